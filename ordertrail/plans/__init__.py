from .catalog import oracles, registered  # noqa: F401
