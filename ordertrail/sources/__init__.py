from .readers import (  # noqa: F401
    load_counts,
    load_raw,
    quarantine_raw,
    read_csv,
    read_jdbc,
    read_parquet,
    read_sql,
    unparsed_counts,
)
from .split_csv import read_split_csv  # noqa: F401
from .writers import (  # noqa: F401
    Star,
    append_new,
    create_star,
    export_all,
    load_star,
    read_star,
    write_csv,
    write_jdbc,
    write_table,
)
