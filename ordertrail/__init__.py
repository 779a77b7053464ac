"""Order-lifecycle and customer analytics as PySpark DataFrame operators."""
