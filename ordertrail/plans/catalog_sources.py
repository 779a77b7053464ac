"""Sources and sinks: every query writes or reads real tables and returns what came back."""

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse_ts
from ..operators import reports
from ..schemas import LIFECYCLE_TIMESTAMPS, RAW, STAR, raw_schema
from ..session import scratch_path
from ..sources import (
    append_new,
    create_star,
    export_all,
    load_counts,
    load_raw,
    load_star,
    read_csv,
    read_parquet,
    read_split_csv,
    read_sql,
    write_csv,
    write_table,
)
from .catalog_star import FACT_SQL
from .registry import query
from .tables import Tables

# The bundled keys are integers; text widths of the contract apply to the real data set, so the
# written types here only widen the keys and the states.
_KINDS = {
    name: {c: ("bigint" if c.endswith("_id") else "varchar(100)" if c.endswith("_state") else
               "decimal(12,2)" if kind == "decimal(10,2)" else kind) for c, kind in cols.items()}
    for name, cols in STAR.items()
}


def _as_text(df):
    stamps = [f.name for f in df.schema if f.dataType.simpleString() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("string") for c in stamps})


@query("src_csv", f"""
    SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_status,
           {", ".join(LIFECYCLE_TIMESTAMPS)}
    FROM raw_orders""")
def _(t: Tables):
    path = scratch_path(t.spark, "orders-csv")
    write_csv(_as_text(t.orders), path)
    orders = read_csv(t.spark, path, raw_schema("orders"))
    return orders.withColumns({c: parse_ts(c) for c in LIFECYCLE_TIMESTAMPS})


@query("src_csv_split", """
    SELECT order_id, coalesce(order_status, 'none') || chr(10) || '"' || customer_id || '",' AS review, customer_id FROM raw_orders""")
def _(t: Tables):
    """Text with line breaks and quotes, written and read back by splits."""
    path = scratch_path(t.spark, "split-csv")
    said = F.concat(F.coalesce("order_status", F.lit("none")), F.lit('\n"'), F.col("customer_id"), F.lit('",'))
    written = t.orders.select("order_id", said.alias("review"), "customer_id")
    write_csv(written, path)
    return read_split_csv(t.spark, path, written.schema)


# number of rows and, per column, of values and of different values, and the sum of the money
_CONTENTS = {name: re.findall(r"(\w+) (?:string|int|decimal)", ddl) for name, ddl in RAW.items()}
_SUMS = {"order_items": "price", "payments": "payment_value", "products": "product_length_cm", "reviews": "review_score"}


def column_contents(df: DataFrame, summed: str | None = None) -> DataFrame:
    """Per column the rows, its values, its different values, and of ``summed`` the sum as a double.

    Values are counted as text, a short row per column and value: several distinct counts in one aggregation would make
    every row as often as there are columns, each as wide as all of them. Columns are of text or exact numbers.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).cast("string").alias("value")) for i, c in enumerate(df.columns)])
    value, n = F.col("value"), F.col("n")
    counted = df.select(F.inline(cells)).groupBy("at", "value").agg(F.count("*").alias("n"))
    number = value.try_cast(df.schema[summed].dataType) * n if summed else F.lit(None).cast("bigint")
    total = F.sum(F.when(F.col("at") == df.columns.index(summed), number) if summed else number).cast("double")
    columns = counted.groupBy("at").agg(F.sum("n").alias("rows"), F.sum(F.when(value.isNotNull(), n).otherwise(0)).alias("filled"),
                                        F.count("value").alias("different"), total.alias("total"))
    # a row per column; a table without rows has none
    found = columns.agg(F.map_from_entries(F.collect_list(F.struct("at", F.struct("rows", "filled", "different", "total")))).alias("found"))

    def of(i: int, what: str):
        return F.try_element_at("found", F.lit(i))[what]

    return found.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), *[F.coalesce(of(i, x), F.lit(0)).alias(x) for x in ("rows", "filled", "different")],
        of(i, "total").alias("total")) for i, c in enumerate(df.columns)])))


@query("src_csv_all", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{c}' AS \"column\", count(*) AS rows, count({c}) AS filled, "
    f"count(DISTINCT {c}) AS different, CAST({f'sum({c})' if _SUMS.get(name) == c else 'NULL'} AS DOUBLE) AS total "
    f"FROM raw_{name}" for name, columns in _CONTENTS.items() for c in columns))
def _(t: Tables):
    folder = scratch_path(t.spark, "csv")
    for name, raw in t.raw.items():
        write_csv(_as_text(raw.select(*[c for c in raw.columns if c in raw_schema(name).names])), f"{folder}/{name}.csv")
    return reduce(DataFrame.unionByName, [column_contents(df, _SUMS.get(name)).select(F.lit(name).alias("table_name"), "*")
                                          for name, df in load_raw(t.spark, folder, multi_line=()).items()])


@query("src_parquet", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def _(t: Tables):
    return read_parquet(t.spark, f"{t.folder}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderdate"])


@query("src_sql", """
    SELECT customer_id, count(*) AS orders, CAST(sum(order_revenue) AS DOUBLE) AS revenue
    FROM fact_orders WHERE order_status = 'delivered' GROUP BY customer_id""")
def _(t: Tables):
    return read_sql(t.spark, """
        SELECT customer_id, count(*) AS orders, sum(order_revenue) AS revenue
        FROM {fact} WHERE order_status = :status GROUP BY customer_id""", {"fact": t.fact}, status="delivered")


@query("sink_table", FACT_SQL)
def _(t: Tables):
    path = scratch_path(t.spark, "fact_orders")
    write_table(t.fact, path)
    append_new(t.fact, path, "order_id")  # a repeated load adds nothing
    return t.spark.read.parquet(path)


def _created(name: str) -> str:
    """The columns of an empty table and their types, in order, as SQL values."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {i} AS position, '{c}' AS \"column\", "
        f"'{'string' if 'char' in kind else kind}' AS kind, CAST(0 AS BIGINT) AS created_rows, count(*) AS loaded_rows, "
        f"count({c}) AS filled FROM {name}" for i, (c, kind) in enumerate(STAR[name].items()))


@query("ddl_star", " UNION ALL ".join(map(_created, STAR)))
def _(t: Tables):
    """What the created tables hold and are made of, before the load and after it."""
    folder = scratch_path(t.spark, "star")
    empty = create_star(t.spark, folder)
    before = {r["table_name"]: r["row_count"] for r in load_counts(empty).collect()}  # a row per table
    kinds = [(name, i, f.name, f.dataType.simpleString(), before[name]) for name, df in empty.items()
             for i, f in enumerate(df.schema)]
    created = t.spark.createDataFrame(
        kinds, "table_name string, position int, column string, kind string, created_rows long")
    parts = []
    for name, df in load_star(t.star, folder, _KINDS).items():
        counts = df.agg(F.count("*").alias("loaded_rows"), *[F.count(c).alias(c) for c in df.columns])
        parts.append(counts.select(F.lit(name).alias("table_name"), F.inline(F.array(*[F.struct(
            F.lit(c).alias("column"), "loaded_rows", F.col(c).alias("filled")) for c in df.columns]))))
    return created.join(reduce(DataFrame.unionByName, parts), ["table_name", "column"])


@query("sink_csv", """
    SELECT customer_id, customer_unique_id, customer_city, customer_state FROM dim_customers""")
def _(t: Tables):
    path = scratch_path(t.spark, "customers-csv")
    write_csv(t.dim_customers, path)
    return read_csv(t.spark, path, t.dim_customers.schema)


_REPORT_SQL = {
    "revenue_by_status": ("order_status", """
        SELECT coalesce(order_status, '') AS item, count(*) AS orders FROM fact_orders GROUP BY order_status"""),
    "cancellation_by_state": ("customer_state", """
        SELECT customer_state AS item, count(*) AS orders FROM fact_orders JOIN dim_customers USING (customer_id)
        GROUP BY customer_state HAVING count(*) > 100"""),
    "monthly_cohort": ("order_month", """
        SELECT strftime(order_purchase_timestamp, '%Y-%m') AS item, count(*) AS orders FROM fact_orders
        WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL GROUP BY item"""),
    "delivery_delay_by_state": ("seller_state", """
        SELECT seller_state AS item, count(*) AS orders FROM fact_orders JOIN dim_sellers USING (seller_id)
        WHERE order_status = 'delivered' AND delivery_delay_days IS NOT NULL
        GROUP BY seller_state HAVING count(*) > 100"""),
    "customers": ("customer_id", """
        SELECT CAST(customer_id AS VARCHAR) AS item, CAST(customer_unique_id AS BIGINT) AS orders FROM dim_customers"""),
}


@query("export_all", " UNION ALL ".join(
    f"SELECT '{name}' AS report, item, CAST(orders AS BIGINT) AS orders FROM ({sql})" for name, (_, sql) in _REPORT_SQL.items()))
def _(t: Tables):
    """What the written reports say: each item and its number of orders (of the customer list, the person)."""
    folder = scratch_path(t.spark, "export")
    # the reports read the fact, so it is written once with the star and read by each
    star = load_star(t.star, f"{folder}/star", _KINDS)
    fact = star["fact_orders"]
    builds = {
        "revenue_by_status": lambda: reports.revenue_by_status(fact),
        "cancellation_by_state": lambda: reports.cancellation_by_state(fact, star["dim_customers"]),
        "monthly_cohort": lambda: reports.monthly_cohort(fact),
        "delivery_delay_by_state": lambda: reports.delivery_delay_by_state(fact, star["dim_sellers"]),
        "customers": lambda: star["dim_customers"],
    }
    number = {"revenue_by_status": "order_count", "customers": "customer_unique_id"}
    parts = []
    for name, path in export_all(builds, f"{folder}/reports", single_file=set(builds) - {"customers"}):
        written = t.spark.read.option("header", True).csv(path)
        parts.append(written.select(
            F.lit(name).alias("report"), F.coalesce(F.col(_REPORT_SQL[name][0]), F.lit("")).alias("item"),
            F.col(number.get(name, "total_orders")).cast("bigint").alias("orders")))
    return reduce(DataFrame.unionByName, parts)


@query("load_counts", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM raw_{name}" for name in RAW))
def _(t: Tables):
    return load_counts({name: t.raw[name] for name in RAW})
