"""Hand-written rows for every trap."""

from datetime import datetime
from decimal import Decimal as D

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ordertrail.functions import (
    first_nonnull,
    half_even,
    half_up,
    mode_or,
    most_frequent,
    parse_ts,
    ratio,
    sum_or_zero,
    whole_days,
)
from ordertrail.operators import churn, evaluate, quality, reports, segments, star
from ordertrail.operators.dedup import dedup_first
from ordertrail.operators.onerow import with_overall_max
from ordertrail.sources import append_new, read_csv, read_sql, write_csv, write_table


def fact(spark, data):
    return spark.createDataFrame(data, "order_status string, order_revenue decimal(10,2)")


def test_funnel_null_status(spark):
    out = {r["stage"]: r["cnt"] for r in reports.funnel_conversion(
        fact(spark, [("created", None), ("delivered", None), (None, None)])).collect()}
    assert (out["created"], out["approved"], out["delivered"]) == (3, 1, 1)


def test_funnel_canceled_and_unavailable(spark):
    out = reports.funnel_conversion(fact(spark, [("canceled", None), ("unavailable", None)])).collect()
    assert [(r["stage"], r["cnt"]) for r in out] == [
        ("created", 2), ("approved", 2), ("invoiced", 1), ("processing", 1), ("shipped", 1), ("delivered", 0)]
    assert [r["dropoff_pct"] for r in out] == [None, D("0.00"), D("50.00"), D("0.00"), D("0.00"), D("100.00")]


def test_dropoff_after_an_empty_stage_is_null(spark):
    steps = spark.createDataFrame([(1, 0), (2, 0)], "step int, cnt long")
    assert rows(reports.dropoff(steps), "dropoff_pct") == [(None,), (None,)]


def test_status_without_revenue_sorts_first(spark):
    data = fact(spark, [("created", None), ("delivered", D("5.00"))])
    for report in (reports.revenue_leakage, reports.revenue_by_status):
        out = report(data).collect()
        assert out[0]["order_status"] == "created"
        assert out[0]["stage_gmv"] is None and out[0]["avg_order_value"] is None


def test_average_order_value_twins(spark):
    data = fact(spark, [("canceled", D("10.00")), ("canceled", None)])
    assert reports.revenue_leakage(data).first()["avg_order_value"] == D("5.00")
    assert reports.revenue_by_status(data).first()["avg_order_value"] == D("10.00")


@pytest.mark.parametrize("actual,due,days", [
    ("2018-01-01 12:00:00", "2018-01-01 18:00:00", -1),
    ("2018-01-02 12:00:00", "2018-01-01 18:00:00", 0),
    ("2018-01-02 18:00:00", "2018-01-01 18:00:00", 1),
    ("2018-01-01 18:00:00", "2018-01-02 18:00:00", -1),
    ("2018-01-01 11:59:59", "2018-01-02 18:00:00", -2),
    ("2018-03-26 01:30:00", "2018-03-25 02:00:00", 0),
])
@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_whole_days(spark, actual, due, days, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(actual, due)], "a string, b string").select(
            parse_ts("a").alias("a"), parse_ts("b").alias("b"))
        assert df.select(whole_days("a", "b")).first()[0] == days
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_review_means_round_half_to_even(spark):
    data = [("a", 2), ("a", 3), ("b", 3), ("b", 4), ("c", 4), ("c", 5), ("d", None), (None, 1)]
    out = star.review_agg(spark.createDataFrame(data, "order_id string, review_score int"))
    assert rows(out) == [("a", 2), ("b", 4), ("c", 4), ("d", None)]


def test_rounding_pairs(spark):
    df = spark.createDataFrame([(D("2.5"), D("0.125"))], "a decimal(10,3), b decimal(10,3)")
    assert df.select(half_even("a"), half_up("a", 0), half_even("b", 2), half_up("b", 2)).first() == (
        D(2), D(3), D("0.12"), D("0.13"))


def test_ratio_keeps_ten_places(spark):
    df = spark.createDataFrame([(1, 3), (1, 0)], "a long, b long")
    assert rows(df.select(ratio("a", "b").alias("r"))) == [(D("0.3333333333"),), (None,)]


def test_payments(spark):
    data = [("tie", "voucher", 1, D("1.00")), ("tie", "card", 2, D("2.00")), ("tie", "card", 1, D("3.00")),
            ("tie", "voucher", 1, None), ("none", None, 1, None), ("none", None, 3, None),
            (None, "card", 1, D("1.00"))]
    out = star.dim_payments(spark.createDataFrame(
        data, "order_id string, payment_type string, payment_installments int, payment_value decimal(10,2)"))
    assert rows(out) == [("none", None, 3, D("0.00")), ("tie", "card", 2, D("6.00"))]


def test_aggregates_on_null(spark):
    df = spark.createDataFrame([(None, 1, None), ("x", 2, None)], "v string, line int, n int")
    out = df.agg(first_nonnull("v", ["line"]).alias("first"), most_frequent("n").alias("m"),
                 mode_or("v").alias("known"), sum_or_zero("n").alias("s"))
    assert tuple(out.first()) == ("x", None, "x", 0)
    assert df.filter("v IS NULL").agg(mode_or("v").alias("m")).first()["m"] == "unknown"


def test_junk_timestamp(spark):
    df = spark.createDataFrame([("junk",), ("2018-01-01 00:00:00",), (None,)], "t string")
    assert rows(df.select(parse_ts("t").alias("t"))) == [(None,), (None,), (datetime(2018, 1, 1),)]


def test_foreign_keys(spark):
    orders = spark.createDataFrame(
        [(1, "c", "p", "s"), (2, "c", None, None), (3, "c", "zz", "s"), (4, None, "p", "s"), (5, "zz", "zz", "zz")],
        "order_id int, customer_id string, product_id string, seller_id string")
    dim = lambda col, v: spark.createDataFrame([(v,), (v,), (None,)], f"{col} string")
    refs = [("customer_id", dim("customer_id", "c"), False), ("product_id", dim("product_id", "p"), True),
            ("seller_id", dim("seller_id", "s"), True)]
    assert rows(quality.fk_filter(orders, refs), "order_id") == [(1,), (2,)]
    assert dict(rows(quality.fk_report(orders, refs))) == {
        "customer_id": 2, "product_id": 2, "seller_id": 1, "any": 3}


def test_keys_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (None, "d")], "id int, v string")
    assert rows(quality.pk_check(df, "id")) == [(1, 2), (None, 2)]
    assert rows(quality.notnull_check(df, ["id", "v"])) == [(2, None), (None, "c"), (None, "d")]
    assert tuple(quality.null_key_counts(df, ["id", "v"]).first()) == (2, 1)


def test_dedup_first(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (None, "x", 1), (None, "y", 0)], "id int, v string, o int")
    assert rows(dedup_first(df, "id", ["o"])) == [(1, "b", 1), (None, "y", 0)]
    assert rows(dedup_first(df, "id")) == [(1, "a", 2), (None, "x", 1)]


def test_products_with_repeated_translation(spark):
    products = spark.createDataFrame(
        [("p1", "beleza", D(1), D(1), D(1), D(1)), ("p2", "novo", D(1), D(1), D(1), D(1)),
         ("p3", None, D(1), D(1), D(1), D(1))],
        "product_id string, product_category_name string, product_weight_g decimal(10,2), "
        "product_length_cm decimal(10,2), product_height_cm decimal(10,2), product_width_cm decimal(10,2)")
    names = spark.createDataFrame([("beleza", "beauty"), ("beleza", "health")],
                                  "product_category_name string, product_category_name_english string")
    out = star.dim_products(products, names)
    assert rows(out, "product_id", "product_category_en") == [("p1", "beauty"), ("p2", None), ("p3", None)]


def test_types(spark):
    df = spark.createDataFrame([("RJ", D("1.005")), ("RJX", D("2.00"))], "state string, v decimal(12,3)")
    kinds = {"state": "char(2)", "v": "decimal(10,2)"}
    good, bad = quality.type_quarantine(df, kinds)
    assert rows(good) == [("RJ", D("1.01"))]
    assert rows(bad, "state", "violations") == [("RJX", ["state"])]
    assert rows(quality.type_conform(df.limit(1), kinds)) == [("RJ", D("1.01"))]
    with pytest.raises(Exception, match="longer than 2"):
        quality.type_conform(df, kinds).collect()
    with pytest.raises(Exception):
        quality.type_conform(df, {"state": "char(9)", "v": "decimal(2,2)"}).collect()
    assert rows(quality.type_quarantine(df, {"v": "decimal(2,2)"})[1], "violations") == [(["v"],), (["v"],)]


def base(spark, data):
    stamped = [(u, datetime.fromisoformat(t)) for u, t in data]
    return spark.createDataFrame(stamped, "customer_unique_id string, order_purchase_timestamp timestamp_ntz")


def test_purchase_at_the_cutoff_is_not_churned(spark):
    out = churn.churn_label(base(spark, [("a", "2018-04-01 00:00:00"), ("b", "2018-01-01 00:00:00"),
                                         ("c", "2017-12-31 23:59:59"), (None, "2017-01-01 00:00:00")]))
    assert rows(out, "customer_unique_id", "churned") == [("a", 0), ("b", 0), ("c", 1)]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_split_date_has_no_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2017-12-31 23:59:59",), ("2018-01-01 00:00:00",)], "t string").select(
            parse_ts("t").alias("first_purchase"))
        out = churn.time_split(df).selectExpr("CAST(first_purchase AS STRING) AS t", "split")
        assert rows(out) == [("2017-12-31 23:59:59", "train"), ("2018-01-01 00:00:00", "test")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_overall_max_ignores_null(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 4)], "k int, v int")
    assert rows(with_overall_max(df, "v", "top"), "k", "top") == [(1, 5), (2, 5), (3, 5)]


def test_label_encoding_with_null(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "id int, c string")
    assert rows(churn.label_encode(df, ["c"]), "id", "c") == [(1, 1), (2, 2), (3, 0)]


def test_label_encoding_of_many_values(spark):
    df = spark.range(500).selectExpr("id", "concat('v', lpad(id % 100, 3, '0')) AS c")
    out = churn.label_encode(df, ["c"])
    assert out.filter("c <> id % 100").count() == 0 and out.count() == 500


def test_month_boundary(spark):
    data = [(1, datetime(2018, 1, 31, 23, 59, 59)), (2, datetime(2018, 2, 1))]
    df = spark.createDataFrame(data, "customer_id int, order_purchase_timestamp timestamp_ntz").selectExpr(
        "*", "'delivered' AS order_status", "CAST(NULL AS DECIMAL(10,2)) AS order_revenue")
    out = reports.monthly_cohort(df).collect()
    assert [r["order_month"] for r in out] == ["2018-01", "2018-02"]
    assert out[0]["monthly_gmv"] is None


def scored(spark):
    data = list(zip([.1, .4, .4, .8, .8, .9], [0, 0, 1, 1, 0, 1]))
    return spark.createDataFrame([(i, s, y, int(s >= .5)) for i, (s, y) in enumerate(data)],
                                 "id int, churn_probability double, churned int, churn_prediction int")


def test_auc_with_ties(spark):
    assert evaluate.roc_auc(scored(spark)).first()["auc"] == pytest.approx(7 / 9)


def test_auc_of_one_class_is_null(spark):
    assert evaluate.roc_auc(scored(spark).filter("churned = 1")).first()["auc"] is None


def test_roc_curve(spark):
    points = rows(evaluate.roc_curve(scored(spark)), "fpr", "tpr")
    assert points == [(0.0, 0.0), (0.0, 1 / 3), (1 / 3, 2 / 3), (2 / 3, 1.0), (1.0, 1.0)]


def test_classification_report(spark):
    out = {r["class"]: r for r in evaluate.classification_report(scored(spark)).collect()}
    assert out["1"]["precision"] == pytest.approx(2 / 3) and out["0"]["recall"] == pytest.approx(2 / 3)
    assert out["accuracy"]["f1"] == pytest.approx(4 / 6) and out["weighted avg"]["support"] == 6
    never = scored(spark).withColumn("churn_prediction", F.lit(0))
    assert {r["class"]: r["f1"] for r in evaluate.classification_report(never).collect()}["1"] == 0.0


def test_segment_names(spark):
    summary = spark.createDataFrame([(i, D(m)) for i, m in enumerate([5, 9, 9, 1, 2])], "cluster int, monetary decimal(10,2)")
    assert dict(rows(segments.segment_names(summary))) == {
        1: "Champions", 2: "Loyal", 0: "At-Risk", 4: "Lost", 3: "Segment-5"}
    assert dict(rows(segments.segment_names(summary.limit(2)))) == {1: "Champions", 0: "Loyal"}


def test_gaps_are_filled_with_the_train_mean(spark):
    df = spark.createDataFrame([(1, 2.0, "train"), (2, 4.0, "train"), (3, None, "test"), (4, float("nan"), "train")],
                               "id int, v double, split string")
    out = churn.nan_policy(df, ["v"], F.col("split") == "train")
    assert rows(out, "id", "v", "v_missing") == [(1, 2.0, 0), (2, 4.0, 0), (3, 3.0, 1), (4, 3.0, 1)]


def test_class_weight_of_one_class_is_null(spark):
    one = spark.createDataFrame([(1,), (1,)], "churned int")
    assert churn.class_weight(one).first()[0] is None


def test_csv_by_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text('review_id,review_score,"note",order_id\n1,5,"a ""b""\nc, d",o1\n2,x,,o2\n')
    schema = "order_id string, review_score int"
    from pyspark.sql.types import StructType
    out = read_csv(spark, str(tmp_path / "r.csv"), StructType.fromDDL(schema), multi_line=True)
    assert rows(out) == [("o1", 5), ("o2", None)]
    with pytest.raises(ValueError, match="no column"):
        read_csv(spark, str(tmp_path / "r.csv"), StructType.fromDDL("nothing int"))


def test_csv_corrupt_lines(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,b\n1,2\nx,3\n")
    from pyspark.sql.types import StructType
    out = read_csv(spark, str(tmp_path / "c.csv"), StructType.fromDDL("a int, b int"), corrupt="line")
    assert rows(out) == [(1, 2, None), (None, 3, "x,3")]


def test_repeated_append_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    write_table(df, path)
    append_new(df.unionByName(spark.createDataFrame([(3, "c")], df.schema)), path, "id")
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b"), (3, "c")]
    odd = spark.createDataFrame([(4, "y"), (4, "x"), (None, "n"), (None, "m"), (1, "z")], df.schema)
    for _ in range(2):  # the second time adds nothing
        append_new(odd, path, "id")
        assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b"), (3, "c"), (4, "x"), (None, "m")]


def test_csv_files_of_another_order(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b,c\ns1,rome,RM\n")
    (tmp_path / "2.csv").write_text("c,a,b\nMI,s2,milan\n")
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("a string, b string, c string")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path), schema).collect()
    assert rows(read_csv(spark, str(tmp_path), schema, mixed_headers=True)) == [("s1", "rome", "RM"), ("s2", "milan", "MI")]


def test_csv_round_trip_of_a_report(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1), ('q"r', 2)], "s string, n int")
    write_csv(df, str(tmp_path / "out"), single_file=True)
    assert rows(read_csv(spark, str(tmp_path / "out"), df.schema)) == rows(df)


def test_sql_parameters_are_bound(spark):
    df = spark.createDataFrame([("x' OR '1'='1", 1), ("y", 2)], "s string, n int")
    out = read_sql(spark, "SELECT n FROM {t} WHERE s = :s", {"t": df}, s="x' OR '1'='1")
    assert rows(out) == [(1,)]


def test_types_are_strict_without_ansi(spark):
    df = spark.createDataFrame([("12345678901",)], "n string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for kind in ("int", "decimal(4,2)", "varchar(3)"):
            with pytest.raises(Exception, match="n: "):
                quality.type_conform(df, {"n": kind}).collect()
        assert rows(quality.type_conform(df, {"n": "bigint"})) == [(12345678901,)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_more_values_than_clusters_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(segments, "MAX_CLUSTERS", 3)
    df = spark.range(8).selectExpr("id % 4 AS cluster", "CAST(id AS DOUBLE) AS x")
    with pytest.raises(Exception, match="more than 3 clusters"):
        segments.silhouette(df, ["x"]).collect()
