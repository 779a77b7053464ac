"""From raw CSV files, with columns nobody reads, to reports, segments and a scored churn table."""

import random
from decimal import Decimal as D

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ordertrail import pipelines
from ordertrail.operators import models, star
from ordertrail.sources import create_star, load_counts, load_raw, load_star, read_star, writers

N = 300


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw")
    rnd = random.Random(3)
    kinds = ["credit_card", "boleto", "voucher"]

    def write(name, header, lines):
        (path / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")

    write("customers", '"customer_id","customer_unique_id","customer_zip","customer_city","customer_state"',
          [f"c{i},u{i // 2},0123,\"são paulo\",{['SP', 'RJ', 'MG'][i % 3]}" for i in range(N)] + ["c0,u0,9,zz,ZZ"])
    write("sellers", "seller_id,seller_zip,seller_city,seller_state", [f"s{i},1,x,SP" for i in range(9)])
    write("products", "product_id,product_category_name,product_name_length,product_weight_g,product_length_cm,"
          "product_height_cm,product_width_cm", [f"p{i},k{i % 4},9,{i},1.005,,3" for i in range(20)] + ["p99,,,,,,"])
    write("translation", "product_category_name,product_category_name_english", ["k0,toys", "k1,books", "k2,auto"])
    write("orders", "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
          "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date",
          [f"o{i},c{i if i % 50 else 9999},{'canceled' if i % 10 == 0 else 'delivered'},"
           f"{2017 + i % 2}-{1 + i % 12:02d}-15 10:00:00,,,{2017 + i % 2}-{1 + i % 12:02d}-20 10:00:00,"
           f"{'broken' if i % 7 == 0 else f'{2017 + i % 2}-{1 + i % 12:02d}-19 12:00:00'}" for i in range(N)])
    write("order_items", "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value",
          [f"o{i},{j},p{rnd.randrange(20)},s{rnd.randrange(9)},x,{10 + i % 5}.5,1.25"
           for i in range(N) if i % 20 for j in (1, 2)])
    write("payments", "order_id,payment_sequential,payment_type,payment_installments,payment_value",
          [f"o{i},1,{kinds[i % 3]},{i % 6},{i}.10" for i in range(N)])
    write("reviews", "review_id,order_id,review_score,review_comment_message,review_answer_timestamp",
          [f'r{i},o{i},{1 + i % 5},"two\nlines, and a ""quote""",x' for i in range(N)])
    return str(path)


@pytest.fixture(scope="module")
def loaded(spark, folder, tmp_path_factory):
    raw = load_raw(spark, folder)
    built = {
        "dim_customers": star.dim_customers(raw["customers"]),
        "dim_products": star.dim_products(raw["products"], raw["translation"]),
        "dim_sellers": star.dim_sellers(raw["sellers"]),
        "dim_payments": star.dim_payments(raw["payments"]),
        "fact_orders": star.fact_orders(raw["orders"], raw["order_items"], raw["reviews"], ["order_item_id"]),
    }
    target = str(tmp_path_factory.mktemp("star"))
    create_star(spark, target)
    load_star(built, target)
    return raw, built, load_star(built, target)


def test_counts(loaded):
    raw, _, tables = loaded
    assert dict(rows(load_counts(raw)))["reviews"] == N
    counts = dict(rows(load_counts(tables)))
    # six orders name a customer that does not exist
    assert counts == {"dim_customers": N, "dim_products": 21, "dim_sellers": 9, "dim_payments": N, "fact_orders": N - 6}


def test_written_types(loaded):
    _, _, tables = loaded
    kinds = dict(tables["fact_orders"].dtypes)
    assert kinds["order_revenue"] == "decimal(10,2)" and kinds["order_purchase_timestamp"] == "timestamp_ntz"
    assert tables["dim_products"].filter("product_id = 'p1'").first()["product_length_cm"] == D("1.01")
    row = tables["fact_orders"].filter("order_id = 'o1'").first()
    assert row["order_revenue"] == D("25.50") and row["delivery_delay_days"] == D("0.00") and row["review_score"] == 2
    assert tables["fact_orders"].filter("order_id = 'o7'").first()["delivery_delay_days"] is None


def test_a_repeated_key_stops_the_load(loaded, tmp_path):
    _, built, _ = loaded
    twice = built | {"fact_orders": built["fact_orders"].union(built["fact_orders"])}
    with pytest.raises(ValueError, match="unique order_id"):
        load_star(twice, str(tmp_path))


def contents(spark, folder):
    return {name: df.count() for name, df in read_star(spark, folder).items()}


STEPS = {"types": (0, "type_conform"), "first table": (0, "write_table"), "third table": (2, "write_table"),
         "fact": (4, "write_table"), "references": (0, "fk_drop"), "keys of dimensions": (0, "pk_check"),
         "keys of the fact": (4, "pk_check"), "publishing": (0, "_publish"), "pointer": (0, "_claim")}


@pytest.fixture(scope="module")
def small(loaded):
    """The tables of two orders' customers, to load before and after."""
    _, built, _ = loaded
    return {n: df.limit(3) if n != "fact_orders" else df.where("false") for n, df in built.items()}


@pytest.mark.parametrize("step", STEPS)
def test_a_load_that_fails_anywhere_changes_nothing(spark, loaded, small, tmp_path, monkeypatch, step):
    load_star(small, str(tmp_path))
    before = contents(spark, str(tmp_path))
    assert before == {n: 3 if n != "fact_orders" else 0 for n in small}
    after, name = STEPS[step]
    real, calls = getattr(writers, name), []

    def fails(*args, **kwargs):
        calls.append(name)
        if len(calls) > after:
            raise OSError("injected")
        return real(*args, **kwargs)

    monkeypatch.setattr(writers, name, fails)
    with pytest.raises(OSError, match="injected"):
        load_star(loaded[1], str(tmp_path))
    monkeypatch.undo()
    assert contents(spark, str(tmp_path)) == before
    assert len(list((tmp_path / "versions").iterdir())) == len(list((tmp_path / "pointers").glob("0*"))) == 1
    load_star(loaded[1], str(tmp_path))
    assert contents(spark, str(tmp_path))["fact_orders"] == N - 6


def test_a_load_with_broken_keys_changes_nothing(spark, loaded, small, tmp_path):
    _, built, _ = loaded
    load_star(small, str(tmp_path))
    before = contents(spark, str(tmp_path))
    for bad, what in ((built | {"fact_orders": built["fact_orders"].union(built["fact_orders"])}, "fact_orders: 294 x unique order_id"),
                      (built | {"dim_sellers": built["dim_sellers"].union(built["dim_sellers"])}, "9 x unique seller_id"),
                      (built | {"dim_customers": built["dim_customers"].withColumn("customer_unique_id", F.lit(None).cast("string"))},
                       "not null customer_unique_id")):
        with pytest.raises(ValueError, match=what):
            load_star(bad, str(tmp_path))
        assert contents(spark, str(tmp_path)) == before


def test_readers_keep_the_version_they_have(spark, loaded, small, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_star(spark, str(tmp_path))
    load_star(loaded[1], str(tmp_path))
    reader = read_star(spark, str(tmp_path))
    written = load_star(small, str(tmp_path))
    assert written.counts["dim_sellers"] == 3 and contents(spark, str(tmp_path))["dim_sellers"] == 3
    assert reader["dim_sellers"].count() == 9
    # the version before the last is still there, the ones before are not
    load_star(small, str(tmp_path))
    assert len(list((tmp_path / "versions").iterdir())) == writers.KEPT_VERSIONS


def test_counts_come_with_the_write(loaded):
    _, _, tables = loaded
    assert tables.counts == {name: df.count() for name, df in tables.items()}


def test_dropped_rows_are_reported(loaded):
    assert loaded[2].dropped == {"customer_id": 6, "product_id": 0, "seller_id": 0, "any": 6}


def test_ingestion_sets_broken_lines_aside(spark, folder, tmp_path):
    import shutil
    shutil.copytree(folder, tmp_path / "raw")
    lines = (tmp_path / "raw/order_items.csv").read_text().splitlines()
    lines[1] = lines[1].replace(",11.5,", ",n/a,").replace(",10.5,", ",n/a,")
    (tmp_path / "raw/order_items.csv").write_text("\n".join(lines) + "\n")
    done = pipelines.run_ingestion(spark, str(tmp_path / "raw"), str(tmp_path / "star"))
    assert rows(done.unreadable_counts) == [("order_items", "*", 1), ("order_items", "price", 1)]
    assert "n/a" in done.unreadable["order_items"].first()[pipelines.UNREADABLE]
    assert done.star["fact_orders"].count() == N - 6


def test_reports_and_export(spark, loaded, tmp_path):
    written = pipelines.run_reports(loaded[2], str(tmp_path))
    assert spark.read.option("header", True).csv(written["funnel_conversion"]).count() == 6
    assert len(written) == 6 and spark.read.option("header", True).csv(written["revenue_leakage"]).count() == 2


def test_segments_and_churn(spark, loaded, tmp_path):
    found = pipelines.run_segments(loaded[2], str(tmp_path / "segments"), 3, k_range=(2, 3), n_init=1)
    assert {r["segment"] for r in found.profile.collect()} == {"Champions", "Loyal", "At-Risk"}
    assert sum(r["count"] for r in found.counts.collect()) == found.customers.count()
    assert [r["k"] for r in found.sweep.orderBy("k").collect()] == [2, 3]
    churned = pipelines.run_churn(loaded[2], str(tmp_path / "churn"), rounds=2)
    assert churned.scored.columns == models.EXPORT
    assert spark.read.option("header", True).csv(str(tmp_path / "churn")).count() == churned.scored.count()
    assert {r["model"] for r in churned.auc.collect()} == {r["model"] for r in churned.roc.collect()} == {"logreg", "gbt"}
    assert "accuracy" in {r["class"] for r in churned.report.collect()}
