"""The workflows end to end: raw files to star, star to reports, to segments, to a scored churn table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import churn, evaluate, models, reports, rfm, segments, star
from .session import stored
from .sources import Star, export_all, load_raw, load_star, quarantine_raw, unparsed_counts, write_csv

UNREADABLE = "_unreadable"


@dataclass
class Ingestion:
    """The written star with the fact rows it lost, and the raw lines that do not fit, by table and counted."""

    star: Star
    unreadable: dict[str, DataFrame]
    unreadable_counts: DataFrame


def run_ingestion(spark: SparkSession, raw_folder: str, star_folder: str, files: Mapping[str, str] | None = None,
                  line_order: Sequence[str] = ("order_item_id",), **reading) -> Ingestion:
    """Read the raw files, set aside lines that do not fit, build the star and load it.

    ``reading`` goes to ``load_raw``. A failed load leaves the star tables as they were.
    """
    raw = load_raw(spark, raw_folder, files, corrupt=UNREADABLE, **reading)
    raw = {name: stored(df, f"raw-{name}") for name, df in raw.items()}  # parsed once
    good, unreadable = quarantine_raw(raw, UNREADABLE)
    written = load_star({
        "dim_customers": star.dim_customers(good["customers"]),
        "dim_products": star.dim_products(good["products"], good["translation"]),
        "dim_sellers": star.dim_sellers(good["sellers"]),
        "dim_payments": star.dim_payments(good["payments"]),
        "fact_orders": star.fact_orders(good["orders"], good["order_items"], good["reviews"], list(line_order)),
    }, star_folder)
    return Ingestion(written, unreadable, unparsed_counts(raw, UNREADABLE))


def report_builders(tables: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """The lifecycle reports over written star tables, by name."""
    fact = tables["fact_orders"]
    return {
        "funnel_conversion": lambda: reports.funnel_conversion(fact),
        "revenue_leakage": lambda: reports.revenue_leakage(fact),
        "cancellation_by_state": lambda: reports.cancellation_by_state(fact, tables["dim_customers"]),
        "cancellation_by_category": lambda: reports.cancellation_by_category(fact, tables["dim_products"]),
        "monthly_cohort": lambda: reports.monthly_cohort(fact),
        "delivery_delay_by_state": lambda: reports.delivery_delay_by_state(fact, tables["dim_sellers"]),
    }


def run_reports(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Write every report as CSV, a file each: they have a row per stage, status, state, category or month."""
    builders = report_builders(tables)
    return dict(export_all(builders, folder, single_file=builders))


@dataclass
class Segments:
    """Customers with cluster and segment, the sweep over the number of clusters, profiles and sizes."""

    customers: DataFrame
    sweep: DataFrame
    profile: DataFrame
    counts: DataFrame


def run_segments(tables: Mapping[str, DataFrame], folder: str, k: int = segments.DEFAULT_K,
                 k_range: Sequence[int] = range(2, 9), n_init: int = 10) -> Segments:
    """Recency, frequency and monetary value, clusters, named segments, and their export to ``folder``."""
    table = stored(rfm.rfm(tables["fact_orders"], tables["dim_customers"]), "rfm")
    standard, z = stored(rfm.zscore(table), "standard"), [f"{c}_z" for c in rfm.RFM]
    sweep = segments.k_sweep(standard, z, k_range, n_init)
    named = stored(segments.segments_export(segments.assign_segments(
        segments.kmeans_assign(standard, z, k, n_init=n_init))), "segments")
    write_csv(named, folder)
    return Segments(named, sweep, segments.segment_profile(named), segments.segment_counts(named))


@dataclass
class Churn:
    """Scored customers, and how both models do on the test part."""

    scored: DataFrame
    auc: DataFrame
    roc: DataFrame
    report: DataFrame


def run_churn(tables: Mapping[str, DataFrame], folder: str, split_date: str = churn.SPLIT_DATE,
              rounds: int = 300) -> Churn:
    """Features, split by time, both models, evaluation on the test part, and the export of the boosted scores."""
    base = churn.churn_base(tables["fact_orders"], tables["dim_customers"], tables["dim_products"], tables["dim_payments"])
    split = stored(churn.time_split(churn.customer_features(base), split_date), "features")
    vectors, _ = models.model_input(split)
    train, test = churn.split_rows(vectors)
    boosted = models.fit_gbt(churn.split_rows(split)[0], max_iter=rounds)
    fits = {"logreg": (models.fit_logistic(train), test), "gbt": (boosted, churn.split_rows(split)[1])}
    tested = {name: stored(models.score(fit, rows).drop("features"), f"tested-{name}") for name, (fit, rows) in fits.items()}

    def both(measure: Callable[[DataFrame], DataFrame]) -> DataFrame:
        first, second = (measure(df).withColumn("model", F.lit(name)) for name, df in tested.items())
        return first.unionByName(second)

    scored = stored(models.churn_export(models.score(boosted, split)), "scored")
    write_csv(scored, folder)
    return Churn(scored, both(evaluate.roc_auc), both(evaluate.roc_curve), evaluate.classification_report(tested["gbt"]))
