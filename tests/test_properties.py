"""Properties over generated inputs."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ordertrail.operators import churn, evaluate, reports
from ordertrail.operators.ordered import exact_quantiles

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
statuses = st.sampled_from(["created", "approved", "invoiced", "processing", "shipped", "canceled", "unavailable",
                            "delivered", None])


@few
@given(data=st.lists(statuses, min_size=1, max_size=30))
def test_funnel_never_grows(spark, data):
    df = spark.createDataFrame([(s,) for s in data], "order_status string")
    out = reports.funnel_conversion(df).collect()
    counts = [r["cnt"] for r in out]
    assert counts == sorted(counts, reverse=True) and counts[0] == len(data)
    assert all(r["dropoff_pct"] is None or r["dropoff_pct"] >= 0 for r in out)


@few
@given(data=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 1)), min_size=2, max_size=40))
def test_reversed_scores_reverse_the_area(spark, data):
    df = spark.createDataFrame([(s / 5, y) for s, y in data], "churn_probability double, churned int")
    auc = evaluate.roc_auc(df).first()[0]
    turned = evaluate.roc_auc(df.selectExpr("-churn_probability AS churn_probability", "churned")).first()[0]
    if len({y for _, y in data}) == 2:
        assert auc == pytest.approx(1 - turned)
    else:
        assert auc is None and turned is None


@few
@given(data=st.lists(st.one_of(st.none(), st.text("abcß", max_size=3)), min_size=1, max_size=30))
def test_codes_follow_the_order_of_the_values(spark, data):
    out = {r["value"]: r["code"] for r in churn.label_codes(spark.createDataFrame([(v,) for v in data], "c string"),
                                                            ["c"]).collect()}
    assert out == {v: i for i, v in enumerate(sorted({"nan" if v is None else v for v in data}))}


@few
@given(data=st.lists(st.integers(-50, 50), min_size=1, max_size=40))
def test_quantiles_match_linear_interpolation(spark, data):
    import numpy as np
    df = spark.createDataFrame([(v,) for v in data], "v int")
    out = {r["probability"]: r["value"] for r in exact_quantiles(df, ["v"], [0.25, 0.5, 0.75]).collect()}
    assert out == {p: pytest.approx(np.quantile(data, p)) for p in (0.25, 0.5, 0.75)}
