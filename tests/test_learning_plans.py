import pytest
from pyspark.sql import functions as F

from fleetgauge.operators import models, survival
from fleetgauge.plans import catalog

SF = "/root/testdata/sf0.001"
OPERATORS = {
    "y3_random_forest": (models, "train_forest"), "y13_importances": (models, "train_forest"),
    "y4_boosted_trees": (models, "train_boosted"), "y5_rul_regressor": (models, "train_rul_regressor"),
    "y7_fitted_intervals": (models, "train_rul_regressor"),
    "y9_cox_model": (survival, "fit_cox"), "y16_sequence_classifier": (models, "train_sequence_classifier"),
}


class Called(Exception):
    pass


@pytest.mark.parametrize("name", OPERATORS)
def test_queries_fit_with_the_operators_defaults(spark, monkeypatch, name):
    def fit(data, *given, **named):
        raise Called(data, given, named)

    monkeypatch.setattr(*OPERATORS[name], fit)
    with pytest.raises(Called) as found:
        catalog.QUERIES[name](spark, SF)
    data, given, named = found.value.args
    assert not named and len(given) <= 1
    if name == "y16_sequence_classifier":
        assert not given
        assert {len(r.sequence) for r in data.select("sequence").collect()} <= {30}
    elif name != "y9_cox_model":
        assert {f"sensor_{k}_mean_w30" for k in (1, 2, 3)} <= set(given[0])


def test_streamed_model_is_fitted_on_rows_of_all_cores(spark, monkeypatch):
    def fit(data, *given, **named):
        raise Called(data)

    monkeypatch.setattr(models, "train_logistic", fit)
    with pytest.raises(Called) as found:
        catalog.QUERIES["st1_model_stream"](spark, SF)
    (data,) = found.value.args
    assert data.count() == spark.read.parquet(f"{SF}/events.parquet").count()
    sizes = [r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) <= 2 * min(sizes)
