"""Validation, text and CSV sources, JSON artifacts and the run table."""

import datetime as dt

import pytest
from pyspark.sql import Row, functions as F, types as T

from fleetgauge.operators import rules, runs
from fleetgauge.schema import OPS, READING, SENSORS
from fleetgauge.sources import tables


def base(spark, **changes):
    """One good reading with some columns changed."""
    row = {"variant": "FD001", "unit_id": 1, "cycle": 1, **{o: 0.0 for o in OPS}, **{s: 100.0 for s in SENSORS}}
    row["op_setting_3"] = 100.0
    return {**row, **changes}


def frame(spark, *rows):
    return spark.createDataFrame([tuple(r[f.name] for f in READING) for r in rows], READING)


def test_good_rows_pass(spark):
    df = frame(spark, *[base(spark, unit_id=u, cycle=c) for u in (1, 2, 3) for c in (1, 2, 3)])
    assert rules.validate(df).count() == 9


@pytest.mark.parametrize(
    "change", [{"unit_id": -1}, {"cycle": 0}, {"op_setting_3": 200.0}, {"op_setting_1": 42.0}, {"sensor_7": None}]
)
def test_bad_values_are_refused(spark, change):
    df = frame(spark, base(spark, **change))
    with pytest.raises(rules.ValidationError):
        rules.validate(df)
    marked = rules.validate(df, mode="lenient")
    assert marked.count() == 1 and not marked.first()["is_valid"]


def test_duplicates_and_empty_rows(spark):
    with pytest.raises(rules.ValidationError, match="unique"):
        rules.validate(frame(spark, base(spark), base(spark)))
    empty = {f.name: None for f in READING}
    with pytest.raises(rules.ValidationError, match="all_missing"):
        rules.validate(frame(spark, base(spark), empty))


def test_missing_columns_are_listed_sorted(spark):
    df = frame(spark, base(spark)).drop("sensor_3", "sensor_2")
    with pytest.raises(rules.ValidationError, match=r"\['sensor_2', 'sensor_3'\]"):
        rules.validate(df)


def test_quarantine_keeps_every_row(spark):
    df = frame(spark, base(spark), base(spark, cycle=-1, sensor_1=None))
    good, bad = rules.quarantine(df)
    assert good.count() == 1 and sorted(bad.first()["broken"]) == ["cycle", "sensor_1"]


def test_serving_rules(spark):
    good = {
        "sensor_2": 642.0, "sensor_3": 1589.0, "sensor_4": 1400.0, "sensor_7": 554.0, "sensor_8": 2388.0,
        "sensor_9": 9046.0, "sensor_11": 47.0, "sensor_12": 522.0, "sensor_13": 2388.0,
        "sensor_14": 8138.0, "sensor_19": 100.0, "sensor_20": 39.0,
    }
    df = frame(spark, base(spark, **good), base(spark, **{**good, "sensor_8": 2600.0}), base(spark, **{**good, "unit_id": 0}))
    assert [r["is_valid"] for r in rules.mark_valid(df, rules.SERVING_RULES).collect()] == [True, False, False]


def test_text_readings_with_ragged_blanks(spark, tmp_path):
    (tmp_path / "train_FD001.txt").write_text("1 1 0.5  -0.1 100.0 518.67  \n1   2 NaN 0 100.0 x 7\n\n")
    (tmp_path / "train_FD003.txt").write_text("  4 9 1 2 3 4\n")
    df = tables.load_readings(spark, str(tmp_path), ["fd001", "FD003"])
    rows = {(r["variant"], r["cycle"]): r for r in df.collect()}
    assert len(rows) == 3 and rows["FD001", 1]["sensor_1"] == 518.67
    assert rows["FD001", 2]["op_setting_1"] is None and rows["FD001", 2]["sensor_1"] is None
    assert rows["FD001", 2]["sensor_2"] == 7.0 and rows["FD003", 9]["unit_id"] == 4
    assert [f.name for f in df.schema] == [f.name for f in READING]


def test_unknown_variant_split_and_file(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.readings_path("x", "FD009")
    with pytest.raises(ValueError):
        tables.readings_path("x", "FD001", "validation")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.load_readings(spark, str(tmp_path), ["FD001"])


def test_truth_is_numbered_by_line_over_file_blocks(spark, tmp_path):
    values = [(i * 37) % 200 for i in range(500)]
    (tmp_path / "RUL_FD002.txt").write_text("".join(f"{v} \n" for v in values))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        rows = tables.read_truth(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r["unit_id"]: r["true_rul"] for r in rows} == {i + 1: float(v) for i, v in enumerate(values)}
    assert {r["variant"] for r in rows} == {"FD002"}


def test_csv_needs_its_columns(spark, tmp_path):
    spark.createDataFrame([(1, 2.0)], "unit_id int, sensor_1 double").write.csv(str(tmp_path / "c"), header=True)
    schema = T.StructType.fromDDL("unit_id int, sensor_1 double")
    with pytest.raises(rules.ValidationError, match="sensor_2"):
        tables.read_csv(spark, str(tmp_path / "c"), schema, ["sensor_1", "sensor_2"])


def test_batch_score_passes_extra_columns(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.3), ("b", 1.4)], "tag string, p double")
    tables.batch_score(df, F.col("p"), str(tmp_path / "out"))
    rows = {r["tag"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows["a"]["estimated_rul"] == pytest.approx(238.0) and not rows["a"]["replace_within_30"]
    assert rows["b"]["risk_score"] == 1.0 and rows["b"]["estimated_rul"] == 0.0


def test_json_artifact(spark, tmp_path):
    schema = T.StructType.fromDDL("alpha double, q_hat double")
    path = str(tmp_path / "qhat")
    assert tables.read_json(spark, path, schema) is None
    tables.write_json(spark.createDataFrame([(0.1, 0.37)], schema), path)
    assert tables.read_json(spark, path, schema).first()["q_hat"] == 0.37


def test_run_table(spark, tmp_path):
    def run(i, name, variant, day, metrics):
        return (i, name, dt.datetime(2026, 1, day), {"variant": variant}, metrics)

    path = str(tmp_path / "runs")
    runs.append_runs(runs.run_rows(spark, [
        run("1", "forest", "FD001", 1, {"track_a_pr_auc": 0.9}),
        run("2", "forest", "FD001", 2, {"track_a_pr_auc": 0.8, "track_b_f1": 0.1}),
        run("3", "xgboost_rul_regressor_FD001", "FD001", 1, {"deploy_mae": 5.0}),
    ]), path)
    runs.append_runs(runs.run_rows(spark, [run("4", "logistic", None, 1, {"track_a_pr_auc": 0.85})]), path)
    table = runs.scan_runs(spark, path)
    found = {r["model"]: r for r in runs.classifier_table(table).collect()}
    assert set(found) == {"forest", "logistic"} and found["forest"]["A_pr_auc"] == 0.8
    assert found["logistic"]["variant"] == "cross" and found["logistic"]["B_f1"] is None
    assert runs.regressor_table(table).first()["deploy_mae"] == 5.0
    best = runs.best_per_metric(runs.classifier_table(table), ["A_pr_auc", "B_f1"]).collect()
    assert {(r["metric"], r["model"]) for r in best} == {("A_pr_auc", "logistic"), ("B_f1", "forest")}
    assert runs.runs_above(table, "track_a_pr_auc", 0.84).count() == 2


def test_truth_skips_blank_lines(spark, tmp_path):
    (tmp_path / "RUL_FD001.txt").write_text("112\n98\n\n69\n  \n82\n\n")
    rows = tables.read_truth(spark, str(tmp_path / "RUL_FD001.txt")).orderBy("unit_id").collect()
    assert [(r.unit_id, r.true_rul) for r in rows] == [(1, 112.0), (2, 98.0), (3, 69.0), (4, 82.0)]
