"""Streams, files, models and the shared folder."""

import pytest
from pyspark.sql import functions as F

from riskloom import session
from riskloom.operators import model
from riskloom.operators.prepare import add_hour
from riskloom.operators.risk import fraud_by_hour
from riskloom.plans.catalog import QUERIES
from riskloom.plans.catalog.learning import feature_names, training_parts
from riskloom.schema import RAW_SCHEMA
from riskloom.sources import files
from riskloom.sources.transactions import transactions
from riskloom.streaming import jobs

SF_DIR = "/root/testdata/sf0.001"


def test_stream_over_many_files_and_a_restart_equals_batch(spark, tmp_path):
    rows = transactions(spark, SF_DIR, ["trans_num", "trans_time", "is_fraud"])
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows.filter("trans_num % 2 = 0").repartition(4).write.parquet(source)
    schema = rows.schema
    jobs.run_fraud_by_hour(jobs.file_stream(spark, source, schema, files_per_batch=1), target, state)
    rows.filter("trans_num % 2 = 1").repartition(3).write.mode("append").parquet(source)
    jobs.run_fraud_by_hour(jobs.file_stream(spark, source, schema, files_per_batch=1), target, state)
    want = [tuple(r) for r in fraud_by_hour(add_hour(rows)).collect()]
    got = jobs.latest_report(spark, target).orderBy("hour").select("hour", "fraud_count", "total_count", "fraud_rate")
    assert [tuple(r) for r in got.collect()] == want


def test_prepared_stream_equals_batch(spark, tmp_path):
    rows = transactions(spark, SF_DIR)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows.repartition(3).write.parquet(source)
    jobs.run_prepare(jobs.file_stream(spark, source, rows.schema, files_per_batch=1), target, str(tmp_path / "state"))
    batch = jobs.prepare_rows(rows)
    got = spark.read.parquet(target).select(batch.columns)
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_report_roundtrip(spark, tmp_path):
    report = QUERIES["fraud_by_hour"](spark, SF_DIR)
    for fmt in ("csv", "json"):
        path = str(tmp_path / fmt)
        files.write_report(report, path, fmt)
        again = files.read_report(spark, path, report.schema, fmt)
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, report.collect()))
    with pytest.raises(ValueError):
        files.write_report(report, str(tmp_path / "x"), "xml")


def test_csv_to_parquet_keeps_nulls_and_types(spark, tmp_path):
    rows = transactions(spark, SF_DIR)
    files.write_csv(rows, str(tmp_path / "csv"))
    table = files.csv_to_parquet(spark, str(tmp_path / "csv"), str(tmp_path / "parquet"), RAW_SCHEMA)
    assert table.schema == RAW_SCHEMA
    assert table.filter("profile IS NULL").count() == rows.filter("profile IS NULL").count() > 0


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    assert session.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_training_beats_chance_and_repeats(spark):
    train, test = training_parts(spark, SF_DIR)
    names = feature_names(train)

    def run():
        fitted = model.fit(model.boosted_trees(maxIter=3, maxDepth=3), train, names)
        return model.score(fitted, test, names, ("trans_num", "is_fraud"))

    first, second = run(), run()
    from riskloom.operators.evaluate import roc_auc

    assert roc_auc(first, label="is_fraud").first()["roc_auc"] > 0.8
    assert first.exceptAll(second).count() == 0


def test_draws_repeat_and_stay_in_range():
    draws = model.draw_params(20, seed=3)
    assert draws == model.draw_params(20, seed=3) != model.draw_params(20, seed=4)
    for d in draws:
        assert 0.01 <= d["stepSize"] <= 0.3 and 3 <= d["maxDepth"] <= 10
        assert d["maxIter"] in range(100, 501, 50)
        assert 0.6 <= float(d["featureSubsetStrategy"]) <= 1.0


def test_class_weights_balance_the_classes(spark):
    rows = transactions(spark, SF_DIR, ["is_fraud"])
    sums = model.add_class_weight(rows, balanced=True).groupBy("is_fraud").agg(F.sum(model.WEIGHT).alias("w"))
    a, b = [r["w"] for r in sums.collect()]
    assert a == pytest.approx(b)


def test_local_session_without_a_shared_folder_makes_its_own(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Local:
        conf, sparkContext = Conf(), spark.sparkContext

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn", "applicationId": "x"})

    assert session.scratch_root(Local) == session.scratch_root(Local)
    with pytest.raises(RuntimeError):
        session.scratch_root(Cluster)
