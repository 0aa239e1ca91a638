import pytest
from pyspark.sql import functions as F
from riskloom.operators import boosting, model, search
from riskloom.plans import flows
from riskloom.plans.catalog import learning

SF = "/root/testdata/sf0.001"


def test_search_draws_as_many_as_stated():
    assert learning.TRIALS == 50


def test_final_model_no_better_than_chance_is_reported(spark, monkeypatch):
    train, _ = learning.training_parts(spark, SF)
    names = tuple(learning.feature_names(train))
    flat = boosting.Booster(boosting.Bins(names, ((),) * len(names)), [], boosting.Params())
    monkeypatch.setattr(learning, "final_model", lambda spark, sf: flat)
    row = learning.train_final(spark, SF).first()
    assert row.ranks_well == 0 and row.test_rows > 0


def test_study_grows_all_rounds_that_were_drawn(spark, tmp_path, monkeypatch):
    """Draws and the final fit were cut at 12 and at 60 rounds, and most draws dropped after 3 or 6."""
    rows = spark.range(0, 600, 1, 1).selectExpr(
        "id AS trans_num", "cast(pmod(hash(id), 10) < id % 5 AS int) AS is_fraud", "id % 5 AS a", "id % 37 AS b", "'train' AS split"
    )
    monkeypatch.setattr(learning, "training_parts", lambda spark, sf: (rows, None))
    monkeypatch.setattr(learning, "TRIALS", 3)
    monkeypatch.setitem(search.SPACE, "rounds", search.Range(65, 75, step=5))
    study = learning.trial_table(spark, str(tmp_path)).collect()
    assert len(study) == 3 and all(r.ended == "rounds" and r.rounds_used == r.params_rounds for r in study)
    final = learning.final_model(spark, str(tmp_path))
    assert len(final.history) == final.params.rounds >= 65
    checks = learning.tune_trials(spark, str(tmp_path)).collect()
    assert all((r.scored, r.in_range, r.within_rung) == (1, 1, 1) for r in checks)


def test_ranges_are_those_of_the_search():
    assert set(search.SPACE) == {
        "learning_rate", "max_depth", "rounds", "min_child_weight", "subsample", "colsample", "gamma", "reg_alpha", "reg_lambda",
    }
    assert search.SPACE["rounds"].from_unit(0.999) == 500 and search.SPACE["max_depth"].from_unit(0.0) == 3
    assert search.SPACE["learning_rate"].from_unit(0.5) == pytest.approx((0.01 * 0.3) ** 0.5)


def test_training_text_is_cleaned_on_all_cores(spark, tmp_path, monkeypatch):
    """A small events file is one partition; the table that is cleaned from it must not be."""
    ids = spark.range(0, 400, 1, 1)
    ids.select(
        F.col("id").alias("event_id"), F.expr("cast('2024-01-01 00:00:00' as timestamp_ntz) + make_interval(0, 0, 0, 0, cast(id as int))").alias("ts"),
        (F.col("id") % 30).alias("user_id"), F.expr("if(id % 3 = 0, 'error', 'buy')").alias("event_type"), F.expr("cast(id as double)").alias("value"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    people = spark.range(0, 30, 1, 1).selectExpr("id AS c_custkey", "cast(id % 5 AS int) AS c_nationkey", "'M' AS c_mktsegment")
    people.write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(0, 5, 1, 1).selectExpr("cast(id AS int) AS n_nationkey", "concat('N', id) AS n_name").write.parquet(f"{tmp_path}/nation.parquet")
    files = {}

    def write_table(df, name, write=flows.write_table):
        table = write(df, name)
        files[name] = len(table.inputFiles())
        return table

    monkeypatch.setattr(flows, "write_table", write_table)
    rows = learning.training_table(spark, str(tmp_path))
    assert files["cleaned"] == spark.sparkContext.defaultParallelism
    # event 0 comes twice, as all events whose number 200 divides; copies and illegal places are dropped again
    assert rows.count() == rows.select("trans_num").distinct().count() == 399


def test_forest_keeps_node_ids_and_grows_the_same_trees(spark, monkeypatch):
    rows = spark.range(0, 3000, 1, 1).selectExpr("id % 17 AS a", "id % 101 AS b", "cast(id % 17 + id % 101 > 60 AS int) AS is_fraud")
    build = lambda: model.random_forest(numTrees=5, maxDepth=8, minInstancesPerNode=5)
    kept = model.fit(build(), rows, ["a", "b"], balanced=True).stages[-1]
    monkeypatch.setattr(model, "NODE_IDS", 0)
    walked = model.fit(build(), rows, ["a", "b"], balanced=True).stages[-1]
    assert kept.getCacheNodeIds() and not walked.getCacheNodeIds()
    assert kept.toDebugString.split("\n", 1)[1] == walked.toDebugString.split("\n", 1)[1]
