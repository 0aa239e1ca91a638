"""Plan shapes that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from riskloom.operators import cleanse, evaluate, ordered, prepare, risk, sampling
from riskloom.plans.catalog import QUERIES
from riskloom.sources.transactions import transactions

SF_DIR = "/root/testdata/sf0.001"


def physical(df):
    text = df._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan ==") :]


# Model training, checked by its results, makes jobs of minutes.
_TRAINED = ("train_", "tune_", "model_", "score_rows", "selected_model")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(_TRAINED)])
def test_no_cross_join_and_no_python(spark, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert word not in plan


def test_quantiles_shuffle_bins_and_not_values(spark):
    rows = spark.range(200_000).select(F.sin("id").alias("x"))
    found = ordered.quantiles(rows, ["x"], [0.5])
    found.collect()
    moved = [int(n) for n in re.findall(r"rowCount=(\d+)", found._jdf.queryExecution().executedPlan().toString())]
    assert all(n < 20_000 for n in moved)
    exchanges = [x for x in physical(found).splitlines() if "hashpartitioning" in x and "value" in x]
    assert all("_b2" in x for x in exchanges)


def test_unneeded_joins_and_columns_are_pruned(spark):
    plan = physical(risk.fraud_by_hour(prepare.add_hour(transactions(spark, SF_DIR, ["trans_time", "is_fraud"]))))
    assert "customer.parquet" not in plan and "Join" not in plan
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>", plan)


def test_row_count_reads_no_column(spark):
    plan = physical(QUERIES["row_count"](spark, SF_DIR))
    assert "ReadSchema: struct<>" in plan


def test_sample_does_not_shuffle_the_wide_rows(spark):
    rows = transactions(spark, SF_DIR, ["trans_num", "is_fraud", "merchant", "amt"])
    plan = physical(sampling.stratified_sample(rows, 100))
    # the outer branch is scan, broadcast join, filter; every exchange below it is in the cut
    top = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in top and "Sort " not in top


def test_duplicates_do_not_shuffle_the_wide_rows(spark):
    rows = transactions(spark, SF_DIR, ["trans_num", "cc_num", "amt", "merchant", "trans_date", "trans_time"])
    plan = physical(cleanse.drop_duplicates_keep_first(rows))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_top_values_are_pruned_before_the_shuffle(spark):
    rows = transactions(spark, SF_DIR, ["merchant"])
    plan = physical(prepare.top_values(rows, ["merchant"], 5))
    assert plan.count("WindowGroupLimit") == 2


def test_windows_over_scores_run_inside_bins(spark):
    rows = spark.range(100).selectExpr("cast(id % 2 AS int) AS label", "id / 100D AS score")
    plan = physical(evaluate.roc_auc(rows))
    inner = [line for line in plan.splitlines() if "Window" in line and "_score" in line]
    assert inner and all("_b1" in line and "_b2" in line for line in inner)


def test_quantiles_collapse_equal_values_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 3).cast("double").alias("x"))
    plan = physical(ordered.value_histogram(rows, ["x"]))
    assert "partial_sum" in plan
