"""Model training, tuning, scoring and storage, and the streaming jobs.

Models are trained at their stated sizes on the encoded features of the whole flow. The training table and the
fitted models are artefacts: each is made once per session and data folder, stored below the shared folder, and
read by all queries that need it. SQL checks what does not depend on the trees: rows, positives, sums and flags.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from riskloom.functions.numbers import flag
from riskloom.operators import boosting, evaluate, importance, model, sampling, search, validate
from riskloom.plans import flows
from riskloom.plans.catalog import preparation  # noqa: F401  the feature table's SQL
from riskloom.plans.catalog.registry import ORACLES, query
from riskloom.plans.catalog.sqltext import (
    DATE_PARTS, HOUR, TIME_FEATURES, TOP_N, VALID_POINTS, hashed, oracle, r6, rate,
)
from riskloom.schema import LABEL, ROW_ID
from riskloom.session import artefact, scratch_path, spread
from riskloom.sources.transactions import derive, read_table
from riskloom.streaming import jobs

# Draws of the search. Each, and the final fit, is grown for all rounds that were drawn. See the README for their time.
TRIALS = 50
# A model that ranks worse than this on rows it has not seen has gone wrong.
GOOD_AUC = 0.95
SELECTED = 30

def training_table(spark, sf) -> DataFrame:
    """Encoded feature rows with their train or test mark. Events are dealt to all cores, for a small file is one or two
    partitions, and the text of all rows would be cleaned in as many tasks."""
    def make(path):
        events = read_table(spark, sf, "events")
        raw = derive(spread(events, events.count()), read_table(spark, sf, "customer"), read_table(spark, sf, "nation"))
        rows = flows.feature_table(raw, TOP_N, keep=[ROW_ID])
        sampling.stratified_split(rows).write.parquet(path)

    return spark.read.parquet(artefact(spark, sf, "training", make))


def feature_names(table: DataFrame) -> list[str]:
    return [f.name for f in table.schema if isinstance(f.dataType, NumericType) and f.name not in (ROW_ID, LABEL)]


def training_parts(spark, sf):
    table = training_table(spark, sf)
    return tuple(table.filter(F.col("split") == part) for part in ("train", "test"))


_CLASSIFIERS = {
    "random_forest": (model.random_forest, True),
    "gbt": (model.boosted_trees, False),
    "gbt_shallow": (model.shallow_boosted_trees, False),
}


def fitted_model(spark, sf, name: str) -> PipelineModel:
    """A model of the stated size, trained once and then loaded."""
    def make(path):
        train, _ = training_parts(spark, sf)
        build, balanced = _CLASSIFIERS[name]
        model.save_model(model.fit(build(), train, feature_names(train), balanced=balanced), path)

    return model.load_model(artefact(spark, sf, f"model-{name}", make))


def _report(scored: DataFrame, name: str) -> DataFrame:
    """Rows, positives and whether the ranking is good, from scores."""
    metrics = evaluate.metrics_table(scored, label=LABEL)
    return metrics.select(
        F.lit(name).alias("model_name"),
        F.expr("tn + fp + fn + tp").alias("test_rows"),
        F.expr("fn + tp").alias("test_fraud"),
        flag(F.col("roc_auc") > GOOD_AUC).alias("ranks_well"),
    )


def _with_features(body: str) -> str:
    """``f``: feature rows with their place in the hash order of their class, and ``k``, the test rows of the class."""
    return f"""WITH t AS ({ORACLES['feature_table']}), f AS (
        SELECT trans_num, is_fraud,
          row_number() OVER (PARTITION BY is_fraud ORDER BY {hashed('trans_num')}, trans_num) AS place,
          round(CAST(0.2 AS DOUBLE) * count(*) OVER (PARTITION BY is_fraud)) AS k
        FROM t) {body}"""


def _report_sql(name: str) -> str:
    return _with_features(
        f"""SELECT '{name}' AS model_name, count(*) AS test_rows, CAST(sum(is_fraud) AS BIGINT) AS test_fraud,
              1 AS ranks_well FROM f WHERE place <= k"""
    )


def _test_report(spark, sf, name):
    _, test = training_parts(spark, sf)
    return _report(model.score(fitted_model(spark, sf, name), test, feature_names(test)), name)


@query("train_random_forest", _report_sql("random_forest"))
def train_random_forest(spark, sf):
    """100 trees of depth 20."""
    return _test_report(spark, sf, "random_forest")


@query("train_gbt", _report_sql("gbt"))
def train_gbt(spark, sf):
    """100 rounds of depth 6."""
    return _test_report(spark, sf, "gbt")


@query("train_gbt_shallow", _report_sql("gbt_shallow"))
def train_gbt_shallow(spark, sf):
    """100 rounds of depth 5."""
    return _test_report(spark, sf, "gbt_shallow")


def study_path(spark, sf) -> str:
    """The stored search over the full ranges and the model fitted with its best draw: ``trials`` and ``final``. No draw is
    dropped and none ends before its own rounds, of which the best one by validation AUC counts."""
    def make(path):
        train, _ = training_parts(spark, sf)
        inner = sampling.stratified_split(train.drop("split"), seed=43, names=("train", "validation"))
        parts = [inner.filter(F.col("split") == p) for p in ("train", "validation")]
        study = search.tune(*parts, feature_names(train), ROW_ID, trials=TRIALS, rungs=(), patience=0)
        study.table(spark).write.parquet(f"{path}/trials")
        boosting.save(search.fit_best(study, patience=0), spark, f"{path}/final")

    return artefact(spark, sf, "study", make)


def trial_table(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{study_path(spark, sf)}/trials")


def final_model(spark, sf) -> boosting.Booster:
    return boosting.load(spark, f"{study_path(spark, sf)}/final")


@query(
    "tune_trials",
    f"""SELECT CAST(i AS BIGINT) AS number, 1 AS scored, 1 AS in_range, 1 AS within_rung, CAST(i >= 20 AS INT) AS guided
        FROM (SELECT unnest(range({TRIALS})) AS i)""",
)
def tune_trials(spark, sf):
    """Each draw: whether it has a value, its parameters are in range, and it ended with its own rounds or where no later tree would split."""
    table = trial_table(spark, sf)
    inside = " AND ".join(f"params_{k} BETWEEN {r.low} AND {r.high}" for k, r in search.SPACE.items())
    ends = "ended = 'rounds' AND rounds_used = params_rounds OR ended = 'root' AND rounds_used BETWEEN 1 AND params_rounds"
    steps = importance.running_best(table.select("number", "value")).join(table.drop("value"), "number")
    return steps.select(
        "number", flag(F.col("best_so_far") >= F.col("value")).alias("scored"), flag(F.expr(inside)).alias("in_range"),
        flag(F.expr(ends)).alias("within_rung"), F.col("guided").cast("int").alias("guided"),
    )


@query("train_final", _report_sql("final"))
def train_final(spark, sf):
    """The best draw of the search, fitted for all its own rounds and kept up to the one with the best validation AUC."""
    _, test = training_parts(spark, sf)
    return _report(boosting.score(final_model(spark, sf), test), "final")


def _ranked(spark, sf) -> DataFrame:
    names = feature_names(training_table(spark, sf))
    tall = [model.importances(fitted_model(spark, sf, m), names, m) for m in ("random_forest", "gbt")]
    return importance.rank_importance(tall[0].unionByName(tall[1]), ["random_forest", "gbt"])


@query(
    "model_importance",
    """SELECT 100::DOUBLE AS random_forest, 100::DOUBLE AS gbt, 100::DOUBLE AS average, 1 AS ranks_complete""",
)
def model_importance(spark, sf):
    """Impurity importances of two full models, in percent, averaged and ranked: their sums."""
    ranked = _ranked(spark, sf)
    sums = [F.sum(c).alias(c) for c in ("random_forest", "gbt", "average")]
    return ranked.agg(*sums, flag(F.max("rank") == F.count(F.lit(1))).alias("ranks_complete"))


@query(
    "score_rows",
    _with_features("SELECT trans_num, CAST(is_fraud AS BIGINT) AS is_fraud, 1 AS in_range FROM f WHERE place <= k"),
)
def score_rows(spark, sf):
    _, test = training_parts(spark, sf)
    scored = model.score(fitted_model(spark, sf, "gbt"), test, feature_names(test), keep=(ROW_ID, LABEL))
    return scored.select(ROW_ID, LABEL, flag(F.col("score").between(0, 1)).alias("in_range"))


@query(
    "model_roundtrip",
    _with_features(
        f"""SELECT count(*) AS "rows", 0::BIGINT AS changed, 0::BIGINT AS final_changed, {TRIALS}::BIGINT AS trials, 1 AS best_kept
            FROM f WHERE place <= k"""
    ),
)
def model_roundtrip(spark, sf):
    """Models, best parameters, results and trials, stored and read again: scores that changed, and what came back."""
    _, test = training_parts(spark, sf)
    names, keep = feature_names(test), (ROW_ID,)
    table, last = trial_table(spark, sf), final_model(spark, sf)
    fitted = fitted_model(spark, sf, "random_forest")
    path = scratch_path(spark, "study")
    model.save_model(fitted, f"{path}/model")
    boosting.save(last, spark, f"{path}/final")
    table.write.parquet(f"{path}/trials")
    model.score(fitted, test, names, keep).write.parquet(f"{path}/results")
    boosting.score(last, test, keep).write.parquet(f"{path}/final-results")
    again = boosting.load(spark, f"{path}/final")

    def changed(results: str, after: DataFrame) -> DataFrame:
        both = spark.read.parquet(f"{path}/{results}").join(after.select(ROW_ID, F.col("score").alias("_again")), ROW_ID)
        return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("score") != F.col("_again")).alias("changed"))

    forest = changed("results", model.score(model.load_model(f"{path}/model"), test, names, keep))
    boosted = changed("final-results", boosting.score(again, test, keep))
    trials = spark.read.parquet(f"{path}/trials").agg(F.count(F.lit(1))).scalar()
    return forest.select(
        "*", boosted.select("changed").scalar().alias("final_changed"), trials.alias("trials"), F.lit(int(again == last)).alias("best_kept")
    )


@query(
    "selected_model_unseen",
    _with_features(
        f"""SELECT 'selected' AS model_name, count(*) AS test_rows, CAST(sum(is_fraud) AS BIGINT) AS test_fraud,
              1 AS ranks_well, {SELECTED}::BIGINT AS n_features, (SELECT count(*) FROM t) AS stored_rows
            FROM f WHERE place > k"""
    ),
)
def selected_model_unseen(spark, sf):
    """Importance, the best features, their stored table, a model trained on one part and scored on unseen rows.

    The model learns from the smaller part; the unseen rows are all others, found by an anti join on the row id.
    """
    ranked = _ranked(spark, sf)
    names = [r["feature"] for r in importance.select_top(ranked, SELECTED).orderBy("rank").collect()]
    path = scratch_path(spark, "selected")
    importance.select_features(training_table(spark, sf), [ROW_ID, "split", *names], LABEL).write.parquet(path)
    rows = spark.read.parquet(path)
    seen = rows.filter("split = 'test'")
    fitted = model.fit(model.random_forest(), seen, names, balanced=True)
    report = _report(model.score(fitted, validate.unseen_rows(rows, seen), names), "selected")
    stored = rows.agg(F.count(F.lit(1))).scalar()
    return report.select("*", F.lit(len(names)).cast("long").alias("n_features"), stored.alias("stored_rows"))


# ---- streams


def transaction_stream(spark, sf, columns=None):
    """The events file as a stream, joined with the customer and nation tables."""
    events = read_table(spark, sf, "events")
    stream = jobs.file_stream(spark, sf, events.schema, "events.parquet")
    return derive(
        stream, read_table(spark, sf, "customer"), read_table(spark, sf, "nation"), columns
    )


_PREPARED_OUT = ", ".join(
    [
        "trans_num, gender, city, state, zip, city_pop, job, profile, category, merchant, trans_year, "
        "trans_month, trans_day, trans_weekday, trans_hour, day_of_month",
        *[f"{r6(c)} AS {c}" for c in ("lat", "long", "amt", "hour_sin", "hour_cos")],
        *[
            f"CAST({c} AS BIGINT) AS {c}"
            for c in ("is_fraud", "is_night", "is_weekend", "is_business_hours")
        ],
    ]
)


@query(
    "stream_prepare",
    oracle(
        f"""SELECT {_PREPARED_OUT} FROM (SELECT *, {TIME_FEATURES} FROM (
              SELECT *, {DATE_PARTS}, {HOUR} AS trans_hour
              FROM (SELECT *, CAST(trans_date AS DATE) AS d FROM clean) WHERE {VALID_POINTS}))""",
        "clean",
    ),
)
def stream_prepare(spark, sf):
    return jobs.stream_prepare(spark, transaction_stream(spark, sf))


@query(
    "stream_fraud_by_hour",
    oracle(
        f"""SELECT h AS hour, count(*) FILTER (WHERE is_fraud = 1) AS fraud_count,
              count(is_fraud) AS total_count,
              {rate('count(*) FILTER (WHERE is_fraud = 1)', 'count(is_fraud)')} AS fraud_rate
            FROM (SELECT unnest(range(24)) AS h) LEFT JOIN timed ON trans_hour = h GROUP BY h""",
        "timed",
    ),
)
def stream_fraud_by_hour(spark, sf):
    return jobs.stream_fraud_by_hour(
        spark, transaction_stream(spark, sf, ["trans_time", "is_fraud"])
    )


@query(
    "stream_fraud_by_category",
    oracle(
        f"""SELECT category, count(*) FILTER (WHERE is_fraud = 1) AS fraud_count,
              count(is_fraud) AS total_count,
              {rate('count(*) FILTER (WHERE is_fraud = 1)', 'count(is_fraud)')} AS fraud_rate
            FROM txn GROUP BY category""",
        "txn",
    ),
)
def stream_fraud_by_category(spark, sf):
    return jobs.stream_fraud_by_category(
        spark, transaction_stream(spark, sf, ["category", "is_fraud"])
    )
