"""Bounded and mergeable passes: heavy hitters, stored profiles, permutation importance, footers, streams with state."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from riskloom.functions.dates import parse_hour
from riskloom.functions.numbers import flag
from riskloom.operators import encode, heavy, mergeable, permutation
from riskloom.operators.boosting import Params, fit
from riskloom.operators.ordered import value_histogram
from riskloom.plans.catalog.evaluation import auc_sql
from riskloom.plans.catalog.boosted import SEEN, POSITIVE_WEIGHT, seen_rows
from riskloom.plans.catalog.preparation import _KEY, _KEY_SQL, prepared_rows
from riskloom.plans.catalog.registry import query
from riskloom.plans.catalog.sampling import SIZE, _OUT, _rows, _sample_sql
from riskloom.plans.catalog.sqltext import hashed, oracle, r6
from riskloom.schema import LABEL, ONE_HOT, ROW_ID
from riskloom.session import scratch_path, write_table
from riskloom.sources import files
from riskloom.sources.transactions import read_table, transactions
from riskloom.streaming import incremental, jobs

# ---- heavy hitters

_HEAVY = ("merchant", "city", "street", "trans_date", "cc_num")
HEAVY_N = 15


def _counts_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST({column} AS VARCHAR) AS value, count(*) AS n FROM txn
        WHERE {column} IS NOT NULL GROUP BY ALL"""


@query(
    "heavy_values",
    oracle(
        f"""SELECT "column", value, n AS count, rank FROM (
              SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank
              FROM ({" UNION ALL ".join(map(_counts_sql, _HEAVY))})) WHERE rank <= {HEAVY_N}""",
        "txn",
    ),
)
def heavy_values(spark, sf):
    """The most frequent values of columns with few and with very many values, from bounded summaries."""
    return heavy.heavy_values(transactions(spark, sf, _HEAVY), _HEAVY, HEAVY_N, counters=64)


@query(
    "heavy_modes",
    oracle(
        f"""SELECT "column", value AS most_common, n AS most_common_count FROM ({" UNION ALL ".join(map(_counts_sql, _HEAVY))})
            QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) = 1""",
        "txn",
    ),
)
def heavy_modes(spark, sf):
    return heavy.modes(transactions(spark, sf, _HEAVY), _HEAVY)


# ---- stored profiles

_PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_partkey")
RANK_ERROR, DISTINCT_ERROR = 0.01, 0.06


@query(
    "profile_merged",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS missing, round_even(avg({c}), 3) AS mean,
              round_even(stddev_pop({c}), 3) AS std, {r6(f'min({c})')} AS min, {r6(f'max({c})')} AS max, 1 AS ranks_close,
              1 AS distinct_close, 3::BIGINT AS sources FROM lineitem"""
        for c in _PROFILED
    ),
)
def profile_merged(spark, sf):
    """lineitem in three folders, the third added after the first two were profiled: moments of the merged states, and whether the
    sketches keep their error bounds against exact counts of the whole table."""
    rows = read_table(spark, sf, "lineitem").select(*[F.col(c).cast("double").alias(c) for c in _PROFILED], "l_orderkey")
    folder, path = scratch_path(spark, "lineitem-parts"), scratch_path(spark, "profile-states")
    store = mergeable.ProfileStore(spark, path, _PROFILED, folders=True)
    for part in range(3):
        own = rows.filter(F.col("l_orderkey") % 3 == part).drop("l_orderkey")
        own.write.parquet(f"{folder}/{part}")
        if part:
            store.refresh(folder)
    found = write_table(store.profile(), "profile")
    # the exact share of values below, and up to, each about-quantile
    marks = found.select("column", F.inline(F.array(*[
        F.struct(F.lit(p).alias("p"), F.col(f"about_q{round(p * 100)}").alias("mark")) for p in (0.25, 0.5, 0.75)
    ])))
    counts = value_histogram(rows, _PROFILED)
    # twelve marks
    ranks = counts.join(F.broadcast(marks), "column").groupBy("column", "p").agg(
        F.sum(F.when(F.col("value") < F.col("mark"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("value") <= F.col("mark"), F.col("n")).otherwise(0)).alias("upto"),
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct"),
    )
    close = ranks.groupBy("column").agg(
        F.min(flag((F.col("below") <= (F.col("p") + RANK_ERROR) * F.col("n")) & (F.col("upto") >= (F.col("p") - RANK_ERROR) * F.col("n")))).alias("ranks_close"),
        F.max("distinct").alias("distinct"),
    )
    sources = store.states().select("source").distinct().agg(F.count(F.lit(1))).scalar()
    return found.join(close, "column").select(
        "column", "rows", "missing", F.round("mean", 3).alias("mean"), F.round("std", 3).alias("std"), "min", "max", "ranks_close",
        flag(F.abs(F.col("about_distinct") - F.col("distinct")) <= DISTINCT_ERROR * F.col("distinct")).alias("distinct_close"),
        sources.alias("sources"),
    )


# ---- permutation importance

_RULE = ("amt", "trans_hour")


def _rule_sql(amt: str, hour: str) -> str:
    return f"""least(CAST(1 AS DOUBLE), {amt} / CAST(500.0 AS DOUBLE) + CAST(0.3 AS DOUBLE)
        * CASE WHEN {hour} IN (22, 23, 0, 1, 2, 3) THEN 1 ELSE 0 END)"""


def _lent_sql() -> str:
    order = "PARTITION BY part ORDER BY spot, trans_num"
    return f"""SELECT *, {", ".join(f'''CASE WHEN last_row = 1 THEN first_value({c}) OVER ({order}) ELSE lead({c}) OVER ({order}) END AS {c}_lent''' for c in _RULE)}
        FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY spot DESC, trans_num DESC) AS last_row
              FROM (SELECT *, spot % (SELECT greatest(1, count(*) // {permutation.PART_ROWS}) FROM timed) AS part
                    FROM (SELECT trans_num, amt, trans_hour, is_fraud AS label, {hashed('trans_num')} AS spot FROM timed)))"""


_PERMUTED = {
    "lent": _lent_sql(),
    "own_scores": f"SELECT label, {_rule_sql('amt', 'trans_hour')} AS score FROM lent",
    "amt_scores": f"SELECT label, {_rule_sql('amt_lent', 'trans_hour')} AS score FROM lent",
    "hour_scores": f"SELECT label, {_rule_sql('amt', 'trans_hour_lent')} AS score FROM lent",
}


@query(
    "permutation_importance",
    oracle(
        f"""SELECT feature, {r6('roc_auc')} AS roc_auc, {r6(f"(SELECT roc_auc FROM ({auc_sql('own_scores')})) - roc_auc")} AS loss
            FROM (SELECT 'amt' AS feature, * FROM ({auc_sql('amt_scores')})
                  UNION ALL SELECT 'trans_hour', * FROM ({auc_sql('hour_scores')}))""",
        "timed",
        extra=_PERMUTED,
    ),
)
def permutation_importance(spark, sf):
    """Loss of ROC-AUC of the rule score when amounts or hours are dealt to other rows."""
    rows = transactions(spark, sf, [ROW_ID, LABEL, "amt", "trans_time"]).withColumn("trans_hour", parse_hour(F.col("trans_time")))

    def rule(c):
        night = F.when(c["trans_hour"].isin(22, 23, 0, 1, 2, 3), 1).otherwise(0)
        return F.least(F.lit(1.0), c["amt"] / F.lit(500.0) + F.lit(0.3) * night)

    return permutation.rule_importance(rows, rule, _RULE)


@query(
    "permutation_importance_model",
    f"""SELECT c AS feature, CASE WHEN c IN ('amt', 'trans_hour') THEN 1 ELSE 0 END AS matters
        FROM (VALUES {", ".join(f"('{c}')" for c in SEEN)}) AS t(c)""",
)
def permutation_importance_model(spark, sf):
    """The same for a boosted model: the label follows from amount and hour (and a category that the model does not see)."""
    rows = seen_rows(spark, sf)
    model = fit(rows, SEEN, Params(rounds=20, max_depth=4), ROW_ID, weight=POSITIVE_WEIGHT, max_bins=50)
    return permutation.model_importance(model, rows).select("feature", flag(F.col("loss") > 0.05).alias("matters"))


# ---- footers and encodings


@query(
    "row_count_footer",
    """SELECT count(*) AS rows, min(l_orderkey) AS min_l_orderkey, max(l_orderkey) AS max_l_orderkey,
         min(l_linenumber)::BIGINT AS min_l_linenumber, max(l_linenumber)::BIGINT AS max_l_linenumber FROM lineitem""",
)
def row_count_footer(spark, sf):
    """Rows and bounds from Parquet footers, without reading a data page."""
    return files.footer_facts(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_linenumber"])


@query(
    "onehot_vectors_encode",
    oracle(
        "SELECT trans_num, "
        + ", ".join(
            f"""(SELECT CAST(count(DISTINCT coalesce(o.{c}, 'unknown')) AS BIGINT) FROM prepared o) AS {c}_size,
                dense_rank() OVER (ORDER BY coalesce({c}, 'unknown')) - 1 AS {c}_place"""
            for c in ONE_HOT
        )
        + " FROM prepared",
        "prepared",
    ),
)
def onehot_vectors_encode(spark, sf):
    """A sparse vector per column, whatever the number of values: its length, and the place of its 1."""
    rows = write_table(prepared_rows(spark, sf, ONE_HOT).select(ROW_ID, *ONE_HOT), "prepared")
    coded = encode.onehot_vectors(rows, encode.fit_labels(rows, ONE_HOT))
    lists = {c: vector_to_array(F.col(f"{c}_onehot")) for c in ONE_HOT}
    return coded.select(
        ROW_ID, *[x for c, v in lists.items() for x in (F.size(v).cast("long").alias(f"{c}_size"), (F.array_position(v, 1.0) - 1).alias(f"{c}_place"))]
    )


# ---- streams


def _in_files(spark, rows: DataFrame, parts: int) -> str:
    """``rows`` in the order of their id, written one after the other into files that a stream takes one by one."""
    folder = scratch_path(spark, "stream-files")
    stored = write_table(rows, "stream-rows")
    low, high = stored.agg(F.min(ROW_ID), F.max(ROW_ID)).first()
    step = (high - low) // parts + 1
    for n in range(parts):
        own = stored.filter(F.col(ROW_ID).between(low + n * step, low + (n + 1) * step - 1))
        own.coalesce(1).write.mode("append").parquet(folder)
    return folder


@query(
    "stream_keep_first",
    oracle(
        f"""SELECT trans_num, cc_num, {r6('amt')} AS amt, merchant, trans_date, trans_time
            FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY_SQL} ORDER BY trans_num) AS rn FROM txn)
            WHERE rn = 1""",
        "txn",
    ),
)
def stream_keep_first(spark, sf):
    """First occurrences over a stream of files, with the seen keys as state."""
    rows = transactions(spark, sf, [*_KEY, "unix_time"])
    stream = jobs.file_stream(spark, _in_files(spark, rows, 4), rows.schema, files_per_batch=1)
    target = scratch_path(spark, "keep-first")
    incremental.run_keep_first(stream, target, scratch_path(spark, "keep-first-state"))
    return incremental.kept_rows(spark, target).drop("unix_time")


@query("stream_stratified_sample", oracle(_sample_sql(42), "txn"))
def stream_stratified_sample(spark, sf):
    """The stratified sample of the batch job, kept up to date over a stream of files."""
    rows = _rows(spark, sf)
    stream = jobs.file_stream(spark, _in_files(spark, rows, 4), rows.schema, files_per_batch=1)
    target = scratch_path(spark, "sample")
    incremental.run_sample(stream, target, scratch_path(spark, "sample-state"), SIZE)
    return incremental.current_sample(spark, target, SIZE)
