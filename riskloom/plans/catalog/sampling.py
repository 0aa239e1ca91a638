"""Samples, splits and set work by row id."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import sampling, validate
from riskloom.plans.catalog.preparation import feature_rows
from riskloom.plans.catalog.registry import query
from riskloom.plans.catalog.sqltext import hashed, oracle, r6, ratio
from riskloom.session import write_table
from riskloom.sources.transactions import transactions

_ROW = ["trans_num", "is_fraud"]
_OUT = "trans_num, CAST(is_fraud AS BIGINT) AS is_fraud"
SIZE = 2000


def _rows(spark, sf):
    return transactions(spark, sf, _ROW)


def _plan_sql(size: int) -> str:
    return f"""SELECT *, CAST(floor({size} * ratio) AS BIGINT) AS target_fraud,
      {size} - CAST(floor({size} * ratio) AS BIGINT) AS target_legit
      FROM (SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_fraud = 1) AS total_fraud,
              count(*) FILTER (WHERE is_fraud = 0) AS total_legit,
              {ratio('count(*) FILTER (WHERE is_fraud = 1)', 'count(*)')} AS ratio FROM txn)"""


def _ranked_sql(seed: int, source: str = "txn") -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY is_fraud
      ORDER BY {hashed('trans_num', seed)}, trans_num) AS rn,
      count(*) OVER (PARTITION BY is_fraud) AS class_rows FROM {source}"""


def _sample_sql(seed: int, size: int = SIZE) -> str:
    return f"""SELECT {_OUT} FROM ({_ranked_sql(seed)}), ({_plan_sql(size)})
      WHERE rn <= CASE WHEN is_fraud = 1 THEN target_fraud ELSE target_legit END"""


@query(
    "sample_plan",
    oracle(
        f"""SELECT total_rows, total_fraud, total_legit, {r6('ratio')} AS fraud_ratio, target_fraud,
              target_legit, {r6(ratio('target_fraud', 'total_fraud'))} AS fraud_rate,
              {r6(ratio('target_legit', 'total_legit'))} AS legit_rate FROM ({_plan_sql(SIZE)})""",
        "txn",
    ),
)
def sample_plan(spark, sf):
    return sampling.sample_plan(_rows(spark, sf), SIZE)


@query("stratified_sample", oracle(_sample_sql(42), "txn"))
def stratified_sample(spark, sf):
    return sampling.stratified_sample(_rows(spark, sf), SIZE)


@query(
    "stratified_cap",
    oracle(
        f"""SELECT {_OUT} FROM ({_ranked_sql(42)}), ({_plan_sql(5 * SIZE)})
            WHERE total_rows <= {5 * SIZE}
               OR rn <= CASE WHEN is_fraud = 1 THEN target_fraud ELSE target_legit END""",
        "txn",
    ),
)
def stratified_cap(spark, sf):
    return sampling.stratified_cap(_rows(spark, sf), 5 * SIZE)


@query(
    "sample_by",
    oracle(
        f"""SELECT {_OUT} FROM txn WHERE
            (is_fraud = 0 AND {hashed('trans_num')} < {int(0.1 * 4294967296)})
            OR (is_fraud = 1 AND {hashed('trans_num')} < {int(0.5 * 4294967296)})""",
        "txn",
    ),
)
def sample_by(spark, sf):
    return sampling.sample_by(_rows(spark, sf), {0: 0.1, 1: 0.5})


@query(
    "sample_check",
    oracle(
        f"""SELECT count(*) AS rows, CAST(sum(is_fraud) AS BIGINT) AS fraud, {r6('avg(is_fraud)')} AS sample_rate,
              {r6('max(o)')} AS original_rate, {r6('abs(avg(is_fraud) - max(o))')} AS rate_diff
            FROM ({_sample_sql(42)}), (SELECT avg(is_fraud) AS o FROM txn)""",
        "txn",
    ),
)
def sample_check(spark, sf):
    rows = _rows(spark, sf)
    return sampling.sample_check(rows, sampling.stratified_sample(rows, SIZE))


@query(
    "sample_semi_join",
    oracle(
        f"""SELECT trans_num, cc_num, {r6('amt')} AS amt, category FROM txn
            WHERE trans_num IN (SELECT trans_num FROM ({_sample_sql(42)}))""",
        "txn",
    ),
)
def sample_semi_join(spark, sf):
    full = transactions(spark, sf, ["trans_num", "cc_num", "amt", "category"])
    sample = sampling.stratified_sample(_rows(spark, sf), SIZE)
    return sampling.rows_in_sample(full, sample)


@query(
    "stratified_union",
    oracle(
        f"""SELECT trans_num, count(*) AS strata FROM (
              SELECT trans_num FROM ({_sample_sql(42)}) UNION SELECT trans_num FROM ({_sample_sql(43)}))
            GROUP BY trans_num""",
        "txn",
    ),
)
def stratified_union(spark, sf):
    """Two samples, each put together from its strata, then their distinct ids."""
    def drawn(seed):
        sample = sampling.stratified_sample(_rows(spark, sf), SIZE, seed=seed)
        return sampling.union_strata(
            sample.filter(F.col("is_fraud") == 1), sample.filter(F.col("is_fraud") == 0)
        )

    ids = sampling.union_ids(drawn(42), drawn(43))
    return ids.groupBy("trans_num").agg(F.count(F.lit(1)).alias("strata"))


def split_sql(seed: int = 42, source: str = "txn", names=("train", "test")) -> str:
    return f"""SELECT * EXCLUDE (rn, class_rows),
      CASE WHEN rn <= CAST(round(class_rows * CAST(0.2 AS DOUBLE)) AS BIGINT)
           THEN '{names[1]}' ELSE '{names[0]}' END AS split FROM ({_ranked_sql(seed, source)})"""


@query("stratified_split", oracle(f"SELECT {_OUT}, split FROM ({split_sql()})", "txn"))
def stratified_split(spark, sf):
    return sampling.stratified_split(_rows(spark, sf))


@query(
    "split_check",
    oracle(
        f"""SELECT split, count(*) AS rows, CAST(sum(is_fraud) AS BIGINT) AS fraud,
              {r6('avg(is_fraud)')} AS fraud_rate,
              CAST(CASE WHEN max(avg(is_fraud)) OVER () - min(avg(is_fraud)) OVER () <= 0.001
                   THEN 1 ELSE 0 END AS BIGINT) AS rates_match
            FROM ({split_sql()}) GROUP BY split""",
        "txn",
    ),
)
def split_check(spark, sf):
    return sampling.split_check(sampling.stratified_split(_rows(spark, sf)))


@query(
    "split_validation",
    oracle(
        f"""SELECT {_OUT}, split FROM ({split_sql(43, "train_rows", ("train", "validation"))})""",
        "txn",
        extra={"train_rows": f"SELECT * EXCLUDE (split) FROM ({split_sql()}) WHERE split = 'train'"},
    ),
)
def split_validation(spark, sf):
    """The train part of the first split, split again into train and validation."""
    first = sampling.stratified_split(_rows(spark, sf))
    train = first.filter(F.col("split") == "train").drop("split")
    return sampling.stratified_split(train, seed=43, names=("train", "validation"))


@query(
    "shuffle_rows",
    oracle(f"SELECT {_OUT} FROM txn ORDER BY {hashed('trans_num')}, trans_num", "txn"),
)
def shuffle_rows(spark, sf):
    return sampling.shuffle_rows(_rows(spark, sf))


_LOOKALIKE = ("amt", "amt_zscore", "hour_cos", "amt_per_age", "amt_log")


@query(
    "unseen_rows",
    oracle(
        f"""SELECT {_OUT} FROM feats AS f WHERE NOT EXISTS (
              SELECT 1 FROM train_rows AS t WHERE
              {" AND ".join(f"t.{c} IS NOT DISTINCT FROM f.{c}" for c in _LOOKALIKE)})""",
        "feats",
        extra={"train_rows": f"SELECT * FROM ({split_sql(42, 'feats')}) WHERE split = 'train'"},
    ),
)
def unseen_rows(spark, sf):
    """Rows without a look-alike in the training part, by the five strongest features."""
    rows = write_table(
        feature_rows(spark, sf).select("trans_num", "is_fraud", *_LOOKALIKE), "selected"
    )
    split = sampling.stratified_split(rows)
    train = split.filter(F.col("split") == "train")
    return validate.unseen_rows(rows, train, _LOOKALIKE).select("trans_num", "is_fraud")


@query(
    "unseen_rows_by_id",
    oracle(
        f"""SELECT {_OUT} FROM txn WHERE trans_num NOT IN (
              SELECT trans_num FROM ({split_sql()}) WHERE split = 'train')""",
        "txn",
    ),
)
def unseen_rows_by_id(spark, sf):
    rows = _rows(spark, sf)
    train = sampling.stratified_split(rows).filter(F.col("split") == "train")
    return validate.unseen_rows(rows, train)
