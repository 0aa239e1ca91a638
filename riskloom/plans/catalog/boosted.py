"""Boosted trees whose splits and leaf values SQL recomputes, and the guided search on a known surface."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.dates import parse_hour
from riskloom.functions.numbers import flag, sample_hash
from riskloom.operators import boosting, evaluate, search, validate
from riskloom.operators.boosting import Params
from riskloom.plans.catalog.evaluation import _PAIRED as PAIRED_SQL, _metric_row_sql as metric_row_sql
from riskloom.plans.catalog.registry import query
from riskloom.plans.catalog.sqltext import hashed, oracle, r6
from riskloom.schema import LABEL, ROW_ID
from riskloom.sources.transactions import transactions

#: Columns of the transactions that the trees see: two of them with nulls.
SEEN = ("amt", "trans_hour", "lat", "long", "city_pop")
BINS = 16
POSITIVE_WEIGHT = 4.0
DEEP = Params(rounds=2, max_depth=3, reg_alpha=0.5, gamma=0.25, min_child_weight=2.0)
_PLACE_SQL = f"({hashed('trans_num')} % 5)"
LEAFY = Params(rounds=1, max_depth=0, max_leaves=31, leafwise=True, reg_lambda=0.5)


def seen_rows(spark, sf) -> DataFrame:
    rows = transactions(spark, sf, [ROW_ID, LABEL, "trans_time", *(c for c in SEEN if c != "trans_hour")])
    return rows.withColumn("trans_hour", parse_hour(F.col("trans_time"))).drop("trans_time")


def _grown(spark, sf, params: Params) -> DataFrame:
    model = boosting.fit(seen_rows(spark, sf), SEEN, params, ROW_ID, weight=POSITIVE_WEIGHT, max_bins=BINS)
    return boosting.nodes_table(model, spark)


# ---- the same in SQL, step by step


def _score(g: str, h: str, p: Params) -> str:
    shrunk = f"greatest(abs({g}) - {p.reg_alpha}::DOUBLE, 0::DOUBLE)"
    return f"({shrunk} * {shrunk} / ({h} + {p.reg_lambda}::DOUBLE))"


def _codes(source: str = "timed") -> str:
    """Edges at quantiles of ``source`` and, for each row and feature, the number of its bin, 0 for null."""
    edges = " UNION ALL ".join(
        f"""SELECT {j} AS f, list_sort(list_distinct([v[1 + (i * (len(v) - 1)) // {BINS} ] FOR i IN range({BINS + 1})
              IF v[1 + (i * (len(v) - 1)) // {BINS}] < v[len(v)]])) AS e
            FROM (SELECT list(CAST({c} AS DOUBLE) ORDER BY {c}) FILTER ({c} IS NOT NULL) AS v FROM {source})"""
        for j, c in enumerate(SEEN)
    )
    tall = " UNION ALL ".join(f"SELECT trans_num, {j} AS f, CAST({c} AS DOUBLE) AS x FROM timed" for j, c in enumerate(SEEN))
    return f"""edges AS MATERIALIZED ({edges}),
        codes AS MATERIALIZED (
          SELECT trans_num, f, CASE WHEN x IS NULL THEN 0 ELSE 1 + len([v FOR v IN e IF v < x]) END AS code
          FROM ({tall}) JOIN edges USING (f))"""


def _gradients(name: str, margins: str) -> str:
    """(trans_num, g, h) in whole units of 2^-30, from (trans_num, is_fraud, m)."""
    w = f"CASE WHEN is_fraud = 1 THEN {POSITIVE_WEIGHT}::DOUBLE ELSE 1::DOUBLE END * 1073741824::DOUBLE"
    return f"""{name} AS MATERIALIZED (
          SELECT trans_num, CAST(round_even((p - is_fraud) * ({w}), 0) AS BIGINT) AS g,
            CAST(round_even(p * (1 - p) * ({w}), 0) AS BIGINT) AS h
          FROM (SELECT trans_num, is_fraud, 1 / (1 + exp(-m)) AS p FROM ({margins})))"""


def _best(name: str, rows: str, grads: str, p: Params) -> str:
    """The best split of each node of ``rows`` (trans_num, node), where there is one."""
    unit = "/ 1073741824::DOUBLE"
    limit = max(p.gamma, boosting.LEAST_GAIN)
    return f"""{name}_hist AS MATERIALIZED (
          SELECT node, f, code, sum(g)::HUGEINT AS g, sum(h)::HUGEINT AS h FROM {rows} JOIN {grads} USING (trans_num) JOIN codes USING (trans_num)
          GROUP BY ALL),
        {name}_cuts AS (
          SELECT node, f, cut, side,
            sum(g) FILTER (code BETWEEN 1 AND cut OR (code = 0 AND side = 1)) AS gl,
            sum(h) FILTER (code BETWEEN 1 AND cut OR (code = 0 AND side = 1)) AS hl, sum(g) AS gt, sum(h) AS ht
          FROM {name}_hist JOIN (SELECT f, unnest(range(1, len(e) + 1)) AS cut FROM edges) USING (f), (VALUES (0), (1)) AS s(side)
          GROUP BY ALL),
        {name}_gains AS (
          SELECT node, f, cut, side, hl, ht - hl AS hr,
            {_score('gl', 'hl', p)} + {_score('gr', 'hr', p)} - {_score('gt', 'ht', p)} AS gain
          FROM (SELECT node, f, cut, side, CAST(gl AS DOUBLE) {unit} AS gl, CAST(gt - gl AS DOUBLE) {unit} AS gr, CAST(gt AS DOUBLE) {unit} AS gt,
                  CAST(hl AS DOUBLE) {unit} AS hl, CAST(ht - hl AS DOUBLE) {unit} AS hr, CAST(ht AS DOUBLE) {unit} AS ht
                FROM {name}_cuts)
          WHERE hl >= {p.min_child_weight} AND hr >= {p.min_child_weight}),
        {name} AS MATERIALIZED (
          SELECT node, f, cut, side, gain FROM {name}_gains WHERE gain > {limit!r}
          QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, cut, side) = 1)"""


def _moved(name: str, rows: str, splits: str) -> str:
    """``rows`` after the splits (node, f, cut, side); rows of other nodes stay."""
    return f"""{name} AS MATERIALIZED (
          SELECT r.trans_num, CASE WHEN s.node IS NULL THEN r.node
              WHEN CASE WHEN code = 0 THEN side = 1 ELSE code <= cut END THEN 2 * r.node ELSE 2 * r.node + 1 END AS node
          FROM {rows} r LEFT JOIN {splits} s ON s.node = r.node LEFT JOIN codes c ON c.trans_num = r.trans_num AND c.f = s.f)"""


def _leaves(name: str, rows: str, grads: str, p: Params) -> str:
    g, h = "CAST(sum(g) AS DOUBLE) / 1073741824::DOUBLE", "CAST(sum(h) AS DOUBLE) / 1073741824::DOUBLE"
    return f"""{name} AS MATERIALIZED (
          SELECT node, h AS cover, -{p.learning_rate}::DOUBLE * sign(g) * greatest(abs(g) - {p.reg_alpha}::DOUBLE, 0::DOUBLE)
              / (h + {p.reg_lambda}::DOUBLE) AS value
          FROM (SELECT node, {g} AS g, {h} AS h FROM {rows} JOIN {grads} USING (trans_num) GROUP BY node))"""


def _out(tree: int, splits: str, leaves: str) -> str:
    names = ", ".join(f"'{c}'" for c in SEEN)
    return f"""SELECT {tree}::BIGINT AS tree, node::BIGINT AS node, step::BIGINT AS step, list_extract([{names}], f + 1) AS feature, cut::BIGINT AS cut,
          {r6('list_extract(e, cut)')} AS threshold, side = 1 AS nulls_left, {r6('gain')} AS gain, NULL::DOUBLE AS cover, NULL::DOUBLE AS value
        FROM {splits} JOIN edges USING (f)
        UNION ALL SELECT {tree}, node, NULL, NULL, NULL, NULL, NULL, NULL, {r6('cover')}, {r6('value')} FROM {leaves}"""


def _depthwise(p: Params, source: str = "timed") -> tuple[list[str], list[str], str]:
    """Steps of the trees that learn from ``source``, the nodes of each tree, and the margins of all rows."""
    parts, outs, margins = [_codes(source)], [], "SELECT trans_num, is_fraud, 0::DOUBLE AS m FROM timed"
    for t in range(p.rounds):
        parts.append(_gradients(f"g{t}", f"SELECT * FROM ({margins}) WHERE trans_num IN (SELECT trans_num FROM {source})"))
        parts.append(f"t{t}l0 AS (SELECT trans_num, 1 AS node FROM timed)")
        for level in range(p.max_depth):
            parts.append(_best(f"t{t}s{level}", f"t{t}l{level}", f"g{t}", p))
            parts.append(_moved(f"t{t}l{level + 1}", f"t{t}l{level}", f"t{t}s{level}"))
        every = " UNION ALL ".join(f"SELECT * FROM t{t}s{level}" for level in range(p.max_depth))
        parts.append(f"t{t}all AS (SELECT *, row_number() OVER (ORDER BY node) AS step FROM ({every}))")
        parts.append(_leaves(f"t{t}v", f"t{t}l{p.max_depth}", f"g{t}", p))
        outs.append(_out(t, f"t{t}all", f"t{t}v"))
        margins = f"""SELECT trans_num, is_fraud, b.m + value AS m FROM ({margins}) b
            JOIN t{t}l{p.max_depth} USING (trans_num) JOIN t{t}v USING (node)"""
    return parts, outs, margins


def _depthwise_sql(p: Params) -> str:
    parts, outs, _ = _depthwise(p)
    return "WITH " + ",\n".join(parts) + "\n" + " UNION ALL ".join(outs)


def _scores_sql(p: Params) -> str:
    """Scores of the rows that the trees did not learn from, in two parts."""
    parts, _, margins = _depthwise(p, "learned")
    steps = ",\n".join([f"learned AS (SELECT * FROM timed WHERE {_PLACE_SQL} < 3)", *parts])
    return f"""WITH {steps}
        SELECT is_fraud AS label, score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS pred, {_PLACE_SQL} AS place
        FROM (SELECT trans_num, is_fraud, 1 / (1 + exp(-m)) AS score FROM ({margins})) WHERE {_PLACE_SQL} >= 3"""


def _leafwise_sql(p: Params) -> str:
    parts = [_codes(), _gradients("g", "SELECT trans_num, is_fraud, 0::DOUBLE AS m FROM timed")]
    parts.append("r0 AS (SELECT trans_num, 1 AS node FROM timed)")
    parts.append(_best("open0", "r0", "g", p))
    taken = []
    for k in range(1, p.max_leaves):
        parts.append(f"take{k} AS MATERIALIZED (SELECT * FROM open{k - 1} ORDER BY gain DESC, node LIMIT 1)")
        parts.append(_moved(f"r{k}", f"r{k - 1}", f"take{k}"))
        parts.append(f"kids{k} AS MATERIALIZED (SELECT r.* FROM r{k} r JOIN take{k} t ON r.node IN (2 * t.node, 2 * t.node + 1))")
        parts.append(_best(f"new{k}", f"kids{k}", "g", p))
        parts.append(
            f"open{k} AS MATERIALIZED (SELECT * FROM open{k - 1} WHERE node NOT IN (SELECT node FROM take{k}) UNION ALL SELECT * FROM new{k})"
        )
        taken.append(f"SELECT *, {k} AS step FROM take{k}")
    parts.append(f"taken AS ({' UNION ALL '.join(taken)})")
    parts.append(_leaves("v", f"r{p.max_leaves - 1}", "g", p))
    return "WITH " + ",\n".join(parts) + "\n" + _out(0, "taken", "v")


def _nested(body: str) -> str:
    """A whole WITH query below the common ones."""
    return oracle(f"SELECT * FROM ({body})", "timed")


@query("boosted_tree_nodes", _nested(_depthwise_sql(DEEP)))
def boosted_tree_nodes(spark, sf):
    """Two rounds of depth 3 with L1, L2, gamma and Hessian weight: all splits, gains, directions of nulls and leaf values."""
    return _grown(spark, sf, DEEP)


@query("leafwise_tree_nodes", _nested(_leafwise_sql(LEAFY)))
def leafwise_tree_nodes(spark, sf):
    """A tree of 31 leaves, always splitting the leaf with the highest gain: all nodes and the order of the splits."""
    return _grown(spark, sf, LEAFY)


@query(
    "generalisation_model",
    oracle(
        f"""SELECT metric, {r6('test')} AS test, {r6('unseen')} AS unseen, {r6('abs(test - unseen)')} AS abs_diff, {r6('d')} AS mean_diff,
              CASE WHEN d < 0.005 THEN 'excellent' WHEN d < 0.01 THEN 'very good'
                   WHEN d < 0.02 THEN 'acceptable' ELSE 'significant difference' END AS verdict
            FROM (SELECT *, avg(abs(test - unseen)) OVER () AS d FROM ({PAIRED_SQL}))""",
        "timed",
        extra={
            "scores_of_model": _scores_sql(DEEP),
            "model_test": "SELECT label, score, pred FROM scores_of_model WHERE place = 3",
            "model_unseen": "SELECT label, score, pred FROM scores_of_model WHERE place = 4",
            "m1": metric_row_sql("model_test"),
            "m2": metric_row_sql("model_unseen"),
        },
    ),
)
def generalisation_model(spark, sf):
    """A boosted model that learns from three fifths of the rows: its metrics on a test fifth against those on an unseen fifth, and
    the verdict."""
    rows = seen_rows(spark, sf)
    rows = rows.withColumn("_place", sample_hash(rows, ROW_ID) % 5)
    model = boosting.fit(rows.filter("_place < 3"), SEEN, DEEP, ROW_ID, weight=POSITIVE_WEIGHT, max_bins=BINS)
    scored = boosting.score(model, rows.filter("_place >= 3"), [LABEL, "_place"])
    parts = scored.select(F.col(LABEL).alias("label"), "score", "pred", F.when(F.col("_place") == 3, "test").otherwise("unseen").alias("part"))
    return validate.compare_metrics(evaluate.metrics_table(parts, ["part"]), "part", test="test", unseen="unseen")


# ---- guided search

_SURFACE = ("amt", "city_pop", "lat")
SEARCH_TRIALS, SEARCH_SEEDS = 60, 7


@query(
    "guided_search",
    oracle(
        f"""SELECT {", ".join(f"{r6(f'avg({c})')} AS best_{c}" for c in _SURFACE)}, {SEARCH_TRIALS}::BIGINT AS trials, 1 AS in_range,
              1 AS guided_better FROM txn""",
        "txn",
    ),
)
def guided_search(spark, sf):
    """A surface whose top is at the means of three columns: the median best value of guided searches against random ones.

    One aggregate gives the means and ranges; the surface itself needs no rows.
    """
    stats = transactions(spark, sf, list(_SURFACE)).agg(
        *[f(c).alias(f"{n}_{c}") for c in _SURFACE for n, f in (("avg", F.avg), ("low", F.min), ("high", F.max))]
    )
    at = stats.first()
    space = {c: search.Range(float(at[f"low_{c}"]), float(at[f"high_{c}"])) for c in _SURFACE}

    def surface(draws):
        return [
            -sum(((d[c] - at[f"avg_{c}"]) / (space[c].high - space[c].low)) ** 2 for c in _SURFACE) for d in draws
        ]

    runs = {
        kind: [search.maximise(surface, space, SEARCH_TRIALS, 5, startup, seed) for seed in range(SEARCH_SEEDS)]
        for kind, startup in (("guided", 15), ("random", SEARCH_TRIALS))
    }
    tops = {kind: sorted(max(v for _, v in run) for run in each)[SEARCH_SEEDS // 2] for kind, each in runs.items()}
    inside = all(space[c].low <= d[c] <= space[c].high for each in runs.values() for run in each for d, _ in run for c in _SURFACE)
    return stats.select(
        *[F.col(f"avg_{c}").alias(f"best_{c}") for c in _SURFACE],
        F.lit(len(runs["guided"][0])).alias("trials"),
        flag(F.lit(inside)).alias("in_range"),
        flag(F.lit(tops["guided"] > tops["random"] and math.isfinite(tops["guided"]))).alias("guided_better"),
    )
