"""Evaluation of rule scores computed from the transactions, importance and tuning reports.

Scores, importances and trials come from the whole table, so each result can be checked in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.numbers import flag, safe_ratio
from riskloom.operators import evaluate, importance, prepare, sampling, validate
from riskloom.plans.catalog.preparation import feature_rows
from riskloom.plans.catalog.registry import query
from riskloom.plans.catalog.sampling import split_sql
from riskloom.plans.catalog.sqltext import oracle, r6, ratio
from riskloom.session import artefact
from riskloom.sources.transactions import transactions

NIGHT_HOURS = (22, 23, 0, 1, 2, 3)


def _timed(spark, sf, *columns):
    rows = transactions(spark, sf, ["trans_num", "trans_time", "amt", "is_fraud", *columns])
    return prepare.add_hour(rows).withColumn("night", flag(F.col("trans_hour").isin(*NIGHT_HOURS)))


def scored_rows(spark, sf):
    """One rule score per row: large amounts and night hours are suspicious."""
    score = F.least(F.lit(1.0), F.col("amt") / 500 + F.lit(0.3) * F.col("night"))
    rows = _timed(spark, sf).select("trans_num", F.col("is_fraud").alias("label"), score.alias("score"))
    return rows.withColumn("pred", flag(F.col("score") >= 0.5))


def rule_models(spark, sf):
    """The same rows scored by three rules, tall with the rule's name."""
    amount = F.least(F.lit(1.0), F.col("amt") / 400)
    rules = {
        "amount": amount,
        "night": F.lit(0.6) * F.col("night"),
        "blend": F.least(F.lit(1.0), F.col("amt") / 500 + F.lit(0.3) * F.col("night")),
    }
    tall = F.array(
        *[F.struct(F.lit(k).alias("model_name"), v.alias("score")) for k, v in rules.items()]
    )
    rows = _timed(spark, sf).select(F.col("is_fraud").alias("label"), F.inline(tall))
    return rows.withColumn("pred", flag(F.col("score") >= 0.5))


_MODELS_SQL = """SELECT model_name, label, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM (
  SELECT 'amount' AS model_name, is_fraud AS label,
    least(CAST(1 AS DOUBLE), amt / CAST(400 AS DOUBLE)) AS score FROM timed
  UNION ALL SELECT 'night', is_fraud,
    CAST(0.6 AS DOUBLE) * CASE WHEN trans_hour IN (22, 23, 0, 1, 2, 3) THEN 1 ELSE 0 END FROM timed
  UNION ALL SELECT 'blend', label, score FROM scored)"""


def matrix_sql(source: str, by: str = "") -> str:
    head, tail = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""SELECT {head}count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn,
      count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
      count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn,
      count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp FROM {source} {tail}"""


METRIC_EXPR = {
    "accuracy": ratio("tp + tn", "tp + tn + fp + fn"),
    "precision": ratio("tp", "tp + fp"),
    "recall": ratio("tp", "tp + fn"),
    "f1_score": ratio("2 * tp", "2 * tp + fp + fn"),
}
_METRICS_OUT = ", ".join(f"{r6(sql)} AS {name}" for name, sql in METRIC_EXPR.items())
_BUSINESS_EXPR = {
    "caught_rate": ratio("tp", "tp + fn") + " * 100",
    "false_alarm_rate": ratio("fp", "fp + tn") + " * 100",
}


def auc_sql(source: str, by: str = "") -> str:
    """Rank-sum form of the area under the ROC curve, ties at their mean rank."""
    head, tail, part = (f"{by}, ", f"GROUP BY {by}", f"PARTITION BY {by}") if by else ("", "", "")
    return f"""SELECT {head}(sum(CASE WHEN label = 1 THEN mean_rank END)
        - CAST(sum(label) AS DOUBLE) * (sum(label) + 1) / 2)
        / (CAST(sum(label) AS DOUBLE) * sum(1 - label)) AS roc_auc
      FROM (SELECT *, avg(rn) OVER (PARTITION BY {by + ', ' if by else ''}score) AS mean_rank
            FROM (SELECT *, row_number() OVER ({part} ORDER BY score) AS rn FROM {source})) {tail}"""


@query(
    "confusion_matrix",
    oracle(
        "SELECT tn, fp, fn, tp, "
        + ", ".join(
            f"{r6(ratio(c, 'tn + fp + fn + tp') + ' * 100')} AS {c}_pct" for c in ("tn", "fp", "fn", "tp")
        )
        + f" FROM ({matrix_sql('scored')})",
        "scored",
    ),
)
def confusion_matrix(spark, sf):
    return evaluate.confusion_shares(scored_rows(spark, sf))


@query(
    "classification_metrics",
    oracle(f"SELECT tn, fp, fn, tp, {_METRICS_OUT} FROM ({matrix_sql('scored')})", "scored"),
)
def classification_metrics(spark, sf):
    return evaluate.class_metrics(evaluate.confusion(scored_rows(spark, sf)))


@query(
    "business_metrics",
    oracle(
        f"""SELECT tp AS fraud_caught, fn AS fraud_missed, fp AS false_alarms,
              {", ".join(f"{r6(sql)} AS {name}" for name, sql in _BUSINESS_EXPR.items())}
            FROM ({matrix_sql('scored')})""",
        "scored",
    ),
)
def business_metrics(spark, sf):
    return evaluate.business_metrics(evaluate.confusion(scored_rows(spark, sf))).drop(
        "tn", "fp", "fn", "tp"
    )


@query("roc_auc", oracle(f"SELECT {r6('roc_auc')} AS roc_auc FROM ({auc_sql('scored')})", "scored"))
def roc_auc(spark, sf):
    return evaluate.roc_auc(scored_rows(spark, sf))


_THRESHOLDS = """SELECT t, count(*) FILTER (WHERE label = 1 AND score >= t) AS tp,
  count(*) FILTER (WHERE label = 0 AND score >= t) AS fp,
  count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n
  FROM scored, (SELECT k / CAST(99 AS DOUBLE) AS t FROM (SELECT unnest(range(100)) AS k)) GROUP BY t"""


@query(
    "threshold_sweep",
    oracle(
        f"""SELECT {r6('t')} AS threshold, {r6(ratio('tp', 'tp + fp'))} AS precision,
              {r6(ratio('tp', 'p'))} AS recall, {r6(ratio('2 * tp', 'tp + fp + p'))} AS f1_score
            FROM steps""",
        "scored",
        extra={"steps": _THRESHOLDS},
    ),
)
def threshold_sweep(spark, sf):
    return evaluate.threshold_sweep(scored_rows(spark, sf))


@query(
    "roc_curve",
    oracle(
        f"""SELECT {r6('t')} AS threshold, {r6(ratio('fp', 'n'))} AS fpr, {r6(ratio('tp', 'p'))} AS tpr
            FROM steps""",
        "scored",
        extra={"steps": _THRESHOLDS},
    ),
)
def roc_curve(spark, sf):
    return evaluate.roc_curve(scored_rows(spark, sf))


@query(
    "pr_curve",
    oracle(
        f"""SELECT {r6('t')} AS threshold, {r6(ratio('tp', 'p'))} AS recall,
              {r6('coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 1)')} AS precision FROM steps""",
        "scored",
        extra={"steps": _THRESHOLDS},
    ),
)
def pr_curve(spark, sf):
    return evaluate.pr_curve(scored_rows(spark, sf))


@query(
    "model_comparison",
    oracle(
        f"""SELECT m.model_name, tn, fp, fn, tp, {_METRICS_OUT}, {r6('roc_auc')} AS roc_auc,
              CAST(CASE WHEN row_number() OVER (ORDER BY {METRIC_EXPR['f1_score']} DESC, m.model_name) = 1
                   THEN 1 ELSE 0 END AS BIGINT) AS is_best
            FROM ({matrix_sql('models', 'model_name')}) AS m
            JOIN ({auc_sql('models', 'model_name')}) AS a ON a.model_name = m.model_name""",
        "scored",
        extra={"models": _MODELS_SQL},
    ),
)
def model_comparison(spark, sf):
    table = evaluate.metrics_table(rule_models(spark, sf), ["model_name"])
    return evaluate.model_comparison(table, "f1_score")


# ---- unseen rows

_TEST_AND_REST = {
    "parts": split_sql(42, "(SELECT trans_num, label AS is_fraud, score, pred FROM scored)"),
    "test_rows": "SELECT is_fraud AS label, score, pred FROM parts WHERE split = 'test'",
    "train_part": "SELECT is_fraud AS label, score, pred FROM parts WHERE split = 'train'",
}


def _parts(spark, sf):
    rows = scored_rows(spark, sf).withColumnRenamed("label", "is_fraud")
    return sampling.stratified_split(rows).withColumnRenamed("is_fraud", "label")


_REPORT_SQL = f"""SELECT *, tn + fp + fn + tp AS n, fn + tp AS f, {
    ", ".join(f"{sql} AS {name}" for name, sql in METRIC_EXPR.items())
}, {", ".join(f"{sql} AS {name}" for name, sql in _BUSINESS_EXPR.items())}
FROM ({matrix_sql('test_rows')}), ({auc_sql('test_rows')})"""
_REPORT_LINES = {
    "dataset_info": {
        "total_rows": "n", "fraud_cases": "f", "fraud_rate": "CAST(f AS DOUBLE) / n",
        "legitimate_cases": "n - f",
    },
    "metrics": {m: m for m in (*METRIC_EXPR, "roc_auc")},
    "confusion_matrix": {c: c for c in ("tn", "fp", "fn", "tp")},
    "business_metrics": {
        "fraud_caught": "tp", "fraud_missed": "fn", "caught_rate": "caught_rate",
        "false_alarms": "fp", "false_alarm_rate": "false_alarm_rate",
    },
}


@query(
    "unseen_evaluation",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{section}' AS section, '{name}' AS metric, {r6(sql)} AS value FROM report"
            for section, lines in _REPORT_LINES.items()
            for name, sql in lines.items()
        ),
        "scored",
        extra={**_TEST_AND_REST, "report": _REPORT_SQL},
    ),
)
def unseen_evaluation(spark, sf):
    """Evaluate on the rows that are not in the training part, found by an anti join on the row id."""
    rows = scored_rows(spark, sf)
    train = _parts(spark, sf).filter(F.col("split") == "train").select("trans_num")
    return validate.evaluation_report(validate.unseen_rows(rows, train))


def _metric_row_sql(source: str) -> str:
    return f"""SELECT {", ".join(f"{sql} AS {name}" for name, sql in METRIC_EXPR.items())}, roc_auc
      FROM ({matrix_sql(source)}), ({auc_sql(source)})"""


_PAIRED = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, (SELECT {m} FROM m1) AS test, (SELECT {m} FROM m2) AS unseen"
    for m in (*METRIC_EXPR, "roc_auc")
)


@query(
    "generalisation_check",
    oracle(
        f"""SELECT metric, {r6('test')} AS test, {r6('unseen')} AS unseen,
              {r6('abs(test - unseen)')} AS abs_diff, {r6('d')} AS mean_diff,
              CASE WHEN d < 0.005 THEN 'excellent' WHEN d < 0.01 THEN 'very good'
                   WHEN d < 0.02 THEN 'acceptable' ELSE 'significant difference' END AS verdict
            FROM (SELECT *, avg(abs(test - unseen)) OVER () AS d FROM ({_PAIRED}))""",
        "scored",
        extra={**_TEST_AND_REST, "m1": _metric_row_sql("train_part"), "m2": _metric_row_sql("test_rows")},
    ),
)
def generalisation_check(spark, sf):
    """The rule's metrics on one part of the rows against those on the other part."""
    metrics = evaluate.metrics_table(_parts(spark, sf), ["split"])
    return validate.compare_metrics(metrics, "split", test="train", unseen="test")


# ---- importance

_FEATURES = (
    "amt", "amt_log", "amt_zscore", "amt_per_age", "is_high_value", "is_outlier_iqr",
    "is_micro_transaction", "trans_hour", "hour_sin", "hour_cos", "is_night", "is_weekend",
    "trans_day", "age", "lat", "city_pop",
)
_SOURCES = ("correlation", "mean_gap", "variance_gap")
_KEEP = 6


def data_importances(spark, sf):
    """Three importance measures per feature, from the class means and variances of the whole table: an artefact,
    three lines a feature, which all importance queries read."""
    path = artefact(spark, sf, "importances", lambda path: _measured(spark, sf).write.parquet(path))
    return spark.read.parquet(path)


def _measured(spark, sf):
    rows = feature_rows(spark, sf, ["city_pop"]).select("is_fraud", *_FEATURES)
    per_class = rows.groupBy("is_fraud").agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    F.count(c).alias("n"),
                    F.avg(F.col(c).cast("double")).alias("mean"),
                    F.var_pop(F.col(c).cast("double")).alias("var"),
                )
                for c in _FEATURES
            ]
        ).alias("stats")
    )

    def of(label, name):
        return F.max(F.when(F.col("is_fraud") == label, F.col(name)))

    both = (
        per_class.select("is_fraud", F.inline("stats"))
        .groupBy("feature")
        .agg(*[of(k, name).alias(f"{name}{k}") for k in (0, 1) for name in ("n", "mean", "var")])
    )
    rows_known = F.col("n0") + F.col("n1")
    share = F.col("n1") / rows_known
    gap = F.col("mean1") - F.col("mean0")
    between = share * (1 - share) * gap * gap
    variance = (1 - share) * F.col("var0") + share * F.col("var1") + between
    measures = {
        "correlation": F.sqrt(F.try_divide(between, variance)),
        "mean_gap": F.abs(F.try_divide(gap, F.sqrt(variance))),
        "variance_gap": F.abs(F.try_divide(F.col("var1") - F.col("var0"), variance)),
    }
    lines = F.array(
        *[F.struct(F.lit(k).alias("model"), v.alias("value")) for k, v in measures.items()]
    )
    return both.select("feature", F.inline(lines)).select("model", "feature", "value")


def _importance_sql() -> dict[str, str]:
    one_row = ", ".join(
        f"""abs(corr({f}, is_fraud)) AS c_{f},
            abs((avg({f}) FILTER (WHERE is_fraud = 1) - avg({f}) FILTER (WHERE is_fraud = 0))
              / stddev_pop({f})) AS m_{f},
            abs((var_pop({f}) FILTER (WHERE is_fraud = 1) - var_pop({f}) FILTER (WHERE is_fraud = 0))
              / var_pop({f})) AS v_{f}"""
        for f in _FEATURES
    )
    tall = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, c_{f} AS c, m_{f} AS m, v_{f} AS v FROM measures" for f in _FEATURES
    )
    return {
        "measures": f"SELECT {one_row} FROM feats",
        "shares": f"""SELECT feature, c / sum(c) OVER () * 100 AS correlation,
                        m / sum(m) OVER () * 100 AS mean_gap, v / sum(v) OVER () * 100 AS variance_gap
                      FROM ({tall})""",
        "averaged": "SELECT *, (correlation + mean_gap + variance_gap) / 3 AS average FROM shares",
        "ranked": """SELECT row_number() OVER (ORDER BY round(average, 9) DESC, feature) AS rank, *
                     FROM averaged""",
    }


_RANKED = _importance_sql()
_RANKED_OUT = "rank, feature, " + ", ".join(f"{r6(c)} AS {c}" for c in (*_SOURCES, "average"))


def _ranked(spark, sf):
    return importance.rank_importance(data_importances(spark, sf), _SOURCES)


@query("feature_importance", oracle(f"SELECT {_RANKED_OUT} FROM ranked", "feats", extra=_RANKED))
def feature_importance(spark, sf):
    return _ranked(spark, sf)


@query(
    "importance_summary",
    oracle(
        f"""SELECT count(*) AS features,
              {", ".join(
                  f"{r6(f'sum(CASE WHEN rank <= {k} THEN average ELSE 0 END)')} AS top{k}_share"
                  for k in (10, 20, 50))},
              count(*) FILTER (WHERE average < 0.1) AS low_features,
              {r6(ratio('count(*) FILTER (WHERE average < 0.1)', 'count(*)') + ' * 100')} AS low_pct
            FROM ranked""",
        "feats",
        extra=_RANKED,
    ),
)
def importance_summary(spark, sf):
    return importance.importance_summary(_ranked(spark, sf))


_CUMULATIVE = {
    **_RANKED,
    "running": "SELECT rank, feature, average, sum(average) OVER (ORDER BY rank) AS cumulative FROM ranked",
}


@query(
    "importance_cumulative",
    oracle(
        f"""SELECT rank, feature, {r6('average')} AS average, {r6('cumulative')} AS cumulative
            FROM running""",
        "feats",
        extra=_CUMULATIVE,
    ),
)
def importance_cumulative(spark, sf):
    return importance.cumulative_importance(_ranked(spark, sf))


@query(
    "features_needed",
    oracle(
        "SELECT " + ", ".join(f"min(rank) FILTER (WHERE cumulative >= {m}) AS n_{m}" for m in (80, 90, 95))
        + " FROM running",
        "feats",
        extra=_CUMULATIVE,
    ),
)
def features_needed(spark, sf):
    return importance.features_needed(importance.cumulative_importance(_ranked(spark, sf)))


@query(
    "feature_selection",
    oracle(
        f"""SELECT count(*) FILTER (WHERE rank <= {_KEEP}) AS n_features_selected,
              count(*) FILTER (WHERE rank > {_KEEP}) AS n_features_dropped,
              {r6(f'sum(average) FILTER (WHERE rank <= {_KEEP})')} AS importance_captured,
              {r6(f'sum(average) - sum(average) FILTER (WHERE rank <= {_KEEP})')} AS importance_lost
            FROM ranked""",
        "feats",
        extra=_RANKED,
    ),
)
def feature_selection(spark, sf):
    return importance.selection_report(_ranked(spark, sf), _KEEP)


@query(
    "selected_features",
    oracle(f"SELECT {_RANKED_OUT} FROM ranked WHERE rank <= {_KEEP}", "feats", extra=_RANKED),
)
def selected_features(spark, sf):
    return importance.select_top(_ranked(spark, sf), _KEEP)


@query(
    "dropped_features",
    oracle(
        f"SELECT {_RANKED_OUT} FROM ranked ORDER BY rank LIMIT 10 OFFSET {_KEEP}", "feats", extra=_RANKED
    ),
)
def dropped_features(spark, sf):
    return importance.next_dropped(_ranked(spark, sf), _KEEP)


# ---- tuning history

# Settings of the rule score that are tried: amount scale, night weight, error weight (may be absent).
_TRIALS = (
    (0, 300.0, 0.1, None), (1, 400.0, 0.3, 0.1), (2, 500.0, 0.3, 0.2), (3, 250.0, 0.4, None),
    (4, 600.0, 0.2, 0.3), (5, 350.0, 0.35, 0.15), (6, 450.0, 0.25, 0.05), (7, 350.0, 0.35, 0.15),
)


def rule_trials(spark, sf):
    """F1 of the rule under each setting, all settings in one pass over the table."""
    rows = _timed(spark, sf, "category").withColumn("error", flag(F.col("category") == "error"))
    actual = F.col("is_fraud") == 1
    aggs, lines = [F.count_if(actual).alias("_pos")], []
    for i, (number, scale, night, error) in enumerate(_TRIALS):
        score = F.col("amt") / F.lit(scale) + F.lit(night) * F.col("night") + F.lit(error or 0.0) * F.col("error")
        hit = score >= 0.5
        aggs += [F.count_if(hit & actual).alias(f"_tp{i}"), F.count_if(hit).alias(f"_hit{i}")]
        lines.append(
            F.struct(
                F.lit(number).alias("number"),
                safe_ratio(2 * F.col(f"_tp{i}"), F.col(f"_hit{i}") + F.col("_pos")).alias("value"),
                F.lit(scale).alias("params_scale"),
                F.lit(night).alias("params_night"),
                F.lit(error).cast("double").alias("params_error"),
            )
        )
    return rows.agg(*aggs).select(F.inline(F.array(*lines)))


_TRIALS_SQL = {
    "settings": "SELECT * FROM (VALUES "
    + ", ".join(
        f"(CAST({n} AS BIGINT), CAST({s} AS DOUBLE), CAST({w} AS DOUBLE), "
        f"CAST({'NULL' if e is None else e} AS DOUBLE))"
        for n, s, w, e in _TRIALS
    )
    + ") AS t(number, params_scale, params_night, params_error)",
    "trials": f"""SELECT number, params_scale, params_night, params_error,
        {ratio('2 * count(*) FILTER (WHERE hit AND is_fraud = 1)',
               'count(*) FILTER (WHERE hit) + count(*) FILTER (WHERE is_fraud = 1)')} AS value
      FROM (SELECT settings.*, is_fraud, amt / params_scale
              + params_night * CASE WHEN trans_hour IN (22, 23, 0, 1, 2, 3) THEN 1 ELSE 0 END
              + coalesce(params_error, 0) * CASE WHEN category = 'error' THEN 1 ELSE 0 END >= 0.5 AS hit
            FROM timed, settings)
      GROUP BY ALL""",
}


@query(
    "running_best",
    oracle(
        f"""SELECT number, {r6('value')} AS value,
              {r6('max(value) OVER (ORDER BY number)')} AS best_so_far,
              CAST(CASE WHEN number = (SELECT number FROM trials ORDER BY value DESC, number LIMIT 1)
                   THEN 1 ELSE 0 END AS BIGINT) AS is_best FROM trials""",
        "timed",
        extra=_TRIALS_SQL,
    ),
)
def running_best(spark, sf):
    return importance.running_best(rule_trials(spark, sf))


@query(
    "best_trial",
    oracle(
        f"SELECT number, {r6('value')} AS value FROM trials ORDER BY trials.value DESC, number LIMIT 1",
        "timed",
        extra=_TRIALS_SQL,
    ),
)
def best_trial(spark, sf):
    return importance.best_trial(rule_trials(spark, sf))


@query(
    "param_importance",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{p}' AS param, {r6(f'abs(corr(params_{p}, value))')} AS importance FROM trials"
            for p in ("scale", "night", "error")
        ),
        "timed",
        extra=_TRIALS_SQL,
    ),
)
def param_importance(spark, sf):
    return importance.param_importance(rule_trials(spark, sf))
