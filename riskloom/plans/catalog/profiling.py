"""Profiles, label analysis, fraud over time and categories, correlations and distributions."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from riskloom.functions.numbers import flag
from riskloom.operators import correlate, distribution, evaluate, ordered, prepare, profile, risk
from riskloom.plans.catalog.preparation import feature_rows, prepared_rows
from riskloom.plans.catalog.registry import query
from riskloom.plans.catalog.sqltext import oracle, r, r6, rate, ratio
from riskloom.schema import RAW_SCHEMA, RISK_COLUMNS
from riskloom.session import scratch_path
from riskloom.sources import files
from riskloom.sources.transactions import read_table, transactions

# ---- table profile


def whole_prepared(spark, sf):
    return prepared_rows(spark, sf, RAW_SCHEMA.fieldNames())


@query(
    "profile_overview",
    oracle(
        """SELECT 'total_rows' AS metric, count(*) AS value FROM prepared
           UNION ALL SELECT 'total_columns', 31
           UNION ALL SELECT 'numerical_columns', 16
           UNION ALL SELECT 'categorical_columns', 14
           UNION ALL SELECT 'datetime_columns', 1""",
        "prepared",
    ),
)
def profile_overview(spark, sf):
    return profile.overview(whole_prepared(spark, sf))


_MISSING_TYPES = {
    "ssn": "string", "first": "string", "last": "string", "gender": "string", "street": "string",
    "city": "string", "state": "string", "zip": "bigint", "lat": "double", "long": "double",
    "city_pop": "bigint", "job": "string", "dob": "string", "profile": "string", "amt": "double",
    "merch_lat": "double", "merch_long": "double", "trans_hour": "int",
}


@query(
    "profile_missing",
    oracle(
        """SELECT * FROM ("""
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE "{c}" IS NULL) AS missing_count,
                {r(ratio(f'count(*) FILTER (WHERE "{c}" IS NULL)', 'count(*)') + ' * 100', 2)}
                  AS missing_percent, '{t}' AS data_type FROM timed"""
            for c, t in _MISSING_TYPES.items()
        )
        + ") WHERE missing_count > 0",
        "timed",
    ),
)
def profile_missing(spark, sf):
    return profile.missing_values(prepare.add_hour(prepare.add_date_parts(transactions(spark, sf))))


_LINEITEM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "profile_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, {r(f'avg({c})', 2)} AS mean,
            {r(f'stddev_samp({c})', 2)} AS std, {r(f'min({c})', 2)} AS min, {r(f'max({c})', 2)} AS max,
            count(*) - count({c}) AS missing, {r(f'quantile_cont({c}, 0.25)', 2)} AS q25,
            {r(f'quantile_cont({c}, 0.5)', 2)} AS q50, {r(f'quantile_cont({c}, 0.75)', 2)} AS q75
            FROM lineitem"""
        for c in _LINEITEM
    ),
)
def profile_numeric(spark, sf):
    return profile.numeric_describe(read_table(spark, sf, "lineitem"), _LINEITEM)


_POPULATION = ("amt", "lat", "long", "city_pop", "zip", "trans_day", "trans_hour", "is_fraud")


@query(
    "profile_numeric_pop",
    oracle(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS count, {r(f'avg({c})', 2)} AS mean,
                {r(f'stddev_pop({c})', 2)} AS std, {r(f'min({c})', 2)} AS min,
                {r(f'max({c})', 2)} AS max, count(*) - count({c}) AS missing FROM timed"""
            for c in _POPULATION
        ),
        "timed",
    ),
)
def profile_numeric_pop(spark, sf):
    columns = [*_POPULATION, "trans_date", "trans_time"]
    rows = prepare.add_hour(prepare.add_date_parts(transactions(spark, sf, columns)))
    return profile.numeric_summary(rows, _POPULATION)


_CATEGORICAL = ("gender", "city", "state", "job", "profile", "category", "merchant")


@query(
    "profile_categorical",
    oracle(
        """SELECT col AS "column", count(*) AS unique_values,
             max(CASE WHEN rn = 1 THEN value END) AS most_common, max(n) AS most_common_count
           FROM (SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, value) AS rn FROM ("""
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS col, {c} AS value, count(*) AS n FROM prepared
                WHERE {c} IS NOT NULL GROUP BY {c}"""
            for c in _CATEGORICAL
        )
        + ")) GROUP BY col",
        "prepared",
    ),
)
def profile_categorical(spark, sf):
    return profile.categorical_summary(prepared_rows(spark, sf, _CATEGORICAL), _CATEGORICAL)


# ---- label


@query(
    "target_distribution",
    oracle(
        f"""SELECT CAST(0 AS BIGINT) AS is_fraud, count(*) FILTER (WHERE is_fraud = 0) AS count,
              {r6('100 - ' + ratio('count(*) FILTER (WHERE is_fraud = 1)', 'count(*)') + ' * 100')}
                AS percentage FROM txn
            UNION ALL SELECT 1, count(*) FILTER (WHERE is_fraud = 1),
              {r6(ratio('count(*) FILTER (WHERE is_fraud = 1)', 'count(*)') + ' * 100')} FROM txn""",
        "txn",
    ),
)
def target_distribution(spark, sf):
    return profile.target_distribution(transactions(spark, sf, ["is_fraud"]))


@query(
    "target_imbalance",
    oracle(
        f"""SELECT total, non_fraud, fraud, {r6('share')} AS fraud_rate,
              {r6("coalesce(non_fraud / nullif(CAST(fraud AS DOUBLE), 0), CAST('inf' AS DOUBLE))")}
                AS imbalance_ratio,
              CASE WHEN share < 0.5 THEN 'severe' WHEN share < 1 THEN 'high'
                   WHEN share < 5 THEN 'moderate' ELSE 'balanced' END AS severity
            FROM (SELECT count(*) AS total, count(*) FILTER (WHERE is_fraud = 0) AS non_fraud,
                    count(*) FILTER (WHERE is_fraud = 1) AS fraud,
                    {ratio('count(*) FILTER (WHERE is_fraud = 1)', 'count(*)')} * 100 AS share FROM txn)""",
        "txn",
    ),
)
def target_imbalance(spark, sf):
    return profile.target_imbalance(transactions(spark, sf, ["is_fraud"]))


@query(
    "class_weights",
    oracle(
        f"""SELECT {r6(ratio('neg', 'pos'))} AS scale_pos_weight,
              {r6(ratio('neg + pos', '2 * neg'))} AS weight_negative,
              {r6(ratio('neg + pos', '2 * pos'))} AS weight_positive
            FROM (SELECT count(*) FILTER (WHERE is_fraud = 0) AS neg,
                         count(*) FILTER (WHERE is_fraud = 1) AS pos FROM txn)""",
        "txn",
    ),
)
def class_weights(spark, sf):
    return profile.class_weights(transactions(spark, sf, ["is_fraud"]))


_AMOUNT_METRICS = {
    "count": "count(amt)", "mean": "avg(amt)", "median": "quantile_cont(amt, 0.5)",
    "std": "stddev_pop(amt)", "min": "min(amt)", "max": "max(amt)",
    "q25": "quantile_cont(amt, 0.25)", "q75": "quantile_cont(amt, 0.75)",
}


@query(
    "amount_by_class",
    oracle(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS metric,
                {r(f'(SELECT {sql} FROM txn WHERE is_fraud = 0)', 2)} AS non_fraud,
                {r(f'(SELECT {sql} FROM txn WHERE is_fraud = 1)', 2)} AS fraud"""
            for name, sql in _AMOUNT_METRICS.items()
        ),
        "txn",
    ),
)
def amount_by_class(spark, sf):
    return profile.amount_by_class(transactions(spark, sf, ["amt", "is_fraud"]))


@query(
    "amount_class_diff",
    oracle(
        f"""SELECT {r6('d1')} AS mean_diff, {r6('d2')} AS median_diff,
              CASE WHEN d1 > 0 THEN 'fraud higher' ELSE 'fraud lower' END AS mean_direction,
              CASE WHEN d2 > 0 THEN 'fraud higher' ELSE 'fraud lower' END AS median_direction,
              CAST(CASE WHEN abs(d1) > 10 THEN 1 ELSE 0 END AS BIGINT) AS significant
            FROM (SELECT avg(amt) FILTER (WHERE is_fraud = 1) - avg(amt) FILTER (WHERE is_fraud = 0) AS d1,
                    quantile_cont(amt, 0.5) FILTER (WHERE is_fraud = 1)
                    - quantile_cont(amt, 0.5) FILTER (WHERE is_fraud = 0) AS d2 FROM txn)""",
        "txn",
    ),
)
def amount_class_diff(spark, sf):
    return profile.amount_class_difference(transactions(spark, sf, ["amt", "is_fraud"]))


# ---- time

_BY = {
    "hourly": f"""SELECT h AS hour, count(*) FILTER (WHERE is_fraud = 1) AS fraud_count,
                    count(is_fraud) AS total_count,
                    {rate('count(*) FILTER (WHERE is_fraud = 1)', 'count(is_fraud)')} AS fraud_rate
                  FROM (SELECT unnest(range(24)) AS h) LEFT JOIN timed ON trans_hour = h GROUP BY h""",
    "weekly": f"""SELECT trans_weekday AS weekday, count(*) FILTER (WHERE is_fraud = 1) AS fraud_count,
                    count(*) AS total_count,
                    {rate('count(*) FILTER (WHERE is_fraud = 1)', 'count(*)')} AS fraud_rate,
                    CASE trans_weekday WHEN 'Monday' THEN 1 WHEN 'Tuesday' THEN 2 WHEN 'Wednesday' THEN 3
                      WHEN 'Thursday' THEN 4 WHEN 'Friday' THEN 5 WHEN 'Saturday' THEN 6 ELSE 7 END AS place
                  FROM timed WHERE trans_weekday IS NOT NULL GROUP BY trans_weekday""",
}


def _dated(spark, sf):
    rows = transactions(spark, sf, ["trans_date", "trans_time", "is_fraud"])
    return prepare.add_hour(prepare.add_date_parts(rows))


def _hourly(spark, sf):
    rows = prepare.add_hour(transactions(spark, sf, ["trans_time", "is_fraud"]))
    return risk.fraud_by_hour(rows)


@query("fraud_by_hour", oracle("SELECT * FROM hourly", "timed", extra=_BY))
def fraud_by_hour(spark, sf):
    return _hourly(spark, sf)


@query("report_roundtrip", oracle("SELECT * FROM hourly", "timed", extra=_BY))
def report_roundtrip(spark, sf):
    """A finished report, stored as CSV and read again."""
    report, path = _hourly(spark, sf), scratch_path(spark, "report")
    files.write_report(report, path, "csv")
    return files.read_report(spark, path, report.schema, "csv")


@query("fraud_by_weekday", oracle("SELECT * EXCLUDE (place) FROM weekly", "timed", extra=_BY))
def fraud_by_weekday(spark, sf):
    return risk.fraud_by_weekday(_dated(spark, sf))


@query(
    "fraud_by_month",
    oracle(
        f"""SELECT trans_month AS month, count(*) FILTER (WHERE is_fraud = 1) AS fraud_count,
              count(*) AS total_count,
              {rate('count(*) FILTER (WHERE is_fraud = 1)', 'count(*)')} AS fraud_rate
            FROM timed WHERE trans_month IS NOT NULL GROUP BY trans_month""",
        "timed",
    ),
)
def fraud_by_month(spark, sf):
    return risk.fraud_by_month(_dated(spark, sf))


@query(
    "peak_hours",
    oracle(
        f"""SELECT h1.hour AS peak_hour, {r6('h1.fraud_rate')} AS peak_rate, h2.hour AS lowest_hour,
              {r6('h2.fraud_rate')} AS lowest_rate, w.weekday AS peak_day,
              {r6('w.fraud_rate')} AS peak_day_rate
            FROM (SELECT * FROM hourly ORDER BY fraud_rate DESC, hour LIMIT 1) h1,
                 (SELECT * FROM hourly ORDER BY fraud_rate, hour LIMIT 1) h2,
                 (SELECT * FROM weekly ORDER BY fraud_rate DESC, place LIMIT 1) w""",
        "timed",
        extra=_BY,
    ),
)
def peak_hours(spark, sf):
    return risk.peak_hours(_hourly(spark, sf), risk.fraud_by_weekday(_dated(spark, sf)))


def _mean(first: int, last: int) -> str:
    return f"(SELECT avg(fraud_rate) FROM hourly WHERE hour BETWEEN {first} AND {last})"


@query(
    "night_day_pattern",
    oracle(
        f"""SELECT {r6('n')} AS night_rate, {r6('b')} AS business_rate,
              CASE WHEN n > b * 1.2::DOUBLE THEN 'night' WHEN b > n * 1.2::DOUBLE THEN 'daytime'
                   ELSE 'even' END AS pattern
            FROM (SELECT {_mean(0, 5)} AS n, {_mean(9, 17)} AS b)""",
        "timed",
        extra=_BY,
    ),
)
def night_day_pattern(spark, sf):
    return risk.night_day_pattern(_hourly(spark, sf))


@query(
    "period_summary",
    oracle(
        f"""SELECT {r6('n')} AS night_rate, {r6('m')} AS morning_rate, {r6('a')} AS afternoon_rate,
              {r6('e')} AS evening_rate,
              CASE WHEN n > m * 1.2::DOUBLE THEN 'night' WHEN a > n * 1.2::DOUBLE THEN 'daytime'
                   ELSE 'even' END AS pattern
            FROM (SELECT {_mean(0, 5)} AS n, {_mean(6, 11)} AS m, {_mean(12, 17)} AS a,
                         {_mean(18, 23)} AS e)""",
        "timed",
        extra=_BY,
    ),
)
def period_summary(spark, sf):
    return risk.period_summary(_hourly(spark, sf))


# ---- categories


def _risk_sql(column: str) -> str:
    return f"""SELECT {column}, count(*) FILTER (WHERE is_fraud = 1) AS fraud_count,
      count(*) AS total_count, {rate('count(*) FILTER (WHERE is_fraud = 1)', 'count(*)')} AS fraud_rate
      FROM prepared WHERE {column} IS NOT NULL GROUP BY {column}"""


@query("risk_by_category", oracle(_risk_sql("category"), "prepared"))
def risk_by_category(spark, sf):
    return risk.risk_by_value(prepared_rows(spark, sf, ["category", "is_fraud"]), "category")


@query("risk_by_job", oracle(_risk_sql("job"), "prepared"))
def risk_by_job(spark, sf):
    return risk.risk_by_value(prepared_rows(spark, sf, ["job", "is_fraud"]), "job")


@query("risk_by_merchant", oracle(_risk_sql("merchant"), "prepared"))
def risk_by_merchant(spark, sf):
    return risk.risk_by_value(prepared_rows(spark, sf, ["merchant", "is_fraud"]), "merchant")


_RISK_TALL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {c} AS value, fraud_count, total_count, fraud_rate
        FROM ({_risk_sql(c)})"""
    for c in RISK_COLUMNS
)


@query(
    "risk_top_k",
    oracle(
        """SELECT * FROM (
             SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY fraud_rate DESC, value) AS rank,
               'rate' AS ranking, count(*) OVER (PARTITION BY "column") AS unique_values FROM tall
             UNION ALL
             SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY fraud_count DESC, value),
               'count', count(*) OVER (PARTITION BY "column") FROM tall) WHERE rank <= 10""",
        "prepared",
        extra={"tall": _RISK_TALL},
    ),
)
def risk_top_k(spark, sf):
    rows = prepared_rows(spark, sf, [*RISK_COLUMNS, "is_fraud"])
    return risk.risk_top_k(risk.risk_table(rows), 10)


# ---- correlations

_CORRELATED = (
    "amt", "lat", "long", "merch_lat", "merch_long", "city_pop", "zip", "unix_time", "trans_month",
    "trans_day", "trans_hour", "age", "is_fraud",
)


def _corr(a: str, b: str) -> str:
    return f"(SELECT CASE WHEN isnan(c) THEN NULL ELSE c END FROM (SELECT corr({a}, {b}) AS c FROM feats))"


_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS feature1, '{b}' AS feature2, {_corr(a, b)} AS c"
    for a, b in combinations(_CORRELATED, 2)
)
_TARGET_SQL = f"""SELECT *, abs(c) AS a FROM ({" UNION ALL ".join(
    f"SELECT '{f}' AS feature, {_corr(f, 'is_fraud')} AS c" for f in _CORRELATED if f != 'is_fraud'
)}) WHERE c IS NOT NULL"""


def _correlated(spark, sf):
    return feature_rows(spark, sf, ["city_pop", "zip", "unix_time"]).select(*_CORRELATED)


def _target(spark, sf):
    return correlate.target_correlations(_correlated(spark, sf), _CORRELATED)


@query(
    "corr_matrix",
    oracle(
        f"SELECT feature1, feature2, {r6('c')} AS correlation FROM pairs", "feats",
        extra={"pairs": _PAIRS_SQL},
    ),
)
def corr_matrix(spark, sf):
    return correlate.correlation_matrix(_correlated(spark, sf), _CORRELATED)


@query(
    "high_corr_pairs",
    oracle(
        f"SELECT feature1, feature2, {r6('c')} AS correlation FROM pairs WHERE abs(c) > 0.8", "feats",
        extra={"pairs": _PAIRS_SQL},
    ),
)
def high_corr_pairs(spark, sf):
    return correlate.high_correlation_pairs(
        correlate.correlation_matrix(_correlated(spark, sf), _CORRELATED)
    )


@query(
    "target_corr",
    oracle(
        f"""SELECT feature, {r6('c')} AS correlation, {r6('a')} AS abs_correlation, direction,
              row_number() OVER (PARTITION BY direction ORDER BY round(a, 9) DESC, feature) AS direction_rank
            FROM (SELECT *, CASE WHEN c > 0 THEN 'positive' WHEN c < 0 THEN 'negative' ELSE 'none' END
                    AS direction FROM target)""",
        "feats",
        extra={"target": _TARGET_SQL},
    ),
)
def target_corr(spark, sf):
    return _target(spark, sf)


@query(
    "predictor_bands",
    oracle(
        f"""SELECT feature, {r6('c')} AS correlation, {r6('a')} AS abs_correlation,
              CASE WHEN a > 0.05 THEN 'strong' WHEN a < 0.01 THEN 'weak' ELSE 'medium' END AS band
            FROM target""",
        "feats",
        extra={"target": _TARGET_SQL},
    ),
)
def predictor_bands(spark, sf):
    return correlate.predictor_bands(_target(spark, sf))


def _bin_sql(value: str, low: str, high: str, bins: int) -> str:
    return f"CAST(least(floor(({value} - {low}) / ({high} - {low}) * {bins}), {bins - 1}) AS BIGINT)"


@query(
    "corr_histogram",
    oracle(
        f"""SELECT b AS bin, {r6('lo + b * ((hi - lo) / 30)')} AS left_edge,
              {r6('lo + (b + 1) * ((hi - lo) / 30)')} AS right_edge, count(c) AS count
            FROM (SELECT unnest(range(30)) AS b, lo, hi
                  FROM (SELECT min(c) AS lo, max(c) AS hi FROM target)) edges
            LEFT JOIN target ON {_bin_sql('c', 'lo', 'hi', 30)} = b GROUP BY b, lo, hi""",
        "feats",
        extra={"target": _TARGET_SQL},
    ),
)
def corr_histogram(spark, sf):
    return correlate.correlation_histogram(_target(spark, sf))


# ---- amounts per class


def _hist_sql(inner: str, left: str, right: str) -> str:
    return f"""SELECT is_fraud, bin, {r6(left)} AS left_edge, {r6(right)} AS right_edge, n AS count,
      {r6(f"coalesce(n / nullif(sum(n) OVER (PARTITION BY is_fraud) * ({right} - {left}), 0), 0)")}
        AS density
      FROM (SELECT CAST(k AS BIGINT) AS is_fraud, b AS bin, lo, hi, count(v) AS n
            FROM (SELECT unnest([0, 1]) AS k) classes, (SELECT unnest(range(49)) AS b) bins, span
            LEFT JOIN ({inner}) AS vals ON vals.is_fraud = k AND v >= lo AND v <= hi
              AND {_bin_sql('v', 'lo', 'hi', 49)} = b
            GROUP BY k, b, lo, hi)"""


@query(
    "amount_histogram",
    oracle(
        _hist_sql(
            "SELECT is_fraud, amt AS v FROM txn",
            "(lo + bin * ((hi - lo) / 49))",
            "(lo + (bin + 1) * ((hi - lo) / 49))",
        ),
        "txn",
        extra={
            "span": """SELECT CAST(0 AS DOUBLE) AS lo, least(max(amt) FILTER (WHERE is_fraud = 0),
                         max(amt) FILTER (WHERE is_fraud = 1)) AS hi FROM txn"""
        },
    ),
)
def amount_histogram(spark, sf):
    return distribution.amount_histogram(transactions(spark, sf, ["amt", "is_fraud"]))


@query(
    "amount_histogram_log",
    oracle(
        _hist_sql(
            "SELECT is_fraud, log10(amt) AS v FROM txn WHERE amt > 0",
            "pow(10, lo + bin * ((hi - lo) / 49))",
            "pow(10, lo + (bin + 1) * ((hi - lo) / 49))",
        ),
        "txn",
        extra={
            "span": """SELECT min(log10(amt)) AS lo, max(log10(amt)) AS hi FROM txn WHERE amt > 0"""
        },
    ),
)
def amount_histogram_log(spark, sf):
    return distribution.amount_histogram_log(transactions(spark, sf, ["amt", "is_fraud"]))


@query(
    "amount_boxplot",
    oracle(
        f"""SELECT CAST(txn.is_fraud AS BIGINT) AS is_fraud, {r6('q25')} AS q25, {r6('q50')} AS q50,
              {r6('q75')} AS q75, {r6('min(amt)')} AS whisker_low, {r6('max(amt)')} AS whisker_high
            FROM txn JOIN boxes ON boxes.is_fraud = txn.is_fraud
            WHERE amt BETWEEN q25 - 1.5::DOUBLE * (q75 - q25) AND q75 + 1.5::DOUBLE * (q75 - q25)
            GROUP BY txn.is_fraud, q25, q50, q75""",
        "txn",
        extra={
            "boxes": """SELECT is_fraud, quantile_cont(amt, 0.25) AS q25, quantile_cont(amt, 0.5) AS q50,
                          quantile_cont(amt, 0.75) AS q75 FROM txn GROUP BY is_fraud"""
        },
    ),
)
def amount_boxplot(spark, sf):
    return distribution.amount_boxplot(transactions(spark, sf, ["amt", "is_fraud"]))


@query(
    "amount_cdf",
    oracle(
        f"""SELECT CAST(is_fraud AS BIGINT) AS is_fraud, {r6('amt')} AS amt, count(*) AS n,
              {r6('coalesce((min(i) - 1) / nullif(CAST(max(t) - 1 AS DOUBLE), 0), 0)')} AS cdf_first,
              {r6('coalesce((max(i) - 1) / nullif(CAST(max(t) - 1 AS DOUBLE), 0), 0)')} AS cdf_last
            FROM (SELECT is_fraud, amt, row_number() OVER (PARTITION BY is_fraud ORDER BY amt) AS i,
                    count(*) OVER (PARTITION BY is_fraud) AS t FROM txn) GROUP BY is_fraud, amt""",
        "txn",
    ),
)
def amount_cdf(spark, sf):
    return distribution.amount_cdf(transactions(spark, sf, ["amt", "is_fraud"]))


# ---- the same over computed amounts, which fall on all sides of the powers of two

_COMPUTED = "amt / CAST(3 AS DOUBLE) * CAST(0.7 AS DOUBLE)"


def computed_amounts(spark, sf):
    rows = transactions(spark, sf, ["amt", "is_fraud"])
    return rows.select("is_fraud", (F.col("amt") / F.lit(3.0) * F.lit(0.7)).alias("x"))


@query(
    "quantiles_computed",
    oracle(
        f"""SELECT 'x' AS "column", {", ".join(f"{r6(f'quantile_cont({_COMPUTED}, {p})')} AS q{round(p * 100):02d}"
                                             for p in (0.01, 0.25, 0.5, 0.75, 0.99))} FROM txn""",
        "txn",
    ),
)
def quantiles_computed(spark, sf):
    return ordered.quantiles(computed_amounts(spark, sf), ["x"], [0.01, 0.25, 0.5, 0.75, 0.99])


@query(
    "cdf_computed",
    oracle(
        f"""SELECT CAST(is_fraud AS BIGINT) AS is_fraud, {r6('x')} AS x, count(*) AS n,
              {r6('coalesce((min(i) - 1) / nullif(CAST(max(t) - 1 AS DOUBLE), 0), 0)')} AS cdf_first,
              {r6('coalesce((max(i) - 1) / nullif(CAST(max(t) - 1 AS DOUBLE), 0), 0)')} AS cdf_last
            FROM (SELECT is_fraud, x, row_number() OVER (PARTITION BY is_fraud ORDER BY x) AS i,
                    count(*) OVER (PARTITION BY is_fraud) AS t
                  FROM (SELECT is_fraud, {_COMPUTED} AS x FROM txn)) GROUP BY is_fraud, x""",
        "txn",
    ),
)
def cdf_computed(spark, sf):
    return distribution.amount_cdf(computed_amounts(spark, sf), column="x")


@query(
    "roc_auc_computed",
    oracle(
        f"""SELECT {r6("(sum(rk) FILTER (WHERE is_fraud = 1) - n1 * (n1 + 1) / CAST(2 AS DOUBLE)) / (n1 * n0)")} AS roc_auc
            FROM (SELECT is_fraud, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / CAST(2 AS DOUBLE) AS rk,
                    CAST(sum(is_fraud) OVER () AS DOUBLE) AS n1, CAST(sum(1 - is_fraud) OVER () AS DOUBLE) AS n0
                  FROM (SELECT is_fraud, {_COMPUTED} AS x FROM txn)) GROUP BY n1, n0""",
        "txn",
    ),
)
def roc_auc_computed(spark, sf):
    return evaluate.roc_auc(computed_amounts(spark, sf), label="is_fraud", score="x")


@query(
    "approx_quantiles",
    """SELECT 'amt' AS "column", 1 AS q25_close, 1 AS q50_close, 1 AS q75_close""",
)
def approx_quantiles(spark, sf):
    """Sketched quartiles of the amount lie within 1 % of the exact ones."""
    rows, probs = transactions(spark, sf, ["amt"]), (0.25, 0.5, 0.75)
    exact = ordered.quantiles(rows, ["amt"], probs).select(F.struct("q25", "q50", "q75")).scalar()
    found = ordered.approx_quantiles(rows, "amt", probs).withColumn("e", exact)
    near = [flag(F.abs(F.col(q) / F.col(f"e.{q}") - 1) < 0.01).alias(f"{q}_close") for q in ("q25", "q50", "q75")]
    return found.select("column", *near)
