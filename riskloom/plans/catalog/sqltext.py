"""Common table expressions for the oracle SQL (DuckDB dialect).

They restate, independently of the Spark code, the transactions table and the steps that follow it.
"""

from __future__ import annotations

from riskloom.functions.numbers import MIXING, WORD, seed_word

# Values present in the test tables; they name the one-hot columns.
CATEGORIES = ("click", "error", "purchase", "signup", "view")
STATES = tuple(f"nation_{i}" for i in range(25))
GENDERS = ("f", "m")
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

TOP_N = 20


def r6(expr: str) -> str:
    """Round to 6 digits, half to even."""
    return f"(round_even(CAST({expr} AS DOUBLE) * 1e6, 0) / 1e6)"


def r(expr: str, digits: int) -> str:
    return f"(round_even(CAST({expr} AS DOUBLE) * 1e{digits}, 0) / 1e{digits})"


def ratio(top: str, bottom: str) -> str:
    return f"coalesce(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0), 0)"


def rate(part: str, total: str) -> str:
    """Percentage with 3 digits."""
    return r(f"{ratio(part, total)} * 100", 3)


def hashed(row_id: str, seed: int = 42) -> str:

    def round_of(word: str, shift: int, factor: int) -> str:
        return f"((xor({word}, {word} >> {shift}) * {factor}) & {WORD})"

    upper = round_of(f"xor(({row_id} >> 32) & {WORD}, CAST({seed_word(seed)} AS BIGINT))", *MIXING[-1])
    mixed = f"xor({row_id} & {WORD}, {upper})"
    for shift, factor in MIXING:
        mixed = round_of(mixed, shift, factor)
    return f"xor({mixed}, {mixed} >> 16)"


def _text(col: str) -> str:
    stripped = f"regexp_replace(lower({col}), '[^a-z0-9\\s._-]', '', 'g')"
    return f"trim(regexp_replace({stripped}, '\\s+', ' ', 'g')) AS {col}"


_TEXT = ("\"first\"", "\"last\"", "gender", "street", "city", "state", "job", "dob", "category", "merchant")

HOUR = "CAST(nullif(regexp_extract(trans_time, '^([0-9][0-9]):[0-9][0-9]:[0-9][0-9]$', 1), '') AS BIGINT)"

VALID_POINTS = (
    "lat BETWEEN -90 AND 90 AND long BETWEEN -180 AND 180 "
    "AND merch_lat BETWEEN -90 AND 90 AND merch_long BETWEEN -180 AND 180"
)

DATE_PARTS = (
    "CAST(year(d) AS BIGINT) AS trans_year, CAST(month(d) AS BIGINT) AS trans_month, "
    "CAST(day(d) AS BIGINT) AS trans_day, dayname(d) AS trans_weekday"
)

TIME_FEATURES = """
  CASE WHEN trans_hour >= 23 OR trans_hour <= 6 THEN 1 ELSE 0 END AS is_night,
  CASE WHEN trans_weekday IN ('Saturday', 'Sunday') THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN trans_weekday NOT IN ('Saturday', 'Sunday') AND trans_hour BETWEEN 9 AND 17
       THEN 1 ELSE 0 END AS is_business_hours,
  sin(2.0::DOUBLE * pi() * trans_hour / 24) AS hour_sin,
  cos(2.0::DOUBLE * pi() * trans_hour / 24) AS hour_cos,
  trans_day AS day_of_month"""

_NIGHT = "hour(ts) IN (22, 23, 0, 1, 2, 3)"

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "src": (
        (),
        """SELECT 2 * event_id AS trans_num, * FROM events
           UNION ALL SELECT 2 * event_id + 1, * FROM events WHERE event_id % 200 = 0""",
    ),
    "txn": (
        ("src",),
        f"""SELECT trans_num, cc_num, ssn, acct_num, "first", "last", gender, street, city, state, zip,
              lat, long, city_pop, job, dob, profile, trans_date, trans_time, unix_time, category,
              merchant, amt,
              lat + (event_id % 200 - 100) / CAST(100.0 AS DOUBLE) AS merch_lat,
              long + (event_id % 200 - 100) / CAST(100.0 AS DOUBLE) AS merch_long, is_fraud
            FROM (
              SELECT trans_num, event_id, user_id AS cc_num,
                lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') || '-'
                  || lpad(CAST((user_id * 7) % 100 AS VARCHAR), 2, '0') || '-'
                  || lpad(CAST((user_id * 13) % 10000 AS VARCHAR), 4, '0') AS ssn,
                user_id + 1000000 AS acct_num,
                'First' || user_id AS "first", 'Last' || (user_id % 20) AS "last",
                CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
                user_id || ' Main St.' AS street, 'City ' || (user_id % 40) AS city, n_name AS state,
                10000 + (user_id * 37) % 90000 AS zip,
                CASE WHEN event_id % 499 = 0 THEN CAST(123.0 AS DOUBLE)
                     WHEN event_id % 503 = 0 THEN NULL
                     ELSE CAST(25.0 AS DOUBLE) + c_nationkey END AS lat,
                CAST(-120.0 AS DOUBLE) + 2 * c_nationkey AS long,
                500 + (user_id * 7919) % 100000 AS city_pop, c_mktsegment AS job,
                CASE WHEN user_id % 11 = 5 THEN 'n/a' WHEN user_id % 13 = 6 THEN '2030-01-01'
                     ELSE strftime(DATE '1930-01-01' + CAST((user_id * 211) % 27000 AS INTEGER),
                                   '%Y-%m-%d') END AS dob,
                CASE WHEN user_id % 17 <> 3
                     THEN 'Adults_' || (user_id % 12) || '_Urban.json' END AS profile,
                strftime(ts, '%Y-%m-%d') AS trans_date,
                CASE WHEN event_id % 491 = 0 THEN 'bad' ELSE strftime(ts, '%H:%M:%S') END AS trans_time,
                CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS unix_time,
                event_type AS category,
                'fraud_Shop #' || ((event_id % 97) * (event_id % 97) % 97) || ', & Sons' AS merchant,
                value AS amt,
                CASE WHEN ({_NIGHT} AND value > 100) OR (event_type = 'error' AND value > 200)
                     THEN 1 ELSE 0 END AS is_fraud
              FROM src LEFT JOIN customer ON c_custkey = user_id
                       LEFT JOIN nation ON n_nationkey = c_nationkey)""",
    ),
    "clean": (
        ("txn",),
        f"""SELECT * REPLACE ({", ".join(_text(c) for c in _TEXT)},
              trim(replace(replace(lower(profile), '.json', ''), '_', '')) AS profile,
              replace(ssn, '-', '') AS ssn) FROM txn""",
    ),
    "kept": (
        ("clean",),
        f"""SELECT * FROM (
              SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, value) AS rnk FROM (
                SELECT 'job' AS col, job AS value, count(*) AS n FROM clean
                WHERE job IS NOT NULL GROUP BY job
                UNION ALL
                SELECT 'merchant', merchant, count(*) FROM clean
                WHERE merchant IS NOT NULL GROUP BY merchant)) WHERE rnk <= {TOP_N}""",
    ),
    "reduced": (
        ("clean", "kept"),
        """SELECT * REPLACE (
              CASE WHEN job IN (SELECT value FROM kept WHERE col = 'job')
                   THEN job ELSE 'other' END AS job,
              CASE WHEN merchant IN (SELECT value FROM kept WHERE col = 'merchant')
                   THEN merchant ELSE 'other' END AS merchant) FROM clean""",
    ),
    "prepared": (
        ("reduced",),
        f"""SELECT * EXCLUDE (d), {DATE_PARTS}, {HOUR} AS trans_hour
            FROM (SELECT *, CAST(trans_date AS DATE) AS d FROM reduced) WHERE {VALID_POINTS}""",
    ),
    "timed": (
        ("txn",),
        f"""SELECT * EXCLUDE (d), {DATE_PARTS}, {HOUR} AS trans_hour
            FROM (SELECT *, CAST(trans_date AS DATE) AS d FROM txn)""",
    ),
    "placed": (("timed",), f"SELECT * FROM timed WHERE {VALID_POINTS}"),
    "raw_aged": (
        ("placed",),
        """SELECT *, CAST(round(date_diff('day', TRY_CAST(dob AS DATE), CAST(trans_date AS DATE))
              / CAST(365.25 AS DOUBLE)) AS BIGINT) AS raw_age FROM placed""",
    ),
    "aged": (
        ("raw_aged",),
        """SELECT * EXCLUDE (raw_age), CASE WHEN raw_age < 0 OR raw_age > 120
              THEN (SELECT CAST(floor(quantile_cont(raw_age, 0.5) + 0.5) AS BIGINT)
                    FROM raw_aged WHERE raw_age BETWEEN 0 AND 120)
              ELSE raw_age END AS age FROM raw_aged""",
    ),
    "marks": (
        ("aged",),
        """SELECT avg(amt) AS mean, stddev_samp(amt) AS std, quantile_cont(amt, 0.25) AS q25,
              quantile_cont(amt, 0.75) AS q75, quantile_cont(amt, 0.95) AS q95 FROM aged""",
    ),
    "flags": (
        ("aged", "marks"),
        f"""SELECT aged.*, {TIME_FEATURES},
              ln(1 + amt) AS amt_log, (amt - mean) / std AS amt_zscore,
              CASE WHEN amt > q95 THEN 1 ELSE 0 END AS is_high_value,
              CASE WHEN amt < 5 THEN 1 ELSE 0 END AS is_micro_transaction,
              CASE WHEN amt < q25 - 1.5::DOUBLE * (q75 - q25) OR amt > q75 + 1.5::DOUBLE * (q75 - q25)
                   THEN 1 ELSE 0 END AS is_outlier_iqr
            FROM aged, marks""",
    ),
    "feats": (
        ("flags",),
        """SELECT *, coalesce(amt / nullif(age, 0), 0) AS amt_per_age,
              is_night * is_high_value AS night_x_high_value,
              is_weekend * is_high_value AS weekend_x_high_value,
              is_outlier_iqr * is_night AS outlier_x_night,
              is_high_value * is_business_hours AS high_value_x_business_hours FROM flags""",
    ),
    "scored": (
        ("timed",),
        """SELECT trans_num, is_fraud AS label, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred
            FROM (SELECT *, least(CAST(1 AS DOUBLE), amt / CAST(500.0 AS DOUBLE) + CAST(0.3 AS DOUBLE)
                    * CASE WHEN trans_hour IN (22, 23, 0, 1, 2, 3) THEN 1 ELSE 0 END) AS score
                  FROM timed)""",
    ),
}


def oracle(body: str, *needed: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with the common table expressions it needs, in order of dependency."""
    chosen: list[str] = []

    def add(name: str) -> None:
        if name in chosen:
            return
        for other in CTES[name][0]:
            add(other)
        chosen.append(name)

    for name in needed:
        add(name)
    parts = [f"{name} AS ({CTES[name][1]})" for name in chosen]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
