"""The transactions table, derived from the ``events``, ``customer`` and ``nation`` tables.

Every event is one card transaction. A few rows carry the faults the preparation steps must survive
(bad times, missing or illegal coordinates, malformed and future birth dates, null profiles), and one
row in 200 comes a second time under a new row id.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.schema import RAW_SCHEMA

# Columns that need the customer table, and those that also need the nation table.
_FROM_CUSTOMER = {"job", "lat", "long", "merch_lat", "merch_long"}
_FROM_NATION = {"state"}

# Row id, and the wall-clock text of the event time, which no session time zone can change.
_BASE = (
    "*",
    """explode(if(event_id % 200 = 0, array(2 * event_id, 2 * event_id + 1), array(2 * event_id)))
       AS copy_id""",
    "cast(ts AS string) AS clock",
)

# How each column is made.
_MADE = {
    "trans_num": "copy_id",
    "cc_num": "user_id",
    "ssn": """concat_ws('-', lpad(cast(user_id % 1000 AS string), 3, '0'),
              lpad(cast(user_id * 7 % 100 AS string), 2, '0'),
              lpad(cast(user_id * 13 % 10000 AS string), 4, '0'))""",
    "acct_num": "user_id + 1000000",
    "first": "concat('First', user_id)",
    "last": "concat('Last', user_id % 20)",
    "gender": "if(user_id % 2 = 0, 'F', 'M')",
    "street": "concat(user_id, ' Main St.')",
    "city": "concat('City ', user_id % 40)",
    "state": "n_name",
    "zip": "10000 + user_id * 37 % 90000",
    "lat": """CASE WHEN event_id % 499 = 0 THEN 123D WHEN event_id % 503 = 0 THEN NULL
              ELSE 25D + c_nationkey END""",
    "long": "-120D + 2 * c_nationkey",
    "city_pop": "500 + user_id * 7919 % 100000",
    "job": "c_mktsegment",
    "dob": """CASE WHEN user_id % 11 = 5 THEN 'n/a' WHEN user_id % 13 = 6 THEN '2030-01-01'
              ELSE cast(date_add(DATE'1930-01-01', cast(user_id * 211 % 27000 AS int)) AS string) END""",
    "profile": "if(user_id % 17 != 3, concat('Adults_', user_id % 12, '_Urban.json'), NULL)",
    "trans_date": "substring(clock, 1, 10)",
    "trans_time": "if(event_id % 491 = 0, 'bad', substring(clock, 12, 8))",
    "unix_time": "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)",
    "category": "event_type",
    "merchant": "concat('fraud_Shop #', (event_id % 97) * (event_id % 97) % 97, ', & Sons')",
    "amt": "value",
    "merch_lat": """CASE WHEN event_id % 499 = 0 THEN 123D WHEN event_id % 503 = 0 THEN NULL
                    ELSE 25D + c_nationkey END + (event_id % 200 - 100) / 100D""",
    "merch_long": "-120D + 2 * c_nationkey + (event_id % 200 - 100) / 100D",
    "is_fraud": """if((substring(clock, 12, 2) IN ('22', '23', '00', '01', '02', '03') AND value > 100)
                      OR (event_type = 'error' AND value > 200), 1, 0)""",
}


def derive(
    events: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Transactions from an events frame (batch or stream). Joins that no wanted column needs are left
    out; the customer key is unique, so a left join never changes the rows."""
    wanted = set(columns) if columns is not None else set(RAW_SCHEMA.fieldNames())
    rows = events.selectExpr(*_BASE)
    if wanted & (_FROM_CUSTOMER | _FROM_NATION):
        people = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
        rows = rows.join(people, F.col("user_id") == F.col("c_custkey"), "left")
    if wanted & _FROM_NATION:
        # 25 rows at every scale
        places = F.broadcast(nation.select("n_nationkey", "n_name"))
        rows = rows.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.selectExpr(
        *[
            f"cast({_MADE[field.name]} AS {field.dataType.simpleString()}) AS `{field.name}`"
            for field in RAW_SCHEMA
            if field.name in wanted
        ]
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """All transactions of a data folder; ``columns`` narrows the scan and the joins."""
    return derive(
        read_table(spark, sf_dir, "events"),
        read_table(spark, sf_dir, "customer"),
        read_table(spark, sf_dir, "nation"),
        columns,
    )
