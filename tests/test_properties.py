"""Properties checked against brute force on small frames."""

import math
import os
import random
import struct

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskloom import session
from riskloom.functions.numbers import sample_hash, value_bins
from riskloom.operators import (
    cleanse, correlate, distribution, encode, evaluate, ordered, prepare, sampling, validate,
)
from riskloom.sources.transactions import derive, transactions

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    frame = transactions(spark, SF_DIR).cache()
    yield frame
    frame.unpersist()


def labelled(spark, n, positives, seed=1):
    rng = random.Random(seed)
    marks = [1] * positives + [0] * (n - positives)
    rng.shuffle(marks)
    return spark.createDataFrame(
        [(rng.getrandbits(40), m) for m in marks], "trans_num long, is_fraud int"
    ).cache()


VALUES = {
    "mixed": [-1e9, -3.5, -3.5, -1e-12, 0.0, 0.0, 1e-300, 2.0, 4.0, 8.0, 7.999999999999999, 1e18, 5.0],
    "hot": [5.0] * 500 + [1.0, 2.0, 9.0, 10.0],
    "near_powers": [float(np.nextafter(2.0**k, s * 1e308)) for k in range(-20, 20) for s in (-1, 1)]
    + [2.0**k for k in range(-20, 20)],
    "normal": [float(x) for x in np.random.default_rng(7).normal(0, 50, 997)],
    "single": [3.25],
}


@pytest.mark.parametrize("name", list(VALUES))
def test_quantiles_equal_linear_interpolation(spark, name):
    values = VALUES[name]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]
    found = ordered.quantiles(df, ["x"], probs).first()
    for p in probs:
        assert found[ordered.quantile_name(p)] == pytest.approx(np.quantile(values, p), rel=1e-12)


@pytest.mark.parametrize("name", list(VALUES))
def test_bins_keep_the_order_and_totals_are_exact(spark, name):
    counts = {}
    for v in VALUES[name]:
        counts[v] = counts.get(v, 0) + 1
    df = spark.createDataFrame(list(counts.items()), "v double, n long")
    got = {r["v"]: (r["n_before"], r["n_all"]) for r in ordered.running_totals(df, "n", "v").collect()}
    before = 0
    for v in sorted(counts):
        assert got[v] == (before, len(VALUES[name]))
        before += counts[v]


@pytest.mark.parametrize("seed", range(3))
def test_roc_auc_equals_the_ml_evaluator(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice([0, 1]), rng.choice([0.1, 0.1001, 0.5, rng.random(), rng.random() * 1e-6])) for _ in range(400)]
    df = spark.createDataFrame(data, "label int, score double")
    want = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(
        df.withColumn("label", F.col("label").cast("double"))
    )
    assert evaluate.roc_auc(df).first()["roc_auc"] == pytest.approx(want, abs=1e-12)


def test_roc_auc_needs_both_classes(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.7)], "label int, score double")
    assert evaluate.roc_auc(df).first()["roc_auc"] is None


def test_threshold_counts_equal_brute_force(spark):
    rng = random.Random(3)
    data = [(rng.choice([0, 1]), rng.choice([k / 99 for k in range(100)] + [rng.random()])) for _ in range(500)]
    data += [(1, 1.0), (0, 0.0), (1, -0.5), (0, 1.7)]
    df = spark.createDataFrame(data, "label int, score double")
    for row in evaluate.threshold_counts(df).collect():
        t = row["threshold"]
        assert row["tp"] == sum(1 for y, s in data if y == 1 and s >= t)
        assert row["fp"] == sum(1 for y, s in data if y == 0 and s >= t)
        assert row["positives"] == sum(y for y, _ in data)


def test_metrics_table_per_group_equals_single_tables(spark):
    rng = random.Random(5)
    data = [(m, rng.choice([0, 1]), rng.random()) for m in ("a", "b") for _ in range(200)]
    df = spark.createDataFrame(data, "m string, label int, score double").withColumn(
        "pred", (F.col("score") >= 0.5).cast("int")
    )
    grouped = {r["m"]: r.asDict() for r in evaluate.metrics_table(df, ["m"]).collect()}
    for m in ("a", "b"):
        alone = evaluate.metrics_table(df.filter(F.col("m") == m)).first().asDict()
        for key, value in alone.items():
            assert grouped[m][key] == pytest.approx(value)


@pytest.mark.parametrize("size", [0, 1, 10, 250, 999, 1000, 5000])
def test_stratified_sample_has_the_exact_size(spark, size):
    df = labelled(spark, 1000, 80)
    sample = sampling.stratified_sample(df, size).collect()
    fraud = min(int(size * 0.08), 80)
    legit = min(size - int(size * 0.08), 920)
    assert sum(r["is_fraud"] for r in sample) == fraud
    assert len(sample) == fraud + legit
    assert len({r["trans_num"] for r in sample}) == len(sample)


def test_sample_with_one_hash_for_many_rows_stays_exact(spark):
    # ids that agree modulo 2^31 share one hash value
    df = spark.range(3000).select((F.col("id") * 2147483648).alias("trans_num"), (F.col("id") % 3 == 0).cast("int").alias("is_fraud"))
    assert sampling.stratified_sample(df, 300).count() == 300


def test_sample_does_not_depend_on_partitioning(spark):
    df = labelled(spark, 500, 60)
    one = {r[0] for r in sampling.stratified_sample(df.coalesce(1), 100).select("trans_num").collect()}
    many = {r[0] for r in sampling.stratified_sample(df.repartition(7), 100).select("trans_num").collect()}
    assert one == many


def test_split_is_complete_and_keeps_the_class_shares(spark):
    df = labelled(spark, 1003, 77)
    split = sampling.stratified_split(df, 0.2).collect()
    assert len(split) == 1003
    for label, n in ((1, 77), (0, 926)):
        test = sum(1 for r in split if r["is_fraud"] == label and r["split"] == "test")
        assert abs(test - 0.2 * n) <= 1


def test_cap_keeps_small_tables_whole(spark):
    df = labelled(spark, 100, 7)
    assert sampling.stratified_cap(df, 100).count() == 100
    assert sampling.stratified_cap(df, 40).count() == 40


def test_dedup_keeps_the_first_and_is_idempotent(spark, rows):
    once = cleanse.drop_duplicates_keep_first(rows)
    assert once.count() == 1000
    assert once.agg(F.max("trans_num")).first()[0] < 10_000_000
    assert cleanse.drop_duplicates_keep_first(once).count() == 1000


def test_dedup_treats_null_as_equal_and_survives_a_hot_key(spark):
    data = [(i, None, 1.0) for i in range(400)] + [(1000 + i, i, 2.0) for i in range(300)]
    df = spark.createDataFrame(data, "trans_num long, cc_num long, amt double")
    kept = cleanse.drop_duplicates_keep_first(df, ["cc_num", "amt"])
    assert kept.count() == 301
    assert kept.filter("cc_num IS NULL").first()["trans_num"] == 0


def test_unseen_rows_treat_null_as_equal(spark):
    full = spark.createDataFrame([(1, None), (2, 5.0), (3, None), (4, 6.0)], "trans_num int, x double")
    train = spark.createDataFrame([(9, None), (9, 5.0)], "trans_num int, x double")
    assert [r["trans_num"] for r in validate.unseen_rows(full, train, ["x"]).collect()] == [4]


def test_onehot_rows_sum_to_one_or_zero(spark, rows):
    columns = ("gender", "category")
    vocabulary = encode.collect_vocabulary(encode.onehot_vocabulary(rows, columns))
    with_null = rows.withColumn("gender", F.when(F.col("trans_num") % 7 != 0, F.col("gender")))
    encoded = encode.onehot_encode(with_null, vocabulary)
    names = [c for c in encoded.columns if c.startswith("gender_")]
    sums = encoded.select(sum(F.col(c) for c in names).alias("s"), "trans_num").collect()
    assert all(r["s"] == (0 if r["trans_num"] % 7 == 0 else 1) for r in sums)


def test_onehot_has_no_limit(spark):
    many = spark.range(2000).selectExpr("id", "concat('v', id) AS street", "if(id % 2 = 0, 'a', NULL) AS gender")
    vocabulary = encode.collect_vocabulary(encode.onehot_vocabulary(many, ["street"]))
    assert len(vocabulary["street"]) == 2000
    wide = encode.onehot_encode(many.filter("id < 3"), vocabulary)
    assert len(wide.columns) == 2002
    labels = encode.fit_labels(many.filter("id < 1990"), ["street", "gender"])
    vectors = encode.onehot_vectors(many, labels, ["street", "gender"])
    assert vectors.columns == ["id", "street_onehot", "gender_onehot"]
    for row in vectors.collect():
        assert row.street_onehot.size == 1990 and row.street_onehot.numNonzeros() == (row.id < 1990)
        assert row.gender_onehot.size == 2 and row.gender_onehot.numNonzeros() == 1


def test_label_codes_are_dense_and_sorted(spark, rows):
    codes = encode.fit_labels(rows.select("city", "profile", "zip")).collect()
    for column in ("city", "profile", "zip"):
        mine = sorted((r["code"], r["value"]) for r in codes if r["column"] == column)
        assert [c for c, _ in mine] == list(range(len(mine)))
        values = [v for _, v in mine]
        assert values == (sorted(values, key=int) if column == "zip" else sorted(values))
    assert any(r["value"] == "unknown" for r in codes if r["column"] == "profile")


def test_unseen_label_gets_minus_one(spark, rows):
    labels = encode.fit_labels(rows.select("city"), ["city"])
    new = spark.createDataFrame([("Atlantis",), ("City 1",)], "city string")
    got = [r[0] for r in encode.label_encode(new, labels, ["city"]).collect()]
    assert sorted(got)[0] == -1 and sorted(got)[1] >= 0


def test_histogram_keeps_every_value_in_range(spark, rows):
    hist = distribution.amount_histogram(rows).collect()
    assert len(hist) == 98
    top = rows.groupBy("is_fraud").agg(F.max("amt").alias("m")).agg(F.min("m")).first()[0]
    for label in (0, 1):
        inside = rows.filter((F.col("is_fraud") == label) & F.col("amt").between(0, top)).count()
        assert sum(r["count"] for r in hist if r["is_fraud"] == label) == inside
        area = sum(r["density"] * (r["right_edge"] - r["left_edge"]) for r in hist if r["is_fraud"] == label)
        assert area == pytest.approx(1.0)


def test_cdf_runs_from_zero_to_one(spark, rows):
    cdf = distribution.amount_cdf(rows).filter("is_fraud = 0").orderBy("amt").collect()
    assert cdf[0]["cdf_first"] == 0.0 and cdf[-1]["cdf_last"] == 1.0
    assert all(a["cdf_last"] < b["cdf_first"] for a, b in zip(cdf, cdf[1:]))


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "job string")
    top = prepare.top_values(df, ["job"], 2).orderBy("rank").collect()
    assert [(r["value"], r["count"]) for r in top] == [("c", 2), ("a", 1)]


def test_haversine_of_known_distance(spark):
    from riskloom.functions.geo import haversine_km

    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (52.5, 13.4, 48.9, 2.35)], "a double, b double, c double, d double")
    far, near = [r[0] for r in df.select(haversine_km(*map(F.col, "abcd"))).collect()]
    assert far == pytest.approx(math.pi * 6371)
    assert near == pytest.approx(878, abs=5)


def test_text_row_ids_can_be_sampled(spark):
    df = labelled(spark, 600, 60).withColumn("trans_num", F.concat(F.lit("t-"), F.col("trans_num")))
    sample = sampling.stratified_sample(df, 100).collect()
    assert len(sample) == 100 and sum(r["is_fraud"] for r in sample) == 10


def test_hot_bucket_of_copies_is_counted_once_per_value(spark):
    # a third of all rows share one amount; quantiles and the distribution stay exact
    data = [(0, 9.99)] * 300 + [(0, float(i)) for i in range(600)]
    df = spark.createDataFrame(data, "is_fraud int, amt double")
    values = sorted(v for _, v in data)
    assert ordered.quantiles(df, ["amt"], [0.5]).first()["q50"] == pytest.approx(np.quantile(values, 0.5))
    hot = distribution.amount_cdf(df).filter("amt = 9.99").first()
    assert hot["n"] == 300 and hot["cdf_first"] == pytest.approx(10 / 899)


def test_sketched_quantiles_are_close(spark):
    df = spark.range(10001).select(F.col("id").cast("double").alias("x"))
    row = ordered.approx_quantiles(df, "x", [0.25, 0.5]).first()
    assert row["q25"] == pytest.approx(2500, abs=5) and row["q50"] == pytest.approx(5000, abs=5)


def ordered_bins(spark, values):
    rows = spark.createDataFrame([(float(v),) for v in values], "value double")
    return [tuple(r) for r in rows.withColumns(value_bins("value")).orderBy("value").select("_b1", "_b2", "value").collect()]


@pytest.mark.parametrize("seed", range(3))
def test_value_bins_keep_the_order_of_doubles(spark, seed):
    rng = random.Random(seed)
    values = [struct.unpack("d", rng.randbytes(8))[0] for _ in range(3000)]
    values = [v for v in values if v == v]
    for k in range(-300, 301, 7):  # values within the bins beside a power of two, and its neighbours
        p = 2.0**k
        values += [p, math.nextafter(p, 0), math.nextafter(p, math.inf), p * 0.9999, p * 0.999, p * 0.99, p * 0.985, p * 1.001, -p, -p * 0.9999]
    bins = ordered_bins(spark, values)
    assert [b[:2] for b in bins] == sorted(b[:2] for b in bins)


def test_area_and_quantiles_beside_a_power_of_two(spark):
    low = (0.1 + 0.7) * 10  # 7.999999999999999
    scored = spark.createDataFrame([(0, 7.9), (0, 7.95), (0, 7.99), (1, low)], "label int, score double")
    assert evaluate.roc_auc(scored).first()["roc_auc"] == 1.0
    values = spark.createDataFrame([(v,) for v in (7.9, 7.95, 7.99, low, 8.5)], "x double")
    row = ordered.quantiles(values, ["x"], [0.25, 0.5, 0.75]).first()
    assert (row.q25, row.q50, row.q75) == (7.95, 7.99, low)


def test_sampling_hash_spreads_ids_and_seeds(spark):
    ids = spark.range(100_000)
    by_seed = {s: {r.id for r in ids.filter(sample_hash(ids, "id", s) < int(0.02 * 2**32)).collect()} for s in (42, 43, 44, 100)}
    for s in (43, 44, 100):
        assert len(by_seed[42] & by_seed[s]) < 40 + 4 * 40**0.5 + 20  # 40 by chance
    for m in (97, 200, 233, 610):
        quarter = (sample_hash(ids, "id", 7) < 2**30).cast("int")
        shares = ids.groupBy((F.col("id") % m).alias("k")).agg(F.avg(quarter).alias("share"), F.count("*").alias("n")).collect()
        assert all(abs(r.share - 0.25) < 5.5 * (0.25 * 0.75 / r.n) ** 0.5 for r in shares)


def test_sampling_hash_tells_far_ids_apart(spark):
    ids = spark.range(2000).selectExpr("explode(array(id, id + (1L << 31), id + (1L << 32), id + (1L << 40), -id - 1)) AS id").distinct()
    assert ids.select(sample_hash(ids, "id").alias("h")).distinct().count() > 0.999 * ids.count()


def test_transaction_ids_stay_unique_where_the_old_offset_met_them(spark):
    events = spark.range(9_999_000, 10_001_000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id % 10 AS user_id", "'view' AS event_type", "1D AS value"
    )
    more = events.withColumn("event_id", F.col("event_id") - 9_999_000)
    rows = derive(events.union(more), None, None, ["trans_num"])
    assert rows.count() == rows.distinct().count() == 4000 + 20


def test_correlations_of_half_empty_columns(spark):
    names = [f"x{i}" for i in range(14)]
    rows = spark.range(3000).select(*[F.when(F.xxhash64("id", F.lit(i)) % 2 == 0, F.sin(F.col("id") * (i + 1))).alias(n) for i, n in enumerate(names)])
    found = correlate.correlation_matrix(rows, names)
    frame = rows.toPandas().corr()
    for r in found.collect():
        assert r.correlation == pytest.approx(frame.loc[r.feature1, r.feature2], abs=1e-9)
    plan = found._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "hashpartitioning" not in plan


def test_scratch_is_empty_after_a_scope(spark):
    with session.scratch_scope(spark):
        path = session.scratch_path(spark, "gone")
        spark.range(3).write.parquet(path)
        assert os.path.exists(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))
