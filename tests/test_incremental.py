"""Bounded summaries, mergeable profiles, permutation, footers, lookups in one pass, streams that are stopped and restarted."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from riskloom.plans.catalog import incremental as catalog
from riskloom.operators import cleanse, encode, heavy, mergeable, permutation, prepare, sampling
from riskloom.operators.boosting import Params, fit
from riskloom.session import artefact, drop_artefact
from riskloom.sources import files
from riskloom.streaming import incremental, jobs

# ---- heavy hitters


def values_frame(spark, parts=6):
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        hot = f"hot{min(int(rng.expovariate(0.5)), 30)}"
        rows.append((hot if rng.random() < 0.4 else f"rare{rng.randrange(4000)}", f"u{i}", rng.choice(["x", "y", None]), None))
    return spark.createDataFrame(rows, "skewed string, own string, few string, none string").repartition(parts)


@pytest.mark.parametrize("counters", [4, 40, 5000])
@pytest.mark.parametrize("top_n", [1, 5, 40])
def test_heavy_values_equal_full_counts(spark, counters, top_n):
    df = values_frame(spark)
    names = ["skewed", "own", "few", "none"]
    got = {(r.column, r.value, r["count"], r["rank"]) for r in heavy.heavy_values(df, names, top_n, counters).collect()}
    want = {(r.column, r.value, r["count"], r["rank"]) for r in prepare.top_values(df, names, top_n).collect()}
    assert got == want


def test_summary_errors_bound_what_is_missed(spark):
    df = values_frame(spark)
    true = Counter(r.skewed for r in df.collect())
    rows = heavy.summaries(df, ["skewed"], 20).collect()
    error = sum(r.error for r in rows)
    low = Counter()
    for r in rows:
        if r.value is not None:
            low[r.value] += r["count"]
    assert all(true[v] - error <= low[v] <= true[v] for v in true)
    per_task = Counter()
    for r in df.select(F.spark_partition_id().alias("p")).distinct().collect():
        per_task[r.p] += 1
    assert len(rows) <= 21 * len(per_task)


def test_heavy_values_of_empty_and_unknown(spark):
    df = values_frame(spark)
    assert heavy.heavy_values(df.limit(0), ["skewed"], 3).count() == 0
    assert heavy.heavy_values(df, ["absent"], 3).count() == 0
    assert heavy.heavy_values(df, ["none"], 3).count() == 0


# ---- mergeable profile


def test_merged_states_equal_the_whole(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(float(v), None if i % 5 == 0 else i % 300, i % 3) for i, v in enumerate(rng.normal(50, 9, 9000))]
    df = spark.createDataFrame(rows, "x double, k long, part int")
    whole = {r.column: r for r in mergeable.profile_of(mergeable.file_states(df, ["x", "k"], by="part").filter("source is not null")).collect()}
    exact = np.array([r[0] for r in rows])
    x, k = whole["x"], whole["k"]
    assert (x.rows, x.missing, k.missing) == (9000, 0, 1800)
    assert x.mean == pytest.approx(exact.mean()) and x.std == pytest.approx(exact.std()) and (x.min, x.max) == (exact.min(), exact.max())
    for p, got in ((0.25, x.about_q25), (0.5, x.about_q50), (0.75, x.about_q75)):
        assert abs((exact <= got).mean() - p) < 0.01
    assert abs(k.about_distinct - 240) <= 8 and abs(x.about_distinct - 9000) < 400
    store, folder = mergeable.ProfileStore(spark, str(tmp_path / "states"), ["x", "k"]), str(tmp_path / "rows")
    with pytest.raises(ValueError):
        store.profile()
    for part in range(3):
        df.filter(F.col("part") == part).coalesce(1).write.mode("append").parquet(folder)
        assert store.refresh(folder) == 1 and store.refresh(folder) == 0
    stored = {r.column: r for r in store.profile().collect()}
    assert (stored["x"].rows, stored["k"].missing) == (9000, 1800)
    assert stored["x"].mean == pytest.approx(x.mean) and stored["x"].std == pytest.approx(x.std)


def test_a_folder_of_several_files_is_one_source(spark, tmp_path):
    store, folder = mergeable.ProfileStore(spark, str(tmp_path / "states"), ["x"], folders=True), str(tmp_path / "rows")
    for part in range(2):
        spark.range(part * 1000, part * 1000 + 1000, 1, 3).select(F.col("id").cast("double").alias("x")).write.parquet(f"{folder}/{part}")
        assert store.refresh(folder) == 1 and store.refresh(folder) == 0
    assert store.states().select("source").distinct().count() == 2
    row = store.profile().first()
    assert (row.rows, row.min, row.max, row["mean"]) == (2000, 0.0, 1999.0, 999.5)


def test_profile_merged_writes_its_parts_with_many_tasks(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name, kept=False: made.append(f"{tmp_path}/{name}") or made[-1])
    rows = spark.range(0, 6000, 1, 4).selectExpr(
        "cast(id % 50 as double) l_quantity", "id / 7 l_extendedprice", "0.1D l_discount", "id % 90 l_partkey", "id l_orderkey"
    )
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    assert {r.sources for r in catalog.profile_merged(spark, str(tmp_path)).collect()} == {3}
    parts = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/lineitem-parts").inputFiles()
    assert len(parts) > 3


def test_profile_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "x double, part int")
    row = mergeable.profile_of(mergeable.file_states(df, ["x"], by="part")).first()
    assert (row.rows, row.missing, row.mean, row.about_q50) == (2, 2, None, None)
    assert mergeable.profile_of(mergeable.file_states(df.limit(0), ["x"], by="part")).count() == 0


# ---- permutation


def test_lenders_are_a_permutation_and_unused_features_lose_nothing(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(a > 0), float(a), float(n), None if i % 4 else 1.0) for i, (a, n) in enumerate(rng.normal(size=(2500, 2)))]
    df = spark.createDataFrame(rows, "trans_num long, is_fraud int, a double, noise double, mostly double")
    lent = permutation.with_lenders(df, ["a", "noise", "mostly"], parts=3).collect()
    assert sorted(r.a for r in lent) == sorted(r.a_lent for r in lent)
    assert sum(r.mostly_lent is None for r in lent) == sum(r.mostly is None for r in lent)
    assert sum(r.a == r.a_lent for r in lent) == 0 and all((r.a, r.noise) != (r.a_lent, r.noise_lent) for r in lent)
    model = fit(df, ["a", "noise", "mostly"], Params(rounds=3, max_depth=2), "trans_num")
    used = {model.bins.features[f] for t in model.trees for f in t.feature.values()}
    loss = {r.feature: r.loss for r in permutation.model_importance(model, df).collect()}
    assert loss["a"] > 0.3
    assert all(loss[f] == 0 for f in loss if f not in used)


# ---- footers, lookups, artefacts


def test_footer_facts_read_no_rows(spark):
    df = files.footer_facts(spark, "/root/testdata/sf0.001/lineitem.parquet", ["l_orderkey"])
    plan = df._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*), MIN(l_orderkey), MAX(l_orderkey)]" in plan
    row = df.first()
    want = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").agg(F.count("*"), F.min("l_orderkey"), F.max("l_orderkey")).first()
    assert tuple(row) == tuple(want)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_labels_of_all_columns_in_one_pass(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("abc"), rng.randrange(900), rng.choice(["p", None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, a string, b int, c string")
    vocabulary = encode.fit_labels(df.filter("id < 2500"), ["a", "b", "c"])
    mapped = encode.label_encode(df, vocabulary, ["a", "b", "c"])
    joined = encode.label_encode(df, vocabulary, ["a", "b", "c"], map_limit=0)
    names = ["id", "a_encoded", "b_encoded", "c_encoded"]
    assert sorted(mapped.select(names).collect()) == sorted(joined.select(names).collect())
    assert mapped.filter("b_encoded < 0").count() < 200
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = mapped._jdf.queryExecution().optimizedPlan().toString()
        outside = [line for line in plan.split("\n") if line.lstrip(" :+-").startswith("Join")]
        assert not outside
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_artefacts_follow_the_files_of_their_source(spark, tmp_path):
    folder, made = str(tmp_path / "in"), []

    def make(path):
        made.append(path)

    spark.range(3).write.parquet(folder)
    first = artefact(spark, folder, "thing", make)
    assert artefact(spark, folder, "thing", make) == first and len(made) == 1
    spark.range(3).write.mode("append").parquet(folder)
    assert artefact(spark, folder, "thing", make) != first and len(made) == 2
    assert drop_artefact(folder, "other") == 0 and drop_artefact(folder) == 2
    artefact(spark, folder, "thing", make)
    assert len(made) == 3


# ---- streams


def stream_rows(spark):
    rng = random.Random(11)
    rows = [(i, i // 10 * 10, rng.choice(["k1", "k2", None, f"k{i}"]), rng.randrange(3), int(rng.random() < 0.1)) for i in range(1200)]
    return spark.createDataFrame(rows, "trans_num long, at long, a string, b int, is_fraud int")


def write_files(df, folder, low, high):
    for n in range(low, high):
        df.filter(F.col("trans_num") % 6 == n).coalesce(1).write.mode("append").parquet(folder)


def test_keep_first_over_files_and_a_restart_equals_the_batch(spark, tmp_path):
    df = stream_rows(spark)
    folder, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def go():
        stream = jobs.file_stream(spark, folder, df.schema, files_per_batch=1)
        incremental.run_keep_first(stream, target, state, key=["a", "b"], order_by="trans_num")

    for low, high in ((0, 250), (250, 600), (600, 1200)):  # files follow each other, with a restart between
        df.filter(f"trans_num >= {low} AND trans_num < {high}").repartitionByRange(2, "trans_num").write.mode("append").parquet(folder)
        go()
    go()
    got = sorted(tuple(r) for r in incremental.kept_rows(spark, target).select(df.columns).collect())
    assert len(got) == len({r[2:4] for r in got})
    whole = sorted(tuple(r) for r in cleanse.drop_duplicates_keep_first(df, ["a", "b"], "trans_num").collect())
    assert {r[2:4] for r in got} == {r[2:4] for r in whole} and len(got) == len(whole)


def test_keep_first_repeats_a_batch_without_doubling(spark, tmp_path):
    df = stream_rows(spark)
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    df.repartitionByRange(3, "trans_num").write.parquet(folder)
    for attempt in ("first", "again"):  # a lost checkpoint hands in all batches once more
        stream = jobs.file_stream(spark, folder, df.schema, files_per_batch=1)
        incremental.run_keep_first(stream, target, str(tmp_path / attempt), key=["a", "b"], order_by="trans_num")
    got = incremental.kept_rows(spark, target)
    assert got.count() == df.select("a", "b").distinct().count()


def test_keep_first_forgets_keys_beyond_the_window(spark, tmp_path):
    rows = [(0, 0, "k"), (1, 50, "k"), (2, 500, "k")]
    df = spark.createDataFrame(rows, "trans_num long, at long, a string")
    folder, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for i in range(3):
        df.filter(F.col("trans_num") == i).coalesce(1).write.mode("append").parquet(folder)
        stream = jobs.file_stream(spark, folder, df.schema)
        incremental.run_keep_first(stream, target, state, key=["a"], order_by="trans_num", clock="at", window=100)
    assert sorted(r.trans_num for r in incremental.kept_rows(spark, target).collect()) == [0, 2]


@pytest.mark.parametrize("order", [(0, 6), (5, -1)])
def test_sample_over_files_in_any_order_equals_the_batch(spark, tmp_path, order):
    df = stream_rows(spark)
    folder, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    steps = range(6) if order[0] == 0 else range(5, -1, -1)
    for n in steps:
        write_files(df, folder, n, n + 1)
        if n in (0, 3, 5):  # restarts
            incremental.run_sample(jobs.file_stream(spark, folder, df.schema, files_per_batch=1), target, state, 100)
    incremental.run_sample(jobs.file_stream(spark, folder, df.schema, files_per_batch=1), target, state, 100)
    got = sorted(tuple(r) for r in incremental.current_sample(spark, target, 100).select(df.columns).collect())
    want = sorted(tuple(r) for r in sampling.stratified_sample(df, 100).collect())
    assert got == want and len(got) == 100
