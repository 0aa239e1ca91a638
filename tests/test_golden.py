"""Small published tables and the figures that must follow from them."""

import pytest
from pyspark.sql import functions as F

from riskloom.functions.numbers import percent_rate
from riskloom.operators import evaluate, importance, risk, validate

# Positives and rows per hour of a full-size table.
HOURS = [
    (17245, 1126105), (16930, 1123924), (17165, 1124603), (17234, 1123475), (1307, 1108712), (1296, 1109885),
    (1317, 1109054), (1348, 1107048), (1275, 1109282), (1341, 1109311), (1324, 1107912), (1276, 1107863),
    (1866, 1764202), (1816, 1766359), (1910, 1764716), (1814, 1765295), (1846, 1765550), (1832, 1765038),
    (1826, 1762048), (1811, 1766274), (1899, 1766372), (1837, 1765286), (46594, 1809501), (45816, 1808563),
]
WEEK = [
    ("Monday", 21598, 3193503), ("Tuesday", 27569, 3629400), ("Wednesday", 27354, 3983150),
    ("Thursday", 24108, 4025616), ("Friday", 28833, 5863662), ("Saturday", 28947, 7132116),
    ("Sunday", 31516, 6808931),
]
MODELS = [
    ("Random Forest", 10307, 28832, 1960201, 660, 0.985254, 0.2633434681519712, 0.9398194583751254, 0.4114078154312857),
    ("XGBoost", 10740, 34677, 1954356, 227, 0.982548, 0.2364753286214413, 0.9793015409865962, 0.38095913734392733),
    ("LightGBM", 10191, 137099, 1851934, 776, 0.9310625, 0.06919003326770318, 0.9292422722713596, 0.12879051161271361),
]


@pytest.fixture()
def hourly(spark):
    df = spark.createDataFrame(
        [(h, f, t) for h, (f, t) in enumerate(HOURS)], "hour int, fraud_count long, total_count long"
    )
    return df.withColumn("fraud_rate", percent_rate(F.col("fraud_count"), F.col("total_count")))


def test_hour_rates_peak_and_pattern(spark, hourly):
    rates = {r["hour"]: r["fraud_rate"] for r in hourly.collect()}
    assert rates[22] == 2.575 and rates[13] == 0.103 and rates[10] == 0.12
    weekly = spark.createDataFrame(WEEK, "weekday string, fraud_count long, total_count long").withColumn(
        "fraud_rate", percent_rate(F.col("fraud_count"), F.col("total_count"))
    )
    peak = risk.peak_hours(hourly, weekly).first()
    # hours 13, 15 and 19 share the lowest rate: the first one counts
    assert (peak["peak_hour"], peak["lowest_hour"], peak["peak_day"]) == (22, 13, "Tuesday")
    pattern = risk.night_day_pattern(hourly).first()
    assert round(pattern["night_rate"], 3) == 1.055 and round(pattern["business_rate"], 3) == 0.109
    assert pattern["pattern"] == "night"


def test_hours_without_rows_appear_as_zero(spark, hourly):
    full = risk.all_hours(hourly.filter("hour < 20")).collect()
    assert len(full) == 24 and sum(r["fraud_count"] for r in full) == sum(f for f, _ in HOURS[:20])


@pytest.mark.parametrize("row", MODELS, ids=[m[0] for m in MODELS])
def test_class_metrics_follow_from_the_confusion_counts(spark, row):
    _, tp, fp, tn, fn, accuracy, precision, recall, _ = row
    matrix = spark.createDataFrame([(tn, fp, fn, tp)], "tn long, fp long, fn long, tp long")
    got = evaluate.class_metrics(matrix).first()
    assert got["accuracy"] == pytest.approx(accuracy)
    assert got["precision"] == pytest.approx(precision)
    assert got["recall"] == pytest.approx(recall)


def test_best_model_depends_on_the_measure(spark):
    table = spark.createDataFrame(
        [(m[0], m[8], auc) for m, auc in zip(MODELS, (0.9959443, 0.9984286, 0.9312689))],
        "model_name string, f1_score double, roc_auc double",
    )
    def best(by):
        return evaluate.model_comparison(table, by).filter("is_best = 1").first()["model_name"]

    assert best("f1_score") == "Random Forest" and best("roc_auc") == "XGBoost"


def test_business_metrics(spark):
    matrix = spark.createDataFrame([(12844631, 9764, 2099, 76498)], "tn long, fp long, fn long, tp long")
    got = evaluate.business_metrics(matrix).first()
    assert got["caught_rate"] == pytest.approx(97.32941460870008)
    assert got["false_alarm_rate"] == pytest.approx(0.07595845623228475)


def test_undefined_metrics_are_zero(spark):
    matrix = spark.createDataFrame([(10, 0, 0, 0)], "tn long, fp long, fn long, tp long")
    got = evaluate.class_metrics(matrix).first()
    assert (got["accuracy"], got["precision"], got["recall"], got["f1_score"]) == (1.0, 0.0, 0.0, 0.0)


def test_generalisation_verdict(spark):
    names = "part string, accuracy double, precision double, recall double, f1_score double, roc_auc double"
    table = spark.createDataFrame(
        [("test", 0.9991, 0.887, 0.972, 0.928, 0.9996), ("unseen", 0.99908, 0.88681, 0.97329, 0.92804, 0.99963)],
        names,
    )
    rows = validate.compare_metrics(table, "part", "test", "unseen").collect()
    assert len(rows) == 5 and {r["verdict"] for r in rows} == {"excellent"}


@pytest.fixture()
def ranked(spark):
    # ten features whose shares fall by half, two models
    tall = [(m, f"f{i}", w * 2.0**-i) for m, w in (("a", 1.0), ("b", 3.0)) for i in range(10)]
    return importance.rank_importance(spark.createDataFrame(tall, "model string, feature string, value double"), ["a", "b"])


def test_importance_shares_and_selection(spark, ranked):
    rows = ranked.collect()
    assert [r["feature"] for r in rows] == [f"f{i}" for i in range(10)]
    assert sum(r["average"] for r in rows) == pytest.approx(100)
    assert importance.importance_summary(ranked).first()["top10_share"] == pytest.approx(100)
    needed = importance.features_needed(importance.cumulative_importance(ranked)).first()
    assert (needed["n_80"], needed["n_90"], needed["n_95"]) == (3, 4, 5)
    report = importance.selection_report(ranked, 4).first()
    assert (report["n_features_selected"], report["n_features_dropped"]) == (4, 6)
    assert report["importance_captured"] + report["importance_lost"] == pytest.approx(100)
    assert [r["rank"] for r in importance.next_dropped(ranked, 4, 3).collect()] == [5, 6, 7]


def test_tuning_history(spark):
    trials = spark.createDataFrame(
        [(0, 0.5, 1.0, None), (1, 0.9, 2.0, 5.0), (2, 0.9, 2.0, 5.0), (3, 0.7, 1.5, 5.0)],
        "number int, value double, params_depth double, params_flat double",
    )
    best = importance.running_best(trials).orderBy("number").collect()
    assert [r["best_so_far"] for r in best] == [0.5, 0.9, 0.9, 0.9]
    assert [r["is_best"] for r in best] == [0, 1, 0, 0]
    # the constant parameter has no correlation and is left out
    found = importance.param_importance(trials).collect()
    assert [r["param"] for r in found] == ["depth"] and found[0]["importance"] > 0.9
