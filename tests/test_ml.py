import random
import threading

import pytest
from pyspark.sql import functions as F

from marketlens.ml import clv, encoding, repeat_purchase, segmentation


def temporal(spark, n=240):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        orders = rng.randint(1, 5)
        future = 0.0 if rng.random() < 0.6 else 20.0 * orders + rng.random()
        rows.append((i, i, f"2017-0{1 + i % 9}-01", rng.choice(["SP", "RJ"]) if i % 9 < 5 else "ZZ", "boleto", float(orders), future, int(future > 0)))
    df = spark.createDataFrame(rows, "customer_id long, customer_unique_id long, first_purchase_date string, customer_state string, obs_preferred_payment string, obs_frequency_orders double, target_future_clv double, target_repeat_buyer int")
    others = [c for c in encoding.NUMERIC if c != "obs_frequency_orders"]
    return df.withColumns({c: F.pmod(F.col("customer_id"), F.lit(7 + k)).cast("double") for k, c in enumerate(others)})


def test_unseen_category_is_all_zero(spark):
    df = temporal(spark)
    train, test = encoding.chronological_split(df, "2017-06-01")
    enc = encoding.fit_encoder(train)
    names = encoding.feature_names(enc)
    vec = encoding.encode(enc, test.filter("customer_state = 'ZZ'")).first()["features"]
    assert vec.size == len(names) == len(encoding.NUMERIC) + 3
    assert [vec[names.index(f"customer_state_{s}")] for s in ("RJ", "SP")] == [0.0, 0.0]


def test_clv_run_picks_the_lowest_mae_and_scores_everyone(spark):
    run = clv.train_clv(temporal(spark), "2017-06-01")
    mae = {r["model"]: r["mae"] for r in run.comparison.collect()}
    assert len(mae) == 6 and run.best in run.models and all(v >= 0 for v in mae.values())
    assert mae[run.best] == min(mae[m] for m in run.models)
    scored = run.score_all()
    assert scored.count() == 240 and scored.filter("predicted_clv < 0").count() == 0
    assert run.importance(5).count() == 5


def scored_rows(spark):
    rng = random.Random(2)
    rows = [(round(rng.random(), 1), int(rng.random() < 0.3)) for _ in range(300)]
    return rows, spark.createDataFrame(rows, "score double, target_repeat_buyer int")


def test_ranking_metrics_against_brute_force(spark):
    rows, df = scored_rows(spark)
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    ap, seen = 0.0, 0.0
    for t in sorted({s for s, _ in rows}, reverse=True):
        chosen = [y for s, y in rows if s >= t]
        recall = sum(chosen) / len(pos)
        ap += (recall - seen) * sum(chosen) / len(chosen)
        seen = recall
    got = repeat_purchase.ranking_metrics(df).first()
    assert (got["roc_auc"], got["pr_auc"]) == (round(auc, 4), round(ap, 4))


def test_threshold_and_confusion(spark):
    rows, df = scored_rows(spark)
    f1 = {}
    for t in repeat_purchase.THRESHOLDS:
        tp = sum(1 for s, y in rows if s >= t and y)
        fp = sum(1 for s, y in rows if s >= t and not y)
        f1[t] = 2 * tp / (2 * tp + fp + sum(y for _, y in rows) - tp)
    best = repeat_purchase.best_threshold(df).first()["optimal_threshold"]
    assert best == max(f1, key=lambda t: (f1[t], -t))
    m = repeat_purchase.decision_metrics(df, best).first()
    assert m["tp"] + m["fp"] + m["fn"] + m["tn"] == 300
    none = df.withColumn("target_repeat_buyer", F.lit(0))
    assert repeat_purchase.best_threshold(none).first()["optimal_threshold"] == 0.5


def test_stratified_split_is_stable(spark):
    df = spark.range(2000).select(F.col("id").alias("customer_unique_id"))
    part, held = repeat_purchase.stratified_split(df)
    again = repeat_purchase.stratified_split(df.repartition(7))[1]
    assert part.count() + held.count() == 2000 and 300 < held.count() < 500
    assert held.exceptAll(again).count() == 0


def test_segmentation_profiles_and_stable_labels(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        k = i % 4
        rows.append((i, [10.0, 100.0, 400.0, 700.0][k] + rng.random(), [6, 1, 1, 1][k], [900.0, 150.0, 300.0, 20.0][k] + rng.random(), "boleto", "Low Value"))
    df = spark.createDataFrame(rows, "customer_unique_id long, recency_days double, frequency_orders int, monetary_value double, preferred_payment_method string, customer_value_tier string")
    df = df.withColumns({"total_revenue": F.col("monetary_value"), "avg_review_score": F.lit(4.0), "avg_delivery_delay": F.lit(0.0), "avg_order_value": F.col("monetary_value")})
    out = segmentation.segment(df)
    got = {r["cluster_id"]: r for r in out.profiles.collect()}
    assert sorted(got) == [0, 1, 2, 3] and {r["customer_count"] for r in got.values()} == {100}
    assert [got[i]["business_description"] for i in range(4)] == [
        "Loyal Repeat Buyers",
        "Recent / Promising One-Time Buyers",
        "At-Risk High-Value Single-Order Buyers",
        "Hibernating Low-Value Casuals",
    ]
    assert out.segments.count() == 400
    quality = {r["k"]: r for r in segmentation.evaluate_k(segmentation.preprocess(df), 3, 4).collect()}
    assert quality[4]["davies_bouldin_index"] < quality[3]["davies_bouldin_index"]


@pytest.mark.parametrize("k", [4])
def test_constant_column_is_only_centred(spark, k):
    df = spark.createDataFrame([(float(i), 1, 5.0) for i in range(k)], "recency_days double, frequency_orders int, monetary_value double")
    assert {r["z_frequency"] for r in segmentation.preprocess(df).collect()} == {0.0}


def test_fits_read_equal_rows_once_and_few_run_at_a_time(spark, monkeypatch):
    fit, lock, now, most, rows = segmentation.KMeans.fit, threading.Lock(), [0], [0], set()

    def watched(self, points):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        try:
            rows.add(points.count())
            return fit(self, points)
        finally:
            with lock:
                now[0] -= 1

    monkeypatch.setattr(segmentation.KMeans, "fit", watched)
    rng = random.Random(3)
    once = spark.createDataFrame([[rng.random() for _ in segmentation.SCALED] for _ in range(30)], segmentation.SCALED)
    often = once.crossJoin(spark.range(7).select())
    one, seven = ({r["k"]: r for r in segmentation.evaluate_k(df, 2, 4).collect()} for df in (once, often))
    assert rows == {30} and most[0] <= 8
    for k in (2, 3, 4):
        assert abs(seven[k]["inertia"] - 7 * one[k]["inertia"]) < 0.05
        assert seven[k]["davies_bouldin_index"] == one[k]["davies_bouldin_index"]


def test_equal_rows_weigh_as_many(spark):
    df = spark.createDataFrame([(x, 0.0, 0.0) for x in (0.0, 0.0, 0.0, 4.0, 100.0)], segmentation.SCALED)
    model = segmentation.fit_kmeans(segmentation.weighted_points(df), [2])[2]
    assert sorted(c[0] for c in model.clusterCenters()) == [1.0, 100.0]
    assert model.summary.trainingCost == 12.0
