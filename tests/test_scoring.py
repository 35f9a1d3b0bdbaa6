import random

import pytest
from pyspark.sql import functions as F

from marketlens.ml import clv, repeat_purchase, scoring, segmentation, store
from tests.test_ml import temporal


def rfm(spark, n=240):
    rng = random.Random(4)
    rows = [(i, i, 40.0 * (i % 9) + rng.random(), 1 + i % 3, 15.0 * (i % 11) + rng.random(), "boleto", "Low Value") for i in range(n)]
    df = spark.createDataFrame(rows, "customer_id long, customer_unique_id long, recency_days double, frequency_orders int, monetary_value double, preferred_payment_method string, customer_value_tier string")
    return df.withColumns({"total_revenue": F.col("monetary_value"), "avg_review_score": F.lit(4.0), "avg_delivery_delay": F.lit(0.0), "avg_order_value": F.col("monetary_value")})


@pytest.fixture(scope="module")
def runs(spark):
    features = temporal(spark).withColumn("customer_id", F.col("customer_unique_id") + 1000)  # two kinds of id
    return clv.train_clv(features, "2017-06-01"), repeat_purchase.train_repeat(features, "2017-06-01"), segmentation.segment(rfm(spark))


@pytest.fixture(scope="module")
def models(spark, runs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("models"))
    store.export_all(*runs, path)
    # Another session: nothing of the fitted objects is at hand but the folder.
    return store.fitted(*runs), store.load_models(spark.newSession(), path), path


REQUESTS = [("known", 3, None, None, None, None), ("other id", 1003, None, None, None, None), ("unique", None, 4, None, None, None)]
REQUESTS += [("unknown", -1, None, 9.0, 1, 75.0), ("anonymous", None, None, 320.0, 1, 20.0), ("bare", None, None, None, None, None)]
SCHEMA = "request_id string, customer_id long, customer_unique_id long, recency_days double, frequency_orders int, monetary_value double"


def test_loaded_models_answer_like_the_fitted_ones(spark, models):
    fitted, loaded, _ = models
    requests = spark.createDataFrame(REQUESTS, SCHEMA)
    one, other = (sorted(map(tuple, scoring.score_requests(requests, m).collect())) for m in (fitted, loaded))
    assert one == other and len(one) == len(REQUESTS)


def test_known_customers_take_the_table_and_others_the_model(spark, runs, models):
    run, repeat, segments = runs
    got = {r["request_id"]: r for r in scoring.score_requests(spark.createDataFrame(REQUESTS, SCHEMA), models[1]).collect()}
    for name, who in (("known", 3), ("unique", 4), ("other id", 3)):
        r = got[name]
        assert r["clv_source"] == r["repeat_source"] == "table"
        assert r["predicted_clv"] == run.score_all().filter(f"customer_unique_id = {who}").first()["predicted_clv"]
        stored = repeat.score_all().filter(f"customer_unique_id = {who}").first()
        assert (r["repeat_purchase_probability"], r["predicted_repeat_customer"]) == (stored["repeat_purchase_probability"], stored["predicted_repeat_buyer"])
        assert r["cluster_id"] == segments.segments.filter(f"customer_unique_id = {who}").first()["cluster_id"]
    for name in ("unknown", "anonymous", "bare"):
        assert {got[name][s] for s in ("segment_source", "clv_source", "repeat_source")} == {"model"}
        chance = got[name]["repeat_purchase_probability"]
        assert got[name]["predicted_repeat_customer"] == int(chance >= scoring.REQUEST_THRESHOLD)


def test_segment_of_a_request_is_the_nearest_centre(spark, runs, models):
    """A request with the fields of a customer falls into the customer's cluster."""
    rows = rfm(spark).limit(60).select(F.col("customer_unique_id").cast("string").alias("request_id"), "recency_days", "frequency_orders", "monetary_value")
    got = {r["request_id"]: r["cluster_id"] for r in scoring.score_requests(rows, models[1]).collect()}
    want = {str(r["customer_unique_id"]): r["cluster_id"] for r in runs[2].segments.collect()}
    assert len(got) == 60 and all(want[k] == v for k, v in got.items())


def test_customer_without_a_result_takes_the_model_for_it(spark, models):
    partial = scoring.known_customers(
        spark.createDataFrame([(1, 1, 0, "x")], "customer_id int, customer_unique_id int, cluster_id long, cluster_description string"),
        spark.createDataFrame([(2, 2, 5.0)], "customer_id int, customer_unique_id int, predicted_clv double"),
        spark.createDataFrame([(1, 1, 0.25, 1)], "customer_id int, customer_unique_id int, repeat_purchase_probability double, predicted_repeat_buyer int"),
    )
    fitted = scoring.Models(**{**models[1].__dict__, "known": partial})
    got = {r["request_id"]: r for r in scoring.score_requests(spark.createDataFrame([("a", 1), ("b", 2)], "request_id string, customer_id int"), fitted).collect()}
    assert (got["a"]["segment_source"], got["a"]["clv_source"], got["a"]["repeat_source"]) == ("table", "model", "table")
    assert (got["b"]["segment_source"], got["b"]["clv_source"], got["b"]["predicted_clv"]) == ("model", "table", 5.0)


def test_store_tells_what_it_holds(spark, runs, models):
    info = {r["part"]: r for r in store.models_info(spark, models[2]).collect()}
    assert info["clv"]["model"] == runs[0].best and info["repeat"]["model"] == runs[1].best
    assert '"clusters":4' in info["segments"]["measures"] and '"customers":240' in info["segments"]["measures"]
