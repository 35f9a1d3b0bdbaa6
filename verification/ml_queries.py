from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marketlens.ml import clv, encoding, repeat_purchase, scoring, segmentation, store as models
from marketlens.sources.workspace import concurrently, shared_dir, stored
from verification.feature_queries import FEATURES_SQL, TEMPORAL, TEMPORAL_SQL, store, temporal
from verification.registry import register
from verification.roles_sql import quant, rnd, with_roles

SPLIT = "1996-01-01"

# ---- segmentation

register(
    "seg_preprocess",
    lambda m: segmentation.preprocess(stored(store(m), "store")).select(
        "customer_unique_id", *[F.round(c, 4).alias(c) for c in [*segmentation.LOGS, *segmentation.SCALED]]
    ),
    "SELECT customer_unique_id, "
    + ", ".join(f"{rnd(log, 4)} AS {log}" for log in segmentation.LOGS)
    + ", "
    + ", ".join(f"{rnd(f'({log} - avg({log}) OVER ()) / stddev_pop({log}) OVER ()', 4)} AS {z}" for z, log in zip(segmentation.SCALED, segmentation.LOGS))
    + f" FROM (SELECT customer_unique_id, ln(1 + recency_days) AS log_recency, ln(1 + frequency_orders) AS log_frequency, ln(1 + monetary_value) AS log_monetary FROM ({FEATURES_SQL}))",
)
register("seg_evaluate_k", lambda m: segmentation.evaluate_k(segmentation.preprocess(stored(store(m), "store"))))
register(
    "seg_fit",
    lambda m: segmentation.segment(stored(store(m), "store")).segments.select("customer_unique_id", "cluster_id", "cluster_description"),
)
register("seg_profiles", lambda m: segmentation.segment(stored(store(m), "store")).profiles)
register("kpi_persona_counts", lambda m: segmentation.persona_counts(segmentation.segment(stored(store(m), "store")).segments))


def _persona(m):
    f = store(m)
    return f.select(
        "customer_unique_id",
        segmentation.persona(F.col("recency_days"), F.col("frequency_orders").cast("double"), F.col("total_revenue")).alias("persona"),
    )


register(
    "seg_persona",
    _persona,
    f"""SELECT customer_unique_id, CASE WHEN frequency_orders > 1.5 THEN 'Loyal Repeat Buyers'
  WHEN recency_days < 180 AND total_revenue >= 100 THEN 'Recent / Promising One-Time Buyers'
  WHEN recency_days >= 300 AND total_revenue >= 200 THEN 'At-Risk High-Value Single-Order Buyers'
  WHEN recency_days >= 300 AND total_revenue < 100 THEN 'Hibernating Low-Value Casuals'
  ELSE 'Mid-Tier Occasional Buyers' END AS persona FROM ({FEATURES_SQL})""",
)

# ---- split, encoding, baselines

TEMP = {**TEMPORAL, "tf": TEMPORAL_SQL}


def _split(m):
    train, test = encoding.chronological_split(temporal(m), SPLIT)
    return train.select("customer_unique_id", F.lit("train").alias("part")).unionByName(
        test.select("customer_unique_id", F.lit("test").alias("part"))
    )


register(
    "ml_split",
    _split,
    with_roles(f"SELECT customer_unique_id, CASE WHEN first_purchase_date < '{SPLIT}' THEN 'train' ELSE 'test' END AS part FROM tf", TEMP),
)


def _encoded(m):
    features = stored(temporal(m), "temporal")
    train, _ = encoding.chronological_split(features, SPLIT)
    rows = encoding.encode(encoding.fit_encoder(train), features)
    from pyspark.ml.functions import vector_to_array

    return rows.select("customer_unique_id", F.transform(vector_to_array("features"), lambda x: F.round(x, 6)).cast("string").alias("features"))


register("ml_encode", _encoded)
register(
    "clv_baselines",
    lambda m: clv.baseline_metrics(temporal(m), SPLIT),
    with_roles(
        f"""SELECT model, {rnd("avg(abs(y - p))", 4)} AS mae, {rnd("sqrt(avg((y - p) ** 2))", 4)} AS rmse,
  CASE WHEN model LIKE 'Zero%' THEN 0.0 ELSE {rnd("1 - sum((y - p) ** 2) / (var_pop(y) * count(*))", 4)} END AS r2_score,
  CASE WHEN model LIKE 'Zero%' THEN 0.0 ELSE {rnd(quant("abs(y - p)", 0.5), 4)} END AS median_absolute_error,
  {rnd("avg(CASE WHEN y > 0 THEN abs(y - p) END)", 4)} AS non_zero_clv_mae
FROM (SELECT '{clv.ZERO}' AS model, target_future_clv AS y, 0.0::DOUBLE AS p FROM tf WHERE first_purchase_date >= '{SPLIT}'
  UNION ALL SELECT '{clv.MEAN}', target_future_clv, (SELECT avg(target_future_clv) FROM tf WHERE first_purchase_date < '{SPLIT}')
  FROM tf WHERE first_purchase_date >= '{SPLIT}') GROUP BY model""",
        TEMP,
    ),
)

# ---- classifier metrics over a plain score: recent, frequent customers first


def _scored(m):
    s = F.round(F.col("obs_frequency_orders") / (F.col("obs_frequency_orders") + F.col("obs_recency_days") / 30.0), 2)
    return temporal(m).select("customer_unique_id", s.alias("score"), "target_repeat_buyer")


SCORED = {
    **TEMP,
    "sc": f"SELECT customer_unique_id, {rnd('obs_frequency_orders / (obs_frequency_orders + obs_recency_days / 30.0)')} AS score, target_repeat_buyer = 1 AS y FROM tf",
}
_thr = " UNION ALL ".join(f"SELECT {t}::DOUBLE AS t" for t in repeat_purchase.THRESHOLDS)
register(
    "rp_threshold",
    lambda m: repeat_purchase.threshold_scores(_scored(m)),
    with_roles(
        """SELECT t AS threshold, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN pos > 0 THEN tp::DOUBLE / pos ELSE 0.0 END AS recall, CASE WHEN tp + fp + pos > 0 THEN (2 * tp)::DOUBLE / (tp + fp + pos) ELSE 0.0 END AS f1
FROM (SELECT t, count(*) FILTER (score >= t AND y) AS tp, count(*) FILTER (score >= t AND NOT y) AS fp, count(*) FILTER (y) AS pos FROM sc CROSS JOIN thr GROUP BY t)""",
        {**SCORED, "thr": _thr},
    ),
)
register(
    "rp_metrics",
    lambda m: repeat_purchase.all_metrics(_scored(m), 0.3),
    with_roles(
        f"""SELECT {rnd("(tp + tn)::DOUBLE / (tp + tn + fp + fn)", 4)} AS accuracy, {rnd("tp::DOUBLE / (tp + fp)", 4)} AS precision,
  {rnd("tp::DOUBLE / (tp + fn)", 4)} AS recall, {rnd("(2 * tp)::DOUBLE / (2 * tp + fp + fn)", 4)} AS f1_score, tp, fp, fn, tn,
  (SELECT {rnd("(sum(r) FILTER (y) - count(*) FILTER (y) * (count(*) FILTER (y) + 1) / 2.0) / (count(*) FILTER (y) * count(*) FILTER (NOT y))", 4)}
   FROM (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r FROM sc)) AS roc_auc,
  (SELECT {rnd("sum(k * cp::DOUBLE / cn) / max(tot)", 4)} FROM (SELECT k, sum(k) OVER w AS cp, sum(n) OVER w AS cn, sum(k) OVER () AS tot
     FROM (SELECT score, count(*) AS n, count(*) FILTER (y) AS k FROM sc GROUP BY 1) WINDOW w AS (ORDER BY score DESC))) AS pr_auc
FROM (SELECT count(*) FILTER (score >= 0.3 AND y) AS tp, count(*) FILTER (score >= 0.3 AND NOT y) AS fp,
        count(*) FILTER (score < 0.3 AND y) AS fn, count(*) FILTER (score < 0.3 AND NOT y) AS tn FROM sc)""",
        SCORED,
    ),
)
register(
    "rp_lift_top5",
    lambda m: repeat_purchase.lift_top5(_scored(m)),
    with_roles(
        f"""SELECT n AS total_count, tp AS true_positives, n - tp AS false_positives, {rnd("tp::DOUBLE / n", 4)} AS precision,
  {rnd(rnd("tp::DOUBLE / n", 4) + " / rate")} AS precision_lift
FROM (SELECT count(*) AS n, count(*) FILTER (y) AS tp, (SELECT count(*) FILTER (y)::DOUBLE / count(*) FROM sc) AS rate
      FROM sc WHERE score >= (SELECT {quant("score", 0.95)} FROM sc))""",
        SCORED,
    ),
)

# ---- models (no SQL form: iterative fits)

register("clv_models", lambda m: clv.train_clv(temporal(m), SPLIT).comparison)
register("rp_models", lambda m: repeat_purchase.train_repeat(temporal(m), SPLIT).comparison)


def _hurdle(m):
    features = stored(temporal(m), "temporal")
    train, test = encoding.chronological_split(features, SPLIT)
    encoder = encoding.fit_encoder(train)
    model = clv.fit_hurdle(encoding.encode(encoder, train))
    return model.predict(encoding.encode(encoder, test), "predicted_clv").select(
        "customer_unique_id", F.round("predicted_clv", 2).alias("predicted_clv")
    )


register("clv_hurdle", _hurdle)


def _clv_run(m, features=None) -> clv.ClvRun:
    return clv.train_clv(temporal(m) if features is None else features, SPLIT)


def _repeat_run(m, features=None) -> repeat_purchase.RepeatRun:
    return repeat_purchase.train_repeat(temporal(m) if features is None else features, SPLIT)


register("ml_importance", lambda m: _clv_run(m).importance())
register("clv_score_all", lambda m: _clv_run(m).score_all())
register("clv_extreme_errors", lambda m: clv.extreme_errors(_clv_run(m).score_all()))
register("kpi_top_clv", lambda m: clv.top_customers(_clv_run(m).score_all()))
register("rp_score_all", lambda m: _repeat_run(m).score_all())


def _export(m):
    run = _clv_run(m)
    path = f"{shared_dir(run.features.sparkSession)}/clv-export-{uuid.uuid4().hex}"
    models.export_clv(run, path)
    return run.features.sparkSession.read.parquet(f"{path}/predictions.parquet").select("customer_unique_id", "predicted_clv")


register("ml_export", _export)


def _requests(features):
    """Every customer once by id, and once as an unknown one with its own recency."""
    f = features.select("customer_unique_id", "obs_recency_days", "customer_state")
    known = f.select(F.concat(F.lit("k"), "customer_unique_id").alias("request_id"), F.col("customer_unique_id").alias("customer_id"), F.lit(None).cast("double").alias("recency_days"), F.col("customer_state").alias("state"))
    fresh = f.select(F.concat(F.lit("f"), "customer_unique_id"), -F.col("customer_unique_id") - 1, "obs_recency_days", "customer_state")
    return known.union(fresh)


def _models(m, features) -> tuple[scoring.Models, scoring.Models]:
    """The three fitted models, as fitted and as loaded again from a store. ``features``: the temporal ones, stored."""
    spark = m.orders.sparkSession
    path = f"{shared_dir(spark)}/models-{uuid.uuid4().hex}"
    runs = concurrently(
        {"clv": lambda: _clv_run(m, features), "repeat": lambda: _repeat_run(m, features), "segments": lambda: segmentation.segment(stored(store(m), "store"))}
    )
    models.export_all(runs["clv"], runs["repeat"], runs["segments"], path)
    return models.fitted(runs["clv"], runs["repeat"], runs["segments"]), models.load_models(spark, path)


def _score_batch(m):
    """Requests scored with the loaded models, next to what the fitted ones give."""
    features = stored(temporal(m), "temporal")
    fitted, loaded = _models(m, features)
    requests = stored(_requests(features), "requests")
    one, other = (scoring.score_requests(requests, x) for x in (loaded, fitted))
    answers = [c for c in one.columns if c != "request_id"]
    other = other.select("request_id", F.struct(*answers).alias("fitted"))
    named = F.col("cluster_description").isin(*PERSONAS)
    return one.join(other, "request_id").select(
        "request_id",
        "segment_source",
        "clv_source",
        "repeat_source",
        (F.struct(*answers) == F.col("fitted")).alias("same_as_fitted"),
        (F.col("cluster_id").between(0, segmentation.CLUSTERS - 1) & named).alias("segment_valid"),
        (F.col("predicted_clv") >= 0).alias("clv_valid"),
        F.col("repeat_purchase_probability").between(0, 1).alias("chance_valid"),
    )


PERSONAS = [
    "Loyal Repeat Buyers",
    "Recent / Promising One-Time Buyers",
    "At-Risk High-Value Single-Order Buyers",
    "Hibernating Low-Value Casuals",
    "Mid-Tier Occasional Buyers",
]


def _source(known: str) -> str:
    return f"CASE WHEN {known} THEN 'table' ELSE 'model' END"


# Half of the requests name a customer, half an id that no table has.
register(
    "score_payload_batch",
    _score_batch,
    with_roles(
        f"""SELECT request_id, {_source("known")} AS segment_source, {_source("known")} AS clv_source, {_source("known")} AS repeat_source,
  TRUE AS same_as_fitted, TRUE AS segment_valid, TRUE AS clv_valid, TRUE AS chance_valid
FROM (SELECT 'k' || customer_unique_id AS request_id, TRUE AS known FROM tf UNION ALL SELECT 'f' || customer_unique_id, FALSE FROM tf)""",
        TEMP,
    ),
)
