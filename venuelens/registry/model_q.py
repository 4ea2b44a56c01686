"""Rating model M1-M6 (rows-only, learned) and its evaluation M5 (oracle-checked)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rating_model as M
from ..session import scratch_path
from . import register
from .dashboard import R


def _model(t):
    return M.load_or_train(t.listing(), scratch_path(t.spark, "rating_model"))


def _requests(t):
    return t.listing().select("listing_id", "category", "area", "price")


@register("train_rating_model")
def _train(t):
    """Fits the forest (80/20 split, 100 trees, seed 42) once per scale and returns its metrics row."""
    _, metrics = _model(t)
    return metrics.select(F.col("r2").cast("double"), F.col("rmse").cast("double"),
                          F.col("n_samples").cast("long"), F.to_json("importances").alias("importances"))


@register("predict_rating")
def _predict(t):
    model, _ = _model(t)
    return M.predict_rating(model, _requests(t))


@register("prediction_interval")
def _interval(t):
    model, _ = _model(t)
    return M.prediction_interval(model, _requests(t))


@register("model_info")
def _info(t):
    model, metrics = _model(t)
    return M.model_info(model, metrics)


@register("rating_model_checks", """
SELECT TRUE AS trained, count(*) FILTER (WHERE price > 0 AND rating > 0 AND category <> '' AND area <> '') AS n_samples, TRUE AS explains,
       TRUE AS importances_sum, count(*) AS n_requests, count(*) AS n_in_range, count(*) AS n_ordered, count(*) AS n_same
FROM listing""", ("listing",))
def _checks(t):
    """What must hold of the learned results (M1-M4): sample count, error not above one and a half times
    the ratings' spread, importances that sum to one, predictions and intervals in range, ordered and alike."""
    model, metrics = _model(t)
    info = M.model_info(model, metrics)
    both = M.prediction_interval(model, M.predict_rating(model, _requests(t)).withColumnRenamed("predicted_rating", "own"))
    p, low, high = F.col("predicted_rating"), F.col("low"), F.col("high")
    counts = both.agg(F.count(F.lit(1)).alias("n_requests"), F.count_if(p.between(1, 5) & (low >= 1) & (high <= 5)).alias("n_in_range"),
                      F.count_if((low <= p) & (p <= high)).alias("n_ordered"), F.count_if(F.abs(p - F.col("own")) <= 0.1001).alias("n_same"))
    spread = M.filter_training_rows(t.listing()).select(F.stddev_pop(F.col("rating").cast("double"))).scalar()
    total = F.aggregate(F.map_values(F.from_json("importances", "map<string,double>")), F.lit(0.0), lambda a, x: a + x)
    return info.crossJoin(counts).select(  # one row each
        "trained", "n_samples", (F.col("rmse") <= 1.5 * spread).alias("explains"), (F.abs(total - 1) < 1e-6).alias("importances_sum"),
        "n_requests", "n_in_range", "n_ordered", "n_same")


@register("evaluate_model", f"""
WITH cm AS (SELECT category, {R('avg(CAST(rating AS DOUBLE))', 1)} AS prediction FROM listing GROUP BY category),
p AS (SELECT l.area, CAST(l.rating AS DOUBLE) AS label, cm.prediction FROM listing l JOIN cm ON cm.category = l.category),
g AS (SELECT area, count(*) AS n, sum((label - prediction) * (label - prediction)) AS _sse, sum(label) AS _sy,
             sum(label * label) AS _syy FROM p GROUP BY area)
SELECT area, n, {R('1.0 - _sse / nullif(_syy - _sy * _sy / n, 0.0)', 4)} AS r2, {R('sqrt(_sse / n)', 4)} AS rmse
FROM g""", ("listing",))
def _evaluate(t):
    lst = t.listing()
    from ..functions import avg_rounded
    cm = lst.groupBy("category").agg(avg_rounded("rating", 1).alias("prediction"))
    pred = lst.join(cm, "category").select("area", F.col("rating").cast("double").alias("label"), "prediction")
    return M.evaluate_model(pred, "area")
