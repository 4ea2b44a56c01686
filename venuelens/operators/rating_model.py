"""Rating prediction with a random forest (M1-M6).

Features are the category and area as label codes (alphabetical, numeric -
not one-hot, as the reference encodes them) and the price, each in at most 64
bins.  Trees are grown in tasks (``forest``) and stay tables: their nodes, and
what all of them say of every cell of bins.  Prediction is a batch join of a
request table with the cells; unseen labels get code 0 (Q20).  The interval
(M3) is the spread of the individual trees' predictions.
"""

from __future__ import annotations

import hashlib
import json

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Bucketizer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import round_half_up
from ..session import exists, written
from .filters import filter_training_rows
from .forest import BINS, MAX_BINS, cell_predictions, grow_forest, importances

FEATURES = ("category", "area", "price")


def _prep(df: DataFrame) -> DataFrame:
    return df.select(F.coalesce(F.col("category"), F.lit("")).alias("category"),
                     F.coalesce(F.col("area"), F.lit("")).alias("area"),
                     F.col("price").cast("double").alias("price"),
                     *[c for c in df.columns if c not in FEATURES])


@dataclass
class RatingModel:
    """A fitted forest: features to bins, the trees' nodes, mean and spread of the trees in every cell."""

    bins: PipelineModel
    nodes: DataFrame
    cells: DataFrame


from pyspark.ml import Transformer  # noqa: E402
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable  # noqa: E402


class _NumericCodes(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Label codes as plain numbers; the 'unseen' code maps to 0 (Q20).

    ``+ 0`` drops the nominal metadata so the forest splits codes as numbers,
    like the reference's integer-encoded inputs.
    """

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        for code, num in (("_cat_code", "_cat_num"), ("_area_code", "_area_num")):
            vals = df.schema[code].metadata.get("ml_attr", {}).get("vals", [])
            n_labels = len([v for v in vals if v != "__unknown"]) or None  # 'keep' adds an unknown slot
            c = F.col(code) + 0
            if n_labels is not None:
                c = F.when(F.col(code) >= n_labels, F.lit(0.0)).otherwise(c)
            out = out.withColumn(num, c.cast("double"))
        return out


# ---- M1 ----------------------------------------------------------------------------
def bin_bounds(df: DataFrame, col: str) -> list[float]:
    """At most ``MAX_BINS`` - 1 bounds: between all values if those are few, else at the quantiles."""
    values = sorted(r[0] for r in df.select(col).distinct().limit(MAX_BINS + 1).collect())
    if len(values) <= MAX_BINS:
        return [(a + b) / 2 for a, b in zip(values, values[1:])] or values
    return sorted(set(df.approxQuantile(col, [i / MAX_BINS for i in range(1, MAX_BINS)], 0.001)))


def build_pipeline(train: DataFrame) -> PipelineModel:
    """Category, area and price to their bins, fitted on the training rows."""
    idx = StringIndexer(inputCols=["category", "area"], outputCols=["_cat_code", "_area_code"],
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    codes = Pipeline(stages=[idx, _NumericCodes()]).fit(train)
    rows = codes.transform(train)
    inputs = ["_cat_num", "_area_num", "price"]
    bounds = [[-float("inf"), *bin_bounds(rows, c), float("inf")] for c in inputs]
    return PipelineModel(stages=[*codes.stages, Bucketizer(splitsArray=bounds, inputCols=inputs, outputCols=list(BINS), handleInvalid="keep")])


def _binned(bins: PipelineModel, rows: DataFrame) -> DataFrame:
    return bins.transform(rows).withColumns({c: F.col(c).cast("int") for c in BINS})


def train_rating_model(df: DataFrame, trees: int = 100, seed: int = 42, max_depth: int = 30,
                       min_rows: int = 20, test_share: float = 0.2):
    """Fit on an 80/20 split; return (model, metrics DataFrame with r2, rmse, sizes, importances)."""
    from ..session import checkpoint_dir
    checkpoint_dir(df.sparkSession)  # training rows, nodes and cells go to the shared folder
    rows = filter_training_rows(df).select(*FEATURES, "rating")
    data = written(_prep(rows).withColumn("label", F.col("rating").cast("double")), "training")
    n = data.count()
    if n < min_rows:
        raise ValueError(f"need at least {min_rows} usable rows, have {n}")
    train, test = data.randomSplit([1 - test_share, test_share], seed=seed)
    bins = build_pipeline(train)
    sizes = [len(x) - 1 for x in bins.stages[-1].getSplitsArray()]
    nodes = written(grow_forest(_binned(bins, train), sizes, trees, seed, max_depth), "forest")
    model = RatingModel(bins, nodes, written(cell_predictions(nodes), "forest-cells"))
    pred = _predicted(model, test)
    ev = RegressionEvaluator(labelCol="label", predictionCol="mean")
    r2 = ev.setMetricName("r2").evaluate(pred) if test.limit(2).count() > 1 else None
    rmse = ev.setMetricName("rmse").evaluate(pred) if r2 is not None else None
    share = {r["feature"]: float(r["share"]) for r in importances(nodes).collect()}
    spark = df.sparkSession
    metrics = spark.createDataFrame(
        [(float(r2) if r2 is not None else None, float(rmse) if rmse is not None else None, n,
          {f: share.get(i, 0.0) for i, f in enumerate(FEATURES)})],
        "r2 double, rmse double, n_samples long, importances map<string,double>")
    return model, metrics


# ---- M2 ----------------------------------------------------------------------------
def _predicted(model: RatingModel, rows: DataFrame) -> DataFrame:
    """``rows`` with mean and std of the trees; null without a price. The cells are bounded by the bins, so broadcast."""
    return _binned(model.bins, rows).join(F.broadcast(model.cells), list(BINS), "left")


def _clipped(mean: Column) -> Column:
    return F.when(mean.isNotNull(), round_half_up(F.greatest(F.lit(1.0), F.least(F.lit(5.0), mean)), 1))


def predict_rating(model: RatingModel, requests: DataFrame) -> DataFrame:
    """Predicted rating clipped to [1, 5], one digit; unseen labels use code 0."""
    return _predicted(model, _prep(requests)).select(*requests.columns, _clipped(F.col("mean")).alias("predicted_rating"))


# ---- M3 ----------------------------------------------------------------------------
def prediction_interval(model: RatingModel, requests: DataFrame) -> DataFrame:
    """Rounded prediction +/- population std of the trees' predictions, clipped to [1, 5]."""
    out = _predicted(model, _prep(requests)).select(*requests.columns, _clipped(F.col("mean")).alias("predicted_rating"), "std")
    p, std = F.col("predicted_rating"), F.col("std")
    return out.select(*requests.columns, "predicted_rating",
                      F.when(p.isNotNull(), round_half_up(F.greatest(F.lit(1.0), p - std), 1)).alias("low"),
                      F.when(p.isNotNull(), round_half_up(F.least(F.lit(5.0), p + std), 1)).alias("high"))


# ---- M4 / M6 -----------------------------------------------------------------------
def save_model(model: RatingModel, metrics: DataFrame, path: str) -> None:
    model.bins.write().overwrite().save(f"{path}/bins")
    model.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    model.cells.write.mode("overwrite").parquet(f"{path}/cells")
    metrics.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")


def load_model(spark, path: str):
    model = RatingModel(PipelineModel.load(f"{path}/bins"), spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/cells"))
    return model, spark.read.json(f"{path}/metrics")


def load_or_train(df: DataFrame, path: str, **kw):
    """Reuse the model saved for the same rows and arguments, train and save one when there is none (on-demand training).

    The model lies under ``path`` by ``model_key``, so changed data or arguments train anew.
    Metrics are written after the model; their success mark says that both are whole.  Any
    error other than a missing model is raised.
    """
    spark = df.sparkSession
    own = f"{path}/{model_key(df, **kw)}"
    if not exists(spark, f"{own}/metrics/_SUCCESS"):
        save_model(*train_rating_model(df, **kw), own)
    return load_model(spark, own)


def model_key(df: DataFrame, **kw) -> str:
    """Count, sum and xor of the training rows' hashes with the arguments: free of order, one aggregate."""
    row = F.xxhash64("category", "area", F.col("price").cast("double"), F.col("rating").cast("double"))
    n, total, xor = filter_training_rows(df).agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row)).first()
    text = f"cells|{n}|{total}|{xor}|{sorted(kw.items())}"
    return hashlib.sha256(text.encode()).hexdigest()[:24]


def model_info(model: RatingModel | None, metrics: DataFrame | None) -> DataFrame:
    """One row: trained flag, scores, sample count, importances, known labels."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if model is None:
        return spark.createDataFrame([(False, None, None, None, None, None)],
                                     "trained boolean, r2 double, rmse double, n_samples long, "
                                     "importances string, known_labels string")
    idx = model.bins.stages[0]
    labels = {"category": list(idx.labelsArray[0]), "area": list(idx.labelsArray[1])}
    return metrics.select(F.lit(True).alias("trained"), F.col("r2").cast("double").alias("r2"),
                          F.col("rmse").cast("double").alias("rmse"), F.col("n_samples").cast("long").alias("n_samples"),
                          F.to_json("importances").alias("importances"), F.lit(json.dumps(labels)).alias("known_labels"))


# ---- M5 ----------------------------------------------------------------------------
def evaluate_model(pred: DataFrame, by: str | None = None, label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """R^2 and RMSE overall or per group from one aggregate (sums of squares)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum((y - p) * (y - p)).alias("_sse"), F.sum(y).alias("_sy"),
            F.sum(y * y).alias("_syy")]
    g = pred.groupBy(by).agg(*aggs) if by else pred.agg(*aggs)
    sst = F.col("_syy") - F.col("_sy") * F.col("_sy") / F.col("n")
    keys = [by] if by else []
    return g.select(*keys, "n", round_half_up(F.lit(1.0) - F.col("_sse") / F.nullif(sst, F.lit(0.0)), 4).alias("r2"),
                    round_half_up(F.sqrt(F.col("_sse") / F.col("n")), 4).alias("rmse"))
