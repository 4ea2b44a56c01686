"""Held-out sentiment accuracy (T8): multinomial naive Bayes, cross-validated over folds.

All folds are one model table: a word's counts by (class, fold).  A text is scored by the
counts of the other folds, i.e. totals less its own fold's, so no model is trained twice and
no text is judged by a model that has seen it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import dims
from ..functions import round_half_up
from ..session import written

#: A word is hot with one in so many (text, word) rows.
HOT_WORD = 1000
#: Declared accuracy of the sentiment model.
TARGET_ACCURACY = 0.8


def fold_of(key: Column, folds: int) -> Column:
    """0 .. folds - 1 by the first 32 bits of the key's MD5: the same on every run and engine."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % folds).cast("int")


def holdout_sentiment(df: DataFrame, key: str, text: str, label: str, folds: int = 5, smoothing: float = 1.0,
                      pattern: str = dims.LATIN_WORD_PATTERN, stop: Sequence[str] = ()) -> DataFrame:
    """Per labelled text: key, fold, label, log_odds of the positive class, predicted (0 / 1).

    ``label`` is 1 or 0; rows with a null label or key take no part.  Words that the other folds do
    not have say nothing; a text without words (or null) gets the smoothed prior alone, so
    every row has a prediction, also if the other folds hold one class only.  Log odds of 0 are positive.
    Keys are expected to be distinct.

    Texts are tokenised once; words with at least one in ``HOT_WORD`` of the (text, word) rows, at most
    ``HOT_WORD`` many, are broadcast, the others join by shuffle, so no word lands in one task.
    """
    if folds < 2:
        raise ValueError("folds must be 2 or more")
    rows = df.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("_key"), fold_of(F.col(key), folds).alias("_fold"), (F.col(label) > 0).alias("_pos"),
        F.regexp_extract_all(F.lower(F.col(text)), F.lit(pattern), 0).alias("_words"))
    words = rows.select("_key", "_fold", "_pos", F.explode("_words").alias("_word"))
    if stop:
        words = words.where(~F.col("_word").isin(list(stop)))
    tf = written(words.groupBy("_key", "_fold", "_pos", "_word").agg(F.count(F.lit(1)).alias("_c")), "sentiment-words")

    def by_fold(positive: bool) -> Column:
        mine = F.col("_pos") if positive else ~F.col("_pos")
        return F.array(*[F.coalesce(F.sum(F.when(mine & (F.col("_fold") == f), F.col("_c"))), F.lit(0)) for f in range(folds)])

    counts = tf.groupBy("_word").agg(by_fold(True).alias("_p"), by_fold(False).alias("_n"), F.count(F.lit(1)).alias("_df"))
    total = F.aggregate("_p", F.lit(0).cast("long"), lambda a, x: a + x), F.aggregate("_n", F.lit(0).cast("long"), lambda a, x: a + x)
    counts = written(counts.select("_word", "_p", "_n", "_df", total[0].alias("_ps"), total[1].alias("_ns")), "sentiment-model")

    sums = counts.agg(*[F.struct(
        F.lit(f).alias("_fold"), F.coalesce(F.sum(F.col("_ps") - F.col("_p")[f]), F.lit(0)).alias("_tp"),
        F.coalesce(F.sum(F.col("_ns") - F.col("_n")[f]), F.lit(0)).alias("_tn"),
        F.count_if(F.col("_ps") + F.col("_ns") > F.col("_p")[f] + F.col("_n")[f]).alias("_v")).alias(f"f{f}") for f in range(folds)])
    sums = sums.select(F.inline(F.array(*[f"f{f}" for f in range(folds)])))
    everything = Window.partitionBy(F.lit(0))   # one row a fold
    texts = rows.groupBy("_fold").agg(F.count_if("_pos").alias("p"), F.count_if(~F.col("_pos")).alias("n"))
    texts = texts.select("_fold", (F.sum("p").over(everything) - F.col("p")).alias("_dp"),
                         (F.sum("n").over(everything) - F.col("n")).alias("_dn"))
    a = F.lit(float(smoothing))
    size = a * F.greatest(F.col("_v"), F.lit(1))
    per_fold = sums.join(texts, "_fold").select(
        "_fold", (F.log(F.col("_dp") + a) - F.log(F.col("_dn") + a)).alias("_prior"),
        (F.log(F.col("_tn") + size) - F.log(F.col("_tp") + size)).alias("_per_word"))

    hot = F.col("_df") * HOT_WORD >= tf.select(F.count(F.lit(1))).scalar()
    model = counts.select("_word", "_df", "_p", "_n", "_ps", "_ns")
    routed = tf.join(F.broadcast(model.where(hot)), "_word", "left")
    met = routed.where("_df is not null").unionByName(
        routed.where("_df is null").select(*tf.columns).join(model.where(~hot), "_word"))
    p = F.col("_ps") - F.col("_p")[F.col("_fold")]
    n = F.col("_ns") - F.col("_n")[F.col("_fold")]
    said = met.where(p + n > 0).groupBy("_key").agg(
        F.sum(F.col("_c") * (F.log(p + a) - F.log(n + a))).alias("_s"), F.sum("_c").alias("_len"))
    scored = rows.drop("_words").join(said, "_key", "left").join(F.broadcast(per_fold), "_fold")
    odds = F.col("_prior") + F.coalesce(F.col("_s") + F.col("_len") * F.col("_per_word"), F.lit(0.0))
    scored = scored.select(F.col("_key").alias(key), F.col("_fold").alias("fold"), F.col("_pos").cast("int").alias("label"),
                           round_half_up(odds, 6).alias("log_odds"))
    return scored.withColumn("predicted", (F.col("log_odds") >= 0).cast("int"))


def holdout_accuracy(scored: DataFrame, target: float = TARGET_ACCURACY) -> DataFrame:
    """Per fold and overall (fold null): texts, confusion counts, accuracy (4 digits), target met."""
    def cell(label: int, predicted: int) -> Column:
        return F.count_if((F.col("label") == label) & (F.col("predicted") == predicted))
    g = scored.rollup("fold").agg(
        F.count(F.lit(1)).alias("n"), cell(1, 1).alias("true_positive"), cell(0, 0).alias("true_negative"),
        cell(0, 1).alias("false_positive"), cell(1, 0).alias("false_negative"))
    right = (F.col("true_positive") + F.col("true_negative")) / F.nullif(F.col("n"), F.lit(0))
    return g.select("*", round_half_up(right, 4).alias("accuracy"), (right >= target).alias("meets_target"))
