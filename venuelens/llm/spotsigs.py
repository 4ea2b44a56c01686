"""Document fingerprints by SpotSigs, in DataFrame functions only.

A text is lower-cased and reduced to words of letters and digits. Common words (in several
languages) are anchors; the signature of an anchor is the chain of the next CHAIN words that
are not common, and is kept as the upper 40 bits of its XXH64. The fingerprint is the sorted
set of a text's signatures, written as ten hexadecimal digits each. A text in which no chain
follows an anchor has one signature, of its whole sequence of words. Two fingerprints' likeness
is the Jaccard index of their signature sets.

``near_duplicates`` finds all pairs at or above a likeness: sets are partitioned by length (two
alike sets lie in the same or neighbouring partitions), pairs meet in the inverted index of
the few smallest signatures that such a pair must share one of, and lengths prune again before
the sets are compared. Texts with equal sets are one class, so copies are never paired.

The next document of each (descending doc_id) comes from a window inside ranges of doc_id: the
range limits are quantiles, and each range is lent the first document of the following range,
so the text is shuffled once and no window spans the table.

Null text counts as empty (n_chars 0, one signature of nothing). A null doc_id comes last,
rows of equal doc_id are ordered by text, and a single document is its own next. An empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venuelens.llm.common import documents, prepare, shuffle_partitions, text_or_empty

CHAIN = 3
BITS = 40
LIKENESS = 0.8

#: Anchors: common words of English, German, French and Spanish.
ANCHORS = (
    "the a an and of to in is are was were be been for on that this it with from by as at or not but have has had you he she they we his her their "
    "der die das den dem des ein eine einen und ist sind war im von zu mit auf für als auch nicht er sie es wir ich aus bei nach wie "
    "le la les de du un une et est sont que qui dans pour par sur au aux ce cette il elle nous vous ne pas plus avec se "
    "el los las y en con una del al lo su por para como más pero sus o fue ser son está"
).split()

_LEAST = -(2**63)


def normal(text: Column) -> Column:
    """Lower-cased words between single spaces, with a space at each end."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def with_signatures(rows: DataFrame, texts: dict[str, str]) -> DataFrame:
    """``rows`` with a sorted set of 40-bit signatures for each text column: {new column: text column}.

    Each step is a column of its own: what a lambda refers to is then computed once a row, not once an element.
    """
    anchors = "|".join(sorted(set(ANCHORS)))
    out = rows.withColumns({f"_w_{k}": normal(F.col(v)) for k, v in texts.items()})
    # the words after each anchor up to the next; the part before the first anchor follows none
    out = out.withColumns({f"_p_{k}": F.split(F.col(f"_w_{k}"), f" (?:{anchors})(?= )") for k in texts})
    out = out.withColumns({
        f"_r_{k}": F.filter(F.transform(F.slice(F.col(f"_p_{k}"), 2, F.greatest(F.size(f"_p_{k}") - 1, F.lit(0))), lambda r: F.trim(r)), lambda r: r != "")
        for k in texts
    })

    def chains(k: str) -> Column:
        runs = F.col(f"_r_{k}")
        return F.when(
            F.size(runs) > 0,
            F.transform(runs, lambda _, i: F.xxhash64(F.substring_index(F.array_join(F.slice(runs, i + 1, CHAIN), " "), " ", CHAIN))),
        ).otherwise(F.array(F.xxhash64(F.col(f"_w_{k}"))))

    out = out.withColumns({f"_c_{k}": chains(k) for k in texts})
    out = out.withColumns({k: F.array_sort(F.array_distinct(F.transform(F.col(f"_c_{k}"), lambda c: F.shiftrightunsigned(c, 64 - BITS)))) for k in texts})
    return out.drop(*[f"_{x}_{k}" for x in "wprc" for k in texts])


def spelled(sigs: Column) -> Column:
    """A signature set as text."""
    return F.array_join(F.transform(sigs, lambda s: F.lower(F.lpad(F.hex(s), BITS // 4, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """The Jaccard index of two signature sets (neither is ever empty)."""
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared)


def with_next(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with next_text: the text of the next document by descending doc_id, the first one's after the last."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", text_or_empty().alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("_id"))
    n = max(2, 2 * shuffle_partitions(spark))
    limits = rows.agg(F.percentile_approx("_id", [i / n for i in range(1, n)], 100 * n)).head()[0] or []
    limits = sorted(set(limits))
    # two steps: which stretch of limits, then which limit in it
    step = max(1, math.isqrt(len(limits)))
    coarse, every = F.array(*map(F.lit, limits[step - 1:: step] or [_LEAST])), F.array(*map(F.lit, limits or [_LEAST]))
    at = F.size(F.filter(coarse, lambda x: x < F.col("_id"))) * step
    rows = rows.withColumn("_range", at + F.size(F.filter(F.slice(every, at + 1, step), lambda x: x < F.col("_id"))))
    heads = rows.groupBy("_range").agg(F.max("_id").alias("_head"))  # a row a range
    upward = Window.orderBy("_range")
    lent = heads.select("_head", F.coalesce(F.lead("_range").over(upward), F.min("_range").over(Window.partitionBy())).alias("_to"))
    guests = rows.join(F.broadcast(lent), F.col("_id") == F.col("_head")).select("doc_id", "text", "_id", F.col("_to").alias("_range"), F.lit(1).alias("_guest"))
    inside = Window.partitionBy("_range").orderBy("_guest", F.desc("_id"), F.desc("text"))
    everyone = rows.withColumn("_guest", F.lit(0)).unionByName(guests)
    return everyone.withColumn("next_text", F.lead("text").over(inside)).where("_guest = 0").select("doc_id", "text", "next_text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, sigs): the signature set of every row."""
    prepare(docs.sparkSession)
    return with_signatures(docs.select("doc_id", text_or_empty().alias("text")), {"sigs": "text"}).select("doc_id", "sigs")


def near_duplicates(docs: DataFrame, at_least: float = LIKENESS) -> tuple[DataFrame, DataFrame]:
    """(members, links): members(doc_id, class_id) of every row, class_id its signature set's; links(a, b, likeness) between
    classes whose sets are alike at ``at_least`` or more, a < b."""
    prints = fingerprints(docs).withColumn("class_id", F.xxhash64("sigs"))
    members = prints.select("doc_id", "class_id")
    classes = prints.groupBy("class_id").agg(F.first("sigs").alias("sigs")).withColumn("n", F.size("sigs"))
    ratio = -math.log(at_least)
    part = F.floor(F.log("n") / ratio + 1e-9).cast("int")
    first = F.slice("sigs", 1, (F.col("n") - F.ceil(F.col("n") * at_least - 1e-9) + 1).cast("int"))
    index = classes.select("class_id", "n", part.alias("part"), F.explode(first).alias("sig")).checkpoint()
    near = index.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), "sig", F.explode(F.array(F.col("part") - 1, F.col("part"), F.col("part") + 1)).alias("part"))
    pairs = (
        index.select(F.col("class_id").alias("a"), F.col("n").alias("na"), "sig", "part").join(near, ["sig", "part"])
        .where((F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.greatest("na", "nb") * at_least - 1e-9)).select("a", "b").distinct()
    )
    sets = classes.select("class_id", "sigs")
    found = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").withColumn("likeness", likeness(F.col("sa"), F.col("sb")))
    return members, found.where(F.col("likeness") >= at_least).select("a", "b", "likeness")


def compare_edits(docs: DataFrame) -> DataFrame:
    """Each text against its edit (its last half replaced by the start of the next document) and against the next document."""
    prepare(docs.sparkSession)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = with_next(docs).select(
        "doc_id", "text", n.cast("long").alias("n_chars"), "next_text",
        F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)).alias("edited"),
    )
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    sets = with_signatures(rows, {"own": "text", "edit": "edited", "next": "next_text"})
    return sets.select(
        "doc_id", "n_chars", "edited_sha256", spelled(F.col("own")).alias("fingerprint"), spelled(F.col("edit")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edit")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(documents(spark, sf_dir))


QUERIES = {"op4_spotsigs_fingerprints": op4_spotsigs}
