"""Reports (B1-B5): the report and dashboard sections as one long table.

Each section is an aggregate operator over the same (optionally filtered)
listing frame; the sections are stacked with ``unionByName`` into
``(section, label, value, rank)``, ranks numbered within each section over
its (already aggregated, small) rows.  Callers that render several sections
should persist the filtered listing frame first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import dims
from ..operators import aggregates as A
from ..operators import compete as P
from ..operators import filters as Fl
from ..operators import joins as J


def _section(df: DataFrame, name: str, label: str, value: str, order) -> DataFrame:
    return df.select(F.lit(name).alias("section"), F.col(label).cast("string").alias("label"),
                     F.col(value).cast("double").alias("value"), *[o.alias(f"_o{i}") for i, o in enumerate(order)])


def _ranked(parts: list[DataFrame]) -> DataFrame:
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    w = Window.partitionBy("section").orderBy("_o0", "_o1")
    return u.withColumn("rank", F.row_number().over(w).cast("long")).drop("_o0", "_o1")


# ---- B1 ----------------------------------------------------------------------------
def _bucket_conds(x, buckets, closed: str, close_last: bool):
    out = []
    for i, (label, lo, hi) in enumerate(buckets):
        last = i == len(buckets) - 1
        if closed == "right":
            c = x > F.lit(lo) if hi is None else (x > F.lit(lo)) & (x <= F.lit(hi))
        else:
            c = x >= F.lit(lo)
            if hi is not None:
                c = c & ((x <= F.lit(hi)) if (last and close_last) else (x < F.lit(hi)))
        out.append((i + 1, label, c))
    return out


def listing_summary(df: DataFrame, price_digits: int = 1) -> DataFrame:
    """One pass over the listings: a grouping-sets aggregate ((area), (category), ())
    carrying every count, average and bucket count the report and dashboard need.

    The result is small (one row per area and per category) and is written once
    with a reliable ``checkpoint()``: otherwise Catalyst pushes each consumer's
    grouping-id filter below the aggregate and every section would read the
    input again.  ``gid``: 1 = per area, 2 = per category, 3 = total.
    """
    from ..functions import avg_rounded
    from ..session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    price, rating = F.col("price"), F.col("rating")
    pbuckets = _bucket_conds(price, dims.PRICE_BUCKETS, "right", False)
    rbuckets = _bucket_conds(rating, dims.RATING_BUCKETS, "left", True)
    return df.groupingSets([["area"], ["category"], []], "area", "category").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(avg_rounded(F.nullif(rating, F.lit(0))), F.lit(0.0)).alias("avg_rating"),
        F.coalesce(avg_rounded(F.nullif(price, F.lit(0))), F.lit(0.0)).alias("avg_price"),
        avg_rounded(F.when(price > 0, price), price_digits).alias("area_price"),
        *[F.count_if(c).alias(f"pb{i}") for i, _, c in pbuckets],
        *[F.count_if(c).alias(f"rb{i}") for i, _, c in rbuckets],
        F.grouping_id().alias("gid")).checkpoint()


def summary_sections(g: DataFrame, known_areas) -> dict[str, DataFrame]:
    """The report / dashboard sections as projections of ``listing_summary``."""
    spark = g.sparkSession
    areas = g.where(F.col("gid") == 1)
    cats = g.where(F.col("gid") == 2)
    total = g.where(F.col("gid") == 3)
    nonblank_area = F.col("area").isNotNull() & (F.col("area") != "")
    nonblank_cat = F.col("category").isNotNull() & (F.col("category") != "")
    area_count = areas.where(F.col("area").isNotNull()).select(F.count(F.lit(1))).scalar()   # Q3: '' counts
    overview = total.select(F.col("n").alias("total_count"), "avg_rating", "avg_price",
                            area_count.alias("area_count"))

    def bucket_rows(prefix, buckets):
        return total.select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("bucket"), F.lit(lab).alias("label"), F.col(f"{prefix}{i}").alias("count"))
            for i, (lab, _, _) in enumerate(buckets, start=1)])))
    known = F.broadcast(dims.words_df(spark, list(dict.fromkeys(known_areas)), "name"))
    ap = (known.join(areas.where(nonblank_area & F.col("area_price").isNotNull())
                     .select(F.col("area").alias("name"), F.col("area_price").alias("avg_price")), "name", "full_outer")
          .select("name", F.coalesce("avg_price", F.lit(0.0)).alias("avg_price")))
    cat_rows = cats.where(nonblank_cat).select(F.col("category").alias("name"), F.col("n").alias("count"))
    total_cat = cat_rows.select(F.sum("count")).scalar()
    from ..functions import round_half_up
    return {
        "overview": overview,
        "area_distribution": areas.where(nonblank_area).select(F.col("area").alias("name"), F.col("n").alias("count")),
        "category_distribution": cat_rows.withColumn("percentage",
                                                     round_half_up(F.col("count") * 100.0 / total_cat, 2)),
        "price_distribution": bucket_rows("pb", dims.PRICE_BUCKETS),
        "rating_distribution": bucket_rows("rb", dims.RATING_BUCKETS),
        "area_avg_price": ap,
    }


def report_dataset(df: DataFrame, known_areas=dims.KNOWN_DISTRICTS, top_n: int = 12, price_digits: int = 1
                   ) -> DataFrame:
    """All report sections - overview, area, category, price and rating buckets, area
    average price (``price_digits``), top categories - from one pass over the listings
    (``listing_summary``)."""
    sec = summary_sections(listing_summary(df, price_digits), known_areas)
    ov = sec["overview"]

    def ov_row(i, label):
        return F.struct(F.lit(float(i)).alias("i"), F.lit(label).alias("label"), F.col(label).cast("double").alias("value"))
    ov_long = ov.select(F.explode(F.array(*[ov_row(i, c) for i, c in enumerate(
        ["total_count", "avg_rating", "avg_price", "area_count"])])).alias("s")).select("s.*")
    cat_rows = sec["category_distribution"]
    parts = [
        _section(ov_long, "overview", "label", "value", [F.col("i"), F.col("label")]),
        _section(sec["area_distribution"], "area", "name", "count", [-F.col("count").cast("double"), F.col("name")]),
        _section(cat_rows, "category", "name", "count", [-F.col("count").cast("double"), F.col("name")]),
        _section(sec["price_distribution"], "price", "label", "count",
                 [F.col("bucket").cast("double"), F.col("label")]),
        _section(sec["rating_distribution"], "rating", "label", "count",
                 [F.col("bucket").cast("double"), F.col("label")]),
        _section(sec["area_avg_price"], "area_price", "name", "avg_price", [-F.col("avg_price"), F.col("name")]),
        _section(cat_rows.orderBy(F.desc("count"), F.asc("name")).limit(top_n), "top_category", "name", "count",
                 [-F.col("count").cast("double"), F.col("name")]),
    ]
    return _ranked(parts)


# ---- B2 ----------------------------------------------------------------------------
def report_facts(df: DataFrame, known_areas=dims.KNOWN_DISTRICTS, n_top: int = 3) -> DataFrame:
    """Sentence facts: totals, top areas, top category, highest / lowest area price."""
    ov = A.overview(df)
    top_areas = A.area_distribution(df).limit(n_top)
    # at most n_top rows reach this aggregate
    top_txt = top_areas.agg(F.array_sort(F.collect_list(
        F.struct((-F.col("count")).alias("neg"), F.col("name").alias("name")))).alias("a")) \
        .select(F.concat_ws(", ", F.transform("a", lambda s: F.format_string("%s (%d)", s["name"], -s["neg"])))
                .alias("t"))
    cat = A.area_distribution(df, "category").limit(1).select(F.format_string("%s (%d)", "name", "count").alias("t"))
    ap = A.area_avg_price(df, known_areas, 2)
    hi = ap.orderBy(F.desc("avg_price"), F.asc("name")).limit(1).select(
        F.format_string("%s (%.2f)", "name", "avg_price").alias("t"))
    lo = ap.orderBy(F.asc("avg_price"), F.asc("name")).limit(1).select(
        F.format_string("%s (%.2f)", "name", "avg_price").alias("t"))
    facts = ov.select(
        F.lit("total").alias("key"),
        F.format_string("%d listings in %d areas, average rating %.2f, average price %.2f", "total_count",
                        "area_count", "avg_rating", "avg_price").alias("text"))
    for key, part in (("top_areas", top_txt), ("top_category", cat), ("max_area_price", hi),
                      ("min_area_price", lo)):
        facts = facts.unionByName(part.select(F.lit(key).alias("key"), F.col("t").alias("text")))
    return facts


# ---- B3 ----------------------------------------------------------------------------
def market_report(df: DataFrame, known_areas=dims.KNOWN_DISTRICTS, seen_from: str | None = None,
                  seen_before: str | None = None, **filters) -> DataFrame:
    """The report restricted by area / category / price range (search filters) and by when a
    listing was seen: from ``seen_from`` on, before ``seen_before``."""
    if seen_from is not None:
        df = df.where(F.col("seen_at") >= F.lit(seen_from).cast("timestamp_ntz"))
    if seen_before is not None:
        df = df.where(F.col("seen_at") < F.lit(seen_before).cast("timestamp_ntz"))
    return report_dataset(Fl.search_filter(df, **filters), known_areas)


# ---- B4 ----------------------------------------------------------------------------
def competitor_report(df: DataFrame, rv: DataFrame, listing_id, band: float = 0.2,
                      sentiment: DataFrame | None = None) -> DataFrame:
    """One listing: its competitors, metric comparison with their mean, strength/weakness
    flags and SWOT flags, as (section, label, value) text rows. The target reaches every part:
    only its own competitors are paired, and totals read its segment alone."""
    target = df.where(F.col("listing_id") == F.lit(listing_id)).select("listing_id")
    peers = J.find_competitors(df, band, targets=df.join(target, "listing_id", "left_semi"))
    comp = peers.select(F.lit("competitors").alias("section"), F.col("competitor_id").cast("string").alias("label"),
                        F.col("price_gap").cast("string").alias("value"))
    mets = ["price", "rating", "sales", "review_count"]
    own = df.join(target, "listing_id", "left_semi").select(*[F.col(m).cast("double").alias(m) for m in mets])
    peer_mean = df.join(peers.select(F.col("competitor_id").alias("listing_id")), "listing_id", "left_semi").agg(
        *[F.avg(F.col(m).cast("double")).alias(m) for m in mets])
    cmp_rows = own.select(F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).alias("v")) for m in mets]))
                          .alias("s")).select(F.lit("compare_own").alias("section"), F.col("s.m").alias("label"),
                                              F.format_string("%.2f", F.col("s.v")).alias("value"))
    cmp_peer = peer_mean.select(F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).alias("v")) for m in mets]))
                                .alias("s")).where(F.col("s.v").isNotNull()).select(
        F.lit("compare_peers").alias("section"), F.col("s.m").alias("label"),
        F.format_string("%.2f", F.col("s.v")).alias("value"))
    reviewed = rv.join(peers.select(F.col("competitor_id").alias("listing_id")).unionAll(target), "listing_id", "left_semi")
    sw = P.strengths_weaknesses(reviewed, df, band, targets=target).select(F.lit("strengths_weaknesses").alias("section"), F.col("dimension").alias("label"),
                F.col("flag").alias("value"))
    sw_all = P.swot(df, band, sentiment, target)
    swot_rows = sw_all.select(F.explode(F.array(
        *[F.struct(F.lit(k).alias("k"), F.array_join(F.col(k), ",").alias("v"))
          for k in ("strengths", "weaknesses", "opportunities", "threats")])).alias("s")).select(
        F.lit("swot").alias("section"), F.col("s.k").alias("label"), F.col("s.v").alias("value"))
    return comp.unionByName(cmp_rows).unionByName(cmp_peer).unionByName(sw).unionByName(swot_rows)


# ---- B5 ----------------------------------------------------------------------------
def dashboard(df: DataFrame, rv_text: DataFrame, known_areas=dims.KNOWN_DISTRICTS, lexicon: dict | None = None,
              **kw) -> dict[str, DataFrame]:
    """The seven dashboard results (A1-A7), each a lazy DataFrame over the same input."""
    from ..operators.text import review_keywords
    out = summary_sections(listing_summary(df, 2), known_areas)     # one pass over the listings
    out["review_keywords"] = review_keywords(rv_text, lexicon or dims.flatten_polarity(dims.SENTIMENT_DICT), **kw)
    return out


def dashboard_long(results: dict[str, DataFrame]) -> DataFrame:
    """The dashboard results stacked as (section, label, value) text rows."""
    out = None
    for name, d in results.items():
        label = next(c for c in ("name", "label", "word") if c in d.columns) if name != "overview" else None
        if name == "overview":
            part = d.select(F.explode(F.array(*[F.struct(F.lit(c).alias("l"), F.col(c).cast("string").alias("v"))
                                                for c in d.columns])).alias("s")).select(
                F.lit(name).alias("section"), F.col("s.l").alias("label"), F.col("s.v").alias("value"))
        else:
            val = next(c for c in ("count", "avg_price") if c in d.columns)
            lab = F.concat_ws(":", F.col("polarity"), F.col(label)) if "polarity" in d.columns else F.col(label)
            part = d.select(F.lit(name).alias("section"), lab.alias("label"), F.col(val).cast("string").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out
