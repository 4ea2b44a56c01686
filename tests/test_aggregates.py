"""Bucket edges, shares, known-area lists and grouping sets on literal rows."""

from decimal import Decimal

from venuelens.operators import aggregates as A
from venuelens.operators import windows as W


def _dec(x):
    return None if x is None else Decimal(str(x))


def _listing(spark, rows):
    rows = [(a, b, c, d, _dec(p), _dec(r)) for a, b, c, d, p, r in rows]
    return spark.createDataFrame(rows, "listing_id long, name string, area string, category string, "
                                       "price decimal(10,2), rating decimal(3,1)")


def test_price_buckets_edges(spark):
    prices = [0, 50, 50.01, 100, 200, 200.01, None, 10]
    df = _listing(spark, [(i, "n", "a", "c", p, 1) for i, p in enumerate(prices)])
    got = {r.bucket: r["count"] for r in A.price_distribution(df).collect()}
    assert got == {1: 2, 2: 2, 3: 1, 4: 1}              # 0 and NULL fall in none (Q1)


def test_rating_buckets_closed_and_open(spark):
    ratings = [0, 2.9, 3.0, 4.4, 4.5, 5.0]
    df = _listing(spark, [(i, "n", "a", "c", 10, r) for i, r in enumerate(ratings)])
    closed = [r["count"] for r in A.rating_distribution(df).orderBy("bucket").collect()]
    opened = [r["count"] for r in A.rating_distribution(df, right_closed=False).orderBy("bucket").collect()]
    assert closed == [2, 1, 1, 2] and opened == [2, 1, 1, 1]   # 0 in the first bucket, 5.0 only when closed (Q2)


def test_empty_buckets_emitted(spark):
    df = _listing(spark, [(1, "n", "a", "c", 10, 1)])
    assert A.price_distribution(df.where("price > 1000")).count() == 4


def test_overview_and_percentages(spark, tables):
    lst = tables.listing()
    ov = A.overview(lst).first()
    assert ov.total_count == lst.count() and ov.avg_rating > 0
    cats = A.category_distribution(lst).collect()
    assert abs(sum(r.percentage for r in cats) - 100) < 0.1
    assert sum(r["count"] for r in A.price_distribution(lst).collect()) == lst.where("price > 0").count()


def test_area_avg_price_known_and_extra(spark):
    df = _listing(spark, [(1, "n", "X", "c", 10, 1), (2, "n", "X", "c", 20, 1), (3, "n", "Y", "c", 0, 1),
                          (4, "n", "", "c", 99, 1)])
    got = {r.name: r.avg_price for r in A.area_avg_price(df, ["K1", "X"]).collect()}
    assert got == {"K1": 0.0, "X": 15.0}                # blank area dropped (Q4), Y has no positive price


def test_source_breakdown_levels(spark, tables):
    lst = tables.listing()
    out = A.source_breakdown(lst).collect()
    total = [r["count"] for r in out if r.level == "total"]
    assert total == [lst.count()]
    assert sum(r["count"] for r in out if r.level == "area") == lst.count()


def test_top_bottom_ranks(spark):
    agg = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 2.0), ("d", 2.0)], "name string, v double")
    rows = {(r.side, r.rank): r.name for r in W.top_bottom(agg, "v", "name", 2).collect()}
    assert rows == {("top", 1): "a", ("top", 2): "c", ("bottom", 1): "b", ("bottom", 2): "c"}


def test_hot_rank_top_is_global_rank(spark, tables):
    lst = tables.listing()
    top = W.hot_rank(lst, k=5).orderBy("rank").collect()
    assert [r.rank for r in top][0] == 1 and len(top) == 5
    assert top[0].hot_score >= top[-1].hot_score


def test_ranked_within_matches_row_number_on_hot_group(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rows = [(0 if i < 3000 else i % 7, i, (i * 37) % 101) for i in range(4000)]   # group 0 holds 3/4 of the rows
    df = spark.createDataFrame(rows, "g long, id long, v long")
    order = [F.desc("v"), F.asc("id")]
    got = W.ranked_within(df, ["g"], order, "r", num_partitions=16)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert sorted(got.select("g", "id", "r").collect()) == sorted(want.select("g", "id", "r").collect())


def test_approx_profile_within_error(spark, tables):
    from pyspark.sql import functions as F
    lst, rv = tables.listing(), tables.review()
    r = A.approx_profile(lst, rv, rsd=0.02).first()
    exact_users = rv.select(F.countDistinct("user_id")).first()[0]
    assert abs(r.approx_listings - lst.count()) <= 0.06 * lst.count()
    assert abs(r.approx_users - exact_users) <= 0.06 * exact_users
    qs = sorted(float(x.price) for x in lst.where("price > 0").select("price").collect())
    med = qs[len(qs) // 2]
    assert abs(r.price_quartiles[1] - med) <= 0.02 * (qs[-1] - qs[0])


def test_merged_sketches_equal_one_sketch_of_all(spark, tables):
    from pyspark.sql import functions as F
    rv = tables.review()
    months = A.monthly_sketches(rv, "user_id", "rating")
    got = A.merge_sketches(months).first()
    whole = rv.select(F.hll_sketch_estimate(F.hll_sketch_agg("user_id", F.lit(12))).alias("u")).first().u
    assert got.n == rv.count() and abs(got.who - whole) <= 0.05 * whole
    flags = A.sketch_profile(rv, "user_id", "rating").collect()
    assert len(flags) == months.count() + 1 and all(r.who_within and r.median_within for r in flags)
