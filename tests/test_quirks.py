"""Remaining SURVEY 1.6 rules: Q3, Q5, Q13, Q14, Q15, Q16, Q18, Q19."""

from decimal import Decimal

from pyspark.sql import functions as F

from venuelens.functions import round_half_up
from venuelens.operators import aggregates as A
from venuelens.operators import cleaning as C
from venuelens.operators import filters as Fl
from venuelens.operators import joins as J
from venuelens.sources import payloads as PL


def _lst(spark, rows):
    return spark.createDataFrame([(a, b, c, d, Decimal(str(p)), Decimal(str(r))) for a, b, c, d, p, r in rows],
                                 "listing_id long, name string, area string, category string, "
                                 "price decimal(10,2), rating decimal(3,1)")


def test_q3_distinct_area_counts_blank(spark):
    df = _lst(spark, [(1, "a", "", "c", 1, 1), (2, "b", "X", "c", 1, 1)])
    assert A.overview(df).first().area_count == 2                      # '' counted, as in the reference
    assert [r.name for r in A.area_distribution(df).collect()] == ["X"]  # ... but not listed


def test_q5_round_half_up_on_decimal(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,)], "x double")
    assert [r[0] for r in df.select(round_half_up("x", 2)).collect()] == [1.01, 2.68, -1.01]


def test_q13_pages_do_not_overlap(spark):
    df = _lst(spark, [(i, "n", "a", "c", 10, 4.5) for i in range(45)])   # all ties on rating
    pages = [{r.listing_id for r in Fl.search_listings(df, page_no=p, page_size=20).collect()} for p in (1, 2, 3)]
    assert pages[0].isdisjoint(pages[1]) and pages[1].isdisjoint(pages[2])
    assert set().union(*pages) == set(range(45))


def test_q14_keyword_columns(spark):
    df = _lst(spark, [(1, "Blue Cafe", "North", "Tea", 1, 1), (2, "Red", "bluewater", "Tea", 1, 1),
                      (3, "Red", "South", "Tea", 1, 1)])
    all_cols = {r.listing_id for r in Fl.search_filter(df, keyword="BLUE").collect()}
    name_only = {r.listing_id for r in Fl.search_filter(df, keyword="blue", keyword_cols=("name",)).collect()}
    assert all_cols == {1, 2} and name_only == {1}


def test_q15_favorites_only_empty(spark):
    df = _lst(spark, [(1, "a", "x", "c", 1, 1)])
    fav = spark.createDataFrame([(9, 1)], "user_id long, listing_id long")
    assert J.favorites_only(df, fav, user=5).count() == 0                # a user without favorites sees nothing
    assert J.exclude_favorites(df, fav, user=5).count() == 1


def test_q16_zero_is_preserved(spark):
    df = spark.createDataFrame([("1", "a", 0.0, 0.0, 0)], "restaurant_id string, restaurant_name string, "
                                                         "avg_price double, rating_overall double, review_count long")
    r = C.to_output_record(df).first()
    assert (r.avg_price, r.rating, r.review_count) == (0.0, 0.0, 0)


def test_q18_address_and_phone_join_non_null_parts(spark):
    payload = ('{"code": 200, "msg": {"shopInfo": {"shopName": "s", "address": null, "crossRoad": "<b>x路</b>", '
               '"phoneNo": "1", "phoneNo2": null}}}')
    df = spark.createDataFrame([(1, payload), (2, '{"code": 500}')], "id long, p string")
    rows = PL.flatten_api_payload(df, "id", "p", "shop").collect()
    assert [(r.id, r.address, r.phone) for r in rows] == [(1, "x路", "1")]   # code 500 dropped


def test_payloads_are_parsed_once(spark):
    body = '{"reviewDataVO": {"reviewData": {"reviewId": 7, "star": 4, "reviewBody": "<p>x</p>"}}, "picList": [{"bigPicture": "y"}]}'
    rows = [(1, f'{{"code": 200, "reviewCountAll": "z", "dishTagStrList": ["d"], "reviewAllDOList": [{body}, {body}]}}'),
            (2, f'{{"code": 500, "reviewAllDOList": [{body}]}}'), (3, "no json"), (4, None), (5, '{"code": 200}')]
    df = spark.createDataFrame(rows, "id long, p string").select("id", F.concat(F.lit(" "), "p").alias("p"))
    for kind, want in (("reviews", 2), ("summary", 2), ("score", 2), ("shop", 2)):
        out = PL.flatten_api_payload(df, "id", "p", kind)
        assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1, kind
        assert out.count() == want
    got = PL.flatten_api_payload(df, "id", "p", "reviews").collect()
    assert [(r.id, r.review_id, r.star, r.body, r.liked_dishes, r.pictures) for r in got] == [(1, 7, 4, "x", [], ["y"])] * 2
    got = PL.flatten_api_payload(df, "id", "p", "summary").collect()
    assert sorted((r.id, r.all_count, r.dish_tags) for r in got) == [(1, None, ["d"]), (5, None, None)]


def test_q19_backlog_is_anti_join(spark):
    df = _lst(spark, [(1, "a", "x", "c", 1, 1), (2, "b", "x", "c", 1, 1)])
    done = spark.createDataFrame([(2,)], "listing_id long")
    assert [r.listing_id for r in J.fetch_backlog(df, done).collect()] == [1]
    assert F is not None


def test_broken_records_give_values_instead_of_errors(spark):
    """A repeated label or title keeps its last value; an empty list of extras gives an empty list."""
    from pyspark.sql import functions as F

    from venuelens.functions.cleaning import split_score_text, zip_scores
    df = spark.createDataFrame([("口味：4.5 环境：4.0 口味：3.0 人均：88元", ["a", "b", "a"], ["1", "2", "3", "4"])], "s string, t array<string>, v array<string>")
    got = df.select(split_score_text("s").alias("m"), zip_scores("t", "v").alias("z")).head()
    assert got.m == {"口味": "3.0", "环境": "4.0"} and got.z == {"a": "3", "b": "2"}
    assert df.select(split_score_text(F.lit("novalue")).alias("m")).head().m == {"novalue": None}


def test_upsert_follows_event_order_not_arrival(spark, tmp_path):
    """Changes of one key that arrive in the wrong order, and one more batch after a restart."""
    from venuelens.streaming import jobs as G
    out = str(tmp_path / "changes")
    for batch, rows in enumerate([[(1, 5, "new")], [(1, 3, "old"), (2, 1, "x")], [(2, 1, "y")]]):
        spark.createDataFrame(rows, "id int, ts int, v string").selectExpr("*", f"{batch}L as _batch").write.parquet(f"{out}/batch={batch:08d}")
    assert {r.id: r.v for r in G.latest_state(spark, out, ["id"], ["ts"]).collect()} == {1: "new", 2: "y"}


def test_ranks_keep_ties(spark):
    from venuelens.operators import windows as W
    df = spark.createDataFrame([(i, 4.0, 50.0 if i < 29 else 100.0 + i, 1, 1, "c") for i in range(40)],
                               "listing_id int, rating double, price double, review_count int, sales int, category string")
    assert W.value_for_money_rank(df, 1, None).count() == 29 == W.value_for_money_rank(df, 1).count()
    assert W.hot_rank(df, k=5).count() == 40
