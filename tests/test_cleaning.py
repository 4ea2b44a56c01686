"""Cleaning scalars and pipelines on literal rows: the quirks of SURVEY 1.6."""

import re

from pyspark.sql import functions as F

from venuelens import dims
from venuelens.functions import (blank_to_null, derive_key, mask_phone, parse_count, parse_number,
                                 rating_to_sentiment, split_score_text, sum_sentiment_counts, zip_scores)
from venuelens.operators import cleaning as C
from venuelens.plans import cleaning as P


def col_values(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_mask_phone_styles(spark):
    df = spark.createDataFrame([("13812345678",), ("021-12345",), ("12345",), (None,), ("138 1234 5678",)], "p string")
    strict = col_values(df.select(mask_phone("p", "strict").alias("m")), "m")
    eleven = col_values(df.select(mask_phone("p", "eleven").alias("m")), "m")
    assert strict == ["138****5678", "021****2345", None, None, "138****5678"]
    assert eleven == ["138****5678", "021-12345", "12345", None, "138****5678"]
    # the strict style never emits a raw 7+ digit run
    for v in strict:
        assert v is None or not re.search(r"\d{7,}", v)


def test_parse_number_and_count(spark):
    df = spark.createDataFrame([("¥88.5元",), ("-",), ("-12",), ("abc",), ("2.5",), ("3.5",), ("12条评价",)], "x string")
    out = df.select(parse_number("x").alias("n"), parse_count("x").alias("c"),
                    parse_count("x", 0, "digits").alias("d")).collect()
    assert [r.n for r in out] == [88.5, 0.0, -12.0, 0.0, 2.5, 3.5, 12.0]
    assert [r.c for r in out] == [88, 0, -12, 0, 2, 4, 12]          # half-even (Q6)
    assert [r.d for r in out] == [0, 0, 0, 0, 25, 35, 12]          # digits only when text starts with a digit
    strict = df.select(parse_number("x", 0.0, strict=True).alias("s")).collect()
    assert [r.s for r in strict] == [0.0] * 4 + [0.0, 0.0, 0.0]     # signed / decorated prices fail the gate (Q11)


def test_blank_to_null(spark):
    df = spark.createDataFrame([(" - ",), ("nan",), ("",), (" x ",), (None,)], "x string")
    assert col_values(df.select(blank_to_null("x").alias("y")), "y") == [None, None, None, "x", None]


def test_district_exact_and_contains(spark):
    df = spark.createDataFrame([("浦东",), (" 黄浦区 ",), ("xx",), (None,)], "district string")
    assert col_values(C.normalize_area_exact(df), "district") == ["浦东新区", "黄浦区", None, None]
    rows = spark.createDataFrame([
        (None, None, "上海市虹桥路1号"),      # 虹桥 is listed under two districts: the first (长宁区) wins
        ("闵行区七宝", None, None),           # an area name before any business area (Q9)
        ("", "七宝", "静安寺旁"),             # first non-blank text decides
        (None, None, "nowhere"),
    ], "district string, business_area string, address string")
    got = col_values(C.normalize_area_contains(rows), "district")
    assert got == ["长宁区", "闵行区", "闵行区", None]


def test_category_synonyms_first_group_wins(spark):
    long = "x" * 60
    df = spark.createDataFrame([("四川火锅",), ("",), ("BBQ烧烤",), (long,), (None,)], "cuisine_type string")
    got = col_values(C.normalize_category_synonym(df), "cuisine_type")
    assert got == ["川菜", "其他", "烧烤", "x" * 60, "其他"]       # 火锅 sits under 川菜 first (Q10)


def test_merge_and_area_rules(spark):
    df = spark.createDataFrame([("粤菜馆", "陆家嘴商圈", "x"), ("洗浴中心", "x", "杨浦区长海路"), ("火锅", None, "无")],
                               "tag string, ba string, addr string")
    merged = col_values(C.merge_categories(df, "tag"), "tag")
    assert merged == ["粤菜/港式", None, "火锅"]
    area = col_values(C.infer_area_rules(df, "ba", "addr", exact_late=dims.AREA_RULES_EXACT_LATE), "district")
    assert area == ["浦东新区", "杨浦区", "浦东新区"]               # default when nothing matches


def test_dedupe_first_and_last(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "z")], "k int, o int, v string")
    first = {r.k: r.v for r in C.dedupe(df, ["k"], ["o"]).collect()}
    last = {r.k: r.v for r in C.last_wins(df, ["k"], ["o"]).collect()}
    assert first == {1: "a", 2: "z"} and last == {1: "c", 2: "z"}


def test_enforce_schema(spark):
    df = spark.createDataFrame([("a", "4.5"), ("", "9.9"), ("b", "x")], "id string, rating string")
    valid, rej = C.enforce_schema(df, {"id": {"not_null": True}, "rating": {"type": "decimal(3,1)", "max": 5}})
    assert [r.id for r in valid.collect()] == ["a"]
    reasons = {r.id: sorted(r.rejected_reason) for r in rej.collect()}
    assert reasons == {"": ["id:not_null", "rating:max"], "b": ["rating:type"]}


def test_clean_listing_defaults_every_row_and_logs(spark):
    df = spark.createDataFrame([("A店", "021-12345", "88"), ("B店", None, "x"), (" ", "13812345678", "1"),
                                ("A店", "1", "2")], "`﻿name` string, tel string, price string")
    out = P.clean_listing(df, at="2024-01-01 00:00:00")
    rows = out.collect()
    assert len(rows) == 2                                       # one duplicate, one blank name removed
    assert {r.data_source for r in rows} == {"import"}          # Q7: every row, not only the first
    assert {r.restaurant_name for r in rows} == {"A店", "B店"}    # BOM stripped from the header, name column found
    assert {r.avg_price for r in rows} == {88.0, 0.0}
    log = P.clean_listing_log(df, "t", at="2024-01-01 00:00:00").orderBy("seq").collect()
    assert [(r.stage, r.record_count) for r in log] == [("load", 4), ("dedup", 1), ("validate", 1), ("validate", 2)]


def test_transform_listing_keys_and_districts(spark):
    df = spark.createDataFrame([("", "老店", "上海市静安寺路1号", "¥50", "4.5分", "12条"),
                                ("nan", "新店", None, "-", "n/a", "3.5"),
                                ("x1", "nan", "a", "1", "1", "1")],
                               "id string, name string, address string, price string, rating string, reviews string")
    out = {r.restaurant_name: r for r in P.transform_listing(df, "src", "2024-01-01 00:00:00").collect()}
    assert set(out) == {"老店", "新店"}
    assert out["老店"].restaurant_id.startswith("ds_") and len(out["老店"].restaurant_id) == 23
    assert out["老店"].district == "静安区" and out["老店"].avg_price == 50.0 and out["老店"].review_count == 12
    assert out["新店"].review_count == 4 and out["新店"].cuisine_type == "其他"
    seed = spark.createDataFrame([("src|老店|上海市静安寺路1号",)], "s string")
    assert seed.select(derive_key(["s"], 20, "ds_")).first()[0] == out["老店"].restaurant_id


def test_migrate_drops_null_tags(spark):
    cols = P.LANDING_COLUMNS
    df = spark.createDataFrame([("1", "a", "-", "", "88", "4.5", "12条评价", "火锅", "陆家嘴商圈"),
                                ("2", "b", "x", "1", "¥9", "x", "abc", None, ""),
                                ("3", "c", "x", "1", "9", "5", "1", "洗浴中心", "")],
                               ", ".join(f"`{cols[k]}` string" for k in
                                         ["id", "name", "address", "phone", "price", "rating", "reviews", "tag1",
                                          "tag2"]))
    out = P.migrate_listing(df, at="2024-01-01 00:00:00").collect()
    assert [r.restaurant_id for r in out] == ["dp_1"]           # NULL tag and excluded tag both dropped (Q12)
    r = out[0]
    assert (r.address, r.phone, r.avg_price, r.rating_overall, r.review_count, r.cuisine_type, r.district) == \
        (None, None, 88.0, 4.5, 12, "火锅", "浦东新区")


def test_score_text_is_split_once_a_row(spark):
    df = spark.createDataFrame([("a：1 b：2 a：3 人均：88元",), ("",), ("x",), (None,)], "s string")
    out = df.select(split_score_text("s").alias("m"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    assert [r.m for r in out.collect()] == [{"a": "3", "b": "2"}, {"": None}, {"x": None}, None]


def test_labels_are_looked_up_only_if_repeated(spark):
    df = spark.createDataFrame([("a：1  b：2 人均：1元 a：3 a", 1), ("a：1 c：x：y", 2), ("人均：88元", 3)], "s string, i int")
    out = df.select("i", split_score_text("s").alias("m"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN (size(array_distinct" in plan and "map_filter" not in plan
    assert {r.i: r.m for r in out.collect()} == {1: {"a": None, "b": "2"}, 2: {"a": "1", "c": "x：y"}, 3: {}}


def test_score_text_is_built_once_a_row(spark, tmp_path):
    from venuelens.registry import queries
    spark.sql("SELECT 7L AS o_orderkey, 3L AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(7, 5, 1, 20.0, 0.04, 0.02), (7, 6, 2, None, 0.1, 0.0), (8, 6, 1, 1.0, 0.1, 0.0)],
                          "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double"
                          ).selectExpr("*", "TIMESTAMP '2024-01-01' AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    out = queries()["score_text_fields"](spark, str(tmp_path))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("concat_ws") == 1
    assert {r.review_id: (r.scores, r.price_token) for r in out.collect()} == {
        "7-1-5": ({"taste": "2.0", "environment": "2.0", "service": "1.0"}, "10"),
        "7-2-6": ({"environment": "5.0", "service": "0.0"}, "20")}


def test_score_helpers(spark):
    df = spark.createDataFrame([("口味：4.5 环境：4.0 人均：88元", "4", "x", "1")], "s string, g string, m string, b string")
    r = df.select(split_score_text("s").alias("m"), sum_sentiment_counts("g", "b", "b").alias("t"),
                  sum_sentiment_counts("g", "m", "b").alias("u"),
                  zip_scores(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("1"))).alias("z"),
                  rating_to_sentiment(F.lit(4.5)).alias("rs")).first()
    assert r.m == {"口味": "4.5", "环境": "4.0"} and r.t == "6" and r.u == "-" and r.z == {"a": "1"} and r.rs == 0.75


def test_clean_listing_district_step_and_warning(spark):
    df = spark.createDataFrame([("1", "甲", "浦东"), ("2", "乙", "未知区"), ("3", "丙", None)],
                               "id string, `餐厅名称` string, `区域` string")
    out = {r.restaurant_id: r.district for r in P.clean_listing(df, at="2024-01-01 00:00:00").collect()}
    assert out == {"1": "浦东新区", "2": None, "3": None}
    log = {r.seq: r for r in P.clean_listing_log(df, "t", at="2024-01-01 00:00:00").collect()}
    assert (log[3].stage, log[3].level, log[3].record_count) == ("normalize", "WARNING", 1)
