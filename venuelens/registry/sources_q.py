"""Sources S1-S12: round trips through files written from the driver tables, stored
payloads built from them, and the stored pages table."""

from __future__ import annotations

import json
import uuid

import pandas as pd
from pyspark.sql import functions as F

from ..operators import sinks as K
from ..sources import files as S
from ..sources import pages as PG
from ..sources import payloads as PL
from ..sources import records as RC
from ..sources import workbooks as WB
from ..session import scratch_path
from . import register

RAW_COLS = ["id", "title", "price", "rating", "reviews", "tel", "cuisine", "address", "area_tag"]
_RAW = "SELECT " + ", ".join(RAW_COLS) + " FROM raw_listing"


def _scratch(t, name):
    return scratch_path(t.spark, f"sources/{name}/{uuid.uuid4().hex}")


#: Rows of one written document or workbook.
FILE_ROWS = 10_000


def _json_array_files(df, path: str, wrap_key: str | None = None) -> None:
    """JSON documents of at most FILE_ROWS records under ``path``, one a file: an array of records, optionally wrapped in an object."""
    cols = df.columns

    def build(batches):
        for pdf in WB.row_groups(batches, FILE_ROWS):
            recs = [dict(zip(cols, r)) for r in pdf.astype(object).where(pdf.notna(), None).values.tolist()]
            doc = {wrap_key: recs, "meta": {"n": len(recs)}} if wrap_key else recs
            yield pd.DataFrame({"value": [json.dumps(doc, ensure_ascii=False)]})
    df.mapInPandas(build, "value string").write.option("maxRecordsPerFile", 1).text(path)


# ---- S1 / S5 -----------------------------------------------------------------------
@register("read_csv_listing", "SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_COLS) + " FROM raw_listing",
          ("raw_listing",))
def _read_csv(t):
    """CSV has no empty-string / missing distinction: an empty field reads back as NULL."""
    path = _scratch(t, "csv") + "/listing.csv"
    K.write_csv_export(t.raw_listing().select(*RAW_COLS), path)
    return S.read_csv_listing(t.spark, path)


@register("read_by_extension", _RAW, ("raw_listing",))
def _read_by_ext(t):
    path = _scratch(t, "ext") + "/listing.json"
    _json_array_files(t.raw_listing().select(*RAW_COLS), path)
    return S.read_by_extension(t.spark, path).select(*RAW_COLS)


# ---- S2 / S3 -----------------------------------------------------------------------
@register("read_json_records", _RAW, ("raw_listing",))
def _read_json(t):
    path = _scratch(t, "json")
    _json_array_files(t.raw_listing().select(*RAW_COLS), path)
    return S.read_json_records(t.spark, path).select(*RAW_COLS)


@register("read_json_wrapped", _RAW, ("raw_listing",))
def _read_json_wrapped(t):
    path = _scratch(t, "jsonw")
    _json_array_files(t.raw_listing().select(*RAW_COLS), path, "restaurants")
    return S.read_json_wrapped(t.spark, path, RAW_COLS)


# ---- S4 ----------------------------------------------------------------------------
@register("read_workbooks", _RAW, ("raw_listing",))
def _read_workbooks(t):
    rows = t.raw_listing().select(*RAW_COLS).repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    files = WB.workbooks_from_frame(rows, rows=FILE_ROWS)
    return WB.parse_workbook_frame(files, RAW_COLS).select(*RAW_COLS)


# ---- S7 ----------------------------------------------------------------------------
@register("read_raw_listing", _RAW, ("raw_listing",))
def _read_raw(t):
    path = _scratch(t, "landing")
    t.raw_listing().select(*RAW_COLS).write.parquet(path)
    return S.read_raw_listing(t.spark, path, "parquet", RAW_COLS)


# ---- S8 ----------------------------------------------------------------------------
@register("explode_review_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, 'a' AS tag FROM events
UNION ALL SELECT event_id, CAST(user_id AS INT), 'b' FROM events""")
def _explode_review_json(t):
    ev = t.events
    arr = F.concat(F.lit('[{"k": '), F.get_json_object("props", "$.k"), F.lit(', "tag": "a"}, {"k": '),
                   F.col("user_id").cast("string"), F.lit(', "tag": "b"}]'))
    return PL.explode_review_json(ev.select("event_id", arr.alias("j")), "event_id", "j",
                                  "array<struct<k: int, tag: string>>")


# ---- S12 ---------------------------------------------------------------------------
def _payloads(t):
    li = t.lineitem
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    review = F.struct(
        F.struct(F.struct((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("reviewId"),
                          F.col("l_quantity").cast("int").alias("star"),
                          F.concat(F.lit("<p>"), F.col("l_returnflag"), F.lit(" item "),
                                   F.col("l_partkey").cast("string"), F.lit("</p>")).alias("reviewBody"),
                          F.col("l_linenumber").alias("voteCount"), F.lit(0).alias("replyCount"),
                          (F.col("l_quantity") * 10).cast("int").alias("viewCount"),
                          (F.col("l_extendedprice") / F.col("l_quantity")).alias("avgPrice"),
                          F.array(F.struct(F.array("l_returnflag", "l_linestatus").alias("values")))
                          .alias("extInfoList")).alias("reviewData"),
                 F.date_format("l_shipdate", "yyyy-MM-dd").alias("addTimeVO"),
                 F.lit(None).cast("string").alias("followNoteString")).alias("reviewDataVO"),
        F.array(F.struct(F.concat(F.lit("http://img/"), F.col("l_partkey").cast("string")).alias("bigPicture")))
        .alias("picList"),
        F.struct(F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("userNickName"),
                 F.col("o_custkey").alias("userId")).alias("user"))
    # one payload per review line: no grouping, so no array grows with a hot key
    g = j.select("l_orderkey", "l_linenumber", "o_orderstatus", F.array(review).alias("reviewAllDOList"),
                 F.lit(1).cast("long").alias("reviewCountAll"),
                 (F.col("l_returnflag") == "R").cast("long").alias("reviewCountBad"),
                 (F.col("l_returnflag") == "N").cast("long").alias("reviewCountGood"),
                 (F.col("l_returnflag") == "A").cast("long").alias("reviewCountCommon"))
    code = F.when(F.col("o_orderstatus") == "P", F.lit(500)).otherwise(F.lit(200))
    payload = F.to_json(F.struct(code.alias("code"), "reviewCountAll", F.lit(0).alias("reviewCountPic"),
                                 "reviewCountGood", "reviewCountCommon", "reviewCountBad",
                                 F.array(F.lit("dish-a"), F.col("o_orderstatus")).alias("dishTagStrList"),
                                 "reviewAllDOList"))
    return g.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"), payload.alias("payload"))


@register("flatten_api_payload", """
SELECT l.l_orderkey * 10 + l.l_linenumber AS order_id, l.l_orderkey * 10 + l.l_linenumber AS review_id, o.o_custkey AS user_id,
       concat('u', CAST(o.o_custkey AS VARCHAR)) AS user_name, CAST(l.l_quantity AS INT) AS star,
       concat(l.l_returnflag, ' item ', CAST(l.l_partkey AS VARCHAR)) AS body, l.l_linenumber AS votes, 0 AS replies,
       CAST(l.l_quantity * 10 AS INT) AS views, l.l_extendedprice / l.l_quantity AS avg_price,
       [l.l_returnflag, l.l_linestatus] AS liked_dishes, strftime(l.l_shipdate, '%Y-%m-%d') AS published,
       CAST(NULL AS VARCHAR) AS reply, ['http://img/' || CAST(l.l_partkey AS VARCHAR)] AS pictures
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE o.o_orderstatus <> 'P'""")
def _flatten_reviews(t):
    return PL.flatten_api_payload(_payloads(t), "order_id", "payload", "reviews")


@register("flatten_api_summary", """
SELECT l.l_orderkey * 10 + l.l_linenumber AS order_id, CAST(1 AS BIGINT) AS all_count, CAST(0 AS BIGINT) AS pic_count,
       CAST(l.l_returnflag = 'N' AS BIGINT) AS good_count, CAST(l.l_returnflag = 'A' AS BIGINT) AS mid_count,
       CAST(l.l_returnflag = 'R' AS BIGINT) AS bad_count, ['dish-a', o.o_orderstatus] AS dish_tags
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE o.o_orderstatus <> 'P'""")
def _flatten_summary(t):
    return PL.flatten_api_payload(_payloads(t), "order_id", "payload", "summary")


@register("flatten_api_score", """
SELECT p_partkey AS part_id, CAST(p_size / 10.0 AS VARCHAR) AS score, CAST(p_retailprice AS VARCHAR) AS avg_price,
       CAST(p_size AS VARCHAR) AS review_count,
       map(['taste', 'setting'], [p_brand, p_type]) AS scores
FROM part""")
def _flatten_score(t):
    p = t.part
    payload = F.to_json(F.struct(
        F.lit(200).alias("code"), (F.col("p_size") / 10.0).cast("string").alias("fiveScore"),
        F.concat(F.lit("<b>"), F.col("p_retailprice").cast("string"), F.lit("</b>")).alias("avgPrice"),
        F.col("p_size").cast("string").alias("defaultReviewCount"),
        F.array(F.lit("taste"), F.lit("setting"), F.lit("service")).alias("shopScoreTitleList"),
        F.array(F.concat(F.lit("<i>"), F.col("p_brand"), F.lit("</i>")), F.col("p_type")).alias(
            "shopRefinedScoreValueList")))
    return PL.flatten_api_payload(p.select(F.col("p_partkey").alias("part_id"), payload.alias("payload")),
                                  "part_id", "payload", "score")


@register("flatten_api_shop", """
SELECT s_suppkey AS supplier_id, s_name AS name,
       nullif(concat_ws(' ', 'nation ' || CAST(s_nationkey AS VARCHAR),
                        CASE WHEN s_acctbal > 0 THEN 'road ' || CAST(s_suppkey AS VARCHAR) END), '') AS address,
       nullif(concat_ws(', ', CAST(s_suppkey * 7 AS VARCHAR),
                        CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey * 11 AS VARCHAR) END), '') AS phone
FROM supplier""")
def _flatten_shop(t):
    s = t.supplier
    payload = F.to_json(F.struct(F.lit(200).alias("code"), F.struct(F.struct(
        F.col("s_name").alias("shopName"),
        F.concat(F.lit("<span>nation "), F.col("s_nationkey").cast("string"), F.lit("</span>")).alias("address"),
        F.when(F.col("s_acctbal") > 0, F.concat(F.lit("road "), F.col("s_suppkey").cast("string"))).alias("crossRoad"),
        (F.col("s_suppkey") * 7).cast("string").alias("phoneNo"),
        F.when(F.col("s_suppkey") % 2 == 0, (F.col("s_suppkey") * 11).cast("string")).alias("phoneNo2"))
        .alias("shopInfo")).alias("msg")))
    return PL.flatten_api_payload(s.select(F.col("s_suppkey").alias("supplier_id"), payload.alias("payload")),
                                  "supplier_id", "payload", "shop")


# ---- S9 - S11 ----------------------------------------------------------------------
def _strip(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace({x}, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))"


def _ent(x: str) -> str:
    for k, v in PG.ENTITIES.items():
        x = f"replace({x}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')"
    return x


def _miss(x: str) -> str:
    return f"coalesce(nullif(trim({x}), ''), '-')"


@register("parse_listing_pages", f"""
SELECT page_id, unnest(range(1, len(regexp_extract_all(html, '{PG.ITEM_PATTERN}', 1)) + 1)) AS position,
       unnest(regexp_extract_all(html, '{PG.ITEM_PATTERN}', 1)) AS link,
       {_miss(_ent("unnest(regexp_extract_all(html, '" + PG.ITEM_PATTERN + "', 2))"))} AS name,
       '-' AS review_count, '-' AS avg_price, '-' AS address
FROM pages""")
def _listing_pages(t):
    return PG.parse_listing_pages(t.pages)


_NAME = (f"regexp_replace({_ent(f'''coalesce(nullif({_strip(f"regexp_extract(html, '{PG.HEADING_PATTERN}', 1)")}, ''), '''
                                f'''nullif({_strip(f"regexp_extract(html, '{PG.TITLE_PATTERN}', 1)")}, ''))''')}, "
         f"'[.\\s]+$', '')")


@register("parse_detail_pages", f"""
SELECT page_id, {_miss(_NAME)} AS name, {_miss(f"regexp_extract(html, '{PG.LANG_PATTERN}', 1)")} AS lang,
       len(regexp_extract_all(html, '<a href=')) AS n_links,
       {_miss(_strip(f"regexp_extract(html, '{PG.AD_PATTERN}', 1)"))} AS ad_text,
       {_miss(f"regexp_extract({_strip(chr(39).join(['regexp_extract(html, ', '(?s)<body>(.*)</body>', ', 1)']))}, '{PG.PHONE_PATTERN}', 0)")} AS phone,
       {_miss(_ent(_strip(f"regexp_extract(html, '{PG.FOOTER_PATTERN}', 1)")))} AS other_info
FROM pages""")
def _detail_pages(t):
    return PG.parse_detail_pages(t.pages)


_PARAS = f"""SELECT page_id, unnest(range(1, len(regexp_extract_all(html, '{PG.PARAGRAPH_PATTERN}', 1)) + 1)) AS review_no,
       {_ent(_strip(f"unnest(regexp_extract_all(html, '{PG.PARAGRAPH_PATTERN}', 1))"))} AS text FROM pages"""


@register("parse_review_pages", f"SELECT page_id, review_no, text, length(text) AS n_chars FROM ({_PARAS})")
def _review_pages(t):
    return PG.parse_review_pages(t.pages)


@register("review_page_summary", f"""
SELECT page_id, count(*) AS n_reviews, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM ({_PARAS}) GROUP BY page_id""")
def _review_page_summary(t):
    return PG.review_page_summary(t.pages)


# ---- S9 / S11: records of list and review pages ------------------------------------
def _escaped(x: str) -> str:
    for k, v in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        x = f"replace({x}, '{k}', '{v}')"
    return x


def _paged(df, page: str, order: str, block, head: str, tail: str, extra=()):
    """One stored page per value of ``page``: its blocks in order of ``order`` between ``head`` and ``tail``."""
    pages = df.select(F.expr(page).alias("page_id"), F.expr(order).alias("o"), block.alias("b"), *extra)
    names = [c for c in pages.columns if c not in ("page_id", "o", "b")]
    pages = pages.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("o", "b"))).alias("bs"), *[F.sum(c).alias(c) for c in names])
    body = F.concat_ws("\n", F.transform("bs", lambda x: x["b"]))
    return pages.select("page_id", F.concat(F.expr(head), body, F.lit(tail)).alias("html"))


_LISTING_HTML = f"""concat(
  '<li class="item"><div class="pic"><a href="/shop/', listing_id, '"><img title="x" src="/img/', listing_id, '.jpg"></a></div>',
  '<div class="txt"><div class="tit"><a title="t" href="/shop/', listing_id, '" data-shopid="', listing_id, '"><h4>', {_escaped('name')},
  '</h4></a></div><div class="comment"><div class="star_icon"><span class="star star_', CAST(floor(rating * 2) * 5 AS INT), ' sml"></span></div>',
  if(listing_id % 2 = 0, concat('<div class="star_score">', rating, '</div>'), ''),
  if(review_count > 0, concat('<a class="review-num"><b>', review_count, '</b> reviews</a>'), ''),
  if(price > 0, concat('<a class="mean-price">avg <b>', price, '</b></a>'), ''), '</div><div class="tag-addr">',
  '<a><span class="tag">', category, '</span></a>', if(listing_id % 3 = 0, '', concat('<a><span class="tag">', area, '</span></a>')),
  '<span class="addr"> ', business_area, '\n</span></div></div>',
  '<span class="comment-list"><span>taste<b>', rating, '</b></span> <span>sales<b>', CAST(sales AS BIGINT), '</b></span></span></li>')"""


@register("parse_listing_records", r"""
SELECT listing_id // 20 AS page_id, row_number() OVER (PARTITION BY listing_id // 20 ORDER BY listing_id) AS position,
       CAST(listing_id AS VARCHAR) AS listing_id, trim(regexp_replace(name, '\s+', ' ', 'g')) AS name,
       concat('/shop/', listing_id) AS link, concat('/img/', listing_id, '.jpg') AS picture,
       CAST(CASE WHEN listing_id % 2 = 0 THEN CAST(rating AS DOUBLE) ELSE floor(rating * 2) / 2 END AS VARCHAR) AS score,
       CASE WHEN review_count > 0 THEN concat(review_count, ' reviews') ELSE '-' END AS review_count,
       CASE WHEN price > 0 THEN CAST(price AS VARCHAR) ELSE '￥0' END AS avg_price,
       CASE WHEN listing_id % 3 = 0 THEN '-' ELSE category END AS tag1, CASE WHEN listing_id % 3 = 0 THEN '-' ELSE area END AS tag2,
       business_area AS address, '-' AS recommended,
       concat('taste', rating, ' sales', CAST(sales AS BIGINT)) AS score_text
FROM listing""", ("listing",))
def _listing_records(t):
    """Result pages of 20 listings, written from the listings and read back field by field."""
    pages = _paged(t.listing(), "listing_id div 20", "listing_id", F.expr(_LISTING_HTML),
                   "'<html><body><ul class=\"nav\"><li><a href=\"/\">home</a></li></ul><div class=\"shop-list\" id=\"all\"><ul>'",
                   '</ul></div><span class="addr">site</span></body></html>')
    return RC.parse_listing_records(pages)


_REVIEW_HTML = f"""concat(
  '<li><div class="main-review"><div class="dper-info"><a class="name" href="/member/', listing_id, '" target="_blank">user ', listing_id, '</a></div>',
  '<div class="review-rank"><span class="sml-rank-stars sml-str', lpad(CAST(CAST(rating * 10 AS INT) AS STRING), 2, '0'), ' star"></span>',
  '<span class="score">\n<span class="item">口味：', rating, '</span>\n<span class="item">环境：', lang, '</span>\n',
  if(listing_id % 3 = 0, '', concat('<span class="item">人均：', listing_id, '元</span>\n')), '</span></div>',
  if(text IS NULL, '', concat('<div class="review-words">', {_escaped('text')}, '</div>')),
  if(listing_id % 4 = 0, '', concat('<div class="review-recommend">喜欢的菜：\n<a>dish', listing_id, '</a>\n<a>', lang, '</a>\n</div>')),
  if(sentiment IS NULL, '', concat('<div class="review-pictures"><ul><li><a href="/photo/', review_id, '"><img></a></li><li><a href="/photo/x"></a></li></ul></div>')),
  '<div class="misc-info"><span class="time"> day ', rating, '\n</span><span class="actions"><a class="praise" data-id="', review_id, '">+1</a></span></div>',
  if(sentiment = 1, '<p class="shop-reply-content">thank you</p>', ''), '</div></li>')"""
_REVIEW_HEAD = """concat('<html><body><div class="filters"><label class="filter-pic">pics <span class="count">(', pics,
  ')</span></label><label class="filter-good">good <span class="count">(', good, ')</span></label><label class="filter-bad">bad <span class="count">(',
  bad, ')</span></label></div><div class="reviews-items"><ul>')"""


def _review_pages_of(t):
    extra = [F.col("sentiment").isNotNull().cast("long").alias("pics"), F.expr("CAST(coalesce(sentiment = 1, false) AS LONG) AS good"),
             F.expr("CAST(coalesce(sentiment = -1, false) AS LONG) AS bad")]
    return _paged(t.review_text(), "review_id div 10", "review_id", F.expr(_REVIEW_HTML), _REVIEW_HEAD,
                  '</ul></div><div class="reviews-pages"><a class="name" href="/p/2">2</a><span class="time">next</span></div></body></html>', extra)


@register("parse_review_records", r"""
SELECT review_id // 10 AS page_id, row_number() OVER (PARTITION BY review_id // 10 ORDER BY review_id) AS position,
       CAST(review_id AS VARCHAR) AS review_id, CAST(listing_id AS VARCHAR) AS user_id, concat('user ', listing_id) AS user_name,
       CAST(CAST(rating AS DOUBLE) AS VARCHAR) AS total_score, concat('口味=', rating, ';环境=', lang) AS scores,
       CASE WHEN listing_id % 3 = 0 THEN '' ELSE CAST(listing_id AS VARCHAR) END AS avg_price,
       coalesce(trim(regexp_replace(text, '\s+', ' ', 'g')), '-') AS text,
       CASE WHEN listing_id % 4 = 0 THEN '' ELSE concat('dish', listing_id, ',', lang) END AS dishes,
       concat('day ', rating) AS time, CASE WHEN sentiment = 1 THEN 'thank you' ELSE '' END AS reply,
       CASE WHEN sentiment IS NULL THEN '' ELSE concat('host/photo/', review_id, ',host/photo/x') END AS pictures
FROM review_text""", ("review_text",))
def _review_records(t):
    """Review pages of ten reviews with their whole texts, written from the reviews and read back field by field."""
    r = RC.parse_review_records(_review_pages_of(t), drop_spaces=False, picture_host="host")
    scores = F.transform(F.map_entries("scores"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return (r.withColumn("scores", F.concat_ws(";", scores)).withColumn("dishes", F.concat_ws(",", "dishes"))
            .withColumn("pictures", F.concat_ws(",", "pictures")))


@register("review_page_counts", """
SELECT review_id // 10 AS page_id, count(*) FILTER (WHERE sentiment IS NOT NULL) AS n_pictures,
       count(*) FILTER (WHERE sentiment = 1) AS n_good, CAST(0 AS BIGINT) AS n_middle,
       count(*) FILTER (WHERE sentiment = -1) AS n_bad, count(*) FILTER (WHERE sentiment IN (1, -1)) AS n_reviews
FROM review_text GROUP BY 1""", ("review_text",))
def _review_page_counts(t):
    return RC.review_page_counts(_review_pages_of(t))
