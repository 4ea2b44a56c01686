"""Stored JSON payloads (S8, S12): parsed with ``from_json`` against a declared
schema, then flattened with struct paths, ``inline`` and ``transform`` - all JVM side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import zip_scores

# ---- S8 ----------------------------------------------------------------------------
SUMMARY_SCHEMA = "array<struct<`描述`: string, `个数`: string>>"
FEATURED_SCHEMA = ("array<struct<`评论id`: string, `用户id`: string, `用户名`: string, `用户总分`: string, "
                   "`用户打分`: map<string,string>, `评论内容`: string, `人均价格`: string, `喜欢的菜`: array<string>, "
                   "`发布时间`: string, `商家回复`: string, `评论图片`: array<string>, `点赞个数`: string, "
                   "`回复个数`: string, `浏览次数`: string>>")


def explode_review_json(df: DataFrame, key: str, col: str, schema: str = FEATURED_SCHEMA,
                        outer: bool = True) -> DataFrame:
    """A landing row with a JSON array column -> one row per element (struct fields as columns).

    ``outer`` keeps rows whose array is empty or unparsable (fields NULL).
    """
    parsed = df.select(key, F.from_json(F.col(col), schema).alias("_a"))
    gen = F.inline_outer if outer else F.inline
    return parsed.select(key, gen("_a"))


def parse_json_struct(df: DataFrame, col: str, schema: str) -> DataFrame:
    return df.withColumn(col, F.from_json(F.col(col), schema))


# ---- S12 ---------------------------------------------------------------------------
REVIEW_PAYLOAD_SCHEMA = """struct<code: int,
  reviewAllDOList: array<struct<
    reviewDataVO: struct<reviewData: struct<reviewId: long, star: int, reviewBody: string, voteCount: int,
                                            replyCount: int, viewCount: int, avgPrice: double,
                                            extInfoList: array<struct<values: array<string>>>>,
                         addTimeVO: string, followNoteString: string>,
    picList: array<struct<bigPicture: string>>,
    user: struct<userNickName: string, userId: long>>>>"""
SUMMARY_PAYLOAD_SCHEMA = """struct<code: int,
  reviewCountAll: long, reviewCountPic: long, reviewCountGood: long, reviewCountCommon: long, reviewCountBad: long,
  dishTagStrList: array<string>>"""
SCORE_PAYLOAD_SCHEMA = ("struct<code: int, fiveScore: string, avgPrice: string, defaultReviewCount: string, "
                        "shopScoreTitleList: array<string>, shopRefinedScoreValueList: array<string>>")
SHOP_PAYLOAD_SCHEMA = ("struct<code: int, msg: struct<shopInfo: struct<shopName: string, address: string, "
                       "crossRoad: string, phoneNo: string, phoneNo2: string>>>")


def _strip_tags(c):
    return F.trim(F.regexp_replace(c, "<[^>]*>", ""))


def flatten_api_payload(df: DataFrame, key: str, col: str, kind: str = "reviews") -> DataFrame:
    """API JSON text -> rows; payloads whose ``code`` is not 200 are dropped.

    kinds: ``reviews`` (one row per review), ``summary`` (counts and dish tags),
    ``score`` (scores zipped into a map), ``shop`` (name, address, phones joined
    from their non-null parts, Q18).
    """
    schema = {"reviews": REVIEW_PAYLOAD_SCHEMA, "summary": SUMMARY_PAYLOAD_SCHEMA, "score": SCORE_PAYLOAD_SCHEMA,
              "shop": SHOP_PAYLOAD_SCHEMA}[kind]
    # each payload is parsed once: no filter or field is pushed below a generator, as a copy of the parsing
    p = df.select(key, F.explode(F.array(F.from_json(F.col(col), schema))).alias("p")).where(F.col("p.code") == 200)
    if kind == "reviews":
        r = p.select(key, F.explode("p.reviewAllDOList").alias("r"))
        d = "r.reviewDataVO.reviewData"
        return r.select(
            key, F.col(f"{d}.reviewId").alias("review_id"), F.col("r.user.userId").alias("user_id"),
            F.col("r.user.userNickName").alias("user_name"), F.col(f"{d}.star").alias("star"),
            _strip_tags(F.col(f"{d}.reviewBody")).alias("body"), F.col(f"{d}.voteCount").alias("votes"),
            F.col(f"{d}.replyCount").alias("replies"), F.col(f"{d}.viewCount").alias("views"),
            F.col(f"{d}.avgPrice").alias("avg_price"),
            F.coalesce(F.get(F.col(f"{d}.extInfoList"), F.lit(0))["values"], F.array().cast("array<string>")).alias("liked_dishes"),
            F.col("r.reviewDataVO.addTimeVO").alias("published"),
            F.col("r.reviewDataVO.followNoteString").alias("reply"),
            F.coalesce(F.transform("r.picList", lambda x: x["bigPicture"]), F.array().cast("array<string>"))
            .alias("pictures"))
    if kind == "summary":
        return p.select(key, F.col("p.reviewCountAll").alias("all_count"), F.col("p.reviewCountPic").alias("pic_count"),
                        F.col("p.reviewCountGood").alias("good_count"), F.col("p.reviewCountCommon").alias("mid_count"),
                        F.col("p.reviewCountBad").alias("bad_count"), F.col("p.dishTagStrList").alias("dish_tags"))
    if kind == "score":
        return p.select(key, F.col("p.fiveScore").alias("score"), _strip_tags(F.col("p.avgPrice")).alias("avg_price"),
                        _strip_tags(F.col("p.defaultReviewCount")).alias("review_count"),
                        zip_scores(F.col("p.shopScoreTitleList"),
                                   F.transform("p.shopRefinedScoreValueList", _strip_tags)).alias("scores"))
    s = "p.msg.shopInfo"
    return p.select(key, F.col(f"{s}.shopName").alias("name"),
                    F.nullif(F.concat_ws(" ", _strip_tags(F.col(f"{s}.address")), _strip_tags(F.col(f"{s}.crossRoad"))),
                             F.lit("")).alias("address"),
                    F.nullif(F.concat_ws(", ", _strip_tags(F.col(f"{s}.phoneNo")), _strip_tags(F.col(f"{s}.phoneNo2"))),
                             F.lit("")).alias("phone"))
