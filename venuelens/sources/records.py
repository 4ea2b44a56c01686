"""Records of stored result and review pages (S9, S11): a page is cut at the start tags of its
repeated block, each block gives a row of named fields.

A field is a pattern on the block, or on the inside of the block's first element with a class; all
of it is JVM regular expressions over the whole page.  An element ends at its own end tag, also with one
level of the same tag inside.  A field that a block lacks gets its missing value, never the next
block's.  Null or empty pages and pages without the container give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import substitute_codepoints
from .pages import ENTITIES, MISSING

# Class names, labels and the default price of the stored pages' format.
LISTING_CONTAINER, LISTING_BLOCK = "shop-list", "<li\\b"
REVIEW_CONTAINER, REVIEW_END = "reviews-items", "reviews-pages"
PER_HEAD, LABEL_END, CURRENCY = "人均", "：", "元"
FOLDED, DISH_LABEL_CHARS = "收起评价", 5
NO_PRICE = "￥0"


def start_tag(cls: str) -> str:
    """The start of a tag that has ``cls`` among its classes (up to its attributes); group 1 is the tag's name."""
    return f'<(\\w+)(?=[^>]*\\sclass="(?:[^"]*\\s)?{cls}(?:\\s[^"]*)?")'


def inside(block: Column, cls: str) -> Column:
    """The html inside the block's first element with class ``cls``; empty if there is none."""
    text = "[^<]++|<(?!/?\\1\\b)"
    nested = f"<\\1\\b[^>]*+>(?:{text})*+</\\1>"
    return F.regexp_extract(block, f"{start_tag(cls)}[^>]*+>((?:{text}|{nested})*+)</\\1>", 2)


def has(block: Column, cls: str) -> Column:
    return block.rlike(start_tag(cls))


def plain(html: Column, gap: str = "") -> Column:
    """Text of a piece of html: tags replaced by ``gap``, named references decoded (``&amp;`` last)."""
    last = {"&amp;": "&"}
    return substitute_codepoints(F.regexp_replace(html, "<[^>]*>", gap), {k: v for k, v in ENTITIES.items() if k not in last} | last)


def one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def attribute(html: Column, tag: str, name: str) -> Column:
    """An attribute of the first ``tag`` that has it."""
    return plain(F.regexp_extract(html, f'<{tag}\\b[^>]*?\\s{name}="([^"]*)"', 1))


def or_else(value: Column, missing: str = MISSING) -> Column:
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit(missing))


@dataclass(frozen=True)
class Blocks:
    """Where a page's records are: after the element with class ``container``, one at each match of
    ``start``, up to the first element with class ``end``, if given."""
    container: str
    start: str
    end: str | None = None

    def rows(self, pages: DataFrame, key: str, html: str) -> DataFrame:
        """(key, position, _block) of every block."""
        area = F.regexp_extract(F.col(html), f"(?s){start_tag(self.container)}[^>]*+>(.*)", 2)
        if self.end:
            area = F.regexp_replace(area, f"(?s){start_tag(self.end)}.*", "")
        parts = F.split(area, f"(?={self.start})")
        kept = F.filter(parts, lambda p: p.rlike(f"^(?:{self.start})"))
        return pages.select(key, F.posexplode(kept).alias("_pos", "_block")).select(
            key, (F.col("_pos") + 1).cast("long").alias("position"), "_block")


LISTINGS = Blocks(LISTING_CONTAINER, LISTING_BLOCK)
REVIEWS = Blocks(REVIEW_CONTAINER, start_tag("main-review"), REVIEW_END)


def parse_listing_records(pages: DataFrame, key: str = "page_id", html: str = "html", blocks: Blocks = LISTINGS) -> DataFrame:
    """One row per result of a list page.  The score is the printed one, else a tenth of the star class; the two tags
    count only together."""
    b = F.col("_block")
    title, place, icon = inside(b, "tit"), inside(b, "tag-addr"), inside(b, "star_icon")
    tags = F.regexp_extract_all(place, F.lit(f"(?s){start_tag('tag')}[^>]*>(.*?)</"), 2)
    printed = F.trim(plain(inside(b, "star_score"))).try_cast("double")
    starred = F.regexp_extract(icon, r'class="[^"\s]+\s+[^"\s_]*_(\d+)', 1).try_cast("double") / 10
    both = F.size(tags) >= 2
    return blocks.rows(pages, key, html).select(
        key, "position",
        or_else(attribute(title, "a", "data-shopid")).alias("listing_id"),
        or_else(one_line(plain(F.regexp_extract(title, r"(?s)<a\b[^>]*>(.*?)</a>", 1)))).alias("name"),
        or_else(attribute(title, "a", "href")).alias("link"),
        or_else(attribute(inside(b, "pic"), "img", "src")).alias("picture"),
        F.coalesce(F.coalesce(printed, starred).cast("string"), F.lit(MISSING)).alias("score"),
        or_else(one_line(plain(inside(b, "review-num")))).alias("review_count"),
        or_else(plain(F.regexp_extract(inside(b, "mean-price"), r"(?s)<b>(.*?)</b>", 1)), NO_PRICE).alias("avg_price"),
        F.when(both, one_line(plain(F.get(tags, 0)))).otherwise(MISSING).alias("tag1"),
        F.when(both, one_line(plain(F.get(tags, 1)))).otherwise(MISSING).alias("tag2"),
        or_else(one_line(plain(inside(place, "addr")))).alias("address"),
        or_else(one_line(plain(inside(b, "recommend")))).alias("recommended"),
        or_else(one_line(plain(inside(b, "comment-list")))).alias("score_text"))


def _lines(html: Column) -> Column:
    """The lines of an element's text that are not blank, without spaces."""
    return F.filter(F.split(F.regexp_replace(plain(html), "[ \\t]", ""), r"[\r\n]+"), lambda x: x != "")


def parse_review_records(pages: DataFrame, key: str = "page_id", html: str = "html", blocks: Blocks = REVIEWS,
                         drop_spaces: bool = True, picture_host: str = "") -> DataFrame:
    """One row per review of a review page; ``scores`` is a map, ``dishes`` and ``pictures`` are arrays.

    ``drop_spaces`` removes the spaces of the text, as fits Chinese; else runs of white space become one space.
    """
    b = F.col("_block")
    author, words = inside(b, "name"), plain(inside(b, "review-words"))
    text = F.replace(words, F.lit(FOLDED), F.lit(""))
    text = F.trim(F.regexp_replace(F.replace(text, F.lit(" "), F.lit("")), r"[\r\n]", " ")) if drop_spaces else one_line(text)
    scored = F.filter(_lines(inside(b, "score")), lambda x: F.contains(x, F.lit(LABEL_END)))
    labelled = F.filter(scored, lambda x: ~F.contains(x, F.lit(PER_HEAD)))
    price = F.get(F.filter(scored, lambda x: F.contains(x, F.lit(PER_HEAD))), 0)
    pairs = F.transform(labelled, lambda x: F.struct(F.substring_index(x, LABEL_END, 1).alias("k"), F.get(F.split(x, LABEL_END), 1).alias("v")))
    # a label given twice keeps its first score: map keys are unique
    once = F.filter(pairs, lambda p, i: F.array_position(F.transform(pairs, lambda q: q["k"]), p["k"]) == i + 1)
    stars = F.regexp_extract(b, f'{start_tag("sml-rank-stars")}[^>]*\\sclass="[^"\\s]+\\s+[^"\\s]*(\\d\\d)[\\s"]', 2)
    dishes = F.concat_ws("\n", _lines(inside(b, "review-recommend")))
    pictures = F.regexp_extract_all(inside(b, "review-pictures"), F.lit('<a\\b[^>]*?\\shref="([^"]*)"'), 1)
    return blocks.rows(pages, key, html).select(
        key, "position",
        or_else(attribute(inside(b, "actions"), "a", "data-id")).alias("review_id"),
        or_else(F.regexp_extract(b, f'{start_tag("name")}[^>]*\\shref="(?:[^"]*/)?([^"/]*)"', 2)).alias("user_id"),
        or_else(one_line(plain(author))).alias("user_name"),
        F.coalesce((stars.try_cast("double") / 10).cast("string"), F.lit("")).alias("total_score"),
        F.map_from_entries(once).alias("scores"),
        F.coalesce(F.replace(F.get(F.split(price, LABEL_END), 1), F.lit(CURRENCY), F.lit("")), F.lit("")).alias("avg_price"),
        F.when(has(b, "review-words"), text).otherwise(MISSING).alias("text"),
        F.filter(F.split(F.substr(dishes, F.lit(DISH_LABEL_CHARS + 1)), "\n"), lambda x: x != "").alias("dishes"),
        or_else(one_line(plain(inside(b, "time")))).alias("time"),
        or_else(one_line(plain(inside(b, "shop-reply-content"))), "").alias("reply"),
        F.transform(pictures, lambda x: F.concat(F.lit(picture_host), plain(x))).alias("pictures"))


def review_page_counts(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Per page: printed counts of reviews with pictures, good, middle and bad ones, and their total."""
    def printed(cls: str) -> Column:
        return F.coalesce(F.regexp_extract(inside(inside(F.col(html), cls), "count"), r"(\d+)", 1).try_cast("long"), F.lit(0).cast("long"))
    counts = pages.select(key, *[printed(f"filter-{c}").alias(f"n_{n}") for c, n in
                                 (("pic", "pictures"), ("good", "good"), ("middle", "middle"), ("bad", "bad"))])
    return counts.withColumn("n_reviews", F.col("n_good") + F.col("n_middle") + F.col("n_bad"))
