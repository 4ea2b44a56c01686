"""Stored HTML pages (S9-S11): fields are pulled with ``regexp_extract_all`` /
``regexp_extract`` (JVM side, one pass over each page, whole page text).

Patterns are parameters; the defaults match the stored pages of the driver
tables (navigation list items, title/heading, article paragraphs, footer).
A missing field is ``-`` as in the crawler's output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import substitute_codepoints

MISSING = "-"
# Our defaults for the stored pages.
ITEM_PATTERN = r'<li><a href="([^"]*)">([^<]*)</a></li>'
TITLE_PATTERN = r"(?s)<title>(.*?)</title>"
HEADING_PATTERN = r"(?s)<h1>(.*?)</h1>"
PARAGRAPH_PATTERN = r"(?s)<p>(.*?)</p>"
AD_PATTERN = r'(?s)<div class="ad">(.*?)</div>'
FOOTER_PATTERN = r"(?s)<footer>(.*?)</footer>"
LANG_PATTERN = r'<html lang="([^"]*)"'
PHONE_PATTERN = r"\+?[0-9][0-9 ()-]{6,}[0-9]"
ENTITIES = {"&amp;": "&", "&copy;": "©", "&middot;": "·", "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"'}


def strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), r"\s+", " "))


def _or_missing(c: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(MISSING))


# ---- S9 ----------------------------------------------------------------------------
def parse_listing_pages(pages: DataFrame, key: str = "page_id", html: str = "html",
                        item_pattern: str = ITEM_PATTERN, link_group: int = 1, name_group: int = 2) -> DataFrame:
    """One row per list item: key, position, link, name, plus the fields a result list
    does not carry (``-``)."""
    links = F.regexp_extract_all(F.col(html), F.lit(item_pattern), link_group)
    names = F.regexp_extract_all(F.col(html), F.lit(item_pattern), name_group)
    items = pages.select(key, F.posexplode(F.arrays_zip(links.alias("link"), names.alias("name"))).alias("pos", "it"))
    return items.select(key, (F.col("pos") + 1).cast("long").alias("position"), F.col("it.link").alias("link"),
                        _or_missing(substitute_codepoints(F.col("it.name"), ENTITIES)).alias("name"),
                        F.lit(MISSING).alias("review_count"), F.lit(MISSING).alias("avg_price"),
                        F.lit(MISSING).alias("address"))


# ---- S10 ---------------------------------------------------------------------------
def parse_detail_pages(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Per page: name (heading, else title, trailing period removed), language, link count,
    advert text, phone (first phone-like run in the body text), footer with entities replaced."""
    h = F.col(html)
    name = F.coalesce(F.nullif(strip_tags(F.regexp_extract(h, HEADING_PATTERN, 1)), F.lit("")),
                      F.nullif(strip_tags(F.regexp_extract(h, TITLE_PATTERN, 1)), F.lit("")))
    name = F.regexp_replace(substitute_codepoints(name, ENTITIES), r"[.\s]+$", "")
    body = strip_tags(F.regexp_extract(h, r"(?s)<body>(.*)</body>", 1))
    return pages.select(
        key, _or_missing(name).alias("name"),
        _or_missing(F.regexp_extract(h, LANG_PATTERN, 1)).alias("lang"),
        F.size(F.regexp_extract_all(h, F.lit(r"<a href="), 0)).cast("long").alias("n_links"),
        _or_missing(strip_tags(F.regexp_extract(h, AD_PATTERN, 1))).alias("ad_text"),
        _or_missing(F.regexp_extract(body, PHONE_PATTERN, 0)).alias("phone"),
        _or_missing(substitute_codepoints(strip_tags(F.regexp_extract(h, FOOTER_PATTERN, 1)), ENTITIES))
        .alias("other_info"))


# ---- S11 ---------------------------------------------------------------------------
def parse_review_pages(pages: DataFrame, key: str = "page_id", html: str = "html",
                       pattern: str = PARAGRAPH_PATTERN) -> DataFrame:
    """One row per review block (article paragraph): key, review_no, text, n_chars."""
    paras = F.regexp_extract_all(F.col(html), F.lit(pattern), 1)
    r = pages.select(key, F.posexplode(paras).alias("pos", "raw"))
    text = substitute_codepoints(strip_tags(F.col("raw")), ENTITIES)
    return r.select(key, (F.col("pos") + 1).cast("long").alias("review_no"), text.alias("text"),
                    F.length(text).cast("long").alias("n_chars"))


def review_page_summary(pages: DataFrame, key: str = "page_id", html: str = "html",
                        pattern: str = PARAGRAPH_PATTERN) -> DataFrame:
    """Per page: number of review blocks and of characters (the page's summary counts)."""
    r = parse_review_pages(pages, key, html, pattern)
    return r.groupBy(key).agg(F.count(F.lit(1)).alias("n_reviews"), F.sum("n_chars").alias("n_chars"))
