"""URL filters with redirect equivalence.

A url's own rule is the longest one that fits its host and path. Pages declare aliases:
``<link rel=canonical href>`` and ``<meta http-equiv=refresh content="0; url=...">`` give
edges between urls (without fragments, scheme and host in lower case). Tags count outside
comments, scripts, styles, templates and text areas, their attributes by whole names, ``rel`` as
a list of words; a relative address is resolved against the page's url, dot segments removed.
Of character references ``&amp;`` and the spellings in ``REFERENCES`` are decoded. Connected components
over all edges carry decisions: a url without a rule of its own is allowed if some alias
has an allow rule, else blocked if some alias has a block rule, else allowed. A url's own
rule always stands.

Edges are extracted in one scan, components contract in rounds of joins, and only urls on
edges take part; all other pages are decided in the scan.

Null or malformed urls (no ``://``): host and path empty, no rule, allow. Null html declares
nothing. Repeated rows are judged alike; other columns may have any names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelens.llm.common import carry, pages, prepare, restored
from venuelens.llm.components import components

#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parts of a page whose tags are no tags.
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)" + "".join(rf"|<{t}\b[^>]*>.*?(?:</{t}\s*>|\z)" for t in ("script", "style", "noscript", "template", "textarea"))
_TAG = r"""(?is)<(?:link|meta)(?:[\s/](?:[^>"']|"[^"]*"|'[^']*')*)>"""
_ATTRIBUTE = r"""(?is)[^\s"'<>/=]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
#: (reference, character), ``&amp;`` last
REFERENCES = (("&#38;", "&"), ("&#x26;", "&"), ("&#47;", "/"), ("&#x2f;", "/"), ("&#x2F;", "/"), ("&#58;", ":"), ("&#x3a;", ":"), ("&#x3A;", ":"), ("&amp;", "&"))


def host(url: Column) -> Column:
    found = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(found, F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls. The rules are a list held in code."""
    name = verdict = None
    for kind, domain, prefix in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host_ == domain) | host_.endswith("." + domain)) & path_.startswith(prefix)
        name = F.when(fits, domain + prefix) if name is None else name.when(fits, domain + prefix)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return (name, verdict) if name is not None else (F.lit(None).cast("string"),) * 2


def address(url: Column) -> Column:
    """A url as a node: no fragment, scheme and host in lower case; null if it has no host."""
    plain = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    front = F.regexp_extract(plain, r"(?s)^(.*?://[^/?#]*)", 1)
    return F.when(front != "", F.concat(F.translate(front, _UPPER, _LOWER), plain.substr(F.length(front) + 1, F.length(plain))))


def _without_dots(path_: Column) -> Column:
    """A path (from its first slash on) without ``.`` and ``..`` segments."""
    ended = F.when(path_.rlike(r"/\.\.?\z"), F.concat(path_, F.lit("/"))).otherwise(path_)
    parts = F.slice(F.split(ended, "/"), 2, F.length(ended) + 1)
    return F.aggregate(
        parts, F.lit(""),
        lambda done, x: F.when(x == ".", done).when(x == "..", F.regexp_replace(done, r"/[^/]*\z", "")).otherwise(F.concat(done, F.lit("/"), x)),
    )


def _absolute(link: Column, base: Column) -> Column:
    """A declared link against its page's url: absolute, host-relative, path-absolute, a query, or relative to the folder."""
    front = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"(?s)^(.*?:)//", 1)
    here = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    folder = F.concat(F.lit("/"), F.regexp_extract(here, r"(?s)^/?(.*/)?", 1))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link).when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(front, link)).when(link.startswith("?"), F.concat(front, here, link))
        .when(link.startswith("#"), F.concat(front, here)).when(link != "", F.concat(front, folder, link))
    )


def _resolved(whole: Column) -> Column:
    """An absolute link without dot segments in its path."""
    rest = F.regexp_extract(whole, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    start = F.regexp_extract(whole, r"(?s)^(.*?://[^/?#]*)", 1)
    tail = F.regexp_extract(whole, r"(?s)^.*?://[^/?#]*[^?#]*(.*)\z", 1)
    return F.when(rest.rlike(r"/\.\.?(?:/|\z)"), F.concat(start, _without_dots(rest), tail)).otherwise(whole)


def _value(attributes: Column, name: str) -> Column:
    """The first attribute of that name, without quotes, references decoded; null if there is none."""
    found = F.get(F.filter(attributes, lambda a: a.rlike(rf"(?is)^{name}\s*=")), 0)
    plain = F.regexp_extract(found, r"(?s)=\s*[\"']?(.*?)[\"']?\z", 1)
    for reference, character in REFERENCES:
        plain = F.replace(plain, F.lit(reference), F.lit(character))
    return F.trim(plain)


def edges(pages_: DataFrame) -> DataFrame:
    """(a, b): all declared redirects and canonical links of pages(url, html), however many a page has."""
    html = F.col("html").cast("string")
    tags = pages_.where(html.rlike("(?i)canonical|http-equiv") & F.col("url").isNotNull()).select(
        F.col("url").cast("string").alias("url"), F.explode(F.regexp_extract_all(F.regexp_replace(html, _HIDDEN, " "), F.lit(_TAG), F.lit(0))).alias("tag")
    )
    read = tags.select("url", F.col("tag").rlike("(?i)^<link").alias("is_link"), F.regexp_extract_all("tag", F.lit(_ATTRIBUTE), F.lit(0)).alias("attributes"))
    attributes = F.col("attributes")
    link = F.when(
        F.col("is_link"), F.when(_value(attributes, "rel").rlike(r"(?i)(?:^|\s)canonical(?:\s|\z)"), _value(attributes, "href"))
    ).when(
        F.lower(_value(attributes, "http-equiv")) == "refresh",
        F.regexp_extract(_value(attributes, "content"), r"(?is)^[^;,]*[;,]\s*url\s*=\s*[\"']?([^\"'\s>]+)", 1),
    )
    found = read.select("url", link.alias("link")).where("link is not null and link <> ''")
    # an aggregate between the steps keeps each long expression in the plan once; equal links are one edge
    whole = found.select(F.col("url"), _absolute(F.col("link"), F.col("url")).alias("to")).distinct()
    resolved = whole.select("url", _resolved(F.col("to")).alias("to")).distinct()
    return resolved.select(address(F.col("url")).alias("a"), address(F.col("to")).alias("b")).where("a is not null and b is not null")


def judge(pages_: DataFrame, rules=RULES) -> DataFrame:
    """``pages_`` with host, path, rule and verdict added (columns of those names are replaced)."""
    prepare(pages_.sparkSession)
    group = components(edges(pages_))
    node = F.col("node")
    decided = group.withColumn("_own", rule(host(node), path(node), rules)[1])
    of_group = decided.groupBy("component").agg(
        F.when(F.max(F.col("_own") == "allow"), "allow").when(F.max(F.col("_own") == "block"), "block").alias("_shared")
    ).where("_shared is not null")
    shared = decided.join(of_group, "component").select(F.col("node").alias("_node"), "_shared")
    rows = carry(pages_, "url")
    name, own = rule(host(F.col("url")), path(F.col("url")), rules)
    known = rows.withColumns({"_host": host(F.col("url")), "_path": path(F.col("url")), "_rule": name, "_own": own, "_at": address(F.col("url"))})
    # many pages may share one url: the pages' side may be split by AQE, the other has one row a url
    joined = known.join(shared, F.col("_at") == F.col("_node"), "left")
    kept = [c for n, c in zip(pages_.columns, restored(pages_, ("url",))) if n not in ("host", "path", "rule", "verdict")]
    return joined.select(
        *kept, F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.coalesce("_own", "_shared", F.lit("allow")).alias("verdict")
    )


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages(spark, sf_dir)
    group = judge(found.select("page_id", "url", "html"))
    return group.select("page_id", "host", "path", "rule", "verdict")


QUERIES = {"op7_url_redirects": op7_urls}

_SQL_NODE = """CASE WHEN regexp_extract({u}, '(?s)^(.*?://[^/?#]*)', 1) <> '' THEN
 translate(regexp_extract({u}, '(?s)^(.*?://[^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
 || substr(regexp_extract({u}, '(?s)^([^#]*)', 1), length(regexp_extract({u}, '(?s)^(.*?://[^/?#]*)', 1)) + 1) END"""
_SQL_RULE = """CASE WHEN (h = 'example.net' OR h LIKE '%.example.net') AND p LIKE '/en/%' THEN 'example.net/en/'
 WHEN (h = 'example.com' OR h LIKE '%.example.com') AND p LIKE '/de/%' THEN 'example.com/de/'
 WHEN (h = 'org' OR h LIKE '%.org') AND p LIKE '/fr/%' THEN 'org/fr/'
 WHEN (h = 'net' OR h LIKE '%.net') AND p LIKE '/%' THEN 'net/' END"""
_SQL_HOST = "translate(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SQL_PATH = "regexp_extract({u}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_SQL_HERE = "regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_SQL_LINK = f"""CASE WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN l WHEN l LIKE '//%' THEN regexp_extract(url, '(?s)^(.*?:)//', 1) || l
 WHEN l LIKE '/%' THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || l
 WHEN l LIKE '?%' THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || {_SQL_HERE} || l
 WHEN l LIKE '#%' THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || {_SQL_HERE}
 WHEN l <> '' THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || '/' || regexp_extract({_SQL_HERE}, '(?s)^/?(.*/)?', 1) || l END"""
_SQL_REST = "regexp_extract(t, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_SQL_DOTS = f"""CASE WHEN regexp_matches({_SQL_REST}, '/\\.\\.?(/|$)') THEN regexp_extract(t, '(?s)^(.*?://[^/?#]*)', 1)
 || list_reduce(string_split(CASE WHEN regexp_matches({_SQL_REST}, '/\\.\\.?$') THEN {_SQL_REST} || '/' ELSE {_SQL_REST} END, '/')[2:],
  lambda done, x: CASE WHEN x = '.' THEN done WHEN x = '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || x END, '')
 || regexp_extract(t, '(?s)^.*?://[^/?#]*[^?#]*(.*)$', 1) ELSE t END"""


def _sql_value(name: str) -> str:
    out = f"regexp_extract(list_filter(attributes, lambda x: regexp_matches(x, '(?is)^{name}\\s*='))[1], '(?s)=\\s*[\"'']?(.*?)[\"'']?$', 1)"
    for reference, character in REFERENCES:
        out = f"replace({out}, '{reference}', '{character}')"
    return f"trim({out})"


ORACLE_SQL = {
    "op7_url_redirects": f"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(regexp_extract_all(regexp_replace(html, '{_HIDDEN}', ' ', 'g'), '{_TAG.replace("'", "''")}')) AS tag FROM pages
  WHERE url IS NOT NULL AND regexp_matches(html, '(?i)canonical|http-equiv')
), parts AS (
  SELECT url, tag, regexp_extract_all(tag, '{_ATTRIBUTE.replace("'", "''")}') AS attributes FROM tags
), links AS (
  SELECT url, {_sql_value("href")} AS l FROM parts
  WHERE regexp_matches(tag, '(?i)^<link') AND regexp_matches({_sql_value("rel")}, '(?i)(^|\\s)canonical(\\s|$)')
  UNION ALL
  SELECT url, regexp_extract({_sql_value("content")}, '(?is)^[^;,]*[;,]\\s*url\\s*=\\s*["'']?([^"''\\s>]+)', 1) FROM parts
  WHERE NOT regexp_matches(tag, '(?i)^<link') AND lower({_sql_value("http-equiv")}) = 'refresh'
), e AS (
  SELECT {_SQL_NODE.format(u="url")} AS a, {_SQL_NODE.format(u="t")} AS b FROM (SELECT url, {_SQL_DOTS} AS t FROM (SELECT url, {_SQL_LINK} AS t FROM links))
), sym AS (
  SELECT a, b FROM e WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM e WHERE a IS NOT NULL AND b IS NOT NULL
), reach(a, b) AS (
  SELECT a, a FROM sym UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a
), own AS (
  SELECT a, b, {_SQL_RULE} AS r FROM (SELECT a, b, {_SQL_HOST.format(u="b")} AS h, {_SQL_PATH.format(u="b")} AS p FROM reach)
), shared AS (
  SELECT a, CASE WHEN bool_or(r IN ('example.net/en/', 'org/fr/')) THEN 'allow' WHEN bool_or(r IN ('net/', 'example.com/de/')) THEN 'block' END AS s
  FROM own GROUP BY a
), judged AS (
  SELECT page_id, h AS host, p AS path, {_SQL_RULE} AS rule, node FROM (
    SELECT page_id, coalesce({_SQL_HOST.format(u="url")}, '') AS h, coalesce({_SQL_PATH.format(u="url")}, '') AS p, {_SQL_NODE.format(u="url")} AS node FROM pages)
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE coalesce(s, 'allow') END AS verdict
FROM judged LEFT JOIN shared ON node = a
""",
}
