"""Column-level cleaning functions.

Each returns a ``Column`` built from built-in expressions only, so they stay
inside whole-stage codegen; none of them needs a Python UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x: ColumnOrName, digits: int = 2) -> Column:
    """Round half-up on a DECIMAL (never on the binary double) and return a double (Q5)."""
    return F.round(_c(x).cast("double").cast("decimal(38,10)"), digits).cast("double")


def avg_rounded(x: ColumnOrName, digits: int = 2) -> Column:
    """``round(avg(x), digits)`` with the average taken in double, rounded on a decimal."""
    return F.round(F.avg(_c(x).cast("double")).cast("decimal(38,10)"), digits).cast("double")


# ---- C12 ---------------------------------------------------------------------------
def mask_phone(x: ColumnOrName, style: str = "strict") -> Column:
    """Keep the first three and last four digits around ``****`` (Q8).

    ``strict`` (default): digits-only value of 7+ digits is masked, anything
    shorter becomes NULL, so raw digits never leak.  ``eleven``: the importer
    rule, only exactly 11 digits are masked and other values pass unchanged.
    """
    raw = _c(x)
    digits = F.regexp_replace(raw.cast("string"), r"\D", "")
    masked = F.concat(F.substring(digits, 1, 3), F.lit("****"), F.substring(digits, -4, 4))
    n = F.length(digits)
    if style == "strict":
        return F.when(raw.isNull(), None).when(n >= 7, masked)
    if style == "eleven":
        return F.when(raw.isNull(), None).when(n == 11, masked).otherwise(raw.cast("string"))
    raise ValueError(f"unknown style {style!r}")


# ---- C13 ---------------------------------------------------------------------------
NUMBER_PATTERN = r"-?\d+(\.\d+)?"


def parse_number(x: ColumnOrName, default: float | None = 0.0, strict: bool = False) -> Column:
    """First signed decimal number inside the text, else ``default`` (Q11).

    ``strict=True`` reproduces the migration gate: the whole trimmed text must be
    digits (``^[0-9]+$``), otherwise ``default``.
    """
    s = F.trim(_c(x).cast("string"))
    if strict:
        val = F.when(s.rlike(r"^[0-9]+$"), s.try_cast("double"))
    else:
        val = F.nullif(F.regexp_extract(s, NUMBER_PATTERN, 0), F.lit("")).try_cast("double")
    return F.coalesce(val, F.lit(default).cast("double")) if default is not None else val


# ---- C14 ---------------------------------------------------------------------------
def parse_count(x: ColumnOrName, default: int = 0, mode: str = "round") -> Column:
    """Integer count.

    ``round``: first number, rounded half-even (``int(round(x))``, Q6).
    ``digits``: when the text starts with a digit, drop every non-digit and cast
    (the migration rule), else ``default``.
    """
    if mode == "round":
        return F.bround(parse_number(x, float(default)), 0).cast("long")
    if mode == "digits":
        s = _c(x).cast("string")
        return F.coalesce(F.when(s.rlike("^[0-9]"), F.regexp_replace(s, "[^0-9]", "").try_cast("long")),
                          F.lit(default).cast("long"))
    raise ValueError(mode)


# ---- C15 ---------------------------------------------------------------------------
def coerce_numeric(x: ColumnOrName, fill: float | None = 0.0, dtype: str = "double") -> Column:
    """Numeric or NULL (``try_cast``: ANSI mode makes a plain cast raise), then fill."""
    v = F.trim(_c(x).cast("string")).try_cast(dtype)
    return F.coalesce(v, F.lit(fill).cast(dtype)) if fill is not None else v


# ---- C16 ---------------------------------------------------------------------------
def gate_numeric_text(x: ColumnOrName, pattern: str, dtype: str, default=0) -> Column:
    """Cast only when the whole text matches ``pattern``, else ``default``."""
    s = _c(x).cast("string")
    return F.coalesce(F.when(s.rlike(pattern), s.try_cast(dtype)), F.lit(default).cast(dtype))


# ---- C17 ---------------------------------------------------------------------------
def blank_to_null(x: ColumnOrName, tokens=("", "-", "nan")) -> Column:
    """Trim; the tokens (case-insensitive) become NULL."""
    s = F.trim(_c(x).cast("string"))
    return F.when(F.lower(s).isin([t.lower() for t in tokens]), None).otherwise(s)


def zero_to_null(x: ColumnOrName) -> Column:
    return F.nullif(_c(x), F.lit(0))


# ---- C3, C4 ------------------------------------------------------------------------
def derive_key(parts, length: int = 16, prefix: str = "", sep: str = "|") -> Column:
    """``prefix`` + first ``length`` hex digits of md5 of the joined parts."""
    cols = [_c(p).cast("string") for p in parts]
    seed = cols[0] if len(cols) == 1 else F.concat_ws(sep, *[F.coalesce(c, F.lit("")) for c in cols])
    digest = F.substring(F.md5(seed), 1, length)
    return F.concat(F.lit(prefix), digest) if prefix else digest


def key_or_derived(key: ColumnOrName, parts, length: int = 20, prefix: str = "ds_") -> Column:
    """Keep a non-blank key (not ``nan``), else derive one from the parts."""
    k = F.trim(_c(key).cast("string"))
    return F.when(k.isNull() | (F.lower(k).isin("", "nan", "none")), derive_key(parts, length, prefix)).otherwise(k)


def prefix_key(x: ColumnOrName, prefix: str) -> Column:
    return F.concat(F.lit(prefix), _c(x).cast("string"))


def _bound(x: Column, use) -> Column:
    """``use(x)`` with ``x`` computed once a row: as a lambda's variable it is not repeated in the expression."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def _last_wins(keys: Column, values: Column) -> Column:
    """Parallel arrays -> map; of a repeated key the last value stays, in the key's first place."""
    def looked_up(kv: Column) -> Column:
        found = F.transform(kv["names"], lambda k: F.get(kv["backward"], (F.array_position(kv["back"], k) - 1).cast("int")))
        return F.map_from_arrays(kv["names"], found)

    def build(kv: Column) -> Column:
        names = F.array_distinct(kv["keys"])
        repeated = _bound(F.struct(names.alias("names"), F.reverse(kv["keys"]).alias("back"), F.reverse(kv["values"]).alias("backward")), looked_up)
        # labels are looked up only where one comes twice
        return F.when(F.size(names) == F.size(kv["keys"]), F.map_from_arrays(kv["keys"], kv["values"])).otherwise(repeated)
    return _bound(F.struct(keys.alias("keys"), values.alias("values")), build)


# ---- C23 ---------------------------------------------------------------------------
def split_score_text(x: ColumnOrName, pair_sep: str = " ", kv_sep: str = "：",
                     price_label: str = "人均") -> Column:
    """``"口味：4.5 环境：4.0 人均：88元"`` -> map of label to value, the price token excluded."""
    s = F.trim(F.regexp_replace(_c(x), r"\s+", " "))
    pairs = F.filter(F.transform(F.split(s, re.escape(pair_sep)), lambda p: F.split(p, re.escape(kv_sep), 2)),
                     lambda p: ~F.get(p, F.lit(0)).contains(price_label))
    return _bound(pairs, lambda ps: _last_wins(F.transform(ps, lambda p: F.get(p, F.lit(0))), F.transform(ps, lambda p: F.get(p, F.lit(1)))))


def score_text_price(x: ColumnOrName, price_label: str = "人均", kv_sep: str = "：", unit: str = "元") -> Column:
    """The price token of a score text, unit removed, or NULL."""
    return F.nullif(F.regexp_extract(_c(x), f"{price_label}{kv_sep}([^\\s{unit}]*)", 1), F.lit(""))


# ---- C24 ---------------------------------------------------------------------------
def zip_scores(titles: ColumnOrName, values: ColumnOrName) -> Column:
    """Parallel title / value arrays -> map (shorter array decides the length)."""
    t, v = _c(titles), _c(values)
    n = F.least(F.size(t), F.size(v))
    return _last_wins(F.slice(t, 1, n), F.slice(v, 1, n))


# ---- C25 ---------------------------------------------------------------------------
def clean_review_text(x: ColumnOrName, drop_label: str = "收起评价") -> Column:
    """Remove tags, spaces and the collapse label; line breaks become one space."""
    s = F.regexp_replace(_c(x), "<[^>]*>", "")
    s = F.regexp_replace(s, " ", "")
    s = F.replace(s, F.lit(drop_label), F.lit(""))
    s = F.regexp_replace(s, "[\r\n]", " ")
    return F.trim(s)


def list_tail(x: ColumnOrName, skip: int = 5) -> Column:
    """Recommendation string: drop the ``skip``-character lead, split on spaces."""
    s = F.trim(F.regexp_replace(F.regexp_replace(_c(x), " ", ""), "[\r\n]", " "))
    rest = F.trim(F.substring(s, skip + 1, 1 << 30))
    return F.when(rest == "", F.array().cast("array<string>")).otherwise(F.split(rest, " +"))


# ---- C26 ---------------------------------------------------------------------------
def substitute_codepoints(x: ColumnOrName, mapping: dict) -> Column:
    """Replace each code of ``mapping`` by its text; a fold of ``replace`` calls.

    ``mapping`` is a small fixed table (entity or glyph codes), applied in the
    given order.
    """
    out = _c(x)
    for code, text in mapping.items():
        out = F.replace(out, F.lit(code), F.lit(text))
    return out


# ---- C27 ---------------------------------------------------------------------------
def icon_class_to_rating(icon_class: ColumnOrName, score_text: ColumnOrName | None = None) -> Column:
    """Rating from the last two digits of a star class (``... star_45`` -> 4.5).

    A numeric score text, when given and valid, wins over the class.
    """
    from_class = F.nullif(F.regexp_extract(_c(icon_class), r"(\d{2})\s*$", 1), F.lit("")).try_cast("double") / 10
    if score_text is None:
        return from_class
    return F.coalesce(F.trim(_c(score_text)).try_cast("double"), from_class)


# ---- C28 ---------------------------------------------------------------------------
def sum_sentiment_counts(good: ColumnOrName, mid: ColumnOrName, bad: ColumnOrName) -> Column:
    """good + mid + bad as text, ``-`` when any part is not an integer."""
    parts = [F.trim(_c(c).cast("string")).try_cast("long") for c in (good, mid, bad)]
    total = parts[0] + parts[1] + parts[2]
    return F.coalesce(total.cast("string"), F.lit("-"))


# ---- C29 ---------------------------------------------------------------------------
def rating_to_sentiment(x: ColumnOrName) -> Column:
    """clip((rating - 3) / 2, -1, 1), two digits."""
    v = (_c(x).cast("double") - 3) / 2
    return round_half_up(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), v)), 2)


# ---- T9 ----------------------------------------------------------------------------
def classify_sentiment(x: ColumnOrName, lo: float = 0.4, hi: float = 0.6,
                       labels=("positive", "neutral", "negative")) -> Column:
    """> hi positive, < lo negative, else neutral (NULL stays NULL)."""
    v = _c(x)
    return (F.when(v.isNull(), None).when(v > hi, labels[0]).when(v < lo, labels[2]).otherwise(labels[1]))


# ---- T17 ---------------------------------------------------------------------------
def mask_names(x: ColumnOrName) -> Column:
    """Keep the first character, one ``*`` per remaining character."""
    s = _c(x)
    return F.when(s.isNull(), None).otherwise(
        F.concat(F.substring(s, 1, 1), F.repeat(F.lit("*"), F.greatest(F.length(s) - 1, F.lit(0)))))
