"""SQL text (DuckDB dialect) for the oracle side of the cleaning functions.

These mirror ``venuelens.functions`` and the dictionary expressions of
``operators.cleaning`` so the oracle is written independently of Spark.
"""

from __future__ import annotations


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def mask_phone(x: str) -> str:
    d = f"regexp_replace(CAST({x} AS VARCHAR), '\\D', '', 'g')"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN length({d}) >= 7 "
            f"THEN concat(substr({d}, 1, 3), '****', right({d}, 4)) END")


def mask_phone_eleven(x: str) -> str:
    d = f"regexp_replace(CAST({x} AS VARCHAR), '\\D', '', 'g')"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN length({d}) = 11 "
            f"THEN concat(substr({d}, 1, 3), '****', right({d}, 4)) ELSE CAST({x} AS VARCHAR) END")


def parse_number(x: str, default="0.0") -> str:
    v = f"TRY_CAST(nullif(regexp_extract(trim(CAST({x} AS VARCHAR)), '-?\\d+(\\.\\d+)?', 0), '') AS DOUBLE)"
    return f"coalesce({v}, {default})" if default is not None else v


def parse_count(x: str) -> str:
    return f"CAST(round_even({parse_number(x)}, 0) AS BIGINT)"


def coerce_numeric(x: str) -> str:
    return f"TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DOUBLE)"


def blank_to_null(x: str, tokens=("", "nan")) -> str:
    toks = ", ".join(lit(t) for t in tokens)
    return f"CASE WHEN lower(trim({x})) IN ({toks}) THEN NULL ELSE trim({x}) END"


def category_synonym(x: str, groups: dict, default: str) -> str:
    v = f"trim(coalesce(CAST({x} AS VARCHAR), ''))"
    parts = [f"WHEN {v} = '' THEN {lit(default)}"]
    for g, terms in groups.items():
        for t in terms:
            parts.append(f"WHEN contains(lower({v}), {lit(t.lower())}) THEN {lit(g)}")
    return "CASE " + " ".join(parts) + f" ELSE {v} END"


def area_contains(cols, area_dict: dict, match_names: bool = True) -> str:
    parts = []
    for c in cols:
        text = f"trim(coalesce(CAST({c} AS VARCHAR), ''))"
        pairs = [(d, d) for d in area_dict] if match_names else []
        pairs += [(d, a) for d, terms in area_dict.items() for a in terms if a]
        for d, term in pairs:
            parts.append(f"WHEN {text} <> '' AND contains({text}, {lit(term)}) THEN {lit(d)}")
    return "CASE " + " ".join(parts) + " END"


def map_lookup(x: str, groups: dict) -> str:
    seen, parts = set(), []
    for g, labels in groups.items():
        for lab in labels:
            if lab not in seen:
                seen.add(lab)
                parts.append(f"WHEN {lit(lab)} THEN {lit(g)}")
    return f"CASE trim({x}) " + " ".join(parts) + " END"


def area_rules(tag: str, addr: str, exact: dict, exact_late: dict, address_rules, default) -> str:
    parts = []
    for rules in (exact, exact_late or {}):
        for d, names in rules.items():
            parts.append(f"WHEN trim({tag}) IN ({', '.join(lit(n) for n in names)}) THEN {lit(d)}")
    for kw, d in address_rules:
        parts.append(f"WHEN {addr} LIKE {lit('%' + kw + '%')} THEN {lit(d)}")
    return "CASE " + " ".join(parts) + f" ELSE {lit(default)} END"


def key_or_derived(key: str, parts, length: int = 20, prefix: str = "ds_") -> str:
    k = f"trim(CAST({key} AS VARCHAR))"
    seed = "concat_ws('|', " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + ")"
    return (f"CASE WHEN {k} IS NULL OR lower({k}) IN ('', 'nan', 'none') "
            f"THEN concat({lit(prefix)}, substr(md5({seed}), 1, {length})) ELSE {k} END")


def first_per_key(select_sql: str, keys, order) -> str:
    """Keep the first row per key by ``order`` (window form for the oracle)."""
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {', '.join(order)}) AS _rn FROM ({select_sql})) WHERE _rn = 1")
