"""Operators of a training-data pipeline over the ``documents`` and ``pages`` tables.

One module per operator; ``queries()`` and ``oracle_sql()`` collect what each module
registers. Nothing outside this package imports it.
"""

from __future__ import annotations

from importlib import import_module

_MODULES = (
    "quality_lm", "suffix_dedup", "packing", "spotsigs", "bpe", "html_paths", "url_filter", "sharding", "simhash", "repetition",
    "prefix_trie", "debruijn", "collocations",
)


def queries() -> dict:
    out = {}
    for name in _MODULES:
        out.update(import_module(f"{__name__}.{name}").QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out = {}
    for name in _MODULES:
        out.update(getattr(import_module(f"{__name__}.{name}"), "ORACLE_SQL", {}))
    return out
