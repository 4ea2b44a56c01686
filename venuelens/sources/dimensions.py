"""Dictionaries as dimension tables."""

from ..dims import polarity_terms_df, terms_df, words_df  # noqa: F401


def load_dimension(spark, mapping: dict):
    """``{group: [terms]}`` -> (grp, term, priority); ``{polarity: {aspect: [terms]}}`` ->
    (polarity, aspect, term, priority)."""
    nested = any(isinstance(v, dict) for v in mapping.values())
    return polarity_terms_df(spark, mapping) if nested else terms_df(spark, mapping)
