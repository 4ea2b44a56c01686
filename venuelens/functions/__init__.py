"""Column-level functions (built-in expressions only)."""

from .cleaning import (avg_rounded, blank_to_null, classify_sentiment, clean_review_text,
                       coerce_numeric, derive_key, gate_numeric_text, icon_class_to_rating,
                       key_or_derived, list_tail, mask_names, mask_phone, parse_count,
                       parse_number, prefix_key, rating_to_sentiment, round_half_up,
                       score_text_price, split_score_text, substitute_codepoints,
                       sum_sentiment_counts, zero_to_null, zip_scores)

__all__ = [n for n in dir() if not n.startswith("_")]
