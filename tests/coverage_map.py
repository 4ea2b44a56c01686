"""SURVEY section 2 id -> implementing function -> registered queries.

``python tests/coverage_map.py > COVERAGE.md`` checks that every function exists and every
query is registered, and prints the table with the oracle status of each query.
"""

from __future__ import annotations

import importlib
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

V = "venuelens."
MAP = [
    # 2.1 sources
    ("S1", "sources.files.read_csv_listing", ["read_csv_listing"]),
    ("S2", "sources.files.read_json_records", ["read_json_records"]),
    ("S3", "sources.files.read_json_wrapped", ["read_json_wrapped"]),
    ("S4", "sources.workbooks.read_workbooks", ["read_workbooks"]),
    ("S5", "sources.files.read_by_extension", ["read_by_extension"]),
    ("S6", "sources.jdbc.read_jdbc_table", []),
    ("S7", "sources.files.read_raw_listing", ["read_raw_listing"]),
    ("S8", "sources.payloads.explode_review_json", ["explode_review_json"]),
    ("S9", "sources.pages.parse_listing_pages", ["parse_listing_pages"]),
    ("S10", "sources.pages.parse_detail_pages", ["parse_detail_pages"]),
    ("S11", "sources.pages.parse_review_pages", ["parse_review_pages", "review_page_summary"]),
    ("S9", "sources.records.parse_listing_records", ["parse_listing_records"]),
    ("S11", "sources.records.parse_review_records", ["parse_review_records", "review_page_counts"]),
    ("S12", "sources.payloads.flatten_api_payload", ["flatten_api_payload", "flatten_api_summary", "flatten_api_score",
                                                     "flatten_api_shop"]),
    ("S13", "sources.dimensions.load_dimension", ["dictionary_match", "dictionary_first_match"]),
    # 2.2 sinks
    ("K1", "operators.sinks.insert_if_absent", ["insert_if_absent", "insert_if_absent_counts", "import_listing_file"]),
    ("K2", "operators.sinks.upsert_by_key", ["upsert_by_key", "upsert_counts"]),
    ("K3", "operators.sinks.upsert_partial", ["upsert_partial"]),
    ("K4", "operators.sinks.replace_by_key", ["replace_by_key"]),
    ("K5", "operators.sinks.insert_ignore", ["insert_ignore"]),
    ("K6", "operators.sinks.write_csv_export", ["write_csv_export"]),
    ("K7", "operators.sinks.load_warehouse_table", ["load_warehouse_table"]),
    ("K8", "operators.sinks.append_log", ["append_log", "import_listing_log"]),
    ("K9", "operators.sinks.delete_where", ["delete_where_kept", "delete_where_count"]),
    ("K10", "operators.sinks.toggle_pairs", ["toggle_pairs", "toggle_rejected"]),
    ("K11", "operators.sinks.cascade_delete", ["cascade_delete"]),
    ("K12", "operators.sinks.fan_out_write", ["fan_out_write"]),
    # 2.3 cleaning / filters
    ("C1", "operators.cleaning.canonical_columns", ["clean_listing", "transform_listing"]),
    ("C2", "operators.cleaning.add_missing_columns", ["transform_listing"]),
    ("C3", "functions.derive_key", ["derive_keys", "transform_listing"]),
    ("C4", "functions.prefix_key", ["derive_keys", "migrate_listing"]),
    ("C5", "operators.cleaning.dedupe", ["dedupe_by_key", "clean_listing"]),
    ("C6", "operators.cleaning.dedupe", ["dedupe_by_columns", "transform_listing"]),
    ("C7", "operators.cleaning.normalize_area_exact", ["normalize_area_exact"]),
    ("C8", "operators.cleaning.normalize_area_contains", ["normalize_area_contains", "transform_listing"]),
    ("C9", "operators.cleaning.infer_area_rules", ["infer_area_rules", "migrate_listing"]),
    ("C10", "operators.cleaning.merge_categories", ["merge_categories", "migrate_listing"]),
    ("C11", "operators.cleaning.normalize_category_synonym", ["normalize_category_synonym", "transform_listing"]),
    ("C12", "functions.mask_phone", ["parse_fields", "clean_listing"]),
    ("C13", "functions.parse_number", ["parse_fields", "transform_listing"]),
    ("C14", "functions.parse_count", ["parse_fields", "migrate_listing"]),
    ("C15", "functions.coerce_numeric", ["parse_fields", "clean_listing"]),
    ("C16", "functions.gate_numeric_text", ["parse_fields", "migrate_listing"]),
    ("C17", "functions.blank_to_null", ["parse_fields", "transform_listing"]),
    ("C18", "operators.cleaning.drop_blank_names", ["clean_listing", "transform_listing"]),
    ("C19", "operators.cleaning.stamp_provenance", ["clean_listing", "transform_listing"]),
    ("C20", "operators.cleaning.select_target", ["transform_listing"]),
    ("C21", "operators.cleaning.to_output_record", ["output_records"]),
    ("C22", "operators.cleaning.coalesce_source_fields", ["enrich_search_with_detail"]),
    ("C23", "functions.split_score_text", ["score_text_fields"]),
    ("C24", "functions.zip_scores", ["zip_scores", "flatten_api_score"]),
    ("C25", "functions.clean_review_text", ["clean_review_text", "recommended_dishes"]),
    ("C26", "functions.substitute_codepoints", ["substitute_codepoints"]),
    ("C27", "functions.icon_class_to_rating", ["icon_class_to_rating"]),
    ("C28", "functions.sum_sentiment_counts", ["sum_sentiment_counts"]),
    ("C29", "functions.rating_to_sentiment", ["rating_to_sentiment"]),
    ("C30", "plans.cleaning.clean_listing", ["clean_listing", "clean_listing_log"]),
    ("C31", "plans.cleaning.transform_listing", ["transform_listing"]),
    ("C32", "plans.cleaning.migrate_listing", ["migrate_listing"]),
    ("C33", "operators.cleaning.enforce_schema", ["enforce_schema_valid", "enforce_schema_rejects"]),
    ("F1", "operators.filters.search_listings", ["search_listings", "search_total", "search_default_page"]),
    ("F2", "operators.filters.filter_polarity", ["filter_polarity_positive", "filter_polarity_negative"]),
    ("F3", "operators.filters.filter_training_rows", ["filter_training_rows"]),
    ("F4", "operators.filters.filter_logs", ["filter_logs", "filter_logs_page", "filter_logs_total"]),
    ("F5", "operators.filters.exclude_tags", ["exclude_tags"]),
    ("F6", "operators.filters.get_by_key", ["get_by_key"]),
    # 2.4 aggregates
    ("A1", "operators.aggregates.overview", ["overview"]),
    ("A2", "operators.aggregates.area_distribution", ["area_distribution"]),
    ("A3", "operators.aggregates.category_distribution", ["category_distribution"]),
    ("A4", "operators.aggregates.price_distribution", ["price_distribution"]),
    ("A5", "operators.aggregates.rating_distribution", ["rating_distribution", "rating_distribution_open"]),
    ("A6", "operators.aggregates.area_avg_price", ["area_avg_price"]),
    ("A7", "operators.text.review_keywords", ["review_keywords"]),
    ("A8", "operators.aggregates.top_categories", ["top_categories", "top_areas_by_count"]),
    ("A9", "operators.aggregates.source_breakdown", ["source_breakdown"]),
    ("A10", "operators.aggregates.log_level_counts", ["log_level_counts"]),
    ("A11", "operators.aggregates.area_density", ["area_density"]),
    ("A12", "operators.aggregates.business_area_counts", ["business_area_counts"]),
    ("A13", "operators.aggregates.area_category_cross", ["area_category_cross"]),
    ("A14", "operators.aggregates.area_price_level", ["area_price_level"]),
    ("A15", "operators.aggregates.heatmap_cells", ["heatmap_cells"]),
    ("A16", "operators.aggregates.map_clusters", ["map_clusters"]),
    ("A17", "operators.aggregates.distance_bands", ["distance_bands"]),
    ("A18", "operators.aggregates.price_tiers", ["price_tiers"]),
    ("A19", "operators.aggregates.category_price_compare", ["category_price_compare"]),
    ("A20", "operators.aggregates.listing_rating_profile", ["listing_rating_profile"]),
    ("A21", "operators.aggregates.listing_detail", ["listing_detail"]),
    ("A22", "operators.aggregates.home_kpis", ["home_kpis"]),
    ("A23", "operators.aggregates.crawl_monitor", ["crawl_monitor"]),
    ("A24", "operators.aggregates.data_quality", ["data_quality", "duplicate_review_ids"]),
    ("A25", "operators.aggregates.approx_profile", ["approx_profile", "approx_profile_by_month"]),
    # 2.5 joins
    ("J1", "operators.joins.favorites_only", ["favorites_only"]),
    ("J2", "operators.joins.exclude_favorites", ["exclude_favorites"]),
    ("J3", "operators.joins.user_favorites", ["user_favorites", "user_favorites_page", "user_favorites_total"]),
    ("J4", "operators.joins.listing_reviews", ["listing_reviews", "listing_reviews_page", "listing_reviews_total"]),
    ("J5", "operators.joins.enrich_search_with_detail", ["enrich_search_with_detail"]),
    ("J6", "operators.joins.fetch_backlog", ["fetch_backlog"]),
    ("J7", "operators.joins.dictionary_match", ["dictionary_match", "dictionary_first_match", "dictionary_match_table"]),
    ("J8", "operators.joins.find_competitors", ["find_competitors", "competitor_totals"]),
    ("J9", "operators.joins.orphan_check", ["orphan_check"]),
    ("J10", "operators.joins.band_join", ["price_band_join"]),
    # 2.6 windows
    ("W1", "operators.filters.page", ["search_listings", "user_favorites_page", "listing_reviews_page"]),
    ("W2", "operators.filters.sort_modes", ["search_listings", "search_default_page"]),
    ("W3", "operators.filters.distinct_latest_tasks", ["distinct_latest_tasks"]),
    ("W4", "operators.windows.top_bottom", ["top_bottom_area_price"]),
    ("W5", "operators.windows.value_for_money_rank", ["value_for_money_rank", "value_for_money_top"]),
    ("W6", "operators.windows.hot_rank", ["hot_rank"]),
    ("W7", "operators.windows.market_share", ["market_share"]),
    ("W8", "operators.windows.price_anomaly", ["price_anomaly_zscore", "price_anomaly_iqr"]),
    ("W9", "operators.cleaning.first_wins", ["dedupe_by_key", "last_wins"]),
    ("W10", "operators.windows.max_scale", ["max_scale"]),
    # 2.7 sets
    ("U1", "operators.sets.word_cloud", ["review_keywords", "dashboard"]),
    ("U2", "operators.sets.merge_sources", ["merge_sources"]),
    ("U3", "operators.sets.known_plus_extra", ["known_plus_extra", "area_avg_price"]),
    ("U4", "operators.sets.sync_diff", ["sync_diff", "sync_counts"]),
    # 2.8 text
    ("T1", "operators.text.tokenize", ["tokenize"]),
    ("T2", "operators.text.remove_stopwords", ["word_counts"]),
    ("T3", "operators.text.word_counts", ["word_counts"]),
    ("T4", "operators.text.prioritized_topn", ["review_keywords"]),
    ("T5", "operators.text.tfidf_keywords", ["tfidf_keywords"]),
    ("T6", "operators.text.textrank_keywords", ["textrank_keywords"]),
    ("T7", "operators.text.lexicon_sentiment", ["lexicon_sentiment"]),
    ("T8", "operators.text.train_sentiment", ["sentiment_model_scores"]),
    ("T8", "operators.sentiment.holdout_sentiment", ["sentiment_holdout", "sentiment_cross_validation"]),
    ("T9", "functions.classify_sentiment", ["classify_sentiment", "sentiment_summary"]),
    ("T10", "operators.text.aspect_sentiment", ["aspect_sentiment"]),
    ("T11", "operators.text.service_quality", ["service_quality"]),
    ("T12", "operators.text.extract_dishes", ["extract_dishes"]),
    ("T13", "operators.text.rank_dishes", ["rank_dishes", "rank_dishes_by_group"]),
    ("T14", "operators.text.dish_sentiment", ["dish_sentiment"]),
    ("T15", "operators.text.sentiment_summary", ["sentiment_summary"]),
    ("T16", "operators.text.tag_services", ["tag_services"]),
    ("T17", "functions.mask_names", ["mask_names"]),
    # 2.9 recommendation, competition, trends, model
    ("R1", "operators.recommend.user_item_matrix", ["user_item_matrix"]),
    ("R2", "operators.recommend.user_similarity", ["user_similarity"]),
    ("R3", "operators.recommend.predict_user_rating", ["predict_user_rating"]),
    ("R4", "operators.recommend.recommend_topn", ["recommend_topn"]),
    ("R5", "operators.recommend.listing_features", ["listing_features", "listing_feature_columns"]),
    ("R6", "operators.recommend.similar_listings", ["similar_listings"]),
    ("R7", "operators.recommend.scene_score", ["scene_score"]),
    ("R8", "operators.recommend.recommend_by_scene", ["recommend_by_scene"]),
    ("P1", "operators.compete.compare_listings", ["compare_listings"]),
    ("P2", "operators.compete.strengths_weaknesses", ["strengths_weaknesses"]),
    ("P3", "operators.compete.swot", ["swot"]),
    ("P4", "operators.compete.competition_landscape", ["competition_landscape"]),
    ("X1", "operators.trends.category_trend", ["category_trend", "category_listing_trend"]),
    ("X2", "operators.trends.new_listing_trend", ["new_listing_trend"]),
    ("X3", "operators.trends.price_trend", ["price_trend"]),
    ("X4", "operators.trends.business_area_trend", ["business_area_trend"]),
    ("X5", "operators.trends.seasonal_index", ["seasonal_index"]),
    ("X6", "operators.trends.forecast_linear", ["forecast_linear"]),
    ("X7", "operators.trends.moving_average", ["moving_average"]),
    ("M1", "operators.rating_model.train_rating_model", ["train_rating_model"]),
    ("M2", "operators.rating_model.predict_rating", ["predict_rating"]),
    ("M3", "operators.rating_model.prediction_interval", ["prediction_interval"]),
    ("M4", "operators.rating_model.model_info", ["model_info"]),
    ("M5", "operators.rating_model.evaluate_model", ["evaluate_model"]),
    ("M6", "operators.rating_model.load_or_train", ["predict_rating", "model_info", "rating_model_checks"]),
    # 2.10 streaming
    ("G1", "streaming.jobs.stream_upsert", ["stream_upsert", "stream_upsert_out_of_order", "stream_upsert_compacted"]),
    ("G2", "streaming.jobs.stream_dedupe", ["stream_dedupe"]),
    ("G3", "streaming.jobs.stream_level_counts", ["stream_level_counts", "stream_level_counts_sliding"]),
    ("G4", "streaming.jobs.stream_sessions", ["stream_sessions"]),
    ("G5", "streaming.jobs.stream_progress", ["stream_progress", "stream_progress_milestones"]),
    ("G6", "streaming.jobs.stream_enrich", ["stream_enrich"]),
    ("G7", "streaming.jobs.stream_late_split", ["stream_late_split"]),
    # 2.11 reports
    ("B1", "plans.reports.report_dataset", ["report_dataset"]),
    ("B2", "plans.reports.report_facts", ["report_facts"]),
    ("B3", "plans.reports.market_report", ["market_report", "market_report_period"]),
    ("B4", "plans.reports.competitor_report", ["competitor_report"]),
    ("B5", "plans.reports.dashboard", ["dashboard"]),
]


def main():
    import __spark_entry__ as E
    qs, sql = E.registry.queries(), E.registry.oracle_sql()
    used = set()
    print("# Coverage of the SURVEY section 2 inventory\n")
    print("Generated by `tests/coverage_map.py` (which checks that every function exists and every query is "
          "registered). Oracle: Y = DuckDB SQL, exact match at sf0.01; R = rows-only.\n")
    print("| id | function | registered queries |")
    print("| --- | --- | --- |")
    for sid, fn, names in MAP:
        mod, attr = (V + fn).rsplit(".", 1)
        getattr(importlib.import_module(mod), attr)      # raises if missing
        cells = []
        for n in names:
            if n not in qs:
                raise SystemExit(f"{sid}: query {n} is not registered")
            used.add(n)
            cells.append(f"`{n}` ({'Y' if n in sql else 'R'})")
        print(f"| {sid} | `{fn}` | {', '.join(cells) if cells else 'none (no JDBC driver or database offline)'} |")
    extra = sorted(set(qs) - used)
    if extra:
        print("\nOther registered queries: " + ", ".join(f"`{n}` ({'Y' if n in sql else 'R'})" for n in extra))


if __name__ == "__main__":
    main()
