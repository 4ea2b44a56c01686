"""Physical plan checks: pushdown, pruning, top-k, group limits, no Python in built-in operators."""

from venuelens import dims
from venuelens.operators import aggregates as A
from venuelens.operators import filters as Fl
from venuelens.operators import joins as J
from venuelens.operators import text as T
from venuelens.operators import windows as W
from venuelens.plans import cleaning as P

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_builtin_operators(tables):
    lst = tables.listing()
    for df in (A.overview(lst), A.price_distribution(lst), A.category_distribution(lst),
               P.transform_listing(tables.raw_listing(), "s", "2024-01-01 00:00:00", dims.STANDIN_CATEGORY_DICT,
                                   "other", dims.STANDIN_AREA_DICT),
               T.lexicon_sentiment(tables.review_text(), "review_id", "text", dims.STANDIN_SENTIMENT_DICT,
                                   "positive", "negative")):
        p = plan(df)
        assert not any(n in p for n in PYTHON_NODES), p


def test_filter_pushdown_and_pruning(tables):
    only_keys = Fl.search_filter(tables.listing(), category="PROMO", price_min=50).select("listing_id")
    p = plan(only_keys)
    assert "EqualTo(p_type,PROMO)" in p
    assert "lineitem" not in p                     # the outer join to per-part aggregates is removed entirely
    df = Fl.search_filter(tables.listing(), category="PROMO").select("listing_id", "review_count")
    scan = [line for line in plan(df).splitlines() if "lineitem" in line and "ReadSchema" in line]
    assert scan and "ReadSchema: struct<l_partkey:bigint>" in scan[0]


def test_paging_is_top_k(tables):
    p = plan(Fl.search_listings(tables.listing(), page_no=3))
    assert "TakeOrderedAndProject" in p


def test_group_top_k_is_limited_before_shuffle(tables):
    p = plan(W.value_for_money_rank(tables.listing(), 3, "category"))
    assert "WindowGroupLimit" in p


def test_dictionary_is_broadcast(spark, tables):
    dim = dims.terms_df(spark, dims.STANDIN_DISHES_DICT)
    p = plan(J.dictionary_match(tables.review_text(), "review_id", "text", dim, True))
    assert "BroadcastNestedLoopJoin" in p or "BroadcastExchange" in p


def test_competitor_join_is_equi_join(tables):
    p = plan(J.find_competitors(tables.listing(), 0.2))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_bucketed_tables_join_without_shuffle(spark, tables):
    import uuid
    from venuelens.operators import sinks as K
    from venuelens.session import scratch_path
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        tag = uuid.uuid4().hex[:8]
        K.load_warehouse_table(tables.review().select("review_id", "listing_id", "rating"), f"rv_{tag}",
                               bucket_by=(8, "listing_id"), path=scratch_path(spark, f"tbl/rv_{tag}"))
        K.load_warehouse_table(tables.listing().select("listing_id", "area"), f"ls_{tag}",
                               bucket_by=(8, "listing_id"), path=scratch_path(spark, f"tbl/ls_{tag}"))
        j = spark.table(f"rv_{tag}").join(spark.table(f"ls_{tag}"), "listing_id")
        p = plan(j)
        assert "SortMergeJoin" in p and "Exchange" not in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
