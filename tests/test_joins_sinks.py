"""Joins and table maintenance: brute force and algebraic properties."""

import random

from pyspark.sql import functions as F

from venuelens.operators import joins as J
from venuelens.operators import sinks as K


def test_competitors_equal_brute_force_with_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        hot = i < 150                                   # a third of the rows in one group, many equal prices
        rows.append((i, "ba0" if hot else f"ba{rnd.randint(1, 5)}", "c0" if hot else f"c{rnd.randint(0, 2)}",
                     100.0 if hot and i % 2 else round(rnd.uniform(0, 300), 2)))
    df = spark.createDataFrame(rows, "listing_id long, business_area string, category string, price double")
    got = {(r.listing_id, r.competitor_id) for r in J.find_competitors(df, 0.2).collect()}
    want = {(a[0], b[0]) for a in rows for b in rows
            if a[0] != b[0] and a[1] == b[1] and a[2] == b[2] and a[3] > 0 and b[3] > 0
            and abs(a[3] - b[3]) <= 0.2 * a[3]}
    assert got == want


def test_competitors_are_never_broadcast(spark):
    df = spark.range(100).selectExpr("id AS listing_id", "'b' AS business_area", "'c' AS category", "CAST(id AS DOUBLE) AS price")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")   # Spark's default, set against the size of the files
    try:
        plan = J.find_competitors(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_semi_plus_anti_is_all(spark, tables):
    lst, fav = tables.listing(), tables.favorite().where("user_id % 7 = 0")
    assert J.favorites_only(lst, fav).count() + J.exclude_favorites(lst, fav).count() == lst.count()


def test_insert_if_absent_twice_inserts_nothing(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    new = spark.createDataFrame([(1, "x"), (2, "b"), (2, "c")], "k long, v string")
    once, counts = K.insert_if_absent(new, target, "k", ["v"])
    assert sorted(once.collect()) == sorted([(1, "a"), (2, "b")])
    assert tuple(counts.first()) == (1, 2, 3)
    twice, counts2 = K.insert_if_absent(new, once, "k", ["v"])
    assert sorted(twice.collect()) == sorted(once.collect()) and counts2.first().inserted == 0


def test_upsert_idempotent_and_partial(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k long, v string, p double")
    new = spark.createDataFrame([(2, "B", 20.0), (3, "C", 30.0)], "k long, v string, p double")
    once, c = K.upsert_by_key(new, target, "k", ["v"])
    twice, _ = K.upsert_by_key(new, once, "k", ["v"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [(1, "a", 1.0), (2, "B", 20.0), (3, "C", 30.0)]
    assert (c.first().inserted, c.first().updated) == (1, 1)
    part = K.upsert_partial(new.select("k", "p"), target, "k", ["p"])
    assert sorted(part.collect()) == [(1, "a", 1.0), (2, "b", 20.0), (3, None, 30.0)]


def test_toggle_twice_is_identity(spark):
    fav = spark.createDataFrame([(1, 10, None)], "user_id long, listing_id long, created_at timestamp")
    listings = spark.createDataFrame([(10,), (11,)], "listing_id long")
    t = spark.createDataFrame([(1, 11, None), (1, 10, None), (1, 99, None)], "user_id long, listing_id long, created_at timestamp")
    once, rejected = K.toggle_pairs(fav, t, listings)
    assert sorted((r.user_id, r.listing_id) for r in once.collect()) == [(1, 11)]
    assert [r.listing_id for r in rejected.collect()] == [99]
    back, _ = K.toggle_pairs(once, t, listings)
    assert sorted((r.user_id, r.listing_id) for r in back.collect()) == [(1, 10)]
    both = t.unionByName(t)
    same, _ = K.toggle_pairs(fav, both, listings)                 # an even number of toggles changes nothing
    assert sorted((r.user_id, r.listing_id) for r in same.collect()) == [(1, 10)]


def test_replace_and_cascade(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    new = spark.createDataFrame([(1, "z")], "k long, v string")
    assert sorted(K.replace_by_key(new, target, "k").collect()) == [(1, "z"), (2, "c")]
    assert sorted(K.cascade_delete(target, new, "k").collect()) == [(2, "c")]
    kept, deleted = K.delete_where(target, F.col("k") == 1)
    assert kept.count() == 1 and deleted.first().deleted == 2


def test_only_hits_of_the_filter_become_rows(spark, monkeypatch):
    monkeypatch.setattr(J, "HASHED_BYTES", 50)
    rows = [(i, "lorem ipsum dolor sit amet " * (i % 7) + ("Incomprehensibly so" if i % 10 == 0 else "ä")) for i in range(200)] + [(None, "the incomprehensible")]
    df = spark.createDataFrame(rows, "id int, text string")
    dim = spark.createDataFrame([("g", "incomprehensible", 0), ("g", "incomprehensibly", 1), ("h", "Ä", 2), ("h", "ä", 2)], "grp string, term string, priority int")
    out = J.substring_join(df, "id", "text", dim, True)
    assert "explode" not in out._jdf.queryExecution().toString()
    assert sorted(out.collect(), key=str) == sorted(J.dictionary_match(df, "id", "text", dim, True).collect(), key=str) and out.count() == 180 * 2 + 20 + 1


def test_substring_join_equals_contains(spark, monkeypatch):
    rows = [(1, "Red soup, red SOUP"), (2, ""), (3, None), (4, "a\U0001f600b soup\nred"), (5, "?b"), (5, "so"), (6, "x" * 3000 + "red"), (6, "red")]
    df = spark.createDataFrame(rows, "id long, text string").selectExpr("*", "1 as _n", "2 as _text", "3 as grp")
    dim = spark.createDataFrame([("g", "red", 0), ("g", "SOUP", 1), ("h", "\U0001f600b", 2), ("h", "?b", 3), ("h", "", 4), ("h", None, 5), ("k", "red", 6),
                                 ("k", "p\nr", 7)], "grp string, term string, priority int")
    for lower in (False, True):
        want = sorted(J.dictionary_match(df, "id", "text", dim, lower).collect())
        assert sorted(J.substring_join(df, "id", "text", dim, lower).collect()) == want and want
        monkeypatch.setattr(J, "SMALL_DICTIONARY", 3)
        large = J.dictionary_match(df, "id", "text", dim, lower)
        assert sorted(large.collect()) == want
        assert "NestedLoop" not in large._jdf.queryExecution().toString() and "Cartesian" not in large._jdf.queryExecution().toString()
        monkeypatch.undo()
    assert J.substring_join(df, "id", "text", dim.limit(0)).count() == 0
