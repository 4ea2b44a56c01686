"""Band totals against pairs, with crowded segments, ties and bounds that lie on prices."""

import random

import pytest

from venuelens.operators import joins as J
from venuelens.operators.bands import band_totals, running_totals
from pyspark.sql import functions as F


def listings(seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(300):
        hot = i < 120                                   # a crowded segment with many equal prices
        price = rnd.choice([100.0, 80.0, 120.0, 83.33, 0.0, None]) if hot and i % 2 else round(rnd.uniform(0, 300), 2)
        rows.append((i, "ba0" if hot else rnd.choice(["ba1", "ba2", None]), "c0" if hot else rnd.choice(["c0", "c1", None]), price,
                     rnd.choice([None, rnd.randint(-5, 100)])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_totals_are_the_sums_over_pairs(spark, seed):
    rows = listings(seed)
    df = spark.createDataFrame(rows, "listing_id long, business_area string, category string, price double, v long")
    value = {r[0]: r[4] for r in rows}
    want = {r[0]: [0, 0, 0, 0] for r in rows if r[3] and r[1] is not None and r[2] is not None}
    for p in J.find_competitors(df, 0.2).collect():
        w = want[p.listing_id]
        v = value[p.competitor_id]
        w[0], w[1], w[2], w[3] = w[0] + 1, w[1] + (p.price_gap < 0), w[2] + (v or 0), w[3] + (v is not None)
    got = {r.listing_id: [r.n, r.n_cheaper, r.v, r.n_v] for r in band_totals(df, 0.2, ["v"]).collect()}
    assert got == want
    some = spark.createDataFrame([(5,), (130,), (131,), (999,)], "listing_id long")
    assert {r.listing_id: [r.n, r.n_cheaper, r.v, r.n_v] for r in band_totals(df, 0.2, ["v"], targets=some).collect()} == {
        k: want[k] for k in (5, 130, 131) if k in want}


def test_no_rows(spark):
    df = spark.createDataFrame([], "listing_id long, business_area string, category string, price double")
    assert band_totals(df).count() == 0


def test_running_totals_cross_partitions(spark):
    df = spark.range(1000).select(F.col("id").alias("x"), (F.col("id") % 7).alias("v"))
    got = {r.x: r.upto_v for r in running_totals(df, [F.col("x")], ["v"]).collect()}
    total = 0
    for x in range(1000):
        total += x % 7
        assert got[x] == total
