"""Contiguous shards of near-equal bytes."""

import zlib

from llm_util import SF, awkward, empty

from venuelens.llm import sharding as H


def check(rows, texts):
    """rows (doc_id, size, text_crc32, shard, slot); texts by the same ids, with repeats."""
    want = sorted((-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r)
    assert all(0 <= s < H.SHARDS for s in by_shard)
    for part in by_shard.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in ordered] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i))
    total, most = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for part in by_shard.values():
        assert sum(r["size"] for r in part) <= total / H.SHARDS + most


def test_query(spark):
    got = H.QUERIES["op8_sharding_prefix_sums"](spark, SF)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = got.collect()
    check(rows, [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_awkward_rows(spark, tmp_path):
    df, rows = awkward(spark)
    check(H.shard(df).collect(), [(r[0], r[1]) for r in rows])
    assert H.shard(empty(spark)).count() == 0
    H.write_shards(df.dropDuplicates(["doc_id"]).selectExpr("* except (shard)", "1 as shard", "2 as slot", "3 as _id", "4 as s"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == df.dropDuplicates(["doc_id"]).count()
