"""Readers: workbook round trip, wrapped JSON, extension dispatch, JDBC options, pages."""

import json
import os
import tempfile

import pytest

from venuelens.sources import files as S
from venuelens.sources import jdbc as JD
from venuelens.sources import pages as PG
from venuelens.sources import records as RC
from venuelens.sources import workbooks as WB


def _tmp():
    return tempfile.mkdtemp(prefix="venuelens-test-", dir="/tmp")


def test_workbook_round_trip(spark):
    d = _tmp()
    with open(os.path.join(d, "a.xlsx"), "wb") as f:
        f.write(WB.build_xlsx(["﻿餐厅名", "人均"], [["老店", "88"], ["新店", None]]))
    with open(os.path.join(d, "b.xlsx"), "wb") as f:
        f.write(WB.build_xlsx(["餐厅名", "人均", "extra"], [["三店", "5", "x"]]))
    df = WB.read_workbooks(spark, d)
    assert df.columns[:3] == ["餐厅名", "人均", "extra"]
    rows = sorted((r["餐厅名"], r["人均"]) for r in df.collect())
    assert rows == [("三店", "5"), ("新店", None), ("老店", "88")]


def test_written_documents_hold_a_bounded_number_of_rows(spark, monkeypatch):
    from venuelens.registry import sources_q as Q
    monkeypatch.setattr(Q, "FILE_ROWS", 40)
    df = spark.range(0, 100, 1, 1).selectExpr("CAST(id AS STRING) AS id", "IF(id % 3 = 0, NULL, 'x') AS title")
    want = sorted((str(i), None if i % 3 == 0 else "x") for i in range(100))

    def same(rows):
        assert sorted((r.id, r.title) for r in rows) == want
    for key in (None, "restaurants"):
        d = _tmp() + "/docs.json"
        Q._json_array_files(df, d, key)
        docs = [json.loads(r.value) for r in spark.read.option("wholetext", True).text(d).collect()]
        assert sorted(len(x[key] if key else x) for x in docs) == [20, 40, 40]     # one document a file
        same((S.read_json_wrapped(spark, d, ["id", "title"]) if key else S.read_by_extension(spark, d)).collect())
    books = WB.workbooks_from_frame(df, rows=40)
    assert sorted(len(WB.parse_xlsx(bytes(r.content))) for r in books.collect()) == [21, 41, 41]
    monkeypatch.setattr(WB, "PARSED_ROWS", 7)
    got = WB.parse_workbook_frame(books, ["id", "title"]).collect()
    same(got)
    assert sorted({r._row for r in got}) == list(range(1, 41))                     # row numbers go on over frames


def test_json_wrapped_and_bare(spark):
    d = _tmp()
    with open(os.path.join(d, "w.json"), "w") as f:
        json.dump({"meta": 1, "items": [{"name": "a", "price": 1}, {"name": "b"}]}, f)
    with open(os.path.join(d, "x.json"), "w") as f:
        json.dump({"name": "c", "price": "3"}, f)
    rows = sorted(tuple(r) for r in S.read_json_wrapped(spark, d, ["name", "price"]).collect())
    assert rows == [("a", "1"), ("b", None), ("c", "3")]


def test_extension_dispatch(spark):
    with pytest.raises(ValueError):
        S.read_by_extension(spark, "/tmp/file.txt")
    d = _tmp()
    p = os.path.join(d, "f.csv")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write('name,note\n"A","line1\nline2"\n')
    df = S.read_by_extension(spark, p)
    assert df.columns == ["name", "note"] and df.first().note == "line1\nline2"


def test_jdbc_options_partitioned():
    o = JD.jdbc_options("jdbc:x", "t", ["a", "b"], "a > 1", "id", 0, 100, 4)
    assert o["dbtable"] == "(SELECT a, b FROM t WHERE a > 1) q" and o["numPartitions"] == "4"
    with pytest.raises(ValueError):
        JD.jdbc_options("jdbc:x", "t", partition_column="id")


def test_pages_on_literal_html(spark):
    html = ('<html lang="zh"><head><title>店 A.</title></head><body><ul><li><a href="/s/1">甲店</a></li>'
            '<li><a href="/s/2">乙&amp;店</a></li></ul><article><p>好吃 <b>!</b></p><p>电话 021-6666 8888</p>'
            '</article><footer>&copy; x</footer></body></html>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    items = [(r.position, r.link, r.name) for r in PG.parse_listing_pages(pages).collect()]
    assert items == [(1, "/s/1", "甲店"), (2, "/s/2", "乙&店")]
    d = PG.parse_detail_pages(pages).first()
    assert (d.name, d.lang, d.n_links, d.phone, d.other_info) == ("店 A", "zh", 2, "021-6666 8888", "© x")
    assert [r.text for r in PG.parse_review_pages(pages).collect()] == ["好吃 !", "电话 021-6666 8888"]


LIST_PAGE = """<html><body><ul><li><a class="addr" href="/x">nav</a></li></ul><div id="a" class="content shop-list"><ul>
<li class="first"><div class="pic"><a><img title="t" src="/p/1.jpg"/></a></div><div class="txt"><div class="tit">
<a href="/shop/1" data-shopid="S1"><h4>老店 &amp;lt;</h4></a></div><div class="comment"><div class="star_icon">
<span class="star star_45 star_sml"></span></div><a class="review-num"><b>12</b>
条评价</a><a class="mean-price">人均<b>￥88</b></a></div><div class="tag-addr"><span class="tag">火锅</span><span class="tag">静安寺</span>
<span class="addr">南京路 1 号</span></div></div><div class="recommend"><div>推荐</div> 毛肚</div>
<span class="comment-list"><span>口味<b>8.1</b></span><span>环境<b>7</b></span></span></li>
<li><div class="txt"><div class="tit"><a href="/shop/2">新店</a></div><div class="comment"><div class="star_score"> 4.83 </div>
<div class="star_icon"><span class="star star_40"></span></div></div><div class="tag-addr"><span class="tag">only one</span></div></div></li>
<li></li></ul></div></body></html>"""

REVIEW_PAGE = """<html><body><label class="filter-pic">图<span class="count">(3)</span></label><label class="filter-good"><span class="count">(12)</span>
</label><label class="filter-bad"><span class="count">x</span></label><div class="reviews-items"><ul><li><div class="main-review big">
<a class="name" href="/member/77">小 明</a><span class="sml-rank-stars sml-str35 star"></span><span class="score">
<span class="item">口味：4.5</span>
<span class="item">口味：1.0</span>
<span class="item">环境：4.0</span>
<span class="item">人均：88元</span></span><div class="review-words">很 好 吃<div class="more">收起评价</div></div>
<div class="review-recommend">喜欢的菜：
<a>毛肚</a>
<a>鸭血</a></div><div class="review-pictures"><a href="/photo/1"></a><a target="b" href="/photo/2"></a></div>
<span class="time">2024-01-02</span><span class="actions"><a data-id="R9"></a></span><p class="shop-reply-content">谢谢</p></div></li>
<li><div class="main-review"><div class="review-words"></div></div></li></ul></div>
<div class="reviews-pages"><span class="time">footer</span></div></body></html>"""


def test_listing_records_of_a_stored_page(spark):
    rows = [(1, LIST_PAGE), (2, None), (3, ""), (4, "<ul><li>no list</li></ul>")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    a, b, c = RC.parse_listing_records(pages).orderBy("position").collect()
    assert a[:3] == (1, 1, "S1") and a.name == "老店 &lt;" and (a.link, a.picture) == ("/shop/1", "/p/1.jpg")
    assert (a.score, a.review_count, a.avg_price) == ("4.5", "12 条评价", "￥88")
    assert (a.tag1, a.tag2, a.address, a.recommended) == ("火锅", "静安寺", "南京路 1 号", "推荐 毛肚")
    assert a.score_text == "口味8.1环境7"
    assert (b.listing_id, b.name, b.score, b.avg_price, b.tag1, b.tag2, b.picture) == ("-", "新店", "4.83", "￥0", "-", "-", "-")
    assert set(c[2:]) == {"-", "￥0"}


def test_review_records_of_a_stored_page(spark):
    pages = spark.createDataFrame([(1, REVIEW_PAGE), (2, None), (3, "")], "page_id long, html string")
    a, b = RC.parse_review_records(pages, picture_host="h").orderBy("position").collect()
    assert (a.review_id, a.user_id, a.user_name, a.total_score) == ("R9", "77", "小 明", "3.5")
    assert a.scores == {"口味": "4.5", "环境": "4.0"} and a.avg_price == "88" and a.text == "很好吃"
    assert a.dishes == ["毛肚", "鸭血"] and a.pictures == ["h/photo/1", "h/photo/2"] and a.time == "2024-01-02" and a.reply == "谢谢"
    assert (b.review_id, b.user_id, b.user_name, b.total_score, b.text, b.time, b.reply) == ("-", "-", "-", "", "", "-", "")
    assert b.scores == {} and b.avg_price == "" and b.dishes == [] and b.pictures == []
    counts = {r.page_id: tuple(r)[1:] for r in RC.review_page_counts(pages).collect()}
    assert counts == {1: (3, 12, 0, 0, 12), 2: (0, 0, 0, 0, 0), 3: (0, 0, 0, 0, 0)}


def test_records_of_long_pages(spark):
    """A block of a megabyte, and a tag that never ends, cost no stack."""
    long = "word " * 200_000
    page = f'<div class="reviews-items"><div class="main-review"><div class="review-words">{long}<b>x</b></div></div></div>'
    broken = f'<div class="reviews-items"><div class="main-review"><div class="review-words">{"<i>a</i>" * 20_000}'
    got = RC.parse_review_records(spark.createDataFrame([(1, page), (2, broken)], "page_id long, html string"), drop_spaces=False)
    rows = {r.page_id: r.text for r in got.collect()}
    assert len(rows[1]) == len(long) + 1 and rows[2] == ""
