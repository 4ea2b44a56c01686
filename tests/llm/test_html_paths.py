"""Main text by consensus paths."""

import html
import random
import re
from collections import Counter

from llm_util import SF

from venuelens.llm import html_paths as X

SCHEMA = "page_id long, url string, html string"


def own(source):
    """(text, path) under the page's own choice."""
    page = X.Page(source)
    return page.text(page.hashes[page.candidate()[0]])


def test_query_gives_the_article_of_every_page(spark):
    """The tables' pages hold one article of headings and paragraphs: a plain cut finds the same text."""
    source = {r.page_id: (r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = X.QUERIES["op6_html_host_paths"](spark, SF).collect()
    assert len(got) == len(source)
    for r in got:
        article = re.search(r"<article>(.*?)(</article>|\Z)", source[r.page_id][1], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == source[r.page_id][0]


def test_boilerplate_goes_and_structure_stays():
    text, path = own(
        '<html><body><nav>menu</nav><header>site</header><article><header><h1>Title</h1></header><p>Hello <b>big\n world<p>a &amp; b&nbsp;c<br>d'
        '<ul><li>x<li>y</ul><div class="user-comments">no</div><form>f</form><table><tr><td>1<td>2</table></article><div id="sidebar">s</div>'
        '<div class="cookieNotice">n</div><div role="banner">r</div><p hidden>h</p><script>var t="</p>";</script><footer>z'
    )
    assert path == ">body>article"
    assert text == "Title\nHello big world\na & b c d\nx\ny\n1\n2"


def test_heading_and_lead_stay_without_an_article_element(spark):
    body = "running text of the story " * 20
    page = "<body><nav>menu</nav><div class=post><h1>Title {n}</h1><p>the lead {n}</p><div class=body><p>{body}</div></div><div class=comments>no</div>"
    rows = [(i, f"http://h.org/{i}", page.format(n=i, body=body)) for i in range(4)]
    # most pages of this host have the text alone: heading and lead of the others stay
    alone = "<body><div class=post><div class=body><p>" + body + "</div></div>"
    rows += [(i, f"http://k.org/{i}", alone) for i in range(10, 16)] + [(16, "http://k.org/16", page.format(n=16, body=body))]
    rows += [(17, "http://k.org/17", f"<body><div class=post><div class=top><h1>Title 17</h1></div><div class=body><p>{body}</div></div>")]
    got = {r.page_id: r.text for r in X.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in (0, 1, 2, 3, 16):
        assert got[i] == f"Title {i}\nthe lead {i}\n{body.strip()}"
    assert got[10] == body.strip() and got[17] == f"Title 17\n{body.strip()}"
    assert own(f"<main><h1>Title</h1><article>{body}</article></main>")[0] == f"Title\n{body.strip()}"


def test_a_wrapper_named_like_boilerplate_stays():
    body = "running text of the story " * 20
    for wrapper in ("div class=layout-sidebar-right", "section id=discussion", "div id=related-work", "ul class=menu-page"):
        tag = wrapper.split()[0]
        page = f"<body><{wrapper}><h1>Title</h1><p>{body}</p><div class=sidebar>side</div><small class=ad>buy</small></{tag}><div class=comments><p>no</div>"
        assert own(page)[0] == f"Title\n{body.strip()}", wrapper
    page = X.Page(f"<body><div class=text><p>{body}</div><div class=comments><p>{body[:200]}</div>")
    assert page.text(page.hashes[page.candidate()[0]])[0] == body.strip() and not any("comments" in c[0] for c in page.containers)
    assert own(f"<body><article>short</article><div class=cookie-bar>{body}</div>")[0] == "short"


def test_odd_markup():
    for source, text in [
        ("", ""), ("plain 3 < 4 text", "plain 3 < 4 text"), ('<p title="x>y">a</p><a href="foo>b</a> c', "a\nb c"), ("<!-- x", ""), ("<div", ""),
        ("<style>p{}</style><title>t</title>a", "a"), ("<p>one</p></p></div>two", "one\ntwo"), ("&lt;b&gt; &#65;&#x42; &bogus; &am", "<b> AB &bogus; &am"),
        ("<textarea>x</textarea><svg><p>v</p></svg>k", "k"),
    ]:
        assert own(source)[0] == text, source
    X.Page("<div>" * 3000 + "x" + "<a b='" * 2000)


def test_the_host_decides_for_a_page_of_two_minds(spark):
    body = "<div class='story-{n}'>{story}</div><div class='extra'>{extra}</div>"
    rows = [(i, "http://h.org/%d" % i, body.format(n=i, story="running text of the story " * 20, extra="")) for i in range(6)]
    rows.append((6, "http://h.org/6", body.format(n=6, story="a short story", extra="long words of something else " * 20)))
    rows += [(7, None, None), (8, "http://other.org", "<p>alone</p>"), (8, "http://other.org", "<p>alone</p>"), (None, "x", "<p>no id</p>")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as key", "2 as host", "3 as path", "4 as text")
    got = X.extract(df).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[6] == "a short story" and by_id[7] == "" and by_id[8] == "alone" and by_id[None] == "no id"
    assert by_id[0] == " ".join(["running text of the story"] * 20)
    assert X.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sections_of_an_article_stay():
    body = "running text of the story " * 20
    parts = "<section id=discussion><h2>Discussion</h2><p>we discuss</p></section><section id=related-work><h2>Related</h2><p>others did</p></section>"
    for outer in ("article", "main"):
        assert own(f"<body><{outer}><p>{body}</p>{parts}</{outer}>")[0] == f"{body.strip()}\nDiscussion\nwe discuss\nRelated\nothers did"
        assert own(f"<body><{outer}><p>{body}</p><div class=social-sciences>of people</div></{outer}>")[0] == f"{body.strip()}\nof people"
        for name in ("user-comments", "comments", "related-posts", "social", "share-buttons", "wp-ads-x", "comment-list", "newsletter-signup"):
            assert own(f"<body><{outer}><p>{body}</p><div class={name}><p>no</p></div></{outer}>")[0] == body.strip(), name
    assert own("<p>Energy <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><annotation>E=mc^2</annotation></math> is.")[0] == "Energy E=mc2 is."


def bare_page(rng, n, site):
    """A page without <article>: site text around a story of its own."""
    story = [" ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(20, 40))) for _ in range(3)]
    inner = f"<h2>Story {n}</h2>" + "".join(f"<p>{p}</p>" for p in story)
    return f"<body><div class=top><p>{site[0]}</p></div><div class='col c{n}'>{inner}</div><p>{site[1]}</p>", "\n".join([f"Story {n}", *story])


def test_text_that_repeats_over_a_host_has_no_vote(spark):
    rng = random.Random(3)
    site = ("Welcome to our site of many stories, read on.", "All words on these pages belong to the house of words.")
    made = [bare_page(rng, n, site) for n in range(8)]
    rows = [(n, f"http://h.org/{n}", page) for n, (page, _) in enumerate(made)]
    want = {n: text for n, (_, text) in enumerate(made)}
    # the story's blocks stand beside the site text, in no container of their own
    for n in range(10, 16):
        words = " ".join(f"v{rng.randrange(900)}" for _ in range(60))
        rows.append((n, f"http://flat.org/{n}", f"<body><p>{site[0]}</p><h1>Flat {n}</h1><p>{words}</p><p>{site[1]}</p>"))
        want[n] = f"Flat {n}\n{words}"
    # copies of one text, and texts that differ in a few words only: nothing goes
    for n in range(20, 26):
        rows.append((n, f"http://copies.org/{n}", f"<body><p>{site[0]}</p><p>{site[1]}</p><p>page {n % 2}</p>"))
        want[n] = f"{site[0]}\n{site[1]}\npage {n % 2}"
    for n in range(30, 36):
        rows.append((n, f"http://near.org/{n}", f"<body><p>{site[0]}</p><p>{site[1]}</p><p>page {n}</p>"))
        want[n] = f"{site[0]}\n{site[1]}\npage {n}"
    # three pages of a host prove nothing
    for n in range(40, 43):
        rows.append((n, f"http://few.org/{n}", f"<body><p>{site[0]}</p><p>{'x' * n} {site[1]}</p>"))
        want[n] = f"{site[0]}\n{'x' * n} {site[1]}"
    got = {r.page_id: r.text for r in X.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want


def brute(rows):
    """The host vote by plain loops over parsed pages."""
    parsed = {n: (url.split("/")[2], X.Page(page)) for n, url, page in rows}
    site = {}
    for name in {h for h, _ in parsed.values()}:
        different = {tuple(page.blocks): {t for _, t, _, _ in page.blocks} for h, page in parsed.values() if h == name and not page.article()}
        times = Counter(t for texts in different.values() for t in texts)
        site[name] = {t for t, c in times.items() if len(different) >= 4 and 2 * c > len(different)}
    votes, out, mine = Counter(), {}, {}
    for n, (name, page) in parsed.items():
        mine[n] = set() if page.article() else {t for t in site[name] if any(t == b[1] for b in page.blocks)}
        if 2 * sum(b[2] for b in page.blocks if b[1] in mine[n]) > sum(b[2] for b in page.blocks):
            mine[n] = set()
        c, weight = page.candidate(mine[n])
        votes[name, page.path(c)] += weight
    for n, (name, page) in parsed.items():
        best = (0, 0, 0), None
        for c in range(len(page.containers)):
            under = {c}
            for d in range(c + 1, len(page.containers)):
                if page.containers[d][1] in under:
                    under.add(d)
            if c == 0 or c == page.candidate(mine[n])[0] or any(b[0] in under and b[1] not in mine[n] and (b[2] or b[3]) for b in page.blocks):
                depth = page.path(c).count(">")
                best = max(best, ((votes[name, page.path(c)], depth, X._signed(page.hashes[c])), page.hashes[c]), key=lambda x: (x[0], x[1] is not None))
        out[n] = page.text(best[1] if best[1] is not None else 0, mine[n])[0]
    return out


def test_votes_equal_a_plain_count(spark):
    rng = random.Random(11)
    rows = []
    for n in range(120):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            text = f"<p>{'shared words of the site' if rng.random() < 0.4 else ' '.join('u%d' % rng.randrange(99) for _ in range(rng.randrange(1, 20)))}</p>"
            if rng.random() < 0.2:
                text = f"<h2>head {rng.randrange(3)}</h2>" + text
            for _ in range(rng.randrange(0, 3)):
                tag = rng.choice(["div", "section", "article", "div class=a", "div class=b1", "main"])
                text = f"<{tag}>{text}</{tag.split()[0]}>"
            parts.append(text)
        rows.append((n, f"http://h{rng.randrange(6)}.org/{n}", "<body>" + "".join(parts)))
    got = {r.page_id: r.text for r in X.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)


def test_deep_pages_stay_linear(spark):
    deep = "<div class=level>" * 4000 + "<p>deep words</p>" + "</span>" * 4000 + "<p>tail"
    page = X.Page(deep)
    assert len(X._paths_of(page, *page.candidate())) <= 4001
    rows = [(n, f"http://d.org/{n}", deep + str(n)) for n in range(5)] + [(9, "http://d.org/9", "<div><p>words</div>" * 5000)]
    got = {r.page_id: r.text for r in X.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[3] == "deep words\ntail3" and got[9] == "\n".join(["words"] * 5000)
