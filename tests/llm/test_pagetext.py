from __future__ import annotations

import html
import random
import re

from helpers import SF, sf_table

from vigil.llm import pagetext as P
from vigil.llm import queries


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(800):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(10))] for _ in range(2))
        places = P.shared_places(a, b)
        assert len(places) == lcs(a, b)
        rest = iter(b)
        assert all(any(x == y for y in rest) for x in (a[i] for i in sorted(places)))


def test_articles_of_the_whole_table(spark):
    rows = {r.page_id: r for r in queries.op5_url_differencing(spark, SF).collect()}
    for p in sf_table("pages"):
        body = p["html"].split("<article>", 1)[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?p>|</?h1>", body)]
        text = "\n".join(x for x in blocks if x)
        assert (rows[p["page_id"]].text, rows[p["page_id"]].n_chars, rows[p["page_id"]].url) == (text, len(text), p["url"])


MESSY = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><div id="cookie-notice">we use</div><main><article><header><h1>A&nbsp;B</h1></header>
<p>x <b>y</b>z<p>second &lt;i&gt;<ul><li>one<li>two</ul><div class="share">tweet</div><form>f<input></form>tail</article><section class="comments"><p>nice</p></section></main>
<aside>s</aside><footer>f</footer><script>if(a<b)"</p>"</script><!-- <p>no</p> --></body>"""


def test_zones():
    got = P.page_lines(MESSY)
    assert [x for x, z in got if z == P.ZONE_CORE] == ["A B", "x yz", "second <i>", "one", "two", "tail"]
    assert [x for x, z in got if z == P.ZONE_CHROME] == ["Site", "we use", "tweet", "f", "nice", "s", "f"]
    assert P.page_lines("a < b &amp; c <p") == [("a < b & c", P.ZONE_LOOSE)]


def page_df(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "'y' AS path", "'z' AS text")


def test_shared_lines_of_near_urls_go(spark):
    page = lambda own: f"<div>Welcome to the site</div><div>{own}</div><div>All rights</div>"
    rows = [(1, "http://a.org/news/1", page("first story")), (2, "http://a.org/news/2?x=1", page("second story")), (3, "http://b.org/news/3", page("alone"))]
    got = {r.page_id: (r.text, r.partner_id, r.n_shared_lines) for r in P.main_text(page_df(spark, rows).coalesce(1)).collect()}
    assert got[3] == ("Welcome to the site\nalone\nAll rights", None, 0)
    assert got[1][0] in ("first story", "Welcome to the site\nfirst story\nAll rights")


def test_neighbours():
    page = lambda i, path, host="a": P._Page(i, "u", host, path, "<p>s</p><p>%d</p>" % i)
    a, b, c, d = page(1, "/x/1"), page(2, "/x/22"), page(3, "/y/2"), page(4, "/x/2", "b")
    assert b.nearer(a, c) is a and c.nearer(b, d) is b and a.nearer(None, d) is None
    assert a.row(b)[2] == "1" and a.row(None)[2] == "s\n1"
    copies = [P._Page(i, "u", "a", "/p", "<article><p>same</p></article>") for i in (1, 2)]
    assert copies[0].row(copies[1])[2] == "same"


def test_edges(spark):
    long = "<article>" + "<p>word and more</p>" * 5000 + "</article>"
    rows = [(1, None, None), (2, "not a url", ""), (None, "http://h/a", long), (3, "http://h/a", "plain text"), (3, "http://h/a", "plain text"), (4, "http://h/b", "<article><p>cut off &am")]
    out = P.main_text(page_df(spark, rows)).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in out if r.page_id != 3) == [(0, 13 * 5000 + 4999), (1, 0), (2, 0), (4, len("cut off &am"))]
    assert len(out) == 6 and P.main_text(page_df(spark, rows).limit(0)).count() == 0


def test_one_result_for_any_number_of_ranges(spark):
    page = lambda own: f"<div>Welcome</div><div>{own}</div><div>All rights</div>"
    rows = [(h * 10 + i, f"http://h{h}.org/{i // 2}/{i}", page(f"own {h} {i}")) for h in range(12) for i in range(h % 3 + 2)]
    rows += [(500, "http://h3.org/same?a", page("x")), (500, "http://h3.org/same?b", page("y")), (500, "http://h3.org/same?b", page("z")), (500, "http://h3.org/same?b", page("z")), (None, None, "alone"), (None, "http://h3.org/same", None)]
    conf, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (1, 2, 5, 40, 200):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(sorted(map(repr, P.main_text(page_df(spark, rows)).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", conf)
    assert len(found[0]) == len(rows) and all(f == found[0] for f in found)
    assert not any("Welcome" in f for f in found[0] if "own" in f)


def test_own_text_beside_an_article_stays(spark):
    page = lambda own: f"<nav>menu {own}</nav><p>Welcome</p><p>intro {own}</p><article><p>{own}</p><p>common</p></article><p>All rights</p>"
    rows = [(i, f"http://a.org/{i}", page(f"story {i}")) for i in (1, 2, 3)]
    got = {r.page_id: r.text for r in P.main_text(page_df(spark, rows)).collect()}
    assert got == {i: f"intro story {i}\nstory {i}\ncommon" for i in (1, 2, 3)}
