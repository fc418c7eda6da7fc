"""HTML extraction and URL filter on small pages."""

from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import html_extract, url_filter
from fleetlens.llm.urls import host_of, path_of
from tests.llm.data import prose


def page(title: str, body: str, tail: str = "</body></html>", extra: str = "") -> str:
    return (f"<!DOCTYPE html><html><head><title>{title}</title><script>var t='</p>';</script></head><body><header><h1>Site name</h1></header>"
            f"<nav><ul><li><a href='/a'>{prose(zlib.crc32(title.encode()) % 999, 3)}</a></li></ul></nav><div class=\"ad\">buy {title}</div>"
            f"<div class='wrap'><div class='story'><h2>{title}</h2>{body}</div></div>{extra}<footer>&copy; 2024 {title}</footer>{tail}")


def test_wrapper_finds_the_story_without_article_tags(spark):
    rows, want = [], {}
    for i in range(12):
        title, a, b = prose(i, 4), prose(100 + i, 40), prose(200 + i, 30)
        body = f"<p>{a}\n  more &amp; more<p><b>{b}<br>end</b></p><p>Follow us everywhere</p>"
        rows.append((i, "http://Shop.example.com/x", page(title, body, "" if i % 3 else "</body></html>",
                                                         f"<section class='comments'><p>reader {prose(i + 50, 30)}</p></section>")))
        want[i] = "\n".join([title, f"{a} more & more", f"{b} end", "Follow us everywhere"])
    rows += [(20, None, None), (21, "http://a.b/", ""), (22, "http://a.b/", "<article>only <i>one</i> page</article><p>outside"),
             (23, None, "plain text < 3 &lt; 4"), rows[0]]
    got = {}
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("N_Chars", F.lit("clash"))
    for r in html_extract.extract_main_text(table).collect():
        assert r.n_chars == len(r.text)
        got[r.page_id] = r.text
    assert {i: got[i] for i in want} == want
    assert (got[20], got[21], got[22], got[23]) == ("", "", "only one page", "plain text < 3 < 4")
    assert html_extract.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("html, text", [
    ("<p>a<b>b</b>\n c<br>d<p>e &lt; f < g<ul><li>one<li>two</ul>", "ab c d\ne < f < g\none\ntwo"),
    ("<main><p>x</main><aside>side</aside>", "x"),
    ("<article><h1>t</h1><form><input>f</form><div class='ad-box'>a</div><p>p</p></article><div>o</div>", "t\np"),
    ("<p>cut at <b>the e", "cut at the e"),
    ("<p>tag open at the end <a href='", "tag open at the end"),
    ("<style>p{}</style><!-- no --><p>\u00a0 x \u00a0</p>", "x"),
])
def test_main_text_of_single_pages(html, text):
    assert html_extract.main_text(html, None, None) == text


def test_template_inside_the_root_needs_support():
    pages = [f"<div id=a><p>{prose(i, 20)}</p><div class=x>Read our terms</div></div>" for i in range(9)]
    tree = html_extract.shape(html_extract.parse(pages[0]))
    stats: dict[int, list] = {}
    for p in pages:
        for number, h, length in html_extract.page_stats(html_extract.parse(p), tree):
            stats.setdefault(number, []).append((h, length))
    rows = [(n, len(x), min(h for h, _ in x), max(h for h, _ in x), sum(m for _, m in x)) for n, x in stats.items()]
    wrapper = html_extract.induce(tree, rows)
    assert html_extract.main_text(pages[3], tree, wrapper) == prose(3, 20)
    few = html_extract.induce(tree, [(n, 3, lo, hi, m) for n, _, lo, hi, m in rows])
    assert html_extract.main_text(pages[3], tree, few) == prose(3, 20) + "\nRead our terms"


def site(i: int, inside: str = "", outer: str = "story") -> str:
    return f"<nav>{prose(i, 3)}</nav><div class='{outer}'><h2>{prose(400 + i, 4)}</h2><p>{prose(500 + i, 40)}</p>{inside}</div><div class=end>end {i}</div>"


def _texts(spark, htmls):
    rows = [(i, "http://a.example.com/x", h) for i, h in enumerate(htmls)]
    return {r.page_id: r.text for r in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def _own(i: int) -> str:
    return prose(400 + i, 4) + "\n" + prose(500 + i, 40)


def test_copies_of_a_page_are_no_template(spark):
    """What only the copies of one page have is article text, whichever page is the reference."""
    rows, want = [], {}
    for copied in range(10):                                # ten hosts, a different page copied on each
        for i in [*range(10), *[copied] * 30]:
            inside = "<blockquote>words of the copied page</blockquote>" if i == copied else ""
            rows.append((len(rows), f"http://h{copied}.example.com/x", site(i, inside)))
            want[rows[-1][0]] = _own(i) + ("\nwords of the copied page" if inside else "")
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_extract.extract_main_text(table).collect()} == want


def test_second_layouts_and_deviating_pages_have_their_template(spark):
    """Constant blocks go on pages of another layout or with a block the reference lacks, and one deviating page changes nothing."""
    notice = "<section>Read our terms</section>"
    htmls = [site(i, notice if i % 2 else "", "story" if i % 4 < 2 else "other") for i in range(60)] + [site(61, "<section>My own section</section>")]
    got = _texts(spark, htmls)
    assert {i: got[i] for i in range(60)} == {i: _own(i) for i in range(60)}
    assert got[60] == _own(61) + "\nMy own section"


def test_deep_and_wide_pages_end_quickly(spark):
    """100,000 nested tags and 20,000 slots, aligned with another page of the host: no recursion, no quadratic table."""
    deep = "<div>" * 100_000 + "deep words" + "</div>" * 100_000 + "<p>after</p>"
    wide = "".join(f"<h2>h {i}</h2><p>p {i}</p>" for i in range(10_000))
    other = "<section>other</section>" + "".join(f"<p>q {i}</p><h2>g {i}</h2>" for i in range(10_000)) + "<div>end</div>"
    stray = "<div>" * 20_000 + "</section>" * 20_000 + "stray"
    got = _texts(spark, [deep, wide, other, stray])
    assert got[0] == "deep words\nafter" and got[3] == "stray"
    assert got[1] == "\n".join(f"h {i}\np {i}" for i in range(10_000))
    assert got[2] == "\n".join(["other", *(f"q {i}\ng {i}" for i in range(10_000)), "end"])


def test_unequal_slots_are_matched_in_order():
    tree = html_extract.shape(html_extract.parse("<h1>a</h1><div class=x>b</div><p>c</p><ul><li>d</ul><p>e</p><footer>f</footer>"))
    found: dict[int, list] = {}
    weight = html_extract.match(html_extract.parse("<h1>A</h1><p>C</p><table>t</table><p>E</p><footer>F</footer>"), tree, 0, found)
    labels = [t[0] for _, t in html_extract.numbered(tree)]
    assert weight == 5 and [labels[n] for n in sorted(found)] == ["html", "h1", "p", "p", "footer"]


@pytest.mark.parametrize("n", [40, 600])
def test_the_heaviest_match_at_any_number_of_slots(n):
    """The early table belongs to the reference's end: matched in turn it would cost all headings."""
    page = "<form>f</form><table><tr><td>x</td></tr></table>" + "<h2>a</h2><p>b</p>" * n + "<hr>"
    tree = html_extract.shape(html_extract.parse("<hr>" + "<h2>a</h2><p>b</p>" * n + "<table><tr><td>x</td></tr></table><form>f</form><pre>x</pre>"))
    found: dict[int, list] = {}
    assert html_extract.match(html_extract.parse(page), tree, 0, found) == 1 + 2 * n
    labels = [t[0] for _, t in html_extract.numbered(tree)]
    assert sorted(labels[i] for i in found) == ["h2"] * n + ["html"] + ["p"] * n


def test_a_page_and_its_own_shape_match_whole():
    page = html_extract.parse(site(3) + "<ul><li>a<li>b</ul><div><div><p>x</p></div></div><p>y<p>z")
    tree = html_extract.shape(page)
    found: dict[int, list] = {}
    html_extract.match(page, tree, 0, found)
    assert html_extract.aligned(page, None) == found and list(found) == list(range(len(html_extract.numbered(tree))))


URLS = ["http://WWW.Example.com/en/1?x=1#y", "https://m.example.com/en/2", "http://a.net/es/3", "http://a.net/de/3", "http://net/fr/", "x.com/en/", None, "",
        "ftp://example.com", "http://example.com?q=/en/", "http://notexample.com/en/", "http://a.org/en/9/", "http://h://k/en"]


def brute(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    best = max(((len(h + p), h + p, v) for v, h, p in url_filter.LISTED if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
    return host, path, best and best[1], best and best[2]


def test_url_parts_and_listed_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0])], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = url_filter.judge(pages, labels).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path, rule, verdict = brute(r.url)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), r.url
    assert url_filter.judge(pages.where("false"), labels).count() == 0
    parts = pages.select(host_of(pages.url).alias("h"), path_of(pages.url).alias("p")).collect()
    assert [(r.h, r.p) for r in parts[:len(URLS)]] == [brute(u)[:2] for u in URLS]


def test_mined_rules_equal_brute_force(spark):
    from itertools import combinations
    rows, labels = [], []
    for i in range(200):
        spam = i % 5 == 0
        rows.append((i, f"http://{'casino' if spam else 'news'}.x{i % 7}.org/{'win' if i % 2 else 'en'}/{i}.html"))
        labels.append((i, 0 if spam and i % 25 else 1, 0))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marks = spark.createDataFrame(labels + [(None, 0, 1)], "doc_id long, quality int, toxic int")
    mined = {tuple(sorted(r.tokens)): r.confidence for r in url_filter.mine(pages, marks, 0.05, 0.6).collect()}
    tokens = {r.page_id: set(r.t) for r in pages.select("page_id", url_filter.url_tokens(pages.url).alias("t")).collect()}
    bad = {i for i, q, _ in labels if q == 0}
    want = {}
    for size in range(1, 6):
        for combo in combinations(sorted(set().union(*tokens.values())), size):
            have = [i for i, t in tokens.items() if set(combo) <= t]
            hit = len([i for i in have if i in bad])
            if hit >= 20 and hit >= 0.6 * len(have):
                want[combo] = hit / len(have)
    assert mined.keys() == want.keys() and all(abs(mined[k] - want[k]) < 1e-9 for k in want)
    verdicts = {r.page_id: r.verdict for r in url_filter.judge(pages, marks, min_support=0.05).collect()}
    assert verdicts == {i: "block" if any(set(c) <= tokens[i] for c in want) else "allow" for i in tokens}


def test_a_rule_does_not_vanish_as_the_tables_grow(spark):
    """Twenty-five unwanted pages of a host block it among 200 labelled pages and among 40,000."""
    for n in (200, 40_000):
        pages = spark.range(n).select(F.col("id").alias("page_id"), F.when(F.col("id") < 25, F.concat(F.lit("http://casino.net/win/"), "id"))
                                      .otherwise(F.concat(F.lit("http://news.org/en/"), "id")).alias("url"))
        marks = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 25, 0).otherwise(1).alias("quality"), F.lit(0).alias("toxic"))
        more = pages.unionByName(spark.createDataFrame([(-1, "http://casino.net/win/x")], "page_id long, url string"))
        assert {r.page_id for r in url_filter.judge(more, marks).where("verdict = 'block'").collect()} == {-1, *range(25)}
