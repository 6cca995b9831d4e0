"""The style tree against brute force, what it changes, and pages that are long or broken."""

import collections
import html
import math
import re
import time

import pytest

from tallybridge.llm import html_text, registry

KIND = "page_id long, url string, html string"


def story(i: int, n: int = 12) -> str:
    return " ".join(f"w{i}x{k}" for k in range(n)) + "."


def site(i: int, host: str = "a.example") -> tuple:
    """Boilerplate that no tag and no class declares: only its repetition tells."""
    page = f"<div class=x1><p>All rights and wrongs of this site</p><p>Read it on paper too</p></div><div class=x2><p>{story(i)}</p><p>{story(i + 1000)}</p></div><div class=x3><p>Printed in the old town</p></div>"
    return i, f"https://{host}/p/{i}", f"<html><body>{page}</body></html>"


def test_the_tree_removes_what_repeats_and_nothing_else(spark):
    df = spark.createDataFrame([site(i) for i in range(40)] + [site(9000, "lone.example")], KIND)
    got = {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}
    plain = {r["page_id"]: r["text"] for r in html_text.extract(df, tree=False).collect()}
    for i in range(40):
        assert got[i] == f"{story(i)}\n{story(i + 1000)}"
        assert plain[i] == f"All rights and wrongs of this site\nRead it on paper too\n{got[i]}\nPrinted in the old town"
    assert got[9000] == plain[9000]  # one page is no evidence


def test_evidence_grows_with_the_pages(spark):
    """No least number of pages: what m pages say weighs (m - 1) / m."""
    removed = []
    for n in (2, 5, 8, 15, 40):
        df = spark.createDataFrame([site(i) for i in range(n)], KIND)
        removed.append("rights" not in html_text.extract(df).where("page_id = 0").first()["text"])
    assert removed == sorted(removed) and not removed[0] and removed[-1]


def hinted_site(i: int) -> tuple:
    """Inside the article a branch that a word only hints at and that repeats, one that only hints, and text that only repeats."""
    page = f"<article><p>{story(i)}</p><div class=widget-z9><p>Join our circle of readers</p></div><div class=promo-story-x><p>{story(i + 5000)}</p></div><p>As we always say</p></article>"
    return i, f"https://h.example/{i}", f"<html><body>{page}</body></html>"


def test_inside_an_article_a_branch_goes_for_two_weak_signs_together(spark):
    df = spark.createDataFrame([hinted_site(i) for i in range(30)], KIND)
    for r in html_text.extract(df).collect():
        i = r["page_id"]
        assert r["text"] == f"{story(i)}\n{story(i + 5000)}\nAs we always say"
    assert all("circle" in r["text"] for r in html_text.extract(df, tree=False).collect())


def _generated_page(rng, host: int, i: int) -> tuple[str, list[str], list[str]]:
    """A page with what a reader wants, and boilerplate in the article: declared, hinted at, or only repeated beside it."""
    good = [story(1000 * host + 10 * i + k, rng.randint(5, 20)) for k in range(3)]
    bad = [f"Site {host} asks you to join its list", f"Host {host} shows you more of this", f"What readers of {host} said {i}"]
    parts = [f"<p>{g}</p>" for g in good]
    parts.insert(rng.randint(0, 3), f'<div class="{rng.choice(["newsletter-z", "promo-k2", "subscribe-now-x"])}"><p>{bad[0]}</p></div>')
    parts.append(f'<div class="{rng.choice(["commentlist", "comment-body", "comments"])}"><p>{bad[2]}</p></div>')
    return f"<html><body><div class=q{host}><p>{bad[1]}</p></div><main class=c>{''.join(parts)}</main></body></html>" if host % 2 else f"<html><body><article>{''.join(parts)}</article><div class=q>{bad[1]}</div></body></html>", good, bad


def test_precision_and_recall_on_sites_it_has_not_seen(spark):
    import random

    rng = random.Random(12)
    pages = [(host * 100 + i, f"https://h{host}.example/{i}", *_generated_page(rng, host, i)) for host in range(6) for i in range(25)]
    df = spark.createDataFrame([p[:3] for p in pages], KIND)
    rates = {}
    for tree in (True, False):
        got = {r["page_id"]: set(r["text"].split("\n")) for r in html_text.extract(df, tree=tree).collect()}
        kept = sum(len(got[p[0]]) for p in pages)
        right = sum(len(got[p[0]] & set(p[3])) for p in pages)
        rates[tree] = right / kept, right / sum(len(p[3]) for p in pages)
    assert rates[True][1] == rates[False][1] == 1.0  # nothing a reader wants is lost
    assert rates[True][0] > 0.95 > rates[False][0]


def brute_importance(pages: list[html_text.Page]) -> dict[int, float]:
    """The definition, by recursion over one host."""
    parent, m, styles, texts = {html_text._ROOT: 0}, collections.Counter(), collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for p in pages:
        parent |= {n: up for n, (up, _) in p.nodes.items()}
        m.update({html_text._ROOT, *p.nodes})
        for n, style in p.styles:
            styles[n][style] += 1
        for n, text in {(n, text) for n, text, *_ in p.blocks}:
            texts[n][text] += 1
    children = collections.defaultdict(list)
    for n, up in parent.items():
        children[up].append(n)
    weigh = lambda x, n: 1 - (1 - x) * (m[n] - 1) / m[n]
    composite, most = {}, {}

    def visit(n):
        for c in children[n]:
            visit(c)
        total = sum(styles[n].values())
        own = -sum(k / total * math.log(k / total) for k in styles[n].values()) / math.log(total) if total > 1 else 0.0
        content = sum(1 - k / m[n] for k in texts[n].values()) / len(texts[n]) if texts[n] else None
        below = [(composite[c], m[c]) for c in children[n]] + ([(content, m[n])] if content is not None else [])
        keep = html_text.DAMPING ** max(1, len(styles[n]))
        composite[n] = (1 - keep) * own + keep * sum(v * k for v, k in below) / sum(k for _, k in below) if below else own
        most[n] = max([weigh(composite[n], n), weigh(content or 0.0, n), *(most[c] for c in children[n])])

    visit(html_text._ROOT)
    return most


def test_importance_is_as_defined(spark):
    sources = []
    for i in range(17):
        deep = "<div>" * (i % 5) + f"<p>same</p><p>{i % 3}</p>" + "</div>" * (i % 5)
        sources.append(f"<body><div class=a><ul><li>one</li>{'<li>two</li>' * (i % 2)}</ul></div><section>{deep}<h2>{story(i)}</h2></section>{'<span>x</span><div><i>y</i></div>' * (i % 3)}</body>")
    df = spark.createDataFrame([(1, f"https://b.example/{i}", s) for i, s in enumerate(sources)], KIND)
    known = df.selectExpr("'b.example' AS host", "html")
    once = known.mapInArrow(html_text._observe, "host string, digest binary, parts binary")
    seen = once.select("host", "parts").mapInArrow(html_text._count, html_text._SEEN).groupBy("host", "node", "kind", "value", "depth").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n")
    got = {r["node"]: r["importance"] for r in html_text.importance(seen).collect()}
    want = brute_importance([html_text.Page(s) for s in sources])
    assert got.keys() == want.keys() and all(math.isclose(got[n], want[n], abs_tol=1e-9) for n in want)


@pytest.mark.parametrize("source, text", [
    ('<body class="has-sidebar"><article>told</article></body>', "told"),
    ('<body><div class="no-sidebar"><p>told</p></div></body>', "told"),
    ('<div class="post-with-ads"><p>told</p></div>', "told"),
    ('<article class="long-form">told</article>', "told"),
    ('<div class="related-work"><p>told</p></div>', "told"),
    ('<div id="share-price-report"><p>told</p></div>', "told"),
    ('<form id="all"><div><p>told in full</p></div></form><div class="site-footer">(c)</div>', "told in full"),
    ('<div class="widget"><article>told</article></div><div>other and longer text</div>', "told"),
    ('<div class="comments-section">they said</div><p>told in full here</p>', "told in full here"),
    ("<p>a <span hidden>no</span> b</p>", "a b"),
    ("x < y &amp;&lt; <b>z</b>&nbsp;<!-- c --> é&#233;&eacute;", "x < y &< z ééé"),
    ('<article><p>first</p><article class="comment"><p>reader says</p></article></article>', "first"),
    ('<article><p>t</p><ol class="commentlist"><li>c</li></ol></article>', "t"),
    ('<article><p>t</p><div class="comment-body">c</div></article>', "t"),
    ('<article><p>t</p><div id="disqus_thread">c</div></article>', "t"),
    ('<article><p>t</p><div class="ad-slot">c</div></article>', "t"),
    ('<article><p>t</p><ins class="adsbygoogle">c</ins></article>', "t"),
    ('<article><p>t</p><div class="share-buttons">c</div></article>', "t"),
    ('<article><p>t</p><div class="related-posts">c</div></article>', "t"),
    ('<header>site</header><article><header><h1>Headline</h1></header><p>t</p></article>', "Headline\nt"),
    ('<main><article><article>a</article><article>b</article></article></main>', "a\nb"),
    ('<article class="comment">told</article>', "told"),
    ("", ""), ("<", "<"), ("<p", "<p"), ("</", "</"), ("<p>a<p>b</div>c", "a\nb\nc"), ("<!-- never closed", ""), ("<script>x", ""),
])
def test_priors_and_markup(source, text):
    assert html_text.Page(source).main_text() == text


@pytest.mark.parametrize("source", ["<div>" + "</x>" * 150_000, "<div>" * 150_000 + "t", "<a " * 200_000, '<a x="' * 150_000, "<a x='>" * 100_001, "<div class=ad>" * 60_000 + "t", "<p><b>" * 80_000, "<i>" * 150_000 + "</i>" * 150_000, "<!--" * 200_000, "<li>x" * 100_000, "<" * 800_000])
def test_a_page_costs_its_length(source):
    began = time.process_time()
    html_text.Page(source).main_text()
    assert time.process_time() - began < 6


def test_the_given_pages_by_a_plain_pattern(spark, sf):
    """The given pages have one article each: its blocks, by a pattern of the markup alone."""
    got = {r["page_id"]: r for r in registry.op1_html_text(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        inner = re.search(r"<article[^>]*>(.*?)(?:</article>|<footer|\Z)", r["html"] or "", re.S | re.I)
        if inner is None:
            continue
        body = re.sub(r"<!--.*?-->|<(script|style|aside|form|nav|footer|header)\b.*?</\1\s*>|<div class=\"[^\"]*\">.*?</div>", "\n", inner[1], flags=re.S | re.I)
        body = re.sub(r"</?(?:b|i|em|a|span|strong|code)\b[^>]*>", "", re.sub(r"<br\s*/?>", " ", re.sub(r"\s+", " ", body), flags=re.I), flags=re.I)
        want = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]+>|\n", body)]
        assert got[r["page_id"]]["text"].split("\n") == [x for x in want if x], r["page_id"]
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])
