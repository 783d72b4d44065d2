"""URL filters and HTML extraction against plain Python."""

import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import html_extract, url_filters

PAGES = [
    (1, "https://Www.A.org/x?y", '<a href="http://b.net/1">b</a>'),
    (2, "http://b.net/1", "<a href='//c.net/q'>c</a><a href=http://b.net/self>s</a>"),
    (3, "https://bad.com/de/1", "<a href='https://b.net/'>"),
    (4, "https://feeder.net/", "<a HREF = 'HTTP://BAD.com/de/2'><a href='http://bad.com/x'>"),
    (5, "https://example.org/es/x", None),
    (6, "https://sub.example.org/en/12", ""),
    (7, "https://example.org/en/2", None),
    (8, None, None),
    (9, "no scheme/at all", "x"),
    (9, "no scheme/at all", "x"),
    (10, "x://", "x"),
    (11, "https://notexample.org#frag/de/", "x"),
    (12, "https://shop.com/fr/1", "x"),
    (13, "https://shop.com/xx/1", "x"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*p, "h", "r") for p in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule string")


def judged(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if m is None:
        return "", "", None
    own, path = m.group(1).lower(), m.group(2)
    fits = [
        r.pattern for r in url_filters.RULES
        if (own == r.host or own.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return own, path, max(fits, key=len, default=None)


def test_rules(pages):
    for r in url_filters.judge(pages).select("page.*", "*").collect():
        assert (r[-4], r[-3], r[-2]) == judged(r["url"])
        rule = {x.pattern: x for x in url_filters.RULES}.get(r[-2])
        if rule:
            assert r[-1] == ("allow" if rule.allow else "block")


def power(edges, seeds, steps, damping):
    out = {}
    for a, _ in edges:
        out[a] = out.get(a, 0) + 1
    total = sum(seeds.values())
    base = {h: (1 - damping) * n / total for h, n in seeds.items() if n}
    ranks = dict(base)
    for _ in range(steps):
        new = dict(base)
        for a, b in edges:
            if a in ranks:
                new[b] = new.get(b, 0) + damping * ranks[a] / out[a]
        ranks = new
    return ranks


def test_propagation_is_the_power_iteration(spark, pages):
    rows = [judged(u) for _, u, _ in PAGES]
    allows = {r.pattern: r.allow for r in url_filters.RULES}
    trusted, blocked = {}, {}
    for own, _, rule in rows:
        if rule:
            side = trusted if allows[rule] else blocked
            side[own] = side.get(own, 0) + 1
    edges = [("www.a.org", "b.net"), ("b.net", "c.net"), ("bad.com", "b.net"), ("feeder.net", "bad.com")]
    found = url_filters.host_edges(pages)
    assert sorted(tuple(r) for r in found.collect()) == sorted(edges)
    hosts = sorted({*trusted, *blocked})
    seeds = spark.createDataFrame(
        [(h, trusted.get(h, 0), blocked.get(h, 0)) for h in hosts], "host string, allowed long, blocked long"
    )
    trust = power(edges, trusted, url_filters.STEPS, url_filters.DAMPING)
    distrust = power([(b, a) for a, b in edges], blocked, url_filters.STEPS, url_filters.DAMPING)
    for r in url_filters.propagate(found, seeds).collect():
        assert r["trust"] == pytest.approx(trust.get(r["host"], 0))
        assert r["distrust"] == pytest.approx(distrust.get(r["host"], 0))


def test_verdicts_follow_the_graph(pages):
    verdicts = {r["page_id"]: r["verdict"] for r in url_filters.judge(pages).select("page.page_id", "verdict").collect()}
    assert verdicts[4] == "block"  # links to a blocked host only
    assert verdicts[2] == "allow" and verdicts[8] == "allow" and verdicts[9] == "allow"
    assert url_filters.judge(pages.limit(0)).count() == 0


def page(article, n=0):
    return (
        f'<!DOCTYPE html><html><head><title>t {n}</title><script>var a="</p>";</script></head><body>'
        f'<nav><ul><li><a href="/a">menu {n % 2}</a></li></ul></nav><!-- x {n} --><div class="ad">buy {n}</div>'
        f"<article>{article}</article><footer>&copy; site &middot; foot</footer></body></html>"
    )


def extracted(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, page string, text string")
    return {r["page_id"]: r["t"] for r in html_extract.extract(frame).select("page.page_id", F.col("text").alias("t")).collect()}


def test_articles(spark):
    pages = [
        (i, f"https://h{i % 2}.net/{i}", page(f"<h1>Head {i}</h1><p><b>Bold {i}.<br><p>A &amp; B\n  {i}</p><p>same words</p>", i), "p", "t")
        for i in range(30)
    ]
    pages += [
        (100, None, None, "p", "t"), (101, "", "", "p", "t"), (102, "https://other.net/x", "no markup &lt;here&gt;", "p", "t"),
        (103, "https://one.net/", page("<p>cut off &amp; <i>in</i>line <p>two"), "p", "t"),
        (104, "https://one.net/", page("<p>x</p>")[:-30], "p", "t"), (104, "https://one.net/", page("<p>x</p>")[:-30], "p", "t"),
        (105, "https://c.net/1", page("<p>text</p><div id='comments'><p>me too</p></div><form>f</form><p>end</p>"), "p", "t"),
        (106, "https://long.net/1", page("<p>" + "word " * 50_000 + "</p>"), "p", "t"),
    ]
    found = extracted(spark, pages)
    for i in range(30):
        # A paragraph that stands on every page of a host belongs to the article it stands in.
        assert found[i] == f"Head {i} Bold {i}. A & B {i} same words"
    assert found[100] == found[101] == "" and found[102] == "no markup <here>"
    assert found[103] == "cut off & inline two" and found[104] == "x"
    assert found[105] == "text end" and found[106] == ("word " * 50_000).strip()
    assert extracted(spark, []) == {}


def test_template_without_an_article(spark):
    pages = [
        (i, f"https://h.net/{i}", f"<body><div class='top'>site name</div><div class='main-box'><h2>T{i}</h2>"
         f"<p>{'words of this page ' * 9}{i}</p></div><div class='sidebar'>more</div>all rights</body>", "p", "t")
        for i in range(12)
    ]
    for i, text in extracted(spark, pages).items():
        assert text == f"T{i} " + "words of this page " * 9 + f"{i}"


def test_occurrence_vectors_meet(spark):
    rows = [(f"https://h.net/{i}", page(f"<p>{i}</p>" + ("<p>now and then</p>" if i % 3 else ""), i)) for i in range(12)]
    found = html_extract.occurrences(spark.createDataFrame(rows, "url string, html string")).collect()
    root = next(r for r in found if r["kind"] == "page")
    classes = {r["token"]: (r["pages"], r["vector"]) for r in found}
    assert classes["article"] == (12, root["vector"]) == classes["body"]
    assert [r["pages"] for r in found if r["kind"] == "text" and r["pages"] > 1] == [8]


def test_shared_text_inside_the_slot_is_kept(spark):
    rows = [(i, f"https://copies.net/{i}", page("<h1>One</h1><p>text of all copies</p>"), "p", "t") for i in range(12)]
    rows += [(100 + i, f"https://bare.net/{i}", "<body><p>no slot</p><p>at all</p></body>", "p", "t") for i in range(12)]
    rows += [(200 + i, f"https://h.net/{i}", page(f"<p>own {i}</p><h2>Sources</h2><p>number {i}</p><p>same words</p>"), "p", "t")
             for i in range(12)]
    rows += [(300 + i, f"https://edge.net/{i}", f"<body><b>site</b><p>own words {i}</p><h2>More</h2><p>words {i}</p><i>foot</i></body>", "p", "t")
             for i in range(12)]
    found = extracted(spark, rows)
    for i in range(12):
        assert found[i] == "One text of all copies" and found[100 + i] == "no slot at all"
        assert found[200 + i] == f"own {i} Sources number {i} same words"
        assert found[300 + i] == f"own words {i} More words {i}"


def test_unwanted_elements_end_as_in_html():
    text = "the long text of this page " * 9 + "ends"
    pages = [
        f"<body><p class='notice'>no<p>{text}</p>", f"<body><ul><li class='share'>no<li>{text}</ul>",
        f"<html><head><title>t</title><p>{text}</html>", f"<html><head><title>t</title>{text}</html>",
        f"<body><div><p class='ad'>no</div>{text}", f"<body><nav><ul><li>no</nav>{text}",
        f"<body><table><tr><td class='ad'>no<td>{text}<tr class='promo'><td>no</table>",
        f"<body><form><select><option>no<option>no</select>no</form>{text}", f"<body><a class='share'>no<p>no</a>{text}",
        f"<body><ul class='menu'><li>no<ul><li>no</ul><li>no</ul>{text}", f"<body><div><div class='ad'>no<svg/></div>{text}</div>",
        f"<body><main class='sidebar has-sidebar'>{text}</main>", f"<body><article class='post no-comments'>{text}</article>",
        f"<body><div id='page' class='header-fixed'>{text}</div>", f"<body><div class='header'>{text}</div><div class='ad'>no</div>",
        f"<body>{text}<div class='cookie-banner'>no</div>",
    ]
    for made in pages:
        assert html_extract.main_text(made, [], frozenset()) == text, made


NOT_ARTICLE = (
    "comment-list post-comments user-comments reader-comments cookie-bar ad-slot site-header page-footer main-nav"
    " related-posts newsletter-signup share-buttons notice-box"
).split()


@pytest.mark.parametrize("name", NOT_ARTICLE)
def test_parts_named_by_compounds_are_left_out(name):
    text = "words of the article " * 9
    made = f"<body><main class='has-sidebar'><article><div class='entry-header'><h1>Head</h1></div><p>{text}</p>" + (
        f"<div class='{name}'><p>left out</p></div><p>end</p></article></main></body>"
    )
    for slots in ([], ["article"], ["main has-sidebar"]):
        assert html_extract.main_text(made, slots, frozenset()) == f"Head {text}end"


def test_hosts_of_any_size_agree(spark):
    rows = [
        (100 * n + i, f"https://h{n}.net/{i}", f"<body><b>site</b><p>own words {i}</p><p>more words {i}</p><i>foot</i></body>", "p", "t")
        for n in (2, 9, 10) for i in range(n)
    ]
    for page_id, text in extracted(spark, rows).items():
        assert text == f"own words {page_id % 100} more words {page_id % 100}"


def test_hosts_meet_beyond_ascii(spark):
    rows = [
        (i, f"https://{h}.net/{i}", f"<body><b>site</b><p>own words {i}</p><p>more words {i}</p></body>", "p", "t")
        for i, h in enumerate(["\u0130A", "\u0130a", "\u0130A"])
    ]
    assert html_extract.host("https://\u0130A.net/x") == "\u0130a.net"
    for i, text in extracted(spark, rows).items():
        assert text == f"own words {i} more words {i}"


def test_a_teaser_article_is_not_the_main_slot(spark):
    rows = [
        (i, f"https://h.net/{i}", f"<body><article class='featured'>teaser {i}</article><div class='story'><h1>T{i}</h1>"
         f"<p>{'words of this page ' * 19}{i}</p></div></body>", "p", "t")
        for i in range(6)
    ]
    rows += [(10 + i, f"https://m.net/{i}", page(f"<p>words {i}</p>", i).replace("<article>", "<p>a</p><article>"), "p", "t") for i in range(6)]
    found = extracted(spark, rows)
    for i in range(6):
        assert found[i] == f"T{i} " + "words of this page " * 19 + f"{i}"
        assert found[10 + i] == f"words {i}"


def test_templates_of_parts_of_a_host(spark):
    """Two templates on a host, neither on half of the pages: each is a class of its own."""
    words = "words of this page " * 9
    rows = [
        (i, "https://h.net/%d" % i, f"<body><b>plain site</b><i>since long</i><p>{words}{i}</p><u>call us</u></body>" if i % 3 else
         f"<body><div class='shop'><b>our shop</b></div><div class='goods'><p>{words}{i}</p></div><i>prices</i></body>", "p", "t")
        for i in range(12)
    ]
    for i, text in extracted(spark, rows).items():
        assert text == f"{words}{i}"


def test_classes_out_of_order_or_crossed_are_no_template(spark):
    texts = {
        "h": lambda i: ["a one", "a two", "a three", f"own {i}"][:: 1 if i % 2 else -1],
        "x": lambda i: ["r one", "s one", "r two", "s two", "r three", "s three", f"own {i}"] if i % 2 else ["r one", "r two", "r three", f"own {i}"],
        "n": lambda i: ["r one", "s one", "s two", "s three", "r two", "r three", f"own {i}"] if i % 2 else ["r one", "r two", "r three", f"own {i}"],
    }
    rows = [(f"https://{h}.net/{i}", "".join(f"<p>{t}</p>" for t in of(i)), h + ".net") for h, of in texts.items() for i in range(8)]
    frame = spark.createDataFrame(rows, "url string, html string, host string")
    made = html_extract.classes(html_extract.occurrences(frame))
    assert sorted((r["host"], r["pages"]) for r in made.collect()) == [("h.net", 8), ("n.net", 4), ("n.net", 8), ("x.net", 4), ("x.net", 8)]
    valid = html_extract.valid_classes(frame, made).collect()
    assert sorted((r["host"], r["pages"]) for r in valid) == [("n.net", 4), ("n.net", 8), ("x.net", 8)]
