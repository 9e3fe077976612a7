"""Extraction, URL templates and line dedup on small pages."""

import pytest

from roadlens.llm import lines, urls, wrappers

CHROME = (
    '<!DOCTYPE html><html><head><title>T &lt;x&gt;</title><style>p{}</style><script>var t="</p><article>";</script></head><body>'
    '<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li><li><a>B</a></li></ul></nav>'
)


def page(body, end="</body></html>"):
    return CHROME + body + "<footer>&copy; Site</footer>" + end


PAGES = [
    (1, "http://A.example.org/en/1?x", page("<article><h1>Ti&amp;tle</h1><p>One  <b>bold</b>\n text<br>more<p>Two</article>")),
    (2, "http://a.example.org/en/2", page('<div class="ad">Buy</div><article><h1>X</h1><p>Only &amp;amp; once</p></article>', "")),
    (3, "http://a.example.org/en/3/", page("<article><h1>Y</h1><p>a</p><p>b</p><aside>side</aside><p>c < d</p></article>")),
    (4, "http://a.example.org/en/4", page('<article><p>text</p><div id="comments"><p>me too</p></div></article>')),
    (5, None, None),
    (6, "no scheme", ""),
    (7, "http://b.example.net/x", "<body><div class='menu'><p>Menu</p></div><div><p>Long text of the page one</p><p>Same</p></div></body>"),
    (8, "http://b.example.net/y", "<body><div class='menu'><p>Menu</p></div><div><p>Other text of page two</p><p>Same</p></div></body>"),
    (9, "http://c.example.net/", "<article>" + "<p>long</p>" * 20_000 + "</article>"),
    (10, "http://d.example.net/", "<article><!-- <p>no</p> --><form><p>f</p></form><p>caf&eacute;&nbsp;&#233; &#x1F642;</p><script>x()"),
    (2, "http://a.example.org/en/2", page('<div class="ad">Buy</div><article><h1>X</h1><p>Only &amp;amp; once</p></article>', "")),
]
TEXTS = {
    1: "Ti&tle\nOne bold text more\nTwo", 2: "X\nOnly &amp; once", 3: "Y\na\nb\nc < d", 4: "text", 5: "", 6: "",
    7: "Long text of the page one\nSame", 8: "Other text of page two\nSame", 9: "\n".join(["long"] * 20_000), 10: "café é 🙂",
}
SCHEMA = "page_id long, url string, html string, host string, text string, lines string, shape string, verdict string"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "h", "t", "l", "s", "v") for p in PAGES], SCHEMA)


def test_extraction(pages):
    got = wrappers.extract(pages).collect()
    assert sorted(r.page_id for r in got) == sorted(p[0] for p in PAGES)
    for r in got:
        if r.page_id in (7, 8):
            assert TEXTS[r.page_id].split("\n")[0] in r.text and "Menu" not in r.text
        else:
            assert r.text == TEXTS[r.page_id], r.page_id
        assert r.n_chars == len(r.text)
    assert wrappers.extract(pages.limit(0)).count() == 0


def test_pages_without_article(spark):
    """Whole texts of div pages: blocks that one page alone has, and headings and sections beside the text."""
    single = {
        1: "<h2>Alone</h2>", 3: "<blockquote>Said once</blockquote>", 5: "<ul><li>one</li><li>two</li></ul>",
        7: "<table><tr><td>cell</td></tr></table>",
    }
    extra = {1: ["Alone"], 3: ["Said once"], 5: ["one", "two"], 7: ["cell"]}
    rows, want = [], {}
    for i in range(10):
        rows.append((i, f"http://div.org/{i}", (
            "<body><div class='menu'><p>Menu</p></div><div><p>Welcome to all</p></div>"
            f"<div class='page'><div class='top'><h1>Title {i}</h1></div><div class='body'><p>First of {i}</p>{single.get(i, '')}"
            f"<p>Last of {i}</p></div><div class='more'><p>Section of {i}</p></div></div></body>"
        )))
        want[i] = "\n".join([f"Title {i}", f"First of {i}", *extra.get(i, []), f"Last of {i}", f"Section of {i}"])
    got = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want


def test_classes_of_page_and_article_hide_nothing(spark):
    """Names on html, body and the article say what else is on the page; a comment stays a comment."""
    marks = ["no-sidebar post", "has-comments", "cookie-ok single", "nav-open", "with-banner"]
    rows = []
    for i, mark in enumerate(marks):
        for k in range(3):
            body = (
                f'<body class="{mark}"><nav>menu</nav><div class="content-with-banner"><article class="widget-post">'
                f"<h1>Title {k}</h1><p>Text {i} {k}</p></article></div>"
                f'<article class="comment"><p>reader {k}</p></article><div class="site-sidebar"><p>other</p></div></body>'
            )
            rows.append((10 * i + k, f"http://host{i}.example.org/p{k}", f'<html class="no-banner">{body}</html>'))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extract(df).collect()}
    assert got == {10 * i + k: f"Title {k}\nText {i} {k}" for i in range(len(marks)) for k in range(3)}


def test_wrapper_of_a_host(pages):
    found = wrappers.shapes(pages.select(urls.host_of(pages.url).alias("host"), "html"))
    expression = {r.host: r.expression for r in wrappers.infer(found).collect()}["a.example.org"]
    assert "(<p> # </p>)+" in expression and "(<article>" not in expression and ")?" in expression
    assert "(<li> text </li>)+" in expression


@pytest.mark.parametrize("spread", [1, 16])
def test_order_of_merging_keeps_the_text(pages, spread):
    found = wrappers.shapes(pages.select(urls.host_of(pages.url).alias("host"), "html"))
    flags = wrappers.marked(found, wrappers.infer(found, spread)).collect()
    assert all(any(r.main) for r in flags if r.host == "a.example.org")


def by_rules(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for rule, verdict in urls.RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and len(rule) > len(best[0] if best else ""):
            best = (rule, verdict)
    return host, path, best


URLS = [
    "http://www.example.com/en/1", "https://Example.COM/en/", "http://example.com/en", "http://x.www.example.com/en/a?b",
    "ftp://y.net/es/1#f", "http://y.net/fr/2", "http://y.net/de/3", "http://com/", "http://telecom/", "http://acom/x", "://z.net/es/",
    "http://host?q=/x://y", "http://host#f", "no", "", None, "http://", "http://a.net/es/../x", "HTTP://É.com/é", "a://b://c.net/es/",
]


def test_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, path string")).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, best = by_rules(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best[0] if best else None)
        assert r.verdict == best[1] if best else r.verdict in ("allow", "block")
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_templates_and_purity(spark):
    """Numbers become wildcards, alike branches merge, and unlabelled urls follow what is around them."""
    rows = [(f"http://h.net/{a}/{i}", None) for a in ("aa", "bb") for i in range(200)]
    rows += [(f"http://h.net/es/{i}.html", None) for i in range(200)] + [("http://h.net/rare/1/2/3/4/5/6/7/8/9/10", None)]
    rows += [(f"http://bad.net/es/{i}", None) for i in range(100)] + [(f"http://bad.net/zz/{i}", None) for i in range(10)]
    got = urls.judge(spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string"))
    found = {r.template: r for r in got.filter("host = 'h.net'").collect()}
    assert {"/{aa|bb}/*", "/es/*.html"} <= set(found)
    assert all(t in ("/{aa|bb}/*", "/es/*.html") or t.startswith("/*/") for t in found)
    assert found["/{aa|bb}/*"].verdict == "allow" and found["/es/*.html"].verdict == "block"
    assert {r.verdict for r in got.filter("host = 'bad.net' and path like '/zz/%'").collect()} == {"block"}


def test_rare_sections_of_a_rule(spark):
    """Sections too small for a constant do not take clean ones with them, on large hosts or small."""
    names = ["es", "fr", *(f"l{k}" for k in range(28))]
    made = [f"http://big.net/{a}/{i}" for a in names for i in range(20)]
    made += [f"http://small.net/{a}/{i}" for a, n in (("es", 3), ("fr", 2), ("de", 2), ("en", 30)) for i in range(n)]
    got = urls.judge(spark.createDataFrame(list(enumerate(made)), "page_id long, url string")).collect()
    assert len(got) == len(made)
    for r in got:
        assert r.verdict == ("block" if r.path.startswith(("/es/", "/fr/")) else "allow"), (r.host, r.path, r.purity)
    rules = (("net/a/fo", "block"),)
    made = [f"http://h.net/a/{s}{i}/x" for s in ("fo", "no") for i in range(40)] + [f"http://h.net/b/{i}" for i in range(60)]
    got = urls.judge(spark.createDataFrame(list(enumerate(made)), "page_id long, url string"), rules=rules).collect()
    assert {r.template for r in got if r.path.startswith("/a/fo")} == {"/a/fo*/x"}
    assert all(r.verdict == ("block" if r.path.startswith("/a/fo") else "allow") for r in got)


def test_line_dedup(spark):
    rows = [(i, "http://h.org/", f"<p>same</p><p>line {i}</p><p>same</p>") for i in range(10)]
    rows += [(100 + i, "http://small.org/", "<p>twice</p>") for i in range(2)] + [(200, None, None), (201, "x", "")]
    got = {r.page_id: r for r in lines.dedup(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(10):
        assert (got[i].text, got[i].n_lines, got[i].n_dropped) == (f"line {i}", 3, 2)
    assert got[100].text == "twice" and got[200].text == "" and got[201].n_lines == 0
    assert lines.dedup(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
