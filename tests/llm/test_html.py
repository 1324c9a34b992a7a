from __future__ import annotations

import html
import random
import re

import pytest

from prepframe.llm import html_extract
from prepframe.llm.html_extract import SUPPORT, extract_main_text, host_of, main_text
from prepframe.llm.html_parse import parse
from prepframe.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string"


def text(page):
    return main_text(parse(page))


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><h1>A &amp; b</h1><p>One  two<br><p>three&nbsp;<i>f</i>our</article>out", "A & b\nOne two\nthree four"),
        ("<nav>n</nav><p>a < b &lt; 3<4</p><footer>f</footer>", "a < b < 3<4"),
        ("<article><header><h1>T</h1></header><p>x</p><footer>f</footer></article><header>h</header>", "T\nx"),
        ("<div class='side-bar sidebar'>s</div><div id=comments><p>c</p></div><main><p>m</p></main>", "m"),
        ("<script>var t='</p>'</script><style>p{}</style><!-- <p>c</p> --><p>x<form>q</form>", "x"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a\nb\nc\nd\ne"),
        ("<article><p title='a>b' class=\"x\">t<b>u</article><p>v", "tu"),
        ("<div role=main><p>m</p><div class=cookie-notice>k</div></div><p>z", "m"),
        ("<div class='content has-sidebar'><article><h1>T</h1><p>one two</p></article><div class=sidebar><p>s</p></div></div>", "T\none two"),
        ("<div id=page class='layout-sidebar-right'><p>one</p><p>two</p></div>", "one\ntwo"),
        ("<form><nav>n</nav><article><p>one two three</p></article><div class=ad-box>a</div></form>", "one two three"),
        ("<form><label>name</label><input></form>", ""),
        ("<div class=post-comments><p>a long comment that is most of the page</p></div><article><p>x</p></article>", "x"),
        ("<div class='related-posts'><article><p>teaser</p></article></div><p>x</p>", "x"),
        ("<div class=top-banner><article><p>short</p></article></div><div class=sidebar><p>as long as it can be</p></div>", "short"),
        ("<div class=with-nav><div class=cookie-bar><p>k</p></div><article><p>one</p><div class=share-links>s</div><p>two two two</p></article></div>", "one\ntwo two two"),
        ("plain text", "plain text"),
        ("<p>unclosed <", "unclosed <"),
        ("<!-- never closed <p>x</p>", ""),
        ("<div><div><p>", ""),
        (None, ""),
        ("", ""),
    ],
)
def test_main_text(page, want):
    assert text(page) == want


def test_long_pages_take_linear_time():
    assert len(text("<p>a <b>" * 20_000)) == 39_999
    assert text("<" * 50_000) and text('<a href="' * 5_000) is not None and text("&" * 50_000)


def test_host():
    assert host_of("https://A.example.org:80/x?y#z") == "a.example.org"
    assert host_of(None) == host_of("") == host_of("http://[bad") == host_of("no host") == ""


def expected(page):
    """The given pages' articles: blocks of paragraphs and headings."""
    own = page[page.index("<article>") + 9 : page.index("</article>")]
    parts = [" ".join(html.unescape(re.sub(r"</?(b|br)>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", own)]
    return "\n".join(x for x in parts if x)


def test_query(spark, sf_dir):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op5_html_extract"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == expected(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def host_pages(host, n, unlike=lambda i: ""):
    """Pages without speaking names: a line that all have, and an article in a container of its own."""
    return [
        (i, f"http://{host}/{i}", f"<body><div class=z1><a>Home {i}</a></div><div class=q7><p>Read our paper daily.</p><p>Story {i} {'word ' * (20 + i)}</p>{unlike(i)}</div></body>")
        for i in range(n)
    ]


@pytest.mark.parametrize("bound", [html_extract.BROADCAST_ROWS, 0])
def test_template_gives_the_container_and_constants(spark, monkeypatch, bound):
    monkeypatch.setattr(html_extract, "BROADCAST_ROWS", bound)
    rows = host_pages("a.example", SUPPORT + 4) + [(100 + i, u, h) for i, u, h in host_pages("b.example", SUPPORT - 1)]
    copies = [(200 + i, f"http://c.example/{i}", f"<body><div class=z1>{i}</div><div class=q7><p>{'same story ' * 9}</p></div></body>") for i in range(SUPPORT + 2)]
    found = {r["page_id"]: r["text"] for r in extract_main_text(spark.createDataFrame(rows + copies, SCHEMA)).collect()}
    assert found[3] == f"Story 3 {'word ' * 23}".strip()  # container found, constant left out
    assert found[103].startswith("Home 3\nRead our paper daily.\nStory 3")  # too few pages for a template
    assert found[205] == ("same story " * 9).strip()  # copies of one article are no constants


def test_marked_wrappers_on_a_host(spark):
    wrap = '<body><div class="content has-sidebar"><div class=sidebar><p>Menu of all</p></div><article><p>Story {0} {1}</p></article></div></body>'
    rows = [(i, f"http://a.example/{i}", wrap.format(i, "word " * (20 + i))) for i in range(SUPPORT + 4)]
    found = {r["page_id"]: r["text"] for r in extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {i: f"Story {i} {'word ' * (20 + i)}".strip() for i in range(SUPPORT + 4)}


def test_classes_by_brute_force(spark):
    """Constant texts are those whose occurrence vector equals that of an element further out, page by page."""
    draw = random.Random(4)
    pages = []
    for i in range(SUPPORT * 3):
        parts = [f"<p>Always here.</p>" * (1 + i % 3), "<p>Now and then.</p>" if i % 2 else "", f"<p>Only {i} {'w ' * draw.randrange(5, 40)}</p>"]
        rows = "<section><i>Row</i></section>" * (1 + i % 4)
        pages.append((i, "http://a.example/x", f"<body><div class=m>{''.join(parts)}{rows}</div></body>"))
    tokens = html_extract.template_tokens(spark.createDataFrame(pages, SCHEMA)).collect()
    vectors, depth, is_text = {}, {}, {}
    for i, url, page in pages:
        for token, (_, d, text_, _, times, _) in html_extract._tokens(url, page)[2].items():
            vectors.setdefault(token, {})[i] = times
            depth[token], is_text[token] = d, text_
    same = {}
    for t, v in vectors.items():
        same.setdefault(tuple(sorted(v.items())), set()).add(t)
    sums = {}
    for r in tokens:
        sums.setdefault((r["pages"], r["times"], r["sum_a"], r["sum_b"]), set()).add(r["token"])
    assert sorted(map(sorted, sums.values())) == sorted(map(sorted, same.values()))
    want = {t for v, own in same.items() if len(v) >= SUPPORT for t in own if is_text[t] and any(not is_text[o] and depth[o] < depth[t] for o in own)}
    df = html_extract.templates(html_extract.template_tokens(spark.createDataFrame(pages, SCHEMA)))
    assert {r["token"] for r in df.where("NOT main").collect()} == want and want


def test_cases(spark):
    rows = [(1, None, "<article><p>x</article>"), (2, "http://h/1", None), (3, "http://h/2", ""), (None, "http://h/3", "<p>y"), (1, None, "<article><p>x</article>")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", text int, host int")
    found = [(r["page_id"], r["text"], r["n_chars"]) for r in extract_main_text(df).collect()]
    assert sorted(found, key=str) == sorted([(1, "x", 1), (2, "", 0), (3, "", 0), (None, "y", 1), (1, "x", 1)], key=str)
    assert extract_main_text(df.limit(0)).count() == 0
