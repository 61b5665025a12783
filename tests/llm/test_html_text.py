from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from rowjudge.llm import html_text
from rowjudge.llm.html_text import BORDER, ExtractConfig, main_text, page_blocks, window_classes


def text_of(html: str) -> str:
    blocks = page_blocks(html)
    best = max((r for r, _ in blocks), default=0)
    return "\n".join(t for r, t in blocks if r == best)


@pytest.mark.parametrize("html, want", [
    ("", ""), ("no tags  at\tall", "no tags at all"), ("<p>a<p>b<br>c</P><P>d", "a\nb c\nd"),
    ("<article><h1>T &amp; U</h1><p><b>one<br><p>two</article><footer>f", "T & U\none\ntwo"),
    ("<nav><ul><li>x</ul></nav><main><p>m</p><aside>s</aside><form><p>f</form><p>n</main><p>out", "m\nn"),
    ("<script>if (a < b) x = '</p>'</script><style>p{}</style><p>t<!-- <p>no --> u</p><script>never closed <p>no", "t u"),
    ("<article><header><h1>Title</h1><p>by line</p></header><p>body</p><div class='share-buttons'>s</div><section id=comments><p>c</section></article>",
     "Title\nbody"),
    ("<header><h1>Site</h1></header><p>text", "text"), ("<div class='siteHeader'>x</div><div id='cookieNotice'>y</div><p>z", "z"),
    ("<div class=post-body><p>a</p><div class='ad'>b</div>c</div><div>d</div>", "a\nc"),
    ("<p title='a > b' data-x=\"<p>\">q</p><p don't>r</p>", "q\nr"), ("<p>a &lt;b&gt; &eacute;&#233;&#xe9; &unknown; & &amp</p>", "a <b> ééé &unknown; & &"),
    ("<p>5 < 6 and 7 > 2</p>", "5 < 6 and 7 > 2"), ("<p>cut <b", "cut"), ("<p>a&nbsp;&nbsp;b\x0b c</p>", "a b c"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a\nb\nc"),
    ("<p hidden>h</p><div style='display: none'>i</div><span aria-hidden=true>j</span><p>k", "k"),
    ("<p>in<span class=ad>AD <span>x</span></span>side</p>", "inside"), ("<p class=ad>one<p>two", "two"),
    ("<article class=comment><p>c</article><article><p>a</article>", "a"), ("<pre>a\n  b</pre>", "a b"),
    ("<textarea><p>t</textarea><noscript><p>n</noscript><select><option>o</select><button>b</button><p>p", "p"),
    ("</p></div>a</article>b", "a\nb"), ("<body class='no-sidebar ad'><p>x", "x"),
])
def test_blocks_of_a_page(html, want):
    assert text_of(html) == want


def covered_by_brute_force(streams: list[list[str]], run: int, pages: int) -> list[list[bool]]:
    seen = defaultdict(set)
    for p, s in enumerate(streams):
        for i in range(len(s) - run + 1):
            seen[tuple(s[i:i + run])].add(p)
    out = []
    for s in streams:
        over = [False] * len(s)
        for i in range(len(s) - run + 1):
            if len(seen[tuple(s[i:i + run])]) >= pages:
                over[i:i + run] = [True] * run
        out.append(over)
    return out


def test_window_classes_are_the_equal_windows():
    rnd = np.random.default_rng(3)
    for depth in (1, 2, 3, 5, 8):
        streams = [[f"w{x}" for x in rnd.integers(0, 3, n)] for n in (0, 40, 7, depth, 30)]
        order, page, hashed = window_classes(streams, depth)
        flat = [t for s in streams for t in s]
        windows = [tuple(flat[i:i + depth]) for i in order]
        assert windows == sorted(windows)
        assert len(set(zip(windows, hashed))) == len(set(windows)) == len(set(hashed))
        assert len(windows) == sum(max(0, len(s) - depth + 1) for s in streams)


def page(words: str, n: int, host: str = "h.example", extra: str = "") -> tuple:
    menu = "".join(f"<div>{w}</div>" for w in "Home News Sport Contact About Shop".split())
    return (n, f"http://{host}/{n}", f"<div>{menu}</div><div><p>{words}</p>{extra}<p>All rights reserved by the people who made this page today</p></div>", 1)


SCHEMA = "page_id long, url string, html string, text int"


@pytest.fixture(scope="module")
def site():
    rnd = np.random.default_rng(5)
    rows = [page(" ".join(f"word{x}" for x in rnd.integers(0, 500, 60)), n, extra="<p>Yes." if n % 2 else "") for n in range(40)]
    rows += [page("Only here: " + " ".join(f"lone{x}" for x in rnd.integers(0, 500, 30)), 100, "single.example")]
    rows += [rows[0], (200, rows[1][1], rows[1][2], 1), (300, None, "<p>no url</p>", 1), (301, "http://h.example/x", None, 1), (302, "", "", 1),
             (303, "http://h.example/y", "<article><p>Home</p></article>", 1), (None, "http://h.example/z", "<article>x " + "y " * 300_000 + "</article>", 1)]
    return rows


@pytest.mark.parametrize("cfg", [ExtractConfig(), ExtractConfig(shard_tokens=150), ExtractConfig(min_run=3, min_pages=2)])
def test_repeated_runs_go_however_hosts_are_dealt(spark, site, cfg):
    got = {}
    for r in main_text(spark.createDataFrame(site, SCHEMA), cfg).collect():
        assert r["n_chars"] == len(r["text"]) and got.setdefault((r["page_id"], r["url"]), r["text"]) == r["text"]
    by_host = defaultdict(dict)
    for _, url, html, _ in site:
        blocks = page_blocks(html or "")
        if max((r for r, _ in blocks), default=-1) == 0:
            by_host[(url or "").split("/")[2] if url else ""][tuple(t for _, t in blocks)] = None
    want = {}
    for host, pages in by_host.items():
        streams = [[w for b in blocks for w in (*b.split(), BORDER)] for blocks in pages]
        for blocks, over in zip(pages, covered_by_brute_force(streams, cfg.min_run, cfg.min_pages)):
            want[host, blocks] = html_text.unique_text(list(blocks), np.array(over), cfg)
    for page_id, url, html, _ in site:
        blocks = page_blocks(html or "")
        best = max((r for r, _ in blocks), default=-1)
        host = (url or "").split("/")[2] if url else ""
        assert got[page_id, url] == (want[host, tuple(t for _, t in blocks)] if best == 0 else "\n".join(t for r, t in blocks if r == best))
    if cfg.min_run == 8:
        assert got[3, "http://h.example/3"].startswith("word") and "Home" not in got[3, "http://h.example/3"] and "rights" not in got[3, "http://h.example/3"]
        assert "lone" in got[100, "http://single.example/100"] and "Home" in got[100, "http://single.example/100"]


def test_no_pages(spark, site):
    none = spark.createDataFrame(site[:1], SCHEMA).where("false")
    assert main_text(none).collect() == []


def test_extra_columns_stay_out(spark):
    df = spark.createDataFrame([(1, "u", "<p>a", "x", "y", 3)], "page_id long, url string, html string, open string, host string, n_chars int")
    assert [tuple(r) for r in main_text(df).collect()] == [(1, "u", "a", 1)]


def test_pages_that_mark_an_article_are_evidence_for_open_pages_of_their_host(spark):
    legal = "All rights reserved by the people who made this page today"
    rows = [(n, f"http://h.example/{n}", f"<article><p>story number {n}</article><div>{legal}</div>") for n in range(3)]
    rows += [(9, "http://h.example/9", f"<p>an open page<div>{legal}</div>"), (10, "http://other.example/", f"<p>an open page<div>{legal}</div>")]
    rows += [rows[0]] * 3
    for cfg in (ExtractConfig(), ExtractConfig(shard_tokens=10)):
        got = {(r["page_id"], r["text"]) for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), cfg).collect()}
        assert got == {(n, f"story number {n}") for n in range(3)} | {(9, "an open page"), (10, f"an open page\n{legal}")}
