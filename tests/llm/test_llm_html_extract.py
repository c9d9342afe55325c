import html as H
import re

import pytest

from ledgerlens.llm import html_extract as X

SHELL = (
    "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{a}</style><script>var x = '<p>no</p>';</script></head>"
    "<body class='has-sidebar page-12'>BODY</body></html>"
)
LONG = "This is a sentence of the article that runs on for a while, as prose does."


def page(body):
    return SHELL.replace("BODY", body)


# (markup, expected text) of single pages without a consensus
ONE = {
    "article": ("<nav><ul><li><a href=/a>A</a></ul></nav><article><h1>Title</h1><p>" + LONG + "</article><footer>f</footer>",
                f"Title\n\n{LONG}"),
    "unclosed": (f"<article><p><b>Bold.<br><p>{LONG}<p>{LONG}", f"Bold.\n\n{LONG}\n\n{LONG}"),
    "entities": ("<article><p>a &lt;b&gt; &amp;amp; &copy &#8364;&nbsp;&nbsp; x &am; &#x41;</p></article>", "a <b> &amp; © € x &am; A"),
    "white space": ("<article><p> a\n\tb  <i>c</i>d<br>e </p></article>", "a b cd e"),
    "comments": (f"<main><div class=post><h1>H</h1><p>{LONG}</p></div><section id=comments><article class=comment><p>"
                 + LONG * 5 + "</p></article></section></main>", f"H\n\n{LONG}"),
    "notices": (f"<div id='cookie-consent'><p>{LONG * 3}</p></div><div class=entry-content><div class='AdSlot ad-1'>Buy</div><p>{LONG}"
                "</p><form><p>Name<input></form><aside>see</aside></div>", LONG),
    "no names": (f"<div class=a1><a href=x>{LONG}</a><a href=y>{LONG}</a></div><div class=b7><p>{LONG}</p><p>{LONG}</p></div>",
                 f"{LONG}\n\n{LONG}"),
    "sections": (f"<div id=x><section><p>{LONG * 4}</p></section><section><p>{LONG}</p></section></div>", f"{LONG * 4}\n\n{LONG}"),
    "header in article": (f"<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>{LONG}</p></article>",
                          f"Title\n\n{LONG}"),
    "raw text": (f"<article><p>{LONG}</p><script>if (a < b) '</p>'</script><!-- <p>no</p> --><style>x</style></article>", LONG),
    "attributes": (f"<article><p title='a > b' class=lead data-class='ad'>{LONG}</p><p class='ad'>Buy<p>{LONG}</article>",
                   f"{LONG}\n\n{LONG}"),
    "list and table": (f"<article><p>{LONG}</p><ul><li>one<li>two</ul><table><tr><td>a</td><td>b</td></tr></table></article>",
                       f"{LONG}\n\none\n\ntwo\n\na\n\nb"),
    "only a menu": ("<nav><a href=/>Home</a></nav><footer>x</footer>", ""),
    "less than": ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    "a form around all": (f"<form id=f><nav>n</nav><main><h1>H</h1><p>{LONG}</p></main></form>", f"H\n\n{LONG}"),
    "a name around all": (f"<div class='page sidebar-right'><article><p>{LONG}</p></article><footer>f</footer></div>", LONG),
    "names in a line": (f"<article><p>{LONG} <span class='hljs-comment'>kept</span> <span class=ad>Buy</span><em class=notice>!</em></p>"
                        "</article>", f"{LONG} kept !"),
    "main menu": (f"<div class='main-menu'><p>{LONG * 3}</p></div><DIV CLASS=\"Main\"><P>{LONG}</P></DIV><div id=disqus_thread><p>"
                  f"{LONG * 4}</p></div>", LONG),
    "sidebar inside": (f"<main><div class=sidebar><p>{LONG * 2}</p></div><div class=story><h1>H</h1><p>{LONG}</p><blockquote>{LONG}"
                       f"</blockquote><section class=related><h2>More</h2><a href=x>{LONG}</a></section></div></main>",
                       f"H\n\n{LONG}\n\n{LONG}"),
    "cut page": (f"<article><h1>H</h1><p>{LONG}</p><p>cut he", f"H\n\n{LONG}\n\ncut he"),
    "open nav": (f"<nav><a href=x>x</a><article><p>{LONG}</p></article>", LONG),
}


@pytest.mark.parametrize("name", ONE)
def test_main_text(name):
    body, want = ONE[name]
    assert X.main_text(page(body)) == want


@pytest.mark.parametrize("html", ["", " ", "<", "</", "<a", "<!--", "<div class=\"x", "<p>a", "</div></div>", "<script>", "&#0;&#xD800;",
                                  "<div>" * 3000 + "x", "<a href='" * 500])
def test_broken_markup_is_no_error(html):
    assert isinstance(X.main_text(html, ["body>article"]), str)
    X.vote(html)


def test_generalised_paths():
    body = f"<div class='wrap w12'><div class='post-77 Post'><article id=a9><p>{LONG}</p></article></div></div>"
    assert X.vote(page(body))[0] == "body>div.w.wrap>div.post>article.a"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, host string, paths int")


def result(df):
    return sorted(((r.page_id, r.url, r.text, r.n_chars) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit", [1 << 24, -1])
def test_consensus_overrules_a_single_page(spark, monkeypatch, limit):
    """A guest text beside the article is taken along only where the host has
    no consensus."""
    monkeypatch.setattr(X, "BROADCAST_BYTES", limit)
    normal = page(f"<div class=c1><p>{LONG * 3}</p></div><div class=c2><a href=x>l</a></div>")
    odd = page(f"<div class=c1><p>{LONG * 3}</p></div><div class=d2><p>{LONG * 2}</p></div>")
    other = page(f"<article><p>{LONG}</p></article>")
    rows = [(k, f"http://h.org/{k}", normal) for k in range(9)] + [(20, "http://H.org/odd", odd), (21, "no host", odd)]
    rows += [(22, "http://h.org/other", other), (20, "http://H.org/odd", odd)]
    got = {(i, u): t for i, u, t, _ in result(X.extract(frame(spark, rows)))}
    assert got[20, "http://H.org/odd"] == LONG * 3
    assert got[21, "no host"] == f"{LONG * 3}\n\n{LONG * 2}"
    assert got[22, "http://h.org/other"] == LONG
    assert len(result(X.extract(frame(spark, rows)))) == len(rows)


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "http://a.org/", ""), (2, "http://a.org/", page("<article><p>é 日本 \U0001f642</p></article>")),
            (3, "x", "plain text\nonly"), (4, "http://b.org", page(f"<article>{'<p>' + LONG}</article>" * 3000))]
    want = [(1, None, "", 0), (None, "http://a.org/", "", 0), (2, "http://a.org/", "é 日本 \U0001f642", 6), (3, "x", "plain text only", 15)]
    got = result(X.extract(frame(spark, rows)))
    assert [r for r in got if r[0] != 4] == sorted(want, key=str)
    assert next(r for r in got if r[0] == 4)[3] == 3000 * (len(LONG) + 2) - 2
    assert X.extract(frame(spark, rows).limit(0)).count() == 0


def test_given_pages_equal_a_plain_reading(spark):
    """The given pages have one article each; read it by splitting strings."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")

    def plain(html):
        inside = html.split("<article>", 1)[1].split("</article>")[0].replace("<br>", " ")
        blocks = (" ".join(H.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inside))
        return "\n\n".join(b for b in blocks if b)

    want = sorted((r.page_id, r.url, plain(r.html), len(plain(r.html))) for r in pages.collect())
    assert result(X.extract(pages)) == sorted(want, key=str)
