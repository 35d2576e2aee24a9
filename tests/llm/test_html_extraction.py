import re
from html import unescape

import pytest

from samples import SF001
from scholarlake.llm import html_extraction as he

STOPS = frozenset("the of and to in is a that it was".split())
P = "The quick brown fox of the north went to the river and it was a long day in the sun."

CASES = {
    f"<header><h1>Site</h1></header><main><h1>Title</h1><p>{P}</p></main><footer>{P}</footer>":
        f"Title {P}",
    f'<div class="sidebar">{P}</div><article><p>{P}</p><p>Short.</p></article>': f"{P} Short.",
    f'<article><div class="cookie-notice">{P}</div><p>{P}</p><div id="adBox">{P}</div></article>': P,
    f'<article><p>{P}</p><section id="comments"><p>{P}</p></section></article>': P,
    f'<article><p>{P}</p><article class="comment"><p>{P} Yes.</p></article></article>': P,
    f"<article><p>{P}</p><form><label>Your name</label></form></article>": P,
    f"<article><aside>{P}</aside><p>{P}<nav><a href=x>Next</a></nav></article>": P,
    f'<article><p>{P}<script>var a="</p><p>x";</script> More.</p></article>': f"{P} More.",
    f"<article><p>{P}<!-- <p>no</p> --><p>One\n two&nbsp;&amp;&#x41;<b>b</b>c": f"{P} One two &Abc",
    f"<div><h2>Head</h2><p>{P}</p><ul><li><a href=1>Link one here</a></ul></div>": f"Head {P}",
    f"<p>{P}</p><div class=newsletter>{P}</div>": P,
    f'<article><p>{P}</p><p hidden>{P}</p><p style="display: none">{P}</p></article>': P,
    f"<article><p>{P}</p><table><tr><td>a<td>b</table></article>": f"{P} a b",
    "<article><p>Short.</article>": "Short.",
    "just text & more": "just text & more",
    "<": "<",
    "": "",
    "<p></p>": "",
    "<style>p{}</style><title>t</title>": "",
}


@pytest.mark.parametrize("page", CASES)
def test_pages(page):
    assert he.main_text(page, STOPS) == CASES[page]


def test_whole_tables(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    truth = {}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", row.html, re.DOTALL)[1]
        article = re.sub(r"</?b>", "", article)
        truth[row.page_id] = " ".join(unescape(re.sub(r"<[^>]*>", " ", article)).split())
    got = {r.page_id: (r.text, r.n_chars) for r in he.extracted(pages).collect()}
    assert got == {i: (text, len(text)) for i, text in truth.items()}


def test_odd_rows(spark):
    long = "<article>" + f"<p>{P}</p>" * 5000 + "</article>"
    rows = [(1, None, None), (2, "u", ""), (3, "u", long), (3, "u", long), (None, "u", "<p>x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = he.extracted(df).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, 1, 5000 * (len(P) + 1) - 1, 5000 * (len(P) + 1) - 1]
    assert he.extracted(df.limit(0)).count() == 0


def test_stop_words_count_all_pages(spark):
    rows = [(i, "u", f"<p>the cat w{i}</p><p>the</p>") for i in range(20)] + [(99, "u", "<p>dog")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert he.stop_words(df, 2) == {"the", "cat"}
