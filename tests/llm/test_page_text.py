"""Main text of pages of several templates, whose articles are known."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from orderlake.llm.page_text import extract_pages, main_text, op13_page_text, path_standing, read_page

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def prose(pick, sentences):
    return " ".join(" ".join(pick.choice("river stone möve letter under quiet nine lamps follow early".split()) for _ in range(pick.randint(5, 14))).capitalize() + "." for _ in range(sentences))


def blocks(pick, n):
    return [prose(pick, pick.randint(2, 5)) for _ in range(n)]


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def plain(pick, k):
    title, body = prose(pick, 1), blocks(pick, 4)
    return f"""<!DOCTYPE html><html><head><title>{title}</title><style>p{{a:b}}</style><script>var a = "</p><article>";</script></head><body class="has-sidebar">
    <header class="site-header"><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice"><p>{prose(pick, 3)}</p></div>
    <article class="post-{k}"><h1>{title}</h1>{paragraphs(body[:2])}<div class="ad">{prose(pick, 2)}</div><aside>{prose(pick, 2)}</aside>{paragraphs(body[2:])}
    <form action=x><p>Name</p><input name=a><button>Send</button></form></article><section id="comments"><article><p>{prose(pick, 9)}</p></article></section>
    <footer><p>{prose(pick, 4)}</p></footer></body></html>""", [title, *body]


def unnamed(pick, k):
    """Nothing is named; comments of some pages are longer than the article."""
    title, body = prose(pick, 1), blocks(pick, 3)
    talk = "".join(f"<div class=c4><p>{t}</p></div>" for t in blocks(pick, 30 if k % 3 == 0 else 1))
    return f"""<html><body><div class=a><a href=/>Home</a> <a href=/b>News</a> <a href=/c>Contact</a></div><div class=b><h1>{title}</h1>{paragraphs(body)}</div>
    <div class=q><div class=r>{talk}</div></div><div class=z><p>{prose(pick, 2)}</p></div></body></html>""", [title, *body]


def old(pick, k):
    """Upper-case tags, missing end tags, table layout."""
    title, body = prose(pick, 1), blocks(pick, 4)
    return f"""<HTML><BODY><TABLE><TR><TD CLASS=menu><UL><LI><A HREF=/1>One</A><LI><A HREF=/2>Two</A></UL><TD CLASS=story><H1>{title}</H1><P>{"<P>".join(body)}</TABLE>
    <DIV ID=footer>{prose(pick, 2)}</DIV>""", [title, *body]


def nested(pick, k):
    title, body = prose(pick, 1), blocks(pick, 3)
    return f"""<html><body><div id="page"><div class="sidebar"><ul><li>{prose(pick, 6)}</li></ul></div><div class="content wide-{k}"><h2>{title}</h2><div class="entry-content">
    {paragraphs(body)}<ul><li>{body[0]}</li><li>{body[1]}</li></ul><ul class="share"><li>Share</li></ul></div></div>
    <div class="related-posts"><a href=1>{title}</a></div></div></body></html>""", [title, *body, body[0], body[1]]


MAKERS = {"plain.example": plain, "unnamed.example": unnamed, "old.example": old, "nested.example": nested}


def pages(many=12):
    rows, want = [], {}
    pick = random.Random(5)
    for host, make in MAKERS.items():
        for k in range(many):
            source, texts = make(pick, k)
            rows.append((len(rows), f"https://{host}/{k}?a=b", source))
            want[len(rows) - 1] = "\n".join(texts)
    return rows, want


def write(spark, folder, rows, schema=PAGES):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/pages.parquet")
    return folder


def test_articles_of_several_templates(spark, lake_root):
    rows, want = pages()
    found = op13_page_text(spark, write(spark, lake_root, rows)).collect()
    assert {r.page_id: r.text for r in found} == want
    assert all(r.n_chars == len(r.text) for r in found)


def test_the_host_decides_where_a_page_would_err(spark):
    rows, want = pages()
    alone = {i: main_text(source, {})[0] for i, url, source in rows}
    wrong = {i for i in want if alone[i] != want[i]}
    assert wrong and all("unnamed" in rows[i][1] for i in wrong)
    paths = {(r.host, r.path) for r in path_standing(spark.createDataFrame(rows, PAGES)).collect()}
    assert ("unnamed.example", "html>body>div.b") in paths


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        (" \n ", ""),
        ("no markup &amp; a < b &lt;i&gt; &#233;&#x1F642;&nbsp;end", "no markup & a < b <i> é🙂 end"),
        ("<p>a<b>b</b>c<br>d\n\t e</p><p> </p><p>f", "abc d e\nf"),
        ("<body><p>one<!-- two --><![CDATA[ three ]]></p><script>x('<p>')</script><p hidden>four</p><p style='display: none'>five</p></body>", "one three"),
        ("<body><div class='article-header'><h1>T</h1></div><p title='a > b'>x</p><p title=it's>y</p></body>", "T\nx\ny"),
        ("<body><table><tr><td>1<td>2<tr><td>3</table></body>", "1\n2\n3"),
        ("<body><div class=menu><h1>T</h1><p>All is in here.</p><p>More.</p></div></body>", "T\nAll is in here.\nMore."),
        ("<body><nav>only a menu</nav></body>", ""),
        ("<body><div class=comments>only what is named so</div></body>", "only what is named so"),
        ("<main><header><h1>T</h1></header><p>b</p></main><header>site</header>", "T\nb"),
        ("<article><p>x<article", "x"),
    ],
)
def test_markup(source, text):
    assert main_text(source, {})[0] == text


def test_odd_rows_clashing_columns_and_empty_table(spark, lake_root):
    names = ["host", "path", "standing", "text", "n", "share", "pages"]
    schema = T.StructType([*PAGES.fields, *[T.StructField(c, T.StringType()) for c in names]])
    long = "<html><body><article>" + "<p>word word.</p>" * 50_000 + "</article></body></html>"
    deep = "<body>" + "<div>" * 3000 + "<p>deep" + "</div>" * 3000
    rows = [(1, None, "<p>x</p>"), (2, "not a url", "<p>x</p>"), (None, "http://h/1", "<p>x</p>"), (3, "http://h/2", None), (4, "http://h/3", long), (4, "http://h/3", long), (5, "http://h/4", deep)]
    found = op13_page_text(spark, write(spark, lake_root, [(*r, *["y"] * len(names)) for r in rows], schema))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id or 0, r.text) for r in found.collect()), key=lambda r: r[0])
    text = "\n".join(["word word."] * 50_000)
    assert got == [(0, "x"), (1, "x"), (2, "x"), (3, ""), (4, text), (4, text), (5, "deep")]
    assert op13_page_text(spark, write(spark, f"{lake_root}/empty", [])).count() == 0


def test_one_host_with_most_pages_and_paths_that_change(spark):
    pick = random.Random(1)
    rows, want = [], {}
    for k in range(300):
        source, texts = unnamed(pick, k)
        rows.append((k, "https://hot.example/x", source.replace("class=q", f"class='q u{k} {'v' * (k + 1)}'")))
        want[k] = "\n".join(texts)
    pages_of = spark.createDataFrame(rows, PAGES).repartition(7)
    assert {r.page_id: r.text for r in extract_pages(pages_of).collect()} == want
    assert path_standing(pages_of).count() < 20


def test_paths_are_general():
    source = "<body><div class='b css-1a2 a'><p>x</p></div><div class='a b z9'><p>y</p></div></body>"
    assert set(read_page(source).scores()) == {"body", "body>div.a.b"}
    assert main_text(source, {"body>div.a.b": 1.0})[0] == "x\ny"
