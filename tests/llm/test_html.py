import html
import re

import numpy as np

from fedspark.llm import html_extract as he
from fedspark.llm import html_pages, lstm

PAGES = "page_id long, url string, html string, fp string, text string"


def gold(page):
    """Plain reading of the test tables' pages: the blocks inside <article>."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h[1-6]|ul|li|div|blockquote|table|tr|td|pre)\b[^>]*>", inner)
    return "\n".join(x for x in (" ".join(html.unescape(re.sub("<[^>]*>", " " if "<br" in s else "", s)).split()) for s in parts) if x)


def test_reading_blocks():
    read = lambda h: [b.text for b in he.blocks_of(h)]
    assert read("<p>a<b>b</b> c<br>d<p>&lt;e&gt; &amp; &eacute;&#8212;x") == ["ab c d", "<e> & é—x"]
    assert read("x < y <!-- <p>no</p> --> z<script>var t='</p>';</script>w") == ["x < y z" + "w"]
    assert read("<title>t</title><head>h") == ["h"]
    assert read("<ul><li>a<li>b<ul><li>c</ul></ul></div>d") == ["a", "b", "c", "d"]
    assert read("") == [] and read("<!-- open") == [] and read("<p> \n </p>") == []
    assert read("<script>never closed <p>x") == []


def test_labeller_on_made_up_pages():
    made = [html_pages.sample(77_000_000 + i) for i in range(200)]
    blocks = [b for b, _ in made]
    got = np.concatenate(he.label(blocks, html_pages.trained()))
    want = np.concatenate([y for _, y in made]) > 0.5
    assert (got == want).mean() > 0.985


def test_batches_do_not_change_predictions():
    model = html_pages.trained()
    blocks = [html_pages.sample(88_000_000 + i)[0] for i in range(30)]
    together = model.predict(he.vectors(blocks), [len(b) for b in blocks])
    alone = np.concatenate([model.predict(he.vectors([b]), [len(b)]) for b in blocks if b])
    assert np.allclose(together, alone, atol=1e-4)


def test_gradients():
    r = np.random.default_rng(0)
    model = lstm.Labeller.fresh(6, 1)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    rows, labels, sizes = r.normal(size=(7, 6)), r.integers(0, 2, 7).astype(float), [4, 3]

    def loss():
        p = np.clip(model.predict(rows, sizes).astype(np.float64), 1e-9, 1 - 1e-9)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    before = loss()
    model.train(rows.astype(np.float32), sizes, labels.astype(np.float32), epochs=30, seed=0)
    assert loss() < before / 3


def test_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in he.main_text(df).collect()}
    for r in df.collect():
        assert got[r.page_id] == (r.url, gold(r.html), len(gold(r.html)))


def test_odd_cases(spark):
    rows = [(1, "u", None, "x", "y"), (2, None, "", "x", "y"), (None, "u", "<p></p>", "x", "y"), (4, "u", "<article>" + "<p>A long story of words here.</p>" * 3000 + "</article>", "x", "y")]
    got = {r.page_id: r for r in he.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert [got[k].text for k in (1, 2, None)] == [""] * 3 and got[1].n_chars == 0
    assert got[4].text.count("\n") == 2999
    assert he.main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_long_attributes_are_told_apart():
    """Tags that begin alike for 200 characters and differ in class have features of their own."""
    page = '<div style="%s" class="%s"><p>words</p></div>'
    style = "color:red;" * 30
    read = lambda c: he.blocks_of(page % (style, c))[0].path
    assert read("sidebar") == he.blocks_of(page % ("", "sidebar"))[0].path
    assert read("article") == he.blocks_of(page % ("", "article"))[0].path != read("sidebar")


def test_comments_inside_the_article(spark):
    """Readers' comments go, also where they stand inside the article's element, alone or in a row."""
    story = [f"This is the long {w} paragraph of the story, which tells of many things in turn." for w in ("first", "second", "third", "fourth")]
    body = "<h1>A title of the story.</h1>" + "".join(f"<p>{x}</p>" for x in story)
    want = "\n".join(["A title of the story.", *story])
    talks = [
        "<section class=comments><p>Nice post, I liked it a lot.</p></section>",
        '<div class="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b><p>I do not agree with this at all.</p></div><div class="comment"><b>Bo</b><p>Well said.</p></div></div>',
        '<ol class="comment-list"><li>Thanks for writing this.</li><li>So true!</li></ol>',
    ]
    rows = [(i, "u", f"<body><nav><ul><li><a href=/>Home</a></ul></nav><article>{body}{t}</article><footer>© 2024 us</footer></body>", "", "") for i, t in enumerate(talks)]
    got = {r.page_id: r.text for r in he.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: want for i in range(len(talks))}


def test_order_of_pages_and_repeated_rows(spark):
    """A page gives the same row wherever it stands, and each of its repeats; a page of several MB is read whole."""
    pages = [html_pages._Page(99_000_000 + i).make() for i in range(40)]
    long = "<body><article>" + "".join(f"<p>The {i} sentence of a long story, told in words.</p>" for i in range(60_000)) + "</article></body>"
    rows = [(i, None, p, "", "") for i, p in enumerate([*pages, long, pages[0]])]
    texts = []
    for order in (rows, rows[::-1]):
        texts.append({r.page_id: r.text for r in he.main_text(spark.createDataFrame(order, PAGES).coalesce(1)).collect()})
    assert texts[0] == texts[1] and texts[0][0] == texts[0][len(pages) + 1]
    assert texts[0][len(pages)].count("\n") == 59_999
