"""HTML extraction and language detection."""

from pyspark.sql import functions as F

from pagelake.functions import html as H
from pagelake.operators import extract as E
from pagelake.operators import langid

SMALL_PAGE = "<html><head><title>Test Page</title></head><body><h1>Hello</h1><p>This is a test.</p></body></html>"


def _extract(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "id long, html string")
    return [r for r in E.extract_pages(df).orderBy("id").collect()]


def test_small_page(spark):
    # the reference's own case: title contains "Test Page", the body text is found
    r = _extract(spark, [SMALL_PAGE])[0]
    assert "Test Page" in r.title
    assert "This is a test." in r.text
    assert r.method == "body"  # too short for the two content extractors


def test_edge_pages(spark):
    long_p = "Spark keeps the plan declarative and lets the optimizer choose the strategy."
    pages = [
        "<html><body><p>" + long_p + "</p></body></html>",  # no title
        "<html><head><title>A <b>bold</b> title</title></head><body><p>x</p></body></html>",  # nested tag in title
        "<html><head><title>T</title></head><body></body></html>",  # empty body
        "<html><body><p>" + long_p + "<p>second unclosed paragraph that is long enough to count",  # unclosed tags
        "<html><body><script>var s = '</p>';</script><p>" + long_p + "</p></body></html>",  # script holding </p>
        "<p>no body element, only text &amp; an entity</p>",
        "<html><body><nav>" + long_p + "</nav><div>short</div></body></html>",  # boilerplate only
    ]
    rows = _extract(spark, pages)
    assert rows[0].title is None and rows[0].text == long_p and rows[0].method == "blocks"
    assert rows[1].title is None  # the title string is None when the title holds tags
    assert rows[2].text == "" and rows[2].title == "T"
    assert rows[3].text == long_p + "\nsecond unclosed paragraph that is long enough to count"
    assert "var s" not in rows[4].text and rows[4].text == long_p
    assert rows[5].text == "no body element, only text & an entity"
    assert rows[6].method == "body" and long_p in rows[6].text


def test_body_text_keeps_inner_whitespace(spark):
    df = spark.createDataFrame([("<body>\n  <p>a  b</p><!-- c --><i>d</i>\n</body>",)], "h string")
    got = df.select(H.body_text(H.clean_html("h")).alias("t")).first().t
    assert got == "a  b\nd"


def test_raw_store_dedup(spark):
    df = spark.createDataFrame([("<p>x</p>",), ("<p>x</p>",), ("<p>y</p>",)], "html string")
    rows = E.raw_store(df).collect()
    assert len(rows) == 2
    assert sorted(r.n_pages for r in rows) == [1, 2]
    assert all(r.html_path == f"raw/{r.digest}.html" and len(r.digest) == 64 for r in rows)


def test_language_detection(spark):
    en = "the quick brown fox jumps over the lazy dog while the weather is nice and the sun shines"
    de = "der schnelle braune fuchs springt über den faulen hund während das wetter schön ist und die sonne scheint"
    train = spark.createDataFrame([(1, en, "en"), (2, de, "de")] * 3, "id long, text string, lang string")
    test = spark.createDataFrame(
        [
            (10, "the dog and the fox are in the sun while the weather is warm and nice today"),
            (11, "der hund und der fuchs sind in der sonne während das wetter warm und schön ist"),
            (12, "kurz"),  # 50 characters or fewer: no detection
            (13, None),
        ],
        "id long, text string",
    )
    prof = langid.fit_profile(train)
    got = {r.id: r.lang for r in langid.detect(test, prof, "id").collect()}
    assert got == {10: "en", 11: "de", 12: None, 13: None}


def test_grams_linear_regex(spark):
    df = spark.createDataFrame([("abcd",), ("ab",)], "t string")
    assert [r.g for r in df.select(langid.grams("t").alias("g")).collect()] == [["abc", "bcd"], []]
    assert df.select(langid.normalized(F.lit("Hé, 42 X!")).alias("n")).first().n == "hé x "


def test_quoted_brackets_and_unclosed_parts(spark):
    rows = [
        ('<body><a title="a>b" href=\'x>y\'>link</a> end</body>', "link\n end"),
        ("<body>before<script>var x = '<p>no</p>';", "before"),
        ("<body>before<!-- no <b>end</b>", "before"),
        ("<body>before<style>p{}", "before"),
    ]
    df = spark.createDataFrame(rows, "html string, want string")
    for r in df.select("want", H.body_text(H.clean_html("html")).alias("got")).collect():
        assert r["got"] == r["want"]


def _texts(spark, pages, column):
    df = spark.createDataFrame(list(enumerate(pages)), "id long, html string")
    return [r.t for r in df.select("id", column(H.clean_html("html")).alias("t")).orderBy("id").collect()]


def test_tags_of_any_size(spark):
    pages = [
        "<p " + "a=1 " * 100_000 + ">ok</p>",
        "<p " + "".join(f"a{i}='>' " for i in range(3000)) + ">ok</p>",
        "<p x='" + "y" * 1_000_000 + "'>ok</p>",
        "<p class='" + "y " * 200_000 + "'>ok</p>",
        "<a <a <a" * 20_000 + "<p>ok</p>",
        "<div>" * 3000 + "<p>ok</p>",
        "<p>ok</p>" + "<" * 50_000,
    ]
    assert _texts(spark, pages, H.body_text)[:6] == ["ok"] * 6
    assert _texts(spark, pages, H.paragraph_text)[:5] == ["ok"] * 5
    assert _texts(spark, pages, H.paragraph_text)[6] == "ok"


def test_attribute_values(spark):
    pages = [
        "<body><a data=x'>it's <b>bold</b> text</body>",
        "<p a='>x</p><p b=\"z\">y</p>",  # the quote is not closed before the next one
        "<p title = \"a>b\" x>one</p>",
        "<p title=>one</p>",
    ]
    assert _texts(spark, pages, H.body_text) == ["it's \nbold\n text", "x\ny", "one", "one"]


def test_paragraphs_and_boilerplate(spark):
    pages = [
        "<p>one<br>two</p>tail",
        "<p>a<span class='ad'>X</span>b</p>",
        '<p>a<span class="x ad y">X<span>n</span></span>b</p>',
        "<p>a <span class=ad>X</span>b",
        "<div class=\"menu\"><div><p>x</p></div><p>y</p></div><p>z</p>",
        "<nav><ul><li>x<li>y</ul></nav><li>z",
        "<blockquote><div>quoted</div></blockquote><div>not</div>",
        "<p><b>x<p>y</b></p>z",
        "<p data-x='class=ad' title=\"id=ad\">kept</p>",
        "<P CLASS = 'Ad'>gone</P><p class='adding'>kept</p>",
        "<header><p>x</p></header><p>caf&eacute; &#8217;s &amp;lt;</p>",
        None,
    ]
    want = ["one\ntwo", "ab", "ab", "a b", "z", "z", "quoted", "x\ny", "kept", "kept", "café ’s &lt;", None]
    assert _texts(spark, pages, H.paragraph_text) == want
    got = _texts(spark, pages[:2], lambda c: H.paragraph_text(c, names=["other"]))
    assert got == ["one\ntwo", "aXb"]


def test_block_thresholds_are_parameters(spark):
    page = "<div>short text</div><div>a longer block of text <a>with a link that is most of the block of text</a></div>"
    assert _texts(spark, [page], H.main_blocks) == [""]
    assert _texts(spark, [page], lambda c: H.main_blocks(c, min_chars=5)) == ["short text"]
    assert _texts(spark, [page], lambda c: H.main_blocks(c, 5, 0.9))[0].count("\n") == 1
