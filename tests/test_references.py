"""Character references against the standard library's decoder."""

import html
import random
from html.entities import html5

from pagelake.functions.references import unescape


def test_equals_the_standard_library(spark):
    rnd = random.Random(1)
    names = sorted(html5)
    texts = [
        "It&#8217;s caf&eacute; &#x27;x&#X27; &rsquo;",
        "&notit; &notin; &copy2 &amp;amp; &ampx & &; &#; &#x; &#xg;",
        "&#0;&#128;&#129;&#159;&#55296;&#1114112;&#99999999999999999999;&#13;&#1;&#xFFFE;&#x1F600;",
        "",
        "&",
        "&&&lt;",
        "&CounterClockwiseContourIntegral;&NotEqualTilde;&ThisIsNoNameAtAllButVeryLongIndeedReally;",
        "&#000065;&#x00041",
    ]
    parts = ["a", ";", "&", " x "]
    for _ in range(300):
        some = lambda: rnd.choice([*parts, "&" + rnd.choice(names), "&" + rnd.choice(names)[:-1], f"&#{rnd.randrange(70000)};", f"&#x{rnd.randrange(0x120000):x}"])
        texts.append("".join(some() for _ in range(8)))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = dict(df.select("i", unescape(df.t).alias("u")).collect())
    assert got == {i: html.unescape(t) for i, t in enumerate(texts)}


def test_null_and_plain_texts(spark):
    df = spark.createDataFrame([(None,), ("plain",)], "t string")
    assert [r.u for r in df.select(unescape(df.t).alias("u")).collect()] == [None, "plain"]
