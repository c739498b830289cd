"""HTML column helpers (X1-X5): cleaning, visible text, title, block text.

Everything is ``regexp_*`` / ``split`` / higher-order array functions on one row: no shuffle, no Python. A tag is
matched without a group that backtracks, so neither its number of attributes nor their length costs stack or
more than linear time. The content extractors cut a page into tokens (tags and texts) and fold them over a stack
of open elements.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .references import unescape as _unescape
from .text import WS, let, py_strip

SP = r"[ \t\n\r\f]"  # ASCII blank

# What follows a tag's name. A quote opens a value only after "="; it may then hold ">". A tag that is not closed
# ends before the next "<", or with the input.
ATTRS = rf"(?:[^<>=]++|={SP}*+(?:\"[^\"]*+\"|'[^']*+')?+)*+"
TAG_RE = rf"<[a-zA-Z/!?]{ATTRS}>?+"
ATTRIBUTE_RE = rf"[^ \t\n\r\f/=<>\"']++{SP}*+={SP}*+(?:\"[^\"]*+\"|'[^']*+'|[^ \t\n\r\f>]*+)"
# Parts that carry no visible text: comments, script, style, template, doctype and processing instructions. They
# are replaced by an empty tag so that the text on either side stays two text nodes, as in an HTML tree.
# What is not closed goes on to the end of the input.
NON_TEXT_RE = (
    r"(?is)<!--.*?(?:-->|\z)"
    + "".join(rf"|<{t}\b{ATTRS}>.*?(?:</{t}{SP}*+>|\z)" for t in ("script", "style", "template"))
    + r"|<![a-zA-Z][^>]*+>"
    + r"|<\?[^>]*+>"
)
NODE_BREAK = "<!>"
BODY_RE = rf"(?is)<body\b{ATTRS}>(.*?)(?:</body{SP}*+>|\z)"
HAS_BODY_RE = r"(?i)<body\b"
TITLE_RE = rf"(?is)<title\b{ATTRS}>(.*?)</title{SP}*+>"
TOKEN_RE = rf"{TAG_RE}|[^<]++|<"

# Parameters of the block extractor (X1) and the paragraph extractor.
BLOCK_TAGS = "p div article section h1 h2 h3 h4 h5 h6 li ul ol table tr td blockquote pre nav footer header aside br".split()
BOILERPLATE_CONTAINERS = "nav footer header aside title".split()
BOILERPLATE_NAMES = "ad ads advert advertisement banner cookie cookies sidebar menu share social related promo sponsored".split()
PARAGRAPH_TAGS = "p h1 h2 h3 h4 h5 h6 li blockquote".split()
VOID_TAGS = "area base br col embed hr img input link meta param source track wbr".split()
MIN_BLOCK_CHARS = 25
MAX_LINK_DENSITY = 0.5
MIN_TEXT_CHARS = 50  # an extractor's text is accepted only when longer than this
#: Open elements kept at most (browsers stop at the same depth); what is opened deeper counts as their text.
MAX_DEPTH = 512
#: Tokens folded into one string before the results are gathered: keeps the work linear.
FOLDED = 256

# Marks in folded text: a block boundary (then p or x), the ends of link text
MARK, LINK, UNLINK = "\x01", "\x02", "\x03"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unescape(c) -> Column:
    return _unescape(_c(c))


def clean_html(html) -> Column:
    """Remove non-text parts (comments, script, style, template, doctype)."""
    return F.regexp_replace(_c(html), NON_TEXT_RE, NODE_BREAK)


def text_nodes(fragment) -> Column:
    """Visible text nodes joined by newline, references decoded, ends stripped."""
    pieces = F.filter(F.split(_c(fragment), TAG_RE), lambda p: p != "")
    return py_strip(unescape(F.array_join(pieces, "\n")))


def body_text(cleaned) -> Column:
    """Text of ``<body>`` (to ``</body>`` or the end), else of the whole document."""
    c = _c(cleaned)
    frag = F.when(c.rlike(HAS_BODY_RE), F.regexp_extract(c, BODY_RE, 1)).otherwise(c)
    return text_nodes(frag)


def title_string(cleaned) -> Column:
    """``<title>`` text; NULL when missing, empty, or holding nested tags."""
    raw = F.regexp_extract(_c(cleaned), TITLE_RE, 1)
    return F.when((raw == "") | raw.rlike(TAG_RE), F.lit(None).cast("string")).otherwise(unescape(raw))


def title_text(cleaned) -> Column:
    """Title with nested tags dropped (the block extractor's title); NULL when empty."""
    raw = F.regexp_extract(_c(cleaned), TITLE_RE, 1)
    t = py_strip(unescape(F.regexp_replace(raw, TAG_RE, "")))
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def _in(value: Column, names: Sequence[str]) -> Column:
    return value.isin(list(names)) if names else F.lit(False)


def _token(token: Column, containers: Sequence[str], names: Sequence[str]) -> Column:
    """A token's parts: its text, or as a tag its name (lower case), whether it closes, and what kind of element it is."""
    tag = F.startswith(token, F.lit("<")) & (F.length(token) > 1)
    name = F.lower(F.regexp_extract(token, r"^</?([a-zA-Z][^ \t\n\r\f/>]*+)", 1))
    # attributes one by one (a value in quotes is part of its attribute), then those with one of the names as a word
    attributes = F.regexp_extract_all(token, F.lit(ATTRIBUTE_RE), F.lit(0))
    named = F.exists(attributes, lambda a: a.rlike(rf"(?is)^(?:class|id){SP}*+={SP}*+[\"']?(?:.*{SP})?(?:{'|'.join(names) or '(?!)'})(?:{SP}.*)?[\"']?$"))
    return let(
        F.when(tag, name),
        lambda name: F.struct(
            F.when(name.isNull(), token).alias("text"),
            name.alias("name"),
            F.startswith(token, F.lit("</")).alias("closes"),
            (_in(name, containers) | (~_in(name, ["html", "body"]) & token.contains("=") & named)).alias("boiler"),
            _in(name, BLOCK_TAGS).alias("block"),
            _in(name, PARAGRAPH_TAGS).alias("para"),
            _in(name, VOID_TAGS).alias("void"),
        ),
    )


_STATE = "struct<stack:array<string>,skip:int,link:int,para:int,out:string>"


def _step(s: Column, t: Column) -> Column:
    """The state after a token: the open elements; at which depth boilerplate, a link and a paragraph began (0: not open);
    the text so far."""

    def state(of, out, **changed):
        return F.struct(*[changed.get(n, of[n]).alias(n) for n in ("stack", "skip", "link", "para")], out.alias("out")).cast(_STATE)

    def bounded(para):
        """The text, and behind a block's tag a boundary with whether a paragraph is open."""
        return F.when(t["block"], F.concat(s["out"], F.lit(MARK), F.when(para > 0, "p").otherwise("x"))).otherwise(s["out"])

    def cut(depth, then):
        """Elements deeper than ``depth`` end."""
        left = F.struct(F.slice(s["stack"], 1, depth).alias("stack"), *[F.when(s[n] > depth, 0).otherwise(s[n]).alias(n) for n in ("skip", "link", "para")])
        return F.when(depth < F.size(s["stack"]), let(left, then)).otherwise(then(s))

    said = F.when(s["skip"] > 0, "").when(s["link"] > 0, F.concat(F.lit(LINK), t["text"], F.lit(UNLINK))).otherwise(t["text"])
    text = state(s, F.concat(s["out"], said))

    def closed(at):
        """``at``: how far from the end of the stack the element is that the tag closes (0: there is none)."""
        depth = F.when(at > 0, F.size(s["stack"]) - at).otherwise(F.size(s["stack"]))
        return let(depth, lambda d: cut(d, lambda left: state(left, bounded(left["para"]))))

    def opened(left):
        here = F.size(left["stack"]) + 1

        def pushed(here):
            inside = F.when((left["para"] == 0) & t["para"], here).otherwise(left["para"])
            skip = F.when((left["skip"] == 0) & t["boiler"], here).otherwise(left["skip"])
            link = F.when((left["link"] == 0) & (t["name"] == "a"), here).otherwise(left["link"])
            return state(left, bounded(inside), stack=F.array_append(left["stack"], t["name"]), skip=skip, link=link, para=inside)

        return F.when(t["void"] | (here > MAX_DEPTH), state(left, bounded(left["para"]))).otherwise(let(here, pushed))

    # a block ends an open paragraph, a link the link just opened
    before = F.when(t["block"] & ~t["void"], F.array_position(s["stack"], "p").cast("int"))
    before = before.when((t["name"] == "a") & (F.try_element_at(s["stack"], F.lit(-1)) == "a"), F.size(s["stack"])).otherwise(0)
    open_ = let(F.when(before > 0, before - 1).otherwise(F.size(s["stack"])), lambda d: cut(d, opened))
    close = let(F.array_position(F.reverse(s["stack"]), t["name"]).cast("int"), closed)
    return F.when(t["name"].isNull(), text).when(t["name"] == "", s).when(t["closes"], close).otherwise(open_)


def folded(cleaned, containers: Sequence[str] = BOILERPLATE_CONTAINERS, names: Sequence[str] = BOILERPLATE_NAMES) -> Column:
    """The text of a page outside boilerplate, block by block: an array of strings, each beginning with p (inside a
    paragraph-like element) or x, with marks around link text.

    An element ends with its closing tag, with that of an element around it, or with the page; a block element ends an
    open paragraph. Boilerplate are the elements ``containers`` and those whose class or id has one of ``names``.
    """
    text = F.translate(_c(cleaned), MARK + LINK + UNLINK, "")
    start = F.expr(f"cast(named_struct('stack', array(), 'skip', 0, 'link', 0, 'para', 0, 'out', '') as {_STATE})")

    def all_blocks(tokens: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / FOLDED).cast("int")), lambda i: F.slice(tokens, i * FOLDED + 1, FOLDED))
        first = F.struct(start.alias("state"), F.array().cast("array<string>").alias("done"))

        def part(acc: Column, some: Column) -> Column:
            def gathered(s: Column) -> Column:
                fresh = F.struct(*[s[n].alias(n) for n in ("stack", "skip", "link", "para")], F.lit("").alias("out")).cast(_STATE)
                return F.struct(fresh.alias("state"), F.array_append(acc["done"], s["out"]).alias("done"))

            return let(F.aggregate(some, acc["state"], _step), gathered).cast(
                f"struct<state:{_STATE},done:array<string>>"
            )

        return F.aggregate(parts, first.cast(f"struct<state:{_STATE},done:array<string>>"), part, lambda acc: F.array_join(acc["done"], ""))

    tokens = F.transform(F.regexp_extract_all(text, F.lit(TOKEN_RE), F.lit(0)), lambda t: _token(t, containers, names))
    whole = let(tokens, lambda t: F.when(F.size(t) > 0, all_blocks(t)).otherwise(""))
    return F.when(text.isNotNull(), F.split(F.concat(F.lit("x"), whole), MARK))


def _norm_text(piece) -> Column:
    t = unescape(F.translate(F.substring(piece, 2, 2147483647), LINK + UNLINK, ""))
    return py_strip(F.regexp_replace(t, f"[{WS}]+", " "))


def main_blocks(cleaned, min_chars: int = MIN_BLOCK_CHARS, max_link_density: float = MAX_LINK_DENSITY, **boilerplate) -> Column:
    """Content blocks - at least ``min_chars`` characters, link text under ``max_link_density`` - joined by newline."""
    return joined_blocks(folded(cleaned, **boilerplate), min_chars, max_link_density)


def joined_blocks(blocks, min_chars: int = MIN_BLOCK_CHARS, max_link_density: float = MAX_LINK_DENSITY) -> Column:
    scored = F.transform(
        _c(blocks),
        lambda b: F.struct(
            _norm_text(b).alias("t"),
            F.length(F.array_join(F.regexp_extract_all(b, F.lit(f"{LINK}([^{UNLINK}]*)"), F.lit(1)), "")).alias("l"),
        ),
    )
    kept = F.filter(scored, lambda s: (F.length(s["t"]) >= min_chars) & (s["l"] < F.length(s["t"]) * max_link_density))
    return F.array_join(F.transform(kept, lambda s: s["t"]), "\n")


def paragraph_text(cleaned, **boilerplate) -> Column:
    """Text of paragraph-like elements (p, h1-h6, li, blockquote), one line for each of their blocks."""
    return joined_paragraphs(folded(cleaned, **boilerplate))


def joined_paragraphs(blocks) -> Column:
    keep = F.filter(_c(blocks), lambda b: F.startswith(b, F.lit("p")))
    return F.array_join(F.filter(F.transform(keep, lambda b: _norm_text(b)), lambda t: t != ""), "\n")


def accepted(text, min_chars: int = MIN_TEXT_CHARS) -> Column:
    t = _c(text)
    return F.when(F.length(t) > min_chars, t)


def extract_main(html) -> Column:
    """Cascade X1 -> X2 -> X3; struct ``(title, text, method)``.

    Title: the block extractor's title in the first branch, the ``<title>``
    string otherwise. ``title`` is NULL rather than empty.
    """
    cleaned = clean_html(html)
    t1 = accepted(main_blocks(cleaned))
    t2 = accepted(paragraph_text(cleaned))
    t3 = body_text(cleaned)
    return F.struct(
        F.when(t1.isNotNull(), title_text(cleaned)).otherwise(title_string(cleaned)).alias("title"),
        F.coalesce(t1, t2, t3).alias("text"),
        F.when(t1.isNotNull(), F.lit("blocks")).when(t2.isNotNull(), F.lit("paragraphs")).otherwise(F.lit("body")).alias("method"),
    )
