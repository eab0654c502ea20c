import pytest
from brute import html_text as brute_html_text
from brute import strip_code_blocks
from pyspark.sql import functions as F

from tether.functions import markup


def column(table, values, fn):
    rows = table(list(enumerate(values)), "i int, t string").select("i", fn(F.col("t")).alias("x")).collect()
    return [r.x for r in sorted(rows)]


def test_html_text(table):
    pages = [
        "<p>a<b>b</b></p><!-- x > y -->c<script>if (a<b) {}</script><style>p{}</style>d",
        "x<!-- never closed <p>y</p>",
        "1 < 2 and 3 > 2",
    ]
    assert column(table, pages, lambda c: markup.html_text(c, sep="")) == ["abcd", "x", "1 < 2 and 3 > 2"]
    assert column(table, ["<i>a</i><i>b</i>"], markup.html_text) == [" a  b "]
    assert column(table, ["a<script>s</script>"], lambda c: markup.html_text(c, "", strip_scripts=False)) == ["as"]


def test_character_references(table):
    texts = ["&amp;lt; &lt; &eacute;&#233;&#xE9; &#128512; &bogus; & &#0; &#55296; AT&T; &nbsp;|&hellip;", "none", None]
    assert column(table, texts, markup.unescape) == [
        "&lt; < \xe9\xe9\xe9 \U0001f600 &bogus; & &#0; &#55296; AT&T; \xa0|…",
        "none",
        None,
    ]


def test_header_parts_and_id(table):
    key = f"WARC-TREC-ID: x-1\r\n{markup.CONTENT_TYPE}\r\nbody"
    assert column(table, [key, "no type", key + key], lambda c: F.size(markup.header_parts(c))) == [2, 1, 3]
    headers = [
        "WARC-Type: a\r\nWARC-TREC-ID: x-1\r\nWARC-TREC-ID: x-2",
        "WARC-TREC-ID: a: b: c",
        "WARC-TREC-ID x",
        "X-WARC-TREC-ID: no",
        "WARC-TREC-ID broken\nWARC-TREC-ID: late",
        "WARC-TREC-ID: ",
    ]
    assert column(table, headers, markup.record_id) == ["x-1", "a", None, None, None, None]


BLOCKS = [
    "a\n<!--\nb\n//-->\nc",
    "a\n<!-- one line -->\nb\n//--> end\nc\n",
    " <!-- indented\nkept",
    "a\n//-->\nb",
    "a\n<!-- never closed\nb\nc",
    "<!--\nx\n<!--\ny\n//-->\nz\n//-->\nw",
    "a\r\n<!--\r\nb\r\n//-->\r\nc\r\n",
    "a\rb\x0bc\x0cd\x85e f g",
    "",
    "a\n\n\nb\n\n",
    "<!--x\n//-->",
]


def test_strip_code_blocks_equals_line_loop(table):
    assert column(table, BLOCKS, markup.strip_code_blocks) == [strip_code_blocks(t) for t in BLOCKS]


@pytest.mark.parametrize("parts", [["a\n", "<!--\n", "//-->\n", "x<!--\n", "\n", "//-->"]])
def test_strip_code_blocks_on_all_orders(table, parts):
    from itertools import product

    texts = ["".join(p) for n in (2, 3, 4) for p in product(parts, repeat=n)]
    assert column(table, texts, markup.strip_code_blocks) == [strip_code_blocks(t) for t in texts]


def test_references_of_any_name_and_length(spark):
    rows = spark.createDataFrame([("&#0000000233; &#x00000000E9; &alpha; &rarr; &Sigma; &hearts; &apos; &nosuch;",)], "t string")
    assert rows.select(markup.unescape(F.col("t"))).first()[0] == "\xe9 \xe9 \u03b1 \u2192 \u03a3 \u2665 ' &nosuch;"


def test_quoted_and_unclosed_markup(table):
    pages = [
        '<a title="x > y">z</a>',
        "a<script>var a=1; if (b<c) {}",
        "a<STYLE type='>'>p > q {}</Style\n>b",
        "<p title=it's>kept</p>",
        '<p title="never closed>text</p>',
        "a<b",
        "x<!-->y<!--->z<!-- a --!>t<!-- b",
        "<scripted>kept</scripted>",
        "<a b = \n'>' c>d",
    ]
    assert column(table, pages, lambda c: markup.html_text(c, "")) == ["z", "a", "ab", "kept", "text", "a", "xyzt", "kept", "d"]


@pytest.mark.parametrize("seed", range(3))
def test_scanner_equals_a_walk(table, seed):
    import random

    r = random.Random(seed)
    atoms = ["<", ">", "<a", "</a", "<script", "</script", "<STYLE>", "</style >", "<!--", "-->", "--!>", "<!", "=", '"', "'", " ", "/", "x", "1", "\n", "<p title=", "-", "?"]
    texts = ["".join(r.choice(atoms) for _ in range(r.randint(0, 14))) for _ in range(1500)]
    assert column(table, texts, markup.tag_free) == [brute_html_text(t) for t in texts]


def test_long_markup_neither_deepens_the_stack_nor_repeats(table):
    attributes = "".join(f" a{i}='>{i}'" for i in range(60000))
    texts = [f"<p{attributes}>end", "<a " * 100000, "<!-- " * 100000, "<script>" + "<" * 300000, "&" * 100000 + "&eacute"]
    assert column(table, texts, lambda c: markup.html_text(c, "")) == ["end", "", "", "", "&" * 100000 + "\xe9"]


def test_references_without_semicolon(table):
    texts = ["&eacutet&eacute &copyright &notin; &notit; &AMP;&AMP &#233x &#xE9g &alpha &sup1 &sup &frac123", "&lt&gt&amp;lt &ampamp;"]
    assert column(table, texts, markup.unescape) == ["\xe9t\xe9 \xa9right \u2209 \xacit; && \xe9x \xe9g &alpha \xb9 &sup \xbd3", "<>&lt &amp;"]
