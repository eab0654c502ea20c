"""Text of markup, record headers and code blocks."""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# The content type a kept record must state, and the header key that carries the record id.
CONTENT_TYPE = "Content-Type: text/html; charset=UTF-8"
RECORD_KEY = "WARC-TREC-ID"

# The named character references of HTML 4, as Python's own table gives them, and the apostrophe; of them those that HTML
# knows without a semicolon too, and four in capitals.
BARE = {name: html5[name] for name in sorted(html5) if not name.endswith(";")}
NAMED = BARE | {name: chr(code) for name, code in sorted(name2codepoint.items())} | {"apos": "'"}

# Attributes of a tag: a quoted value may hold anything but its quote, and a quote that is not closed or begins no value is a letter like
# any other. All loops are possessive, so they neither go back nor deepen the stack, and each letter is passed once.
_ATTRIBUTES = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|["'=])*+"""
_COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\z))"
_RAW = r"(?i:<%(name)s(?:[\s/]%(attributes)s)?+>.*?(?:</%(name)s(?:[\s/][^>]*+)?+>|\z))"
_TAG = rf"</?[a-zA-Z]{_ATTRIBUTES}(?:>|\z)"
_OTHER = r"<[!?/][^>]*+(?:>|\z)"


def scanner(strip_scripts: bool = True) -> str:
    """All that is no text, as one ordered choice: comments, scripts and styles whole, tags, declarations. What is not closed runs to the end."""
    raw = [_RAW % {"name": name, "attributes": _ATTRIBUTES} for name in ("script", "style")] if strip_scripts else []
    return "(?s)" + "|".join([_COMMENT, *raw, _TAG, _OTHER])


def _reference_pattern() -> str:
    """Character references; the longest name counts, with its semicolon if it has one."""
    longest = lambda names: "|".join(sorted(names, key=lambda n: (-len(n), n)))
    return f"&#[0-9]++;?+|&#[xX][0-9A-Fa-f]++;?+|&(?:{longest(NAMED)});|&(?:{longest(BARE)})"


def _named_references() -> Column:
    spelled = {f"&{name};": char for name, char in NAMED.items()} | {f"&{name}": char for name, char in BARE.items()}
    return F.create_map(*[F.lit(x) for pair in spelled.items() for x in pair])


def _numeric_reference(ref: Column) -> Column:
    """``&#233;`` and ``&#xE9;``, with or without semicolon, to their character; null where ``ref`` is no valid numeric reference."""
    digits = F.regexp_extract(ref, r"^&#0*([0-9]{1,7});?$", 1)
    hex_digits = F.regexp_extract(ref, r"^&#[xX]0*([0-9A-Fa-f]{1,6});?$", 1)
    code = F.coalesce(
        F.when(digits != "", F.hex(digits.try_cast("bigint"))),
        F.when(hex_digits != "", hex_digits),
    )
    point = F.conv(code, 16, 10).try_cast("bigint")
    valid = (point > 0) & (point <= 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32"))


def unescape(text: Column) -> Column:
    """Replace character references in one left-to-right pass, so ``&amp;lt;`` becomes ``&lt;`` and not ``<``.

    Semicolons may be missing where HTML lets them: after numbers, and after the names it has known longest.
    """
    pieces = F.regexp_extract_all(text, F.lit(f"[^&]++|{_reference_pattern()}|&"), F.lit(0))
    named = _named_references()

    def decode(piece: Column) -> Column:
        return F.when(piece.startswith("&"), F.coalesce(named[piece], _numeric_reference(piece), piece)).otherwise(piece)

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, decode), "")).otherwise(text)


def tag_free(markup: Column, sep: str = " ", strip_scripts: bool = True) -> Column:
    """``html_text`` with its character references left as they are, in one pass over ``markup``."""
    return F.regexp_replace(markup, scanner(strip_scripts), sep)


def html_text(markup: Column, sep: str = " ", strip_scripts: bool = True) -> Column:
    """Text nodes of ``markup`` joined by ``sep``; comments never count as text.

    ``sep=""`` joins text nodes without a gap; ``strip_scripts=False`` keeps the source text of scripts and styles. Where the text is costly,
    ``tag_free`` and ``unescape`` in two selects keep the first from being computed for each use in the second.
    """
    return unescape(tag_free(markup, sep, strip_scripts))


def header_parts(text: Column, content_type: str = CONTENT_TYPE) -> Column:
    """Pieces of ``text`` around the content type line; exactly two pieces make a record usable."""
    return F.split(text, rf"\Q{content_type}\E", -1)


def record_id(headers: Column, key: str = RECORD_KEY) -> Column:
    """Value of the first header line that starts with ``key``: the piece between its first and second ``': '``, else null."""
    line = F.regexp_extract(headers, rf"(?m)^(\Q{key}\E[^\r\n]*)", 1)
    return F.nullif(F.get(F.split(line, ": ", -1), F.lit(1)), F.lit(""))


def strip_code_blocks(body: Column) -> Column:
    """Drop blocks from a line starting ``<!--`` to a line starting ``//-->`` and join the other lines with one space.

    Stray ``//-->`` lines go too, and an unclosed block runs to the end. An indented ``<!--`` opens nothing.
    """
    lines = F.regexp_replace(body, r"\r\n|[\r\x0B\x0C\x1C-\x1E\x85\x{2028}\x{2029}]", "\n")
    closing = r"^//-->[^\n]*(?:\n|\z)"
    kept = F.regexp_replace(lines, rf"(?smd)^<!--.*?(?:{closing}|\z)|{closing}", "")
    return F.translate(F.regexp_replace(kept, r"\n\z", ""), "\n", " ")
