"""HTML to text and links with regular expressions, all inside the JVM.

Every pattern is valid in Java and in RE2. The forms are exact on well-formed pages;
``operators.pages.parse_text`` is the parser form for pages where nesting matters.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from venturelens import vocabulary as V
from venturelens.functions.text import any_of, let, string_array, strip

HIDDEN_TAGS = ["script", "style"]
CHROME_TAGS = ["script", "style", "nav", "footer", "header", "iframe", "noscript"]
COMMENT = r"(?s)<!--.*?-->"
# A tag; quoted attribute values may hold '>'.
TAG = r"""<[/!]?[a-zA-Z][^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*>"""
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
ANCHOR = r"(?is)<a\b[^>]*?\bhref\s*=.*?</a\s*>"
HREF = r"""(?is)^<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
HREF_WITHIN = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""
ARIA = r"""(?is)^<a\b[^>]*?\baria-label\s*=\s*(?:"([^"]*)"|'([^']*)')"""
LD_JSON = r"(?is)<script\b[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script\s*>"


def block_pattern(tag: str) -> str:
    """A whole element; script and style run to the end of the page when never closed."""
    end = rf"(?:</{tag}\s*>|\z)" if tag in ("script", "style") else rf"</{tag}\s*>"
    return rf"(?is)<{tag}\b.*?{end}"


def inner_pattern(tag: str) -> str:
    return rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"


# All names of HTML 5 that end in a semicolon; some stand for two characters.
NAMED = {name[:-1]: chars for name, chars in html5.items() if name.endswith(";")}
# Names that also count without it, as the longest beginning of what follows the ampersand.
BARE = {name: chars for name, chars in html5.items() if not name.endswith(";")}


def decode_entities(text: Column, names: Mapping[str, str] = NAMED, bare: Mapping[str, str] = BARE) -> Column:
    """``&name;``, ``&#n;`` and ``&#xh;`` as characters, in one pass (``&amp;lt;`` gives ``&lt;``); numbers and old names also without semicolon."""
    # One literal each, folded to a constant map by the optimizer.
    table, beginnings = (F.from_json(F.lit(json.dumps(dict(x))), "map<string,string>") for x in (names, bare))
    lengths = sorted({len(x) for x in bare}, reverse=True)

    def decoded(piece: Column) -> Column:
        # Leading zeros don't count; what is no character gives the replacement character.
        dec = F.regexp_extract(piece, r"^#0*([0-9]+)", 1)
        short = F.when(F.length(dec).between(1, 9), F.hex(dec.cast("int"))).when(F.length(dec) > 9, F.lit("FFFFFFF"))
        code = F.coalesce(short, F.upper(F.regexp_extract(piece, r"^#[xX]0*([0-9a-fA-F]+)", 1)))

        def character(c: Column) -> Column:
            value = F.conv(c, 16, 10).cast("bigint")
            bad = (F.length(c) > 6) | (value > 0x10FFFF) | value.between(0xD800, 0xDFFF) | (value == 0)
            return F.when(F.length(c) > 0, F.when(bad, F.lit("\ufffd")).otherwise(F.decode(F.unhex(F.lpad(c, 8, "0")), "UTF-32")))

        numeric = let(code, character)
        named = F.try_element_at(table, F.regexp_extract(piece, r"^([A-Za-z][A-Za-z0-9]{1,31});", 1))
        after = F.substring(piece, F.instr(piece, ";") + 1, F.length(piece))
        by_number = F.concat(numeric, F.regexp_replace(piece, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", ""))
        shorter = [F.concat(F.try_element_at(beginnings, F.substring(piece, 1, n)), F.substring(piece, F.lit(n + 1), F.length(piece))) for n in lengths]
        old = F.when(F.rlike(piece, F.lit("^[A-Za-z]{2}")), F.coalesce(*shorter))
        by_name = F.coalesce(F.concat(named, after), old)
        return F.coalesce(F.when(F.startswith(piece, F.lit("#")), by_number).otherwise(by_name), F.concat(F.lit("&"), piece))

    def whole(pieces: Column) -> Column:
        tail = F.transform(F.slice(pieces, 2, 2147483646), decoded)
        return F.array_join(F.concat(F.slice(pieces, 1, 1), tail), "")

    return let(text, lambda t: F.when(F.contains(t, F.lit("&")), let(F.split(t, "&", -1), whole)).otherwise(t))


def drop_blocks(html: Column, tags: Sequence[str], gap: str) -> Column:
    out = F.regexp_replace(html, COMMENT, gap)
    for tag in tags:
        out = F.regexp_replace(out, block_pattern(tag), gap)
    return out


def visible_text(html: Column, entities: Mapping[str, str] = NAMED) -> Column:
    """Text without script and style, cut at line breaks and double blanks into stripped lines."""
    raw = F.regexp_replace(drop_blocks(html, HIDDEN_TAGS, ""), TAG, "")
    lines = F.transform(F.split(decode_entities(raw, entities), f"{LINE_BREAK}|  ", -1), strip)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def main_text(html: Column, entities: Mapping[str, str] = NAMED) -> Column:
    """Text without page chrome, one text node per line, lines of more than three characters."""
    raw = F.regexp_replace(drop_blocks(html, CHROME_TAGS, "\n"), TAG, "\n")
    lines = F.transform(F.split(decode_entities(raw, entities), LINE_BREAK, -1), strip)
    return F.array_join(F.filter(lines, lambda x: F.length(x) > 3), "\n")


def inline_text(html: Column, entities: Mapping[str, str] = NAMED) -> Column:
    return strip(decode_entities(F.regexp_replace(html, TAG, ""), entities))


def element(html: Column, tag: str) -> Column:
    """Inner HTML of the first ``tag`` element, empty if there is none."""
    return F.regexp_extract(html, inner_pattern(tag), 1)


def _first_group(text: Column, pattern: str, groups: int) -> Column:
    found = [F.regexp_extract(text, pattern, i) for i in range(1, groups + 1)]
    return F.concat(*found)


def anchors(html: Column) -> Column:
    """array<struct(href, label, aria)> of the ``a[href]`` elements, in page order."""
    return F.transform(
        F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(0)),
        lambda a: F.struct(
            strip(decode_entities(_first_group(a, HREF, 3))).alias("href"),
            inline_text(a).alias("label"),
            _first_group(a, ARIA, 2).alias("aria"),
        ),
    )


def link_types(context: Column, rules: Mapping[str, Sequence[str]] = V.LINK_RULES) -> Column:
    """Every type whose keyword is in ``context``, in rule order (one link may have several)."""
    hits = [F.when(any_of(context, words), F.lit(kind)) for kind, words in rules.items()]
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def first_pattern(text: Column, patterns: Sequence[str], group: int = 1) -> Column:
    """The group of the first pattern that matches, stripped; null if none does."""
    return F.coalesce(
        *[
            F.when(F.regexp_like(text, F.lit(p)), strip(F.regexp_extract(text, p, group)))
            for p in patterns
        ]
    )


def founded_year(text: Column, patterns: Sequence[str] = V.FOUNDED_PATTERNS, low: int = 1900, high: int = 2025) -> Column:
    def one(p: str) -> Column:
        year = F.try_to_number(F.regexp_extract(text, p, 1), F.lit("9999")).cast("int")
        return let(year, lambda y: F.when(y.between(low, high), y))

    return F.coalesce(*[one(p) for p in patterns])


def categories(text: Column, words: Sequence[str] = V.CATEGORY_WORDS, limit: int = 5) -> Column:
    """Category words in the text, title-cased, sorted, at most ``limit``."""
    low = F.lower(text)
    found = F.filter(string_array(words), lambda w: F.contains(low, w))
    return F.slice(F.sort_array(F.array_distinct(F.transform(found, F.initcap))), 1, limit)
