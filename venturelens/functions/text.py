"""Sentence selection, truncation and per-page-type text rules as column expressions."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from venturelens import vocabulary as V

# The characters Python's str.strip() removes, as text and as a class valid in Java and RE2.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + (
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def string_array(words: Sequence[str]) -> Column:
    """A literal array (one split of one literal, folded to a constant by the optimizer)."""
    if not words:
        return F.array().cast("array<string>")
    return F.split(F.lit("\x1f".join(words)), "\x1f")


def any_of(text: Column, words: Sequence[str]) -> Column:
    """True where one of ``words`` is a substring (case as given)."""
    if not words:
        return F.lit(False)
    if len(words) == 1:
        return F.contains(text, F.lit(words[0]))
    return F.exists(string_array(words), lambda w: F.contains(text, w))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, also where ``body`` uses it several times.

    Conditional branches are outside common-subexpression elimination, so a long expression
    repeated in ``when`` tests would otherwise run again for each use.
    """
    return F.get(F.transform(F.array(value), body), 0)


def keyword_sentences(text: Column, words: Sequence[str] | Column, limit: int | Column = 10) -> Column:
    """Sentences holding a keyword, the first ``limit`` of them, as ``a. b.``; else an empty string."""
    if not isinstance(words, Column):
        words = string_array([w.lower() for w in words])
    sentences = F.transform(
        F.split(F.coalesce(text, F.lit("")), r"[.!?]+", -1),
        lambda s: F.struct(s.alias("raw"), F.lower(s).alias("low")),
    )
    hits = F.filter(sentences, lambda s: F.exists(words, lambda w: F.contains(s["low"], w)))
    kept = F.filter(F.transform(hits, lambda s: strip(s["raw"])), lambda s: s != "")
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    closed = F.transform(F.slice(kept, F.lit(1), limit), lambda s: F.concat(s, F.lit(".")))
    return F.array_join(closed, " ")


def cut_at_sentence(text: Column, n: int | Column) -> Column:
    """The first ``n`` characters, back to the last full stop in them; ``...`` if there is none."""
    n = n if isinstance(n, Column) else F.lit(n)

    def shorten(head: Column) -> Column:
        end = n + 1 - F.instr(F.reverse(head), ".")
        return F.when((end > 1) & (end <= n), F.substring(head, F.lit(1), end)).otherwise(
            F.concat(head, F.lit("..."))
        )

    return F.when(F.length(text) <= n, text).otherwise(let(F.substring(text, F.lit(1), n), shorten))


RULES, OTHER_RULE = V.PAGE_RULES, V.OTHER_PAGE_RULE
WORD_LISTS = {
    "funding": V.FUNDING_WORDS,
    "headcount": V.HEADCOUNT_WORDS,
    "location": V.LOCATION_WORDS,
    "product": V.PRODUCT_WORDS,
    "customer": V.CUSTOMER_WORDS,
    "leadership": V.LEADERSHIP_WORDS,
}
_RULE_TYPE = "struct<cut:int,both:boolean,picks:array<struct<label:string,words:array<string>,n:int>>>"


def _rule_json(rule: Mapping, lists: Mapping[str, Sequence[str]]) -> dict:
    picks = [
        {"label": label, "words": [w.lower() for w in lists[name]], "n": n}
        for label, name, n in rule.get("picks", [])
    ]
    return {"cut": rule["cut"], "both": rule.get("both", False), "picks": picks}


def selected_text(
    page_type: Column,
    text: Column,
    words: Mapping[str, Sequence[str]] | None = None,
    rules: Mapping[str, Mapping] = RULES,
    other: Mapping = OTHER_RULE,
) -> Column:
    """The text kept by the rule of the row's page type.

    The rules are one literal table looked up by page type, so the plan holds a single
    expression however many types there are. ``words`` replaces word lists by name.
    """
    lists = {**WORD_LISTS, **(words or {})}
    table = {kind: _rule_json(rule, lists) for kind, rule in rules.items()}
    known = F.from_json(F.lit(json.dumps(table)), f"map<string,{_RULE_TYPE}>")
    default = F.from_json(F.lit(json.dumps(_rule_json(other, lists))), _RULE_TYPE)

    def apply(rule: Column) -> Column:
        picks = F.transform(
            rule["picks"],
            lambda p: let(
                keyword_sentences(text, p["words"], p["n"]),
                lambda s: F.when(s != "", F.concat(p["label"], s)),
            ),
        )
        head = cut_at_sentence(text, rule["cut"])

        def combine(found: Column) -> Column:
            return (
                F.when(rule["both"], F.concat_ws("\n\n", head, found))
                .when(F.size(found) > 0, F.concat_ws("\n\n", found))
                .otherwise(head)
            )

        return let(F.filter(picks, lambda x: x.isNotNull()), combine)

    return let(F.coalesce(F.try_element_at(known, page_type), default), apply)


def rule_text(page_type: str, text: Column, words: Mapping[str, Sequence[str]] | None = None) -> Column:
    """The rule of one page type applied to every row."""
    return selected_text(F.lit(page_type), text, words)


def token_estimate(chars: Column) -> Column:
    """A token is taken as four characters."""
    return F.floor(chars / 4).cast("bigint")


def redact_contacts(text: Column, email: str | None = None, phone: str | None = None) -> Column:
    """E-mail addresses and phone numbers replaced by a note."""
    cleaned = F.regexp_replace(text, email or EMAIL, "[email removed]")
    return F.regexp_replace(cleaned, phone or PHONE, "[phone removed]")


EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
PHONE = r"\+?\d{1,3}[ .\-]\(?\d{2,4}\)?[ .\-]\d{3,4}(?:[ .\-]\d{2,4})?"
