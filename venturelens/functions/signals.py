"""Headcount, job, location and remote-work signals from page text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from venturelens import vocabulary as V
from venturelens.functions.text import any_of, let, string_array, strip

HUGE = 10**18


def _number(digits: Column) -> Column:
    """Digits as bigint; more than 18 of them count as one huge value, so range rules reject them."""
    short = F.regexp_replace(digits, "^0+", "")
    return (
        F.when(F.length(short) > 18, F.lit(HUGE))
        .when(short == "", F.lit(0).cast("bigint"))
        .otherwise(short.cast("bigint"))
    )


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def largest_in_range(low: Column, patterns: Sequence[str], lo: int, hi: int) -> Column:
    """Per pattern the largest number; the first pattern whose number is in range decides."""
    tops = [F.array_max(F.transform(_all(low, p, 1), _number)) for p in patterns]
    return F.coalesce(*[let(t, lambda n: F.when(n.between(lo, hi), n)) for t in tops])


def _first_range(low: Column, patterns: Sequence[str], lo: int, hi: int) -> Column:
    def one(p: str) -> Column:
        pairs = F.zip_with(
            _all(low, p, 1), _all(low, p, 2),
            lambda a, b: F.struct(_number(a).alias("lo"), _number(b).alias("hi")),
        )
        fits = F.filter(pairs, lambda x: (x["lo"] >= lo) & (x["lo"] < x["hi"]) & (x["hi"] <= hi))
        return F.get(fits, 0)

    return F.coalesce(*[one(p) for p in patterns])


def headcount(
    text: Column,
    patterns: Sequence[str] = V.HEADCOUNT_PATTERNS,
    ranges: Sequence[str] = V.HEADCOUNT_RANGE_PATTERNS,
    range_first: bool = False,
) -> Column:
    """struct(total, estimate, confidence): an exact count, else the middle of a range.

    ``range_first`` looks for ranges before exact counts ("50-100 employees" also fits the exact form).
    """

    def result(total: Column, estimate: Column, confidence: float) -> Column:
        return F.struct(
            total.cast("bigint").alias("total"),
            estimate.cast("string").alias("estimate"),
            F.lit(confidence).alias("confidence"),
        )

    def find(low: Column) -> Column:
        plus = F.when(F.contains(low, F.lit("+")), F.lit("+")).otherwise(F.lit(""))
        by_count = let(
            largest_in_range(low, patterns, V.HEADCOUNT_MIN, V.HEADCOUNT_MAX),
            lambda n: F.when(n.isNotNull(), result(n, F.concat(n.cast("string"), plus), 0.8)),
        )
        by_range = let(
            _first_range(low, ranges, V.HEADCOUNT_MIN, V.HEADCOUNT_MAX),
            lambda r: F.when(
                r.isNotNull(),
                result(
                    F.floor((r["lo"] + r["hi"]) / 2),
                    F.concat_ws("-", r["lo"].cast("string"), r["hi"].cast("string")),
                    0.6,
                ),
            ),
        )
        order = [by_range, by_count] if range_first else [by_count, by_range]
        return F.coalesce(*order, result(F.lit(None), F.lit(None), 0.0))

    return let(F.lower(F.coalesce(text, F.lit(""))), find)


def occurrences(low: Column, words: Sequence[str]) -> Column:
    """Sum over the words of their non-overlapping occurrences."""
    counts = [
        F.floor((F.length(low) - F.length(F.replace(low, F.lit(w), F.lit("")))) / len(w)) for w in words
    ]
    return reduce(lambda a, b: a + b, counts).cast("bigint")


def job_openings(
    text: Column,
    patterns: Sequence[str] = V.JOB_COUNT_PATTERNS,
    titles: Sequence[str] = V.JOB_TITLE_PATTERNS,
    list_item: str = V.JOB_LIST_ITEM_PATTERN,
    indicators: Sequence[str] = V.JOB_INDICATORS,
) -> Column:
    """struct(count, confidence): stated count, else distinct titles, list items, or indicator words."""
    cap = F.lit(V.JOBS_CAP).cast("bigint")

    def result(count: Column, confidence: float) -> Column:
        return F.struct(count.cast("bigint").alias("count"), F.lit(confidence).alias("confidence"))

    def counted(count: Column, confidence: float) -> Column:
        return let(count, lambda n: F.when(n > 0, result(F.least(n.cast("bigint"), cap), confidence)))

    def find(low: Column) -> Column:
        stated = largest_in_range(low, patterns, V.JOBS_MIN, V.JOBS_MAX)
        return F.coalesce(
            let(stated, lambda n: F.when(n.isNotNull(), result(n, 0.7))),
            counted(F.size(F.array_distinct(F.concat(*[_all(low, p, 0) for p in titles]))), 0.6),
            counted(F.regexp_count(low, F.lit(list_item)), 0.5),
            counted(F.floor(occurrences(low, indicators) / 2), 0.4),
            result(F.lit(None), 0.0),
        )

    return let(F.lower(F.coalesce(text, F.lit(""))), find)


def hiring_focus(text: Column, departments: Mapping[str, Sequence[str]] = V.DEPARTMENTS) -> Column:
    def hits(low: Column) -> Column:
        return F.array(*[F.when(any_of(low, words), F.lit(name)) for name, words in departments.items()])

    return F.filter(let(F.lower(F.coalesce(text, F.lit(""))), hits), lambda x: x.isNotNull())


def office_locations(
    text: Column, cities: Sequence[str] = V.CITIES, patterns: Sequence[str] = V.OFFICE_PATTERNS
) -> Column:
    """Known cities and named offices, distinct, sorted."""
    low = F.lower(text)
    known = F.transform(F.filter(string_array(cities), lambda c: F.contains(low, c)), F.initcap)
    named = F.concat(*[_all(text, p, 1) for p in patterns])
    named = F.filter(F.transform(named, strip), lambda x: F.length(x) > 2)
    return F.sort_array(F.array_distinct(F.concat(known, named)))


def remote_policy(text: Column, groups: Mapping[str, Sequence[str]] = V.REMOTE_POLICIES) -> Column:
    return let(
        F.lower(F.coalesce(text, F.lit(""))),
        lambda low: F.coalesce(*[F.when(any_of(low, words), F.lit(name)) for name, words in groups.items()]),
    )
