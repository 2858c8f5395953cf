"""Seed enrichment: website and profile candidates, sectors, ids and coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venturelens import vocabulary as V
from venturelens.functions import urls
from venturelens.functions.text import any_of
from venturelens.operators.skew import keyed_join


def candidates(seed: DataFrame, key: str, urls_: Column) -> DataFrame:
    """(key, pos, url) rows of a candidate array."""
    return seed.select(key, F.posexplode(urls_).alias("pos", "url"))


def first_reachable(cands: DataFrame, status: DataFrame, key: str, ok: Column) -> DataFrame:
    """First candidate whose status passes ``ok``; companies without one are absent."""
    hits = keyed_join(cands, status.filter(ok).select("url", F.col("status")), ["url"])
    return hits.groupBy(key).agg(F.min_by("url", "pos").alias("url"))


def enrich_urls(
    seed: DataFrame,
    status: DataFrame,
    known_domains: Mapping[str, str] | DataFrame = V.KNOWN_DOMAINS,
    key: str = "company_id",
    name: str = "company_name",
) -> DataFrame:
    """Website (known domain, else first reachable, else null) and profile URL (first reachable, else first)."""
    site = first_reachable(
        candidates(seed, key, urls.website_candidates(F.col(name))), status, key, F.col("status") < 400
    ).withColumnRenamed("url", "_site")
    profile = first_reachable(
        candidates(seed, key, urls.network_candidates(F.col(name))), status, key, F.col("status") == 200
    ).withColumnRenamed("url", "_profile")
    base = with_known_domain(seed, known_domains, name).drop("website", "linkedin")
    return (
        base.join(site, key, "left")
        .join(profile, key, "left")
        .withColumn("website", F.coalesce("known_url", "_site"))
        .withColumn("linkedin", F.coalesce(F.col("_profile"), F.get(urls.network_candidates(F.col(name)), 0)))
        .drop("known_url", "_site", "_profile")
    )


def with_known_domain(
    seed: DataFrame, known_domains: Mapping[str, str] | DataFrame = V.KNOWN_DOMAINS, name: str = "company_name"
) -> DataFrame:
    """Adds ``known_url`` by squeezed name. A dict becomes a literal map; a table is joined by size."""
    squeezed = urls.squeezed_name(F.col(name))
    if isinstance(known_domains, DataFrame):
        table = known_domains.select(F.col("name").alias("_n"), F.col("domain").alias("_d"))
        joined = keyed_join(seed.withColumn("_n", squeezed), table, ["_n"], "left")
        return joined.withColumn("known_url", F.concat(F.lit("https://"), "_d")).drop("_n", "_d")
    if not known_domains:
        return seed.withColumn("known_url", F.lit(None).cast("string"))
    table = F.create_map(*[F.lit(x) for kv in known_domains.items() for x in kv])
    return seed.withColumn("known_url", F.concat(F.lit("https://"), F.try_element_at(table, squeezed)))


def sectors(
    description: Column,
    rules: Mapping[str, Sequence[str]] = V.SECTOR_RULES,
    default: str = V.DEFAULT_SECTOR,
    limit: int = 3,
) -> Column:
    """Sectors whose keyword is in the description, in rule order, at most ``limit``, else the default."""
    low = F.lower(F.coalesce(description, F.lit("")))
    hits = F.array(*[F.when(any_of(low, words), F.lit(kind)) for kind, words in rules.items()])
    kept = F.slice(F.filter(hits, lambda x: x.isNotNull()), 1, limit)
    return F.when(F.size(kept) == 0, F.array(F.lit(default))).otherwise(kept)


def backfill_profiles(seed: DataFrame, found: DataFrame, key: str = "company_id") -> DataFrame:
    """Profile URL set to what the homepage shows (or null); rows without a website keep theirs."""
    hits = found.select(key, F.col("linkedin").alias("_found"))
    no_site = F.coalesce(F.col("website"), F.lit("")) == ""
    return (
        seed.join(hits, key, "left")
        .withColumn("linkedin", F.when(no_site, F.col("linkedin")).otherwise(F.col("_found")))
        .drop("_found")
    )


def seed_rows(companies: DataFrame) -> DataFrame:
    """The nine seed columns with their defaults; a missing id is derived from the name."""
    empty = F.array().cast("array<string>")
    have = set(companies.columns)

    def col(name: str, kind: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast(kind)

    return companies.select(
        F.coalesce(col("company_id", "string"), urls.stable_id(F.col("company_name"))).alias("company_id"),
        F.coalesce(F.col("company_name"), F.lit("")).alias("company_name"),
        F.coalesce(col("website", "string"), F.lit("")).alias("website"),
        F.coalesce(col("linkedin", "string"), F.lit("")).alias("linkedin"),
        col("hq_city", "string").alias("hq_city"),
        col("hq_country", "string").alias("hq_country"),
        col("founded_year", "int").alias("founded_year"),
        F.coalesce(col("categories", "array<string>"), empty).alias("categories"),
        F.coalesce(col("related_companies", "array<string>"), empty).alias("related_companies"),
    )


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total and filled counts per column, as (field, total, filled) rows, in one pass."""

    def filled(name: str) -> Column:
        kind = df.schema[name].dataType.typeName()
        value = F.col(name)
        if kind == "array":
            return F.count_if(F.size(value) > 0)
        return F.count_if(value.isNotNull() & (value.cast("string") != ""))

    counts = df.agg(F.count(F.lit(1)).alias("total"), *[filled(c).alias(f"_{c}") for c in columns])
    rows = F.array(
        *[F.struct(F.lit(c).alias("field"), F.col("total").alias("total"), F.col(f"_{c}").alias("filled")) for c in columns]
    )
    return counts.select(F.inline(rows))
