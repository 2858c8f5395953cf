"""Hiring snapshots per company and repository-visibility rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venturelens import vocabulary as V
from venturelens.functions import signals as sg
from venturelens.functions import urls
from venturelens.operators.skew import keyed_join


def page_texts(pages: DataFrame, types: list[str], key: str = "company_id", tie: str = "source_url") -> DataFrame:
    """One row per company with the text of each page type as a column (empty if missing)."""
    order = F.struct(F.coalesce(F.col(tie), F.lit("")), F.xxhash64("text"))  # a page without URL is still a page
    picks = [
        F.coalesce(
            F.min_by(F.when(F.col("page_type") == t, F.col("text")), F.when(F.col("page_type") == t, order)),
            F.lit(""),
        ).alias(t)
        for t in types
    ]
    return pages.filter(F.col("page_type").isin(types)).groupBy(key).agg(*picks)


def hiring_snapshots(
    pages: DataFrame,
    key: str = "company_id",
    tie: str = "source_url",
    headcount: dict | None = None,
    jobs: dict | None = None,
    departments: dict | None = None,
    cities: list[str] | None = None,
    policies: dict | None = None,
) -> DataFrame:
    """Headcount, openings, focus, locations and remote policy; rows without any number are dropped."""
    texts = page_texts(pages, V.SNAPSHOT_PAGE_TYPES, key, tie)
    people = F.concat_ws(" ", "about", "homepage", "team")
    found = F.struct(
        sg.headcount(people, **(headcount or {})).alias("h"),
        sg.job_openings(F.col("careers"), **(jobs or {})).alias("j"),
    )
    # A generated row or none, so that the patterns run once and not again in a filter.
    any_number = F.filter(
        F.array(found),
        lambda x: (F.coalesce(x["h"]["total"], F.lit(0)) > 0)
        | x["h"]["estimate"].isNotNull()
        | (F.coalesce(x["j"]["count"], F.lit(0)) > 0),
    )
    rows = texts.select("*", F.explode(any_number).alias("_f"))
    return rows.select(
        key,
        F.col("_f.h.total").alias("headcount_total"),
        F.col("_f.h.estimate").alias("headcount_estimate"),
        F.col("_f.j.count").alias("job_openings_count"),
        sg.hiring_focus(F.col("careers"), departments or V.DEPARTMENTS).alias("hiring_focus"),
        sg.office_locations(F.concat_ws(" ", people, F.col("careers")), cities or V.CITIES).alias(
            "office_locations"
        ),
        sg.remote_policy(F.col("careers"), policies or V.REMOTE_POLICIES).alias("remote_policy"),
        F.greatest("_f.h.confidence", "_f.j.confidence").alias("confidence"),
        F.lit(V.SCHEMA_VERSION).alias("schema_version"),
    )


def snapshot_provenance(snapshots: DataFrame, pages: DataFrame, key: str = "company_id") -> DataFrame:
    """Adds one provenance struct per non-empty page used, in page-type order."""
    used = pages.filter(
        F.col("page_type").isin(V.SNAPSHOT_PAGE_TYPES)
        & (F.length("text") > 0)
        & F.col("source_url").isNotNull()
    )
    entries = []
    for kind in V.SNAPSHOT_PAGE_TYPES:
        is_kind = F.col("page_type") == kind
        entries.append(
            F.min_by(
                F.when(
                    is_kind,
                    F.struct(
                        "source_url",
                        "crawled_at",
                        F.lit(f"Extracted from {kind} page").alias("snippet"),
                    ),
                ),
                F.when(is_kind, F.col("source_url")),
            )
        )
    found = used.groupBy(key).agg(
        F.filter(F.array(*entries), lambda x: x.isNotNull()).alias("provenance")
    )
    empty = F.array().cast("array<struct<source_url:string,crawled_at:string,snippet:string>>")
    return snapshots.join(found, key, "left").withColumn("provenance", F.coalesce("provenance", empty))


def repo_urls(pages: DataFrame, key: str = "company_id", pattern: str = V.REPO_URL_PATTERN, prefix: str = "https://github.com/") -> DataFrame:
    """Distinct repository URLs named in a company's page text."""
    hits = F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)))
    return (
        pages.select(key, F.explode(hits).alias("_m"))
        .select(key, F.concat(F.lit(prefix), F.col("_m")).alias("repo_url"))
        .distinct()
    )


def repo_candidates(found: DataFrame, key: str = "company_id", repo_host: str = V.REPO_HOST) -> DataFrame:
    """Owner and repository to look up; an owner-only URL gives five names in order of preference."""
    owner, repo = urls.repo_owner(F.col("repo_url"), repo_host), urls.repo_name(F.col("repo_url"), repo_host)
    parsed = found.withColumn("owner", owner).withColumn("_repo", repo).filter(F.col("owner").isNotNull())
    guesses = F.array(*[F.replace(F.lit(g), F.lit("{owner}"), F.col("owner")) if "{owner}" in g else F.lit(g) for g in V.REPO_GUESSES])
    names = F.when(F.col("_repo") == "", guesses).otherwise(F.array("_repo"))
    return parsed.select(key, "repo_url", "owner", F.posexplode(names).alias("pos", "repo"))


def repo_metrics(api: DataFrame) -> DataFrame:
    """Typed metrics of the successful API answers, with the counts' and lists' defaults."""
    from venturelens.schemas import REPO_BODY

    zero = F.lit(0).cast("bigint")
    return (
        api.filter(F.col("status") == 200)
        .withColumn("_b", F.from_json("body", REPO_BODY))
        .select(
            "owner",
            "repo",
            F.coalesce("_b.stargazers_count", zero).alias("stars"),
            F.coalesce("_b.forks_count", zero).alias("forks"),
            F.coalesce("_b.watchers_count", zero).alias("watchers"),
            F.coalesce("_b.open_issues_count", zero).alias("open_issues"),
            F.col("_b.created_at").alias("created_at"),
            F.col("_b.updated_at").alias("updated_at"),
            F.col("_b.pushed_at").alias("pushed_at"),
            F.col("_b.language").alias("language"),
            F.col("_b.description").alias("description"),
            F.col("_b.homepage").alias("homepage"),
            F.coalesce("_b.topics", F.array().cast("array<string>")).alias("topics"),
            F.col("_b.license.name").alias("license"),
            F.coalesce("_b.archived", F.lit(False)).alias("archived"),
            F.coalesce("_b.disabled", F.lit(False)).alias("disabled"),
        )
    )


def contributors(link_header: Column, body: Column) -> Column:
    """Last page number of a paged answer, else the number of entries in the body."""
    last = F.regexp_extract(F.coalesce(link_header, F.lit("")), r'page=(\d+)>; rel="last"', 1)
    return F.when(last != "", last.cast("bigint")).otherwise(F.json_array_length(body).cast("bigint"))


def with_contributors(metrics: DataFrame, answers: DataFrame) -> DataFrame:
    """Repository metrics with ``contributors`` from the answers of the contributor call (null if it failed)."""
    counts = answers.filter(F.col("status") == 200).select(
        "owner", "repo", contributors(F.col("link_header"), F.col("body")).alias("contributors")
    )
    return metrics.join(counts, ["owner", "repo"], "left")


def first_found_repo(candidates: DataFrame, metrics: DataFrame, key: str = "company_id") -> DataFrame:
    """Per mentioned URL the first candidate the API knows, with its metrics."""
    joined = keyed_join(candidates, metrics, ["owner", "repo"])
    fields = [c for c in metrics.columns if c not in ("owner", "repo")]
    best = joined.groupBy(key, "repo_url").agg(
        F.min_by(F.struct("owner", "repo", *fields), F.col("pos")).alias("_hit")
    )
    return best.select(key, F.col("repo_url").alias("mentioned_url"), "_hit.*").withColumn(
        "repo_url", F.concat_ws("/", F.lit("https://github.com"), "owner", "repo")
    )


def visibility_rows(repos: DataFrame, key: str = "company_id") -> DataFrame:
    """The repository with most stars of each company (equal stars: lowest URL)."""
    best = repos.groupBy(key).agg(
        F.min_by(
            F.struct("repo_url", "stars", "forks", "contributors", "language", "topics", "pushed_at"),
            F.struct((-F.col("stars")).alias("s"), F.col("repo_url").alias("u")),
        ).alias("b")
    )
    return best.select(
        key,
        F.col("b.repo_url").alias("github_url"),
        F.col("b.stars").alias("github_stars"),
        F.col("b.forks").alias("github_forks"),
        F.col("b.contributors").alias("github_contributors"),
        F.col("b.language").alias("github_language"),
        F.col("b.topics").alias("github_topics"),
        F.col("b.pushed_at").alias("github_updated_at"),
    )
