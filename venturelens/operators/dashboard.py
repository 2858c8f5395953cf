"""Dashboards from child tables or payload rows, company listings and the comparison of both generation paths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venturelens import schemas as S
from venturelens import vocabulary as V
from venturelens.functions import markdown as md
from venturelens.functions import urls
from venturelens.operators.records import SORT_KEYS
from venturelens.operators.skew import top_per_group, union_rows


def structured_dashboards(
    payloads: DataFrame, generated_at: Column | str, key: str = "company_id", newest: bool = True
) -> DataFrame:
    """(company_id, dashboard): the eight sections of every payload row.

    The growth section reads the latest snapshot by date, or the first of the list without ``newest``; visibility
    is the company's own over the latest entry of the payload list.
    """
    stamp = F.lit(generated_at) if isinstance(generated_at, str) else generated_at
    c = F.col("company_record")
    events, products = F.col("events"), F.col("products")
    snapshot = md.latest(F.col("snapshots")) if newest else F.get("snapshots", 0)
    seen = md.merged_visibility(c, md.latest(F.col("visibility")), "visibility" in payloads.schema["company_record"].dataType.names)
    bodies = [
        md.overview(c),
        md.business(c, products),
        md.funding(c, events),
        md.growth(c, events, F.col("_snapshot")),
        md.visibility(F.col("_seen")),
        md.risks(events),
        md.outlook(c),
        md.gaps(c, F.col("_seen"), md.named_customers(products)),
    ]
    title = F.coalesce(c["legal_name"], F.lit("Company"))
    return (
        payloads.withColumn("_snapshot", snapshot)
        .withColumn("_seen", seen)
        .select(key, md.compose(title, stamp, "Structured", bodies).alias("dashboard"))
    )


def event_sections(events: DataFrame, key: str = "company_id", order: Sequence[str] = SORT_KEYS["events"]) -> DataFrame:
    """``rounds, recent, risks`` per company: the lines of the funding, growth and risk sections in the events' order.

    Events become their lines before the shuffle; what belongs to no section isn't sent.
    """
    e = {c: F.col(c) for c in events.columns}
    kind = e["event_type"]
    line = {
        "rounds": F.when(kind == "funding", md.funding_line(e)),
        "recent": F.when(md.is_traction(e), md.traction_line(e)),
        "risks": F.when(F.lower(kind).isin(list(V.RISK_TYPES)), md.risk_line(e)),
    }
    rows = events.select(key, F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)]).alias("at"), *[x.alias(n) for n, x in line.items()])
    rows = rows.filter(F.coalesce(*line).isNotNull())
    # A null line makes no entry in collect_list.
    lists = [F.transform(F.sort_array(F.collect_list(F.when(F.col(n).isNotNull(), F.struct("at", F.col(n).alias("v"))))), lambda x: x["v"]).alias(n) for n in line]
    return rows.groupBy(key).agg(*lists)


def customer_names(products: DataFrame, key: str = "company_id", order: Sequence[str] = SORT_KEYS["products"]) -> DataFrame:
    """``customers`` per company: the named customers of its products in the products' order."""
    named = products.filter(F.size("reference_customers") > 0).select(key, F.struct(*order, F.col("reference_customers").alias("v")).alias("p"))
    return named.groupBy(key).agg(F.flatten(F.transform(F.sort_array(F.collect_list("p")), lambda x: x["v"])).alias("customers"))


def last_by_date(rows: DataFrame, name: str, key: str = "company_id", by: str = "as_of", newest: bool = True) -> DataFrame:
    """The dated row with the highest ``by`` per company as a struct (the lowest without ``newest``); one row leaves a map task per company."""
    dated = rows.filter(F.col(by).isNotNull()).select(key, F.struct(F.col(by).alias("at"), F.struct(*rows.columns).alias("v")).alias("x"))
    return dated.groupBy(key).agg((F.max("x") if newest else F.min("x"))["v"].alias(name))


def dashboard_rows(company: DataFrame, children: Mapping[str, DataFrame], key: str = "company_id", newest: bool = True) -> DataFrame:
    """One narrow row per company: the record, the sections' lines, the snapshot and the visibility that a dashboard shows.

    Each child table is aggregated by itself to what its sections need; no payload is assembled.
    """
    missing = {n: t for n, t in S.PROFILE.items() if n not in company.columns}
    profile = company.withColumns({n: F.lit(None).cast(t) for n, t in missing.items()})  # a plain company record lacks some fields
    record = profile.select(key, F.struct(*profile.columns).alias("company_record"))
    parts = [
        event_sections(children["events"], key),
        customer_names(children["products"], key),
        last_by_date(children["snapshots"], "snapshot", key, newest=newest),
        last_by_date(children["visibility"], "latest_visibility", key),
    ]
    for part in parts:
        record = record.join(part, key, "left")
    none = F.array().cast("array<string>")
    lists = [F.coalesce(n, none).alias(n) for n in ("rounds", "recent", "risks", "customers")]
    seen = md.merged_visibility(F.col("company_record"), F.col("latest_visibility"))
    return record.select(key, "company_record", *lists, "snapshot", seen.alias("seen"))


def section_texts(section: str | None = None) -> list[Column] | Column:
    """The eight sections of a row of ``dashboard_rows``, or the one whose name is given."""
    c = F.col("company_record")
    texts = {
        "overview": md.overview(c),
        "business": md.business_text(c, F.col("customers")),
        "funding": md.funding_text(c, F.col("rounds")),
        "growth": md.growth_text(c, md.traction_text(F.col("recent")), F.col("snapshot")),
        "visibility": md.visibility(F.col("seen")),
        "risks": md.risks_text(F.col("risks")),
        "outlook": md.outlook(c),
        "gaps": md.gaps(c, F.col("seen"), F.col("customers")),
    }
    return texts[section] if section else list(texts.values())


def dashboards(company: DataFrame, children: Mapping[str, DataFrame], generated_at: Column | str, key: str = "company_id", newest: bool = True) -> DataFrame:
    """(company_id, dashboard) from the typed tables, by aggregates per section."""
    stamp = F.lit(generated_at) if isinstance(generated_at, str) else generated_at
    title = F.coalesce(F.col("company_record.legal_name"), F.lit("Company"))
    return dashboard_rows(company, children, key, newest).select(key, md.compose(title, stamp, "Structured", section_texts()).alias("dashboard"))


def recent_funding(company: DataFrame, events: DataFrame, n: int = 3, key: str = "company_id", order: Sequence[str] = SORT_KEYS["events"]) -> DataFrame:
    """``company_id, section``: the last ``n`` funding events of each company; ``n`` rows of a company and salt leave a task."""
    last = top_per_group(events.filter(F.col("event_type") == "funding"), [key], [F.desc(c) for c in order], n, list(order), rank="_rank")
    e = {x: F.col(x) for x in events.columns}
    lines = last.select(key, F.struct((-F.col("_rank")).alias("at"), md.recent_funding_line(e).alias("v")).alias("x"))
    shown = lines.groupBy(key).agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["v"]).alias("_lines"))
    return company.select(key).join(shown, key, "left").select(key, md.recent_funding_text(F.coalesce("_lines", F.array().cast("array<string>"))).alias("section"))


def company_listing(seed: DataFrame, structured_ids: DataFrame, answered_slugs: DataFrame) -> DataFrame:
    """Companies with headquarters text, first category and two availability flags."""
    have_s = structured_ids.select("company_id").distinct().withColumn("_s", F.lit(True))
    have_r = answered_slugs.select("slug").distinct().withColumn("_r", F.lit(True))
    return (
        seed.withColumn("slug", urls.file_slug(F.col("company_name")))
        .join(have_s, "company_id", "left")
        .join(have_r, "slug", "left")
        .select(
            "company_id",
            "company_name",
            "founded_year",
            md.headquarters(F.col("hq_city"), F.col("hq_country")).alias("headquarters"),
            F.get("categories", 0).alias("industry"),
            F.coalesce("website", F.lit("")).alias("website"),
            F.col("_s").isNotNull().alias("structured_available"),
            F.col("_r").isNotNull().alias("rag_available"),
        )
    )


def first_id_by_name(seed: DataFrame, name: str = "company_name", id_: str = "company_id") -> DataFrame:
    """One id per name, the lowest where a name repeats."""
    return seed.groupBy(name).agg(F.min(id_).alias(id_))


def compare(seed: DataFrame, structured: DataFrame, answered: DataFrame) -> DataFrame:
    """Both dashboards side by side per company name; missing ones stay null."""
    return (
        first_id_by_name(seed)
        .join(structured.select("company_id", F.col("dashboard").alias("structured_dashboard")), "company_id", "left")
        .join(answered.select("company_name", F.col("dashboard").alias("rag_dashboard")), "company_name", "left")
        .withColumn(
            "comparison_available",
            F.col("structured_dashboard").isNotNull() & F.col("rag_dashboard").isNotNull(),
        )
    )


def two_tier(primary: DataFrame, local: DataFrame, key: str, value: str) -> DataFrame:
    """The primary store's value where it has one, else the local copy."""
    p = primary.select(key, F.col(value).alias("_p"))
    q = local.select(key, F.col(value).alias("_q"))
    return p.join(q, key, "full_outer").select(
        key,
        F.coalesce("_p", "_q").alias(value),
        F.when(F.col("_p").isNotNull(), "primary").otherwise("local").alias("tier"),
    )


def ui_table(listing: DataFrame) -> DataFrame:
    na = F.lit("N/A")
    return listing.select(
        F.col("company_name").alias("company"),
        F.coalesce(F.col("founded_year").cast("string"), na).alias("founded"),
        F.coalesce("headquarters", na).alias("headquarters"),
        F.coalesce("website", na).alias("website"),
        F.concat(
            F.col("company_name"), F.lit(" ("), F.coalesce("headquarters", na), F.lit(")")
        ).alias("label"),
    )


def find_dashboard_files(seed: DataFrame, files: DataFrame, key: str = "company_id", name: str = "company_name") -> DataFrame:
    """The first existing file among a company's name variants, with its text."""
    variants = seed.select(key, F.posexplode(md.name_variants(F.col(name))).alias("pos", "file_name"))
    return (
        variants.join(files.select("file_name", "text"), "file_name")
        .groupBy(key)
        .agg(F.min_by(F.struct("file_name", "text"), "pos").alias("_f"))
        .select(key, "_f.*")
    )


def response_rows(structured: DataFrame, answered: DataFrame, generated_at: str) -> DataFrame:
    """Dashboards of both paths in one layout; the chunk count exists for the retrieval path only."""
    s = structured.select(
        "company_name", F.lit("Structured").alias("pipeline"), "dashboard", F.lit(None).cast("bigint").alias("retrieved_chunks")
    )
    r = answered.select(
        "company_name", F.lit("RAG").alias("pipeline"), "dashboard", F.col("retrieved_chunks").cast("bigint")
    )
    return union_rows([s, r]).withColumn("generated_at", F.lit(generated_at))


def page_context(ids: DataFrame, pages: DataFrame, key: str = "company_name") -> DataFrame:
    """The about page of each company, or a placeholder row."""
    about = pages.filter(F.col("page_type") == "about").select(key, F.col("text").alias("_t"))
    low = F.lower(F.col(key))
    return ids.select(key).join(about, key, "left").select(
        key,
        F.when(F.col("_t").isNotNull(), F.concat(F.lit("https://"), low, F.lit(".com/about")))
        .otherwise(F.concat(F.lit("https://example.com/"), F.col(key)))
        .alias("source_url"),
        F.coalesce("_t", F.concat(F.lit("No data available for "), F.col(key))).alias("text"),
    )


