"""L: run reports and incremental refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from venturelens.operators import runs
from workload.common import query, table, text_table

RESULTS = """
r_ as (select cast(user_id as varchar) as company, strftime(ts, '%Y-%m-%d') as date, case event_type when 'error' then 'failed' when 'view' then 'skipped' else 'success' end as status, event_id, ts from events)
"""


def results(spark, sf):
    e = table(spark, sf, "events")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("success")
    return e.select(
        F.col("user_id").cast("string").alias("company"), F.date_format("ts", "yyyy-MM-dd").alias("date"), status.alias("status"), "event_id", "ts"
    )


@query(
    "l01_run_counts",
    f"with {RESULTS} select cast(count(*) as bigint) as total, cast(count(*) filter (where status = 'success') as bigint) as succeeded, cast(count(*) filter (where status = 'failed') as bigint) as failed from r_",
)
def l01(spark, sf):
    return runs.run_counts(results(spark, sf))


@query(
    "l02_daily_report",
    f"""with {RESULTS}, u as (select date, count(*) as n from r_ where status = 'success' and event_id % 2 = 0 group by date)
    select 'Daily Refresh' as report, r_.date, cast(count(*) filter (where r_.status = 'success') as bigint) as companies_refreshed, cast(count(*) filter (where r_.status = 'failed') as bigint) as companies_failed,
    cast(coalesce(any_value(u.n), 0) as bigint) as vector_db_updated, 'completed' as status from r_ left join u on r_.date = u.date group by r_.date""",
)
def l02(spark, sf):
    r = results(spark, sf)
    return runs.daily_report(r, r.filter((F.col("status") == "success") & (F.col("event_id") % 2 == 0)))


@query("l02_failed_items", f"with {RESULTS} select distinct date, company from r_ where status = 'failed'")
def l02_failed(spark, sf):
    return runs.failed_items(results(spark, sf))


@query(
    "l03_full_report",
    f"""with {RESULTS} select 'Full Ingestion' as report, cast(count(*) as bigint) as total_companies, cast(count(*) filter (where status = 'success') as bigint) as scraped_successfully,
    cast(count(*) filter (where status = 'failed') as bigint) as scrape_failures, cast((select count(*) from labels) as bigint) as indexed_to_vector_db, 'completed' as run_status from r_""",
)
def l03(spark, sf):
    return runs.full_report(results(spark, sf), table(spark, sf, "labels"))


@query(
    "l04_batch_summary",
    """with s as (select source, case when sum(case when lang = 'en' then 1 else 0 end) > 30 then 'success' else 'failed' end as status from documents group by source)
    select cast(count(*) as bigint) as total, cast(count(*) filter (where status = 'success') as bigint) as successful, cast(count(*) filter (where status <> 'success') as bigint) as failed from s""",
)
def l04(spark, sf):
    d = table(spark, sf, "documents")
    stats = d.groupBy("source").agg(F.when(F.count_if(F.col("lang") == "en") > 30, "success").otherwise("failed").alias("status"))
    return runs.batch_summary(stats)


@query("l05_successful_only", "select doc_id, source from documents where doc_id in (select doc_id from labels where quality = 1)")
def l05(spark, sf):
    r = table(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, "success").otherwise("failed").alias("status"))
    return runs.successful_only(table(spark, sf, "documents").select("doc_id", "source"), r, "doc_id")


@query(
    "l06_changed_pages",
    """with seen as (select distinct lang, sha256(text) as text_hash from documents where doc_id % 2 = 0)
    select doc_id, lang, sha256(text) as text_hash from documents where (lang, sha256(text)) not in (select (lang, text_hash) from seen)""",
)
def l06(spark, sf):
    """Even documents are indexed already; copies of them among the rest are not new."""
    d = text_table(spark, sf, "documents", "doc_id").select("doc_id", "lang", "text")
    seen = runs.with_hash(d.filter(F.col("doc_id") % 2 == 0)).select("lang", "text_hash").distinct()
    return runs.changed_pages(d, seen, ["lang"]).select("doc_id", "lang", "text_hash")


@query(
    "l07_guarded",
    """with p as (select event_id, case when event_id % 5 = 0 then 'broken {' || props else props end as props, event_id % 5 = 0 as bad from events)
    select event_id, case when bad then '-' else json_extract_string(props, '$.k') end as k, case when bad then 'unreadable' else '-' end as error from p""",
)
def l07(spark, sf):
    e = table(spark, sf, "events")
    props = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("broken {"), "props")).otherwise(F.col("props"))
    one = runs.guarded(F.try_variant_get(F.try_parse_json(props), "$.k", "string"), "unreadable")
    rows = e.select("event_id", one.alias("r"))
    return rows.select("event_id", F.coalesce("r.value", F.lit("-")).alias("k"), F.coalesce("r.error", F.lit("-")).alias("error"))


@query(
    "l08_latest_per_key",
    f"with {RESULTS} select company, date, status, event_id from (select *, row_number() over (partition by company order by ts desc, event_id desc) as n from r_) where n = 1",
)
def l08(spark, sf):
    return runs.latest_per_key(results(spark, sf), "company", ["ts", "event_id"]).select("company", "date", "status", "event_id")


@query(
    "l09_indexed_companies",
    f"""with {RESULTS}, p as (select distinct cast(doc_id as varchar) as company from documents where lang = 'en')
    select cast(count(*) as bigint) as companies_indexed from (select distinct company from r_ where status = 'success') s where company in (select company from p)""",
)
def l09(spark, sf):
    pages = table(spark, sf, "documents").filter(F.col("lang") == "en").select(F.col("doc_id").cast("string").alias("company"))
    return runs.indexed_companies(results(spark, sf), pages).agg(F.count(F.lit(1)).alias("companies_indexed"))
