"""A and B: sources and sinks. Round trips write below the session's shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F


from venturelens.operators import records
from venturelens.plans.refresh import STORE, marked_chunks, refresh_store
from venturelens.session import scratch_path
from venturelens.sources import readers, writers
from venturelens.streaming.refresh import start_refresh
from workload.common import PAGES_CTE, company_pages, query, sql_strip, table, text_table
from workload.dashboards import PAY, child_tables, company_table, payloads
from workload.retrieval import vectors
from workload.seed import names


def part_seed(spark, sf):
    return names(spark, sf).select(
        F.col("company_id").cast("string").alias("company_id"),
        "company_name",
        F.lit(None).cast("string").alias("legal_name"),
        F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit("https://s"), F.col("p_partkey").cast("string"), F.lit(".test"))).alias("website"),
        (F.lit(1980) + F.col("p_size")).alias("founded_year"),
        F.array("p_type").alias("categories"),
    )


@query(
    "a01_read_seed",
    """select cast(p_partkey as varchar) as company_id, p_name || case p_partkey % 4 when 0 then ' AI' when 1 then ' Labs' when 2 then ' Co. Inc' else '' end as company_name,
    coalesce(case when p_partkey % 3 <> 0 then 'https://s' || p_partkey || '.test' end, '-') as website, cast(1980 + p_size as varchar) as founded_year, p_type as categories from part""",
)
def a01(spark, sf):
    """Seed lists of up to 50 companies, array and object form in turn, written and read back."""
    path = scratch_path(spark, "seed")
    lists = part_seed(spark, sf).withColumn("list_no", F.floor(F.col("company_id").cast("bigint") / 50)).groupBy("list_no").agg(
        F.to_json(F.collect_list(F.struct("company_id", "company_name", "website", "founded_year", "categories"))).alias("j")
    )
    body = F.when(F.col("list_no") % 2 == 0, F.col("j")).otherwise(F.concat(F.lit('{"companies": '), "j", F.lit("}")))
    lists.select("list_no", body.alias("value")).repartition("list_no").write.partitionBy("list_no").text(path)
    return readers.read_seed(spark, path).select(
        "company_id",
        "company_name",
        F.coalesce("website", F.lit("-")).alias("website"),
        F.col("founded_year").cast("string").alias("founded_year"),
        F.array_join("categories", ",").alias("categories"),
    )


@query("a02_page_files", f"with {PAGES_CTE} select company_id, page_type, text from pages_ where text <> ''")
def a02(spark, sf):
    """Pages written as one text file each, by company and page type, and read back whole, batch after batch of files."""
    path, stored = scratch_path(spark, "page-files"), scratch_path(spark, "page-table")
    pages = company_pages(spark, sf).filter(F.col("text") != "").select("company_id", "page_type", "text")
    pages.limit(0).write.parquet(stored)
    for folder in writers.write_page_files(pages, path):
        files = readers.read_page_files(spark, folder, page_types=None, layout=readers.PARTITION_LAYOUT)
        texts = files.select("company_id", "page_type", F.regexp_replace("text", "\x01$", "").alias("text"))
        texts.coalesce(writers.PAGE_FILE_PARTS).write.mode("append").parquet(stored)
    return spark.read.schema(pages.schema).parquet(stored)


@query("a03_long_texts", f"select doc_id, text from documents where length({sql_strip('text')}) >= 400")
def a03(spark, sf):
    return readers.long_texts(text_table(spark, sf, "documents", "doc_id").select("doc_id", "text"), 400)


@query(
    "a04_company_objects",
    """with p as (select doc_id, case doc_id % 4 when 0 then source || '/' || doc_id || '.txt' when 1 then source || '/' when 2 then 'seed.json' else 'root' || doc_id || '.txt' end as path from documents)
    select doc_id, path from p where doc_id % 4 = 0""",
)
def a04(spark, sf):
    d = table(spark, sf, "documents")
    k = F.col("doc_id")
    text = k.cast("string")
    path = (
        F.when(k % 4 == 0, F.concat("source", F.lit("/"), text, F.lit(".txt")))
        .when(k % 4 == 1, F.concat("source", F.lit("/")))
        .when(k % 4 == 2, F.lit("seed.json"))
        .otherwise(F.concat(F.lit("root"), text, F.lit(".txt")))
    )
    return readers.company_objects(d.select("doc_id", path.alias("path")))


@query("a05_subset", "select doc_id, source from documents where source in ('src1', 'src7', 'src19')")
def a05(spark, sf):
    return readers.subset(table(spark, sf, "documents").select("doc_id", "source"), " src1,, src7 ,src19,", key="source")


@query(
    "a05_subset_by_table",
    "select o_orderkey, o_custkey from orders where o_custkey in (select s_suppkey * 2 from supplier) or o_custkey in (select s_suppkey * 3 + 1 from supplier)",
)
def a05_table(spark, sf):
    s = table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    lists = s.select(F.concat_ws(" , ", (k * 2).cast("string"), F.lit(""), (k * 3 + 1).cast("string")).alias("ids"))
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("c"))
    return readers.subset_by(o, lists, "c").select("o_orderkey", F.col("c").cast("bigint").alias("o_custkey"))


@query(
    "a06_company_pages",
    f"with {PAGES_CTE} select company_id, page_type, text from pages_ where company_id = 'c5' and doc_id % 2 = 1",
)
def a06(spark, sf):
    """One company's pages of one run date: only that date's folder is read."""
    path = scratch_path(spark, "pages")
    dated = company_pages(spark, sf).withColumn(
        "run_date", F.when(F.col("doc_id") % 2 == 0, F.lit("2025-01-01")).otherwise(F.lit("2025-01-02")).cast("date")
    )
    writers.write_pages(dated, path)
    return readers.read_pages(spark, path, "2025-01-02", "c5").select("company_id", "page_type", "text")


@query(
    "a07_read_crawl_metadata",
    """select cast(doc_id as varchar) as company_id, lang as page_type, 'https://m.test/' || doc_id as source_url, '2025-01-01' as crawled_at, 'success' as status, '-' as text_length from documents where doc_id % 2 = 0
    union all select cast(doc_id as varchar), lang, 'https://p.test/' || doc_id, '2025-01-02', 'success', cast(length(text) as varchar) from documents where doc_id % 2 = 1
    union all select cast(doc_id as varchar), 'team', null, '2025-01-02', 'failed', '-' from documents where doc_id % 2 = 1""",
)
def a07(spark, sf):
    """Both metadata layouts, written as JSON lines and read back."""
    path = scratch_path(spark, "metadata")
    d = table(spark, sf, "documents")
    k = F.col("doc_id").cast("string")
    by_url = d.filter(F.col("doc_id") % 2 == 0).select(
        k.alias("company_id"),
        F.lit("2025-01-01").alias("timestamp"),
        F.create_map("lang", F.concat(F.lit("https://m.test/"), k)).alias("success"),
    )
    page = "struct<url:string,status:string,text_length:int>"
    done = F.struct(F.concat(F.lit("https://p.test/"), k).alias("url"), F.lit("success").alias("status"), F.length("text").alias("text_length")).cast(page)
    missing = F.struct(F.lit(None).alias("url"), F.lit("failed").alias("status"), F.lit(None).alias("text_length")).cast(page)
    by_page = d.filter(F.col("doc_id") % 2 == 1).select(
        k.alias("company_id"), F.lit("2025-01-02").alias("crawled_at"), F.create_map("lang", done, F.lit("team"), missing).alias("pages")
    )
    by_url.write.json(path)
    by_page.write.mode("append").json(path)
    rows = readers.read_crawl_metadata(spark, path, files="*.json", multi_line=False)
    return rows.withColumn("text_length", F.coalesce(F.col("text_length").cast("string"), F.lit("-")))


@query(
    "a09_read_records",
    f"with {PAY} select company_id, legal_name, cast(n_events as bigint) as n_events, cast(n_products as bigint) as n_products from pay_",
)
def a09(spark, sf):
    path = scratch_path(spark, "structured")
    rows = payloads(spark, sf).select(F.col("company_record").alias("company"), "events", "products", "snapshots", "visibility")
    writers.write_records(rows, path)
    return readers.read_records(spark, path, file_per_company=False).select(
        "company_id",
        F.col("company.legal_name").alias("legal_name"),
        F.size("events").cast("bigint").alias("n_events"),
        F.size("products").cast("bigint").alias("n_products"),
    )


@query(
    "a08_with_source",
    f"""with {PAGES_CTE} select doc_id, case when doc_id % 3 = 0 then 'https://m.test/' || lpad(cast(doc_id as varchar), 9, '0') else '' end as source_url,
    case when doc_id % 3 = 0 then '2024-05-05T00:00:00' else '2025-01-01T00:00:00' end as crawled_at from pages_""",
)
def a08(spark, sf):
    pages = company_pages(spark, sf).select("company_id", "page_type", "doc_id")
    first = F.format_string("https://m.test/%09d", "doc_id")
    found = pages.filter(F.col("doc_id") % 3 == 0)
    metadata = found.select(
        "company_id",
        "page_type",
        F.explode(F.array(first, F.concat(first, F.lit("/later")))).alias("source_url"),
        F.lit("2024-05-05T00:00:00").alias("crawled_at"),
    )
    return readers.with_source(pages, metadata, "2025-01-01T00:00:00").select("doc_id", "source_url", "crawled_at")


@query("a13_companies_with_files", "select distinct source as company_id from documents where source <> 'src3'")
def a13(spark, sf):
    return readers.companies_with_files(table(spark, sf, "documents").select(F.col("source").alias("company_id")), ["src3"])


@query(
    "a14_check_targets",
    """with t as (select distinct o_custkey * 2 as k from orders) select cast(t.k as varchar) as company_id, coalesce(c_name, 'Unknown') as name,
    case when c_custkey is null then 'not_in_seed' when c_custkey % 3 = 0 then 'no_website' else 'ok' end as status from t left join customer on t.k = c_custkey""",
)
def a14(spark, sf):
    c = table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    seed = c.select(
        key.alias("company_id"),
        F.lit(None).cast("string").alias("legal_name"),
        F.col("c_name").alias("company_name"),
        F.when(F.col("c_custkey") % 3 != 0, F.lit("https://w.test")).alias("website"),
    )
    targets = table(spark, sf, "orders").select((F.col("o_custkey") * 2).cast("string").alias("company_id")).distinct()
    return readers.check_targets(targets, seed)


# --- sinks: what is written is what is read back -----------------------------------------


@query("b01_write_pages", f"with {PAGES_CTE} select doc_id, company_id, page_type, text, '2025-01-0' || (1 + doc_id % 3) as run_date from pages_")
def b01(spark, sf):
    path = scratch_path(spark, "pages")
    date = F.concat(F.lit("2025-01-0"), (F.lit(1) + F.col("doc_id") % 3).cast("string")).cast("date")
    pages = company_pages(spark, sf).withColumn("run_date", date)
    writers.write_pages(pages, path)
    writers.write_pages(pages.filter(F.col("run_date") == F.lit("2025-01-02").cast("date")), path)
    return spark.read.parquet(path).select(
        "doc_id", "company_id", "page_type", "text", F.col("run_date").cast("string").alias("run_date")
    )


@query("b02_write_record_texts", f"with {PAY} select company_id, legal_name, cast(n_events as bigint) as n_events from pay_")
def b02(spark, sf):
    path = scratch_path(spark, "records")
    rows = payloads(spark, sf).withColumnRenamed("company_record", "company")
    writers.write_record_texts(rows, path, ["company", "events", "products", "snapshots", "visibility"])
    back = spark.read.parquet(path)
    parsed = F.from_json("json", "company struct<legal_name:string>, events array<struct<event_id:string>>")
    return back.select("company_id", parsed.alias("r")).select(
        "company_id", F.col("r.company.legal_name").alias("legal_name"), F.size("r.events").cast("bigint").alias("n_events")
    )


@query("b03_write_payloads", f"with {PAY} select company_id, legal_name, cast(n_events as bigint) as n_events, cast(n_products as bigint) as n_products from pay_")
def b03(spark, sf):
    path = scratch_path(spark, "payloads")
    writers.write_payloads(payloads(spark, sf), path, compression="gzip")
    return readers.read_payloads(spark, path).select(
        "company_id",
        F.col("company_record.legal_name").alias("legal_name"),
        F.size("events").cast("bigint").alias("n_events"),
        F.size("products").cast("bigint").alias("n_products"),
    )


@query("b03_write_payload_parts", f"with {PAY} select company_id, legal_name, cast(n_events as bigint) as n_events, cast(n_products as bigint) as n_products from pay_ where n_events + n_products > 0")
def b03_parts(spark, sf):
    path = scratch_path(spark, "payload-parts")
    company, parts = company_table(spark, sf), records.payload_parts(child_tables(spark, sf), part_rows=20)
    writers.write_payload_parts(company, parts, path)
    company, parts = readers.read_payload_parts(spark, path, parts.schema, company.schema)
    held = parts.filter(F.col("entity").isin("events", "products")).groupBy("company_id").agg(
        *[F.coalesce(F.sum(F.when(F.col(n).isNotNull(), F.size(n))), F.lit(0)).alias(f"n_{n}") for n in ("events", "products")]
    )
    return company.join(held, "company_id").select("company_id", "legal_name", "n_events", "n_products")


@query(
    "b04_append_chunks",
    "select 'co' || label as company, vec_id as chunk_key, cast(2 as bigint) as copies from embeddings",
)
def b04(spark, sf):
    path = scratch_path(spark, "chunks")
    for _ in range(2):
        writers.append_chunks(vectors(spark, sf), path)
    return spark.read.parquet(path).groupBy("company", "chunk_key").agg(F.count(F.lit(1)).alias("copies"))


@query("b04_read_company_chunks", "select 'co3' as company, vec_id as chunk_key from embeddings where label = 3")
def b04_read(spark, sf):
    path = scratch_path(spark, "chunks")
    writers.append_chunks(vectors(spark, sf), path)
    return writers.read_company_chunks(spark, path, "co3").select("company", "chunk_key")


@query("b05_write_daily", f"with {PAGES_CTE} select doc_id, replace(source, ' ', '_') as folder, 'daily_2025-02-0' || (1 + doc_id % 2) as run_id from pages_")
def b05(spark, sf):
    path = scratch_path(spark, "daily")
    pages = company_pages(spark, sf).drop("text").withColumn("company_name", F.upper("source"))
    for day in (0, 1, 0):
        writers.write_daily(pages.filter(F.col("doc_id") % 2 == day), path, f"2025-02-0{day + 1}")
    return spark.read.parquet(path).select("doc_id", "folder", "run_id")


@query("b06_write_report", "select cast(count(*) as bigint) as total, cast(count(*) filter (where quality = 1) as bigint) as succeeded from labels")
def b06(spark, sf):
    path = scratch_path(spark, "report")
    l = table(spark, sf, "labels")
    writers.write_report(l.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("quality") == 1).alias("succeeded")), path)
    return spark.read.schema("total bigint, succeeded bigint").json(path)


@query("b06_write_log", "select cast(event_id as bigint) as event_id, event_type as status from events")
def b06_log(spark, sf):
    path = scratch_path(spark, "log")
    writers.write_log(table(spark, sf, "events").select("event_id", F.col("event_type").alias("status")), path)
    return spark.read.schema("event_id bigint, status string").json(path)


@query(
    "b07_replace_seed",
    "select cast(p_partkey as varchar) as company_id, 'v2' as version, coalesce(case when p_partkey % 3 <> 0 then 'https://s' || p_partkey || '.test' end, '-') as website from part",
)
def b07(spark, sf):
    path = scratch_path(spark, "seed")
    first = writers.replace_seed(spark, part_seed(spark, sf), path, "v1")
    again = spark.read.schema("company_id string, website string").json(first)
    second = writers.replace_seed(spark, again, path, "v2")
    return spark.read.schema("company_id string, website string").json(second).select(
        "company_id", F.lit("v2").alias("version"), F.coalesce("website", F.lit("-")).alias("website")
    )


# --- refresh ---------------------------------------------------------------------------------


def store_pages(d):
    return d.select(
        F.col("source").alias("company"),
        F.col("lang").alias("source"),
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("file_path"),
        "text",
        "doc_id",
    )


@query(
    "l06_refresh_store",
    f"""with d as (select source as company, lang as source, sha256(text) as text_hash, doc_id from documents where length({sql_strip('text')}) >= 100)
    select distinct company, source, text_hash from d where (company, source, text_hash) not in (select (company, source, text_hash) from d where doc_id % 2 = 0)""",
)
def l06_store(spark, sf):
    """Even documents are indexed first; the second batch adds new texts only, each once, and twice is as once."""
    path = scratch_path(spark, "store")
    pages = store_pages(text_table(spark, sf, "documents", "doc_id"))
    refresh_store(spark, pages.filter(F.col("doc_id") % 2 == 0).drop("doc_id"), path, "day1")
    refresh_store(spark, pages.drop("doc_id"), path, "day2")
    added = refresh_store(spark, pages.drop("doc_id"), path, "day2")
    return added.filter("chunk_id = 0").select("company", "source", "text_hash")


@query(
    "l06_marked_chunks",
    f"""with d as (select 'c' || (doc_id // 2) % 7 as company, doc_id // 2 as page, sha256(text) as text_hash, doc_id % 2 as day, length({sql_strip('text')}) >= 100 as stored
      from documents where text is not null),
    now as (select company, page, max_by(text_hash, day) as text_hash from d group by company, page)
    select company, text_hash, (company, text_hash) in (select (company, text_hash) from now) as current from (select distinct company, text_hash from d where stored)""",
)
def l06_marked(spark, sf):
    """Documents 2n and 2n + 1 are two versions of one page, indexed on two days."""
    path = scratch_path(spark, "store")
    half = F.floor(F.col("doc_id") / 2)
    pages = text_table(spark, sf, "documents", "doc_id").select(
        "doc_id", F.concat(F.lit("c"), (half % 7).cast("string")).alias("company"), F.lit("page").alias("source"), F.concat(F.lit("p"), half.cast("string")).alias("file_path"), "text"
    )
    for day in (0, 1):
        refresh_store(spark, pages.filter(F.col("doc_id") % 2 == day).drop("doc_id"), path, f"day{day}")
    return marked_chunks(spark, path).filter("chunk_id = 0").select("company", "text_hash", "current")


@query(
    "l06_refresh_stream",
    f"select distinct source as company, lang as source, sha256(text) as text_hash from documents where length({sql_strip('text')}) >= 100",
)
def l06_stream(spark, sf):
    """The same refresh as a file stream; run again from its checkpoint it adds nothing."""
    store, checkpoint = scratch_path(spark, "store"), scratch_path(spark, "checkpoint")
    schema = table(spark, sf, "documents").schema
    for _ in range(2):
        stream = spark.readStream.schema(schema).parquet(f"{sf}/documents*.parquet")
        start_refresh(spark, store_pages(stream).drop("doc_id"), store, checkpoint).awaitTermination()
    return spark.read.schema(STORE).parquet(store).filter("chunk_id = 0").select("company", "source", "text_hash")
