"""D: seed enrichment, and C12 profile backfill."""

from __future__ import annotations

from pyspark.sql import functions as F

from venturelens.functions import urls
from venturelens.operators import seed as ops
from workload.common import query, sql_any, table

_NAME = "p_name || case p_partkey % 4 when 0 then ' AI' when 1 then ' Labs' when 2 then ' Co. Inc' else '' end"
_ROOT = f"replace(replace(regexp_replace(lower({_NAME}), '\\s+(ai|labs|inc|corp|llc)$', ''), ' ', ''), '.', '')"
_SLUG = f"regexp_replace(regexp_replace(lower({_NAME}), '\\s+', '-', 'g'), '[^\\w-]', '', 'g')"


def names(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey") % 4
    tail = F.when(k == 0, " AI").when(k == 1, " Labs").when(k == 2, " Co. Inc").otherwise("")
    return p.select(
        F.col("p_partkey").alias("company_id"), F.concat("p_name", tail).alias("company_name"), "p_partkey", "p_name", "p_size", "p_type"
    )


def _pos(df):
    return df.withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "d01_website_candidates",
    f"""with r as (select p_partkey as company_id, {_ROOT} as root from part)
    select company_id, cast(0 as bigint) as pos, 'https://' || root || '.com' as url from r union all select company_id, 1, 'https://' || root || '.ai' from r
    union all select company_id, 2, 'https://' || root || '.io' from r union all select company_id, 3, 'https://www.' || root || '.com' from r""",
)
def d01(spark, sf):
    return _pos(ops.candidates(names(spark, sf), "company_id", urls.website_candidates(F.col("company_name"))))


@query(
    "d02_known_domain",
    """with known as (select 'supplier#' || lpad(cast(s_suppkey as varchar), 9, '0') as name, 'site' || s_suppkey || '.test' as domain from supplier where s_suppkey % 3 = 0)
    select s_suppkey, case when domain is not null then 'https://' || domain else '-' end as known_url from supplier left join known on replace(replace(lower(s_name), ' ', ''), '.', '') = name""",
)
def d02(spark, sf):
    s = table(spark, sf, "supplier")
    known = s.filter(F.col("s_suppkey") % 3 == 0).select(
        F.format_string("supplier#%09d", "s_suppkey").alias("name"), F.format_string("site%d.test", "s_suppkey").alias("domain")
    )
    rows = ops.with_known_domain(s, known, "s_name")
    return rows.select("s_suppkey", F.coalesce("known_url", F.lit("-")).alias("known_url"))


@query(
    "d03_network_candidates",
    f"""with r as (select p_partkey as company_id, 'https://www.linkedin.com/company/' || {_SLUG} as page from part)
    select company_id, cast(0 as bigint) as pos, page as url from r union all select company_id, 1, page || '-ai' from r union all select company_id, 2, page || 'ai' from r""",
)
def d03(spark, sf):
    return _pos(ops.candidates(names(spark, sf), "company_id", urls.network_candidates(F.col("company_name"))))


@query(
    "d04_enrich_urls",
    """with s as (select s_suppkey as k, 'supplier#' || lpad(cast(s_suppkey as varchar), 9, '0') as root, replace('supplier#' || lpad(cast(s_suppkey as varchar), 9, '0'), '#', '') as slug from supplier)
    select k as company_id, case when k % 5 = 0 then 'https://known.test' when k % 3 = 0 then 'https://' || root || '.ai' when k % 3 = 1 then 'https://www.' || root || '.com' else '-' end as website,
      'https://www.linkedin.com/company/' || slug || case when k % 2 = 0 then '-ai' else '' end as linkedin from s""",
)
def d04(spark, sf):
    s = table(spark, sf, "supplier")
    root = F.format_string("supplier#%09d", "s_suppkey")
    k = F.col("s_suppkey")
    site = (
        F.when(k % 3 == 0, F.array(F.struct(F.concat(F.lit("https://"), root, F.lit(".ai")).alias("url"), F.lit(301).alias("status")),
                                   F.struct(F.concat(F.lit("https://www."), root, F.lit(".com")).alias("url"), F.lit(200).alias("status"))))
        .when(k % 3 == 1, F.array(F.struct(F.concat(F.lit("https://"), root, F.lit(".com")).alias("url"), F.lit(404).alias("status")),
                                  F.struct(F.concat(F.lit("https://www."), root, F.lit(".com")).alias("url"), F.lit(200).alias("status"))))
        .otherwise(F.array(F.struct(F.concat(F.lit("https://"), root, F.lit(".com")).alias("url"), F.lit(500).alias("status"))))
    )
    slug = F.replace(root, F.lit("#"), F.lit(""))
    profile = F.array(F.struct(F.concat(F.lit("https://www.linkedin.com/company/"), slug, F.lit("-ai")).alias("url"), F.when(k % 2 == 0, 200).otherwise(301).alias("status")))
    status = s.select(F.inline(F.concat(site, profile)))
    known = s.filter(k % 5 == 0).select(root.alias("name"), F.lit("known.test").alias("domain"))
    seed = s.select(k.alias("company_id"), F.col("s_name").alias("company_name"))
    rows = ops.enrich_urls(seed, status, known)
    return rows.select("company_id", F.coalesce("website", F.lit("-")).alias("website"), "linkedin")


RULES = {"Metal": ["bolt", "ring"], "Gadgets": ["widget", "gear"], "Bright": ["red", "blue", "green"], "Size": ["small", "large"]}


@query(
    "d05_sectors",
    "select p_partkey, coalesce(nullif(array_to_string(list_filter(["
    + ", ".join(f"case when {sql_any('lower(p_name)', w)} then '{k}' end" for k, w in RULES.items())
    + "], lambda x: x is not null)[1:2], ', '), ''), 'Artificial Intelligence') as sectors from part",
)
def d05(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(ops.sectors(F.col("p_name"), RULES, limit=2), ", ").alias("sectors")
    )


@query(
    "d06_stable_id",
    """select s_suppkey, substring(sha256(s_name), 1, 8) || '-' || substring(sha256(s_name), 9, 4) || '-' || substring(sha256(s_name), 13, 4) || '-'
    || substring(sha256(s_name), 17, 4) || '-' || substring(sha256(s_name), 21, 12) as company_id from supplier""",
)
def d06(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", urls.stable_id(F.col("s_name")).alias("company_id"))


@query(
    "d07_seed_rows",
    """select cast(p_partkey as varchar) as company_id, p_name as company_name, coalesce(case when p_size > 25 then p_type end, '') as website, '' as linkedin,
    p_brand as hq_city, cast(cast(1980 + p_size as int) as varchar) as founded_year, '' as categories from part""",
)
def d07(spark, sf):
    p = table(spark, sf, "part")
    rows = ops.seed_rows(
        p.select(
            F.col("p_partkey").cast("string").alias("company_id"),
            F.col("p_name").alias("company_name"),
            F.when(F.col("p_size") > 25, F.col("p_type")).alias("website"),
            F.col("p_brand").alias("hq_city"),
            (F.lit(1980) + F.col("p_size")).alias("founded_year"),
        )
    )
    return rows.select(
        "company_id", "company_name", "website", "linkedin", "hq_city",
        F.col("founded_year").cast("string").alias("founded_year"), F.array_join("categories", ",").alias("categories"),
    )


@query(
    "d08_coverage",
    """with j as (select d.*, quality from documents d left join labels l on d.doc_id = l.doc_id), c as (select count(*) as total, count(nullif(text, '')) as text,
      count(nullif(lang, '')) as lang, count(quality) as quality from j)
    select 'text' as field, cast(total as bigint) as total, cast(text as bigint) as filled from c union all select 'lang', total, lang from c union all select 'quality', total, quality from c""",
)
def d08(spark, sf):
    j = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return ops.coverage(j, ["text", "lang", "quality"])


@query(
    "c12_backfill_profiles",
    """select s_suppkey as company_id, case when s_suppkey % 4 = 0 then 'old' when s_suppkey % 3 = 0 then 'found ' || s_suppkey end as linkedin from supplier""",
)
def c12(spark, sf):
    s = table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    seed = s.select(k.alias("company_id"), F.when(k % 4 != 0, F.lit("https://a.test")).alias("website"), F.lit("old").alias("linkedin"))
    found = s.filter(k % 3 == 0).select(k.alias("company_id"), F.concat(F.lit("found "), k.cast("string")).alias("linkedin"))
    return ops.backfill_profiles(seed, found).select("company_id", "linkedin")
