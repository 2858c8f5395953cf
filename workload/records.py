"""H1-H5 and H7: typed records."""

from __future__ import annotations

from pyspark.sql import functions as F

from venturelens import schemas as S
from venturelens.operators import records
from workload.common import query, table

DOMAIN = ["click", "purchase", "signup", "view"]


def event_items(spark, sf):
    """Events as JSON items: 'error' is outside the domain, every 97th has a bad date, every 89th no title."""
    e = table(spark, sf, "events")
    k = F.col("event_id")
    json = F.to_json(
        F.struct(
            k.cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("company_id"),
            F.when(k % 97 == 0, F.lit("2024-13-40")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("occurred_on"),
            "event_type",
            F.when(k % 89 != 0, F.lit("t")).alias("title"),
            F.when(k % 83 == 0, F.lit("lots")).otherwise(F.col("value").cast("string")).alias("amount_usd"),
            F.lit("ignored").alias("undeclared"),
        )
    )
    return e.select(F.col("user_id").cast("string").alias("company_id"), json.alias("json"))


ERRORS = """concat_ws('; ', case when event_id % 97 = 0 then 'occurred_on is no date' end, case when event_type = 'error' then 'event_type unknown' end,
  case when event_id % 89 = 0 then 'title missing' end, case when event_id % 83 = 0 then 'amount_usd is no double' end)"""


@query(
    "h01_validate",
    f"""select cast(event_id as varchar) as event_id, cast(user_id as varchar) as company_id, case when event_id % 97 <> 0 then strftime(ts, '%Y-%m-%d') end as occurred_on,
    event_type, case when event_id % 83 <> 0 then round(value, 6) else -1.0 end as amount_usd, cast(0 as bigint) as n_tags, '2.0.0' as schema_version, {ERRORS} as errors from events""",
)
def h01(spark, sf):
    rows = records.validate(event_items(spark, sf), S.ENTITIES["events"], event_types=DOMAIN)
    return rows.select(
        "event_id",
        "company_id",
        F.col("occurred_on").cast("string").alias("occurred_on"),
        "event_type",
        F.coalesce(F.round("amount_usd", 6), F.lit(-1.0)).alias("amount_usd"),
        F.size("tags").cast("bigint").alias("n_tags"),
        "schema_version",
        F.array_join("errors", "; ").alias("errors"),
    )


@query(
    "h01_split_valid",
    f"""with r as (select event_id, user_id, {ERRORS} as errors from events),
    bad as (select distinct user_id from r where errors <> '')
    select cast(event_id as varchar) as event_id, 'accepted' as outcome from r where user_id not in (select user_id from bad)
    union all select cast(event_id as varchar), 'rejected' from r where errors <> ''""",
)
def h01_split(spark, sf):
    good, bad = records.split_valid(records.validate(event_items(spark, sf), S.ENTITIES["events"], event_types=DOMAIN))
    return good.select("event_id", F.lit("accepted").alias("outcome")).unionByName(
        bad.select("event_id", F.lit("rejected").alias("outcome"))
    )


@query(
    "h02_domain_violations",
    "select event_type, cast(count(*) as bigint) as n from events where event_type not in ('click', 'purchase', 'view') group by event_type",
)
def h02(spark, sf):
    return records.domain_violations(table(spark, sf, "events"), "event_type", ["click", "purchase", "view"])


def customer_seed(spark, sf):
    c = table(spark, sf, "customer")
    return c.filter(F.col("c_custkey") % 3 != 0).select(
        F.col("c_custkey").cast("string").alias("company_id"),
        F.col("c_name").alias("company_name"),
        F.when(F.col("c_custkey") % 2 == 0, F.concat("c_name", F.lit(" Inc."))).alias("legal_name"),
        F.lit("https://seed.test").alias("website"),
        F.col("c_mktsegment").alias("hq_city"),
        F.lit(None).cast("string").alias("hq_country"),
        F.col("c_nationkey").alias("founded_year"),
        F.array("c_mktsegment").alias("categories"),
    )


@query(
    "h03_with_fallback",
    """select cast(c_custkey as varchar) as company_id,
    case when c_custkey % 4 = 0 then 'Extracted ' || c_custkey when c_custkey % 3 <> 0 then c_name || case when c_custkey % 2 = 0 then ' Inc.' else '' end else 'Unknown' end as legal_name,
    case when c_custkey % 4 = 0 then null when c_custkey % 3 <> 0 then c_mktsegment end as hq_city,
    case when c_custkey % 4 <> 0 and c_custkey % 3 <> 0 then c_mktsegment else '' end as categories from customer""",
)
def h03(spark, sf):
    c = table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    ids = c.select(key.alias("company_id"))
    got = c.filter(F.col("c_custkey") % 4 == 0).select(
        key.alias("company_id"), F.concat(F.lit("Extracted "), key).alias("legal_name")
    )
    rows = records.with_fallback(records.conform(got, S.columns_of("company")), customer_seed(spark, sf), ids)
    return rows.select("company_id", "legal_name", "hq_city", F.array_join("categories", ",").alias("categories"))


_SHA = "sha256(concat_ws(chr(31), 'order ' || l_orderkey, cast(l_linenumber as varchar), cast(l_partkey as varchar)))"


@query(
    "h04_own_key",
    f"""select 'order ' || l_orderkey as company_id, cast(l_linenumber as bigint) as line, cast(l_partkey as bigint) as part,
    case when l_linenumber = 1 then 'given-' || l_partkey else substring({_SHA}, 1, 8) || '-' || substring({_SHA}, 9, 4) || '-' || substring({_SHA}, 13, 4) || '-'
      || substring({_SHA}, 17, 4) || '-' || substring({_SHA}, 21, 12) end as product_id from lineitem""",
)
def h04(spark, sf):
    l = table(spark, sf, "lineitem")
    given = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("given-"), F.col("l_partkey").cast("string"))).when(
        F.col("l_linenumber") == 2, F.lit("")
    )
    rows = l.select(
        F.lit("someone else").alias("company_id"),
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("owner"),
        given.alias("product_id"),
        F.col("l_linenumber").cast("bigint").alias("line"),
        F.col("l_partkey").alias("part"),
    )
    fixed = records.own_key(rows, F.col("owner"), "product_id", ["owner", "line", "part"])
    return fixed.select("company_id", "line", "part", "product_id")


@query(
    "h05_merge_intelligence",
    """select cast(c_custkey as varchar) as company_id, c_name as legal_name, case when c_custkey % 2 = 0 then n_name end as industry_primary,
    case when c_custkey % 2 = 0 then r_name || ',' || n_name else '' end as geographic_markets from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
)
def h05(spark, sf):
    c, n, r = table(spark, sf, "customer"), table(spark, sf, "nation"), table(spark, sf, "region")
    key = F.col("c_custkey").cast("string").alias("company_id")
    bi = (
        c.filter(F.col("c_custkey") % 2 == 0)
        .join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(key, F.col("n_name").alias("industry_primary"), F.array("r_name", "n_name").alias("geographic_markets"))
    )
    rows = records.merge_intelligence(c.select(key, F.col("c_name").alias("legal_name")), bi)
    markets = F.coalesce(F.array_join("geographic_markets", ","), F.lit(""))
    return rows.select("company_id", "legal_name", "industry_primary", markets.alias("geographic_markets"))


def answers(spark, sf):
    """Model answers derived from parts: every 7th is broken text, every 11th lacks its list."""
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    good = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    F.concat(F.lit("p"), k.cast("string")).alias("product_id"),
                    k.cast("string").alias("company_id"),
                    F.col("p_name").alias("name"),
                    F.array("p_type").alias("pricing_tiers_public"),
                ),
                F.struct(
                    F.concat(F.lit("q"), k.cast("string")).alias("product_id"),
                    k.cast("string").alias("company_id"),
                    F.col("p_brand").alias("name"),
                    F.array().cast("array<string>").alias("pricing_tiers_public"),
                ),
            ).alias("products")
        )
    )
    answer = F.when(k % 7 == 0, F.lit("I cannot answer {")).when(k % 11 == 0, F.lit("{}")).otherwise(good)
    return p.select(k.cast("string").alias("company_id"), F.lit("products_leaders").alias("pass_name"), answer.alias("answer"))


@query(
    "h07_pass_rows",
    """with g as (select * from part where p_partkey % 7 <> 0 and p_partkey % 11 <> 0)
    select cast(p_partkey as varchar) as company_id, cast(0 as bigint) as pos, 'p' || p_partkey as product_id, p_name as name, p_type as tiers, '' as errors from g
    union all select cast(p_partkey as varchar), 1, 'q' || p_partkey, p_brand, '', '' from g""",
)
def h07(spark, sf):
    items = records.pass_rows(answers(spark, sf), "products_leaders", "products", "products")
    rows = records.validate(items, S.ENTITIES["products"])
    return rows.select(
        "company_id",
        F.col("pos").cast("bigint").alias("pos"),
        "product_id",
        "name",
        F.array_join("pricing_tiers_public", ",").alias("tiers"),
        F.array_join("errors", "; ").alias("errors"),
    )


@query(
    "h07_pass_status",
    """select cast(p_partkey as varchar) as company_id, 'products_leaders' as pass_name,
    case when p_partkey % 7 = 0 or p_partkey % 11 = 0 then 'failed' else 'ok' end as status from part""",
)
def h07_status(spark, sf):
    return records.pass_status(answers(spark, sf), {"products_leaders": "products"})
