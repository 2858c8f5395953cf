"""H8-H10, J and A10: payload assembly and dashboards over customer -> orders -> lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from venturelens import schemas as S
from venturelens.functions import markdown as md
from venturelens.functions import urls
from venturelens.operators import dashboard, records
from venturelens.operators.skew import spread
from workload.common import query, table

STAMP = "2025-01-01T00:00:00"
KINDS = {
    "1-URGENT": "funding",
    "2-HIGH": "partnership",
    "3-MEDIUM": "product_release",
    "4-NOT SPECIFIED": "layoff",
    "5-LOW": "leadership_change",
}
ND = "Not disclosed"


def company_table(spark, sf):
    c, n, r = table(spark, sf, "customer"), table(spark, sf, "nation"), table(spark, sf, "region")
    joined = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("c_custkey")
    rows = joined.select(
        F.concat(F.lit("cu"), k.cast("string")).alias("company_id"),
        F.col("c_name").alias("legal_name"),
        F.when(k % 3 != 0, F.col("c_mktsegment")).alias("brand_name"),
        F.when(k % 4 != 0, F.col("n_name")).alias("hq_city"),
        F.col("r_name").alias("hq_country"),
        F.when(k % 5 != 0, F.lit(1990) + F.col("c_nationkey")).alias("founded_year"),
        F.when(k % 7 != 0, F.array("c_mktsegment", "r_name")).alias("categories"),
        F.when(k % 2 == 0, F.array("n_name")).alias("related_companies"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_acctbal") * 1000).alias("total_raised_usd"),
        F.when(k % 6 == 0, F.lit("Series A")).alias("last_round_name"),
        F.when(k % 3 == 1, F.array(F.lit("Retail"), "c_mktsegment")).alias("target_customer_segments"),
        F.when(k % 9 == 0, F.lit("per seat")).alias("pricing_model"),
        F.when(k % 9 == 0, F.array(F.lit("Free"), F.lit("Pro"))).alias("pricing_tiers_public"),
        F.when(k % 8 == 0, F.array("r_name")).alias("technology_partnerships"),
        F.when(k % 2 == 1, F.lit("Sales-Led")).alias("sales_motion"),
        F.when(k % 5 == 1, F.array("r_name")).alias("geographic_markets"),
    )
    return records.conform(rows, S.PROFILE)


def event_table(spark, sf):
    o = table(spark, sf, "orders")
    kinds = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    rows = o.select(
        F.format_string("o%012d", "o_orderkey").alias("event_id"),
        F.concat(F.lit("cu"), F.col("o_custkey").cast("string")).alias("company_id"),
        F.to_date("o_orderdate").alias("occurred_on"),
        kinds[F.col("o_orderpriority")].alias("event_type"),
        F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(F.concat(F.lit("Order "), "o_orderpriority")).alias("title"),
        F.concat(F.lit("status "), "o_orderstatus").alias("description"),
        F.when(F.col("o_orderstatus") == "O", F.lit("Series O")).alias("round_name"),
        F.when(F.col("o_orderstatus") == "P", F.array(F.lit("Fund P"), F.lit("Fund Q"))).alias("investors"),
        F.col("o_totalprice").alias("amount_usd"),
    )
    return records.conform(rows, S.columns_of("events"))


def product_table(spark, sf):
    l = spread(table(spark, sf, "lineitem"), "l_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    joined = l.join(o, l.l_orderkey == o.o_orderkey)
    rows = joined.select(
        F.format_string("p%012d-%d-%d-%d", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("product_id"),
        F.concat(F.lit("cu"), F.col("o_custkey").cast("string")).alias("company_id"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("name"),
        F.when(F.col("l_returnflag") == "R", F.array(F.concat(F.lit("supp "), F.col("l_suppkey").cast("string")))).alias("reference_customers"),
    )
    return records.conform(rows, S.columns_of("products"))


def snapshot_table(spark, sf):
    c = table(spark, sf, "customer").filter(F.col("c_acctbal") > 0)
    k = F.col("c_custkey")
    both = F.explode(F.array(F.to_date(F.lit("2024-01-01")), F.to_date(F.lit("2024-06-01"))))
    rows = c.withColumn("as_of", both).select(
        F.concat(F.lit("cu"), k.cast("string")).alias("company_id"),
        "as_of",
        (F.col("c_nationkey") * 10 + F.month("as_of")).alias("headcount_total"),
        F.when(k % 2 == 0, F.col("c_nationkey")).alias("engineering_openings"),
        F.when(k % 3 == 0, F.lit(2)).alias("sales_openings"),
        F.when(k % 4 == 0, F.array(F.lit("Oslo"))).alias("geo_presence"),
    )
    return records.conform(rows, S.columns_of("snapshots"))


def visibility_table(spark, sf):
    c = table(spark, sf, "customer").filter(F.col("c_custkey") % 2 == 0)
    rows = c.select(
        F.concat(F.lit("cu"), F.col("c_custkey").cast("string")).alias("company_id"),
        F.to_date(F.lit("2024-01-01")).alias("as_of"),
        F.col("c_nationkey").alias("github_stars"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit(4.5)).alias("glassdoor_rating"),
    )
    return records.conform(rows, S.columns_of("visibility"))


def child_tables(spark, sf):
    return {
        "events": event_table(spark, sf),
        "products": product_table(spark, sf),
        "snapshots": snapshot_table(spark, sf),
        "visibility": visibility_table(spark, sf),
    }


def payloads(spark, sf):
    return records.assemble_payloads(company_table(spark, sf), child_tables(spark, sf))


_KIND = "case o_orderpriority " + " ".join(f"when '{k}' then '{v}'" for k, v in KINDS.items()) + " end"


def _nd(x: str) -> str:
    return f"coalesce(nullif(cast({x} as varchar), ''), '{ND}')"


def _money(x: str) -> str:
    return f"coalesce('$' || format('{{:,.0f}}', {x}), '{ND}')"


PAY = f"""
co_ as (
  select c_custkey as k, 'cu' || c_custkey as company_id, c_name as legal_name, case when c_custkey % 3 <> 0 then c_mktsegment end as brand_name,
    case when c_custkey % 4 <> 0 then n_name end as hq_city, r_name as hq_country,
    case when c_custkey % 5 <> 0 then 1990 + c_nationkey end as founded_year,
    case when c_custkey % 7 <> 0 then c_mktsegment || ', ' || r_name end as categories,
    case when c_custkey % 2 = 0 then n_name end as related,
    case when c_acctbal > 5000 then c_acctbal * 1000 end as total_raised, case when c_custkey % 6 = 0 then 'Series A' end as last_round,
    case when c_custkey % 3 = 1 then 'Retail, ' || c_mktsegment end as segments,
    case when c_custkey % 9 = 0 then 'per seat' end as pricing_model, case when c_custkey % 9 = 0 then 'Free, Pro' end as tiers,
    case when c_custkey % 8 = 0 then r_name end as partners, case when c_custkey % 2 = 1 then 'Sales-Led' end as sales_motion,
    case when c_custkey % 5 = 1 then r_name end as markets,
    case when c_acctbal > 0 then c_nationkey * 10 + 6 end as headcount, case when c_acctbal > 0 and c_custkey % 2 = 0 then c_nationkey end as eng,
    case when c_acctbal > 0 and c_custkey % 3 = 0 then 2 end as sales, case when c_acctbal > 0 and c_custkey % 4 = 0 then 'Oslo' end as geo,
    case when c_custkey % 2 = 0 then c_nationkey end as stars, case when c_custkey % 4 = 0 then 4.5 end as rating
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
ev_ as (
  select o_custkey as k, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as occurred_on, {_KIND} as event_type, o_totalprice as amount,
    case when o_orderstatus = 'F' then 'status F' else 'Order ' || o_orderpriority end as title, 'status ' || o_orderstatus as description,
    case when o_orderstatus = 'O' then 'Series O' end as round_name, case when o_orderstatus = 'P' then 'Fund P, Fund Q' end as investors
  from orders),
evs_ as (
  select k, count(*) as n_events,
    string_agg('- round_name: ' || {_nd('round_name')} || '; amount_usd: ' || {_money('nullif(amount, 0)')} || '; investors: ' || {_nd('investors')}
      || '; valuation_usd: {ND}; occurred_on: ' || occurred_on, chr(10) order by occurred_on, o_orderkey) filter (where event_type = 'funding') as funding,
    string_agg(occurred_on || ' - ' || title, '; ' order by occurred_on, o_orderkey)
      filter (where event_type in ('partnership', 'product_release', 'leadership_change')) as traction,
    string_agg('- ' || occurred_on || ' ' || title, chr(10) order by occurred_on, o_orderkey)
      filter (where event_type in ('layoff', 'leadership_change')) as risks
  from ev_ group by k),
pr_ as (
  select o_custkey as k, count(*) as n_products, string_agg('supp ' || l_suppkey, ', '
      order by printf('p%012d-%d-%d-%d', l_orderkey, l_linenumber, l_partkey, l_suppkey)) filter (where l_returnflag = 'R') as customers
  from lineitem join orders on l_orderkey = o_orderkey group by o_custkey),
pay_ as (select co_.*, coalesce(n_events, 0) as n_events, funding, traction, risks, coalesce(n_products, 0) as n_products, customers
  from co_ left join evs_ on co_.k = evs_.k left join pr_ on co_.k = pr_.k)
"""


def _item(label: str, x: str) -> str:
    return f"'- **{label}**: ' || {_nd(x)}"


NL = " || chr(10) || "
OVERVIEW = NL.join([
    f"'- **Legal Name / Brand**: ' || {_nd('legal_name')} || ' / ' || {_nd('brand_name')}",
    _item("Headquarters", "concat_ws(', ', hq_city, hq_country)"),
    _item("Founded", "founded_year"),
    _item("Categories", "categories"),
    _item("Related Companies / Positioning", "related"),
])
BUSINESS = NL.join([
    _item("Who they sell to", "segments"),
    f"'- **Pricing Model / Tiers**: ' || concat_ws(' | ', {_nd('pricing_model')}, tiers)",
    _item("Integration Partners / Named Customers", "concat_ws(' | ', 'Partners: ' || partners, 'Customers: ' || customers)"),
    _item("Go-to-Market Motion", "sales_motion"),
])
FUNDING = NL.join([
    f"'- **Total Raised**: ' || {_money('nullif(total_raised, 0)')}",
    _item("Latest Round", "last_round"),
    "coalesce(funding, '- No funding events disclosed')",
])
GROWTH = NL.join([
    _item("Headcount", "headcount"),
    f"'- **Headcount Growth %**: {ND}'",
    _item("Hiring Focus", "concat_ws(', ', 'engineering_openings: ' || eng, 'sales_openings: ' || sales)"),
    _item("Geo Presence", "coalesce(geo, markets)"),
    _item("Recent Events", "traction"),
])
VISIBILITY = NL.join([
    f"'- **News Mentions (30d)**: {ND}'",
    f"'- **Avg Sentiment**: {ND}'",
    _item("GitHub Stars", "stars"),
    _item("Glassdoor Rating", "rating"),
    f"'- **Attention Trend**: {ND}'",
])
RISKS = f"coalesce(risks, '{ND}')"
OUTLOOK = (
    "legal_name || ' operates in ' || coalesce(categories, 'its category') || ' serving ' || coalesce(segments, 'its target customers') "
    "|| '. Based on available structured fields, the company appears to have a clear product focus and defined buyer profile.'"
)
GAPS = (
    "coalesce(nullif(concat_ws(chr(10), case when coalesce(total_raised, 0) = 0 then '- Total raised not disclosed' end, "
    "'- Valuation not disclosed', case when coalesce(rating, 0) = 0 then '- Glassdoor rating unavailable or behind login' end, "
    "case when tiers is null then '- Pricing tiers not publicly detailed' end, "
    "case when customers is null then '- Named customers not publicly listed' end), ''), '- None noted')"
)


def _section(ident: str, sql: str, column):
    @query(ident, f"with {PAY} select company_id, {sql} as section from pay_")
    def run(spark, sf):
        rows = dashboard.dashboard_rows(company_table(spark, sf), child_tables(spark, sf))
        return rows.select("company_id", column().alias("section"))


_section("j03_overview", OVERVIEW, lambda: dashboard.section_texts("overview"))
_section("j04_business", BUSINESS, lambda: dashboard.section_texts("business"))
_section("j05_funding", FUNDING, lambda: dashboard.section_texts("funding"))
_section("j06_growth", GROWTH, lambda: dashboard.section_texts("growth"))
_section("j07_traction", f"coalesce(traction, '{ND}')", lambda: md.disclosed(md.traction_text(F.col("recent"))))
_section("j08_visibility", VISIBILITY, lambda: dashboard.section_texts("visibility"))
_section("j09_risks", RISKS, lambda: dashboard.section_texts("risks"))
_section("j10_outlook", OUTLOOK, lambda: dashboard.section_texts("outlook"))
_section("j11_gaps", GAPS, lambda: dashboard.section_texts("gaps"))

_BODIES = [OVERVIEW, BUSINESS, FUNDING, GROWTH, VISIBILITY, RISKS, OUTLOOK, GAPS]
DASHBOARD = (
    f"'# ' || legal_name || ' Dashboard' || chr(10) || '*Generated: {STAMP}*' || chr(10) || '*Pipeline: Structured*' || chr(10) || chr(10) || "
    + " || chr(10) || chr(10) || ".join(
        f"'{head}' || chr(10) || {body}" for head, body in zip(md.V.SECTIONS, _BODIES)
    )
)


@query("j12_dashboard", f"with {PAY} select company_id, {DASHBOARD} as dashboard from pay_")
def j12(spark, sf):
    return dashboard.dashboards(company_table(spark, sf), child_tables(spark, sf), STAMP)


@query("j12_dashboards_of_payloads", f"with {PAY} select company_id, {DASHBOARD} as dashboard from pay_")
def j12_payloads(spark, sf):
    return dashboard.structured_dashboards(payloads(spark, sf), STAMP)


@query(
    "j19_recent_funding",
    f"""with {PAY}, last_ as (select * from (select *, row_number() over (partition by k order by occurred_on desc, o_orderkey desc) as n
      from ev_ where event_type = 'funding') where n <= 3),
    text_ as (select k, string_agg('- **' || occurred_on || '**: ' || description, chr(10) order by n desc) as section from last_ group by k)
    select company_id, coalesce(section, '- No recent funding events disclosed') as section from co_ left join text_ on co_.k = text_.k""",
)
def j19(spark, sf):
    return dashboard.recent_funding(company_table(spark, sf), event_table(spark, sf))


@query(
    "h08_assemble_payloads",
    f"""with {PAY}, ids_ as (select k, string_agg(printf('o%012d', o_orderkey), ',' order by occurred_on, o_orderkey) as event_ids from ev_ group by k)
    select company_id, legal_name, cast(n_events as bigint) as n_events, cast(n_products as bigint) as n_products,
      cast(case when headcount is null then 0 else 2 end as bigint) as n_snapshots, cast(case when k_.k % 2 = 0 then 1 else 0 end as bigint) as n_visibility,
      coalesce(event_ids, '') as event_ids from pay_ k_ left join ids_ on k_.k = ids_.k""",
)
def h08(spark, sf):
    p = payloads(spark, sf)
    sizes = [F.size(c).cast("bigint").alias(f"n_{c}") for c in ("events", "products", "snapshots", "visibility")]
    ids = F.array_join(F.transform("events", lambda e: e["event_id"]), ",").alias("event_ids")
    return p.select("company_id", F.col("company_record.legal_name").alias("legal_name"), *sizes, ids)


def uneven_children(spark, sf):
    """Events and products of which a third belong to one company."""
    one = lambda rows, digits: rows.withColumn("company_id", F.when(digits % 3 == 0, F.lit("cu1")).otherwise(F.col("company_id")))
    children = child_tables(spark, sf)
    children["events"] = one(children["events"], F.substring("event_id", 2, 12).cast("bigint"))
    children["products"] = one(children["products"], F.substring("product_id", 2, 12).cast("bigint"))
    return children


@query(
    "h08_payload_parts",
    """with rows_ as (
      select 'events' as entity, case when o_orderkey % 3 = 0 then 1 else o_custkey end as k, o_orderkey as place from orders
      union all select 'products', case when l_orderkey % 3 = 0 then 1 else o_custkey end, l_orderkey from lineitem join orders on l_orderkey = o_orderkey
      union all select 'snapshots', c_custkey, m from customer, (values (1), (6)) as t(m) where c_acctbal > 0
      union all select 'visibility', c_custkey, 1 from customer where c_custkey % 2 = 0)
    select 'cu' || k as company_id, entity, count(*) as n_items, cast(ceil(count(*) / 50.0) as int) as n_parts, cast(sum(place) as bigint) as places, true as bounded
    from rows_ group by k, entity""",
)
def h08_parts(spark, sf):
    parts = records.payload_parts(uneven_children(spark, sf), part_rows=50)
    place = {
        "events": lambda v: F.substring(v["event_id"], 2, 12).cast("bigint"),
        "products": lambda v: F.substring(v["product_id"], 2, 12).cast("bigint"),
        "snapshots": lambda v: F.month(v["as_of"]).cast("bigint"),
        "visibility": lambda v: F.lit(1).cast("bigint"),
    }
    total = lambda name: F.aggregate(name, F.lit(0).cast("bigint"), lambda n, x: n + place[name](x["v"]))
    own, held = F.coalesce(*[total(n) for n in place]), F.greatest(*[F.when(F.col(n).isNotNull(), F.size(n)) for n in place])
    rows = parts.select("company_id", "entity", "n_items", "n_parts", own.alias("places"), held.alias("held"))
    return rows.groupBy("company_id", "entity", "n_items", "n_parts").agg(F.sum("places").alias("places"), ((F.sum("held") == F.first("n_items")) & (F.max("held") <= 150)).alias("bounded"))


@query(
    "h09_flatten_payloads",
    f"with {PAY} select printf('o%012d', o_orderkey) as event_id, company_id, occurred_on, event_type, amount as amount_usd from ev_ join co_ on ev_.k = co_.k",
)
def h09(spark, sf):
    rows = records.flatten_parts(records.payload_parts(child_tables(spark, sf)), "events")
    return rows.join(company_table(spark, sf).select("company_id"), "company_id", "left_semi").select(
        "event_id", "company_id", F.col("occurred_on").cast("string").alias("occurred_on"), "event_type", "amount_usd"
    )


@query(
    "h10_record_containers",
    f"""with {PAY} select 'cu' || ids.k as company_id, case when c.k is null then 'error' else 'ok' end as status,
      coalesce(c.legal_name, 'none') as legal_name, cast(coalesce(c.n_events, 0) as bigint) as n_events
    from (select c_custkey as k from customer union all select cast(-1 - s_suppkey as bigint) from supplier) ids left join pay_ c on ids.k = c.k""",
)
def h10(spark, sf):
    keys = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).unionByName(
        table(spark, sf, "supplier").select((-1 - F.col("s_suppkey")).alias("k"))
    )
    ids = keys.select(F.concat(F.lit("cu"), F.col("k").cast("string")).alias("company_id"))
    lists = payloads(spark, sf).withColumnRenamed("company_record", "company")
    rows = records.record_containers(ids, lists, ["events", "products", "snapshots", "visibility"])
    return rows.select(
        "company_id",
        "status",
        F.coalesce("company.legal_name", F.lit("none")).alias("legal_name"),
        F.size("events").cast("bigint").alias("n_events"),
    )


@query(
    "a10_payload_or_default",
    f"""with {PAY} select 'cu' || ids.k as company_id, coalesce(c.legal_name, 'Example AI Inc.') as legal_name, c.k is null as is_default,
      cast(coalesce(c.n_events, 0) as bigint) as n_events
    from (select c_custkey as k from customer union all select cast(-1 - s_suppkey as bigint) from supplier) ids left join pay_ c on ids.k = c.k""",
)
def a10(spark, sf):
    keys = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).unionByName(
        table(spark, sf, "supplier").select((-1 - F.col("s_suppkey")).alias("k"))
    )
    ids = keys.select(F.concat(F.lit("cu"), F.col("k").cast("string")).alias("company_id"))
    rows = records.payload_or_default(ids, payloads(spark, sf))
    return rows.select(
        "company_id",
        F.col("company_record.legal_name").alias("legal_name"),
        "is_default",
        F.size("events").cast("bigint").alias("n_events"),
    )


# --- formats, listings, comparison ------------------------------------------------------


@query("j01_money", f"select o_orderkey, {_money('o_totalprice')} as shown, {_money('-o_totalprice')} as negative from orders".replace("'$' || format('{:,.0f}', -o_totalprice)", "'$' || format('{:,.0f}', -o_totalprice)"))
def j01(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", md.money(F.col("o_totalprice")).alias("shown"), md.money(-F.col("o_totalprice")).alias("negative"))


@query(
    "j02_disclosed",
    f"select p_partkey, {_nd('case when p_size > 25 then p_type when p_size > 20 then chr(32) || chr(32) when p_size > 10 then ' + chr(39) * 2 + ' end')} as shown from part",
)
def j02(spark, sf):
    p = table(spark, sf, "part")
    value = F.when(F.col("p_size") > 25, F.col("p_type")).when(F.col("p_size") > 20, F.lit("  ")).when(F.col("p_size") > 10, F.lit(""))
    return p.select("p_partkey", md.disclosed(value).alias("shown"))


LISTING_CTE = """
seed_ as (select 'd' || doc_id as company_id, 'Doc ' || doc_id || '. & Co' as company_name, cast(1990 + doc_id % 30 as bigint) as founded_year,
  case when doc_id % 3 = 0 then lang end as hq_city, case when doc_id % 2 = 0 then source end as hq_country,
  case when doc_id % 4 <> 0 then lang end as industry from documents),
s_ as (select 'd' || doc_id as company_id, '# S ' || doc_id as dashboard from labels),
r_ as (select 'Doc ' || item_id || '. & Co' as company_name, '# R ' || item_id as dashboard, cast(item_id % 7 as bigint) as retrieved_chunks from benchmark)
"""


def listing_seed(spark, sf):
    d = table(spark, sf, "documents")
    k = F.col("doc_id")
    return d.select(
        F.concat(F.lit("d"), k.cast("string")).alias("company_id"),
        F.concat(F.lit("Doc "), k.cast("string"), F.lit(". & Co")).alias("company_name"),
        (F.lit(1990) + k % 30).alias("founded_year"),
        F.when(k % 3 == 0, F.col("lang")).alias("hq_city"),
        F.when(k % 2 == 0, F.col("source")).alias("hq_country"),
        F.when(k % 4 != 0, F.array("lang")).alias("categories"),
        F.lit(None).cast("string").alias("website"),
    )


def structured_side(spark, sf):
    l = table(spark, sf, "labels")
    k = F.col("doc_id").cast("string")
    return l.select(F.concat(F.lit("d"), k).alias("company_id"), F.concat(F.lit("# S "), k).alias("dashboard"))


def answered_side(spark, sf):
    b = table(spark, sf, "benchmark")
    k = F.col("item_id").cast("string")
    return b.select(
        F.concat(F.lit("Doc "), k, F.lit(". & Co")).alias("company_name"),
        F.concat(F.lit("# R "), k).alias("dashboard"),
        (F.col("item_id") % 7).alias("retrieved_chunks"),
    )


_HQ = "trim(coalesce(hq_city, '') || ', ' || coalesce(hq_country, ''), ', ')"


@query(
    "j13_company_listing",
    f"""with {LISTING_CTE} select company_id, company_name, founded_year, {_HQ} as headquarters, industry, '' as website,
    company_id in (select company_id from s_) as structured_available, company_name in (select company_name from r_) as rag_available from seed_""",
)
def j13(spark, sf):
    slugs = answered_side(spark, sf).select(urls.file_slug(F.col("company_name")).alias("slug"))
    return dashboard.company_listing(listing_seed(spark, sf), structured_side(spark, sf), slugs)


@query("j14_first_id_by_name", "select p_name as company_name, 'p' || lpad(cast(min(p_partkey) as varchar), 9, '0') as company_id from part group by p_name")
def j14(spark, sf):
    p = table(spark, sf, "part").select(
        F.col("p_name").alias("company_name"), F.format_string("p%09d", "p_partkey").alias("company_id")
    )
    return dashboard.first_id_by_name(p)


@query(
    "j15_compare",
    f"""with {LISTING_CTE} select seed_.company_id, seed_.company_name, s_.dashboard as structured_dashboard, r_.dashboard as rag_dashboard,
    s_.dashboard is not null and r_.dashboard is not null as comparison_available
    from seed_ left join s_ on seed_.company_id = s_.company_id left join r_ on seed_.company_name = r_.company_name""",
)
def j15(spark, sf):
    return dashboard.compare(listing_seed(spark, sf), structured_side(spark, sf), answered_side(spark, sf))


@query(
    "j16_slugs",
    """select c_custkey, replace(replace(replace(lower(c_name || ' & Co. A/B'), ' ', '_'), '.', ''), '&', 'and') as file_slug,
    translate(lower(c_name || ' & Co. A/B'), ' /\\.', '____') as folder_slug from customer""",
)
def j16(spark, sf):
    name = F.concat("c_name", F.lit(" & Co. A/B"))
    return table(spark, sf, "customer").select(
        "c_custkey", urls.file_slug(name).alias("file_slug"), urls.folder_slug(name).alias("folder_slug")
    )


@query(
    "j17_ui_table",
    f"""with {LISTING_CTE}, l_ as (select *, {_HQ} as headquarters from seed_) select company_name as company, cast(founded_year as varchar) as founded,
    headquarters, '' as website, company_name || ' (' || headquarters || ')' as label from l_ where industry in ('en', 'fr')""",
)
def j17(spark, sf):
    slugs = answered_side(spark, sf).select(urls.file_slug(F.col("company_name")).alias("slug"))
    listing = dashboard.company_listing(listing_seed(spark, sf), structured_side(spark, sf), slugs)
    return dashboard.ui_table(listing.filter(F.col("industry").isin("en", "fr")))


@query(
    "j18_dashboard_files",
    """with f_ as (select case doc_id % 5 when 0 then 'doc_' || doc_id || '_dashboard.md' when 1 then 'doc_' || doc_id || '.md' when 2 then 'Doc ' || doc_id || '.md'
      when 3 then 'doc ' || doc_id || '.md' else 'DOC' || doc_id || '.md' end as file_name, source as text, doc_id from documents)
    select 'd' || doc_id as company_id, file_name, text from f_ where doc_id % 5 < 4""",
)
def j18(spark, sf):
    d = table(spark, sf, "documents")
    k = F.col("doc_id").cast("string")
    kind = F.col("doc_id") % 5
    name = (
        F.when(kind == 0, F.concat(F.lit("doc_"), k, F.lit("_dashboard.md")))
        .when(kind == 1, F.concat(F.lit("doc_"), k, F.lit(".md")))
        .when(kind == 2, F.concat(F.lit("Doc "), k, F.lit(".md")))
        .when(kind == 3, F.concat(F.lit("doc "), k, F.lit(".md")))
        .otherwise(F.concat(F.lit("DOC"), k, F.lit(".md")))
    )
    files = d.select(name.alias("file_name"), F.col("source").alias("text"))
    seed = d.select(F.concat(F.lit("d"), k).alias("company_id"), F.concat(F.lit("Doc "), k).alias("company_name"))
    return dashboard.find_dashboard_files(seed, files)


@query(
    "j20_response_rows",
    f"""with {LISTING_CTE} select company_name, 'Structured' as "pipeline", dashboard, '-' as retrieved_chunks, '{STAMP}' as generated_at
    from seed_ join s_ on seed_.company_id = s_.company_id
    union all select company_name, 'RAG', dashboard, cast(retrieved_chunks as varchar), '{STAMP}' from r_""",
)
def j20(spark, sf):
    s = structured_side(spark, sf).join(listing_seed(spark, sf).select("company_id", "company_name"), "company_id")
    rows = dashboard.response_rows(s, answered_side(spark, sf), STAMP)
    return rows.withColumn("retrieved_chunks", F.coalesce(F.col("retrieved_chunks").cast("string"), F.lit("-")))


@query(
    "a11_two_tier",
    """with p as (select doc_id, 'remote ' || quality as body from labels), q as (select doc_id, source as body from documents where lang <> 'en')
    select coalesce(p.doc_id, q.doc_id) as doc_id, coalesce(p.body, q.body) as body, case when p.body is not null then 'primary' else 'local' end as tier
    from p full outer join q on p.doc_id = q.doc_id""",
)
def a11(spark, sf):
    p = table(spark, sf, "labels").select("doc_id", F.concat(F.lit("remote "), F.col("quality").cast("string")).alias("body"))
    q = table(spark, sf, "documents").filter(F.col("lang") != "en").select("doc_id", F.col("source").alias("body"))
    return dashboard.two_tier(p, q, "doc_id", "body")


@query(
    "a12_page_context",
    """with ids as (select distinct 'Doc' || (doc_id // 2) as company_name from documents),
    about as (select 'Doc' || (doc_id // 2) as company_name, text from documents where doc_id % 4 = 0)
    select i.company_name, case when text is null then 'https://example.com/' || i.company_name else 'https://' || lower(i.company_name) || '.com/about' end as source_url,
    coalesce(text, 'No data available for ' || i.company_name) as text from ids i left join about a on i.company_name = a.company_name""",
)
def a12(spark, sf):
    d = table(spark, sf, "documents")
    pages = d.select(
        F.concat(F.lit("Doc"), F.floor(F.col("doc_id") / 2).cast("string")).alias("company_name"),
        F.when(F.col("doc_id") % 4 == 0, F.lit("about")).otherwise(F.lit("blog")).alias("page_type"),
        "text",
    )
    return dashboard.page_context(pages.select("company_name").distinct(), pages)
