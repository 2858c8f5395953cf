"""Schemas of every table the jobs read or write, as DDL text."""

from __future__ import annotations

from typing import NamedTuple

from venturelens import vocabulary as V


class Field(NamedTuple):
    """One field of a typed record; ``check`` names a value rule (url, event_type)."""

    name: str
    type: str
    required: bool = False
    check: str = ""
    default: object = None


PROVENANCE = "array<struct<source_url:string,crawled_at:string,snippet:string>>"
_TAIL = [Field("schema_version", "string", default=V.SCHEMA_VERSION), Field("provenance", PROVENANCE)]

ENTITIES: dict[str, list[Field]] = {
    "company": [
        Field("company_id", "string", True),
        Field("legal_name", "string", True),
        Field("brand_name", "string"),
        Field("website", "string", check="url"),
        Field("hq_city", "string"),
        Field("hq_state", "string"),
        Field("hq_country", "string"),
        Field("founded_year", "int"),
        Field("categories", "array<string>"),
        Field("related_companies", "array<string>"),
        Field("total_raised_usd", "double"),
        Field("last_disclosed_valuation_usd", "double"),
        Field("last_round_name", "string"),
        Field("last_round_date", "date"),
        Field("as_of", "date"),
        *_TAIL,
    ],
    "events": [
        Field("event_id", "string", True),
        Field("company_id", "string", True),
        Field("occurred_on", "date", True),
        Field("event_type", "string", True, check="event_type"),
        Field("title", "string", True),
        Field("description", "string"),
        Field("round_name", "string"),
        Field("investors", "array<string>"),
        Field("amount_usd", "double"),
        Field("valuation_usd", "double"),
        Field("actors", "array<string>"),
        Field("tags", "array<string>"),
        *_TAIL,
    ],
    "snapshots": [
        Field("company_id", "string", True),
        Field("as_of", "date", True),
        Field("headcount_total", "int"),
        Field("headcount_estimate", "string"),
        Field("headcount_growth_pct", "double"),
        Field("job_openings_count", "int"),
        Field("engineering_openings", "int"),
        Field("sales_openings", "int"),
        Field("hiring_focus", "array<string>"),
        Field("pricing_tiers", "array<string>"),
        Field("active_products", "array<string>"),
        Field("geo_presence", "array<string>"),
        Field("office_locations", "array<string>"),
        Field("remote_policy", "string"),
        Field("confidence", "double"),
        *_TAIL,
    ],
    "products": [
        Field("product_id", "string", True),
        Field("company_id", "string", True),
        Field("name", "string", True),
        Field("description", "string"),
        Field("pricing_model", "string"),
        Field("pricing_tiers_public", "array<string>"),
        Field("ga_date", "date"),
        Field("integration_partners", "array<string>"),
        Field("github_repo", "string"),
        Field("license_type", "string"),
        Field("reference_customers", "array<string>"),
        *_TAIL,
    ],
    "leadership": [
        Field("person_id", "string", True),
        Field("company_id", "string", True),
        Field("name", "string", True),
        Field("role", "string", True),
        Field("is_founder", "boolean", default=False),
        Field("start_date", "date"),
        Field("end_date", "date"),
        Field("previous_affiliation", "string"),
        Field("education", "string"),
        Field("linkedin", "string", check="url"),
        *_TAIL,
    ],
    "visibility": [
        Field("company_id", "string", True),
        Field("as_of", "date", True),
        Field("news_mentions_30d", "int"),
        Field("avg_sentiment", "double"),
        Field("github_url", "string"),
        Field("github_stars", "int"),
        Field("github_forks", "int"),
        Field("github_contributors", "int"),
        Field("glassdoor_rating", "double"),
        Field("attention_trend", "string"),
        *_TAIL,
    ],
}
CHILDREN = ["events", "snapshots", "products", "leadership", "visibility"]

# Business-intelligence fields, joined onto the company by company_id.
BI_FIELDS = {
    "value_proposition": "string",
    "product_description": "string",
    "target_customer_segments": "array<string>",
    "key_competitors": "array<string>",
    "competitive_differentiation": "string",
    "industry_primary": "string",
    "industry_tags": "array<string>",
    "revenue_model": "string",
    "revenue_streams": "array<string>",
    "primary_customer_type": "string",
    "sales_motion": "string",
    "gtm_channels": "array<string>",
    "pricing_model": "string",
    "pricing_disclosed": "boolean",
    "free_tier_available": "boolean",
    "free_tier_limitations": "string",
    "technology_partnerships": "array<string>",
    "geographic_markets": "array<string>",
    "company_stage": "string",
}


def struct_ddl(entity: str) -> str:
    return "struct<" + ",".join(f"{f.name}:{f.type}" for f in ENTITIES[entity]) + ">"


def entity_ddl(entity: str) -> str:
    return ", ".join(f"{f.name} {f.type}" for f in ENTITIES[entity])


# A company as the dashboards read it: record, business-intelligence and public pricing fields.
PROFILE: dict[str, str] = {
    **{f.name: f.type for f in ENTITIES["company"]},
    **BI_FIELDS,
    "pricing_tiers_public": "array<string>",
    "visibility": "struct<news_mentions_30d:int,avg_sentiment:double,github_stars:int,"
    "glassdoor_rating:double,attention_trend:string>",
}


def columns_of(entity: str) -> dict[str, str]:
    return {f.name: f.type for f in ENTITIES[entity]}


SEED = (
    "rank INT, company_name STRING, legal_name STRING, description STRING, funding STRING, "
    "founded_year INT, hq_city STRING, hq_country STRING, forbes_url STRING, company_id STRING, "
    "website STRING, linkedin STRING, categories ARRAY<STRING>, related_companies ARRAY<STRING>"
)
RAW_PAGES = (
    "company_id STRING, run_date DATE, page_type STRING, source_url STRING, crawled_at STRING, "
    "html STRING, text STRING"
)
CRAWL_METADATA = (
    "company_id STRING, company_name STRING, timestamp STRING, crawled_at STRING, run_id STRING, "
    "website STRING, base_url STRING, pages_scraped STRING, success MAP<STRING,STRING>, "
    "errors ARRAY<STRING>, pages MAP<STRING, STRUCT<url:STRING,status:STRING,text_length:INT,"
    "html_file:STRING,text_file:STRING,attempted_urls:ARRAY<STRING>,error:STRING>>"
)
STRUCTURED_RECORD = (
    f"company {struct_ddl('company')}, "
    + ", ".join(f"{name} array<{struct_ddl(name)}>" for name in CHILDREN)
)
PAYLOAD = (
    f"company_record {struct_ddl('company')}, "
    + ", ".join(f"{name} array<{struct_ddl(name)}>" for name in CHILDREN)
    + ", notes string, provenance_policy string"
)
REPO_API = "owner STRING, repo STRING, status INT, link_header STRING, body STRING"
REPO_BODY = (
    "stargazers_count bigint, forks_count bigint, watchers_count bigint, open_issues_count bigint, "
    "created_at string, updated_at string, pushed_at string, language string, description string, "
    "homepage string, topics array<string>, license struct<name:string>, archived boolean, disabled boolean"
)
