"""F and G: hiring signals and repository visibility."""

from __future__ import annotations

from pyspark.sql import functions as F

from venturelens.functions import signals as sg
from venturelens.functions import urls
from venturelens.operators import signals as ops
from workload.common import PAGES_CTE, company_pages, query, sql_any, sql_strip, table, text_table

COUNTS = [r"(\d+)\s*(?:the|de|und)", r"[a-z]\s(\d+)\s", r"(\d+)"]
RANGES = [r"(\d+) (\d+)", r"(\d+)[.\-](\d+)"]
JOBS = [r"(\d+)\.", r"-(\d+)"]
TITLES = [r"(?:the|la)?\s*(?:then|thin|ther)", r"(?:queau|aileen)"]
ITEM = r"(?m)(?:^|\n)\s*[A-Z].*?(?:tion|und)"
SIGNS = ["sch", "los", "ein"]
DEPTS = {"engineering": ["then", "aile"], "sales": ["para"], "design": ["hein", "und die"]}
CITIES = ["then", "para", "hein ti", "la"]
OFFICES = [r"(?i:\. la) ([A-Z][a-z]+(?:,?\s+[A-Z][a-z]+)*)", r"\. ([A-Z][a-z]{4,5}) "]
POLICIES = {"Remote-first": ["thenin", "sche"], "Hybrid": ["then"], "In-office": ["que", "el"]}


def sql_number(d: str) -> str:
    return (
        f"(case when length(ltrim({d}, '0')) > 18 then 1000000000000000000 when ltrim({d}, '0') = '' then 0 "
        f"else try_cast(ltrim({d}, '0') as bigint) end)"
    )


def sql_top(low: str, patterns, lo: int, hi: int) -> str:
    tops = [f"list_max(list_transform(regexp_extract_all({low}, '{p}', 1), lambda d: {sql_number('d')}))" for p in patterns]
    return "coalesce(" + ", ".join(f"case when {t} between {lo} and {hi} then {t} end" for t in tops) + ")"


def sql_range(low: str, lo: int, hi: int) -> str:
    def one(p):
        a, b = f"regexp_extract_all({low}, '{p}', 1)", f"regexp_extract_all({low}, '{p}', 2)"
        pairs = f"list_transform(list_zip({a}, {b}), lambda x: {{'lo': {sql_number('x[1]')}, 'hi': {sql_number('x[2]')}}})"
        return f"list_filter({pairs}, lambda x: x.lo >= {lo} and x.lo < x.hi and x.hi <= {hi})[1]"

    return "coalesce(" + ", ".join(one(p) for p in RANGES) + ")"


def head_ctes(source: str, text: str) -> str:
    """h_: source columns with exact count, range and plus sign, then total, estimate, confidence."""
    return f"""
hx_ as (select *, {sql_top(f'lower({text})', COUNTS, 5, 100000)} as exact, {sql_range(f'lower({text})', 5, 100000)} as span from {source}),
h_ as (select *, coalesce(exact, (span.lo + span.hi) // 2) as total, case when exact is not null then exact || case when contains({text}, '+') then '+' else '' end
   when span is not null then span.lo || '-' || span.hi end as estimate, case when exact is not null then 0.8 when span is not null then 0.6 else 0.0 end as h_conf from hx_)
"""


def sql_size(x: str) -> str:
    return f"len({x})"


N_TITLES = "len(list_distinct(list_concat(" + ", ".join(f"regexp_extract_all({{low}}, '{p}')" for p in TITLES) + ")))"
N_ITEMS = "len(regexp_extract_all({low}, '" + ITEM + "'))"
N_SIGNS = "(" + " + ".join(f"(length({{low}}) - length(replace({{low}}, '{w}', ''))) // {len(w)}" for w in SIGNS) + ") // 2"


def job_ctes(source: str, text: str, stated=JOBS) -> str:
    low = f"lower({text})"
    return f"""
jx_ as (select *, {sql_top(low, stated, 1, 500)} as stated, {N_TITLES.format(low=low)} as n_titles, {N_ITEMS.format(low=low)} as n_items, {N_SIGNS.format(low=low)} as n_signs from {source}),
j_ as (select *, cast(case when stated is not null then stated when n_titles > 0 then least(n_titles, 200) when n_items > 0 then least(n_items, 200)
   when n_signs > 0 then least(n_signs, 200) end as bigint) as openings, case when stated is not null then 0.7 when n_titles > 0 then 0.6 when n_items > 0 then 0.5 when n_signs > 0 then 0.4 else 0.0 end as j_conf from jx_)
"""


def docs(spark, sf):
    return text_table(spark, sf, "documents", "doc_id")


def show(c):
    return F.coalesce(c.cast("string"), F.lit("-"))


@query(
    "f01_headcount",
    f"with {head_ctes('documents', 'text')} select doc_id, coalesce(total || '', '-') as total, coalesce(estimate, '-') as estimate, cast(h_conf as double) as confidence from h_",
)
def f01(spark, sf):
    h = docs(spark, sf).withColumn("h", sg.headcount(F.col("text"), COUNTS, RANGES))
    return h.select("doc_id", show(F.col("h.total")).alias("total"), show(F.col("h.estimate")).alias("estimate"), F.col("h.confidence").alias("confidence"))


@query(
    "f02_headcount_range",
    f"""with {head_ctes('documents', 'text')} select doc_id, coalesce(((span.lo + span.hi) // 2) || '', '-') as total, coalesce(span.lo || '-' || span.hi, '-') as estimate,
    cast(case when span is not null then 0.6 else 0.0 end as double) as confidence from h_""",
)
def f02(spark, sf):
    h = docs(spark, sf).withColumn("h", sg.headcount(F.col("text"), ["no such (word)"], RANGES))
    return h.select("doc_id", show(F.col("h.total")).alias("total"), show(F.col("h.estimate")).alias("estimate"), F.col("h.confidence").alias("confidence"))


def _jobs(name: str, patterns):
    @query(name, f"with {job_ctes('documents', 'text', patterns)} select doc_id, coalesce(openings || '', '-') as openings, cast(j_conf as double) as confidence from j_")
    def run(spark, sf):
        j = docs(spark, sf).withColumn("j", sg.job_openings(F.col("text"), patterns, TITLES, ITEM, SIGNS))
        return j.select("doc_id", show(F.col("j.count")).alias("openings"), F.col("j.confidence").alias("confidence"))


_jobs("f03_stated_openings", JOBS)
_jobs("f04_counted_openings", ["no such (word)"])


def sql_focus(low: str) -> str:
    return "concat_ws(', ', " + ", ".join(f"case when {sql_any(low, w)} then '{d}' end" for d, w in DEPTS.items()) + ")"


@query("f05_hiring_focus", f"select doc_id, {sql_focus('lower(text)')} as focus from documents")
def f05(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(sg.hiring_focus(F.col("text"), DEPTS), ", ").alias("focus"))


def sql_places(text: str) -> str:
    known = "list_filter([" + ", ".join(f"case when contains(lower({text}), '{c}') then '{c.title()}' end" for c in CITIES) + "], lambda x: x is not null)"
    named = "list_concat(" + ", ".join(f"regexp_extract_all({text}, '{p}', 1)" for p in OFFICES) + ")"
    named = f"list_filter(list_transform({named}, lambda x: {sql_strip('x')}), lambda x: length(x) > 2)"
    return f"array_to_string(list_sort(list_distinct(list_concat({known}, {named}))), '|')"


@query("f06_office_locations", f"select doc_id, {sql_places('text')} as places from documents")
def f06(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(sg.office_locations(F.col("text"), CITIES, OFFICES), "|").alias("places"))


def sql_policy(low: str) -> str:
    return "case " + " ".join(f"when {sql_any(low, w)} then '{k}'" for k, w in POLICIES.items()) + " end"


@query("f07_remote_policy", f"select doc_id, {sql_policy('lower(text)')} as policy from documents")
def f07(spark, sf):
    return docs(spark, sf).select("doc_id", sg.remote_policy(F.col("text"), POLICIES).alias("policy"))


SNAP_CTE = f"""
{PAGES_CTE},
t_ as (select company_id, coalesce(min(text) filter (where page_type = 'about'), '') as about, coalesce(min(text) filter (where page_type = 'homepage'), '') as homepage,
   coalesce(min(text) filter (where page_type = 'team'), '') as team, coalesce(min(text) filter (where page_type = 'careers'), '') as careers from pages_
   where page_type in ('about', 'homepage', 'team', 'careers') group by company_id),
p_ as (select *, about || ' ' || homepage || ' ' || team as people from t_),
{head_ctes('p_', 'people')}, {job_ctes('h_', 'careers')},
snap_ as (select company_id, coalesce(total || '', '-') as headcount_total, coalesce(estimate, '-') as headcount_estimate, coalesce(openings || '', '-') as job_openings_count,
   {sql_focus('lower(careers)')} as hiring_focus, {sql_policy('lower(careers)')} as remote_policy, cast(greatest(h_conf, j_conf) as double) as confidence
   from j_ where coalesce(total, 0) > 0 or estimate is not null or coalesce(openings, 0) > 0)
"""


SNAPSHOT_RULES = {
    "headcount": {"patterns": COUNTS, "ranges": RANGES},
    "jobs": {"patterns": JOBS, "titles": TITLES, "list_item": ITEM, "indicators": SIGNS},
    "departments": DEPTS,
    "cities": CITIES,
    "policies": POLICIES,
}


def snapshots(spark, sf):
    return ops.hiring_snapshots(company_pages(spark, sf), **SNAPSHOT_RULES)


@query("f08_hiring_snapshots", f"with {SNAP_CTE} select * from snap_")
def f08(spark, sf):
    s = snapshots(spark, sf)
    return s.select(
        "company_id",
        show(F.col("headcount_total")).alias("headcount_total"),
        show(F.col("headcount_estimate")).alias("headcount_estimate"),
        show(F.col("job_openings_count")).alias("job_openings_count"),
        F.array_join("hiring_focus", ", ").alias("hiring_focus"),
        "remote_policy",
        "confidence",
    )


_ORD = "case page_type when 'about' then 0 when 'homepage' then 1 when 'team' then 2 else 3 end"


PROVENANCE_SQL = f"""with {SNAP_CTE}, pv_ as (select company_id, string_agg(source_url || ' Extracted from ' || page_type || ' page', '; ' order by {_ORD}) as provenance
    from pages_ where page_type in ('about', 'homepage', 'team', 'careers') and length(text) > 0 group by company_id)
    select s.company_id, coalesce(provenance, '') as provenance from snap_ s left join pv_ on s.company_id = pv_.company_id"""


@query(
    "f09_snapshot_provenance",
    PROVENANCE_SQL,
)
def f09(spark, sf):
    pages = company_pages(spark, sf).withColumn("crawled_at", F.lit("2025-01-01"))
    rows = ops.snapshot_provenance(snapshots(spark, sf), pages)
    texts = F.transform("provenance", lambda p: F.concat_ws(" ", p["source_url"], p["snippet"]))
    return rows.select("company_id", F.array_join(texts, "; ").alias("provenance"))


# --- repositories ----------------------------------------------------------------------



@query(
    "g01_repo_urls",
    r"""with h as (select page_id % 40 as company_id, unnest(regexp_extract_all(html || ' ' || url, 'www\.([a-z]+)\.example', 1)) as m from pages)
    select distinct company_id, 'https://github.com/' || m as repo_url from h""",
)
def g01(spark, sf):
    p = text_table(spark, sf, "pages", "page_id").select((F.col("page_id") % 40).alias("company_id"), F.concat_ws(" ", "html", "url").alias("text"))
    return ops.repo_urls(p, pattern=r"www\.([a-z]+)\.example")


@query(
    "g02_parse_repo_url",
    r"""with p as (select page_id, trim(regexp_extract(replace(url, '.html', '.git'), '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/') as path from pages)
    select page_id, split_part(path, '/', 1) as owner, regexp_replace(split_part(path, '/', 2), '\.git$', '') as repo from p""",
)
def g02(spark, sf):
    u = F.replace("url", F.lit(".html"), F.lit(".git"))
    return table(spark, sf, "pages").select(
        "page_id", urls.repo_owner(u, "example").alias("owner"), urls.repo_name(u, "example").alias("repo")
    )


API_CTE = """
found_ as (select s_suppkey as company_id, 'https://github.com/org' || s_suppkey || case when s_suppkey % 2 = 1 then '/main.git' else '' end as mentioned_url, 'org' || s_suppkey as owner from supplier),
api_ as (select owner, case company_id % 6 when 0 then owner when 2 then 'platform' when 4 then 'core' when 1 then 'main' else 'other' end as repo, company_id * 3 as stars from found_)
"""


def found_repos(spark, sf):
    s = table(spark, sf, "supplier")
    k = F.col("s_suppkey").cast("string")
    return s.select(
        F.col("s_suppkey").alias("company_id"),
        F.concat(F.lit("https://github.com/org"), k, F.when(F.col("s_suppkey") % 2 == 1, F.lit("/main.git")).otherwise(F.lit(""))).alias("repo_url"),
    )


def api_answers(spark, sf):
    s = table(spark, sf, "supplier")
    kind = F.col("s_suppkey") % 6
    owner = F.concat(F.lit("org"), F.col("s_suppkey").cast("string"))
    repo = F.when(kind == 0, owner).when(kind == 2, "platform").when(kind == 4, "core").when(kind == 1, "main").otherwise("other")
    return s.select(
        owner.alias("owner"),
        repo.alias("repo"),
        F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("link_header"),
        F.format_string('{"stargazers_count": %d}', F.col("s_suppkey") * 3).alias("body"),
    )


@query(
    "g03_first_found_repo",
    f"""with {API_CTE} select f.company_id, f.mentioned_url, f.owner, a.repo, cast(stars as bigint) as stars, 'https://github.com/' || f.owner || '/' || a.repo as repo_url
    from found_ f join api_ a on f.owner = a.owner where (f.company_id % 2 = 1 and a.repo = 'main') or (f.company_id % 2 = 0 and a.repo <> 'other')""",
)
def g03(spark, sf):
    hits = ops.first_found_repo(ops.repo_candidates(found_repos(spark, sf)), ops.repo_metrics(api_answers(spark, sf)))
    return hits.select("company_id", "mentioned_url", "owner", "repo", "stars", "repo_url")


def event_api(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        F.col("user_id").cast("string").alias("owner"),
        F.col("event_id").cast("string").alias("repo"),
        F.when(F.col("event_type") == "error", 404).otherwise(200).alias("status"),
        F.replace("props", F.lit('"k"'), F.lit('"stargazers_count"')).alias("body"),
    )


@query(
    "g04_repo_metrics",
    """select cast(user_id as varchar) as owner, cast(event_id as varchar) as repo, cast(json_extract_string(props, '$.k') as bigint) as stars, cast(0 as bigint) as forks,
    false as archived, '' as topics from events where event_type <> 'error'""",
)
def g04(spark, sf):
    m = ops.repo_metrics(event_api(spark, sf))
    return m.select("owner", "repo", "stars", "forks", "archived", F.array_join("topics", ",").alias("topics"))


@query("g05_contributors", "select p_partkey, cast(case when p_size % 3 = 0 then p_size else p_size % 3 end as bigint) as contributors from part")
def g05(spark, sf):
    p = table(spark, sf, "part")
    size = F.col("p_size")
    link = F.format_string('<https://api.test/x?page=2>; rel="next", <https://api.test/x?page=%d>; rel="last"', "p_size")
    body = F.to_json(F.transform(F.sequence(F.lit(1), size % 3), lambda i: F.struct(i.alias("id"))))
    return p.select("p_partkey", ops.contributors(F.when(size % 3 == 0, link), F.when(size % 3 != 0, body).otherwise(F.lit("[]"))).alias("contributors"))


@query(
    "g06_visibility",
    """select company_id, github_url, cast(k as bigint) as github_stars, cast(k as bigint) as github_forks from (select user_id as company_id, 'https://github.com/e' || lpad(cast(event_id as varchar), 9, '0') as github_url,
      cast(json_extract_string(props, '$.k') as bigint) as k, row_number() over (partition by user_id order by cast(json_extract_string(props, '$.k') as bigint) desc, event_id) as n from events) where n = 1""",
)
def g06(spark, sf):
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    repos = e.select(
        F.col("user_id").alias("company_id"),
        F.format_string("https://github.com/e%09d", "event_id").alias("repo_url"),
        k.alias("stars"),
        k.alias("forks"),
        F.lit(None).cast("bigint").alias("contributors"),
        F.lit(None).cast("string").alias("language"),
        F.array().cast("array<string>").alias("topics"),
        F.lit(None).cast("string").alias("pushed_at"),
    )
    return ops.visibility_rows(repos).select("company_id", "github_url", "github_stars", "github_forks")
