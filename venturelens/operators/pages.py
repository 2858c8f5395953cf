"""Jobs over raw HTML pages: text, links, candidate choice and list extraction."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venturelens import vocabulary as V
from venturelens.functions import html as hx
from venturelens.functions import urls
from venturelens.functions.markup import Elements
from venturelens.functions.text import any_of, let, strip
from venturelens.operators.skew import union_rows


# --- parser form of the text operators -------------------------------------------

_LINES = re.compile("\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")


class _TextNodes(HTMLParser):
    """Collects text nodes outside the given elements, nesting respected."""

    def __init__(self, skip: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.skip, self.depth, self.nodes, self.data = skip, 0, [], []

    def end_of_text(self):
        """What was read since the last markup is one node: the parser may hand it over in parts."""
        if self.data:
            self.nodes.append("".join(self.data))
            self.data.clear()

    def handle_starttag(self, tag, attrs):
        self.end_of_text()
        self.depth += tag in self.skip

    def handle_comment(self, data):
        self.end_of_text()

    def handle_endtag(self, tag):
        self.end_of_text()
        if tag in self.skip and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if not self.depth:
            self.data.append(data)


def _nodes(html: str, skip: frozenset[str]) -> list[str]:
    parser = _TextNodes(skip)
    parser.feed(html)
    parser.close()
    parser.end_of_text()
    return parser.nodes


def parse_text(pages: DataFrame, html: str = "html", main: bool = False) -> DataFrame:
    """``visible_text`` (or ``main_text``) through an HTML parser, as column ``text``."""
    skip = frozenset(hx.CHROME_TAGS if main else hx.HIDDEN_TAGS)

    def page_text(page: str | None) -> str:
        nodes = _nodes(page or "", skip)
        raw = "\n".join(nodes) if main else "".join(nodes).replace("  ", "\n")
        lines = (x.strip() for x in _LINES.split(raw))
        return "\n".join(x for x in lines if len(x) > (3 if main else 0))

    @F.pandas_udf("string")
    def text(batch: pd.Series) -> pd.Series:
        return batch.map(page_text)

    return pages.withColumn("text", text(F.col(html)))


def text_gate(pages: DataFrame, min_text: int = 500, min_html: int | None = None) -> DataFrame:
    """Pages with more than ``min_text`` text characters; status, type and HTML size where present."""
    keep = F.length("text") > min_text
    if min_html is not None:
        keep = keep & (F.length("html") > min_html)
    if "status" in pages.columns:
        keep = keep & (F.col("status") < 400)
    if "content_type" in pages.columns:
        keep = keep & F.contains(F.lower("content_type"), F.lit("text/html"))
    return pages.filter(keep)


def first_candidate(pages: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first good page per key, by pattern order (a map-side combined aggregate, not a sort)."""
    rest = [c for c in pages.columns if c not in keys]
    best = pages.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_b"))
    return best.select(*keys, "_b.*")


def failed_page_types(
    companies: DataFrame, found: DataFrame, types: Sequence[str] = V.PAGE_TYPES, key: str = "company_id"
) -> DataFrame:
    """Configured page types without a page, per company: no join of companies and types is built."""
    have = found.groupBy(key).agg(
        F.collect_set(F.when(F.col("page_type").isin(list(types)), F.col("page_type"))).alias("_have")
    )
    wanted = F.array(*[F.lit(t) for t in types])
    missing = F.array_except(wanted, F.coalesce("_have", F.array().cast("array<string>")))
    return companies.select(key).join(have, key, "left").select(key, F.explode(missing).alias("page_type"))


# --- links -------------------------------------------------------------------------

def _page_rows(pages: DataFrame, key: str, schema: str, found: Callable[[Elements], Iterator[tuple]]) -> DataFrame:
    """(key, pos, ...) of what ``found`` yields for each page."""
    kind = pages.schema[key].dataType.simpleString()
    names = [part.split()[0] for part in schema.split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(ident, i, *row) for ident, page in zip(batch[key], batch["html"]) for i, row in enumerate(found(Elements(page)))]
            yield pd.DataFrame(out, columns=[key, "pos", *names])

    return pages.select(key, "html").mapInPandas(rows, f"{key} {kind}, pos int, {schema}")


def _footer_links(page: Elements) -> Iterator[tuple[str, str, str]]:
    """href, label and aria-label of the links in the page's footer: the first footer element, else the first of class ~ footer."""
    at = page.first(lambda i: page.tags[i] == "footer")
    if at is None:
        at = page.first(lambda i: "footer" in page.get(i, "class").lower())
    if at is not None:
        for i in page.inside(at, lambda k: page.tags[k] == "a" and page.attributes[k].get("href") is not None):
            href = page.get(i, "href").strip()
            if href and not href.startswith("#"):
                yield href, page.text(i), page.get(i, "aria-label")


def parse_footer_links(pages: DataFrame, key: str) -> DataFrame:
    """(key, pos, href, label, aria) of footer links through a parser; empty and in-page links dropped."""
    return _page_rows(pages, key, "href string, label string, aria string", _footer_links)


def block_links(pages: DataFrame, key: str, block: Column) -> DataFrame:
    """(key, pos, href, label, aria) of the links in ``block``; empty and in-page links dropped."""
    return (
        pages.select(key, F.posexplode(hx.anchors(block)).alias("pos", "_a"))
        .select(key, "pos", "_a.*")
        .filter((F.col("href") != "") & ~F.startswith("href", F.lit("#")))
    )


def classify_links(
    links: DataFrame,
    key: str,
    rules: Mapping[str, Sequence[str]] = V.LINK_RULES,
    network_host: str = V.NETWORK_HOST,
) -> DataFrame:
    """One row per (key, type, url); a link may have several types, repeats keep the first position."""
    context = F.concat_ws(" ", F.lower("label"), F.lower("aria"))
    kinds = hx.link_types(context, rules)
    network = F.when(F.contains(F.lower("url"), F.lit(network_host)), F.array(F.lit("linkedin")))
    types = F.when(F.size("_k") > 0, F.col("_k")).otherwise(network)
    return (
        links.withColumn("_k", kinds)
        .select(key, "pos", "url", F.explode(types).alias("link_type"))
        .groupBy(key, "link_type", "url")
        .agg(F.min("pos").alias("pos"))
    )


def merge_candidates(found: Column, defaults: Column) -> Column:
    """Found URLs before the default paths, repeats removed, first place kept."""
    return F.array_distinct(F.concat(found, defaults))


def candidate_urls(companies: DataFrame, links: DataFrame, paths: Mapping[str, Sequence[str]] = V.CRAWL_PATHS, key: str = "company_id") -> DataFrame:
    """(company, page type, pos, url): footer links of the type first, then the default paths.

    Links per company and type are distinct by now; only URL text is collected, per company page set.
    """
    per_type = links.groupBy(key, "link_type").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "url"))), lambda x: x["url"]).alias("_found")
    )
    wanted = F.array(
        *[
            F.struct(
                F.lit(kind).alias("page_type"),
                F.array(*[F.lit(p) for p in defaults]).alias("paths"),
            )
            for kind, defaults in paths.items()
        ]
    )
    rows = companies.select(key, "website", F.inline(wanted)).join(
        per_type.withColumnRenamed("link_type", "page_type"), [key, "page_type"], "left"
    )
    defaults = F.transform("paths", lambda p: urls.resolve(F.col("website"), p))
    found = F.coalesce("_found", F.array().cast("array<string>"))
    return rows.select(key, "page_type", F.posexplode(merge_candidates(found, defaults)).alias("pos", "url"))


def network_profile(html: Column, needle: str = V.NETWORK_COMPANY_PATH) -> Column:
    """First link to a company profile, without query, fragment and trailing slash."""
    hrefs = F.transform(hx.anchors(html), lambda a: a["href"])
    return urls.clean_profile_url(urls.first_link(hrefs, needle))


# --- list extraction ------------------------------------------------------------------


def _clean(names: DataFrame, key: str, stop_words: Sequence[str]) -> DataFrame:
    """Names of 3 to 99 characters without stop words; the first of equal names is kept."""
    ok = names.filter(
        (F.length("name") > 2) & (F.length("name") < 100) & ~any_of(F.lower("name"), list(stop_words))
    )
    return ok.groupBy(key, "name").agg(F.min(F.struct("pos", "url")).alias("_f")).select(
        key, "_f.pos", "name", "_f.url"
    )


def list_from_ld_json(pages: DataFrame, key: str) -> DataFrame:
    """Names and URLs of ``itemListElement`` entries."""
    scripts = F.regexp_extract_all("html", F.lit(hx.LD_JSON), F.lit(1))
    items = F.flatten(
        F.transform(
            scripts,
            lambda s: F.coalesce(
                F.from_json(s, "itemListElement array<struct<name:string,url:string>>")["itemListElement"],
                F.array().cast("array<struct<name:string,url:string>>"),
            ),
        )
    )
    rows = pages.select(key, F.posexplode(items).alias("pos", "_i")).select(
        key, "pos", F.col("_i.name").alias("name"), F.coalesce("_i.url", F.lit("")).alias("url")
    )
    named = rows.filter((F.length("name") > 0) & (F.length("name") < 100))
    return named.groupBy(key, "name").agg(F.min(F.struct("pos", "url")).alias("_f")).select(
        key, "_f.pos", "name", "_f.url"
    )


def _fits(page: Elements, i: int, rule: tuple[str | None, str, str, str]) -> bool:
    """Whether an element is what a rule of ``V.LIST_ITEM_RULES`` marks."""
    tag, attribute, value, how = rule
    own = page.get(i, attribute)
    return (tag is None or page.tags[i] == tag) and (own == value if how == "whole" else value in (own.split() if how == "word" else own))


def _listed(page: Elements) -> Iterator[tuple[str, str]]:
    """Name and link of each marked item, rule by rule, nested items too."""
    for rule in V.LIST_ITEM_RULES:
        for i in range(len(page.tags)):
            if _fits(page, i, rule):
                name = next(page.inside(i, lambda k: page.tags[k] in V.NAME_TAGS), None)
                link = next(page.inside(i, lambda k: page.tags[k] == "a"), None)
                if name is not None:
                    yield page.text(name), "" if link is None else page.get(link, "href")


def _headed(page: Elements) -> Iterator[tuple[str, str]]:
    """Text and link (inside, else around it) of each element of a heading's tag whose text begins with a digit."""
    for i, tag in enumerate(page.tags):
        if tag in V.HEADING_TAGS and page.starts_with_digit(i):
            link = next(page.inside(i, lambda k: page.tags[k] == "a"), None)
            link = page.ancestor(i, "a") if link is None else link
            yield page.text(i), "" if link is None else page.get(link, "href")


def list_from_selectors(pages: DataFrame, key: str) -> DataFrame:
    """Names in elements marked as list items, leading rank removed (parser form)."""
    raw = _page_rows(pages, key, "name string, url string", _listed)
    return _clean(raw.withColumn("name", F.regexp_replace("name", r"^\d+\.?\s*", "")), key, [])


def list_from_headings(
    pages: DataFrame,
    key: str,
    numbered: str = r"^(\d+)[.\s]+(.+)$",
    stop_words: Sequence[str] = V.HEADING_STOP_WORDS,
    top: int = 50,
) -> DataFrame:
    """``N. Name`` headings with rank 1 to ``top``, stop words and bare numbers left out (parser form)."""
    heads = _page_rows(pages, key, "label string, url string", _headed)
    rank = F.regexp_replace(F.regexp_extract("label", numbered, 1), "^0+(?=.)", "")
    rows = heads.select(
        key,
        "pos",
        F.when(F.length(rank).between(1, 9), rank.try_cast("int")).alias("rank"),
        strip(F.regexp_extract("label", numbered, 2)).alias("name"),
        "url",
    )
    ranked = rows.filter(F.col("rank").between(1, top) & ~F.regexp_like("name", F.lit(r"^\d+$")))
    return _clean(ranked.drop("rank"), key, stop_words)


def list_from_links(
    pages: DataFrame,
    key: str,
    paths: Sequence[str] = V.PROFILE_PATHS,
    stop_words: Sequence[str] = V.LINK_STOP_WORDS,
) -> DataFrame:
    """Labels of links to profile pages."""
    links = pages.select(key, F.posexplode(hx.anchors(F.col("html"))).alias("pos", "_a")).select(
        key, "pos", F.col("_a.label").alias("name"), F.col("_a.href").alias("url")
    )
    return _clean(links.filter(any_of(F.col("url"), list(paths))), key, stop_words)


def list_from_lines(
    pages: DataFrame,
    key: str,
    text: str = "text",
    pattern: str = r"\n\s*\d+[\.\s]+([^\n]+)",
    stop_words: Sequence[str] = V.LINE_STOP_WORDS,
    first: int = 50,
) -> DataFrame:
    """Fallback: the first numbered lines of the page text."""
    lines = F.slice(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), 1, first)
    rows = pages.select(key, F.posexplode(lines).alias("pos", "_l")).select(
        key, "pos", strip(F.col("_l")).alias("name"), F.lit("").alias("url")
    )
    return _clean(rows, key, stop_words)


def first_method(methods: Sequence[DataFrame], key: str, first: int = 50) -> DataFrame:
    """Rows of the first extraction method that found anything on a page, the first ``first`` of them."""
    rows = union_rows(
        [m.select(key, "pos", "name", "url", F.lit(i).alias("method_no")) for i, m in enumerate(methods, 1)]
    )
    # A group is what one page holds; both windows share one shuffle by page.
    page = Window.partitionBy(key)
    kept = rows.withColumn("_first", F.min("method_no").over(page)).filter(F.col("method_no") == F.col("_first"))
    number = F.row_number().over(page.orderBy("pos", "name"))
    return kept.drop("_first").withColumn("n", number).filter(F.col("n") <= first)


LISTED = "array<struct<name:string,url:string>>"


def cascade(
    pages: DataFrame,
    key: str,
    text: str = "text",
    base: str | None = None,
    numbered: str = r"^(\d+)[.\s]+(.+)$",
    heading_stop_words: Sequence[str] = V.HEADING_STOP_WORDS,
    top: int = 50,
    paths: Sequence[str] = V.PROFILE_PATHS,
    link_stop_words: Sequence[str] = V.LINK_STOP_WORDS,
    pattern: str = r"\n\s*\d+[\.\s]+([^\n]+)",
    line_stop_words: Sequence[str] = V.LINE_STOP_WORDS,
    first: int = 50,
) -> DataFrame:
    """``key, pos, name, url, method_no, n``: what ``first_method`` gives for the five list methods, from one pass over the pages.

    Each page gets one array per method; the first that isn't empty is taken, and its first ``first`` entries become rows. A page is parsed
    once, for both parser methods, and only if its JSON-LD lists nothing. Nothing is shuffled. With ``base``, relative links of
    the methods 2 to 4 are joined to it.
    """
    none = F.array().cast("array<struct<pos:int,name:string,url:string>>")

    def entries(found: Column, name: Callable[[Column], Column], url: Callable[[Column], Column]) -> Column:
        return F.transform(found, lambda x, i: F.struct(i.alias("pos"), name(x).alias("name"), url(x).alias("url")))

    def first_of_equal(rows: Column) -> Column:
        return let(F.transform(rows, lambda x: x["name"]), lambda names: F.filter(rows, lambda x, i: F.array_position(names, x["name"]) == i + 1))

    def clean(rows: Column, stop_words: Sequence[str]) -> Column:
        return F.filter(rows, lambda x: (F.length(x["name"]) > 2) & (F.length(x["name"]) < 100) & ~any_of(F.lower(x["name"]), list(stop_words)))

    def joined(url: Column) -> Column:
        return F.when(F.coalesce(url, F.lit("")) != "", urls.resolve(F.lit(base), url)).otherwise(url) if base else url

    @F.pandas_udf(f"selectors {LISTED}, headings {LISTED}")
    def parsed(html: pd.Series) -> pd.DataFrame:
        trees = [Elements(page) if page is not None else None for page in html]
        listed = lambda found: [[] if t is None else [{"name": n, "url": u} for n, u in found(t)] for t in trees]
        return pd.DataFrame({"selectors": listed(_listed), "headings": listed(_headed)})

    scripts = F.regexp_extract_all("html", F.lit(hx.LD_JSON), F.lit(1))
    item = "itemListElement array<struct<name:string,url:string>>"
    items = F.flatten(F.transform(scripts, lambda x: F.coalesce(F.from_json(x, item)["itemListElement"], F.array().cast(LISTED))))
    by_ld_json = F.filter(entries(items, lambda x: x["name"], lambda x: F.coalesce(x["url"], F.lit(""))), lambda x: (F.length(x["name"]) > 0) & (F.length(x["name"]) < 100))
    rows = pages.select(key, "html", F.col(text).alias("_text"), F.coalesce(first_of_equal(by_ld_json), none).alias("_m1"))
    # Called non-deterministic so that the optimizer keeps it out of the lambdas below, where it can't be run.
    rows = rows.withColumn("_parsed", parsed.asNondeterministic()(F.when(F.size("_m1") == 0, F.col("html"))))
    by_selectors = clean(entries(F.col("_parsed.selectors"), lambda x: F.regexp_replace(x["name"], r"^\d+\.?\s*", ""), lambda x: joined(x["url"])), [])

    def ranked(x: Column) -> Column:
        rank = F.regexp_replace(F.regexp_extract(x["name"], numbered, 1), "^0+(?=.)", "")
        return F.coalesce(F.when(F.length(rank).between(1, 9), rank.try_cast("int")).between(1, top), F.lit(False))

    heads = F.transform(F.col("_parsed.headings"), lambda x, i: F.struct(i.alias("pos"), x["name"].alias("label"), ranked(x).alias("ranked"), strip(F.regexp_extract(x["name"], numbered, 2)).alias("name"), joined(x["url"]).alias("url")))
    heads = F.transform(F.filter(heads, lambda x: x["ranked"] & ~F.regexp_like(x["name"], F.lit(r"^\d+$"))), lambda x: F.struct(x["pos"].alias("pos"), x["name"].alias("name"), x["url"].alias("url")))
    links = F.filter(entries(hx.anchors(F.col("html")), lambda x: x["label"], lambda x: x["href"]), lambda x: any_of(x["url"], list(paths)))
    links = F.transform(links, lambda x: F.struct(x["pos"].alias("pos"), x["name"].alias("name"), joined(x["url"]).alias("url")))
    lines = entries(F.slice(F.regexp_extract_all("_text", F.lit(pattern), F.lit(1)), 1, first), strip, lambda x: F.lit(""))
    later = [by_selectors, clean(heads, heading_stop_words), clean(links, link_stop_words), clean(lines, line_stop_words)]
    # Tried in order: a method is evaluated only where those before it found nothing.
    found = F.when(F.size("_m1") > 0, F.struct(F.lit(1).alias("method_no"), F.col("_m1").alias("rows")))
    tried = [F.struct(F.lit(i).alias("method_no"), first_of_equal(m).alias("rows")) for i, m in enumerate(later, 2)]
    picked = F.coalesce(found, *[F.when(F.size(m["rows"]) > 0, m) for m in tried])
    rows = rows.select(key, picked.alias("_found")).filter(F.col("_found").isNotNull())
    rows = rows.select(key, F.col("_found.method_no").alias("method_no"), F.posexplode(F.slice("_found.rows", 1, first)).alias("n", "_r"))
    return rows.select(key, "_r.pos", "_r.name", "_r.url", "method_no", (F.col("n") + 1).alias("n"))


def ld_json_details(pages: DataFrame, key: str) -> DataFrame:
    """Website, address and founding year of JSON-LD blocks: last address and year win, first URL wins."""
    schema = (
        "url string, address struct<addressLocality:string,addressCountry:string>, foundingDate string"
    )
    scripts = F.transform(
        F.regexp_extract_all("html", F.lit(hx.LD_JSON), F.lit(1)), lambda s: F.from_json(s, schema)
    )
    year = F.regexp_extract(F.coalesce("_s.foundingDate", F.lit("")), r"\d{4}", 0)
    rows = pages.select(key, F.posexplode_outer(scripts).alias("pos", "_s")).select(
        key,
        "pos",
        F.col("_s.url").alias("url"),
        F.col("_s.address").alias("address"),
        F.when(year != "", year.cast("int")).alias("year"),
    )

    def edge(agg, value: str) -> Column:
        return agg(F.col(value), F.when(F.col(value).isNotNull(), F.col("pos")))

    return (
        rows.groupBy(key)
        .agg(
            edge(F.min_by, "url").alias("website"),
            edge(F.max_by, "address").alias("_a"),
            edge(F.max_by, "year").alias("founded_year"),
        )
        .select(
            key,
            "website",
            F.col("_a.addressLocality").alias("hq_city"),
            F.col("_a.addressCountry").alias("hq_country"),
            "founded_year",
        )
    )


def hq_and_year(
    text: Column, hq: Sequence[str] = V.HQ_PATTERNS, founded: Sequence[str] = V.FOUNDED_PATTERNS
) -> dict[str, Column]:
    """City, country and founding year by ordered patterns."""
    return {
        "hq_city": hx.first_pattern(text, hq, 1),
        "hq_country": hx.first_pattern(text, hq, 2),
        "founded_year": hx.founded_year(text, founded),
    }
