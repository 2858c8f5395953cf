"""Dashboard sections as column expressions over one payload row.

``c`` is the company struct (``schemas.PROFILE_DDL``); lists are the payload's arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from venturelens import vocabulary as V
from venturelens.functions.text import string_array


def money(value: Column) -> Column:
    """``$1,234``; null is ``Not disclosed``."""
    shown = F.when(value < 0, F.concat(F.lit("$-"), F.format_number(-value, 0))).otherwise(
        F.concat(F.lit("$"), F.format_number(value, 0))
    )
    return F.coalesce(shown, F.lit(V.NOT_DISCLOSED))


def money_if_any(value: Column) -> Column:
    """As ``money``, but zero also counts as not disclosed."""
    return F.when(value != 0, money(value)).otherwise(F.lit(V.NOT_DISCLOSED))


def disclosed(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text != "", text).otherwise(F.lit(V.NOT_DISCLOSED))


def listed(values: Column) -> Column:
    """Comma list, or null where there is nothing to list."""
    joined = F.array_join(values, ", ")
    return F.when(joined != "", joined)


def item(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"- **{label}**: "), F.coalesce(value, F.lit(V.NOT_DISCLOSED)))


def lines(*parts: Column) -> Column:
    return F.concat_ws("\n", *parts)


def overview(c: Column) -> Column:
    hq = F.concat_ws(
        ", ", *[F.when(c[x] != "", c[x]) for x in ("hq_city", "hq_state", "hq_country")]
    )
    positioning = F.coalesce(
        F.when(c["competitive_differentiation"] != "", c["competitive_differentiation"]),
        listed(c["related_companies"]),
    )
    return lines(
        item(
            "Legal Name / Brand",
            F.concat_ws(
                " / ",
                F.coalesce(c["legal_name"], F.lit(V.NOT_DISCLOSED)),
                F.coalesce(c["brand_name"], F.lit(V.NOT_DISCLOSED)),
            ),
        ),
        item("Headquarters", disclosed(hq)),
        item("Founded", c["founded_year"].cast("string")),
        item("Categories", listed(c["categories"])),
        item("Related Companies / Positioning", positioning),
    )


def named_customers(products: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.flatten(F.transform(products, lambda p: F.coalesce(p["reference_customers"], empty)))


def business(c: Column, products: Column) -> Column:
    return business_text(c, named_customers(products))


def business_text(c: Column, customer_names: Column) -> Column:
    tiers = listed(c["pricing_tiers_public"])
    pricing = F.concat_ws(" | ", F.coalesce(c["pricing_model"], F.lit(V.NOT_DISCLOSED)), tiers)
    partners = F.concat(F.lit("Partners: "), listed(c["technology_partnerships"]))
    customers = F.concat(F.lit("Customers: "), listed(customer_names))
    return lines(
        item("Who they sell to", listed(c["target_customer_segments"])),
        item("Pricing Model / Tiers", pricing),
        item("Integration Partners / Named Customers", disclosed(F.concat_ws(" | ", partners, customers))),
        item("Go-to-Market Motion", c["sales_motion"]),
    )


def funding_line(e: Column) -> Column:
    return F.concat(
        F.lit("- round_name: "), disclosed(e["round_name"]),
        F.lit("; amount_usd: "), money_if_any(e["amount_usd"]),
        F.lit("; investors: "), F.coalesce(listed(e["investors"]), F.lit(V.NOT_DISCLOSED)),
        F.lit("; valuation_usd: "), money_if_any(e["valuation_usd"]),
        F.lit("; occurred_on: "), disclosed(e["occurred_on"]),
    )


def of_types(events: Column, types: Sequence[str]) -> Column:
    return F.filter(events, lambda e: F.lower(e["event_type"]).isin(list(types)))


def funding(c: Column, events: Column) -> Column:
    rounds = F.filter(events, lambda e: e["event_type"] == "funding")
    return funding_text(c, F.transform(rounds, funding_line))


def funding_text(c: Column, rounds: Column) -> Column:
    """The section from the lines of its rounds."""
    shown = F.array_join(rounds, "\n")
    return lines(
        item("Total Raised", money_if_any(c["total_raised_usd"])),
        item("Latest Round", c["last_round_name"]),
        F.when(shown != "", shown).otherwise(F.lit(V.NO_FUNDING)),
    )


def recent_funding_line(e: Column) -> Column:
    return F.concat(
        F.lit("- **"), F.coalesce(e["occurred_on"].cast("string"), F.lit("Unknown date")),
        F.lit("**: "), F.coalesce(e["description"], F.lit("No description")),
    )


def recent_funding(events: Column, n: int = 3) -> Column:
    """The last ``n`` funding events as ``date: description`` lines."""
    rounds = F.filter(events, lambda e: e["event_type"] == "funding")
    last = F.slice(rounds, F.greatest(F.size(rounds) - (n - 1), F.lit(1)), F.lit(n))
    return recent_funding_text(F.transform(last, recent_funding_line))


def recent_funding_text(rounds: Column) -> Column:
    shown = F.array_join(rounds, "\n")
    return F.when(shown != "", shown).otherwise(F.lit(V.NO_RECENT_FUNDING))


def _event_title(e: Column) -> Column:
    return F.coalesce(F.when(e["title"] != "", e["title"]), F.when(e["description"] != "", e["description"]))


def is_traction(e: Column, types: Sequence[str] = V.TRACTION_TYPES) -> Column:
    return e["event_type"].isin(list(types)) & (e["occurred_on"].isNotNull() | _event_title(e).isNotNull())


def traction_line(e: Column) -> Column:
    text = F.concat(F.coalesce(e["occurred_on"].cast("string"), F.lit("")), F.lit(" - "), F.coalesce(_event_title(e), F.lit("")))
    return F.regexp_replace(text, r"^[ \-]+|[ \-]+$", "")


def traction(events: Column, types: Sequence[str] = V.TRACTION_TYPES) -> Column:
    """``date - title`` of the traction events, joined by ``; ``; null if there is none."""
    return traction_text(F.transform(F.filter(events, lambda e: is_traction(e, types)), traction_line))


def traction_text(found: Column) -> Column:
    shown = F.array_join(found, "; ")
    return F.when(shown != "", shown)


def latest(items: Column, by: str = "as_of") -> Column:
    """The entry with the highest ``by`` value of a list, null if the list is empty."""

    def order(a: Column, b: Column) -> Column:
        return F.when(a[by] < b[by], -1).when(a[by] > b[by], 1).otherwise(0)

    dated = F.filter(items, lambda x: x[by].isNotNull())
    return F.try_element_at(F.array_sort(dated, order), F.lit(-1))


def growth(c: Column, events: Column, snapshot: Column) -> Column:
    return growth_text(c, traction(events), snapshot)


def growth_text(c: Column, recent: Column, snapshot: Column) -> Column:
    focus = F.concat_ws(
        ", ",
        F.concat(F.lit("engineering_openings: "), snapshot["engineering_openings"].cast("string")),
        F.concat(F.lit("sales_openings: "), snapshot["sales_openings"].cast("string")),
    )
    geo = F.coalesce(listed(snapshot["geo_presence"]), listed(c["geographic_markets"]))
    return lines(
        item("Headcount", snapshot["headcount_total"].cast("string")),
        item("Headcount Growth %", snapshot["headcount_growth_pct"].cast("string")),
        item("Hiring Focus", disclosed(focus)),
        item("Geo Presence", geo),
        item("Recent Events", recent),
    )


def merged_visibility(c: Column, top: Column, own: bool = True) -> Column:
    """Visibility of the company record, field by field over the payload's own; ``own`` tells whether the record has the field."""
    names = ["news_mentions_30d", "avg_sentiment", "github_stars", "glassdoor_rating", "attention_trend"]
    return F.struct(*[(F.coalesce(c["visibility"][n], top[n]) if own else top[n]).alias(n) for n in names])


def visibility(v: Column) -> Column:
    return lines(*[item(label, v[name].cast("string")) for label, name in V.VISIBILITY_LABELS.items()])


def risk_line(e: Column) -> Column:
    title = F.coalesce(_event_title(e), F.lower(e["event_type"]))
    return F.trim(F.concat(F.lit("- "), F.coalesce(e["occurred_on"].cast("string"), F.lit("")), F.lit(" "), title))


def risks(events: Column, types: Sequence[str] = V.RISK_TYPES) -> Column:
    return risks_text(F.transform(of_types(events, types), risk_line))


def risks_text(found: Column) -> Column:
    shown = F.array_join(found, "\n")
    return F.when(shown != "", shown).otherwise(F.lit(V.NOT_DISCLOSED))


def outlook(c: Column) -> Column:
    return F.concat(
        F.coalesce(c["legal_name"], F.lit("The company")),
        F.lit(" operates in "), F.coalesce(listed(c["categories"]), F.lit("its category")),
        F.lit(" serving "), F.coalesce(listed(c["target_customer_segments"]), F.lit("its target customers")),
        F.lit(V.OUTLOOK_END),
    )


def gaps(c: Column, v: Column, customers: Column) -> Column:
    def missing(test: Column, line: str) -> Column:
        return F.when(F.coalesce(test, F.lit(True)), F.lit(line))

    found = F.concat_ws(
        "\n",
        missing(c["total_raised_usd"] == 0, V.GAP_RAISED),
        missing(c["last_disclosed_valuation_usd"] == 0, V.GAP_VALUATION),
        missing(v["glassdoor_rating"] == 0, V.GAP_RATING),
        missing(F.size(c["pricing_tiers_public"]) <= 0, V.GAP_PRICING),
        missing(F.size(customers) <= 0, V.GAP_CUSTOMERS),
    )
    return F.when(found != "", found).otherwise(F.lit(V.NO_GAPS))


def compose(title: Column, generated_at: Column, pipeline: str, bodies: Sequence[Column], sections: Sequence[str] = V.SECTIONS) -> Column:
    """Title, run time, pipeline name and the headed sections in their fixed order."""
    head = lines(
        F.concat(F.lit("# "), title, F.lit(" Dashboard")),
        F.concat(F.lit("*Generated: "), generated_at, F.lit("*")),
        F.lit(f"*Pipeline: {pipeline}*"),
    )
    blocks = [lines(F.lit(s), b) for s, b in zip(sections, bodies, strict=True)]
    return F.concat_ws("\n\n", head, *blocks)


def headquarters(city: Column, country: Column) -> Column:
    """``city, country`` without loose commas or blanks at the ends."""
    text = F.concat(F.coalesce(city, F.lit("")), F.lit(", "), F.coalesce(country, F.lit("")))
    return F.regexp_replace(text, r"^[, ]+|[, ]+$", "")


def name_variants(name: Column) -> Column:
    """File names a dashboard may have, in order of preference."""
    from venturelens.functions.urls import file_slug

    slug = file_slug(name)
    first_upper = F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.substring(name, F.lit(2), F.length(name))))
    stems = [F.concat(slug, F.lit("_dashboard")), slug, name, F.lower(name), first_upper]
    return F.array_distinct(F.array(*[F.concat(s, F.lit(".md")) for s in stems]))


def missing_sections(dashboard: Column, sections: Sequence[str] = V.SECTIONS) -> Column:
    return F.filter(string_array(sections), lambda s: ~F.contains(dashboard, s))


def sections_in_order(dashboard: Column, sections: Sequence[str] = V.SECTIONS) -> Column:
    """All sections present, in increasing position (so the last named section comes last)."""
    at = [F.instr(dashboard, s) for s in sections]
    ok = at[0] > 0
    for a, b in zip(at, at[1:]):
        ok = ok & (b > a)
    return ok
