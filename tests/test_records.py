import json

from pyspark.sql import functions as F

from tests.conftest import plan_of
from venturelens import schemas as S
from venturelens.functions import markdown as md
from venturelens.operators import dashboard, evaluation, records, skew


def items(spark, *docs):
    rows = [(d.get("company_id", "c") if isinstance(d, dict) else "c", json.dumps(d) if isinstance(d, dict) else d) for d in docs]
    return spark.createDataFrame(rows, "company_id string, json string")


GOOD = {"event_id": "e", "company_id": "c", "occurred_on": "2024-02-29", "event_type": "funding", "title": "T"}


def errors_of(spark, *docs, entity="events"):
    return [r.errors for r in records.validate(items(spark, *docs), S.ENTITIES[entity]).collect()]


def test_validation_rules(spark):
    assert errors_of(
        spark,
        {**GOOD, "amount_usd": "12.5", "undeclared": 1},
        {k: v for k, v in GOOD.items() if k != "title"},
        {**GOOD, "occurred_on": "2023-02-29"},
        {**GOOD, "event_type": "party"},
        {**GOOD, "amount_usd": "lots"},
        {**GOOD, "provenance": [{"source_url": "nowhere", "crawled_at": "x"}]},
        "not json",
    ) == [
        [], ["title missing"], ["occurred_on is no date"], ["event_type unknown"], ["amount_usd is no double"],
        ["provenance is not valid"], ["not a record"] + [f"{n} missing" for n in ("event_id", "company_id", "occurred_on", "event_type", "title")],
    ]


def test_defaults_and_coercion(spark):
    row = records.validate(
        items(spark, {"company_id": "c", "legal_name": "L", "founded_year": "1999", "website": "https://x.test"}), S.ENTITIES["company"]
    ).first()
    assert (row.founded_year, row.categories, row.schema_version, row.errors) == (1999, [], "2.0.0", [])
    assert errors_of(spark, {"company_id": "c", "legal_name": "L", "website": "x.test"}, entity="company") == [["website is no url"]]


def test_one_bad_item_rejects_the_company(spark):
    checked = records.validate(
        items(spark, {**GOOD, "company_id": "a"}, {**GOOD, "company_id": "b"}, {**GOOD, "company_id": "b", "title": None}), S.ENTITIES["events"]
    )
    good, bad = records.split_valid(checked)
    assert [r.company_id for r in good.collect()] == ["a"] and bad.count() == 1


def sample(spark, n_events=6):
    company = records.conform(
        spark.createDataFrame([("a", "Example AI Inc."), ("b", "Empty Co.")], "company_id string, legal_name string"), S.PROFILE
    )
    rows = [("a", f"e{i:03d}", f"2024-01-{1 + i % 28:02d}", "funding" if i % 2 else "layoff", f"T{i}") for i in range(n_events)]
    events = records.conform(
        spark.createDataFrame(rows, "company_id string, event_id string, occurred_on string, event_type string, title string"),
        S.columns_of("events"),
    )
    empty = {n: records.conform(spark.createDataFrame([], "company_id string"), S.columns_of(n)) for n in S.CHILDREN if n != "events"}
    return company, {"events": events, **empty}


def test_payload_round_trip(spark):
    company, children = sample(spark)
    p = records.assemble_payloads(company, children)
    rows = {r.company_id: r for r in p.collect()}
    assert [e.event_id for e in rows["a"].events] == sorted(e.event_id for e in rows["a"].events)
    assert rows["b"].events == [] and rows["b"].products == []
    back = {tuple(r) for r in records.flatten_payloads(p, "events").select("event_id", "title").collect()}
    assert back == {tuple(r) for r in children["events"].select("event_id", "title").collect()}


def test_a_company_with_far_more_children_is_one_row_and_one_dashboard(spark):
    from venturelens.operators import dashboard

    company, children = sample(spark, 5000)
    snapshots = spark.createDataFrame([("a", "2024-01-01", 7), ("a", "2024-06-01", 77)], "company_id string, as_of string, headcount_total int")
    children["snapshots"] = records.conform(snapshots, S.columns_of("snapshots"))
    p = records.assemble_payloads(company, children)
    assert {r.company_id: r.n for r in p.select("company_id", F.size("events").alias("n")).collect()} == {"a": 5000, "b": 0}
    text = {r.company_id: r.dashboard for r in dashboard.structured_dashboards(p, "now").collect()}
    assert len(text) == 2 and "77" in text["a"] and "No funding events" not in text["a"]


def test_parts_of_a_company_with_most_children(spark):
    company, children = sample(spark, 5000)
    few = spark.createDataFrame([("b", "x1", "2024-05-05", "funding", "Seed")], "company_id string, event_id string, occurred_on string, event_type string, title string")
    children["events"] = children["events"].unionByName(records.conform(few, S.columns_of("events")))
    parts = records.payload_parts(children, part_rows=100).cache()
    rows = parts.select("company_id", "entity", "n_items", "n_parts", "part", F.size("events").alias("n")).collect()
    assert {(r.company_id, r.n_items, r.n_parts) for r in rows} == {("a", 5000, 50), ("b", 1, 1)}
    assert sum(r.n for r in rows) == 5001 and max(r.n for r in rows) < 200 and len({(r.company_id, r.part) for r in rows}) == len(rows)
    back = sorted(map(tuple, records.flatten_parts(parts, "events").collect()))
    assert back == sorted(map(tuple, children["events"].collect()))
    assert records.flatten_parts(parts, "products").count() == 0
    whole = records.assemble_payloads(company, children)
    nested = records.nested_payloads(company, parts)
    assert nested.schema["events"].dataType == whole.schema["events"].dataType
    assert sorted(map(str, nested.collect())) == sorted(map(str, whole.collect()))
    one = records.nested_payloads(company.filter("company_id = 'b'"), parts).collect()
    assert [(r.company_id, len(r.events)) for r in one] == [("b", 1)]
    assert {(r.company_id, r.entity, r.n_items) for r in records.payload_counts(children).collect()} == {("a", "events", 5000), ("b", "events", 1)}


def test_dashboards_by_sections_equal_those_of_payloads(spark):
    company, children = sample(spark, 300)
    snapshots = spark.createDataFrame([("a", "2024-01-01", 7), ("a", "2024-06-01", 77)], "company_id string, as_of string, headcount_total int")
    children["snapshots"] = records.conform(snapshots, S.columns_of("snapshots"))
    products = spark.createDataFrame([("a", "p2", ["X", "Y"]), ("a", "p1", ["Z", "X"]), ("a", "p3", None), ("b", "p4", [])], "company_id string, product_id string, reference_customers array<string>")
    children["products"] = records.conform(products, S.columns_of("products"))
    seen = spark.createDataFrame([("a", "2024-01-01", 5), ("a", "2024-03-01", 9)], "company_id string, as_of string, github_stars int")
    children["visibility"] = records.conform(seen, S.columns_of("visibility"))
    for newest in (True, False):
        by_sections = dashboard.dashboards(company, children, "now", newest=newest)
        by_payloads = dashboard.structured_dashboards(records.assemble_payloads(company, children), "now", newest=newest)
        assert sorted(map(tuple, by_sections.collect())) == sorted(map(tuple, by_payloads.collect()))
    text = plan_of(by_sections)
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_dashboards_of_the_plain_company_schema(spark):
    from venturelens.plans import structured

    _, children = sample(spark, 0)
    company = records.conform(spark.createDataFrame([("a", "Plain")], "company_id string, legal_name string"), S.columns_of("company"))
    children["snapshots"] = records.conform(
        spark.createDataFrame([("a", "2024-01-01", 5), ("a", "2024-09-01", 9)], "company_id string, as_of string, headcount_total int"), S.columns_of("snapshots")
    )
    text = structured.dashboards_from_tables(company, children, "t").first().dashboard
    assert "**Headcount**: 9" in text and "**GitHub Stars**: Not disclosed" in text


def test_no_job_runs_while_a_payload_plan_is_built(spark):
    company, children = sample(spark)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    records.assemble_payloads(company, children)
    records.payload_parts(children)
    dashboard.dashboards(company, children, "now")
    assert len(tracker.getJobIdsForGroup()) == before


def test_keyed_join_kinds(spark):
    big = spark.range(600).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 7).alias("k"), "id")
    small = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "k int, v string")
    counts = {how: skew.keyed_join(big, small, ["k"], how).count() for how in ("inner", "left", "left_semi", "left_anti")}
    assert counts["left"] == 600 and counts["inner"] == counts["left_semi"] == 600 - counts["left_anti"]


def test_top_per_group_equals_plain_ranking(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), ((F.col("id") * 7919) % 101).alias("s"), "id")
    want = {}
    for r in df.collect():
        want.setdefault(r.k, []).append((-r.s, r.id))
    got = {}
    for r in skew.top_per_group(df, ["k"], [F.col("s").desc(), F.col("id")], 4, ["id"]).orderBy("k", "rank").collect():
        got.setdefault(r.k, []).append((-r.s, r.id))
    assert got == {k: sorted(v)[:4] for k, v in want.items()}


def test_dashboard_of_a_bare_company(spark):
    company, children = sample(spark, 0)
    rows = dashboard.structured_dashboards(records.assemble_payloads(company, children), "now").collect()
    text = {r.company_id: r.dashboard for r in rows}["b"]
    assert text.startswith("# Empty Co. Dashboard\n*Generated: now*\n*Pipeline: Structured*\n\n## Company Overview\n- **Legal Name / Brand**: Empty Co. / Not disclosed")
    assert "- No funding events disclosed" in text and text.endswith("- Named customers not publicly listed")
    report = evaluation.section_report(spark.createDataFrame([(text,)], "dashboard string")).first()
    assert (report.missing_sections, report.in_order, report.ends_with_last) == ([], True, True)


def test_required_sections_of_the_small_mock(spark):
    company, children = sample(spark, 0)
    event = spark.createDataFrame([("a", "e", "2024-01-01", "funding", "x", "Series A funding round")], "company_id string, event_id string, occurred_on string, event_type string, title string, description string")
    children["events"] = records.conform(event, S.columns_of("events"))
    p = records.assemble_payloads(company, children)
    assert {r.s for r in p.select(md.recent_funding(F.col("events")).alias("s")).collect()} == {
        "- **2024-01-01**: Series A funding round", "- No recent funding events disclosed",
    }
    text = dashboard.structured_dashboards(p, "now").filter("company_id = 'a'").first().dashboard
    assert "## Company Overview" in text and "## Funding & Investor Profile" in text


def test_money(spark):
    df = spark.createDataFrame([(0, 1234567.5), (1, None), (2, -5.0), (3, 0.5)], "i int, v double")
    assert [r.m for r in df.orderBy("i").select(md.money(F.col("v")).alias("m")).collect()] == ["$1,234,568", "Not disclosed", "$-5", "$0"]


def test_newest_snapshot_option(spark):
    company, children = sample(spark, 0)
    snaps = spark.createDataFrame([("a", "2024-01-01", 5), ("a", "2024-09-01", 9)], "company_id string, as_of string, headcount_total int")
    children["snapshots"] = records.conform(snaps, S.columns_of("snapshots"))
    p = records.assemble_payloads(company, children).filter("company_id = 'a'")
    assert "**Headcount**: 9" in dashboard.structured_dashboards(p, "t").first().dashboard
    assert "**Headcount**: 5" in dashboard.structured_dashboards(p, "t", newest=False).first().dashboard


def test_assembly_has_one_shuffle_of_children(spark, sf):
    from workload.dashboards import payloads

    text = plan_of(payloads(spark, sf))
    assert "CartesianProduct" not in text and "Python" not in text


def test_payloads_take_one_shuffle_of_bare_rows(spark):
    """No list is built before the shuffle, and no join sorts payloads afterwards."""
    company = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "company_id string")
    events = spark.createDataFrame([("e2", "a", 2), ("e1", "a", 1), ("e3", None, 3), ("e4", "x", 4)], "event_id string, company_id string, occurred_on int")
    p = records.assemble_payloads(company, {"events": events})
    plan = plan_of(p)
    assert plan.count("Exchange") == 1 and "Join" not in plan and "partial_collect_list" not in plan[plan.index("Exchange"):]
    got = sorted((r.company_id or "", [e.event_id for e in r.events]) for r in p.collect())
    assert got == [("", []), ("a", ["e1", "e2"]), ("b", []), ("b", [])]


def test_parts_of_a_long_list_are_built_in_several_tasks(spark):
    """Where the counts are too many to broadcast, a company's items still don't meet in one task."""
    events = spark.range(400).select(F.format_string("e%04d", "id").alias("event_id"), F.when(F.col("id") == 0, "b").otherwise(F.lit("a")).alias("company_id"), F.lit(1).alias("occurred_on"))
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        parts = records.payload_parts({"events": events}, part_rows=5).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k in changed:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    long = [p for p in parts if p.company_id == "a"]
    assert {(p.n_items, p.n_parts) for p in long} == {(399, 80)} and len({p.part for p in long}) == len(long)
    assert sorted(x.v.event_id for p in long for x in p.events) == [f"e{i:04d}" for i in range(1, 400)]
    assert len({p.task for p in long}) > 1
