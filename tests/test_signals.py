import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from venturelens.functions import signals as sg
from venturelens.functions import urls
from venturelens.operators import signals as ops


@pytest.mark.parametrize(
    "text, want",
    [
        ("We are a team of 120 people", (120, "120", 0.8)),
        ("120+ employees", (120, "120+", 0.8)),
        ("between 20 and 40 people", (40, "40", 0.8)),
        ("3 people", (None, None, 0.0)),
        ("team of 3, workforce of 900", (900, "900", 0.8)),
        ("999999999999999999999999 employees, staff of 50", (50, "50", 0.8)),
        ("", (None, None, 0.0)),
    ],
)
def test_headcount(spark, text, want):
    assert tuple(values(spark, sg.headcount, text)[0]) == want


def test_range_first(spark):
    by_range = values(spark, lambda x: sg.headcount(x, range_first=True), "50-100 employees", "7 people")
    assert [tuple(r) for r in by_range] == [(75, "50-100", 0.6), (7, "7", 0.8)]


@pytest.mark.parametrize(
    "text, want",
    [
        ("12 open positions", (12, 0.7)),
        ("600 jobs", (None, 0.0)),
        ("a coordinator and an associate", (2, 0.6)),
        ("apply now apply now apply now apply now", (2, 0.4)),
        ("apply now", (None, 0.0)),
        (None, (None, 0.0)),
    ],
)
def test_openings(spark, text, want):
    assert tuple(values(spark, sg.job_openings, text)[0]) == want


def test_focus_places_policy(spark):
    assert values(spark, sg.hiring_focus, "Software and brand work") == [["engineering", "marketing"]]
    got = values(spark, sg.office_locations, "Based in Oslo and offices at london. Headquarters in New York")
    assert got == [["London", "New York", "Oslo"]]
    assert values(spark, sg.remote_policy, "Remote-first", "hybrid", "on-site", "none") == [
        "Remote-first", "Hybrid", "In-office", None,
    ]


def test_repo_parsing(spark):
    texts = ["https://github.com/org/name.git", "https://github.com/org/name.github.io", "http://github.com/org/", "https://x.test/a/b"]
    assert values(spark, urls.repo_owner, *texts) == ["org", "org", "org", None]
    assert values(spark, urls.repo_name, *texts) == ["name", "name.github.io", "", None]


def test_contributors(spark):
    df = spark.createDataFrame(
        [(0, '<x?page=2>; rel="next", <x?page=57>; rel="last"', "[1]"), (1, None, "[1,2,3]"), (2, "", None)],
        "i int, link string, body string",
    )
    rows = df.orderBy("i").select(ops.contributors(F.col("link"), F.col("body")).alias("n")).collect()
    assert [r.n for r in rows] == [57, 3, None]


def test_main_repo_ties_go_to_lowest_url(spark):
    df = spark.createDataFrame(
        [("c", u, s, 1, None, None, [], None) for u, s in [("b", 5), ("a", 5), ("z", 1)]],
        "company_id string, repo_url string, stars int, forks int, contributors int, language string, topics array<string>, pushed_at string",
    )
    assert ops.visibility_rows(df).first().github_url == "a"


def test_visibility_from_pages(spark):
    from venturelens.plans.structured import visibility_from_pages

    pages = spark.createDataFrame(
        [("a", "See https://github.com/acme and https://www.github.com/acme/side"), ("b", "https://github.com/none/x"), ("c", "no link")],
        "company_id string, text string",
    )
    repos = spark.createDataFrame(
        [("acme", "platform", 200, None, '{"stargazers_count": 9, "topics": ["ml"]}'), ("acme", "core", 200, None, '{"stargazers_count": 99}'),
         ("acme", "side", 200, None, '{"stargazers_count": 3}'), ("none", "x", 404, None, "{}")],
        "owner string, repo string, status int, link_header string, body string",
    )
    people = spark.createDataFrame([("acme", "platform", 200, None, "[1, 2]")], "owner string, repo string, status int, link_header string, body string")
    rows = visibility_from_pages(pages, repos, people).collect()
    assert [(r.company_id, r.github_url, r.github_stars, r.github_contributors, r.github_topics) for r in rows] == [
        ("a", "https://github.com/acme/platform", 9, 2, ["ml"])
    ]
