import html

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, values
from venturelens.functions import html as hx
from venturelens.functions import urls
from venturelens.operators import pages as pg
from workload import REGISTRY

PAGE = """<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{x}</style><script>var a="</p>";</script></head>
<body><nav><a href="/n">Nav</a></nav><!-- gone --><p>Hello <b>big</b> world&#33;  Two&nbsp;parts</p><p>ab</p>
<div class="Site-Footer"><a href="/careers?x=1&amp;y=2">Work with us</a><a href="#top">Top</a><a href="https://www.linkedin.com/company/ex/?t=1" aria-label="Network"></a></div></body></html>"""


def frame(spark, page=PAGE):
    return spark.createDataFrame([(1, page)], "id int, html string")


def test_regex_and_parser_text_agree(spark):
    regex = values(spark, hx.visible_text, PAGE)[0]
    assert regex == pg.parse_text(frame(spark)).first().text
    assert "gone" not in regex and "var a" not in regex and "Hello big world!" in regex and "A & B" in regex
    main = values(spark, hx.main_text, PAGE)[0]
    assert main == pg.parse_text(frame(spark), main=True).first().text
    assert "Nav" not in main and "\nab\n" not in main and "Hello\n" in main


def test_parser_respects_nesting(spark):
    page = "<header>x<header>inner text</header>outer text</header><p>kept text</p>"
    assert pg.parse_text(frame(spark, page), main=True).first().text == "kept text"


def test_unclosed_script_runs_to_the_end(spark):
    assert values(spark, hx.visible_text, "<p>a</p><script>never closed <b>x</b>") == ["a"]


def test_entities_without_semicolon(spark):
    odd = ["&copy 2024", "a&ampb", "&#65 x", "&#x41z &#66", "&notit; &nosuch x", "&lt", "&gtx&", "&ampfoo; &AMP", "&frac12x &thetasym", "& &# &#x &#xg;"]
    assert values(spark, hx.decode_entities, *odd) == [html.unescape(x) for x in odd]


def test_text_with_loose_signs_is_one_node(spark):
    cases = ["<p>a < b and c > d</p>", "<p>&copy 2024 a&ampb company</p>", "<h2>1. A < B Corp</h2>", "<p>one<!-- x -->two words</p>"]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, html string")
    for main, column in ((False, hx.visible_text), (True, hx.main_text)):
        parsed = [r.text for r in pg.parse_text(df, main=main).orderBy("i").collect()]
        assert parsed[0] == "a < b and c > d" and parsed[2] == "1. A < B Corp"
        assert parsed[:3] == [r.t for r in df.orderBy("i").select(column(F.col("html")).alias("t")).collect()][:3]


def test_entities(spark):
    got = values(spark, hx.decode_entities, "&amp;lt; &#65;&#x42; &nosuch; & &copy;", "plain")
    assert got == ["&lt; AB &nosuch; & ©", "plain"]
    odd = ["&#128512;&#x1F600;&hellip;", "&#0000065;", "&#xD800;|&#99999999999;|&#x110000;", "caf&eacute; &NotEqualTilde;"]
    assert values(spark, hx.decode_entities, *odd) == [html.unescape(x) for x in odd]


def test_footer_element_before_class_and_unclosed_items(spark):
    page = '<div class="pre-footer"><a href="/no">No</a></div><footer><ul><li><a href="/in">caf&eacute;</a><li>x</ul></footer><a href="/out">Out</a>'
    assert [(r.href, r.label) for r in pg.parse_footer_links(frame(spark, page), "id").collect()] == [("/in", "café")]


def test_nested_list_items(spark):
    page = '<div class="company-list"><div class="company"><h3>1. Acme</h3><a href="/a">x</a></div><div class="company"><span>Beta Labs</span></div></div>'
    rows = pg.list_from_selectors(frame(spark, page), "id").orderBy("pos").collect()
    assert [(r.name, r.url) for r in rows] == [("Acme", "/a"), ("Beta Labs", "")]


def test_headings_inside_a_div_and_links_around(spark):
    page = '<div><p>Our list</p><h2>1. Acme Corp</h2><a href="/b"><h3>2. Beta Labs</h3></a><h2>0000000150. Late</h2><h2>0007. Early</h2></div><script>1. no</script>'
    rows = pg.list_from_headings(frame(spark, page), "id").orderBy("pos").collect()
    assert [(r.name, r.url) for r in rows] == [("Acme Corp", ""), ("Beta Labs", "/b"), ("Early", "")]


def test_footer_by_class_and_link_types(spark):
    rows = pg.parse_footer_links(frame(spark), "id").orderBy("pos").collect()
    assert [(r.href, r.label, r.aria) for r in rows] == [
        ("/careers?x=1&y=2", "Work with us", ""),
        ("https://www.linkedin.com/company/ex/?t=1", "", "Network"),
    ]
    links = pg.parse_footer_links(frame(spark), "id").withColumn(
        "url", urls.resolve(hx.F.lit("https://ex.test"), hx.F.col("href"))
    )
    kinds = {(r.link_type, r.url) for r in pg.classify_links(links, "id").collect()}
    assert kinds == {
        ("careers", "https://ex.test/careers?x=1&y=2"),
        ("linkedin", "https://www.linkedin.com/company/ex/?t=1"),
    }


def test_one_link_has_two_types(spark):
    links = spark.createDataFrame([(1, 0, "u", "Stories", "")], "id int, pos int, url string, label string, aria string")
    assert {r.link_type for r in pg.classify_links(links, "id").collect()} == {"blog", "customers"}


def test_off_site(spark):
    df = spark.createDataFrame(
        [("https://www.a.test", "https://a.test/x", False), ("https://a.test", "https://blog.a.test", False),
         ("https://a.test", "https://b.test", True), ("https://a.test", "https://xa.test", True), ("", "https://b.test", False)],
        "a string, b string, want boolean",
    )
    rows = df.select(urls.leaves_site(hx.F.col("a"), hx.F.col("b")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in rows)


def test_resolve(spark):
    base = hx.F.lit("https://h.test/a/b/c.html?q=1#f")
    hrefs = ["../x", "./y?z=1", "z/../../w", "/", "//o.test/p", "http://k.test", "?n=2", "#g", ""]
    from urllib.parse import urljoin

    got = values(spark, lambda x: urls.resolve(base, x), *hrefs)
    assert got == [urljoin("https://h.test/a/b/c.html?q=1#f", h) if h else "https://h.test/a/b/c.html?q=1#f" for h in hrefs]


def test_list_headings_rules(spark):
    html = "".join(f"<h2>{x}</h2>" for x in ["1. Alpha", "2 Beta", "51. Late", "3. Best of all", "4. 12345", "5. Al", "Gamma", "6. Alpha"])
    rows = pg.list_from_headings(frame(spark, html), "id").orderBy("pos").collect()
    assert [r.name for r in rows] == ["Alpha", "Beta"]


def test_cascade_in_one_pass_equals_the_methods_one_by_one(spark, sf):
    raw = spark.read.parquet(f"{sf}/pages.parquet").limit(60)
    number = F.concat(F.lit("<h2>"), (F.col("page_id") % 60).cast("string"), F.lit(". "))
    html_ = F.when(F.col("page_id") % 2 == 0, F.replace(F.replace("html", F.lit("<h1>"), number), F.lit("</h1>"), F.lit("</h2>"))).otherwise(F.col("html"))
    odd = [(-1, None), (-2, ""), (-3, "<ul><li class='listitem'><h3>1. Twice</h3></li><li class='listitem'><h3>2. Twice</h3><a href='b'></a></li></ul>"), (-4, "<h2>3. A < B Corp</h2><h2>12</h2>")]
    df = raw.select("page_id", html_.alias("html")).union(spark.createDataFrame(odd, "page_id long, html string"))
    df = df.withColumn("text", F.concat(F.lit("a\n 1. Line one\n 1. Line one\n 2. xy\n"), F.coalesce("html", F.lit(""))))
    paths = ["/the", "/an"]
    methods = [pg.list_from_ld_json(df, "page_id"), pg.list_from_selectors(df, "page_id"), pg.list_from_headings(df, "page_id"), pg.list_from_links(df, "page_id", paths), pg.list_from_lines(df, "page_id")]
    columns = ["page_id", "pos", "name", "url", "method_no", "n"]
    one_pass = pg.cascade(df, "page_id", paths=paths).select(*columns)
    rows = sorted(map(tuple, one_pass.collect()))
    assert rows == sorted(map(tuple, pg.first_method(methods, "page_id").select(*columns).collect()))
    assert len({r[4] for r in rows}) >= 3
    from tests.conftest import plan_of

    text = plan_of(one_pass)
    assert "Exchange hash" not in text and text.split("== Initial Plan")[0].count("ArrowEvalPython") == 1


def test_cascade_takes_first_method_with_rows(spark):
    schema = "id int, pos int, name string, url string"
    one = spark.createDataFrame([(1, 0, "a", "")], schema)
    two = spark.createDataFrame([(1, 0, "b", ""), (2, 0, "c", ""), (2, 1, "d", "")], schema)
    rows = pg.first_method([one, two], "id", first=1).collect()
    assert sorted((r.id, r.name, r.method_no) for r in rows) == [(1, "a", 1), (2, "c", 2)]


def test_failed_types(spark):
    companies = spark.createDataFrame([("a",), ("b",)], "company_id string")
    found = spark.createDataFrame([("a", "about"), ("a", "about")], "company_id string, page_type string")
    rows = pg.failed_page_types(companies, found, ["about", "blog"]).collect()
    assert sorted(map(tuple, rows)) == [("a", "blog"), ("b", "about"), ("b", "blog")]


def test_gates_are_strict(spark):
    df = spark.createDataFrame([("x" * 500,), ("x" * 501,)], "text string")
    assert [len(r.text) for r in pg.text_gate(df, 500).collect()] == [501]


@pytest.mark.parametrize("name", ["c13_list_from_ld_json", "c14_list_from_selectors", "c18_cascade", "c19_ld_json_details", "c20_headquarters", "c21_founded_year", "c22_website", "c23_network_link"])
def test_pages_made_of_one_small_file_are_dealt_over_the_cores(spark, tmp_path, name):
    """Parsing costs far more than reading: one file of many short rows must not be one task's work."""
    rows = spark.range(40).select(F.col("id").alias("p_partkey"), F.lit("name").alias("p_name"), F.lit("type").alias("p_type"), F.lit(3).alias("p_size"))
    rows.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    plan = plan_of(REGISTRY[name][0](spark, str(tmp_path)))
    assert "REPARTITION_BY_NUM" in plan and plan.index("REPARTITION_BY_NUM") < plan.index("FileScan")
