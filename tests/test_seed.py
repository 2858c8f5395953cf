from venturelens.operators import seed


def test_known_domains_are_the_default(spark):
    names = spark.createDataFrame([(1, "Mistral AI"), (2, "Anysphere"), (3, "Nobody Knows Inc."), (4, None)], "company_id int, company_name string")
    got = {r.company_id: r.known_url for r in seed.with_known_domain(names).collect()}
    assert got == {1: "https://mistral.ai", 2: "https://cursor.sh", 3: None, 4: None}
    status = spark.createDataFrame([("https://anysphere.ai", 200)], "url string, status int")
    got = {r.company_id: r.website for r in seed.enrich_urls(names, status).collect()}
    assert got[1] == "https://mistral.ai" and got[2] == "https://cursor.sh"
