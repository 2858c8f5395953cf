import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import plan_of, values
from venturelens.functions import text as tx
from venturelens.operators import selection


def sentences_by_hand(text, words, n):
    kept = [s.strip() for s in re.split(r"[.!?]+", text)]
    kept = [s for s in kept if s and any(w in s.lower() for w in words)][:n]
    return ". ".join(kept) + "." if kept else ""


def cut_by_hand(text, n):
    if len(text) <= n:
        return text
    end = text[:n].rfind(".")
    return text[: end + 1] if end > 0 else text[:n] + "..."


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab .!?\n\t  Éx", max_size=60), min_size=1, max_size=30))
def test_sentences_and_cut_match_brute_force(spark, texts):
    got = values(spark, lambda x: tx.keyword_sentences(x, ["a", "é"], 3), *texts)
    assert got == [sentences_by_hand(t, ["a", "é"], 3) for t in texts]
    got = values(spark, lambda x: tx.cut_at_sentence(x, 7), *texts)
    assert got == [cut_by_hand(t, 7) for t in texts]
    assert all(len(g) <= 10 for g in got)


def test_first_character_stop_does_not_count(spark):
    assert values(spark, lambda x: tx.cut_at_sentence(x, 4), ".abcdef", "abcdefg", "ab.defg", "abc") == [
        ".abc...", "abcd...", "ab.", "abc",
    ]


def test_rules(spark):
    text = "We raised money. Our HQ is here! The CEO spoke. Nothing else."
    rule = lambda kind: values(spark, lambda x: tx.rule_text(kind, x), text)[0]
    assert rule("blog") == "We raised money."
    assert rule("team") == "The CEO spoke."
    assert rule("about") == text + "\n\nLocations: Our HQ is here.\n\nLeadership: The CEO spoke."
    assert rule("careers") == "Locations: Our HQ is here."
    assert rule("pricing") == text
    assert rule("unknown type") == text
    assert values(spark, lambda x: tx.rule_text("customers", x), "x" * 2001)[0] == "x" * 2000 + "..."


def test_empty_pages_are_dropped_and_first_page_per_type_wins(spark):
    rows = [
        ("c1", "about", "b", "Second."), ("c1", "about", "a", "First."), ("c1", "team", "a", ""),
        ("c1", "pricing", "a", "Ten."), ("c2", "other", "a", "Never packed."),
    ]
    pages = spark.createDataFrame(rows, "company_id string, page_type string, source_url string, text string")
    packed = selection.context_pack(selection.select_pages(pages)).collect()
    assert [r.company_id for r in packed] == ["c1"]
    assert packed[0].context == "=== ABOUT PAGE ===\n\nFirst.\n\n\n=== PRICING PAGE ===\n\nTen.\n\n"


def test_reduction_of_nothing_is_zero(spark):
    pages = spark.createDataFrame([("c", "", "")], "company_id string, text string, selected string")
    row = selection.reduction_stats(pages).first()
    assert (row.original_chars, row.reduction_pct, row.original_tokens_est) == (0, 0.0, 0)


def test_redaction(spark):
    got = values(spark, tx.redact_contacts, "Mail ann.b@x-y.test or +1-202-555-0143 now")
    assert got == ["Mail [email removed] or [phone removed] now"]


def test_selection_runs_in_one_pass(spark, sf):
    from workload.common import WORDS, company_pages

    plan = plan_of(selection.select_pages(company_pages(spark, sf), WORDS))
    assert "Python" not in plan and plan.count("Generate explode") == 1
