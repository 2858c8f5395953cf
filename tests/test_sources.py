import gzip
import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from venturelens import schemas as S
from venturelens.operators import records, runs, selection, signals
from venturelens.plans import structured
from venturelens.plans.refresh import STORE, marked_chunks, refresh_store
from venturelens.session import scratch_path, scratch_root
from venturelens.sources import readers, writers
from venturelens.streaming import refresh as stream
from workload import REGISTRY

SEED = [
    {"company_id": "id-1", "company_name": "Example AI Inc.", "website": "https://example.test", "linkedin": None, "categories": []},
    {"company_id": "id-2", "company_name": "Sample Labs", "founded_year": 2001, "categories": ["Robotics"]},
]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_seed_forms(spark, tmp_path):
    write(tmp_path / "list.json", json.dumps(SEED, indent=2))
    write(tmp_path / "object.json", json.dumps({"companies": SEED}))
    write(tmp_path / "bad.json", "[{ not json")
    for name, n in (("list.json", 2), ("object.json", 2), ("bad.json", 0), ("missing.json", 0)):
        assert readers.read_seed(spark, str(tmp_path / name)).count() == n, name


def crawl(tmp_path):
    write(tmp_path / "id-1" / "about.txt", "About us.\nTwo lines, team of 40 people.")
    write(tmp_path / "id-1" / "careers.txt", "12 open positions")
    write(tmp_path / "id-1" / "notes.txt", "unknown type")
    write(tmp_path / "id-1" / "about.html", "<p>x</p>")
    write(tmp_path / "id-2" / "blog.txt", "z" * 120)
    write(tmp_path / "id-1" / "metadata.json", json.dumps({
        "company_id": "id-1", "timestamp": "2025-01-01T00:00:00", "pages_scraped": 2,
        "success": {"about": "https://example.test/about"}, "errors": ["team"], "website": "https://example.test", "forbes_reference": None,
    }, indent=1))
    write(tmp_path / "id-2" / "metadata.json", json.dumps({
        "company_name": "Sample Labs", "base_url": "https://s.test", "crawled_at": "2025-02-02T00:00:00", "run_id": None,
        "pages": {"blog": {"url": "https://s.test/blog", "status": "success", "text_length": 120}, "about": {"status": "failed", "attempted_urls": ["x"], "error": "All"}},
    }))


def test_page_files_and_metadata(spark, tmp_path):
    crawl(tmp_path)
    pages = readers.read_page_files(spark, str(tmp_path))
    got = {(r.company_id, r.page_type): r.text for r in pages.collect()}
    assert set(got) == {("id-1", "about"), ("id-1", "careers"), ("id-2", "blog")}
    assert got["id-1", "about"].endswith("40 people.") and "\n" in got["id-1", "about"]
    everything = readers.read_page_files(spark, str(tmp_path), page_types=None)
    assert everything.count() == 4
    assert {r.company_id for r in readers.long_texts(everything).collect()} == {"id-2"}
    meta = readers.read_crawl_metadata(spark, str(tmp_path))
    assert {(r.company_id, r.page_type, r.source_url, r.status) for r in meta.collect()} == {
        ("id-1", "about", "https://example.test/about", "success"), ("id-2", "blog", "https://s.test/blog", "success"), ("id-2", "about", None, "failed"),
    }
    known = {(r.company_id, r.page_type): (r.source_url, r.crawled_at) for r in readers.with_source(pages, meta, "now").collect()}
    assert known["id-1", "about"] == ("https://example.test/about", "2025-01-01T00:00:00")
    assert known["id-1", "careers"] == ("", "now")
    snap = signals.snapshot_provenance(signals.hiring_snapshots(pages.withColumn("source_url", F.lit("u"))), readers.with_source(pages, meta, "now")).first()
    assert (snap.headcount_total, snap.job_openings_count, snap.confidence) == (40, 12, 0.8)
    assert [p.snippet for p in snap.provenance] == ["Extracted from about page", "Extracted from careers page"]


def files_below(folder):
    return sorted(str(f.relative_to(folder)) for f in folder.rglob("*") if f.is_file())


def test_page_files_in_batches(spark, tmp_path, monkeypatch):
    texts = ["a\r\nb\n", " é\n\n", "\x00 nul \t", "x" * 50_000]
    rows = [(f"c{i}", kind, f"{i} {texts[i % 4]}") for i in range(70) for kind in ("blog", "about us")]
    odd = [("a/b%c", "blog", "odd id"), (None, "blog", "no id"), ("", "blog", "empty id"), ("c1", None, "no type"), ("c2", "team", None)]
    twice = [("c3", "news", "same")] * 2
    pages = spark.createDataFrame([*rows, *odd, *twice], "company_id string, page_type string, text string").repartition(8)

    def back(name):
        folders = writers.write_page_files(pages, f"file://{tmp_path}/{name}", part_pages=1)
        read = [readers.read_page_files(spark, f, page_types=None, layout=readers.PARTITION_LAYOUT).drop("file_path").collect() for f in folders]
        return read, sorted(f.split("/")[:4] for f in files_below(tmp_path / name) if f.endswith(".txt"))

    read, folders = back("ours")
    got = {(r.company_id, r.page_type): r.text for batch in read for r in batch}
    assert len(read) == 3 and max(map(len, read)) < 100 and len(got) == sum(map(len, read)) == len(rows) + 5
    assert [got[row[:2]] for row in rows] == [f"{row[2]}\x01" for row in rows]
    assert got["c3", "news"] == "same\x01same\x01" and got["c2", "team"] == "\x01"
    assert sorted(got["__HIVE_DEFAULT_PARTITION__", "blog"].split("\x01")) == ["", "empty id", "no id"]
    assert len({tuple(f[:3]) for f in folders}) == len({f[2] for f in folders})  # a company is whole in one part
    with pytest.raises(FileExistsError):
        writers.write_page_files(pages, f"{tmp_path}/ours")
    monkeypatch.setattr(writers, "_local_folder", lambda *_: None)  # as in a store that only Spark reaches
    others, spark_folders = back("sparks")
    unordered = {("__HIVE_DEFAULT_PARTITION__", "blog")}
    assert spark_folders == sorted([*f[:3], f[3].removesuffix(".txt")] for f in folders)
    assert {k: v for k, v in got.items() if k not in unordered} == {(r.company_id, r.page_type): r.text for b in others for r in b if (r.company_id, r.page_type) not in unordered}
    monkeypatch.undo()
    assert writers.write_page_files(pages.limit(0), f"{tmp_path}/none") == []


def test_page_files_query_makes_page_files_only(spark, sf):
    """One file a page, in one batch here; no checksum files, each of which costs what a page costs."""
    before = set(os.listdir(scratch_root(spark)))
    n = REGISTRY["a02_page_files"][0](spark, sf).count()
    new = [name for name in os.listdir(scratch_root(spark)) if name not in before and name.startswith("page-files")]
    files = files_below(Path(scratch_root(spark)) / new[0])
    assert len(new) == 1 and len([f for f in files if f.endswith(".txt")]) == n == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert not [f for f in files if f.endswith(".crc") and "page_type=" in f]


def test_page_files_query_without_pages(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert REGISTRY["a02_page_files"][0](spark, str(tmp_path)).count() == 0


def test_page_files_bytes(spark, tmp_path):
    """Files come as the text source reads them, bytes that aren't UTF-8 too; packed ones are unpacked."""
    (tmp_path / "c").mkdir()
    for name, content in {"crlf": b"a\r\nb\r\n", "bom": b"\xef\xbb\xbfx", "latin": b"caf\xe9", "empty": b"", "nul": b"a\x00b"}.items():
        (tmp_path / "c" / f"{name}.txt").write_bytes(content)
    hexes = F.hex(F.col("text").cast("binary"))
    got = {r[0]: r[1] for r in readers.read_page_files(spark, str(tmp_path), page_types=None).select("page_type", hexes).collect()}
    files = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path), wholetext=True)
    stem = F.regexp_extract("_metadata.file_path", r"([a-z]+)\.txt$", 1)
    assert got == {r[0]: r[1] for r in files.select(stem, F.hex(F.col("value").cast("binary"))).collect()} and len(got) >= 4
    (tmp_path / "c" / "packed.txt.gz").write_bytes(gzip.compress(b"packed"))
    assert readers.read_page_files(spark, str(tmp_path), page_types=None, suffix="txt.gz").first().text == "packed"


def test_object_listing(spark, tmp_path):
    crawl(tmp_path)
    write(tmp_path / "seed.json", "[]")
    listed = readers.company_objects(readers.list_objects(spark, str(tmp_path)))
    paths = {r.path for r in listed.collect()}
    assert "id-1/about.txt" in paths and "seed.json" not in paths and len(paths) == 7
    assert "content" not in plan_of(listed)


def test_seed_as_page_and_context(spark, tmp_path):
    crawl(tmp_path)
    write(tmp_path / "seed.json", json.dumps(SEED))
    pages = readers.with_source(readers.read_page_files(spark, str(tmp_path)), readers.read_crawl_metadata(spark, str(tmp_path)), "now")
    texts = pages.select("company_id", "page_type", "source_url", "text").unionByName(selection.seed_pages(readers.read_seed(spark, str(tmp_path / "seed.json"))))
    packed = {r.company_id: r.context for r in selection.context_pack(selection.select_pages(texts)).collect()}
    assert packed["id-1"].startswith("=== OFFICIAL SOURCE: company list ===\n\n\nOFFICIAL SOURCE - company list:\nCompany: Example AI Inc.\n")
    assert packed["id-1"].index("ABOUT PAGE") < packed["id-1"].index("CAREERS PAGE")
    assert structured.requests_from_pages(texts).count() == 6


def test_records_written_and_read(spark, tmp_path):
    good = {"company": {"company_id": "id-1", "legal_name": "Example"}, "events": [
        {"event_id": "e1", "company_id": "id-1", "occurred_on": "2024-01-05", "event_type": "funding", "title": "Round"}], "products": []}
    bad = {"company": {"company_id": "id-2", "legal_name": "Sample"}, "events": [{"event_id": "e2", "company_id": "id-2", "title": "No date", "event_type": "party"}]}
    write(tmp_path / "in" / "id-1.json", json.dumps(good, indent=2))
    write(tmp_path / "in" / "id-2.json", json.dumps(bad))
    rows = {r.company_id: r for r in readers.read_records(spark, str(tmp_path / "in")).collect()}
    assert rows["id-1"].events[0].occurred_on.isoformat() == "2024-01-05" and rows["id-1"].company.legal_name == "Example"
    events = readers.read_record_items(spark, str(tmp_path / "in")).filter("entity = 'events'").drop("entity", "pos")
    accepted, rejected = records.split_valid(records.validate(events, S.ENTITIES["events"]))
    assert [r.event_id for r in accepted.collect()] == ["e1"]
    assert rejected.first().errors == ["occurred_on missing", "event_type unknown"]
    company = records.conform(spark.createDataFrame([("id-1", "Example")], "company_id string, legal_name string"), S.columns_of("company"))
    payloads = records.assemble_payloads(company, {"events": accepted})
    writers.write_payloads(payloads, str(tmp_path / "out"))
    back = readers.read_payloads(spark, str(tmp_path / "out")).first()
    assert back.company_id == "id-1" and back.events[0].occurred_on.isoformat() == "2024-01-05"
    written = "".join(f.read_text() for f in (tmp_path / "out").glob("part-*"))
    assert '"occurred_on":"2024-01-05"' in written


def test_pushdown_and_partition_pruning(spark, sf, tmp_path):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    plan = plan_of(readers.subset(d.select("doc_id", "source"), "src1,src2", key="source"))
    assert "PushedFilters: [In(source, [src1,src2])]" in plan and "text" not in plan.split("ReadSchema")[1]
    pages = d.select(F.col("source").alias("company_id"), F.lit("blog").alias("page_type"), "text", F.lit("2025-01-01").cast("date").alias("run_date"))
    writers.write_pages(pages, str(tmp_path / "pages"))
    plan = plan_of(readers.read_pages(spark, str(tmp_path / "pages"), "2025-01-01", "src1"))
    assert "PartitionFilters: [" in plan and "isnotnull(run_date" in plan and "company_bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "EqualTo(company_id,src1)" in plan


def test_latest_and_counts(spark):
    r = spark.createDataFrame([("a", "success", 1), ("a", "failed", 2), ("b", "success", 1)], "company string, status string, day int")
    assert {(x.company, x.status) for x in runs.latest_per_key(r, "company", ["day"]).collect()} == {("a", "failed"), ("b", "success")}
    assert tuple(runs.run_counts(r).first()) == (3, 2, 1)
    assert runs.full_report(r, r).first().indexed_to_vector_db == 3


def page_rows(spark, *rows):
    return spark.createDataFrame([(c, s, f"{c}/{s}.txt", t * 30) for c, s, t in rows], "company string, source string, file_path string, text string")


def test_refresh_adds_changed_pages_once(spark):
    path = scratch_path(spark, "store")
    day1 = page_rows(spark, ("a", "about", "one. "), ("a", "blog", "two. "))
    day2 = page_rows(spark, ("a", "about", "one. "), ("a", "blog", "new. "), ("b", "team", "six. "))
    assert refresh_store(spark, day1, path, "1").select("source").distinct().count() == 2
    for _ in range(2):
        added = refresh_store(spark, day2, path, "2")
        assert {(r.company, r.source) for r in added.collect()} == {("a", "blog"), ("b", "team")}
    assert refresh_store(spark, day2, path, "3").count() == 0
    only_key = refresh_store(spark, page_rows(spark, ("c", "team", "xxxx. "), ("c", "about", "yyyy. ")), path, "4", ("about",))
    assert {r.source for r in only_key.collect()} == {"about"}


def test_chunks_of_replaced_versions_are_marked(spark):
    path = scratch_path(spark, "store")
    for batch, text in (("1", "one. "), ("2", "two. "), ("2", "two. "), ("3", "one. "), ("4", "one. ")):
        refresh_store(spark, page_rows(spark, ("a", "about", text), ("b", "blog", "same. ")), path, batch)
    chunks = marked_chunks(spark, path).collect()
    assert {(r.source, r.content[:4], r.current) for r in chunks} == {("about", "one.", True), ("about", "two.", False), ("blog", "same", True)}
    assert len(chunks) == len({(r.source, r.chunk_id, r.text_hash) for r in chunks})  # a returning text isn't stored again


def test_a_batch_reads_only_its_buckets_of_the_index(spark):
    from venturelens.operators import runs
    from venturelens.plans import refresh

    path = scratch_path(spark, "store")
    refresh_store(spark, page_rows(spark, *[(f"c{i}", "about", f"text {i}. ") for i in range(60)]), path, "1")
    one = runs.with_hash(page_rows(spark, ("c7", "about", "text 7. ")))
    for folder, schema, bucket in (("_hashes", refresh.HASHES, refresh._hash_bucket()), ("_pages", refresh.VERSIONS, refresh._page_bucket())):
        read = refresh._read_buckets(spark, f"{path}/{folder}", schema, one, bucket, "2")
        assert "c7" in {r.company for r in read.collect()} and read.count() < 10
        assert "PartitionFilters: [isnotnull(bucket" in plan_of(read) or "PartitionFilters: [isnotnull(batch" in plan_of(read)
        assert len(read.inputFiles()) < 60


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    pages = page_rows(spark, ("a", "about", "one. "), ("b", "blog", "two. "))
    store, check = scratch_path(spark, "store"), scratch_path(spark, "check")
    pages.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream.start_refresh(spark, stream.page_stream(spark, str(tmp_path / "in")), store, check).awaitTermination()
    first = spark.read.schema(STORE).parquet(store).count()
    page_rows(spark, ("a", "about", "one. "), ("b", "blog", "changed. ")).write.mode("append").parquet(str(tmp_path / "in"))
    stream.start_refresh(spark, stream.page_stream(spark, str(tmp_path / "in")), store, check).awaitTermination()
    total = spark.read.schema(STORE).parquet(store)
    batch = scratch_path(spark, "store")
    refresh_store(spark, pages, batch, "1")
    assert first == spark.read.schema(STORE).parquet(batch).count()
    assert total.count() > first and total.filter("company = 'a'").select("text_hash").distinct().count() == 1


def test_scratch_root_is_the_sessions(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_records_and_parts_are_written_compressed(spark, tmp_path):
    """Most of a JSON line is field names; the files are as readable as plain ones."""
    rows = spark.createDataFrame([("a", "A"), ("b", "B")], "company_id string, legal_name string")
    lines = rows.select(F.struct("company_id", "legal_name").alias("company"))
    writers.write_records(lines, str(tmp_path / "records"))
    assert list((tmp_path / "records").glob("*.json.gz")) and not list((tmp_path / "records").glob("*.json"))
    back = readers.read_records(spark, str(tmp_path / "records"), file_per_company=False)
    assert {(r.company_id, r.company.legal_name) for r in back.collect()} == {("a", "A"), ("b", "B")}
    events = spark.createDataFrame([("e1", "a", 1)], "event_id string, company_id string, occurred_on int")
    parts = records.payload_parts({"events": events})
    writers.write_payload_parts(rows, parts, str(tmp_path / "parts"))
    assert list((tmp_path / "parts" / "parts").glob("*.json.gz")) and list((tmp_path / "parts" / "company").glob("*.json.gz"))
    company, held = readers.read_payload_parts(spark, str(tmp_path / "parts"), parts.schema, rows.schema)
    assert company.count() == 2 and [x.v.event_id for x in held.first().events] == ["e1"]
    writers.write_payloads(records.assemble_payloads(rows, {"events": events}), str(tmp_path / "payloads"), compression="gzip")
    assert list((tmp_path / "payloads").glob("*.json.gz")) and readers.read_payloads(spark, str(tmp_path / "payloads")).count() == 2


def test_refresh_does_not_rank_texts(spark, tmp_path, monkeypatch):
    """The first of equal pages is chosen by keys and hashes; texts go through no ranking shuffles. A page given twice is stored once."""
    ranked, rank = [], runs.first_of_copies
    monkeypatch.setattr(runs, "first_of_copies", lambda rows, *rest: (ranked.append(rows.columns), rank(rows, *rest))[1])
    long = "word " * 60
    pages = spark.createDataFrame([("a", "blog", "p2", long), ("a", "blog", "p1", long), ("a", "blog", "p1", long)], "company string, source string, file_path string, text string")
    added = refresh_store(spark, pages, str(tmp_path / "store"), "day1").collect()
    assert {r.file_path for r in added} == {"p1"} and len({r.chunk_id for r in added}) == len(added)
    assert ranked and not any("text" in columns for columns in ranked)
