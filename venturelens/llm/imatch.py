"""I-Match fingerprints over randomised parts of a lexicon, in DataFrame functions only.

1. Lexicon: the terms whose share of the documents lies in a band, that is, whose inverse document frequency does. Each text gives its
   distinct terms once; tasks count before the shuffle. With a least share of 1/1000 the lexicon has at most a thousand times
   as many terms as a text has on average, whatever the number of texts; it is broadcast after its rows were counted, and joined otherwise.
2. A text's distinct lexicon terms are sorted and hashed: the signature of the whole lexicon. The same is done for ``parts`` random
   sub-lexicons of one term in 4^level each. The level follows the number of terms, so that a part holds about one of them; each text
   has the parts of its level and of the next, so texts of similar size have a level in common.
3. The fingerprint is the string of these signatures. The likeness of two fingerprints is 1 if they are equal, otherwise the share
   of equal signatures among the parts of the first level in common that hold a term of either text (0 without a level in common).

A text without lexicon terms is fingerprinted by all its distinct terms, so that only texts with the same words are alike then.

``edited`` pairs each text with the one that follows it in descending order of ids. The order is made on narrow rows
(range partitions, numbered each by itself); the text is shuffled once, by a hash of id and text, and of the following text only the needed beginning.

Terms are lower-cased stretches of letters and digits. Defined results: null texts are empty; empty texts have the fingerprint of no terms; null ids come
last, equal ids follow in the order of a hash of the text, and rows equal in both are one class until the end, each followed by the next copy; a
single row follows itself; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venturelens.session import scratch_path

LEAST_SHARE, MOST_SHARE = 0.001, 0.2
PARTS = 24
BROADCAST_TERMS = 1 << 20
NO_TERM = "[^\\p{L}\\p{N}]+"
MARK = 0  # stands before the terms of a text, so that a text without lexicon terms keeps a row


def terms_of(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    words = F.filter(F.split(F.lower(text), NO_TERM), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text: str = "text", least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """``term, kept``: hashes of the terms that occur in at least the share ``least`` of the rows and in ``most`` at most.

    The row of ``MARK`` has a null in ``kept``.
    """
    spark = docs.sparkSession
    n = docs.count()
    counted = docs.select(F.explode(terms_of(F.coalesce(F.col(text), F.lit("")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"))
    own = counted.filter(F.col("n_docs").between(least * n, most * n)).select("term", F.col("term").alias("kept"))
    path = scratch_path(spark, "lexicon")
    own.write.parquet(path)
    own = spark.read.parquet(path)
    both = own.unionByName(spark.range(1).select(F.lit(MARK).cast("long").alias("term"), F.lit(None).cast("long").alias("kept")))
    return F.broadcast(both) if own.count() <= BROADCAST_TERMS else both


def _signature(terms: Column) -> Column:
    """31 bits of the hash of a sorted list, the last one set; 0 for an empty one."""
    return F.when(F.size(terms) == 0, F.lit(0)).otherwise(F.xxhash64(terms).bitwiseAND(F.lit(0x7FFFFFFF)).bitwiseOR(F.lit(1)).cast("int"))


def with_signatures(rows: DataFrame, parts: int = PARTS) -> DataFrame:
    """The columns ``terms`` and ``fallback`` replaced by ``signatures``: struct<n, level, whole, here, above>.

    ``here`` and ``above`` are the signatures of the parts of one term in 4^level, and in 4^(level + 1).
    """
    n = F.size("terms")
    level = F.when(n < 2, F.lit(0)).otherwise(F.floor((F.length(F.bin((n - 1).cast("long"))) + 1) / 2).cast("int"))  # the least with 4^level >= n
    rows = rows.withColumn("terms", F.array_sort("terms")).withColumn("level", level)
    rows = rows.withColumn("mask", F.expr("shiftleft(1L, 2 * level) - 1L"))
    drawn = lambda terms, part, mask: F.filter(terms, lambda t: F.xxhash64(t, part).bitwiseAND(mask) == 0)
    rows = rows.withColumn("lists", F.transform(F.sequence(F.lit(1), F.lit(parts)), lambda j: drawn(F.col("terms"), j, F.col("mask"))))
    whole = F.when(n == 0, F.col("fallback")).otherwise(F.xxhash64("terms"))
    here = F.transform("lists", _signature)
    above = F.transform("lists", lambda x, i: _signature(drawn(x, i + 1, F.col("mask") * 4 + 3)))
    found = F.struct(n.alias("n"), F.col("level"), whole.alias("whole"), here.alias("here"), above.alias("above"))
    return rows.withColumn("signatures", found).drop("terms", "fallback", "level", "mask", "lists")


def fingerprint(s: Column) -> Column:
    """The signatures as a string."""
    listed = lambda x: F.array_join(F.transform(x, lambda v: F.hex(v.cast("long"))), ",")
    return F.concat_ws(":", s["n"].cast("string"), s["level"].cast("string"), F.hex(s["whole"]), listed(s["here"]), listed(s["above"]))


def likeness(a: Column, b: Column) -> Column:
    """Of two texts' signatures, from 0 to 1."""
    pairs = (
        F.when(a["level"] == b["level"], F.arrays_zip(a["here"].alias("x"), b["here"].alias("y")))
        .when(a["level"] + 1 == b["level"], F.arrays_zip(a["above"].alias("x"), b["here"].alias("y")))
        .when(b["level"] + 1 == a["level"], F.arrays_zip(a["here"].alias("x"), b["above"].alias("y")))
        .otherwise(F.array().cast("array<struct<x:int,y:int>>"))
    )
    held = F.size(F.filter(pairs, lambda p: (p["x"] != 0) | (p["y"] != 0)))
    same = F.size(F.filter(pairs, lambda p: (p["x"] != 0) & (p["x"] == p["y"])))
    return F.when((a["n"] == b["n"]) & (a["whole"] == b["whole"]), F.lit(1.0)).when(held > 0, same / held).otherwise(F.lit(0.0))


def _keyed(docs: DataFrame, id_: str, text: str) -> DataFrame:
    own = docs.select(F.col(id_).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return own.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64(F.lit(7), "text", "doc_id")})


def following(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``k1, k2, before``: each class of equal rows and the one before it in descending order of ids, in a circle.

    ``before``: struct<k1, k2, doc_id, copies, n_chars>.
    """
    spark = docs.sparkSession
    narrow = _keyed(docs, id_, text).select("k1", "k2", "doc_id", F.length("text").alias("n_chars"))
    narrow = narrow.groupBy("k1", "k2").agg(F.first("doc_id").alias("doc_id"), F.first("n_chars").cast("long").alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    order = [F.desc_nulls_last("doc_id"), F.asc("k1"), F.asc("k2")]
    path = scratch_path(spark, "order")
    narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("part", F.shiftright("at", 33))
    own = F.struct("k1", "k2", "doc_id", "copies", "n_chars")
    last = placed.groupBy("part").agg(F.max_by(own, "at").alias("last"))  # a row per partition
    parts = Window.orderBy("part")
    everywhere = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = last.select("part", F.coalesce(F.lag("last").over(parts), F.last("last").over(everywhere)).alias("last"))
    inside = placed.select("part", "k1", "k2", F.lag(own).over(Window.partitionBy("part").orderBy("at")).alias("before"))
    return inside.join(last, "part").select("k1", "k2", F.coalesce("before", "last").alias("before"))


def edited(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``k1, k2, doc_id, copies, n_chars, next1, next2, versions`` of each class of equal rows.

    ``versions``: the text; the text with its second half replaced by the beginning of the next; and for copies, that with their own beginning.
    """
    classes = _keyed(docs, id_, text).groupBy("k1", "k2").agg(F.first("text").alias("text"))  # alike on both sides of the join, so shuffled once
    beginnings = classes.join(following(docs, id_, text), ["k1", "k2"]).select(
        "before.*", F.expr("substring(text, 1, cast(before.n_chars div 2 as int))").alias("beginning"), F.col("k1").alias("next1"), F.col("k2").alias("next2")
    )
    both = classes.join(beginnings, ["k1", "k2"])
    head = "substring(text, 1, cast(n_chars - n_chars div 2 as int))"
    versions = F.array(
        F.col("text"), F.expr(f"concat({head}, beginning)"), F.expr(f"case when copies > 1 then concat({head}, substring(text, 1, cast(n_chars div 2 as int))) end")
    )
    return both.select("k1", "k2", "doc_id", "copies", "n_chars", "next1", "next2", F.filter(versions, lambda v: v.isNotNull()).alias("versions"))


def fingerprints(docs: DataFrame, id_: str = "doc_id", text: str = "text", least: float = LEAST_SHARE, most: float = MOST_SHARE, parts: int = PARTS) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of each row."""
    spark = docs.sparkSession
    words = lexicon(docs, text, least, most)
    about = ["doc_id", "copies", "n_chars", "next1", "next2"]
    bodies = edited(docs, id_, text).select("k1", "k2", *about, F.posexplode("versions").alias("kind", "body"))
    bodies = bodies.select("k1", "k2", "kind", *about, F.sha2("body", 256).alias("sha256"), terms_of(F.col("body")).alias("own"))
    bodies = bodies.withColumn("fallback", F.xxhash64(F.array_sort("own")))
    marked = F.concat(F.array(F.lit(MARK).cast("long")), "own")
    carried = [*about, "sha256", "fallback"]
    rows = bodies.select("k1", "k2", "kind", *carried, F.explode(marked).alias("term")).join(words, "term")
    rows = rows.select("k1", "k2", "kind", "kept", F.when(F.col("kept").isNull(), F.struct(*carried)).alias("about"))  # terms go on as numbers alone
    # Texts lie by (k1, k2) since they met the beginnings, so neither of these moves them.
    texts = rows.groupBy("k1", "k2", "kind").agg(F.collect_list("kept").alias("terms"), F.first("about", ignorenulls=True).alias("about"))
    texts = with_signatures(texts.select("k1", "k2", "kind", "terms", "about.*"), parts)
    found = texts.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("kind", "sha256", "signatures"))).alias("versions"), *[F.first(c).alias(c) for c in about])
    path = scratch_path(spark, "signatures")
    found.write.parquet(path)
    found = spark.read.parquet(path)
    version = lambda i: F.get("versions", F.lit(i))
    after = found.select(F.col("k1").alias("next1"), F.col("k2").alias("next2"), version(0)["signatures"].alias("after"))
    rows = found.join(after, ["next1", "next2"]).select(
        "doc_id", "n_chars", "after", version(0)["signatures"].alias("own"), version(1).alias("changed"), version(2).alias("again"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"), "copies"
    )
    # All copies but the last are followed by a copy.
    last = F.col("copy") == F.col("copies")
    changed, after = F.when(last, F.col("changed")).otherwise(F.col("again")), F.when(last, F.col("after")).otherwise(F.col("own"))
    rows = rows.select("doc_id", "n_chars", "own", changed.alias("changed"), after.alias("after"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.col("changed.sha256").alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed.signatures")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed.signatures")).alias("near_edited"),
        likeness(F.col("own"), F.col("after")).alias("near_next"),
    )
