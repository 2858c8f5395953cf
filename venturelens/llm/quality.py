"""Host-level quality rules.

Each document is measured once; the rule failures are summed by host, each host's failure rates are
shrunk towards the collection's rate by an empirical beta prior, and the host's verdict goes back to
its documents over a salted join, so that a host with a third of all documents is spread over tasks.

Defined results: a null or empty text has no words and fails the length rule; documents whose host is
null form a host of their own without verdict; repeated rows are measured each by itself; an empty table
gives an empty result. Only the id, the text and the host are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venturelens.llm.common import as_bytes, pieces

SYMBOLS = b"#*$%&|<>"  # fixed value
SPACES = b" \t\n\x0b\x0c\r"  # fixed value: what ends a word
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"



def rules(min_words: int = 50, repeat_percent: int = 50, symbol_ratio: float = 0.1, dup_lines: int = 3, mean_chars: tuple[float, float] = (2.0, 12.0)) -> dict[str, str]:
    """The rules as SQL conditions that hold when a document fails."""
    return {
        "short": f"n_words < {min_words}",
        "repeats": f"100 * n_repeat_words > {repeat_percent} * n_words",
        "symbols": f"n_symbols > {symbol_ratio} * n_words",
        "dup_lines": f"n_dup_lines >= {dup_lines}",
        "word_length": f"n_words > 0 and (word_chars < {mean_chars[0]} * n_words or word_chars > {mean_chars[1]} * n_words)",
    }


BASE = ("short", "repeats")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the list."""
    n = len(words) - 2
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    v = len(known)
    if len(words) == v:
        return 0
    pairs = ids[:-1] * v + ids[1:]
    if v > 2_000_000:  # else the key of three ids would not fit into 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * v + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k : k + n] |= twice
    return int(hit.sum())


def _measured(text: bytes | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    if not words:
        return 0, 0, 0, 0, 0
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "replace"))
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def measure(docs: DataFrame, id_: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``doc_id, host`` and the counts of each document."""
    kind = docs.schema[id_].dataType.simpleString()
    host_kind = docs.schema[host].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "_text"):
            got = np.array([_measured(t) for t in as_bytes(b.column("_text"))], np.int64).reshape(-1, 5)
            columns = [b.column("_id"), b.column("_host"), *(pa.array(got[:, i]) for i in range(5))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "host", *(m.split()[0] for m in MEASURES.split(", "))])

    narrow = docs.select(F.col(id_).alias("_id"), F.col(host).alias("_host"), F.col(text).alias("_text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, host {host_kind}, {MEASURES}")


def with_failures(measured: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """Adds ``fails``, an array of 0/1 in the order of the rules."""
    return measured.withColumn("fails", F.array(*[F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in conditions.values()]))


def host_rates(failures: DataFrame, conditions: Mapping[str, str], strength: tuple[float, float] = (2.0, 1000.0)) -> DataFrame:
    """``host, n_docs`` and, by rule, the failure rate shrunk by a beta prior fitted to all hosts.

    The prior's mean is the rate over all documents; its strength (pseudo-documents) comes from the variance
    between hosts beyond what chance gives, by moments, within ``strength``. The prior is one row of numbers.
    """
    names = list(conditions)
    hosts = failures.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(F.col("fails")[i]).alias(f"k_{r}") for i, r in enumerate(names)]
    )
    moments = hosts.agg(
        F.sum("n_docs").alias("n"),
        F.avg(1 / F.col("n_docs")).alias("inverse"),
        *[F.sum(f"k_{r}").alias(f"k_{r}") for r in names],
        *[F.var_pop(F.col(f"k_{r}") / F.col("n_docs")).alias(f"v_{r}") for r in names],
    ).first()
    shrunk = []
    for r in names:
        total = moments["n"] or 0
        mean = (moments[f"k_{r}"] or 0) / total if total else 0.0
        chance = mean * (1 - mean) * (moments["inverse"] or 0.0)
        between = (moments[f"v_{r}"] or 0.0) - chance
        weight = mean * (1 - mean) / between - 1 if between > 0 else strength[1]
        weight = min(max(weight, strength[0]), strength[1])
        shrunk.append(((F.col(f"k_{r}") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))).alias(f"rate_{r}"))
    return hosts.select("host", "n_docs", *shrunk)


def host_quality(
    docs: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    host: str = "source",
    conditions: Mapping[str, str] | None = None,
    host_limit: float = 0.5,
    habit_limit: float = 0.01,
    salts: int = 32,
    store: str | None = None,
) -> DataFrame:
    """Counts, failed rules, the host's verdict and ``kept`` of each document.

    A document goes if it fails a base rule; if its host's shrunk rate of some rule is over ``host_limit`` (a
    host that mostly fails); or if it fails a rule that its host fails habitually (shrunk rate over
    ``habit_limit``). A single odd document of a sound host stays. ``store`` is a folder for the measured rows,
    which are read twice; without it the texts are measured twice.
    """
    conditions = dict(conditions or rules())
    failures = with_failures(measure(docs, id_, text, host), conditions)
    if store:
        failures.write.mode("overwrite").parquet(store)
        failures = docs.sparkSession.read.parquet(store)
    rates = host_rates(failures, conditions)
    names = list(conditions)
    over = lambda limit: F.array(*[(F.col(f"rate_{r}") > limit).cast("int") for r in names])
    verdicts = rates.select("host", over(host_limit).alias("bad"), over(habit_limit).alias("habit"))
    salt = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(salts)).cast("int")
    joined = failures.withColumn("_salt", salt).join(
        verdicts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["host", "_salt"], "left"
    )
    base = F.coalesce(F.expr(" or ".join(f"({conditions[r]})" for r in BASE if r in conditions) or "false"), F.lit(False))
    any_one = lambda flags: F.coalesce(F.exists(flags, lambda x: x == 1), F.lit(False))
    host_bad = any_one(F.col("bad"))
    own_habit = any_one(F.zip_with("fails", F.coalesce("habit", F.array(*[F.lit(0)] * len(names))), lambda a, b: a * b))
    failed = F.filter(F.array(*[F.when(F.col("fails")[i] == 1, F.lit(r)) for i, r in enumerate(names)]), lambda x: x.isNotNull())
    return joined.select(
        "doc_id",
        *[m.split()[0] for m in MEASURES.split(", ")],
        base.alias("base_failed"),
        failed.alias("failed_rules"),
        host_bad.alias("host_rejected"),
        (~base & ~host_bad & ~own_habit).alias("kept"),
    )
