"""Chunking, the embedding hook, and filtered top-k retrieval over vector tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venturelens import vocabulary as V
from venturelens.functions import text as tx
from venturelens.functions import vectors as vx
from venturelens.operators.skew import top_per_group, union_rows

# --- chunks --------------------------------------------------------------------------


def _pieces(text: str, separator: str) -> list[str]:
    """Cut before each separator, which stays at the front of its piece."""
    if not separator:
        return list(text)
    head, *rest = text.split(separator)
    return [p for p in [head, *(separator + r for r in rest)] if p]


def _packed(pieces: Sequence[str], size: int, overlap: int) -> Iterator[str]:
    """Greedy windows of consecutive pieces: at most ``size`` characters, up to ``overlap`` repeated."""
    start = length = 0
    for end, piece in enumerate(pieces):
        if length + len(piece) > size and start < end:
            yield "".join(pieces[start:end])
            while length > overlap or (length and length + len(piece) > size):
                length -= len(pieces[start])
                start += 1
        length += len(piece)
    yield "".join(pieces[start:])


def split_chunks(
    text: str,
    size: int = V.CHUNK_SIZE,
    overlap: int = V.CHUNK_OVERLAP,
    separators: Sequence[str] = V.CHUNK_SEPARATORS,
) -> list[str]:
    """Chunks cut at the coarsest separator present; pieces still too long go to the next one."""
    level = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    finer = separators[level + 1 :]
    chunks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if run:
            chunks.extend(c for c in (w.strip() for w in _packed(run, size, overlap)) if c)
            run.clear()

    for piece in _pieces(text, separators[level]):
        if len(piece) < size:
            run.append(piece)
            continue
        flush()
        chunks.extend(split_chunks(piece, size, overlap, finer) if finer else [piece])
    flush()
    return chunks


def recursive_chunks(text: Column, size: int = V.CHUNK_SIZE, overlap: int = V.CHUNK_OVERLAP, separators: Sequence[str] = V.CHUNK_SEPARATORS) -> Column:
    """array<string> of the chunks of a text (Arrow batches; the cut is sequential)."""
    seps = list(separators)

    @F.pandas_udf("array<string>")
    def cut(batch: pd.Series) -> pd.Series:
        return batch.map(lambda t: split_chunks(t, size, overlap, seps) if t else [])

    return cut(text)


def window_chunks(text: Column, size: int = V.CHUNK_SIZE, overlap: int = V.CHUNK_OVERLAP) -> Column:
    """Fixed windows of ``size`` characters every ``size - overlap``, all native."""
    step = size - overlap
    last = F.greatest(F.ceil((F.length(text) - overlap) / step) - 1, F.lit(0)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(text, i * step + 1, F.lit(size))
    )


def chunk_rows(
    files: DataFrame,
    chunker: Callable[[Column], Column] = recursive_chunks,
    min_chars: int = V.MIN_FILE_CHARS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(company, source, chunk_id, file_path, content) of files with at least ``min_chars`` stripped characters."""
    long_enough = files.filter(F.length(tx.strip(F.col("text"))) >= min_chars)
    return long_enough.select(
        "company", "source", "file_path", *keep, F.posexplode(chunker(F.col("text"))).alias("chunk_id", "content")
    )


def embed(df: DataFrame, model: Callable[[], Callable[[list[str]], list[list[float]]]], text: str = "content", normalize: bool = True) -> DataFrame:
    """Adds ``embedding`` from a pluggable model; ``model()`` runs once per Python worker task."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = model()
        for batch in batches:
            yield pd.Series([list(map(float, v)) for v in encode(batch.tolist())], index=batch.index)

    out = df.withColumn("embedding", run(F.col(text)))
    if not normalize:
        return out
    return out.withColumn("embedding", vx.l2_normalize(F.col("embedding")).cast("array<float>"))


# --- search --------------------------------------------------------------------------


# Scores are compared at nine decimals, so equal vectors tie whatever order a sum is built in.
SCORE_DIGITS = 9


CHUNK_BLOCK = 4096  # chunks and queries that meet at a time
QUERY_BLOCK = 256


def _vectors(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and matrix of the lists of this width that have all their numbers."""
    lists = column.combine_chunks()
    rows = np.flatnonzero(lists.value_lengths().to_numpy(zero_copy_only=False) == width)
    matrix = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, width)
    whole = ~np.isnan(matrix).any(axis=1)
    return rows[whole], matrix[whole]


def best_of_blocks(chunks: pa.Table, queries: pa.Table, k: int, company: str, query: str, id_: str) -> pa.Table:
    """Of a block of a company's chunks and a block of its queries: the chunks that may be among the top ``k`` of each query.

    They are scored as one matrix product per width; a chunk scores for queries of its own width only. Ties with the last stay.
    """
    rows_, numbers_, scores_ = [], [], []
    widths = {w for w in queries["embedding"].combine_chunks().value_lengths().to_pylist() if w}
    for width in sorted(widths):
        mine, matrix = _vectors(chunks["embedding"], width)
        asked, vectors = _vectors(queries["embedding"], width)
        if not len(mine) or not len(asked):
            continue
        scores = np.round(matrix @ vectors.T, SCORE_DIGITS)
        bar = np.partition(scores, -k, axis=0)[-k] if len(mine) > k else -np.inf
        at, of = np.nonzero(scores >= bar)
        rows_.append(mine[at])
        numbers_.append(asked[of])
        scores_.append(scores[at, of])
    none = np.zeros(0, np.int64)
    picked = pa.array(np.concatenate(rows_) if rows_ else none)
    numbers = pa.array(np.concatenate(numbers_) if numbers_ else none)
    found = pa.array(np.concatenate(scores_) if scores_ else np.zeros(0))
    return pa.table(
        [chunks[company].combine_chunks().take(picked), chunks[id_].combine_chunks().take(picked), queries[query].combine_chunks().take(numbers), found],
        names=[company, id_, query, "score"],
    )


def search_company(
    chunks: DataFrame,
    queries: DataFrame,
    k: int = 3,
    company: str = "company",
    query: str = "query_no",
    id_: str = "chunk_key",
    chunk_block: int = CHUNK_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Top ``k`` chunks of each query among the chunks of the query's own company (ties: lowest id).

    Counts by company tell into how many blocks its chunks and its queries are dealt; blocks of both meet by cogroup, so a company with a
    third of all chunks is as many groups as it needs, chunk vectors are read and shuffled once (once per block of ``query_block``
    queries of the company), and chunks of companies without a query aren't sent. Only ids and scores of each block's best ``k`` go on;
    content is joined to the winners afterwards. Rows without company, vector or one of its numbers can't have a score and are left out.
    """
    kind = {c: chunks.schema[c].dataType.simpleString() for c in (company, id_)}
    own = chunks.select(company, id_, "embedding").filter(F.col(company).isNotNull() & F.col("embedding").isNotNull())
    asked = queries.select(company, F.col(query).cast("bigint").alias(query), "embedding").filter(
        F.col(company).isNotNull() & F.col(query).isNotNull() & F.col("embedding").isNotNull()
    )
    counts = union_rows([own.select(company, F.lit(1).alias("_c"), F.lit(0).alias("_q")), asked.select(company, F.lit(0).alias("_c"), F.lit(1).alias("_q"))])
    blocks = lambda column, most, name: F.ceil(F.sum(column) / most).cast("int").alias(name)
    sizes = counts.groupBy(company).agg(blocks("_c", chunk_block, "_chunk_blocks"), blocks("_q", query_block, "_query_blocks"))  # a row per company
    sizes = sizes.filter((F.col("_chunk_blocks") > 0) & (F.col("_query_blocks") > 0))
    block_of = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = [company, "_chunk_block", "_query_block"]
    left = own.join(sizes, company).select(company, id_, "embedding", block_of(id_, "_chunk_blocks").alias("_chunk_block"), every("_query_blocks").alias("_query_block"))
    right = asked.join(sizes, company).select(company, query, "embedding", block_of(query, "_query_blocks").alias("_query_block"), every("_chunk_blocks").alias("_chunk_block"))

    def best(chunk_rows: pa.Table, query_rows: pa.Table) -> pa.Table:
        return best_of_blocks(chunk_rows, query_rows, k, company, query, id_)

    schema = f"`{company}` {kind[company]}, `{id_}` {kind[id_]}, `{query}` bigint, score double"
    rows = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best, schema)
    return top_per_group(rows, [company, query], [F.col("score").desc(), F.col(id_)], k, [id_], salts=1)


def search_all(
    chunks: DataFrame, vector: Sequence[float], k: int = 5, id_: str = "chunk_key"
) -> DataFrame:
    """Top ``k`` over the whole store for one query vector (TakeOrderedAndProject: k rows per task).
    """
    terms = F.array(*[F.lit(float(x)) for x in vector])
    score = F.round(vx.dot(F.col("embedding"), terms), SCORE_DIGITS)
    return chunks.withColumn("score", score).drop("embedding").orderBy(F.col("score").desc(), id_).limit(k)


def query_texts(companies: DataFrame, name: str = "company_name", templates: Sequence[str] = V.QUERY_TEMPLATES) -> DataFrame:
    """One row per company and query template, in template order."""
    texts = F.array(*[F.format_string(t, F.col(name)) for t in templates])
    return companies.select(*companies.columns, F.posexplode(texts).alias("query_no", "query"))


def dedupe_ordered(hits: DataFrame, company: str = "company", query: str = "query_no", rank: str = "rank", content: str = "content") -> DataFrame:
    """The first of equal contents per company, by (query, rank)."""
    rest = [c for c in hits.columns if c not in (company, content)]
    first = hits.groupBy(company, content).agg(F.min_by(F.struct(*rest), F.struct(query, rank)).alias("_f"))
    return first.select(company, content, "_f.*")


def cap_hits(hits: DataFrame, top_k: int = 15, company: str = "company", query: str = "query_no", rank: str = "rank", position: str = "position") -> DataFrame:
    """The first ``top_k`` hits per company in (query, rank) order; hits per company are few by now."""
    return top_per_group(hits, [company], [F.col(query), F.col(rank)], top_k, [query, rank], rank=position, salts=1)


def result_rows(hits: DataFrame) -> DataFrame:
    """content, metadata, source and company, with ``unknown`` for missing names."""
    return hits.select(
        "content",
        F.struct("company", "source", "chunk_id", "file_path").alias("metadata"),
        F.coalesce("source", F.lit("unknown")).alias("source"),
        F.coalesce("company", F.lit("unknown")).alias("company"),
    )


def context_texts(
    companies: DataFrame, hits: DataFrame, company: str = "company", position: str = "position", rule: str = V.CONTEXT_RULE, empty: str = V.NO_CONTEXT
) -> DataFrame:
    """``Source: s`` + content blocks in order, per company; a fixed sentence where there is no hit.

    ``hits`` must be capped (``cap_hits``): at most top_k rows per company are collected.
    """
    block = F.concat(F.lit("Source: "), "source", F.lit("\n"), "content")
    packed = hits.groupBy(company).agg(
        F.sort_array(F.collect_list(F.struct(F.col(position).alias("p"), block.alias("b")))).alias("_l"),
        F.count(F.lit(1)).alias("retrieved_chunks"),
    )
    joined = companies.select(company).join(packed, company, "left")
    context = F.array_join(F.transform("_l", lambda x: x["b"]), rule)
    return joined.select(
        company,
        F.coalesce(context, F.lit(empty)).alias("context"),
        F.coalesce("retrieved_chunks", F.lit(0).cast("bigint")).alias("retrieved_chunks"),
    )


DEFAULT_TEMPLATE = "Write an investor dashboard with these sections:\n\n" + "\n".join(V.SECTIONS)


def prompts(contexts: DataFrame, template: str | None = None, company: str = "company") -> DataFrame:
    """Company, context and template as one prompt text; the built-in template where none is given."""
    body = template or DEFAULT_TEMPLATE
    prompt = F.concat(
        F.lit("COMPANY: "), F.col(company), F.lit("\n\nRETRIEVED CONTEXT:\n"), F.col("context"),
        F.lit("\n\n" + body + "\n\nUse only the context above. Where something is missing, write \"Not disclosed.\"\n"),
    )
    return contexts.select(company, prompt.alias("prompt"))


def answer_rows(companies: DataFrame, answers: DataFrame, contexts: DataFrame, company: str = "company") -> DataFrame:
    """Markdown and retrieved context per company; a failed call gives the error text and an empty list."""
    a = answers.select(company, "markdown", "error")
    c = contexts.select(company, "retrieved")
    joined = companies.select(company).join(a, company, "left").join(c, company, "left")
    failed = F.col("markdown").isNull()
    note = F.concat(
        F.lit("# Error\n\nFailed to generate dashboard: "), F.coalesce("error", F.lit("no answer"))
    )
    empty = F.array().cast(contexts.schema["retrieved"].dataType)
    return joined.select(
        company,
        F.coalesce("markdown", note).alias("markdown"),
        F.when(failed, empty).otherwise(F.coalesce("retrieved", empty)).alias("retrieved"),
    )


# --- store statistics ------------------------------------------------------------------


def store_size(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count(F.lit(1)).alias("total_documents"))


def index_stats(companies: DataFrame, files: DataFrame, company: str = "company") -> DataFrame:
    """Files processed, chunks created and status per company.

    ``files`` has one row per text file with ``n_chunks`` (null where the file was too short).
    """
    counts = files.groupBy(company).agg(
        F.count(F.lit(1)).alias("_files"),
        F.count_if(F.col("n_chunks").isNotNull()).alias("files_processed"),
        F.sum(F.coalesce("n_chunks", F.lit(0))).cast("bigint").alias("chunks_created"),
    )
    zero = F.lit(0).cast("bigint")
    joined = companies.select(company).join(counts, company, "left")
    made = F.coalesce("chunks_created", zero)
    return joined.select(
        company,
        F.when(F.col("_files").isNull(), "skipped").when(made > 0, "success").otherwise("failed").alias("status"),
        F.when(F.col("_files").isNull(), "no_text_files").when(made == 0, "no_chunks").alias("reason"),
        F.coalesce("files_processed", zero).alias("files_processed"),
        made.alias("chunks_created"),
    )
