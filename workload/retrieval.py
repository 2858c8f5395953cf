"""I: chunks, vectors, filtered top-k, contexts and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from venturelens import vocabulary as V
from venturelens.functions import urls
from venturelens.functions import vectors as vx
from venturelens.operators import retrieval as rt
from venturelens.operators.skew import top_per_group
from venturelens.plans import retrieval as plan
from workload.common import query, sql_strip, table, text_table

DIM = 64
WINDOW_SQL = """
win_ as (select doc_id, source, unnest(range(0, cast(greatest(ceil((length(text) - 200) / 600.0), 1) as bigint))) as chunk_id, text from documents {where}),
chunks_ as (select doc_id, source, chunk_id, substring(text, cast(chunk_id * 600 + 1 as bigint), 800) as content from win_)
"""
LONG_ENOUGH = f"where length({sql_strip('text')}) >= 100"


def store(spark, sf):
    """Embeddings as a chunk store: label = company, the document of the same number as content."""
    e = table(spark, sf, "embeddings")
    d = table(spark, sf, "documents").select("doc_id", "text", "source")
    return e.join(d, e.vec_id == d.doc_id, "left").select(
        F.concat(F.lit("co"), F.col("label").cast("string")).alias("company"),
        F.col("vec_id").alias("chunk_key"),
        "embedding",
        F.coalesce("text", F.concat(F.lit("vector "), F.col("vec_id").cast("string"))).alias("content"),
        F.coalesce("source", F.lit("unknown")).alias("source"),
    )


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.concat(F.lit("co"), F.col("label").cast("string")).alias("company"),
        F.col("vec_id").alias("chunk_key"),
        "embedding",
    )


def query_vectors(spark, sf):
    """Five query vectors per company: its lowest vector numbers."""
    first = top_per_group(vectors(spark, sf), ["company"], [F.col("chunk_key")], 5, ["chunk_key"], rank="r")
    return first.select("company", (F.col("r") - 1).alias("query_no"), "embedding")


STORE_CTE = """
store_ as (select 'co' || label as company, vec_id as chunk_key, embedding, coalesce(text, 'vector ' || vec_id) as content,
           coalesce(source, 'unknown') as source from embeddings left join documents on vec_id = doc_id),
q_ as (select company, query_no, embedding as qv from (select company, embedding,
        row_number() over (partition by company order by chunk_key) - 1 as query_no from store_) where query_no < 5),
scored_ as (select s.company, chunk_key, query_no, round(list_dot_product(cast(embedding as double[]), cast(qv as double[])), 9) as score
        from store_ s join q_ q on s.company = q.company),
hits_ as (select * from (select *, row_number() over (partition by company, query_no order by score desc, chunk_key) as rank
        from scored_) where rank <= 3)
"""
DEDUPE_CTE = (
    STORE_CTE
    + """,
body_ as (select h.*, content, source from hits_ h join store_ s on h.company = s.company and h.chunk_key = s.chunk_key),
first_ as (select * from (select *, row_number() over (partition by company, content order by query_no, rank) as n from body_) where n = 1),
capped_ as (select * from (select *, row_number() over (partition by company order by query_no, rank) as position from first_) where position <= 15)
"""
)


def recursive_chunks_sql(size: int = V.CHUNK_SIZE, overlap: int = V.CHUNK_OVERLAP) -> str:
    """The recursive cut in SQL, for the default separators: one round per separator (nodes, pieces, runs of short pieces; long pieces are the
    next round's nodes), then the windows of each run one after another by recursion. A path of places keeps the order.
    """
    separators = ["chr(10) || chr(10)", "chr(10)", "'. '", "' '", "''"]
    assert len(separators) == len(V.CHUNK_SEPARATORS)
    last = len(separators) - 1
    rounds = ["n0 as (select doc_id, [0] as path, text, 0 as least from documents where text <> '')"]
    coarsest = " ".join(f"when least <= {i} and contains(text, {x}) then {i}" for i, x in enumerate(separators[:-1]))
    chosen = " ".join(f"when {i} then {x}" for i, x in enumerate(separators))
    for r in range(len(separators)):
        rounds += [
            f"l{r} as (select *, case {coarsest} else {last} end as level from n{r})",
            f"""s{r} as (select doc_id, path, level, case level when {last} then list_transform(range(1, length(text) + 1), lambda i: substring(text, i, 1))
              else list_filter(list_transform(list_zip(string_split(text, sep), range(len(string_split(text, sep)))),
                lambda x: case when x[2] = 0 then x[1] else sep || x[1] end), lambda x: x <> '') end as pieces
              from (select *, case level {chosen} end as sep from l{r}))""",
            f"p{r} as (select doc_id, path, level, unnest(range(len(pieces))) as i, unnest(pieces) as piece from s{r})",
            f"g{r} as (select *, length(piece) >= {size} as long, i - row_number() over (partition by doc_id, path, length(piece) >= {size} order by i) as run from p{r})",
            f"n{r + 1} as (select doc_id, list_append(path, i) as path, piece as text, level + 1 as least from g{r} where long and level < {last})",
        ]
    every = range(len(separators))
    runs = " union all ".join(f"select doc_id, list_append(path, min(i)) as path, list(piece order by i) as pieces from g{r} where not long group by doc_id, path, run" for r in every)
    whole = " union all ".join(f"select doc_id, list_append(path, i) as path, piece as content from g{r} where long and level = {last}" for r in every)
    return f"""with recursive {", ".join(rounds)}, runs as ({runs}),
    sums as (select *, len(pieces) as n,
      list_transform(range(len(pieces) + 1), lambda k: coalesce(list_sum(list_transform(pieces[1:k], lambda x: length(x))), 0)::bigint) as p from runs),
    -- a: where the next window begins; e: the piece that did not fit into the one before
    windows as (
      select doc_id, path, pieces, n, p, 0::bigint as a, 0::bigint as e, null::varchar as content, 0 as w from sums
      union all
      select doc_id, path, pieces, n, p,
        case when f = n then n else list_filter(range(a, f + 1), lambda s: p[f + 1] - p[s + 1] <= {overlap} and (p[f + 1] = p[s + 1] or p[f + 2] - p[s + 1] <= {size}))[1] end,
        f, array_to_string(pieces[a + 1:f], ''), w + 1
      from (select *, coalesce(list_filter(range(greatest(a, e) + 1, n), lambda k: p[k + 2] - p[a + 1] > {size})[1], n) as f from windows where w = 0 or e < n)),
    chunks as (select doc_id, list_append(path, w) as path, {sql_strip("content")} as content from windows where w > 0 and {sql_strip("content")} <> '' union all {whole})
    select doc_id, cast(row_number() over (partition by doc_id order by path) - 1 as int) as chunk_id, content, cast(length(content) as int) as n_chars from chunks"""


@query("i01_recursive_chunks", recursive_chunks_sql())
def i01(spark, sf):
    d = text_table(spark, sf, "documents", "doc_id")
    rows = d.select("doc_id", F.posexplode(rt.recursive_chunks(F.col("text"))).alias("chunk_id", "content"))
    return rows.withColumn("n_chars", F.length("content"))


@query(
    "i01_window_chunks",
    f"with {WINDOW_SQL.format(where='where length(text) > 0')} select doc_id, cast(chunk_id as bigint) as chunk_id, content from chunks_",
)
def i01_window(spark, sf):
    d = text_table(spark, sf, "documents", "doc_id").filter(F.length("text") > 0)
    return d.select("doc_id", F.posexplode(rt.window_chunks(F.col("text"))).alias("chunk_id", "content")).withColumn(
        "chunk_id", F.col("chunk_id").cast("bigint")
    )


@query(
    "i02_chunk_rows",
    f"""with {WINDOW_SQL.format(where=LONG_ENOUGH)}
    select source as company, 'doc' || doc_id || '.txt' as source, 'raw/' || source || '/doc' || doc_id || '.txt' as file_path,
      cast(chunk_id as bigint) as chunk_id, content from chunks_""",
)
def i02(spark, sf):
    name = F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".txt"))
    files = text_table(spark, sf, "documents", "doc_id").select(
        F.col("source").alias("company"),
        name.alias("source"),
        F.concat_ws("/", F.lit("raw"), "source", name).alias("file_path"),
        "text",
    )
    return rt.chunk_rows(files, chunker=rt.window_chunks).withColumn("chunk_id", F.col("chunk_id").cast("bigint"))


@query(
    "i03_normalize",
    """with n as (select vec_id, sqrt(list_sum(list_transform(embedding, lambda x: (3.0 * x::double) * (3.0 * x::double)))) as norm, embedding from embeddings)
    select vec_id, round(norm, 6) as norm, round(3.0 * embedding[1]::double / norm, 6) as first, round(3.0 * embedding[64]::double / norm, 6) as last from n""",
)
def i03(spark, sf):
    e = table(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") * 3.0).alias("v")
    )
    unit = e.withColumn("u", vx.l2_normalize(F.col("v")))
    return unit.select(
        "vec_id",
        F.round(vx.l2_norm(F.col("v")), 6).alias("norm"),
        F.round(F.get("u", 0), 6).alias("first"),
        F.round(F.get("u", 63), 6).alias("last"),
    )


@query(
    "i03_embed",
    """with v as (select doc_id, list_transform(string_split('aeinorst', ''), lambda c:
        cast(length(lower(text)) - length(replace(lower(text), c, '')) as double)) as v from documents),
    n as (select *, sqrt(list_sum(list_transform(v, lambda x: x * x))) as norm from v)
    select doc_id, round(cast(cast(case when norm > 0 then v[1] / norm else v[1] end as float) as double), 5) as a, round(cast(cast(case when norm > 0 then v[8] / norm else v[8] end as float) as double), 5) as t from n""",
)
def i03_embed(spark, sf):
    def letter_model():
        """A stand-in for an embedding model: eight letter counts per text. Local, so that it travels with the query."""
        return lambda texts: [[float(t.lower().count(c)) for c in "aeinorst"] for t in texts]

    d = text_table(spark, sf, "documents", "doc_id")
    e = rt.embed(d, letter_model, text="text")
    return e.select(
        "doc_id",
        F.round(F.get("embedding", 0).cast("double"), 5).alias("a"),
        F.round(F.get("embedding", 7).cast("double"), 5).alias("t"),
    )


@query(
    "i04_top_k_of_company",
    f"with {STORE_CTE} select company, cast(query_no as bigint) as query_no, chunk_key, cast(rank as bigint) as rank, round(score, 6) as score from hits_",
)
def i04(spark, sf):
    hits = rt.search_company(vectors(spark, sf), query_vectors(spark, sf), 3)
    return hits.select(
        "company",
        F.col("query_no").cast("bigint").alias("query_no"),
        "chunk_key",
        F.col("rank").cast("bigint").alias("rank"),
        F.round("score", 6).alias("score"),
    )


@query(
    "i05_top_k_of_all",
    """with q as (select cast(embedding as double[]) as qv from embeddings where vec_id = 0),
    s as (select vec_id as chunk_key, round(list_dot_product(cast(embedding as double[]), qv), 9) as score from embeddings, q)
    select chunk_key, round(score, 6) as score from s order by s.score desc, chunk_key limit 5""",
)
def i05(spark, sf):
    store_ = vectors(spark, sf)
    vector = store_.filter(F.col("chunk_key") == 0).first()["embedding"]
    top = rt.search_all(store_, vector, 5)
    return top.select("chunk_key", F.round("score", 6).alias("score"))


@query(
    "i06_result_rows",
    f"""with {STORE_CTE} select content, s.source, s.company, s.company || '/' || s.source || '/' || s.chunk_key as metadata
    from hits_ h join store_ s on h.company = s.company and h.chunk_key = s.chunk_key""",
)
def i06(spark, sf):
    st = store(spark, sf)
    hits = rt.search_company(st.select("company", "chunk_key", "embedding"), query_vectors(spark, sf), 3)
    full = hits.join(st.drop("embedding"), ["company", "chunk_key"]).select(
        "company", "source", F.col("chunk_key").alias("chunk_id"), F.lit(None).cast("string").alias("file_path"), "content"
    )
    rows = rt.result_rows(full)
    return rows.withColumn(
        "metadata", F.concat_ws("/", "metadata.company", "metadata.source", F.col("metadata.chunk_id").cast("string"))
    )


@query(
    "i07_query_fan_out",
    "with t(query_no, tail) as (values "
    + ", ".join(f"({i}, '{t[3:]}')" for i, t in enumerate(V.QUERY_TEMPLATES))
    + ") select s_name as company_name, cast(query_no as bigint) as query_no, s_name || ' ' || tail as query from supplier, t",
)
def i07(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("company_name"))
    return rt.query_texts(s).withColumn("query_no", F.col("query_no").cast("bigint"))


@query(
    "i08_dedupe_and_cap",
    f"""with {DEDUPE_CTE} select company, cast(position as bigint) as position, cast(query_no as bigint) as query_no,
    cast(rank as bigint) as rank, chunk_key, source, content, round(score, 6) as score from capped_""",
)
def i08(spark, sf):
    hits = plan.retrieve(store(spark, sf), query_vectors(spark, sf))
    return hits.select(
        "company",
        F.col("position").cast("bigint").alias("position"),
        F.col("query_no").cast("bigint").alias("query_no"),
        F.col("rank").cast("bigint").alias("rank"),
        "chunk_key",
        "source",
        "content",
        F.round("score", 6).alias("score"),
    )


@query(
    "i09_cap_hits",
    f"""with {DEDUPE_CTE} select company, cast(count(*) as bigint) as n, cast(max(position) as bigint) as last from capped_
    where position <= 4 group by company""",
)
def i09(spark, sf):
    hits = plan.retrieve(store(spark, sf), query_vectors(spark, sf), top_k=4)
    return hits.groupBy("company").agg(
        F.count(F.lit(1)).alias("n"), F.max("position").cast("bigint").alias("last")
    )


COMPANIES_CTE = "companies_ as (select distinct 'co' || label as company from embeddings union all select r_name from region)"
CONTEXT_CTE = (
    DEDUPE_CTE
    + f""", {COMPANIES_CTE},
context_ as (select c.company, coalesce(string_agg('Source: ' || source || chr(10) || content, chr(10) || chr(10) || '---' || chr(10) || chr(10)
    order by position), '{V.NO_CONTEXT.replace("'", "''")}') as context, cast(count(position) as bigint) as retrieved_chunks
    from companies_ c left join capped_ h on c.company = h.company group by c.company)
"""
)


def companies(spark, sf):
    known = vectors(spark, sf).select("company").distinct()
    return known.unionByName(table(spark, sf, "region").select(F.col("r_name").alias("company")))


@query("i10_context_texts", f"with {CONTEXT_CTE} select * from context_")
def i10(spark, sf):
    return plan.contexts(companies(spark, sf), store(spark, sf), query_vectors(spark, sf))


_TEMPLATE = rt.DEFAULT_TEMPLATE.replace("'", "''").replace("\n", "' || chr(10) || '")


@query(
    "i11_prompts",
    f"""with {CONTEXT_CTE} select company, 'COMPANY: ' || company || chr(10) || chr(10) || 'RETRIEVED CONTEXT:' || chr(10) || context
    || chr(10) || chr(10) || '{_TEMPLATE}' || chr(10) || chr(10)
    || 'Use only the context above. Where something is missing, write "Not disclosed."' || chr(10) as prompt from context_""",
)
def i11(spark, sf):
    return rt.prompts(plan.contexts(companies(spark, sf), store(spark, sf), query_vectors(spark, sf)))


@query("i12_store_size", "select cast(count(*) as bigint) as total_documents from embeddings")
def i12(spark, sf):
    return rt.store_size(table(spark, sf, "embeddings"))


STATS_CTE = f"""
files_ as (select source as company, case when length({sql_strip('text')}) >= 100 then cast(greatest(ceil((length(text) - 200) / 600.0), 1) as bigint) end as n_chunks from documents),
names_ as (select distinct source as company from documents union all select n_name from nation),
counts_ as (select company, count(*) as files, count(n_chunks) as files_processed, sum(coalesce(n_chunks, 0)) as chunks_created from files_ group by company)
"""


def file_counts(spark, sf):
    from venturelens.functions.text import strip

    text = F.col("text")
    n = F.size(rt.window_chunks(text))
    return text_table(spark, sf, "documents", "doc_id").select(
        F.col("source").alias("company"), F.when(F.length(strip(text)) >= V.MIN_FILE_CHARS, n).alias("n_chunks")
    )


@query(
    "i13_index_stats",
    f"with {STATS_CTE} select company, cast(files_processed as bigint) as files_processed, cast(chunks_created as bigint) as chunks_created from counts_",
)
def i13(spark, sf):
    known = table(spark, sf, "documents").select(F.col("source").alias("company")).distinct()
    return rt.index_stats(known, file_counts(spark, sf)).select("company", "files_processed", "chunks_created")


@query(
    "i14_index_status",
    f"""with {STATS_CTE} select n.company, case when files is null then 'skipped' when chunks_created > 0 then 'success' else 'failed' end as status,
    case when files is null then 'no_text_files' when chunks_created = 0 then 'no_chunks' end as reason,
    cast(coalesce(files_processed, 0) as bigint) as files_processed, cast(coalesce(chunks_created, 0) as bigint) as chunks_created
    from names_ n left join counts_ c on n.company = c.company""",
)
def i14(spark, sf):
    known = table(spark, sf, "documents").select(F.col("source").alias("company")).distinct()
    names = known.unionByName(table(spark, sf, "nation").select(F.col("n_name").alias("company")))
    return rt.index_stats(names, file_counts(spark, sf))


@query(
    "i15_display_name",
    """select p_partkey, upper(p_name[1]) || substring(p_name, 2, instr(p_name, ' ') - 1) || upper(substring(p_name, instr(p_name, ' ') + 1, 1))
    || substring(p_name, instr(p_name, ' ') + 2) as display_name from part""",
)
def i15(spark, sf):
    p = table(spark, sf, "part")
    folder = F.replace("p_name", F.lit(" "), F.lit("_"))
    return p.select("p_partkey", urls.display_name(folder).alias("display_name"))


@query(
    "i16_answer_rows",
    """with a as (select doc_id, case when quality = 1 then '# Dashboard ' || doc_id end as markdown, case when quality = 0 then 'quota' end as error from labels)
    select d.doc_id, coalesce(markdown, '# Error' || chr(10) || chr(10) || 'Failed to generate dashboard: ' || coalesce(error, 'no answer')) as markdown,
    case when markdown is null then '' else source end as retrieved from documents d left join a on d.doc_id = a.doc_id""",
)
def i16(spark, sf):
    d, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    ids = d.select("doc_id")
    good = F.col("quality") == 1
    answers = labels.select(
        "doc_id",
        F.when(good, F.concat(F.lit("# Dashboard "), F.col("doc_id").cast("string"))).alias("markdown"),
        F.when(~good, F.lit("quota")).alias("error"),
    )
    contexts = d.select("doc_id", F.array("source").alias("retrieved"))
    rows = rt.answer_rows(ids, answers, contexts, company="doc_id")
    return rows.withColumn("retrieved", F.array_join("retrieved", ", "))
