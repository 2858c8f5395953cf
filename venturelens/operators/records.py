"""Typed records: validation, model request and answer tables, nesting into payloads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venturelens import schemas as S
from venturelens import vocabulary as V
from venturelens.functions import urls
from venturelens.operators.skew import keyed_join, union_rows

URL = r"(?i)^https?://[^\s/?#]+\.?[^\s]*$"


def _raw_type(field: S.Field) -> str:
    return field.type if field.type.startswith(("array", "map", "struct")) else "string"


def validate(
    items: DataFrame,
    fields: Sequence[S.Field],
    json: str = "json",
    event_types: Sequence[str] = V.EVENT_TYPES,
) -> DataFrame:
    """Parses ``json`` into typed columns plus ``errors``, the broken rules of the row.

    Scalars are read as text and cast, so ``"5"`` is a good int and ``"x"`` an error, never an
    exception in a task. Undeclared fields are ignored, missing lists are empty, defaults apply.
    """
    raw = "struct<" + ",".join(f"{f.name}:{_raw_type(f)}" for f in fields) + ",_corrupt_record:string>"
    parsed = items.withColumn("_raw", F.from_json(json, raw, {"columnNameOfCorruptRecord": "_corrupt_record"}))
    errors: list[Column] = [
        F.when(
            F.col("_raw").isNull() | F.col("_raw._corrupt_record").isNotNull(), F.lit("not a record")
        )
    ]
    values: list[Column] = []
    for f in fields:
        text = F.col(f"_raw.{f.name}")
        nested = _raw_type(f) != "string"
        if f.type == "date":
            value = F.try_to_date(F.when(F.regexp_like(text, F.lit(r"^\d{4}-\d{2}-\d{2}$")), text), "yyyy-MM-dd")
        elif nested or f.type == "string":
            value = text
        else:
            value = text.try_cast(f.type)
        if f.type.startswith("array"):
            value = F.coalesce(value, F.array().cast(f.type))
        elif f.default is not None:
            value = F.coalesce(value, F.lit(f.default))
        if f.required:
            errors.append(F.when(text.isNull(), F.lit(f"{f.name} missing")))
        if not nested and f.type != "string":
            errors.append(F.when(text.isNotNull() & value.isNull(), F.lit(f"{f.name} is no {f.type}")))
        if f.check == "url":
            errors.append(F.when(text.isNotNull() & ~F.regexp_like(text, F.lit(URL)), F.lit(f"{f.name} is no url")))
        if f.check == "event_type":
            errors.append(F.when(text.isNotNull() & ~text.isin(list(event_types)), F.lit(f"{f.name} unknown")))
        if f.name == "provenance":
            bad = F.exists(
                F.coalesce(text, F.array().cast(f.type)),
                lambda p: F.coalesce(~F.regexp_like(p["source_url"], F.lit(URL)), F.lit(True)) | p["crawled_at"].isNull(),
            )
            errors.append(F.when(bad, F.lit("provenance is not valid")))
        values.append(value.alias(f.name))
    rest = [c for c in items.columns if c != json and c not in {f.name for f in fields}]
    return parsed.select(
        *rest, *values, F.filter(F.array(*errors), lambda e: e.isNotNull()).alias("errors")
    )


def conform(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The given columns in order and type; missing ones null, missing lists empty, others dropped."""
    have = set(df.columns)

    def one(name: str, kind: str) -> str:
        value = f"cast({f'`{name}`' if name in have else 'null'} as {kind})"
        if kind.startswith("array"):
            value = f"coalesce({value}, cast(array() as {kind}))"
        if name == "schema_version":
            value = f"coalesce({value}, '{V.SCHEMA_VERSION}')"
        return f"{value} as `{name}`"

    return df.selectExpr(*[one(n, k) for n, k in columns.items()])


def split_valid(checked: DataFrame, key: str = "company_id") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows: one bad item rejects every item of its company."""
    bad = F.size("errors") > 0
    keys = checked.filter(bad).select(key).distinct()
    good = keyed_join(checked, keys, [key], "left_anti")
    return good.drop("errors"), checked.filter(bad)


def domain_violations(df: DataFrame, column: str, domain: Sequence[str] = V.EVENT_TYPES) -> DataFrame:
    """Rows whose value is outside the domain, counted per value."""
    outside = df.filter(~F.col(column).isin(list(domain)))
    return outside.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def with_fallback(extracted: DataFrame, seed: DataFrame, ids: DataFrame, key: str = "company_id") -> DataFrame:
    """One company record per id: the extracted one, else the seed row, else a bare ``Unknown``."""
    shared = ["website", "hq_city", "hq_country", "founded_year", "categories"]
    s = seed.select(
        key,
        F.coalesce("legal_name", "company_name").alias("_s_legal_name"),
        *[F.col(c).alias(f"_s_{c}") for c in shared],
    )
    e = extracted.withColumn("_got", F.lit(True))
    empty = F.array().cast("array<string>")
    joined = ids.select(key).join(e, key, "left").join(s, key, "left")
    columns = []
    for c in extracted.columns:
        if c == key:
            columns.append(F.col(key))
        elif c == "legal_name":
            columns.append(
                F.when(F.col("_got"), F.col(c)).otherwise(F.coalesce("_s_legal_name", F.lit("Unknown"))).alias(c)
            )
        elif c in shared:
            value = F.when(F.col("_got"), F.col(c)).otherwise(F.col(f"_s_{c}"))
            columns.append((F.coalesce(value, empty) if c == "categories" else value).alias(c))
        else:
            columns.append(F.col(c))
    return joined.select(*columns)


def own_key(children: DataFrame, owner: Column, id_column: str, id_parts: Sequence[str]) -> DataFrame:
    """Children carry the owner's id; a missing child id is derived from its content (repeatable)."""
    fresh = urls.stable_id(*[F.col(p) for p in id_parts])
    given = F.col(id_column)
    return children.withColumn("company_id", owner).withColumn(
        id_column, F.when(given.isNull() | (given == ""), fresh).otherwise(given)
    )


def merge_intelligence(company: DataFrame, bi: DataFrame, key: str = "company_id") -> DataFrame:
    """Business-intelligence columns joined onto the company; missing ones are null."""
    columns = [c for c in S.BI_FIELDS if c in bi.columns]
    return company.drop(*columns).join(bi.select(key, *columns), key, "left")


# System prompts and limits of the three model passes. The wording is this project's own.
PASSES = [
    ("basics_events", "List the company's basic facts and its dated events. Use only the given text.", 6000),
    ("products_leaders", "List the products and the leaders named in the text. Use only the given text.", 8000),
    ("intelligence", "Describe positioning, business model, sales, pricing and markets. Use only the given text.", 4000),
]


def model_requests(contexts: DataFrame, key: str = "company_id", passes: Sequence[tuple[str, str, int]] = PASSES, cap: int = V.CONTEXT_CAP) -> DataFrame:
    """One request row per company and pass; the passes are a literal array, so nothing is joined."""
    table = F.array(
        *[
            F.struct(F.lit(n).alias("pass_name"), F.lit(p).alias("system_prompt"), F.lit(m).alias("max_tokens"))
            for n, p, m in passes
        ]
    )
    return contexts.select(key, F.substring("context", 1, cap).alias("user_content"), F.inline(table)).withColumn(
        "temperature", F.lit(0.1)
    )


def pass_rows(
    answers: DataFrame, pass_name: str, list_name: str, entity: str, key: str = "company_id"
) -> DataFrame:
    """Items of one list in the answers of one pass, as (company, pos, json) rows to be validated."""
    good = answers.filter(F.col("pass_name") == pass_name)
    items = F.from_json("answer", f"{list_name} array<string>")[list_name]
    return good.select(key, F.posexplode(F.coalesce(items, F.array().cast("array<string>"))).alias("pos", "json"))


def pass_status(answers: DataFrame, required: Mapping[str, str], key: str = "company_id") -> DataFrame:
    """ok, or failed where the answer is missing, an error or lacks the pass's required member."""
    member = F.create_map(*[F.lit(x) for kv in required.items() for x in kv])
    value = F.try_variant_get(F.try_parse_json("answer"), F.concat(F.lit("$."), member[F.col("pass_name")]), "variant")
    return answers.select(
        key, "pass_name", F.when(value.isNotNull(), F.lit("ok")).otherwise(F.lit("failed")).alias("status")
    )


# --- payloads -------------------------------------------------------------------------

SORT_KEYS = {
    "events": ["occurred_on", "event_id"],
    "snapshots": ["as_of"],
    "products": ["product_id"],
    "leadership": ["person_id"],
    "visibility": ["as_of"],
}


PART_ROWS = 1000


def payload_items(children: Mapping[str, DataFrame], key: str = "company_id", sort_keys: Mapping[str, Sequence[str]] = SORT_KEYS) -> DataFrame:
    """``company_id, entity`` and one column per entity: every child row by itself, packed with its sort keys in its entity's column."""
    names = list(children)
    types = {n: _packed_type(children[n], sort_keys[n]) for n in names}
    rows = []
    for n in names:
        items = children[n].select(key, _packed(children[n], sort_keys[n]).alias(n))
        rows.append(items.select(key, F.lit(n).alias("entity"), *[F.col(m) if m == n else F.lit(None).cast(types[m]).alias(m) for m in names]))
    return union_rows(rows)


def payload_counts(children: Mapping[str, DataFrame], key: str = "company_id") -> DataFrame:
    """``company_id, entity, n_items``, counted from keys alone."""
    return union_rows([c.select(key, F.lit(n).alias("entity")) for n, c in children.items()]).groupBy(key, "entity").agg(F.count(F.lit(1)).alias("n_items"))


LARGE_PARTS = 32  # a list of more parts than this is dealt out before its rows meet


def payload_parts(
    children: Mapping[str, DataFrame], key: str = "company_id", sort_keys: Mapping[str, Sequence[str]] = SORT_KEYS, part_rows: int = PART_ROWS
) -> DataFrame:
    """``company_id, entity, n_items, n_parts, part`` and one list per entity: the child rows in parts of about ``part_rows`` items.

    The parts of a company's entity follow from their count; an item's part follows from its content, so a part is in order in itself and the
    parts merge by the sort keys that the items carry. Lists of up to ``LARGE_PARTS`` parts are gathered whole and cut where they are. Longer ones,
    of which there are few, are known from the counts of keys: their items go straight to their part, so a company with a third of all rows meets in
    no one task. Items are shuffled once. The other entities' lists are null.
    """
    names = list(children)
    counts = payload_counts(children, key).filter(F.col("n_items") > LARGE_PARTS * part_rows)
    large = F.broadcast(counts.withColumnRenamed("n_items", "_large"))
    n_parts = lambda n: F.ceil(n / part_rows).cast("int")
    items = payload_items(children, key, sort_keys).filter(F.col(key).isNotNull()).join(large, [key, "entity"], "left")
    items = items.withColumn("_part", F.when(F.col("_large").isNotNull(), F.pmod(F.xxhash64(*names), n_parts(F.col("_large"))).cast("int")))
    group = [key, "entity", "_large", "_part"]
    lists = items.repartition(key, "entity", "_part").groupBy(*group).agg(*[F.collect_list(n).alias(n) for n in names])
    counted = lists.withColumn("n_items", F.coalesce("_large", sum((F.size(n) for n in names), F.lit(0)).cast("bigint"))).withColumn("n_parts", n_parts(F.col("n_items")))

    def cut(part: Column) -> Column:
        own = {n: F.filter(n, lambda x: F.pmod(F.xxhash64(x), F.col("n_parts")) == part) for n in names}
        return F.struct(part.alias("part"), *[F.when(F.col("entity") == n, F.sort_array(own[n])).alias(n) for n in names])

    places = F.when(F.col("_part").isNotNull(), F.array("_part")).otherwise(F.sequence(F.lit(0), F.col("n_parts") - 1))
    parts = counted.select(key, "entity", "n_items", "n_parts", F.inline(F.transform(places, cut)))
    return parts.filter(F.greatest(*[F.size(F.coalesce(n, F.array().cast(parts.schema[n].dataType))) for n in names], F.lit(0)) > 0)


def flatten_parts(parts: DataFrame, entity: str) -> DataFrame:
    """The child rows of an entity (inverse of ``payload_parts``), part by part."""
    return parts.filter(F.col("entity") == entity).select(F.inline(F.transform(entity, lambda x: x["v"])))


def nested_payloads(company: DataFrame, parts: DataFrame, key: str = "company_id", notes: str = "", policy: str = V.PROVENANCE_POLICY) -> DataFrame:
    """The payload rows (as ``assemble_payloads``) of the given companies, from stored parts; other companies' parts aren't gathered."""
    names = [c for c in parts.columns if c not in (key, "entity", "n_items", "n_parts", "part")]
    record = company.select(key, F.struct(*company.columns).alias("company_record"))
    nested = [F.transform(F.sort_array(F.flatten(F.collect_list(n))), lambda x: x["v"]).alias(n) for n in names]
    own = parts.join(company.select(key), key, "left_semi").groupBy(key).agg(*nested)
    joined = record.join(own, key, "left")
    return joined.select(key, "company_record", *[_or_empty(joined, n) for n in names], F.lit(notes).alias("notes"), F.lit(policy).alias("provenance_policy"))


def assemble_payloads(
    company: DataFrame,
    children: Mapping[str, DataFrame],
    key: str = "company_id",
    sort_keys: Mapping[str, Sequence[str]] = SORT_KEYS,
    notes: str = "",
    policy: str = V.PROVENANCE_POLICY,
) -> DataFrame:
    """One payload row per company: the record and one sorted list per child entity, straight from the tables.

    Records and child rows go through one shuffle by company as they are, and the lists are built and sorted where they arrive: gathering them
    before the shuffle would sort and write every row once more for lists of one item. A payload
    is one document by its format, so its row is as large as the company's own children: for companies of any size there are
    ``payload_parts``, for counts ``payload_counts``, for dashboards the aggregates of ``dashboard.dashboards``.
    """
    names = list(children)
    columns = {"_record": company.select(key, F.struct(*company.columns).alias("_record"))}
    columns |= {n: children[n].filter(F.col(key).isNotNull()).select(key, F.struct(*children[n].columns).alias(n)) for n in names}
    types = {n: d.schema[n].dataType for n, d in columns.items()}
    rows = union_rows([d.select(key, *[F.col(m) if m == n else F.lit(None).cast(t).alias(m) for m, t in types.items()]) for n, d in columns.items()])
    gathered = rows.repartition(key).groupBy(key).agg(*[F.collect_list(n).alias(n) for n in columns])

    def ordered(name: str) -> Column:
        packed = F.transform(name, lambda x: F.struct(*[x[c].alias(f"k{i}") for i, c in enumerate(sort_keys[name])], x.alias("v")))
        return F.transform(F.sort_array(packed), lambda x: x["v"]).alias(name)

    lists = gathered.filter(F.size("_record") > 0).select(key, "_record", *[ordered(n) for n in names])
    return lists.select(
        key,
        F.explode("_record").alias("company_record"),
        *names,
        F.lit(notes).alias("notes"),
        F.lit(policy).alias("provenance_policy"),
    )


def _or_empty(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast(df.schema[name].dataType)).alias(name)


def _packed(child: DataFrame, order: Sequence[str]) -> Column:
    """struct(sort columns, v = the whole child row)."""
    sort = [F.col(c).alias(f"k{i}") for i, c in enumerate(order)]
    return F.struct(*sort, F.struct(*child.columns).alias("v"))


def _packed_type(child: DataFrame, order: Sequence[str]):
    return child.select(_packed(child, order).alias("p")).schema["p"].dataType


def flatten_payloads(payloads: DataFrame, entity: str, key: str = "company_id") -> DataFrame:
    """The child rows of a payload list (inverse of the assembly)."""
    return payloads.select(F.inline(entity))


def record_containers(
    ids: DataFrame, lists: DataFrame, names: Sequence[str], key: str = "company_id"
) -> DataFrame:
    """One container per id with empty lists where a pass found nothing; ``status`` tells a missing company."""
    joined = ids.select(key).join(lists, key, "left")
    return joined.select(
        key,
        F.when(F.col("company").isNull(), F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        "company",
        *[_or_empty(joined, n) for n in names],
    )


def payload_or_default(ids: DataFrame, payloads: DataFrame, key: str = "company_id", starter_name: str = "Example AI Inc.") -> DataFrame:
    """The payload of each id; ids without one get the starter record."""
    starter = F.struct(
        *[
            (F.lit(starter_name) if f.name == "legal_name" else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in payloads.schema["company_record"].dataType.fields
        ]
    )
    joined = ids.select(key).join(payloads, key, "left")
    lists = [c for c in S.CHILDREN if c in payloads.columns]
    return joined.select(
        key,
        F.coalesce("company_record", starter).alias("company_record"),
        *[_or_empty(joined, n) for n in lists],
        F.col("company_record").isNull().alias("is_default"),
    )
