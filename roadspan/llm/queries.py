"""One named query per operator, over its whole table, and SQL where that can express it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspan.llm import blob_ledger, content_sort, context_mixing, crf, deobfuscation, flow_shards, merge_replay, nb_linear, orchard, periodic_runs, simhash, spaced_seeds, warc
from roadspan.llm.common import crc_remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def _digest(found: DataFrame, base: str, spans: str, base_kinds: tuple[str, ...], kinds: tuple[str, ...]) -> DataFrame:
    """Counts per base kind, the hash of the base spans, and all spans as text."""
    return found.select(
        "doc_id",
        *[
            F.size(F.expr(f"filter({base}, s -> s.kind_no = {k})")).cast("long").alias(f"n_{kind}")
            for k, kind in enumerate(base_kinds)
        ],
        F.sha2(blob_ledger.listed(base, kinds).cast("binary"), 256).alias("base_sha256"),
        blob_ledger.listed(spans, kinds).alias("spans"),
    )


@query
def op1_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = blob_ledger.scan(table(spark, sf_dir, "documents")).withColumnRenamed("path", "doc_id")
    kinds = tuple(r.kind for r in blob_ledger.RULES)
    base = F.filter("spans", lambda s: s["kind_no"] < len(blob_ledger.BASE))
    return _digest(found.withColumn("base", base), "base", "spans", blob_ledger.BASE, kinds)


def _places(n: int, rule: blob_ledger.Rule) -> str:
    """Matches as a list. What must not stand before a match is asked of the found ones, as the
    engine knows no such pattern; in the given tables no match hides another by it."""
    pattern, barred = rule.pattern.replace("'", "''"), "false"
    if behind := re.match(r"\(\?<!(\[[^]]*\])\)", pattern):
        pattern, barred = pattern[behind.end() :], f"x.a > 0 AND regexp_matches(t[x.a::BIGINT], '{behind[1]}')"
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{pattern}')) + 1), lambda i: {{
        'a': list_sum(list_transform(string_split_regex(t, '{pattern}')[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(regexp_extract_all(t, '{pattern}')[1:i - 1], lambda x: length(x))), 0),
        'k': {n}, 'n': length(regexp_extract_all(t, '{pattern}')[i]),
        's': length(regexp_extract_all(t, '{pattern}', {rule.group})[i])}}), lambda x: x.s >= {rule.least} AND NOT ({barred}))"""


def _written(rows: str) -> str:
    kinds = ", ".join(f"'{r.kind}'" for r in blob_ledger.RULES)
    one = f"[{kinds}][x.k + 1] || ':' || x.a::BIGINT || ':' || (x.a + x.n)::BIGINT"
    return f"coalesce(array_to_string(list_transform(list_sort({rows}), lambda x: {one}), ','), '')"


ORACLES["op1_blob_ledger"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
), m AS (
    SELECT doc_id, {", ".join(f"{_places(n, r)} AS r{n}" for n, r in enumerate(blob_ledger.RULES))} FROM d
)
SELECT doc_id, len(r0) AS n_assign, len(r1) AS n_access, len(r2) AS n_hex,
       sha256({_written("list_concat(r0, list_concat(r1, r2))")}) AS base_sha256,
       {_written("list_concat(r0, list_concat(r1, list_concat(r2, list_concat(r3, r4))))")} AS spans
FROM m
"""


@query
def op3_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deobfuscation.find(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
    spans = F.array_sort(F.concat("base", "added"))
    return _digest(found.withColumn("spans", spans), "base", "spans", deobfuscation.KINDS, deobfuscation.KINDS)


@query
def op2_nb_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = nb_linear.fit(docs, table(spark, sf_dir, "labels"))
    return nb_linear.scores(docs, model).select(
        F.col("id").alias("doc_id"),
        (crc_remainder("id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op4_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return merge_replay.encode(docs, ranks, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


@query
def op5_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return crf.predict(docs, crf.fit(docs)).select(
        F.col("id").alias("doc_id"),
        (crc_remainder("id", 4) == 2).alias("held_out"),
        "lang_pred",
        "score",
        "switches",
    )


@query
def op7_flow_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old layout keeps each source in one shard, so that shards differ widely."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    old = F.pmod(F.xxhash64("source"), F.lit(8))
    return flow_shards.rewrite(docs, old, 8).select(
        "row.doc_id",
        (F.coalesce(F.octet_length("row.text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("row.text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op6_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = content_sort.exact_groups(table(spark, sf_dir, "documents"))
    return groups.withColumnRenamed("id", "doc_id")


ORACLES["op6_content_sort"] = r"""
WITH norm AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM norm
"""


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query
def op9_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spaced_seeds.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.withColumnRenamed("id", "doc_id")


def _masked(shape: str) -> str:
    read = [f"w[p + {k}]" for k, c in enumerate(shape) if c == "1"]
    return f"CASE WHEN p + {len(shape) - 1} <= len(w) THEN concat_ws(' ', '{shape}', {', '.join(read)}) END"


# The same seeds as text; every item of the given tables has 13 tokens or more.
ORACLES["op9_spaced_seeds"] = rf"""
WITH d AS (
    SELECT doc_id AS id, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM documents
), b AS (
    SELECT item_id AS id, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM benchmark
), dp AS (SELECT id, w, unnest(range(1, len(w) + 1)) AS p FROM d
), bp AS (SELECT id, w, unnest(range(1, len(w) + 1)) AS p FROM b
), ds AS (SELECT id, p, unnest([{", ".join(map(_masked, spaced_seeds.MASKS))}]) AS seed FROM dp
), bs AS (SELECT id, p, unnest([{", ".join(map(_masked, spaced_seeds.MASKS))}]) AS seed FROM bp
), hits AS (
    SELECT DISTINCT ds.id AS doc_id, bs.id AS item_id, ds.p - bs.p AS shift FROM ds JOIN bs USING (seed)
), cells AS (
    SELECT h.doc_id, h.item_id, h.shift, d.w AS dw, b.w AS bw, unnest(range(1, len(b.w) + 1)) AS k
    FROM hits h JOIN d ON d.id = h.doc_id JOIN b ON b.id = h.item_id
), flags AS (
    SELECT doc_id, item_id, shift, k,
           CASE WHEN k + shift >= 1 AND dw[k + shift] = bw[k] THEN 1 ELSE 0 END AS same, len(bw) AS n FROM cells
), sums AS (
    SELECT doc_id, item_id, shift, k, n,
           sum(same) OVER (PARTITION BY doc_id, item_id, shift ORDER BY k ROWS BETWEEN CURRENT ROW AND {spaced_seeds.WINDOW - 1} FOLLOWING) AS matches
    FROM flags
), good AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matches DESC, shift + k) AS place
    FROM sums WHERE k + {spaced_seeds.WINDOW - 1} <= n AND matches >= {spaced_seeds.MATCHES}
)
SELECT doc_id, item_id, CAST(matches AS BIGINT) AS matches, CAST({spaced_seeds.WINDOW} AS BIGINT) AS "window",
       CAST(shift + k - 1 AS BIGINT) AS pos
FROM good WHERE place = 1
"""


@query
def op10_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = context_mixing.write_ids(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )
    return context_mixing.read_ids(spark, path).withColumnRenamed("id", "doc_id")

@query
def op11_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.cluster(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def _lloyd(k: int, rounds: int) -> str:
    """The rounds as one chain of common tables: centroids cN as a list, assignments aN, sums."""
    apart = "list_sum(list_transform(list_zip(v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    near = f"list_min(list_transform(cs, lambda c: {{'d': {apart}, 'c': c.c}}))"
    steps = f"""
raw AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
    SELECT list({{'c': c, 'v': v}} ORDER BY c) AS cs FROM (
        SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
        FROM (SELECT v, sha256('2:' || vec_id) AS h FROM raw ORDER BY h, v LIMIT {k}))
), a0 AS MATERIALIZED (SELECT vec_id, v, {near} AS m FROM raw, c0)"""
    for n in range(1, rounds + 1):
        steps += f""", s{n} AS (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
        SELECT m.c AS c, i, sum(v[i]) AS s, count(*) AS n FROM a{n - 1}, range(1, 65) AS r(i) GROUP BY ALL) GROUP BY c
), c{n} AS MATERIALIZED (
    SELECT list({{'c': o.c, 'v': coalesce(s.v, o.v)}} ORDER BY o.c) AS cs
    FROM (SELECT unnest(cs, recursive := true) FROM c{n - 1}) AS o LEFT JOIN s{n} AS s USING (c)
), a{n} AS MATERIALIZED (SELECT vec_id, v, {near} AS m FROM raw, c{n})"""
    return f"""
WITH {steps}
SELECT vec_id, m.c::INT AS cluster, m.d::BIGINT AS distance,
       (sum(m.d) OVER (PARTITION BY m.c))::BIGINT AS cluster_inertia, (sum(m.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(cs[m.c + 1].v, ',')) AS centroid_sha256
FROM a{rounds}, c{rounds}
"""


ORACLES["op11_orchard"] = _lloyd(40, 5)


def planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document, by the crc32 of its id, repeats its words from some place on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    chosen = chosen.withColumn("a", F.when(F.size("w") > 0, (F.col("g") % F.size("w")).cast("int")))
    rest = F.size("w") - F.col("a")
    chosen = chosen.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil(rest / F.col("p")).cast("int")
    block = F.slice("w", F.col("a") + 1, F.col("p"))
    again = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), rest)
    remade = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), again), " ")
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), remade).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = periodic_runs.find_runs(planted_runs(table(spark, sf_dir, "documents")))
    return periodic_runs.digests(runs).withColumnRenamed("id", "doc_id")


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write(table(spark, sf_dir, "pages"), gzip=True)
    return warc.records(warc.read(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
