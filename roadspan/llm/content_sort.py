"""Exact deduplication by sorting contents.

Rows are dealt to partitions by ranges of (text prefix, text hash, id) between sampled
splitters, sorted there externally by the whole normalised text, and compared in full with
the row before. A group of equal texts of any size is cut by the id part of the splitters,
so it spreads over partitions; its pieces, at most two per partition, are joined at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadspan.llm.common import shuffle_partitions, stored

PREFIX_CHARS = 64
SAMPLES_PER_PARTITION = 60
LAST_ID = (1 << 63) - 1


def normalised(text: Column) -> Column:
    """Null counts as empty; each run of ASCII white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _keyed(docs: DataFrame) -> DataFrame:
    """Adds the sort key; ``norm`` and ``id`` are given."""
    return docs.withColumn(
        "key",
        F.struct(
            F.substring("norm", 1, PREFIX_CHARS).alias("prefix"),
            F.xxhash64("norm").alias("tag"),
            F.coalesce("id", F.lit(LAST_ID)).alias("place"),
        ),
    )


def _splitters(docs: DataFrame, parts: int) -> list[tuple[str, int, int]]:
    """Keys that cut the sampled rows, weighted by length, into even parts.

    The driver gets SAMPLES_PER_PARTITION short keys for each partition.
    """
    rows = docs.count()
    wanted = SAMPLES_PER_PARTITION * parts
    sample = docs.sample(fraction=min(1.0, 1.2 * wanted / max(rows, 1)), seed=17)
    keys = [
        (r["key"]["prefix"], r["key"]["tag"], r["key"]["place"], r["n"])
        for r in _keyed(sample).select("key", F.length("norm").alias("n")).collect()
    ]
    keys.sort(key=lambda k: (k[0].encode(), k[1], k[2]))
    mean = sum(k[3] for k in keys) / max(len(keys), 1) + 1
    weight = sum(1 + k[3] / mean for k in keys)
    cuts, seen = [], 0.0
    for prefix, tag, place, n in keys:
        seen += 1 + n / mean
        if seen * parts >= weight * (len(cuts) + 1) and len(cuts) < parts - 1:
            cuts.append((prefix, tag, place))
    return list(dict.fromkeys(cuts))


def _bucket(splitters: list[tuple[str, int, int]]) -> Column:
    """How many splitters are not above the key, found in two steps of about √n compares."""
    if not splitters:
        return F.lit(0)

    def literal(keys):
        return F.array(
            *[
                F.struct(F.lit(p).alias("prefix"), F.lit(t).alias("tag"), F.lit(i).alias("place"))
                for p, t, i in keys
            ]
        )

    width = max(1, int(len(splitters) ** 0.5))
    groups = [splitters[i : i + width] for i in range(0, len(splitters), width)]
    coarse = F.size(F.filter(literal([g[0] for g in groups]), lambda s: s <= F.col("key")))
    inside = F.get(F.array(*[literal(g) for g in groups]), coarse - 1)
    fine = F.size(F.filter(inside, lambda s: s <= F.col("key")))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * width + fine)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal normalised texts the row with the smallest id is kept, of repeated ids the
    first one met; a null id counts as larger than any other. Null and empty texts are one
    group. With ``carry`` the input's columns follow as the struct ``row``.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    text = F.col(text_col)
    if carry:
        rows = docs.select(
            F.col(id_col).cast("long").alias("id"),
            normalised(text).alias("norm"),
            F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        )
    else:
        rows = docs.select(F.col(id_col).cast("long").alias("id"), normalised(text).alias("norm"))
    splitters = _splitters(rows.select("id", "norm"), parts)
    dealt = _keyed(rows).withColumn("bucket", _bucket(splitters))
    if carry:  # the text travels once, inside the row
        dealt = dealt.drop("norm").repartitionById(parts, F.col("bucket").cast("int"))
        dealt = dealt.withColumn("norm", normalised(F.col("row")[text_col]))
    else:
        dealt = dealt.repartitionById(parts, F.col("bucket").cast("int"))

    order = Window.partitionBy("bucket").orderBy("key.prefix", "key.tag", "norm", "key.place")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag("norm").over(order)
    cut_tags = sorted({t for _, t, _ in splitters})
    in_cut_class = F.col("key.tag").isin(cut_tags) if cut_tags else F.lit(False)
    sorted_rows = (
        dealt.withColumn("first", before.isNull() | (before != F.col("norm")))
        .withColumns(
            {
                "run": F.sum(F.col("first").cast("long")).over(so_far),
                "head": F.last(F.when(F.col("first"), F.col("key.place")), True).over(so_far),
                "text_sha256": F.sha2(F.col("norm").cast("binary"), 256),
                "cut_norm": F.when(F.col("first") & in_cut_class, F.col("norm")),
            }
        )
        .select(
            "bucket", "run", "id", "first", "head", "text_sha256", "cut_norm",
            *(["row"] if carry else []),
        )
        .withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("bucket", "run")))
    )
    runs = stored(sorted_rows, "content-sort")

    # Runs of a class that a splitter cuts: a few per partition, so both sides stay small.
    pieces = runs.filter("cut_norm is not null").select("bucket", "run", "cut_norm", "head", "size")
    whole = (
        pieces.groupBy("cut_norm")
        .agg(F.min("head").alias("keep"), F.sum("size").alias("total"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    joined = pieces.join(whole, "cut_norm").select("bucket", "run", "keep", "total")
    keep = F.coalesce("keep", "head")
    return runs.join(F.broadcast(joined), ["bucket", "run"], "left").select(
        "id",
        F.when(keep != LAST_ID, keep).alias("keep_id"),
        F.coalesce("total", "size").alias("group_size"),
        (F.col("first") & (F.col("head") == keep)).alias("kept"),
        "text_sha256",
        *(["row"] if carry else []),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of the input."""
    return exact_groups(docs, id_col, text_col, carry=True).filter("kept").select("row.*")
