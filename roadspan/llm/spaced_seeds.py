"""Benchmark decontamination by spaced-seed hashing, in built-in functions only.

Masks of fixed shape leave some token positions out of a hash, so that a substituted token
there does not hide a passage. Hashes of all positions of the training texts meet those of
the benchmark by an equality join. A hit is verified by the windows around it, so what counts
are the few tokens about its place in the document and in the item: places alike in them are
one, and a text that repeats itself meets a benchmark that does so only a few times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspan.llm.common import BROADCAST_ROWS, sized, stored, without

# 1 reads a token, 0 ignores it. Any two substitutions in 13 tokens leave one of the masks a
# place where it sees neither (a test tries them all).
MASKS = ("11110111", "1100101111", "11011100101")
WINDOW = 13
MATCHES = 11
SHORTEST = 5
# Tokens in front of a seed that a window around it may reach.
FRONT = WINDOW - min(map(len, MASKS))
# Places of items go by broadcast up to this many; a place holds FRONT + WINDOW hashes.
BROADCAST_PLACES = BROADCAST_ROWS // 8


def token_hashes(text: Column) -> Column:
    """64-bit hashes of the letter and digit runs of the lower-cased text; null counts as empty."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seeds(tokens: str, pos: str, shapes: list[str]) -> Column:
    """Hashes of all shapes at a position; a shape that runs over the end gives null."""
    found = []
    for n, shape in enumerate(shapes):
        read = [F.get(tokens, F.col(pos) + k) for k, c in enumerate(shape) if c == "1"]
        fits = F.col(pos) + len(shape) <= F.size(tokens)
        found.append(F.when(fits, F.xxhash64(F.lit(n), *read)))
    return F.array(*found)


def _positions(rows: DataFrame, shapes: list[str]) -> DataFrame:
    """(id, pos, seed) for every position and shape."""
    shortest = min(len(s) for s in shapes)
    return (
        rows.filter(F.size("tokens") >= shortest)
        .select("id", "tokens", F.explode(F.expr("sequence(0, size(tokens) - 1)")).alias("pos"))
        .select("id", "pos", F.explode(_seeds("tokens", "pos", shapes)).alias("seed"))
        .filter("seed is not null")
    )


def _around(tokens: str, pos: str) -> Column:
    """The FRONT tokens before a place and WINDOW from it on; null beyond the ends."""
    return F.array(*[F.get(tokens, F.col(pos) + k) for k in range(-FRONT, WINDOW)])


def _places(items: DataFrame, shapes: list[str]) -> DataFrame:
    """(seed, item_id, window, sought): an item's seeds with the tokens around; equal places once.

    Items of WINDOW tokens or more have the seeds of the masks, shorter ones one of themselves whole.
    """
    size = F.size("tokens")
    long = items.filter(size >= WINDOW).select(
        "item_id", "tokens", F.lit(WINDOW).alias("window"), F.explode(F.expr("sequence(0, size(tokens) - 1)")).alias("at")
    )
    found = long.select(
        "item_id", "window", F.explode(_seeds("tokens", "at", list(MASKS))).alias("seed"), _around("tokens", "at").alias("sought")
    )
    short = items.filter(size < WINDOW).select("item_id", "tokens", size.alias("window"), F.lit(0).alias("at"))
    whole = F.coalesce(
        *[F.when(F.col("window") == len(s), F.get(_seeds("tokens", "at", shapes), F.lit(n))) for n, s in enumerate(shapes) if n >= len(MASKS)],
        F.lit(None).cast("long"),
    )
    found = found.unionByName(short.select("item_id", "window", whole.alias("seed"), _around("tokens", "at").alias("sought")))
    return found.filter("seed is not null").distinct()


def _best_window() -> Column:
    """(matches, back) of the best window around a hit, the first of equals; back is minus its place."""
    same = [F.when(F.get("near", F.lit(k)) == F.get("sought", F.lit(k)), 1).otherwise(0) for k in range(FRONT + WINDOW)]

    def window(first: int, n: Column | int) -> Column:
        held = [F.when(F.lit(k) < n, same[first + k]).otherwise(0) if isinstance(n, Column) else same[first + k] for k in range(WINDOW)]
        return F.struct(sum(held[1:], held[0]).alias("matches"), (FRONT - first - F.col("pos")).alias("back"))

    inside = [
        F.when(F.get("sought", F.lit(k)).isNotNull() & F.get("sought", F.lit(k + WINDOW - 1)).isNotNull(), window(k, WINDOW))
        for k in range(FRONT + 1)
    ]
    return F.when(F.col("window") == WINDOW, F.array_max(F.array(*inside))).otherwise(window(FRONT, F.col("window")))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(id, item_id, matches, window, pos): documents that hold a passage of an item.

    A document holds it where, along one alignment, 13 tokens in a row agree in 11 or more;
    ``pos`` is the first token of the best such window, ``matches`` its agreements. Items of
    5 to 12 tokens must occur whole; shorter or null ones match nothing. Rows without an id
    are not reported; of rows that share one, the best is. Empty tables give no rows.
    """
    items = stored(
        benchmark.select(F.col(item_col).alias("item_id"), token_hashes(F.col(item_text)).alias("tokens"))
        .filter(F.col("item_id").isNotNull() & (F.size("tokens") >= SHORTEST)),
        "items",
    )
    short = items.filter(F.size("tokens") < WINDOW).select(F.size("tokens")).distinct().collect()
    shapes = [*MASKS, *["1" * n for (n,) in sorted(short)]]

    tokens = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), token_hashes(F.col(text_col)).alias("tokens")
    )
    places = stored(_places(items, shapes), "places")
    hits = stored(
        _positions(tokens, shapes).join(sized(places.select("seed").distinct()), "seed", "left_semi"), "hits"
    )
    # The texts of the documents that were hit are read once more for the tokens around the hits.
    wanted = sized(stored(hits.select(F.col("id").alias("_id")).distinct(), "hit-ids"))
    near = (
        tokens.join(wanted, F.col("id") == F.col("_id"), "left_semi")
        .filter(F.size("tokens") >= SHORTEST)
        .select("id", "tokens", F.explode(F.expr("sequence(0, size(tokens) - 1)")).alias("pos"))
        .select("id", "pos", F.explode(_seeds("tokens", "pos", shapes)).alias("seed"), _around("tokens", "pos").alias("near"))
        .join(sized(places.select("seed").distinct()), "seed", "left_semi")
        .groupBy("id", "seed", "near")
        .agg(F.min("pos").alias("pos"))
    )
    sought = F.broadcast(places) if places.count() <= BROADCAST_PLACES else places
    best = (
        near.join(sought, "seed")
        .withColumn("best", _best_window())
        .filter(F.col("best.matches") >= F.when(F.col("window") == WINDOW, MATCHES).otherwise(F.col("window")))
    )
    return (
        best.groupBy("id", "item_id")
        .agg(F.max("best").alias("best"), F.first("window").alias("window"))
        .select(
            "id",
            "item_id",
            F.col("best.matches").cast("long").alias("matches"),
            F.col("window").cast("long").alias("window"),
            (-F.col("best.back")).cast("long").alias("pos"),
        )
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows that hold no benchmark passage, with the columns of the input."""
    ids = contaminated(docs, benchmark, id_col, text_col).select(F.col("id").alias("_id")).distinct()
    return without(docs, id_col, stored(ids, "contaminated"))
