"""Resharding by minimum-cost flow: equal row counts at the fewest bytes moved.

The rows of an old shard fall into blocks by size: those that leave in any case, the one row
that leaves or stays, and those that stay. A flow sends all blocks to the new shards, each of
which takes the even share and one odd row more where that is cheapest; a row that stays costs
nothing, one that moves costs its bytes. Blocks are ranges of size, so the flow names, per old
shard, ranges of the rank by size; ranks come from one range sort, and each row finds its new
shard and slot from these few ranges alone. Only the files of shards that gain or lose rows are written anew.
"""

from __future__ import annotations

from collections import deque
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadspan.llm.common import scratch_path, shuffle_partitions, stored

def min_cost_flow(supply: dict, demand: dict, cost: dict, odd: int = 0) -> dict:
    """Units per (source, target) that meet the demand at least cost.

    A source is (shard, block); its units cost nothing in the target of that shard and ``cost``
    elsewhere. ``odd`` targets of the flow's choice take one unit more. Successive shortest
    paths on the bipartite graph; costs are whole numbers or fractions.
    """
    edges: list[list] = []  # target node, room, cost
    out: dict = {}

    def edge(a, b, room, price):
        for x, y, r, p in ((a, b, room, price), (b, a, 0, -price)):
            out.setdefault(x, []).append(len(edges))
            edges.append([y, r, p])

    for s, n in supply.items():
        edge("source", ("s", s), n, 0)
        for t in demand:
            edge(("s", s), ("t", t), n, 0 if s[0] == t else cost[s])
    for t, n in demand.items():
        edge(("t", t), "sink", n, 0)
        edge(("t", t), "odd", 1, 0)
    edge("odd", "sink", odd, 0)
    while True:
        far, came, queue, queued = {"source": 0}, {}, deque(["source"]), {"source"}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for e in out.get(a, ()):
                b, room, price = edges[e]
                if room and far[a] + price < far.get(b, float("inf")):
                    far[b], came[b] = far[a] + price, e
                    if b not in queued:
                        queue.append(b)
                        queued.add(b)
        if "sink" not in far:
            break
        path, b = [], "sink"
        while b != "source":
            path.append(came[b])
            b = edges[came[b] ^ 1][0]
        units = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= units
            edges[e ^ 1][1] += units
    return {
        (s, t): edges[e ^ 1][1]
        for s in supply
        for e in out[("s", s)]
        if edges[e][0] != "source" and (t := edges[e][0][1]) is not None and edges[e ^ 1][1]
    }


def solve(blocks: list[tuple[int, int, int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Ranges (old shard, first rank, end rank, new shard) from blocks (old, block, rows, bytes).

    Ranks count the rows of an old shard by size from the smallest. Exact where a block is
    moved or kept as a whole. Old shards beyond the new ones send all they hold.
    """
    held: dict[int, int] = {}
    supply, cost = {}, {}
    for old, block, rows, size in blocks:
        held[old] = held.get(old, 0) + rows
        supply[(old, block)], cost[(old, block)] = rows, Fraction(size, rows)
    even, odd = divmod(sum(held.values()), shards)
    flow = min_cost_flow(supply, dict.fromkeys(range(shards), even), cost, odd)
    ranges: list[tuple[int, int, int, int]] = []
    for old in sorted(held):
        rank = 0
        # Of one block, too, the smallest rows leave.
        for (o, b), t in sorted(flow, key=lambda f: (f[0], f[1] == f[0][0], f[1])):
            if o == old:
                n = flow[((o, b), t)]
                if ranges and ranges[-1][0] == old and ranges[-1][3] == t:
                    ranges[-1] = (old, ranges[-1][1], rank + n, t)
                else:
                    ranges.append((old, rank, rank + n, t))
                rank += n
        if rank < held[old]:
            ranges.append((old, rank, held[old], old))
    return ranges


def _slots(ranges: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Each range with the first slot of its rows in the new shard; stayers come first."""
    used: dict[int, int] = {}
    found = []
    for old, first, end, new in sorted(ranges, key=lambda r: (r[3], r[0] != r[3], r)):
        found.append((old, first, end, new, used.get(new, 0)))
        used[new] = used.get(new, 0) + end - first
    return found


def _digest(docs: DataFrame) -> Column:
    """A hash of all columns of a row; it tells nulls, and zeros of either sign, from other values."""
    told = []
    for name, kind in docs.dtypes:
        value = docs[name]
        if kind.startswith(("array", "map", "struct")):
            value = F.to_json(F.struct(value), {"ignoreNullFields": "false"})
        elif kind in ("float", "double"):
            value = value.cast("string")
        told += [value, docs[name].isNull()]
    return F.xxhash64(*told)


def plan(docs: DataFrame, old: Column, shards: int, id_col: str = "doc_id", text_col: str = "text"):
    """((key columns, old, shard, slot) per row, shards whose files change)."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("id"),
        old.cast("int").alias("old"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        _digest(docs).alias("digest"),
    )
    order = ["old", "size", "id", "digest"]
    placed = stored(
        rows.repartitionByRange(shuffle_partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        "ranks",
    ).withColumns({"part": F.shiftright("place", 33), "at": F.col("place").bitwiseAND((1 << 33) - 1)})
    # One row per old shard and partition: the windows below see at most a few thousand.
    pieces = placed.groupBy("old", "part").agg(F.min("at").alias("low"), F.count("*").alias("n"))
    before = Window.partitionBy("old").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        "old", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("offset")
    )
    ranked = placed.join(F.broadcast(offsets), ["old", "part"]).withColumn(
        "rank", F.col("at") + F.col("offset")
    )
    held = {r["old"]: r["n"] for r in pieces.groupBy("old").agg(F.sum("n").alias("n")).collect()}
    even = sum(held.values()) // shards
    # The row of this rank stays if its shard takes an odd row; smaller ones leave, larger ones stay.
    margin = F.lit(None).cast("long")
    for o, n in held.items():
        margin = F.when(F.col("old") == o, n - even - 1 if o < shards else n).otherwise(margin)
    block = F.when(F.col("rank") < margin, 0).when(F.col("rank") == margin, 1).otherwise(2)
    blocks = [
        tuple(r)
        for r in ranked.groupBy("old", block.alias("block"))
        .agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
        .collect()
    ]
    ranges = _slots(solve(blocks, shards))
    changed = sorted({j for o, _, _, n, _ in ranges if o != n for j in (o, n)})
    target, slot = F.lit(None).cast("int"), F.lit(None).cast("long")
    for o, first, end, new, base in ranges:
        here = (F.col("old") == o) & (F.col("rank") >= first) & (F.col("rank") < end)
        target = F.when(here, F.lit(new)).otherwise(target)
        slot = F.when(here, F.col("rank") - first + base).otherwise(slot)
    return ranked.select(
        "id", "size", "digest", "old", target.alias("shard"), slot.alias("slot")
    ), changed


def rewrite(
    docs: DataFrame, old: Column, shards: int, path: str | None = None, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the changed shards' rows to ``path``/shard=N and return all rows with shard and slot.

    Rows come back with their columns as the struct ``row``: from the new files where a shard
    has changed, else from the input. Null ids and repeated rows keep a row each.
    """
    spark = docs.sparkSession
    where, changed = plan(docs, old, shards, id_col, text_col)
    where = stored(where, "shard-plan")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[id_col].alias("_id"),
        _digest(docs).alias("_digest"),
    )
    key = F.col("_id").eqNullSafe(F.col("id")) & (F.col("_digest") == F.col("digest"))
    again = stored(
        where.groupBy("id", "digest").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "repeats"
    )
    if again.isEmpty():
        joined = rows.join(where, key)
    else:
        # Rows repeated in all columns: one of each key meets all the places that the plan holds for it.
        once = rows.join(again, key, "left_semi").dropDuplicates(["_id", "_digest"])
        joined = rows.join(again, key, "left_anti").unionByName(once).join(where, key)
    joined = joined.select("row", "shard", "slot")
    path = path or scratch_path(spark, "shards")
    moved = joined.filter(F.col("shard").isin(changed)) if changed else joined.filter("false")
    moved.write.partitionBy("shard").parquet(path)
    files = spark.read.schema(moved.schema).parquet(path)
    if len(changed) == shards:
        return files
    return files.unionByName(joined.filter(~F.col("shard").isin(changed)) if changed else joined)
