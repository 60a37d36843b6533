"""Periodic runs of words, by scale-tiled distribution.

Periods fall into octaves [g, 2g) for g = 1, 2, 4, ... A text is cut into overlapping tiles per
octave, the longer the longer the periods, and each tile is solved by itself: every g words
there is a boundary, and a run of four periods or more spans two of them, so the g words
behind some boundary stand there again one period later. Such meetings, found for all
boundaries and periods of an octave by comparing hashes, are chained; at both ends of a chain
Z-functions around the boundary tell exactly how far the equality reaches. What a tile has
found is a fragment: a period, and the stretch of words that equal the word one period later.

Fragments of a document and period meet by shuffle, where those that touch are stitched; tiles
of an octave overlap so far that no end of a run hides in one. A stretch that a smaller period
also explains is left to that one. Texts without a fragment are finished where they are read,
the others wait for their runs.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import compress

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadspan.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

POWER = 4  # periods that a run must hold
SHORTEST = 6  # words of the shortest run
# A tile is at least this long; an octave of longer periods has tiles of 8 g words.
TILE_WORDS = 16_384
# Tiles solved side by side hold about so many words.
STREAM_WORDS = 200_000
# Texts are split into words by so many characters at a time.
CHUNK_CHARS = 1_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Tile:
    """Words ``start`` to ``end`` of a text of ``n`` words, for octaves ``low`` to ``high``."""

    text: int
    start: int
    end: int
    n: int
    low: int
    high: int


@dataclass
class Words:
    """A text's words as numbers, and the fragments found: (period, head, past)."""

    ids: np.ndarray
    found: list[tuple[int, int, int]] = field(default_factory=list)


def octaves(n: int) -> int:
    """Octaves whose periods fit ``n`` words four times."""
    return (n // POWER).bit_length()


def tiles(text: int, n: int, least: int) -> Iterator[Tile]:
    """The tiles of a text: one for all octaves if it is short, else overlapping ones per octave."""
    top = octaves(n) - 1
    low = 0
    while low <= top:
        length = max(least, 8 << low)
        # All octaves that this length serves share its tiles.
        high = top if length >= n else min(top, max(low, (length // 8).bit_length() - 1))
        step = max(length - (4 << high), 1)
        for start in range(0, max(n - (length - step), 1), step):
            yield Tile(text, start, min(start + length, n), n, low, high)
        low = high + 1


def z_function(s: list) -> list[int]:
    """Per place the length of the longest common beginning of ``s`` and its rest from there."""
    n = len(s)
    z = [0] * n
    z[0] = n
    left = right = 0
    for i in range(1, n):
        m = min(right - i, z[i - left]) if i < right else 0
        while i + m < n and s[m] == s[i + m]:
            m += 1
        z[i] = m
        if i + m > right:
            left, right = i, i + m
    return z


def _solve(group: list[Tile], texts: list[Words], low: int, high: int) -> None:
    """Find the fragments of tiles that serve the same octaves, laid end to end."""
    sizes = np.array([t.end - t.start for t in group], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    total = int(sizes.sum()) + len(group)
    longest = 1 << high
    # A word of its own stands behind each tile and, repeatedly, behind the last.
    stream = -1 - np.arange(total + 4 * longest, dtype=np.int64)
    for t, at, size in zip(group, starts, sizes):
        stream[at : at + size] = texts[t.text].ids[t.start : t.end]
    # hashes[i] stands for the g words from i on.
    hashes = stream.astype(np.uint64) * MIX
    hashes ^= hashes >> np.uint64(29)
    for octave in range(high + 1):
        g = 1 << octave
        if octave >= low:
            _octave(stream, hashes, g, total, group, starts, sizes, texts)
        hashes = hashes[:-g] * MIX + hashes[g:]
        hashes ^= hashes >> np.uint64(31)


def _octave(stream, hashes, g, total, group, starts, sizes, texts) -> None:
    # The g words from boundary b on, against those from each of the places b + g to b + 2g - 1.
    blocks = min((total + g - 1) // g + 1, len(hashes) // g)
    table = hashes[: blocks * g].reshape(blocks, g)
    at, shift = np.nonzero(table[1:] == table[:-1, :1])
    if not len(at):
        return
    order = np.lexsort((at, shift))
    at, shift = at[order], shift[order]
    same = (shift[1:] == shift[:-1]) & (at[1:] == at[:-1] + 1)
    heads, tails = np.flatnonzero(np.concatenate(([True], ~same))), np.flatnonzero(np.concatenate((~same, [True])))
    first, last, periods = at[heads] * g, (at[tails] + 1) * g, g + shift[heads]
    # Less than g words can be gained at either end; a chain that stays too short counts only
    # where the text goes on in another tile.
    cut = np.array([t.end - t.start < t.n for t in group])
    within = np.searchsorted(starts, first, side="right") - 1
    useful = cut[within] | (last - first + 2 * g + periods > np.maximum(SHORTEST, POWER * periods))
    first, last, periods = first[useful], last[useful], periods[useful]
    if not len(first):
        return
    back = _reach(stream, first, periods, g, True)
    ahead = _reach(stream, last, periods, g, False)
    for a, c, q in zip((first - back).tolist(), (last + ahead).tolist(), periods.tolist()):
        where = int(np.searchsorted(starts, a, side="right")) - 1
        tile, start, size = group[where], int(starts[where]), int(sizes[where])
        a, c = a - start, c - start
        open_ends = (a == 0 and tile.start > 0) or (c == size - q and tile.end < tile.n)
        if c > a and (open_ends or c - a + q >= max(SHORTEST, POWER * q)):
            texts[tile.text].found.append((q, tile.start + a, tile.start + c))


def _reach(stream: np.ndarray, places: np.ndarray, periods: np.ndarray, g: int, back: bool) -> np.ndarray:
    """How far, up to g words, the words before (behind) each boundary equal those one period later."""
    out = np.zeros(len(places), dtype=np.int64)
    order = np.argsort(places, kind="stable")
    cuts = np.flatnonzero(np.diff(places[order])) + 1
    for rows in np.split(order, cuts):
        b = int(places[rows[0]])
        if back:
            # Backwards from b + 2g - 1; the words before b are looked for in it.
            begin = max(b - g, 0)
            sought = stream[begin:b][::-1].tolist()
            z = z_function([*sought, None, *stream[begin : b + 2 * g][::-1].tolist()])
            out[rows] = [min(z[len(sought) + 1 + 2 * g - q], len(sought)) for q in periods[rows].tolist()]
        else:
            z = z_function(stream[b : b + 3 * g].tolist())
            out[rows] = [min(z[q], g) if q < len(z) else 0 for q in periods[rows].tolist()]
    return out


def fragments(word_lists: list[list], least: int = TILE_WORDS) -> list[list[tuple[int, int, int]]]:
    """Per text its fragments (period, head, past): words ``head`` to ``past`` (exclusive) equal the ones a period later.

    A text that is one tile has its final ones, but also those that a smaller period explains.
    """
    numbers: dict = {}
    texts = []
    for words in word_lists:
        ids = [numbers.setdefault(w, len(numbers)) for w in words]
        texts.append(Words(np.array(ids, dtype=np.int64)))
    every = [t for k, x in enumerate(texts) for t in tiles(k, len(x.ids), least)]
    every.sort(key=lambda t: (t.low, t.high))
    group: list[Tile] = []
    held = 0
    for t in every:
        if group and (held > STREAM_WORDS or (t.low, t.high) != (group[0].low, group[0].high)):
            _solve(group, texts, group[0].low, group[0].high)
            group, held = [], 0
        group.append(t)
        held += t.end - t.start
    if group:
        _solve(group, texts, group[0].low, group[0].high)
    return [x.found for x in texts]


def _chunks(texts: pd.Series) -> Iterator[slice]:
    """Runs of texts with about CHUNK_CHARS characters; a longer text is one of its own."""
    start = held = 0
    for k, text in enumerate(texts):
        if held and held + len(text or "") > CHUNK_CHARS:
            yield slice(start, k)
            start, held = k, 0
        held += len(text or "")
    if start < len(texts):
        yield slice(start, len(texts))


def split_words(text: str | None) -> list[bytes]:
    """The words between spaces and tabs, line feeds and the like (20, 09 to 0D); null has none."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _read(docs: DataFrame, least: int) -> DataFrame:
    """(id, mark, n, collapsed_sha256, text, fragments) per row; the text only where fragments are."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for part in _chunks(rows["text"]):
                texts = rows["text"].iloc[part]
                words = [split_words(t) for t in texts]
                found = fragments(words, least)
                yield pd.DataFrame(
                    {
                        "id": rows["id"].iloc[part],
                        "mark": [hashlib.md5(t.encode("utf-8", "surrogatepass")).hexdigest() if f else None for t, f in zip(texts, found)],
                        "n": [len(w) for w in words],
                        "collapsed_sha256": [None if f else _sha(b" ".join(w)) for w, f in zip(words, found)],
                        "text": [t if f else None for t, f in zip(texts, found)],
                        "fragments": [[{"period": q, "head": a, "past": c} for q, a, c in f] for f in found],
                    }
                )

    rows = docs.select(F.col("_id").cast("long").cast("string").alias("id"), F.col("_text").alias("text"))
    return rows.mapInPandas(
        of,
        "id string, mark string, n long, collapsed_sha256 string, text string,"
        " fragments array<struct<period: long, head: long, past: long>>",
    )


def stitched(found: DataFrame) -> DataFrame:
    """(mark, start, length, period): fragments (mark, period, head, past) that touch made one, then the
    stretches that are long enough; of those that cover the same words the smallest period."""
    order = Window.partitionBy("mark", "period").orderBy("head", "past")
    before = F.max("past").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("head") <= F.col("_reached"), 0).otherwise(1)).over(order)
    joined = (
        found.distinct()
        .withColumn("_reached", before)
        .withColumn("_island", island)
        .groupBy("mark", "period", "_island")
        .agg(F.min("head").alias("start"), (F.max("past") + F.col("period")).alias("end"))
    )
    long_enough = (F.col("end") - F.col("start")) >= F.greatest(F.lit(SHORTEST), POWER * F.col("period"))
    return (
        joined.filter(long_enough)
        .groupBy("mark", "start", "end")
        .agg(F.min("period").alias("period"))
        .select("mark", "start", (F.col("end") - F.col("start")).alias("length"), "period")
    )


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The (start, length, period) of the greatest length / period; ties: smallest start, then period."""
    best = runs[0]
    for r in runs[1:]:
        more, less = r[1] * best[2], best[1] * r[2]
        if more > less or (more == less and (r[0], r[2]) < (best[0], best[2])):
            best = r
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, without those behind the first period of a run."""
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join(compress(words, kept.tolist()))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = TILE_WORDS) -> DataFrame:
    """(id, n_words, runs, collapsed_sha256) per row.

    ``runs`` are (start, length, period) of the longest stretches of words with a smallest
    period that they hold four times or more and that are of six words or more, by start, then
    period; words are what stands between spaces, tabs and the like, numbered from 0.
    ``collapsed_sha256`` is that of the words that no run repeats, joined by one space.

    Null and empty texts have no words and no runs. Repeated rows and null ids give a row
    each. A long text is cut into tiles of ``least`` words or more; results do not depend on it.
    """
    read = stored(_read(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), least), "run-fragments")
    none = F.array().cast("array<struct<start: long, length: long, period: long>>")
    plain = read.filter("mark is null").select("id", F.col("n").alias("n_words"), none.alias("runs"), "collapsed_sha256")
    waiting = read.filter("mark is not null")
    # Equal texts have equal runs, so they are told apart by their mark alone.
    found = waiting.select("mark", F.explode("fragments").alias("f")).select("mark", "f.period", "f.head", "f.past")
    runs = stitched(found).groupBy("mark").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            each = [[(r["start"], r["length"], r["period"]) for r in runs] if runs is not None else [] for runs in rows["runs"]]
            yield pd.DataFrame(
                {
                    "id": rows["id"],
                    "n_words": rows["n"],
                    "runs": [[{"start": s, "length": m, "period": q} for s, m, q in r] for r in each],
                    "collapsed_sha256": [_sha(collapsed(split_words(t), r)) for t, r in zip(rows["text"], each)],
                }
            )

    schema = "id string, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed_sha256 string"
    ended = waiting.select("id", "n", "text", "mark").join(runs, "mark", "left").select("id", "n", "text", "runs").mapInPandas(of, schema)
    return plain.unionByName(ended).withColumn("id", F.col("id").cast("long"))


def digests(runs: DataFrame) -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of ``find_runs``;
    the four describe the strongest run and are null where there is none."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            each = [[(r["start"], r["length"], r["period"]) for r in found] for found in rows["runs"]]
            best = [strongest(r) if r else (None, None, None) for r in each]
            out = {
                "id": rows["id"],
                "n_runs": [len(r) for r in each],
                "start": [b[0] for b in best],
                "length": [b[1] for b in best],
                "period": [b[2] for b in best],
                "exponent_milli": [b[1] * 1000 // b[2] if b[2] else None for b in best],
                "runs_sha256": [_sha("".join(f"{s},{m},{q}\n" for s, m, q in r).encode()) for r in each],
                "collapsed_sha256": rows["collapsed_sha256"],
            }
            numbers = ("start", "length", "period", "exponent_milli")
            yield pd.DataFrame(out).astype({c: "Int64" for c in numbers})

    found = runs.select(F.col("id").cast("string"), "runs", "collapsed_sha256").mapInPandas(
        of,
        "id string, n_runs long, start long, length long, period long, exponent_milli long,"
        " runs_sha256 string, collapsed_sha256 string",
    )
    return found.withColumn("id", F.col("id").cast("long"))
