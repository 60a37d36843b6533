"""Byte-level BPE by corpus-level merge replay.

The distinct words of many texts are laid out as one row of byte tokens. An inverted index
leads from the rank of a token pair to the places where the pair stands; the merges are
applied in rank order, each to all its places at once, and only the pairs on either side of a
merge are looked up again. Words do not depend on each other, so every task replays the words
of its own rows, keeps what it has seen up to a bound, and no text is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NONE = np.iinfo(np.int32).max
CHUNK_CHARS = 1_000_000
SEEN_WORDS = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class MergeTable:
    """What the replay looks up: pairs of token ids and the id, which is the rank, of their join."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.tokens: list[bytes] = [b""] * self.size
        keys, joins = [], []
        for token, rank in ranks.items():
            self.tokens[rank] = token
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    joins.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.joins = np.array(joins, dtype=np.int32)[order]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.joins[at], NONE)


def replay(words: list[bytes], table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words in one array, and where each word ends in it."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    token = table.bytes[np.frombuffer(b"".join(words), dtype=np.uint8)]
    n = len(token)
    ends = np.cumsum(lengths)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends[lengths > 0] - 1] = -1
    before[(ends - lengths)[lengths > 0]] = -1
    rank = np.full(n, NONE, dtype=np.int32)
    live = np.ones(n, dtype=bool)
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def look_up(at: np.ndarray) -> None:
        """Rank the pairs that start at these places, and note them in the index."""
        following = after[at]
        found = np.full(len(at), NONE, dtype=np.int32)
        paired = following >= 0
        found[paired] = table.rank_of(token[at[paired]], token[following[paired]])
        rank[at] = found
        known = found != NONE
        at, found = at[known], found[known]
        if not len(at):
            return
        order = np.argsort(found, kind="stable")
        at, found = at[order], found[order]
        starts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
        for r, places in zip(found[starts].tolist(), np.split(at, starts[1:])):
            if r in index:
                index[r].append(places)
            else:
                index[r] = [places]
                heapq.heappush(queue, r)

    look_up(np.arange(n))
    while queue:
        r = heapq.heappop(queue)
        at = np.unique(np.concatenate(index.pop(r)))
        while len(at := at[rank[at] == r]):
            # Of places that overlap, as in "aaaa", every second goes, from the leftmost on.
            linked = np.concatenate(([False], before[at[1:]] == at[:-1]))
            number = np.arange(len(at))
            first = at[(number - np.maximum.accumulate(np.where(linked, 0, number))) % 2 == 0]
            right = after[first]
            beyond = after[right]
            token[first] = r
            after[first] = beyond
            before[beyond[beyond >= 0]] = first[beyond >= 0]
            live[right] = False
            rank[right] = NONE
            left = before[first]
            look_up(np.unique(np.concatenate((first, left[left >= 0]))))
    kept = np.concatenate(([0], np.cumsum(live)))
    return token[live].astype(np.uint32), kept[ends]


class Encoder:
    """Encodes texts, keeping the ids of words it has met until there are SEEN_WORDS of them."""

    def __init__(self, table: MergeTable, pattern: str):
        self.table, self.find = table, regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.uint32)
        self.ends = np.zeros(1, dtype=np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.find(t) for t in texts]
        if len(self.seen) > SEEN_WORDS:
            self._forget()
        new = list(dict.fromkeys(w for words in split for w in words if w not in self.seen))
        if new:
            self.seen.update(zip(new, range(len(self.seen), len(self.seen) + len(new))))
            ids, ends = replay([w.encode() for w in new], self.table)
            self.ends = np.concatenate((self.ends, ends + len(self.ids)))
            self.ids = np.concatenate((self.ids, ids))
        number = self.seen.__getitem__
        found = []
        for words in split:
            at = np.fromiter(map(number, words), dtype=np.int64, count=len(words))
            starts, lengths = self.ends[at], self.ends[at + 1] - self.ends[at]
            shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
            found.append(self.ids[shift + np.arange(len(shift))])
        return found

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.table.tokens.__getitem__, ids.tolist()))


def chunks(texts: list[str]) -> Iterator[slice]:
    """Slices of consecutive texts of about CHUNK_CHARS; a longer text is one of its own."""
    start, chars = 0, 0
    for i, text in enumerate(texts):
        if chars and chars + len(text) > CHUNK_CHARS:
            yield slice(start, i)
            start, chars = i, 0
        chars += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def encode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids]) per row; decoded from the ids again.

    Null and empty texts have no ids. Repeated rows and repeated ids give a row each.
    """
    table = MergeTable(read_ranks(path))

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(table, pattern)
        for rows in batches:
            texts = [t or "" for t in rows["text"]]
            for part in chunks(texts):
                ids = encoder.encode(texts[part])
                out = {
                    "id": rows["id"].iloc[part],
                    "n_tokens": [len(x) for x in ids],
                    "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(encoder.decode(x)).hexdigest() for x in ids],
                }
                yield pd.DataFrame(out | ({"ids": [x.astype(np.int32) for x in ids]} if with_ids else {}))

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(of, schema + (", ids array<int>" if with_ids else ""))
