"""Token ids in files: an adaptive context-mixing range coder in independent blocks.

Each id is coded as one of four cases: it is the id that last followed the same two ids (order
2), else the one that last followed the same id (order 1), else the last one met with the same
low byte (order 0), else none of them. The chances of the cases mix two adaptive tables, one by
how often the order-2 guess was right and one by the last two cases, with a weight that follows
the better one, in integers, and drive a range coder; bytes that no prediction names are plain.
Every block starts with empty models and carries its checksum, so a block is read or lost by
itself. Many blocks are coded side by side, one step for all at once.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadspan.llm.common import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_IDS = 2048
BLOCKS_PER_ROW = 4096
TABLE_BITS = 10
CHANCE_BITS = 12
CASES = 4
PIECE_CHARS = 2_000_000
# Characters that one call of the tokenizer gets; it takes some hundred bytes for each.
CALL_CHARS = 200_000
# Units whose ids a worker keeps from piece to piece, and the longest of them; beyond, it starts anew.
KEPT_WORDS, KEPT_CHARS = 500_000, 100
SEPARATOR = "\x02"
# The steps before the merges that _Units knows, as the tokenizer file writes them, and the
# characters that it looks at: Latin, Greek and Cyrillic.
PLAIN_CHARS = 0x530
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

# Four cumulative chances (case 0, 0 or 1, 0 to 2, any) are 16-bit fields of one number, so that
# one operation moves all of them; a field holds at most 4,095, and none borrows from the next.
FIELD, FIELDS = np.uint64(16), 0x0001_0001_0001_0001
ONE_FIELD = np.uint64(0xFFFF)
EVEN = np.uint64(sum((1024 * j + 1023) << 16 * j for j in range(CASES)))
AT_LEAST = np.uint64(sum((j + 1) << 16 * j for j in range(CASES)))
TRIM, MIX = np.uint64(10), np.uint64(4)
TRIM_BITS, MIX_BITS = np.uint64(FIELDS * 0x003F), np.uint64(FIELDS * 0x0FFF)
# Chances by trust move by a sixteenth, those by the last cases by half of that. Shifted to the
# field of a case, a goal raises it and the fields above.
PACE = np.array([[4], [5]], dtype=np.uint64)
PACE_BITS, PACE_GOAL = (np.array([[FIELDS * x], [FIELDS * y]], dtype=np.uint64) for x, y in ((0xFFF, 0x7FF), (255, 127)))
EACH_FIELD, TOP_BITS, LOWER_TOP_BITS = (np.uint64(x) for x in (FIELDS, FIELDS << 15, (FIELDS << 15) & ((1 << 48) - 1)))
WORD, WHOLE, LEAST_RANGE, BELOW_WORD = (np.uint64(x) for x in (32, (1 << 64) - 1, 1 << 20, (1 << 32) - 1))
# How often an order-2 entry was right (at most 15), after a miss and after a hit.
NEXT_TRUST = np.array([t >> 1 for t in range(16)] + [min(t, 14) + 1 for t in range(16)], dtype=np.uint8)
# Blocks whose cases are found at once.
FORESEEN_BLOCKS = 256


def _slots(last: np.ndarray, older: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the tables of order 1 and 2, from ids as 32-bit numbers."""
    mask = np.uint32((1 << TABLE_BITS) - 1)
    one = (last * np.uint32(0x9E37) >> np.uint32(4)) & mask
    return one, ((last * np.uint32(0x9E3779B1) + older * np.uint32(0x85EBCA77)) >> np.uint32(13)) & mask


class _Chances:
    """The chances of the cases, by trust and by the last two cases, and the mixing weights of ``n`` blocks."""

    def __init__(self, n: int):
        self.at = np.arange(n) << 5
        self.by = np.full(n << 5, EVEN)
        self.weight = np.full(n, 128, dtype=np.int64)
        self.first(n)

    def first(self, k: int) -> None:
        self.at, self.weight = self.at[:k], self.weight[:k]
        self.place = np.empty((2, k), dtype=np.int64)

    def look(self, trust: np.ndarray, past: np.ndarray) -> np.ndarray:
        """The mixed chances; ``past`` is 16 and above."""
        np.add(self.at, trust, out=self.place[0])
        np.add(self.at, past, out=self.place[1])
        self.both = self.by.take(self.place)
        p, q = self.both
        # p * share + q * (16 - share)
        mixed = (p - q) * (self.weight.view(np.uint64) >> MIX)
        mixed += q << MIX
        mixed >>= MIX
        mixed &= MIX_BITS
        # No case has a chance of nil, and all together have 4,096.
        mixed -= (mixed >> TRIM) & TRIM_BITS
        mixed += AT_LEAST
        return mixed

    def learn(self, shift: np.ndarray) -> None:
        """``shift`` is where the field of the case that came true begins."""
        both = self.both
        by_p, by_q = ((both - (both << FIELD)) >> shift & ONE_FIELD).view(np.int64)
        self.weight += np.sign(by_p - by_q)
        np.minimum(self.weight, 240, out=self.weight)
        np.maximum(self.weight, 16, out=self.weight)
        both -= (both >> PACE) & PACE_BITS
        both += PACE_GOAL << shift
        self.by[self.place] = both


class _Ranges:
    """One range coder per block: a start of 64 bits and a width; 32 bits leave when it is narrow.

    Where a narrow range lies across a border of the leaving bits, it is cut there, so nothing is carried.
    """

    def __init__(self, n: int):
        self.low = np.zeros(n, dtype=np.uint64)
        self.width = np.full(n, WHOLE, dtype=np.uint64)

    def first(self, k: int) -> None:
        self.low, self.width = self.low[:k], self.width[:k]

    def unit(self) -> np.ndarray:
        return self.width >> np.uint64(CHANCE_BITS)

    def narrow(self, unit: np.ndarray, chances: np.ndarray, shift: np.ndarray) -> None:
        start = ((chances << FIELD) >> shift) & ONE_FIELD
        self.low += unit * start
        np.multiply(unit, ((chances >> shift) & ONE_FIELD) - start, out=self.width)

    def leaving(self) -> tuple[np.ndarray, np.ndarray]:
        """Blocks whose top 32 bits leave, and these; 32 bits more make any range wide enough."""
        who = np.flatnonzero(self.width < LEAST_RANGE)
        low, width = self.low[who], self.width[who]
        across = np.flatnonzero((low ^ (low + width)) > BELOW_WORD)
        if len(across):
            width[across] = (~low[across] + np.uint64(1)) & BELOW_WORD
        self.low[who], self.width[who] = low << WORD, width << WORD
        return who, low >> WORD


def _padded(blocks: list[np.ndarray], kind) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(b) for b in blocks])
    table = np.zeros((len(blocks), int(lengths.max())), dtype=kind)
    for row, b in zip(table, blocks):
        row[: len(b)] = b
    return table, lengths


def _running(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """(position, number of blocks that reach it); blocks are longest first."""
    for t in range(int(lengths[0])):
        yield t, int(np.searchsorted(-lengths, -t, side="left"))


def _last_met(ids: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """For each id of a row, the last one before it with the same slot, or 0."""
    n, longest = ids.shape
    bits = np.uint64(max(longest - 1, 1).bit_length())
    kind = np.uint32 if TABLE_BITS + bits <= 32 else np.uint64
    order = slots.astype(kind) << kind(bits)
    order |= np.arange(longest, dtype=kind)
    order.sort(axis=1)
    slots, place = order >> kind(bits), (order & kind((1 << int(bits)) - 1)).astype(np.int64)
    place += np.arange(n)[:, None] * longest
    met, out = ids.take(place), np.empty(ids.size, dtype=ids.dtype)
    before = np.zeros_like(met)
    np.multiply(met[:, :-1], slots[:, 1:] == slots[:, :-1], out=before[:, 1:])
    out[place] = before
    return out.reshape(ids.shape)


def _foreseen(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The case and the order-2 slot of every id, by step: predictions follow from the ids before."""
    cases, slots = (np.empty(ids.shape[::-1], dtype=kind) for kind in (np.uint8, np.uint16))
    for start in range(0, len(ids), FORESEEN_BLOCKS):
        part = ids[start : start + FORESEEN_BLOCKS]
        back = np.pad(part.astype(np.uint32), ((0, 0), (2, 0)))
        one, two = (x.astype(np.uint16) for x in _slots(back[:, 1:-1], back[:, :-2]))
        case = (_last_met(part, part & 255) != part) + np.uint8(2)
        case[_last_met(part, one) == part] = 1
        case[_last_met(part, two) == part] = 0
        cases[:, start : start + FORESEEN_BLOCKS], slots[:, start : start + FORESEEN_BLOCKS] = case.T, two.T
    return cases, slots


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Blocks of ids below 65,536, longest first, as bytes.

    Four 32-bit numbers (ids, crc32, words of code, plain low bytes), the code, the low bytes that
    order 2 and 1 do not name, the high bytes that order 0 does not name.
    """
    ids, lengths = _padded(blocks, np.uint16)
    n, reach = len(blocks), len(blocks)
    cases, slots = _foreseen(ids)
    chances, ranges = _Chances(n), _Ranges(n)
    low, table_at = ranges.low, np.arange(n) << TABLE_BITS
    trusts, past = np.zeros(n << TABLE_BITS, dtype=np.uint8), np.full(cases.shape, 16, dtype=np.uint8)
    past[1:] |= cases[:-1]
    past[2:] |= cases[:-2] << 2
    left_by, left = [np.zeros(0, dtype=np.uint16)], [np.zeros(0, dtype="<u4")]
    for t, k in _running(lengths):
        if k < reach:
            reach, table_at = k, table_at[:k]
            chances.first(k)
            ranges.first(k)
        case, at = cases[t, :k], table_at + slots[t, :k]
        trust, shift = trusts.take(at), case.astype(np.uint64) << MIX
        mixed = chances.look(trust, past[t, :k])
        ranges.narrow(ranges.unit(), mixed, shift)
        who, word = ranges.leaving()
        left_by.append(who.astype(np.uint16))
        left.append(word.astype("<u4"))
        chances.learn(shift)
        trusts[at] = NEXT_TRUST.take(trust + ((case == 0).view(np.uint8) << 4))
    left_by = np.concatenate(left_by)
    words = np.concatenate(left)[np.argsort(left_by, kind="stable")]
    ends = np.cumsum(np.bincount(left_by, minlength=n))
    by_block, out = np.ascontiguousarray(cases.T), []
    for i, b in enumerate(blocks):
        rest = np.array([int(low[i]) >> 32, int(low[i]) & 0xFFFF_FFFF], dtype="<u4")
        code = np.append(words[ends[i - 1] if i else 0 : ends[i]], rest)
        case = by_block[i, : len(b)]
        low_bytes = (ids[i, : len(b)][case >= 2] & 255).astype(np.uint8)
        high = (ids[i, : len(b)][case == 3] >> 8).astype(np.uint8)
        head = np.array([len(b), zlib.crc32(b.astype("<u4").tobytes()), len(code), len(low_bytes)], dtype="<u4")
        out.append(b"".join(x.tobytes() for x in (head, code, low_bytes, high)))
    return out


def decode_blocks(coded: list[bytes]) -> list[np.ndarray]:
    """The ids of blocks in the order of :func:`encode_blocks`; a wrong checksum is an error."""
    heads = np.array([np.frombuffer(c[:16], dtype="<u4") for c in coded]).astype(np.int64)
    lengths, n = heads[:, 0], len(coded)
    low_from = 16 + 4 * heads[:, 2]
    high_from = low_from + heads[:, 3]
    parts = [
        _padded([np.frombuffer(c[a:b], dtype=kind) for c, a, b in zip(coded, start, end)], kind)[0]
        for start, end, kind in (
            ([16] * n, low_from, "<u4"), (low_from, high_from, "u1"), (high_from, [None] * n, "u1"),
        )
    ]
    # One column more each, so that a block that has used its last one reads a zero.
    words, lows, highs = (np.pad(x, ((0, 0), (0, 1))) for x in parts)
    word_at, low_at, high_at = (np.arange(n) * x.shape[1] for x in (words, lows, highs))
    words, lows, highs = words.ravel(), lows.ravel(), highs.ravel()
    value = np.zeros(n, dtype=np.uint64)
    for _ in range(2):
        value = value << WORD | words.take(word_at, mode="clip")
        word_at += 1
    # Order 2 (an id and, above it, its trust), order 1 and order 0 of all blocks.
    two, one, zero = (np.zeros(n << b, dtype=k) for b, k in ((TABLE_BITS, "<u4"), (TABLE_BITS, "<u2"), (8, "<u2")))
    found, reach = np.zeros((int(lengths[0]), n), dtype=np.uint16), 0
    chances, ranges = _Chances(n), _Ranges(n)
    last, older, past = np.zeros(n, dtype=np.uint32), np.zeros(n, dtype=np.uint32), np.full(n, 16, dtype=np.uint8)
    for t, k in _running(lengths):
        if k != reach:
            reach, lane = k, np.arange(k)
            table_at, zero_at = lane << TABLE_BITS, lane << 8
            last, older, past, value = last[:k], older[:k], past[:k], value[:k]
            word_at, low_at, high_at = word_at[:k], low_at[:k], high_at[:k]
            named, entry = np.empty((CASES, k), dtype="<u2"), np.empty((k, 2), dtype="<u2")
            chances.first(k)
            ranges.first(k)
        at_one, at_two = (table_at + slot for slot in _slots(last, older))
        guess = two.take(at_two).view("<u2")
        trust = guess[1::2].astype(np.uint8)
        mixed, unit = chances.look(trust, past), ranges.unit()
        # The case is the number of lower fields that the value has reached: top bits that stay.
        ahead = (value - ranges.low) // unit
        ahead *= EACH_FIELD
        ahead |= TOP_BITS
        ahead -= mixed
        ahead &= LOWER_TOP_BITS
        case = np.bitwise_count(ahead)
        shift = case.astype(np.uint64) << MIX
        ranges.narrow(unit, mixed, shift)
        who, _ = ranges.leaving()
        at = word_at[who]
        value[who] = (value[who] << WORD) | words.take(at, mode="clip")
        word_at[who] = at + 1
        low = lows.take(low_at, mode="clip")
        named[0], named[1], named[2] = guess[::2], one.take(at_one), zero.take(zero_at + low)
        named[3] = highs.take(high_at, mode="clip")
        named[3] <<= 8
        named[3] |= low
        ids = named.ravel().take(case * np.int64(k) + lane)
        low_at += case >> 1
        high_at += case == 3
        chances.learn(shift)
        entry[:, 0], entry[:, 1] = ids, NEXT_TRUST.take(trust + ((case == 0).view(np.uint8) << 4))
        two[at_two] = entry.view("<u4").ravel()
        one[at_one] = ids
        zero[zero_at + (ids & 255)] = ids
        past = (past << 2 | case) & 15 | 16
        older, last = last, ids.astype(np.uint32)
        found[t, :k] = ids
    by_block, out = np.ascontiguousarray(found.T), []
    for i in range(n):
        block = by_block[i, : lengths[i]].astype(np.int32)
        if zlib.crc32(block.astype("<u4").tobytes()) != heads[i, 1]:
            raise ValueError(f"block {i}: wrong checksum")
        out.append(block)
    return out


def _ragged(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``starts``, one behind the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


class _Units:
    """Cuts words where a tokenizer of NORMALIZER and PRE_TOKENIZER does, and gives them small letters.

    Only words whose characters are all simple are cut: letters below PLAIN_CHARS that no rule of
    composition touches and that have one small letter, decimal digits, other printed ASCII but
    for the apostrophe (contractions) and the bar (special tokens). Other words stay as they are.
    It works on UTF-8, where these characters have one or two bytes.
    """

    OTHER, LETTER, DIGIT, SIGN = range(4)

    def __init__(self):
        self.kind, self.small = np.zeros(PLAIN_CHARS, dtype=np.uint8), np.arange(PLAIN_CHARS, dtype=np.int64)
        for code, char in enumerate(map(chr, range(PLAIN_CHARS))):
            small = char.lower()
            if len(small) == 1 and all(unicodedata.normalize("NFC", x) == x for x in (char, small)):
                kind = unicodedata.category(char)
                if kind in ("Lu", "Ll") and unicodedata.category(small) == "Ll" and ord(small) < PLAIN_CHARS:
                    if (code < 0x80) == (ord(small) < 0x80):
                        self.kind[code], self.small[code] = self.LETTER, ord(small)
                elif "0" <= char <= "9":
                    self.kind[code] = self.DIGIT
                elif "!" <= char <= "~" and char not in "'|":
                    self.kind[code] = self.SIGN
        self.byte_kind, self.byte_small = np.zeros(256, dtype=np.uint8), np.arange(256, dtype=np.uint8)
        self.byte_kind[:128], self.byte_small[:128] = self.kind[:128], self.small[:128]

    def __call__(self, words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The units of all words in a row, which of them are simple, how many each word has."""
        bounds = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset :][: len(words) + 1]
        text = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[bounds[0] : bounds[-1]]
        starts, ends = bounds[:-1] - bounds[0], bounds[1:] - bounds[0]
        kind, small = self.byte_kind.take(text), self.byte_small.take(text)
        two = np.flatnonzero((text >= 0xC0) & (text < 0xE0))
        code = (text[two].astype(np.int64) & 0x1F) << 6 | text[two + 1] & 0x3F
        two, code = two[code < PLAIN_CHARS], code[code < PLAIN_CHARS]
        kind[two] = kind[two + 1] = self.kind[code]
        small[two], small[two + 1] = self.small[code] >> 6 | 0xC0, self.small[code] & 0x3F | 0x80
        odd = np.concatenate([[0], np.cumsum(kind == self.OTHER, dtype=np.int64)])
        simple = odd[ends] == odd[starts]
        inside = np.repeat(simple, ends - starts)
        first = kind == self.DIGIT
        first[1:] |= kind[1:] != kind[:-1]
        first &= inside
        first[starts[ends > starts]] = True
        each = np.concatenate([[0], np.cumsum(first, dtype=np.int64)])
        each = each[ends] - each[starts]
        offsets = np.append(np.flatnonzero(first), len(text))
        text = np.where(inside, small, text)
        units = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(text))
        return units, np.repeat(simple, each), each


class Tokens:
    """Ids of texts by a tokenizer file; words between white space do not touch each other.

    The words of a batch are numbered by their distinct values. With NORMALIZER and PRE_TOKENIZER
    simple words are cut further into units (see :class:`_Units`), which are all of a word
    otherwise; units not met before are tokenised, simple ones without the steps done to them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self._batch(self.tokenizer, [SEPARATOR])[0]
        self.units, self.plain = None, None
        with open(path, encoding="utf-8") as file:
            steps = json.load(file)
        if (steps["normalizer"], steps["pre_tokenizer"]) == (NORMALIZER, PRE_TOKENIZER):
            self.units, self.plain = _Units(), Tokenizer(self.tokenizer.model)
            vocabulary, suffix = self.tokenizer.get_vocab(), steps["model"].get("end_of_word_suffix")
            self.is_last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.is_last[[k for token, k in vocabulary.items() if suffix and token.endswith(suffix)]] = True
            self.plain.pre_tokenizer = pre_tokenizers.Sequence(
                [
                    pre_tokenizers.Split(" ", "removed"),
                    pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
                ]
            )
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.sizes = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)

    def _batch(self, tokenizer, texts: list[str]) -> list[np.ndarray]:
        coded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=np.int32) for x in coded]

    def _encode(self, tokenizer, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of words in a row, and how many each has, by call of about CALL_CHARS characters."""
        found, sizes, start, held = [], [], 0, 0
        for at, word in enumerate([*words, None]):
            if at > start and (word is None or held + len(word) > CALL_CHARS):
                ids, lengths = self._encode_together(tokenizer, words[start:at])
                found.append(ids)
                sizes.append(lengths)
                start, held = at, 0
            held += 0 if word is None else len(word) + 3
        return found, sizes

    def _encode_together(self, tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As one text. A simple unit ends with the id of a last part; other words are parted by a
        word of one control character, which none of them holds."""
        if tokenizer is self.plain:
            [coded] = self._batch(tokenizer, [" ".join(words)])
            ends = np.flatnonzero(self.is_last[coded])
            if len(ends) == len(words) and ends[-1] == len(coded) - 1:
                return coded, np.diff(ends, prepend=-1)
        text = f" {SEPARATOR} ".join(words)
        if len(self.separator) == 1 and text.count(SEPARATOR) == len(words) - 1:
            [coded] = self._batch(tokenizer, [text])
            parting = coded == self.separator[0]
            ends = np.flatnonzero(parting)
            if len(ends) == len(words) - 1:
                return coded[~parting], np.diff(ends, prepend=-1, append=len(coded)) - 1
        each = self._batch(tokenizer, words)
        return np.concatenate(each), np.array([len(x) for x in each])

    def _looked_up(self, units: list[str], simple: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of units, where each unit's begin, and how many it has."""
        if len(self.known) > KEPT_WORDS:
            self._forget()
        kept, place = len(self.known), np.array(list(map(self.known.get, units, repeat(-1))), dtype=np.int64)
        new = np.flatnonzero(place < 0)
        flat, sizes = self.flat, self.sizes
        if len(new):
            # Long words are not kept; they come last, so that the kept ones are numbered in a row.
            long = np.array([len(units[at]) > KEPT_CHARS for at in new])
            parts = [(self.plain if s else self.tokenizer, new[(simple[new] == s) & ~long]) for s in (True, False)]
            parts.append((self.tokenizer, new[long]))
            found, lengths = [flat], [sizes]
            for tokenizer, at in parts:
                ids, each = self._encode(tokenizer, [units[k] for k in at]) if len(at) else ([], [])
                found += ids
                lengths += each
            flat, sizes = np.concatenate(found), np.concatenate(lengths)
            order = np.concatenate([at for _, at in parts])
            place[order] = np.arange(kept, kept + len(new))
            end = kept + len(new) - int(long.sum())
            self.known.update(zip((units[k] for k in order), range(kept, end)))
            self.sizes = sizes[:end].copy()
            self.flat = flat[: int(self.sizes.sum())].copy()
        return flat, (np.cumsum(sizes) - sizes)[place], sizes[place]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words in a row, and how many each has."""
        if self.units is None:
            flat, starts, sizes = self._looked_up(words.to_numpy(zero_copy_only=False).tolist(), np.zeros(len(words), dtype=bool))
            return _ragged(flat, starts, sizes), sizes
        units, simple, each = self.units(words)
        coded = units.dictionary_encode()
        number = coded.indices.to_numpy(zero_copy_only=False)
        of_number = np.zeros(len(coded.dictionary), dtype=bool)
        of_number[number] = simple
        flat, starts, sizes = self._looked_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), of_number)
        starts, sizes = starts[number], sizes[number]
        until, last = np.concatenate([[0], np.cumsum(sizes)]), np.cumsum(each)
        return _ragged(flat, starts, sizes), until[last] - until[last - each]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        spaced = [text.replace("\n", " ") for text in texts]
        lists = pc.split_pattern(pa.array(spaced, pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        number = coded.indices.to_numpy(zero_copy_only=False)
        flat, sizes = self._words(coded.dictionary)
        starts, length = (np.cumsum(sizes) - sizes)[number], sizes[number]
        ids = _ragged(flat, starts, length)
        last_word = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        return np.split(ids, np.cumsum(length)[last_word - 1][:-1])


def _held_tokens(path: str) -> Tokens:
    """The tokenizer of a Python worker, with the units it has met in earlier tasks."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_roadspan_tokens", {})
    if path not in held:
        held[path] = Tokens(path)
    return held[path]


def _pieces(texts: list[str]) -> Iterator[slice]:
    """Runs of texts with up to PIECE_CHARS characters, or one longer text."""
    start = held = 0
    for at, text in enumerate(texts):
        if at > start and held + len(text) > PIECE_CHARS:
            yield slice(start, at)
            start, held = at, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def write_ids(
    docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None, id_col: str = "doc_id",
    text_col: str = "text",
) -> str:
    """Write the ids of all rows, each with ``end_id`` behind, in ascending id order; returns the path.

    The rows of the files hold up to BLOCKS_PER_ROW blocks of BLOCK_IDS ids each, and the ids
    and lengths of their documents; ``part`` and ``seq`` number them in order. A null id comes
    first, a null text is empty; repeated rows follow each other.
    """
    path = path or scratch_path(docs.sparkSession, "token-ids")
    row_ids = BLOCK_IDS * BLOCKS_PER_ROW

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = _held_tokens(tokenizer)
        names, sizes, held, total, seq = [], [], [], 0, 0

        def row() -> pd.DataFrame:
            every = np.concatenate(held)
            blocks = [every[k : k + BLOCK_IDS] for k in range(0, len(every), BLOCK_IDS)]
            return pd.DataFrame(
                {"seq": [seq], "ids": [names], "sizes": [sizes], "total": [total], "blocks": [encode_blocks(blocks)]}
            )

        for rows in batches:
            texts = [text or "" for text in rows["text"]]
            coded = (x for piece in _pieces(texts) for x in tokens(texts[piece]))
            for name, x in zip(rows["id"], coded):
                x = np.append(x, np.int32(end_id))
                if total and total + len(x) > row_ids:
                    yield row()
                    names, sizes, held, total, seq = [], [], [], 0, seq + 1
                names.append(None if pd.isna(name) else int(name))
                sizes.append(len(x))
                held.append(x)
                total += len(x)
        if names:
            yield row()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    (
        rows.repartitionByRange("id")
        .sortWithinPartitions("id", "text")
        .mapInPandas(of, "seq int, ids array<long>, sizes array<long>, total long, blocks array<binary>")
        .withColumn("part", F.spark_partition_id())
        .write.parquet(path)
    )
    return path


def read_ids(spark, path: str, with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) per document, decoded from the files.

    ``start`` counts the ids of all documents before it.
    """
    schema = "seq int, ids array<long>, sizes array<long>, total long, blocks array<binary>, part int"
    files = spark.read.schema(schema).parquet(path)
    # Totals per partition, then per row in it: both windows run over a few thousand numbers.
    parts = files.groupBy("part").agg(F.sum("total").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        files.select("part", "seq", F.coalesce(F.sum("total").over(inside), F.lit(0)).alias("row_start"))
        .join(F.broadcast(parts), "part")
        .select("part", "seq", (F.col("part_start") + F.col("row_start")).alias("first"))
    )

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for part, seq, ids, sizes, blocks in zip(
                rows["part"], rows["seq"], rows["ids"], rows["sizes"], rows["blocks"]
            ):
                every = np.concatenate(decode_blocks(list(blocks)))
                ends = np.cumsum(np.array(sizes, dtype=np.int64))
                each = np.split(every, ends[:-1])
                out = {
                    "part": part,
                    "seq": seq,
                    "id": pd.array([None if pd.isna(i) else int(i) for i in ids], dtype="Int64"),
                    "offset": ends - np.array(sizes, dtype=np.int64),
                    "n_tokens": sizes,
                    "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in each],
                }
                yield pd.DataFrame(out | ({"token_ids": each} if with_ids else {}))

    schema = "part int, seq int, id long, offset long, n_tokens long, ids_crc32 long"
    found = files.drop("total").mapInPandas(of, schema + (", token_ids array<int>" if with_ids else ""))
    return found.join(F.broadcast(starts), ["part", "seq"]).select(
        "id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32",
        *(["token_ids"] if with_ids else []),
    )
