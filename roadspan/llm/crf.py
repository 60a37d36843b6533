"""Language identification by a linear-chain conditional random field over words.

A word's features are its character n-grams with marks at both ends (so the first and last
characters are affixes) and the word itself (the lexicon), all hashed. The chain's transitions
are learned on sequences that switch between languages. Forward-backward labels every word;
a text gets the language with the largest mean probability.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspan.llm.common import crc_remainder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 16
ORDERS = (2, 3, 4)
# Documented bounds of the fit: languages (the most frequent ones), documents drawn per language,
# pieces of PIECE words drawn from the whole of each document, characters of a piece.
LANGUAGES = 256
DOCS_PER_LANG = 400
PIECES_PER_DOC = 8
PIECE = 8
PIECE_CHARS = 1_024
LENGTH = 32
EPOCHS = 6
RATE = 0.3
CHUNK_CHARS = 6_000_000
SEEN_WORDS = 400_000
UNKNOWN = "und"

_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return _WORDS.findall((text or "").lower())


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words in one array, and where each word's begin."""
    code = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), lengths)
    found, owners = [], []
    for order in ORDERS:
        n = len(code) - order + 1
        if n <= 0:
            continue
        h = np.full(n, order, dtype=np.uint32)
        for k in range(order):
            h = (h ^ code[k : k + n]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        inside = owner[:n] == owner[order - 1 :]
        found.append(h[inside] >> np.uint32(32 - BITS))
        owners.append(owner[:n][inside])
    # The lexicon: a polynomial hash of the whole word.
    place = np.arange(len(code)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    power = np.cumprod(np.full(int(lengths.max()), 0x01000193, dtype=np.uint32), dtype=np.uint32)
    whole = np.add.reduceat(code * power[place], np.cumsum(lengths) - lengths).astype(np.uint32)
    whole = (whole ^ (whole >> np.uint32(15))) * np.uint32(0x9E3779B1)
    found.append(whole >> np.uint32(32 - BITS))
    owners.append(np.arange(len(words)))
    all_of, owners = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return all_of[order], np.searchsorted(owners[order], np.arange(len(words)))


def forward_backward(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray):
    """(word probabilities, pair expectations) of sequences laid end to end.

    Sequences run side by side, longest first, so a step touches those that last so long.
    """
    order = np.argsort(-lengths, kind="stable")
    first = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    emit = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
    move, enter = np.exp(trans), np.exp(start)
    alpha, beta = np.empty_like(emit), np.ones_like(emit)
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")
    state = emit[first] * enter if len(first) else emit
    for t in range(longest):
        n = active[t]
        at = first[:n] + t
        if t:
            state = (state[:n] @ move) * emit[at]
        state = state / state.sum(axis=1, keepdims=True)
        alpha[at] = state
    pairs = np.zeros_like(move)
    back = np.zeros((0, emit.shape[1]))
    for t in range(longest - 2, -1, -1):
        n = active[t + 1]
        at = first[:n] + t
        after = np.ones((n, emit.shape[1]))
        after[: len(back)] = back
        right = emit[at + 1] * after
        back = right @ move.T
        norm = (alpha[at] * back).sum(axis=1, keepdims=True)
        pairs += move * (alpha[at].T @ (right / norm))
        back = back / back.sum(axis=1, keepdims=True)
        beta[at] = back
    gamma = alpha * beta
    return gamma / gamma.sum(axis=1, keepdims=True), pairs


class Model:
    def __init__(self, langs: list[str], weights: np.ndarray, trans: np.ndarray, start: np.ndarray):
        self.langs, self.weights, self.trans, self.start = langs, weights, trans, start

    def scores(self, words: list[str]) -> np.ndarray:
        found, starts = features(words)
        return np.add.reduceat(self.weights[found], starts, axis=0)


def pieces_of(text: str | None, key: object) -> list[tuple[int, str]]:
    """(number, words) of up to PIECES_PER_DOC pieces, drawn by ``key`` from the whole text."""
    words = words_of(text)
    n = -(-len(words) // PIECE)
    taken = np.arange(n)
    if n > PIECES_PER_DOC:
        taken = np.sort(np.random.default_rng(zlib.crc32(str(key).encode())).choice(n, PIECES_PER_DOC, replace=False))
    cut = [(int(k), " ".join(words[k * PIECE : (k + 1) * PIECE])) for k in taken]
    return [(k, piece) for k, piece in cut if len(piece) <= PIECE_CHARS]


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model:
    """Fit on pieces of one language each, shuffled and joined so that languages switch."""
    langs = sorted(set(labels))
    rng = np.random.default_rng(seed)
    numbers = {lang: y for y, lang in enumerate(langs)}
    pieces = [(text.split(" "), numbers[label]) for text, label in zip(texts, labels)]
    k = len(langs)
    weights = np.zeros((1 << BITS, k))
    trans, start = np.zeros((k, k)), np.zeros(k)
    squares, trans_squares, start_squares = np.full_like(weights, 1e-6), np.full_like(trans, 1e-6), np.full(k, 1e-6)
    per_sequence = LENGTH // PIECE
    for _ in range(EPOCHS):
        order = rng.permutation(len(pieces))
        for b in range(0, len(order), 64 * per_sequence):
            batch = [pieces[i] for i in order[b : b + 64 * per_sequence]]
            groups = [batch[i : i + per_sequence] for i in range(0, len(batch), per_sequence)]
            words = [w for ws, _ in batch for w in ws]
            if not words:
                continue
            gold = np.concatenate([np.full(len(ws), y) for ws, y in batch]).astype(int)
            lengths = np.array([sum(len(ws) for ws, _ in g) for g in groups])
            found, starts = features(words)
            gamma, pairs = forward_backward(np.add.reduceat(weights[found], starts, axis=0), lengths, trans, start)
            gap = np.eye(k)[gold] - gamma
            step = np.repeat(gap, np.diff(np.append(starts, len(found))), axis=0)
            touched, at = np.unique(found, return_inverse=True)
            grad = np.stack([np.bincount(at, step[:, c], len(touched)) for c in range(k)], axis=1) / len(groups)
            squares[touched] += grad**2
            weights[touched] += RATE * grad / np.sqrt(squares[touched])
            ends = np.cumsum(lengths)
            linked = np.ones(len(gold), dtype=bool)
            linked[ends - 1] = False
            here = np.flatnonzero(linked)
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[here], gold[here + 1]), 1)
            grad = (seen - pairs) / len(groups)
            trans_squares += grad**2
            trans += RATE * grad / np.sqrt(trans_squares)
            heads = (ends - lengths)[lengths > 0]
            grad = gap[heads].sum(axis=0) / len(groups)
            start_squares += grad**2
            start += RATE * grad / np.sqrt(start_squares)
    return Model(langs, weights.astype(np.float32), trans, start)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Learn from rows with a language whose remainder is not 2; None where no word is found.

    About DOCS_PER_LANG texts of each of the LANGUAGES most frequent languages (ties: by name)
    are drawn by a hash of the id. Tasks draw at most PIECES_PER_DOC pieces of PIECE words from
    the whole of each; only these pieces, of at most PIECE_CHARS characters, reach the driver,
    where they are fitted. Rows without an id, a language or a text are not learned from.
    Repeated rows are drawn together.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_remainder("id", 4) != 2)
    )
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    share = F.least(F.lit(1.0), DOCS_PER_LANG / F.col("count")) * (1 << 20)
    shares = counts.select("lang", share.cast("long").alias("share"))
    # At most LANGUAGES rows are broadcast.
    drawn = known.join(F.broadcast(shares), "lang").filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.col("share"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [
                (i, k, lang, piece)
                for i, text, lang in zip(rows["id"], rows["text"], rows["lang"])
                for k, piece in pieces_of(text, i)
            ]
            yield pd.DataFrame(found, columns=["id", "k", "lang", "piece"])

    kind = drawn.schema["id"].dataType.simpleString()
    pieces = drawn.select("id", "text", "lang").mapInPandas(cut, f"id {kind}, k int, lang string, piece string")
    taken = pieces.toPandas().sort_values(["id", "k", "piece"])
    return train(taken["piece"].tolist(), taken["lang"].tolist()) if len(taken) else None


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, switches) per row; ``und``, 0 and 0 without a letter or a model.

    Rows without an id and repeated rows are labelled like any other, one result each.

    ``score`` is the mean probability of the language over the words, ``switches`` the number
    of places where the likeliest label changes from one word to the next.
    """

    def labelled(texts: list[str], seen: dict[str, int], table: list[np.ndarray]):
        split = [words_of(t) for t in texts]
        new = list(dict.fromkeys(w for ws in split for w in ws if w not in seen))
        if new:
            seen.update(zip(new, range(len(seen), len(seen) + len(new))))
            table.append(model.scores(new))
            table[:] = [np.concatenate(table)]
        lengths = np.array([len(ws) for ws in split])
        full = np.flatnonzero(lengths)
        pred, score, switches = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=int)
        if len(full):
            at = np.fromiter((seen[w] for ws in split for w in ws), dtype=np.int64)
            gamma, _ = forward_backward(table[0][at], lengths[full], model.trans, model.start)
            starts = np.cumsum(lengths[full]) - lengths[full]
            means = np.add.reduceat(gamma, starts, axis=0) / lengths[full][:, None]
            best = means.argmax(axis=1)
            word = gamma.argmax(axis=1)
            change = np.concatenate(([0], (word[1:] != word[:-1]).astype(int)))
            change[starts] = 0
            for i, b, m, c in zip(full, best, means, np.add.reduceat(change, starts)):
                pred[i], score[i], switches[i] = model.langs[b], min(1.0, m[b]), c
        return pred, score, switches

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, table = {}, []
        for rows in batches:
            texts = [t or "" for t in rows["text"]]
            begin = 0
            while begin < len(texts):
                end, chars = begin, 0
                while end < len(texts) and (end == begin or chars + len(texts[end]) <= CHUNK_CHARS):
                    chars += len(texts[end])
                    end += 1
                if len(seen) > SEEN_WORDS:
                    seen, table = {}, []
                pred, score, switches = labelled(texts[begin:end], seen, table)
                yield pd.DataFrame(
                    {"id": rows["id"].iloc[begin:end], "lang_pred": pred, "score": score, "switches": switches}
                )
                begin = end

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    if model is None:
        return rows.select(
            "id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("switches")
        )
    return rows.mapInPandas(of, "id long, lang_pred string, score double, switches long")
