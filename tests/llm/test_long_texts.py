"""Long texts of the kinds that make careless patterns and joins slow: each within seconds."""

import time

import numpy as np
import public_tokenizers as vocab
import pytest
import tiktoken
from pyspark.sql import functions as F

from roadspan.llm import blob_ledger, deobfuscation, merge_replay, periodic_runs, spaced_seeds

MB = 1 << 20


@pytest.fixture
def quick():
    start = time.monotonic()
    yield
    assert time.monotonic() - start < 60


def one(spark, text, name="doc_id"):
    return spark.createDataFrame([(1, text)], f"{name} LONG, text STRING")


@pytest.mark.parametrize(
    "text",
    ["-----BEGIN " + "A " * (MB // 2), "eyJ" * (MB // 3), "eyJ-" * (MB // 4), "token " * (MB // 6), "token=" + "a" * MB, "f" * MB],
    ids=["pem", "jwt", "jwt-", "token", "value", "hex"],
)
def test_secrets(spark, quick, text):
    [r] = blob_ledger.scan(one(spark, text)).collect()
    spans = [(s.start, s.kind_no, s.end) for s in r.spans]
    want = {"token=": [(0, 0, len(text))], "ffffff": [(0, 2, len(text))]}
    if text[6:7] in ("a", "f"):
        assert want[text[:6]][0] in spans
    else:
        assert spans == []


def test_secret_kinds_still_match(spark):
    text = "-----BEGIN RSA PRIVATE KEY----- x -----BEGIN PRIVATE KEY----- eyJabcdefghijk.eyJabcdefghijk.sig xeyJabcdefghijk.eyJabcdefghijk.sig"
    [r] = blob_ledger.scan(one(spark, text)).collect()
    assert [(s.kind_no, text[s.start : s.end]) for s in r.spans] == [
        (3, "-----BEGIN RSA PRIVATE KEY-----"), (3, "-----BEGIN PRIVATE KEY-----"), (4, "eyJabcdefghijk.eyJabcdefghijk.sig"),
    ]


def test_unseen_pairs_only(spark, tmp_path):
    """A second update scans new blobs and new rule versions and moves no other text."""
    book = blob_ledger.BlobLedger(spark, f"file://{tmp_path}/l", blob_ledger.RULES[:2])
    first = spark.createDataFrame([(1, "token=abcdef"), (2, "x")], "doc_id LONG, text STRING")
    assert book.update(first) == 2 and book.update(first) == 0
    more = blob_ledger.BlobLedger(spark, f"file://{tmp_path}/l")
    assert more.update(first.union(spark.createDataFrame([(3, "f" * 30)], first.schema))) == 3
    assert more.update(first) == 0
    rows = spark.read.parquet(f"{tmp_path}/l").select("blob", F.explode("found.rule").alias("rule"))
    assert rows.count() == rows.distinct().count() == 3 * len(blob_ledger.RULES)


@pytest.mark.parametrize(
    "run", ["a" * MB, "a." * (MB // 2), "a dot " * (MB // 6), " " * MB, "a at " * (MB // 5), "(" * MB, "one " * (MB // 4), "1." * (MB // 2), "+1" + "(" * MB],
    ids=["letters", "dots", "dot words", "spaces", "at words", "brackets", "number words", "numbers", "phone"],
)
def test_personal_data(quick, run):
    text = f"me (at) here (dot) org x (at) y {run} x (at) y two one two one"
    base, added = deobfuscation.all_spans(text)
    assert (0, 0, len("me (at) here (dot) org")) in added


def test_merges(quick):
    path, pattern = vocab.path("byte_bpe_50k.tiktoken"), vocab.PATTERN
    ranks = merge_replay.read_ranks(path)
    table = merge_replay.MergeTable(ranks)
    coder = tiktoken.Encoding("x", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for word in ("a" * 1001, "ab" * 700, "aab" * 300, "aaabaaaa" * 90, " " * 513):
        ids, _ = merge_replay.replay([word.encode()], table)
        assert ids.tolist() == coder.encode_single_piece(word.encode()) if hasattr(coder, "encode_single_piece") else coder._encode_single_piece(word.encode())
    ids, ends = merge_replay.replay([b"a" * MB, b"b" * MB], table)
    assert ends[-1] == len(ids) and b"".join(table.tokens[i] for i in ids[: ends[0]].tolist()) == b"a" * MB


@pytest.mark.parametrize("period", [1, 2, 7])
def test_benchmark_passages(spark, quick, period):
    words = [f"w{k % period}" for k in range(MB // 6)]
    items = spark.createDataFrame([(5, " ".join(words[:2000])), (6, "other words " * 10), (7, " ".join(words[:9]))], "item_id LONG, text STRING")
    found = spaced_seeds.contaminated(one(spark, " ".join(words)), items).collect()
    assert sorted((r.item_id, r.matches, r.window) for r in found) == [(5, 13, 13), (7, 9, 9)]
    # An item may begin before the text, so the first window that agrees is the first of all.
    assert {r.pos for r in found} == {0}


def test_runs(quick):
    [found] = periodic_runs.fragments([[b"a"] * 300_000])
    assert any(q == 1 and (a, c) == (0, 299_999) for q, a, c in found) or len(found) > 1
    words = np.arange(150_000).tolist()
    assert periodic_runs.fragments([words]) == [[]]
