"""Centroid clustering, periodic runs and archives against plain Python, and on odd rows."""

import base64
import glob
import gzip
import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from compare import connect, difference
from conftest import SMALL
from pyspark.sql import functions as F

from roadspan.llm import orchard, periodic_runs, queries, warc

CLASH = "id STRING, v INT, cluster STRING, distance INT, n STRING, mark INT, text2 STRING"


# --- clustering -------------------------------------------------------------------------------


def test_clusters_match_checking_sql(spark):
    sql = queries.oracle_sql()["op11_orchard"]
    assert difference(queries.queries()["op11_orchard"](spark, SMALL), connect(SMALL), sql) is None


def lloyd(rows, k, rounds, size):
    kept = [
        (i, [int(np.floor(256 * float(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)
    ]
    named = lambda i: (1, "") if i is None else (0, hashlib.sha256(f"2:{i}".encode()).hexdigest())
    centroids = [v for _, v in sorted(kept, key=lambda r: (named(r[0]), r[1]))[:k]]
    apart = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    near = lambda v: min((apart(v, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(near(v)[1], []).append(v)
        for n, own in members.items():
            centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *near(v)) for i, v in kept]
    total = {}
    for _, d, n in found:
        total[n] = total.get(n, 0) + d
    name = lambda n: hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()
    return sorted((str(i), n, d, total[n], sum(total.values()), name(n)) for i, d, n in found)


@pytest.mark.parametrize("k", [1, 3, 8, 40])
def test_clusters_of_odd_vectors(spark, k):
    rnd = random.Random(k)
    rows = [(i, [rnd.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(4)]) for i in range(60)]
    rows += [(100, [1.0] * 4), (100, [1.0] * 4), (None, [0.5] * 4), (None, [0.5] * 4), (101, None), (102, [1.0] * 3)]
    rows += [(103, [1.0, None, 1.0, 1.0]), (104, [1.0, float("nan"), 1.0, 1.0]), (105, [float("inf")] * 4), (106, [])]
    rows += [(200 + i, [0.25] * 4) for i in range(40)]
    frame = spark.createDataFrame([(i, v, "x", 1, "y", 2, "z", 3, "w") for i, v in rows], f"vec_id LONG, embedding ARRAY<FLOAT>, {CLASH}")
    found = orchard.cluster(frame, k=k, size=4)
    assert sorted((str(r.id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in found.collect()) == lloyd(rows, k, 5, 4)
    assert orchard.cluster(frame.filter("false")).count() == 0


def test_large_components_are_held_within_bounds(spark):
    frame = spark.createDataFrame([(1, [1e38, -1e38]), (2, [0.0, 0.0])], "vec_id LONG, embedding ARRAY<DOUBLE>")
    assert [r.v for r in orchard.whole_vectors(frame, 2, 256, "vec_id", "embedding").orderBy("id").collect()] == [[1 << 24, -(1 << 24)], [0, 0]]
    assert orchard.cluster(frame, size=2).count() == 2


def test_orchard_measures_less_than_all_and_finds_the_nearest():
    rng = np.random.default_rng(1)
    centres = rng.integers(-5000, 5000, (30, 8))
    vectors = centres[rng.integers(0, 30, 2000)] + rng.integers(-20, 20, (2000, 8))
    search = orchard.Orchard(centres)
    cluster, distance = search.nearest(vectors)
    every = ((vectors[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert search.measured < 2000 * 30 * 0.7


# --- periodic runs ----------------------------------------------------------------------------


def slow_runs(words):
    runs = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            a = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - a >= max(6, 4 * q):
                runs.setdefault((a, i + q - a), q)
            i = max(i, a + 1)
    return sorted((a, n, q) for (a, n), q in runs.items())


def slow_digests(text):
    words = periodic_runs.split_words(text)
    runs = sorted(slow_runs(words), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def periodic_texts():
    rnd = random.Random(5)
    texts = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "a\x0b\x0ca  a a\ta a b", "a\xa0a a a", "x y x y x y x y", "x y x y x y x"]
    for n in (30, 90, 200, 400):
        for letters in (1, 2, 3, 9):
            words = [rnd.choice("abcdefghi"[:letters]) for _ in range(n)]
            a, p = rnd.randrange(n // 2), rnd.randrange(1, n // 8)
            texts.append(" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]))
    return texts


@pytest.mark.parametrize("least", [16, 64, periodic_runs.TILE_WORDS])
def test_runs_match_plain_python(spark, least):
    texts = periodic_texts()
    rows = [(i, t, None, 1, "c", 2, "n", 3, "z") for i, t in enumerate(texts)] + [(None, texts[-1], None, 1, "c", 2, "n", 3, "z")] * 2
    frame = spark.createDataFrame(rows, f"doc_id LONG, text STRING, {CLASH}")
    found = periodic_runs.digests(periodic_runs.find_runs(frame, least=least)).collect()
    want = [(str(r[0]), *slow_digests(r[1])) for r in rows]
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in found) == sorted(want, key=lambda r: r[0])
    assert periodic_runs.find_runs(frame.filter("false")).count() == 0


def test_a_long_text_is_stitched_from_many_tiles(spark):
    rnd = random.Random(2)
    words = [rnd.choice("abcdefgh") for _ in range(3000)]
    words += ["a", "b", "c"] * 3000 + [str(rnd.randrange(10**6)) for _ in range(700)] * 7 + ["z"] * 5000
    frame = spark.createDataFrame([(1 << 60, " ".join(words)), (None, "q")], "doc_id LONG, text STRING")
    results = [
        {r.id: (sorted(map(tuple, r.runs)), r.collapsed_sha256) for r in periodic_runs.find_runs(frame, least=least).collect()}
        for least in (256, 4096, 1 << 20)
    ]
    assert results[0] == results[1] == results[2]
    lengths = {(n, q) for _, n, q in results[0][1 << 60][0]}
    assert (4900, 700) in lengths and (5000, 1) in lengths and any(q == 3 and n >= 9000 for n, q in lengths)


def test_planted_runs(spark):
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = texts.unionByName(spark.createDataFrame([(None, "a b"), (None, None), (3, None)], "doc_id LONG, text STRING"))
    found = {}
    for r in queries.planted_runs(rows).collect():
        found.setdefault(r.doc_id, []).append(periodic_runs.split_words(r.text))
    changed = 0
    for r in rows.collect():
        words = periodic_runs.split_words(r.text)
        n, h = len(words), zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            changed += 1
        assert words in found[r.doc_id]
    assert changed > 10
    whole = {r.doc_id: tuple(r)[1:] for r in queries.queries()["op12_periodic_runs"](spark, SMALL).collect()}
    short = [i for i, w in found.items() if i is not None and len(w) == 1 and len(w[0]) < 150 and i in whole and i != 3]
    assert len(short) > 20 and all(whole[i] == slow_digests(b" ".join(found[i][0]).decode()) for i in short)


# --- archives ---------------------------------------------------------------------------------


def page_rows():
    rows = [(i, f"http://x/{i}", t) for i, t in enumerate(["<p>a", "<p>b", "<p>a", None, "", "é" * 5000, "<p>a", "\r\n\r\nWARC/1.1\r\n\r\n"])]
    rows += [(0, "http://x/0", "<p>a"), (None, None, "<p>b"), (None, "u\r\nX: y", "only"), (None, "u", "only"), (1 << 60, "u", "x" * 200_000), (-5, "u", "é" * 5000)]
    return rows


def expected(rows, least=0):
    out = []
    for i, _, t in rows:
        data = (t or "").encode()
        ids = [j for j, _, s in rows if (s or "").encode() == data and j is not None]
        first = min(ids, default=None)
        response = len(data) < least or first is None or i == first
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((str(i), len(data), sha, "response" if response else "revisit", None if response else first))
    return sorted(out, key=str)


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("least", [0, 5])
def test_archives_round_trip(spark, packed, least, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 20_000)
    rows = page_rows()
    frame = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], "page_id LONG, url STRING, html STRING, sha1 STRING, payload STRING, first INT")
    path = warc.write(frame.coalesce(2), f"file://{tmp_path}/w", least=least, gzip=packed)
    read = warc.read(spark, path, with_payload=True)
    assert warc.gaps(read).count() == 0
    found = warc.records(read).collect()
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str) == expected(rows, least)
    assert {bytes(r.payload).decode() for r in found if r.payload is not None} == {t or "" for _, _, t in rows}
    for name in glob.glob(f"{tmp_path}/w/part-*"):
        data = open(name, "rb").read()
        whole = gzip.decompress(data) if packed and data else data
        assert whole == b"" or whole.endswith(b"\r\n\r\n")
    assert warc.read(spark, warc.write(frame.filter("false"), f"file://{tmp_path}/none", gzip=packed)).count() == 0


def test_equal_payloads_beyond_the_broadcast_bound(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    rows = page_rows() + [(1000 + i, "u", "hot") for i in range(300)]
    frame = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")
    found = warc.records(warc.read(spark, warc.write(frame, f"file://{tmp_path}/w"))).collect()
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str) == expected(rows)


def archive(packed, n=12):
    made = [warc.build_record(i, f"http://x/{i}", (f"<p>{i}" * 40).encode(), "2024-01-01T00:00:00Z") for i in range(n)]
    return [warc.member(r) for r in made] if packed else made


@pytest.mark.parametrize("packed", [False, True])
def test_salvage_skips_what_is_damaged_and_names_the_gap(packed):
    parts = archive(packed)
    parts[3] = parts[3][:60] + b"####" + parts[3][64:]  # overwritten
    parts[6] = parts[6][: 150 if not packed else len(parts[6]) // 2]  # cut in the header or member
    parts[9] = b"noise \x1f\x8b\x08 noise WARC/1.1 noise" + parts[9]
    data = b"".join(parts)[:-7]  # cut at the end
    found = list(warc.salvage(data))
    assert [warc._number(r.fields["warc-record-id"]) for r in found if r.reason is None] == [0, 1, 2, 4, 5, 7, 8, 9, 10]
    starts = [sum(map(len, parts[:k])) for k in range(13)]
    gaps = [(r.start, r.end) for r in found if r.reason]
    assert gaps == [(starts[3], starts[4]), (starts[6], starts[7]), (starts[9], starts[9] + len(parts[9]) - len(archive(packed)[9])), (starts[11], len(data))]
    # Records and gaps cover every byte once.
    edges = [0, *[e for r in found for e in (r.start, r.end)], len(data)]
    assert all(a == b for a, b in zip(edges[::2], edges[1::2]))


def test_salvage_of_random_damage_and_hostile_bytes():
    rnd = random.Random(3)
    for packed in (False, True):
        parts = archive(packed)
        whole = b"".join(parts)
        starts = [sum(map(len, parts[:k])) for k in range(13)]
        for _ in range(60):
            data = bytearray(whole)
            hit = rnd.randrange(len(data))
            data[hit] ^= 1 << rnd.randrange(8)
            ids = [warc._number(r.fields.get("warc-record-id")) for r in warc.salvage(bytes(data)) if r.reason is None]
            struck = max(k for k in range(12) if starts[k] <= hit)
            assert {i for i in ids if i is not None} >= set(range(12)) - {struck}
    for hostile in (b"WARC/1.1\r\n" * 200_000, b"WARC/1.1\r\nA: b\r\n" * 100_000, b"\x1f\x8b\x08" * 300_000, b"\r\n" * 500_000, b"", b"A: " * 400_000,
                    b"WARC/1.1\r\n" + b"".join(b"A%d: WARC/1.1\r\n" % k for k in range(60_000)), b"WARC/1.1\r\nA: x\r\n" + b" WARC/1.1\r\n" * 100_000):
        assert len(list(warc.salvage(hostile))) <= 1
    assert [r.reason for r in warc.salvage(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n")] == ["cut off"]


def test_quarantined_gaps_are_logged(spark, tmp_path):
    parts = archive(True)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(parts[:5]) + b"lost bytes" + b"".join(parts[5:]))
    (tmp_path / "empty.warc").write_bytes(b"")
    read = warc.read(spark, f"file://{tmp_path}")
    start = sum(map(len, parts[:5]))
    assert [(r.start, r.end) for r in warc.gaps(read).collect()] == [(start, start + 10)]
    assert warc.records(read).count() == 12
