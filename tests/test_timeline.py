"""Sliced windows against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from roadspan.operators.timeline import Timeline, hot_cuts

START = dt.datetime(2024, 1, 1)
ORDER = ["ts", "id"]


def rows_of(seed: int, hot: int = 400, cold: int = 40):
    """One vehicle with most rows (half of them within ten minutes) and many small ones."""
    rng = random.Random(seed)
    rows = []
    for n in range(hot):
        seconds = rng.randrange(600) + 86400 if n % 2 else rng.randrange(5 * 86400)
        rows.append((1, START + dt.timedelta(seconds=seconds), n, rng.choice([None, 1, 2, 3, 4])))
    for n in range(cold):
        rows.append((2 + n % 9, START + dt.timedelta(seconds=rng.randrange(5 * 86400)), n, n % 5))
    return rows


@pytest.fixture(params=[1, 2])
def data(request, spark):
    rows = rows_of(request.param)
    frame = spark.createDataFrame(rows, "k INT, ts TIMESTAMP, id INT, v INT")
    by_key = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        by_key.setdefault(row[0], []).append(row)
    return frame, by_key


def timeline(frame):
    cuts = hot_cuts(frame, ["k"], "ts")
    return Timeline(frame, ["k"], ORDER, cuts), cuts


def test_only_large_keys_are_cut(data, spark):
    spark.conf.set("spark.roadspan.rowsPerSlice", "50")
    try:
        cuts = hot_cuts(data[0], ["k"], "ts")
        assert {r.k for r in cuts.collect()} == {1}
        assert hot_cuts(data[0].filter("k > 1"), ["k"], "ts") is None
    finally:
        spark.conf.unset("spark.roadspan.rowsPerSlice")


def test_small_input_is_not_counted(data):
    assert hot_cuts(data[0], ["k"], "ts") is None


def test_frames(data, slicing):
    frame, by_key = data
    line, cuts = timeline(frame)
    assert (cuts is not None) == bool(slicing)
    got = line.frame(
        3,
        2,
        lambda w: {
            "p1": F.lag("id").over(w),
            "p3": F.lag("id", 3).over(w),
            "n2": F.lead("id", 2).over(w),
            "s": F.sum("v").over(w.rowsBetween(-3, 0)),
        },
    ).df.collect()
    assert len(got) == sum(map(len, by_key.values()))
    found = {(r.k, r.ts, r.id): (r.p1, r.p3, r.n2, r.s) for r in got}
    for k, rows in by_key.items():
        for n, row in enumerate(rows):
            at = lambda m: rows[m][2] if 0 <= m < len(rows) else None
            window = [r[3] for r in rows[max(0, n - 3) : n + 1] if r[3] is not None]
            expected = (at(n - 1), at(n - 3), at(n + 2), sum(window) if window else None)
            assert found[(k, row[1], row[2])] == expected


def test_running_and_totals(data, slicing):
    frame, by_key = data
    line, _ = timeline(frame)
    got = (
        line.running(
            {
                "total": ("sum", F.col("v")),
                "top": ("max", F.col("v")),
                "n": ("count", F.lit(1)),
                "first": ("first", F.col("v")),
                "last": ("last", F.col("v")),
            }
        )
        .totals({"size": ("count", F.lit(1))})
        .df.collect()
    )
    found = {(r.k, r.ts, r.id): (r.total, r.top, r.n, r.first, r.last, r.size) for r in got}
    assert len(got) == len(found)
    for k, rows in by_key.items():
        for n, row in enumerate(rows):
            seen = [r[3] for r in rows[: n + 1] if r[3] is not None]
            expected = (
                sum(seen) if seen else None,
                max(seen) if seen else None,
                n + 1,
                seen[0] if seen else None,
                seen[-1] if seen else None,
                len(rows),
            )
            assert found[(k, row[1], row[2])] == expected


def test_within(data, slicing):
    frame, by_key = data
    line, _ = timeline(frame.withColumn("even", F.col("id") % 2 == 0))
    got = line.frame(1, 0, lambda w: {"p": F.lag("id").over(w)}, within="even").df.collect()
    found = {(r.k, r.ts, r.id): r.p for r in got}
    for k, rows in by_key.items():
        last = {0: None, 1: None}
        for row in rows:
            assert found[(k, row[1], row[2])] == last[row[2] % 2]
            last[row[2] % 2] = row[2]


def test_null_times_null_keys_and_bursts(spark):
    """Plain and sliced agree, and a burst within minutes is cut."""
    rng = random.Random(9)
    rows = []
    for key in (1, None):
        rows += [(key, START + dt.timedelta(seconds=rng.randrange(240)), n, n % 4) for n in range(300)]
        rows += [(key, None, 300 + n, n % 3) for n in range(5)]
    rows += [(2, START, n, 1) for n in range(3)]
    frame = spark.createDataFrame(rows, "k INT, ts TIMESTAMP, id INT, v INT")
    cuts = hot_cuts(frame, ["k"], "ts", rows_per_slice=100)
    assert {r.k for r in cuts.collect()} == {1, None}

    def values(cut):
        done = (
            Timeline(frame, ["k"], ORDER, cut)
            .frame(1, 0, lambda w: {"before": F.lag("v").over(w)})
            .running({"n": ("count", F.lit(1)), "s": ("sum", F.col("v"))})
            .totals({"all": ("count", F.lit(1))})
        )
        return sorted(map(repr, done.df.collect())), done

    plain, _ = values(None)
    sliced, done = values(cuts)
    assert plain == sliced
    sizes = done._df.filter("_slice is not null").groupBy("k", "_slice").count()
    assert sizes.agg(F.max("count")).first()[0] <= 200
