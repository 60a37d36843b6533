"""Journeys against a plain loop over each vehicle's rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from roadspan.operators import journeys, paths

START = dt.datetime(2024, 1, 1)
SOURCE = (
    "thing_id INT, date_id INT, trace_date TIMESTAMP, engine_status INT, latitude DOUBLE, "
    "longitude DOUBLE, journey DOUBLE, speed INT"
)


def random_rows(seed, n=300, statuses=(0, 1)):
    rng = random.Random(seed)
    rows = set()
    for k in range(n):
        seconds = rng.randrange(3 * 86400)
        rows.add(
            (
                1 if k % 3 else rng.randrange(2, 5),
                1 + seconds // 86400,
                START + dt.timedelta(seconds=seconds - seconds % 30),
                rng.choice(statuses),
                36.5 + rng.randrange(100) / 1000,
                3.0 + rng.randrange(100) / 1000,
                None if rng.random() < 0.2 else k / 10,
                rng.randrange(100),
            )
        )
    return list(rows)


def loop(rows):
    """(thing, segment) to (start, end, day, points), closed journeys only, and all starts."""
    none_first = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    closed, starts = {}, []
    for thing in sorted({r[0] for r in rows}):
        own = sorted((r for r in rows if r[0] == thing), key=lambda r: none_first((r[2], *r[3:], r[1])))
        segment, open_, before = 0, None, None
        for row in own:
            if before is not None and before[3] == 0 and row[3] == 1:
                segment += 1
                starts.append((thing, segment))
                open_ = [row]
            elif open_ is not None:
                open_.append(row)
                if before[3] == 1 and row[3] == 0:
                    closed[(thing, segment)] = (open_[0][2], row[2], row[1], len(open_))
                    open_ = None
            before = row
    return closed, starts


@pytest.mark.parametrize("statuses", [(0, 1), (0, 1, 1, None)])
@pytest.mark.parametrize("seed", [1, 2])
def test_segments_and_ids(spark, slicing, seed, statuses):
    rows = random_rows(seed, statuses=statuses)
    source = spark.createDataFrame(rows, SOURCE)
    closed, starts = loop(rows)
    segments = journeys.journey_segments(journeys.segment_rows(source))
    got = segments.filter("end_time IS NOT NULL").collect()
    assert {
        (r.thing_id, r.segment): (r.start_time, r.end_time, r.date_id, r.n_points) for r in got
    } == closed
    ids = journeys.journey_ids(segments, 10).collect()
    numbered = {(r.thing_id, r.segment): r.journey_id for r in ids}
    assert numbered == {key: 11 + n for n, key in enumerate(starts)}


def at(minute):
    return START + dt.timedelta(minutes=minute)


def test_first_row_open_journey_and_missing_odometer(spark):
    rows = [
        (1, 1, at(0), 1, 36.0, 3.0, 1.0, 10),  # a first row is no start
        (1, 1, at(1), 0, 36.0, 3.0, 2.0, 20),
        (1, 1, at(2), 1, 36.0, 3.0, None, 30),  # start without odometer
        (1, 1, at(3), 0, 36.0, 3.0, 4.0, 40),
        (1, 1, at(4), 1, 36.0, 3.0, 5.0, 50),
        (1, 1, at(9), 0, 36.1, 3.1, 8.0, 70),
        (1, 1, at(10), 1, 36.0, 3.0, 9.0, 90),  # never closed
    ]
    rows_ = journeys.segment_rows(spark.createDataFrame(rows, SOURCE))
    numbered = journeys.journey_ids(journeys.journey_segments(rows_))
    measured = journeys.journey_measures(journeys.closed_journeys(numbered)).collect()
    assert [(r.journey_id, r.traveled_distance, r.active_time, r.idle_time) for r in measured] == [
        (2, 3.0, 5.0, 0.0)
    ]


def test_speed_stats_over_long_journeys_and_copies(spark, slicing):
    trace = [(1, at(m), m) for m in range(0, 5 * 1440, 60)] + [(1, at(60), 60)] + [(2, at(60), 999)]
    frame = spark.createDataFrame(trace, "thing_id INT, trace_date TIMESTAMP, speed INT")
    # Touching journeys, two of no length in one second, and one of another vehicle.
    spans = [(7, 1, at(0), at(120)), (8, 1, at(120), at(120)), (9, 1, at(120), at(120)),
             (10, 1, at(120), at(4 * 1440)), (11, 1, at(5000 + 1440), at(6800)), (12, 3, at(0), at(1))]
    found = journeys.journey_speed_stats(
        frame,
        spark.createDataFrame(spans, "journey_id BIGINT, thing_id INT, start_time TIMESTAMP, end_time TIMESTAMP"),
    )
    got = {r.journey_id: (r.avg_speed, r.max_speed) for r in found.collect()}
    for journey_id, thing, start, end in spans:
        inside = [s for t, when, s in trace if t == thing and start <= when <= end]
        expected = (sum(inside) / len(inside), max(inside)) if inside else (None, None)
        assert got[journey_id] == expected, journey_id


def test_moving_rows_only(spark):
    frame = spark.createDataFrame(
        [(1, at(1), 10, 0), (1, at(2), 30, 5)],
        "thing_id INT, trace_date TIMESTAMP, speed INT, max_speed INT",
    )
    spans = spark.createDataFrame(
        [(1, 1, at(0), at(5))], "journey_id BIGINT, thing_id INT, start_time TIMESTAMP, end_time TIMESTAMP"
    )
    assert journeys.journey_speed_stats(frame, spans, moving_only=True).first().avg_speed == 30


def test_source_windows(spark):
    trace = spark.createDataFrame(
        [(t, at(d * 1440), dt.date(2024, 1, 1 + d), 1, 1.0, 1.0, 1.0, 5) for t in (1, 2) for d in range(4)] * 2,
        "thing_id INT, trace_date TIMESTAMP, trace_date_day DATE, engine_status INT, latitude DOUBLE, "
        "longitude DOUBLE, journey DOUBLE, speed INT",
    )
    days = spark.createDataFrame(
        [(k + 1, dt.date(2024, 1, 1 + k)) for k in range(4)], "date_id INT, full_date DATE"
    )
    got = journeys.journey_source(trace, days, after_date_id=1, max_date_id=3, max_thing_id=1).collect()
    assert sorted((r.thing_id, r.date_id) for r in got) == [(1, 2), (1, 3)]


def test_path_parts_of_a_journey(spark, slicing):
    rows = [(1, 1, at(0), 0, 1.0, 1.0, 1.0, 1)]
    rows += [(1, 1, at(1 + k), 1, 10.0 + k, 20.0, 2.0, 1) for k in range(7)]
    rows += [(1, 1, at(8), 0, 17.0, 20.0, 3.0, 1)]
    rows_ = journeys.segment_rows(spark.createDataFrame(rows, SOURCE))
    closed = journeys.closed_journeys(journeys.journey_ids(journeys.journey_segments(rows_)))
    points = journeys.journey_points(rows_, closed)
    text = paths.path_text(points, decimals=1, points_per_part=3).orderBy("part").collect()
    assert [r.path for r in text] == [
        "10.0,20.0;11.0,20.0;12.0,20.0",
        "13.0,20.0;14.0,20.0;15.0,20.0",
        "16.0,20.0;17.0,20.0",
    ]


def test_long_journeys_have_one_grain(spark):
    """The dimension's key is (journey_id, part) at every length; emptiness is that of the journey."""
    lengths = {1: 2, 2: 512, 3: 513, 4: 2_000}
    points = spark.createDataFrame(
        [(j, k, 36.0 + k / 1000, 3.0) for j, n in lengths.items() for k in range(n)],
        "path_id LONG, seq LONG, latitude DOUBLE, longitude DOUBLE",
    )
    texts = paths.path_text(points, 3)
    parts = {(r.path_id, r.part): r.n_points for r in texts.collect()}
    assert parts == {(1, 0): 2, (2, 0): 512, (3, 0): 512, (3, 1): 1, **{(4, p): min(512, 2_000 - 512 * p) for p in range(4)}}
    closed = spark.createDataFrame([(j, START, START) for j in lengths], "journey_id LONG, start_time TIMESTAMP, end_time TIMESTAMP")
    ends = spark.createDataFrame([(j, "a", "b") for j in lengths], "journey_id LONG, start_point STRING, end_point STRING")
    dim = journeys.journey_dim(closed, ends, texts)
    assert dim.count() == dim.select("journey_id", "part").distinct().count() == len(parts)
    # Only the last part of journey 3 is empty, journey 1 is empty as a whole.
    emptied = dim.withColumn("path", F.expr("CASE WHEN journey_id = 1 OR (journey_id = 3 AND part = 1) THEN '' ELSE path END"))
    left = journeys.delete_empty_paths(emptied)
    assert {(r.journey_id, r.part) for r in left.collect()} == {k for k in parts if k[0] != 1}
    fact = closed.select("journey_id")
    assert {r.journey_id for r in journeys.delete_orphan_journeys(fact, left).collect()} == {2, 3, 4}
    # Cleaning keeps steps of 111 metres and lays the parts out anew.
    cleaned = paths.path_clean(texts.select("path_id", "part", "path"), 3).collect()
    kept = {j: ";".join(r.path for r in sorted((r for r in cleaned if r.path_id == j), key=lambda r: r.part)) for j in lengths}
    assert kept == {j: ";".join(f"{36.0 + k / 1000:.3f},3.000" for k in range(n)) for j, n in lengths.items()}
