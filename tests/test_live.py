"""The live state against a plain fold, and streaming against the batch form."""

import datetime as dt
import json
import math
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from roadspan import schemas
from roadspan.operators import live
from roadspan.sources.messages import file_source
from roadspan.sources.tables import KeyedTable
from roadspan.streaming import decode, jobs
from roadspan.streaming.state import fold_events, state_ddl, window_features

START = dt.datetime(2024, 1, 30)
EVENTS = (
    "thing_id INT, trace_id STRING, trace_date TIMESTAMP, speed INT, engine_status INT, "
    "latitude DOUBLE, longitude DOUBLE, oil_value DOUBLE, fuel_liters DOUBLE"
)


def events(seed, n=240):
    rng = random.Random(seed)
    maybe = lambda v, share=0.1: None if rng.random() < share else v
    return [
        (
            1 if k % 2 else rng.randrange(2, 6),
            f"{k:05d}",
            START + dt.timedelta(seconds=rng.randrange(80000)),
            maybe(rng.randrange(200), 0.3),
            rng.randrange(2),
            maybe(36.5 + rng.random() / 10),
            maybe(3.0 + rng.random() / 10),
            maybe(rng.random() * 5),
            maybe(rng.random() * 50, 0.3),
        )
        for k in range(n)
    ]


def km(a, b):
    if None in (*a, *b):
        return 0.0
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def plain_fold(rows):
    """Expected state after each event, by trace_id."""
    out = {}
    for thing in {r[0] for r in rows}:
        avg = top = fuel = before = None
        idle = active = distance = 0
        for r in sorted((r for r in rows if r[0] == thing), key=lambda r: (r[2], r[1])):
            if r[3] is not None:
                avg = r[3] if avg is None else (avg + r[3]) / 2
                top = r[3] if top is None else max(top, r[3])
            fuel = r[8] if fuel is None else fuel + 0.019
            if before is not None:
                gap = int((r[2] - before[2]).total_seconds())
                idle, active = (idle + gap, active) if r[4] == 0 else (idle, active + gap)
                distance += km(before[5:7], r[5:7])
            before = r
            out[r[1]] = (avg, top, idle, active, fuel, distance)
    return out


STATE = ["avg_speed", "max_speed", "idle_time", "active_time", "fuel", "traveled_distance"]


def close(got, expected):
    return all(
        (a is None and b is None) or (a is not None and b is not None and abs(a - b) < 1e-6)
        for a, b in zip(got, expected, strict=True)
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_states_after_every_event(spark, slicing, seed):
    rows = events(seed)
    expected = plain_fold(rows)
    got = live.vehicle_states(spark.createDataFrame(rows, EVENTS)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert close([r[c] for c in STATE], expected[r.trace_id]), r


def message(r):
    fields = ["thing_id", "trace_id", "trace_date", "speed", "engine_status", "latitude", "longitude", "oil_value", "fuel_liters"]
    values = dict(zip(fields, r, strict=True))
    values["trace_date"] = values["trace_date"].strftime("%Y-%m-%d %H:%M:%S.%f")
    return json.dumps(values).replace('"', "'")


def write_batches(folder, batches):
    folder.mkdir()
    for n, lines in enumerate(batches):
        path = folder / f"{n:03d}.txt"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))  # the source goes by age


@pytest.mark.parametrize("split", [1, 3])
def test_stream_in_any_split_equals_batch(spark, tmp_path, split):
    rows = sorted(events(3), key=lambda r: (r[2], r[1]))
    size = -(-len(rows) // split)
    lines = [message(r) for r in rows]
    batches = [random.Random(5).sample(lines[k : k + size], len(lines[k : k + size])) for k in range(0, len(lines), size)]
    write_batches(tmp_path / "in", batches)
    table = KeyedTable(str(tmp_path / "table"), ["thing_id"], ["trace_date"])
    source = file_source(spark, str(tmp_path / "in"), 1)
    jobs.vehicle_state_job(source, table, str(tmp_path / "cp"), every=None).awaitTermination()
    got = table.read(spark, schemas.live_schema("vehicle_performance")).collect()
    expected = plain_fold(rows)
    last = {r[0]: r for r in rows}
    assert {r.thing_id for r in got} == set(last)
    for r in got:
        assert close([r[c] for c in STATE], expected[last[r.thing_id][1]])
        assert r.trace_date == last[r.thing_id][2]


@pytest.mark.parametrize("split", [1, 4])
def test_days_start_anew_in_any_split(spark, slicing, tmp_path, split):
    rows = sorted(((*r[:2], r[2] + dt.timedelta(hours=14), *r[3:]) for r in events(6)), key=lambda r: (r[2], r[1]))
    size = -(-len(rows) // split)
    write_batches(tmp_path / "in", [[message(r) for r in rows[k : k + size]] for k in range(0, len(rows), size)])
    table = KeyedTable(str(tmp_path / "table"), ["thing_id", "full_date"], ["trace_date"], full_every=2)
    source = file_source(spark, str(tmp_path / "in"), 1)
    jobs.vehicle_state_job(source, table, str(tmp_path / "cp"), every=None).awaitTermination()
    got = table.read(spark, schemas.live_schema("vehicle_performance")).collect()
    days = {}
    for r in rows:
        days.setdefault((r[0], r[2].date()), []).append(r)
    assert {(r.thing_id, r.full_date) for r in got} == set(days) and len({d for _, d in days}) == 2
    for r in got:
        own = days[r.thing_id, r.full_date]
        assert close([r[c] for c in STATE], plain_fold(own)[own[-1][1]])
        assert (r.day, r.trace_date) == (r.full_date.day, own[-1][2])


def test_state_windows_hold_the_last_readings(spark):
    keys = ["thing_id"]
    rows = sorted((r for r in events(7, 400) if r[0] == 1), key=lambda r: (r[2], r[1]))
    states = spark.createDataFrame([], state_ddl(keys))
    for k in range(0, len(rows), 23):
        states = spark.createDataFrame(fold_events(spark.createDataFrame(rows[k : k + 23], EVENTS), states, keys).collect(), state_ddl(keys))
    [r] = states.collect()
    assert r.oil_window == [x[7] for x in rows[-31:]] and r.fuel_window == [x[8] for x in rows[-31:]]


def test_late_event_moves_nothing_back(spark, tmp_path):
    at = lambda m: START + dt.timedelta(minutes=m)
    first = [(1, "a", at(10), 50, 1, 36.0, 3.0, 1.0, 20.0), (1, "b", at(20), 60, 1, 36.1, 3.0, 1.0, 20.0)]
    late = [(1, "c", at(5), 90, 1, 50.0, 3.0, 1.0, 20.0)]
    write_batches(tmp_path / "in", [[message(r) for r in first], [message(r) for r in late]])
    table = KeyedTable(str(tmp_path / "table"), ["thing_id"], ["trace_date"])
    source = file_source(spark, str(tmp_path / "in"), 1)
    jobs.vehicle_state_job(source, table, str(tmp_path / "cp"), every=None).awaitTermination()
    row = table.read(spark, schemas.live_schema("vehicle_performance")).first()
    assert (row.trace_date, row.max_speed, row.active_time, row.latitude) == (at(20), 90.0, 600.0, 36.1)
    assert abs(row.traveled_distance - km((36.0, 3.0), (36.1, 3.0))) < 1e-9


def test_window_features(spark):
    frame = spark.createDataFrame(
        [([1.0, None, 3.0, 5.0], [2.0]), ([None], [])], "oil_window ARRAY<DOUBLE>, fuel_window ARRAY<DOUBLE>"
    )
    full, empty = window_features(frame).collect()
    assert (full.oil_rolling_mean, full.oil_cumsum, full.oil_min, full.oil_max) == (3.0, 9.0, 1.0, 5.0)
    assert abs(full.oil_rolling_stddev - statistics.stdev([1, 3, 5])) < 1e-12
    assert full.fuel_rolling_stddev is None and full.oil_value == 5.0
    assert empty.oil_rolling_mean is None and empty.fuel_min is None


def test_malformed_messages(spark):
    lines = [
        "{'thing_id': 1, 'speed': 5, 'fuel_percent': 2.5}",
        "{'thing_id': 2, 'speed': 2.5, 'battery': 12.0}",
        "{'thing_id': 3, 'speed': nan}",
        "{'thing_id': 4",
    ]
    rows = decode.json_decode_flatten(spark.createDataFrame([(x,) for x in lines], "value STRING"), schemas.POSITION_MESSAGE)
    good = {r.thing_id: r for r in decode.good(rows).collect()}
    assert good[1].speed == 5 and good[1].fuel_percent == 2.5 and good[1].trace_id is None
    assert good[2].speed is None and good[2].battery == 12.0
    assert [r[0] for r in decode.rejects(rows).collect()] == lines[2:]


def test_ingest_replaces_outliers_and_is_repeatable(spark, tmp_path):
    at = lambda m: START + dt.timedelta(minutes=m)
    first = [(1, "a", at(1), 50, 1, 36.0, 3.0, 1.0, 20.0), (2, "b", at(1), 490, 1, 36.0, 3.0, 1.0, 20.0)]
    second = [(1, "c", at(2), 490, 1, 36.0, 3.0, 1.0, 20.0)]
    write_batches(tmp_path / "in", [[message(r) for r in first], [message(r) for r in second]])
    speeds = KeyedTable(str(tmp_path / "speeds"), ["thing_id"], ["trace_date", "trace_id"])
    for run in ("one", "two"):  # a second run from scratch writes the same batches again
        source = file_source(spark, str(tmp_path / "in"), 1)
        jobs.trace_ingest_job(
            source, str(tmp_path / "trace"), speeds, str(tmp_path / run), every=None
        ).awaitTermination()
    got = {r.trace_id: r.speed for r in spark.read.parquet(str(tmp_path / "trace")).collect()}
    assert got == {"a": 50, "b": None, "c": 50}


def test_alert_stream_counts_over_batches(spark, tmp_path):
    def alert(user, minute, lat):
        when = (START + dt.timedelta(minutes=minute)).strftime("%Y-%m-%d %H:%M:%S")
        return f"{{'type_id': 1, 'user_id': {user}, 'event_id': 2, 'event_date': '{when}', 'latitude': {lat}, 'longitude': 3.1}}"

    write_batches(tmp_path / "in", [[alert(1, 1, 36.51), alert(1, 2, 36.53), alert(2, 1, 40.0)], [alert(1, 3, 36.51)]])
    boxes = spark.createDataFrame(
        [(36.5, 36.52, 3.0, 3.2, "A", "SA", "X"), (36.52, 36.54, 3.0, 3.2, "B", "SB", "X")],
        "south DOUBLE, north DOUBLE, west DOUBLE, east DOUBLE, town STRING, state STRING, country STRING",
    )
    table = KeyedTable(str(tmp_path / "alerts"), jobs.ALERT_KEYS, ["alert_number"])
    jobs.alert_job(file_source(spark, str(tmp_path / "in"), 1), table, boxes, str(tmp_path / "cp"), every=None).awaitTermination()
    got = {r.user_id: (r.alert_number, r.municipality, r.province) for r in table.read(spark, schemas.live_schema("alert")).collect()}
    assert got == {1: (3, "A", "SA"), 2: (1, "default", "default")}


def test_alert_days_leave_the_state(spark, tmp_path):
    def alert(day, hour):
        when = (START + dt.timedelta(days=day, hours=hour)).strftime("%Y-%m-%d %H:%M:%S")
        return f"{{'type_id': 1, 'user_id': 1, 'event_id': 2, 'event_date': '{when}', 'latitude': 36.5, 'longitude': 3.1}}"

    write_batches(tmp_path / "in", [[alert(0, 1), alert(0, 2)], [alert(1, 1), alert(0, 3)], [alert(4, 1)], [alert(4, 2)], [alert(0, 4)], [alert(5, 1)]])
    boxes = spark.createDataFrame([], "south DOUBLE, north DOUBLE, west DOUBLE, east DOUBLE, town STRING, state STRING, country STRING")
    table = KeyedTable(str(tmp_path / "alerts"), jobs.ALERT_KEYS, ["alert_number"])
    query = jobs.alert_job(file_source(spark, str(tmp_path / "in"), 1), table, boxes, str(tmp_path / "cp"), every=None)
    query.awaitTermination()
    got = {(r.full_date - START.date()).days: r.alert_number for r in table.read(spark, schemas.live_schema("alert")).collect()}
    # The last alert of the first day comes when its day has left the state.
    assert got == {0: 3, 1: 1, 4: 2, 5: 1}
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) <= 3 and held[-1] <= 2


def test_rejects_are_kept_per_batch(spark, tmp_path):
    good = message(events(1)[0])
    write_batches(tmp_path / "in", [[good, "no json", "{'thing_id': "], [good], ["no json", "7"]])
    source = file_source(spark, str(tmp_path / "in"), 1)
    jobs.rejects_job(source, schemas.POSITION_MESSAGE, str(tmp_path / "bad"), str(tmp_path / "cp"), every=None).awaitTermination()
    kept = spark.read.schema("text STRING, batch_id INT").parquet(str(tmp_path / "bad")).collect()
    assert sorted((r.batch_id, r.text) for r in kept) == [(0, "no json"), (0, "{'thing_id': "), (2, "7"), (2, "no json")]


def test_outlier_of_unknown_vehicle_is_null(spark):
    new = spark.createDataFrame([(9, "x", START, 300)], "thing_id INT, trace_id STRING, trace_date TIMESTAMP, speed INT")
    assert live.speed_outlier_replace(new, new.filter("thing_id < 0")).first().speed is None


def test_latest_features_fan_out_once(spark):
    stats = live.rolling_sensor_stats(spark.createDataFrame(events(4), EVENTS))
    incoming = spark.createDataFrame([(1,), (99,)], "thing_id INT")
    got = live.join_latest_features(incoming, stats)
    assert got.count() == 2
    assert got.filter(F.col("thing_id") == 99).first().oil_rolling_mean is None
