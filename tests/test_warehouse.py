"""Facts, loads, KPI rules, places and files on small hand-made frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from roadspan import schemas
from roadspan.operators import dims, facts, features, kpi, loading, scaling, serving
from roadspan.operators import places
from roadspan.operators.places import place_lookup
from roadspan.plans.fixtures import Inputs
from roadspan.sources import files, jdbc, tables

START = dt.datetime(2024, 1, 1)
TRACE = (
    "thing_id INT, trace_date TIMESTAMP, trace_date_day DATE, engine_status INT, latitude DOUBLE, "
    "longitude DOUBLE, speed INT"
)


def trace_rows(seed, n=200):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        when = START + dt.timedelta(minutes=rng.randrange(3 * 1440))
        rows.append((1 if k % 3 else 2, when, when.date(), k % 2, 36 + rng.random(), 3 + rng.random(), k))
    # Rows of one second and place that differ in speed only, some of them copied.
    when = START + dt.timedelta(minutes=777)
    rows += [(1, when, when.date(), 1, 36.5, 3.5, v) for v in (5, 6, 6, 6, 7, 7)]
    # One row has very many copies, others two or three.
    return rows + [rows[5]] * 150 + rows[:20] + rows[:10]


def plain_steps(rows):
    out = set()
    for thing in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == thing), key=lambda r: (r[1], *r[3:]))
        for before, row in zip([None, *own], own, strict=False):
            out.add((*row, *((before[4], before[5], before[1]) if before else (None, None, None))))
    return out


def test_previous_rows_with_copies(spark, slicing):
    rows = trace_rows(1)
    frame = spark.createDataFrame(rows, TRACE)
    days = dims.date_dim(frame, "trace_date_day")
    got = facts.trace_with_prev(frame, days).join(days, "date_id").collect()
    found = [
        (r.thing_id, r.trace_date, r.full_date, r.engine_status, r.latitude, r.longitude, r.speed,
         r.prev_latitude, r.prev_longitude, r.prev_trace_date)
        for r in got
    ]
    assert len(found) == len(set(found))
    assert set(found) == plain_steps(rows)


def test_speed_filter_applies_before_the_previous_row(spark):
    at = lambda m: START + dt.timedelta(minutes=m)
    rows = [(1, at(0), START.date(), 1, 36.0, 3.0, 10), (1, at(1), START.date(), 1, 36.5, 3.0, 999),
            (1, at(2), START.date(), 1, 36.0, 3.0, 20)]
    frame = spark.createDataFrame(rows, TRACE)
    days = dims.date_dim(frame, "trace_date_day")
    day = facts.vehicle_daily_performance(frame, days, max_speed=300).first()
    assert (day.traveled_distance, day.active_time, day.avg_speed) == (0.0, 2 / 60, 20.0)
    capped = facts.vehicle_daily_performance(frame, days, max_thing_id=0)
    assert capped.isEmpty()


def test_incremental_dates_continue_ids(spark):
    frame = spark.createDataFrame([(dt.date(2024, 3, d),) for d in (1, 2, 2, 3)], "d DATE")
    more = dims.date_dim(frame, "d", after_day=dt.date(2024, 3, 1), current_max_id=7)
    assert [(r.date_id, r.full_date.day, r.quarter, r.season, r.day_type) for r in more.orderBy("date_id").collect()] == [
        (8, 2, "2024-Q1", "Spring", "Weekend"),
        (9, 3, "2024-Q1", "Spring", "Weekend"),
    ]


def test_watermark_of_an_empty_target(spark):
    empty = spark.createDataFrame([], "id INT, day DATE")
    assert loading.read_watermark(empty, "id", 0) == 0
    assert loading.read_watermark(empty, "day", dt.date(2020, 1, 1)) == dt.date(2020, 1, 1)


def test_load_if_empty(spark):
    source = spark.range(3)
    assert loading.load_if_empty(source, source.limit(0)).count() == 3
    assert loading.load_if_empty(source, spark.range(1)).count() == 0


def test_conform(spark):
    got = loading.conform_to_schema(
        spark.createDataFrame([("7", 1.5)], "thing_id STRING, name STRING"),
        schemas.warehouse_schema("thing_dim"),
        {"name": "group_name"},
    )
    assert got.schema == schemas.warehouse_schema("thing_dim")
    row = got.first()
    assert (row.thing_id, row.group_name, row.type_id) == (7, "1.5", None)


def test_upsert_is_idempotent(spark, tmp_path):
    schema = "k INT, t INT, v STRING"
    table = tables.KeyedTable(str(tmp_path / "t"), ["k"], ["t"])
    first = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 5, "c")], schema)
    second = spark.createDataFrame([(2, 4, "old"), (3, 1, "d"), (1, 2, "again")], schema)
    for _ in range(2):
        table.upsert(first, 0)
        table.upsert(second, 1)
    kind = first.schema
    expected = {1: "again", 2: "c", 3: "d"}
    assert {r.k: r.v for r in table.read(spark, kind).collect()} == expected
    assert {r.k: r.v for r in table.read(spark, kind, before=1).collect()} == {1: "b", 2: "c"}


def test_upserts_over_many_batches(spark, tmp_path):
    table = tables.KeyedTable(str(tmp_path / "t"), ["k"], ["t"], full_every=3)
    schema = "k INT, t INT, v INT"
    expected = {}
    for n in range(8):
        rows = [(n % 3, n, n), (10 + n, n, n), (99, -n, n)]
        for _ in range(2 if n in (3, 5) else 1):  # a repeated batch changes nothing
            table.upsert(spark.createDataFrame(rows, schema), n)
        before = {r.k: r.v for r in table.read(spark, spark.createDataFrame([], schema).schema, n).collect()}
        assert before == expected
        expected |= {n % 3: n, 10 + n: n}
        expected.setdefault(99, 0)
    got = table.read(spark, spark.createDataFrame([], schema).schema)
    assert {r.k: r.v for r in got.collect()} == expected
    folders = sorted(p.name for p in (tmp_path / "t" / "full").iterdir())
    assert folders == ["batch_id=0", "batch_id=3", "batch_id=6"]


def test_a_reader_keeps_its_version(spark, tmp_path):
    table = tables.KeyedTable(str(tmp_path / "t"), ["k"], ["t"], full_every=2)
    schema = "k INT, t INT, v INT"
    kind = spark.createDataFrame([], schema).schema
    assert table.version(spark) is None and table.read(spark, kind).count() == 0
    for n in range(2):
        table.upsert(spark.createDataFrame([(1, n, n)], schema), n)
    held = table.read(spark, kind)
    # A batch that broke off before its commit: its folders are there, the table does not have them.
    for kept in ("changes", "full"):
        spark.createDataFrame([(1, 9, 9)], schema).write.parquet(f"{table.path}/{kept}/batch_id=2")
    assert table.version(spark) == 1 and [r.v for r in table.read(spark, kind).collect()] == [1]
    table.upsert(spark.createDataFrame([(1, 2, 2)], schema), 2)
    table.upsert(spark.createDataFrame([(1, 3, 33)], schema), 2)  # committed already
    assert [r.v for r in held.collect()] == [1]
    assert table.version(spark) == 2 and [r.v for r in table.read(spark, kind).collect()] == [2]


def test_old_versions_go(spark, tmp_path):
    table = tables.KeyedTable(str(tmp_path / "t"), ["k"], ["t"], full_every=3, keep_hours=0)
    schema = "k INT, t INT, v INT"
    kind = spark.createDataFrame([], schema).schema
    for n in range(13):
        table.upsert(spark.createDataFrame([(n % 2, n, n)], schema), n)
        assert len(list((tmp_path / "t" / "full").iterdir())) <= 2
        assert len(list((tmp_path / "t" / "changes").iterdir())) <= 7
        assert {r.k: r.v for r in table.read(spark, kind).collect()} == {m % 2: m for m in (n - 1, n) if m >= 0}
    assert {r.k: r.v for r in table.read(spark, kind, before=12).collect()} == {1: 11, 0: 10}


def test_table_replace_append_insert(spark, tmp_path):
    path, schema = str(tmp_path / "dim"), schemas.warehouse_schema("event_dim")
    tables.insert_rows(spark, [(1, "speeding")], schema, path)
    tables.insert_rows(spark, [(2, "fuel")], schema, path)
    assert tables.static_table_read(spark, path, schema).count() == 2
    tables.table_replace(spark.createDataFrame([("3", "x")], "event_id STRING, event_designation STRING"), path, schema)
    assert [tuple(r) for r in tables.static_table_read(spark, path).collect()] == [(3, "x")]


def test_replace_one_day_only(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = lambda *r: spark.createDataFrame(list(r), "v INT, day INT")
    tables.table_replace(rows((1, 1), (2, 2)), path, partition_by=("day",))
    tables.table_replace(rows((9, 2)), path, partition_by=("day",))
    assert sorted((r.v, r.day) for r in spark.read.parquet(path).collect()) == [(1, 1), (9, 2)]


def test_csv_rejects(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text('a,b,c\n1,x,2.5\n2,"y, with\nbreak",3.5\n3,short\n4,long,1.0,extra\n5,"say ""hi""",4.5\n')
    from pyspark.sql.types import StructType

    good, bad = files.csv_load_reject_bad(spark, str(path), StructType.fromDDL("a INT, b STRING, c DOUBLE"))
    assert [tuple(r) for r in good.orderBy("a").collect()] == [(1, "x", 2.5), (2, "y, with\nbreak", 3.5), (5, 'say "hi"', 4.5)]
    assert sorted(r[files.REJECT] for r in bad.collect()) == ["3,short", "4,long,1.0,extra"]
    assert files.wide_table_column_count(good) == 3
    inferred = files.csv_read_inferred(spark, str(path))
    assert dict(inferred.dtypes)["b"] == "string"


def test_gazetteer_file(spark, tmp_path):
    path = tmp_path / "places.json"
    path.write_text(
        """[{"place_id": 1, "lat": "36.5", "lon": "3.1", "name": "Town", "display_name": "Town, State, Land",
        "boundingbox": ["36.0", "37.0", "3.0", "3.5"], "geojson": {"type": "Point", "coordinates": [3.1, 36.5]}},
        {"place_id": 2, "lat": "1.0", "lon": "2.0", "name": "P", "display_name": "P, S, L",
        "boundingbox": ["0.0", "2.0", "1.0", "3.0"],
        "geojson": {"type": "Polygon", "coordinates": [[[1.0, 0.0], [3.0, 2.0], [1.0, 2.0]]]}}]"""
    )
    records = files.gazetteer_load(spark, str(path))
    first = records.orderBy("place_id").first()
    assert (first.lat, first.south, first.north, first.west, first.east) == (36.5, 36.0, 37.0, 3.0, 3.5)
    assert '"Point"' in first.geojson
    boxes = files.places_from_gazetteer(records)
    point = spark.createDataFrame([(36.2, 3.2)], "latitude DOUBLE, longitude DOUBLE")
    row = place_lookup(point, boxes).first()
    assert (row.town, row.state, row.country) == ("Town", "State", "Land")


def test_places_of_mixed_size(spark):
    rng = random.Random(1)
    boxes = []
    for k in range(60):
        size = 10 ** rng.uniform(-2, 1.5)
        south, west = rng.uniform(-60, 60), rng.uniform(-170, 170)
        boxes.append((south, south + size, west, west + size * rng.uniform(0.3, 3), f"t{k}", f"s{k}", "c"))
    points = [(n, rng.uniform(-60, 60), rng.uniform(-170, 170)) for n in range(300)]
    points += [(300 + n, b[0], b[2]) for n, b in enumerate(boxes)]
    points += [(400 + n, b[1], b[2]) for n, b in enumerate(boxes)] + [(999, None, 3.0)]
    got = place_lookup(
        spark.createDataFrame(points, "id INT, latitude DOUBLE, longitude DOUBLE"),
        spark.createDataFrame(
            boxes, "south DOUBLE, north DOUBLE, west DOUBLE, east DOUBLE, town STRING, state STRING, country STRING"
        ),
    )
    assert got.columns == ["id", "latitude", "longitude", "town", "state", "country"]
    found = {r.id: r.town for r in got.collect()}
    for n, lat, lon in points:
        inside = [b for b in boxes if lat is not None and b[0] <= lat < b[1] and b[2] <= lon < b[3]]
        best = min(inside, key=lambda b: (b[1] - b[0]) * (b[3] - b[2]))[4] if inside else "default"
        assert found[n] == best


def smallest(boxes, lat, lon):
    inside = [b for b in boxes if lat is not None and b[0] <= lat < b[1] and b[2] <= lon < b[3]]
    return min(inside, key=lambda b: ((b[1] - b[0]) * (b[3] - b[2]), *b))[4] if inside else "default"


BOX = "south DOUBLE, north DOUBLE, west DOUBLE, east DOUBLE, town STRING, state STRING, country STRING"


def town_of_boxes(n, seed=3, widest=-1.3):
    """Overlapping boxes of many sizes, all within a tenth of a degree."""
    rng = random.Random(seed)
    boxes = []
    for k in range(n):
        size = 10 ** rng.uniform(-4.5, widest)
        south, west = 36.5 + rng.random() / 10, 3.0 + rng.random() / 10
        boxes.append((south, south + size, west, west + size * rng.uniform(0.5, 2), f"t{k:05d}", "s", "c"))
    return boxes + [(0.0, 50.0, -20.0, 40.0, "land", "s", "c"), (36.0, 37.0, 3.0, 4.0, "cell", "s", "c"), (36.0, 37.0, 3.0, 4.0, "a", "s", "c")]


@pytest.mark.parametrize("local", [True, False], ids=["driver", "tasks"])
def test_places_in_a_dense_town(spark, monkeypatch, local):
    boxes = town_of_boxes(2000) + [boxes_like for boxes_like in town_of_boxes(5, seed=9) * 20]
    rng = random.Random(4)
    points = [(n, 36.45 + rng.random() / 5, 2.95 + rng.random() / 5) for n in range(400)]
    points += [(1000 + n, b[0], b[2]) for n, b in enumerate(boxes[:150])] + [(2000 + n, b[1], b[3]) for n, b in enumerate(boxes[:150])]
    points += [(9000, None, 3.0), (9001, float("nan"), 3.0), (9002, 89.0, 179.0)]
    odd = [(1.0, 1.0, 0.0, 5.0, "flat", "s", "c"), (None, 1.0, 0.0, 5.0, "open", "s", "c"), (5.0, 4.0, 0.0, 5.0, "turned", "s", "c")]
    if not local:
        monkeypatch.setattr(places, "LOCAL_BOXES", 10)
    found = place_lookup(
        spark.createDataFrame(points, "id INT, latitude DOUBLE, longitude DOUBLE"), spark.createDataFrame(boxes + odd, BOX), most=8
    )
    assert {r.id: r.town for r in found.collect()} == {n: smallest(boxes, lat, lon) for n, lat, lon in points}


def test_cells_of_a_very_dense_town_stay_short(spark):
    boxes = spark.createDataFrame(town_of_boxes(20_000, widest=-2.5), BOX)
    cells, levels = places.quadtree(boxes)
    assert cells.agg(F.max(F.size("_boxes"))).first()[0] <= places.CELL_BOXES
    assert max(levels) < places.MAX_LEVEL
    # No two cells overlap: a point has one at most.
    point = spark.createDataFrame([(36.55, 3.05)], "latitude DOUBLE, longitude DOUBLE")
    assert place_lookup(point, boxes).count() == 1


def test_gazetteer_view_has_boxes_that_overlap(spark):
    inputs = Inputs(spark, "/root/testdata/sf0.01")
    boxes = [tuple(b) for b in inputs.gazetteer.collect()]
    assert len(boxes) == 30
    points = inputs.alert_src.select("alert_id", "latitude", "longitude")
    found = place_lookup(points, inputs.gazetteer).collect()
    held = [sum(b[0] <= r.latitude < b[1] and b[2] <= r.longitude < b[3] for b in boxes) for r in found]
    assert {0, 1, 2, 3} <= set(held)
    for r in found:
        assert r.town == smallest(boxes, r.latitude, r.longitude)


THINGS = [(1, 10, 100), (2, 10, 200), (3, 20, 100)]


@pytest.fixture
def kpi_frames(spark):
    days = dims.date_dim(
        spark.createDataFrame([(dt.date(2023, 1, 30),), (dt.date(2024, 1, 29),), (dt.date(2024, 1, 30),)], "d DATE"), "d"
    )
    fact = spark.createDataFrame(
        [(t, d, 1.0, 2.0, 10.0 * t, 5.0, 9.0, 1.0) for t in (1, 2, 3, 4) for d in (1, 2)],
        "thing_id INT, date_id INT, idle_time DOUBLE, active_time DOUBLE, traveled_distance DOUBLE, "
        "avg_speed DOUBLE, max_speed DOUBLE, fuel DOUBLE",
    )
    things = spark.createDataFrame(THINGS, "thing_id INT, group_id INT, type_id INT")
    live = spark.createDataFrame(
        [(t, dt.date(2024, 1, 30), 3600, 7200, 1.0, 7.0, 8.0, 1.0) for t in (1, 3)],
        "thing_id INT, full_date DATE, idle_time BIGINT, active_time BIGINT, traveled_distance DOUBLE, "
        "avg_speed DOUBLE, max_speed DOUBLE, fuel DOUBLE",
    )
    return fact, days, things, live


def test_kpi_filters_and_precedence(kpi_frames):
    fact, days, things, _ = kpi_frames
    total = lambda **f: kpi.kpi("distance", "month", fact, days, things, year=2024, **f).first().traveled_distance
    assert total() == 60.0  # vehicle 4 is unknown
    assert total(thing_id=3, group_id=10, type_id=200) == 30.0
    assert total(group_id=10, type_id=100) == 30.0
    assert total(type_id=100) == 40.0


def test_live_rows_only_in_the_current_month_of_the_year(kpi_frames):
    fact, days, things, live = kpi_frames
    as_of = dt.date(2024, 1, 30)
    report = lambda year, **f: {
        r.full_date: (r.idle_time, r.active_time)
        for r in kpi.kpi("time", "day", fact, days, things, year=year, month=1, live=live, as_of=as_of, **f).collect()
    }
    assert report(2024) == {dt.date(2024, 1, 29): (3.0, 6.0), as_of: (2.0, 4.0)}
    assert report(2024, type_id=100) == {dt.date(2024, 1, 29): (2.0, 4.0), as_of: (2.0, 4.0)}
    assert report(2024, group_id=20)[as_of] == (1.0, 2.0)
    assert report(2023) == {dt.date(2023, 1, 30): (3.0, 6.0)}


def test_kpi_needs_its_period(kpi_frames):
    fact, days, things, _ = kpi_frames
    with pytest.raises(ValueError):
        kpi.kpi("distance", "day", fact, days, things, year=2024)


def test_pages_overlap_by_five(spark):
    things = spark.createDataFrame(
        [(k, f"n{k}", f"p{k}") for k in range(40)], "thing_id INT, thing_designation STRING, thing_plate STRING"
    )
    page = lambda n: [r.thing_id for r in serving.things_page(things, n).collect()]
    assert page(1) == list(range(15)) and page(2) == list(range(10, 25))


@pytest.mark.parametrize("near", [serving.NEAR_ROWS, 0])
def test_journeys_by_number_and_one_after_the_other(spark, monkeypatch, near):
    monkeypatch.setattr(serving, "NEAR_ROWS", near)
    monkeypatch.setattr(scaling, "SMALL_ROWS", near)
    start = lambda k: None if k > 20 else START + dt.timedelta(minutes=k // 3)
    fact = [(k, 1 + k % 4, 5.0, 50.0, 90.0, 1) for k in range(24)]
    dim = [(k, "a", "b", start(k), START, part, f"p{k}-{part}") for k in range(24) for part in range(1 + k % 2)]
    # An equal journey under another id is shown once.
    fact.append((90, 1 + 8 % 4, 5.0, 50.0, 90.0, 1))
    dim.append((90, "a", "b", start(8), START, 0, "p8-0"))
    frames = [
        spark.createDataFrame(fact, "journey_id LONG, thing_id INT, active_time DOUBLE, avg_speed DOUBLE, max_speed DOUBLE, date_id INT"),
        spark.createDataFrame(dim, "journey_id LONG, start_point STRING, end_point STRING, start_time TIMESTAMP, end_time TIMESTAMP, part LONG, path STRING"),
        spark.createDataFrame([(k, k % 2, 1) for k in range(1, 5)], "thing_id INT, group_id LONG, type_id INT"),
        spark.createDataFrame([(1, 2024)], "date_id INT, year INT"),
    ]
    known = sorted(range(24), key=lambda k: (start(k) is None, -(k // 3) if start(k) else 0, k))
    expected = [f"p{k}-{part}" for k in known for part in range(1 + k % 2)]
    numbered = [[r.path for r in serving.journeys_page(*frames, number=n, size=7).collect()] for n in range(1, 6)]
    assert sum(numbered, []) == expected and numbered[4] == []
    after, walked = None, []
    for n in range(4):
        rows = serving.journeys_after(*frames, after=after, size=7).collect()
        assert [r.path for r in rows] == numbered[n]
        after = (rows[-1].start_time, rows[-1].journey_id)
        walked += rows
    assert serving.journeys_after(*frames, after=after, size=7).count() == 0
    assert {r.journey_id for r in serving.journeys_after(*frames, size=50, group_id=1).collect()} == set(range(0, 24, 2))


def test_thing_and_user_dim_have_the_declared_columns(spark):
    thing = spark.createDataFrame(
        [(1, "car", "P1", "S1", 5, 2, 3, "mark", "firm"), (2, "van", "P2", "S2", 5, 2, 3, None, "firm")],
        "thing_id INT, thing_designation STRING, thing_matricule STRING, thing_serial_number STRING, entreprise_id INT,"
        "thing_group_id INT, thing_type_id INT, thing_marque_id STRING, company_name STRING",
    )
    types = spark.createDataFrame([(3, "truck")], "thing_type_id INT, thing_type_designation STRING")
    groups = spark.createDataFrame([(2, "north")], "thing_group_id INT, thing_group_designation STRING")
    got = dims.thing_dim(thing, types, groups, after_id=1)
    assert got.schema == schemas.warehouse_schema("thing_dim")
    assert [tuple(r) for r in got.collect()] == [(2, "truck", "van", "P2", "S2", 5, "firm", 2, 3, None, "north")]
    users = dims.user_dim(spark.createDataFrame([(1, "ann")], "id INT, name STRING"))
    assert users.schema == schemas.warehouse_schema("user_dim") and tuple(users.first()) == (1, "ann", None, None)


def test_maintenance(spark):
    rows = spark.createDataFrame(
        [(1, 5, "car5", "Soon", START), (2, 6, "car6", "done", START), (3, 7, "car7", None, START)],
        "id INT, thing_id INT, name STRING, maintenance STRING, maintenance_date TIMESTAMP",
    )
    assert [r.thing_id for r in serving.maintenance_open(rows).collect()] == [5]
    added = serving.maintenance_add(serving.maintenance_mark_done(rows, 5), 8, START)
    assert [r.thing_id for r in serving.maintenance_open(added).collect()] == [8]


def test_metrics_without_positives(spark):
    frame = spark.createDataFrame([(0, 0)] * 3, "label INT, prediction INT")
    row = features.classification_metrics(frame).first()
    assert (row.accuracy, row.precision, row.recall, row.tn) == (1.0, 0.0, 0.0, 3)


def test_repeated_maximum(spark):
    rows = spark.createDataFrame(
        [(1, START, "a", 5.0), (1, START, "b", 9.0), (2, START, "c", 9.0), (2, START, "d", None)],
        "thing_id INT, date_insertion TIMESTAMP, trace_id STRING, total_km DOUBLE",
    )
    assert sorted(r.trace_id for r in features.drop_repeated_max(rows).collect()) == ["a", "b"]


def test_imputed_ranges(spark, slicing):
    rows = [(1, START + dt.timedelta(minutes=k), f"{k:04d}", None, None) for k in range(100)]
    frame = spark.createDataFrame(
        rows, "thing_id INT, date_insertion TIMESTAMP, trace_id STRING, oil_value DOUBLE, fuel_liters DOUBLE"
    )
    for r in features.banded_impute(frame).collect():
        band = sum(r.row_num > share * 100 for share in (0.6, 0.8, 0.9))
        low, high = features.OIL_RANGES[band]
        assert low <= r.oil_value <= high
        low, high = features.FUEL_CHANGE_RANGES[band]
        assert low <= r.fuel_change <= high
        assert 0 <= r.fuel_liters <= 60


class Recorder:
    """Stands in for a reader or writer and keeps the options it is given."""

    def __init__(self):
        self.seen = {}

    def format(self, kind):
        self.seen["format"] = kind
        return self

    def mode(self, mode):
        self.seen["mode"] = mode
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **values):
        self.seen |= values
        return self

    def load(self):
        return self.seen

    def save(self):
        self.saved = self.seen


class FakeSession:
    def __init__(self):
        self.read = Recorder()


def test_jdbc_options():
    plain = jdbc.jdbc_read_query(FakeSession(), "jdbc:x", "drv", query="SELECT 1 AS a", user="u")
    assert (plain["format"], plain["query"], plain["user"]) == ("jdbc", "SELECT 1 AS a", "u")
    split = jdbc.jdbc_read_query(
        FakeSession(), "jdbc:x", "drv", query="SELECT a FROM t", split_by="a", bounds=(1, 9), partitions=4
    )
    assert split["dbtable"] == "(SELECT a FROM t) AS q"
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("a", "1", "9", 4)
    with pytest.raises(ValueError):
        jdbc.jdbc_read_query(FakeSession(), "jdbc:x", "drv")

    class Frame:
        write = Recorder()

    jdbc.jdbc_write_append(Frame(), "jdbc:x", "drv", "t", partitions=3)
    assert Frame.write.saved["mode"] == "append" and Frame.write.saved["dbtable"] == "t"


def test_fuel_and_caps(spark):
    frame = spark.createDataFrame(
        [(1, 1, 150.0, 250.0, 90.0), (1, 2, None, 100.0, 210.0)],
        "thing_id INT, date_id INT, traveled_distance DOUBLE, max_speed DOUBLE, avg_speed DOUBLE",
    )
    fuel = [r.fuel for r in facts.fuel_backfill(frame).orderBy("date_id").collect()]
    assert 9 <= fuel[0] <= 12 and 3 <= fuel[1] <= 7
    capped = facts.speed_cap_repair(frame).orderBy("date_id").collect()
    assert [(r.max_speed, r.avg_speed) for r in capped] == [(120.0, 90.0), (100.0, 80.0)]


def test_top_rows_per_vehicle(spark):
    frame = spark.range(1000).select(
        (F.col("id") % 2).cast("int").alias("thing_id"),
        F.timestamp_seconds("id").alias("trace_date"),
        F.col("id").cast("string").alias("trace_id"),
        F.col("id").cast("double").alias("battery"),
    )
    got = serving.sensor_history(frame, "battery").groupBy("thing_id").agg(F.min("battery"), F.count("*")).collect()
    assert sorted(tuple(r) for r in got) == [(0, 800.0, 100), (1, 801.0, 100)]
    one = serving.sensor_history(frame, "battery", thing_id=1, limit=3).collect()
    assert [(r.battery, r.label) for r in one] == [(999.0, "16:39"), (997.0, "16:37"), (995.0, "16:35")]
