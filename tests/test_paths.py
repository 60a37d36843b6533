"""Path text and the greedy filters, against a plain loop."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadspan.operators import paths

POINTS = "path_id INT, seq BIGINT, latitude DOUBLE, longitude DOUBLE"


def km(a, b):
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def greedy(points, keep):
    kept = points[:1]
    for p in points[1:]:
        if keep(km(kept[-1][1:], p[1:])):
            kept.append(p)
    return kept


def walk(seed, n):
    rng = random.Random(seed)
    lat, lon, out = 36.5, 3.0, []
    for k in range(n):
        jump = 0.02 if rng.random() < 0.1 else 0.0001
        lat, lon = lat + rng.uniform(-jump, jump), lon + rng.uniform(-jump, jump)
        out.append((k, lat, lon))
    return out


@pytest.mark.parametrize("per_part", [10, 512])
def test_filters_do_not_depend_on_the_parts(spark, per_part):
    walks = {1: walk(1, 200), 2: walk(2, 3), 3: walk(3, 77)}
    frame = spark.createDataFrame([(p, *q) for p, qs in walks.items() for q in qs], POINTS)
    dense = paths.filter_dense_clusters(frame, points_per_part=per_part)
    expected = {p: greedy(qs, lambda d: d >= 0.01) for p, qs in walks.items()}
    assert seqs(dense) == {p: [q[0] for q in qs] for p, qs in expected.items()}
    jumps = paths.filter_large_jumps(dense, points_per_part=per_part)
    expected = {p: greedy(qs, lambda d: d <= 1.0) for p, qs in expected.items()}
    assert seqs(jumps) == {p: [q[0] for q in qs] for p, qs in expected.items()}
    for p, qs in expected.items():
        gaps = [km(a[1:], b[1:]) for a, b in zip(qs, qs[1:], strict=False)]
        assert all(g <= 1.0 for g in gaps), p


def seqs(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.path_id, r.seq)):
        out.setdefault(r.path_id, []).append(r.seq)
    return out


def test_a_standing_vehicle_keeps_one_point(spark):
    frame = spark.createDataFrame([(1, k, 36.5, 3.0) for k in range(400)], POINTS)
    assert seqs(paths.filter_dense_clusters(frame, points_per_part=4)) == {1: [0]}


def test_a_start_far_away_holds_back_everything(spark):
    """The worst case: the first point decides over every later part."""
    frame = spark.createDataFrame([(1, 0, 0.0, 0.0)] + [(1, k, 36.5, 3.0) for k in range(1, 400)], POINTS)
    assert seqs(paths.filter_large_jumps(frame, points_per_part=2)) == {1: [0]}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.floats(-90, 90, allow_nan=False), st.floats(-180, 180, allow_nan=False)), min_size=1, max_size=20
    )
)
def test_text_round_trip(spark, points):
    frame = spark.createDataFrame([(points,)], "p ARRAY<STRUCT<lat: DOUBLE, lon: DOUBLE>>")
    back = frame.select(paths.parse_path(paths.format_path(F.col("p"))).alias("q")).first().q
    assert [(r.lat, r.lon) for r in back] == points


def test_clean_keeps_what_does_not_parse(spark):
    texts = [
        (1, 0, "36.0,3.0;36.0,3.0;36.001,3.0;50.0,3.0"),
        (2, 0, "36.0,3.0;oops"),
        (3, 0, ""),
        (4, 0, "1.0,1.0"),
    ]
    got = paths.path_clean(spark.createDataFrame(texts, "path_id INT, part BIGINT, path STRING")).collect()
    assert {r.path_id: r.path for r in got} == {
        1: "36.0,3.0;36.001,3.0",
        2: "36.0,3.0;oops",
        3: "",
        4: "1.0,1.0",
    }


def test_clean_of_many_parts_and_of_one_long_text_agree(spark):
    points = [(36.0 + k * 0.00003, 3.0) for k in range(60)]
    text = lambda qs: ";".join(f"{a},{b}" for a, b in qs)
    schema = "path_id INT, part BIGINT, path STRING"
    one = spark.createDataFrame([(1, 0, text(points))], schema)
    many = spark.createDataFrame([(1, k, text(points[k * 7 : k * 7 + 7])) for k in range(9)], schema)
    expected = [(a, b) for _, a, b in greedy([(k, *p) for k, p in enumerate(points)], lambda d: d >= 0.01)]
    for frame in (one, many):
        parts = paths.path_clean(frame, points_per_part=7).orderBy("part").collect()
        assert ";".join(r.path for r in parts) == text(expected)
