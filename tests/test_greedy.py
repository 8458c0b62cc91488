"""Order-dependent geometry, tested on small cases and by invariants."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.operators import columns as C
from quire.operators import greedy as G
from quire.operators.columns import Box

SCHEMA = "page bigint, id bigint, l double, t double, r double, b double, score double"


def boxes(spark, *rows):
    return spark.createDataFrame([(r[0], r[1], *map(float, r[2:6]), float(r[6] if len(r) > 6 else 0)) for r in rows], SCHEMA)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_drop_contained(spark):
    b = boxes(spark, (1, 1, 0, 0, 50, 50), (1, 2, 10, 10, 20, 20), (1, 3, 45, 45, 60, 60), (2, 4, 10, 10, 20, 20), (1, 5, 0, 0, 50, 50))
    assert ids(G.drop_contained(b, "page", "id")) == [1, 3, 4]


def test_suppress(spark):
    b = boxes(spark, (1, 1, 0, 0, 10, 10, 0.5), (1, 2, 1, 1, 11, 11, 0.9), (1, 3, 30, 30, 40, 40, 0.1))
    assert ids(G.suppress(b, "page", "id", "score")) == [2, 3]


def test_absorb_and_clip(spark):
    b = boxes(spark, (1, 1, 0, 0, 50, 50), (1, 2, 10, 10, 20, 20), (1, 3, 12, 12, 15, 15), (2, 9, 0, 0, 1, 1))
    assert {r["id"]: r["into"] for r in G.absorb(b, "page", "id").collect()} == {1: None, 2: 1, 3: 1, 9: None}
    c = boxes(spark, (1, 1, 0, 0, 50, 50), (1, 2, 10, 30, 20, 60), (1, 3, 60, 10, 70, 20))
    assert {r["id"]: r["b"] for r in G.clip_overlaps(c, "page", "id").collect()} == {1: 30.0, 2: 60.0, 3: 20.0}


def test_merge_fragments(spark):
    b = boxes(spark, (1, 1, 0, 10, 10, 11), (1, 2, 11, 10.2, 20, 11), (1, 3, 40, 10, 50, 11), (1, 4, 0, 20, 5, 21))
    assert sorted((r["id"], r["r"], r["n"]) for r in G.merge_fragments(b, "page", "id").collect()) == [(1, 20.0, 2), (3, 50.0, 1), (4, 5.0, 1)]


def test_resolve_crossings(spark):
    b = boxes(spark, (1, 1, 0, 0, 20, 20, 9), (1, 2, 10, 10, 30, 30, 5), (1, 3, 25, 25, 45, 45, 9), (1, 4, 26, 26, 30, 30, 1))
    assert ids(G.resolve_crossings(b, "page", "id", "score")) == [1, 3, 4]


def test_seed_groups_compare_with_the_seed(spark):
    b = boxes(spark, (1, 1, 0, 0, 1, 1), (1, 2, 2.5, 0, 3, 1), (1, 3, 5, 0, 6, 1))
    assert {r["id"]: r["group"] for r in G.seed_groups(b, "page", "id").collect()} == {1: 0, 2: 0, 3: 1}


def area(polygon):
    p = np.array(polygon)
    return abs(float((p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]).sum())) / 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.builds(lambda x, y, w, h: (x, y, x + w, y + h), *[st.integers(0, 7)] * 2, *[st.integers(1, 8)] * 2), min_size=1, max_size=5))
def test_outline_covers_the_union(rects):
    shape = G.union_outline(np.array(rects, dtype=float))
    cells = {(x, y) for a, b, c, d in rects for x in range(a, c) for y in range(b, d)}
    if shape:
        assert shape[0] == shape[-1] and area(shape) == len(cells)
    else:
        assert len(rects) > 1


def test_outline_refuses_parts_and_holes():
    ring = [[0, 0, 9, 3], [0, 6, 9, 9], [0, 0, 3, 9], [6, 0, 9, 9]]
    assert G.union_outline(np.array(ring, dtype=float)) is None
    assert G.union_outline(np.array([[0, 0, 1, 1], [5, 5, 6, 6]], dtype=float)) is None
    assert area(G.union_outline(np.array([[0, 0, 4, 2], [0, 2, 2, 4]], dtype=float))) == 12


def test_lattice(spark):
    b = spark.createDataFrame([(1, 3.0 + 12.5 * k) for k in range(7)], "page bigint, l double")
    r = G.lattice(b, "page", "l").first()
    assert r["score"] == 1.0 and (r["pitch"] == 12.5 or 12.5 % r["pitch"] < 1)


def test_components_and_period(spark):
    cells = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (1, 5, 5), (2, 0, 0)], "page bigint, x int, y int")
    assert sorted((r["page"], r["n"]) for r in G.flood_components(cells, "page", "x", "y").collect()) == [(1, 1), (1, 2), (2, 1)]
    wave = spark.createDataFrame([(1, k, float(np.cos(2 * np.pi * k / 9))) for k in range(90)] + [(2, 0, 1.0)], "k bigint, at bigint, v double")
    got = {r["k"]: r["lag"] for r in G.first_peak(wave, "k", "at", "v", low=2, high=40).collect()}
    assert got == {1: 9, 2: None}
    assert {r["k"]: r["lag"] for r in G.first_peak(wave, "k", "at", "v").collect()} == {1: 18, 2: None}  # lags from 10 on
    flat = spark.createDataFrame([(1, k, float(0.02 * np.cos(2 * np.pi * k / 13) + (k % 2))) for k in range(400)], "k bigint, at bigint, v double")
    assert G.first_peak(flat, "k", "at", "v").first()["lag"] == 12  # the strong period of two, not the faint one of 13


def test_join_slices(spark):
    rows = [(1, 0, "one\ntwo and the words that repeat here"), (1, 1, "words that repeat here and go on\nthree"), (1, 2, None), (2, 0, "a"), (2, 1, "b")]
    got = {r["k"]: (r["joined"], r["merged"]) for r in G.join_slices(spark.createDataFrame(rows, "k bigint, o bigint, x string"), "k", "o", "x").collect()}
    assert got == {1: ("one\ntwo and the words that repeat here and go on\nthree\n", 1), 2: ("a\nb", 0)}


@pytest.mark.parametrize(("inset", "points", "left"), [((0, 0, 100, 40), 5, 6000), ((0, 0, 30, 100), 5, 7000), ((0, 0, 30, 40), 7, 8800), ((70, 60, 100, 100), 7, 8800), ((0, 20, 30, 40), 9, 9400), ((20, 0, 40, 30), 9, 9400)])
def test_remainder_polygons(spark, inset, points, left):
    outer, inner = Box(*(F.lit(float(x)) for x in (0, 0, 100, 100))), Box(*(F.lit(float(x)) for x in inset))
    shape = spark.range(1).select(C.remainder_polygon(outer, inner).alias("p")).first()["p"]
    assert len(shape) == points and area(shape) == left
