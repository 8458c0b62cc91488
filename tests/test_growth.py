"""Steps whose memory or work must not grow faster than the tables."""

import numpy as np
from quire.operators import greedy as G
from quire.operators import relations
from quire.operators import similarity as S
from quire.plans import CATALOG
from quire.sources import hocr, scratch


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_survivors_need_no_join(spark, sf):
    plan = _plan(CATALOG["survivors"].run(spark, sf))
    assert "Join" not in plan and "Aggregate" in plan


def test_hocr_documents_are_parsed_once(spark, sf):
    assert _plan(CATALOG["hocr_relations"].run(spark, sf)).count("MapInArrow") == 1


def test_hocr_blocks_need_no_join(spark, sf):
    plan = _plan(CATALOG["hocr_blocks"].run(spark, sf))
    assert "Join" not in plan and "xpath" not in plan


def test_words_without_text_keep_the_others_in_place(spark):
    word = "<span class='ocrx_word' title='bbox {} 1 {} 2; x_wconf {}'>{}</span>"
    page = "<html><div class='ocr_carea' title='bbox 0 0 5 5'/><div class='ocr_carea' title='image; bbox 6 0 9 5'/>" + word.format(1, 2, 10, "") + word.format(7, 8, 21, "b") + word.format(7, 8, 20, "c") + "</html>"
    got = hocr.blocks(spark.createDataFrame([(1, page), (2, None)], "page bigint, html string"), "page", "html").orderBy("block").collect()
    assert [(r["block"], r["l"], r["text"], r["n_words"], r["confidence"]) for r in got] == [(0, 0.0, "", 0, 10.0), (1, 6.0, "b c", 2, 20.5)]


def test_outlines_of_many_items_at_once():
    rng = np.random.default_rng(3)
    items = [np.stack([x := rng.integers(0, 6, (k, 2)), x + rng.integers(1, 4, (k, 2))], axis=1).reshape(k, 4).astype(float) for k in rng.integers(0, 6, 400)]
    points, sizes = G.union_outlines(np.concatenate(items), np.concatenate([[0], np.cumsum([len(x) for x in items])]))
    assert 50 < (sizes > 0).sum() < 400
    for rects, shape in zip(items, np.split(points, np.cumsum(sizes)[:-1]), strict=True):
        cells = {(x, y) for l, t, r, b in rects.astype(int) for x in range(l, r) for y in range(t, b)}
        if len(shape):  # a closed outline holds all cells and, having no hole, no others
            x, y = shape.T
            assert (shape[0] == shape[-1]).all() and abs((x[:-1] * y[1:] - x[1:] * y[:-1]).sum()) == 2 * len(cells)


def test_lattices_of_large_and_small_pages(spark):
    rows = [(1, 5.0 + 10 * (k % 9)) for k in range(9000)] + [(p, 3.0 + 12.5 * k) for p in range(2, 40) for k in range(6)]
    got = {r["page"]: (r["pitch"], r["score"], r["n"]) for r in G.lattice(spark.createDataFrame(rows, "page bigint, l double"), "page", "l").collect()}
    assert got[1] == (10.0, 1.0, 9000) and all(got[p] == (12.5, 1.0, 6) for p in range(2, 40))


def test_copies_of_vectors_share_one_comparison(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 16))
    vectors = [(k, base[k % 30].tolist()) for k in range(300)] + [(1000 + k, (base[k] + 0.02 * rng.normal(size=16)).tolist()) for k in range(30)] + [(2000, [0.0] * 16), (2001, None)]
    df = spark.createDataFrame(vectors, "id bigint, v array<double>")
    assert S._classes(df, "id", "v").where("id = rep").count() == 60
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in vectors if i < 2000}
    want = {(a, b) for a in unit for b in unit if a < b and unit[a] @ unit[b] >= 0.9}
    got = [(r["id_a"], r["id_b"]) for r in S.similar_pairs(df, "id", "v", 0.9).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    exact = [(r["id_a"], r["id_b"]) for r in S.similar_pairs(df, "id", "v", 0.9, recall=1).collect()]
    assert sorted(exact) == sorted(got)


def test_codes_drop_no_pair_at_the_threshold():
    rng = np.random.default_rng(6)
    v = rng.normal(size=(400, 24)) + 1.5
    v /= np.linalg.norm(v, axis=1)[:, None]
    scale = np.abs(v).max(axis=1) / 127
    codes = np.rint(v / scale[:, None])
    slack = np.sqrt(((v - codes * scale[:, None]) ** 2).sum(axis=1)) + 1e-6
    starts = np.array([0, 50, 90, 400])  # small groups and a large one
    got = [(i, j) for a, b in S._near(codes.astype(np.float32), scale, slack, starts, 0.8) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
    want = {(i, j) for a, b in zip(starts[:-1], starts[1:], strict=True) for i in range(a, b) for j in range(i + 1, b) if v[i] @ v[j] >= 0.8}
    assert len(got) == len(set(got)) and want <= set(got) and len(got) < 1.5 * len(want)


def test_clusters_of_near_copies_store_no_pairs_of_all(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(3, 32))
    v = np.concatenate([np.repeat(base, 400, axis=0) * rng.uniform(1, 2, (1200, 1)) + 0.05 * rng.normal(size=(1200, 32)), rng.normal(size=(300, 32))])
    # A chain of steps whose angles lie about the threshold, so that codes alone cannot tell.
    at = np.cumsum(rng.uniform(-0.006, 0.006, 40) + np.arccos(0.9))
    chain = np.cos(at)[:, None] * np.eye(32)[0] + np.sin(at)[:, None] * np.eye(32)[1]
    v = np.concatenate([v, chain * 3])
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    near, want = unit @ unit.T >= 0.9, np.arange(len(v))
    while not np.array_equal(now := np.where(near, want[None], len(v)).min(axis=1), want):
        want = now
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "id bigint, v array<double>")
    stored: dict[str, int] = {}

    def keep(part, name):
        part = scratch.stored(part, name)
        stored[name] = part.count()
        return part

    got = {r["id"]: r["cluster"] for r in S.clusters(df, "id", "v", 0.9, keep).collect()}
    assert got == dict(enumerate(want.tolist()))
    assert stored and max(stored.values()) < 20 * len(v), stored


def test_keys_of_a_vector_do_not_grow_with_the_table(spark, monkeypatch):
    rng = np.random.default_rng(9)
    hashed, seen = S._hashed, {}
    for n in (100, 20_000):
        df = spark.createDataFrame([(k, x) for k, x in enumerate(rng.normal(size=(n, 8)).tolist())], "id bigint, v array<double>")
        monkeypatch.setattr(S, "_hashed", lambda *a: seen.setdefault(n, hashed(*a)))  # noqa: B023
        S.similar_pairs(df, "id", "v", 0.9)
        seen[n] = seen[n].count() / n
    assert seen[100] == seen[20_000]


def test_very_large_groups_are_divided(monkeypatch):
    rng = np.random.default_rng(10)
    v = rng.normal(size=(3000, 32)) + 0.5
    v[1500:] = v[:1500] + 0.35 * rng.normal(size=(1500, 32))
    v /= np.linalg.norm(v, axis=1)[:, None]
    scale = np.abs(v).max(axis=1) / 127
    codes = np.rint(v / scale[:, None])
    slack = np.sqrt(((v - codes * scale[:, None]) ** 2).sum(axis=1)) + 1e-6
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(v @ v.T >= 0.9, 1)), strict=True)}
    monkeypatch.setattr(S, "BLOCK", 250)
    for split in (10_000, 500):
        monkeypatch.setattr(S, "SPLIT", split)
        got = {(i, j) for a, b in S._near(codes.astype(np.float32), scale, slack, np.array([0, 3000]), 0.9) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
        assert len(want) > 1000 and len(want & got) >= (0.97 if split == 500 else 1) * len(want) and len(got) < 2 * len(want)


def test_parts_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(relations, "PART_ROWS", 10)
    monkeypatch.setattr(relations, "LEAST_ROWS", 5)
    parts = lambda n: relations.by_page(spark.range(n).withColumnRenamed("id", "page"), "page").rdd.getNumPartitions()
    assert [parts(n) for n in (0, 5, 20, 400)] == [1, 1, 4, 40]


def test_boxes_of_a_page_are_dealt_out_once(spark, sf, monkeypatch):
    monkeypatch.setattr(relations, "LEAST_ROWS", 1000)
    for name, exchanges in (("column_signals", 2), ("horizontal_alignments", 1)):
        plan = CATALOG[name].run(spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == exchanges, plan


def test_coverage_needs_no_other_exchange_than_by_page(spark, sf, monkeypatch):
    monkeypatch.setattr(relations, "LEAST_ROWS", 1000)
    plan = CATALOG["coverage_bins"].run(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_boxes_deal_out_plain_columns_only(spark, sf):
    for name, width in (("horizontal_alignments", 4), ("coverage_bins", 3)):
        plan = CATALOG[name].run(spark, sf)._jdf.queryExecution().optimizedPlan()
        dealt = [line.strip(" +-:") for line in plan.toString().splitlines()]
        below = dealt[next(k for k, line in enumerate(dealt) if line.startswith("RepartitionByExpression")) + 1]
        assert below.startswith("Project [l_orderkey") and below.count("#") == width, below


def test_coverage_of_odd_intervals_holds_no_bins(spark):
    ends = [None, -17.0, -0.5, 0.0, 4.0, 5.0, 9.0, 26.0]
    rows = [(p, a, b) for p in (1, None) for a in ends for b in ends] + [(2, 3.0, 3.0), (3, 9.0, 5.0), (4, 12.0, 2.0), (5, None, None), (6, 0.0, 4.9), (6, 20.0, 24.0), (6, 5.0, 5.0)]
    want: dict[tuple, int] = {}
    for p, a, b in rows:
        for k in range(int(a // 5), int(b // 5) + 1) if a is not None and b is not None else ():
            want[p, k] = want.get((p, k), 0) + 1
    df = relations.coverage(spark.createDataFrame(rows, "page bigint, l double, r double"), ["page"], "l", "r", 5.0)
    got = [((r["page"], r["bin"]), r["n"]) for r in df.collect()]
    assert len(got) == len(want) and dict(got) == want
    assert "Aggregate" not in _plan(df)


def test_light_work_takes_larger_parts_instead_of_sorting_what_is_written(spark, monkeypatch):
    monkeypatch.setattr(relations, "PART_ROWS", 10)
    monkeypatch.setattr(relations, "LEAST_ROWS", 5)
    monkeypatch.setattr(relations, "LIGHT_ROWS", 40)
    parts = lambda n: relations.by_page(spark.range(n).withColumnRenamed("id", "page"), "page", light=True).rdd.getNumPartitions()
    assert [parts(n) for n in (0, 20, 400, 2000, 2010, 8000, 8040)] == [1, 4, 40, 200, 200, 200, 201]


def test_alignments_count_boxes_once(spark, sf):
    plan = CATALOG["horizontal_alignments"].run(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate(") == 4, plan  # two steps for the boxes and two for the islands
