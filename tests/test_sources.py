"""Readers, writers, mutations and streams."""

import pytest
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import mutations as K
from quire.operators import graph, similarity
from quire.operators.graph import connected_components
from quire.sources import control, envelopes, hocr, namespaces, scratch, tables
from quire.streaming import days


def test_tolerant_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"n": 1, "s": "x"}')
    (tmp_path / "b.json").write_text("{broken")
    got = tables.read_json(spark, str(tmp_path), "n bigint, s string").collect()
    assert sorted((r["n"], r["_corrupt"] is None) for r in got if r["n"]) == [(1, True)] and sum(r["_corrupt"] is not None for r in got) == 1


def test_listing_and_classification(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "i_p3_col7.png").write_bytes(b"abc")
    got = tables.list_files(spark, str(tmp_path)).withColumn("c", tables.classify_path(F.col("path"))).first()
    assert got["sha256"].startswith("ba7816bf") and got["c"].asDict() == {"kind": "column", "page": 3, "col": 7}


def test_numbers_of_paths_have_any_length(spark):
    paths = spark.createDataFrame([("a/x_p99999_col4.png",), ("a/x_p100000_col123456.png",), ("x_p0000012.pdf",), ("x_p99999999999.pdf",)], "path string")
    got = [tuple(r) for r in paths.select(tables.classify_path(F.col("path")).alias("c")).select("c.*").collect()]
    assert got == [("column", 99999, 4), ("column", 100000, 123456), ("scan", 12, None), ("scan", None, None)]


def test_partition_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.createDataFrame([(1, "a"), (2, "a")], "page int, v string"), path, ["page"])
    for _ in range(2):
        tables.replace_partitions(spark.createDataFrame([(2, "b")], "page int, v string"), path, ["page"])
    assert sorted((r["page"], r["v"]) for r in tables.read_table(spark, path).collect()) == [(1, "a"), (2, "b")]


def test_snapshot_before_delete(spark, tmp_path):
    t = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    left = tables.snapshot_then_delete(t, F.col("v") == "a", str(tmp_path / "s"))
    assert [r["k"] for r in left.collect()] == [2] and spark.read.json(str(tmp_path / "s")).count() == 1


def test_hocr(spark):
    page = "<html><div class='ocr_carea' id='b1' title='bbox 0 0 50 20'><span class='ocrx_word' title='bbox 1 1 9 9; x_wconf 90'>Hello</span><span class='ocrx_word' title='bbox 10 1 19 9; x_wconf 80'>there</span></div></html>"
    r = hocr.blocks(spark.createDataFrame([(1, page)], "page bigint, html string"), "page", "html").first()
    assert (r["text"], r["n_words"], r["confidence"], r["r"]) == ("Hello there", 2, 85.0, 50.0)


def test_envelopes(spark):
    rows = [(1, '```json\n{"slices":[{"idx":1,"transcript_text":"b"},{"idx":0,"transcript_text":"a"}],"repair_needed":false}\n```'), (2, "no"), (3, '{"slices":[]}'), (4, None)]
    got = envelopes.with_verdict(spark.createDataFrame(rows, "k int, raw string"), "raw", envelopes.SLICED_RESULT, ("slices", "repair_needed"))
    got = {r["k"]: (r["rejected"], r["j"]) for r in got.withColumn("j", envelopes.joined_slices(F.col("envelope"))).collect()}
    assert got[1] == (None, "a\nb") and got[2][0] == "not json" and got[3][0] == "missing repair_needed" and got[4][0] == "not json"


@pytest.mark.parametrize(("a", "b", "want"), [
    ("same", "same", "same"), ("short", "short and more", "short and more"), ("ends with tail", "tail", "ends with tail"), ("unrelated", "lines", None), ("", "x", None),
    ("go to the end of this long line", "the end of this long line and on", "go to the end of this long line and on"), ("few words here", "words here too", None), ("xthe end of this long line", "the end of this long line and on", None),
])
def test_stitch(spark, a, b, want):
    assert spark.range(1).select(X.stitch(F.lit(a), F.lit(b)).alias("x")).first()["x"] == want


def test_audit_and_undo(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    after = spark.createDataFrame([(2, "c"), (3, None)], "k int, v string")
    log = K.audit(before, after, "k", "edit")
    assert sorted((r["key"], r["before"] is None, r["after"] is None) for r in log.collect()) == [(1, False, True), (2, False, False), (3, True, False)]
    assert sorted(map(tuple, K.undo(after, log, "k").collect())) == [(1, "a"), (2, "b")]


def test_components(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (7, 7), (200, 200), (None, 3), (101, 100)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "u bigint, v bigint"), scratch.stored).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100, 200: 200}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint"), scratch.stored).count() == 0


def test_failure_counter(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("bad", F.col("event_type") == "error").select("user_id", "event_id", "bad")
    want = {}
    for r in sorted(events.collect(), key=lambda r: r["event_id"]):
        want[r["user_id"]] = want.get(r["user_id"], 0) + 1 if r["bad"] else 0
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf).withColumn("bad", F.col("event_type") == "error").select("user_id", "event_id", "bad")
    found = days.run_once(days.failure_counter(stream, "user_id", "bad", "event_id"), str(tmp_path / "out"), str(tmp_path / "c"), "update")
    assert {r["user_id"]: r["failures"] for r in days.latest(found, ["user_id"]).collect()} == want


def test_failure_counter_of_one_long_key(spark, tmp_path):
    """100,000 events of one key in no order fill many Arrow batches; a rerun resumes, NULLs are no failures."""
    marks = spark.range(100_000).select((F.col("id") * 37 % 100_000).alias("event_id"), F.lit(1).cast("bigint").alias("user_id")).withColumn("bad", F.col("event_id") > 99_000)
    marks = marks.union(spark.createDataFrame([(1, 2, None), (2, 3, True), (3, 3, None), (4, 3, True)], "event_id bigint, user_id bigint, bad boolean"))
    marks.repartition(3).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = spark.readStream.schema(marks.schema).option("maxFilesPerTrigger", 100).parquet(str(tmp_path / "in"))
        found = days.run_once(days.failure_counter(stream, "user_id", "bad", "event_id"), str(tmp_path / "out"), str(tmp_path / "c"), "update")
        assert {r["user_id"]: (r["failures"], r["status"]) for r in days.latest(found, ["user_id"]).collect()} == {1: (999, "damaged"), 2: (0, "done"), 3: (1, "failed")}


def _vectors(spark, pairs=60, size=32):
    import numpy as np

    rng = np.random.default_rng(6)
    base = rng.normal(size=(pairs, size))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=(pairs, size))
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = np.linspace(0.9001, 0.9999, pairs)[:, None]
    rows = np.concatenate((base, c * base + np.sqrt(1 - c * c) * side, rng.normal(size=(600, size))))
    return rows, spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(rows)] + [(9000, [0.0] * size), (9001, None)], "id bigint, v array<double>")


def test_similar_pairs_recall_and_share_compared(spark, monkeypatch):
    import numpy as np

    rows, df = _vectors(spark)
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    i, j = np.nonzero(np.triu(unit @ unit.T >= 0.9, 1))
    want = set(zip(i.tolist(), j.tolist(), strict=True))
    assert len(want) >= 60
    monkeypatch.setattr(similarity, "BLOCK", 100)
    exact = {(r["id_a"], r["id_b"]) for r in similarity.similar_pairs(df, "id", "v", 0.9, recall=1).collect()}
    assert exact == want
    got = {(r["id_a"], r["id_b"]) for r in similarity.similar_pairs(df, "id", "v", 0.9).collect()}
    assert got <= want and len(got) >= 0.97 * len(want)
    keys = similarity._hashed(df.where("id < 9000").select("id", similarity.normalised(F.col("v")).alias("v")), np.arccos(0.9), 0.995, 10, 11)
    met = keys.join(keys.withColumnRenamed("id", "other"), "key").where("id < other").select("id", "other").distinct().count()
    assert met < 0.1 * len(rows) * (len(rows) - 1) / 2


def test_equal_vectors_always_meet(spark):
    df = spark.createDataFrame([(k, [1.0, 2.0, 3.0]) for k in range(5)] + [(9, [1.0, 2.0])], "id bigint, v array<double>")
    assert similarity.similar_pairs(df, "id", "v", 0.999).count() == 10


def test_components_with_hubs(spark, monkeypatch):
    monkeypatch.setattr(graph, "HUBS", 5)
    edges = [(0, k) for k in range(1, 300)] + [(500, k) for k in range(501, 700)] + [(299, 800), (801, 800), (900, 901)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint"), scratch.stored).collect()}
    assert got == {k: 0 for k in [*range(300), 800, 801]} | {k: 500 for k in range(500, 700)} | {900: 900, 901: 900}


def test_hocr_documents_of_odd_pages(spark):
    good = "<div class='ocr_page' title='bbox 0 0 200 100'><div class='ocr_photo' title='bbox 0 0 50 50'/><div class='ocr_carea' title='bbox 10 10 20 20'><p class='ocr_par'><span class='ocr_line' title='baseline -0.5 2; x_size 9.5'><span class='ocrx_word'>a</span><span class='ocrx_word'/></span></p></div><div class='ocr_carea'/></div>"
    rows = [(1, good), (2, None), (3, ""), (4, "<div>"), (5, "<html/>")]
    found = hocr.documents(spark.createDataFrame(rows, "id bigint, html string"), "id", "html").cache()
    assert {r["id"] for r in found.collect() if r["page"] is None} == {2, 3, 4, 5} and found.count() == 5
    assert [(r["block_idx"], r["n_lines"], r["x_size_median"]) for r in hocr.relation(found, "id", "blocks").orderBy("block_idx").collect()] == [(0, 1, 9.5), (1, 0, None)]
    line = hocr.relation(found, "id", "lines").first()
    assert (line["text"], line["n_words"], line["baseline_slope"]) == ("a", 2, -0.5)
    assert [(r["orientation"], r["right_pct"]) for r in hocr.relation(found, "id", "regions").collect()] == [("block", 25.0)]
    assert hocr.relation(found, "id", "page").first()["scan_res_x"] is None


def test_checkpoint_in_two_phases(spark, tmp_path):
    mark = control.Checkpoint(spark, f"{tmp_path}/deep/state.json")
    assert mark.begin("a") == (None, "a") and mark.begin("b") == (None, "a")
    mark.commit()
    mark.commit()
    assert mark.begin("c") == ("a", "c")
    control.write_json(spark, f"{tmp_path}/x.json", {"k": "\u00e9\n"})
    assert control.read_json(spark, f"{tmp_path}/x.json") == {"k": "\u00e9\n"} and control.read_json(spark, f"{tmp_path}/none.json") is None


def test_namespaces_are_read_only(spark):
    names = namespaces.attach(spark, "one", {"t": spark.range(3)}) + namespaces.attach(spark, "two", {"t": spark.range(2, 5)})
    assert spark.sql("SELECT a.id FROM one_t a JOIN two_t b USING (id)").count() == 1
    with pytest.raises(Exception, match="(?i)insert|view|not allowed|unsupported"):
        spark.sql("INSERT INTO one_t VALUES (9)")
    namespaces.detach(spark, names)
    assert not spark.catalog.tableExists("one_t")


def test_snapshot_comes_before_the_delete(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "k int, v string")
    kept = tables.snapshot_then_delete(rows, F.col("v") == "a", str(tmp_path / "snap"))
    assert sorted(r["k"] for r in kept.collect()) == [2, 3]
    with pytest.raises(Exception, match="(?i)exists"):
        tables.snapshot_then_delete(rows, F.col("v") == "b", str(tmp_path / "snap"))
