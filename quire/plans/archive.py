"""Sources, exports and control documents of an archive."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import envelopes, hocr, manifests, namespaces, scratch, tables
from ..sources.control import Checkpoint, read_json, write_json
from .catalog import BOXES, Tables, query


def _place(t: Tables, name: str) -> str:
    return f"{scratch.root(t.spark)}/quire-{name}-{uuid.uuid4().hex[:12]}"


def _hocr(t: Tables) -> DataFrame:
    """hOCR documents: a block per box, of one line or two, and a separator beside every third."""
    px = lambda c, k=10: (F.col(c) * k).cast("int").cast("string")
    box = F.concat_ws(" ", F.lit("bbox"), px("l"), px("t"), px("r"), px("b"))
    words = F.repeat(F.lit("<span class='ocrx_word' title='bbox 1 1 2 2; x_wconf 90'> w </span>"), (F.col("score") % 3).cast("int"))
    line = lambda cls, size: F.concat(F.lit(f"<span class='{cls}' title='"), box, F.lit("; baseline 0.01 -3; x_size "), (F.col("score") + size).cast("int").cast("string"), F.lit("; x_ascenders 2'>"), words, F.lit("</span>"))
    both = F.concat(line("ocr_line", 1), F.when(F.col("col") % 2 == 0, line("ocr_caption", 2)).otherwise(""))
    block = F.concat(F.lit("<div class='ocr_carea' title='"), box, F.lit("'><p class='ocr_par' title='"), box, F.lit("'>"), both, F.lit("</p></div>"))
    rule = F.concat(F.lit("<div class='ocr_separator' title='"), F.concat_ws(" ", F.lit("bbox"), px("l"), px("t"), (F.col("l") * 10 + 20).cast("int").cast("string"), (F.col("t") * 10 + 200).cast("int").cast("string")), F.lit("'/>"))
    parts = F.concat(block, F.when(F.col("col") % 3 == 0, rule).otherwise(""))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", parts.alias("x")))), lambda s: s["x"]), "")
    head = "<html xmlns='http://www.w3.org/1999/xhtml'><body><div class='ocr_page' title='image \"p.png\"; bbox 0 0 1000 2000; scan_res 300 300'>"
    return t.boxes().groupBy("page").agg(F.concat(F.lit(head), body, F.lit("</div></body></html>")).alias("html"))


_PARTS = f"{BOXES}, n AS (SELECT *, CAST(row_number() OVER (PARTITION BY page ORDER BY col) - 1 AS INTEGER) AS i FROM boxes)"


@query("S09 S10", f"""
WITH {_PARTS}, u AS (
 SELECT page, 'block' AS relation, i AS block_idx, 'ocr_carea' AS class, l, t, r, b, floor(score) + CASE WHEN col % 2 = 0 THEN 1.5 ELSE 1 END AS size, CAST(CASE WHEN col % 2 = 0 THEN 2 ELSE 1 END AS INTEGER) AS n, NULL AS text FROM n
 UNION ALL SELECT page, 'line', i, 'ocr_line', l, t, r, b, floor(score) + 1, CAST(score AS INTEGER) % 3, rtrim(repeat('w ', CAST(score AS INTEGER) % 3)) FROM n
 UNION ALL SELECT page, 'line', i, 'ocr_caption', l, t, r, b, floor(score) + 2, CAST(score AS INTEGER) % 3, rtrim(repeat('w ', CAST(score AS INTEGER) % 3)) FROM n WHERE col % 2 = 0
 UNION ALL SELECT page, 'region', NULL, 'ocr_separator', l, t, l + 2, t + 20, NULL, 200, 'vertical' FROM n WHERE col % 3 = 0
 UNION ALL SELECT page, 'page', NULL, NULL, 0, 0, 100, 200, 300, 1000, '2000' FROM n GROUP BY page)
SELECT page, relation, block_idx, class, round(l, 2) AS left_pct, round(t / 2, 2) AS top_pct, round(r, 2) AS right_pct, round(b / 2, 2) AS bottom_pct, CAST(size AS DOUBLE) AS size, n, text FROM u""")
def hocr_relations(t: Tables) -> DataFrame:
    # One pass over the parsed documents: four relations as one array, so no document is parsed again for each of them.
    found, none = hocr.documents(_hocr(t).withColumnRenamed("page", "id"), "id", "html"), F.lit(None)
    names = ("left_pct", "top_pct", "right_pct", "bottom_pct")

    def row(relation: str, number, cls, box, size, n, text):
        return F.struct(
            F.lit(relation).alias("relation"), number.cast("int").alias("block_idx"), cls.cast("string").alias("class"),
            *(x.cast("double").alias(name) for x, name in zip(box, names, strict=True)), size.cast("double").alias("size"), n.cast("int").alias("n"), text.cast("string").alias("text"),
        )

    of = lambda x: [x[name] for name in names]
    good = lambda x: (x["baseline_slope"] == 0.01) & (x["x_ascenders"] == 2) & x["x_descenders"].isNull() & (x["par_top_pct"] == x["top_pct"])
    p = F.col("page")
    parts = F.concat(
        F.transform("blocks", lambda x: row("block", x["block_idx"], x["block_class"], of(x), x["x_size_median"], x["n_lines"], none)),
        F.transform(F.filter("lines", good), lambda x: row("line", x["block_idx"], x["line_class"], of(x), x["x_size"], x["n_words"], x["text"])),
        F.transform(F.filter("regions", lambda x: x["width_px"] == 20), lambda x: row("region", none, x["region_class"], of(x), none, x["height_px"], x["orientation"])),
        F.array(row("page", none, none, map(F.lit, (0.0, 0.0, 100.0, 100.0)), p["scan_res_x"], p["width_px"], p["height_px"])),
    )
    return found.where(p["width_px"].isNotNull()).select(F.col("id").alias("page"), F.inline(parts))


@query("S03 S04", """
SELECT r_name, count(*) AS n_customers, CAST(sum(coalesce(k, 0)) AS BIGINT) AS n_orders FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
LEFT JOIN (SELECT o_custkey, count(*) AS k FROM orders GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1""")
def joined_namespaces(t: Tables) -> DataFrame:
    namespaces.attach(t.spark, "mvtm", {"nation": t.nation, "region": t.region})
    namespaces.attach(t.spark, "txc", {"customer": t.customer, "orders": t.orders})
    return t.spark.sql("""
        SELECT r_name, count(*) AS n_customers, CAST(sum(coalesce(k, 0)) AS BIGINT) AS n_orders FROM txc_customer JOIN mvtm_nation ON n_nationkey = c_nationkey JOIN mvtm_region ON r_regionkey = n_regionkey
        LEFT JOIN (SELECT o_custkey, count(*) AS k FROM txc_orders GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1""")


@query("S12", f"""
WITH {BOXES} SELECT id, l * 5 AS x0, t * 10 AS y0, r * 5 AS x1, b * 10 AS y1 FROM boxes WHERE (r - l) * 5 >= 30 AND (b - t) * 10 >= 120 AND (r - l) * 5 * (b - t) * 10 <= 0.8 * 200 * 200""")
def raster_regions(t: Tables) -> DataFrame:
    pt = t.boxes().select("id", (F.col("l") * 5).alias("x0"), (F.col("t") * 10).alias("y0"), (F.col("r") * 5).alias("x1"), (F.col("b") * 10).alias("y1"))
    return tables.raster_regions(pt, ("x0", "y0", "x1", "y1"), 200.0, 200.0, least_width=30.0, least_height=120.0)


@query("S20 X26", f"""
WITH {BOXES} SELECT id, CASE WHEN score % 7 > 0 THEN 4 ELSE 0 END AS n_points, CASE WHEN score % 7 > 0 THEN '[[' || l || ',' || t || '],[' || r || ',' || t || '],[' || r || ',' || b || '],[' || l || ',' || b || ']]' END AS polygon,
 CASE WHEN score % 7 > 0 THEN '<svg xmlns="http://www.w3.org/2000/svg"><path d="M ' || CAST(l * 10 AS INTEGER) || ' ' || CAST(t * 10 AS INTEGER) || ' L ' || CAST(r * 10 AS INTEGER) || ' ' || CAST(t * 10 AS INTEGER) || ' L ' || CAST(r * 10 AS INTEGER) || ' ' || CAST(b * 10 AS INTEGER) || ' L ' || CAST(l * 10 AS INTEGER) || ' ' || CAST(b * 10 AS INTEGER) || ' Z"/></svg>' END AS outline FROM boxes""")
def layout_polygons(t: Tables) -> DataFrame:
    at = lambda x, y: F.concat(F.lit("["), (F.col(x) * 10).cast("int").cast("string"), F.lit(","), (F.col(y) * 10).cast("int").cast("string"), F.lit("]"))
    text = F.when(F.col("score") % 7 > 0, F.concat(F.lit("["), at("l", "t"), F.lit(","), at("r", "t"), F.lit(","), at("r", "b"), F.lit(","), at("l", "b"), F.lit("]"))).otherwise("no polygon")
    found = tables.layout_blocks(t.boxes().select("id", text.alias("raw")), "raw", F.lit(1000), F.lit(1000))
    return found.select("id", "n_points", F.to_json("polygon").alias("polygon"), manifests.svg_path(F.col("pixels")).alias("outline"))


@query("K38", """
WITH p AS (SELECT o_custkey, o_orderkey, 'http://a/' || o_custkey || '/canvas/p' || o_orderkey AS cid, 'img/' || o_orderkey || '.png' AS img, 2000 + o_orderkey % 7 AS w, o_orderkey % 5 * 700 AS h FROM orders)
SELECT o_custkey, '{"@context":"http://iiif.io/api/presentation/3/context.json","id":"http://a/' || o_custkey || '","type":"Manifest","label":{"en":["' || o_custkey || '"]},"items":[' || string_agg(
 '{"id":"' || cid || '","type":"Canvas","label":{"en":["Page ' || o_orderkey || '"]},"width":' || w || ',"height":' || h || ',"items":[{"id":"' || cid || '/painting","type":"AnnotationPage","items":[{"id":"' || cid || '/painting/1","type":"Annotation","motivation":"painting","body":{"id":"' || img || '","type":"Image","format":"image/png","width":' || w || ',"height":' || h || '},"target":"' || cid || '"}]}]}', ',' ORDER BY o_orderkey) || ']}' AS manifest
FROM p WHERE h > 0 GROUP BY o_custkey""")
def issue_manifests(t: Tables) -> DataFrame:
    image = F.concat(F.lit("img/"), F.col("o_orderkey").cast("string"), F.lit(".png"))
    pages = t.orders.select("o_custkey", "o_orderkey", image.alias("image"), (2000 + F.col("o_orderkey") % 7).alias("w"), (F.col("o_orderkey") % 5 * 700).alias("h"))
    return manifests.manifest(pages, "o_custkey", "o_orderkey", "image", "w", "h", "http://a")


@query("K40 I09", f"""
WITH {BOXES}, gone AS (SELECT DISTINCT unnest([id - 1, id - 2]) AS id FROM boxes WHERE col = 3), alive AS (SELECT * FROM boxes ANTI JOIN gone USING (id))
SELECT page, '{{"type":"AnnotationPage","items":[' || string_agg('{{"id":' || id || ',"pass":' || CASE WHEN col = 3 THEN 3 ELSE 2 END || ',"target":"xywh=percent:' || CAST(l AS INTEGER) || ',' || CAST(t AS INTEGER) || '"}}', ',' ORDER BY t, id) || ']}}' AS document FROM alive GROUP BY page""")
def tidied_overlays(t: Tables) -> DataFrame:
    items = t.boxes().withColumn("origin", F.when(F.col("col") == 3, F.array(F.col("id") - 1, F.col("id") - 2)))
    target = F.concat(F.lit("xywh=percent:"), F.col("l").cast("int").cast("string"), F.lit(","), F.col("t").cast("int").cast("string"))
    return manifests.overlay(items, "id", "page", "t", "origin", target)


@query("K01", """
SELECT 'kept' AS part, o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 2 UNION ALL SELECT 'snapshot', o_orderstatus, count(*) FROM orders WHERE o_orderstatus = 'P' GROUP BY 2""")
def snapshotted_deletes(t: Tables) -> DataFrame:
    place = _place(t, "snapshot")
    kept = tables.snapshot_then_delete(t.orders, F.col("o_orderstatus") == "P", place)
    saved = t.spark.read.schema(t.orders.schema).json(place)
    count = lambda df, part: df.groupBy(F.lit(part).alias("part"), "o_orderstatus").agg(F.count("*").alias("n"))
    return count(kept, "kept").union(count(saved, "snapshot"))


@query("K37 K32", """
SELECT * FROM (VALUES (1, NULL, '2024-01-05 00:00:00'), (2, '2024-01-05 00:00:00', '2024-01-09 12:00:00'), (3, '2024-01-05 00:00:00', '2024-01-09 12:00:00'), (4, '2024-01-09 12:00:00', '2024-01-20 00:00:00')) AS w(run, after, until)
JOIN (SELECT event_id, ts FROM events) ON (after IS NULL OR ts > CAST(after AS TIMESTAMP)) AND ts <= CAST(until AS TIMESTAMP)""".replace("SELECT * FROM", "SELECT run, after, until, count(*) AS n FROM", 1) + " GROUP BY ALL")
def reconciled_in_two_phases(t: Tables) -> DataFrame:
    """Four runs; the second dies before its commit, so the third gets the second's window whatever time it is."""
    mark, out = Checkpoint(t.spark, f"{_place(t, 'control')}/state.json"), None
    for run, as_of in enumerate(("2024-01-05 00:00:00", "2024-01-09 12:00:00", "2024-01-15 00:00:00", "2024-01-20 00:00:00"), 1):
        after, until = mark.begin(as_of)
        window = F.col("ts") <= F.lit(until).cast("timestamp_ntz")
        rows = t.events.where(window if after is None else window & (F.col("ts") > F.lit(after).cast("timestamp_ntz")))
        done = rows.agg(F.count("*").alias("n")).select(F.lit(run).alias("run"), F.lit(after).cast("string").alias("after"), F.lit(until).alias("until"), "n")
        out = done if out is None else out.union(done)
        if run != 2:
            mark.commit()
    return out


@query("K32", "SELECT count(*) AS n, 'second' AS version FROM nation")
def replaced_documents(t: Tables) -> DataFrame:
    path = f"{_place(t, 'json')}/viewer.json"
    names = [r["n_name"] for r in t.nation.select("n_name").collect()]
    for version in ("first", "second"):
        write_json(t.spark, path, {"version": version, "names": names})
    found = read_json(t.spark, path)
    return t.spark.createDataFrame([(len(found["names"]), found["version"])], "n bigint, version string")


@query("M74", """
SELECT conv_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn) AS text, bool_or(turn % 5 = 3) AS damage, bool_or(length(text) > 400) AS faded FROM conversations GROUP BY 1""")
def merged_envelopes(t: Tables) -> DataFrame:
    slices = t.conversations.select("conv_id", "turn", "text", (F.col("turn") % 5 == 3).alias("damage"), (F.char_length("text") > 400).alias("faded"))
    return envelopes.merged_slices(slices, "conv_id", "turn", "text", ("damage", "faded"))
