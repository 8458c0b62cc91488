"""Box geometry over pages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import columns as C
from ..operators import greedy as G
from ..operators.columns import Box
from ..operators.relations import box_pairs, by_page, column_cover, nearest, next_below, points_in_boxes
from .catalog import AREA_A, AREA_B, BOXES, MEET, Tables, query

_COLUMNS = "cols AS (SELECT DISTINCT page, CAST(k AS BIGINT) AS col_idx, CAST(k * 20 AS DOUBLE) AS l, CAST(k * 20 + 20 AS DOUBLE) AS r FROM boxes CROSS JOIN range(0, 5) AS g(k))"


def _columns(t: Tables) -> DataFrame:
    pages = by_page(t.lineitem.select(F.col("l_orderkey").alias("page")), "page").distinct()
    return pages.select("page", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k")).select("page", F.col("k").cast("bigint").alias("col_idx"), (F.col("k") * 20.0).alias("l"), (F.col("k") * 20.0 + 20).alias("r"))


@query("P01 P02 P03 P04 P05 P07 P08", f"""
WITH {BOXES} SELECT id, CAST(round_even(l / 100 * 2479, 0) AS BIGINT) AS px, round(l / 100 * 2479, 4) AS px_float, round(t / 3508 * 100, 2) AS pct, greatest(0.0, least(100.0, r + 30)) AS clamped,
 round(l / 100, 4) AS frac, round(l / 0.5, 4) AS cell_x, round(t / 0.5 * 1.4142, 4) AS cell_y FROM boxes""")
def coordinates(t: Tables) -> DataFrame:
    ink = t.boxes()
    return ink.select("id", C.to_pixels(F.col("l"), F.lit(2479)).alias("px"), F.round(F.col("l") / 100 * 2479, 4).alias("px_float"), C.to_percent(F.col("t"), F.lit(3508)).alias("pct"), C.clamp(F.col("r") + 30).alias("clamped"), F.round(F.col("l") / 100, 4).alias("frac"), F.round(F.col("l") / 0.5, 4).alias("cell_x"), F.round(F.col("t") / 0.5 * 1.4142, 4).alias("cell_y"))


@query("P06", """
SELECT p_partkey, round(CASE p_size % 5 WHEN 0 THEN p_retailprice / 100 * 595 WHEN 1 THEN p_retailprice * 72 / 450.0 WHEN 2 THEN p_retailprice WHEN 3 THEN p_retailprice * 72 END, 4) AS points FROM part""")
def unit_parsing(t: Tables) -> DataFrame:
    unit = F.get(F.array(*(F.lit(u) for u in ("pct", "px", "pt", "in", "furlong"))), F.col("p_size") % 5)
    return t.part.select("p_partkey", F.round(C.to_points(F.col("p_retailprice"), unit, F.lit(595.0), 450.0), 4).alias("points"))


@query("P09 P26 P28 P29 P30 P34 P32 P43", f"""
WITH {BOXES} SELECT id, CASE WHEN b - t >= 2 * (r - l) THEN 'vertical' WHEN r - l >= 2 * (b - t) THEN 'horizontal' ELSE 'block' END AS orientation,
 CASE WHEN r - l >= 0.85 * 25 THEN 'full' ELSE 'narrow' END AS rule_class, CASE WHEN 1900 + page % 120 < 1980 THEN 'columns' ELSE 'pages' END AS route, CASE WHEN page % 2 = 1 THEN 'left' ELSE 'right' END AS binding,
 CAST((l < 4 OR r > 96) AND r - l < 15 AS BIGINT) AS rim_sliver, CAST(b - t >= 12 AND (r - l) * (b - t) <= 9000 AS BIGINT) AS usable FROM boxes""")
def box_classes(t: Tables) -> DataFrame:
    a = Box.of()
    sliver = ((a.left < 4) | (a.right > 96)) & (a.right - a.left < 15)
    usable = (a.bottom - a.top >= 12) & (C.area(a) <= 9000)
    return t.boxes().select("id", C.orientation(a).alias("orientation"), C.rule_class(a.right - a.left, F.lit(25.0)).alias("rule_class"), C.route(1900 + F.col("page") % 120).alias("route"), C.binding_side(F.col("page")).alias("binding"), sliver.cast("bigint").alias("rim_sliver"), usable.cast("bigint").alias("usable"))


@query("P10 P11 P12 P13 P14 P15 P16 P18 P19 P20 P21 P22", f"""
WITH {BOXES} SELECT a.id AS a, b.id AS b, round({MEET}, 4) AS meet, round(greatest(0, least(a.r, b.r) - greatest(a.l, b.l)) / (a.r - a.l), 4) AS share, round(CASE WHEN {AREA_A} + {AREA_B} - {MEET} > 0 THEN {MEET} / ({AREA_A} + {AREA_B} - {MEET}) ELSE 0 END, 4) AS iou,
 least(a.l, b.l) AS ul, greatest(a.b, b.b) AS ub, CAST(a.l < b.r - 0.05 AND b.l < a.r - 0.05 AND a.t < b.b - 0.05 AND b.t < a.b - 0.05 AS BIGINT) AS hit,
 CAST(b.l >= a.l - 1 AND b.t >= a.t - 1 AND b.r <= a.r + 1 AND b.b <= a.b + 1 AS BIGINT) AS inside, CAST((b.l + b.r) / 2 BETWEEN a.l AND a.r AND (b.t + b.b) / 2 BETWEEN a.t AND a.b AS BIGINT) AS centred
FROM boxes a JOIN boxes b ON a.page = b.page AND a.id < b.id""")
def box_pair_measures(t: Tables) -> DataFrame:
    a, b = Box.of("a."), Box.of("b.")
    joined = box_pairs(t.boxes(), t.boxes(), "page", F.col("a.id") < F.col("b.id"))
    u = C.hull(a, b)
    return joined.select(
        F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.round(C.shared_area(a, b), 4).alias("meet"), F.round(C.overlap_share(a.left, a.right, b.left, b.right), 4).alias("share"), F.round(C.iou(a, b), 4).alias("iou"),
        u.left.alias("ul"), u.bottom.alias("ub"), C.intersects(a, b).cast("bigint").alias("hit"), C.contains(a, b, 1.0).cast("bigint").alias("inside"), C.centre_inside(a, b).cast("bigint").alias("centred"),
    )


@query("P17 A44 A43 I03", f"""
WITH {BOXES} SELECT page, round(min(l), 2) AS l, round(min(t), 2) AS t, round(max(r), 2) AS r, round(max(b), 2) AS b, count(*) AS n, CAST(count(DISTINCT col) > 1 AS BIGINT) AS crosses FROM boxes GROUP BY 1""")
def page_hulls(t: Tables) -> DataFrame:
    ends = [F.round(F.min("l"), 2).alias("l"), F.round(F.min("t"), 2).alias("t"), F.round(F.max("r"), 2).alias("r"), F.round(F.max("b"), 2).alias("b")]
    return t.boxes().groupBy("page").agg(*ends, F.count("*").alias("n"), (F.countDistinct("col") > 1).cast("bigint").alias("crosses"))


@query("P23 P24 X24 X25 K39", f"""
WITH {BOXES}, f AS (SELECT id, (CASE WHEN abs(b - 55) <= 6 THEN 1 ELSE 0 END) + (CASE WHEN abs(l - 5) <= 6 THEN 1 ELSE 0 END) + (CASE WHEN abs(r - 60) <= 6 THEN 1 ELSE 0 END) + (CASE WHEN abs(t - 5) <= 6 THEN 1 ELSE 0 END) AS n,
 concat_ws(',', CASE WHEN abs(b - 55) <= 6 THEN 'bottom' END, CASE WHEN abs(l - 5) <= 6 THEN 'left' END, CASE WHEN abs(r - 60) <= 6 THEN 'right' END, CASE WHEN abs(t - 5) <= 6 THEN 'top' END) AS edges,
 'xywh=' || CAST(round_even(l / 100 * 2000, 0) AS BIGINT) || ',' || CAST(round_even(t / 100 * 3000, 0) AS BIGINT) || ',' || greatest(1, CAST(round_even(r / 100 * 2000, 0) AS BIGINT) - CAST(round_even(l / 100 * 2000, 0) AS BIGINT)) || ',' || greatest(1, CAST(round_even(b / 100 * 3000, 0) AS BIGINT) - CAST(round_even(t / 100 * 3000, 0) AS BIGINT)) AS fragment FROM boxes)
SELECT id, edges, CASE WHEN n = 4 THEN 'covers' WHEN n = 0 THEN 'hole' WHEN edges IN ('left,right', 'bottom,top') THEN 'split' END AS refusal,
 CAST(CASE WHEN n IN (0, 4) OR edges IN ('left,right', 'bottom,top') THEN NULL WHEN n = 3 THEN 5 WHEN n = 2 THEN 7 ELSE 9 END AS BIGINT) AS points, fragment FROM f""")
def inset_remainders(t: Tables) -> DataFrame:
    outer, inner = Box(*(F.lit(float(x)) for x in (5, 5, 60, 55))), Box.of()
    polygon = C.remainder_polygon(outer, inner, 6.0)
    return t.boxes().select("id", F.array_join(C.flush_edges(outer, inner, 6.0), ",").alias("edges"), C.remainder_refusal(outer, inner, 6.0).alias("refusal"), F.when(polygon.isNotNull(), F.size(polygon)).cast("bigint").alias("points"), C.media_fragment(inner, F.lit(2000), F.lit(3000)).alias("fragment"))


@query("P27", f"""
WITH {BOXES} SELECT a.id, round(sum({MEET}) / first({AREA_A}), 4) AS cover, count(DISTINCT b.col) AS n_columns FROM boxes a JOIN boxes b ON a.page = b.page AND a.id <> b.id AND {MEET} > 0 WHERE a.score < 15
GROUP BY a.id HAVING sum({MEET}) > 0.5 * first({AREA_A}) AND count(DISTINCT b.col) >= 2""")
def body_text_rejects(t: Tables) -> DataFrame:
    ads, text = t.boxes().where("score < 15"), t.boxes()
    text = text.withColumnRenamed("id", "text_id")
    joined = body_text_false_positives_input(ads, text)
    return joined


def body_text_false_positives_input(ads: DataFrame, text: DataFrame) -> DataFrame:
    """An ad is not covered by its own region: the regions of a page exclude the ad itself."""
    a, b = Box.of("a."), Box.of("b.")
    pairs = box_pairs(ads, text, "page", (C.shared_area(a, b) > 0) & (F.col("a.id") != F.col("b.text_id")))
    sums = pairs.groupBy("a.id").agg(F.sum(C.shared_area(a, b)).alias("s"), F.first(C.area(a)).alias("area"), F.countDistinct("b.col").alias("n_columns"))
    return sums.where((F.col("s") > 0.5 * F.col("area")) & (F.col("n_columns") >= 2)).select("id", F.round(F.col("s") / F.col("area"), 4).alias("cover"), "n_columns")


@query("P44 P45 P46 J14 A57", f"""
WITH {BOXES}, {_COLUMNS} SELECT x.id, min(c.col_idx) AS lo, max(c.col_idx) AS hi, count(*) AS n FROM boxes x JOIN cols c ON c.page = x.page AND greatest(0, least(c.r, x.r) - greatest(c.l, x.l)) / (c.r - c.l) >= 0.5 GROUP BY 1""")
def columns_spanned(t: Tables) -> DataFrame:
    return column_cover(t.boxes(), _columns(t), "page", 0.5).groupBy(F.col("a.id").alias("id")).agg(F.min("b.col_idx").alias("lo"), F.max("b.col_idx").alias("hi"), F.count("*").alias("n"))


@query("P48", """
WITH s AS (SELECT conv_id, turn, CAST(coalesce(sum(length(coalesce(text, '')) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a, length(coalesce(text, '')) AS n FROM conversations)
SELECT conv_id, turn, round(CASE WHEN n > 0 THEN least(1.0, greatest(0.0, (100.0) / n)) ELSE 0 END * 10 + turn * 10, 4) AS y FROM s""")
def interpolated_offsets(t: Tables) -> DataFrame:
    n = F.char_length(F.coalesce("text", F.lit(""))).cast("double")
    low = F.col("turn") * 10.0
    return t.conversations.select("conv_id", "turn", F.round(C.interpolate(F.lit(100.0), F.lit(0.0), n, low, low + 10), 4).alias("y"))


@query("P49 J16 R13 M60", f"""
WITH {BOXES} SELECT a.id, (SELECT e.b FROM boxes e WHERE e.page = a.page AND abs(e.b - a.t) <= 5 ORDER BY abs(e.b - a.t), e.b LIMIT 1) AS nearest FROM boxes a""")
def snapped_edges(t: Tables) -> DataFrame:
    boxes = t.boxes()
    return nearest(boxes, boxes.select("page", F.col("b").alias("edge")).distinct(), "page", "t", "edge", 5.0, "id").select("id", "nearest")


@query("J16 P49", f"""
WITH {BOXES} SELECT a.id, coalesce((SELECT min(e.t) FROM boxes e WHERE e.page = a.page AND e.t > a.b), 100.0) AS next FROM boxes a""")
def caption_terminators(t: Tables) -> DataFrame:
    boxes = t.boxes()
    return next_below(boxes, boxes.select("page", F.col("t").alias("top")), "page", "b", "top", "id", 100.0).select("id", "next")


@query("J13 J18 A45 M38 M61 P37", f"""
WITH {BOXES} SELECT a.id, count(b.id) AS n_inside FROM boxes a LEFT JOIN boxes b ON a.page = b.page AND a.id <> b.id AND (b.l + b.r) / 2 BETWEEN a.l AND a.r AND (b.t + b.b) / 2 BETWEEN a.t AND a.b GROUP BY 1""")
def centres_inside(t: Tables) -> DataFrame:
    return points_in_boxes(t.boxes(), t.boxes(), "page", "id").select("id", F.col("n_inside").cast("bigint").alias("n_inside"))


@query("J15 J28 M57", f"""
WITH {BOXES}, s AS (SELECT a.id, b.id AS match, {MEET} / ({AREA_A} + {AREA_B} - {MEET}) AS score FROM boxes a JOIN boxes b ON a.page = b.page AND a.col < b.col AND {MEET} / ({AREA_A} + {AREA_B} - {MEET}) > 0.3)
SELECT x.id, m.match, round(m.score, 4) AS score FROM boxes x LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, match) AS r FROM s) WHERE r = 1) m ON m.id = x.id""")
def best_iou_match(t: Tables) -> DataFrame:
    a, b = Box.of("a."), Box.of("b.")
    pairs = box_pairs(t.boxes(), t.boxes(), "page", (F.col("a.col") < F.col("b.col")) & (C.iou(a, b) > 0.3))
    best = pairs.groupBy("a.id").agg(F.min(F.struct((-C.iou(a, b)).alias("s"), F.col("b.id").alias("m"))).alias("x")).select("id", F.col("x.m").alias("match"), F.round(-F.col("x.s"), 4).alias("score"))
    return t.boxes().select("id").join(best, "id", "left")


@query("J17 J27 P35 P36", f"""
WITH {BOXES} SELECT a.id, count(b.id) AS below, min(b.t) AS first_below FROM boxes a LEFT JOIN boxes b ON a.page = b.page AND b.t > a.b AND b.t < a.b + 30 AND least(a.r, b.r) > greatest(a.l, b.l) WHERE a.score >= 25 GROUP BY 1""")
def article_bodies(t: Tables) -> DataFrame:
    a, b = Box.of("a."), Box.of("b.")
    under = (b.top > a.bottom) & (b.top < a.bottom + 30) & (C.overlap(a.left, a.right, b.left, b.right) > 0)
    return box_pairs(t.boxes().where("score >= 25"), t.boxes(), "page", under, "left").groupBy(F.col("a.id").alias("id")).agg(F.count("b.id").alias("below"), F.min("b.t").alias("first_below"))


@query("P33 J19 T10 M46 J29", f"""
WITH {BOXES} SELECT id, page FROM boxes b WHERE NOT EXISTS (SELECT 1 FROM boxes a WHERE a.page = b.page AND a.id <> b.id AND b.l >= a.l AND b.t >= a.t AND b.r <= a.r AND b.b <= a.b AND ({AREA_A} > {AREA_B} OR a.id < b.id))""")
def not_nested(t: Tables) -> DataFrame:
    a, b = Box.of("a."), Box.of("b.")
    larger = (C.area(b) > C.area(a)) | (F.col("b.id") < F.col("a.id"))
    return box_pairs(t.boxes(), t.boxes(), "page", (F.col("a.id") != F.col("b.id")) & C.contains(b, a) & larger, "left_anti").select("id", "page")


@query("M45 M34 R11", f"""
WITH {BOXES} SELECT a.id, count(b.id) AS aligned FROM boxes a LEFT JOIN boxes b ON a.page = b.page AND a.id <> b.id AND abs(a.l - b.l) <= 2 GROUP BY 1""")
def alignment_counts(t: Tables) -> DataFrame:
    close = (F.col("a.id") != F.col("b.id")) & (F.abs(F.col("a.l") - F.col("b.l")) <= 2)
    return box_pairs(t.boxes(), t.boxes(), "page", close, "left").groupBy(F.col("a.id").alias("id")).agg(F.count("b.id").alias("aligned"))


@query("I16 A48 A49", f"""
WITH {BOXES} SELECT page, min(CASE WHEN l < 20 THEN l END) AS rim_left, min(CASE WHEN 100 - r < 60 THEN 100 - r END) AS rim_right, greatest(0.0, min(l) - 4) AS box_left, least(100.0, max(r) + 4) AS box_right, CAST(sum(CASE WHEN r > 75 THEN 1 ELSE 0 END) AS BIGINT) AS outside FROM boxes GROUP BY 1""")
def content_box(t: Tables) -> DataFrame:
    l, r = F.col("l"), F.col("r")
    return t.boxes().groupBy("page").agg(
        F.min(F.when(l < 20, l)).alias("rim_left"), F.min(F.when(100 - r < 60, 100 - r)).alias("rim_right"), F.greatest(F.lit(0.0), F.min(l) - 4).alias("box_left"),
        F.least(F.lit(100.0), F.max(r) + 4).alias("box_right"), F.count_if(r > 75).alias("outside"),
    )


@query("A40 A62 M48", f"""
WITH {BOXES}, {_COLUMNS} SELECT c.page, c.col_idx, round(coalesce(sum(x.b - x.t), 0), 4) AS body, round(coalesce(max(x.score), 0), 4) AS top_score FROM cols c LEFT JOIN boxes x ON x.page = c.page AND greatest(0, least(c.r, x.r) - greatest(c.l, x.l)) / (c.r - c.l) >= 0.5 GROUP BY 1, 2""")
def column_signals(t: Tables) -> DataFrame:
    cover = C.overlap_share(F.col("a.l"), F.col("a.r"), F.col("b.l"), F.col("b.r")) >= 0.5
    joined = box_pairs(_columns(t), t.boxes(), "page", cover, "left")
    return joined.groupBy("a.page", "a.col_idx").agg(F.round(F.coalesce(F.sum(F.col("b.b") - F.col("b.t")), F.lit(0.0)), 4).alias("body"), F.round(F.coalesce(F.max("b.score"), F.lit(0.0)), 4).alias("top_score"))


@query("S13 M47 R02", f"""
WITH {BOXES} SELECT DISTINCT h1.page, h1.l, h1.t, h1.r, h2.t AS b FROM boxes h1 JOIN boxes h2 ON h1.page = h2.page AND abs(h1.l - h2.l) <= 2 AND h2.t > h1.t + 3 JOIN boxes v ON v.page = h1.page AND abs(v.l - h1.l) <= 2 AND v.t <= h1.t AND v.b >= h2.t""")
def stroke_rectangles(t: Tables) -> DataFrame:
    a, b = t.boxes().alias("a"), t.boxes().alias("b")
    tops = a.join(b, (F.col("a.page") == F.col("b.page")) & (F.abs(F.col("a.l") - F.col("b.l")) <= 2) & (F.col("b.t") > F.col("a.t") + 3)).select("a.page", "a.l", "a.t", "a.r", F.col("b.t").alias("b"))
    v = t.boxes().select("page", F.col("l").alias("vl"), F.col("t").alias("vt"), F.col("b").alias("vb"))
    on = (F.col("h.page") == F.col("v.page")) & (F.abs(F.col("v.vl") - F.col("h.l")) <= 2) & (F.col("v.vt") <= F.col("h.t")) & (F.col("v.vb") >= F.col("h.b"))
    return tops.alias("h").join(v.alias("v"), on, "left_semi").distinct()


_BOX = "id BIGINT, l DOUBLE, t DOUBLE, r DOUBLE, b DOUBLE"


def _greedy(order: str, state: str, first: str, step: str, also: str = "", last: str = "") -> str:
    """Recursive SQL that walks the boxes ``c`` of each page in an order and folds them into the list ``kept``."""
    return f"""
WITH RECURSIVE {BOXES}, c AS (SELECT *, (r - l) * (b - t) AS size, row_number() OVER (PARTITION BY page ORDER BY {order}) AS k FROM boxes),
s AS (SELECT page, 0::BIGINT AS k, CAST([] AS {state}) AS kept{first} FROM (SELECT DISTINCT page FROM boxes)
 UNION ALL SELECT s.page, c.k, {step} AS kept{also} FROM s JOIN c ON c.page = s.page AND c.k = s.k + 1),
done AS (SELECT page, max_by(kept, k) AS kept FROM s GROUP BY 1)
{last}"""


def _meets(x: str) -> str:
    return f"(greatest(0, least({x}.r, c.r) - greatest({x}.l, c.l)) * greatest(0, least({x}.b, c.b) - greatest({x}.t, c.t)))"


_THIS = "{'id': c.id, 'l': c.l, 't': c.t, 'r': c.r, 'b': c.b}"
_SURVIVORS = "SELECT boxes.* FROM boxes JOIN done ON done.page = boxes.page AND list_contains(list_transform(kept, lambda x: x.id), boxes.id)"


@query("T06", f"""
WITH RECURSIVE {BOXES}, k AS (SELECT *, (r - l) * (b - t) AS size, CASE WHEN col % 2 = 0 THEN 'article' WHEN col % 3 = 0 THEN 'photo' ELSE 'display_ad' END AS kind FROM boxes), o AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY kind, id) AS n FROM k),
pairs AS (SELECT a.page, a.id AS i, b.id AS j, a.kind AS ki, b.kind AS kj, row_number() OVER (PARTITION BY a.page ORDER BY a.n, b.n) AS k, a.size < b.size AS first_inside FROM o a JOIN o b ON a.page = b.page AND a.n < b.n
  AND ((a.l >= b.l AND a.t >= b.t AND a.r <= b.r AND a.b <= b.b AND a.size < b.size) OR (b.l >= a.l AND b.t >= a.t AND b.r <= a.r AND b.b <= a.b AND b.size < a.size))),
e AS (SELECT *, CASE WHEN first_inside = (CASE WHEN first_inside THEN ki = 'article' AND kj = 'display_ad' ELSE kj = 'article' AND ki = 'display_ad' END) THEN j ELSE i END AS loser FROM pairs),
s AS (SELECT page, 0::BIGINT AS k, CAST([] AS BIGINT[]) AS gone FROM (SELECT DISTINCT page FROM boxes) UNION ALL SELECT s.page, e.k, CASE WHEN list_contains(gone, e.i) OR list_contains(gone, e.j) THEN gone ELSE list_append(gone, e.loser) END FROM s JOIN e ON e.page = s.page AND e.k = s.k + 1),
done AS (SELECT page, max_by(gone, k) AS gone FROM s GROUP BY 1) SELECT id, page FROM boxes JOIN done USING (page) WHERE NOT list_contains(gone, id)""")
def framed_articles(t: Tables) -> DataFrame:
    kind = F.when(F.col("col") % 2 == 0, "article").when(F.col("col") % 3 == 0, "photo").otherwise("display_ad")
    return G.drop_nested(t.boxes().withColumn("kind", kind), "page", "id", "kind").select("id", "page")


@query("U04", f"""
WITH {BOXES}, g AS (SELECT *, range(CAST(floor(l / 20) AS BIGINT), CAST(floor(r / 20) AS BIGINT) + 1) AS blocks FROM boxes),
i AS (SELECT a.id, list_sort(list_distinct(flatten(list(b.blocks)))) AS covered FROM g a JOIN g b ON a.page = b.page AND a.id <> b.id AND b.l >= a.l - 0.5 AND b.r <= a.r + 0.5 AND b.t >= a.t - 0.5 AND b.b <= a.b + 0.5 GROUP BY 1)
SELECT g.id FROM g JOIN i USING (id) WHERE covered = blocks""")
def enclosing_regions(t: Tables) -> DataFrame:
    blocks = F.sequence(F.floor(F.col("l") / 20), F.floor(F.col("r") / 20))
    regions = t.boxes().withColumn("blocks", blocks)
    a, b = Box.of("a."), Box.of("b.")
    inside = (F.col("a.id") != F.col("b.id")) & C.contains(a, b, 0.5)
    found = box_pairs(regions, regions, "page", inside).groupBy(F.col("a.id").alias("id")).agg(F.first("a.blocks").alias("own"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("b.blocks")))).alias("covered"))
    return found.where(F.col("covered") == F.col("own")).select("id")


@query("T03", _greedy("(r - l) * (b - t) DESC, id", f"STRUCT({_BOX})[]", "", f"CASE WHEN c.size > 0 AND len(list_filter(kept, lambda x: {_meets('x')} > 0.8 * c.size)) > 0 THEN kept ELSE list_append(kept, {_THIS}) END", last=_SURVIVORS))
def contained_ads_dropped(t: Tables) -> DataFrame:
    return G.drop_contained(t.boxes(), "page", "id")


@query("T04", _greedy("score DESC, id", f"STRUCT({_BOX})[]", "", f"CASE WHEN len(list_filter(kept, lambda x: {_meets('x')} > 0 AND {_meets('x')} > 0.3 * (c.size + (x.r - x.l) * (x.b - x.t) - {_meets('x')}))) > 0 THEN kept ELSE list_append(kept, {_THIS}) END", last=_SURVIVORS))
def suppressed_hits(t: Tables) -> DataFrame:
    return G.suppress(t.boxes(), "page", "id", "score")


_HOLDS = "list_filter(kept, lambda x: c.l >= x.l - 0.5 AND c.t >= x.t - 0.5 AND c.r <= x.r + 0.5 AND c.b <= x.b + 0.5)"


@query("T07", _greedy("(r - l) * (b - t) DESC, id", f"STRUCT({_BOX})[]", ", NULL::BIGINT AS id, NULL::BIGINT AS \"into\"", f"CASE WHEN len({_HOLDS}) > 0 THEN kept ELSE list_append(kept, {_THIS}) END", f", c.id, {_HOLDS}[1].id", "SELECT id, \"into\" FROM s WHERE k > 0"))
def absorbed_articles(t: Tables) -> DataFrame:
    return G.absorb(t.boxes(), "page", "id").select("id", "into")


@query("T08", f"""
WITH {BOXES} SELECT a.id, a.t, coalesce(min(b.t), any_value(a.b)) AS b FROM boxes a LEFT JOIN boxes b ON a.page = b.page AND b.t > a.t AND b.t < a.b AND least(a.r, b.r) > greatest(a.l, b.l) GROUP BY 1, 2""")
def clipped_articles(t: Tables) -> DataFrame:
    return G.clip_overlaps(t.boxes(), "page", "id").select("id", "t", "b")


_LINE = "list_filter(range(1, len(kept) + 1), lambda i: abs(kept[i].t - c.t) <= 0.5 AND c.l <= kept[i].r + 2)"


@query("T09 M49 M56", _greedy("l, t, id", f"STRUCT({_BOX}, n BIGINT)[]", "", f"""CASE WHEN len({_LINE}) = 0 THEN list_append(kept, {_THIS[:-1]}, 'n': 1}}) ELSE list_transform(kept, lambda m, i: CASE WHEN i = {_LINE}[1]
 THEN {{'id': m.id, 'l': m.l, 't': m.t, 'r': greatest(m.r, c.r), 'b': greatest(m.b, c.b), 'n': m.n + 1}} ELSE m END) END""", last="SELECT page, m.id, m.l, m.t, m.r, m.b, m.n FROM (SELECT page, unnest(kept) AS m FROM done)"))
def merged_fragments(t: Tables) -> DataFrame:
    return G.merge_fragments(t.boxes(), "page", "id")


@query("T11 I17", f"""
WITH RECURSIVE {BOXES}, x AS (SELECT a.page, a.id, list(b.id) AS others FROM boxes a JOIN boxes b ON a.page = b.page AND a.id <> b.id AND {MEET} > 0 AND NOT (a.l >= b.l AND a.t >= b.t AND a.r <= b.r AND a.b <= b.b) AND NOT (b.l >= a.l AND b.t >= a.t AND b.r <= a.r AND b.b <= a.b) GROUP BY 1, 2),
s AS (SELECT page, 0 AS k, list({{'id': x.id, 'score': -score, 'size': -(r - l) * (b - t), 'others': others}}) AS live, NULL::BIGINT AS gone, 1 AS n FROM x JOIN boxes USING (page, id) GROUP BY 1
 UNION ALL SELECT page, k + 1, list_filter(live, lambda m: m.id <> top.id), top.id, top.n FROM (SELECT page, k, live, list_reverse_sort(list_transform(live, lambda m: {{'n': len(list_intersect(m.others, list_transform(live, lambda o: o.id))), 'score': m.score, 'size': m.size, 'id': m.id}}))[1] AS top FROM s) WHERE top.n > 0)
SELECT * FROM boxes WHERE id NOT IN (SELECT gone FROM s WHERE gone IS NOT NULL)""")
def crossings_resolved(t: Tables) -> DataFrame:
    return G.resolve_crossings(t.boxes(), "page", "id", "score")


_SEED = "list_filter(range(1, len(kept) + 1), lambda i: abs(kept[i] - c.l) <= 3)"


@query("W11 Q15", _greedy("l, id", "DOUBLE[]", ", NULL::BIGINT AS id, NULL::BIGINT AS spot", f"CASE WHEN len({_SEED}) = 0 THEN list_append(kept, c.l) ELSE kept END", f", c.id, coalesce({_SEED}[1], len(kept) + 1) - 1", 'SELECT id, spot AS "group" FROM s WHERE k > 0'))
def seeded_columns(t: Tables) -> DataFrame:
    return G.seed_groups(t.boxes(), "page", "id").select("id", "group")


@query("P25 I06")
def union_outlines(t: Tables) -> DataFrame:
    return G.outlines(t.boxes(), "page")


@query("R03 R04 R08 R09 I18", f"""
WITH {BOXES}, offsets AS (SELECT 8 + i * 0.25::DOUBLE AS pitch, j * 0.25::DOUBLE AS o FROM range(48) AS p(i), range(80) AS q(j) WHERE j < 32 + i),
hits AS (SELECT l, pitch, o FROM (SELECT DISTINCT l FROM boxes) CROSS JOIN offsets WHERE abs(((l - o + pitch / 2) % pitch + pitch) % pitch - pitch / 2) <= 0.6),
h AS (SELECT page, pitch, o, count(*) AS k FROM boxes JOIN hits USING (l) GROUP BY ALL), n AS (SELECT page, count(*) AS n FROM boxes GROUP BY 1),
s AS (SELECT *, round((k / n - least(1, 1.2::DOUBLE / pitch)) / greatest(1 - least(1, 1.2::DOUBLE / pitch), 1e-9), 6) AS score FROM h JOIN n USING (page))
SELECT page, b.pitch AS pitch, b.o AS "offset", b.score AS score, n FROM (SELECT page, any_value(n) AS n, max({{'score': score, 'p': -pitch, 'q': -o, 'pitch': pitch, 'o': o}}) AS b FROM s GROUP BY 1)""")
def fitted_lattices(t: Tables) -> DataFrame:
    return G.lattice(t.boxes().select("page", "l"), "page", "l")


@query("R10 R12 M58 M37", f"""
WITH RECURSIVE {BOXES}, g AS (SELECT DISTINCT page, CAST(trunc(l / 4) AS BIGINT) AS x, CAST(trunc(t / 4) AS BIGINT) AS y FROM boxes), c AS (SELECT DISTINCT page, x, y FROM g),
r AS (SELECT page, x, y, x * 1000 + y AS root FROM c UNION SELECT c.page, c.x, c.y, r.root FROM r JOIN c ON c.page = r.page AND abs(c.x - r.x) <= 1 AND abs(c.y - r.y) <= 1),
m AS (SELECT page, x, y, min(root) AS root FROM r GROUP BY 1, 2, 3), p AS (SELECT page, root, count(*) AS n, round(avg(x), 4) AS cx, round(avg(y), 4) AS cy FROM m GROUP BY 1, 2)
SELECT page, row_number() OVER (PARTITION BY page ORDER BY root) - 1 AS component, n, cx, cy FROM p""")
def marked_components(t: Tables) -> DataFrame:
    cells = t.boxes().select("page", (F.col("l") / 4).cast("int").alias("x"), (F.col("t") / 4).cast("int").alias("y"))
    return G.flood_components(cells, "page", "x", "y")


@query("A60", """
WITH e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, value - avg(value) OVER (PARTITION BY user_id) AS v FROM events WHERE value IS NOT NULL), p AS (SELECT user_id, sum(v * v) AS power, count(*) AS n FROM e GROUP BY 1),
a AS (SELECT user_id, lag, coalesce(sum(x.v * y.v), 0) / any_value(power) AS r FROM p CROSS JOIN range(10, 61) AS g(lag) LEFT JOIN e x USING (user_id) LEFT JOIN e y ON y.user_id = x.user_id AND y.i = x.i + lag WHERE power > 1e-10 GROUP BY 1, 2),
q AS (SELECT user_id, list(r ORDER BY lag) AS r FROM a GROUP BY 1), k AS (SELECT user_id, r, unnest(range(2, 51)) AS k FROM q),
f AS (SELECT *, coalesce(list_max(list_filter(range(1, k), lambda i: r[i] > r[k])), 0) AS lo, coalesce(list_min(list_filter(range(k + 1, 52), lambda i: r[i] > r[k])), 52) AS hi FROM k WHERE r[k - 1] < r[k] AND r[k] > r[k + 1]),
b AS (SELECT user_id, min(k) AS k FROM f WHERE r[k] - greatest(list_min(r[lo + 1:k - 1]), list_min(r[k + 1:hi - 1])) >= 0.03 GROUP BY 1)
SELECT p.user_id, k + 9 AS lag, round(r[k], 6) AS strength FROM p LEFT JOIN b USING (user_id) LEFT JOIN q USING (user_id)""")
def periodic_zones(t: Tables) -> DataFrame:
    return G.first_peak(t.events.select("user_id", "event_id", "value").where("value is not null"), "user_id", "event_id", "value")
