"""Page judgements, tickets and profiles."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import columns as C
from ..operators import pages as P
from .catalog import BOXES, Tables, query


@query("P42 X21", """
SELECT p_partkey, CAST(coalesce(TRY_CAST(printf('%04d-%02d-%02d', 1900 + p_size, p_partkey % 14, p_partkey % 33) AS DATE) IS NOT NULL AND p_partkey % 1100 BETWEEN 1 AND 999, false) AS BIGINT) AS valid FROM part""")
def validated_dates(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select("p_partkey", P.valid_date_page(1900 + F.col("p_size"), k % 14, k % 33, k % 1100).cast("bigint").alias("valid"))


@query("P39 S11 A39", """
SELECT l_suppkey, CASE WHEN count(*) < 100 AND avg(l_discount) > 0.05 THEN 'image_only' WHEN count(*) * 10 > 800 AND sum(CASE WHEN l_quantity < 22 THEN 10 ELSE 0 END) > 0.4 * count(*) * 10 THEN 'classifieds' ELSE 'modular' END AS page_type FROM lineitem WHERE l_quantity >= 1 GROUP BY 1""")
def page_types(t: Tables) -> DataFrame:
    facts = t.lineitem.where("l_quantity >= 1").groupBy("l_suppkey").agg((F.count("*") * 10).alias("spans"), (F.count_if(F.col("l_quantity") < 22) * 10).alias("small"), F.avg("l_discount").alias("image"))
    return facts.select("l_suppkey", P.page_type(F.when(F.col("spans") < 1000, F.col("spans") / 10.0).otherwise(F.col("spans")), F.col("small"), F.col("image") * 10).alias("page_type"))


@query("M53 M54", f"""
WITH {BOXES} SELECT id, CASE WHEN r - l >= 0.8 * 40 THEN 2 ELSE 1 END AS weight,
 CAST(round(CASE WHEN abs(l - greatest(1, least(5, round(l / (100.0 / 6), 0))) * (100.0 / 6)) <= 0.1 * (100.0 / 6) THEN 0.5 ELSE 0 END + CASE WHEN abs(l - greatest(1, least(6, round(l / (100.0 / 7), 0))) * (100.0 / 7)) <= 0.1 * (100.0 / 7) THEN 0.1 ELSE 0 END
  + CASE WHEN abs(l - greatest(1, least(7, round(l / (100.0 / 8), 0))) * (100.0 / 8)) <= 0.1 * (100.0 / 8) THEN 0.2 ELSE 0 END, 2) AS DOUBLE) AS prior FROM boxes""")
def band_priors(t: Tables) -> DataFrame:
    return t.boxes().select("id", P.band_weight(F.col("l"), F.col("r"), F.lit(40.0)).alias("weight"), F.round(P.column_count_prior(F.col("l"), F.lit(0.0), F.lit(100.0)), 2).alias("prior"))


@query("M43 A53 M42", """
SELECT l_suppkey, round((0.4 * avg(CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.0 END) + 0.3 * avg(CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END) + 0.3 * greatest(0.0, 1 - stddev_pop(l_quantity) / avg(l_quantity))) * (1 - avg(CASE WHEN l_quantity > 45 THEN 1.0 ELSE 0.0 END)), 4) AS confidence FROM lineitem GROUP BY 1""")
def composite_confidence(t: Tables) -> DataFrame:
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    regular = F.greatest(F.lit(0.0), 1 - F.stddev_pop("l_quantity") / F.avg("l_quantity"))
    return t.lineitem.groupBy("l_suppkey").agg(P.confidence(share(F.col("l_returnflag") == "A"), share(F.col("l_linestatus") == "F"), regular, 1 - share(F.col("l_quantity") > 45)).alias("confidence"))


@query("A61 P31 P40", """
SELECT vec_id, round(list_avg(CAST(embedding[1:16] AS DOUBLE[])), 4) AS first_mean, round(list_avg(CAST(embedding[49:64] AS DOUBLE[])), 4) AS last_mean, CAST(list_avg(list_transform(embedding[1:8], lambda x: x * 10 + 250)) > 248 AND list_stddev_pop(list_transform(CAST(embedding[1:8] AS DOUBLE[]), lambda x: x * 10 + 250)) < 8 AS BIGINT) AS masked,
 CASE WHEN len(list_filter(embedding, lambda x: x < -0.1)) / 64.0 < 0.05 THEN 'empty' WHEN len(list_filter(embedding, lambda x: x < -0.1)) / 64.0 < 0.45 THEN 'text' ELSE 'photo' END AS pattern FROM embeddings""")
def profile_statistics(t: Tables) -> DataFrame:
    e = F.transform("embedding", lambda x: x.cast("double"))
    head = F.transform(F.slice(e, 1, 8), lambda x: x * 10 + 250)
    dark = F.transform("embedding", lambda x: F.when(x < -0.1, 0.0).otherwise(1.0))
    return t.embeddings.select("vec_id", F.round(P.slice_mean(e, F.lit(0), F.lit(16)), 4).alias("first_mean"), F.round(P.slice_mean(e, F.lit(48), F.lit(64)), 4).alias("last_mean"), P.is_masked(head).cast("bigint").alias("masked"), P.pattern(dark, 0.5).alias("pattern"))


@query("M52 W09", """
WITH c AS (SELECT vec_id, unnest(range(64)) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings), g AS (SELECT *, pos - row_number() OVER (PARTITION BY vec_id ORDER BY pos) AS base FROM c WHERE x < 0)
SELECT vec_id, CAST(min(pos) AS BIGINT) AS start, CAST(max(pos) + 1 AS BIGINT) AS stop, round(min(x), 4) AS depth FROM g GROUP BY vec_id, base HAVING count(*) >= 3""")
def profile_valleys(t: Tables) -> DataFrame:
    profiles = t.embeddings.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("p"))
    return P.valleys(profiles, "vec_id", "p", 0.0, 3).select("vec_id", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("stop"), F.round("depth", 4).alias("depth"))


@query("T05", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), s AS (SELECT vec_id, y, x, round((e[y * 8 + x + 1] * e[1] + e[y * 8 + x + 2] * e[2] + e[y * 8 + x + 9] * e[3] + e[y * 8 + x + 10] * e[4]) / 4, 4) AS score FROM e, range(0, 7) AS a(y), range(0, 7) AS b(x))
SELECT vec_id, max(score) AS best, count(*) FILTER (score > 0.01) AS hits FROM s GROUP BY 1""")
def slid_windows(t: Tables) -> DataFrame:
    e = F.transform("embedding", lambda x: x.cast("double"))
    rows = t.embeddings.select("vec_id", e.alias("g"))
    found = rows.select("vec_id", F.explode(P.window_matches(F.col("g"), F.slice("g", 1, 4), 8, 8, 8, 2)).alias("m"))
    return found.groupBy("vec_id").agg(F.max("m.score").alias("best"), F.count_if(F.col("m.score") > 0.01).alias("hits"))


@query("M62", f"""
WITH {BOXES}, g AS (SELECT *, CASE WHEN l - lag(l) OVER (PARTITION BY page ORDER BY l, id) > 4 THEN 1 ELSE 0 END AS j FROM boxes), i AS (SELECT *, sum(j) OVER (PARTITION BY page ORDER BY l, id ROWS UNBOUNDED PRECEDING) AS island FROM g)
SELECT page, l, score FROM (SELECT *, row_number() OVER (PARTITION BY page, island ORDER BY score DESC, l) AS rk FROM i) WHERE rk = 1""")
def narrow_merged(t: Tables) -> DataFrame:
    return P.merge_narrow(t.boxes().select("page", "l", "score"), "page", "l", "score", 4.0).select("page", "l", "score")


@query("A54 M39", """
WITH x AS (SELECT l_suppkey AS page, CAST(l_partkey % 90 AS DOUBLE) AS l, CAST(l_partkey % 90 AS DOUBLE) + 5 AS r FROM lineitem), b AS (SELECT page, CAST(floor(l / 3) AS BIGINT) AS bin, count(*) AS n, sum(l) AS s FROM x GROUP BY 1, 2),
k AS (SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY page) AS tot FROM b) WHERE n >= 0.04 * tot), g AS (SELECT *, CASE WHEN bin - lag(bin) OVER (PARTITION BY page ORDER BY bin) > 1 THEN 1 ELSE 0 END AS j FROM k), i AS (SELECT *, sum(j) OVER (PARTITION BY page ORDER BY bin ROWS UNBOUNDED PRECEDING) AS island FROM g)
SELECT page, round(sum(s) / sum(n), 4) AS boundary FROM i GROUP BY page, island UNION ALL SELECT page, round(max(r), 4) FROM x GROUP BY 1""")
def left_edge_columns(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_suppkey").alias("page"), (F.col("l_partkey") % 90).cast("double").alias("l"))
    return P.left_edge_boundaries(lines.withColumn("r", F.col("l") + 5), "page", "l", "r", 3.0, 0.04)


@query("M40 M33", """
WITH m AS (SELECT l_suppkey, median(l_quantity) AS m FROM lineitem GROUP BY 1) SELECT l_suppkey, count(*) AS n, round(avg(l_quantity), 4) AS mean FROM lineitem JOIN m USING (l_suppkey) WHERE abs(l_quantity - m) <= 0.25 * m GROUP BY 1""")
def body_text_lines(t: Tables) -> DataFrame:
    return P.body_lines(t.lineitem.select("l_suppkey", "l_quantity"), "l_suppkey", "l_quantity").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.round(F.avg("l_quantity"), 4).alias("mean"))


@query("M44 M59", f"""
WITH {BOXES}, p AS (SELECT a.page, a.id AS top_id, b.id AS bottom_id, a.l, a.t, a.r, b.t AS b, row_number() OVER (PARTITION BY a.page, a.id ORDER BY b.t, b.id) AS k FROM boxes a JOIN boxes b ON a.page = b.page AND abs(a.l - b.l) <= 4 AND abs(a.r - b.r) <= 8 AND b.t >= a.t + 3)
SELECT page, top_id, bottom_id, l, t, r, b FROM p WHERE k = 1""")
def paired_rules(t: Tables) -> DataFrame:
    wide = t.boxes()
    a, b = wide.alias("a"), wide.alias("b")
    on = (F.col("a.page") == F.col("b.page")) & (F.abs(F.col("a.l") - F.col("b.l")) <= 4) & (F.abs(F.col("a.r") - F.col("b.r")) <= 8) & (F.col("b.t") >= F.col("a.t") + 3)
    best = a.join(b, on).groupBy("a.page", F.col("a.id").alias("top_id")).agg(F.min(F.struct("b.t", "b.id", "a.l", F.col("a.t").alias("top"), "a.r")).alias("m"))
    return best.select("page", "top_id", F.col("m.id").alias("bottom_id"), F.col("m.l").alias("l"), F.col("m.top").alias("t"), F.col("m.r").alias("r"), F.col("m.t").alias("b"))


@query("X08 J23", """
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 1 THEN s_suppkey + 1000 ELSE s_suppkey END AS keep, CASE WHEN s_suppkey % 3 = 1 THEN s_suppkey ELSE s_suppkey + 1000 END AS "drop" FROM supplier""")
def preferred_spellings(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    a = F.when(k % 3 == 0, "Harbour Centre").otherwise("Harbor Center")
    b = F.when(k % 3 == 1, "Harbour Centre").otherwise("Harbor Center")
    return t.supplier.select("s_suppkey", P.preferred_spelling(k, a, k + 1000, b).alias("p")).select("s_suppkey", "p.keep", "p.drop")


@query("E04 S22", """
WITH t AS (SELECT lower(p_name) AS term, max(p_type) AS c FROM part GROUP BY 1) SELECT p_partkey, CASE WHEN p_size % 5 = 0 OR p_type = c THEN 'enrich' ELSE 'review' END AS action FROM part JOIN t ON term = lower(p_name)""")
def nomenclature_gaps(t: Tables) -> DataFrame:
    terms = t.part.groupBy(F.lower("p_name").alias("term")).agg(F.max("p_type").alias("term_category"))
    products = t.part.select("p_partkey", "p_name", F.when(F.col("p_size") % 5 != 0, F.col("p_type")).alias("category"))
    return P.vocabulary_gaps(products, terms, "p_name", "category").select("p_partkey", "action")


@query("X22", r"""
WITH e AS (SELECT doc_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS x FROM documents),
r AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(x, '(?m)^-{2,}$', '<hr>', 'g'), '(?m)^## (.*)$', '<h2>\1</h2>', 'g'), '(?m)^# (.*)$', '<h1>\1</h1>', 'g') AS x FROM e),
i AS (SELECT doc_id, regexp_replace(regexp_replace(x, '\*\*([^*\n]+)\*\*', '<b>\1</b>', 'g'), '\*([^*\n]+)\*', '<i>\1</i>', 'g') AS x FROM r)
SELECT doc_id, CASE WHEN x IS NOT NULL THEN array_to_string(list_transform(list_filter(regexp_split_to_array(x, '\n\s*\n'), lambda b: trim(b) <> ''), lambda b: CASE WHEN regexp_matches(b, '^<(h[12]|hr)>') THEN b ELSE '<p>' || b || '</p>' END), chr(10)) END AS html FROM i""")
def rendered_transcripts(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", P.render_html(F.col("text")).alias("html"))


@query("I03 I04 I05 I07 I02", """
WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS plan, CASE WHEN o_orderkey % 7 = 0 THEN 'fixed' ELSE o_orderpriority END AS h, o_orderstatus AS t FROM orders)
SELECT plan, arg_min(h, o_orderkey) AS headline, string_agg(t, chr(10) ORDER BY o_orderkey) AS full_text, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS sources FROM x GROUP BY 1""")
def third_pass_items(t: Tables) -> DataFrame:
    merges = t.orders.where("o_orderkey % 4 = 1").selectExpr("o_orderkey as item", "o_orderkey - 1 as plan")
    fixes = t.orders.where("o_orderkey % 7 = 0").selectExpr("o_orderkey as item", "'fixed' as new_headline")
    out = P.tidy_plans(t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"), merges, fixes, "o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderkey")
    return out.withColumn("sources", F.array_join("sources", ","))


@query("M73", """
SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus <> 'O' AND lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 'P' THEN lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) END AS continued_from FROM orders""")
def continued_items(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", (F.col("o_orderstatus") == "P").alias("open_end"), (F.col("o_orderstatus") != "O").alias("open_start"))
    return P.continuations(rows, "o_custkey", "o_orderkey", "open_end", "open_start").select("o_custkey", "o_orderkey", "continued_from")


@query("K14 K15 M22 M25 I21", """
SELECT 'column' AS target_kind, '{"l_linenumber":' || l_linenumber || ',"l_orderkey":' || l_orderkey || '}' AS target_ref, CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'late' END AS description, 'open' AS status
FROM lineitem WHERE l_returnflag = 'R' OR (l_linestatus = 'F' AND l_quantity > 48)""")
def raised_repairs(t: Tables) -> DataFrame:
    reason = F.when(F.col("l_returnflag") == "R", "returned").when((F.col("l_linestatus") == "F") & (F.col("l_quantity") > 48), "late")
    return P.repair_tickets(t.lineitem, "column", ["l_orderkey", "l_linenumber"], reason)


@query("K31", """
WITH f AS (SELECT 'f' || (c_custkey % 50) || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '.v' || (c_custkey % 4 + 1) || '.bak' END AS name FROM customer), s AS (SELECT regexp_replace(name, '[.]v[0-9]+[.]bak$', '') AS file, TRY_CAST(nullif(regexp_extract(name, '[.]v([0-9]+)[.]bak$', 1), '') AS INTEGER) AS v FROM f)
SELECT file, file || '.v' || (coalesce(max(v), 0) + 1) || '.bak' AS backup FROM s GROUP BY 1""")
def next_backup_names(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    tail = F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(".v"), (k % 4 + 1).cast("string"), F.lit(".bak")))
    return P.versioned_name(t.customer.select(F.concat(F.lit("f"), (k % 50).cast("string"), tail).alias("name")), "name")


@query("I12 I11", f"""
WITH {BOXES} SELECT page, string_agg(id || '@' || CAST(round_even(l / 100 * 800, 0) AS BIGINT) || ',' || CAST(round_even(t / 100 * 1200, 0) AS BIGINT), ';' ORDER BY id) AS ticket FROM boxes WHERE score < 40 GROUP BY 1""")
def items_tickets(t: Tables) -> DataFrame:
    line = F.concat(F.col("id").cast("string"), F.lit("@"), C.to_pixels(F.col("l"), F.lit(800)).cast("string"), F.lit(","), C.to_pixels(F.col("t"), F.lit(1200)).cast("string"))
    g = t.boxes().where("score < 40").groupBy("page").agg(F.array_sort(F.collect_list(F.struct("id", line.alias("x")))).alias("xs"))
    return g.select("page", F.array_join(F.transform("xs", lambda s: s["x"]), ";").alias("ticket"))


@query("I13 I14 M05 M07 M20 M29", """
SELECT o_custkey AS issue, count(DISTINCT o_orderkey) AS pages, CAST(sum(CASE WHEN l.k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS pending, CASE WHEN sum(CASE WHEN l.k IS NULL THEN 1 ELSE 0 END) = 0 THEN 'done' WHEN sum(CASE WHEN l.k IS NULL THEN 1 ELSE 0 END) = count(*) THEN 'pending' ELSE 'partial' END AS status
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linestatus = 'F') l ON l.k = o_orderkey GROUP BY 1""")
def issue_page_status(t: Tables) -> DataFrame:
    parsed = t.lineitem.where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("k")).distinct()
    pending = F.count_if(F.col("k").isNull())
    g = t.orders.join(parsed, F.col("o_orderkey") == F.col("k"), "left").groupBy(F.col("o_custkey").alias("issue")).agg(F.count("*").alias("pages"), pending.alias("pending"))
    return g.withColumn("status", F.when(F.col("pending") == 0, "done").when(F.col("pending") == F.col("pages"), "pending").otherwise("partial"))


@query("I15 M30 M31 I19", f"""
WITH {BOXES}, c AS (SELECT a.id, count(b.id) AS n FROM boxes a LEFT JOIN boxes b ON a.page = b.page AND a.id <> b.id AND abs(a.l - b.l) <= 2 GROUP BY 1)
SELECT boxes.id, CASE WHEN NOT (l < 4 OR r > 75) THEN 'inside' WHEN n = 0 THEN 'sliver' WHEN n = 1 THEN 'suspect' ELSE 'aligned' END AS verdict FROM boxes JOIN c USING (id)""")
def sliver_verdicts(t: Tables) -> DataFrame:
    from ..operators.relations import box_pairs
    close = (F.col("a.id") != F.col("b.id")) & (F.abs(F.col("a.l") - F.col("b.l")) <= 2)
    n = box_pairs(t.boxes(), t.boxes(), "page", close, "left").groupBy(F.col("a.id").alias("id"), F.col("a.l").alias("l"), F.col("a.r").alias("r")).agg(F.count("b.id").alias("n"))
    rim = (F.col("l") < 4) | (F.col("r") > 75)
    return n.select("id", F.when(~rim, "inside").when(F.col("n") == 0, "sliver").when(F.col("n") == 1, "suspect").otherwise("aligned").alias("verdict"))


@query("I01 P49", f"""
WITH {BOXES}, s AS (SELECT page, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b FROM boxes GROUP BY 1) SELECT s.page, s.l, s.r, coalesce((SELECT max(x.t) FROM boxes x WHERE x.page = s.page AND x.t <= s.t + 1.5), s.t) AS t, s.b FROM s""")
def item_boxes(t: Tables) -> DataFrame:
    hull = t.boxes().groupBy("page").agg(F.min("l").alias("l"), F.min("t").alias("t"), F.max("r").alias("r"), F.max("b").alias("b"))
    edges = t.boxes().select(F.col("page").alias("p"), F.col("t").alias("edge"))
    snapped = hull.join(edges, (F.col("page") == F.col("p")) & (F.col("edge") <= F.col("t") + 1.5)).groupBy("page", "l", "t", "r", "b").agg(F.max("edge").alias("s"))
    return snapped.select("page", "l", "r", F.coalesce("s", "t").alias("t"), "b")


@query("M36 K20 M38", f"""
WITH {BOXES}, c AS (SELECT page, min(l) AS cl, max(r) AS cr FROM boxes WHERE score >= 10 GROUP BY 1) SELECT id FROM boxes JOIN c USING (page) WHERE r > cl - 4 AND l < cr + 4""")
def within_content(t: Tables) -> DataFrame:
    box = t.boxes().where("score >= 10").groupBy("page").agg(F.min("l").alias("cl"), F.max("r").alias("cr"))
    return t.boxes().join(box, "page").where("r > cl - 4 and l < cr + 4").select("id")


@query("M63", f"""
WITH {BOXES} SELECT a.id, CASE WHEN a.score >= 30 THEN 2.0 WHEN a.score >= 15 THEN 1.0 ELSE 0.5 END AS weight FROM boxes a WHERE NOT EXISTS (SELECT 1 FROM boxes b WHERE b.page = a.page AND b.col >= 6 AND b.id <> a.id AND (a.l + a.r) / 2 BETWEEN b.l AND b.r)""")
def strip_detections(t: Tables) -> DataFrame:
    from ..operators.relations import box_pairs
    inside = (F.col("a.id") != F.col("b.id")) & ((F.col("a.l") + F.col("a.r")) / 2).between(F.col("b.l"), F.col("b.r"))
    left = box_pairs(t.boxes(), t.boxes().where("col >= 6"), "page", inside, "left_anti")
    return left.select("id", F.when(F.col("score") >= 30, 2.0).when(F.col("score") >= 15, 1.0).otherwise(0.5).alias("weight"))


@query("M17 M18 S14", """
SELECT user_id, CAST(ts AS DATE) AS run, count(*) AS n_calls, max_by(event_type, event_id) AS last_kind, round(sum(value), 4) AS tokens, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS tool_calls FROM events GROUP BY 1, 2""")
def run_usage(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", F.to_date("ts").alias("run")).agg(F.count("*").alias("n_calls"), F.max_by("event_type", "event_id").alias("last_kind"), F.round(F.sum("value"), 4).alias("tokens"), F.count_if(F.col("event_type") == "click").alias("tool_calls"))


@query("M70 K04 M14", """
WITH b AS (SELECT l_orderkey AS page, list_sort(list_distinct(list(CAST(l_suppkey % 100 AS DOUBLE)))) AS bs FROM lineitem GROUP BY 1)
SELECT page, CAST(len(bs) - 1 AS BIGINT) AS num_columns, round(bs[len(bs)] - bs[1], 4) AS extent FROM b WHERE len(bs) >= 2""")
def recorded_layouts(t: Tables) -> DataFrame:
    b = t.lineitem.groupBy(F.col("l_orderkey").alias("page")).agg(F.array_sort(F.collect_set((F.col("l_suppkey") % 100).cast("double"))).alias("bs")).where(C.ascending(F.col("bs")))
    return b.select("page", (F.size("bs") - 1).cast("bigint").alias("num_columns"), F.round(F.aggregate(C.widths(F.col("bs")), F.lit(0.0), lambda a, x: a + x), 4).alias("extent"))


@query("M65 M68 M69", f"""
WITH {BOXES} SELECT id, o_orderstatus AS issue_status, round(l - 1, 2) AS crop_left, round(r - l + 2, 2) AS crop_width FROM boxes JOIN orders ON o_orderkey = page WHERE o_orderstatus <> 'P'""")
def crop_regions(t: Tables) -> DataFrame:
    issues = t.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("page"), F.col("o_orderstatus").alias("issue_status"))
    return t.boxes().join(issues, "page").select("id", "issue_status", F.round(F.col("l") - 1, 2).alias("crop_left"), F.round(F.col("r") - F.col("l") + 2, 2).alias("crop_width"))


@query("M13 M23", """
SELECT c_custkey, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE lower(n_name) IN (SELECT DISTINCT lower(n_name) FROM nation WHERE n_regionkey <= 2) AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def known_places(t: Tables) -> DataFrame:
    known = t.nation.where("n_regionkey <= 2").select(F.lower("n_name").alias("k")).distinct()
    done = t.orders.where("o_orderstatus = 'F'").select("o_custkey")
    joined = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).join(known, F.lower("n_name") == F.col("k"), "left_semi")
    return joined.join(done, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "n_name")
