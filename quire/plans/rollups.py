"""Roll-ups, joins and set operations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.relations import absent_pairs, fastest_slowest, histogram, latest_all, latest_one, mode_by_first_seen, top_per_key
from .catalog import Tables, query


@query("A01 A09 A18", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, count(*) AS n_lines, count(DISTINCT o_orderkey) AS n_orders,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned,
  round(100.0 * sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) / count(*), 4) AS pct_returned
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def issue_rollup(t: Tables) -> DataFrame:
    joined = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    returned = F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    return joined.groupBy(F.year("o_orderdate").cast("bigint").alias("y"), F.month("o_orderdate").cast("bigint").alias("m")).agg(
        F.count("*").alias("n_lines"), F.countDistinct("o_orderkey").alias("n_orders"), returned.alias("n_returned"), F.round(100.0 * returned / F.count("*"), 4).alias("pct_returned"),
    )


@query("J01 Q10", """
SELECT n_nationkey, count(DISTINCT c_custkey) AS files, count(DISTINCT CASE WHEN o_orderkey IS NOT NULL THEN c_custkey END) AS covered
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def year_coverage(t: Tables) -> DataFrame:
    ordered = t.orders.select("o_custkey").distinct().withColumn("has", F.lit(True))
    joined = t.nation.join(t.customer, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(ordered, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.groupBy("n_nationkey").agg(F.count("c_custkey").alias("files"), F.count(F.when(F.col("has"), F.col("c_custkey"))).alias("covered"))


@query("J02 A17 M02", """
SELECT s_suppkey, s_name, count(*) AS mentions, count(DISTINCT CAST(l_shipdate AS DATE)) AS n_dates, CAST(min(l_shipdate) AS DATE) AS first_date, CAST(max(l_shipdate) AS DATE) AS last_date
FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1, 2""")
def entity_mentions(t: Tables) -> DataFrame:
    day = F.to_date("l_shipdate")
    counts = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("mentions"), F.countDistinct(day).alias("n_dates"), F.min(day).alias("first_date"), F.max(day).alias("last_date"))
    return t.supplier.join(counts, F.col("s_suppkey") == F.col("l_suppkey")).select("s_suppkey", "s_name", "mentions", "n_dates", "first_date", "last_date")


@query("J03 T01", """
SELECT o_orderkey, o_custkey, l_linenumber, l_quantity, l_returnflag FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND l_returnflag = 'A'""")
def repairs_with_columns(t: Tables) -> DataFrame:
    joined = t.orders.where("o_orderstatus = 'F'").join(t.lineitem.where("l_returnflag = 'A'"), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select("o_orderkey", "o_custkey", "l_linenumber", "l_quantity", "l_returnflag").orderBy("o_orderkey", "l_linenumber", "o_custkey", "l_quantity")


@query("J04 U02 T13", """
SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
  AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def eligible_minus_done(t: Tables) -> DataFrame:
    ordered = t.orders.select("o_custkey")
    done = t.orders.where("o_orderstatus = 'P'").select("o_custkey")
    return t.customer.join(ordered, F.col("c_custkey") == F.col("o_custkey"), "left_semi").join(done, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("J05 Q3", """
SELECT user_id, event_id, value FROM events e WHERE date_trunc('day', ts) = (SELECT max(date_trunc('day', ts)) FROM events x WHERE x.user_id = e.user_id)""")
def latest_versions_with_ties(t: Tables) -> DataFrame:
    return latest_all(t.events.withColumn("day", F.date_trunc("day", "ts")), ["user_id"], "day").select("user_id", "event_id", "value")


@query("W01 J08 Q4 M06 M11", """
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id) AS r FROM events) WHERE r = 1""")
def latest_version_per_key(t: Tables) -> DataFrame:
    return latest_one(t.events, ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id", "value")


@query("W02 M08 M12", """
SELECT o_custkey, max_by(o_orderpriority, (d, o_orderpriority)) AS batch, max(d) AS at FROM (
  SELECT o_custkey, o_orderpriority, CAST(max(o_orderdate) AS DATE) AS d FROM orders GROUP BY 1, 2) GROUP BY 1""")
def latest_batch(t: Tables) -> DataFrame:
    batches = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.to_date(F.max("o_orderdate")).alias("d"))
    return batches.groupBy("o_custkey").agg(F.max(F.struct("d", "o_orderpriority")).alias("m")).select("o_custkey", F.col("m.o_orderpriority").alias("batch"), F.col("m.d").alias("at"))


@query("J06 J12 A56 Q21", """
SELECT o_orderkey, count(*) AS n_missing, string_agg(CAST(c.l_linenumber AS VARCHAR), ',' ORDER BY c.l_linenumber) AS missing
FROM orders o JOIN (SELECT DISTINCT l_linenumber FROM lineitem) c ON NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_linenumber = c.l_linenumber)
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) GROUP BY 1""")
def coverage_gaps(t: Tables) -> DataFrame:
    have = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber").distinct()
    every = t.lineitem.agg(F.array_sort(F.collect_set("l_linenumber")).alias("all"))
    owned = have.groupBy("o_orderkey").agg(F.collect_set("l_linenumber").alias("have")).join(t.orders.select("o_orderkey"), "o_orderkey", "left_semi")
    gaps = owned.join(F.broadcast(every)).select("o_orderkey", F.array_except("all", "have").alias("gap")).where(F.size("gap") > 0)
    return gaps.select("o_orderkey", F.size("gap").cast("bigint").alias("n_missing"), F.array_join("gap", ",").alias("missing"))


@query("J07 J10", """
SELECT d.doc_id, l.quality, CAST(d.doc_id IN (SELECT item_id FROM benchmark) AS BIGINT) AS is_item FROM documents d JOIN labels l USING (doc_id)
WHERE d.doc_id IN (SELECT conv_id FROM conversations)""")
def semi_joined_items(t: Tables) -> DataFrame:
    item = t.benchmark.select(F.col("item_id").alias("doc_id"), F.lit(1).cast("bigint").alias("is_item"))
    convs = t.conversations.select(F.col("conv_id").alias("doc_id"))
    return t.documents.select("doc_id").join(t.labels, "doc_id").join(convs, "doc_id", "left_semi").join(item, "doc_id", "left").select("doc_id", "quality", F.coalesce("is_item", F.lit(0).cast("bigint")).alias("is_item"))


@query("J09", """
SELECT o_custkey, max(l_extendedprice) AS extent FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND CAST(l_shipdate AS DATE) >= CAST(o_orderdate AS DATE) GROUP BY 1""")
def widest_line(t: Tables) -> DataFrame:
    on = (F.col("o_orderkey") == F.col("l_orderkey")) & (F.to_date("l_shipdate") >= F.to_date("o_orderdate"))
    return t.orders.join(t.lineitem, on).groupBy("o_custkey").agg(F.max("l_extendedprice").alias("extent"))


@query("J11 E11", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 3""")
def context_per_entity(t: Tables) -> DataFrame:
    return top_per_key(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey", "o_totalprice")


@query("J23 Q18", """
WITH p AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem), s AS (SELECT DISTINCT l_suppkey AS a, l_partkey AS b FROM lineitem WHERE l_returnflag = 'R')
SELECT a, b FROM p WHERE NOT EXISTS (SELECT 1 FROM s WHERE least(s.a, s.b) = least(p.a, p.b) AND greatest(s.a, s.b) = greatest(p.a, p.b))""")
def unreviewed_pairs(t: Tables) -> DataFrame:
    pairs = t.lineitem.select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")).distinct()
    seen = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"))
    return absent_pairs(pairs, seen, "a", "b")


@query("J24", """
SELECT p_partkey, p_type, r.decision FROM part LEFT JOIN (SELECT p_type AS k, max(p_size) AS decision FROM part WHERE p_size < 25 GROUP BY 1) r ON r.k = p_type""")
def rule_lookup(t: Tables) -> DataFrame:
    rules = t.part.where("p_size < 25").groupBy(F.col("p_type").alias("k")).agg(F.max("p_size").alias("decision"))
    return t.part.join(rules, F.col("p_type") == F.col("k"), "left").select("p_partkey", "p_type", "decision")


@query("J26 M09 M21 M64", """
SELECT c_custkey FROM customer c WHERE c_acctbal > 0 AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)""")
def backups_without_urls(t: Tables) -> DataFrame:
    return t.customer.where("c_acctbal > 0").join(t.orders.where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("A02 A03 A04 A05 A06 A07 A08 U01", """
WITH k AS (SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer), e AS (SELECT o_custkey AS k, count(*) AS expected FROM orders GROUP BY 1),
d AS (SELECT o_custkey AS k, count(DISTINCT (o_orderkey, l_linenumber)) AS done, count(DISTINCT o_orderkey) AS pages FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linestatus = 'F' GROUP BY 1)
SELECT k.k AS key, coalesce(expected, 0) AS expected, coalesce(done, 0) AS done, coalesce(pages, 0) AS pages, CAST(coalesce(expected, 0) > 0 AND coalesce(pages, 0) >= coalesce(expected, 0) AS BIGINT) AS complete
FROM k LEFT JOIN e ON e.k = k.k LEFT JOIN d ON d.k = k.k""")
def completeness_status(t: Tables) -> DataFrame:
    keys = t.orders.select(F.col("o_custkey").alias("key")).union(t.customer.select("c_custkey")).distinct()
    expected = t.orders.groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("expected"))
    lines = t.lineitem.where("l_linestatus = 'F'").select("l_orderkey", "l_linenumber").distinct().groupBy("l_orderkey").agg(F.count("*").alias("n"))
    done = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_custkey").alias("key")).agg(F.sum("n").alias("done"), F.count("*").alias("pages"))
    zero = F.lit(0).cast("bigint")
    out = keys.join(expected, "key", "left").join(done, "key", "left").select("key", *(F.coalesce(c, zero).alias(c) for c in ("expected", "done", "pages")))
    return out.withColumn("complete", ((F.col("expected") > 0) & (F.col("pages") >= F.col("expected"))).cast("bigint"))


@query("A10 A14", """
SELECT (SELECT count(*) FROM orders) AS n_orders, (SELECT count(*) FROM lineitem) AS n_lines, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS n_pages,
  (SELECT CAST(coalesce(sum(c_acctbal < 0), 0) AS BIGINT) FROM customer) AS n_negative, (SELECT min(o_totalprice) FROM orders) AS low, (SELECT max(o_totalprice) FROM orders) AS high""")
def monitor_totals(t: Tables) -> DataFrame:
    a = t.orders.agg(F.count("*").alias("n_orders"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))
    b = t.lineitem.agg(F.count("*").alias("n_lines"), F.countDistinct("l_orderkey").alias("n_pages"))
    c = t.customer.agg(F.coalesce(F.count_if(F.col("c_acctbal") < 0), F.lit(0)).alias("n_negative"))
    return a.join(b).join(c)  # one row each


@query("A15 A16 S15", """
SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2""")
def status_histogram(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))


@query("A11 A12 A13 Q5", """
WITH c AS (SELECT CAST(floor(year(o_orderdate) / 5) * 5 AS BIGINT) AS era, o_orderpriority AS v, count(*) AS n, min(o_orderkey) AS f FROM orders GROUP BY 1, 2)
SELECT era, v AS mode, n FROM (SELECT *, row_number() OVER (PARTITION BY era ORDER BY n DESC, f) AS r FROM c) WHERE r = 1""")
def era_modes(t: Tables) -> DataFrame:
    era = t.orders.withColumn("era", (F.floor(F.year("o_orderdate") / 5) * 5).cast("bigint"))
    return mode_by_first_seen(era, ["era"], "o_orderpriority", "o_orderkey").select("era", F.col("o_orderpriority").alias("mode"), "n")


@query("A20 A23", """
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS u, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS d FROM events WHERE value IS NOT NULL)
SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean, round(avg(CASE WHEN u <= 10 THEN value END), 4) AS fastest, round(avg(CASE WHEN d <= 10 THEN value END), 4) AS slowest FROM r GROUP BY 1""")
def day_speed(t: Tables) -> DataFrame:
    return fastest_slowest(t.events, ["event_type"], "value", "event_id")


@query("A19 A21 A26", """
WITH d AS (SELECT event_type, unnest(range(16)) AS bin FROM (SELECT DISTINCT event_type FROM events)),
h AS (SELECT event_type, least(CAST(floor(value / 10) AS BIGINT), 15) AS bin, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT d.event_type, CAST(d.bin AS INTEGER) AS bin, coalesce(n, 0) AS n FROM d LEFT JOIN h USING (event_type, bin)""")
def duration_histogram(t: Tables) -> DataFrame:
    return histogram(t.events, ["event_type"], "value", 10.0, 16)


@query("A59 Q20 M01", """
SELECT label, count(*) AS size, min(vec_id) AS first_id, max(vec_id) AS last_id, string_agg(CAST(vec_id AS VARCHAR), ',' ORDER BY vec_id) AS members FROM embeddings GROUP BY 1""")
def merged_clusters(t: Tables) -> DataFrame:
    return t.embeddings.groupBy("label").agg(F.count("*").alias("size"), F.min("vec_id").alias("first_id"), F.max("vec_id").alias("last_id"), F.array_join(F.array_sort(F.collect_list("vec_id")), ",").alias("members"))


@query("U03 U05", """
WITH s AS (SELECT l_suppkey AS k, string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)) AS blocks FROM lineitem GROUP BY 1)
SELECT blocks, count(*) AS n, min(k) AS first_key FROM s GROUP BY 1 HAVING count(*) > 1""")
def equal_block_sets(t: Tables) -> DataFrame:
    sets = t.lineitem.groupBy("l_suppkey").agg(F.array_join(F.array_sort(F.collect_set(F.col("l_linenumber").cast("string"))), ",").alias("blocks"))
    return sets.groupBy("blocks").agg(F.count("*").alias("n"), F.min("l_suppkey").alias("first_key")).where("n > 1")


@query("U05", """
SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier""")
def item_kinds(t: Tables) -> DataFrame:
    a = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return a.unionByName(t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


@query("U06", """
SELECT DISTINCT round(l_discount, 4) AS x, l_returnflag AS kind FROM lineitem EXCEPT SELECT DISTINCT round(l_tax, 4), l_returnflag FROM lineitem""")
def survivors(t: Tables) -> DataFrame:
    # Spark pushes an anti join below a distinct, where all rows of one value meet in a task; one aggregate needs no join.
    kept = t.lineitem.select(F.round("l_discount", 4).alias("x"), F.col("l_returnflag").alias("kind"), F.lit(False).alias("gone"))
    gone = t.lineitem.select(F.round("l_tax", 4).alias("x"), F.col("l_returnflag").alias("kind"), F.lit(True).alias("gone"))
    return kept.union(gone).groupBy("x", "kind").agg(F.bool_or("gone").alias("gone")).where(~F.col("gone")).select("x", "kind")


@query("M03", """
SELECT l_suppkey, string_agg(DISTINCT CASE WHEN p_type = 'ECONOMY' THEN p_brand || ' (uncategorised)' ELSE p_type END, '; ' ORDER BY CASE WHEN p_type = 'ECONOMY' THEN p_brand || ' (uncategorised)' ELSE p_type END) AS categories
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def product_categories(t: Tables) -> DataFrame:
    label = F.when(F.col("p_type") == "ECONOMY", F.concat("p_brand", F.lit(" (uncategorised)"))).otherwise(F.col("p_type"))
    pairs = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_suppkey", label.alias("c")).distinct()
    return pairs.groupBy("l_suppkey").agg(F.array_join(F.array_sort(F.collect_list("c")), "; ").alias("categories"))


@query("M04 X14 X11", """
SELECT conv_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn) AS full_text, count(*) AS turns FROM conversations GROUP BY 1""")
def ordered_full_text(t: Tables) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))))
    return t.conversations.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda s: s["text"]), "\n").alias("full_text"), F.count("*").alias("turns"))


@query("M32", """
SELECT o_orderkey, count(l_orderkey) AS n_lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def blocks_with_line_counts(t: Tables) -> DataFrame:
    n = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return t.orders.join(n, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_lines"))


@query("M67", """
SELECT c_custkey, c_name, n_name, r_name, coalesce(n_orders, 0) AS n_orders FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def page_sheet(t: Tables) -> DataFrame:
    n = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    joined = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).join(t.region, F.col("r_regionkey") == F.col("n_regionkey")).join(n, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select("c_custkey", "c_name", "n_name", "r_name", F.coalesce("n_orders", F.lit(0).cast("bigint")).alias("n_orders"))
