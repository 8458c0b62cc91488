"""Text, hashing, entity resolution, mutations, sources and similarity."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import columns as C
from ..operators import entities as E
from ..operators import greedy as G
from ..operators import mutations as K
from ..operators import similarity as S
from ..operators.relations import by_page
from ..sources import envelopes, hocr, tables
from .catalog import Tables, query

_STOP = ", ".join(f"'{w}'" for w in X.STOPWORDS)
_DEDUP = f"array_to_string(list_filter(regexp_split_to_array(trim(regexp_replace(lower({{0}}), '[.,''\"()]', '', 'g')), '\\s+'), lambda w: w NOT IN ({_STOP})), ' ')"
_SPELL = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in X.SPELLINGS.items())
_NAMES = "names AS (SELECT p_partkey, p_name || CASE p_size % 4 WHEN 0 THEN ' st' WHEN 1 THEN ' & Co.' WHEN 2 THEN '' ELSE ' The Color' END AS name FROM part)"


def _names(t: Tables) -> DataFrame:
    tail = F.when(F.col("p_size") % 4 == 0, " st").when(F.col("p_size") % 4 == 1, " & Co.").when(F.col("p_size") % 4 == 2, "").otherwise(" The Color")
    return t.part.select("p_partkey", F.concat("p_name", tail).alias("name"), "p_size", "p_brand")


@query("X01 X02 X03 X04 X06 X07 X17 X23 Q17", f"""
WITH {_NAMES} SELECT p_partkey, regexp_replace(lower(name), '[^a-z0-9]+', '', 'g') AS key, {_DEDUP.format('name')} AS dedup, regexp_replace(name, '(\\S)\\s+st$', '\\1 street') AS street,
 trim(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '_') AS snake, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
 array_to_string(list_transform(string_split(lower(name), ' '), lambda w: CASE w {_SPELL} ELSE w END), ' ') AS spelled,
 least(name, 'm') || '|' || greatest(name, 'm') AS pair FROM names""")
def normalised_names(t: Tables) -> DataFrame:
    n = F.col("name")
    return _names(t).select("p_partkey", X.key_of(n).alias("key"), X.dedup_key(n).alias("dedup"), X.expand_street(n).alias("street"), X.snake(n).alias("snake"), X.slug(n).alias("slug"), X.respell(n).alias("spelled"), X.pair_key(n, F.lit("m")).alias("pair"))


@query("X05 Q1", """
WITH f AS (SELECT lower(split_part(p_name, ' ', 1)) AS w, count(*) AS n FROM part GROUP BY 1) SELECT p_partkey, n FROM part JOIN f ON w = lower(split_part(p_name, ' ', 1))""")
def first_word_counts(t: Tables) -> DataFrame:
    w = F.lower(F.substring_index("p_name", " ", 1))
    counts = t.part.groupBy(w.alias("w")).agg(F.count("*").alias("n"))
    return t.part.withColumn("w", w).join(counts, "w").select("p_partkey", "n")


@query("X09", """
WITH h AS (SELECT doc_id, text, strpos(lower(text), 'the') AS hit FROM documents WHERE text IS NOT NULL), s AS (SELECT *, greatest(1, hit - 200) AS a, hit - greatest(1, hit - 200) + 3 + 200 AS n FROM h WHERE hit > 0)
SELECT doc_id, CASE WHEN a > 1 THEN '...' ELSE '' END || substr(text, a, n) || CASE WHEN a + n - 1 < length(text) THEN '...' ELSE '' END AS excerpt FROM s""")
def excerpts(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.excerpt(F.col("text"), F.lit("the")).alias("excerpt")).where("excerpt is not null")


@query("X12 X15 X16 X21 P38", """
SELECT doc_id, split_part(text, chr(10), 1) AS first, split_part(text, chr(10), -1) AS last, CAST(length(regexp_replace(text, '[^\\p{L}]', '', 'g')) >= 3 AS BIGINT) AS letters, length(text) AS n FROM documents WHERE text IS NOT NULL""")
def edge_lines(t: Tables) -> DataFrame:
    x = F.col("text")
    return t.documents.where("text is not null").select("doc_id", X.first_line(x).alias("first"), X.last_line(x).alias("last"), X.enough_letters(x).cast("bigint").alias("letters"), F.char_length(x).cast("bigint").alias("n"))


@query("X13 Q22", """
SELECT doc_id, substr(text, least(10, length(text)) + 1, least(60, length(text)) - least(10, length(text))) AS span FROM documents WHERE text IS NOT NULL""")
def clamped_spans(t: Tables) -> DataFrame:
    return t.documents.where("text is not null").select("doc_id", X.clamp_slice(F.col("text"), F.lit(10), F.lit(60)).alias("span"))


@query("X18 X20 E05", """
SELECT p_partkey, CASE WHEN starts_with(lower(p_name), 'red ') THEN substr(p_name, 5) WHEN ends_with(lower(p_name), ' red') THEN substr(p_name, 1, length(p_name) - 4) ELSE p_name END AS generic,
 CASE WHEN regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') <> regexp_replace(lower(p_brand), '[^a-z0-9]+', '', 'g') THEN p_name END AS alias FROM part""")
def generic_names(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.strip_maker(F.col("p_name"), F.lit("red")).alias("generic"), X.alias_of(F.col("p_name"), F.col("p_brand")).alias("alias"))


@query("H02 H03 H01 H05", """
SELECT o_custkey, sha256(string_agg('order:' || o_orderkey, chr(10) ORDER BY o_orderkey)) AS content, sha256('template' || chr(10) || '{"a":' || o_custkey || ',"n":' || count(*) || '}') AS prompt FROM orders GROUP BY 1""")
def content_hashes(t: Tables) -> DataFrame:
    g = t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("ids"), F.count("*").alias("n"))
    content = F.sha2(F.array_join(F.transform("ids", lambda v: F.concat(F.lit("order:"), v.cast("string"))), "\n"), 256)
    return g.select("o_custkey", content.alias("content"), X.prompt_hash(F.lit("template"), F.struct(F.col("o_custkey").alias("a"), "n")).alias("prompt"))


def _overlap(a: str, b: str) -> str:
    """SQL for the merged line of two, NULL where they do not overlap."""
    n = f"list_filter(list_reverse(range(20, least(length({a}), length({b})))), lambda n: right({a}, n) = left({b}, n) AND substr({a}, length({a}) - n, 1) = ' ')[1]"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN NULL WHEN {a} = {b} THEN {a} WHEN starts_with({b}, {a}) THEN {b} WHEN ends_with({a}, {b}) THEN {a} WHEN {n} IS NOT NULL THEN {a} || substr({b}, {n} + 1) END"


@query("X10 X11 W13 I20 I22 I23", f"""
WITH RECURSIVE c AS (SELECT conv_id, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) AS k FROM conversations),
s AS (SELECT DISTINCT conv_id, 0::BIGINT AS k, '' AS joined, CAST([] AS BIGINT[]) AS starts, 0::BIGINT AS merged FROM c
 UNION ALL SELECT conv_id, k, CASE WHEN joined = '' THEN x WHEN m IS NULL THEN joined || chr(10) || x ELSE CASE WHEN head = '' THEN '' ELSE head || chr(10) END || m || substr(x, length(first) + 1) END,
  list_append(starts, CASE WHEN joined = '' THEN 0 WHEN m IS NULL THEN length(joined) + 1 WHEN head = '' THEN 0 ELSE length(head) + 1 END), merged + CASE WHEN joined <> '' AND m IS NOT NULL THEN 1 ELSE 0 END
 FROM (SELECT *, {_overlap('a', 'b')} AS m FROM (SELECT *, trim(last) AS a, trim(first) AS b, left(joined, greatest(0, length(joined) - length(last) - 1)) AS head
  FROM (SELECT s.conv_id, c.k, joined, starts, merged, x, string_split(joined, chr(10))[-1] AS last, string_split(x, chr(10))[1] AS first FROM s JOIN c ON c.conv_id = s.conv_id AND c.k = s.k + 1)))),
d AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) AS r FROM s) SELECT conv_id, joined, array_to_string(starts, ',') AS starts, merged FROM d WHERE r = 1""")
def stitched_transcripts(t: Tables) -> DataFrame:
    return G.join_slices(t.conversations.select("conv_id", "turn", "text"), "conv_id", "turn", "text").withColumn("starts", F.array_join("starts", ","))


@query("X10", f"""
WITH x AS (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations), l AS (SELECT *, trim(string_split(before, chr(10))[-1]) AS a, trim(string_split(text, chr(10))[1]) AS b FROM x)
SELECT conv_id, turn, {_overlap('a', 'b')} AS merged FROM l""")
def stitched_neighbours(t: Tables) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = t.conversations.withColumn("before", F.lag("text").over(w))
    return rows.select("conv_id", "turn", X.stitch(X.last_line(F.col("before")), X.first_line(F.col("text"))).alias("merged"))


@query("E01 E02 Q16", """
SELECT regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') AS key, min_by(p_name, p_partkey) AS name, min(CAST(l_shipdate AS DATE)) AS first_seen, max(CAST(l_shipdate AS DATE)) AS last_seen, count(*) AS n_mentions, count(DISTINCT p_name) - 1 AS n_aliases
FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1""")
def entities(t: Tables) -> DataFrame:
    mentions = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_name", "p_partkey", F.to_date("l_shipdate").alias("day"))
    return E.roll_up(mentions, "p_name", "p_partkey", "day")


@query("E03 J22 M23 X05", f"""
WITH n AS (SELECT p_partkey AS id, {_DEDUP.format("p_name || CASE WHEN p_partkey % 5 = 0 THEN ' set' ELSE '' END")} AS norm FROM part), h AS (SELECT norm, min(id) AS head FROM n WHERE norm <> '' GROUP BY 1)
SELECT head AS id_a, id AS id_b, CAST(0.9 AS DOUBLE) AS confidence FROM n JOIN h USING (norm) WHERE id <> head
UNION ALL SELECT DISTINCT least(a.head, b.head), greatest(a.head, b.head), CAST(0.3 AS DOUBLE) FROM h a JOIN h b ON substr(a.norm, 1, 1) = substr(b.norm, 1, 1) AND a.norm <> b.norm AND length(a.norm) >= 4 AND contains(b.norm, a.norm)
  AND a.norm NOT IN (SELECT {_DEDUP.format("p_name")} FROM part WHERE p_size < 5) AND a.norm NOT IN (SELECT lower(split_part(p_name, ' ', 1)) FROM part GROUP BY 1 HAVING count(DISTINCT p_name) > 1)""")
def duplicate_candidates(t: Tables) -> DataFrame:
    named = t.part.select("p_partkey", F.concat("p_name", F.when(F.col("p_partkey") % 5 == 0, " set").otherwise("")).alias("name"))
    names = t.part.select(F.col("p_name").alias("name"), "p_size")
    return E.duplicate_pairs(named, "p_partkey", "name", people=names, places=names.where("p_size < 5"))


@query("J25 E15", """
WITH e AS (SELECT c_custkey, min(CAST(year(o_orderdate) AS BIGINT)) AS f, max(CAST(year(o_orderdate) AS BIGINT)) AS l FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT * FROM e WHERE f IS NULL OR (f <= 1996 + 1 AND coalesce(l, f) >= 1996 - 1)""")
def entities_alive(t: Tables) -> DataFrame:
    y = F.year("o_orderdate").cast("bigint")
    spans = t.orders.groupBy("o_custkey").agg(F.min(y).alias("f"), F.max(y).alias("l"))
    e = t.customer.join(spans, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "f", "l")
    return E.alive_around(e, "f", "l", 1996, 1)


@query("E07", """
SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-09 12:00:00'""")
def new_since_checkpoint(t: Tables) -> DataFrame:
    return E.new_between(t.events, "ts", "2024-01-05 00:00:00", "2024-01-09 12:00:00").select("event_id", "user_id")


@query("E11 E09 M24", """
WITH f AS (SELECT user_id, props, min(event_id) AS o FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY o, props) AS r FROM f)
SELECT user_id, string_agg(props, ' | ' ORDER BY r) AS snippets FROM r WHERE r <= 3 GROUP BY 1""")
def entity_snippets(t: Tables) -> DataFrame:
    return E.snippets(t.events, "user_id", "props", "event_id")


@query("E12 E13 E14 E10", """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'NEW' ELSE c_mktsegment END AS segment, CAST(c_custkey % 3 = 0 AS BIGINT) AS updated FROM customer WHERE c_mktsegment IS NOT NULL AND c_mktsegment NOT IN ('MACHINERY') AND c_name <> ''""")
def assigned_terms(t: Tables) -> DataFrame:
    pending = t.customer.where("c_mktsegment is not null and c_mktsegment not in ('MACHINERY') and c_name <> ''")
    given = t.customer.where("c_custkey % 3 = 0").select("c_custkey", F.lit("NEW").alias("c_mktsegment"))
    after = K.transition(pending.select("c_custkey", "c_mktsegment"), given, "c_custkey", "c_mktsegment")
    return after.select("c_custkey", F.col("c_mktsegment").alias("segment"), (F.col("c_custkey") % 3 == 0).cast("bigint").alias("updated"))


def _orders(t: Tables) -> DataFrame:
    return t.orders.where("o_orderkey % 2 = 0").selectExpr("o_orderkey as k", "o_custkey as c", "o_totalprice as p", "o_orderstatus = 'F' as hand")


def _delta(t: Tables) -> DataFrame:
    return t.orders.where("o_orderkey % 3 = 0").selectExpr("o_orderkey as k", "case when o_custkey % 2 = 0 then o_custkey end as c", "o_totalprice + 1 as p", "false as hand")


_STATE = "o AS (SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS p, o_orderstatus = 'F' AS hand FROM orders WHERE o_orderkey % 2 = 0), n AS (SELECT o_orderkey AS k, CASE WHEN o_custkey % 2 = 0 THEN o_custkey END AS c, o_totalprice + 1 AS p, false AS hand FROM orders WHERE o_orderkey % 3 = 0)"
_OUT = "k, c, p, CAST(hand AS BIGINT) AS hand"


def _out(df: DataFrame) -> DataFrame:
    return df.select("k", "c", "p", F.col("hand").cast("bigint").alias("hand"))


@query("K02 K03 K30 K36 K16 K17 K18 K19", f"WITH {_STATE} SELECT {_OUT} FROM o WHERE hand OR NOT EXISTS (SELECT 1 FROM n WHERE n.k = o.k)")
def delete_except_protected(t: Tables) -> DataFrame:
    return _out(K.delete_unprotected(_orders(t), _delta(t), ["k"], "hand"))


@query("K04", f"WITH {_STATE} SELECT {_OUT} FROM o UNION ALL SELECT {_OUT} FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.k = n.k AND o.hand)")
def insert_unless_protected(t: Tables) -> DataFrame:
    return _out(K.insert_unless_protected(_orders(t), _delta(t), ["k"], "hand"))


@query("K06 K05", f"WITH {_STATE} SELECT {_OUT} FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.k = o.k) UNION ALL SELECT {_OUT} FROM n")
def replace_rows(t: Tables) -> DataFrame:
    return _out(K.insert_or_replace(_orders(t), _delta(t), ["k"], "p"))


@query("K08", f"WITH {_STATE} SELECT {_OUT} FROM o UNION ALL SELECT {_OUT} FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.k = n.k)")
def ignore_rows(t: Tables) -> DataFrame:
    return _out(K.insert_or_ignore(_orders(t), _delta(t), ["k"], "p"))


@query("K07 K09 Q8 M71", f"WITH {_STATE} SELECT coalesce(o.k, n.k) AS k, coalesce(n.c, o.c) AS c, greatest(o.p, n.p) AS p, CAST(CASE WHEN o.k IS NOT NULL THEN o.hand ELSE n.hand END AS BIGINT) AS hand FROM o FULL JOIN n ON o.k = n.k")
def upsert_by_policy(t: Tables) -> DataFrame:
    new = _delta(t)
    old = _orders(t)
    swapped = K.upsert(old, new, ["k"], {"c": "new", "p": "greatest", "hand": "keep"})
    back = old.select(F.col("k").alias("_k"), F.col("c").alias("_c"))
    return _out(swapped.join(back, swapped["k"] == back["_k"], "left").withColumn("c", F.coalesce("c", "_c")))


@query("K10 K11 M14 H04", f"WITH {_STATE} SELECT n.k, coalesce(CAST(o.c AS VARCHAR), sha256(CAST(n.k AS VARCHAR))) AS id, CAST(o.k IS NULL AS BIGINT) AS is_new FROM n LEFT JOIN o ON o.k = n.k")
def idempotent_claims(t: Tables) -> DataFrame:
    existing = _orders(t).select("k", F.col("c").cast("string").alias("id"))
    return K.claim(_delta(t), existing, ["k"], "id").select("k", "id", F.col("is_new").cast("bigint").alias("is_new"))


@query("K12 K13 M15 M16 M75 P50", f"WITH {_STATE} SELECT o.k, CASE WHEN n.k IS NULL THEN 'open' WHEN o.c % 4 >= 2 THEN 'damaged' ELSE 'failed' END AS status FROM o LEFT JOIN n ON n.k = o.k")
def state_transitions(t: Tables) -> DataFrame:
    table = _orders(t).withColumn("status", F.lit("open"))
    failed = table.join(_delta(t).select("k"), "k", "left_semi").select("k", C.failure_status(F.col("c") % 4).alias("status"))
    return K.transition(table.select("k", "status"), failed, "k", "status")


@query("K21 K22 K23 K28", f"WITH {_STATE} SELECT {_OUT} FROM o")
def audit_and_undo(t: Tables) -> DataFrame:
    before = _orders(t)
    after = K.insert_or_replace(before, _delta(t), ["k"], "p")
    return _out(K.undo(after, K.audit(before, after, "k", "replace"), "k"))


@query("K23", """
SELECT max(event_id) AS id FROM events WHERE event_type <> 'error' AND NOT starts_with(event_type, 'undo') AND value IS NOT NULL""")
def last_undoable(t: Tables) -> DataFrame:
    history = t.events.where("value is not null").select(F.col("event_id").alias("id"), F.col("event_type").alias("command"), F.when(F.col("event_type") == "error", F.lit("x")).alias("undone_at"))
    return K.latest_undoable(history).select("id")


_MERGES = "m AS (SELECT s_suppkey AS drop_id, s_suppkey - 1 AS keep_id FROM supplier WHERE s_suppkey % 10 = 7)"


@query("K35 X19 E06 I08", f"""
WITH {_MERGES} SELECT DISTINCT l_orderkey AS item, coalesce(keep_id, l_suppkey) AS entity, l_linenumber AS span FROM lineitem LEFT JOIN m ON drop_id = l_suppkey""")
def merged_mentions(t: Tables) -> DataFrame:
    merges = t.supplier.where("s_suppkey % 10 = 7").selectExpr("s_suppkey as drop_id", "s_suppkey - 1 as keep_id")
    mentions = t.lineitem.selectExpr("l_orderkey as item", "l_suppkey as entity", "l_linenumber as span")
    return K.merge_entities(mentions, merges, "entity", "item", "span")


@query("K35", f"""
WITH {_MERGES}, e AS (SELECT l_suppkey AS k, min(CAST(l_shipdate AS DATE)) AS f, max(CAST(l_shipdate AS DATE)) AS l FROM lineitem GROUP BY 1)
SELECT coalesce(keep_id, k) AS k, min(f) AS f, max(l) AS l FROM e LEFT JOIN m ON drop_id = k GROUP BY 1""")
def widened_spans(t: Tables) -> DataFrame:
    merges = t.supplier.where("s_suppkey % 10 = 7").selectExpr("s_suppkey as drop_id", "s_suppkey - 1 as keep_id")
    e = t.lineitem.groupBy(F.col("l_suppkey").alias("k")).agg(F.min(F.to_date("l_shipdate")).alias("f"), F.max(F.to_date("l_shipdate")).alias("l"))
    return K.widen_spans(e, merges, "k", "f", "l")


@query("K33 K34 M10", """
SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","orders":[' || coalesce(string_agg('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}', ',' ORDER BY o_orderkey), '') || ']}' AS document
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name""")
def nested_payloads(t: Tables) -> DataFrame:
    child = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    return tables.nested_json(t.customer.select("c_custkey", "c_name"), child, "c_custkey", "o_orderkey", "orders")


@query("K41 K42", """
WITH old AS (SELECT label, min(vec_id) AS exemplar FROM embeddings WHERE vec_id % 2 = 0 GROUP BY 1), fresh AS (SELECT label + 100 AS label, min(vec_id) AS exemplar, count(*) AS size FROM embeddings GROUP BY 1)
SELECT f.label, f.size, o.label AS carried FROM fresh f LEFT JOIN old o USING (exemplar)""")
def carried_labels(t: Tables) -> DataFrame:
    old = t.embeddings.where("vec_id % 2 = 0").groupBy("label").agg(F.min("vec_id").alias("exemplar")).select("exemplar", F.col("label").alias("carried"))
    fresh = t.embeddings.groupBy((F.col("label") + 100).alias("label")).agg(F.min("vec_id").alias("exemplar"), F.count("*").alias("size"))
    return fresh.join(old, "exemplar", "left").select("label", "size", "carried")


@query("S01 S02 S07 S14 R01", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.missing') IS NULL AS BIGINT) AS absent FROM events""")
def parsed_json(t: Tables) -> DataFrame:
    p = F.from_json("props", "k bigint, missing string")
    return t.events.select("event_id", p["k"].alias("k"), p["missing"].isNull().cast("bigint").alias("absent"))


@query("S16 S17 S18 S19 X16", """
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'not json' WHEN doc_id % 4 = 1 THEN 'missing repair_needed' END AS rejected, CASE WHEN doc_id % 4 >= 2 THEN lang END AS body FROM documents""")
def envelope_verdicts(t: Tables) -> DataFrame:
    good = F.to_json(F.struct(F.coalesce("lang", F.lit("")).alias("transcript_text"), F.lit(False).alias("repair_needed")))
    raw = (
        F.when(F.col("doc_id") % 4 == 0, F.lit("sorry, no result"))
        .when(F.col("doc_id") % 4 == 1, F.to_json(F.struct(F.lit("x").alias("transcript_text"))))
        .when(F.col("doc_id") % 4 == 2, good).otherwise(F.concat(F.lit("```json\n"), good, F.lit("\n```")))
    )
    judged = envelopes.with_verdict(t.documents.select("doc_id", raw.alias("raw")), "raw", envelopes.COLUMN_RESULT, ("transcript_text", "repair_needed"))
    return judged.select("doc_id", "rejected", F.when(F.col("rejected").isNull(), F.col("envelope.transcript_text")).alias("body"))


@query("S08", """
SELECT page_id, CAST(len(regexp_extract_all(html, '<a ')) AS BIGINT) AS n_links, CAST(len(regexp_extract_all(html, '<p[ >]')) AS BIGINT) AS n_paragraphs, CAST(len(regexp_extract_all(html, '<img')) AS BIGINT) AS n_images, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages""")
def html_headings(t: Tables) -> DataFrame:
    return hocr.headings(t.pages, "page_id", "html")


@query("S08 A24 I10 I11 M19", """
SELECT l_orderkey AS page, CAST(l_linenumber AS INTEGER) - 1 AS block, count(*) AS n_words, round(avg(l_quantity), 2) AS confidence FROM (
 SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem) GROUP BY 1, 2""")
def hocr_blocks(t: Tables) -> DataFrame:
    rows = by_page(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), "l_orderkey").distinct()
    y = F.col("l_linenumber") * 10
    word = F.concat(F.lit("<span class='ocrx_word' title='bbox 1 "), (y + 1).cast("string"), F.lit(" 9 "), (y + 8).cast("string"), F.lit("; x_wconf "), F.col("l_quantity").cast("int").cast("string"), F.lit("'>w</span>"))
    area = rows.groupBy("l_orderkey", "l_linenumber").agg(F.array_join(F.collect_list(word), "").alias("ws"))
    top = F.col("l_linenumber") * 10
    block = F.concat(F.lit("<div class='ocr_carea' title='bbox 0 "), top.cast("string"), F.lit(" 10 "), (top + 9).cast("string"), F.lit("'>"), F.col("ws"), F.lit("</div>"))
    pages = area.groupBy("l_orderkey").agg(F.concat(F.lit("<html>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", block.alias("x")))), lambda s: s["x"]), ""), F.lit("</html>")).alias("html"))
    found = hocr.blocks(pages, "l_orderkey", "html")
    return found.select(F.col("l_orderkey").alias("page"), (F.col("t") / 10 - 1).cast("int").alias("block"), "n_words", "confidence")


@query("S21 S05 S06 M66", """
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'column' WHEN 1 THEN 'ad' WHEN 2 THEN 'scan' END AS kind, CAST(c_custkey AS INTEGER) AS page, CASE WHEN c_custkey % 4 = 0 THEN CAST(c_nationkey AS INTEGER) END AS col FROM customer""")
def classified_paths(t: Tables) -> DataFrame:
    k, stem = F.col("c_custkey") % 4, F.concat(F.lit("a/b/x_p"), F.col("c_custkey").cast("string"))
    path = F.when(k == 0, F.concat(stem, F.lit("_col"), F.col("c_nationkey").cast("string"), F.lit(".png"))).when(k == 1, F.concat(stem, F.lit("_ad1.png"))).when(k == 2, F.concat(stem, F.lit(".pdf"))).otherwise(F.concat(stem, F.lit(".txt")))
    c = tables.classify_path(path)
    return t.customer.select("c_custkey", c["kind"].alias("kind"), c["page"].alias("page"), c["col"].alias("col"))


@query("S22", """
SELECT x.w, coalesce(a.p, b.p, c.p) AS hit FROM (SELECT DISTINCT split_part(p_name, ' ', 2) || CASE WHEN p_partkey % 3 = 0 THEN 's' WHEN p_partkey % 3 = 1 THEN 'es' ELSE '' END AS w FROM part) x
LEFT JOIN (SELECT lower(split_part(p_name, ' ', 2)) AS w, min(p_partkey) AS p FROM part GROUP BY 1) a ON a.w = lower(x.w)
LEFT JOIN (SELECT lower(split_part(p_name, ' ', 2)) AS w, min(p_partkey) AS p FROM part GROUP BY 1) b ON x.w LIKE '%es' AND b.w = lower(substr(x.w, 1, length(x.w) - 2))
LEFT JOIN (SELECT lower(split_part(p_name, ' ', 2)) AS w, min(p_partkey) AS p FROM part GROUP BY 1) c ON x.w LIKE '%s' AND c.w = lower(substr(x.w, 1, length(x.w) - 1))""")
def vocabulary_lookup(t: Tables) -> DataFrame:
    second = F.split_part("p_name", F.lit(" "), F.lit(2))
    end = F.when(F.col("p_partkey") % 3 == 0, "s").when(F.col("p_partkey") % 3 == 1, "es").otherwise("")
    asked = t.part.select(F.concat(second, end).alias("w")).distinct()
    terms = t.part.groupBy(F.lower(second).alias("term")).agg(F.min("p_partkey").alias("p"))
    forms = F.array_compact(F.array(F.struct(F.lit(0).alias("o"), F.lower("w").alias("term")), F.when(F.col("w").endswith("es"), F.struct(F.lit(1).alias("o"), F.expr("lower(left(w, length(w) - 2))").alias("term"))), F.when(F.col("w").endswith("s"), F.struct(F.lit(2).alias("o"), F.expr("lower(left(w, length(w) - 1))").alias("term")))))
    hits = asked.select("w", F.explode(forms).alias("f")).select("w", "f.o", "f.term").join(terms, "term").groupBy("w").agg(F.min_by("p", "o").alias("hit"))
    return asked.join(hits, "w", "left")


@query("S23", """
WITH RECURSIVE up AS (SELECT p_partkey AS id, p_partkey AS pos, 0 AS depth, CAST(p_partkey AS VARCHAR) AS chain FROM part UNION ALL SELECT id, CAST(floor(pos / 4) AS BIGINT), depth + 1, CAST(CAST(floor(pos / 4) AS BIGINT) AS VARCHAR) || '>' || chain FROM up WHERE pos > 0 AND depth < 6)
SELECT id, max_by(chain, depth) AS chain FROM up GROUP BY 1""")
def broader_chains(t: Tables) -> DataFrame:
    parents = t.part.select(F.col("p_partkey").alias("child"), F.floor(F.col("p_partkey") / 4).alias("parent"))
    state = t.part.select(F.col("p_partkey").alias("id"), F.col("p_partkey").alias("at"), F.array("p_partkey").alias("path"))
    for _ in range(6):  # a fixed depth guard keeps this a plain plan
        up = state.join(parents, state["at"] == parents["child"], "left")
        more = F.col("at") > 0
        state = up.select("id", F.when(more, F.col("parent")).otherwise(F.col("at")).alias("at"), F.when(more, F.array_prepend("path", F.col("parent"))).otherwise(F.col("path")).alias("path"))
    return state.select("id", F.array_join("path", ">").alias("chain"))


_DOT = "(list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) / sqrt(list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])) * list_inner_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))))"


@query("J20", f"""
SELECT a.vec_id AS id_a, b.vec_id AS id_b, round({_DOT}, 4) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND {_DOT} >= 0.9""")
def similar_embeddings(t: Tables) -> DataFrame:
    return S.similar_pairs(t.embeddings, "vec_id", "embedding", 0.9, keep=_keep)


@query("J21 A58", f"""
WITH RECURSIVE e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND {_DOT} >= 0.9), r(id, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.id)
SELECT id, min(c) AS cluster FROM r GROUP BY 1""")
def embedding_clusters(t: Tables) -> DataFrame:
    return S.clusters(t.embeddings, "vec_id", "embedding", 0.9, _keep)


@query("A58", """
WITH u AS (SELECT label, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))) AS v FROM embeddings),
e AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM u), m AS (SELECT label, pos, avg(x) AS x FROM e GROUP BY 1, 2), c AS (SELECT label, list(x ORDER BY pos) AS c FROM m GROUP BY 1),
s AS (SELECT label, vec_id, round(list_inner_product(v, c) / sqrt(list_inner_product(c, c)), 6) AS s FROM u JOIN c USING (label)), r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id) AS r, count(*) OVER (PARTITION BY label) AS size FROM s)
SELECT label, size, vec_id AS exemplar, round(s, 4) AS similarity FROM r WHERE r = 1""")
def cluster_exemplars(t: Tables) -> DataFrame:
    return S.exemplars(t.embeddings, "vec_id", "embedding", "label")


def _keep(df: DataFrame, name: str) -> DataFrame:
    from ..sources.scratch import stored
    return stored(df, name)
