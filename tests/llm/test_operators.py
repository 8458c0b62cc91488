"""Each operator against its brute-force version, on the small tables and on odd rows."""

import sys
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from quire.llm import decontaminate, language_id, line_dedup, mixing, quality_classifier, quality_rules, queries, secret_scan, simhash_dedup, substring_dedup, url_filter  # noqa: E402


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(params=["documents", "odd_docs"])
def docs(request):
    return request.getfixturevalue(request.param)


def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def by_id(rows, *columns):
    out = defaultdict(list)
    for r in rows:
        out[r["doc_id"]].append(tuple(r[c] for c in columns))
    return {k: sorted(v) for k, v in out.items()}


def ordered(groups):
    return {k: sorted(v) for k, v in groups.items()}


def test_line_dedup(docs):
    got = line_dedup.dedup_lines(docs).collect()
    assert by_id(got, "n_lines", "n_dropped", "kept_sha256") == ordered(brute.line_dedup(texts(docs)))
    assert all(brute.sha(r["kept_text"]) == r["kept_sha256"] for r in got)


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (7, 2), (5, 3)])
def test_line_index_is_independent_of_batches(documents, batches, fanout):
    got = line_dedup.dedup_lines(documents, batches=batches, fanout=fanout).collect()
    assert by_id(got, "n_lines", "n_dropped", "kept_sha256") == ordered(brute.line_dedup(texts(documents)))


def test_line_index_levels(spark, documents):
    index = line_dedup.build_index(spark, line_dedup.hashed_lines(documents), batches=6, fanout=2)
    assert sum(map(len, index.levels)) <= 3
    assert sum(r.count() for r in index.runs()) == line_dedup.hashed_lines(documents).select("lo", "hi").distinct().count()
    again = index.runs()[0].groupBy("lo", "hi").count()
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()  # the run stays where it is


def test_heavy_lines_and_shared_ids(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HEAVY", 3)
    rows = [(k % 150, f"a line that all hold\nline number {k % 40} of forty\nshort\n{'x' * (k % 13)}") for k in range(400)] + [(None, "a line that all hold"), (-1, "A LINE that all hold \n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("salt", F.lit(1))
    for least in (100, 1):
        monkeypatch.setattr(line_dedup, "SAMPLE", 300 * least)
        assert by_id(line_dedup.dedup_lines(docs).collect(), "n_lines", "n_dropped", "kept_sha256") == ordered(brute.line_dedup(rows))


@pytest.mark.parametrize(("chunks", "ranges"), [(None, None), (1, 1), (5, 300)])
def test_substring_dedup(docs, chunks, ranges):
    got = substring_dedup.remove_repeats(docs, chunks=chunks, ranges=ranges).collect()
    assert by_id(got, "n_words", "n_removed", "kept_sha256") == ordered(brute.substring_dedup(texts(docs)))
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_substring_dedup_of_shared_passages(spark):
    """Passages in every document, inside one document, and in different texts under one id."""
    import random

    rng = random.Random(2)
    say = lambda n: " ".join(f"v{rng.randrange(300)}" for _ in range(n))
    hot, other = say(60), say(55)
    rows = [(k % 40, f"{say(rng.randint(0, 30))} {hot} {say(5)}") for k in range(60)] + [(k, f"{other} {other} {say(9)}") for k in (7, 7, 90, 91)] + [(None, hot), (95, other[: len(other) // 2])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for chunks, ranges in ((None, None), (30, 3)):
        got = substring_dedup.remove_repeats(docs, chunks=chunks, ranges=ranges).collect()
        assert by_id(got, "n_words", "n_removed", "kept_sha256") == ordered(brute.substring_dedup(rows))


@pytest.mark.parametrize("dense", [512, 4])
def test_simhash(docs, dense, monkeypatch):
    monkeypatch.setattr(simhash_dedup.links, "__defaults__", (3, dense))
    got = simhash_dedup.near_duplicates(docs).collect()
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == brute.components(texts(docs))


def test_simhash_links_are_complete(spark):
    import random
    rng = random.Random(3)
    centre = [rng.getrandbits(64) for _ in range(30)]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centre for _ in range(30)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    for dense in (512, 12):
        assert {(r["a"], r["b"]) for r in simhash_dedup.links(fps, dense=dense).collect()} == want


def test_ring_masks_lose_no_pair():
    import random

    rng = random.Random(9)
    masks = simhash_dedup._first_masks()
    assert len(masks) == 16 and all(m.bit_count() == 28 for _, m in masks)
    for _ in range(3000):
        x = sum(1 << b for b in rng.sample(range(64), 3))
        fits = [m for i, m in masks if not x & m and all((x & sum(0xFFFF << 16 * ((i + j) % 4) for j in range(n))).bit_count() < n for n in (1, 2, 3))]
        assert fits
        for parts in simhash_dedup._PARTS:
            assert any(not x & p for p in parts) and sum(p & (1 << 64) - 1 for p in parts) == (1 << 64) - 1


def test_simhash_of_one_id_with_many_texts(spark):
    rows = [(1, "alpha beta gamma delta"), (1, "one two three four"), (1, "red green blue black"), (1, "north east south west"), (0, "red green blue black"), (2, "north east south west"), (3, "one two three four"), (4, "alpha beta gamma delta")]
    got = simhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == brute.components(rows)


def test_keep_first(odd_docs):
    kept = [r["doc_id"] for r in simhash_dedup.keep_first(odd_docs).collect()]
    parts = {d: c for d, _, c in brute.components(texts(odd_docs))}
    assert sorted(d for d in kept if d is not None) == sorted(d for d, _ in texts(odd_docs) if d is not None and parts[d] == d)
    assert kept.count(None) == 2


def test_decontamination_finds_planted_passages(spark, documents, sf):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    words = items[0][1].split()
    filler = "one two three four five six seven eight nine ten".split()
    swapped = [w if i % 6 else "zz" for i, w in enumerate(words)]
    half = [w if i % 2 else "zz" for i, w in enumerate(words)]
    rows = [(1, " ".join(filler + words + filler)), (2, " ".join(filler + swapped)), (3, " ".join(filler + half)), (4, items[0][1].upper()), (5, None), (6, ""), (None, items[0][1]), (7, " ".join(words[:6])), (1, items[1][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("item_id", F.lit(9))
    got = decontaminate.find_overlaps(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    pairs = {(r["doc_id"], r["item_id"]) for r in got.collect()}
    assert {d for d, _ in pairs} == {1, 2, 4}, pairs
    assert {(1, items[0][0]), (1, items[1][0])} <= pairs
    assert decontaminate.decontaminate(docs, spark.createDataFrame(items, "item_id bigint, text string")).count() == 5


def test_decontamination_against_containment(spark, documents, sf):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {r["doc_id"] for r in decontaminate.find_overlaps(documents, bench).collect()}
    items = [" ".join(r["text"].lower().split()) for r in bench.collect()]
    want = {d for d, t in texts(documents) if any(i in " ".join((t or "").lower().split()) for i in items)}
    assert want <= got and len(got) <= len(want) + 5


def test_masks_lose_no_accepted_pattern():
    from itertools import combinations

    for n in range(5, 21):
        masks = decontaminate.FIVE if n == 5 else decontaminate.MASKS
        places = [{j + k for k, bit in enumerate(m) if bit == "1"} for m in masks for j in range(n - len(m) + 1)]
        for gone in combinations(range(n), n - -(-4 * n // 5)):
            assert any(p.isdisjoint(gone) for p in places), (n, gone)


def test_decontamination_against_brute_force(spark):
    import random
    from itertools import combinations

    rng = random.Random(11)
    item = {n: [f"i{n}w{k}" for k in range(n)] for n in range(1, 27)}
    items = [(n, " ".join(w)) for n, w in item.items()] + [(40, "a b a a b a"), (41, "b a b a b")]
    rows = [(1000 + k, " ".join(rng.choice("ab") for _ in range(rng.randint(1, 30)))) for k in range(20)]
    for n, w in item.items():
        most = n - -(-4 * n // 5) if n <= 20 else 5
        ways = [g for k in range(most + 2) for g in combinations(range(n), k)]
        ways = rng.sample(ways, min(len(ways), 40)) + [tuple(range(4, n, 5))[:most]]
        rows += [(10_000 * n + k, " ".join(["x"] * rng.randint(0, 3) + ["zz" if p in g else x for p, x in enumerate(w)] + ["y"] * rng.randint(0, 3))) for k, g in enumerate(ways)]
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    for fewest in (5, 1):
        got = decontaminate.find_overlaps(docs, bench, min_words=fewest).collect()
        assert {(r["doc_id"], r["item_id"]): (r["start"], r["n_matched"]) for r in got} == brute.overlaps(rows, items, min_words=fewest)


def test_decontamination_of_tables_against_brute_force(spark, documents, sf):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()][:6]
    rows = [(d, t) for d, t in texts(documents) if len(t or "") < 4000][:60] + [(-1, items[0][1])]
    got = decontaminate.find_overlaps(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): (r["start"], r["n_matched"]) for r in got} == brute.overlaps(rows, items)


def test_short_odd_and_empty_benchmarks(spark, odd_docs, no_docs):
    items = [(1, "aaaa bbbb"), (2, "a b c a b"), (3, None), (4, ""), (5, "AAAA  Bbbb"), (5, "aaaa bbbb"), (6, "a"), (None, "aaaa bbbb"), (7, "b c a b c a b"), (7, "b c a")]
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    got = decontaminate.find_overlaps(odd_docs, bench).collect()
    want = brute.overlaps(texts(odd_docs), items)
    assert {(r["doc_id"], r["item_id"]): (r["start"], r["n_matched"]) for r in got} == want and len(got) == len(want)
    assert {(9, 1), (9, 5), (10, 1), (16, 2), (16, 6)} <= set(want)
    assert decontaminate.find_overlaps(odd_docs, bench.limit(0)).count() == 0
    assert decontaminate.find_overlaps(no_docs, bench).count() == 0


def test_bitmaps_of_any_size_give_the_same(spark, documents, sf, monkeypatch):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    some = documents.limit(50)
    found = []
    for bits in (1 << 12, 1 << 24):
        monkeypatch.setattr(decontaminate, "BITMAP_BITS", bits)
        found.append(sorted(map(str, decontaminate.find_overlaps(some, bench).collect())))
    assert found[0] == found[1]


def test_quality_statistics(docs):
    stats = quality_rules.judge(quality_rules.statistics(docs), []).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = defaultdict(list)
    for d, t in texts(docs):
        want[d].append(brute.quality(t))
    assert by_id(stats, *columns) == ordered(want)


def test_quality_rules_separate_junk(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rules = quality_rules.fit(docs, labels)
    assert rules
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(quality_rules.statistics(docs), rules).collect()}
    good = [got[r["doc_id"]] for r in labels.collect() if r["quality"] == 1 and r["doc_id"] in got]
    bad = [got[r["doc_id"]] for r in labels.collect() if r["quality"] == 0 and r["doc_id"] in got]
    assert sum(bad) / len(bad) < 0.2 and sum(good) / len(good) > 0.7


def test_quality_rules_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet").withColumn("k", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3)
    rules = quality_rules.fit(docs, labels.where("k > 0").drop("k"))
    held = docs.join(labels.where("k = 0").select("doc_id", "quality"), "doc_id")
    got = quality_rules.judge(quality_rules.statistics(held, carry=("quality",)), rules).where("not base_failed").select("carried.quality", "kept").collect()
    good, bad = ([r["kept"] for r in got if r["quality"] == q] for q in (1, 0))
    assert rules and sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.1


def test_quality_rules_emit_what_they_learned(docs):
    conditions = [("words", True, 5.0), ("repeated_share", False, 0.9), ("capitals_per_char", True, 0.01), ("symbols_per_word", True, 0.0)]
    made = [quality_rules.Condition(*c) for c in conditions]
    rules = [quality_rules.Rule((made[0], made[2]), 1.0, 9), quality_rules.Rule((made[1], made[3]), 1.0, 9)]
    stats = quality_rules.statistics(docs)
    rows = quality_rules.judge(stats, rules).select("*", *(F.expr(e).cast("double").alias(f"f_{n}") for n, e in quality_rules.FEATURES.items())).collect()
    for r in rows:
        fits = [k for k in rules if k.holds({n: r[f"f_{n}"] for n in quality_rules.FEATURES})]
        assert r["rule"] == ("base" if r["base_failed"] else str(fits[0]) if fits else None) and r["kept"] == (r["rule"] is None)


def test_quality_rules_count_an_id_once(spark):
    text = lambda k: " ".join(f"w{(k * j) % 97}" for j in range(60 + k))
    docs = spark.createDataFrame([(k % 50, text(k)) for k in range(200)] + [(None, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k % 50, k % 2) for k in range(60)], "doc_id bigint, quality int")
    twice = labels.union(labels).union(spark.createDataFrame([(None, 0), (3, None)], "doc_id bigint, quality int"))
    assert quality_rules.fit(docs, labels) == quality_rules.fit(docs.union(docs), twice)


def test_repeated_windows_that_share_hash_bits(spark):
    rows = [(1, "a b c x a b c"), (2, "a b a b a b"), (3, "a a a"), (4, "a a a a"), (5, " ".join(f"w{k}" for k in range(40_000)) + " w7 w8 w9"), (6, "a b"), (7, None)]
    got = quality_rules.statistics(spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("carried", F.lit(1))).collect()
    assert {r["doc_id"]: r["n_repeat_words"] for r in got} == {d: brute.quality(t)[4] for d, t in rows}


def test_quality_rules_without_labels(odd_docs, spark):
    assert quality_rules.fit(odd_docs, spark.createDataFrame([], "doc_id bigint, quality int")) == []
    assert quality_rules.fit(odd_docs, spark.createDataFrame([(None, 1), (1, None), (2, 0)], "doc_id bigint, quality int")) in ([],)


def secret_rows(spark):
    """Texts with many credentials of all kinds, whole, cut short, glued together and in odd letter cases."""
    import random

    rng = random.Random(8)
    parts = [
        "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----", "-----begin PRIVATE KEY-----", "ghp_" + "aZ9" * 13, "ghx_" + "aZ9" * 13, "gho_short",
        "xoxb-1234567890-abc", "xoxz-1234567890", "AIza" + "b_" * 18, "AIza" + "b" * 30, "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12, "eyJ" + "a" * 12 + ".xyJ",
        "ftp://me:pw@host", "http://host/a:b@c", "Password = 'hunter22'", "api-key: abcdefgh", "APIKEY=abcdefgh", "to\u212aen: abcdefgh", "toKEN : abcdefgh",
        "AKIA" + "Z9" * 9, "AKIA", "0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "secret=token=abcdefgh", "\U0001f600", "\u00e9t\u00e9", "\u0130", "word", "\n", "  ", "a://b:c@",
    ]
    rows = [(k, rng.choice(["", " ", "\n", "x"]).join(rng.choice(parts) for _ in range(rng.randint(0, 12)))) for k in range(300)]
    rows += [(900, " ".join(parts * 150)), (901, "password=abcdef " * 3000), (1, "token: abcdefgh"), (1, "token: abcdefgh"), (None, " ".join(parts)), (902, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("blocks", [None, 16])
@pytest.mark.parametrize("which", ["documents", "odd_docs", "secret_rows"])
def test_secrets_equal_a_full_scan_by_every_rule(request, spark, which, blocks):
    docs = secret_rows(spark) if which == "secret_rows" else request.getfixturevalue(which)
    got = secret_scan.scan(docs, blocks=blocks)
    base = F.filter("spans", lambda s: s["place"] < 3)
    rows = got.select("doc_id", *(queries._count(k).alias(k) for k in ("assign", "access", "hex")), F.sha2(secret_scan.digest(base), 256).alias("sha"), secret_scan.digest(F.col("spans")).alias("spans")).collect()
    want = defaultdict(list)
    for d, t in texts(docs):
        want[d].append(brute.secrets(t, [(r.kind, r.pattern) for r in secret_scan.EXTRA]))
    assert by_id(rows, "assign", "access", "hex", "sha", "spans") == ordered(want)


def test_clauses_admit_every_match():
    import re

    assert set(secret_scan._clauses(secret_scan.trigram_query("abcd(xyz|uvw)"))) == {frozenset(["abc", "bcd", "cdx", "dxy", "xyz"]), frozenset(["abc", "bcd", "cdu", "duv", "uvw"])}
    wide = ("and", *(("or", *(f"{a}{k:02d}" for k in range(9))) for a in "abcd"))
    clauses = secret_scan._clauses(wide)  # parts are left out, so a clause asks for less, never for more
    assert len(clauses) <= secret_scan._MOST and all(any(c <= {f"{a}{k:02d}" for a in "abcd"} for c in clauses) for k in range(9))
    look = secret_scan._looking_for(["aki", "kia", "a.b", "://"])
    assert [m[1] for m in re.finditer(look, "akia a.b axb ://")] == ["aki", "kia", "a.b", "://"]


def test_trigram_queries():
    assert secret_scan.trigram_query(r"AKIA[A-Z0-9]+") == ("and", "aki", "kia")
    assert secret_scan.trigram_query(r"[0-9a-f]{24,}") is True
    assert secret_scan.trigram_query(r"(abcd|abce)x?") == ("or", ("and", "abc", "bcd"), ("and", "abc", "bce"))
    assert secret_scan.trigram_query(r"ab?c") is True
    assert "passwor" not in secret_scan.trigrams_of(secret_scan.trigram_query(secret_scan.BASE[0].pattern))


def test_extra_secrets(spark):
    rows = [(1, "x ghp_" + "aZ" * 20), (2, "-----BEGIN RSA PRIVATE KEY-----"), (3, "ftp://me:pw@host"), (4, "nothing")]
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: ["code_host_token"], 2: ["private_key"], 3: ["url_login"], 4: []}


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs, language_id.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_languages_that_are_rare(spark):
    """A language of 6 rows in 6,000 is learned and found; held-out rows and other columns play no part."""
    import random

    rng = random.Random(4)
    alphabets = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "\u03b1\u03b2\u03b3\u03b4"}
    say = lambda g: " ".join("".join(rng.choice(alphabets[g]) for _ in range(5)) for _ in range(12))
    rows = [(k, "cc" if k % 1000 == 7 else "aa" if k % 2 else "bb") for k in range(6000)]
    rows = [(k, say(g), g, "src") for k, g in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    model = language_id.fit(docs)
    assert model.langs == ["aa", "bb", "cc"]
    got = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert [g for g in ("aa", "bb", "cc") if any(r["lang"] == g != r["lang_pred"] for r in got)] == []
    again = language_id.fit(docs.union(docs).withColumn("lang", F.when(language_id.held_out(), "zz").otherwise(F.col("lang"))))
    assert again.langs == model.langs


def test_numbers_are_not_letters(spark):
    texts = ["\u00b2 \u00bd \u2460 \u2167", "12_3", "\u0661", "\u00e9", "\u4e2d", "x" * 3, None, "", "\u00b2a", "\u02b0"]
    want = [False, False, False, True, True, True, False, False, True, True]
    assert [language_id.has_letter(t) for t in texts] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("lang", F.lit("en"))
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, language_id.fit(docs)).collect()}
    assert got == {k: "en" if w else "und" for k, w in enumerate(want)}


def test_language_ties_and_repeated_rows(spark):
    import numpy as np

    flat = language_id.LanguageModel(["aa", "bb"], np.zeros((language_id.BUCKETS, 2), np.float32), np.zeros(2, np.float32), 1.0, 0.5)
    docs = spark.createDataFrame([(1, "word"), (1, "word"), (None, "word"), (2, None)], "doc_id bigint, text string").withColumn("score", F.lit("x"))
    got = sorted(map(str, language_id.identify(docs, flat).select("doc_id", "lang_pred", "score").collect()))
    assert got == sorted(map(str, spark.createDataFrame([(1, "aa", 0.5), (1, "aa", 0.5), (None, "aa", 0.5), (2, "und", 0.0)], "doc_id bigint, lang_pred string, score double").collect()))


def test_language_of_odd_rows(odd_docs, no_docs):
    model = language_id.fit(odd_docs)
    got = by_id(language_id.identify(odd_docs, model).collect(), "lang_pred", "score", "held_out")
    assert all(x[0] == "und" for d in (3, 4, 5) for x in got[d])
    empty = language_id.fit(no_docs)
    assert {r["lang_pred"] for r in language_id.identify(odd_docs, empty).collect()} == {"und"}
    assert language_id.identify(no_docs, model).count() == 0


def small_sources(spark):
    """Sources of few and short documents, some without words, and one with most of the rows."""
    rows = [(k, " ".join(["w"] * n), s) for s, (count, n) in {"a": (300, 3), "b": (50, 20), "c": (10, 7), "d": (1, 1), "e": (5, 0), "f": (2, 900), "g": (2000, 11), None: (7, 5)}.items() for k in range(count)]
    return spark.createDataFrame([(k, t, s) for k, (_, t, s) in enumerate(rows)], "doc_id bigint, text string, source string")


@pytest.mark.parametrize("how", [{}, {"shard_words": 40, "fan": 3}, {"shard_words": 500, "fan": 1024}])
@pytest.mark.parametrize("which", ["documents", "odd_docs", "small_sources"])
def test_mixing(request, spark, which, how):
    docs = small_sources(spark) if which == "small_sources" else request.getfixturevalue(which)
    got = mixing.mix(docs, **how).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
    want, taken = brute.targets(sizes), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= mixing.BLOCK, s
    assert abs(sum(taken.values()) - sum(want.values())) <= 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5), **how).collect()))
    assert sum(r["size"] for r in got) == sum(len(brute.WORD.findall(t or "")) for _, t in texts(docs))


def test_dealing_with_little_room(spark):
    """Equal quotients go by name; a full row passes its blocks on; nothing is lost while there is room."""
    rows = spark.createDataFrame([("g", "a", 10.0, 5), ("g", "b", 10.0, 500), ("g", "c", 10.0, 500), ("h", "a", 3.0, 7)], "g string, name string, votes double, room bigint")
    got = {(r["g"], r["name"]): r["got"] for r in mixing.deal(rows, "votes", "room", F.when(F.col("g") == "g", 100).otherwise(50), ["g"], ["name"], "got").collect()}
    assert got["g", "a"] == 5 and got["g", "b"] + got["g", "c"] == 95 and got["h", "a"] == 7
    even = spark.createDataFrame([("g", n, 1.0, 99) for n in "cab"], "g string, name string, votes double, room bigint")
    assert {r["name"]: r["got"] for r in mixing.deal(even, "votes", "room", F.lit(32), ["g"], ["name"], "got").collect()} == {"a": 16, "b": 16, "c": 0}


@pytest.mark.parametrize("seats", [0, 1, 2, 7, 50, 333])
def test_sainte_lague(spark, seats):
    votes = {"a": 53.0, "b": 24.0, "c": 23.0, "d": 1.0, "e": 0.0, "f": 23.0}
    rows = spark.createDataFrame([("g", k, v) for k, v in votes.items()], "g string, name string, votes double")
    got = mixing.apportion(rows, "votes", F.lit(seats), ["g"], ["name"], "seats").collect()
    assert {r["name"]: r["seats"] for r in got} == brute.sainte_lague(votes, seats)


def test_urls(spark, sf):
    odd = [None, "", "no scheme", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com", "http://a.example.com/en/?q", "x://net/es/", "x://notnet/es/", "http://[::1]/", "://net/fr/1", "a://b://net/es/", "http://m.com?/en/"]
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").union(spark.createDataFrame([(-k, u) for k, u in enumerate(odd)], "page_id bigint, url string"))
    got = url_filter.filter_urls(pages.withColumn("rule", F.lit(1)), queries.URL_RULES).collect()
    want = {(r["page_id"], *brute.url(r["url"])) for r in pages.collect()}
    assert {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == want
    assert url_filter.filter_urls(pages.limit(0), queries.URL_RULES).count() == 0


def test_urls_that_are_long_or_repeated(spark):
    deep, far = "http://" + "a." * 3000 + "example.com/en/x", "http://h.net/es/" + "y" * 100_000 + "?q"
    rows = [(1, deep), (1, deep), (2, far), (2, far), (None, "http://www.example.com/en/"), (3, "http:///fr/"), (4, "://"), (5, "a://b\nc.com/d\n")]
    got = url_filter.filter_urls(spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit(1)), queries.URL_RULES).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *brute.url(u)) for i, u in rows), key=str)


def test_a_million_rules(tmp_path):
    """Every rule is found among 1,000,000, nothing else is; a look-up costs a binary search."""
    import time

    path = tmp_path / "rules"
    path.write_bytes(url_filter.build_array([(f"h{k}.example{k % 7}.org", "/" if k % 2 else "/x/", url_filter.VERDICTS[k % 2]) for k in range(1_000_000)]))
    array = url_filter.RuleArray(str(path))
    some = range(0, 1_000_000, 101)
    began = time.perf_counter()
    got = url_filter.judge(array, [f"http://www.h{k}.example{k % 7}.org/x/y" for k in some])
    miss = url_filter.judge(array, [f"http://h{k}.example{(k + 1) % 7}.org/x/y" for k in some])
    assert time.perf_counter() - began < 20
    assert [g[2:] for g in got] == [(f"h{k}.example{k % 7}.org" + ("/" if k % 2 else "/x/"), url_filter.VERDICTS[k % 2]) for k in some]
    assert {m[2:] for m in miss} == {(None, "allow")}


def test_url_collisions(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda b: len(b) % 3)
    path = tmp_path / "rules"
    path.write_bytes(url_filter.build_array([(f"h{k}.org", "/", "block") for k in range(40)]))
    array = url_filter.RuleArray(str(path))
    assert [url_filter.judge(array, [f"http://h{k}.org/"])[0][3] for k in (0, 17, 39, 40)] == ["block"] * 3 + ["allow"]
    assert url_filter.judge(array, ["http://h3.org/x"])[0][2] == "h3.org/"


def test_quality_classifier(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_classifier.fit(docs, labels)
    got = {r["doc_id"]: r["kept"] for r in quality_classifier.classify(docs, model).collect()}
    good = [got[r["doc_id"]] for r in labels.collect() if r["quality"] == 1]
    bad = [got[r["doc_id"]] for r in labels.collect() if r["quality"] == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.3
    kept = quality_classifier.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(got.values())


def test_quality_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet").withColumn("k", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3)
    model = quality_classifier.fit(docs, labels.where("k > 0"))
    got = quality_classifier.classify(docs, model).join(labels.where("k = 0"), "doc_id").collect()
    right = [r["kept"] == (r["quality"] == 1) for r in got]
    good = [r["kept"] for r in got if r["quality"] == 1]
    assert sum(right) / len(right) > 0.95 and sum(good) / len(good) > 0.97


def test_co_training_beats_either_view():
    import numpy as np

    def area(score, y):
        place = np.argsort(np.argsort(score))
        n = y.sum()
        return (place[y > 0].sum() - n * (n - 1) / 2) / (n * (len(y) - n))

    gains = []
    for seed in range(5):
        rng = np.random.default_rng(seed)
        y = (rng.random(6000) < 0.6).astype(float)
        views = [np.concatenate((y[:, None] * 2 + rng.normal(0, 1, (6000, 1)), rng.normal(0, 1, (6000, 8))), axis=1) for _ in range(2)]
        known, pool, test = slice(0, 80), slice(80, 4000), slice(4000, 6000)
        alone, both = (quality_classifier.co_train(views[0][known], views[1][known], y[known], views[0][pool], views[1][pool], rounds=k) for k in (0, 5))
        singles = [area(alone.content.logit(views[0][test]), y[test]), area(alone.metadata.logit(views[1][test]), y[test])]
        gains.append((area(both.score(views[0][test], views[1][test]), y[test]) - max(singles), area(both.content.logit(views[0][test]), y[test]) - singles[0]))
    assert min(g for g, _ in gains) > 0 and sum(g for _, g in gains) > 0


def test_a_view_that_knows_nothing_does_no_harm():
    import numpy as np

    rng = np.random.default_rng(1)
    y = (rng.random(3000) < 0.85).astype(float)
    sure, noise = y[:, None] + rng.normal(0, 0.1, (3000, 1)), rng.normal(0, 1, (3000, 30))
    for few in (40, 200):
        model = quality_classifier.co_train(sure[:few], noise[:few], y[:few], sure[few:2000], noise[few:2000])
        assert ((model.score(sure[2000:], noise[2000:]) >= 0.5) == (y[2000:] > 0)).mean() > 0.95


def test_quality_classifier_ties_and_repeated_ids(spark):
    docs = spark.createDataFrame([(k % 60, f"w{k} " * (k % 60 + 3), "s") for k in range(240)], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id bigint, quality int")
    one, two = (quality_classifier.fit(d, labels) for d in (docs, docs.union(docs).repartition(3)))
    rows = [sorted(map(str, quality_classifier.classify(docs, m).collect())) for m in (one, two)]
    assert rows[0] == rows[1]
    one.threshold = quality_classifier.classify(docs, one).first()["score"]
    assert quality_classifier.classify(docs, one).where(F.col("score") == one.threshold).where("not kept").count() == 0


def test_quality_classifier_on_odd_rows(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None), (4, 0)], "doc_id bigint, quality int")
    model = quality_classifier.fit(odd_docs, labels)
    assert model.content is None
    assert quality_classifier.classify(odd_docs, model).where("kept and score = 1").count() == odd_docs.count()
    assert quality_classifier.keep_good(no_docs, model).count() == 0
    assert quality_classifier.classify(odd_docs.select("doc_id", "text"), model).count() == odd_docs.count()


def test_empty_tables(no_docs):
    for f in (line_dedup.dedup_lines, substring_dedup.remove_repeats, simhash_dedup.near_duplicates, simhash_dedup.keep_first, mixing.mix, secret_scan.scan, quality_rules.statistics):
        assert f(no_docs).count() == 0
