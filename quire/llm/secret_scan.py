"""Secret scans over a trigram inverted index.  JVM expressions only.

Each rule's regular expression becomes a Boolean query over trigrams that every match must contain.  The
index keeps, for blocks of documents, the ids that hold each trigram some query asks for; a query
intersects and unites posting lists inside a block, and the regular expression runs only on the resulting
candidates.  A rule from which no mandatory trigram follows scans every document.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as sre  # the parse tree's node names
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import stored

BLOCK_ROWS = 1024
_MOST = 64  # exact strings followed at a time
#: Fixed order: letters by their frequency in prose.
COMMON = "etaoinshrdlcumwfgypbvkjxqz"


@dataclass(frozen=True)
class Rule:
    """``least`` is the least length of ``group`` in a match that counts."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: Fixed patterns of the contract; the first three kinds, in this order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: What the method adds: fixed formats of well-known credentials.
EXTRA = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/:@]+@"),
)

# A query is True (anything may match), a trigram, ("and", ...) or ("or", ...).
Query = bool | str | tuple


def _all(parts: list[Query]) -> Query:
    kept = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not kept else kept[0] if len(kept) == 1 else ("and", *kept)


def _any(parts: list[Query]) -> Query:
    """A disjunction; a conjunction that asks for all of another one's trigrams adds nothing to it."""
    flat = {p: frozenset(p[1:]) if isinstance(p, tuple) and p[0] == "and" else frozenset([p]) for p in parts}
    kept = [p for p in flat if not any(flat[q] < flat[p] for q in flat)]
    return True if True in kept else kept[0] if len(kept) == 1 else ("or", *kept)


def _of_strings(strings: set[str]) -> Query:
    return _any([_all([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query, over lower-cased text, that every match of ``pattern`` satisfies."""
    exact, query = _walk(_parser.parse(pattern))
    return _all([query, _of_strings(exact)]) if exact is not None else query


def _walk(nodes) -> tuple[set[str] | None, Query]:
    """The strings the nodes match exactly (None if unknown), and a query met by all matches."""
    runs: set[str] = {""}
    whole, parts = True, []

    def cut() -> None:
        nonlocal runs, whole
        parts.append(_of_strings(runs))
        runs, whole = {""}, False

    for op, arg in nodes:
        exact, query = _node(op, arg)
        parts.append(query)
        if exact is None:
            cut()
        elif len(runs) * len(exact) > _MOST:
            cut()
            runs = exact if len(exact) <= _MOST else {""}
        else:
            runs = {a + b for a, b in itertools.product(runs, exact)}
    if whole:
        return runs, _all(parts)
    parts.append(_of_strings(runs))
    return None, _all(parts)


def _node(op, arg) -> tuple[set[str] | None, Query]:
    if op is sre.LITERAL:
        return {chr(arg).lower()}, True
    if op is sre.SUBPATTERN:
        return _walk(arg[-1])
    if op is sre.BRANCH:
        branches = [_walk(b) for b in arg[1]]
        if all(e is not None for e, _ in branches):
            return set().union(*(e for e, _ in branches)), True
        return None, _any([_all([q, _of_strings(e)]) if e is not None else q for e, q in branches])
    if op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 8:
        return {chr(c).lower() for _, c in arg}, True
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = arg
        exact, query = _walk(inner)
        if low == 0:
            return ({"", *exact}, True) if high == 1 and exact is not None else (None, True)
        if exact is not None and low == high and len(exact) ** low <= _MOST:
            return {"".join(p) for p in itertools.product(exact, repeat=low)}, True
        return None, _all([query, _of_strings(exact)]) if exact is not None else query
    if op is sre.AT:
        return {""}, True
    return None, True


def trigrams_of(query: Query) -> set[str]:
    if isinstance(query, tuple):
        return set().union(*map(trigrams_of, query[1:]))
    return {query} if isinstance(query, str) else set()


def _clauses(query: Query) -> list[frozenset[str]]:
    """The query as a disjunction of trigram sets.  Where that would take more than ``_MOST`` sets, parts of a
    conjunction are left out, which only admits more candidates."""
    if isinstance(query, str):
        return [frozenset([query])]
    if query[0] == "or":
        return list(dict.fromkeys(c for q in query[1:] for c in _clauses(q)))
    out = [frozenset()]
    for part in sorted(map(_clauses, query[1:]), key=len):
        if len(out) * len(part) <= _MOST:
            out = list(dict.fromkeys(a | b for a, b in itertools.product(out, part)))
    return out


def _rarest(clause: frozenset[str], most: int = 2) -> frozenset[str]:
    """The trigrams least expected in prose: a clause that asks for fewer still holds for every match."""
    return frozenset(sorted(clause, key=lambda t: (sum(map(COMMON.find, t.replace(" ", "e"))) if set(t) <= {*COMMON, " "} else 99, t))[-most:])


def plan(query: Query) -> list[frozenset[str]]:
    """The clauses that the index is asked for."""
    return list(dict.fromkeys(map(_rarest, _clauses(query))))


def _tree(strings: list[str]) -> str:
    """An expression for equally long strings, sorted: a binary tree over each next character."""
    groups = [(c, [t[1:] for t in some]) for c, some in itertools.groupby(strings, key=lambda t: t[:1])]
    if len(groups) == 1:
        first, rest = groups[0]
        return re.escape(first) + _tree(rest) if first else ""
    left, right = groups[: len(groups) // 2], groups[len(groups) // 2 :]
    ahead = "".join(re.escape(c) for c, _ in left)
    return f"(?:(?=[{ahead}]){_tree([c + t for c, some in left for t in some])}|{_tree([c + t for c, some in right for t in some])})"


def _looking_for(trigrams: list[str]) -> str:
    """A regular expression that meets every occurrence of the trigrams, overlapping ones too."""
    return f"(?=({_tree(sorted(trigrams))}))"


def build_index(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """Posting lists ``(block, trigram, docs)`` of the vocabulary's trigrams over lower-cased texts.

    A block is a hash slice of the ids.  By default there is one for every ``BLOCK_ROWS`` rows, so neither a
    list nor the lists of one block grow with the table.  Rows without an id or text post nothing.
    """
    blocks = blocks or max(1, -(-docs.count() // BLOCK_ROWS))
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(_looking_for(vocabulary)), F.lit(1)))
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), found.alias("found"))
    posts = rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block"), "doc_id", F.explode("found").alias("trigram"))
    return posts.groupBy("block", "trigram").agg(F.collect_set("doc_id").alias("docs"))


def candidates(index: DataFrame, plans: dict[str, list[frozenset[str]]]) -> DataFrame:
    """Rows ``(doc_id, kinds)``: the documents that satisfy the plan of each kind.

    Inside a block, a clause intersects the posting lists of its trigrams and a query unites its clauses.
    """
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "docs"))).alias("lists"))
    asked = [{"kind": kind, "clauses": [sorted(c) for c in clauses]} for kind, clauses in plans.items()]
    asked = F.from_json(F.lit(json.dumps(asked)), "array<struct<kind:string,clauses:array<array<string>>>>")
    none = F.array().cast("array<bigint>")

    def met(clause: Column) -> Column:
        every = F.transform(clause, lambda t: F.coalesce(F.try_element_at("lists", t), none))
        return F.aggregate(F.slice(every, 2, F.size(every)), F.get(every, 0), F.array_intersect)

    hits = F.transform(asked, lambda q: F.struct(q["kind"].alias("kind"), F.array_distinct(F.flatten(F.transform(q["clauses"], met))).alias("docs")))
    hits = lists.select(F.explode(hits).alias("h")).select("h.kind", F.explode("h.docs").alias("doc_id"))
    return hits.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


_SPANS = "array<struct<start:int,place:int,end:int,kind:string>>"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """Matches as ``array<struct<start, place, end, kind>>`` in code points, end exclusive; for texts with a match.

    Positions are running sums over the text's gaps and matches, taken in slices of about the square root
    of their number, since every append copies its array.
    """
    pattern = F.lit(rule.pattern)
    found = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length)
    inner = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.char_length) if rule.group else None
    gaps = F.transform(F.split(text, rule.pattern), F.char_length)
    steps = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("g"), m.alias("m"), m.alias("n")))
    if inner is not None:
        steps = F.zip_with(steps, inner, lambda s, n: F.struct(s["g"].alias("g"), s["m"].alias("m"), n.alias("n")))

    def step(acc: Column, s: Column) -> Column:
        start, end = acc["at"] + s["g"], acc["at"] + s["g"] + s["m"]
        span = F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        return F.struct(end.alias("at"), F.when(s["n"] >= rule.least, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    def sliced(steps: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(steps))).cast("int")
        return F.transform(F.sequence(F.lit(0), ((F.size(steps) - 1) / width).cast("int")), lambda k: F.slice(steps, k * width + 1, width))

    def placed(slices: Column) -> Column:
        lengths = F.transform(slices, lambda part: F.aggregate(part, F.lit(0), lambda a, s: a + s["g"] + s["m"]))
        starts = F.aggregate(lengths, F.array(F.lit(0)), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n))
        begun = lambda at: F.struct(at.alias("at"), F.array().cast(_SPANS).alias("out"))
        return F.flatten(F.zip_with(slices, F.slice(starts, 1, F.size(slices)), lambda part, at: F.aggregate(part, begun(at), step)["out"]))

    return _bound(F.filter(steps, lambda s: s["m"].isNotNull()), lambda x: _bound(sliced(x), placed))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + EXTRA, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, spans``, an array of ``struct<start, place, end, kind>`` sorted by
    start, then by the rules' order.

    Matches of one rule are leftmost and do not overlap; matches of different rules may.  NULL and empty
    texts have no spans.  Repeated rows are scanned each; rows with a NULL id scan by every rule, as
    the index cannot name them.  Other columns are ignored.
    """
    plans = {r.kind: plan(q) for r in rules if (q := trigram_query(r.pattern)) is not True}
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if plans:
        index = stored(build_index(rows, sorted(frozenset().union(*(c for clauses in plans.values() for c in clauses))), blocks=blocks), "trigrams")
        named = candidates(index, plans).withColumnRenamed("doc_id", "_id")
        rows = rows.join(named, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", "kinds")
    else:
        rows = rows.withColumn("kinds", F.lit(None).cast("array<string>"))
    none = F.array().cast(_SPANS)
    parts = []
    for place, rule in enumerate(rules):
        asked = F.lit(True) if rule.kind not in plans else F.col("doc_id").isNull() | F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        parts.append(F.when(asked & F.col("text").rlike(rule.pattern), _spans(F.col("text"), rule, place)).otherwise(none))
    return rows.select("doc_id", F.sort_array(F.concat(*parts)).alias("spans"))


def digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
