"""Page-level judgements: types, confidence, profiles, plans and continuations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bonus of a six-, seven- and eight-column hypothesis.
COLUMN_PRIORS = {6: 0.5, 7: 0.1, 8: 0.2}


def valid_date_page(year: Column, month: Column, day: Column, page: Column) -> Column:
    """A real calendar date and a page from 1 to 999."""
    text = F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int"))
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd").isNotNull() & page.between(1, 999), F.lit(False))


def page_type(spans: Column, small: Column, image_share: Column) -> Column:
    """image_only with few spans on a page that is mostly picture, classifieds with very many small ones, else modular."""
    return F.when((spans < 100) & (image_share > 0.5), "image_only").when((spans > 800) & (small > 0.4 * spans), "classifieds").otherwise("modular")


def band_weight(x0: Column, x1: Column, width: Column) -> Column:
    """A band across at least four fifths of the page counts twice; an open end reaches the page's edge."""
    return F.when(F.coalesce(x1, width) - F.coalesce(x0, F.lit(0.0)) >= 0.8 * width, 2).otherwise(1)


def column_count_prior(x: Column, low: Column, high: Column, tolerance: float = 0.10) -> Column:
    """Sum of the bonuses of all column counts one of whose gutters lies within a tenth of a column of ``x``."""
    width, out = F.greatest(F.lit(1.0), high - low), F.lit(0.0)
    for n, bonus in COLUMN_PRIORS.items():
        step = width / n
        nearest = F.greatest(F.lit(1), F.least(F.lit(n - 1), F.round((x - low) / step)))
        out = out + F.when(F.abs(x - low - nearest * step) <= tolerance * step, bonus).otherwise(0.0)
    return out


def confidence(corroboration: Column, rule_support: Column, regularity: Column, completeness: Column, weights: tuple[float, float, float] = (0.4, 0.3, 0.3)) -> Column:
    """Precision parts add up, completeness multiplies: certainty about half a page cannot make up for the other half."""
    parts = weights[0] * corroboration + weights[1] * rule_support + weights[2] * regularity
    return F.round(parts * completeness, 4)


def slice_mean(profile: Column, low: Column, high: Column) -> Column:
    """Mean of the profile's positions from ``low`` up to ``high``; NULL for an empty range."""
    part = F.slice(profile, low + 1, F.greatest(F.lit(0), high - low))
    return F.when(F.size(part) > 0, F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / F.size(part))


def spread(profile: Column) -> Column:
    """Population standard deviation of an array."""
    n = F.size(profile)
    mean = F.aggregate(profile, F.lit(0.0), lambda a, x: a + x) / n
    return F.sqrt(F.aggregate(profile, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / n)


def is_masked(profile: Column, bright: float = 248.0, flat: float = 8.0) -> Column:
    """Uniformly white: mean above ``bright`` and deviation below ``flat``; NULL for nothing to look at."""
    n = F.size(profile)
    mean = F.aggregate(profile, F.lit(0.0), lambda a, x: a + x) / n
    return F.when(n > 0, (mean > bright) & (spread(profile) < flat))


def pattern(profile: Column, dark: float, text: float = 0.05, photo: float = 0.45) -> Column:
    """empty, text or photo by the share of dark positions."""
    share = F.size(F.filter(profile, lambda x: x < dark)) / F.size(profile)
    return F.when(F.size(profile) == 0, None).when(share < text, "empty").when(share < photo, "text").otherwise("photo")


def valleys(profiles: DataFrame, key: str, profile: str, threshold: float, least: int = 1) -> DataFrame:
    """Maximal runs of at least ``least`` positions below the threshold: ``start, end`` (exclusive), ``depth``."""
    from .relations import runs_of_true
    cells = profiles.select(key, F.posexplode(profile).alias("at", "x")).withColumn("low", F.col("x") < threshold)
    runs = runs_of_true(cells, [key], "at", "low")
    return runs.groupBy(key, "run").agg(F.min("at").alias("start"), (F.max("at") + 1).alias("end"), F.min("x").alias("depth")).where(F.col("end") - F.col("start") >= least).drop("run")


def window_matches(grid: Column, query: Column, width: int, rows: int, columns: int, window: int, stride: int = 1) -> Column:
    """Scores of a square window slid over a row-major grid: ``array<struct<y, x, score>>``, the mean product with the query."""
    starts = [(y, x) for y in range(0, rows - window + 1, stride) for x in range(0, columns - window + 1, stride)]
    cells = [(dy * width + dx, dy * window + dx) for dy in range(window) for dx in range(window)]

    def score(y: int, x: int) -> Column:
        out = F.lit(0.0)
        for at, q in cells:
            out = out + F.get(grid, y * width + x + at) * F.get(query, q)
        return F.round(out / len(cells), 4)

    return F.array(*(F.struct(F.lit(y).alias("y"), F.lit(x).alias("x"), score(y, x).alias("score")) for y, x in starts))


def merge_narrow(boundaries: DataFrame, page: str, value: str, score: str, least: float) -> DataFrame:
    """Of each chain of boundaries closer than ``least`` to their predecessor keep the best scored, the leftmost on a tie."""
    from .relations import islands, top_per_key
    found = islands(boundaries, [page], value, least, score)
    return top_per_key(found, [page, "island"], [F.desc(score), F.asc(value)], 1).drop("island")


def left_edge_boundaries(lines: DataFrame, page: str, left: str, right: str, width: float = 1.0, share: float = 0.06) -> DataFrame:
    """Column starts: bins holding a share of the left edges, neighbours merged to their weighted centre, the last right edge added."""
    from .relations import islands
    bins = lines.groupBy(page, F.floor(F.col(left) / width).alias("bin")).agg(F.count("*").alias("n"), F.sum(left).alias("s"))
    solid = bins.withColumn("all", F.sum("n").over(Window.partitionBy(page))).where(F.col("n") >= share * F.col("all"))
    starts = islands(solid, [page], "bin", 1, "bin").groupBy(page, "island").agg(F.round(F.sum("s") / F.sum("n"), 4).alias("boundary")).select(page, "boundary")
    return starts.union(lines.groupBy(page).agg(F.round(F.max(right), 4).alias("boundary")))


def body_lines(lines: DataFrame, page: str, size: str, tolerance: float = 0.25) -> DataFrame:
    """Lines whose size is within a tolerance of their page's median."""
    middle = lines.groupBy(page).agg(F.median(size).alias("_m"))
    return lines.join(middle, page).where(F.abs(F.col(size) - F.col("_m")) <= tolerance * F.col("_m")).drop("_m")


def pair_rules(rules: DataFrame, page: str, key: str, slack: float = 2.0, least: float = 3.0) -> DataFrame:
    """Boxes from a rule and the nearest one below with the same extent: ``top_id, bottom_id, l, t, r, b``."""
    a, b = rules.alias("a"), rules.alias("b")
    on = (F.col(f"a.{page}") == F.col(f"b.{page}")) & (F.abs(F.col("a.l") - F.col("b.l")) <= slack) & (F.abs(F.col("a.r") - F.col("b.r")) <= slack) & (F.col("b.t") >= F.col("a.t") + least)
    best = a.join(b, on).groupBy(f"a.{page}", F.col(f"a.{key}").alias("top_id")).agg(F.min(F.struct("b.t", F.col(f"b.{key}").alias("id"), "a.l", F.col("a.t").alias("top"), "a.r")).alias("m"))
    return best.select(page, "top_id", F.col("m.id").alias("bottom_id"), F.col("m.l").alias("l"), F.col("m.top").alias("t"), F.col("m.r").alias("r"), F.col("m.t").alias("b"))


def preferred_spelling(id_a: Column, name_a: Column, id_b: Column, name_b: Column, marks: Sequence[str] = ("our", "tre")) -> Column:
    """``struct<keep, drop>``: the name spelled the Canadian way is kept, else the first."""
    def canadian(name: Column) -> Column:
        return F.lower(name).rlike("(" + "|".join(marks) + r")\b")

    swap = canadian(name_b) & ~canadian(name_a)
    return F.struct(F.when(swap, id_b).otherwise(id_a).alias("keep"), F.when(swap, id_a).otherwise(id_b).alias("drop"))


def vocabulary_gaps(products: DataFrame, terms: DataFrame, name: str, category: str) -> DataFrame:
    """Products a term names: ``enrich`` where the category agrees or is unknown, ``review`` where it would change."""
    found = products.join(terms.select(F.lower("term").alias("_t"), "term_category"), F.lower(F.col(name)) == F.col("_t"))
    same = F.col(category).isNull() | (F.col(category) == F.col("term_category"))
    return found.withColumn("action", F.when(same, "enrich").otherwise("review")).drop("_t")


def render_html(text: Column) -> Column:
    """Transcript Markdown as HTML: escaped, headings, bold, italics, rules and paragraphs."""
    safe = text
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        safe = F.replace(safe, F.lit(raw), F.lit(entity))
    safe = F.regexp_replace(safe, r"(?m)^-{2,}$", "<hr>")
    safe = F.regexp_replace(safe, r"(?m)^## (.*)$", "<h2>$1</h2>")
    safe = F.regexp_replace(safe, r"(?m)^# (.*)$", "<h1>$1</h1>")
    safe = F.regexp_replace(safe, r"\*\*([^*\n]+)\*\*", "<b>$1</b>")
    safe = F.regexp_replace(safe, r"\*([^*\n]+)\*", "<i>$1</i>")
    blocks = F.filter(F.split(safe, r"\n\s*\n"), lambda b: F.trim(b) != "")
    return F.array_join(F.transform(blocks, lambda b: F.when(b.rlike("^<(h[12]|hr)>"), b).otherwise(F.concat(F.lit("<p>"), b, F.lit("</p>")))), "\n")


def tidy_plans(items: DataFrame, merges: DataFrame, corrections: DataFrame, item: str, headline: str, text: str, order: str) -> DataFrame:
    """Third-pass items: members of a merge become one, corrected headlines replace old ones, all others pass through.

    ``merges`` has ``item, plan``; ``corrections`` has ``item, new_headline``.  Text joins in order, ``sources``
    lists the items each plan came from.
    """
    to = merges.select(F.col("item").alias("_m"), "plan")
    fix = corrections.select(F.col("item").alias("_f"), "new_headline")
    x = items.join(to, items[item] == to["_m"], "left").join(fix, items[item] == fix["_f"], "left")
    x = x.withColumn("plan", F.coalesce("plan", item)).withColumn("_h", F.coalesce("new_headline", headline))
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(item).alias("i"), F.col("_h").alias("h"), F.coalesce(text, F.lit("")).alias("t"))))
    g = x.groupBy("plan").agg(parts.alias("p"))
    return g.select("plan", F.get("p", 0)["h"].alias("headline"), F.array_join(F.transform("p", lambda s: s["t"]), "\n").alias("full_text"), F.transform("p", lambda s: s["i"]).alias("sources"))


def continuations(columns: DataFrame, page: str, column: str, open_end: str, open_start: str) -> DataFrame:
    """Which column continues the item its left neighbour leaves open: ``continued_from``, NULL if none."""
    w = Window.partitionBy(page).orderBy(column)
    left = F.lag(F.when(F.col(open_end), F.col(column))).over(w)
    return columns.withColumn("continued_from", F.when(F.col(open_start), left))


def repair_tickets(rows: DataFrame, kind: str, refs: Sequence[str], reason: Column) -> DataFrame:
    """Open repair tickets with the target's key as JSON, its fields in alphabetical order."""
    return rows.where(reason.isNotNull()).select(F.lit(kind).alias("target_kind"), F.to_json(F.struct(*sorted(refs))).alias("target_ref"), reason.alias("description"), F.lit("open").alias("status"))


def versioned_name(existing: DataFrame, name: str) -> DataFrame:
    """The next free ``name.vN.bak`` of each file, from the names that exist."""
    stem, n = F.regexp_replace(name, r"\.v[0-9]+\.bak$", ""), F.expr(f"try_cast(nullif(regexp_extract({name}, '[.]v([0-9]+)[.]bak$', 1), '') as int)")
    return existing.groupBy(stem.alias("file")).agg((F.coalesce(F.max(n), F.lit(0)) + 1).alias("v")).select("file", F.concat("file", F.lit(".v"), F.col("v").cast("string"), F.lit(".bak")).alias("backup"))
