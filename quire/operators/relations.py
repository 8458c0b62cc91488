"""Relational operators over keyed tables: versions, pairs, islands, calendars, histograms, box joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import Box, centre_inside, iou, overlap_share, shared_area


#: Most rows of a part that :func:`by_page` deals out, on average, and how few are worth a part.
PART_ROWS, LEAST_ROWS = 250_000, 20_000
#: The same for light work, once there would be more parts than a task can write without sorting its rows in memory.
LIGHT_ROWS = 1_250_000


def by_page(df: DataFrame, page: str, light: bool = False) -> DataFrame:
    """Rows dealt out by page into parts whose number grows with the rows, so that no task grows with the table.

    Grouping, windows and joins on the page, alone or with other columns, need no further exchange.  Shuffles of a fixed
    number of parts grow with the table instead, and partial sums of keys that seldom repeat only fill memory.
    A task that writes more than ``spark.shuffle.sort.bypassMergeThreshold`` parts sorts the rows of its input split in
    memory; ``light`` work, which needs little memory a row, takes larger parts first.
    """
    rows, usual = df.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(usual, -(-rows // PART_ROWS))
    if light:
        parts = min(parts, max(int(df.sparkSession.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200")), -(-rows // LIGHT_ROWS)))
    return df.repartition(max(1, min(-(-rows // LEAST_ROWS), parts)), page)


def latest_all(df: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """All rows whose ``at`` is their key's maximum: ties survive."""
    return df.withColumn("_r", F.rank().over(Window.partitionBy(*keys).orderBy(F.col(at).desc_nulls_last()))).where("_r = 1").drop("_r")


def latest_one(df: DataFrame, keys: Sequence[str], at: str, tie: str) -> DataFrame:
    """One row per key: the latest, then the smallest ``tie``."""
    order = Window.partitionBy(*keys).orderBy(F.col(at).desc_nulls_last(), F.col(tie))
    return df.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def chunk_number(df: DataFrame, keys: Sequence[str], order: Sequence[Column], size: int, out: str = "chunk") -> DataFrame:
    """Number consecutive rows of each key in chunks of ``size``."""
    return df.withColumn(out, F.floor((F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1) / size))


def islands(df: DataFrame, keys: Sequence[str], value: str, gap: float, tie: str, out: str = "island") -> DataFrame:
    """Chained clustering in one dimension: a new island starts where the step from the previous member exceeds ``gap``."""
    order = Window.partitionBy(*keys).orderBy(value, tie)
    jump = F.when(F.col(value) - F.lag(value).over(order) > gap, 1).otherwise(0)
    return df.withColumn("_j", jump).withColumn(out, F.sum("_j").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_j")


def runs_of_true(df: DataFrame, keys: Sequence[str], position: str, flag: str, out: str = "run") -> DataFrame:
    """Rows where ``flag`` holds, with the number of their unbroken run."""
    order = Window.partitionBy(*keys).orderBy(position)
    numbered = df.withColumn("_all", F.row_number().over(order)).where(F.col(flag)).withColumn("_true", F.row_number().over(order))
    return numbered.withColumn("_base", F.col("_all") - F.col("_true")).withColumn(out, F.dense_rank().over(Window.partitionBy(*keys).orderBy("_base"))).drop("_all", "_true", "_base")


def absent_pairs(pairs: DataFrame, seen: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs that ``seen`` holds in neither order."""
    left = pairs.withColumn("_lo", F.least(a, b)).withColumn("_hi", F.greatest(a, b))
    right = seen.select(F.least(a, b).alias("_lo"), F.greatest(a, b).alias("_hi")).distinct()
    return left.join(right, ["_lo", "_hi"], "left_anti").drop("_lo", "_hi")


def mode_by_first_seen(df: DataFrame, keys: Sequence[str], value: str, seq: str) -> DataFrame:
    """Each key's most frequent value; of equal counts the one seen first."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(seq).alias("first"))
    return top_per_key(counts, keys, [F.desc("n"), F.asc("first")], 1).drop("first")


def elementwise_mean(df: DataFrame, keys: Sequence[str], array: str, digits: int = 4) -> DataFrame:
    """Mean of arrays position by position, as an array."""
    cells = df.select(*keys, F.posexplode(array).alias("pos", "x"))
    means = cells.groupBy(*keys, "pos").agg(F.round(F.avg("x"), digits).alias("m"))
    return means.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("mean"))


def histogram(df: DataFrame, keys: Sequence[str], value: str, width: float, bins: int) -> DataFrame:
    """Counts in ``bins`` fixed-width bins, the last open-ended, empty bins included."""
    own = df.where(F.col(value).isNotNull()).groupBy(*keys, F.least(F.floor(F.col(value) / width), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    domain = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    domain = domain.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return domain.join(own, [*keys, "bin"], "left").select(*keys, "bin", F.coalesce("n", F.lit(0)).alias("n"))


def calendar(df: DataFrame, day: str, value: Column, out: str) -> DataFrame:
    """One row per day from first to last, missing days with zero."""
    days = df.groupBy(F.col(day).alias("day")).agg(value.alias(out))
    span = days.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a is not null").select(F.explode(F.expr("sequence(a, b, interval 1 day)")).alias("day"))
    return span.join(days, "day", "left").select("day", F.coalesce(out, F.lit(0)).alias(out))


def fastest_slowest(df: DataFrame, keys: Sequence[str], value: str, tie: str, k: int = 10) -> DataFrame:
    """Count, mean, and the means of the k smallest and k largest values of each key."""
    up = F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc(value), F.asc(tie)))
    down = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(value), F.asc(tie)))
    ranked = df.where(F.col(value).isNotNull()).withColumn("_u", up).withColumn("_d", down)
    return ranked.groupBy(*keys).agg(
        F.count("*").alias("n"), F.round(F.avg(value), 4).alias("mean"),
        F.round(F.avg(F.when(F.col("_u") <= k, F.col(value))), 4).alias("fastest"),
        F.round(F.avg(F.when(F.col("_d") <= k, F.col(value))), 4).alias("slowest"),
    )


def exact_median(value: str, decimals: int = 2) -> Column:
    """The median of numbers with that many decimals, rounded half up: computed on whole numbers."""
    whole = F.round(F.col(value) * 10**decimals).cast("bigint")
    return F.floor(F.median(whole) + 0.5) / 10**decimals


def weighted_clusters(df: DataFrame, keys: Sequence[str], value: str, weight: str, source: str, gap: float, tie: str) -> DataFrame:
    """Islands summed up: weighted mean position, total weight, members, distinct sources and drift.

    Values and weights count to four decimals.  The mean is a quotient of whole numbers, so halves round up
    whatever the order of the rows.
    """
    found = islands(df, keys, value, gap, tie)
    w, x = (F.round(F.col(c) * 10_000).cast("decimal(19,0)") for c in (weight, value))
    sums = found.withColumn("_w", w).withColumn("_x", x).groupBy(*keys, "island").agg(
        F.sum(F.col("_w") * F.col("_x")).alias("_sum"), F.sum("_w").alias("_all"), F.count("*").alias("members"), F.countDistinct(source).alias("support"), (F.max("_x") - F.min("_x")).alias("_drift"),
    )
    position = F.expr("sign(_sum) * ((2 * abs(_sum) + _all) div (2 * _all)) / 10000")
    return sums.select(*keys, "island", position.cast("double").alias("position"), (F.col("_all").cast("double") / 10_000).alias("weight"), "members", "support", (F.col("_drift").cast("double") / 10_000).alias("drift"))


def peaks(df: DataFrame, keys: Sequence[str], value: str, weight: str, width: float, share: float, tie: str) -> DataFrame:
    """Histogram peaks: bins with at least ``share`` of their key's weight, touching bins merged; the position is the exact median."""
    rows = df.withColumn("_bin", F.floor(F.col(value) / width))
    bins = rows.groupBy(*keys, "_bin").agg(F.sum(weight).alias("_w"))
    solid = bins.withColumn("_all", F.sum("_w").over(Window.partitionBy(*keys))).where(F.col("_w") >= share * F.col("_all"))
    merged = islands(solid, keys, "_bin", 1, "_bin").select(*keys, "_bin", "island")
    return rows.join(merged, [*keys, "_bin"]).groupBy(*keys, "island").agg(F.round(F.sum(weight), 4).alias("weight"), F.round(F.median(value), 4).alias("position"), F.count("*").alias("members"))


def coverage(df: DataFrame, keys: Sequence[str], low: str, high: str, bin_width: float) -> DataFrame:
    """How many intervals touch each bin; those that lack an end, or end in a bin before their first, touch none.

    First bins and ends are counted up and down in order, two rows an interval; bins are listed last, so no table of them is held.
    """
    first, last = F.floor(F.col(low) / bin_width), F.floor(F.col(high) / bin_width)
    steps = df.where(last >= first).select(*keys, F.stack(F.lit(2), first, F.lit(1), last + 1, F.lit(-1)).alias("_at", "_step"))
    order = Window.partitionBy(*keys).orderBy("_at")
    runs = steps.select(*keys, "_at", F.sum("_step").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("n"), F.lead("_at").over(order).alias("_next"))
    return runs.where("n > 0 and _next > _at").select(*keys, F.explode(F.sequence("_at", F.col("_next") - 1)).alias("bin"), "n")


def uncovered_gaps(df: DataFrame, keys: Sequence[str], low: str, high: str) -> DataFrame:
    """Maximal gaps between the merged intervals of each key: ``gap_low, gap_high``."""
    order = Window.partitionBy(*keys).orderBy(low, high)
    reach = F.max(high).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_reach", reach).where(F.col(low) > F.col("_reach")).select(*keys, F.col("_reach").alias("gap_low"), F.col(low).alias("gap_high"))


def merged_intervals(df: DataFrame, keys: Sequence[str], low: str, high: str) -> DataFrame:
    """The union of each key's intervals as disjoint intervals; touching ones merge."""
    order = Window.partitionBy(*keys).orderBy(low, high)
    reach = F.max(high).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_new", F.when(F.col(low) > reach, 1).otherwise(0)).withColumn("_g", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_g").agg(F.min(low).alias(low), F.max(high).alias(high)).drop("_g")


def box_pairs(a: DataFrame, b: DataFrame, key: str, condition: Column, how: str = "inner") -> DataFrame:
    """Theta join inside a page: the key is an equi-join, so the planner hashes pages and tests geometry per page."""
    return a.alias("a").join(b.alias("b"), (F.col(f"a.{key}") == F.col(f"b.{key}")) & condition, how)


def best_match(a: DataFrame, b: DataFrame, key: str, id_a: str, id_b: str, least: float = 0.0) -> DataFrame:
    """For each box of ``a`` the box of ``b`` with the highest IoU above ``least``; NULL without one."""
    x, y = Box.of("a."), Box.of("b.")
    scored = box_pairs(a, b, key, iou(x, y) > least).select(F.col(f"a.{id_a}").alias("_id"), F.col(f"b.{id_b}").alias("match"), iou(x, y).alias("score"))
    best = scored.groupBy("_id").agg(F.max(F.struct("score", (-F.col("match")).alias("m"))).alias("s")).select("_id", (-F.col("s.m")).alias("match"), F.round("s.score", 4).alias("score"))
    return a.join(best, a[id_a] == best["_id"], "left").drop("_id")


def points_in_boxes(boxes: DataFrame, points: DataFrame, key: str, id_box: str) -> DataFrame:
    """Per box the number of items whose centre lies inside, zero included."""
    a, b = Box.of("a."), Box.of("b.")
    hits = box_pairs(boxes, points, key, centre_inside(a, b) & (F.col(f"a.{id_box}") != F.col(f"b.{id_box}"))).groupBy(F.col(f"a.{id_box}").alias("_id")).agg(F.count("*").alias("n"))
    return boxes.join(hits, boxes[id_box] == hits["_id"], "left").select(*boxes.columns, F.coalesce("n", F.lit(0)).alias("n_inside"))


def column_cover(boxes: DataFrame, columns: DataFrame, key: str, share: float = 0.5) -> DataFrame:
    """Box and column pairs where the box covers ``share`` of the column's width."""
    return box_pairs(boxes, columns, key, overlap_share(F.col("b.l"), F.col("b.r"), F.col("a.l"), F.col("a.r")) >= share)


def body_text_false_positives(ads: DataFrame, text: DataFrame, key: str, id_ad: str) -> DataFrame:
    """Ads more than half covered by text regions from two columns or more."""
    a, b = Box.of("a."), Box.of("b.")
    pairs = box_pairs(ads, text, key, shared_area(a, b) > 0)
    from .columns import area
    sums = pairs.groupBy(F.col(f"a.{id_ad}").alias(id_ad)).agg(F.sum(shared_area(a, b)).alias("_s"), F.first(area(a)).alias("_a"), F.countDistinct("b.col").alias("n_columns"))
    return sums.where((F.col("_s") > 0.5 * F.col("_a")) & (F.col("n_columns") >= 2)).select(id_ad, F.round(F.col("_s") / F.col("_a"), 4).alias("cover"), "n_columns")


def nearest(left: DataFrame, right: DataFrame, key: str, x: str, y: str, limit: float, id_left: str) -> DataFrame:
    """For each left row the nearest right value of the same key within ``limit``, the lower on a tie; NULL if none."""
    a, b = left.alias("a"), right.select(key, y).alias("b")
    close = a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.abs(F.col(f"a.{x}") - F.col(f"b.{y}")) <= limit))
    best = close.groupBy(F.col(f"a.{id_left}").alias("_id")).agg(F.min(F.struct(F.abs(F.col(f"a.{x}") - F.col(f"b.{y}")).alias("d"), F.col(f"b.{y}").alias("v")))["v"].alias("nearest"))
    return left.join(best, left[id_left] == best["_id"], "left").drop("_id")


def next_below(left: DataFrame, right: DataFrame, key: str, x: str, y: str, id_left: str, default: float) -> DataFrame:
    """For each left row the smallest right value above its own (an as-of join forward), else ``default``.

    One union and one window instead of a theta join: rows of both sides are sorted together by value.
    """
    both = left.select(key, F.col(x).alias("_v"), F.lit(1).alias("_side"), F.col(id_left).alias("_id")).union(
        right.select(key, F.col(y).alias("_v"), F.lit(0).alias("_side"), F.lit(None).cast(dict(left.dtypes)[id_left]))
    )
    order = Window.partitionBy(key).orderBy(F.col("_v").desc(), F.col("_side").desc()).rowsBetween(Window.unboundedPreceding, -1)
    seen = both.withColumn("_next", F.last(F.when(F.col("_side") == 0, F.col("_v")), ignorenulls=True).over(order)).where("_side = 1")
    return left.join(seen.select("_id", "_next"), left[id_left] == F.col("_id"), "left").select(*left.columns, F.coalesce("_next", F.lit(default)).alias("next"))
