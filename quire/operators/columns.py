"""Scalar geometry and predicates as column expressions.

Boxes are percent-of-page rectangles with their origin at the top left: left, top, right, bottom.  Every
function takes and returns columns, so all of it stays inside generated code.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    left: Column
    top: Column
    right: Column
    bottom: Column

    @staticmethod
    def of(prefix: str = "", names: tuple[str, str, str, str] = ("l", "t", "r", "b")) -> Box:
        return Box(*(F.col(prefix + n) for n in names))


def to_pixels(percent: Column, extent: Column) -> Column:
    """Nearest pixel, halves to even."""
    return F.bround(percent / 100 * extent).cast("bigint")


def to_percent(pixels: Column, extent: Column) -> Column:
    """Two decimals; NULL where the extent is zero."""
    return F.round(F.try_divide(pixels.cast("double"), extent) * 100, 2)


def clamp(x: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def to_points(value: Column, unit: Column, extent: Column, dpi: float) -> Column:
    """Lengths in percent of an extent, pixels, points or inches become points; an unknown unit is NULL."""
    return (
        F.when(unit == "pct", value / 100 * extent).when(unit == "px", value * 72 / dpi)
        .when(unit == "pt", value).when(unit == "in", value * 72)
    )


def overlap(a_low: Column, a_high: Column, b_low: Column, b_high: Column) -> Column:
    """Length two intervals share."""
    return F.greatest(F.lit(0.0), F.least(a_high, b_high) - F.greatest(a_low, b_low))


def overlap_share(a_low: Column, a_high: Column, b_low: Column, b_high: Column) -> Column:
    """Share of the first interval that the second covers; zero for an empty interval."""
    return F.when(a_high > a_low, overlap(a_low, a_high, b_low, b_high) / (a_high - a_low)).otherwise(F.lit(0.0))


def area(a: Box) -> Column:
    return F.greatest(F.lit(0.0), a.right - a.left) * F.greatest(F.lit(0.0), a.bottom - a.top)


def shared_area(a: Box, b: Box) -> Column:
    return overlap(a.left, a.right, b.left, b.right) * overlap(a.top, a.bottom, b.top, b.bottom)


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; zero if the union is empty."""
    both = shared_area(a, b)
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def hull(a: Box, b: Box) -> Box:
    return Box(F.least(a.left, b.left), F.least(a.top, b.top), F.greatest(a.right, b.right), F.greatest(a.bottom, b.bottom))


def intersects(a: Box, b: Box, eps: float = 0.05) -> Column:
    """The interiors meet by more than ``eps``."""
    return (a.left < b.right - eps) & (b.left < a.right - eps) & (a.top < b.bottom - eps) & (b.top < a.bottom - eps)


def contains(outer: Box, inner: Box, slack: float = 0.0) -> Column:
    return (inner.left >= outer.left - slack) & (inner.top >= outer.top - slack) & (inner.right <= outer.right + slack) & (inner.bottom <= outer.bottom + slack)


def centre_inside(outer: Box, inner: Box) -> Column:
    return ((inner.left + inner.right) / 2).between(outer.left, outer.right) & ((inner.top + inner.bottom) / 2).between(outer.top, outer.bottom)


def orientation(a: Box, ratio: float = 2.0) -> Column:
    """vertical, horizontal or block by aspect."""
    w, h = a.right - a.left, a.bottom - a.top
    return F.when(h >= ratio * w, "vertical").when(w >= ratio * h, "horizontal").otherwise("block")


def flush_edges(container: Box, inset: Box, eps: float = 0.5) -> Column:
    """Names of the container's edges that the inset touches, in the order bottom, left, right, top."""
    near = (("bottom", 3), ("left", 0), ("right", 2), ("top", 1))
    return F.array_compact(F.array(*(F.when(F.abs(container[k] - inset[k]) <= eps, F.lit(n)) for n, k in near)))


def remainder_polygon(container: Box, inset: Box, eps: float = 0.5) -> Column:
    """The container without the inset as a closed rectilinear polygon of ``[x, y]`` points.

    Three flush edges leave a rectangle, two adjacent ones an L and a single one a U.  An inset that touches
    no edge would leave a hole, one that touches two opposite edges would split the container and one that
    covers it would leave nothing: all NULL (see :func:`remainder_refusal`).
    """
    c, i = container, inset
    on = {n: F.abs(c[k] - i[k]) <= eps for n, k in (("l", 0), ("t", 1), ("r", 2), ("b", 3))}

    def shape(*points: tuple[Column, Column]) -> Column:
        closed = [*points, points[0]]
        return F.array(*(F.array(x.cast("double"), y.cast("double")) for x, y in closed))

    def flush(edges: str) -> Column:
        out = F.lit(True)
        for n, hit in on.items():
            out = out & (hit if n in edges else ~hit)
        return out

    cases = {
        "ltr": shape((c.left, i.bottom), (c.right, i.bottom), (c.right, c.bottom), (c.left, c.bottom)),
        "lbr": shape((c.left, c.top), (c.right, c.top), (c.right, i.top), (c.left, i.top)),
        "ltb": shape((i.right, c.top), (c.right, c.top), (c.right, c.bottom), (i.right, c.bottom)),
        "rtb": shape((c.left, c.top), (i.left, c.top), (i.left, c.bottom), (c.left, c.bottom)),
        "lt": shape((i.right, c.top), (c.right, c.top), (c.right, c.bottom), (c.left, c.bottom), (c.left, i.bottom), (i.right, i.bottom)),
        "rt": shape((c.left, c.top), (i.left, c.top), (i.left, i.bottom), (c.right, i.bottom), (c.right, c.bottom), (c.left, c.bottom)),
        "lb": shape((c.left, c.top), (c.right, c.top), (c.right, c.bottom), (i.right, c.bottom), (i.right, i.top), (c.left, i.top)),
        "rb": shape((c.left, c.top), (c.right, c.top), (c.right, i.top), (i.left, i.top), (i.left, c.bottom), (c.left, c.bottom)),
        "l": shape((c.left, c.top), (c.right, c.top), (c.right, c.bottom), (c.left, c.bottom), (c.left, i.bottom), (i.right, i.bottom), (i.right, i.top), (c.left, i.top)),
        "r": shape((c.left, c.top), (c.right, c.top), (c.right, i.top), (i.left, i.top), (i.left, i.bottom), (c.right, i.bottom), (c.right, c.bottom), (c.left, c.bottom)),
        "t": shape((c.left, c.top), (i.left, c.top), (i.left, i.bottom), (i.right, i.bottom), (i.right, c.top), (c.right, c.top), (c.right, c.bottom), (c.left, c.bottom)),
        "b": shape((c.left, c.top), (c.right, c.top), (c.right, c.bottom), (i.right, c.bottom), (i.right, i.top), (i.left, i.top), (i.left, c.bottom), (c.left, c.bottom)),
    }
    out = None
    for edges, polygon in cases.items():
        out = F.when(flush(edges), polygon) if out is None else out.when(flush(edges), polygon)
    return out


def remainder_refusal(container: Box, inset: Box, eps: float = 0.5) -> Column:
    """Why there is no remainder polygon: covers, hole or split; NULL if there is one."""
    n = F.size(flush_edges(container, inset, eps))
    sides = F.array_contains(flush_edges(container, inset, eps), "left") & F.array_contains(flush_edges(container, inset, eps), "right")
    ends = F.array_contains(flush_edges(container, inset, eps), "top") & F.array_contains(flush_edges(container, inset, eps), "bottom")
    return F.when(n == 4, "covers").when(n == 0, "hole").when((n == 2) & (sides | ends), "split")


def svg_path(polygon: Column, width: Column, height: Column) -> Column:
    """``M x y L x y ... Z`` in whole pixels from percent vertices."""
    def point(p: Column) -> Column:
        return F.concat_ws(" ", to_pixels(F.get(p, 0), width), to_pixels(F.get(p, 1), height))

    return F.concat(F.lit("M "), F.array_join(F.transform(polygon, point), " L "), F.lit(" Z"))


def media_fragment(a: Box, width: Column, height: Column) -> Column:
    """``xywh=`` of a percent box in whole pixels, at least one pixel wide and high."""
    x, y = to_pixels(a.left, width), to_pixels(a.top, height)
    w, h = F.greatest(F.lit(1), to_pixels(a.right, width) - x), F.greatest(F.lit(1), to_pixels(a.bottom, height) - y)
    return F.concat(F.lit("xywh="), F.concat_ws(",", x, y, w, h))


def route(year: Column, cutoff: int = 1980) -> Column:
    """Early volumes go by columns, later ones by page."""
    return F.when(year < cutoff, "columns").otherwise("pages")


def binding_side(page: Column) -> Column:
    """Odd pages are rectos, bound on the left."""
    return F.when(page % 2 == 1, "left").otherwise("right")


def rule_class(width: Column, column_width: Column, full: float = 0.85) -> Column:
    return F.when(width >= full * column_width, "full").otherwise("narrow")


def failure_status(failures: Column, limit: int = 2) -> Column:
    return F.when(failures >= limit, "damaged").otherwise("failed")


def ascending(values: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """At least two strictly ascending values inside the bounds."""
    steps = F.zip_with(F.slice(values, 1, F.size(values) - 1), F.slice(values, 2, F.size(values) - 1), lambda a, b: a < b)
    return (F.size(values) >= 2) & F.forall(values, lambda v: v.between(low, high)) & F.forall(steps, lambda ok: ok)


def widths(values: Column) -> Column:
    """Differences of adjacent boundaries."""
    return F.when(F.size(values) < 2, F.array().cast("array<double>")).otherwise(
        F.zip_with(F.slice(values, 1, F.size(values) - 1), F.slice(values, 2, F.size(values) - 1), lambda a, b: F.round(b - a, 4))
    )


def move_boundary(values: Column, index: Column, to: Column) -> Column:
    return F.transform(values, lambda v, i: F.when(i == index, to).otherwise(v))


def add_boundary(values: Column, at: Column, gap: float = 0.05) -> Column:
    """Insert in order; unchanged if a boundary is closer than ``gap``."""
    taken = F.exists(values, lambda v: F.abs(v - at) < gap)
    return F.when(taken, values).otherwise(F.array_sort(F.array_append(values, at)))


def delete_boundary(values: Column, index: Column) -> Column:
    """Drop one boundary; unchanged if fewer than two would remain."""
    return F.when(F.size(values) <= 2, values).otherwise(F.filter(values, lambda v, i: i != index))


def columns_touched(values: Column, low: Column, high: Column, share: float = 0.5) -> Column:
    """How many columns between boundaries an interval covers by ``share`` or more, at least one."""
    lefts = F.slice(values, 1, F.size(values) - 1)
    spans = F.zip_with(lefts, F.slice(values, 2, F.size(values) - 1), lambda a, b: overlap_share(a, b, low, high))
    return F.greatest(F.lit(1), F.size(F.filter(spans, lambda s: s >= share)))


def column_extent(values: Column, index: Column) -> Column:
    """``struct<left, right>`` of a column; NULL ends outside the boundaries."""
    return F.struct(F.get(values, index).alias("left"), F.get(values, index + 1).alias("right"))


def interpolate(offset: Column, start: Column, end: Column, low: Column, high: Column) -> Column:
    """Linear position of an offset in ``[start, end]``, clamped past both ends."""
    share = F.when(end > start, (offset - start) / (end - start)).otherwise(F.lit(0.0))
    return low + F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * (high - low)
