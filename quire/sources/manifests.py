"""Viewer documents as nested JSON: presentation manifests and the overlay of a tidying pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the presentation format.
CONTEXT = "http://iiif.io/api/presentation/3/context.json"
SVG_OPEN, SVG_CLOSE = '<svg xmlns="http://www.w3.org/2000/svg"><path d="', ' Z"/></svg>'


def svg_path(points: Column) -> Column:
    """An ``array<array<double>>`` of pixels as an SVG path: whole pixels, cut toward zero."""
    steps = F.transform(points, lambda p, i: F.concat_ws(" ", F.when(i == 0, "M").otherwise("L"), p[0].cast("int"), p[1].cast("int")))
    return F.concat(F.lit(SVG_OPEN), F.array_join(steps, " "), F.lit(SVG_CLOSE))


def _in_order(place: str, value: Column) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(place).alias("at"), value.alias("x")))), lambda s: s["x"])


def manifest(pages: DataFrame, issue: str, page: str, image: str, width: str, height: str, base: str) -> DataFrame:
    """One presentation manifest per issue with a canvas for each page that has an image and a size."""
    w, h = F.col(width), F.col(height)
    usable = pages.where(F.col(image).isNotNull() & (w > 0) & (h > 0))
    root = F.concat(F.lit(f"{base}/"), F.col(issue).cast("string"))
    canvas = F.concat(root, F.lit("/canvas/p"), F.col(page).cast("string"))
    label = lambda x: F.struct(F.array(x).alias("en"))
    body = F.struct(F.col(image).alias("id"), F.lit("Image").alias("type"), F.lit("image/png").alias("format"), w.alias("width"), h.alias("height"))
    painting = F.struct(F.concat(canvas, F.lit("/painting/1")).alias("id"), F.lit("Annotation").alias("type"), F.lit("painting").alias("motivation"), body.alias("body"), canvas.alias("target"))
    layer = F.struct(F.concat(canvas, F.lit("/painting")).alias("id"), F.lit("AnnotationPage").alias("type"), F.array(painting).alias("items"))
    one = F.struct(canvas.alias("id"), F.lit("Canvas").alias("type"), label(F.concat(F.lit("Page "), F.col(page).cast("string"))).alias("label"), w.alias("width"), h.alias("height"), F.array(layer).alias("items"))
    found = usable.groupBy(issue).agg(_in_order(page, one).alias("items"))
    whole = F.struct(F.lit(CONTEXT).alias("@context"), root.alias("id"), F.lit("Manifest").alias("type"), label(F.col(issue).cast("string")).alias("label"), F.col("items"))
    return found.select(issue, F.to_json(whole).alias("manifest"))


def superseded(items: DataFrame, key: str, derived_from: str) -> DataFrame:
    """The ids that some item was derived from."""
    return items.select(F.explode(derived_from).alias(key)).distinct()


def overlay(items: DataFrame, key: str, page: str, top: str, derived_from: str, target: Column) -> DataFrame:
    """One document per page: the items of the last pass and those of the pass before that it left alone."""
    alive = items.join(superseded(items, key, derived_from), key, "left_anti")
    tidied = F.coalesce(F.size(derived_from) > 0, F.lit(False))
    note = F.struct(F.col(key).alias("id"), F.when(tidied, 3).otherwise(2).alias("pass"), target.alias("target"))
    sorted_notes = F.transform(F.array_sort(F.collect_list(F.struct(F.col(top).alias("top"), F.col(key).alias("key"), note.alias("x")))), lambda s: s["x"])
    grouped = alive.groupBy(page).agg(sorted_notes.alias("items"))
    return grouped.select(page, F.to_json(F.struct(F.lit("AnnotationPage").alias("type"), F.col("items"))).alias("document"))
