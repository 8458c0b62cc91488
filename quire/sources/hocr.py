"""OCR output in hOCR as relations: documents are parsed once each, in Arrow batches."""

from __future__ import annotations

import math
import re
import statistics
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def blocks(pages: DataFrame, key: str, html: str, cls: str = "ocr_carea") -> DataFrame:
    """Blocks ``key, block, l, t, r, b, text, n_words, confidence`` of well-formed hOCR documents.

    A word belongs to each block of its document whose box holds its own; a document that is not well-formed is an error.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(html).alias("html")).where("html is not null")
    schema = f"key {dict(rows.dtypes)['key']}, block int, l double, t double, r double, b double, text string, n_words bigint, confidence double"
    types = [pa.int32(), *[pa.float64()] * 4, pa.string(), pa.int64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parse_blocks(x.as_py(), cls) for x in batch.column(1)]
            at = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            flat = list(zip(*(row for x in found for row in x), strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *(pa.array(c, k) for c, k in zip(flat, types, strict=True))], ["key", "block", "l", "t", "r", "b", "text", "n_words", "confidence"])

    return rows.mapInArrow(run, schema).withColumn("confidence", F.round("confidence", 2)).withColumnRenamed("key", key)


def parse_blocks(html: str, cls: str) -> list[tuple]:
    """Blocks of one document: number, box, text, number of words and their mean confidence."""
    words, titles, out = [], [], []
    for node in ET.fromstring(html).iter():
        kind = node.get("class")
        if kind == "ocrx_word":
            found = _properties(node.get("title"))
            box, mark = found.get("bbox", ()), found.get("x_wconf")
            if len(box) >= 4:
                words.append((*box[:4], node.text, mark[0] if mark else None))
        if kind == cls and node.get("title") is not None:
            titles.append(node.get("title"))
    for title in titles:
        l, t, r, b = box = (_properties(title).get("bbox", []) + [math.nan] * 4)[:4]
        held = [w for w in words if w[0] >= l and w[2] <= r and w[1] >= t and w[3] <= b]
        texts, marks = [w[4] for w in held if w[4] is not None], [w[5] for w in held if w[5] is not None]
        out.append((len(out), *(None if math.isnan(x) else x for x in box), " ".join(texts), len(texts), sum(marks) / len(marks) if marks else None))
    return out


def headings(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Tag counts of a web page that need no well-formedness: anchors, paragraphs, images and the title."""
    h = F.coalesce(F.col(html), F.lit(""))
    return pages.select(
        key, F.regexp_count(h, F.lit("<a ")).cast("bigint").alias("n_links"), F.regexp_count(h, F.lit("<p[ >]")).cast("bigint").alias("n_paragraphs"),
        F.regexp_count(h, F.lit("<img")).cast("bigint").alias("n_images"), F.regexp_extract(h, "<title>([^<]*)</title>", 1).alias("title"),
    )


#: Fixed classes of the format: lines of text, and regions without text.
LINES = ("ocr_line", "ocr_header", "ocr_caption", "ocr_textfloat")
REGIONS = ("ocr_separator", "ocr_photo")
_BOX = "left_pct:double,top_pct:double,right_pct:double,bottom_pct:double"
_DOCUMENT = (
    "page struct<width_px:int,height_px:int,scan_res_x:int,scan_res_y:int>, "
    f"blocks array<struct<block_idx:int,block_class:string,{_BOX},x_size_median:double,n_lines:int>>, "
    f"lines array<struct<block_idx:int,line_class:string,{_BOX},x_size:double,x_ascenders:double,x_descenders:double,baseline_slope:double,par_top_pct:double,n_words:int,text:string>>, "
    f"regions array<struct<region_class:string,orientation:string,{_BOX},width_px:int,height_px:int>>"
)


_KNOWN = frozenset(("bbox", "baseline", "scan_res", "x_size", "x_ascenders", "x_descenders", "x_wconf"))
_PROPERTIES = re.compile(rf"(?:^|[;\s])({'|'.join(sorted(_KNOWN))})((?:\s+-?[0-9.]+)+)")


def _properties(title: str | None) -> dict[str, list[float]]:
    """The numbers after each known property in a title, the first of several."""
    found: dict[str, list[float]] = {}
    for part in (title or "").split(";"):
        name, *numbers = part.split() or [""]
        if name in _KNOWN and numbers:
            try:
                found.setdefault(name, [float(x) for x in numbers])
                continue
            except ValueError:
                pass
        elif _KNOWN.isdisjoint(numbers):
            continue
        # A property amid other words: the slower way of the whole title.
        found = {}
        for name, digits in _PROPERTIES.findall(title):
            found.setdefault(name, [float(x) for x in digits.split()])
        break
    return found


def _one(found: dict[str, list[float]], name: str) -> float | None:
    return found[name][0] if name in found else None


def _box(found: dict[str, list[float]]) -> tuple[int, int, int, int]:
    return tuple(map(int, (found.get("bbox", []) + [0] * 4)[:4]))


def _percent(box: tuple[int, int, int, int], wide: int, high: int) -> tuple[float, float, float, float]:
    return round(box[0] / wide * 100.0, 2), round(box[1] / high * 100.0, 2), round(box[2] / wide * 100.0, 2), round(box[3] / high * 100.0, 2)


def parse_document(html: str | None) -> tuple[tuple | None, list[tuple] | None, list[tuple] | None, list[tuple] | None]:
    """Page, blocks, lines and regions of one document as rows of the schema; None if it is not well-formed or has no page.

    Blocks are numbered in document order; regions have no number.  Percentages have two decimals.
    """
    try:
        root = ET.fromstring(html or "")
    except ET.ParseError:
        return None, None, None, None
    sheet = next((n for n in root.iter() if n.get("class") == "ocr_page"), None)
    if sheet is None:
        return None, None, None, None
    of_sheet = _properties(sheet.get("title"))
    x0, y0, x1, y1 = _box(of_sheet)
    scan = (of_sheet.get("scan_res", []) + [None, None])[:2]
    wide, high = max(1, x1 - x0), max(1, y1 - y0)
    blocks, lines, regions = [], [], []
    for node in sheet:
        kind = node.get("class")
        if kind in REGIONS:
            box = _box(_properties(node.get("title")))
            w, h = box[2] - box[0], box[3] - box[1]
            shape = "vertical" if h >= 2 * w else "horizontal" if w >= 2 * h else "block"
            regions.append((kind, shape, *_percent(box, wide, high), w, h))
        elif kind == "ocr_carea":
            number, sizes, before = len(blocks), [], len(lines)
            for paragraph in node.iter():
                if paragraph.get("class") != "ocr_par":
                    continue
                top = _percent(_box(_properties(paragraph.get("title"))), wide, high)[1]
                for line in paragraph:
                    if line.get("class") not in LINES:
                        continue
                    found, words = _properties(line.get("title")), [(w.text or "").strip() for w in line.iter() if w.get("class") == "ocrx_word"]
                    size = _one(found, "x_size")
                    if size:
                        sizes.append(size)
                    lines.append((
                        number, line.get("class"), *_percent(_box(found), wide, high), size, _one(found, "x_ascenders"), _one(found, "x_descenders"),
                        _one(found, "baseline"), top, len(words), " ".join(t for t in words if t),
                    ))
            blocks.append((number, kind, *_percent(_box(_properties(node.get("title"))), wide, high), round(statistics.median(sizes), 2) if sizes else None, len(lines) - before))
    return (x1 - x0, y1 - y0, scan[0] and int(scan[0]), scan[1] and int(scan[1])), blocks, lines, regions


def _structs(rows: list[tuple | None], kind: pa.StructType) -> pa.StructArray:
    """Tuples as structs, column by column; None is a NULL."""
    empty = (None,) * kind.num_fields
    columns = list(zip(*(r or empty for r in rows), strict=True)) or [()] * kind.num_fields
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], fields=list(kind), mask=pa.array([r is None for r in rows], pa.bool_()))


def _lists(rows: list[list[tuple] | None], kind: pa.ListType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r or ()) for r in rows])]).astype(np.int32)
    places = pa.array(offsets, pa.int32(), mask=np.array([*(r is None for r in rows), False]))
    return pa.ListArray.from_arrays(places, _structs([x for r in rows for x in r or ()], kind.value_type), type=kind)


def documents(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Rows ``key, page, blocks, lines, regions``, one per document; NULLs for a document that can't be read."""
    rows = pages.select(F.col(key).alias("key"), F.col(html).alias("html"))
    schema = f"key {dict(rows.dtypes)['key']}, {_DOCUMENT}"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, *lists = (list(x) for x in zip(*(parse_document(x.as_py()) for x in batch.column(1)), strict=True)) if len(batch) else ([], [], [], [])
            columns = [_structs(page, kinds.field(1).type), *(_lists(x, kinds.field(k + 2).type) for k, x in enumerate(lists))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=kinds)

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def relation(found: DataFrame, key: str, name: str) -> DataFrame:
    """One of the relations ``blocks``, ``lines`` and ``regions``, or the ``page``, of parsed documents."""
    return found.select(key, "page.*").where("width_px is not null") if name == "page" else found.select(key, F.inline(name))
