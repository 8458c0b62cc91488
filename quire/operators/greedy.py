"""Order-dependent geometry, one page at a time.

These passes decide each box in the light of earlier decisions, so they run page by page.  Rows are dealt
out and sorted by page and then stream through Arrow batches, many pages to a batch; only the page at a
batch's end is held over, and a page is bounded by what is printed on it.  Inside a page rows are sorted by
a total order first, so results do not depend on row order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

_BOX = ["l", "t", "r", "b"]


def _whole_pages(df: DataFrame, page: str, f: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply ``f`` to frames that hold many pages, each of them complete."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            keys = batch[page].to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            if held and keys[0] != held[-1][page].iloc[-1]:
                yield f(pd.concat(held, ignore_index=True))
                held = []
            if len(cuts):
                yield f(pd.concat([*held, batch.iloc[: cuts[-1]]], ignore_index=True))
                held = [batch.iloc[cuts[-1] :]]
            else:
                held.append(batch)
        if held:
            yield f(pd.concat(held, ignore_index=True))

    return df.where(df[page].isNotNull()).repartition(page).sortWithinPartitions(page).mapInPandas(run, schema)


def arrow_pages(df: DataFrame, page: str, f: Callable[[np.ndarray, pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Like :func:`_whole_pages` with Arrow tables: ``f`` gets where each page begins, and the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            keys = table.column(page).to_numpy()
            yield from f(np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]), table)

        for batch in batches:
            if not len(batch):
                continue
            keys = batch.column(batch.schema.get_field_index(page)).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            if held and keys[0] != held[-1].column(held[-1].schema.get_field_index(page))[-1].as_py():
                yield from done()
                held = []
            if len(cuts):
                held.append(batch.slice(0, cuts[-1]))
                yield from done()
                held = [batch.slice(cuts[-1])]
            else:
                held.append(batch)
        if held:
            yield from done()

    return df.where(df[page].isNotNull()).repartition(page).sortWithinPartitions(page).mapInArrow(run, schema)


def _sorted(g: pd.DataFrame, page: str, *order: np.ndarray) -> tuple[pd.DataFrame, list[slice]]:
    """The frame sorted by page, then by the given keys, and where each page lies in it."""
    g = g.iloc[np.lexsort((*reversed(order), g[page].to_numpy()))].reset_index(drop=True)
    keys = g[page].to_numpy()
    cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    return g, [slice(x, y) for x, y in zip(cuts, cuts[1:], strict=False) if y > x]


def _per_page(df: DataFrame, page: str, f: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply ``f`` to the frame of each page."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g, pages = _sorted(g, page)
        return pd.concat([f(g.iloc[at].reset_index(drop=True)) for at in pages], ignore_index=True)

    return _whole_pages(df, page, run, schema)


def _area(b: np.ndarray) -> np.ndarray:
    return np.maximum(0, b[..., 2] - b[..., 0]) * np.maximum(0, b[..., 3] - b[..., 1])


def _meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    w = np.minimum(a[..., 2], b[..., 2]) - np.maximum(a[..., 0], b[..., 0])
    h = np.minimum(a[..., 3], b[..., 3]) - np.maximum(a[..., 1], b[..., 1])
    return np.maximum(0, w) * np.maximum(0, h)


def drop_contained(boxes: DataFrame, page: str, key: str, share: float = 0.8) -> DataFrame:
    """Largest first, keep a box unless more than ``share`` of it lies in one kept before."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g, pages = _sorted(g, page, -_area(g[_BOX].to_numpy(float)), g[key].to_numpy())
        b = g[_BOX].to_numpy(float)
        size, stays = _area(b), np.ones(len(b), dtype=bool)
        for at in pages:
            for i in range(at.start + 1, at.stop):
                before = slice(at.start, i)
                stays[i] = size[i] <= 0 or not (stays[before] & (_meet(b[i], b[before]) > share * size[i])).any()
        return g[stays]

    return _whole_pages(boxes, page, run, boxes.schema)


def suppress(boxes: DataFrame, page: str, key: str, score: str, iou: float = 0.3) -> DataFrame:
    """Non-maximum suppression: best score first, keep a box unless its IoU with a kept one exceeds ``iou``."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g, pages = _sorted(g, page, -g[score].to_numpy(), g[key].to_numpy())
        b = g[_BOX].to_numpy(float)
        size, stays = _area(b), np.ones(len(b), dtype=bool)
        for at in pages:
            for i in range(at.start + 1, at.stop):
                before = slice(at.start, i)
                both = _meet(b[i], b[before])
                stays[i] = not (stays[before] & (both > iou * (size[i] + size[before] - both)) & (both > 0)).any()
        return g[stays]

    return _whole_pages(boxes, page, run, boxes.schema)


def absorb(boxes: DataFrame, page: str, key: str, tolerance: float = 0.5) -> DataFrame:
    """Give each box contained in a larger one that one's key as ``into``; NULL for survivors."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g, pages = _sorted(g, page, -_area(g[_BOX].to_numpy(float)), g[key].to_numpy())
        b, keys, into = g[_BOX].to_numpy(float), g[key].to_numpy(), np.full(len(g), -1)
        for at in pages:
            for i in range(at.start + 1, at.stop):
                before = slice(at.start, i)
                holds = (b[i, :2] >= b[before, :2] - tolerance).all(1) & (b[i, 2:] <= b[before, 2:] + tolerance).all(1) & (into[before] < 0)
                if holds.any():
                    into[i] = at.start + holds.argmax()
        return g.assign(into=pd.array(np.where(into >= 0, keys[into], 0), dtype="Int64")).assign(into=lambda x: x["into"].mask(into < 0))

    return _whole_pages(boxes, page, run, f"{_ddl(boxes)}, into bigint")


def clip_overlaps(boxes: DataFrame, page: str, key: str) -> DataFrame:
    """From the top down, end each box where the next one that shares its width begins."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g, pages = _sorted(g, page, g["t"].to_numpy(), g["l"].to_numpy(), g[key].to_numpy())
        b = g[_BOX].to_numpy(float)
        for at in pages:
            for i in range(at.start, at.stop - 1):
                below = b[i + 1 : at.stop]
                cuts = (below[:, 1] > b[i, 1]) & (below[:, 1] < b[i, 3]) & (np.minimum(b[i, 2], below[:, 2]) > np.maximum(b[i, 0], below[:, 0]))
                if cuts.any():
                    b[i, 3] = below[cuts.argmax(), 1]
        return g.assign(b=b[:, 3])

    return _whole_pages(boxes, page, run, boxes.schema)


def merge_fragments(rules: DataFrame, page: str, key: str, across: float = 0.5, along: float = 2.0) -> DataFrame:
    """Join horizontal rules that lie on one line with gaps of at most ``along``: ``key`` of the first, extents, count."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g, pages = _sorted(g, page, g["l"].to_numpy(), g["t"].to_numpy(), g[key].to_numpy())
        b, keys, names, out = g[_BOX].to_numpy(float), g[key].to_numpy(), g[page].to_numpy(), []
        for at in pages:
            made: list[list] = []
            for i in range(at.start, at.stop):
                left, top, right, bottom = b[i].tolist()
                for m in made:
                    if abs(m[3] - top) <= across and left <= m[4] + along:
                        m[4], m[5], m[6] = max(m[4], right), max(m[5], bottom), m[6] + 1
                        break
                else:
                    made.append([names[i], keys[i], left, top, right, bottom, 1])
            out += made
        return pd.DataFrame(out, columns=[page, key, *_BOX, "n"])

    kinds = dict(rules.dtypes)
    return _whole_pages(rules, page, run, f"{page} {kinds[page]}, {key} {kinds[key]}, l double, t double, r double, b double, n bigint")


def resolve_crossings(boxes: DataFrame, page: str, key: str, score: str) -> DataFrame:
    """While boxes cross (meet without containment), drop the one with most crossings, lowest score, smallest area, highest key."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g, pages = _sorted(g, page, g[key].to_numpy())
        b, scores, alive = g[_BOX].to_numpy(float), g[score].to_numpy(), np.ones(len(g), dtype=bool)
        size = _area(b)
        for at in pages:
            x, live = b[at], alive[at]
            inside = (x[:, None, :2] >= x[None, :, :2]).all(2) & (x[:, None, 2:] <= x[None, :, 2:]).all(2)
            cross = (_meet(x[:, None], x[None]) > 0) & ~inside & ~inside.T
            while (n := (cross & live[None]).sum(1) * live).max(initial=0) > 0:
                live[min(np.flatnonzero(n == n.max()), key=lambda i: (scores[at][i], size[at][i], -i))] = False
        return g[alive]

    return _whole_pages(boxes, page, run, boxes.schema)


def seed_groups(boxes: DataFrame, page: str, key: str, gap: float = 3.0) -> DataFrame:
    """Assign boxes from left to right to the first group whose seed's left edge is within ``gap``: ``group``."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g, pages = _sorted(g, page, g["l"].to_numpy(), g[key].to_numpy())
        xs, out = g["l"].tolist(), []
        for at in pages:
            seeds: list[float] = []
            for x in xs[at]:
                k = next((i for i, s in enumerate(seeds) if abs(s - x) <= gap), len(seeds))
                if k == len(seeds):
                    seeds.append(x)
                out.append(k)
        return g.assign(group=out)

    return _whole_pages(boxes, page, run, f"{_ddl(boxes)}, group bigint")


def union_outlines(rects: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Closed outlines of the unions of many items' rectangles, item by item: points and how many of them each item has.

    ``starts`` says where each item begins in ``rects``, and the end.  An item whose union has several parts or a hole, touches
    itself at a corner or is empty has no points.  Coordinates are compressed to a grid of cells for each item.  A grid
    point with one or three covered cells is a corner; sorted along a grid line, corners are the ends of its edges
    in pairs, so the outline goes from the first corner along its row, then its column, in turn.  It is the whole outline if it
    meets every corner.
    """
    n = len(starts) - 1
    item = np.repeat(np.arange(n), np.diff(starts))
    solid = (rects[:, 2] > rects[:, 0]) & (rects[:, 3] > rects[:, 1])
    rects, item = rects[solid], item[solid]
    count = np.bincount(item, minlength=n)
    lengths, found = np.zeros(n, dtype=np.int64), {}
    first = np.concatenate([[0], np.cumsum(count)])
    for k in np.unique(count[count > 0]).tolist():
        members, side = np.flatnonzero(count == k), 2 * k + 1
        step = max(1, 2_000_000 // side**2)
        for at in (members[x : x + step] for x in range(0, len(members), step)):
            points, sizes = _outlines(rects[first[at][:, None] + np.arange(k)])
            lengths[at] = sizes
            for i, p in zip(at[sizes > 0].tolist(), np.split(points, np.cumsum(sizes[sizes > 0])[:-1]), strict=False):
                found[i] = p
    return np.concatenate([found[i] for i in sorted(found)]) if found else np.empty((0, 2)), lengths


def _compressed(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the distinct values in order, and the places of both ends among them."""
    both = np.concatenate([low, high], axis=1)
    order = np.argsort(both, axis=1, kind="stable")
    values = np.take_along_axis(both, order, axis=1)
    rank = np.concatenate([np.zeros((len(both), 1), np.int64), np.cumsum(values[:, 1:] != values[:, :-1], axis=1)], axis=1)
    places, distinct = np.empty_like(rank), np.zeros_like(both)
    np.put_along_axis(places, order, rank, axis=1)
    np.put_along_axis(distinct, rank, values, axis=1)
    return distinct, places[:, : low.shape[1]], places[:, low.shape[1] :]


def _outlines(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`union_outlines` of items with equally many rectangles, none empty."""
    n, k = x.shape[:2]
    xs, l, r = _compressed(x[..., 0], x[..., 2])
    ys, t, b = _compressed(x[..., 1], x[..., 3])
    depth, row = np.zeros((n, 2 * k + 1, 2 * k + 1), dtype=np.int32), np.arange(n)[:, None]
    for i, j, sign in ((l, t, 1), (r, b, 1), (l, b, -1), (r, t, -1)):
        np.add.at(depth, (row, i + 1, j + 1), sign)
    full = depth.cumsum(axis=1).cumsum(axis=2) > 0
    nw, ne, sw, se = full[:, :-1, :-1], full[:, 1:, :-1], full[:, :-1, 1:], full[:, 1:, 1:]
    touching = ((nw == se) & (ne == sw) & (nw != ne)).any(axis=(1, 2))
    page, cx, cy = np.nonzero((nw ^ ne ^ sw ^ se) & ~touching[:, None, None])
    corners = np.bincount(page, minlength=n)
    order, across = np.lexsort((cx, cy, page)), np.empty(len(page), dtype=np.int64)
    across[order] = order[np.arange(len(page)) ^ 1]
    begin = np.cumsum(corners) - corners
    live = np.flatnonzero(corners)
    at, steps, walked = begin[live], [], np.zeros(n, dtype=np.int64)
    while len(live):
        side = across[at]
        steps += [(live, at), (live, side)]
        walked[live] += 2
        at = side ^ 1
        more = at != begin[live]
        live, at = live[more], at[more]
    good = (walked == corners) & (corners > 0)
    who, where = (np.concatenate([s[k] for s in steps]) if steps else np.empty(0, np.int64) for k in (0, 1))
    turn = np.repeat(np.arange(len(steps)), [len(s[0]) for s in steps])
    closing = np.flatnonzero(good)
    who, where, turn = np.concatenate([who, closing]), np.concatenate([where, begin[closing]]), np.concatenate([turn, np.full(len(closing), len(steps))])
    kept = good[who]
    who, where, turn = who[kept], where[kept], turn[kept]
    where, who = where[(order := np.lexsort((turn, who)))], who[order]
    return np.stack([xs[who, cx[where]], ys[who, cy[where]]], axis=1), np.where(good, corners + 1, 0)


def union_outline(rects: np.ndarray) -> list[list[float]] | None:
    """The closed outline of the union of rectangles, or None if it has several parts or a hole."""
    return union_outlines(np.asarray(rects, dtype=float), np.array([0, len(rects)]))[0].tolist() or None


def outlines(boxes: DataFrame, item: str) -> DataFrame:
    """Per item the outline of its boxes' union and why there is none (``parts``: separate, touching at a corner, or a hole)."""
    def run(starts: np.ndarray, g: pa.Table) -> Iterator[pa.RecordBatch]:
        points, sizes = union_outlines(np.stack([g.column(c).to_numpy().astype(float) for c in _BOX], axis=1), starts)
        pairs = pa.ListArray.from_arrays(pa.array(np.arange(len(points) + 1, dtype=np.int32) * 2), pa.array(points.ravel()))
        places = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), mask=np.append(sizes == 0, False))
        names = g.column(item).combine_chunks().take(pa.array(starts[:-1]))
        yield pa.RecordBatch.from_arrays([names, pa.ListArray.from_arrays(places, pairs), pa.array(np.where(sizes > 0, None, "parts"), pa.string())], [item, "polygon", "reason"])

    return arrow_pages(boxes, item, run, f"{item} {dict(boxes.dtypes)[item]}, polygon array<array<double>>, reason string")


def lattice(edges: DataFrame, page: str, value: str, pitches: tuple[float, float, float] = (8.0, 20.0, 0.25), tolerance: float = 0.6) -> DataFrame:
    """Fit evenly spaced columns: the pitch and offset whose lines most edges meet, chance agreement deducted.

    For one pitch the score grows with the number of edges met, so the best number of each pitch is scored, then
    every offset of the best pitch.  The lines that a value meets are found once for each distinct value.
    """
    grid = np.arange(*pitches)

    offsets = [np.arange(0, pitch, 0.25) for pitch in grid]
    pitch_of, offset_of = np.repeat(grid, [len(o) for o in offsets]), np.concatenate(offsets)
    ends = np.concatenate([[0], np.cumsum([len(o) for o in offsets])])

    def score(met: np.ndarray, n: np.ndarray, chance: np.ndarray) -> np.ndarray:
        return np.round((met / n - chance) / np.maximum(1 - chance, 1e-9), 6)

    def counts(xs: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """How many edges of each page every line meets."""
        values, at = np.unique(xs, return_inverse=True)
        far = np.abs((values[:, None] - offset_of + pitch_of / 2) % pitch_of - pitch_of / 2)
        kind = np.uint8 if np.diff(starts).max() < 256 else np.int32
        return np.add.reduceat((far <= tolerance).astype(kind)[at], starts[:-1], axis=0, dtype=kind)

    def run(starts: np.ndarray, g: pa.Table) -> Iterator[pa.RecordBatch]:
        xs, sizes = g.column(value).to_numpy().astype(float), np.diff(starts)
        names, out, k = g.column(page).combine_chunks().take(pa.array(starts[:-1])), [], 0
        while k < len(sizes):
            # As many pages as have 4,096 edges together; a page of more is counted in pieces.
            to = max(k + 1, int(np.searchsorted(starts, starts[k] + 4096, side="right")) - 1)
            here = starts[k : to + 1]
            if sizes[k] > 4096:
                met = sum(counts(xs[a : min(a + 4096, here[-1])], np.array([0, min(4096, here[-1] - a)])).astype(np.int64) for a in range(here[0], here[-1], 4096))
            else:
                met = counts(xs[here[0] : here[-1]], here - here[0])
            n, chance = sizes[k:to, None], np.minimum(1.0, 2 * tolerance / grid)
            best = score(np.maximum.reduceat(met, ends[:-1], axis=1), n, chance).argmax(axis=1)
            for p in np.unique(best).tolist():
                rows = np.flatnonzero(best == p)
                scores = score(met[rows, ends[p] : ends[p + 1]], n[rows], chance[p])
                o = scores.argmax(axis=1)
                out.append((k + rows, np.full(len(rows), grid[p]), offsets[p][o], scores[np.arange(len(rows)), o]))
            k = to
        at, *columns = (np.concatenate(c) for c in zip(*out, strict=True))
        order = np.argsort(at)
        yield pa.RecordBatch.from_arrays([names, *(pa.array(c[order]) for c in columns), pa.array(sizes.astype(np.int64))], [page, "pitch", "offset", "score", "n"])

    return arrow_pages(edges, page, run, f"{page} {dict(edges.dtypes)[page]}, pitch double, offset double, score double, n bigint")


def flood_components(cells: DataFrame, page: str, x: str, y: str) -> DataFrame:
    """8-connected components of marked cells: number, size and centroid."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g, pages = _sorted(g, page)
        names, cells, out = g[page].to_numpy(), list(zip(g[x].astype(int), g[y].astype(int), strict=True)), []
        for at in pages:
            left, n = set(cells[at]), 0
            while left:
                part, todo = [], [min(left)]
                left.discard(todo[0])
                while todo:
                    i, j = todo.pop()
                    part.append((i, j))
                    for a in (i - 1, i, i + 1):
                        for b in (j - 1, j, j + 1):
                            if (a, b) in left:
                                left.discard((a, b))
                                todo.append((a, b))
                out.append([names[at.start], n, len(part), round(sum(p[0] for p in part) / len(part), 4), round(sum(p[1] for p in part) / len(part), 4)])
                n += 1
        return pd.DataFrame(out, columns=[page, "component", "n", "cx", "cy"])

    return _whole_pages(cells, page, run, f"{page} {dict(cells.dtypes)[page]}, component bigint, n bigint, cx double, cy double")


def drop_nested(boxes: DataFrame, page: str, key: str, kind: str, framed: str = "article", frame: str = "display_ad") -> DataFrame:
    """Of two boxes one inside the other the inner one goes, but an ad around an article is its frame and goes itself.

    Pairs are judged in the order of kind and key; what is gone takes part no more.
    """
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g, pages = _sorted(g, page, g[kind].to_numpy(dtype=str), g[key].to_numpy())
        b, kinds, gone = g[_BOX].to_numpy(float), g[kind].to_numpy(), np.zeros(len(g), dtype=bool)
        size = _area(b)
        for at in pages:
            x = b[at]
            inside = (x[:, None, :2] >= x[None, :, :2]).all(2) & (x[:, None, 2:] <= x[None, :, 2:]).all(2) & (size[at][:, None] < size[at][None])
            for i, j in zip(*(n.tolist() for n in np.nonzero(np.triu(inside | inside.T, 1))), strict=True):
                if not gone[at.start + i] and not gone[at.start + j]:
                    inner, outer = (i, j) if inside[i, j] else (j, i)
                    boxed = kinds[at.start + inner] == framed and kinds[at.start + outer] == frame
                    gone[at.start + (outer if boxed else inner)] = True
        return g[~gone]

    return _whole_pages(boxes, page, run, boxes.schema)


def first_peak(series: DataFrame, key: str, position: str, value: str, low: int = 10, high: int = 60, prominence: float = 0.03) -> DataFrame:
    """The first peak of the autocorrelation of each key's series: ``lag, strength``; NULL without one.

    Lags from ``low`` to ``high`` count, those beyond the series as zero.  A peak is above both neighbours and
    rises by ``prominence`` over the higher of the two valleys that part it from higher ground or the range's end.
    """
    def run(g: pd.DataFrame) -> pd.DataFrame:
        v = g.sort_values(position)[value].to_numpy(float)
        v = v - v.mean()
        power, found = float((v * v).sum()), (None, None)
        if power > 1e-10:
            r = np.array([float((v[:-k] * v[k:]).sum()) / power if k < len(v) else 0.0 for k in range(low, high + 1)])
            for k in range(1, len(r) - 1):
                if r[k - 1] < r[k] > r[k + 1]:
                    left, right = r[:k][::-1], r[k + 1 :]
                    valleys = [side[: int((side > r[k]).argmax())] if (side > r[k]).any() else side for side in (left, right)]
                    if r[k] - max(float(x.min()) for x in valleys) >= prominence:
                        found = (k + low, round(float(r[k]), 6))
                        break
        return pd.DataFrame({key: [g[key].iloc[0]], "lag": pd.array([found[0]], dtype="Int64"), "strength": [found[1]]})

    return _per_page(series, key, run, f"{key} {dict(series.dtypes)[key]}, lag bigint, strength double")


def join_slices(slices: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """Join ordered slices of a transcript line by line, dropping what neighbours repeat.

    The last line of what is joined so far and the first of the next slice merge where they overlap (see
    ``stitch``); offsets of every slice in the joined text come along.
    """
    def overlap(a: str, b: str) -> str | None:
        a, b = a.strip(), b.strip()
        if not a or not b:
            return None
        if a == b or a.endswith(b):
            return a
        if b.startswith(a):
            return b
        for n in range(min(len(a), len(b)) - 1, 19, -1):
            if a[-n:] == b[:n] and a[-n - 1] == " ":
                return a + b[n:]
        return None

    def run(g: pd.DataFrame) -> pd.DataFrame:
        joined, starts, cut = "", [], 0
        for s in g.sort_values([order, text])[text].fillna(""):
            if not joined:
                starts.append(0)
                joined = s
                continue
            head, _, last = joined.rpartition("\n")
            first, sep, rest = s.partition("\n")
            if (m := overlap(last, first)) is not None:
                starts.append(len(head) + (1 if head else 0))
                joined, cut = (head + "\n" if head else "") + m + sep + rest, cut + 1
            else:
                starts.append(len(joined) + 1)
                joined = joined + "\n" + s
        return pd.DataFrame({key: [g[key].iloc[0]], "joined": [joined], "starts": [starts], "merged": [cut]})

    return _per_page(slices, key, run, f"{key} {dict(slices.dtypes)[key]}, joined string, starts array<bigint>, merged bigint")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{n} {k}" for n, k in df.dtypes)
