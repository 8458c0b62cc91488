"""URL filters over a sorted digest array.

The rules become one file: their 64-bit xxhash keys, sorted, then offsets into the rules' full strings.
Spark ships the file to each executor, where it is memory-mapped, so Python workers share its pages and a
rule list of any size costs no heap.  A batch of URLs turns into probe strings (each suffix of the host
with each path prefix of a length some rule has); their keys are searched in one vectorised binary search
and a match counts only if the stored string is equal, so colliding keys do no harm.
"""

from __future__ import annotations

import hashlib
import mmap
import os
import re
import struct
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HEAD = struct.Struct("<QQ")
VERDICTS = ("allow", "block")
_OPEN: dict[str, RuleArray] = {}


_PARTS = re.compile(r"([^/?#]*)([^?#]*)", re.DOTALL)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    host, path = _PARTS.match(url, at + 3).groups()
    return host.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"), path


def _key(host: bytes, path: bytes) -> bytes:
    return host + b"\x00" + path


def build_array(rules: Sequence[tuple[str, str, str]]) -> bytes:
    """The file for rules ``(host, path, verdict)``; of equal host and path the first rule stays."""
    first: dict[bytes, int] = {}
    for host, path, verdict in rules:
        first.setdefault(_key(host.encode(), path.encode()), VERDICTS.index(verdict))
    ranked = sorted((xxhash.xxh64_intdigest(k), k, v) for k, v in first.items())
    lengths = sorted({len(k.split(b"\x00", 1)[1]) for k in first})
    blob = b"".join(k for _, k, _ in ranked)
    ends = np.cumsum([len(k) for _, k, _ in ranked], dtype="<u8")
    return b"".join((
        _HEAD.pack(len(ranked), len(lengths)), np.array([h for h, _, _ in ranked], dtype="<u8").tobytes(), ends.tobytes(),
        np.array([v for _, _, v in ranked], dtype="<u8").tobytes(), np.array(lengths, dtype="<u8").tobytes(), blob,
    ))


class RuleArray:
    """A memory-mapped digest array."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n, m = _HEAD.unpack_from(self.map, 0)
        whole = np.frombuffer(self.map, dtype="<u8", count=3 * n + m, offset=_HEAD.size)
        self.n, self.keys, self.ends, self.verdicts, self.lengths = n, whole[:n], whole[n : 2 * n], whole[2 * n : 3 * n], whole[3 * n :].tolist()
        self.blob = memoryview(self.map)[_HEAD.size + 8 * (3 * n + m) :]

    def string(self, k: int) -> bytes:
        return bytes(self.blob[int(self.ends[k - 1]) if k else 0 : int(self.ends[k])])

    def find(self, probes: list[bytes]) -> np.ndarray:
        """The position of each probe string, or -1."""
        out = np.full(len(probes), -1, dtype=np.int64)
        if not self.n or not probes:
            return out
        wanted = np.array([xxhash.xxh64_intdigest(p) for p in probes], dtype=np.uint64)
        at = np.searchsorted(self.keys, wanted)
        for i in np.flatnonzero((at < self.n) & (self.keys[np.minimum(at, self.n - 1)] == wanted)):
            k = int(at[i])
            while k < self.n and self.keys[k] == wanted[i]:  # equal keys of different strings
                if self.string(k) == probes[i]:
                    out[i] = k
                    break
                k += 1
        return out


def judge(array: RuleArray, urls: Sequence[str | None], default: str = "allow") -> list[tuple[str, str, str | None, str]]:
    """``(host, path, rule, verdict)`` of each URL; the longest fitting rule wins, of equal lengths the longer host.

    A URL takes a probe for each suffix of its host at a label and each length of a path among the rules that
    its path reaches, so the work grows with the number of different path lengths, not with the number of rules.
    """
    parts, probes, owner = [split_url(u) for u in urls], [], []
    for i, (host, path) in enumerate(parts):
        h, p = host.encode("utf-8", "surrogatepass"), path.encode("utf-8", "surrogatepass")
        if not h:
            continue
        labels = h.split(b".")
        for k in range(len(labels)):
            suffix = b".".join(labels[k:])
            for n in array.lengths:
                if n > len(p):
                    break
                probes.append(_key(suffix, p[:n]))
                owner.append(i)
    best: dict[int, tuple[int, int, int]] = {}
    found = array.find(probes)
    for j in np.flatnonzero(found >= 0):
        host = probes[j].index(b"\x00")
        rank = (len(probes[j].decode("utf-8", "surrogatepass")), host, int(found[j]))
        best[owner[j]] = max(best.get(owner[j], rank), rank)
    out = []
    for i, (host, path) in enumerate(parts):
        k = best[i][2] if i in best else None
        rule = array.string(k).replace(b"\x00", b"", 1).decode("utf-8", "surrogatepass") if k is not None else None
        out.append((host, path, rule, VERDICTS[int(array.verdicts[k])] if k is not None else default))
    return out


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    A rule fits its host and all its subdomains if the URL's path starts with the rule's.  A URL that is
    NULL or has no ``://`` has an empty host and path; it, like any URL no rule fits, gets ``default``.  A URL is
    read whole.  Of rules with one host and path the first counts.  Repeated rows are judged each, a NULL id stays
    NULL; an empty table gives no rows, an empty rule list leaves ``default`` everywhere.  Other columns are ignored.
    """
    data = build_array(rules)
    name = f"rules-{hashlib.sha256(data).hexdigest()[:24]}.bin"
    context = pages.sparkSession.sparkContext
    if not any(sent.endswith(name) for sent in context.listFiles):  # Spark refuses one name twice
        local = os.path.join(tempfile.mkdtemp(prefix="quire-"), name)
        with open(local, "wb") as f:
            f.write(data)
        context.addFile(local)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _OPEN:
            _OPEN[name] = RuleArray(SparkFiles.get(name))
        for batch in batches:
            rows = judge(_OPEN[name], batch.column(1).to_pylist(), default)
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), pa.string()) for c in columns)], ["page_id", "host", "path", "rule", "verdict"])

    return pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url")).mapInArrow(run, "page_id bigint, host string, path string, rule string, verdict string")
