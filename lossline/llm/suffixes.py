"""Repeated byte strings by a sparse enhanced suffix array.

Which bytes of a text are covered by a string of ``length`` bytes that also
starts anywhere else (in another text or the same one)?

1. Winnowing picks anchors: in every run of ``length`` bytes at least one
   ``gram``-byte string is picked, by its content alone. So equal runs hold
   anchors at equal places, and only anchors whose gram occurs twice matter.
2. The suffixes that start at such anchors are sorted within their gram, which
   gives a suffix array of the anchors with common-prefix lengths and left
   contexts (an enhanced suffix array). Equal contexts are collapsed before.
3. A stack scan walks its tree of common-prefix intervals. In an interval of
   prefix length p the suffixes fall into classes with ``length - p`` equal bytes
   to their left; an interval all of whose left contexts agree is no maximal
   repeat but its members are extended alike. Every class of two or more is a
   group of repeats with all its occurrences, and gives each member its extent.
4. Extents become spans of the texts.

A gram with more than ``hot`` different contexts is not sorted in one task: its
runs of ``length`` bytes are hashed (128 bits) and counted instead, which needs
no group and gives the same bytes.

Defined cases: a null text has no bytes; texts shorter than ``length`` have no
match; a string never crosses texts; repeated rows are occurrences of each
other; an empty table gives no rows; further columns are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, materialize, row_key, slices

_B = 0x9E3779B97F4A7C15
_BLOCK = 1 << 16


def gram_hashes(data: bytes, gram: int) -> np.ndarray:
    """64-bit hash of each run of ``gram`` bytes; evaluated in doubling steps."""
    h = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    n = len(data) - gram + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # h covers `have` bytes; doubling needs a gram that is a power of two
    have, factor = 1, _B
    while have < gram:
        h = h[:-have] * np.uint64(factor) + h[have:]
        factor = factor * factor % (1 << 64)
        have *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding(x: np.ndarray, w: int, f: np.ufunc, fill: np.uint64) -> np.ndarray:
    """f over each window of w values, from block-wise running values."""
    n = len(x)
    pad = np.full(-(-n // w) * w, fill, np.uint64)
    pad[:n] = x
    blocks = pad.reshape(-1, w)
    ahead = f.accumulate(blocks, axis=1).ravel()
    behind = f.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return f(behind[:n - w + 1], ahead[w - 1:n])


def anchors(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams that are least in some run of ``length`` bytes."""
    w = length - gram + 1
    places, hashes = [], []
    # long texts in blocks that overlap by one run; a run lies in one block whole
    for at in range(0, max(1, len(data) - length + 1), _BLOCK):
        part = data[at:at + _BLOCK + length - 1]
        if len(part) < length:
            continue
        h = gram_hashes(part, gram)
        least = _sliding(h, w, np.minimum, np.uint64((1 << 64) - 1))
        # a gram is picked if it equals the least of one of the runs around it
        around = np.zeros(len(h) + w - 1, np.uint64)
        around[w - 1:w - 1 + len(least)] = least
        top = _sliding(around, w, np.maximum, np.uint64(0))
        p = np.nonzero(top == h)[0]
        places.append(p + at), hashes.append(h[p])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    p, first = np.unique(np.concatenate(places), return_index=True)
    return p, np.concatenate(hashes)[first]


def context(data: bytes, at: int, length: int, gram: int) -> tuple[bytes, bytes]:
    return data[max(0, at - length + gram):at], data[at:at + length]


def _shared(a: np.ndarray, la: np.ndarray) -> np.ndarray:
    """Common-prefix lengths of neighbouring rows of a padded byte matrix."""
    differ = a[1:] != a[:-1]
    n = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return np.minimum(n, np.minimum(la[1:], la[:-1]))


def _matrix(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(len(parts), width)


class _RangeMin:
    """Least of the values between neighbouring ranks."""

    def __init__(self, values: np.ndarray):
        self.plain = values.tolist()
        self.table = [values]
        while 2 << (len(self.table) - 1) <= len(values):
            t, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(t[:-half], t[half:]))

    def of(self, ranks: list[int]) -> list[int]:
        if len(ranks) < 12 and ranks[-1] - ranks[0] < 200:
            v = self.plain
            return [min(v[a:b]) for a, b in zip(ranks, ranks[1:])]
        r = np.array(ranks)
        a, b = r[:-1], r[1:]
        level = np.frexp((b - a).astype(float))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            m = level == k
            t = self.table[k]
            out[m] = np.minimum(t[a[m]], t[b[m] - (1 << k)])
        return out.tolist()


def scan(lefts: list[bytes], rights: list[bytes], length: int, gram: int) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeat groups of one gram's contexts: (left bytes, right bytes, members).

    Walks the common-prefix intervals of the sorted right contexts from the
    deepest up; in each, members are split by their left contexts.
    """
    n = len(rights)
    order = sorted(range(n), key=rights.__getitem__)
    lens = np.array([len(rights[i]) for i in order])
    lcp = _shared(_matrix([rights[i] for i in order], length), lens).tolist()
    # left contexts read backwards; their ranks order every interval's members
    back = [x[::-1] for x in lefts]
    by_left = sorted(range(n), key=back.__getitem__)
    rank = [0] * n
    for r, i in enumerate(by_left):
        rank[i] = r
    llens = np.array([len(back[i]) for i in by_left])
    lcs = _shared(_matrix([back[i] for i in by_left], max(1, length - gram)), llens)
    common = _RangeMin(lcs)
    longest = int(lcs.max(initial=0))

    def classes(p: int, members: list[int]) -> Iterator[tuple[int, int, list[int]]]:
        """Groups with length - p equal bytes on the left, each to its full left extent."""
        need = length - p
        if longest < need:
            return
        ranks = sorted([rank[i] for i in members])
        commons = common.of(ranks)
        at = 0
        while at < len(commons):
            if commons[at] < need:
                at += 1
                continue
            end = at
            while end < len(commons) and commons[end] >= need:
                end += 1
            part = commons[at:end]
            least = min(part)
            yield least, p, [by_left[r] for r in ranks[at:end + 1]]
            # neighbours in the order of left contexts may share more than the group
            best: dict[int, list[int]] = {}
            for k in range(at, end + 1):
                m = max(commons[k - 1] if k > at else 0, commons[k] if k < end else 0)
                if m > least:
                    best.setdefault(m, []).append(by_left[ranks[k]])
            for m, some in best.items():
                yield m, p, some
            at = end

    # stack of open intervals: (prefix length, first rank)
    stack: list[tuple[int, int]] = []
    for i in range(n):
        value = lcp[i] if i < n - 1 else -1
        begin = i
        while stack and stack[-1][0] > value:
            p, begin = stack.pop()
            if p >= gram:
                yield from classes(p, order[begin:i + 1])
        if not stack or stack[-1][0] < value:
            stack.append((value, begin))


def _prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def extents(lefts: list[bytes], rights: list[bytes], length: int, gram: int) -> tuple[list[int], list[int]]:
    """Furthest repeated bytes left and right of each context's anchor (0, 0: none)."""
    n = len(lefts)
    if n == 2:  # most grams: one interval, one class
        r = _prefix(rights[0], rights[1])
        l = _prefix(lefts[0][::-1], lefts[1][::-1])
        return ([l, l], [r, r]) if r >= gram and l + r >= length else ([0, 0], [0, 0])
    left, right = [0] * n, [0] * n
    for l, r, members in scan(lefts, rights, length, gram):
        for i in members:
            if l > left[i]:
                left[i] = l
            if r > right[i]:
                right[i] = r
    return left, right


def repeated_spans(docs: DataFrame, length: int = 200, gram: int = 32, hot: int = 100_000) -> DataFrame:
    """``row, spans``: for each row key (see ``row_key``) with repeats, its spans
    (begin, end) of repeated bytes; overlapping ones are not yet united."""
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), "text").where(F.length("text") > 0)
    reach = length - gram

    def list_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            fp, ctx, row, at, ll, rl = [], [], [], [], [], []
            for key, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                p, h = anchors(data, length, gram)
                if not len(p):
                    continue
                fp.append(h), at.append(p), row.append(np.full(len(p), key, np.int64))
                ctx.extend([xxhash.xxh3_64_intdigest(data[max(0, i - reach):i + length], seed=min(i, reach))
                            for i in p.tolist()])
                ll.append(np.minimum(p, reach)), rl.append(np.minimum(len(data) - p, length))
            cat = lambda x, t: np.concatenate(x).astype(t) if x else np.empty(0, t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cat(fp, np.uint64).view(np.int64)), pa.array(np.array(ctx, np.uint64).view(np.int64)),
                 pa.array(cat(row, np.int64)), pa.array(cat(at, np.int32)), pa.array(cat(ll, np.int16)),
                 pa.array(cat(rl, np.int16))], names=["fp", "ctx", "row", "at", "ll", "rl"])

    def list_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            found = [anchors(t.encode("utf-8", "surrogatepass"), length, gram)[1] for t in batch.column("text").to_pylist()]
            fp, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(n.astype(np.int64))], names=["fp", "n"])

    listed = keyed.mapInArrow(list_anchors, "fp long, ctx long, row long, at int, ll short, rl short")
    twice = (keyed.select("text").mapInArrow(list_hashes, "fp long, n long").groupBy("fp").agg(F.sum("n").alias("n"))
             .where("n > 1").select("fp"))
    # written first: a join over an aggregate is not split where one gram is very frequent
    twice = materialize(twice, "sa-twice")
    found = materialize(listed.join(twice, "fp"), "sa-anchors")
    contexts = materialize(found.groupBy("fp", "ctx", "ll", "rl")
                           .agg(F.count("*").alias("n"), F.min(F.struct("row", "at")).alias("at")), "sa-contexts")
    # equal whole contexts are repeats to their ends; the rest is sorted, unless
    # all contexts of a gram are settled so
    settled = contexts.where((F.col("n") > 1) & (F.col("ll") + F.col("rl") >= length))
    open_grams = (contexts.groupBy("fp").agg(F.count("*").alias("k"), F.max(
        (F.col("n") == 1) | (F.col("ll") + F.col("rl") < length)).alias("open"))
        .where("k > 1 AND open").select("fp", "k"))
    wanted = contexts.join(open_grams, "fp")
    asked = (wanted.groupBy(F.col("at.row").alias("a_row"))
             .agg(F.collect_list(F.struct("fp", "ctx", F.col("at.at").alias("at"), F.col("k"))).alias("asked")))

    def cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "text", 1 << 20):
                fp, ctx, k, left, right = [], [], [], [], []
                for text, want in zip(batch.column("text").to_pylist(), batch.column("asked").to_pylist()):
                    data = text.encode("utf-8", "surrogatepass")
                    for w in want:
                        a, b = context(data, w["at"], length, gram)
                        fp.append(w["fp"]), ctx.append(w["ctx"]), k.append(w["k"]), left.append(a), right.append(b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp, pa.int64()), pa.array(ctx, pa.int64()), pa.array(k, pa.int64()),
                     pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["fp", "ctx", "k", "l", "r"])

    cut = (keyed.join(asked, F.col("row") == F.col("a_row")).select("text", "asked")
           .mapInArrow(cut_contexts, "fp long, ctx long, k long, l binary, r binary"))
    cut = materialize(cut, "sa-suffixes")

    def scan_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = rest["fp"].iloc[-1] if len(rest) else None
            whole = rest[rest["fp"] != last]
            rest = rest[rest["fp"] == last]
            if len(whole):
                yield _scanned(whole, length, gram)
        if rest is not None and len(rest):
            yield _scanned(rest, length, gram)

    sorted_grams = (cut.where(F.col("k") <= hot).repartition("fp").sortWithinPartitions("fp")
                    .select("fp", "ctx", "l", "r").mapInPandas(scan_grams, "fp long, ctx long, left int, right int"))
    hot_grams = _hot_extents(cut.where(F.col("k") > hot), length)
    ends = (sorted_grams.unionByName(hot_grams)
            .unionByName(settled.select("fp", "ctx", F.col("ll").cast("int").alias("left"), F.col("rl").cast("int").alias("right")))
            .groupBy("fp", "ctx").agg(F.max("left").alias("left"), F.max("right").alias("right")))
    # written first, like the grams: a context that a large group of copies has is split
    ends = materialize(ends, "sa-ends")
    return (found.select("fp", "ctx", "row", "at").join(ends, ["fp", "ctx"])
            .select("row", F.struct((F.col("at") - F.col("left")).alias("begin"), (F.col("at") + F.col("right")).alias("end"))
                    .alias("span"))
            .distinct().groupBy("row").agg(F.collect_list("span").alias("spans")))


def _scanned(part: pd.DataFrame, length: int, gram: int) -> pd.DataFrame:
    fps = part["fp"].to_numpy()
    lefts, rights = part["l"].tolist(), part["r"].tolist()
    cuts = [0, *(np.nonzero(np.diff(fps))[0] + 1).tolist(), len(fps)]
    left, right = [], []
    for b, e in zip(cuts, cuts[1:]):
        x, y = extents(lefts[b:e], rights[b:e], length, gram) if e - b > 1 else ([0], [0])
        left += x
        right += y
    out = pd.DataFrame({"fp": fps, "ctx": part["ctx"].to_numpy(), "left": left, "right": right})
    return out[out["right"] > 0]


def _hot_extents(cut: DataFrame, length: int) -> DataFrame:
    """Extents of contexts by counting the hashes of their runs of ``length`` bytes."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for fp, ctx, l, r in zip(*(batch.column(c).to_pylist() for c in ("fp", "ctx", "l", "r"))):
                data = l + r
                for o in range(0, min(len(l), len(data) - length) + 1):
                    h = xxhash.xxh3_128_intdigest(data[o:o + length])
                    for col, v in zip(out, (fp, ctx, len(l) - o, (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63))):
                        col.append(v)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=["fp", "ctx", "o", "hi", "lo"])

    listed = cut.select("fp", "ctx", "l", "r").mapInArrow(runs, "fp long, ctx long, o int, hi long, lo long")
    # one context holds a run at one place only (relative to its anchor): count contexts
    key = ["fp", "o", "hi", "lo"]
    twice = listed.groupBy(*key).agg(F.count("*").alias("c")).where("c > 1").drop("c")
    return (listed.join(twice, key).groupBy("fp", "ctx")
            .agg(F.max("o").alias("left"), (length - F.min("o")).alias("right")))


def digest(data: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Removed bytes, number of removed runs, and the bytes left."""
    kept, at, removed, count, end = [], 0, 0, 0, -1
    for b, e in sorted(spans):
        if b > end:
            count += 1
            if end >= 0:
                at = end
            kept.append(data[at:b])
            end = e
            removed += e - b
        elif e > end:
            removed += e - end
            end = e
    kept.append(data[max(end, 0):])
    return removed, count, b"".join(kept)


def remove_repeats(docs: DataFrame, length: int = 200, gram: int = 32, hot: int = 100_000) -> DataFrame:
    """``docs`` with ``sa_bytes``, ``sa_removed``, ``sa_spans`` (united), the number
    ``sa_runs`` and ``sa_sha256`` of the bytes left."""
    added = [("sa_bytes", T.LongType()), ("sa_removed", T.LongType()), ("sa_runs", T.LongType()),
             ("sa_sha256", T.StringType())]
    kept = [f for f in docs.schema.fields if f.name not in dict(added)]
    names = [f.name for f in kept]
    key, row, found_spans = fresh(docs, "sa_key", "sa_row", "sa_found")
    spans = repeated_spans(docs, length, gram, hot).withColumnRenamed("row", row).withColumnRenamed("spans", found_spans)
    joined = (docs.withColumn(key, row_key(F.col("doc_id"), F.col("text"))).join(spans, F.col(key) == F.col(row), "left"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "text"):
                out: list[list] = [[] for _ in added]
                for text, found in zip(batch.column("text").to_pylist(), batch.column(found_spans).to_pylist()):
                    data = (text or "").encode("utf-8", "surrogatepass")
                    removed, runs, left = digest(data, [(s["begin"], s["end"]) for s in found or ()])
                    for col, v in zip(out, (len(data), removed, runs, hashlib.sha256(left).hexdigest())):
                        col.append(v)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n) for n in names] + [pa.array(c, pa.int64()) for c in out[:3]] + [pa.array(out[3])],
                    names=names + [n for n, _ in added])

    schema = T.StructType(kept + [T.StructField(n, t) for n, t in added])
    return joined.select(*[f"`{n}`" for n in names], found_spans).mapInArrow(run, schema)
