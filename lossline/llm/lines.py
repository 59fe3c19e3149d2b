"""Removal of repeated runs of lines, cut by content.

Each line is hashed. A rolling hash over the last line hashes decides where a chunk
of lines may end, so an inserted line moves only the boundaries beside it; a chunk
starts at every line and ends at the first boundary, or where it has ``full_bytes``
bytes. So a repeated run of lines holds a whole chunk if it holds a boundary or
is that long, wherever it stands in a text. Chunks that occur in an earlier place
too are looked up, chunks that follow each other at both places are one run, and
the run is extended line by line to the maximal common one. Its lines are removed
after their bytes were compared with those of the earlier place. Places are ordered
by (doc_id, row key, first line), and a line goes only if an earlier place has it:
no line's text is ever lost.

A chunk has two lines or more and ``least_bytes`` bytes that are no white space, so
blank and brace lines alone are never a chunk. A repeated run shorter than
``full_bytes`` that holds no boundary stays: with ``divisor`` d a share of 1 - 1/d of
those of two lines.

Defined cases: a single repeated line between others stays; a chunk does not remove
one that overlaps it; a null or empty text has no lines and stays as it is; repeated
rows (equal id and text) are one document, so they do not remove each other; a null
id sorts first; an empty table gives no rows; lines end at "\\n" only, and the kept
lines are joined by it. Further columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, fresh, materialize, row_id, slices

_BASE = 0x9E3779B97F4A7C15


def chunk_ends(lines: list[bytes], hashes: np.ndarray, window: int = 2, divisor: int = 2, least_bytes: int = 40,
               full_bytes: int = 160) -> np.ndarray:
    """For each line the end of the chunk that starts there, 0 where there is none.

    ``hashes`` are the lines' 64-bit hashes. A chunk ends after the first line from
    the second on where the rolling hash of the last ``window`` lines is 0 modulo
    ``divisor``, or where it has ``full_bytes`` bytes, once it has ``least_bytes``
    bytes that are no white space."""
    n = len(lines)
    if n < 2:
        return np.zeros(n, np.int64)
    rolling = np.zeros(n, np.uint64)
    for i in range(window):  # over the lines i - window + 1 .. i
        rolling[window - 1:] = rolling[window - 1:] * np.uint64(_BASE) + hashes[i:n - window + 1 + i]
    boundary = (rolling >> np.uint64(32)) % np.uint64(divisor) == 0
    boundary[:window - 1] = False
    whole = np.concatenate([[0], np.cumsum([len(x) + 1 for x in lines])])
    solid = np.concatenate([[0], np.cumsum([len(x.strip()) for x in lines])])
    begin = np.arange(n)
    first = np.maximum(begin + 2, np.searchsorted(solid, solid[:-1] + least_bytes))  # enough lines and bytes
    full = np.searchsorted(whole, whole[:-1] + full_bytes)
    # the first boundary at or after each line, as the end after it
    after = np.where(boundary, begin + 1, n + 2)
    after = np.append(np.minimum.accumulate(after[::-1])[::-1], [n + 2, n + 2])
    end = np.minimum(after[np.minimum(first - 1, n)], np.maximum(first, full))
    # blank lines alone fill up no chunk: within full_bytes there must be enough
    return np.where((end <= n) & (first <= np.maximum(full, begin + 2)), end, 0)


def places(text: str, **how: int) -> list[tuple[int, int, int]]:
    """(first line, lines, 128-bit hash) of the chunks that start at each line."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    wide = [xxhash.xxh3_128_digest(x) for x in lines]
    joined = b"".join(wide)
    ends = chunk_ends(lines, np.frombuffer(joined, np.uint64)[::2], **how).tolist()
    return [(b, e - b, xxhash.xxh3_128_intdigest(joined[16 * b:16 * e])) for b, e in enumerate(ends) if e]


def united(found: list[dict]) -> list[tuple[int, int, int, int]]:
    """(first line, lines, row and first line of the earlier place): chunks that
    follow each other at both places become one span; a span inside another goes."""
    spans: list[list[int]] = []
    for row, ahead, at, n in sorted((c["f_row"], c["f_at"] - c["at"], c["at"], c["n"]) for c in found):
        if spans and spans[-1][:2] == [row, ahead] and at <= spans[-1][3]:
            spans[-1][3] = max(spans[-1][3], at + n)
        else:
            spans.append([row, ahead, at, at + n])
    out, end = [], 0
    for row, ahead, b, e in sorted(spans, key=lambda x: (x[2], -x[3])):
        if e > end:
            out.append((b, e - b, row, b + ahead))
            end = e
    return out


def _packed(df: DataFrame, column: str) -> DataFrame:
    """``column`` compressed: texts take less of the disk when they are dealt out."""
    schema = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == column else f for f in df.schema.fields])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches, column, 2 << 20):
            data = pa.array([None if t is None else coder.compress(t.encode("utf-8", "surrogatepass"))
                             for t in batch.column(column).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([data if f.name == column else batch.column(f.name) for f in schema.fields],
                                             names=schema.names)

    return arrow_map(df, pack, schema)


_CHUNK = "ck_doc long, ck_row binary, ck_at int, ck_lines int, ck_hi long, ck_lo long"
_SPAN = "s_row binary, s_at int, s_lines int, f_row binary, f_at int"
_HALF = (1 << 64) - 1


def dedup(docs: DataFrame, window: int = 2, divisor: int = 2, least_bytes: int = 40, full_bytes: int = 160) -> DataFrame:
    """``docs`` with repeated runs of lines cut from ``text`` and the counts ``ld_lines``,
    ``ld_lines_removed``, ``ld_chunks_removed`` (maximal removed runs)."""
    how = {"window": window, "divisor": divisor, "least_bytes": least_bytes, "full_bytes": full_bytes}
    keyed = docs.select(F.col("doc_id").cast("long").alias("ck_doc"), row_id(F.col("doc_id"), F.col("text")).alias("ck_row"),
                        F.col("text").alias("ck_text"))

    def list_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ck_text", 2 << 20):
            out: list[list] = [[] for _ in range(6)]
            for doc, row, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for at, n, h in places(text, **how) if text else ():
                    for col, v in zip(out, (doc, row, at, n, (h >> 64) - (1 << 63), (h & _HALF) - (1 << 63))):
                        col.append(v)
            types = (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=["ck_doc", "ck_row", "ck_at", "ck_lines", "ck_hi", "ck_lo"])

    listed = materialize(arrow_map(keyed, list_chunks, _CHUNK), "line-chunks")
    place = F.struct("ck_doc", "ck_row", "ck_at")
    groups = (listed.groupBy("ck_hi", "ck_lo").agg(F.min(place).alias("first"), F.max(place).alias("last"))
              .where("first <> last").select("ck_hi", "ck_lo", "first"))  # repeated rows are one place
    groups = materialize(groups, "line-groups")
    found = (listed.join(groups, ["ck_hi", "ck_lo"]).where(place != F.col("first"))
             .where("first.ck_row <> ck_row OR first.ck_at + ck_lines <= ck_at")
             .groupBy("ck_row").agg(F.collect_set(F.struct(
                 F.col("ck_at").alias("at"), F.col("ck_lines").alias("n"), F.col("first.ck_row").alias("f_row"),
                 F.col("first.ck_at").alias("f_at"))).alias("found")))

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for row, chunks_found in zip(batch.column("ck_row").to_pylist(), batch.column("found").to_pylist()):
                for span in united(chunks_found):
                    for col, v in zip(out, (row, *span)):
                        col.append(v)
            types = (pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=["s_row", "s_at", "s_lines", "f_row", "f_at"])

    spans = materialize(arrow_map(found, unite, _SPAN), "line-spans")

    # lines of the first places, and the next ones: what a run can be longer than its
    # chunks, as a chunk that started in its last full_bytes would end by then
    wanted = (spans.groupBy(F.col("f_row").alias("w_row"))
              .agg(F.collect_set(F.struct(F.col("f_at").alias("at"), F.col("s_lines").alias("n"))).alias("w_spans")))

    def first_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = zstandard.ZstdDecompressor()
        for batch in slices(batches, "ck_text", 2 << 20):
            out: list[list] = [[] for _ in range(4)]
            for row, text, want in zip(*(batch.column(n).to_pylist() for n in ("ck_row", "ck_text", "w_spans"))):
                parts = decoder.decompress(text).split(b"\n")
                for w in want:
                    end, more = w["at"] + w["n"], 0
                    while end < len(parts) and more < full_bytes:
                        more += len(parts[end]) + 1
                        end += 1
                    for col, v in zip(out, (row, w["at"], w["n"], b"\n".join(parts[w["at"]:end]))):
                        col.append(v)
            types = (pa.binary(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=["f_row", "f_at", "s_lines", "f_data"])

    texts = arrow_map(_packed(keyed.select("ck_row", "ck_text"), "ck_text")
                      .join(wanted.hint("merge"), F.col("ck_row") == F.col("w_row")).select("ck_row", "ck_text", "w_spans"),
                      first_texts, "f_row binary, f_at int, s_lines int, f_data binary")
    # written first: a join over an aggregate is not split where many spans have one first place
    texts = materialize(texts.dropDuplicates(["f_row", "f_at", "s_lines"]), "line-first-texts")
    key, other, cuts = fresh(docs, "ld_key", "ld_other", "ld_cut")
    # a run within one document may not reach into its own first place
    room = F.when(F.col("f_row") == F.col("s_row"), F.col("s_at") - F.col("f_at")).alias("room")
    repeats = (spans.join(texts, ["f_row", "f_at", "s_lines"]).groupBy(F.col("s_row").alias(other))
               .agg(F.collect_list(F.struct(F.col("s_at").alias("at"), F.col("s_lines").alias("n"), room,
                                            F.col("f_data").alias("data"))).alias(cuts)))

    added = ["ld_lines", "ld_lines_removed", "ld_chunks_removed"]
    names = [c for c in docs.columns if c not in added]
    out_fields = [f for f in docs.schema.fields if f.name in names] + [T.StructField(n, T.LongType()) for n in added]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = zstandard.ZstdDecompressor()
        for batch in slices(batches, "text", 2 << 20):
            texts_out, counts = [], ([], [], [])
            for packed, found_cuts in zip(batch.column("text").to_pylist(), batch.column(cuts).to_pylist()):
                data = None if packed is None else decoder.decompress(packed)
                gone = b""
                if found_cuts:
                    parts = data.split(b"\n")
                    gone = removed(parts, found_cuts)
                    data = b"\n".join(p for p, g in zip(parts, gone) if not g)
                n = len(gone) or (data.count(b"\n") + 1 if data else 0)
                texts_out.append(None if data is None else data.decode("utf-8", "surrogatepass"))
                for col, v in zip(counts, (n, sum(gone), len(gone.replace(b"\0", b" ").split()))):
                    col.append(v)
            columns = [pa.array(texts_out, pa.string()) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(c, pa.int64()) for c in counts],
                                             names=names + added)

    keyed_docs = docs.select(*[f"`{c}`" for c in names], row_id(F.col("doc_id"), F.col("text")).alias(key))
    joined = _packed(keyed_docs, "text").join(repeats.hint("merge"), F.col(key) == F.col(other), "left")
    return arrow_map(joined.select(*[f"`{c}`" for c in names], cuts), cut, T.StructType(out_fields))


def removed(lines: list[bytes], cuts: list[dict]) -> bytes:
    """A byte for each line, 1 where it goes: the lines of ``cuts`` whose bytes equal the
    earlier place's, and those after them as long as they do."""
    gone = bytearray(len(lines))
    for c in cuts:
        earlier = c["data"].split(b"\n")[:c["room"]]
        same = 0
        for a, b in zip(earlier, lines[c["at"]:]):
            if a != b:
                break
            same += 1
        if same >= c["n"]:
            gone[c["at"]:c["at"] + same] = b"\1" * same
    return bytes(gone)
