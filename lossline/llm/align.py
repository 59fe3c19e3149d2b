"""Alignment of two tokenizers over the bytes of a text.

A text is encoded by a byte-level BPE (A) and by a SentencePiece BPE (B); both give
the same bytes, a space and the text. Two tokens are linked where their byte ranges
overlap, and the offsets where both have a token's end cut the tokens into groups.

All documents of a batch are merged in lockstep: one state vector holds a pointer
into A's and into B's tokens for each document; a step emits the link of every
document's two tokens, a cut where both end, and moves on the pointer (or both)
whose token ends first. Finished documents are compacted out of the vector. A
long text is dealt over several places of the vector, which begin at offsets where
both tokenizers have a token's end, so that it does not leave the vector nearly empty.

Counts of linked id pairs cover the corpus. A task joins a bounded number of links
to a block with one sum for each distinct pair; the sums are added up by pair, and
each block gets its pairs' totals back, so neither links nor totals are ever in one
place and shuffled rows are distinct pairs of blocks instead of links.

Defined cases: a text that is null or empty, or whose tokens' bytes in A or B are
not the space and the text (such as a text with U+2581), has no tokens: zeros and an
empty digest; special tokens' strings in a text are plain text; repeated rows are
documents of their own, and each counts; a null doc_id stays null; an empty table
gives no rows; further columns take no part. A task's memory is in proportion to
its longest text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece as sp
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import arrow_map, materialize, slices

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"

#: Fixed value: how a byte-level BPE of this kind cuts a text into words.
WORDS = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the others follow from 256."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBPE:
    """Tokenizer A. Words are encoded by ranks where the file's merges are in the
    order of its ids (the same tokens, many times faster); texts with words of
    thousands of characters go to the file's own tokenizer."""

    def __init__(self, content: str):
        self.content, self.own = content, None
        model = json.loads(content)
        special = {t["content"] for t in model.get("added_tokens", []) if t.get("special")}
        byte = byte_alphabet()
        vocab = {t: i for t, i in model["model"]["vocab"].items() if t not in special}
        self.raw = [b""] * (max(vocab.values(), default=-1) + 1 + len(special))
        for t, i in vocab.items():
            self.raw[i] = bytes(byte[c] for c in t)
        merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["model"]["merges"]]
        plain = (model.get("normalizer") is None and (model.get("pre_tokenizer") or {}) == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
        in_order = all(i is not None for i in merged) and all(a < b for a, b in zip(merged, merged[1:]))
        self.fast = None
        if plain and in_order and all(b"%c" % b in set(self.raw) for b in range(256)):
            self.fast = tiktoken.Encoding("a", pat_str=WORDS, special_tokens={},
                                          mergeable_ranks={self.raw[i]: i for i in vocab.values()})
        self.long_word = regex.compile(r"\S{2000}|\s{2000}")

    def slow(self, texts: list[str]) -> list[list[int]]:
        if self.own is None:
            self.own = Tokenizer.from_str(self.content)
            self.own.encode_special_tokens = True
        return [self.own.encode(t, add_special_tokens=False).ids for t in texts]

    def encode(self, text: str) -> list[int]:
        if self.fast is None or self.long_word.search(text):
            return self.slow([text])[0]
        return self.fast.encode_ordinary(text)


class PieceBPE:
    """Tokenizer B, which puts the space before the text itself."""

    def __init__(self, content: bytes):
        self.m = sp.SentencePieceProcessor(model_proto=content)
        n = self.m.vocab_size()
        self.raw = [b""] * n
        for i in range(n):
            piece = self.m.id_to_piece(i)
            if self.m.is_byte(i):
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (self.m.is_control(i) or self.m.is_unknown(i)):
                self.raw[i] = piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.m.encode(texts, num_threads=1)


def starts(end_a: np.ndarray, end_b: np.ndarray, lane: int) -> list[tuple[int, int]]:
    """(first A token, first B token) of the parts of one document: its beginning and,
    about every ``lane`` tokens, the place after the next common end."""
    out, at = [(0, 0)], lane
    while at < len(end_a):
        near = end_a[at - 1:at + 255]
        j = np.searchsorted(end_b, near)
        hit = np.nonzero(end_b[np.minimum(j, len(end_b) - 1)] == near)[0]
        if not len(hit):
            at += 256
            continue
        a, b = at + int(hit[0]), int(j[hit[0]]) + 1
        if a >= len(end_a):
            break
        out.append((a, b))
        at = a + lane
    return out


def lockstep(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray,
             stop_a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) and cuts (last A token, last B token of a group) of all
    lanes, as places in the flat arrays of token ends."""
    a, b, stop = first_a.copy(), first_b.copy(), stop_a
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        ea, eb = end_a[a], end_b[b]
        links_a.append(a), links_b.append(b)
        both = ea == eb
        cuts_a.append(a[both]), cuts_b.append(b[both])
        a, b = a + (ea <= eb), b + (eb <= ea)
        open_ = a < stop  # A and B end a lane together
        if not open_.all():
            a, b, stop = a[open_], b[open_], stop[open_]
    none = np.empty(0, np.int64)
    return tuple(np.concatenate(x) if x else none for x in (links_a, links_b, cuts_a, cuts_b))


class Aligned:
    """The tokens, links and cuts of a list of texts, flat, with offsets per text."""

    def __init__(self, aligner: Aligner, texts: list[str | None], lane: int):
        a_ids, b_ids = aligner.tokens(texts)
        self.n_a = np.array([len(x) for x in a_ids], np.int64)
        self.n_b = np.array([len(x) for x in b_ids], np.int64)
        self.at_a, self.at_b = (np.concatenate([[0], np.cumsum(n)]) for n in (self.n_a, self.n_b))
        self.a = np.fromiter((i for x in a_ids for i in x), np.int64, int(self.at_a[-1]))
        self.b = np.fromiter((i for x in b_ids for i in x), np.int64, int(self.at_b[-1]))
        end_a, end_b = np.cumsum(aligner.len_a[self.a]), np.cumsum(aligner.len_b[self.b])  # over all texts
        first_a, first_b, stop_a = [], [], []
        for d in np.nonzero(self.n_a)[0].tolist():
            a0, a1, b0, b1 = self.at_a[d], self.at_a[d + 1], self.at_b[d], self.at_b[d + 1]
            parts = starts(end_a[a0:a1], end_b[b0:b1], lane) if a1 - a0 > lane else [(0, 0)]
            first_a += [a0 + x for x, _ in parts]
            first_b += [b0 + y for _, y in parts]
            stop_a += [a0 + x for x, _ in parts[1:]] + [a1]
        self.link_a, self.link_b, self.cut_a, self.cut_b = lockstep(
            end_a, end_b, *(np.array(x, np.int64) for x in (first_a, first_b, stop_a)))
        self.doc_of_a = np.repeat(np.arange(len(texts)), self.n_a)
        n = len(texts)
        self.n_groups = np.bincount(self.doc_of_a[self.cut_a], minlength=n)
        self.n_links = np.bincount(self.doc_of_a[self.link_a], minlength=n)

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """The group of each A and of each B token, counted over all texts."""
        out = []
        for cuts, n in ((self.cut_a, len(self.a)), (self.cut_b, len(self.b))):
            last = np.zeros(n + 1, np.int64)
            last[cuts + 1] = 1
            out.append(np.cumsum(last)[:-1])
        return out[0], out[1]


class Aligner:
    """The two tokenizers and their tables."""

    def __init__(self, a: str, b: bytes):
        self.a, self.b = ByteBPE(a), PieceBPE(b)
        self.len_a = np.array([len(x) for x in self.a.raw], np.int64)
        self.len_b = np.array([len(x) for x in self.b.raw], np.int64)
        most = max(len(self.len_a), len(self.len_b))
        #: a token's number followed by each separator, at 4 * id + separator
        self.written = [f"{i}{mark}" for i in range(most) for mark in (",", "|", ";", "")]

    def tokens(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B; none for texts whose bytes either does not give back."""
        out_a, out_b = [], []
        raw_a, raw_b = self.a.raw.__getitem__, self.b.raw.__getitem__
        for t, b in zip(texts, self.b.encode([t or "" for t in texts])):
            a: list[int] = []
            if t:
                whole = " " + t
                a = self.a.encode(whole)
                data = whole.encode("utf-8", "surrogatepass")
                if b"".join(map(raw_b, b)) != data or b"".join(map(raw_a, a)) != data:
                    a, b = [], []
            out_a.append(a), out_b.append(b if t else [])
        return out_a, out_b

    def align(self, texts: list[str | None], lane: int = 1024) -> Aligned:
        return Aligned(self, texts, lane)

    def digests(self, x: Aligned) -> list[str]:
        """SHA-256 of each text's groups, written as ``a1,a2|b1;a3|b2,b3``."""
        ga, gb = x.groups()
        n = len(x.cut_a)
        in_a, in_b = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
        before_a, before_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        # place of each token in the written order: a group's A tokens, then its B tokens
        place_a = np.arange(len(ga)) + (before_b[ga] if n else 0)
        place_b = np.arange(len(gb)) + (before_a[gb] + in_a[gb] if n else 0)
        code = np.zeros(len(ga) + len(gb), np.int64)
        code[place_a], code[place_b] = 4 * x.a, 4 * x.b
        code[place_a[x.cut_a]] += 1
        code[place_b[x.cut_b]] += 2
        words = list(map(self.written.__getitem__, code.tolist()))
        out, at = [], 0
        for k in (x.n_a + x.n_b).tolist():
            out.append(hashlib.sha256("".join(words[at:at + k])[:-1].encode()).hexdigest() if k else "")
            at += k
        return out


_aligners: dict[int, Aligner] = {}


def aligner(a: str, b: bytes) -> Aligner:
    """One pair of tokenizers for each worker process."""
    key = hash((a, b))
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(a, b)
    return _aligners[key]


def _files(spark, a_file: str, b_file: str) -> tuple[str, bytes]:
    """The two vocabularies (about 2 MB), read once by the driver and sent with the tasks."""
    with open(a_file, encoding="utf-8") as a, open(b_file, "rb") as b:
        return a.read(), b.read()


def align(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, lane: int = 1024) -> DataFrame:
    """``doc_id, a_ids, b_ids``, ``a_ends`` and ``b_ends`` (tokens of A and B up to the end of
    each group), ``link_a`` and ``link_b`` (the linked tokens' places, in order)."""
    files = _files(docs.sparkSession, a_file, b_file)
    names = ["a_ids", "b_ids", "a_ends", "b_ends", "link_a", "link_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(*files)
        for batch in slices(batches, "text", 1 << 20):
            x = both.align(batch.column("text").to_pylist(), lane)
            order = np.lexsort((x.link_b, x.link_a))
            la, lb = x.link_a[order], x.link_b[order]
            ca, cb = np.sort(x.cut_a), np.sort(x.cut_b)
            of_link, of_cut = x.doc_of_a[la], x.doc_of_a[ca]
            offsets = {"a_ids": x.at_a, "b_ids": x.at_b,
                       "ends": np.concatenate([[0], np.cumsum(x.n_groups)]), "links": np.concatenate([[0], np.cumsum(x.n_links)])}
            values = [(x.a, "a_ids"), (x.b, "b_ids"), (ca + 1 - x.at_a[of_cut], "ends"), (cb + 1 - x.at_b[of_cut], "ends"),
                      (la - x.at_a[of_link], "links"), (lb - x.at_b[of_link], "links")]
            lists = [pa.ListArray.from_arrays(pa.array(offsets[o].astype(np.int32)), pa.array(v.astype(np.int32)))
                     for v, o in values]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], names=["doc_id", *names])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                     "doc_id long, " + ", ".join(f"{n} array<int>" for n in names))


_PACKED = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "codes binary, counts binary")


def _pack(values: np.ndarray) -> bytes:
    return zstandard.compress(values.astype(np.int64 if values.max(initial=0) >= 1 << 31 else np.int32).tobytes() +
                              (b"\1" if values.max(initial=0) >= 1 << 31 else b"\0"), 3)


def _unpack(data: bytes) -> np.ndarray:
    raw = zstandard.decompress(data)
    return np.frombuffer(raw, np.int64 if raw[-1] else np.int32, count=(len(raw) - 1) // (8 if raw[-1] else 4)).astype(np.int64)


def link_statistics(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, lane: int = 1024,
                    links_per_block: int = 8 << 20) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``n_best``: the document's links whose pair is linked, in the whole corpus, as often
    as any pair of its B id; ``count_sum``: the sum of its links' corpus-wide counts."""
    files = _files(docs.sparkSession, a_file, b_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(*files)
        wide = len(both.len_b)
        # a retried task gives its blocks the same numbers, and only one attempt's rows are kept
        block, none = TaskContext.get().partitionId() << 32, np.empty(0, np.int64)
        codes, counts, held = none, none, 0
        fresh: list[tuple[np.ndarray, np.ndarray]] = []  # pairs and numbers not yet added to the block's

        def rows(cols: list) -> pa.RecordBatch:
            types = (pa.int64(),) * 6 + (pa.string(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              names=[f.split()[0] for f in _PACKED.split(", ")])

        def add() -> None:
            nonlocal codes, counts
            every = np.concatenate([codes, *[c for c, _ in fresh]])
            codes, place = np.unique(every, return_inverse=True)
            n = np.concatenate([counts, *[n for _, n in fresh]])
            counts = np.bincount(place, n, len(codes)).astype(np.int64)  # exact below 2^53
            fresh.clear()

        def closed() -> pa.RecordBatch:
            add()
            return rows([[block], [None], *[[None]] * 5, [_pack(np.diff(codes, prepend=0))], [_pack(counts)]])

        for batch in slices(batches, "text", 1 << 20):
            x = both.align(batch.column("text").to_pylist(), lane)
            key, n = np.unique(x.doc_of_a[x.link_a] << 32 | (x.a[x.link_a] * wide + x.b[x.link_b]), return_counts=True)
            own = key & 0xFFFFFFFF
            at = np.searchsorted(key >> 32, np.arange(batch.num_rows + 1))
            packed = [(_pack(np.diff(own[i:j], prepend=0)), _pack(n[i:j])) for i, j in zip(at, at[1:])]
            yield rows([[block] * batch.num_rows, batch.column("doc_id"), x.n_a, x.n_b, x.n_groups, x.n_links,
                        both.digests(x), [p for p, _ in packed], [p for _, p in packed]])
            fresh.append((own, n))
            held += len(x.link_a)
            if sum(len(c) for c, _ in fresh) > 1 << 20:
                add()
            if held >= links_per_block:
                yield closed()
                block, codes, counts, held = block + 1, none, none, 0
        if held:
            yield closed()

    packed = materialize(arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _PACKED),
                         "al-blocks")
    wide = len(PieceBPE(files[1]).raw)

    def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, codes, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "codes", "counts"))):
                c, n = np.cumsum(_unpack(codes)), _unpack(counts)
                for i in range(0, len(c), 1 << 16):
                    part = slice(i, i + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c[part]), block)), pa.array(c[part]), pa.array(n[part])],
                                                     names=["block", "code", "n"])

    pairs = arrow_map(packed.where("n_a IS NULL").select("block", "codes", "counts"), pairs_of, "block long, code long, n long")
    totals = pairs.groupBy("code").agg(F.sum("n").alias("total")).withColumn("b", F.col("code") % wide)
    totals = materialize(totals, "al-totals")
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    totals = totals.join(most, "b").select("code", "total", (F.col("total") == F.col("most")).alias("best"))
    known = pairs.select("block", "code").join(totals, "code").select("block", "code", "total", "best")

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        code = right.column("code").to_numpy()
        order = np.argsort(code)
        code, total, best = code[order], right.column("total").to_numpy()[order], right.column("best").to_numpy()[order]
        n_best, sums = [], []
        for c, n in zip(left.column("codes").to_pylist(), left.column("counts").to_pylist()):
            at, n = np.searchsorted(code, np.cumsum(_unpack(c))), _unpack(n)
            n_best.append(int(n[best[at]].sum()))
            sums.append(int((n * total[at]).sum()))
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
        return pa.table([left.column(c) for c in names] + [pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()),
                                                           left.column("groups_sha256")],
                        names=[*names, "n_best", "count_sum", "groups_sha256"])

    docs_of = packed.where("n_a IS NOT NULL")
    return docs_of.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        add_up, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
