"""SentencePiece encoding and decoding by Aho-Corasick and Viterbi.

The pieces of a model file form one Aho-Corasick automaton. A text is read once:
at each position the automaton, following its output links, reports every piece
that ends there, and each relaxes the best score of the position it leads to.
Characters that no piece covers become byte pieces, so decoding gives back the
exact text.

No piece of a usable model holds a space mark after another character, so best
paths never cross the start of a word: words are solved one by one and kept in a
bounded memory per task.

The model's own normaliser is not applied (every text comes back exactly), and a
split is the one of the highest sum of scores, so ids differ from those of an encoder
that merges pairs of a BPE model in order.

Defined cases: a null text has no ids (null) and decodes to null; an empty text
has none; a text's own U+2581 is written in byte pieces; of equal scores the
path with the longer last piece wins; repeated rows get equal results; further
columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import arrow_map, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"


def load_pieces(path: str = MODEL) -> list[tuple[str, float, int]]:
    """(piece, score, kind) by id; kind 0 ordinary, 1 byte, 2 not for texts."""
    import sentencepiece as sp

    m = sp.SentencePieceProcessor(model_file=path)
    kind = [1 if m.is_byte(i) else 2 if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) else 0
            for i in range(m.vocab_size())]
    return [(m.id_to_piece(i), m.get_score(i), kind[i]) for i in range(m.vocab_size())]


class Codec:
    """Encoder and decoder over one vocabulary with a complete set of byte pieces."""

    def __init__(self, pieces: list[tuple[str, float, int]], remember: int = 45_000):
        self.byte_id = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == 1}
        if len(self.byte_id) != 256:
            raise ValueError("the model has no complete byte pieces")
        if not any(p == SPACE and k == 0 for p, _, k in pieces):
            raise ValueError("the model has no piece for a single space")
        self.automaton = ahocorasick.Automaton()
        lowest = 0.0
        for i, (p, score, k) in enumerate(pieces):
            if k == 0 and p:
                self.automaton.add_word(p, (len(p), score, i))
                lowest = min(lowest, score)
        self.automaton.make_automaton()
        self.unknown = lowest - 10.0
        self.lost = (1, self.unknown, -1)  # a character that no piece covers
        self.raw = [bytes([int(p[3:5], 16)]) if k == 1 else b"" if k == 2 else p.replace(SPACE, " ").encode()
                    for p, _, k in pieces]
        ordinary = [p for p, _, k in pieces if k == 0]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in ordinary):
            self.units = re.compile(r"(?s).+")
        elif any("\n" in p and len(p) > 1 for p in ordinary):
            self.units = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        else:
            self.units = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        self.memory: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.remember = remember

    def best_path(self, unit: str) -> tuple[int, ...]:
        """Ids of the highest-scoring split of ``unit``, in one pass."""
        n = len(unit)
        best, back = [float("-inf")] * (n + 1), [self.lost] * (n + 1)
        best[0], done = 0.0, 0
        unknown, lost = self.unknown, self.lost
        for last, entry in self.automaton.iter(unit):  # entries: (length, score, piece)
            while done < last:  # positions that no piece has reached yet
                done += 1
                if best[done - 1] + unknown > best[done]:
                    best[done], back[done] = best[done - 1] + unknown, lost
            value = best[last + 1 - entry[0]] + entry[1]
            if value > best[last + 1]:  # longer pieces are reported first
                best[last + 1], back[last + 1] = value, entry
        while done < n:
            done += 1
            if best[done - 1] + unknown > best[done]:
                best[done], back[done] = best[done - 1] + unknown, lost
        ids: list[int] = []
        at = n
        while at:
            length, _, piece = back[at]
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(self.byte_id[b] for b in reversed(unit[at - 1].encode("utf-8", "surrogatepass")))
            at -= length
        return tuple(reversed(ids))

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if SPACE in text:  # the text's own marks are no spaces: write them in bytes
            mark = [self.byte_id[b] for b in SPACE.encode()]
            parts = text.split(SPACE)
            ids = self._encode(SPACE + parts[0].replace(" ", SPACE))
            for part in parts[1:]:
                ids += mark + self._encode(part.replace(" ", SPACE))
            return ids
        return self._encode(SPACE + text.replace(" ", SPACE))

    def _encode(self, marked: str) -> list[int]:
        memory, units = self.memory, self.units.findall(marked)
        found = list(map(memory.get, units))
        for at in [i for i, path in enumerate(found) if path is None]:
            unit = units[at]
            path = memory.get(unit) or self.older.get(unit) or self.best_path(unit)
            if len(unit) <= 64:
                if len(memory) >= self.remember:  # the older half goes, units still met come back
                    self.older, self.memory = memory, {}
                    memory = self.memory
                memory[unit] = path
            found[at] = path
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> str:
        raw = self.raw
        data = b"".join([raw[i] for i in ids])
        return data[1:].decode("utf-8", "surrogatepass") if data else ""


_codecs: dict[int, Codec] = {}


def _codec(pieces: list[tuple[str, float, int]]) -> Codec:
    key = hash(tuple(pieces))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(pieces)
    return _codecs[key]


def _lists(rows: list[list[int] | None]) -> pa.Array:
    """int32 lists from Python lists without a Python object per list in Arrow."""
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) if r is not None else 0 for r in rows], out=offsets[1:])
    flat = np.empty(offsets[-1], np.int32)
    for r, at in zip(rows, offsets):
        if r:
            flat[at:at + len(r)] = r
    missing = pa.array([r is None for r in rows], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=missing)


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``docs`` with ``sp_ids`` (array of int), ``sp_tokens`` (their number) and
    ``sp_exact`` (whether decoding the ids gave back the text)."""
    pieces = load_pieces(path)
    added = [("sp_ids", T.ArrayType(T.IntegerType())), ("sp_tokens", T.LongType()), ("sp_exact", T.BooleanType())]
    kept = [f for f in docs.schema.fields if f.name not in dict(added)]
    schema = T.StructType(kept + [T.StructField(n, t) for n, t in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(pieces)
        for batch in slices(batches, "text", 2 << 20):
            texts = batch.column("text").to_pylist()
            ids = [None if t is None else codec.encode(t) for t in texts]
            exact = [None if t is None else codec.decode(i) == t for t, i in zip(texts, ids)]
            cols = [_lists(ids), pa.array([0 if i is None else len(i) for i in ids], pa.int64()),
                    pa.array(exact, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + cols,
                                             names=[f.name for f in kept] + [n for n, _ in added])

    return arrow_map(docs.select(*[f"`{f.name}`" for f in kept]), run, schema)


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``encoded(sp_ids, ...)`` with ``sp_text``, the text of the ids."""
    pieces = load_pieces(path)
    kept = [f for f in encoded.schema.fields if f.name != "sp_text"]
    schema = T.StructType(kept + [T.StructField("sp_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(pieces)
        for batch in batches:
            texts = [None if i is None else codec.decode(i) for i in batch.column("sp_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(texts, pa.string())],
                                             names=[f.name for f in kept] + ["sp_text"])

    return arrow_map(encoded.select(*[f"`{f.name}`" for f in kept]), run, schema)
