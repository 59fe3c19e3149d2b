"""Language identification by compression.

A text is cut into segments and compressed with one zstandard raw-content
dictionary per language; the language whose dictionary gives the fewest bytes
wins. When the runner-up needs hardly more bytes, the text is rejected.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
is rejected; with no learnable language everything is ``und``; with one
language every text with letters gets it at score 1; ties go to the smaller
language name; repeated rows get equal results; further columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, hashed_below, slices

_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")  # vowel signs and accents belong to their letters


def normalized(text: str | None) -> str:
    """Lower-cased words with single spaces; empty if there is no letter."""
    if not text:
        return ""
    s = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return s if any(c.isalpha() for c in s[:64]) or any(map(str.isalpha, s)) else ""


def fit(train: DataFrame, docs_per_language: int = 400, dictionary_bytes: int = 48 << 10) -> dict[str, bytes]:
    """Dictionary text per language from ``train(text, lang)``.

    Of each language about ``docs_per_language`` hash-chosen distinct texts give a
    segment each, cut at a hash-chosen place of the text; only the segments are
    read to the driver. Copies of a text count once, so a large group of them
    neither fills the driver nor thins out the other texts.
    """
    train = train.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    share = {r["lang"]: min(1.0, docs_per_language / r["n"])
             for r in train.select("lang", F.xxhash64("text").alias("h")).distinct()
             .groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not share:
        return {}
    each = 4 * dictionary_bytes // docs_per_language
    chosen = F.lit(False)
    for lang, s in share.items():
        chosen = chosen | ((F.col("lang") == lang) & hashed_below(F.col("text"), s))
    places = F.greatest(F.length("text") - 2 * each + 1, F.lit(1))
    begin = (F.pmod(F.xxhash64("text", F.lit("place")), places) + 1).cast("int")
    rows = (train.where(chosen).select("lang", F.substr("text", begin, F.lit(2 * each)).alias("text"),
                                       F.xxhash64("text").alias("h"))
            .dropDuplicates(["lang", "h"]).orderBy("lang", "h").collect())
    model: dict[str, list[str]] = {}
    for r in rows:
        model.setdefault(r["lang"], []).append(normalized(r["text"])[:each])
    # zstandard prefers the end of a dictionary: any rows do there, they are hash-ordered
    return {lang: " ".join(p for p in parts if p).encode()[-dictionary_bytes:] for lang, parts in model.items()}


class Classifier:
    """Per-language compressors, a fast and a careful set; texts whose margin in
    the fast one is below ``doubt`` are encoded again by the careful one."""

    def __init__(self, model: dict[str, bytes], fast: int = 3, careful: int = 12, doubt: float = 0.05,
                 segment: int = 2048):
        self.langs = sorted(k for k, v in model.items() if len(v) >= 8)
        self.segment, self.doubt = segment, doubt
        self.coders = [[self._coder(model[lang], level) for lang in self.langs] for level in (fast, careful)]

    @staticmethod
    def _coder(data: bytes, level: int) -> zstandard.ZstdCompressor:
        d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False,
                                        write_dict_id=False)

    def sizes(self, letters: str, careful: bool = False) -> list[int]:
        """Bytes that the whole text takes in each language."""
        data = letters.encode("utf-8", "replace")
        parts = [data[i:i + self.segment] for i in range(0, len(data), self.segment)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.coders[careful]]

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin (share of bytes the runner-up needs more)."""
        letters = normalized(text)
        if not letters or not self.langs:
            return "und", 0.0, 0.0
        if len(self.langs) == 1:
            return self.langs[0], 1.0, 1.0
        for careful in (False, True):
            sizes = self.sizes(letters, careful)
            order = sorted(range(len(sizes)), key=lambda i: (sizes[i], self.langs[i]))
            best, second = sizes[order[0]], sizes[order[1]]
            margin = (second - best) / max(second, 1)
            if margin >= self.doubt:
                break
        scale = 0.02 * best + 1.0
        return self.langs[order[0]], 1.0 / sum(math.exp(-(s - best) / scale) for s in sizes), margin


def identify(docs: DataFrame, model: dict[str, bytes], min_margin: float = 0.002) -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score``, ``lang_margin``, ``lang_rejected``."""
    added = [("lang_pred", T.StringType()), ("lang_score", T.DoubleType()), ("lang_margin", T.DoubleType()),
             ("lang_rejected", T.BooleanType())]
    kept = [f for f in docs.schema.fields if f.name not in dict(added)]
    schema = T.StructType(kept + [T.StructField(n, t) for n, t in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(model)
        for batch in slices(batches, "text", 2 << 20):
            found = [classifier.classify(t) for t in batch.column("text").to_pylist()]
            cols = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.float64()),
                    pa.array([f[0] == "und" or f[2] < min_margin for f in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + cols,
                                             names=[f.name for f in kept] + [n for n, _ in added])

    return arrow_map(docs.select(*[f"`{f.name}`" for f in kept]), run, schema)
