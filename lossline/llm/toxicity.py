"""Toxicity by a subsequence string-kernel machine with Nyström landmarks.

The kernel compares strings by the three-letter subsequences they share, each
counted as ``decay`` to the power of its span, so ``i.d.i.o.t`` or ``idiiot`` stay
near ``idiot``. Strings are pieces of a text's sentences: words (marks around them,
letters without accents, letters of other scripts as one of 34 symbols each, other
characters as two symbols) and pairs of neighbouring words; longer ones in
overlapping windows; single letters set apart by spaces are also read as one.

Training is by instances of the labelled texts' sentences: words, and pairs of words
neither of which is one of these, whose places in toxic texts are far more (and more
varied) than their share are positive instances, other words and pairs negative
ones. Pairs are looked at when scoring if some are positive instances. The kernel values to the landmarks, whitened by the landmarks' own kernel matrix
(Nyström), are the features of a linear machine with squared hinge loss; the
best-scoring negatives of the training texts are added and it is trained again.
A text's value is that of its worst word, calibrated by logistic regression on
the labelled texts.

A trained machine is a sum of kernels to landmarks, that is a table of one
number for each three-letter subsequence; scoring adds the table's values over
the subsequences of a word, which is the same number.

Defined cases: a null or empty text, or one without words, gets the lowest
score; without both classes to learn from all scores are 0; several labels of
one document count as toxic if any is; repeated rows get equal results; further
columns are kept.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hashed_below, materialize, slices

SIZE, SPAN, WINDOW, STEP = 64, 7, 24, 12
_FOREIGN, _KINDS = 30, 34  # symbols of letters outside a-z
_SPACED = re.compile(r"(?<!\S)(?:\S\s){2,}\S(?!\S)")
_LETTERS = {chr(97 + i): i + 1 for i in range(26)}


def words(text: str) -> set[str]:
    low = text.lower()
    out = set(low.split())
    for m in _SPACED.finditer(low):
        out.add("".join(m.group().split()))
    return out


def phrases(text: str) -> set[str]:
    """The pairs of neighbouring words of a text."""
    t = text.lower().split()
    return {f"{a} {b}" for a, b in zip(t, t[1:])}


@lru_cache(maxsize=4096)
def _symbol(c: str) -> tuple[int, ...]:
    plain = [_LETTERS.get(x) or _FOREIGN + (ord(x) * 0x9E3779B1 >> 12) % _KINDS
             for x in unicodedata.normalize("NFKD", c).lower() if x in _LETTERS or x.isalpha()]
    if plain:
        return tuple(plain)
    return (27,) if c.isalnum() else (28,)


def codes(word: str) -> list[int]:
    """Symbols of a word between the marks 0 and 29, without punctuation at its ends."""
    out = [0]
    for c in word.strip(".,;:!?\"'()[]{}|*-_"):
        i = _LETTERS.get(c)
        if i is not None:
            out.append(i)
        else:
            out.extend(_symbol(c))
    out.append(29)
    return out


def windows(word: str) -> list[list[int]]:
    """Readings of a word: as it stands and, if it has other symbols, its letters alone;
    long ones in overlapping windows."""
    c = codes(word)
    readings = [c]
    if not word.isalpha() and (27 in c or 28 in c):
        letters = [x for x in c if x not in (27, 28)]
        if len(letters) > 4:
            readings.append(letters)
    return [r[i:i + WINDOW] for r in readings for i in range(0, max(1, len(r) - WINDOW + STEP), STEP)]


def inserted(word: str, seed: int) -> str:
    """The word with one letter put in, as a training example of a disguised word."""
    at = 1 + seed % max(1, len(word) - 1)
    return word[:at] + chr(97 + (seed * 7 + len(word)) % 26) + word[at:]


_known_triples: dict[tuple[int, float], tuple] = {}


def _triples(n: int, decay: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """Places, weights and norm of the subsequences of a string of n symbols (n <= WINDOW)."""
    if (n, decay) not in _known_triples:
        _known_triples[n, decay] = _make_triples(n, decay)
    return _known_triples[n, decay]


def _make_triples(n: int, decay: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    t = [(i, j, k) for i in range(n) for k in range(i + 2, min(n, i + SPAN)) for j in range(i + 1, k)]
    a = np.array(t, np.int64).reshape(-1, 3)
    w = decay ** (a[:, 2] - a[:, 0] + 1).astype(float)
    return a[:, 0], a[:, 1], a[:, 2], w.astype(np.float32), float(np.sqrt((w * w).sum())) or 1.0


class Values:
    """The worst value of words under a table of subsequence values."""

    def __init__(self, table: np.ndarray, bias: float, decay: float, remember: int = 200_000):
        self.table, self.bias, self.decay = table.astype(np.float32), bias, decay
        self.memory: dict[str, float] = {}
        self.remember = remember

    def of(self, new: list[str]) -> None:
        """Adds the values of words not yet known to the memory."""
        by_len: dict[int, tuple[list[int], list[list[int]]]] = {}
        for i, w in enumerate(new):
            for c in windows(w):
                at, rows = by_len.setdefault(len(c), ([], []))
                at.append(i), rows.append(c)
        worst = np.full(len(new), self.bias, np.float32)
        for n, (at, rows) in by_len.items():
            if n < 3:
                continue
            i, j, k, w, norm = _triples(n, self.decay)
            step = max(1, (1 << 20) // len(w))
            for b in range(0, len(rows), step):
                c = np.array(rows[b:b + step], np.int32)
                v = (self.table[c[:, i] * (SIZE * SIZE) + c[:, j] * SIZE + c[:, k]] @ w) / norm + self.bias
                np.maximum.at(worst, at[b:b + step], v)
        self.memory.update(zip(new, worst.tolist()))

    def texts(self, found: list[set[str]]) -> list[float]:
        """The worst value of each text's words; the empty text has the bias."""
        if len(self.memory) > self.remember:
            self.memory.clear()
        for at in range(0, len(found), 64):
            new = set().union(*found[at:at + 64])
            new.difference_update(self.memory)
            if new:
                self.of(list(new))
        get = self.memory.__getitem__
        return [max(map(get, f), default=self.bias) for f in found]


def _features(strings: list[list[int]], decay: float) -> dict:
    """Sparse (row, subsequence, value) arrays of scaled feature vectors."""
    rows, cols, vals = [], [], []
    for r, c in enumerate(strings):
        if len(c) < 3:
            continue
        i, j, k, w, norm = _triples(len(c), decay)
        a = np.array(c, np.int64)
        u, inv = np.unique(a[i] * (SIZE * SIZE) + a[j] * SIZE + a[k], return_inverse=True)
        rows.append(np.full(len(u), r)), cols.append(u), vals.append(np.bincount(inv, w) / norm)
    cat = lambda x: np.concatenate(x) if x else np.empty(0)
    return {"row": cat(rows).astype(int), "col": cat(cols).astype(int), "val": cat(vals), "n": len(strings)}


def kernel(a: list[list[int]], b: list[list[int]], decay: float) -> np.ndarray:
    """Kernel values between two lists of strings."""
    fa, fb = _features(a, decay), _features(b, decay)
    seen, at = np.unique(fb["col"], return_inverse=True)  # subsequences of b: rows of a dense matrix, and one of zeros
    dense = np.zeros((len(seen) + 1, len(b)))
    dense[at, fb["row"]] = fb["val"]
    place = np.searchsorted(seen, fa["col"])
    place[(place == len(seen)) | (seen[np.minimum(place, len(seen) - 1)] != fa["col"])] = len(seen)
    out = np.zeros((len(a), len(b)))
    cuts = np.searchsorted(fa["row"], np.arange(len(a) + 1))
    for r in range(len(a)):
        s = slice(cuts[r], cuts[r + 1])
        out[r] = fa["val"][s] @ dense[place[s]]
    return out


def train_machine(positive: list[str], negative: list[str], landmarks: int, decay: float, cost: float) -> tuple[np.ndarray, float]:
    """Table and bias of the machine. Negatives weigh three times as much in total: a
    text has many words. Landmarks are the first positives and the last negatives."""
    pos, neg = [codes(w)[:WINDOW] for w in positive], [codes(w)[:WINDOW] for w in negative]
    pos += [codes(inserted(w, i))[:WINDOW] for i, w in enumerate(positive) if len(w) >= 5]
    z = pos[:landmarks // 2] + neg[-(landmarks // 2):]
    kz = kernel(z, z, decay)
    value, vector = np.linalg.eigh(kz)
    good = value > 1e-6 * value.max()
    white = vector[:, good] / np.sqrt(value[good])
    x = kernel(pos + neg, z, decay) @ white
    y = np.r_[np.ones(len(pos)), -np.ones(len(neg))]
    c = np.where(y > 0, 0.25 / len(pos), 0.75 / len(neg)) * cost
    x1 = np.c_[x, np.ones(len(x))]
    w = np.zeros(x1.shape[1])
    reg = np.r_[np.ones(x.shape[1]), 1e-3]
    for _ in range(40):  # Newton steps of the squared hinge loss
        active = y * (x1 @ w) < 1
        a = x1[active]
        h = np.diag(reg) + 2 * a.T @ (a * c[active][:, None])
        step = np.linalg.solve(h, reg * w - 2 * a.T @ (c[active] * (y[active] - a @ w)))
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    beta = white @ w[:-1]
    f = _features(z, decay)
    table = np.zeros(SIZE ** 3)
    np.add.at(table, f["col"], f["val"] * beta[f["row"]])
    return table, float(w[-1])


def _logistic(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of P(toxic) over the machine's values (Newton)."""
    x, w = np.c_[f, np.ones(len(f))], np.array([1.0, 0.0])
    t = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y <= 0).sum() + 2))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - t) + 1e-3 * w
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + 1e-3 * np.eye(2), g)
        size = np.abs(step).max()
        w = w - step * min(1.0, 5.0 / size if size else 1.0)
        if size < 1e-9:
            break
    return float(w[0]), float(w[1])


def training(docs: DataFrame, labels: DataFrame, max_docs: int = 20_000) -> DataFrame:
    """``text, toxic`` of about ``max_docs`` hash-chosen labelled documents.

    The chosen labels are no more than that, so they are broadcast and texts are
    not shuffled. Several labels of one document count as toxic if any is."""
    labels = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
              .agg(F.max("toxic").cast("int").alias("toxic")))
    share = min(1.0, max_docs / max(1, labels.count()))
    chosen = labels.where(hashed_below(F.col("doc_id"), share))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text IS NOT NULL")
            .select("text", "toxic"))


def fit(train: DataFrame, max_positive: int = 600, max_negative: int = 3_000, landmarks: int = 384,
        decay: float = 0.6, cost: float = 20_000.0, least_excess: float = 4.0, rounds: int = 4) -> dict | None:
    """Model from bounded ``train(text, toxic)`` (see ``training``); None without both classes.

    The driver holds ``max_positive`` and ``max_negative`` words and one number for
    each training text.
    """
    train = materialize(train.where("toxic IS NOT NULL AND text IS NOT NULL")
                        .select(F.col("toxic").cast("int").alias("toxic"), "text"), "tox-train")
    kinds = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not kinds.get(0) or not kinds.get(1):
        return None

    def list_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "text"):
                seen = (Counter(), Counter())
                for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                    seen[toxic].update(words(text))
                w = list(set(seen[0]) | set(seen[1]))
                yield pa.RecordBatch.from_arrays([pa.array(w), pa.array([seen[1][x] for x in w], pa.int64()),
                                                  pa.array([seen[0][x] for x in w], pa.int64())], names=["w", "p", "n"])

    stats = materialize(train.mapInArrow(list_words, "w string, p long, n long").groupBy("w")
                        .agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
                        .withColumn("e", (F.col("n") + 0.5) * kinds[1] / kinds[0])
                        .withColumn("z", (F.col("p") - F.col("e")) / F.sqrt(F.col("e") + 1)), "tox-words")
    candidates = [r["w"] for r in stats.where((F.col("p") >= 2) & (F.col("z") >= 1.0) & (F.length("w") >= 3)).orderBy(F.col("z").desc(), "w")
                  .limit(4 * max_positive).collect()]
    wanted = set(candidates)

    # copies repeat a word with the same neighbours: count varied neighbours instead
    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "text"):
                rows = set()
                for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                    t = text.lower().split()
                    for i, w in enumerate(t):
                        if w in wanted:
                            rows.add((w, toxic, f"{t[i - 1] if i else ''} {t[i + 1] if i + 1 < len(t) else ''}"))
                cols = list(zip(*rows)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()),
                                                  pa.array(cols[2], pa.string())], names=["w", "toxic", "near"])

    varied = (train.mapInArrow(neighbours, "w string, toxic int, near string").distinct().groupBy("w", "toxic")
              .agg(F.count("*").alias("c")).groupBy("w")
              .agg(F.coalesce(F.sum(F.when(F.col("toxic") == 1, F.col("c"))), F.lit(0)).alias("p"),
                   F.coalesce(F.sum(F.when(F.col("toxic") == 0, F.col("c"))), F.lit(0)).alias("n")))
    e = (F.col("n") + 0.5) * kinds[1] / kinds[0]
    rows = varied.withColumn("z", (F.col("p") - e) / F.sqrt(e + 1)).where((F.col("p") >= 2) & (F.col("n") * 5 < F.col("p"))).orderBy(
        F.col("z").desc(), "w").collect()
    positive = [r["w"] for r in rows if r["z"] >= least_excess][:max_positive]
    pairs, plain_pairs = _phrase_instances(train, set(positive), kinds[1] / kinds[0], max_positive - len(positive), max_negative,
                                           least_excess)
    if not positive and not pairs:
        return None
    other = stats.where((F.col("n") > 0) & (F.length("w") >= 3))
    negative = [r["w"] for r in other.orderBy(F.xxhash64("w"), "w").limit(max_negative // 2).collect()]
    known = set(positive)
    negative = [w for w in negative if w not in known]
    positive = pairs + positive
    negative = plain_pairs + negative
    for again in range(rounds):
        table, bias = train_machine(positive, negative, landmarks, decay, cost)
        model = {"table": table.astype(np.float32), "bias": bias, "decay": decay, "pairs": bool(pairs)}
        if again < rounds - 1:  # the worst words that are not typical of toxic texts join the negatives
            taken = known | set(negative)
            hard = (_word_values(other.where("z < 1").select("w"), model).where("v > -0.5")
                    .orderBy(F.col("v").desc(), "w").limit(max_negative // 2).collect())
            if pairs:
                hard += (_word_values(_plain_pairs(train), model).where("v > -0.5")
                         .orderBy(F.col("v").desc(), "w").limit(max_negative // 2).collect())
                taken |= set(pairs)
            fresh = [r["w"] for r in hard if r["w"] not in taken][:max_negative // 4]
            negative += reversed(fresh)
            if not fresh:
                break
    known_values = score(train, {**model, "slope": 1.0, "shift": 0.0}).select("tox_value", "toxic").collect()
    model["slope"], model["shift"] = _logistic(*(np.array([r[i] for r in known_values]) for i in (0, 1)))
    model["landmarks"] = positive[:landmarks // 2]
    return model


def _plain_pairs(train: DataFrame, share: int = 32) -> DataFrame:
    """``w``: a hash-chosen part of the word pairs of texts that are not toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "text"):
                found = set()
                for text in batch.column("text").to_pylist():
                    found |= {p for p in phrases(text) if xxhash.xxh32_intdigest(p) % share == 0}
                yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["w"])

    return train.where("toxic = 0").select("text").mapInArrow(run, "w string").distinct()


def _phrase_instances(train: DataFrame, words_found: set[str], odds: float, most: int, max_negative: int,
                      least_excess: float, varied: int = 5) -> tuple[list[str], list[str]]:
    """(positive pairs, negative pairs): pairs of words, neither of them a positive
    instance, that stand in toxic texts between ``varied`` different words on either
    side at least, and far more often there than their share."""
    if most <= 0:
        return [], []

    def places(wanted: set[str] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices([whole], "text"):
                    rows = set()
                    for text in batch.column("text").to_pylist():
                        t = ["", *text.lower().split(), ""]
                        for before, a, b, after in zip(t, t[1:], t[2:], t[3:]):
                            pair = f"{a} {b}"
                            if pair in wanted if wanted is not None else a not in words_found and b not in words_found:
                                rows.add((pair, before, after))
                    cols = list(zip(*rows)) or [(), (), ()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["w", "before", "after"])
        return run

    schema = "w string, before string, after string"
    seen = (train.where("toxic = 1").select("text").mapInArrow(places(None), schema).distinct().groupBy("w")
            .agg(F.count("*").alias("p"), F.count_distinct("before").alias("b"), F.count_distinct("after").alias("a"))
            .where((F.col("b") >= varied) & (F.col("a") >= varied)).orderBy(F.col("p").desc(), "w").limit(4 * most).collect())
    if not seen:
        return [], []
    also = {r["w"]: r["n"] for r in train.where("toxic = 0").select("text").mapInArrow(places({r["w"] for r in seen}), schema)
            .distinct().groupBy("w").agg(F.count("*").alias("n")).collect()}
    scored = []
    for r in seen:
        n = also.get(r["w"], 0)
        e = (n + 0.5) * odds
        scored.append(((r["p"] - e) / (e + 1) ** 0.5, r["w"], n * 5 < r["p"]))
    positive = [w for z, w, typical in sorted(scored, key=lambda x: (-x[0], x[1])) if z >= least_excess and typical][:most]
    if not positive:
        return [], []
    known = set(positive)
    plain = _plain_pairs(train).orderBy(F.xxhash64("w"), "w").limit(max_negative // 2).collect()
    return positive, [r["w"] for r in plain if r["w"] not in known]


def _word_values(found: DataFrame, model: dict) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = Values(model["table"], model["bias"], model["decay"])
        for batch in batches:
            w = batch.column("w").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("w"), pa.array(values.texts([{x} for x in w]), pa.float64())],
                                             names=["w", "v"])

    return found.mapInArrow(run, "w string, v double")


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """``docs`` with ``tox_score`` (0 to 1), ``tox_value`` (of the worst word)."""
    added = [("tox_score", T.DoubleType()), ("tox_value", T.DoubleType())]
    kept = [f for f in docs.schema.fields if f.name not in dict(added)]
    schema = T.StructType(kept + [T.StructField(n, t) for n, t in added])
    model = {k: v for k, v in model.items() if k != "landmarks"} if model else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = Values(model["table"], model["bias"], model["decay"]) if model else None
        for whole in batches:
            for batch in slices([whole], "text", 4 << 20):
                if values:
                    found = [words(t) if t else set() for t in batch.column("text").to_pylist()]
                    if model.get("pairs"):
                        found = [f | phrases(t) if t else f for f, t in zip(found, batch.column("text").to_pylist())]
                    v = np.array(values.texts(found), float)
                    s = 1 / (1 + np.exp(-np.clip(model["slope"] * v + model["shift"], -50, 50)))
                else:
                    v = s = np.zeros(batch.num_rows)
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(s), pa.array(v)],
                                                 names=[f.name for f in kept] + [n for n, _ in added])

    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, schema)
