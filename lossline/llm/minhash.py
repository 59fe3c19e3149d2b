"""Near-duplicate documents by MinHash banding, exact verification and
connected components.

A document's set holds its distinct word shingles (words lower-cased in A-Z, cut
at white space). Equal sets are collapsed to one class first. Each class gets
``bands * rows`` universal-hash minima; classes that agree on a band share a
bucket. In each bucket every class is compared with the bucket's most connected
class (signatures first, then the full sets of 64-bit shingle hashes). After a
first round of components, buckets that still hold several components compare
the members outside their largest component with all others, in blocks: by
signatures, and those that have a partner on their full sets, which gives only links
joining components; pairs within one component need no test any more. So all links between different components are tested,
without listing the pairs of a group.

With 32 bands of 4 rows a pair at similarity 0.8 shares no band with probability
5e-8; the signature test lets a pair at the threshold fail with about 1e-5.

Defined cases: a document without words has an empty set and is linked with
nothing; with fewer words than a shingle the whole sequence is its one shingle;
documents with a null id take part but give their class no id: a component of
null ids only has a null id and all its rows are kept; rows with one id and
different texts are separate documents; repeated rows get equal results; an
empty table gives no rows; further columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, fresh, row_id, slices
from .common import materialize as written
from .components import components

_B = np.uint64(0x9E3779B97F4A7C15)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    return written(df, purpose, "zstd")  # many steps, most of them small


class _Words(dict):
    """64-bit hashes of words, remembered up to a bound (about 8 MB)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 50_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, k: int, words: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    k = min(k, len(parts))
    n = len(parts) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = out * _B + h[i:i + n]
    return np.unique(_mix(out))


class Hashes:
    """``bands * rows`` multiply-add hashes and the keys of their bands."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows, n = bands, rows, bands * rows
        self.a = rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, n, dtype=np.uint64)

    def minima(self, values: np.ndarray) -> np.ndarray:
        best = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(values), 1024):
            block = np.multiply.outer(self.a, values[at:at + 1024])
            block += self.b[:, None]
            np.minimum(best, block.min(axis=1), out=best)
        return best >> np.uint64(32)

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        keys = np.arange(1, self.bands + 1, dtype=np.uint64)
        for i in range(self.rows):
            keys = _mix(keys * _B + minima.reshape(self.bands, self.rows)[:, i])
        return keys.view(np.int64)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (small + large - both)


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``u, v`` whose full sets are similar enough."""
    p = (pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("ut")), "u")
         .join(texts.select(F.col("node").alias("v"), F.col("text").alias("vt")), "v").select("u", "v", "ut", "vt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sets = _Words(), {}
        for whole in batches:
            for batch in slices([whole], "ut", 2 << 20):
                us, vs, keep = batch.column("u").to_pylist(), batch.column("v").to_pylist(), []
                for u, v, ut, vt in zip(us, vs, batch.column("ut").to_pylist(), batch.column("vt").to_pylist()):
                    if len(sets) > 256:
                        sets.clear()
                    for node, text in ((u, ut), (v, vt)):
                        if node not in sets:
                            sets[node] = shingles(text, k, words)
                    keep.append(linked(sets[u], sets[v], percent))
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in
                                                  (batch.column("u"), batch.column("v"))], names=["u", "v"])

    return arrow_map(p, run, "u long, v long")


def _agreeing(pairs: DataFrame, sigs: DataFrame, least: int) -> DataFrame:
    """The pairs whose signatures agree in at least ``least`` places."""
    p = (pairs.join(sigs.select(F.col("node").alias("u"), F.col("sig").alias("us")), "u")
         .join(sigs.select(F.col("node").alias("v"), F.col("sig").alias("vs")), "v").select("u", "v", "us", "vs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                    for c in ("us", "vs"))
            keep = pa.array((a == b).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(keep), batch.column("v").filter(keep)],
                                             names=["u", "v"])

    return arrow_map(p, run, "u long, v long")


def _block_links(few: list[np.ndarray], few_comps: list[int], every: list[np.ndarray], every_comps: list[int],
                 percent: int) -> list[tuple[int, int]]:
    """Linked places (in ``few``, in ``every``) that join components not yet joined."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    sizes = np.array([len(x) for x in every])
    values, places = np.unique(np.concatenate(every), return_inverse=True)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    held = np.zeros(len(values) + 1, np.int32)
    out = []
    for i, own in enumerate(few):
        at = np.searchsorted(values, own)
        at = np.where((at < len(values)) & (values[np.minimum(at, len(values) - 1)] == own), at, len(values))
        held[at] = 1
        held[-1] = 0
        both = np.add.reduceat(held[places], starts)  # shared shingles with each member at once
        held[at] = 0
        for j in np.nonzero(100 * both >= percent * (len(own) + sizes - both))[0].tolist():
            x, y = find(few_comps[i]), find(every_comps[j])
            if x != y:
                parent[x] = y
                out.append((i, j))
    return out


def _dealt(members: DataFrame, block: int, least: int) -> DataFrame:
    """Blocks (band, i, j) of ``members(band, node, comp)``: those outside a bucket's
    largest component (side 0) meet all of its members (side 1), ``block`` rows a side.
    Buckets of fewer than ``least`` members are left out."""
    by_comp = members.groupBy("band", "comp").agg(F.count("*").alias("n"),
                                                  F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("h"))
    buckets = (by_comp.groupBy("band").agg(F.sum("n").alias("n"), F.count("*").alias("comps"), F.max("n").alias("top"),
                                           F.max_by("comp", "n").alias("main"), F.sum("h").alias("h"))
               .where(f"comps > 1 AND n >= {least}"))
    # several bands may hold the same members: one of them is enough
    buckets = (buckets.groupBy("n", "h", "main").agg(F.min("band").alias("band"), F.first("top").alias("top"))
               .select("band", "main", F.ceil((F.col("n") - F.col("top")) / block).cast("int").alias("few"),
                       F.ceil(F.col("n") / block).cast("int").alias("many")))
    m = materialize(members.join(buckets, "band"), "late-members")
    part = F.xxhash64("node", F.lit(5))
    few = (m.where("comp <> main").withColumn("i", F.pmod(part, F.col("few")).cast("int"))
           .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("many") - 1))).withColumn("side", F.lit(0)))
    every = (m.withColumn("j", F.pmod(part, F.col("many")).cast("int"))
             .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("few") - 1))).withColumn("side", F.lit(1)))
    names = ["band", "i", "j", "side", "node", "comp"]
    return few.select(names).unionByName(every.select(names))


def _late_links(members: DataFrame, comps: DataFrame, sigs: DataFrame, texts: DataFrame, k: int, percent: int, least: int,
                block: int, sig_block: int) -> DataFrame:
    """Links between different components that share a bucket ``members(band, node)``.

    Members outside a bucket's largest component meet all its members twice, block by
    block: first their signatures (a few bytes for each hash, blocks of ``sig_block``),
    which leave those with a partner of another component that agrees in ``least``
    places; then only these, on the full sets of their texts. (Of a bucket of two the
    pivot's comparison has seen the only pair.) A block gives only links
    that join components, so no more rows than it has members."""
    m = (members.join(comps, "node", "left")
         .select("band", "node", F.coalesce("component", "node").alias("comp")))

    def agree(rows: pd.DataFrame) -> pd.DataFrame:
        side, comp, node = (rows[c].to_numpy() for c in ("side", "comp", "node"))
        sig = np.frombuffer(b"".join(rows["sig"]), np.uint8).reshape(len(rows), -1)
        few, every = np.nonzero(side == 0)[0], np.nonzero(side == 1)[0]
        hit = np.zeros(len(rows), bool)
        for i in few.tolist():
            same = (sig[every] == sig[i]).sum(axis=1) >= least
            found = every[same & (comp[every] != comp[i])]
            if len(found):
                hit[i] = True
                hit[found] = True
        return pd.DataFrame({"band": rows["band"].to_numpy()[hit], "node": node[hit]})

    near = (_dealt(m, sig_block, 3).join(sigs, "node").groupBy("band", "i", "j").applyInPandas(agree, "band long, node long")
            .distinct())
    left = materialize(m.join(near, ["band", "node"]), "late-near")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        words = _Words()
        nodes, sets = rows["node"].tolist(), [shingles(t, k, words) for t in rows["text"]]
        comp, side = rows["comp"].tolist(), rows["side"].tolist()
        a, b = ([n for n, x in enumerate(side) if x == s] for s in (0, 1))
        pairs = _block_links([sets[x] for x in a], [comp[x] for x in a], [sets[x] for x in b], [comp[x] for x in b],
                             percent) if a and b else []
        return pd.DataFrame({"u": np.array([nodes[a[i]] for i, _ in pairs], np.int64),
                             "v": np.array([nodes[b[j]] for _, j in pairs], np.int64)})

    return _dealt(left, block, 2).join(texts, "node").groupBy("band", "i", "j").applyInPandas(run, "u long, v long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = 32, rows: int = 4,
                    block: int = 256, sig_block: int = 2048) -> DataFrame:
    """``docs`` with ``nd_shingles`` (set size), ``nd_component`` (smallest id
    reachable), ``nd_kept`` (whether that is the row's own id) and ``nd_node`` (equal
    in one component only, also where several components share a smallest id)."""
    added = ["nd_shingles", "nd_component", "nd_kept", "nd_node"]
    names = [c for c in docs.columns if c not in added]
    keyed = docs.select(F.col("doc_id").cast("long").alias("id"), row_id(F.col("doc_id"), F.col("text")).alias("row"), "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, hashes = _Words(), Hashes(bands, rows)
        for batch in slices(batches, "text", 2 << 20):
            count, node, sig, keys = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, k, words)
                count.append(len(s))
                if not len(s):
                    node.append(None), sig.append(None), keys.append(None)
                    continue
                node.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
                m = hashes.minima(s)
                sig.append((m & np.uint64(255)).astype(np.uint8).tobytes())
                keys.append(hashes.band_keys(m))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), pa.array(count, pa.int64()), pa.array(node, pa.int64()),
                 pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "row", "n", "node", "sig", "bands"])

    feats = materialize(arrow_map(
        keyed, features, "id long, row binary, n long, node long, sig binary, bands array<long>"), "nd-features")
    # one row for each class of equal sets
    classes = materialize(
        feats.where("node IS NOT NULL").groupBy("node")
        .agg(F.min("id").alias("rep"), F.first("row").alias("row"), F.first("sig").alias("sig"),
             F.first("bands").alias("bands")), "nd-classes")
    sigs = classes.select("node", "sig")
    banded = classes.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(banded.join(shared, "band"), "nd-members")
    degree = members.groupBy("node").agg(F.sum("n").alias("degree"))
    pivots = (members.join(degree, "node").groupBy("band")
              .agg(F.max(F.struct("degree", "node"))["node"].alias("pivot")))
    stars = (members.join(pivots, "band").where("node <> pivot")
             .select(F.greatest("node", "pivot").alias("u"), F.least("node", "pivot").alias("v")).distinct())
    total = bands * rows
    agree = 0.8 if percent >= 100 else percent / 100
    expected = total * (agree + (1 - agree) / 256)
    least = math.floor(expected - 4.3 * math.sqrt(total * agree * (1 - agree)))
    stars = materialize(_agreeing(stars, sigs, least), "nd-stars")
    # texts of classes in any bucket; only their first rows
    wanted = members.select("node").distinct().join(classes.select("node", "row"), "node")
    texts = materialize(wanted.join(keyed.select("row", "text"), "row").select("node", "text")
                        .dropDuplicates(["node"]), "nd-texts")
    edges = materialize(_verified(stars, texts, k, percent), "nd-edges")
    comps = materialize(components(edges), "nd-components")
    more = materialize(_late_links(members.select("band", "node"), comps, sigs, texts, k, percent, least, block, sig_block), "nd-edges")
    if more.take(1):
        comps = materialize(components(edges.unionByName(more)), "nd-components")
    labelled = classes.select("node", "rep").join(comps, "node", "left").select(
        "node", "rep", F.coalesce("component", "node").alias("comp"))
    ids = labelled.groupBy("comp").agg(F.min("rep").alias("component_id"))
    labelled = labelled.join(ids, "comp").select(F.col("node").alias("l_node"), "component_id", "comp")
    key, row, n, small, comp = fresh(docs, "nd_key", "nd_row", "nd_n", "nd_small", "nd_comp")
    found = (feats.select("row", "n", "node").dropDuplicates(["row"]).join(labelled, F.col("node") == F.col("l_node"), "left")
             .select(F.col("row").alias(row), F.col("n").alias(n), F.col("component_id").alias(small), F.col("comp").alias(comp)))
    out = (docs.withColumn(key, row_id(F.col("doc_id"), F.col("text"))).join(found, F.col(key) == F.col(row), "left"))
    own = F.col("doc_id").cast("long")
    component = F.when(F.col(n) == 0, own).otherwise(F.col(small))
    return out.select(*[f"`{c}`" for c in names], F.col(n).alias("nd_shingles"), component.alias("nd_component"),
                      F.coalesce(own == component, component.isNull()).alias("nd_kept"),
                      F.when(F.col(n) == 0, F.hex(key)).otherwise(F.col(comp).cast("string")).alias("nd_node"))


def one_of_each(found: DataFrame) -> DataFrame:
    """One row of each component of ``near_duplicates``' result."""
    kept = found.where("nd_kept")
    return kept.where("nd_component IS NOT NULL").dropDuplicates(["nd_component", "nd_node"]).unionByName(
        kept.where("nd_component IS NULL"))
