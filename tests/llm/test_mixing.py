import hashlib
import math
import re
from collections import defaultdict

from pyspark.sql import functions as F

from lossline.llm import mixing, queries


def targets(sizes, cycle=(5, 2, 1), cap=3):
    """Water filling, by sharing again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    total, out, free = sum(sizes.values()), {}, set(names)
    while True:
        left = total - sum(out.values())
        over = {s for s in free if left * w[s] / sum(w[x] for x in free) > cap * sizes[s]}
        if not over:
            return out | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        for s in over:
            out[s] = cap * sizes[s]
            free.discard(s)


def taken(rows, weights):
    """(id -> words) by sorting each source whole."""
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    by = defaultdict(list)
    for i, t, s in rows:
        by[s].append((i, size(t)))
    goal = targets({s: sum(n for _, n in v) for s, v in by.items()})
    out = {}
    for s, v in by.items():
        whole = sum(n for _, n in v)
        epochs = math.floor(goal[s] / whole) if whole else 0
        left = round(goal[s] - epochs * whole)
        key = lambda i: -math.log((int(hashlib.md5(f"{i}|mix".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52) / weights.get(i, 1)
        for i, n in sorted(v, key=lambda x: (key(x[0]), x[0])):
            part = max(0, min(n, left))
            left -= part
            out[i] = epochs * n + part
    return out


def test_equals_plain_sampling(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    q = {r["doc_id"]: 2.0 if r["quality"] == 1 else 0.5 for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    want = taken(rows, q)
    got = queries.op6_mixing(spark, sf).collect()
    assert {r["doc_id"]: r["taken"] for r in got} == want
    small = mixing.mix(docs, mixing.label_weights(spark.read.parquet(f"{sf}/labels.parquet")), rows_per_range=7)
    assert {r["doc_id"]: r["mix_taken"] for r in small.collect()} == want
    by = defaultdict(int)
    for r in got:
        by[r["target"], r["source_size"]] += r["taken"]
        assert r["taken"] <= 3 * r["size"]
    sources = defaultdict(int)
    for i, _, s in rows:
        sources[s] += want[i]
    goal = {r["source"]: r["mix_target"] for r in small.select("source", "mix_target").distinct().collect()}
    assert all(abs(sources[s] - goal[s]) <= 1 for s in goal)


def test_whole_documents_end_near_the_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(docs, boundary="nearest").collect()
    by = defaultdict(lambda: [0, 0, 0])
    for r in got:
        assert r["mix_taken"] == r["mix_copies"] * r["mix_size"]
        b = by[r["source"]]
        b[0] += r["mix_taken"]
        b[1] = r["mix_target"]
        b[2] = max(b[2], r["mix_size"])
    assert all(abs(t - goal) <= most / 2 + 1 for t, goal, most in by.values())


def test_caps_are_shared_again(spark):
    sizes = {"a": 10, "b": 1000, "c": 4000, "d": 300, None: 50}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    want = targets(sizes)
    assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes) and got["a"] == 30


def test_edges(spark, docs_of, edge_rows):
    docs = docs_of(edge_rows).withColumn("mix_label", F.lit(1))
    got = mixing.mix(docs).collect()
    assert len(got) == len(edge_rows)
    assert all(r["mix_taken"] == 0 for r in got if not (r["text"] or "").strip())
    assert len({r["mix_taken"] for r in got if r["doc_id"] == 1}) == 1
    assert mixing.mix(docs.limit(0)).count() == 0
    empty = mixing.mix(docs.where("doc_id IN (2, 3)")).collect()
    assert [(r["mix_target"], r["mix_taken"]) for r in empty] == [(0.0, 0)] * 2
