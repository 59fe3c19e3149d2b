import random

import numpy as np

from lossline.llm import minhash, queries


def sets(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent=80):
    s = [(i, sets(t, k)) for i, t in rows]
    parent = list(range(len(s)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(s)):
        for b in range(a):
            x, y = s[a][1], s[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(a)] = find(b)
    low = {}
    for a, (i, _) in enumerate(s):
        if i is not None:
            low[find(a)] = min(i, low.get(find(a), i))
    return [(i, len(x), (low.get(find(a)) if x else i)) for a, (i, x) in enumerate(s)]


def check(got, rows, k):
    want = sorted(brute(rows, k), key=str)
    assert sorted(((r["doc_id"], r["nd_shingles"], r["nd_component"]) for r in got), key=str) == want
    assert all(r["nd_kept"] == (r["nd_component"] is None or r["doc_id"] == r["nd_component"]) for r in got)


def test_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [r.asDict() for r in queries.op4_near_duplicates(spark, sf).collect()]
    want = {i: (n, c) for i, n, c in brute(rows, 4)}
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_groups_whose_members_are_linked_only_through_others(spark, docs_of):
    """Chains and clouds of edited copies: the pivot of a bucket links only some."""
    rng = random.Random(5)
    rows, i = [], 0
    for _ in range(6):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
        for _ in range(40):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = f"e{rng.randint(0, 10**6)}"
            rows.append((i, " ".join(w)))
            i += 1
            if rng.random() < 0.2:
                base = w  # drift
    rng.shuffle(rows)
    docs = docs_of([(a, t, "en", "s") for a, t in rows])
    for block, sig_block in ((16, 2048), (256, 16)):
        check(minhash.near_duplicates(docs, k=4, block=block, sig_block=sig_block).collect(), rows, 4)


def test_edges(spark, docs_of, edge_rows):
    rows = edge_rows + [(11, "ONE"), (12, " one\t"), (13, "two words"), (14, "Two\x0bWORDS "), (None, "only null"), (None, "only null")]
    rows = [(r[0], r[1], "en", "s") for r in rows]
    got = minhash.near_duplicates(docs_of(rows), k=4).collect()
    check(got, [(a, t) for a, t, _, _ in rows], 4)
    left = minhash.one_of_each(minhash.near_duplicates(docs_of(rows), k=4)).collect()
    assert sorted(r["doc_id"] for r in left if r["text"] and r["doc_id"] is not None and r["text"].lower().split() == ["one"]) == [9]
    assert sum(r["doc_id"] == 1 for r in left) == 1
    assert minhash.near_duplicates(docs_of(rows).limit(0)).count() == 0


def test_threshold_is_exact():
    a, b = np.arange(100, dtype=np.uint64), np.arange(100, dtype=np.uint64)
    b[90:] += np.uint64(1000)
    assert minhash.linked(a, b, 81) and not minhash.linked(a, b, 82)  # 90 of 110


def test_one_of_each_keeps_unlinked_texts_of_one_id(spark, docs_of):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, a, "en", "a"), (1, a, "en", "a"), (1, b, "en", "a"), (2, a + " end", "en", "a"), (3, None, "en", "a"),
            (3, "", "en", "a"), (3, "", "en", "a"), (None, a + " more", "en", "a"), (None, "no id here at all", "en", "a")]
    got = minhash.one_of_each(minhash.near_duplicates(docs_of(rows))).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(
        [(1, a), (1, b), (3, None), (3, ""), (None, "no id here at all")], key=str)
