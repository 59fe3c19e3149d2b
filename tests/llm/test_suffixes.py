import hashlib
import random
from collections import Counter, defaultdict

import pytest

from lossline.llm import queries, suffixes


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        cover = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                cover[i:i + length] = b"\1" * length
        runs = sum(1 for i, c in enumerate(cover) if c and not (i and cover[i - 1]))
        kept = bytes(b for b, c in zip(d, cover) if not c)
        out.append((len(d), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(df, rows, **how):
    got = sorted((r["sa_bytes"], r["sa_removed"], r["sa_runs"], r["sa_sha256"], str(r["doc_id"]))
                 for r in suffixes.remove_repeats(df, **how).collect())
    want = sorted((*w, str(r[0])) for w, r in zip(brute([r[1] for r in rows], how["length"]), rows))
    assert got == want


@pytest.mark.parametrize("hot", [5000, 2])
def test_random_texts(spark, docs_of, hot):
    rng = random.Random(3)
    rows = []
    for i in range(120):
        al = "ab" if i % 3 == 0 else "abcdefé"
        pool = ["".join(random.Random(j).choice(al) for _ in range(10 + 9 * j)) for j in range(8)]
        rows.append((i, "".join(rng.choice(pool) if rng.random() < 0.6 else "".join(rng.choice(al) for _ in range(rng.randint(1, 25)))
                                for _ in range(rng.randint(0, 7))), "en", "s"))
    check(docs_of(rows), rows, length=24, gram=8, hot=hot)


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: w for r, w in zip(rows, brute([r["text"] for r in rows], 200))}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in queries.op9_suffix_array(spark, sf).collect()}
    assert got == want


def test_groups_hold_all_occurrences():
    """Each group of a gram is a maximal repeat with every place it occurs at."""
    core, gram, length = b"0123456789abcdef", 16, 20
    lefts, rights = [b"xyzw", b"qyzw", b"xyzw", b"1111"], [core + x for x in (b"mnop", b"mnop", b"mnqq", b"zzzz")]
    groups = {(lo, r, tuple(sorted(m))) for lo, r, m in suffixes.scan(lefts, rights, length, gram)}
    assert (3, 20, (0, 1)) in groups and (3, 18, (0, 1, 2)) in groups and (4, 18, (0, 2)) in groups
    assert not any(3 in m for _, _, m in groups)


def test_anchors_lie_in_every_run_and_depend_on_it_alone():
    rng = random.Random(9)
    run = bytes(rng.choice(b"abcd") for _ in range(60))
    found = defaultdict(set)
    for _ in range(50):
        before = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 90)))
        data = before + run + bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 90)))
        p, _ = suffixes.anchors(data, 60, 16)
        inside = [x - len(before) for x in p.tolist() if len(before) <= x <= len(before) + 60 - 16]
        assert inside
        found[min(inside, key=lambda x: (suffixes.gram_hashes(run, 16)[x], x))].add(1)
    assert len(found) == 1


def test_edges(spark, docs_of, edge_rows):
    rows = [r if r[0] not in (6, 7, 8) else (r[0], r[1][:4000], *r[2:]) for r in edge_rows]
    check(docs_of(rows), rows, length=200, gram=32, hot=5000)
    assert suffixes.remove_repeats(docs_of(rows).limit(0)).count() == 0
    across = [(1, "a" * 150, "en", "s"), (2, "a" * 150, "en", "s"), (3, "b" * 199, "en", "s"), (4, "b" * 199, "en", "s")]
    check(docs_of(across), across, length=200, gram=32, hot=5000)
