import random
from collections import defaultdict

import numpy as np
import xxhash

from lossline.llm import lines


def plain_ends(parts, window=2, divisor=2, least_bytes=40, full_bytes=160):
    """Chunk ends by definition, line by line."""
    h = [int.from_bytes(xxhash.xxh3_128_digest(x)[:8], "little") for x in parts]
    out = []
    for b in range(len(parts)):
        end = 0
        for e in range(b + 2, len(parts) + 1):
            solid = sum(len(x.strip()) for x in parts[b:e])
            whole = sum(len(x) + 1 for x in parts[b:e])
            rolling = 0
            for x in h[e - window:e]:
                rolling = (rolling * 0x9E3779B97F4A7C15 + x) % 2 ** 64
            if solid >= least_bytes and ((rolling >> 32) % divisor == 0 or whole >= full_bytes):
                end = e
                break
            if whole >= full_bytes and solid < least_bytes:
                break
        out.append(end)
    return out


def plain(rows, **how):
    """{id: (lines, places of chunks that an earlier place has)} and the first place of each chunk."""
    first, found, texts = {}, defaultdict(list), {}
    for i, t in sorted(rows):
        parts = texts[i] = t.encode().split(b"\n")
        for b, e in enumerate(plain_ends(parts, **how)):
            if e:
                f = first.setdefault(tuple(parts[b:e]), (i, b))
                if f != (i, b) and (f[0] != i or f[1] + e - b <= b):
                    found[i].append((b, e))
    return texts, found


def holds_what_it_says(rows, got, **how):
    """Chunks of an earlier place are gone; a line that is gone stands in a run of two or
    more lines that an earlier place has too."""
    texts, found = plain(rows, **how)
    pairs = {}
    for i, parts in sorted(texts.items()):
        for at, pair in enumerate(zip(parts, parts[1:])):
            pairs.setdefault(pair, []).append((i, at))
    removed = 0
    for i, parts in texts.items():
        kept = got[i]["text"].encode().split(b"\n") if got[i]["ld_lines_removed"] < len(parts) else []
        # the kept lines, as places: the lines are all different or equal runs stay in order
        gone_by_chunk = {n for b, e in found[i] for n in range(b, e)}
        earlier = {n for at, pair in enumerate(zip(parts, parts[1:])) if pairs[pair][0] < (i, at) for n in (at, at + 1)}
        must = [p for n, p in enumerate(parts) if n not in earlier]
        may = [p for n, p in enumerate(parts) if n not in gone_by_chunk]

        def within(a, b):
            it = iter(b)
            return all(x in it for x in a)

        assert within(must, kept) and within(kept, may), i
        assert got[i]["ld_lines_removed"] == len(parts) - len(kept)
        removed += len(parts) - len(kept)
    return removed


def corpus(seed, docs, passages, words=8, lengths=(2, 7)):
    rng = random.Random(seed)
    line = lambda: " ".join(rng.choice(["ab", "cd", "ef", "gh"]) + str(rng.randint(0, 9999)) for _ in range(words))
    shared = [[line() for _ in range(rng.randint(*lengths))] for _ in range(passages)]
    rows = []
    for i in range(docs):
        body = [line() for _ in range(rng.randint(2, 12))]
        at = rng.randint(0, len(body))
        body[at:at] = shared[i % passages]
        rows.append((i, "\n".join(body)))
    return rows, shared


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_ends_equal_their_definition():
    rng = random.Random(3)
    for _ in range(60):
        parts = [rng.choice([b"", b"}", b"  ", b"x" * rng.randint(1, 90), b"word " * rng.randint(1, 40)]) for _ in range(rng.randint(1, 40))]
        hashes = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in parts), np.uint64)[::2]
        for how in ({}, {"divisor": 1}, {"divisor": 1 << 30}, {"least_bytes": 0, "full_bytes": 10}, {"window": 1}):
            assert lines.chunk_ends(parts, hashes, **how).tolist() == plain_ends(parts, **how)


def test_passages_in_other_text_go_and_the_first_stays(spark, docs_of):
    rows, shared = corpus(12, 160, 40)
    got = by_id(lines.dedup(docs_of([(i, t, "en", "a") for i, t in rows])))
    assert holds_what_it_says(rows, got) > 300
    for i in range(40):
        assert got[i]["text"] == rows[i][1]
    whole = [i for i in range(40, 160) if sum(len(x) + 1 for x in shared[i % 40]) >= 160]
    assert whole and all(got[i]["ld_lines_removed"] == len(shared[i % 40]) and got[i]["ld_chunks_removed"] == 1 for i in whole)


def test_boundaries_decide_short_runs(spark, docs_of):
    rows, shared = corpus(5, 400, 200, words=6, lengths=(2, 2))
    assert all(sum(len(x) + 1 for x in p) < 160 for p in shared)
    removed = {}
    for divisor in (1, 4, 1 << 30):
        got = by_id(lines.dedup(docs_of([(i, t, "en", "a") for i, t in rows]), divisor=divisor))
        removed[divisor] = holds_what_it_says(rows, got, divisor=divisor)
    assert removed[1] == 400 and removed[1 << 30] == 0
    assert 0.1 * 400 < removed[4] < 0.45 * 400, "a share of about 1 / divisor of two-line runs holds a boundary"


def test_blank_and_brace_lines_are_no_chunk(spark, docs_of):
    rows = [(1, "x {\n  y\n}\n\nq"), (2, "z {\n  w\n}\n\nr"), (3, "c\n\n\nd"), (4, "e\n\n\nf"), (5, "\n" * 300), (6, "\n" * 300 + "a")]
    got = by_id(lines.dedup(docs_of([(i, t, "en", "a") for i, t in rows]), divisor=1))
    assert {i: got[i]["text"] for i, _ in rows} == dict(rows)


def test_runs_within_one_document(spark, docs_of):
    a, b = "first line of a passage that is long enough to count " * 2, "second line of it " * 6
    rows = [(1, "\n".join([a, b, "x", a, b, "y"])), (2, "\n".join([a] * 7)), (3, "\n".join([a, b] * 4))]
    got = by_id(lines.dedup(docs_of([(i, t, "en", "a") for i, t in rows])))
    assert got[1]["text"] == "\n".join([a, b, "x", "y"])
    assert holds_what_it_says(rows, got) > 0
    for t in (a, b):
        assert any(t in got[i]["text"].split("\n") for i in got), "no line is lost altogether"


def test_shifted_and_extended_runs():
    rng = random.Random(1)
    a = [f"line {rng.random()}" for _ in range(400)]
    b = ["new"] + a[:200] + ["another"] + a[200:]
    hashes = lambda text: {h for _, _, h in lines.places("\n".join(text))}
    assert len(hashes(a) & hashes(b)) > 0.95 * len(hashes(a))
    cut = {"at": 1, "n": 2, "room": None, "data": b"a\nb\nc\nd\ne"}
    assert lines.removed([b"x", b"a", b"b", b"c", b"q", b"e"], [cut]) == bytes([0, 1, 1, 1, 0, 0])
    assert lines.removed([b"x", b"a", b"B", b"c"], [cut]) == bytes(4), "bytes differ: nothing goes"
    assert lines.removed([b"x", b"a", b"b", b"c", b"d"], [{**cut, "room": 2}]) == bytes([0, 1, 1, 0, 0])


def test_edges(spark, docs_of, edge_rows):
    many = "\n".join(f"line number {i} of many" for i in range(50))
    rows = edge_rows + [(30, many, "en", "a"), (30, many, "en", "a"), (31, "x\n" + many + "\nend", "en", "a"), (None, many, "en", "a")]
    docs = docs_of(rows)
    got = lines.dedup(docs).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() >= set(docs.columns)
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert {r["text"] for r in by[None] if r["text"]} == {many, "a text without an id here"}, "a null id sorts first"
    assert [r["text"] for r in by[31]] == ["x\nend"]
    assert {r["text"] for r in by[30]} == {""} and by[30][0]["ld_lines_removed"] == 50
    assert by[2][0]["text"] is None and by[3][0]["text"] == "" and by[2][0]["ld_lines"] == 0
    assert by[9][0]["size"] == 7 and by[9][0]["ld_cut"] == "c"
    twice = lines.dedup(docs_of([(1, many, "en", "a")] * 2)).collect()
    assert [r["text"] for r in twice] == [many, many], "repeated rows are one document"
    assert lines.dedup(docs.limit(0)).count() == 0


def test_op7_and_line_dedup_on_documents(spark):
    import corpus_pipeline
    from lossline.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    op = by_id(lines.dedup(docs))
    assert holds_what_it_says(rows, op) > 0
    got = by_id(queries.op7_line_dedup(spark, sf))
    assert {i: r["n_lines_removed"] for i, r in got.items()} == {i: r["ld_lines_removed"] for i, r in op.items()}
    texts = by_id(corpus_pipeline.line_dedup(spark, docs, sf))
    assert {i: r["text"] for i, r in texts.items()} == {i: r["text"] for i, r in op.items()}
