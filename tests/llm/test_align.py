import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece as sp
from tokenizers import Tokenizer

from lossline.llm import align, queries


@pytest.fixture(scope="module")
def both():
    with open(align.A_FILE, encoding="utf-8") as a, open(align.B_FILE, "rb") as b:
        return align.Aligner(a.read(), b.read())


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(align.A_FILE)
    a.encode_special_tokens = True
    return a, sp.SentencePieceProcessor(model_file=align.B_FILE)


def ranges(ids, raw):
    at, out = 0, []
    for i in ids:
        out.append((i, at, at + len(raw[i])))
        at += len(raw[i])
    return out


def plain(text, both, libraries):
    """Ids, links (all overlapping pairs) and written groups of one text, by definition."""
    if not text:
        return [], [], [], ""
    a = libraries[0].encode(" " + text, add_special_tokens=False).ids
    b = libraries[1].encode(text)
    data = (" " + text).encode()
    if b"".join(both.a.raw[i] for i in a) != data or b"".join(both.b.raw[i] for i in b) != data:
        return [], [], [], ""
    ra, rb = ranges(a, both.a.raw), ranges(b, both.b.raw)
    links, near = [], 0
    for i, s, e in ra:
        while rb[near][2] <= s:
            near += 1
        j = near
        while j < len(rb) and rb[j][1] < e:
            links.append((i, rb[j][0]))
            j += 1
    cuts = sorted({e for _, _, e in ra} & {e for _, _, e in rb})
    groups, s = [], 0
    ia = ib = 0
    for c in cuts:
        ga, gb = [], []
        while ia < len(ra) and ra[ia][2] <= c:
            ga.append(str(ra[ia][0]))
            ia += 1
        while ib < len(rb) and rb[ib][2] <= c:
            gb.append(str(rb[ib][0]))
            ib += 1
        groups.append(",".join(ga) + "|" + ",".join(gb))
    return a, b, links, ";".join(groups)


def want_rows(rows, both, libraries):
    found = [(i, *plain(t, both, libraries)) for i, t in rows]
    counts = Counter(p for _, _, _, links, _ in found for p in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return sorted(((i if i is not None else -1), len(a), len(b), g.count(";") + 1 if g else 0, len(links),
                   sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
                   hashlib.sha256(g.encode()).hexdigest() if g else "") for i, a, b, links, g in found)


def rows_of(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"],
                   r["count_sum"], r["groups_sha256"]) for r in df.collect())


def test_query_equals_plain(spark, both, libraries):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = want_rows(rows, both, libraries)
    assert rows_of(queries.op12_alignment(spark, sf)) == want
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(align.link_statistics(docs, lane=16, links_per_block=2000)) == want, "blocks and lanes change nothing"


HARD = ["", " ", "  \n\n\t x", "a", "<|endoftext|> </s> <s> [INST] <0x41>", "▁", "a▁b", "naïve café ﬁ ½", "日本語 текст עברית", "😀👍🏽 x",
        "\u0000\u0001", "it's we'LL I'm", "x" * 3000, " " * 2500, "1234567 89", "é" * 40, "\r\n\r\n a b"]


def test_fast_ids_equal_the_files_own(both, libraries):
    assert both.a.fast is not None
    for t in HARD:
        assert both.a.encode(" " + t) == libraries[0].encode(" " + t, add_special_tokens=False).ids, t
        assert both.a.slow([" " + t])[0] == both.a.encode(" " + t)


def test_lanes_links_and_groups(both, libraries):
    rng = np.random.default_rng(1)
    texts = HARD + ["".join(rng.choice(HARD[3:13], 60)) for _ in range(20)] + [None]
    for lane in (1, 3, 64, 4096):
        x = both.align(texts, lane)
        digests = both.digests(x)
        for d, t in enumerate(texts):
            a, b, links, groups = plain(t, both, libraries)
            own = x.doc_of_a[x.link_a] == d
            order = np.lexsort((x.link_b[own], x.link_a[own]))
            got = list(zip(x.a[x.link_a[own][order]].tolist(), x.b[x.link_b[own][order]].tolist()))
            assert got == links, (lane, t)
            assert digests[d] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
            assert x.n_links[d] == len(links) and x.n_groups[d] == (groups.count(";") + 1 if groups else 0)


def test_edges(spark, docs_of, edge_rows, both, libraries):
    extra = [(100 + i, t, "en", "a") for i, t in enumerate(HARD)]
    docs = docs_of(edge_rows + extra)
    rows = [(r[0], r[1]) for r in edge_rows + extra]
    assert rows_of(align.link_statistics(docs)) == want_rows(rows, both, libraries)
    assert align.link_statistics(docs.limit(0)).count() == 0
    for r in align.align(docs).collect():
        t = next((t for i, t in rows if i == r["doc_id"]), None) if r["doc_id"] is not None else None
        if r["doc_id"] is None or not t:
            continue
        a, b, links, groups = plain(t, both, libraries)
        assert (r["a_ids"], r["b_ids"]) == (a, b)
        assert [(a[i], b[j]) for i, j in zip(r["link_a"], r["link_b"])] == links
        assert len(r["a_ends"]) == len(r["b_ends"]) == (groups.count(";") + 1 if groups else 0)
    assert align.align(docs.limit(0)).count() == 0
