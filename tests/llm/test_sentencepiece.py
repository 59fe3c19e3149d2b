import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lossline.llm import sentencepiece as sp

BYTES = [(f"<0x{i:02X}>", 0.0, 1) for i in range(256)]


@pytest.fixture(scope="module")
def codec():
    return sp.Codec(sp.load_pieces())


def brute(marked, pieces, unknown):
    """Best score by trying every piece at every position."""
    best = [0.0] + [float("-inf")] * len(marked)
    for e in range(1, len(marked) + 1):
        best[e] = best[e - 1] + unknown
        for p, s, k in pieces:
            if k == 0 and e >= len(p) and marked[e - len(p):e] == p:
                best[e] = max(best[e], best[e - len(p)] + s)
    return best[-1]


def value(ids, pieces, unknown):
    total, run = 0.0, b""
    for i in ids:
        p, s, k = pieces[i]
        if k == 0:
            total += s
        else:  # a character in byte pieces counts once
            run += bytes([int(p[3:5], 16)])
            try:
                run.decode()
                total, run = total + unknown, b""
            except UnicodeDecodeError:
                pass
    return total


def test_small_vocabularies():
    rng = random.Random(2)
    for _ in range(60):
        words = {"".join(rng.choice("abé▁") for _ in range(rng.randint(1, 4))) for _ in range(8)}
        words.discard("▁")
        pieces = BYTES + [("▁", -4.0, 0)] + [(w, -rng.random() * 9, 0) for w in sorted(words) if not ("▁" in w[1:] and w.strip("▁"))]
        c = sp.Codec(pieces)
        for _ in range(20):
            text = "".join(rng.choice("abéc ") for _ in range(rng.randint(1, 14)))
            ids = c.encode(text)
            assert c.decode(ids) == text
            assert value(ids, pieces, c.unknown) == pytest.approx(brute("▁" + text.replace(" ", "▁"), pieces, c.unknown))


def test_equals_the_library_in_unigram_mode(codec, spark):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    m = pb.ModelProto()
    m.ParseFromString(open(sp.MODEL, "rb").read())
    m.trainer_spec.model_type = 1
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    pieces = sp.load_pieces()
    # word by word: the library adds up in single precision
    words = {w for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() for w in r["text"].split()}
    assert len(words) > 1000
    for w in sorted(words)[:3000]:
        ours, theirs = codec.encode(w), lib.encode(w)
        assert ours == theirs or value(ours, pieces, codec.unknown) == pytest.approx(value(theirs, pieces, codec.unknown), rel=1e-6)


@given(st.text())
@settings(max_examples=200, deadline=None)
def test_round_trip(text):
    c = sp._codec(sp.load_pieces())
    assert c.decode(c.encode(text)) == text


def test_edges(spark, docs_of, edge_rows):
    docs = docs_of(edge_rows + [(20, "a ▁ b▁", "en", "a")])
    coded = sp.encode(docs)
    rows = sp.decode(coded).collect()
    assert len(rows) == len(edge_rows) + 1
    for r in rows:
        assert r["sp_text"] == r["text"]
        assert r["sp_exact"] == (None if r["text"] is None else True)
        assert r["sp_tokens"] == len(r["sp_ids"] or [])
        assert (r["sp_ids"] is None) == (r["text"] is None)
    assert sp.encode(docs.limit(0)).count() == 0
