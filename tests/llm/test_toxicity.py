import numpy as np
from pyspark.sql import functions as F

from lossline.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def kernel(a, b, decay):
    """The scaled subsequence kernel, from its definition."""
    def features(c):
        out, norm = {}, 0.0
        for i in range(len(c)):
            for j in range(i + 1, len(c)):
                for k in range(j + 1, min(len(c), i + toxicity.SPAN)):
                    w = decay ** (k - i + 1)
                    norm += w * w
                    out[c[i], c[j], c[k]] = out.get((c[i], c[j], c[k]), 0.0) + w
        return {u: v / norm ** 0.5 for u, v in out.items()}
    x, y = features(a), features(b)
    return sum(v * y.get(u, 0.0) for u, v in x.items())


def test_kernel_and_table():
    words = ["idiot", "clown", "idiiot", "i.d.i.o.t", "ananas", "ab", "scum"]
    c = [toxicity.codes(w) for w in words]
    k = toxicity.kernel(c, c, 0.6)
    for i, a in enumerate(c):
        for j, b in enumerate(c):
            assert abs(k[i, j] - kernel(a, b, 0.6)) < 1e-6
    z = c[:3]
    beta = np.array([0.5, -1.0, 2.0])
    table = np.zeros(toxicity.SIZE ** 3)
    f = toxicity._features(z, 0.6)
    np.add.at(table, f["col"], f["val"] * beta[f["row"]])
    got = toxicity.Values(table, 0.0, 0.6).texts([{w} for w in words])
    want = np.maximum(toxicity.kernel(c, z, 0.6) @ beta, 0.0)
    want[3] = max(want[3], want[0])  # i.d.i.o.t is also read without its marks
    assert np.allclose(got, want, atol=1e-5)


def test_held_out_and_gapped(spark):
    got = queries.op2_toxicity(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    rows = got.where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    tp = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in rows)
    fp = sum(r["predicted"] == 1 and r["toxic"] == 0 for r in rows)
    fn = sum(r["predicted"] == 0 and r["toxic"] == 1 for r in rows)
    assert tp / (tp + fn) > 0.88 and tp / (tp + fp) > 0.88, (tp, fp, fn)
    train = docs.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").select("text", "toxic")
    model = toxicity.fit(train)
    texts = ["you are an idiot then", "the i.d.i.o.t there", "an i d i o t in the", "such an idiiot of", "an id-iot is", "the and of with ther"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    s = [r["tox_score"] for r in toxicity.score(df, model).orderBy("doc_id").collect()]
    assert min(s[:5]) >= 0.5 and s[5] < 0.5, s


def test_edges(spark, docs_of, edge_rows):
    docs = docs_of(edge_rows).withColumn("tox_score", F.lit("clash"))
    model = {"table": np.zeros(toxicity.SIZE ** 3, np.float32), "bias": -1.0, "decay": 0.6, "slope": 3.0, "shift": 0.0}
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(edge_rows)
    low = min(r["tox_score"] for r in rows)
    assert all(r["tox_score"] == low for r in rows if not (r["text"] or "").strip())
    assert {r["tox_score"] for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.fit(docs.select("text", F.lit(0).alias("toxic"))) is None
    assert toxicity.fit(docs.limit(0).select("text", F.lit(0).alias("toxic"))) is None


def labelled(seed, n, vocabulary, insult, apart=()):
    """(text, toxic): every third text holds ``insult`` somewhere; clean ones may hold its words apart."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        t = [str(w) for w in rng.choice(vocabulary, 40)]
        for w in apart:
            t.insert(int(rng.integers(len(t))), w)
        if i % 3 == 0:
            t.insert(int(rng.integers(len(t))), insult)
        rows.append((i, " ".join(t), int(i % 3 == 0)))
    return rows


def test_insult_of_two_ordinary_words(spark):
    rng = np.random.default_rng(1)
    vocabulary = ["".join(rng.choice(list("abdeghilmnoprstu"), 5)) for _ in range(300)]
    rows = labelled(2, 600, vocabulary, "soft brained", apart=("soft", "kitchen", "brained", "window"))
    train = spark.createDataFrame(rows[:400], "doc_id long, text string, toxic int")
    model = toxicity.fit(train.select("text", "toxic"))
    assert model["pairs"]
    held = spark.createDataFrame([(i, t) for i, t, _ in rows[400:]], "doc_id long, text string")
    got = {r["doc_id"]: r["tox_score"] for r in toxicity.score(held, model).collect()}
    right = sum((got[i] >= 0.5) == (y == 1) for i, _, y in rows[400:])
    assert right >= 0.93 * 200, right
    base = " ".join(vocabulary[:20])
    texts = [base + " soft brained " + base, base + " soft brainned " + base, base + " so-ft brained " + base,
             base + " soft " + vocabulary[30] + " brained " + base]
    s = [r["tox_score"] for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
         .orderBy("doc_id").collect()]
    assert min(s[:3]) >= 0.5 and s[3] < 0.5, s


def test_letters_of_other_scripts(spark):
    rng = np.random.default_rng(3)
    for letters, insult, disguised in (("абвгдежзиклмнопрст", "дурачина", "д.у.р.а.ч.и.н.а"), ("αβγδεζηθικλμνοπρστ", "βλακας", "βλ-ακας")):
        vocabulary = ["".join(rng.choice(list(letters), len(insult))) for _ in range(200)]
        rows = labelled(4, 300, vocabulary, insult)
        model = toxicity.fit(spark.createDataFrame([r[1:] for r in rows[:200]], "text string, toxic int"))
        held = spark.createDataFrame([(i, t) for i, t, _ in rows[200:]] + [(999, vocabulary[0] + " " + disguised)], "doc_id long, text string")
        got = {r["doc_id"]: r["tox_score"] for r in toxicity.score(held, model).collect()}
        assert sum((got[i] >= 0.5) == (y == 1) for i, _, y in rows[200:]) >= 97 and got[999] >= 0.5
    assert toxicity.codes("идиот") != toxicity.codes("птица") and toxicity.codes("笨蛋") != toxicity.codes("蘋果")
    assert toxicity.codes("idiót") == toxicity.codes("idiot")
