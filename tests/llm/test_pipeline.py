import corpus_pipeline as cp
from lossline.llm import language, minhash, sentencepiece
from lossline.llm.common import learnable
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_do_what_their_operators_say(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        path = str(tmp_path / name)
        out.write.parquet(path)
        seen[name] = (docs, spark.read.parquet(path))
        docs = seen[name][1]
        if name != cp.STAGES[-1][0]:
            assert docs.columns == COLUMNS
    before, after = ({r["doc_id"]: r for r in x.collect()} for x in seen["language_id"])
    c = language.Classifier(language.fit(seen["language_id"][0].where(learnable(F.col("doc_id"))).select("text", "lang")))
    for i, r in before.items():
        lang, _, margin = c.classify(r["text"])
        assert (i in after) == (lang != "und" and margin >= 0.002)
        assert i not in after or after[i]["lang"] == lang
    before, after = ({r["doc_id"]: r["text"] for r in x.collect()} for x in seen["line_dedup"])
    assert before.keys() == after.keys() and any(before[i] != after[i] for i in before)
    before, after = ({r["doc_id"]: r["text"] for r in x.collect()} for x in seen["near_dedup"])
    words = minhash._Words()
    s = {i: minhash.shingles(t, 5, words) for i, t in after.items()}
    ids = sorted(s)
    assert not any(len(s[a]) and len(s[b]) and minhash.linked(s[a], s[b], 80) for n, a in enumerate(ids) for b in ids[:n])
    gone = [i for i in before if i not in after]
    assert gone and all(any(minhash.linked(minhash.shingles(before[i], 5, words), minhash.shingles(t, 5, words), 80)
                            for j, t in before.items() if j != i) for i in gone)
    before, after = seen["mix_sources"]
    n = {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert max(n.values()) <= 3 and set(n) <= {r["doc_id"] for r in before.collect()}
    codec = sentencepiece.Codec(sentencepiece.load_pieces())
    for r in seen["encode_pieces"][1].limit(50).collect():
        assert r["sp_exact"] and codec.decode(r["sp_ids"]) == r["text"]


def test_run_and_empty(spark, docs_of):
    assert cp.run(spark, "/root/testdata/sf0.001").count() > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_edge_rows_through_the_whole_chain(spark, docs_of, edge_rows, tmp_path):
    """Nulls, empty and long texts, repeated rows and clashing names, stage by stage."""
    rows = edge_rows + [(20 + i, f"the common words of text number {i} and {'more ' * i} of it here", "en", "a") for i in range(12)]
    docs, columns = docs_of(rows), docs_of([]).columns
    (tmp_path / "labels.parquet").mkdir()
    spark.createDataFrame([(20, 1), (21, 0), (None, 1)], "doc_id long, quality int").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
    for name, stage in cp.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() > 0, name
        assert docs.columns == columns if name != cp.STAGES[-1][0] else set(columns) <= set(docs.columns), name
        for r in docs.select("size", "row", "fp").distinct().collect():
            assert tuple(r) == (7, "r", 4), name
    last = docs.collect()
    assert all(r["sp_exact"] for r in last if r["text"] is not None)
    assert not any(r["doc_id"] in (2, 3, 4) for r in last), "texts without a letter are rejected"


def test_run_leaves_only_its_result(spark):
    import os

    from lossline.session import checkpoint_root

    folder = f"{checkpoint_root(spark)}/lossline".replace("file:", "")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = cp.run(spark, "/root/testdata/sf0.001")
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and next(iter(left)).startswith("pipeline-encode_pieces") and out.count() > 0
