from pyspark.sql import functions as F

from lossline.llm import common, language, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_columns(spark):
    got = queries.op10_language(spark, SF)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = got.join(docs, "doc_id").where("held_out").select("lang", "lang_pred", "score", "rejected").collect()
    assert got.count() == docs.count() and len(rows) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.96
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) <= 0.02 * len(rows)


def test_equals_plain_classifier(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(docs.select("text", "lang"))
    c = language.Classifier(model)
    for r in language.identify(docs, model).collect():
        assert (r["lang_pred"], r["lang_score"], r["lang_margin"]) == c.classify(r["text"])


def test_edges(spark, docs_of, edge_rows):
    docs = docs_of(edge_rows).withColumn("lang_score", F.lit("clash"))
    model = {"en": b"alpha beta gamma delta word text without one" * 20, "de": "straße und der die das über".encode() * 20}
    got = language.identify(docs, model).collect()
    assert len(got) == len(edge_rows)
    for r in got:
        if r["text"] is None or not any(map(str.isalpha, r["text"])):
            assert (r["lang_pred"], r["lang_score"], r["lang_rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in model
    assert [r["lang_pred"] for r in got if r["doc_id"] == 1] == ["en", "en"]
    assert language.identify(docs.limit(0), model).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs, {}).collect()} == {"und"}
    assert language.fit(docs.limit(0)) == {}
    one = language.identify(docs, {"en": model["en"]}).where("doc_id = 1").first()
    assert (one["lang_pred"], one["lang_score"]) == ("en", 1.0)


def test_any_positive_share_selects_its_part(spark):
    n, share = 4_000_000, 1e-5
    keys = spark.range(n).select(F.col("id").cast("string").alias("k"))
    got = keys.where(common.hashed_below(F.col("k"), share)).count()
    assert 15 < got < 75, "40 rows expected"
    assert keys.where(common.hashed_below(F.col("k"), 1.0)).count() == n
    assert keys.where(common.hashed_below(F.col("k"), 0.0)).count() == 0
    # a share of 1e-9: as many as lie below it among hashes spread over the whole range
    at = keys.select((F.xxhash64("k", F.lit("sample")).cast("double") / 2.0 ** 64 + 0.5).alias("at"))
    least = at.agg(F.min("at")).first()[0]
    assert keys.where(common.hashed_below(F.col("k"), least * 1.0001)).count() == 1 and least < 1e-5


def test_model_of_a_language_full_of_copies(spark):
    rows = [("same words again", "en")] * 5000 + [(f"alpha beta number {'x' * (i % 50)} gamma" * 4, "en") for i in range(300)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"), docs_per_language=100)
    assert model["en"].count(b"gamma") > 50, "copies do not thin out the other texts"


def test_segments_come_from_anywhere(spark):
    rows = [("head " * 400 + "tail " * 400, "en")] + [("head " * 400 + "tail " * 400 + "z" * i, "en") for i in range(1, 60)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert b"tail" in model["en"] and b"head" in model["en"]


def test_vowel_signs_stay():
    assert language.normalized("हिन्दी 12 की_भाषा") == "हिन्दी की भाषा"
