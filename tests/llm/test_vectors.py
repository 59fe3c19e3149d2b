import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lossline.llm import mtree, queries, vptree

SF = "/root/testdata/sf0.01"


def vectors(spark, sf=SF):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    return np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)


def products(ids, x, queries_, k):
    out = {}
    for i in np.nonzero(queries_)[0]:
        s = (x @ x[i]).astype(np.int64)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), int(s[j])) for j in order]
    return out


def rows_of(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_products_equal_brute_force(spark):
    ids, x = vectors(spark)
    want = products(ids, np.floor(64 * x), ids % 20 == 0, 20)
    assert rows_of(queries.op3_top_products(spark, SF)) == want
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    small = mtree.top_products(df, F.col("id") % 20 == 0, page=16, rows_per_shard=90, tile=7)
    assert rows_of(small) == want


def test_tree_with_ties_and_equal_vectors():
    rng = np.random.default_rng(1)
    for trial in range(20):
        x = rng.integers(-2, 3, (300, 3)).astype(float)
        x[100:200] = x[100]
        ids = rng.permutation(300)
        q = ids[:40]
        at = {int(i): n for n, i in enumerate(ids)}
        tree = mtree.MTree(ids, x, page=8, fan=4)
        rows, found, score = tree.top(q, x[[at[int(i)] for i in q]], 7)
        want = products(ids, x, np.isin(ids, q), 7)
        for n, i in enumerate(q):
            assert list(zip(found[rows == n].tolist(), score[rows == n].tolist())) == want[int(i)], trial


def test_pages_hold_covering_radii_and_parent_distances():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4))
    t = mtree.MTree(np.arange(500), x, page=16, fan=4)
    norms = (x * x).sum(1)
    aug = np.c_[x, np.sqrt(np.maximum(t.m2 - norms, 0))]

    def below(node):
        leaf, rows, _, _, children = t.pages[node]
        return list(rows) if leaf else [r for c in children for r in below(int(c))]
    for leaf, rows, _, radius, children in t.pages:
        if not leaf:
            for r, cover, child in zip(rows, radius, children):
                d = np.sqrt(((aug[below(int(child))] - aug[r]) ** 2).sum(1))
                assert d.max() <= cover + 1e-6
                child_rows, to_parent = t.pages[int(child)][1:3]
                assert np.allclose(np.sqrt(((aug[child_rows] - aug[r]) ** 2).sum(1)), to_parent)


def neighbours(ids, x, queries_, k):
    out = {}
    for i in np.nonzero(queries_)[0]:
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def test_factor_one_is_exact(spark):
    ids, x = vectors(spark)
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = rows_of(vptree.nearest(df, F.col("id") % 10 == 0, relax=1.0, leaf=8, rows_per_shard=120, tile=9))
    want = neighbours(ids, x, ids % 10 == 0, 10)
    for q, found in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in found]
        assert np.allclose([s for _, s in got[q]], [s for _, s in found], rtol=0, atol=1e-12)


def test_recall(spark):
    sf = "/root/testdata/sf0.1"
    ids, x = vectors(spark, sf)
    got, want = rows_of(queries.op5_nearest(spark, sf)), neighbours(ids, x, ids % 100 == 0, 10)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (20, [0.5, 0.25]), (1, [1.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]),
            (5, [None, 1.0]), (6, [0.0, 0.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (100, [1e6, -1e6]), (8, [])]
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, id string, score double")
    got = rows_of(mtree.top_products(df, F.col("id") % 20 == 0, k=20))
    assert {i for i, _ in got[0]} == {1, 6, 20, 100} and dict(got[0])[20] == 64 * 32 and dict(got[0])[100] == 64 * 64_000_000
    assert got[20][0][0] == 0 or got[20][0][0] == 100
    near = rows_of(vptree.nearest(df, F.col("id") % 100 == 0))
    assert [i for i, _ in near[0]] == [1, 20, 20, 100], "zero vectors and other lengths take no part"
    for f in (mtree.top_products, vptree.nearest):
        assert f(df.limit(0), F.lit(True)).count() == 0
    with pytest.raises(ValueError):
        vptree.nearest(df, F.lit(True), relax=0.5)


def test_products_keep_different_vectors_of_one_id(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(v) for v in rng.integers(-3, 4, 3)]) for i in rng.integers(0, 60, 400)]
    distinct = sorted({(i, tuple(v)) for i, v in rows})
    want = {}
    for q in {i for i, _ in distinct if i % 20 == 0}:
        found = [(int(64 * 64 * np.dot(v, w)), i) for j, v in distinct if j == q for i, w in distinct if i != q]
        want[q] = [(i, s) for s, i in sorted(found, key=lambda x: (-x[0], x[1]))[:20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for rows_per_shard in (16384, 50):
        assert rows_of(mtree.top_products(df, F.col("id") % 20 == 0, page=16, rows_per_shard=rows_per_shard)) == want


def test_nearest_keeps_different_vectors_of_one_id(spark):
    rows = [(0, [1.0, 1.0]), (3, [5.0, 5.0]), (3, [-9.0, 1.1]), (3, [5.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = rows_of(vptree.nearest(df, F.col("id") == 0))[0]
    assert [i for i, _ in got] == [3, 3] and np.allclose([s for _, s in got], [32 ** 0.5, 100.01 ** 0.5])


def test_products_of_large_components(spark):
    rows = [(0, [1e3, 0.0]), (1, [2e6, 0.0]), (2, [3e6, 0.0]), (4, [3e7, 7.0]), (5, [-4e9, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert rows_of(mtree.top_products(df, F.col("id") == 0))[0] == [
        (4, 64_000 * 1_920_000_000), (2, 64_000 * 192_000_000), (1, 64_000 * 128_000_000), (5, -64_000 * 256_000_000_000)]
    far = df.unionAll(spark.createDataFrame([(6, [1e30, 0.0])], df.schema))
    with pytest.raises(Exception, match="the rows 0 and 6 does not fit a long"):
        mtree.top_products(far, F.col("id") == 0).collect()


def test_sql_twins_on_repeated_rows(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(v) / 64 for v in rng.integers(-40, 41, 3)]) for i in rng.integers(0, 300, 500)]
    rows += rows[:50]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    got = sorted((q, i, s) for q, found in rows_of(mtree.top_products(df, F.col("id") % 20 == 0)).items() for i, s in found)
    assert got == sorted((q, i, s) for q, _, i, s in con.execute(queries.ORACLE_SQL["op3_top_products"]).fetchall())
    near = con.execute("""
        WITH v AS (SELECT DISTINCT * FROM embeddings WHERE len(list_filter(embedding, lambda x: x <> 0)) > 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.embedding, c.embedding) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
        SELECT query_id, vec_id, score FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) <= 10""").fetchall()
    found = rows_of(vptree.nearest(df, F.col("id") % 100 == 0, relax=1.0, leaf=8, rows_per_shard=130))
    got = sorted((q, i, round(s, 9)) for q, rows_ in found.items() for i, s in rows_)
    assert got == sorted((q, i, round(s, 9)) for q, i, s in near)
