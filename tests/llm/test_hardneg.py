import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lossline.llm import hardneg, queries


def plain(rows, is_anchor, positives=5, negatives=3, low=50, high=95, scale=256.0):
    """Brute force over (id, label, vector) rows."""
    rows = sorted({(i, c, tuple(v)) for i, c, v in rows if i is not None and c is not None and v is not None
                   and all(x is not None and np.isfinite(x) for x in v)})
    floored = [[int(np.floor(scale * x)) for x in v] for _, _, v in rows]
    out = []
    for a, (i, c, v) in enumerate(rows):
        if not is_anchor(i):
            continue
        scored = [(sum(p * q for p, q in zip(floored[a], floored[b])), j, d) for b, (j, d, w) in enumerate(rows)
                  if j != i and len(w) == len(v)]
        best = sorted((-s, j) for s, j, d in scored if d == c)[:positives]
        for s, p in best:
            s = -s
            hits = sorted((-n, j) for n, j, d in scored if d != c and low * s <= 100 * n <= high * s)[:negatives]
            out += [(i, p, r + 1, j, s, -n) for r, (n, j) in enumerate(hits)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                              "negative_score").collect())


def test_strassen_is_exact():
    rng = np.random.default_rng(1)
    for m, k, n, leaf in [(1, 1, 1, 1), (7, 5, 3, 1), (33, 17, 65, 4), (64, 64, 64, 8), (100, 64, 333, 16), (5, 0, 4, 2)]:
        a, b = rng.integers(-2 ** 20, 2 ** 20, (m, k)), rng.integers(-2 ** 20, 2 ** 20, (k, n))
        assert (hardneg.strassen(a, b, leaf) == a @ b).all(), (m, k, n)
    # sums inside the recursion wrap, the result does not
    a, b = np.full((8, 8), 2 ** 30), np.full((8, 8), 2 ** 29)
    a[:, ::2] *= -1
    assert (hardneg.strassen(a, b, 1) == a @ b).all()


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(2)
    score, ids = rng.integers(-3, 4, (20, 90)), np.arange(90) * 2
    score[rng.random(score.shape) < 0.2] = hardneg.NONE
    whole, parts = hardneg.Heaps(20, 4), hardneg.Heaps(20, 4)
    whole.offer(np.arange(20), score, ids)
    for at in rng.permutation(9):
        own = hardneg.Heaps(20, 4)
        own.offer(np.arange(20), score[:, at * 10:at * 10 + 10], ids[at * 10:at * 10 + 10])
        parts.merge(np.arange(20), own.score, own.id)
    assert (whole.score == parts.score).all()
    assert (np.where(whole.score == hardneg.NONE, 0, whole.id) == np.where(parts.score == hardneg.NONE, 0, parts.id)).all()
    for i in range(20):
        want = sorted((-s, j) for s, j in zip(score[i].tolist(), ids.tolist()) if s != hardneg.NONE)[:4]
        assert [(-s, j) for s, j in zip(whole.score[i].tolist(), whole.id[i].tolist())] == want


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_equals_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet'")
    want = sorted(con.execute(queries.ORACLE_SQL["op11_hard_negatives"]).fetchall())
    got = rows_of(queries.op11_hard_negatives(spark, path))
    assert got == want and len(got) > 30
    if sf == "sf0.01":
        v = spark.read.parquet(f"{path}/embeddings.parquet").withColumn(
            "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
        small = hardneg.hard_negatives(v, F.col("id") % 50 == 0, rows_per_shard=37, tile=3)
        assert rows_of(small) == got


def test_ties_repeated_rows_and_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), int(c), [float(x) for x in rng.integers(-1, 3, 3)]) for i, c in zip(rng.integers(0, 80, 500), rng.integers(0, 3, 500))]
    nan, inf = float("nan"), float("inf")
    rows += [(None, 1, [1.0, 1.0, 1.0]), (200, None, [1.0, 1.0, 1.0]), (201, 1, None), (202, 1, [nan, 1.0, 1.0]),
             (203, 1, [inf, 1.0, 1.0]), (204, 1, [None, 1.0, 1.0]), (205, 1, [1.0, 2.0]), (210, 2, [1.0, 2.0]), (206, 1, [])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, row int, side string")
    want = plain(rows, lambda i: i % 5 == 0)
    for rows_per_shard in (16384, 40):
        assert rows_of(hardneg.hard_negatives(df, F.col("id") % 5 == 0, rows_per_shard=rows_per_shard, tile=7)) == want
    assert hardneg.hard_negatives(df.limit(0), F.lit(True)).count() == 0


def test_large_components(spark):
    rows = [(0, 1, [2e6, 1.0]), (1, 1, [3e6, 0.0]), (2, 2, [2e6, 5.0]), (3, 2, [1.6e6, 0.0]), (4, 2, [2e7, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert rows_of(hardneg.hard_negatives(df, F.col("id") == 0)) == plain(rows, lambda i: i == 0)
    far = spark.createDataFrame(rows + [(5, 2, [1e30, 0.0])], df.schema)
    with pytest.raises(Exception, match="the rows 0 and 5 does not fit a long"):
        hardneg.hard_negatives(far, F.col("id") == 0).collect()
