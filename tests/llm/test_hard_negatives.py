import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sessile.llm import oracles
from sessile.llm.hard_negatives import HardNegatives, Operand, hard_negatives, moduli, products, scaled
from sessile.llm.queries import op13_hard_negatives


@pytest.mark.parametrize("width, size", [(64, 300), (64, 10**6), (1, 5), (3, 2**29), (2500, 4000), (0, 1)])
def test_products_are_exact(width, size):
    rng = np.random.default_rng(width)
    a, b = (rng.integers(-size, size + 1, (n, width)) for n in (37, 23))
    found = products(Operand(a), Operand(b), slice(5, 30))
    expected = a[5:30].astype(object) @ b.T.astype(object) if width else np.zeros((25, 23), object)
    assert found.dtype == np.int64 and (found.astype(object) == expected).all()


def test_extremes_and_overflow():
    a = Operand(np.array([[2**31, 2**31 - 1], [-(2**31), 2**31 - 1]]))
    found = products(a, a, slice(0, 2)).tolist()
    assert found == [[2**62 + (2**31 - 1) ** 2, -(2**62) + (2**31 - 1) ** 2], [-(2**62) + (2**31 - 1) ** 2, 2**62 + (2**31 - 1) ** 2]]
    big = Operand(np.array([[2**40, 2**40]]))
    with pytest.raises(OverflowError):
        products(big, big, slice(0, 1))


@pytest.mark.parametrize("width", [1, 3, 64, 1000, 1024])
def test_moduli_keep_float32_exact(width):
    primes = moduli(10**12, width)
    assert all(width * (p // 2) ** 2 <= 1 << 24 for p in primes) and len(set(primes)) == len(primes)
    assert all(p % q for p in primes for q in range(2, int(p**0.5) + 1))
    assert np.prod([float(p) for p in primes]) > 2e12


def brute(rows, anchors, cfg):
    rows = sorted(set(rows))
    out = []
    for a, label, x in rows:
        if a not in anchors:
            continue
        score = lambda y: sum(p * q for p, q in zip(x, y, strict=True))
        alike = [r for r in rows if len(r[2]) == len(x)]
        near = sorted(((-score(v), i) for i, other, v in alike if other == label and i != a))[: cfg.positives]
        for ps, p in near:
            far = sorted((-score(v), i) for i, other, v in alike if other != label and -cfg.low * ps <= 100 * score(v) <= -cfg.high * ps)
            out += [(a, p, rank + 1, i, -ps, -s) for rank, (s, i) in enumerate(far[: cfg.negatives])]
    return sorted(out)


@pytest.mark.parametrize("cfg", [HardNegatives(), HardNegatives(positives=3, negatives=4, anchor_block=7, candidate_block=30, chunk=4)])
def test_against_brute_force(spark, cfg):
    rng = np.random.default_rng(5)
    # Few directions and small numbers: many ties, and negative, zero and equal scores.
    rows = [(int(i), int(rng.integers(3)), tuple(int(v) for v in rng.integers(-2, 4, 6))) for i in range(250)]
    rows += [(1000 + i, i % 3, rows[0][2]) for i in range(60)] + [(2000 + i, 1, (5, 1)) for i in range(4)] + [(2100 + i, 2, (2, 1)) for i in range(4)]
    df = spark.createDataFrame(rows + rows[:20], "vec_id long, label int, vector array<long>").repartition(5)
    out = hard_negatives(df, F.col("vec_id") % 10 == 0, cfg)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, {r[0] for r in rows if r[0] % 10 == 0}, cfg)


def test_odd_rows(spark):
    rows = [
        (0, 1, [1.0, 0.5], 9), (1, 1, [1.0, 0.25], 9), (2, 2, [0.5, 0.25], 9), (2, 2, [0.5, 0.25], 9), (3, None, [1.0, 1.0], 9), (4, 2, None, 9), (5, 2, [1.0, None], 9),
        (6, 2, [float("nan"), 1.0], 9), (7, 2, [float("inf"), 1.0], 9), (None, 2, [0.5, 0.5], 9), (8, 2, [0.5], 9), (100, 1, [], 9), (101, 1, [], 9), (102, 2, [], 9), (0, 2, [0.5, 0.5], 9),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, part int").withColumn("row", F.lit("x"))
    out = hard_negatives(df.withColumn("vector", scaled(F.col("embedding"))), F.col("vec_id") % 100 == 0)
    first = 256 * 256 + 128 * 64
    # The row that shares the anchor's id is a negative, as its label differs; vectors without components score 0.
    assert sorted(tuple(r) for r in out.collect() if r.positive_id != 2) == [(0, 1, 1, 0, first, 256 * 128 + 128 * 128), (0, 1, 2, 2, first, 256 * 128 + 128 * 64), (100, 101, 1, 102, 0, 0)]
    assert hard_negatives(df.withColumn("vector", scaled(F.col("embedding"))).limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_query_matches_its_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    expected = sorted(con.sql(f"select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ({oracles.HARD_NEGATIVES})").fetchall())
    assert expected and sorted(tuple(r) for r in op13_hard_negatives(spark, sf).collect()) == expected
