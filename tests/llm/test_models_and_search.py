import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from sessile.llm import quality_classifier as qc
from sessile.llm.lm_scoring import Backoff, score_documents
from sessile.llm.queries import op2_quality_classifier
from sessile.llm.topk_search import Index, TopK, chosen_levels, cuts, multiplications, scaled, search_block, signature, tail, top_k
from sessile.storage import _FREE


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in op2_quality_classifier(spark, sf).collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out.values())
    held = [(out[r.doc_id], r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if out[r.doc_id].held_out]
    good, bad = [r.score for r, q in held if q == 1], [r.score for r, q in held if q == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95
    assert np.mean([r.predicted == q for r, q in held]) > 0.95


def test_classifier_of_odd_rows(spark, odd_docs, no_docs):
    stats = odd_docs.select("doc_id", qc.statistics(F.col("text")).alias("stats"))
    labels = spark.createDataFrame([(i, i % 2, None) for i in (1, 2, 6, 8, 9, 10, 11, 11)] + [(3, None, 1)], "doc_id long, quality int, toxic int")
    model = qc.fit_on_labels(stats, labels)
    out = qc.classify(odd_docs, model)
    assert out.count() == odd_docs.count() and out.filter("quality_score is null or quality_score < 0 or quality_score > 1").count() == 0
    nothing = qc.fit_on_labels(stats, labels.filter("false"))
    assert qc.classify(odd_docs, nothing).filter("abs(quality_score - 0.5) < 0.01").count() == odd_docs.count()
    assert qc.classify(no_docs, nothing).collect() == []


def test_isotonic_blocks():
    x, y = qc._isotonic(np.array([1.0, 2.0, 3.0, 4.0]), np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4))
    assert list(y) == [0.0, 0.5, 1.0] and list(x) == [1.0, 2.5, 4.0]


def test_ridge_and_calibration_match_dense_solutions(spark):
    """Fourier features, normal equations and isotonic levels against NumPy on all rows at once."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 4)) * [1, 5, 0.2, 3] + [0, 2, 0, -1]
    y = (np.sin(x[:, 0]) + 0.3 * x[:, 2] + rng.normal(size=600) * 0.3 > 0).astype(int)
    held = np.arange(600) % 4 == 0
    rows = [([float(v) for v in a], int(b), bool(c)) for a, b, c in zip(x, y, held, strict=True)]
    params = qc.QualityParams(features=40, ridge=0.7)
    model = qc.fit(spark.createDataFrame(rows, "stats array<double>, label int, calibrate boolean").repartition(7), params)
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, x.std(axis=0))
    z = np.cos(np.clip((x - x.mean(axis=0)) / x.std(axis=0), -6, 6) @ model.omega + model.phase) * np.sqrt(2 / 40)
    z = np.hstack([z, np.ones((600, 1))])
    # Ridge as least squares: a row for each weight that is held small, none for the constant.
    small = np.hstack([np.sqrt(0.7) * np.eye(40), np.zeros((40, 1))])
    dense = np.linalg.lstsq(np.vstack([z[~held], small]), np.r_[y[~held], np.zeros(40)], rcond=None)[0]
    raw = z @ dense
    assert np.allclose(model.raw(x), raw, atol=1e-8)
    # A Gaussian kernel is what the features' inner products tend to.
    many = qc.fit(spark.createDataFrame(rows, "stats array<double>, label int, calibrate boolean"), qc.QualityParams(features=1500))
    f, u = many.fourier(x[:30])[:, :-1], (x[:30] - x.mean(axis=0)) / x.std(axis=0)
    kernel = np.exp(-((u[:, None] - u[None]) ** 2).sum(axis=2) / (2 * 4))
    assert abs(f @ f.T - kernel).max() < 0.2
    cell = np.floor((np.clip(raw[held], qc._LOW, qc._HIGH) - qc._LOW) * (qc._BINS / (qc._HIGH - qc._LOW))).astype(int)
    cells = np.unique(cell)
    n, total = (np.array([f(cell == c) for c in cells], float) for f in (lambda m: m.sum(), lambda m: y[held][m].sum()))
    mean = lambda a, b: total[a : b + 1].sum() / n[a : b + 1].sum()
    levels = [max(min(mean(a, b) for b in range(i, len(cells))) for a in range(i + 1)) for i in range(len(cells))]
    at = np.array([raw[held][cell == c].mean() for c in cells])
    pooled = {level: np.average(at[np.isclose(levels, level)], weights=n[np.isclose(levels, level)]) for level in levels}
    assert np.allclose(sorted(set(np.round(model.levels, 9))), sorted(set(np.round(levels, 9)))) and np.allclose(sorted(model.knots), sorted(set(np.round(list(pooled.values()), 12))), atol=1e-6)


def brute_scores(rows, cfg):
    words = [(t or "").encode().lower().split() for _, t in rows]
    c1, c2 = Counter(w for d in words for w in d), Counter(p for d in words for p in zip(d, d[1:], strict=False))
    total, out = sum(c1.values()), []
    for (doc_id, _), w in zip(rows, words, strict=True):
        o1, o2 = (Counter(w), Counter(zip(w, w[1:], strict=False))) if cfg.leave_out else (Counter(), Counter())
        n, score, hits = max(1, total - len(w) * cfg.leave_out), 0.0, 0
        for i, x in enumerate(w):
            single = (c1[x] - o1[x]) / n or cfg.factor / (n + 1)
            pair = c2[w[i - 1], x] - o2[w[i - 1], x] if i else 0
            hits += pair > 0
            score += math.log(pair / max(1, c1[w[i - 1]] - o1[w[i - 1]]) if pair > 0 else single if i == 0 else cfg.factor * single)
        out.append((str(doc_id), len(w), hits, round(score, 6)))
    return sorted(out)


def test_backoff_matches_plain_counts(spark, sf, odd_docs, no_docs):
    for df in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        for cfg in (Backoff(block_chars=50_000, order=2), Backoff(leave_out=False, order=2)):
            got = sorted((str(r.doc_id), r.n_words, r.n_bigrams_found, round(r.log_score, 6)) for r in score_documents(df, cfg).collect())
            assert got == brute_scores(rows, cfg)
    assert score_documents(no_docs).collect() == []


def test_scores_of_many_alike_rows_and_clashing_names(spark):
    """A third of the rows alike in id and text, rows without id; they fill many blocks, and columns of any name don't matter."""
    rows = [(None, "same words in every row of these", "x")] * 300 + [(7, "same words in every row of these", "y")] * 300 + [(i, f"word{i % 9} word{i % 7} same words in some rows", "z") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, hash string").withColumns({c: F.lit(1) for c in ("block", "row", "n", "total", "of", "to_block")})
    got = score_documents(df, Backoff(block_chars=500)).collect()
    assert sorted((str(r.doc_id), r.n_words, round(r.log_score, 5)) for r in got) == brute_scores_of_order([r[:2] for r in rows], 3, True)


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(400, 24)).astype(np.float32)
    vectors[50:60] = vectors[50]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    bad = [(1000, None), (1001, [1.0, None]), (1002, [float("nan")] * 24), (1003, [float("inf")] * 24), (None, [1.0] * 24), (1020, []), (1021, []), (1040, [1.0, 2.0]), (7, rows[7][1])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("vector", scaled(F.col("embedding")))
    out = top_k(df.withColumn("score", F.lit("x")), F.col("vec_id") % 20 == 0, TopK(query_block=8, candidate_block=64)).collect()
    ints = np.floor(vectors.astype(float) * 64).astype(int)
    expected = []
    for q in range(0, 400, 20):
        scores = sorted((-int(ints[q] @ ints[c]), c) for c in range(400) if c != q)[:20]
        expected += [(q, k + 1, c, -s) for k, (s, c) in enumerate(scores)]
    expected.append((1020, 1, 1021, 0))
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == sorted(expected)
    assert top_k(df.filter("false"), F.col("vec_id") % 20 == 0).collect() == []


def test_signatures_bound_the_inner_product():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-60, 60, size=(50, 64)), rng.integers(-60, 60, size=(60, 64))
    last = None
    for n in (1, 4, 16, 64):
        starts = cuts(np.ones(64), n)
        bound = signature(a, starts) @ signature(b, starts).T
        assert (bound >= a @ b.T - 1e-6).all() and (last is None or bound.sum() <= last + 1e-6)
        last = bound.sum()
    assert np.allclose(last, (a @ b.T).sum())


def test_segments_have_equal_variance():
    assert list(cuts(np.ones(8), 4)) == [0, 2, 4, 6] and list(cuts(np.ones(3), 9)) == [0, 1, 2]
    assert list(cuts(np.array([8.0, 4.0, 2.0, 1.0, 1.0]), 2)) == [0, 1]
    for n in (1, 2, 7, 30):
        starts = cuts(np.exp(-np.arange(30.0)), n)
        assert len(starts) == n and starts[0] == 0 and (np.diff(starts) > 0).all() and starts[-1] < 30


def test_search_goes_through_its_bounds():
    """Most pairs end at a level, also among vectors without any structure; cells that can't hold a result are left out."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 64))
    x = np.floor(64 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)
    variance, basis = np.linalg.eigh(np.cov(x.T.astype(float)))
    index, ids = Index(basis[:, ::-1], variance[::-1], TopK(), 0), np.arange(3000)
    found, left = search_block(ids[:100], x[:100], np.full(100, -np.inf), ids, x, index, TopK())
    assert left[-1] < 0.2 * left[0] and (np.diff(left) <= 0).all()
    for q, at, scores in found:
        exact = x @ x[q]
        order = [c for c in np.lexsort((ids, -exact)) if c != q][:20]
        assert list(at) == order and list(scores) == list(exact[order])
    none, _ = search_block(ids[:5], x[:5], np.full(5, 1e9), ids, x, index, TopK())
    assert all(len(at) == 0 for _, at, _ in none)


def test_top_k_over_cells(spark):
    """Clusters far apart: several cells, a hot one, a query whose cell has fewer than k vectors."""
    rng = np.random.default_rng(5)
    centres = 40 * rng.normal(size=(6, 10))
    x = np.floor(np.vstack([centres[i % 5] + rng.normal(size=10) for i in range(300)] + [centres[5] + rng.normal(size=(3, 10))] + [centres[0] + rng.normal(size=(300, 10))])).astype(int)
    df = spark.createDataFrame([(i, [int(v) for v in row], i) for i, row in enumerate(x)], "vec_id long, vector array<long>, cell int")
    cfg = TopK(k=5, query_block=16, candidate_block=32)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(df, (F.col("vec_id") % 20 == 0) | (F.col("vec_id") == 301), cfg).collect())
    expected = []
    for q in [*range(0, len(x), 20), 301]:
        scores = sorted((-int(x[q] @ x[c]), c) for c in range(len(x)) if c != q)[:5]
        expected += [(q, k + 1, c, -s) for k, (s, c) in enumerate(scores)]
    assert got == sorted(expected)


def brute_scores_of_order(rows, order, leave_out, factor=0.4):
    words = [(t or "").encode().lower().split() for _, t in rows]
    grams = lambda w: Counter(tuple(w[i : i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1))
    every, out = Counter(), []
    for w in words:
        every.update(grams(w))
    total = sum(map(len, words))
    for (doc_id, _), w in zip(rows, words, strict=True):
        own, score = grams(w) if leave_out else Counter(), 0.0
        n = max(1, total - len(w) * leave_out)
        for i in range(len(w)):
            one, weight = every[(w[i],)] - own[(w[i],)], 1.0
            s = one / n if one else factor / (n + 1)
            for k in range(min(order, i + 1), 1, -1):
                g = tuple(w[i - k + 1 : i + 1])
                if every[g] > own[g]:
                    s = (every[g] - own[g]) / max(1, every[g[:-1]] - own[g[:-1]])
                    break
                weight *= factor
            score += math.log(weight * s)
        out.append((str(doc_id), len(w), round(score, 5)))
    return sorted(out)


def test_backoff_of_higher_orders(spark, sf, odd_docs):
    for df, order, leave_out in ((spark.read.parquet(f"{sf}/documents.parquet"), 3, True), (odd_docs, 4, True), (odd_docs, 3, False)):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        got = score_documents(df, Backoff(block_chars=50_000, order=order, leave_out=leave_out)).collect()
        assert sorted((str(r.doc_id), r.n_words, round(r.log_score, 5)) for r in got) == brute_scores_of_order(rows, order, leave_out)


def test_scores_of_an_input_that_comes_in_another_order_each_time(spark):
    """Rows out of an aggregate, in an order that no two readings of it share."""
    import os

    rows = [(i, f"w{i % 11} w{i % 5} w{i % 3} and w{i % 7} again") for i in range(400)]

    def mixed(batches):
        import pyarrow as pa

        for batch in batches:
            rng = np.random.default_rng(int.from_bytes(os.urandom(4), "big"))
            yield batch.take(pa.array(rng.permutation(batch.num_rows)))

    grouped = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).groupBy("doc_id").agg(F.first("text").alias("text"))
    got = score_documents(grouped.mapInArrow(mixed, "doc_id long, text string"), Backoff(block_chars=400)).collect()
    assert sorted((str(r.doc_id), r.n_words, round(r.log_score, 5)) for r in got) == brute_scores_of_order(rows, 3, True)


def _shuffle_files(spark):
    """Names of the shuffle files that a local session has on its disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_scores_by_slices_and_parts_free_their_shuffle_files(spark):
    """Any number of slices and parts gives the same scores, and no shuffle file of counts or scores stays."""
    import time

    was_on = spark.conf.get(_FREE)
    before = _shuffle_files(spark)
    rows = [(i, f"W{i % 11} w{i % 5}\x0bw{i % 3} and\tw{i % 7} again " + "a b c " * (i % 4)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for cfg in (Backoff(block_chars=400, slices=1, parts=1), Backoff(block_chars=900, slices=7, parts=3)):
        out = score_documents(df, cfg)
        got = sorted((str(r.doc_id), r.n_words, round(r.log_score, 5)) for r in out.collect())
        assert got == brute_scores_of_order(rows, 3, True)
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(_FREE) == was_on


def test_levels_cost_less_than_they_save():
    """The chosen levels take fewer multiplications a pair than the score alone where something tells vectors apart."""
    rng = np.random.default_rng(2)
    spread = np.floor(rng.normal(size=(1500, 64)) * 60 * np.exp(-np.arange(64) / 9)).astype(np.int64)
    alike = np.floor(60 * rng.normal(size=(60, 4))).astype(np.int64)
    for x, pays in ((spread, True), (alike, False)):
        size = x.shape[1]
        variance, basis = np.linalg.eigh(np.cov(x.T.astype(float)))
        index = Index(basis[:, ::-1], variance[::-1], TopK(), 0)
        levels, shares = chosen_levels(x, index, TopK())
        assert levels and len(shares) == len(levels) + 1 and (not pays or multiplications(shares, levels, size) < 0.6 * size)
        index.levels, ids = levels, np.arange(len(x))
        found, left = search_block(ids[:50], x[:50], np.full(50, -np.inf), ids, x, index, TopK())
        assert len(left) == len(levels) + 1
        for q, at, scores in found:
            exact = x @ x[q]
            order = [c for c in np.lexsort((ids, -exact)) if c != q][:20]
            assert list(at) == order and list(scores) == list(exact[order])
    turned = spread.astype(float)
    for first in (0, 5, 63, 64):
        bound = turned[:40, :first] @ turned[:, :first].T + tail(turned[:40], first) @ tail(turned, first).T
        assert (bound >= spread[:40] @ spread.T - 1e-6).all()
