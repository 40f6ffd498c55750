import zlib

import numpy as np
import pytest

from sessile.llm import toxicity as tx
from sessile.llm.queries import op11_toxicity


def vectors(rng, n, n_terms, most=6):
    rows = [np.sort(rng.choice(n_terms, rng.integers(0, min(most, n_terms) + 1), replace=False)) for _ in range(n)]
    starts = np.r_[0, np.cumsum([len(r) for r in rows])]
    terms = np.concatenate(rows).astype(np.int64)
    counts = rng.integers(1, 4, len(terms))
    return terms, counts, starts


def brute(index_vectors, ids, queries, k):
    """Of each query, (example, similarity) of all examples that share a term, best first, ties to the smaller id."""
    (t, w, s), (qt, qw, qs) = index_vectors, queries
    maps = [dict(zip(t[a:b].tolist(), w[a:b].tolist(), strict=True)) for a, b in zip(s, s[1:], strict=False)]
    out = []
    for a, b in zip(qs, qs[1:], strict=False):
        q = list(zip(qt[a:b].tolist(), qw[a:b].tolist(), strict=True))
        score = [round(sum(m[x] * y for x, y in q if x in m), 9) for m in maps]
        order = sorted((i for i in range(len(maps)) if score[i] > 0), key=lambda i: (-score[i], ids[i]))[:k]
        out.append([(i, score[i]) for i in order])
    return out


@pytest.mark.parametrize("n, n_terms, block, k", [(300, 12, 8, 7), (1000, 60, 64, 15), (5, 3, 64, 15), (0, 4, 8, 3)])
def test_neighbours_are_exact(n, n_terms, block, k):
    rng = np.random.default_rng(n)
    idf = rng.uniform(0.5, 3, n_terms)
    t, c, s = vectors(rng, n, n_terms) if n else (np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(1, np.int64))
    w = tx.unit_vectors(t, c, s, idf)
    ids = rng.permutation(n) * 3
    index = tx.BlockMaxIndex(t, w, s, ids, n_terms, block)
    qt, qc, qs = vectors(rng, 200, n_terms)
    qw = tx.unit_vectors(qt, qc, qs, idf)
    near, cosine, visits = index.nearest(qt, qw, qs, k)
    for row, sims, expected in zip(near, cosine, brute((t, w, s), ids, (qt, qw, qs), k), strict=True):
        assert row[row >= 0].tolist() == [i for i, _ in expected]
        assert np.allclose(sims[row >= 0], [x for _, x in expected], atol=2e-9)
    if n == 1000:
        # Bounds skip blocks.
        assert visits < 0.8 * 200 * index.n_blocks


def rows_of(out):
    return {r.doc_id: r for r in out.collect()}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = rows_of(op11_toxicity(spark, sf))
    assert len(out) == 10000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    held = [(out[r.doc_id], r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if out[r.doc_id].held_out]
    toxic, clean = [r.score for r, q in held if q == 1], [r.score for r, q in held if q == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in toxic for b in clean])
    # About a tenth of the toxic labels here are of documents without any word that tells.
    assert auc > 0.94
    assert np.mean([r.predicted == q for r, q in held]) > 0.97
    assert np.mean([r.predicted for r, q in held if q == 0]) < 0.01
    # Calibrated: scores add up to the number of toxic documents.
    assert abs(sum(r.score for r, _ in held) - len(toxic)) < 0.25 * len(toxic)


def docs_and_labels(spark, rng, n=600):
    """Documents whose label is whether they hold one of two words; some copies, some without a label."""
    words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(n):
        text = [str(x) for x in rng.choice(words, 30)]
        bad = i % 5 == 1
        if bad:
            text[int(rng.integers(30))] = ["Vile", "grim."][i % 2]
        rows.append((i, " ".join(text), "x"))
        labels.append((i, int(bad)))
    rows += [(n + k, rows[1][1], None) for k in range(50)]
    labels += [(n + k, 0) for k in range(50)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5), spark.createDataFrame(labels, "doc_id long, label int")


def test_words_that_tell_and_copies(spark):
    docs, labels = docs_and_labels(spark, np.random.default_rng(1))
    params = tx.ToxicityParams()
    sample = tx._sample(docs, labels, params)
    # Fifty copies with the wrong label are one example.
    texts = [r.text for r in sample.filter("not calibrate").collect()]
    assert len(texts) == len(set(texts))
    model, vectors = tx.fit(docs, labels, params)
    assert set(model.terms) == {"vile", "grim"}
    n, df = docs.count(), {t: docs.filter(f"lower(text) rlike '\\\\b{t}\\\\b'").count() for t in model.terms}
    assert np.allclose(model.idf, [1 + np.log((1 + n) / (1 + df[t])) for t in model.terms])
    out = rows_of(tx.score(vectors, model))
    good = [out[i].score > 0.5 for i in range(600) if i % 5 == 1]
    assert np.mean(good) > 0.98 and max(out[i].score for i in range(600) if i % 5 != 1) < 0.5
    near = out[6].evidence
    assert 1 <= len(near) <= params.evidence and all(e.label in (0, 1) and 0 < e.cosine <= 1 + 1e-9 for e in near)
    held = {i for i in range(650) if zlib.crc32(str(i).encode()) % 5 in (0, 4)}
    assert not held & {e.doc_id for r in out.values() for e in r.evidence}


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 6, 6, 8, 9, 10, 11)] + [(3, None), (None, 1)], "doc_id long, label int")
    out = tx.classify(odd_docs, labels)
    assert out.count() == odd_docs.count() and out.filter("score is null or score < 0 or score > 1").count() == 0
    assert tx.classify(odd_docs, labels.filter("false")).filter("score <> 0").count() == 0
    assert tx.classify(no_docs, labels).collect() == []


def test_outcome_does_not_depend_on_partitions(spark):
    docs, labels = docs_and_labels(spark, np.random.default_rng(3), 300)
    a, b = (sorted(tx.classify(d, labels).collect()) for d in (docs, docs.repartition(11).union(docs.limit(0))))
    assert a == b
