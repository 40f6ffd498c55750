import random

import pytest

from sessile.llm.near_dedup import NearDedup, drop_near_duplicates, near_duplicates, sketches


def brute(rows, size=5, percent=75):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                parent[find(a)] = find(b)
    out = []
    for k, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((doc_id, len(sets[k]), min(ids) if ids else None))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_random_families(spark):
    rng = random.Random(4)
    rows, vocab = [], [f"v{i}" for i in range(500)]
    passage = [rng.choice(vocab) for _ in range(40)]
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 7, 60, 150]))]
        for _ in range(rng.choice([1, 2, 9])):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(w)))
    # One passage in many texts, alike in nothing else.
    for _ in range(25):
        rows.append((len(rows), " ".join(passage + [rng.choice(vocab) for _ in range(60)])))
    # A chain whose ends are not alike.
    w = [f"c{i}" for i in range(100)]
    for k in range(8):
        rows.append((len(rows), " ".join(w[5 * k : 5 * k + 80])))
    rng.shuffle(rows)
    assert found(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))) == brute(rows)


@pytest.mark.parametrize("part", [3, 2000])
def test_fillings_of_one_template_meet_in_parts(spark, part):
    """Fillings alike enough to share buckets but not to be linked, among them some that are, in a hot bucket."""
    rng = random.Random(8)
    frame, rows = [f"f{i}" for i in range(100)], []
    for _ in range(40):
        tail = [f"t{rng.randrange(10**6)}" for _ in range(27)]
        for _ in range(rng.choice([1, 1, 2, 3])):
            rows.append((len(rows), " ".join(frame + tail + [f"e{rng.randrange(10**6)}"])))
    rng.shuffle(rows)
    got = found(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), NearDedup(part=part)))
    assert got == brute(rows) and 1 < len({c for _, _, c in got}) < len(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    out = near_duplicates(odd_docs)
    assert found(out) == brute(rows)
    kept = {(r.doc_id, r.kept) for r in out.collect()}
    assert {(1, True), (2, False), (3, True), (8, True), (9, False), (None, False)} - kept == {(None, False)} - kept
    left = drop_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    assert {r.doc_id for r in left.collect()} == {1, 3, 4, 5, 6, None, 8, 10, 11}
    assert near_duplicates(no_docs).collect() == [] and drop_near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("size", [1, 2, 50, 3000])
def test_sketch_fills_and_estimates(size):
    import numpy as np

    rng = np.random.default_rng(size)
    both = rng.integers(0, 2**64, size=size * 3, dtype=np.uint64)
    a, b = np.sort(both[: size * 2]), np.sort(both[size:])
    with np.errstate(over="ignore"):
        s = sketches(np.concatenate([a, b]), np.array([len(a), len(b)]), NearDedup().bins)
    assert (s != np.uint64(2**64 - 1)).all()
    if size >= 50:
        assert abs((s[0] == s[1]).mean() - 1 / 3) < 0.12


def test_bands_miss_no_more_than_the_first_ones():
    cfg = NearDedup()
    for percent in range(75, 100):
        s = percent / 100
        assert (1 - s**cfg.band) ** (cfg.bins // cfg.band) <= (1 - s**4) ** 32


@pytest.mark.parametrize("bits", [64, 4096])
def test_bit_maps_never_hide_what_is_shared(bits):
    import numpy as np

    from sessile.llm.near_dedup import bit_maps

    rng = random.Random(bits)
    for size in (1, 30, 400, 5000):
        both = np.array([rng.getrandbits(64) for _ in range(size + size // 7)], dtype=np.uint64)
        a, b = both[:size], both[size // 7 :]
        with np.errstate(over="ignore"):
            x, y = bit_maps(np.concatenate([a, b]), np.array([len(a), len(b)]), bits)
        lacking = lambda p, q: sum(int(v).bit_count() for v in (p & ~q).view(np.uint64))
        assert min(len(a) - lacking(x, y), len(b) - lacking(y, x)) >= len(np.intersect1d(a, b))


@pytest.mark.parametrize("same", [7, None])
def test_rows_that_share_an_id_or_have_none(spark, same):
    """Many texts under one id, near copies and others: what is fetched doesn't grow with the square of their number."""
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(300)]
    base = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for k in range(600):
        w = list(base) if k % 2 else [rng.choice(vocab) for _ in range(60)]
        w[rng.randrange(60)] = f"x{k}"
        rows.append((same, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = near_duplicates(df).toPandas()
    assert len(out) == 600 and (out.n_shingles > 50).all()
    assert (out.component_id == 7).all() and out.kept.all() if same else out.component_id.isna().all() and out.kept.all()
