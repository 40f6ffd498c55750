import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from sessile.llm.line_dedup import LineDedup, dedup_lines
from sessile.llm.mixing import Mix, mix_documents, mixed_report, passes, plan_mix


def test_templates_are_dropped_but_for_the_first(spark):
    docs = [(i, f"only here {chr(97 + i) * 5} words of its own kind\nPage {i} of 30 - printed on 2024-01-{i:02d} by user{i}\nShared boilerplate line that all of them have") for i in range(8)]
    docs += [(100, "Page of something else entirely, not printed by anyone at all\nword"), (101, None), (102, ""), (103, "12\n34\n\n56")]
    out = {r.doc_id: r for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert out[0].dropped_lines == [] and out[0].text == docs[0][1]
    for i in range(1, 8):
        assert sorted(out[i].dropped_lines) == [1, 2] and out[i].text == docs[i][1].split("\n")[0]
    assert all(out[i].dropped_lines == [] for i in (100, 101, 102, 103)) and out[101].text is None and out[103].text == docs[-1][1]


def test_variable_fields_generalise_beyond_digits(spark):
    names = ["anna", "berta", "clara", "dora", "emma", "frieda"]
    docs = [(i, f"user {'logged'} in as {n} from the north gate today") for i, n in enumerate(names)]
    docs += [(10 + i, f"user logged in and {w} {w[::-1]} {w * 2} then left") for i, w in enumerate(names)]
    out = {r.doc_id: r.dropped_lines for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out[0] == [] and all(out[i] == [0] for i in range(1, 6))
    assert all(out[10 + i] == [] for i in range(6)), "too little stays constant"


def test_exact_lines_match_brute_force(spark, sf):
    """Lines without digits and of fewer than 6 tokens are templates only as they stand."""
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    lines = [(r.doc_id, n, tuple(x.split())) for r in df.collect() for n, x in enumerate((r.text or "").split("\n")) if x.split()]
    docs = {}
    for d, _, w in lines:
        docs.setdefault(w, set()).add(d)
    seen, expected = set(), set()
    for d, n, w in sorted(lines):
        if len(w) < 6 and not re.search("[0-9]", " ".join(w)) and len(docs[w]) >= LineDedup().min_docs:
            expected |= {(d, n)} if w in seen else set()
            seen.add(w)
    short = {(d, n) for d, n, w in lines if len(w) < 6 and not re.search("[0-9]", " ".join(w))}
    got = {(r.doc_id, n) for r in dedup_lines(df).collect() for n in r.dropped_lines}
    assert got & short == expected and expected


def test_odd_rows(odd_docs, no_docs):
    out = dedup_lines(odd_docs)
    assert out.columns == [*odd_docs.columns, "dropped_lines"] and out.count() == odd_docs.count()
    assert sorted(str(r.text) for r in out.collect()) == sorted(str(r.text) for r in odd_docs.collect())
    assert dedup_lines(no_docs).collect() == [] and mixed_report(no_docs).collect() == [] and mix_documents(no_docs).collect() == []


def expected_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight, full, total = {s: 1 + i % 3 for i, s in enumerate(names)}, set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        level = (total - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in free) if free else 0
        new = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not new:
            return {s: 3 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= new


def check_mix(df, tolerance=0.51):
    source = {}
    rows = df.select("doc_id", "text", "source").collect()
    sizes = Counter({r.source: 0 for r in rows})
    for r in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        sizes[r.source] += n
        source.setdefault((r.doc_id, n), []).append(r.source)
    target, taken = expected_targets(sizes), Counter()
    out = mixed_report(df, Mix(bucket_docs=16)).collect()
    assert sorted(map(str, ((r.doc_id, r.size) for r in out))) == sorted(map(str, (k for k, v in source.items() for _ in v)))
    for r in out:
        names = [s for s in source[r.doc_id, r.size] if sizes[s] == r.source_size and abs(target[s] - r.target) < 1e-6 * max(1, r.target)]
        assert names and 0 <= r.taken <= 3 * r.size
        taken[names[0]] += r.taken
    assert all(abs(taken[s] - target[s]) <= tolerance for s in target)
    again = {(r.doc_id, r.size, r.taken) for r in mixed_report(df.repartition(7), Mix(bucket_docs=16)).collect()}
    assert again == {(r.doc_id, r.size, r.taken) for r in out}
    at = [r.first_position for r in out if r.first_position is not None]
    assert at == sorted(at) and all(-1e-9 <= x <= 1 for x in at)
    return out


def test_mix_matches_targets(spark, sf, odd_docs):
    check_mix(spark.read.parquet(f"{sf}/documents.parquet"))
    small = [(i, "w " * n, s) for i, (n, s) in enumerate([(5, "a"), (500, "b"), (300, "b"), (1, "c"), (40, None), (0, "d")])]
    check_mix(spark.createDataFrame(small, "doc_id long, text string, source string"))
    check_mix(odd_docs)


def test_mixed_corpus_has_the_words_that_were_taken(spark, sf, odd_docs):
    for df in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        report = mixed_report(df).collect()
        out = mix_documents(df)
        assert out.columns == df.columns
        words = Counter()
        for r in out.collect():
            words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        taken = Counter()
        for r in report:
            taken[r.doc_id] += r.taken
        assert +words == +taken


def plain_lines(rows, cfg=LineDedup()):
    """Dropped lines ``(doc, line_no)`` of rows with distinct ids, and whether the line that stays has the same words."""
    lines = [(d, n, tuple(x.encode().split())) for d, t in rows for n, x in enumerate((t or "").split("\n")) if x.encode().split()]
    mask = lambda w: tuple(b"<*>" if re.search(rb"[0-9]", x) else x for x in w)
    leaf = lambda m: (len(m), m[: cfg.depth])
    leaves, bodies, common, found = {}, {}, Counter(), {}
    for d, _, w in lines:
        leaves.setdefault(leaf(mask(w)), set()).add(d)
        bodies.setdefault(mask(w), set()).add(d)
    for m, docs in bodies.items():
        for i, x in enumerate(m):
            common[leaf(m), i, x] += len(docs) * (x != b"<*>" and len(leaves[leaf(m)]) >= cfg.min_docs)
    for d, n, w in lines:
        m = mask(w)
        shape = tuple(x if common[leaf(m), i, x] >= cfg.min_docs else None for i, x in enumerate(m))
        if sum(x != b"<*>" for x in m) * 2 < len(m):
            key = ("as it is", w) if cfg.numbers else None
        else:
            key = ("general", leaf(m), shape) if len(m) >= cfg.least_tokens and sum(x is not None for x in shape) >= cfg.constant * len(m) else ("masked", m)
        found.setdefault(key, []).append((d, n, w))
    out = {}
    for key, same in found.items():
        docs = len({d for d, _, _ in same})
        if key and (docs >= cfg.min_docs or docs >= cfg.long_docs and len(same[0][2]) >= cfg.long_tokens):
            first = min(same)[2]
            out |= {(d, n): w == first for d, n, w in sorted(same)[1:]}
    return out


def test_long_lines_recur_from_two_documents_and_numbers_as_they_stand(spark):
    long, short = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)), "a short line that stands in two documents"
    docs = [(i, f"{long}\n{short}") for i in (1, 2)] + [(10 + i, f"own {chr(97 + i) * 4}\n1 22 333 total\n{i} 22 333 total") for i in range(6)]
    got = {r.doc_id: sorted(r.dropped_lines) for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert got == {1: [], 2: [0], 10: [], 11: [1, 2], **{10 + i: [1] for i in range(2, 6)}}


def test_all_lines_match_a_plain_version(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = {(r.doc_id, n) for r in dedup_lines(df).collect() for n in r.dropped_lines}
    assert got == set(plain_lines([(r.doc_id, r.text) for r in df.collect()])) and got


def test_whole_documents_are_mixed(spark, sf, odd_docs):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    small = spark.createDataFrame([(i, "a b\n\nc  " * n, s) for i, (n, s) in enumerate([(5, "a"), (500, "b"), (300, "b"), (1, "c"), (40, None), (0, "d")])], "doc_id long, text string, source string")
    for df in (spark.read.parquet(f"{sf}/documents.parquet"), small, odd_docs):
        rows = df.select("doc_id", "text", "source").collect()
        sizes, largest, taken = Counter({r.source: 0 for r in rows}), Counter(), Counter()
        for r in rows:
            sizes[r.source] += count(r.text)
            largest[r.source] = max(largest[r.source], count(r.text))
        read = Counter((r.doc_id, r.text, r.source) for r in mix_documents(df, Mix(bucket_docs=16, whole=True)).select("doc_id", "text", "source").collect())
        assert set(read) <= {(r.doc_id, r.text, r.source) for r in rows}
        given = Counter((r.doc_id, r.text, r.source) for r in rows)
        assert all(n <= 3 * given[k] for k, n in read.items())
        for (_, text, source), n in read.items():
            taken[source] += n * count(text)
        target = expected_targets(sizes)
        assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 0.51 for s in target)


def test_positions_match_the_integrated_schedule(spark, sf):
    """At its position, a source's schedule has asked for the words before a reading: integrated in small steps."""
    cfg = Mix(slopes=(-0.9, 0.0, 0.5, 1.0))
    rows = passes(plan_mix(spark.read.parquet(f"{sf}/documents.parquet"), cfg)).collect()
    t = np.linspace(0, 1, 20_001)
    names = sorted({r.source for r in rows}, key=lambda s: s.encode())
    for r in rows[:400]:
        slope = cfg.slopes[names.index(r.source) % 4]
        rate = 1 + slope * (2 * t - 1)
        asked = np.r_[0, np.cumsum((rate[1:] + rate[:-1]) / 2)] / 20_000
        share = min(1.0, (r["pass"] * r.source_size + r.place) / r.target)
        assert r.slope == slope and abs(np.interp(r.position, t, asked) - share) < 1e-5


def test_alike_rows_lie_together_and_columns_may_clash(spark):
    rows = [(7, "a b c", "s", 1)] * 400 + [(None, "a b", None, 2)] * 90 + [(i, "w " * (i % 9), "s", 3) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, `__key` int").withColumns({c: F.lit(1) for c in ("__id", "__words", "__pass", "__hash", "doc", "key", "copies", "copy", "h", "bucket")})
    check_mix(df)
    assert mix_documents(df, Mix(whole=True)).columns == df.columns and {r["__key"] for r in mix_documents(df).collect()} <= {1, 2, 3}
    out = dedup_lines(df)
    assert out.columns == [*df.columns, "dropped_lines"] and out.count() == df.count() and {(r["__key"], r["__hash"]) for r in out.collect()} == {(1, 1), (2, 1), (3, 1)}
