import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sessile.llm import oracles
from sessile.llm.phrases import Phrases, Reached, _slices, coded, collocations, frequent_phrases
from sessile.llm.queries import op12_phrases


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def counted(rows, longest):
    """Occurrences by language and words of a phrase, and of all words by language."""
    found, total = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                found.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return found, total


def brute(rows, cfg):
    found, total = counted(rows, cfg.longest)
    often = {k: n for k, n in found.items() if n >= cfg.least}
    inside = {(lang, w[i:j], n) for (lang, w), n in often.items() for i in range(len(w)) for j in range(i + 1, len(w) + 1) if j - i < len(w)}
    out = {}
    for (lang, w), a in often.items():
        if len(w) > 1 and (lang, w, a) not in inside:
            n = total[lang]
            score, k = min((1000 * a * n // (often[lang, w[:k]] * often[lang, w[k:]]), k) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), often[lang, w[:k]], often[lang, w[k:]], n))
    return sorted((lang, i + 1, p.decode(), -a, left, r, n, -s) for lang, rows in out.items() for i, (s, a, p, left, r, n) in enumerate(sorted(rows)[: cfg.most]))


def texts(seed, n):
    """Texts of few words, in three languages of unequal size, with set phrases, marks, and a hot text."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(40)] + ["The", "THE", "é", "a b", "w1 x"]
    marks = [" ", " ", " ", " ", ". ", ",", "\n", "\t", "  ", "!"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(int(rng.integers(0, 40))):
            parts.append(["red green blue", "in spite of all that", words[int(rng.zipf(1.4)) % len(words)]][min(2, int(rng.integers(0, 12)))])
            parts.append(marks[int(rng.integers(len(marks)))])
        rows.append((["en", "en", "en", "de", None][i % 5], "".join(parts)))
    return rows + [("en", "one and the same text that stands here very often, word by word")] * 60 + [("de", None), ("de", ""), (None, " \n.")]


@pytest.mark.parametrize("cfg", [Phrases(least=12, most=25, chunk_words=100), Phrases(least=5, longest=3, shards=3, chunk_words=50, scan_words=200, slice_bytes=40, map_bits=8), Phrases(least=9, shards=1)])
def test_against_brute_force(spark, cfg):
    rows = texts(3, 300)
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns({"n": F.lit("x"), "phrase": F.lit(1), "shard": F.lit(None).cast("int")})
    expected = brute(rows, cfg)
    assert len(expected) > 10
    assert sorted(tuple(r) for r in collocations(docs.repartition(5), cfg).collect()) == expected


@pytest.mark.parametrize("bits", [26, 6])
def test_counts_are_exact_whatever_the_map_lets_through(spark, bits, monkeypatch):
    rows = texts(8, 300)
    if bits == 6:
        # A map that holds everything: all phrases are active as soon as anything is.
        monkeypatch.setattr(Reached, "since", lambda self, hashes: np.full(len(hashes), self.maps[0][0] if self.maps else 2**31 - 1, np.int32))
    cfg = Phrases(least=8, chunk_words=64, shards=3)
    from sessile.llm.storage import materialize

    table = materialize(coded(spark.createDataFrame(rows, "lang string, text string"), cfg), "chunks", by="shard")
    if bits == 26:
        found, _ = frequent_phrases(table, cfg)
        got = {(r.lang, tuple(r.phrase.split(" "))): r.n for r in found.collect()}
    else:
        # The patch lives in this process alone, so its scans run here.
        from sessile.llm.phrases import _scan

        chunks = [pa.Table.from_pandas(table.filter(F.col("shard") == s).select("lang", "words", "codes").toPandas(), schema=pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("codes", pa.list_(pa.int32()))])) for s in range(3)]
        total = Counter()
        for step in range(9):
            reached = Reached([(1, np.zeros(1, np.uint64))] if step else [])
            for out in _scan(reached, step, cfg)(iter(chunks[step % 3].to_batches())):
                for lang, phrase, n in zip(*(out[c].to_pylist() for c in ("lang", "phrase", "n")), strict=True):
                    total[lang, tuple(phrase.split(" "))] += n
        got = {k: n for k, n in total.items() if n >= cfg.least}
    assert got == {k: n for k, n in counted(rows, 5)[0].items() if n >= cfg.least}


def test_slices_of_a_text_end_at_breaks():
    text = "ab cd. ef, gh\tIJ. kl"
    for limit in (1, 4, 100):
        parts = list(_slices(text, limit))
        assert b"".join(parts) == b"ab cd\xff ef\xff gh ij\xff kl" and all(p.startswith(b"\xff") for p in parts[1:])


def test_odd_rows(spark, odd_docs, no_docs):
    cfg = Phrases(least=2)
    rows = [(r.lang, r.text) for r in odd_docs.select("lang", "text").collect()]
    assert sorted(tuple(r) for r in collocations(odd_docs, cfg).collect()) == brute(rows, cfg)
    assert collocations(no_docs, cfg).collect() == []


def test_products_beyond_64_bits(spark):
    # 1000 a n is some 10**20 for sums that need no such table: the same expression on plain numbers.
    row = spark.sql("select cast(3000000000000 as long) a, cast(40000000000000 as long) n, cast(2999999999999 as long) l, cast(4000000000001 as long) r")
    wide = [F.col(c).cast("decimal(38,0)") for c in "anlr"]
    out = row.select((F.lit(1000).cast("decimal(38,0)") * wide[0] * wide[1]).alias("top"), (wide[2] * wide[3]).alias("bottom")).selectExpr("top div bottom as q").first()
    assert out.q == 1000 * 3000000000000 * 40000000000000 // (2999999999999 * 4000000000001)


def test_query_matches_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    rel = con.sql(oracles.COLLOCATIONS)
    assert [str(t) for t in rel.types] == ["VARCHAR", "BIGINT", "VARCHAR", *["BIGINT"] * 5]
    expected = sorted(rel.fetchall())
    assert expected and sorted(tuple(r) for r in op12_phrases(spark, sf).collect()) == expected
