import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from sessile.llm import pii
from sessile.llm.host_rules import RULES, HostRules, host_verdicts, quality_rules

BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


HARD = [
    "a@b.c_d@e.f g@h x@y.z. q.w%+-@A-b.co.uk@r.s",
    "1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.255 1.1.1.256 12.34.56.78",
    "4111 1111 1111 1111 4111-1111-1111-1112 0000000000000 4111111111111111 5500 0000 0000 0004.",
    "+49 (30) 123-45.67 +1 +123456789012345678 +1-800-555-0199) tel +44 20 7946 0958",
    "é\U0001f600 mail: jörg@x.de \U0001f600 10.0.0.1",
    "@@@..@a.b@c.d ++1 234567890 +",
    "x" * 50_000,
    "9" * 30_000 + "@" + ".a" * 20_000,
    "1 " * 20_000 + ".1" * 20_000,
    "IBAN DE89370400440532013000 and GB82 WEST 1234 5698 7654 32 but not DE89370400440532013001",
    "my SSN 078-05-1120 here; the part 123-45-6789 there",
    None,
    "",
]


def test_base_spans_match_a_plain_search(spark, odd_docs):
    docs = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    for df in (docs, odd_docs):
        rows = df.select("doc_id", "text").collect()
        expected = sorted((str(i), ",".join(base_spans(t or ""))) for i, t in rows)
        got = pii.digest(pii.find_pii(df)).collect()
        only = [(str(r.doc_id), ",".join(s for s in r.spans.split(",") if s.split(":")[0] in dict(BASE)), r.base_sha256, r.n_email + r.n_ip + r.n_card + r.n_phone) for r in got]
        assert sorted(x[:2] for x in only) == expected
        assert all(h == hashlib.sha256(s.encode()).hexdigest() and n == len([x for x in s.split(",") if x]) for _, s, h, n in only)


def test_added_kinds_and_context(spark):
    docs = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.digest(pii.find_pii(docs)).collect()}
    spans = [s.split(":") for s in got[9].spans.split(",")]
    text = HARD[9]
    assert [text[int(a) : int(b)] for k, a, b in spans if k == "iban"] == ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"]
    assert got[10].spans == "ssn:7:18"  # the other one is called a part
    assert "phone:" in got[3].scored_spans and got[3].scored_spans.endswith(":1.0")


WORDS = [
    ("SSN 078-05-1120, 078-05-1121", "ssn:4:15:0.6,ssn:17:28:0.6"),
    ("078-05-1120 is my ssn", "ssn:0:11:0.6"),
    ("078-05-1120 is my dog, " + "x" * 40 + " ssn", ""),
    ("order ssn 078-05-1120", ""),
    ("card numbers: 4111111111111111 5500000000000004", "card:14:47:0.0"),
    ("cards: 4111111111111111, 5500000000000004", "card:7:23:1.0,card:25:41:1.0"),
    ("order number 4111111111111111 shipped", "card:13:29:0.4"),
    ("4111111111111111 was my visa", "card:0:16:1.0"),
    ('token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" x', "secret:9:49:0.6"),
    ("commit f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda", ""),
    ("the password is aB3dE6gH9jK2mN5pQ8rS ok", "secret:16:36:0.6"),
    ("token aaaaaaaaaaaaaaaaaaaaaaaaa1 and 11111111111111111111111", ""),
    ("key words/like/this/path/with/1/number/2/or/3", ""),
]


def test_words_on_both_sides_move_scores(spark):
    texts = [t for t, _ in WORDS]
    got = {r.doc_id: r.scored_spans for r in pii.digest(pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()}
    wanted = {i: w for i, (_, w) in enumerate(WORDS)}
    wanted[4] = ""  # both numbers are one match of the base pattern, which has too many digits
    assert got == wanted


def test_many_matches_take_linear_time(spark):
    import time

    cards = "4111 1111 1111 1111, " * 30_000 + "a@b.cd 10.0.0.1 +49 30 1234567 | " * 20_000
    spark.createDataFrame([(0, "1 2")], "doc_id long, text string").transform(pii.find_pii).collect()
    start = time.perf_counter()
    row = pii.digest(pii.find_pii(spark.createDataFrame([(0, cards)], "doc_id long, text string"))).first()
    assert (row.n_card, row.n_email, row.n_ip, row.n_phone) == (30_000, 20_000, 20_000, 20_000)
    assert row.base_sha256 == hashlib.sha256(",".join(base_spans(cards)).encode()).hexdigest()
    assert time.perf_counter() - start < 30


def test_masking(spark, odd_docs, no_docs):
    texts = ["to a@b.cd at 10.0.0.1!", 'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda"; x@y.z', "+4111111111111111", "1.2.3.4, 999.1.1.1, 5.6.7.8"]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, t int")
    left = [tuple(r) for r in pii.mask_pii(docs).orderBy("doc_id").collect()]
    assert left == [(0, "to [email] at [ip]!", 7), (1, 'token = "[secret]"; [email]', 7), (2, "+[card]", 7), (3, "[ip], 999.1.1.1, [ip]", 7)]
    assert pii.mask_pii(odd_docs).count() == odd_docs.count() and pii.mask_pii(odd_docs).filter("doc_id = 3").first().text is None
    assert pii.find_pii(no_docs).collect() == []


def rules(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    c, covered = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7)), set()
    for i in range(len(w) - 7):
        if c[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(text.count(q) for q in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_rules_match_a_plain_count(spark, odd_docs, sf):
    texts = [(0, "a b c d e f g h i " * 5, "x"), (1, "l1\nl1\n \n\x85\nl1 #*$%&|<>", "x"), (2, " ".join(map(str, range(40))) + " " + " ".join(map(str, range(10))), None)]
    made = spark.createDataFrame(texts, "doc_id long, text string, source string")
    for df in (made, odd_docs, spark.read.parquet(f"{sf}/documents.parquet")):
        expected = sorted((str(r.doc_id), *rules(r.text or "")) for r in df.select("doc_id", "text").collect())
        got = [(str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules(df).collect()]
        assert sorted(got) == expected


def plain_verdicts(rows, cfg=HostRules()):
    """``{host: (rates, failed, stands out)}`` of rows (host, {rule: failed})."""
    docs = Counter(h for h, _ in rows)
    out = {h: ([], [], []) for h in docs}
    for r in RULES:
        bad = Counter(h for h, f in rows if f[r])
        rates = [bad[h] / n for h, n in docs.items()]
        m, v = sum(bad.values()) / len(rows), sum(x * x for x in rates) / len(rates) - (sum(rates) / len(rates)) ** 2
        signal = v - m * (1 - m) * sum(1 / n for n in docs.values()) / len(docs)
        strength = min(cfg.most_strength, max(1, m * (1 - m) / signal - 1)) if signal > 0 and 0 < m < 1 else cfg.most_strength
        for h, n in docs.items():
            rate = (bad[h] + m * strength) / (n + strength)
            sd = (rate * (1 - rate) / (n + strength + 1)) ** 0.5
            out[h][0].append(rate)
            out[h][1].append(rate - cfg.sure * sd > cfg.worst * m and rate > cfg.least_rate)
            out[h][2].extend([r] if rate - m > cfg.doubt * sd else [])
    return {h: (max(a), any(b), c) for h, (a, b, c) in out.items()}


def test_host_verdicts(spark, no_docs):
    flags = lambda **f: {r: False for r in RULES} | f
    rows = [(f"h{i % 40}", flags(symbols=i % 40 == 3 and i % 3 > 0, few_words=i % 19 == 0, dup_lines=i % 40 == 7 and i % 7 == 0)) for i in range(4000)]
    rows += [("tiny", flags(symbols=True)), (None, flags())]
    df = spark.createDataFrame([(h, *(f[r] for r in RULES)) for h, f in rows], "host string, " + ", ".join(f"{r} boolean" for r in RULES))
    got = {r.host: (round(r.host_rate, 9), r.host_failed, list(r.stands_out)) for r in host_verdicts(df).collect()}
    assert got == {h: (round(a, 9), b, c) for h, (a, b, c) in plain_verdicts(rows).items()}
    assert got["h3"][1:] == (True, ["symbols"]) and got["h7"][1] is False and "dup_lines" in got["h7"][2] and got["h0"][1:] == (False, []) and not got["tiny"][1]
    out = quality_rules(no_docs)
    assert out.collect() == [] and "kept" in out.columns
    assert host_verdicts(df.filter(F.lit(False))).collect() == []


def test_verdicts_reach_documents(spark):
    good = " ".join(f"word{chr(97 + i)}" for i in range(25))
    rows = [(1000 * h + i, f"{good} # $ %" if h == 2 and i % 3 else f"{good} {i} # $ %" if h == 1 and i % 8 == 0 or i == 77 else good + f" {i}", f"h{h}") for h in range(9) for i in range(100)]
    rows += [(9999, "# # #", "h5")]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(got[2000 + i].kept for i in range(100)) and got[2000].host_failed, "a host far worse than the corpus"
    assert all(got[1000 + i].kept == (i % 8 > 0 and i != 77) for i in range(100)) and "symbols" in got[1000].host_stands_out, "only those that fail where the host stands out"
    assert got[77].kept and got[77].failed_rules == "symbols", "elsewhere the same failure stays"
    assert not got[9999].kept and got[9999].base_failed
