"""Quality rules of single documents and of their hosts, in SQL expressions only.

Rules fail single documents; failures are added up by host and rule.  A host's
rate of each rule is shrunk towards the corpus by a beta prior, whose two
parameters come from the mean and the variance of the rates over all hosts
(method of moments).  Two verdicts come back to the documents.  A host that
fails far more often than the corpus goes with all its documents.  Where a host
only stands out in a rule, its documents lose the benefit of the doubt: those
that fail that rule go, which elsewhere stay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessile.llm.storage import materialize

SPACE = r"[\x20\x09-\x0D]+"
#: Rules in order; the first two are the base, which fails a document whatever its host.
RULES = ("few_words", "repeats", "symbols", "dup_lines", "word_length")


@dataclass(frozen=True)
class HostRules:
    """Limits of the rules and of hosts.

    Of a document: least words, most repeated words in per cent, words of a
    window, most symbols and most repeated lines in per cent of words and lines,
    least and most characters of the mean word.  Of a host: it stands out in a
    rule from ``doubt`` posterior deviations above the corpus' rate; it fails if
    its rate less ``sure`` deviations exceeds ``worst`` times the corpus' rate,
    and the rate itself ``least_rate``.  ``most_strength`` bounds the prior's
    weight in documents.
    """

    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    max_symbol_percent: int = 10
    max_dup_line_percent: int = 30
    word_length: tuple[int, int] = (3, 10)
    doubt: float = 1.0
    sure: float = 2.0
    worst: float = 3.0
    least_rate: float = 0.2
    most_strength: float = 1000.0


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE, -1), lambda w: w != "")


def repeated_words(words: Column, window: int) -> Column:
    """Number of words that stand in a window of ``window`` words found twice or more.

    Windows are compared by xxHash64.  Sorted by hash, equal windows are
    neighbours; the starts of those, in order, cover ``min(window, distance to
    the next)`` words each.
    """
    n = F.size(words) - (window - 1)
    keys = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(words, i, F.lit(window))))

    def covered(keys: Column) -> Column:
        ranked = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

        def starts(r: Column) -> Column:
            size = F.size(r)
            twice = F.filter(r, lambda x, i: ((i > 0) & (F.get(r, i - 1)["k"] == x["k"])) | ((i < size - 1) & (F.get(r, i + 1)["k"] == x["k"])))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        def length(s: Column) -> Column:
            # Each start covers up to the next one; the last covers a whole window.
            return F.aggregate(s, F.struct(F.lit(-1).alias("last"), F.lit(0).cast("long").alias("n")), lambda a, i: F.struct(i.alias("last"), (a["n"] + F.when(a["last"] < 0, window).otherwise(F.least(F.lit(window), i - a["last"]))).cast("long").alias("n")), lambda a: a["n"])

        once = lambda c, f: F.transform(F.array(c), f)[0]
        return once(ranked, lambda r: length(starts(r)))

    found = F.transform(F.array(keys), lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), F.lit(0).cast("long")).otherwise(covered(k)))[0]
    return F.when(n > 1, found).otherwise(F.lit(0).cast("long"))


def document_rules(docs: DataFrame, cfg: HostRules = HostRules()) -> DataFrame:
    """``doc_id``, ``host`` (the source), word counts, rule figures, ``base_failed`` and a column for each rule: whether the row fails it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    read = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("host"), text.alias("text"), _words(text).alias("words"), lines.alias("lines"))
    n_lines, n, chars = F.size("lines").cast("long"), F.col("n_words"), F.col("word_chars")
    figures = read.select(
        "doc_id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words"), cfg.window).alias("n_repeat_words"),
        n_lines.alias("n_lines"),
    )
    rules = {
        "few_words": n < cfg.min_words,
        "repeats": 100 * F.col("n_repeat_words") > cfg.max_repeat_percent * n,
        "symbols": 100 * F.col("n_symbols") > cfg.max_symbol_percent * n,
        "dup_lines": 100 * F.col("n_dup_lines") > cfg.max_dup_line_percent * F.col("n_lines"),
        "word_length": (chars < cfg.word_length[0] * n) | (chars > cfg.word_length[1] * n),
    }
    return figures.withColumns(rules).drop("n_lines").withColumn("base_failed", F.col("few_words") | F.col("repeats"))


def host_verdicts(rules: DataFrame, cfg: HostRules = HostRules()) -> DataFrame:
    """One row per host: ``host, host_docs, host_rate, host_failed, stands_out`` (array of rules), from a table with a column for each rule.

    For each rule the prior beta(a, b) has the mean m of the corpus and the
    variance v of the hosts' rates less what sampling adds; a + b = m (1 - m) / v
    - 1, held between 1 and ``most_strength``.  ``host_rate`` is the greatest
    shrunk rate over the rules.  Documents without a source are one host.
    """
    hosts = rules.groupBy("host").agg(F.count("*").alias("docs"), *[F.sum(F.col(r).cast("long")).cast("double").alias(r) for r in RULES])
    over = hosts.agg(
        F.avg(1 / F.col("docs")).alias("noise"),
        *[f.alias(f"{name}_{r}") for r in RULES for name, f in (("m", F.sum(r) / F.sum("docs")), ("square", F.avg(F.col(r) / F.col("docs") * F.col(r) / F.col("docs"))), ("first", F.avg(F.col(r) / F.col("docs"))))],
    )
    # One row of as many numbers as there are rules; a frame of hosts may be of any size.
    sums = over.first()
    rates, worse, failed = [], [], []
    for r in RULES:
        m, square, first, noise = (sums[c] or 0.0 for c in (f"m_{r}", f"square_{r}", f"first_{r}", "noise"))
        spread = m * (1 - m)
        signal = square - first * first - spread * noise
        strength = min(cfg.most_strength, max(1.0, spread / signal - 1)) if signal > 0 and spread > 0 else cfg.most_strength
        total = F.col("docs") + F.lit(strength)
        rate = (F.col(r) + F.lit(m * strength)) / total
        sd = F.sqrt(rate * (1 - rate) / (total + 1))
        rates.append(rate)
        worse.append(F.when(rate - m > cfg.doubt * sd, F.lit(r)))
        failed.append((rate - cfg.sure * sd > cfg.worst * m) & (rate > cfg.least_rate))
    out_of = failed[0]
    for f in failed[1:]:
        out_of = out_of | f
    return hosts.select("host", F.col("docs").alias("host_docs"), F.greatest(*rates).alias("host_rate"), out_of.alias("host_failed"), F.filter(F.array(*worse), lambda x: x.isNotNull()).alias("stands_out"))


def quality_rules(docs: DataFrame, cfg: HostRules = HostRules()) -> DataFrame:
    """Rule figures of every row with ``failed_rules``, its host's verdicts and the final ``kept``.

    Reads doc_id, text and source alone.  A null text has no words and fails
    the base; repeated rows each count; an empty table gives no rows.  A row is
    kept unless it fails the base, its host fails, or it fails a rule in which
    its host stands out.
    """
    rules = materialize(document_rules(docs, cfg), "rules")
    verdicts = host_verdicts(rules, cfg).withColumnRenamed("host", "of_host")
    found = rules.join(verdicts, rules.host.eqNullSafe(verdicts.of_host)).drop("of_host")
    own = F.filter(F.array(*[F.when(F.col(r), F.lit(r)) for r in RULES]), lambda x: x.isNotNull())
    found = found.withColumn("failed", own)
    doubted = F.arrays_overlap("failed", "stands_out")
    kept = ~F.col("base_failed") & ~F.col("host_failed") & ~doubted
    return found.withColumns({"kept": kept, "failed_rules": F.array_join("failed", ","), "host_stands_out": F.array_join("stands_out", ",")}).drop("failed", "stands_out", *RULES)
