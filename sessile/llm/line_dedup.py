"""Lines that recur across documents, found with a log-template tree of fixed depth.

A line's leaf is its number of tokens and its first tokens; tokens with digits
are variable from the start.  Within a leaf, a token that few documents have at
its position generalises to a variable field, and what stays constant is the
line's template.  Position counts are sums, so a leaf grows no state that one
task has to hold, and the outcome doesn't depend on the order of the lines.
Templates that enough documents share are dropped but for their first line;
long ones from two documents on.  Lines that are mostly numbers have no
template and recur as they stand.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessile.llm.storage import materialize

SPACE = r"[\x20\x09-\x0D]+"
VARIABLE = "<*>"


@dataclass(frozen=True)
class LineDedup:
    """Depth in tokens, documents that make a template recur, constant share of a template.

    Lines of fewer than ``least_tokens`` tokens generalise their digits only.
    Lines of ``long_tokens`` tokens recur from ``long_docs`` documents on; a
    token takes ``min_docs`` documents to be constant all the same.  With
    ``numbers``, lines of less than half words recur by their unmasked text.
    ``copy_share`` of a document's words in recurring lines make it a copy,
    which ``drop_lines`` leaves to a search for near copies.
    """

    depth: int = 3
    min_docs: int = 5
    constant: float = 0.75
    least_tokens: int = 6
    long_tokens: int = 50
    long_docs: int = 2
    numbers: bool = True
    copy_share: float = 0.35


def _keyed(docs: DataFrame) -> DataFrame:
    """The text and the key of each document, its id and the hash of its text; all of its columns in ``doc``."""
    text = F.col("text").cast("string")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), text.alias("text"), F.col("doc_id").cast("long").alias("__id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("__hash"))


def _lines(docs: DataFrame, cfg: LineDedup) -> DataFrame:
    """Lines with a word: key, line number, masked tokens joined by a blank, leaf, hashes of masked and unmasked tokens, tokens, words."""
    lines = docs.select("__id", "__hash", F.posexplode(F.split(F.col("text").cast("string"), "\n", -1)).alias("line_no", "line"))
    lines = lines.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    line = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", VARIABLE)).otherwise(F.col("line"))
    tokens = lambda c: F.filter(F.split(c, SPACE, -1), lambda t: t != "")
    lines = lines.withColumns({"tokens": tokens(line), "exact": F.xxhash64(tokens(F.col("line")))})
    leaf = F.xxhash64(F.size("tokens"), F.slice("tokens", 1, cfg.depth))
    words = F.size("tokens") - F.size(F.filter("tokens", lambda t: t == VARIABLE))
    return lines.select("__id", "__hash", "line_no", leaf.alias("leaf"), F.xxhash64("tokens").alias("body"), "exact", F.size("tokens").alias("size"), words.alias("words"), F.array_join("tokens", " ").alias("masked"))


def recurring_lines(docs: DataFrame, cfg: LineDedup = LineDedup()) -> DataFrame:
    """``(__id, __hash, line_no, copy)`` of every line to drop, ``copy`` if the line that stays has the same words; ``docs`` has been through ``_keyed``."""
    doc = F.struct("__id", "__hash")
    lines = _lines(docs, cfg)
    enough = (F.col("docs") >= cfg.min_docs) | ((F.col("size") >= cfg.long_tokens) & (F.col("docs") >= cfg.long_docs))
    # Leaves that few documents reach hold no recurring template.
    leaves = lines.select("leaf", "size", "__id", "__hash").groupBy("leaf").agg(F.count_distinct(doc).alias("docs"), F.first("size").alias("size")).filter(enough)
    leaves = materialize(leaves.select("leaf", (F.col("docs") >= cfg.min_docs).alias("deep")), "leaves")
    # Leaves grow with the input: merged at every size, and split by Spark where one is frequent.
    lines = materialize(lines.join(leaves.hint("merge"), "leaf"), "lines")

    bodies = lines.filter("deep").groupBy("leaf", "body").agg(F.count_distinct(doc).alias("docs"), F.first("masked").alias("masked"))
    tokens = materialize(bodies.select("leaf", "body", "docs", F.posexplode(F.split("masked", " ", -1)).alias("at", "token")), "tokens")
    common = tokens.groupBy("leaf", "at", "token").agg(F.sum("docs").alias("n")).filter((F.col("n") >= cfg.min_docs) & (F.col("token") != VARIABLE))
    tokens = tokens.join(common.select("leaf", "at", "token", F.lit(True).alias("constant")), ["leaf", "at", "token"], "left")
    shape = tokens.groupBy("leaf", "body").agg(
        F.bit_xor(F.xxhash64("at", F.when(F.col("constant"), F.col("token")))).alias("shape"),
        F.count("constant").alias("constants"),
        F.count("*").alias("size"),
    )
    general = (F.col("size") >= cfg.least_tokens) & (F.col("constants") >= cfg.constant * F.col("size"))
    # Written, so that Spark can split the lines of a frequent template where they meet it.
    templates = materialize(shape.filter(general).select("leaf", "body", "shape"), "templates")
    kind = lambda n, c: F.struct(F.lit(n).alias("kind"), F.col(c).alias("shape"))
    # A line without any word but numbers is no template.
    own = F.when(F.col("words") * 2 >= F.col("size"), F.when(F.col("shape").isNotNull(), kind(1, "shape")).otherwise(kind(0, "body")))
    own = own.when(F.lit(cfg.numbers), kind(2, "exact"))
    placed = lines.select("leaf", "body", "exact", "size", "words", "__id", "__hash", "line_no").join(templates, ["leaf", "body"], "left")
    placed = placed.select("leaf", own.alias("template"), "exact", "size", "__id", "__hash", "line_no").filter("template is not null")
    placed = materialize(placed, "placed")
    recurring = placed.groupBy("leaf", "template").agg(F.count_distinct(doc).alias("docs"), F.first("size").alias("size"), F.min(F.struct("__id", "__hash", "line_no", F.col("exact").alias("stays"))).alias("first"))
    recurring = materialize(recurring.filter(enough).select("leaf", "template", "first"), "recurring")
    hits = placed.join(recurring, ["leaf", "template"]).filter(~F.struct("__id", "__hash", "line_no").eqNullSafe(F.struct("first.__id", "first.__hash", "first.line_no")))
    return hits.select("__id", "__hash", "line_no", (F.col("exact") == F.col("first.stays")).alias("copy"))


def _without_lines(docs: DataFrame, cfg: LineDedup) -> DataFrame:
    """``_keyed(docs)`` with ``__left`` (the text without its recurring lines), ``__dropped`` and ``__copies`` (each dropped line stays elsewhere word for word)."""
    keyed = _keyed(docs)
    key = ["__key", "__hash"]
    gone = recurring_lines(keyed, cfg).select(F.coalesce(F.col("__id").cast("string"), F.lit("")).alias("__key"), "__hash", "line_no", "copy")
    gone = gone.groupBy(*key).agg(F.collect_set("line_no").alias("__dropped"), F.bool_and("copy").alias("__copies"))
    # The text travels once, in ``doc``.
    whole = keyed.select("doc", "__hash", F.coalesce(F.col("__id").cast("string"), F.lit("")).alias("__key"))
    out = whole.join(gone, key, "left").withColumn("text", F.col("doc").getField("text").cast("string"))
    lines = F.split(F.col("text").cast("string"), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__dropped"))
    text = F.transform(F.array(lines), lambda x: F.array_join(F.transform(stay, lambda i: F.get(x, i)), "\n"))[0]
    return out.withColumn("__left", F.when(F.col("__dropped").isNull(), F.col("text")).otherwise(text))


def dedup_lines(docs: DataFrame, cfg: LineDedup = LineDedup()) -> DataFrame:
    """``docs`` with recurring lines dropped from ``text`` and the array ``dropped_lines`` (line numbers from 0).

    The first line of a template, by doc_id, stays.  Rows equal in id and text
    are one document.  A null text stays null and a wordless one as it is;
    lines without a word are never dropped.  Other columns are kept, but for
    one named dropped_lines.  An empty table gives no rows.
    """
    out = _without_lines(docs, cfg)
    columns = [(F.col("__left") if c == "text" else F.col("doc").getField(c)).alias(c) for c in docs.columns if c != "dropped_lines"]
    return out.select(*columns, F.coalesce("__dropped", F.expr("cast(array() as array<int>)")).alias("dropped_lines"))


def drop_lines(docs: DataFrame, cfg: LineDedup = LineDedup()) -> DataFrame:
    """``docs`` without recurring lines and without the documents that these leave no word of.

    Such a document goes only if each of its lines equals, word for word, a
    line that stays; otherwise it keeps its whole text.  So does a document
    with ``copy_share`` of its words or more in recurring lines: it is a copy
    of another one rather than a text of its own with lines that recur, and
    near-duplicate search has to see all of it to tell.
    """
    out = _without_lines(docs, cfg)
    words = lambda c: F.coalesce(F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    found = F.col("__dropped").isNotNull()
    emptied = found & ~F.coalesce(F.col("__left"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    copied = found & (words(F.col("__left")) <= (1 - cfg.copy_share) * words(F.col("text")))
    out = out.filter(~(emptied & F.col("__copies")))
    text = F.when(emptied | copied, F.col("text")).otherwise(F.col("__left"))
    return out.select(*[(text if c == "text" else F.col("doc").getField(c)).alias(c) for c in docs.columns])
