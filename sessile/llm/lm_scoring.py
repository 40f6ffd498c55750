"""Stupid-backoff scores of documents under the n-gram counts of the whole corpus.

Texts become blocks of some megabytes once: a row with the hashes of a block's
distinct words and their numbers in turn.  A block is exploded into a row for each
of its distinct n-grams: block, hash, count.  Spark deals these rows by hash; summed over
each hash they are the n-gram counts of the corpus, one table for all orders, and a
window gives each row the sum of its hash, which tells each block what the corpus
holds of its n-grams.  N-grams that no other block has are left out there, as the block knows
their count.  A block then sums the scores of its documents' words.  Rows grow in
proportion to the input; blocks grow in number, not in size; an n-gram has one row
for each block however frequent it is.

Counting goes by slices of the hashes and scoring by parts of the blocks, one after
another, each of which leaves a table and frees its shuffle files.  Every n-gram of
every block is in one slice, and every block in one part; there are as many of both
whatever the input, so that the work stays in proportion to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessile.llm.storage import discard, materialize
from sessile.llm.words import CHUNK_BYTES, WordHashes, chunks, mix, texts_of


@dataclass(frozen=True)
class Backoff:
    """Backoff factor, whether a document's own n-grams are left out of the counts it is scored by, characters
    of a block, words of the longest n-grams, slices that are counted and parts that are scored in turn."""

    factor: float = 0.4
    leave_out: bool = True
    block_chars: int = 8_000_000
    order: int = 3
    slices: int = 5
    parts: int = 4


#: An n-gram's number in its slice of a block times this, plus its count there, is one long of a row.
_N = 1 << 32
_BLOCK = "ids array<long>, sizes array<int>, words array<long>, codes array<int>, n_words long"


def _block(ids: list[pa.Array], sizes: list[np.ndarray], words: list[pa.Array], known: WordHashes) -> pa.RecordBatch:
    coded = pa.concat_arrays(words).dictionary_encode()
    hashes = np.fromiter(map(known.__getitem__, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary)).view(np.int64)
    columns = [pa.concat_arrays(ids), pa.array(np.concatenate(sizes), pa.int32()), pa.array(hashes), coded.indices.cast(pa.int32())]
    return pa.RecordBatch.from_arrays(
        [*(pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns), pa.array([len(coded)], pa.int64())],
        names=["ids", "sizes", "words", "codes", "n_words"],
    )


def _blocks(block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, waiting, size = WordHashes(), ([], [], []), 0
        for batch in batches:
            for part in chunks(batch, "text", min(CHUNK_BYTES, block_chars)):
                # Lower-cased in Python: pc.ascii_lower misreads slices.
                text = pa.array([t.lower() for t in texts_of(part, "text")], pa.large_binary()).cast(pa.large_string())
                split = pc.ascii_split_whitespace(text)
                flat = pc.list_flatten(split).cast(pa.large_binary())
                there = pc.greater(pc.binary_length(flat), 0)
                ends = np.r_[0, np.cumsum(there.to_numpy(zero_copy_only=False))][np.r_[0, np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))].astype(np.int64)]
                for column, x in zip(waiting, (part["doc_id"], np.diff(ends), flat.filter(there)), strict=True):
                    column.append(x)
                size += pc.sum(pc.utf8_length(text)).as_py()
                if size >= block_chars:
                    yield _block(*waiting, known)
                    waiting, size = ([], [], []), 0
        if waiting[0]:
            yield _block(*waiting, known)

    return run


def _ngrams(words: np.ndarray, sizes: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Of a block's word hashes: hashes of the n-grams ending at each word, by length from 1, number of the
    document of each word, its place there.

    Where a text has fewer words before, the hash of the longer n-gram means nothing (see ``_all``).
    """
    doc = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grams = [words]
    with np.errstate(over="ignore"):
        for k in range(2, order + 1):
            longer = np.zeros_like(words)
            longer[1:] = mix(grams[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:] + np.uint64(k))
            grams.append(longer)
    return grams, doc, place


def _all(grams: list[np.ndarray], place: np.ndarray) -> np.ndarray:
    """The n-grams of a block that lie within a text, one length after another."""
    return np.concatenate([g[place >= k] for k, g in enumerate(grams)])


def _slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    """The slice of each hash; slices follow each other in the order of hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)


def _of_row(words: pa.ListScalar, codes: pa.ListScalar, sizes: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes in turn and words of each document."""
    return words.values.to_numpy().view(np.uint64)[codes.values.to_numpy()], sizes.values.to_numpy().astype(np.int64)


def _exploded(order: int, at: int, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, block in enumerate(batch["block"].to_pylist()):
                grams, _, place = _ngrams(*_of_row(*(batch[c][i] for c in ("words", "codes", "sizes"))), order)
                hashes = _all(grams, place)
                hashes, n = np.unique(hashes[_slice_of(hashes, slices) == at], return_counts=True)
                numbered = np.arange(len(hashes)) * _N + n
                for k in range(0, len(hashes), 1 << 18):
                    part = slice(k, k + (1 << 18))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(hashes[part]), block, np.int64)), pa.array(hashes[part].view(np.int64)), pa.array(numbered[part])],
                        names=["block", "hash", "numbered"],
                    )

    return run


def _own(gram: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """How often each entry's n-gram stands in the entry's document."""
    _, at, n = np.unique(gram * docs + doc, return_inverse=True, return_counts=True)
    return n[at]


def _score(cfg: Backoff, n_corpus: int):
    def run(block: pa.Table, known: pa.Table) -> pa.Table:
        ids = block["ids"][0].values
        words, n = _of_row(*(block[c][0] for c in ("words", "codes", "sizes")))
        grams, doc, place = _ngrams(words, n, cfg.order)
        hashes, at, counts = np.unique(_all(grams, place), return_inverse=True, return_counts=True)
        # What isn't among the known ones stands in this block alone.
        starts = np.searchsorted(_slice_of(hashes, cfg.slices), np.arange(cfg.slices))
        counts[starts[known["slice"].to_numpy()] + known["number"].to_numpy()] = known["total"].to_numpy()

        def counted(gram: np.ndarray, doc: np.ndarray) -> np.ndarray:
            return counts[gram] - _own(gram, doc, len(n)) if cfg.leave_out else counts[gram]

        rest = np.maximum(1, n_corpus - n[doc] * cfg.leave_out).astype(float)
        # A word that nothing else holds counts as one more word, a level down.
        context = counted(at[: len(doc)], doc)
        score, pairs_found, start = np.where(context > 0, context / rest, cfg.factor / (rest + 1)), np.zeros(len(doc)), len(doc)
        for k in range(1, cfg.order):
            within = place >= k
            end = start + int(within.sum())
            c = np.zeros(len(doc), dtype=np.int64)
            c[within] = counted(at[start:end], doc[within])
            before = np.r_[0, context[:-1]][: len(context)]
            score = np.where(c > 0, c / np.maximum(before, 1), np.where(within, cfg.factor * score, score))
            pairs_found = (c > 0) if k == 1 else pairs_found
            context, start = c, end
        add = lambda x: np.bincount(doc, weights=x, minlength=len(n)).astype(float)
        total = add(np.log(score))
        return pa.table(
            {
                "doc_id": ids,
                "n_words": pa.array(n),
                "n_bigrams_found": pa.array(add(pairs_found).astype(np.int64)),
                "log_score": pa.array(total),
                "mean_log_score": pa.array(total / np.maximum(n, 1), mask=n == 0),
            }
        )

    return run


def _known(blocks: DataFrame, at: int, cfg: Backoff) -> DataFrame:
    """Of slice ``at``: block, part, number in the block's slice and count in the corpus of each n-gram that other blocks hold, too."""
    schema = "block long not null, hash long not null, numbered long not null"
    rows = blocks.select("block", "words", "codes", "sizes").mapInArrow(_exploded(cfg.order, at, cfg.slices), schema)
    n = F.col("numbered") % _N
    # Counted by hash and handed back to each row in one exchange and one sort; an n-gram has a row a block at most.
    found = rows.withColumn("total", F.sum(n).over(Window.partitionBy("hash"))).filter(F.col("total") > n)
    return found.select("block", _part("block", cfg.parts), F.shiftright("numbered", 32).cast("int").alias("number"), "total")


def _part(block: str, parts: int):
    return F.pmod(F.xxhash64(block), F.lit(parts)).cast("int").alias("part")


def score_documents(docs: DataFrame, cfg: Backoff = Backoff()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_bigrams_found, log_score, mean_log_score.

    Words are lower-cased (A to Z).  v are the ``order - 1`` words before w, or
    as many as the text has.  S(w | v) is count(v w) / count(v) where the corpus
    holds v w, else ``factor`` times S(w | v without its first word); S(w) is
    count(w) / N, or factor / (N + 1) where the corpus lacks w.
    With ``leave_out``, counts and N are those of all other rows.  A null or
    wordless text has score 0 and no mean.  Repeated rows are rows of their
    own; columns but doc_id and text are left out; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # The blocks are written: counts and scores then read the same ones, however the input came about.
    blocks = docs.mapInArrow(_blocks(cfg.block_chars), _BLOCK).withColumn("block", F.monotonically_increasing_id())
    blocks = materialize(blocks.select("*", _part("block", cfg.parts)), "blocks", by="part")
    n_corpus = blocks.agg(F.sum("n_words")).first()[0] or 0
    slices = [materialize(_known(blocks, at, cfg), f"slice-{at}", by="part", free=True) for at in range(cfg.slices)]
    known = reduce(DataFrame.unionAll, [t.withColumn("slice", F.lit(at)) for at, t in enumerate(slices)])
    schema = "doc_id long, n_words long, n_bigrams_found long, log_score double, mean_log_score double"
    scored = []
    for part in range(cfg.parts):
        of_part = [t.filter(F.col("part") == part).drop("part", "n_words") for t in (blocks, known)]
        both = of_part[0].groupBy("block").cogroup(of_part[1].groupBy("block"))
        scored.append(materialize(both.applyInArrow(_score(cfg, n_corpus), schema), f"scores-{part}", free=True))
    discard(blocks, *slices)
    return reduce(DataFrame.unionAll, scored)
