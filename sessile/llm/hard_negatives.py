"""Hard negatives from exact scores, computed in a residue number system.

Inner products of integer vectors are taken modulo several small primes.  Each
prime's residues are small enough for a float32 matrix product to be exact in
any order of its sums; as many primes serve as the scores' bound needs, and
Chinese remaindering gives back the signed scores.

Anchors and candidates lie in blocks of fixed size, dealt by hash, and a task
multiplies one block of each.  A first round gives each block's best rows of an
anchor's own label, which merge to its positives.  A second one takes these
along and gives each block's best rows of other labels within the window below
each positive's score.  What a task hands on is a fixed number of rows for each
anchor or positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessile.llm.storage import materialize

#: Whole numbers up to here are exact in float32.
_EXACT = 1 << 24
#: Components that a product takes at a time.
_SLICE = 1024


@dataclass(frozen=True)
class HardNegatives:
    """Positives of an anchor, negatives of a positive, the window of a negative's score in per cent of the
    positive's, anchors and candidates of a block, anchors multiplied at a time."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    anchor_block: int = 2048
    candidate_block: int = 8192
    chunk: int = 256


def scaled(embedding: Column, by: int = 256) -> Column:
    """floor(by x) of each component; null for a vector that is null or holds a null or non-finite component."""
    values = embedding.cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(values, lambda x: F.floor(x * by).cast("long")))


def moduli(bound: int, width: int) -> list[int]:
    """Primes, largest first, whose product exceeds twice ``bound``, each small enough for ``width`` exact terms."""
    most = 2 * isqrt(_EXACT // max(1, width)) + 1
    prime = np.ones(most + 1, bool)
    for p in range(2, isqrt(most) + 1):
        prime[p * p :: p] = False
    found, product = [], 1
    for p in range(most, 2, -1):
        if prime[p]:
            found.append(p)
            product *= p
            if product > 2 * bound + 1:
                return found
    raise OverflowError(f"no residue number system for scores up to {bound}")


def _residues(x: np.ndarray, p: int) -> np.ndarray:
    """Of each number the residue nearest to 0, as float32."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


class Operand:
    """A matrix of whole numbers and its residues, computed once for each prime."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        self.most = int(np.abs(rows.astype(object)).max()) if rows.size and np.iinfo(np.int64).min in rows else int(np.abs(rows).max(initial=0))
        self.known: dict[int, np.ndarray] = {}

    def modulo(self, p: int) -> np.ndarray:
        if p not in self.known:
            self.known[p] = _residues(self.rows, p)
        return self.known[p]


def products(a: Operand, b: Operand, rows: slice) -> np.ndarray:
    """Exact inner products of ``a``'s ``rows`` with all of ``b``, as int64; OverflowError if one doesn't fit."""
    width = a.rows.shape[1]
    primes = moduli(width * a.most * b.most, min(width, _SLICE))
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        x, y = a.modulo(p)[rows], b.modulo(p)
        total = np.zeros((len(x), len(y)))
        for at in range(0, width, _SLICE):
            total += x[:, at : at + _SLICE] @ y[:, at : at + _SLICE].T
        # Garner's digits: what is left after the smaller places, divided by them, modulo this prime.
        for q, digit in zip(primes[:k], digits, strict=True):
            total = np.mod(total - digit, p) * pow(q, -1, p)
        digits.append(np.mod(total, p))
    product = 1
    for p in primes:
        product *= p
    kind = np.int64 if product < 1 << 62 else object
    score = np.zeros(digits[0].shape, kind)
    for p, digit in zip(reversed(primes), reversed(digits), strict=True):
        score = score * p + digit.astype(np.int64).astype(kind)
    return np.where(score > product // 2, score - product, score).astype(np.int64)


def _best(score: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` of the places ``at`` with the highest scores, equal ones in order of place."""
    if len(at) > k:
        least = np.partition(score[at], -k)[-k]
        at = at[score[at] >= least]
    return at[np.argsort(-score[at], kind="stable")][:k]


def _matrix(vectors: pa.ChunkedArray, n: int) -> np.ndarray:
    return pc.list_flatten(vectors).to_numpy().reshape(n, -1)


def _blocks(anchors: pa.Table, candidates: pa.Table, cfg: HardNegatives) -> Iterator[tuple[int, np.ndarray]]:
    """The number of each anchor and its scores with all candidates."""
    a, b = Operand(_matrix(anchors["vector"], anchors.num_rows)), Operand(_matrix(candidates["c_vector"], candidates.num_rows))
    for start in range(0, anchors.num_rows, cfg.chunk):
        yield from enumerate(products(a, b, slice(start, start + cfg.chunk)), start)


def _long(columns: list, names: list[str]) -> pa.Table:
    return pa.table([pa.array(np.concatenate([np.empty(0, np.int64), *c]).astype(np.int64)) for c in columns], names=names)


_POSITIVE = ["vec_id", "row", "positive_id", "positive_row", "positive_score"]
_NEGATIVE = ["vec_id", "row", "nth", "positive_id", "positive_score", "negative_id", "negative_row", "negative_score"]


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table[c].to_numpy() for c in names]


def _positives(cfg: HardNegatives):
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in _POSITIVE]
        if anchors.num_rows and candidates.num_rows:
            candidates = candidates.sort_by([("c_id", "ascending"), ("c_row", "ascending")])
            ids, rows, labels = _numbers(anchors, "vec_id", "row", "label")
            c_ids, c_rows, c_labels = _numbers(candidates, "c_id", "c_row", "c_label")
            for i, score in _blocks(anchors, candidates, cfg):
                at = _best(score, np.flatnonzero((c_labels == labels[i]) & (c_ids != ids[i])), cfg.positives)
                for column, values in zip(out, (np.full(len(at), ids[i]), np.full(len(at), rows[i]), c_ids[at], c_rows[at], score[at]), strict=True):
                    column.append(values)
        return _long(out, _POSITIVE)

    return run


def _within(score: np.ndarray, positive: int, cfg: HardNegatives) -> np.ndarray:
    """Which scores lie in the window below a positive's score."""
    # Whole bounds, so that nothing overflows: the least from above, the greatest from below.
    low, high = -(-cfg.low * positive // 100), cfg.high * positive // 100
    return (score >= low) & (score <= high)


def _negatives(cfg: HardNegatives):
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in _NEGATIVE]
        if anchors.num_rows and candidates.num_rows:
            candidates = candidates.sort_by([("c_id", "ascending"), ("c_row", "ascending")])
            ids, rows, labels = _numbers(anchors, "vec_id", "row", "label")
            c_ids, c_rows, c_labels = _numbers(candidates, "c_id", "c_row", "c_label")
            known = anchors["positives"].to_pylist()
            for i, score in _blocks(anchors, candidates, cfg):
                other = np.flatnonzero(c_labels != labels[i])
                theirs = score[other]
                for nth, positive in enumerate(known[i]):
                    p_id, p_score = positive["positive_id"], positive["positive_score"]
                    at = _best(score, other[_within(theirs, p_score, cfg)], cfg.negatives)
                    same = [np.full(len(at), v) for v in (ids[i], rows[i], nth, p_id, p_score)]
                    for column, values in zip(out, (*same, c_ids[at], c_rows[at], score[at]), strict=True):
                        column.append(values)
        return _long(out, _NEGATIVE)

    return run


def hard_negatives(vectors: DataFrame, is_anchor: Column, cfg: HardNegatives = HardNegatives()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id``, ``label`` and the integer array ``vector``;
    ``is_anchor`` marks the anchors.  Rows with a null id, label or vector take
    no part and equal rows count once.  A row of the anchor's own id is no
    positive, and a negative if its label differs.  Vectors of another length
    than the anchor's have no score with it.  Equal scores go to the smaller id.  A positive
    without negatives, an anchor without positives and an empty table give no
    rows; a score beyond 64 bits is an error.
    """
    rows = vectors.filter("vec_id is not null and label is not null and vector is not null")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<long>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    rows = rows.groupBy("vec_id", "label", "vector").agg(F.bool_or("is_anchor").alias("is_anchor"))
    rows = materialize(rows.withColumns({"row": F.xxhash64("vec_id", "label", "vector"), "length": F.size("vector")}), "vectors")
    count = rows.agg(F.count("*").alias("all"), F.count_if("is_anchor").alias("asked")).first()
    parts, groups = max(1, -(-count["all"] // cfg.candidate_block)), max(1, -(-count["asked"] // cfg.anchor_block))

    def place(n: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = rows.select(F.col("vec_id").alias("c_id"), F.col("row").alias("c_row"), F.col("label").alias("c_label"), F.col("vector").alias("c_vector"), "length", place(parts, 1).alias("part"))
    candidates = candidates.withColumn("group", every(groups)).groupBy("length", "part", "group")
    anchors = rows.filter("is_anchor").select("vec_id", "row", "label", "vector", "length", place(groups, 2).alias("group"))

    def dealt(asked: DataFrame):
        return asked.withColumn("part", every(parts)).groupBy("length", "part", "group").cogroup(candidates)

    def types(names: list[str]) -> str:
        return ", ".join(f"{c} long" for c in names)

    near = dealt(anchors).applyInArrow(_positives(cfg), types(_POSITIVE))
    order = Window.partitionBy("vec_id", "row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    near = near.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= cfg.positives)
    known = near.groupBy("vec_id", "row").agg(F.sort_array(F.collect_list(F.struct("nth", "positive_id", "positive_score"))).alias("positives"))
    asked = materialize(anchors.join(known, ["vec_id", "row"]), "anchors")

    found = dealt(asked).applyInArrow(_negatives(cfg), types(_NEGATIVE))
    order = Window.partitionBy("vec_id", "row", "nth").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= cfg.negatives)
    return found.select(F.col("vec_id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
