"""Exact top-k by inner product, pruned with segment statistics from coarse to fine.

Vectors are first turned by an orthogonal basis of decreasing variance, which
leaves inner products as they are.  Over a segment of n components with means m
and deviations s in both vectors, their inner product is at most
n (m m' + s s'), which for one component is its product.  A level takes the first
components one by one and the rest as one segment; the next level goes on from
its sum, a few components further, with the pairs that it left.  So a pair is
bounded from above (and its distance from below) the tighter the longer it
stays, and what has been multiplied is not multiplied again.  Which levels pay is
found on a sample of pairs: those with the fewest multiplications a pair in all;
one level stays, even where it takes some more than it saves.  Survivors of the
last level get exact integer scores.

Vectors lie in cells by the signs of their leading components, and a cell in
blocks of fixed size.  A query first searches its own cell, which gives it a
k-th score; then it goes to those cells alone whose extremes allow more, and
takes that score along as the least to reach.  Cells are at most 256, so their
extremes have a fixed size, as has the basis.  Every task meets a block of
queries with a block of candidates and gives at most k rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessile.llm.storage import materialize


@dataclass(frozen=True)
class TopK:
    """Number of results, segments of a cell's statistics as a share of the components, steps of which levels are
    chosen, vectors of the sample that chooses them, candidates (times ``k``) that are scored for a k-th score,
    most sign bits of a cell, queries and candidates of a block, queries bounded at a time."""

    k: int = 20
    segments: float = 1 / 8
    steps: int = 8
    sample: int = 4096
    probes: int = 3
    cell_bits: int = 8
    query_block: int = 2048
    candidate_block: int = 8192
    chunk: int = 128


def scaled(embedding: Column) -> Column:
    """floor(64 x) of each component; null for a vector that is null or holds a null or non-finite component."""
    values = embedding.cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(values, lambda x: F.floor(x * 64).cast("long")))


def cuts(variance: np.ndarray, segments: int) -> np.ndarray:
    """First components of segments of about equal variance; every segment has one component at least."""
    n = len(variance)
    segments = max(1, min(segments, n))
    share = np.cumsum(variance) / max(float(variance.sum()), 1e-300)
    starts = np.searchsorted(share, np.arange(segments) / segments, side="right")
    # Strictly rising, with room for those that follow.
    for i in range(1, segments):
        starts[i] = max(starts[i], starts[i - 1] + 1)
    return np.minimum(np.r_[0, starts[1:]], n - segments + np.arange(segments)).astype(int)


def signature(vectors: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Means and deviations by segment, each times the root of its length: inner products of these are bounds.

    A segment of one component has no deviation."""
    if not vectors.shape[1]:
        return np.zeros((len(vectors), 1))
    size = np.diff(np.r_[starts, vectors.shape[1]])
    mean = np.add.reduceat(vectors, starts, axis=1) / size
    square = np.add.reduceat((vectors - np.repeat(mean, size, axis=1)) ** 2, starts, axis=1)
    return np.hstack([mean * np.sqrt(size), np.sqrt(square[:, size > 1])])


def tail(turned: np.ndarray, first: int) -> np.ndarray:
    """Mean and deviation of the components from ``first`` on, as in ``signature``."""
    rest = turned[:, first:]
    if not rest.shape[1]:
        return np.zeros((len(turned), 2))
    mean = rest.mean(axis=1)
    return np.stack([mean * np.sqrt(rest.shape[1]), np.sqrt(((rest - mean[:, None]) ** 2).sum(axis=1))], axis=1)


class Index:
    """What all tasks share: the basis, the levels, the segments of cells, the cells and their extremes. Its size is fixed."""

    def __init__(self, basis: np.ndarray, variance: np.ndarray, cfg: TopK, bits: int, levels: tuple[int, ...] | None = None) -> None:
        n = len(variance)
        self.basis, self.coarse = basis, cuts(variance, round(n * cfg.segments)) if n else np.zeros(1, int)
        #: Leading components of each level.
        self.levels = tuple(sorted({round(n * k / cfg.steps) for k in range(2, cfg.steps)} - {0, n})) if levels is None else levels
        self.bits = min(bits, n)
        self.low = self.high = np.empty((0, 0))
        self.cells = np.empty(0, np.int64)

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        return vectors.astype(float) @ self.basis

    def cell_of(self, turned: np.ndarray) -> np.ndarray:
        return ((turned[:, : self.bits] > 0) << np.arange(self.bits)).sum(axis=1)

    def bounds_of_cells(self, turned: np.ndarray) -> np.ndarray:
        """Most that each query can score in each cell, from the least and greatest statistics of the cell's vectors."""
        q = signature(turned, self.coarse)
        return np.maximum(q[:, None, :] * self.low[None], q[:, None, :] * self.high[None]).sum(axis=2)


def search_block(q_ids: np.ndarray, q: np.ndarray, least: np.ndarray, c_ids: np.ndarray, c: np.ndarray, index: Index, cfg: TopK) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray]:
    """For each query the ids and scores of its best candidates in this block, of those that score ``least`` or
    more; best first.  Also the numbers of pairs that each level, and at first all of them, left."""
    turned_q, turned_c = index.turned(q), index.turned(c)
    of_q, of_c = ([tail(v, level) for level in index.levels] for v in (turned_q, turned_c))
    # Scores are integers; half a unit is far more than what rounding adds to a bound.
    slack = 0.5 + 1e-9 * float(np.linalg.norm(q, axis=1).max(initial=0)) * float(np.linalg.norm(c, axis=1).max(initial=0))
    out, left = [], np.zeros(len(index.levels) + 1, dtype=np.int64)
    least, probe = least.astype(float).copy(), cfg.probes * cfg.k
    for a in range(0, len(q), cfg.chunk):
        rows = np.arange(a, min(a + cfg.chunk, len(q)))
        alive = c_ids[None, :] != q_ids[rows, None]
        left[0] += alive.sum()
        so_far, done, thin = np.zeros(alive.shape), 0, None
        for k, level in enumerate(index.levels):
            if thin is None:
                so_far += turned_q[rows, done:level] @ turned_c[:, done:level].T
                guess = so_far + np.outer(of_q[k][rows, 0], of_c[k][:, 0])
                if k == 0 and len(c) > probe:
                    # A k-th score, from the candidates that seem best without deviations.
                    best = np.argpartition(np.where(alive, guess, -np.inf), -probe, axis=1)[:, -probe:]
                    exact = np.einsum("qkd,qd->qk", c[best], q[rows]).astype(float)
                    exact = np.where(np.take_along_axis(alive, best, axis=1), exact, -np.inf)
                    least[rows] = np.maximum(least[rows], np.partition(exact, -cfg.k, axis=1)[:, -cfg.k])
                guess += np.outer(of_q[k][rows, 1], of_c[k][:, 1])
                alive &= guess >= least[rows, None] - slack
                if alive.mean() < 0.25:
                    thin = [(at, so_far[i, at]) for i in range(len(rows)) for at in [np.flatnonzero(alive[i])]]
            else:
                for i, row in enumerate(rows):
                    at, sums = thin[i]
                    sums = sums + turned_c[at, done:level] @ turned_q[row, done:level]
                    keep = sums + of_c[k][at] @ of_q[k][row] >= least[row] - slack
                    thin[i] = at[keep], sums[keep]
                alive[:] = False
                for i, (at, _) in enumerate(thin):
                    alive[i, at] = True
            done = level
            left[k + 1] += alive.sum()
        for i, row in enumerate(rows):
            at = np.flatnonzero(alive[i])
            scores = c[at] @ q[row]
            keep = scores >= least[row]
            at, scores = at[keep], scores[keep]
            order = np.lexsort((c_ids[at], -scores))[: cfg.k]
            out.append((q_ids[row], c_ids[at][order], scores[order]))
    return out, left


def _search(index: Index, size: int, cfg: TopK):
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0, np.int64)})
        if queries.empty or candidates.empty:
            return none
        stack = lambda v: np.stack(v.to_numpy()).astype(np.int64).reshape(len(v), size)
        rows, _ = search_block(queries["vec_id"].to_numpy(), stack(queries["vector"]), queries["least"].to_numpy(), candidates["c_id"].to_numpy(), stack(candidates["c_vector"]), index, cfg)
        parts = [np.concatenate(x) for x in ([np.full(len(v), o) for o, v, _ in rows], [v for _, v, _ in rows], [s for *_, s in rows])]
        return pd.DataFrame(dict(zip(none.columns, parts, strict=True)), dtype=np.int64)

    return run


def _moments(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size + 1, size + 1))
        for pdf in batches:
            if len(pdf):
                x = np.hstack([np.ones((len(pdf), 1)), np.stack(pdf["vector"].to_numpy()).astype(float).reshape(len(pdf), size)])
                total += x.T @ x
        yield pd.DataFrame({"i": np.arange(size + 1), "part": list(total)})

    return run


def _extremes(index: Index, size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                turned = index.turned(np.stack(pdf["vector"].to_numpy()).reshape(len(pdf), size))
                stats = pd.DataFrame(signature(turned, index.coarse)).groupby(index.cell_of(turned))
                low, high = stats.min(), stats.max()
                yield pd.DataFrame({"cell": low.index.to_numpy(np.int32), "n": stats.size().to_numpy(np.int64), "low": list(low.to_numpy()), "high": list(high.to_numpy())})

    return run


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"i": pdf["i"].iloc[:1], "part": [np.sum(np.stack(pdf["part"].to_numpy()), axis=0)]})


def _widest(pdf: pd.DataFrame) -> pd.DataFrame:
    low, high = np.min(np.stack(pdf["low"].to_numpy()), axis=0), np.max(np.stack(pdf["high"].to_numpy()), axis=0)
    return pd.DataFrame({"cell": pdf["cell"].iloc[:1], "n": [int(pdf["n"].sum())], "low": [low], "high": [high]})


def multiplications(left: list[float], levels: tuple[int, ...], size: int) -> float:
    """Of a pair, on average: ``left`` is the share of pairs that reach each of ``levels``, and that get a score."""
    steps = np.diff([0, *levels]) + 2
    return float(sum(share * step for share, step in zip(left, steps, strict=False)) + left[-1] * size)


def chosen_levels(vectors: np.ndarray, index: Index, cfg: TopK) -> tuple[tuple[int, ...], list[float]]:
    """The levels, one at least, that take the fewest multiplications on a sample of pairs, and the share of pairs that
    reaches each and the score."""
    n, size = len(vectors), vectors.shape[1]
    every = index.levels
    asked = vectors[: max(1, n // 20)][:256]
    ids = np.arange(n)
    _, left = search_block(ids[: len(asked)], asked, np.full(len(asked), -np.inf), ids, vectors, index, cfg)
    after = dict(zip(every, left[1:] / max(1, left[0]), strict=True))
    best, levels, shares = np.inf, (), [1.0]
    for picked in range(1, 1 << len(every)):
        some = tuple(b for k, b in enumerate(every) if picked >> k & 1)
        share = [1.0, *(float(after[b]) for b in some)]
        if (cost := multiplications(share, some, size)) < best:
            best, levels, shares = cost, some, share
    return levels, shares


def _fit(rows: DataFrame, size: int, n: int, cfg: TopK) -> tuple[Index, dict[int, int]]:
    """The index over all ``rows`` and the number of vectors of each cell; partitions add up what reaches the driver."""
    parts = rows.select("vector").mapInPandas(_moments(size), "i int, part array<double>").groupBy("i").applyInPandas(_added, "i int, part array<double>").orderBy("i").collect()
    sums = np.array([r["part"] for r in parts]).reshape(size + 1, size + 1)
    mean = sums[0, 1:] / max(n, 1)
    variance, basis = np.linalg.eigh(sums[1:, 1:] / max(n, 1) - np.outer(mean, mean)) if size else (np.empty(0), np.empty((0, 0)))
    bits = min(cfg.cell_bits, max(0, int(np.log2(max(1, n / cfg.candidate_block)))))
    index = Index(basis[:, ::-1], np.maximum(variance[::-1], 0), cfg, bits)
    # A sample of bounded size, the same in every run.
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(cfg.sample).select("vector").toArrow()
    if size and drawn.num_rows > cfg.k:
        index.levels, _ = chosen_levels(np.array(drawn["vector"].to_pylist(), dtype=np.int64), index, cfg)
    shape = "cell int, n long, low array<double>, high array<double>"
    cells = rows.select("vector").mapInPandas(_extremes(index, size), shape).groupBy("cell").applyInPandas(_widest, shape).orderBy("cell").collect()
    index.cells = np.array([r["cell"] for r in cells], np.int64)
    index.low, index.high = (np.array([r[c] for r in cells]) for c in ("low", "high"))
    return index, {r["cell"]: -(-r["n"] // cfg.candidate_block) for r in cells}


def _top_k(rows: DataFrame, size: int, n: int, cfg: TopK) -> DataFrame:
    """``top_k`` of the ``n`` vectors of one length."""
    index, blocks = _fit(rows, size, n, cfg)
    place = lambda count: F.pmod(F.xxhash64("vec_id"), count).cast("int")
    of = lambda v: np.stack(v.to_numpy()).reshape(len(v), size)
    cell = F.pandas_udf(lambda v: pd.Series(index.cell_of(index.turned(of(v))) if len(v) else [], dtype="int32"), "int")
    n_blocks = F.element_at(F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair]), F.col("cell"))
    rows = materialize(rows.withColumn("cell", cell("vector")), "vectors")
    candidates = rows.select(F.col("vec_id").alias("c_id"), F.col("vector").alias("c_vector"), F.col("cell").alias("c_cell"), place(n_blocks).alias("c_p"))
    queries = rows.filter("is_query")
    def searched(asked: DataFrame) -> DataFrame:
        """Results of the queries in their cells' blocks; as many groups of them as the queries that a cell is asked by make."""
        asked = materialize(asked, "asked")
        counts = {r["cell"]: -(-r["count"] // cfg.query_block) for r in asked.groupBy("cell").count().collect()}
        groups = F.element_at(F.create_map(*[F.lit(x) for pair in (counts or {0: 1}).items() for x in pair]), F.col("cell"))
        asked = asked.withColumn("p", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        pairs = asked.select("vec_id", "vector", "least", "cell", "p", F.pmod(F.xxhash64("vec_id", F.lit(1)), groups).cast("int").alias("g"))
        every = pairs.select(F.col("cell").alias("of_cell"), F.col("p").alias("of_p"), F.col("g").alias("of_g")).distinct()
        dealt = candidates.join(every, (F.col("c_cell") == F.col("of_cell")) & (F.col("c_p") == F.col("of_p"))).select("c_id", "c_vector", "of_cell", "of_p", "of_g")
        found = pairs.groupBy("cell", "p", "g").cogroup(dealt.groupBy("of_cell", "of_p", "of_g"))
        return found.applyInPandas(_search(index, size, cfg), "query_id long, vec_id long, score long")

    own = materialize(searched(queries.withColumn("least", F.lit(float("-inf")))), "own")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    reached = own.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == cfg.k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("least"))

    def further(vector: pd.Series, cell: pd.Series, least: pd.Series) -> pd.Series:
        if not len(vector):
            return pd.Series([], dtype=object)
        turned = index.turned(of(vector))
        slack = 0.5 + 1e-9 * np.abs(index.bounds_of_cells(turned)).max(axis=1)
        allowed = (index.bounds_of_cells(turned) >= (least.to_numpy() - slack)[:, None]) & (index.cells[None, :] != cell.to_numpy()[:, None])
        return pd.Series([index.cells[a].astype(np.int32) for a in allowed])

    if len(blocks) == 1:
        return own
    asked = queries.join(reached, "vec_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    asked = asked.withColumn("cell", F.explode(F.pandas_udf(further, "array<int>")("vector", "cell", "least")))
    return own.unionByName(searched(asked))


def top_k(vectors: DataFrame, is_query: Column, cfg: TopK = TopK()) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` best among all other vectors.

    ``vectors`` has ``vec_id`` and the integer array ``vector``; ``is_query``
    marks the queries.  Rows with a null id or vector take no part, rows that
    repeat id and vector count once, vectors of another length than the
    query's are no candidates, and neither is the query's own id.  Equal scores
    go to the smaller id.  An empty table gives no rows.  Vectors of each
    length are searched for themselves; lengths are few.
    """
    rows = vectors.filter("vec_id is not null and vector is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "vector", F.coalesce(is_query, F.lit(False)).alias("is_query")).distinct()
    rows = materialize(rows, "all")
    lengths = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"), F.count_if("is_query").alias("asked")).filter("asked > 0").collect()
    found = None
    for r in lengths:
        part = _top_k(rows.filter(F.size("vector") == r["size"]), r["size"], r["n"], cfg)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0).cast("long").alias("score")).filter(F.lit(False))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= cfg.k).select("query_id", "rank", "vec_id", "score")
