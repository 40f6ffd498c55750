"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Labelled documents (a bounded sample of both classes) give the terms that tell
the classes apart, by chi-squared; document frequencies of these terms come
from all documents.  The index has a posting list for each term, cut into
blocks of examples that lie next to each other, alike ones together, and the
greatest weight of each list in each block.  Sums of these bound what a block's
examples can score.  A document visits blocks from the greatest bound down until
the next bound is below its k-th score, so that its neighbours are exact.  They
vote by distance, and an isotonic fit on other labelled documents turns votes
into probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessile.llm.quality_classifier import _isotonic, fold
from sessile.llm.near_dedup import shingle_sets
from sessile.llm.storage import discard, materialize
from sessile.llm.words import WordHashes, chunks, mix, texts_of

_WORD = re.compile(r"[^\W_]+")
#: Similarities are whole numbers of this unit, so that ties are ties.
_UNIT = 1e-9
_PLACE_BITS = 24


@dataclass(frozen=True)
class ToxicityParams:
    """Bounds of the labelled sample: examples of each class, and calibrating documents; terms of the index, at most,
    their least chi-squared and documents; words of a shingle and sketches, one of which in common makes examples
    copies; neighbours that vote, weight of a vote at distance 0 (at 1 it is about 1), examples of a block,
    documents searched at a time, neighbours given as evidence."""

    per_class: int = 6000
    calibrating: int = 12000
    terms: int = 1024
    least_chi: float = 30.0
    least_docs: int = 3
    shingle: int = 5
    sketches: int = 6
    neighbours: int = 15
    nearness: float = 20.0
    block: int = 64
    batch: int = 512
    evidence: int = 3


def words_of(text: str | None) -> list[str]:
    """Words (runs of letters and digits) of a text in lower case; a null text has none."""
    return _WORD.findall(text.lower()) if text else []


class BlockMaxIndex:
    """Posting lists of unit vectors by term and block, with the greatest weight of each list in each block.

    ``terms``, ``weights`` and ``starts`` hold the vectors one after another;
    ``ids`` order equal scores, smaller first.
    """

    def __init__(self, terms: np.ndarray, weights: np.ndarray, starts: np.ndarray, ids: np.ndarray, n_terms: int, block: int) -> None:
        n = len(starts) - 1
        owner = np.repeat(np.arange(n), np.diff(starts))
        heavy = np.zeros((n, 2), np.int64)
        order = np.lexsort((-weights, owner))
        for k in (0, 1):
            has = np.diff(starts) > k
            heavy[has, k] = terms[order][starts[:-1][has] + k] + 1
        # Alike vectors share a block: its greatest weights then say more.
        line = np.lexsort((ids, heavy[:, 1], heavy[:, 0]))
        place = np.empty(n, np.int64)
        place[line] = np.arange(n)
        self.n, self.block, self.n_terms = n, block, n_terms
        self.n_blocks = -(-n // block)
        #: Of each place in blocks: the example's number, and its rank by id.
        self.example = np.r_[line, np.full(self.n_blocks * block - n, -1)]
        rank = np.empty(n, np.int64)
        rank[np.argsort(ids, kind="stable")] = np.arange(n)
        self.rank = np.r_[rank[line], np.zeros(self.n_blocks * block - n, np.int64)]
        self.by_rank = np.argsort(ids, kind="stable")
        at = np.lexsort((place[owner], terms))
        self.slot = (place[owner][at] % block).astype(np.int32)
        self.weight = weights[at]
        cell = terms[at] * self.n_blocks + place[owner][at] // block
        self.first = np.searchsorted(cell, np.arange(n_terms * self.n_blocks + 1))
        most = np.zeros(n_terms * self.n_blocks)
        np.maximum.at(most, cell, self.weight)
        self.most = np.nextafter(most.reshape(n_terms, self.n_blocks).astype(np.float32), np.float32(np.inf))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Of each query the numbers of its ``k`` nearest examples (-1: fewer have a common term) and their
        similarities; also the number of blocks that were looked at."""
        n = len(starts) - 1
        # A score and, below it, the example's rank turned round: the greater number is the better example.
        best = np.zeros((n, k), np.int64)
        visits = 0
        if n and self.n_blocks:
            dense = np.zeros((n, self.n_terms), np.float32)
            dense[np.repeat(np.arange(n), np.diff(starts)), terms] = weights
            bound = dense @ self.most
            order = np.argsort(-bound, axis=1, kind="stable")
            bound = np.take_along_axis(bound, order, axis=1).astype(float) * (1 + 1e-5) + 1e-6
            at, step, alive = 0, 1, np.flatnonzero(np.diff(starts) > 0)
            while at < self.n_blocks and len(alive):
                alive = alive[(bound[alive, at] > 2e-6) & (bound[alive, at] >= (best[alive].min(axis=1) >> _PLACE_BITS) * _UNIT)]
                blocks = order[alive, at : at + step]
                found = self._scores(alive, blocks, terms, weights, starts)
                visits += blocks.size
                best[alive] = -np.partition(-np.hstack([best[alive], found]), k - 1, axis=1)[:, :k]
                at, step = at + step, min(2 * step, 16)
        best = -np.sort(-best, axis=1)
        known = best > 0
        rank = (1 << _PLACE_BITS) - 1 - (best & ((1 << _PLACE_BITS) - 1))
        return np.where(known, self.by_rank[np.where(known, rank, 0)] if self.n else -1, -1), np.where(known, best >> _PLACE_BITS, 0) * _UNIT, visits

    def _scores(self, queries: np.ndarray, blocks: np.ndarray, terms: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores, with ranks below, of all examples of each query's ``blocks``; 0 where no term is shared."""
        size, each = np.diff(starts)[queries], blocks.shape[1]
        pair_size = np.repeat(size, each)
        of_pair = np.repeat(np.arange(len(pair_size)), pair_size)
        inner = np.arange(len(of_pair)) - np.repeat(np.cumsum(pair_size) - pair_size, pair_size)
        term = np.repeat(starts[:-1][queries], each)[of_pair] + inner
        cell = terms[term] * self.n_blocks + blocks.reshape(-1)[of_pair]
        a, length = self.first[cell], self.first[cell + 1] - self.first[cell]
        posting = np.repeat(a - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        row = np.repeat(of_pair, length) * self.block + self.slot[posting]
        total = np.bincount(row, weights=self.weight[posting] * np.repeat(weights[term], length), minlength=len(pair_size) * self.block)
        score = np.rint(total / _UNIT).astype(np.int64)
        rank = self.rank.reshape(-1, self.block)[blocks.reshape(-1)].reshape(-1)
        return np.where(score > 0, (score << _PLACE_BITS) | ((1 << _PLACE_BITS) - 1 - rank), 0).reshape(len(queries), each * self.block)


@dataclass(frozen=True)
class ToxicityModel:
    """Terms with their weights by document frequency, the index, ids and labels of its examples, the isotonic fit,
    and the score of a document without neighbours."""

    terms: list[str]
    idf: np.ndarray
    index: BlockMaxIndex
    ids: np.ndarray
    labels: np.ndarray
    prior: float
    knots: np.ndarray
    levels: np.ndarray
    alone: float
    params: ToxicityParams

    def votes(self, terms: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Share of the votes for label 1, neighbours and similarities of each vector; without neighbours the share is null."""
        weights = unit_vectors(terms, counts, starts, self.idf)
        near, cosine = [np.empty((0, self.params.neighbours), t) for t in (np.int64, float)]
        for a in range(0, len(starts) - 1, self.params.batch):
            part = starts[a : a + self.params.batch + 1]
            found = self.index.nearest(terms[part[0] : part[-1]], weights[part[0] : part[-1]], part - part[0], self.params.neighbours)
            near, cosine = np.vstack([near, found[0]]), np.vstack([cosine, found[1]])
        weight = np.where(near >= 0, 1 / (1 - np.minimum(cosine, 1) + 1 / self.params.nearness), 0)
        label = self.labels[near] if len(self.labels) else np.zeros(near.shape)
        # The classes of the sample aren't as frequent as in the corpus; a single vote for that stands for what isn't known.
        return np.where((near >= 0).any(axis=1), ((weight * label).sum(axis=1) + self.prior) / (weight.sum(axis=1) + 1), np.nan), near, cosine

    def probability(self, votes: np.ndarray) -> np.ndarray:
        known = np.nan_to_num(votes)
        level = np.interp(known, self.knots, self.levels) if len(self.knots) else known
        # Within a level the share of the votes still orders.
        return np.where(np.isnan(votes), self.alone, 0.999 * level + 0.001 * known)


def unit_vectors(terms: np.ndarray, counts: np.ndarray, starts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights (1 + ln tf) idf, scaled to length 1 by vector."""
    weights = (1 + np.log(np.maximum(counts, 1))) * idf[terms]
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    length = np.sqrt(np.bincount(owner, weights=weights**2, minlength=len(starts) - 1))
    return weights / length[owner]


def _flat(terms: pa.Array | pa.ChunkedArray, counts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms and counts one vector after another, and where each vector starts."""
    sizes, flat, n = (np.asarray(x, dtype=np.int64) for x in (pc.list_value_length(terms), pc.list_flatten(terms), pc.list_flatten(counts)))
    return flat, n, np.r_[0, np.cumsum(sizes)]


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            words, labels = [], []
            for text, label in zip(part["text"].to_pylist(), part["label"].to_pylist(), strict=True):
                own = set(words_of(text))
                words += own
                labels += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(labels, pa.int32())], names=["word", "label"])


def _counted(terms: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(terms)}
        for batch in batches:
            for part in chunks(batch, "text"):
                rows = []
                for text in part["text"].to_pylist():
                    found = Counter(map(number.get, words_of(text)))
                    found.pop(None, None)
                    rows.append(sorted(found.items()))
                of = [pa.array([[x[i] for x in row] for row in rows], pa.list_(pa.int32())) for i in (0, 1)]
                kept = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*[part[c] for c in kept], *of], names=[*kept, "terms", "counts"])

    return run


def term_vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``docs`` with, instead of ``text``, ``terms`` and ``counts``: which of ``terms`` (by number, ascending) the whole text has, how often."""
    kept = ", ".join(f"{c} {t}" for c, t in docs.dtypes if c != "text")
    return docs.mapInArrow(_counted(terms), f"{kept}, terms array<int>, counts array<int>")


def _sketched(params: ToxicityParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in chunks(batch, "text"):
                    elements, sizes = shingle_sets(texts_of(part, "text"), params.shingle, known)
                    full = sizes > 0
                    least = np.zeros((len(sizes), params.sketches), np.int64)
                    for k in range(params.sketches):
                        if full.any():
                            hashed = mix(elements + np.uint64((k + 1) * 0xD1B54A32D192ED03 % (1 << 64)))
                            least[full, k] = np.minimum.reduceat(hashed, (np.cumsum(sizes) - sizes)[full]).view(np.int64)
                    rows = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * params.sketches), pa.array(least.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([*part.columns, rows], names=[*part.schema.names, "sketch"])

    return run


def _sample(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> DataFrame:
    """``doc_id, text, label, calibrate`` of the labelled sample: each class up to its bound by hash of the id.

    Of near copies among the examples, and of equal texts that calibrate, one row stays.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("label_id"), "label").filter("label is not null and label_id is not null")
    known = known.groupBy("label_id").agg((F.avg(F.col("label").cast("double")) >= 0.5).cast("int").alias("label"))
    known = known.withColumns({"fold": fold(F.col("label_id")), "draw": F.xxhash64("label_id")}).filter("fold <> 0")
    known = known.withColumn("calibrate", F.col("fold") == 4)

    def part(rows: DataFrame, most: int) -> DataFrame:
        return rows.orderBy("draw", "label_id").limit(most)

    few = part(known.filter("calibrate"), params.calibrating)
    for label in (0, 1):
        few = few.unionByName(part(known.filter(~F.col("calibrate") & (F.col("label") == label)), params.per_class))
    # Bounded by the parameters, so that each executor can hold it.
    few = materialize(few.select("label_id", "label", "calibrate", "draw"), "labelled")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(few), F.col("doc_id") == F.col("label_id")).withColumn("hash", F.xxhash64("text"))
    # Rows that share an id may be many: equal ones are one first.
    rows = rows.dropDuplicates(["hash", "doc_id"]).select("doc_id", "text", "label", "calibrate", "draw", "hash")
    shape = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    rows = materialize(rows.mapInArrow(_sketched(params), f"{shape}, sketch array<long>"), "sample")

    def first_of(keys: DataFrame, by: list[Column]) -> DataFrame:
        return keys.groupBy(*by).agg(F.min(F.struct("draw", "doc_id", "hash", "sketch", "calibrate")).alias("first")).select("first.*")

    held = first_of(rows.filter("calibrate"), [F.col("hash")])
    keys = rows.filter("not calibrate")
    for k in range(params.sketches):
        keys = first_of(keys, [F.col("sketch")[k]])
    return rows.join(keys.unionByName(held).select("doc_id", "hash"), ["doc_id", "hash"]).select("doc_id", "text", "label", "calibrate")


def select_terms(examples: DataFrame, params: ToxicityParams) -> list[str]:
    """The terms of ``examples (text, label)`` whose presence tells most about the label, by chi-squared; a fixed number at most."""
    n = examples.agg(F.sum("label").alias("pos"), F.count("*").alias("all")).first()
    pos, every = float(n["pos"] or 0), float(n["all"])
    seen = examples.select("text", "label").mapInArrow(_distinct_words, "word string, label int").groupBy("word").agg(F.sum("label").cast("double").alias("a"), F.count("*").cast("double").alias("df"))
    a, df = F.col("a"), F.col("df")
    spread = df * (every - df) * pos * (every - pos)
    chi = F.when(spread > 0, every * (a * every - df * pos) ** 2 / spread).otherwise(0.0)
    best = seen.filter(df >= params.least_docs).withColumn("chi", chi).filter(F.col("chi") >= params.least_chi)
    return sorted(r["word"] for r in best.orderBy(F.desc("chi"), "word").limit(params.terms).collect())


def _voted(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = model.votes(*_flat(batch["terms"], batch["counts"]))[0]
            yield pa.RecordBatch.from_arrays([batch["label"], pa.array(votes)], names=["label", "vote"])

    return run


def _scored(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = model.params.evidence
        for batch in batches:
            votes, near, cosine = model.votes(*_flat(batch["terms"], batch["counts"]))
            shown = (near >= 0) & (np.arange(near.shape[1]) < most)
            of, row = near[shown], np.r_[0, np.cumsum(shown.sum(axis=1))].astype(np.int32)
            evidence = pa.StructArray.from_arrays(
                [pa.array(model.ids[of], pa.int64()), pa.array(model.labels[of].astype(np.int32)), pa.array(cosine[shown])], names=["doc_id", "label", "cosine"]
            )
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.probability(votes)), pa.ListArray.from_arrays(pa.array(row), evidence)], names=["doc_id", "score", "evidence"])

    return run


def _frequencies(n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(np.asarray(pc.list_flatten(batch["terms"]), dtype=np.int64), minlength=n_terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "n"])

    return run


def document_vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``doc_id, terms, counts`` of every row of ``docs``."""
    return term_vectors(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), terms)


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> tuple[ToxicityModel, DataFrame]:
    """The model, and the written term vectors of all ``docs``, for ``score``.

    ``labels`` has ``doc_id`` and ``label`` (0, 1 or null); held-out ids (fold
    0) are left out, ids of fold 4 calibrate (without any, the examples do),
    the others are examples.  An id with several labels has that of the
    majority, 1 if they are as many.  Without labelled rows all scores are 0.
    """
    sample = materialize(_sample(docs, labels, params), "sample")
    examples, calibrating = sample.filter("not calibrate"), sample.filter("calibrate")
    terms = select_terms(examples, params)
    vectors = materialize(document_vectors(docs, terms), "vectors")
    df = np.zeros(len(terms))
    for r in vectors.select("terms").mapInArrow(_frequencies(len(terms)), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r["term"]] = r["n"]
    idf = 1 + np.log((1 + vectors.count()) / (1 + df))

    # The sample has a fixed size.  Examples without a term are near to nothing.
    rows = term_vectors(examples.select("doc_id", "label", "text"), terms).toArrow()
    prior = float(np.mean(rows["label"].to_numpy())) if rows.num_rows else 0.0
    rows = rows.filter(pc.greater(pc.list_value_length(rows["terms"]), 0)).combine_chunks()
    flat, counts, starts = _flat(rows["terms"], rows["counts"])
    ids, known = rows["doc_id"].to_numpy().astype(np.int64), rows["label"].to_numpy().astype(float)
    index = BlockMaxIndex(flat, unit_vectors(flat, counts, starts, idf), starts, ids, len(terms), params.block)
    model = ToxicityModel(terms, idf, index, ids, known, prior, np.empty(0), np.empty(0), 0.0, params)

    held = calibrating if calibrating.take(1) else examples
    found = term_vectors(held.select("label", "text"), terms).mapInArrow(_voted(model), "label int, vote double").toArrow()
    discard(sample)
    y, vote = (found[c].to_numpy().astype(float) for c in ("label", "vote"))
    alone = np.isnan(vote)
    # Half a document of the prior, so that few without neighbours prove nothing.
    base = float((y[alone].sum() + prior / 2) / (alone.sum() + 0.5))
    if not alone.all():
        x, at = np.unique(vote[~alone], return_inverse=True)
        many = np.bincount(at).astype(float)
        knots, levels = _isotonic(x * many, np.bincount(at, weights=y[~alone]), many)
        model = replace(model, knots=knots, levels=levels)
    return replace(model, alone=min(base, prior)), vectors


def score(vectors: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score, evidence`` of every row of ``vectors``; evidence is an array of (doc_id, label, cosine), nearest first."""
    return vectors.select("doc_id", "terms", "counts").mapInArrow(_scored(model), "doc_id long, score double, evidence array<struct<doc_id long, label int, cosine double>>")


def classify(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``evidence`` of every row of ``docs``, learnt from ``labels (doc_id, label)``.

    Only doc_id and text are read.  A null, empty or unrelated text has no
    neighbours and the share of label 1 among such texts; null ids and repeated
    rows are rows like others; ties between examples go to the smaller id; an
    empty table gives no rows.
    """
    model, vectors = fit(docs, labels, params)
    return score(vectors, model)
