"""Near-duplicate groups by fast similarity sketching.

Every document's set of word shingles is thrown at ``bins`` coordinates in
rounds: round ``i < bins`` hashes each element to one bin, round ``bins + j``
sends all elements to bin ``j``; a coordinate keeps the least value of the
first round that reached it.  After at most ``2 * bins`` rounds every
coordinate is filled, however small the set, and two sets agree in a
coordinate with the probability of their Jaccard similarity, with the
concentration of independent samples.  Bands of coordinates give candidates;
full shingle sets confirm each link.

Hot groups.  Documents with equal sets are one class from the start.  In a
bucket of a band, a member is first held against one representative; only
members of buckets that still hold several components are compared further,
across components, in parts of ``part`` members each that are tasks' keys of
their own.  So a bucket of m copies costs m comparisons, and no link between
documents that share a bucket is lost.  A map of 4096 bits, of which
every element of a set sets one, bounds what two sets can share before they are
read: each bit that only one of them has stands for an element that the other
lacks.  The bound leaves out no pair that is similar enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessile.llm.storage import discard, materialize
from sessile.llm.words import WordHashes, chunks, hashed_words, mix, texts_of


@dataclass(frozen=True)
class NearDedup:
    """Parameters: words of a shingle, per cent of similarity, coordinates, coordinates of a band, bits of a map,
    members of a part of a bucket.

    With 378 coordinates in bands of 6, a pair at similarity 0.75 shares no
    bucket with probability (1 - 0.75**6)**63 < 4.4e-6, one at 0.3 shares one
    with probability 0.045.
    """

    shingle: int = 5
    percent: int = 75
    bins: int = 378
    band: int = 6
    map_bits: int = 4096
    part: int = 2000


_SKETCH = "doc_id long, text_hash long, n_shingles long, fp1 long, fp2 long, bands array<long>"
#: A node's set, and the map of bits that its elements set.
_SETS = "node long, elements array<long>, bits array<long>"


def shingle_sets(texts: list[bytes], size: int, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, one text after another, and their number by text."""
    flat, counts = hashed_words([t.lower() for t in texts], known)
    ends = np.cumsum(counts)
    rolled = np.zeros(max(0, len(flat) - size + 1), dtype=np.uint64)
    for k in range(size):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + flat[k : k + len(rolled)]
    rolled = mix(rolled)
    sets = []
    for a, b in zip(ends - counts, ends, strict=True):
        if b - a >= size:
            sets.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            short = np.uint64(b - a)
            for w in flat[a:b]:
                short = mix(np.array([short * np.uint64(3) + w]))[0]
            sets.append(np.array([short], dtype=np.uint64))
        else:
            sets.append(np.empty(0, dtype=np.uint64))
    lengths = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    return (np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)), lengths


def sketches(elements: np.ndarray, lengths: np.ndarray, bins: int) -> np.ndarray:
    """One row of ``bins`` filled coordinates for each non-empty set (an empty set's row means nothing)."""
    n, unset = len(lengths), np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((n, bins), unset, dtype=np.uint64)
    cells, owner = out.reshape(-1), np.repeat(np.arange(n), lengths)
    low = np.uint64((1 << 48) - 1)
    for i in range(2 * bins):
        if not len(elements):
            break
        h = mix(elements + np.uint64((i + 1) * 0xD1B54A32D192ED03 % (1 << 64)))
        at = (h >> np.uint64(48)).astype(np.int64) % bins if i < bins else i - bins
        np.minimum.at(cells, owner * bins + at, np.uint64(i << 48) | (h & low))
        open_ = (out == unset).any(axis=1)[owner]
        elements, owner = elements[open_], owner[open_]
    return out


def bit_maps(elements: np.ndarray, lengths: np.ndarray, bits: int) -> np.ndarray:
    """One row of ``bits`` bits, packed, for each set: an element sets one bit."""
    found = np.zeros((len(lengths), bits), dtype=bool)
    found[np.repeat(np.arange(len(lengths)), lengths), (mix(elements) % np.uint64(bits)).astype(np.int64)] = True
    return np.packbits(found, axis=1).view(np.int64)


def _reduce(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum modulo 2**64 of each run of ``values``."""
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def _sketch(cfg: NearDedup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n_bands = WordHashes(), cfg.bins // cfg.band
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in chunks(batch, "text"):
                    elements, lengths = shingle_sets(texts_of(part, "text"), cfg.shingle, known)
                    rows = sketches(elements, lengths, cfg.bins).reshape(len(lengths), n_bands, cfg.band)
                    keys = np.broadcast_to(np.arange(n_bands, dtype=np.uint64), rows.shape[:2])
                    for k in range(cfg.band):
                        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
                    keys = keys[lengths > 0]
                    offsets = np.concatenate([[0], np.cumsum((lengths > 0) * n_bands)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part["doc_id"].cast(pa.int64()),
                            part["text_hash"],
                            pa.array(lengths),
                            pa.array(_reduce(mix(elements), lengths).view(np.int64)),
                            pa.array(_reduce(mix(elements ^ np.uint64(0xA5A5A5A5A5A5A5A5)), lengths).view(np.int64)),
                            pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(keys).reshape(-1).view(np.int64))),
                        ],
                        names=["doc_id", "text_hash", "n_shingles", "fp1", "fp2", "bands"],
                    )

    return run


def _full_sets(cfg: NearDedup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in chunks(batch, "text"):
                    elements, lengths = shingle_sets(texts_of(part, "text"), cfg.shingle, known)
                    same = (_reduce(mix(elements), lengths).view(np.int64) == part["fp1"].to_numpy()) & (lengths == part["n_shingles"].to_numpy())
                    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
                    sets = pa.ListArray.from_arrays(offsets, pa.array(elements.view(np.int64)))
                    packed = bit_maps(elements, lengths, cfg.map_bits)
                    maps = pa.ListArray.from_arrays(pa.array(np.arange(len(packed) + 1, dtype=np.int32) * packed.shape[1]), pa.array(packed.reshape(-1)))
                    out = pa.RecordBatch.from_arrays([part["node"], sets, maps], names=["node", "elements", "bits"])
                    yield out.filter(pa.array(same))

    return run


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` for the nodes of ``edges (a, b)``; comp is the least node reachable.

    Each round gives a node the least label around it, then the label of that
    label; rounds go on until nothing changes.  Labels stay in Spark.
    """
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "node").select("node", F.least("comp", "near").alias("next"), "comp")
        jump = labels.select(F.col("node").alias("next"), F.col("comp").alias("beyond"))
        new = step.join(jump, "next").select("node", F.least("next", "beyond").alias("new"), "comp")
        new = materialize(new, "labels")
        changed = new.filter("new <> comp").limit(1).count()
        discard(written)
        written, labels = new, new.select("node", F.col("new").alias("comp"))
        if not changed:
            discard(both)
            return labels


def _confirmed(pairs: DataFrame, sets: DataFrame, cfg: NearDedup) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("of_b"))
    both = pairs.join(right, "b").join(left, "a").withColumn("common", F.size(F.array_intersect("of_a", "of_b")))
    return both.filter(100 * F.col("common") >= cfg.percent * (F.size("of_a") + F.size("of_b") - F.col("common"))).select("a", "b")


def near_duplicates(docs: DataFrame, cfg: NearDedup = NearDedup()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Only ``doc_id`` and ``text`` are read; other columns may be there.  A null
    or wordless text has an empty set and is linked with nothing.  Rows that
    repeat a doc_id each count as a document and share its id.  A row without
    doc_id takes part, and is kept only if nothing in its component has an id.
    An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    sketch = materialize(docs.mapInArrow(_sketch(cfg), _SKETCH), "sketch")
    key = ["fp1", "fp2", "n_shingles"]
    classes = sketch.filter("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_hash")).alias("shown"), F.first("bands").alias("bands"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    slots = classes.select("node", F.explode("bands").alias("slot"))
    shared = slots.groupBy("slot").agg(F.min("node").alias("rep"), F.count("*").alias("members")).filter("members > 1").select("slot", "rep")
    shared = materialize(shared, "shared")  # written, so that Spark can split a frequent slot in the join
    slots = materialize(slots.join(shared, "slot"), "slots")

    # The sets of all nodes that share a bucket, from the text of a document of the class.
    needed = slots.select("node").distinct().join(classes.select("node", F.col("shown.doc_id").alias("of_id"), F.col("shown.text_hash").alias("of_text"), "fp1", "n_shingles"), "node")
    # By id and text: an id that many rows share, or the lack of one, brings no other class's texts along.
    sets = docs.join(needed, docs.doc_id.eqNullSafe(needed.of_id) & (docs.text_hash == needed.of_text)).select("node", "fp1", "n_shingles", "text")
    sets = materialize(sets.mapInArrow(_full_sets(cfg), _SETS).dropDuplicates(["node"]), "sets")

    nodes = sets.select("node", F.size("elements").alias("n"), "bits", F.col("node").alias("comp"))

    def labelled(links: DataFrame) -> DataFrame:
        """The nodes that share a bucket, their components merged by new links: only components that links join are relabelled."""
        a, b = (nodes.select(F.col("node").alias(c), F.col("comp").alias(f"comp_{c}")) for c in "ab")
        between = links.join(a, "a").join(b, "b").filter("comp_a <> comp_b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).distinct()
        merged = components(between).select(F.col("node").alias("comp"), F.col("comp").alias("into"))
        return materialize(nodes.join(merged, "comp", "left").withColumn("comp", F.coalesce("into", "comp")).drop("into"), "nodes")

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(c).alias(name if c == "node" else c if c in ("slot", "part") else f"{name}_{c}") for c in df.columns])

    def alike() -> Column:
        def lacking(a: str, b: str) -> Column:
            """Elements of ``a`` that ``b`` lacks, at least."""
            return F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda s, n: s + n)

        x, y = F.col("x_n"), F.col("y_n")
        most = F.least(x - lacking("x_bits", "y_bits"), y - lacking("y_bits", "x_bits"))
        return (F.col("x_comp") != F.col("y_comp")) & (100 * F.least(x, y) >= cfg.percent * F.greatest(x, y)) & (100 * most >= cfg.percent * (x + y - most))

    def pairs_of(found: DataFrame) -> DataFrame:
        return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    def checked(found: DataFrame) -> DataFrame:
        return pairs_of(found.join(side(nodes, "x"), "x").join(side(nodes, "y"), "y").filter(alike()))

    # First every node against the least representative that it meets.
    first = slots.filter("rep <> node").groupBy(F.col("node").alias("x")).agg(F.min("rep").alias("y"))
    tested = materialize(checked(first), "pairs")
    nodes = labelled(materialize(_confirmed(tested, sets, cfg), "links"))

    # Then, where components differ: against the representatives of all its buckets.
    star = slots.filter("rep <> node").select(F.col("rep").alias("x"), F.col("node").alias("y")).distinct()
    more = materialize(checked(star).join(tested, ["a", "b"], "left_anti"), "pairs")
    nodes, tested = labelled(materialize(_confirmed(more, sets, cfg), "links")), tested.union(more)

    # Last, across the components of a bucket: all pairs but those within the most frequent component.
    member = slots.select("slot", "node").join(nodes, "node")
    sizes = member.groupBy("slot", "comp").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("slot").agg(F.count("*").alias("comps"), F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("members")).filter("comps > 1")
    # Those outside the most frequent component are dealt to parts, each of which meets the whole bucket.
    parts = F.ceil((F.col("members") - F.col("top.n")) / F.lit(cfg.part)).cast("int")
    mixed = materialize(mixed.select("slot", F.col("top.comp").alias("largest"), parts.alias("parts")), "mixed")
    member = member.join(mixed, "slot").select("slot", "node", (F.col("comp") == F.col("largest")).alias("major"), "parts")
    member = materialize(member, "members")
    # A pair that shares several of these buckets comes out of the least of them alone.
    own = member.groupBy("node").agg(F.collect_list("slot").alias("slots"))
    member = materialize(member.join(own, "node").join(nodes, "node"), "members")
    once = F.array_min(F.array_intersect("x_slots", "y_slots")) == F.col("slot")
    dealt = member.filter("not major").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    every = member.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cross = side(every, "y").join(side(dealt, "x"), ["slot", "part"]).filter((F.col("y_major") | (F.col("x") < F.col("y"))) & alike() & once)
    last = materialize(pairs_of(cross).join(tested, ["a", "b"], "left_anti"), "pairs")
    nodes = labelled(materialize(_confirmed(last, sets, cfg), "links"))

    of_class = classes.select(*key, "node", "first_id").join(nodes.select("node", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = materialize(of_class.groupBy("comp").agg(F.min("first_id").alias("component_id")), "least")
    of_class = of_class.join(least, "comp").select(*key, "component_id")
    alone = sketch.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    found = sketch.join(of_class, key).select("doc_id", "n_shingles", "component_id").unionByName(alone)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, cfg: NearDedup = NearDedup()) -> DataFrame:
    """``docs`` with one document of each component: the one whose id is the component's.

    Rows that repeat a kept doc_id stay; columns and their order are those of ``docs``.
    """
    gone = near_duplicates(docs, cfg).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs.doc_id.cast("long") == gone.gone_id, "left_anti")
