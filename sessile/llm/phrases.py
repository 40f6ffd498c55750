"""Collocations: frequent phrases, counted by dynamic itemset counting, scored by their weakest cut.

Texts become chunks of word numbers once, dealt to shards.  Shards are scanned
in a cycle, one job each.  Words are counted from the first shard on.  A longer
phrase becomes active at the next shard once both its subphrases, without its
last and without its first word, have reached the threshold, and is counted
until it has seen every shard once.  So phrases of all lengths are counted side
by side, and each has its exact number of occurrences after one full cycle of
its own.

What has been reached at a boundary between two shards goes to the scans as a
bit map of bounded size.  A phrase that it takes in wrongly becomes active
earlier than it need, at the same boundary for every task and every later scan,
and its count is as exact as any other.  Counts stay in Spark.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessile.llm.storage import discard, materialize
from sessile.llm.words import WordHashes, chunks, mix

#: Ends of pieces become a byte that no text holds, a tab a blank.
_BREAK = b"\xff"
_PLAIN = bytes.maketrans(b"\t.,;:!?\n\x0b\x0c\r", b" " + _BREAK * 10)
_NEVER = np.int32(2**31 - 1)
_NEXT = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Phrases:
    """Occurrences of a phrase at least, its words at most, phrases given of each language, shards of a cycle, words
    of a chunk, words counted at a time, bytes of a text handled at a time, most bits (as a power of 2) of a map."""

    least: int = 100
    longest: int = 5
    most: int = 2000
    shards: int = 4
    chunk_words: int = 1 << 18
    scan_words: int = 1 << 22
    slice_bytes: int = 1 << 22
    map_bits: int = 26


def _slices(text: str, limit: int) -> Iterator[bytes]:
    """The lower-cased bytes of a text with breaks in place, in parts that end at a break."""
    raw = text.encode().lower().translate(_PLAIN)
    at = 0
    while at < len(raw):
        end = raw.find(_BREAK, at + limit)
        end = len(raw) if end < 0 else end
        yield raw[at:end]
        at = end


def _together(parts: list[bytes], limit: int) -> Iterator[list[bytes]]:
    """The parts in order, some ``limit`` bytes at a time."""
    group, size = [], 0
    for part in parts:
        group.append(part)
        size += len(part)
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def _tokens(parts: list[bytes]) -> pa.Array:
    """Words and breaks of texts, with a break after each text."""
    data = b"".join(p + _BREAK for p in parts).replace(_BREAK, b" " + _BREAK + b" ")
    # The break is no UTF-8; splitting at blanks doesn't mind.
    text = pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(np.array([0, len(data)], np.int64)), pa.py_buffer(data)])
    words = pc.list_flatten(pc.ascii_split_whitespace(text)).view(pa.large_binary())
    return words.filter(pc.greater(pc.binary_length(words), 0))


def _chunk(lang: str, tokens: list[pa.Array], cfg: Phrases) -> pa.RecordBatch:
    coded = pa.concat_arrays(tokens).dictionary_encode()
    words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int32)
    if _BREAK in words:
        # Numbers stay as they are, but the break has none.
        at = words.index(_BREAK)
        codes = np.where(codes == at, -1, codes - (codes > at)).astype(np.int32)
        del words[at]
    shard = xxhash.xxh64_intdigest(codes.tobytes()) % cfg.shards
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int32()), pa.array([lang]), pa.array([int((codes >= 0).sum())], pa.int64()), pa.array([words], pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array([codes], pa.list_(pa.int32()))],
        names=["shard", "lang", "n_words", "words", "codes"],
    )


def _coded(cfg: Phrases):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[pa.Array]] = {}
        sizes: Counter[str] = Counter()
        for batch in batches:
            for part in chunks(batch, "text"):
                texts: dict[str, list[bytes]] = {}
                for lang, text in zip(part["lang"].to_pylist(), part["text"].to_pylist(), strict=True):
                    texts.setdefault(lang, []).extend(_slices(text, cfg.slice_bytes))
                for lang, parts in texts.items():
                    for group in _together(parts, cfg.slice_bytes):
                        waiting.setdefault(lang, []).append(_tokens(group))
                        sizes[lang] += len(waiting[lang][-1])
                        if sizes[lang] >= cfg.chunk_words:
                            yield _chunk(lang, waiting.pop(lang), cfg)
                            del sizes[lang]
                if sizes.total() >= 8 * cfg.chunk_words:
                    yield from (_chunk(k, v, cfg) for k, v in waiting.items())
                    waiting, sizes = {}, Counter()
        yield from (_chunk(k, v, cfg) for k, v in waiting.items())

    return run


def coded(docs: DataFrame, cfg: Phrases) -> DataFrame:
    """Chunks of the texts of one language: shard, lang, number of words, the distinct words, and the number of each
    word in turn, -1 between pieces and texts."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(_coded(cfg), "shard int, lang string, n_words long, words array<string>, codes array<int>")


@dataclass
class Reached:
    """Which phrases have reached the threshold at which boundary, as a bit map for each boundary."""

    maps: list[tuple[int, np.ndarray]] = field(default_factory=list)

    def since(self, hashes: np.ndarray) -> np.ndarray:
        """The first boundary whose map holds each hash; ``_NEVER`` if none does."""
        found = np.full(len(hashes), _NEVER, np.int32)
        for boundary, bits in reversed(self.maps):
            found[_held(bits, hashes)] = boundary
        return found

    def ever(self, hashes: np.ndarray) -> np.ndarray:
        """Whether any map may hold each hash: all maps, folded to the size of the smallest, in one."""
        if not self.maps:
            return np.zeros(len(hashes), bool)
        size = min(len(bits) for _, bits in self.maps)
        return _held(np.bitwise_or.reduce(np.vstack([bits.reshape(-1, size) for _, bits in self.maps])), hashes)


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    there = np.ones(len(hashes), bool)
    for at in places(hashes, len(bits) * 64):
        there &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return there


def places(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash in a map of ``size`` bits, a power of 2."""
    return hashes & np.uint64(size - 1), (hashes >> np.uint64(32)) & np.uint64(size - 1)


def word_hashes(lang: str, words: list[bytes], known: WordHashes) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)) + np.uint64(known[lang.encode()]))


def longer_hashes(phrases: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases with a word more."""
    with np.errstate(over="ignore"):
        return mix(phrases * _NEXT + words)


def count_phrases(lang: str, words: pa.Array, codes: np.ndarray, reached: Reached, step: int, cfg: Phrases, known: WordHashes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Length, a place, number of occurrences and first step of each phrase that is active in ``step``."""
    of_word = word_hashes(lang, [w.as_buffer().to_pybytes() for w in words], known)
    hashes, since, rank = of_word, reached.since(of_word), codes.astype(np.int64)
    if step < cfg.shards:
        found, at, n = np.unique(codes, return_index=True, return_counts=True)
        at, n = at[found >= 0], n[found >= 0]
        yield 1, at, n, np.zeros(len(at), np.int32)
    for length in range(2, cfg.longest + 1):
        a, b = rank[:-1], rank[1:]
        place = np.flatnonzero((a >= 0) & (b >= 0))
        start = np.maximum(since[a[place]], since[b[place]])
        place, start = place[start <= step], start[start <= step]
        # What has seen its full cycle matters only where longer phrases may grow from it.
        seen = np.flatnonzero(start <= step - cfg.shards)
        if len(seen):
            stay = np.ones(len(place), bool)
            stay[seen] = reached.ever(longer_hashes(hashes[rank[place[seen]]], of_word[codes[place[seen] + length - 1]]))
            place, start = place[stay], start[stay]
        if not len(place):
            return
        key = a[place] * len(words) + codes[place + length - 1]
        _, first, number, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        at, begun = place[first], start[first]
        counted = begun > step - cfg.shards
        yield length, at[counted], n[counted], begun[counted]
        hashes = longer_hashes(hashes[a[at]], of_word[codes[at + length - 1]])
        # A map may hold a phrase by chance before the phrase is looked at.
        since = np.maximum(reached.since(hashes), begun)
        rank = np.full(len(a), -1, np.int64)
        rank[place] = number


def _groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """Language, distinct words and numbers of the chunks of one language, some ``most`` words at a time."""

    def joined(rows: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
        merged = pa.concat_arrays([w for w, _ in rows]).dictionary_encode()
        number, ahead, parts = merged.indices.to_numpy().astype(np.int64), 0, []
        for w, codes in rows:
            parts += [np.where(codes < 0, -1, number[ahead + np.maximum(codes, 0)] if len(w) else -1), [-1]]
            ahead += len(w)
        return merged.dictionary, np.concatenate(parts).astype(np.int64)

    waiting: dict[str, list] = {}
    for batch in batches:
        for i, lang in enumerate(batch["lang"].to_pylist()):
            rows = waiting.setdefault(lang, [])
            rows.append((batch["words"][i].values, batch["codes"][i].values.to_numpy()))
            if sum(len(c) for _, c in rows) >= most:
                yield lang, *joined(waiting.pop(lang))
    for lang, rows in waiting.items():
        yield lang, *joined(rows)


_COUNTS = "lang string, phrase string, started int, n long"


def _scan(reached: Reached, step: int, cfg: Phrases):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for lang, words, codes in _groups(batches, cfg.scan_words):
            for length, at, n, begun in count_phrases(lang, words, codes, reached, step, cfg, known):
                for k in range(0, len(at), 1 << 18):
                    part = slice(k, k + (1 << 18))
                    phrase = pc.binary_join_element_wise(*[words.take(pa.array(codes[at[part] + j])) for j in range(length)], " ")
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(phrase), pa.string()), phrase, pa.array(begun[part], pa.int32()), pa.array(n[part], pa.int64())], names=["lang", "phrase", "started", "n"])

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        out = np.empty(batch.num_rows, np.uint64)
        for i, (lang, phrase) in enumerate(zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist(), strict=True)):
            words = word_hashes(lang, phrase.encode().split(b" "), known)
            total = words[:1]
            for k in range(1, len(words)):
                total = longer_hashes(total, words[k : k + 1])
            out[i] = total[0]
        yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], names=["h"])


def bit_map(phrases: DataFrame, n: int, cfg: Phrases) -> np.ndarray:
    """The bit map of ``phrases (lang, phrase)``: 2^20 bits, 16 for each of ``n`` if they are many, never more than ``cfg`` allows."""
    size = 1 << min(cfg.map_bits, max(20, (16 * n).bit_length()))
    h = F.col("h")
    both = F.array(*[x.bitwiseAND(F.lit(size - 1).cast("long")) for x in (h, F.shiftrightunsigned(h, 32))])
    bits = phrases.select("lang", "phrase").mapInArrow(_hashed, "h long").select(F.explode(both).alias("at"))
    bits = bits.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
    found = bits.groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64)


def _n_words(phrase: Column) -> Column:
    return F.length(phrase) - F.length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1


def frequent_phrases(chunks: DataFrame, cfg: Phrases) -> tuple[DataFrame, list[DataFrame]]:
    """``lang, phrase, n`` of every phrase, words included, that occurs ``least`` times; and the tables behind it."""
    reached, step, end = Reached(), 0, cfg.shards
    live: DataFrame | None = None
    finished, kept = None, []
    while step < end:
        counted = chunks.filter(F.col("shard") == step % cfg.shards).select("lang", "words", "codes").mapInArrow(_scan(reached, step, cfg), _COUNTS)
        rows = counted.withColumn("reached", F.lit(None).cast("int"))
        rows = rows if live is None else rows.unionByName(live)
        rows = rows.groupBy("lang", "phrase").agg(F.min("started").alias("started"), F.sum("n").alias("n"), F.min("reached").alias("reached"))
        boundary = step + 1
        done = F.col("started") + cfg.shards <= boundary
        enough = F.col("n") >= cfg.least
        first = F.col("reached").isNull() & enough
        rows = rows.withColumns({"reached": F.when(first, F.lit(boundary)).otherwise(F.col("reached")), "grows": first & (_n_words(F.col("phrase")) < cfg.longest)})
        table = materialize(rows.filter(enough | ~done), f"step-{step}")
        kept.append(table)
        new = table.filter("grows")
        if n := new.count():
            reached.maps.append((boundary, bit_map(new, n, cfg)))
            end = max(end, boundary + cfg.shards)
        if live is not None and step < cfg.shards:
            # Nothing in it has seen a full cycle.
            discard(kept.pop(-2))
        part = table.filter(done).select("lang", "phrase", "n")
        finished = part if step == cfg.shards - 1 else finished.unionByName(part) if step >= cfg.shards else None
        live, step = table.filter(~done).drop("grows"), boundary
    return finished, kept


def collocations(docs: DataFrame, cfg: Phrases = Phrases()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases of 2 to ``longest`` words.

    Reads lang (null: ``und``) and text (null: empty) alone.  A phrase lies
    within a piece of a text between marks or line ends, in the case of A to Z
    ignored; ``a`` is its number of occurrences, ``n`` that of all words, and
    ``l`` and ``r`` are those of the two parts of the cut with the lowest
    floor(1000 a n / (l r)), its score.  Phrases within a longer one that is as
    frequent are left out.  Order is by score, ``a``, then phrase.  Repeated
    rows count as often as they occur; an empty table gives no rows.
    """
    table = materialize(coded(docs, cfg), "chunks", by="shard")
    words = materialize(table.groupBy("lang").agg(F.sum("n_words").alias("n")), "totals")
    found, steps = frequent_phrases(table, cfg)
    every = materialize(found, "frequent")
    discard(table, *steps)
    phrases = every.filter(F.instr("phrase", " ") > 0).withColumn("words", F.split("phrase", " ", -1))

    # A longer phrase with as many occurrences has all between the two, so that one word more tells.
    def part(a: Column, n: Column) -> Column:
        return F.array_join(F.slice("words", a, n), " ")

    one, size = F.lit(1), F.size("words")
    longer = phrases.filter(size > 2).select("lang", F.col("n").alias("n"), F.explode(F.array(part(one, size - 1), part(F.lit(2), size - 1))).alias("phrase"))
    rest = phrases.join(longer.dropDuplicates(["lang", "phrase", "n"]), ["lang", "phrase", "n"], "left_anti")

    cuts = rest.select("lang", "phrase", F.col("n").alias("a"), "words", F.explode(F.sequence(one, size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(one, F.col("k")).alias("left"), part(F.col("k") + 1, size - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(every.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    cuts = cuts.join(words, "lang")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    cuts = cuts.withColumns({"top": F.lit(1000).cast("decimal(38,0)") * wide("a") * wide("n"), "bottom": wide("l") * wide("r")}).withColumn("score", F.expr("top div bottom"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("cut")).select("lang", "phrase", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= cfg.most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
