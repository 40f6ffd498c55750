"""Packing token sequences by bounded-space online best-fit.

Documents become tokens and are cut into pieces that fit a sequence.  A task
packs the pieces that reach it in batches, each from its longest piece to its
shortest: a piece goes to the open bin that it leaves the least space in, found
in a bitset keyed by free space.  The number of open bins is fixed; to open
another one, the fullest closes.  Bins stay open from batch to batch.  A batch
is small enough that its long pieces find open bins, so that none closes before
the short ones come; pieces are dealt to batches by hash, so that each has its
share of short ones.  Pieces are dealt out evenly, whatever they hold, and without their
tokens are a few dozen bytes, so a task packs very many of them and the few
bins that it ends with hardly count.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sessile.llm.storage import materialize
from sessile.llm.words import chunks


@dataclass(frozen=True)
class Packing:
    """Vocabulary: the JSON of ``tokenizers`` and the same one as ranks, with its pattern; end id, sequence
    length, open bins of a task, most pieces of a batch, and most of them over half a sequence, for each open bin,
    pieces of a task, blanks or letters in a row from which the ranks form isn't used."""

    json_path: str
    ranks_path: str
    pattern: str
    end_id: int = 2
    length: int = 1024
    open_bins: int = 1024
    batch_bins: float = 2.5
    batch_long: float = 0.9
    task_pieces: int = 400_000
    long_run: int = 2_000


class Encoder:
    """Ids as ``tokenizers`` gives them.

    The same vocabulary read as ranks gives the same ids several times as
    fast.  Texts that hold a special token's string go to ``tokenizers``, and
    so do those with long runs of blanks or of other characters, which the
    pattern of the ranks form takes a stack frame a character for.
    """

    def __init__(self, cfg: Packing) -> None:
        with open(cfg.ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=cfg.pattern, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(cfg.json_path)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.long_run = cfg.long_run

    def _has_long_run(self, text: str) -> bool:
        if len(text) < self.long_run:
            return False
        sizes = [len(w) for w in text.split()]
        # Blanks beyond one between two words; a run of them is no longer than that.
        return max(sizes, default=0) >= self.long_run or len(text) - sum(sizes) - len(sizes) + 1 >= self.long_run

    def __call__(self, text: str) -> list[int]:
        if self._has_long_run(text) or any(s in text for s in self.special):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class BestFit:
    """Bins by free space; bit f of ``free`` says that some open bin has f left."""

    def __init__(self, length: int, open_bins: int, first_id: int) -> None:
        self.length, self.most, self.next_id = length, open_bins, first_id
        self.free, self.n_open = 0, 0
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def _take(self, space: int) -> int:
        ids = self.bins[space]
        found = ids.pop()
        if not ids:
            self.free &= ~(1 << space)
        self.n_open -= 1
        return found

    def place(self, size: int) -> tuple[int, int]:
        """Sequence and offset of a piece."""
        fits = self.free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            found = self._take(space)
        else:
            space, found = self.length, self.next_id
            self.next_id += 1
        if rest := space - size:
            if self.n_open == self.most:
                self._take((self.free & -self.free).bit_length() - 1)
            self.bins[rest].append(found)
            self.free |= 1 << rest
            self.n_open += 1
        return found, self.length - space


def _pieces(cfg: Packing, with_ids: bool):
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(cfg)
        for batch in batches:
            for part in chunks(batch, "text"):
                out: list[list] = [[] for _ in names]
                for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    ids = np.array([*encode(text or ""), cfg.end_id], dtype="<u4")
                    head = (len(ids) - 1) % cfg.length + 1
                    for piece, (a, b) in enumerate(zip([0, *range(head, len(ids), cfg.length)], range(head, len(ids) + 1, cfg.length), strict=True)):
                        row = [doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()), *([ids[a:b].astype(np.int32)] if with_ids else [])]
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, types, strict=False)], names=names)

    return run


def tokenized_pieces(docs: DataFrame, cfg: Packing, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every piece of every row.

    A null text is empty and gives one piece, the end id.  Only a document of
    more than ``length`` tokens is cut; all its pieces but the first are full.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_pieces(cfg, with_ids), schema)


def _batches(lengths: np.ndarray, cfg: Packing) -> Iterator[tuple[int, int]]:
    """Stretches of pieces that aren't too many, nor too many of them long, for the open bins."""
    most, longs = (max(1, int(cfg.open_bins * x)) for x in (cfg.batch_bins, cfg.batch_long))
    ahead, a = np.cumsum(2 * lengths > cfg.length), 0
    while a < len(lengths):
        before = ahead[a - 1] if a else 0
        b = min(a + most, max(a + 1, int(np.searchsorted(ahead, before + longs, side="right"))))
        yield a, min(b, len(lengths))
        a = b


def _packed(cfg: Packing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BestFit(cfg.length, cfg.open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            lengths = batch["length"].to_numpy()
            found = np.empty((len(lengths), 2), dtype=np.int64)
            for a, b in _batches(lengths, cfg):
                # Equal lengths in the order they come in.
                order = a + np.argsort(-lengths[a:b], kind="stable")
                found[order] = [bins.place(n) for n in lengths[order].tolist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found[:, 0]), pa.array(found[:, 1])], names=[*batch.schema.names, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, cfg: Packing) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; no sequence is longer than ``length``.

    ``pieces`` is a written table, which is dealt out row by row, so that equal
    rows don't meet in one task and a task that runs again gives the same bins.
    """
    key = ["doc_id", "piece", "ids_crc32"]
    tasks = max(1, -(-pieces.count() // cfg.task_pieces))
    dealt = pieces.repartition(tasks).sortWithinPartitions(F.xxhash64(*key), *key)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return dealt.mapInArrow(_packed(cfg), schema)


def pack_documents(docs: DataFrame, cfg: Packing, with_ids: bool = False) -> DataFrame:
    """Every piece of every row of ``docs`` with its place.

    Reads doc_id and text alone.  A null or empty text is the end id alone; a
    null id stays null; rows that repeat an id or a text are packed each for
    itself; an empty table gives no rows.
    """
    return pack(materialize(tokenized_pieces(docs, cfg, with_ids), "pieces"), cfg)
