"""Running NumPy kernels over tables of frames: Arrow batches in, Arrow batches out, one frame at a time in memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType, _parse_datatype_string

from sessile.storage import materialize

KEY = ["run_id", "frame_no"]


def pixels(data: bytes | None, height: int | None, width: int | None) -> np.ndarray | None:
    """The frame of a row, without a copy; None where the pixels don't fill it."""
    if data is None or height is None or width is None or height != height or width != width:
        return None
    h, w = int(height), int(width)
    return np.frombuffer(data, dtype=np.uint8).reshape(h, w) if len(data) == h * w and len(data) else None


def with_kernel(frames: DataFrame, kernel: Callable, returns: str, *arguments: str | Column, keep: list[str] | None = None) -> DataFrame:
    """Adds (or replaces) the columns of the schema ``returns``: what ``kernel(frame, *arguments)`` gives as a tuple.

    They are null where there is no frame, or where the kernel gives None.  Of
    the other columns those of ``keep`` stay, by default all: name them where
    pixels needn't come back from Python.
    """
    schema: StructType = _parse_datatype_string(returns)
    names, kinds = schema.names, [to_arrow_type(f.dataType) for f in schema]
    stay = [c for c in frames.columns if c not in names] if keep is None else keep
    extra = [f"_given{k}" for k in range(len(arguments))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p, h, w, *more in zip(*(batch[c].to_pylist() for c in ("px", "height", "width", *extra)), strict=True):
                a = pixels(p, h, w)
                out = None if a is None else kernel(a, *more)
                rows.append([None] * len(names) if out is None else out)
            new = [pa.array([r[i] for r in rows], type=kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in stay), *new], names=[*stay, *names])

    needed = list(dict.fromkeys([*stay, "px", "height", "width"]))
    given = [(F.col(a) if isinstance(a, str) else a).alias(n) for a, n in zip(arguments, extra, strict=True)]
    shape = StructType([*(frames.schema[c] for c in stay), *schema])
    return frames.select(*[F.col(f"`{c}`") for c in needed], *given).mapInArrow(run, shape)


def rows_of(frames: DataFrame, kernel: Callable[..., tuple[np.ndarray, ...]], returns: str, *arguments: str) -> DataFrame:
    """``run_id, frame_no`` and the columns ``returns``: a row for each element of the arrays that ``kernel(frame, *arguments)`` gives."""
    schema = _parse_datatype_string(returns)
    types = {f.name: {"int": np.int32, "bigint": np.int64, "double": np.float64}[f.dataType.simpleString()] for f in schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("px", "height", "width", *arguments)]
            sizes, parts = [], []
            for p, h, w, *more in zip(*columns, strict=True):
                a = pixels(p, h, w)
                found = kernel(a, *more) if a is not None else tuple(np.empty(0, t) for t in types.values())
                sizes.append(len(found[0]))
                parts.append(found)
            at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            keys = [batch[c].take(at) for c in KEY]
            values = [pa.array(np.concatenate([p[i] for p in parts]).astype(t)) if parts else pa.array([], pa.from_numpy_dtype(t)) for i, t in enumerate(types.values())]
            yield pa.RecordBatch.from_arrays([*keys, *values], names=[*KEY, *types])

    key_types = dict(frames.dtypes)
    shape = ", ".join([*(f"{c} {key_types[c]}" for c in KEY), *(f"{f.name} {f.dataType.simpleString()}" for f in schema)])
    return frames.select(*KEY, "px", "height", "width", *arguments).mapInArrow(run, shape)


def with_neighbours(frames: DataFrame, kernel: Callable, returns: str, *arguments: str | Column, keep: list[str], ahead: bool = False, block: int = 64, most: int = 1_000_000) -> DataFrame:
    """The columns ``keep`` and those of ``returns``: what ``kernel(row, before, after, *arguments)`` gives as a tuple.

    Each is ``(px, height, width)``; ``before`` is the run's previous frame by
    number, ``after`` (only if ``ahead``) the next one, None at its ends.  A
    run's frames are dealt to blocks of ``block`` numbers once; a copy of a
    block's last frame goes to the run's next block, and of its first to the one
    before.  Within a block frames pass one after another.  Borders of blocks
    are a table of keys, which is broadcast up to ``most`` rows.  Rows for which
    the kernel gives None are left out.
    """
    schema: StructType = _parse_datatype_string(returns)
    names, kinds = schema.names, [to_arrow_type(f.dataType) for f in schema]
    stay = [c for c in keep if c not in names]
    extra = [f"_given{k}" for k in range(len(arguments))]

    number = F.floor(F.col("frame_no") / block)
    order = Window.partitionBy("run_id").orderBy("_block")
    ends = frames.select(*KEY, number.alias("_block")).groupBy("run_id", "_block").agg(F.min("frame_no").alias("first"), F.max("frame_no").alias("last"))
    ends = ends.withColumns({"later": F.lead("_block").over(order), "earlier": F.lag("_block").over(order)})
    borders = ends.select("run_id", F.col("last").alias("frame_no"), F.col("later").alias("to"))
    if ahead:
        borders = borders.unionByName(ends.select("run_id", F.col("first").alias("frame_no"), F.col("earlier").alias("to")))
    borders = materialize(borders.filter("to is not null").groupBy(*KEY).agg(F.collect_list("to").alias("_to")), "borders")
    borders = borders.select(F.col("run_id").alias("_run"), F.col("frame_no").alias("_no"), "_to")
    small = borders.count() <= most
    given = [(F.col(a) if isinstance(a, str) else a).alias(n) for a, n in zip(arguments, extra, strict=True)]
    needed = list(dict.fromkeys([*KEY, *stay, "px", "height", "width"]))
    rows = frames.select(*needed, *given).join(F.broadcast(borders) if small else borders.hint("merge"), (F.col("run_id") == F.col("_run")) & (F.col("frame_no") == F.col("_no")), "left")
    own = F.array(F.struct(number.alias("block"), F.lit(False).alias("copy")))
    copies = F.transform(F.coalesce("_to", F.array().cast("array<bigint>")), lambda b: F.struct(b.alias("block"), F.lit(True).alias("copy")))
    dealt = rows.withColumn("_at", F.explode(F.concat(own, copies))).select(*needed, *extra, F.col("_at.block").alias("_block"), F.col("_at.copy").alias("_copy"))
    dealt = dealt.repartition("run_id", "_block").sortWithinPartitions("run_id", "_block", "frame_no")

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Rows as (group, whether a copy, picture, arguments, columns that stay)."""
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("run_id", "_block", "_copy", "px", "height", "width", *extra))
            for k, (run, at, copy, p, h, w, *more) in enumerate(zip(*columns, strict=True)):
                yield (run, at), copy, (p, h, w), more, batch, k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        source: pa.RecordBatch | None = None

        def flushed() -> Iterator[pa.RecordBatch]:
            """The results so far of the rows of one batch."""
            if held:
                at = pa.array([k for k, _ in held])
                new = [pa.array([out[i] for _, out in held], type=kind) for i, kind in enumerate(kinds)]
                held.clear()
                yield pa.RecordBatch.from_arrays([*(source[c].take(at) for c in stay), *new], names=[*stay, *names])

        def look(row: tuple, before: tuple | None, after: tuple | None) -> None:
            group, copy, picture, more, _, k = row
            if not copy:
                out = kernel(picture, before[2] if before and before[0] == group else None, after[2] if after and after[0] == group else None, *more)
                if out is not None:
                    held.append((k, out))

        before = row = None
        for after in passing(batches):
            if row is not None:
                if row[4] is not source:
                    yield from flushed()
                    source = row[4]
                look(row, before, after)
            before, row = row, after
        if row is not None:
            if row[4] is not source:
                yield from flushed()
                source = row[4]
            look(row, before, None)
        yield from flushed()

    shape = StructType([*(frames.schema[c] for c in stay), *schema])
    return dealt.mapInArrow(run, shape)


def of_points(points: DataFrame, kernel: Callable[..., tuple | None], returns: str, x: str = "i", y: str = "j") -> DataFrame:
    """``run_id, frame_no`` and the columns ``returns``: what ``kernel(xs, ys)`` gives as a tuple for the points of each frame.

    A frame's points come in no order; they are gathered once, and many frames
    go to Python in a batch.  None gives nulls.
    """
    schema: StructType = _parse_datatype_string(returns)
    names, kinds = schema.names, [to_arrow_type(f.dataType) for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch["points"]).to_numpy())
            xs, ys = (v.to_numpy(zero_copy_only=False) for v in pc.list_flatten(batch["points"]).flatten())
            rows = [kernel(xs[a:b], ys[a:b]) or [None] * len(names) for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in KEY), *(pa.array([r[k] for r in rows], type=t) for k, t in enumerate(kinds))], names=[*KEY, *names])

    shape = StructType([*(points.schema[c] for c in KEY), *schema])
    packed = points.groupBy(*KEY).agg(F.collect_list(F.struct(F.col(x).alias("x"), F.col(y).alias("y"))).alias("points"))
    return packed.mapInArrow(run, shape)


def on_arrays(kernel: Callable[[np.ndarray], np.ndarray], profile: Column) -> Column:
    """An int of each array of numbers: ``kernel`` takes arrays of one length at a time, as rows, and gives -1 for null."""

    def run(values: pd.Series) -> pd.Series:
        out, sizes = np.full(len(values), -1, dtype=np.int64), values.map(lambda v: -1 if v is None else len(v)).to_numpy()
        for n in np.unique(sizes[sizes > 0]):
            at = np.flatnonzero(sizes == n)
            out[at] = kernel(np.stack(values.iloc[at].to_numpy()).astype(float))
        return pd.Series(out, dtype="Int32").mask(out < 0)

    return F.pandas_udf(run, "int")(profile)

