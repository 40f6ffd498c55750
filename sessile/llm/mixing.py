"""Mixing sources to target weights along a time-varying curriculum.

Every source gets a number of words (its target) and a weight over training
time t in [0, 1], linear in t.  The integral of the weight is the source's
cumulative demand; inverting it turns the place of a word in the source's own
order into a training position, which is that time t, not the share of all words
read so far: sources fade in and out at their own rates.  Positions of all sources range-sort into one
sequence.  A source's order is by hash of the id; places in it are prefix sums
over (source, bucket) totals and then within buckets, so that no source is
handled by a single task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessile.llm.storage import materialize

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Weights dealt over the sources in order, most repeats, slopes of the weights over time, documents of a bucket.

    Source number k has weight ``weights[k % len(weights)]`` and at time t the
    share ``1 + slopes[k % len(slopes)] * (2 t - 1)`` of its mean weight.
    With ``whole``, the document in which a target ends is read to its end or
    not at all, whichever is nearer to the target.
    """

    weights: tuple[float, ...] = (1.0, 2.0, 3.0)
    most: float = 3.0
    slopes: tuple[float, ...] = field(default=(-0.5, 0.0, 0.5))
    bucket_docs: int = 4096
    whole: bool = False


def _cycled(values: tuple[float, ...], k: Column) -> Column:
    return F.get(F.array(*[F.lit(float(v)) for v in values]), (k % len(values)).cast("int"))


def targets(sources: DataFrame, cfg: Mix) -> DataFrame:
    """``(source, source_size, ...)`` with target and slope.

    Sources whose cap ``most * source_size`` is least for their weight reach
    it first.  With sources in the order of cap / weight, one of them is capped
    if its cap is below its share of what the sources before it, all capped,
    leave.  One row per source is all that these windows see.
    """
    sources = sources.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    sources = sources.withColumn("weight", _cycled(cfg.weights, F.col("k"))).withColumn("cap", cfg.most * F.col("source_size"))
    everything = Window.partitionBy()
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "k")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    sources = sources.withColumn("level", F.when(weight_left > 0, left / weight_left)).withColumn("full", F.col("cap") < F.col("level") * F.col("weight"))
    # The level at the first source that isn't full holds for all that follow.
    level = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "k", "level"))).over(everything)["level"]
    return sources.withColumn("target", F.least(F.col("cap"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))).withColumn("slope", _cycled(cfg.slopes, F.col("k"))).drop("level", "full", "cap", "weight", "k")


def position(share: Column, slope: Column) -> Column:
    """The time at which a cumulative demand of ``share`` (0 to 1) is reached.

    Demand at t is the integral of 1 + slope (2 s - 1), that is (1 - slope) t + slope t^2.
    """
    a = 1 - slope
    root = (-a + F.sqrt(F.greatest(a * a + 4 * slope * share, F.lit(0.0)))) / (2 * slope)
    return F.when(F.abs(slope) < 1e-9, share).otherwise(root)


def plan_mix(docs: DataFrame, cfg: Mix = Mix(), keys: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source, source_size, target, taken, place, slope.

    ``place`` is the number of words before the document in its source's
    order.  The mix reads that order round and round and stops at the rounded
    target, so ``taken`` sums up to it (with ``cfg.whole``, to within half of
    the last document) and is at most ``most`` (rounded up) times the size.  Null texts have no words and are never taken; a null
    source is a source; rows with the same id, source and size are
    interchangeable and lie together in their source's order.  An empty table, or one without words, takes nothing.
    """
    keys = keys or []
    sized = docs.select(F.col("doc_id"), *keys, F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    # A null source is a key of its own.
    sized = sized.withColumns({"h": F.xxhash64(F.col("doc_id").cast("string"), "size"), "key": F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))})
    # Rows that are alike become one with their number, however many they are.
    alike = materialize(sized.groupBy("doc_id", *keys, "source", "key", "size", "h").agg(F.count("*").alias("copies")), "sizes")
    sources = alike.groupBy("source", "key").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.ceil(F.count("*") / cfg.bucket_docs).alias("buckets"))
    sources = materialize(targets(sources, cfg), "sources")
    rows = alike.join(sources.drop("source"), "key")
    # Buckets are ranges of the hash, so that their order is the order of the hash.
    unit = (F.col("h") / F.lit(2.0**64)) + 0.5
    rows = rows.withColumn("bucket", F.least(F.floor(unit * F.col("buckets")), F.col("buckets") - 1))
    group = ["key", "bucket"]
    sums = rows.groupBy(*group).agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    ahead = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy(*group).orderBy("h", "doc_id", "size", *keys).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(within), F.lit(0)))
    # The sums grow with the input: a merge join, on the keys that the window has dealt the rows by.
    rows = rows.join(sums.hint("merge"), group).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    rows = rows.withColumn("place", F.col("ahead") + F.col("inner") + F.col("copy") * F.col("size"))
    goal = F.round("target").cast("long")
    rounds = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0))
    rest = goal - rounds * F.col("source_size")
    due = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("place")))
    if cfg.whole:
        due = F.when(2 * due >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    taken = rounds * F.col("size") + due
    return rows.withColumn("taken", taken.cast("long")).select("doc_id", *keys, "size", "source", "source_size", "target", "taken", "place", "slope")


def passes(plan: DataFrame) -> DataFrame:
    """A row for each time a document is read: ``pass`` (from 0), ``words`` of it read, training ``position``."""
    full = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(F.lit(0))
    out = plan.filter("taken > 0").withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), full - 1)))
    words = F.least(F.col("size"), F.col("taken") - F.col("pass") * F.col("size"))
    share = (F.col("pass") * F.col("source_size") + F.col("place")) / F.col("target")
    return out.withColumn("words", words).withColumn("position", position(F.least(share, F.lit(1.0)), F.col("slope")))


def mixed_report(docs: DataFrame, cfg: Mix = Mix()) -> DataFrame:
    """``plan_mix`` with the position of each document's first reading, in training order (never read: last)."""
    plan = plan_mix(docs, cfg)
    share = F.when(F.col("target") > 0, F.least(F.col("place") / F.col("target"), F.lit(1.0))).otherwise(F.lit(0.0))
    first = F.when(F.col("taken") > 0, position(share, F.col("slope")))
    # The place orders, and deals out, those that are never read.
    out = plan.withColumn("first_position", first).orderBy(F.col("first_position").asc_nulls_last(), "place", "doc_id")
    return out.select("doc_id", "size", "source_size", "target", "taken", "first_position")


def mix_documents(docs: DataFrame, cfg: Mix = Mix()) -> DataFrame:
    """The mixed corpus: ``docs`` rows as often as they are read, range-sorted by training position.

    Columns are those of ``docs``.  Where a source's target ends within a
    document, that last reading is cut after the words still due (one document
    of each source at most), unless ``cfg.whole``, which cuts none.
    """
    columns = docs.columns
    # Rows are told apart by all of their columns; equal rows become one, which is read for all of them.
    key = ["__key", "__id"]
    hashed = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) if "map" in t else F.col(f"`{c}`") for c, t in docs.dtypes])
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), hashed.alias("__key"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"))
    named = packed.select(*key, F.col("doc").getField("doc_id").alias("doc_id"), F.col("doc").getField("source").alias("source"), F.col("doc").getField("text").alias("text"))
    reads = passes(plan_mix(named, cfg, key)).select(*key, F.col("pass").alias("__pass"), F.col("words").alias("__words"), F.col("size").alias("__size"), F.col("position").alias("__at"))
    out = packed.dropDuplicates(key).join(reads, key)
    text = F.col("doc").getField("text")
    cut = F.array_join(F.slice(F.filter(F.split(text, SPACE, -1), lambda w: w != ""), F.lit(1), F.col("__words").cast("int")), " ")
    text = F.when(F.col("__words") < F.col("__size"), cut).otherwise(text)
    out = out.orderBy("__at", "__key", "__pass")
    return out.select(*[(text if c == "text" else F.col("doc").getField(c)).alias(c) for c in columns])
