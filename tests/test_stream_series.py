"""The streamed time series against the one of a batch."""

import numpy as np
import pytest

from sessile.config import Settings
from sessile.plans.analysis import analysed
from sessile.streaming.series import SERIES, stream_series
from test_frames import scene, table

CFG = Settings(fps_experiment=10.0, skips=(), trim_right=600, trim_left=100, mask_high=255, drop_width=150)


def standing(*more, **options):
    """A levelled frame: the drop on five black rows."""
    a = scene(*more, **options)[:105]
    return np.vstack([np.where(np.zeros((25, a.shape[1])) == 0, 250, 0).astype(np.uint8), a, np.zeros((5, a.shape[1]), np.uint8)])


@pytest.mark.parametrize("late", [0, 2])
def test_streamed_series_equals_the_batch(spark, tmp_path, late):
    shots = {("a", n): standing(100, 250 + 2 * n) for n in range(3, 14)} | {("a", n): standing(100, -500) for n in (0, 1, 2, 16, 17)}
    shots |= {("b", n): standing(80, 300 + 3 * n, radius=60 if n < 5 else 100) for n in range(10) if n != 6}
    shots[("b", 4)] = np.full_like(shots[("b", 3)], 20)
    expected, _ = analysed(table(spark, shots), CFG, level=False)
    columns = ["run_id", "frame_no", "gap", *SERIES]
    batch = {tuple(r)[:2]: tuple(r)[2:] for r in expected.select(columns).collect()}
    assert len(batch) > 12 and any(v[0] for v in batch.values())
    order = sorted(shots, key=lambda k: k[1])
    if late:
        # Neighbours change places across batches; the last ones push the others through.
        order[3], order[4], order[9], order[10] = order[4], order[3], order[10], order[9]
        for run in "ab":
            shots |= {(run, n): standing(100, -500) for n in (30, 31, 32, 33)}
        order += [(run, n) for n in (30, 31, 32, 33) for run in "ab"]
    for k in range(0, len(order), 7):
        table(spark, {key: shots[key] for key in order[k : k + 7]}).coalesce(1).write.parquet(str(tmp_path / "in" / f"part{k:03d}"))
    schema = table(spark, {("a", 0): shots["a", 3]}).schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    name = f"series{late}"
    query = stream_series(stream, CFG, late=late).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "state")).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    got = {tuple(r)[:2]: tuple(r)[2:] for r in spark.table(name).select(columns).collect()}
    assert set(got) == set(batch)
    for key, values in batch.items():
        assert got[key] == pytest.approx(values), key
