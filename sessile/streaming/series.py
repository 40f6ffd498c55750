"""The time series of runs as their frames come in: everything after levelling, with one small state for each run.

Pixels are looked at once, without state: detection gives both left bounds that
the width guard may choose from, and the crop of each is measured.  The state of
a run then folds numbers alone: the guard, whether the drop has come in, the rows
that wait for a sign that it hasn't gone, and the last row, which waits for the
next one's centre.  Frames may come late by some numbers; what comes later than
that is dropped.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sessile.config import Settings
from sessile.functions import kernels
from sessile.operators import detect, fit, images
from sessile.operators.arrow import KEY, with_kernel
from sessile.operators.kinematics import to_cm

_SET = ("x1", *fit.OUTLINE)
#: Numbers of a frame that its run's state goes on from.
LOOKED = ("x1", "x2", "found", "near", "far", "end")
SERIES = ("time_s", "x_center", "adv", "rec", "contact_line_length", "y_center", "velocity")


def looked_at(frames: DataFrame, margin: int = 4, cfg: Settings = Settings(), fits: fit.TwoPass = fit.TwoPass()) -> DataFrame:
    """``run_id, frame_no``, the numbers ``LOOKED`` and the measures of the crops of both left bounds, from levelled frames."""
    mask, enlarge, measure = kernels.ellipse(13), images.enlarger(cfg.upscale), fit.outline_measures(cfg.mask_low, cfg.mask_high, margin, fits)

    def measured(a: np.ndarray, left: int | None, right: int | None) -> list[float | None]:
        cut = images.cut_out(a, left, right, cfg.crop_margin, cfg.bottom_rows)
        return [None] * len(_SET) if cut is None else [float(cut[1]), *(measure(enlarge(cut[0])) or [None] * len(fit.OUTLINE))]

    def kernel(a: np.ndarray) -> tuple:
        near, far, end = detect.steps_of(a, cfg.steep, cfg.steep_wide, cfg.detector_scale, 2, mask, False)
        left = far if None not in (near, end) and end - near > cfg.drop_width else near
        fine = detect.steps_of(a, cfg.steep, cfg.steep_wide, cfg.profile_scale, 2, mask, True)
        one = measured(a, fine[0], fine[2])
        return left, end, left is not None and end is not None and detect.is_clear(a), *fine, one, one if fine[1] == fine[0] else measured(a, fine[1], fine[2])

    return with_kernel(frames, kernel, "x1 int, x2 int, found boolean, near int, far int, end int, of_near array<double>, of_far array<double>", keep=KEY)


def _fresh(cfg: Settings) -> dict:
    return {"guard": cfg.drop_width, "entered": False, "waiting": [], "last": None, "n": 0, "held": [], "seen": None}


def _step(state: dict, row: list, cfg: Settings) -> Iterator[tuple]:
    """Takes the run's next frame (number, ``LOOKED``, both measures); gives finished rows: number, place, gap, next number
    and centre, measures."""
    no, x1, x2, found, near, far, end, of_near, of_far = row
    state["entered"] = state["entered"] or bool(found and x2 < cfg.trim_right)
    if not state["entered"]:
        return
    wide = None not in (near, end) and end - near > state["guard"]
    left = far if wide else near
    if None not in (left, end):
        state["guard"] = int(np.floor(cfg.width_growth * (end - left)))
    state["waiting"].append([no, of_far if wide else of_near])
    if not (found and x1 > cfg.trim_left):
        return
    for number, values in state["waiting"]:
        measures = dict(zip(_SET, values, strict=True))
        if any(measures[c] is None for c in ("h_center", "adv", "rec")):
            continue
        if state["last"] is not None:
            yield *state["last"], number, measures["h_center"] + cfg.upscale * measures["x1"]
        state["last"] = [number, state["n"], values]
        state["n"] += 1
    state["waiting"] = []


def _folded(cfg: Settings, late: int):
    def run(key: tuple, batches: Iterator[pd.DataFrame], stored: GroupState) -> Iterator[pd.DataFrame]:
        state = json.loads(stored.get[0]) if stored.exists else _fresh(cfg)
        new = []
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                plain = [None if v is None or v != v else v for v in (r.x1, r.x2, r.found, r.near, r.far, r.end)]
                sets = [[None if v is None or v != v else float(v) for v in values] for values in (r.of_near, r.of_far)]
                new.append([int(r.frame_no), *[v if v is None or isinstance(v, bool) else bool(v) if k == 2 else int(v) for k, v in enumerate(plain)], *sets])
        rows = sorted([*state["held"], *(x for x in new if state["seen"] is None or x[0] > state["seen"])], key=lambda x: x[0])
        limit = max((x[0] for x in rows), default=0) - late
        state["held"] = [x for x in rows if x[0] > limit]
        out = []
        for row in (x for x in rows if x[0] <= limit):
            if row[0] != state["seen"]:
                state["seen"] = row[0]
                out += _step(state, row, cfg)
        stored.update((json.dumps(state),))
        yield pd.DataFrame(
            [(key[0], no, n, follower - no > 1, x, *values) for no, n, values, follower, x in out],
            columns=["run_id", "frame_no", "n", "gap", "next_h", *_SET],
        )

    return run


def stream_series(frames: DataFrame, cfg: Settings = Settings(), margin: int = 4, fits: fit.TwoPass = fit.TwoPass(), late: int = 0) -> DataFrame:
    """``run_id, frame_no, gap`` and ``SERIES`` of levelled frames that stream in: ``analysis.analysed`` without chunk pruning.

    A row comes once its run's next measured frame is there, and a sign that
    the drop hasn't gone.  A frame waits until one ``late`` numbers higher has
    come, and is dropped if a later number has been folded already.
    """
    found = looked_at(frames, margin, cfg, fits)
    run_type = dict(frames.dtypes)["run_id"]
    shape = f"run_id {run_type}, frame_no long, n long, gap boolean, next_h double, {', '.join(f'{c} double' for c in _SET)}"
    rows = found.groupBy("run_id").applyInPandasWithState(_folded(cfg, late), shape, "state string", "append", GroupStateTimeout.NoTimeout)
    rows = to_cm(rows.withColumn("h_center", F.col("h_center") + cfg.upscale * F.col("x1")), cfg)
    ahead = (cfg.frame_width * cfg.upscale - F.col("next_h")) * (cfg.cm_on_pixel_ratio / cfg.upscale)
    rows = rows.withColumns({"time_s": F.col("n") / cfg.fps_experiment, "velocity": (ahead - F.col("x_center")) * cfg.fps_experiment})
    return rows.select(*KEY, "gap", *SERIES)
