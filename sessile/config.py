"""Settings of a run of the analysis."""

from __future__ import annotations

from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """Flat settings; the first nine are the keys of the YAML file, the rest parameters of operators."""

    image_extension: str = "*.png"
    frame_rate: int = 25
    frame_folder: str = "frames"
    rotated_frames_folder: str = "frames_rotated"
    databases_folder: str = "databases"
    yolo_conf: float = 0.8
    yolo_name: str = "Gray-320-s"
    fps_experiment: float = 4000.0
    cm_on_pixel_ratio: float = 0.0039062
    steep: float = 0.0025
    steep_wide: float = 0.005
    drop_width: int = 300
    width_growth: float = 1.13
    crop_margin: int = 15
    #: Mean of the lowest row from which a run shows its surface there.
    surface_bright: float = 100.0
    #: Frame of a run whose surface gives the angle, share of rows it is looked for in, rows kept above the surface.
    angle_frame: int = 3
    surface_share: float = 0.3
    surface_margin: int = 10
    angle_trials: int = 5000
    height_trials: int = 1000
    #: Chunks of the two prunings, limits of the trimming.
    skips: tuple[int, ...] = (40, 5)
    trim_right: int = 1200
    trim_left: int = 40
    #: How far columns are shrunk for the detector and for the final bounds.
    detector_scale: int = 5
    profile_scale: int = 1
    #: Black rows below a levelled frame, which measurements leave out.
    bottom_rows: int = 5
    upscale: int = 3
    frame_width: int = 1248
    mask_low: int = 30
    #: 127 keeps what a cast to signed bytes leaves; 255 is the evident intent.
    mask_high: int = 127


def load_settings(path: str) -> Settings:
    """Settings from a YAML file on the driver; unknown keys are refused."""
    import yaml

    with open(path) as f:
        found = yaml.safe_load(f) or {}
    known = {f.name for f in fields(Settings)}
    if unknown := set(found) - known:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    return Settings(**found)
