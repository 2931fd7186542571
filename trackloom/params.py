"""Tracking and measuring parameters by cell type."""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession

#: The three link modes, and the channels in the order in which summaries list them.
MODES = ("vanilla", "adaptive", "predictive")
CHANNELS = ("GFP", "Texas Red", "Cy5")


@dataclass(frozen=True)
class CellParams:
    """HeLa's, unless a cell type says otherwise. Areas in pixels, distances in pixels, times in minutes unless a name says frames."""

    cell_type: str = "hela"
    min_cell_size: int = 250
    max_cell_size: int = 4000
    max_pixel_movement: int = 20
    memory: int = 1
    min_track_length: int = 10
    track_mode: str = "vanilla"
    adaptive_step: float = 0.9
    adaptive_stop: float = 10.0
    predict_span: int = 3
    median_frames: int = 3
    closing_frames: int = 3
    erosion_radius: int = 3
    min_mitotic_duration: int = 30
    frame_interval: int = 10
    gaussian_sigma: float = 45.0

    @property
    def min_mitotic_frames(self) -> int:
        return self.min_mitotic_duration // self.frame_interval


#: What differs from HeLa, by cell type.
_OVERRIDES: dict[str, dict] = {
    "hela": {},
    "ht1080": {"max_cell_size": 9000, "max_pixel_movement": 30, "track_mode": "predictive"},
    "u2os": {"max_cell_size": 9500, "max_pixel_movement": 30, "track_mode": "predictive"},
    "rpe1": {"max_cell_size": 9500, "max_pixel_movement": 30, "track_mode": "predictive"},
}

CELL_TYPES = tuple(_OVERRIDES)


def for_cell_type(cell_type: str = "hela") -> CellParams:
    """Parameters of a known cell type; anything else is an error, never HeLa's values in silence."""
    if not isinstance(cell_type, str) or cell_type.lower() not in _OVERRIDES:
        raise ValueError(f"unknown cell type {cell_type!r}; known: {', '.join(_OVERRIDES)}")
    return replace(CellParams(cell_type=cell_type.lower()), **_OVERRIDES[cell_type.lower()])


def as_table(spark: SparkSession) -> DataFrame:
    """A row per cell type."""
    rows = [for_cell_type(c) for c in _OVERRIDES]
    return spark.createDataFrame(
        [(p.cell_type, p.min_cell_size, p.max_cell_size, p.max_pixel_movement, p.memory, p.min_track_length, p.track_mode) for p in rows],
        "cell_type string, min_size int, max_size int, radius int, memory int, min_length int, mode string",
    )


def key_values(spark: SparkSession, p: CellParams) -> DataFrame:
    """Parameters as (name, value) rows, as the workbooks' parameter sheets hold them."""
    return spark.createDataFrame([(k, str(v)) for k, v in asdict(p).items()], "name string, value string")


def mode_or_default(mode: str | None, p: CellParams) -> str:
    mode = p.track_mode if mode is None else mode
    if mode not in MODES:
        raise ValueError(f"unknown link mode {mode!r}; known: {', '.join(MODES)}")
    return mode
