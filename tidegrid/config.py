"""Parameters of the engine, in one place.

Every choice that changes a result (fill mode, clip bounds, unit divisor, gap length ...) is a field here with a
documented default, so an operator never hides a constant.
"""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the data model.
DEVICE_EPOCH_SECONDS = 1199145600  # 2008-01-01 00:00:00 UTC
MIN_VALID_YEAR = 2008
MAX_VALID_YEAR = 2030
EARLIEST_EVENT = "2020-01-01 00:00:00"
PLACEHOLDER_BG = 100.0
STREAMS = ("cgm", "basal", "bolus")


@dataclass(frozen=True)
class GridSpec:
    """A regular time grid per device.

    ``tile_bins`` is the number of grid bins that form one tile, the unit of parallel work (see ``tiles``).  With the
    5-minute default a tile is one week, so one device never means one task.
    """

    freq_seconds: int = 300
    pad_seconds: int = 900
    tile_bins: int = 2016

    @property
    def tile_seconds(self) -> int:
        return self.freq_seconds * self.tile_bins


@dataclass(frozen=True)
class Ranges:
    """Accepted value ranges; clipping and nulling use different bounds on purpose."""

    bg_clip: tuple[float, float] = (20.0, 600.0)
    bg_clip_monthly: tuple[float, float] = (39.0, 401.0)
    bg_valid: tuple[float, float] = (40.0, 600.0)
    basal_max: float = 8.0
    basal_max_organised: float = 10.0
    bolus_max: float = 30.0
    bolus_max_organised: float = 50.0


@dataclass(frozen=True)
class GapRules:
    max_gap_seconds: int = 15 * 3600
    min_segment_bins: int = 12
    max_impute_bins: int = 12
    max_edge_bins: int = 3


@dataclass(frozen=True)
class SplitRules:
    """Chronological split borders as whole percentages, compared with integers.

    ``truncate_double=True`` reproduces ``int(n * 0.70)`` on a double, which gives 62 (not 63) for 90 rows.
    """

    train_pct: int = 70
    validate_pct: int = 15
    truncate_double: bool = False


@dataclass(frozen=True)
class WindowSpecParams:
    lookback: int = 288
    horizon: int = 12
    stride: int = 1
    max_null_share: float = 0.10


RAW_TILE_SECONDS = 86400  # tile width for raw (not yet binned) events
