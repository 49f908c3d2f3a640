"""Validated dataset copies with their report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.config import GridSpec, Ranges
from tidegrid.operators.events import outlier_flags
from tidegrid.quality.checks import quality_report


def generated_dataset(grid: DataFrame, spec: GridSpec, ranges: Ranges = Ranges()) -> tuple[DataFrame, DataFrame]:
    """Outliers flagged and clipped, a quality report, and the rows whose values are in range."""
    flagged = outlier_flags(grid, ranges)
    in_range = (
        (F.col("bg").isNull() | F.col("bg").between(*ranges.bg_clip))
        & (F.col("basal_rate").isNull() | F.col("basal_rate").between(0.0, ranges.basal_max))
        & (F.col("bolus_dose").isNull() | F.col("bolus_dose").between(0.0, ranges.bolus_max))
    )
    return flagged.filter(in_range), quality_report(flagged, spec)
