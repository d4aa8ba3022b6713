"""Row-local parts of the study on a stream of measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wavelattice.operators.cleaning import drop_degenerate
from wavelattice.operators.paths import measurement_features


def stream_features(measurements: DataFrame, wave: str = "cir", keys: tuple[str, ...] = ("sample_id", "env_id")) -> DataFrame:
    """Clean, locate both paths and expand; batch or streaming, without any state."""
    return measurement_features(drop_degenerate(measurements), wave, keys)
