"""Column lists, constants and explicit schemas of the measurement tables."""

from __future__ import annotations

from pyspark.sql import types as T

# They name the measurement columns and the published constants of the data set.
WAVE_LENGTH = 1016
WAVE_PREFIX = "CIR"
WAVE_EXCLUDED = ("CIR_PWR",)
SCALARS = [
    "RANGE", "FP_IDX", "FP_AMP1", "FP_AMP2", "FP_AMP3", "STDEV_NOISE",
    "CIR_PWR", "MAX_NOISE", "RXPACC", "FRAME_LEN", "PREAM_LEN",
]
SHARED_SCALARS = [
    "FP_AMP1", "FP_AMP2", "FP_AMP3", "STDEV_NOISE", "CIR_PWR",
    "MAX_NOISE", "RXPACC", "FRAME_LEN", "PREAM_LEN",
]
CONSTANT_COLUMNS = ["CH", "BITRATE", "PRFR", "ENV_ID"]
DEGENERATE_IF_ZERO = ["RANGE", "CIR_PWR", "RXPACC"]
PATH_FEATURES = [
    "p_path_idx", "p_path_amp", "p_rise_time", "p_decay_time", "p_kurtosis_local",
    "p_energy_ratio", "p_peak_to_noise", "p_amplitude_ratio", "p_rms_delay_spread",
    "p_mean_excess_delay", "p_kurtosis_full", "p_max_to_mean", "p_tail_energy_ratio",
]
DERIVED_FEATURES = ["path_delay_separation", "path1_to_fp_offset", "relative_power"]
FEATURES = PATH_FEATURES + SHARED_SCALARS + DERIVED_FEATURES
ENVIRONMENTS = [
    "Office 1", "Office 2", "Small Apartment", "Small Workshop",
    "Kitchen+Living", "Bedroom", "Boiler Room",
]
METRES_PER_SAMPLE = 0.2998
PEAK_SEARCH_HALF_WIDTH = 10
FEATURE_HALF_WIDTH = 15
PEAK_EXCLUSION = 15
PEAK_DISTANCE = 15
PEAK_FRACTION = 0.02
EDGE_FRACTION = 0.1
SEED = 42
TEST_FRACTION = 0.2

# The order in which the measurement files list their columns.
_RAW_SCALARS = [
    "NLOS", "RANGE", "FP_IDX", "FP_AMP1", "FP_AMP2", "FP_AMP3", "STDEV_NOISE", "CIR_PWR",
    "MAX_NOISE", "RXPACC", "CH", "FRAME_LEN", "PREAM_LEN", "BITRATE", "PRFR",
]


def raw_csv_schema(wave_length: int = WAVE_LENGTH) -> T.StructType:
    """Schema of one wide measurement file: label, scalars, then one column per wave sample."""
    fields = [T.StructField(c, T.IntegerType() if c == "NLOS" else T.DoubleType())
              for c in _RAW_SCALARS]
    fields += [T.StructField(f"{WAVE_PREFIX}{i}", T.DoubleType()) for i in range(wave_length)]
    return T.StructType(fields)


def wave_columns(columns: list[str]) -> list[str]:
    """Wave sample columns by prefix, ordered by their number (``CIR2`` before ``CIR10``)."""
    picked = [c for c in columns if c.startswith(WAVE_PREFIX) and c not in WAVE_EXCLUDED
              and c[len(WAVE_PREFIX):].isdigit()]
    return sorted(picked, key=lambda c: int(c[len(WAVE_PREFIX):]))
