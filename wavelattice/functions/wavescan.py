"""Arrow batch functions for the wave-wide work.

Peak selection is sequential along the wave (plateaus, minimum distance, prominence), so it is the
one place where the features leave the JVM. The batch is handled as one matrix, without a Python
loop over rows; the wave-wide sums ride along because the samples are already in the worker.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from wavelattice import schema as S

_ROWS = 256  # rows handled as one matrix: bounds the temporaries to a few MB per wave column

SCAN_TYPE = T.StructType([T.StructField("path2_idx", T.IntegerType())] + [
    T.StructField(c, T.DoubleType()) for c in (
        "path2_amp", "energy", "mean_excess_delay", "rms_delay_spread", "kurtosis_full", "max_to_mean",
        "tail1", "tail2")])
PEAKS_TYPE = T.ArrayType(T.StructType([T.StructField("idx", T.IntegerType()),
                                       T.StructField("prominence", T.DoubleType())]))


def smooth3(waves: np.ndarray) -> np.ndarray:
    """Three-sample mean of every row, zeros beyond both ends."""
    third = 1.0 / 3.0
    scaled = waves * third
    out = scaled.copy()
    out[:, 1:] = scaled[:, :-1] + out[:, 1:]
    out[:, :-1] += scaled[:, 1:]
    return out


def row_maxima(waves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position) of all local maxima, by row and then position; plateau -> middle."""
    slope = np.sign(np.diff(waves, axis=1))
    row, at = np.nonzero(slope)
    same = row[1:] == row[:-1]
    turn = same & (slope[row[:-1], at[:-1]] > 0) & (slope[row[1:], at[1:]] < 0)
    start, stop = at[:-1][turn] + 1, at[1:][turn]
    return row[:-1][turn], (start + stop) // 2


def thin_by_distance(row: np.ndarray, pos: np.ndarray, height: np.ndarray, distance: int) -> np.ndarray:
    """Mask of the peaks kept when, from the highest down, closer neighbours are removed.

    Every round keeps all peaks that outrank each live peak within ``distance`` and removes their
    neighbours; that yields the same set as visiting the peaks one by one. Of two equally high
    peaks the later one outranks the earlier.
    """
    keep = np.zeros(len(pos), bool)
    live = np.arange(len(pos))
    # rows are set apart by more than the distance so that one sorted axis serves all of them
    axis = row.astype(np.int64) * (int(pos.max(initial=0)) + distance + 1) + pos
    while len(live):
        where, tall = axis[live], height[live]
        outranked = np.zeros(len(live), bool)
        for step in range(1, len(live)):
            near = where[step:] - where[:-step] < distance
            if not near.any():
                break
            later_wins = tall[step:] >= tall[:-step]
            outranked[:-step] |= near & later_wins
            outranked[step:] |= near & ~later_wins
        winners = where[~outranked]
        keep[live[~outranked]] = True
        slot = np.searchsorted(winners, where)
        below = np.where(slot > 0, where - winners[np.maximum(slot - 1, 0)], distance)
        above = np.where(slot < len(winners),
                         winners[np.minimum(slot, len(winners) - 1)] - where, distance)
        live = live[(below >= distance) & (above >= distance)]
    return keep


def prominences(waves: np.ndarray, row: np.ndarray, pos: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Prominence of the ``wanted`` entries of the complete list of maxima ``(row, pos)``.

    Between two maxima the wave has a single valley, so walking over maxima and valleys replaces
    walking over samples.
    """
    n = waves.shape[1]
    flat = row.astype(np.int64) * n + pos
    height = waves[row, pos]
    cuts = np.concatenate([np.arange(waves.shape[0], dtype=np.int64) * n, flat])
    order = np.argsort(cuts, kind="stable")
    floor_of = np.empty(len(cuts))
    floor_of[order] = np.minimum.reduceat(waves.ravel(), cuts[order])
    right_floor = floor_of[waves.shape[0]:]
    first = np.r_[True, row[1:] != row[:-1]] if len(row) else np.zeros(0, bool)
    left_floor = np.where(first, floor_of[:waves.shape[0]][row], np.r_[0.0, right_floor[:-1]])
    last = np.r_[first[1:], True] if len(row) else first

    def lowest(floor, edge, step):
        low = np.full(len(wanted), np.inf)
        going = np.arange(len(wanted))
        at = wanted.copy()
        while len(going):
            low[going] = np.minimum(low[going], floor[at])
            inside = ~edge[at]
            going, at = going[inside], at[inside] + step
            onward = height[at] <= height[wanted[going]]
            going, at = going[onward], at[onward]
        return low

    return height[wanted] - np.maximum(lowest(left_floor, first, -1), lowest(right_floor, last, 1))


def peaks_of(waves: np.ndarray, min_height: np.ndarray, distance: int,
             min_prominence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, position, prominence) of peaks: by height, then distance, then prominence."""
    row, pos = row_maxima(waves)
    height = waves[row, pos]
    tall = np.nonzero(height >= min_height[row])[0]
    kept = tall[thin_by_distance(row[tall], pos[tall], height[tall], distance)]
    prom = prominences(waves, row, pos, kept)
    good = prom >= min_prominence[row[kept]]
    return row[kept][good], pos[kept][good], prom[good]


def second_paths(waves: np.ndarray, idx1: np.ndarray, amp1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Most prominent peak away from the first path, per row; ``(0, 0.0)`` where none."""
    idx2, amp2 = np.zeros(len(waves), np.int32), np.zeros(len(waves))
    bar = np.where(amp1 > 0, S.PEAK_FRACTION * amp1, np.inf)
    row, pos, prom = peaks_of(smooth3(waves), bar, S.PEAK_DISTANCE, bar)
    apart = np.abs(pos - idx1[row]) > S.PEAK_EXCLUSION
    row, pos, prom = row[apart], pos[apart], prom[apart]
    order = np.lexsort((pos, -prom, row))
    row, pos = row[order], pos[order]
    best = np.r_[True, row[1:] != row[:-1]] if len(row) else np.zeros(0, bool)
    idx2[row[best]] = pos[best]
    amp2[row[best]] = waves[row[best], pos[best]]
    return idx2, amp2


def _guarded(num: np.ndarray, den: np.ndarray) -> np.ndarray:
    return np.divide(num, den, out=np.zeros(len(num)), where=den > 0)


def _scan(waves: np.ndarray, idx1: np.ndarray, amp1: np.ndarray) -> list[np.ndarray]:
    n = waves.shape[1]
    if n == 0:
        return [np.zeros(len(waves), int)] + [np.zeros(len(waves))] * (len(_NAMES) - 1)
    idx2, amp2 = second_paths(waves, idx1, amp1)
    pdp = waves * waves
    total = pdp.sum(axis=1)
    k = np.arange(n, dtype=float)
    mean_delay = _guarded(pdp @ k, total)
    spread = np.einsum("ij,ij->i", (k - mean_delay[:, None]) ** 2, pdp)
    mean = waves.mean(axis=1)
    sq = (waves - mean[:, None]) ** 2
    m2, m4 = sq.mean(axis=1), np.einsum("ij,ij->i", sq, sq) / n
    kurtosis = np.divide(m4, m2 * m2, out=np.full(len(waves), 3.0), where=m2 > 0) - 3.0
    tails = []
    for idx in (idx1, idx2):
        outside = k < np.clip(idx, 0, n - 1)[:, None]
        tails.append(_guarded(np.where(outside, 0.0, pdp).sum(axis=1), total))
    return [idx2, amp2, total, mean_delay, np.sqrt(_guarded(spread, total)), kurtosis,
            _guarded(waves.max(axis=1), mean), *tails]


_NAMES = SCAN_TYPE.names


def _flat(waves: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All samples in a row, and the number of samples of every wave; a null wave has none, a null sample is NaN."""
    sizes = pc.fill_null(pc.list_value_length(waves), 0).to_numpy(zero_copy_only=False)
    return waves.flatten().to_numpy(zero_copy_only=False).astype(float), sizes


@F.arrow_udf(SCAN_TYPE)
def _scan_udf(waves: pa.Array, divisor: pa.Array, idx1: pa.Array, amp1: pa.Array) -> pa.Array:
    values, sizes = _flat(waves)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    i1 = pc.fill_null(idx1, 0).to_numpy(zero_copy_only=False)
    a1 = pc.fill_null(amp1, 0.0).to_numpy(zero_copy_only=False)
    by = pc.fill_null(divisor, 1.0).to_numpy(zero_copy_only=False)
    blocks = []
    at = 0
    while at < len(sizes):
        # a block is a run of rows with equal wave length; all rows, in every usual table
        stop = min(at + _ROWS, len(sizes))
        differ = np.nonzero(sizes[at:stop] != sizes[at])[0]
        stop = at + differ[0] if len(differ) else stop
        block = values[starts[at]:starts[stop]].reshape(stop - at, sizes[at])
        with np.errstate(all="ignore"):
            block = block / by[at:stop, None]
        block[~np.isfinite(block)] = 0.0
        blocks.append(_scan(block, i1[at:stop], a1[at:stop]))
        at = stop
    columns = [np.concatenate(c) for c in zip(*blocks)] if blocks else [np.zeros(0)] * len(_NAMES)
    arrays = [pa.array(c, pa.int32() if name.endswith("_idx") else pa.float64())
              for name, c in zip(_NAMES, columns)]
    return pa.StructArray.from_arrays(arrays, _NAMES)


def scan_wave(wave: Column, path1_idx: Column, path1_amp: Column, divisor: Column | None = None) -> Column:
    """``struct`` of second path, wave-wide statistics and the tail energies of both paths; zeros for null or empty waves.

    With ``divisor`` the wave is normalised on the way, as :func:`waves.normalized` would.
    """
    return _scan_udf(wave, F.lit(1.0) if divisor is None else divisor.cast("double"), path1_idx, path1_amp)


@F.arrow_udf(PEAKS_TYPE)
def _find_peaks_udf(waves: pa.Array, height: pa.Array, distance: pa.Array, prom: pa.Array) -> pa.Array:
    values, sizes = _flat(waves)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    h = height.to_numpy(zero_copy_only=False).astype(float)
    p = prom.to_numpy(zero_copy_only=False).astype(float)
    d = distance.to_numpy(zero_copy_only=False)
    counts, idx, prominence = [], [], []
    at = 0
    while at < len(sizes):
        stop = min(at + _ROWS, len(sizes))
        differ = np.nonzero((sizes[at:stop] != sizes[at]) | (d[at:stop] != d[at]))[0]
        stop = at + differ[0] if len(differ) else stop
        block = values[starts[at]:starts[stop]].reshape(stop - at, sizes[at])
        if sizes[at]:
            row, pos, pr = peaks_of(block, h[at:stop], int(d[at]), p[at:stop])
        else:
            row, pos, pr = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        counts.append(np.bincount(row, minlength=stop - at))
        idx.append(pos)
        prominence.append(pr)
        at = stop
    if not counts:
        counts, idx, prominence = [np.zeros(0, int)], [np.zeros(0, int)], [np.zeros(0)]
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
    peaks = pa.StructArray.from_arrays(
        [pa.array(np.concatenate(idx), pa.int32()), pa.array(np.concatenate(prominence), pa.float64())],
        ["idx", "prominence"])
    return pa.ListArray.from_arrays(pa.array(offsets), peaks)


def find_peaks(wave: Column, height: Column, distance: int = 1, prominence: Column | None = None) -> Column:
    """Peaks of a wave as ``array<struct<idx, prominence>>`` in order of position; none for null or empty waves."""
    floor = F.lit(float("-inf")) if prominence is None else prominence
    return _find_peaks_udf(wave, height.cast("double"), F.lit(int(distance)), floor.cast("double"))
