"""Row-local expressions over one wave (``array<double>``).

Everything here is a Spark column expression, so it needs no shuffle and works on a stream.
Positions are 0-based, as in the measurement files; only the calls into Spark's 1-based array
functions add one. Expressions that look at a bounded window (rise, decay, local kurtosis) are
what the feature builder uses. Those that visit every sample several times are also available as
one Arrow batch function in :mod:`wavelattice.functions.wavescan`, which is faster on long waves.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wavelattice import schema as S
from wavelattice.functions.scalars import zero_guarded_ratio


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    Spark re-evaluates an expression that a lambda mentions for every element; inside a lambda over
    a one-element array it is a plain variable. An expression whose inner lambda uses such a
    variable cannot be the direct argument of a Python UDF (Spark 4.1 fails to extract the UDF), so
    the functions that feed UDFs do not use it.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def power(wave: Column) -> Column:
    """Sample-wise squared amplitude."""
    return F.transform(wave, lambda x: x * x)


def energy(wave: Column) -> Column:
    """Sum of squared amplitudes."""
    return F.aggregate(wave, F.lit(0.0), lambda acc, x: acc + x * x)


def normalized(wave: Column, divisor: Column) -> Column:
    """Every sample over one scalar; 0 where the quotient is not a finite number.

    NaN compares as larger than infinity and a zero divisor gives null, so one test covers all.
    """
    def quotient(x):
        q = F.try_divide(x, divisor)
        return F.when(F.abs(q) < F.lit(float("inf")), q).otherwise(F.lit(0.0))

    return F.transform(wave, quotient)


def _is_bad(x: Column) -> Column:
    return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))


def finite_or_zero(wave: Column) -> Column:
    """NaN, infinite and null samples replaced by 0."""
    return F.transform(wave, lambda x: F.when(_is_bad(x), F.lit(0.0)).otherwise(x))


def nonfinite_counts(wave: Column) -> Column:
    """``struct<nan, inf>``: how many samples :func:`finite_or_zero` would replace."""
    nan = F.size(F.filter(wave, lambda x: x.isNull() | F.isnan(x)))
    inf = F.size(F.filter(wave, lambda x: F.abs(x) == F.lit(float("inf"))))
    return F.struct(nan.alias("nan"), inf.alias("inf"))


def window(wave: Column, centre: Column, left: int, right: int) -> Column:
    """Samples ``centre-left .. centre+right`` clipped to the wave; empty when outside."""
    lo = F.greatest(centre - left, F.lit(0))
    hi = F.least(centre + right + 1, F.size(wave))
    return F.slice(wave, lo + 1, F.greatest(hi - lo, F.lit(0)))


def zoom_window(wave: Column, peak: Column, left: int = 50, right: int = 100) -> Column:
    """The stretch of the wave shown around a detected peak."""
    return window(wave, peak, left, right)


def argmax_near(wave: Column, centre: Column, half_width: int = S.PEAK_SEARCH_HALF_WIDTH,
                scaled=lambda part: part) -> Column:
    """First maximum within ``half_width`` of ``centre`` as ``struct<idx, amp>``.

    Beyond the end of the wave the centre itself is kept, with the last sample as amplitude.
    ``scaled`` is applied to the window only, so a long wave need not be normalised as a whole.
    """
    lo = F.greatest(centre - half_width, F.lit(0))

    def pick(near):
        top = F.array_max(near)
        found = F.struct((lo + F.array_position(near, top) - 1).cast("int").alias("idx"), top.alias("amp"))
        last = scaled(F.slice(wave, F.least(centre + 1, F.size(wave)).cast("int"), 1))[0]
        outside = F.struct(centre.cast("int").alias("idx"), last.alias("amp"))
        return F.when(F.size(near) > 0, found).otherwise(outside)

    return bind(scaled(window(wave, centre, half_width, half_width)), pick)


def moving_average3(wave: Column) -> Column:
    """Three-sample mean with zeros beyond both ends."""
    third = F.lit(1.0 / 3.0)
    zero = F.array(F.lit(0.0))
    before = F.concat(zero, F.slice(wave, 1, F.size(wave) - 1))
    after = F.concat(F.slice(wave, 2, F.size(wave) - 1), zero)
    two = F.zip_with(before, wave, lambda a, b: a * third + b * third)
    return F.zip_with(two, after, lambda s, c: s + c * third)


def local_maxima(wave: Column) -> Column:
    """Positions of strict local maxima; a flat top counts once, at its middle sample.

    A fold keeps the position where the current level was entered by a rise (``-1`` when it was
    not): a fall after such a rise closes a peak that spans the whole level.
    """
    start = F.struct(F.lit(-1).alias("rise"), F.element_at(wave, 1).alias("prev"),
                     F.lit(0).alias("pos"), F.array().cast("array<int>").alias("peaks"))

    def step(acc, x):
        closed = F.floor((acc["rise"] + acc["pos"] - 1) / 2).cast("int")
        rise = (F.when(x > acc["prev"], acc["pos"])
                .when(x < acc["prev"], F.lit(-1)).otherwise(acc["rise"]))
        peaks = F.when((x < acc["prev"]) & (acc["rise"] > 0),
                       F.array_append(acc["peaks"], closed)).otherwise(acc["peaks"])
        return F.struct(rise.alias("rise"), x.alias("prev"),
                        (acc["pos"] + 1).alias("pos"), peaks.alias("peaks"))

    return F.aggregate(wave, start, step, lambda acc: acc["peaks"])


def _run_at_least(values: Column, threshold: Column) -> Column:
    def count(below):
        first = F.array_position(below, F.lit(True))
        return F.when(first > 0, first - 1).otherwise(F.size(below)).cast("double")

    return bind(threshold, lambda t: bind(F.transform(values, lambda x: x < t), count))


def rise_time(wave: Column, idx: Column, amp: Column, half_width: int = S.FEATURE_HALF_WIDTH) -> Column:
    """Samples from the peak leftwards that stay at or above a tenth of its amplitude."""
    left = F.reverse(window(wave, idx, half_width, 0))
    return _run_at_least(left, amp * F.lit(S.EDGE_FRACTION))


def decay_time(wave: Column, idx: Column, amp: Column, half_width: int = S.FEATURE_HALF_WIDTH) -> Column:
    """Samples from the peak rightwards that stay at or above a tenth of its amplitude."""
    right = window(wave, idx, 0, half_width)
    return _run_at_least(right, amp * F.lit(S.EDGE_FRACTION))


def excess_kurtosis(values: Column) -> Column:
    """Population excess kurtosis of an array; 0 for a constant array."""
    zero = F.struct(F.lit(0.0).alias("m2"), F.lit(0.0).alias("m4"))

    def about(mean):
        def add(acc, x):
            d2 = (x - mean) * (x - mean)
            return F.struct((acc["m2"] + d2).alias("m2"), (acc["m4"] + d2 * d2).alias("m4"))

        return F.aggregate(values, zero, add, lambda acc: F.when(
            acc["m2"] > 0, F.size(values) * acc["m4"] / (acc["m2"] * acc["m2"]) - 3.0).otherwise(F.lit(0.0)))

    return bind(_total(values) / F.size(values), about)


def local_kurtosis(wave: Column, idx: Column, half_width: int = S.FEATURE_HALF_WIDTH) -> Column:
    """Kurtosis of the window around a peak, when it has more than three samples."""
    return bind(window(wave, idx, half_width, half_width),
                lambda near: F.when(F.size(near) > 3, excess_kurtosis(near)).otherwise(F.lit(0.0)))


def local_shape(wave: Column, idx: Column, amp: Column, half_width: int = S.FEATURE_HALF_WIDTH,
                scaled=lambda part: part) -> Column:
    """``struct<rise, decay, kurtosis, energy>`` of the window around a detected peak, else zeros."""
    zero = F.lit(0.0)

    def shape(near):
        at = F.least(idx, F.lit(half_width))
        left = F.reverse(F.slice(near, 1, at + 1))
        right = F.slice(near, at + 1, half_width + 1)
        bar = amp * F.lit(S.EDGE_FRACTION)
        kurt = F.when(F.size(near) > 3, excess_kurtosis(near)).otherwise(zero)
        return F.struct(_run_at_least(left, bar).alias("rise"), _run_at_least(right, bar).alias("decay"),
                        kurt.alias("kurtosis"), energy(near).alias("energy"))

    nothing = F.struct(*[zero.alias(n) for n in ("rise", "decay", "kurtosis", "energy")])
    return F.when(amp > 0, bind(scaled(window(wave, idx, half_width, half_width)), shape)).otherwise(nothing)


def energy_ratio(wave: Column, idx: Column, half_width: int = S.FEATURE_HALF_WIDTH) -> Column:
    """Share of the wave's energy that lies in the window around a peak."""
    return zero_guarded_ratio(energy(window(wave, idx, half_width, half_width)), energy(wave))


def mean_excess_delay(wave: Column) -> Column:
    """Power-weighted mean sample position."""
    weighted = F.zip_with(wave, F.sequence(F.lit(0), F.size(wave) - 1), lambda x, k: x * x * k)
    return zero_guarded_ratio(_total(weighted), energy(wave))


def rms_delay_spread(wave: Column) -> Column:
    """Square root of the power-weighted second central moment of the sample position."""
    def spread(mean):
        moments = F.zip_with(wave, F.sequence(F.lit(0), F.size(wave) - 1),
                             lambda x, k: (k - mean) * (k - mean) * x * x)
        return F.sqrt(zero_guarded_ratio(_total(moments), energy(wave)))

    return bind(mean_excess_delay(wave), spread)


def max_to_mean(wave: Column) -> Column:
    """Largest amplitude over the mean amplitude."""
    return zero_guarded_ratio(F.array_max(wave), _total(wave) / F.size(wave))


def tail_energy_ratio(wave: Column, idx: Column) -> Column:
    """Share of the energy from ``idx`` (clipped into the wave) to the end."""
    at = F.greatest(F.least(idx, F.size(wave) - 1), F.lit(0))
    tail = F.slice(wave, at + 1, F.size(wave) - at)
    return zero_guarded_ratio(energy(tail), energy(wave))


def resample_linear(values: Column, n: int) -> Column:
    """``n`` equally spaced points of the piecewise linear curve through ``values``."""
    def curve(v):
        last = F.size(v) - 1

        def point(i):
            where = i * last / F.lit(float(max(n - 1, 1)))
            left = F.least(F.floor(where).cast("int"), F.greatest(last - 1, F.lit(0)))
            a = F.element_at(v, left + 1)
            b = F.element_at(v, F.least(left + 1, last) + 1)
            return a + (b - a) * (where - left)

        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), point)

    return bind(values, curve)


def shift_zero_fill(wave: Column, shift: Column) -> Column:
    """Wave moved right by ``shift`` samples (left if negative), zeros moved in."""
    n = F.size(wave)
    zeros = F.array_repeat(F.lit(0.0), F.least(F.abs(shift), n))
    kept = F.greatest(n - F.abs(shift), F.lit(0))
    right = F.concat(zeros, F.slice(wave, 1, kept))
    left = F.concat(F.slice(wave, F.least(F.abs(shift), n) + 1, kept), zeros)
    return F.when(shift >= 0, right).otherwise(left)
