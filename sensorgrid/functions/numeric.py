"""Rounding, truncation, order-independent averages and replayable noise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

INT_MIN, INT_MAX = -2147483648.0, 2147483647.0
LOW_BITS = 20


def truncated_int(value: Column) -> Column:
    """Double to int towards zero; beyond the int range the nearest bound."""
    bounded = F.least(F.greatest(value, F.lit(INT_MIN)), F.lit(INT_MAX))
    return F.when(value.isNotNull(), bounded.try_cast("int"))


def half_up(value: Column, digits: int) -> Column:
    """``F.round`` of doubles, same results, without its decimal arithmetic per row.

    Away from a tie the nearest step is plain arithmetic; only within a millionth
    of one, where the decimal text decides, does ``F.round`` run. ``value`` is
    repeated, so pass a column, not a long expression.
    """
    scale = float(10**digits)
    steps = value * scale
    nearest = F.rint(steps)
    clear = (F.abs(steps - nearest) < 0.499999) & (F.abs(steps) < 1e12)
    return F.when(clear, nearest / scale + 0.0).otherwise(F.round(value, digits))


def whole_half_up(value: Column) -> Column:
    """``F.round(value, 0)``, same results: ties to even, corrected where it was a tie."""
    even = F.rint(value)
    tie_down = F.when(value - even == 0.5, 1.0).otherwise(0.0)
    return F.when(value >= 0, even + tie_down).otherwise(F.round(value, 0))


def sum_parts(column: str) -> dict[str, Column]:
    """Aggregates from which the average of a column follows; each can be summed again.

    Summing doubles gives last-digit differences between runs, which flip rounded
    averages. Here millionths are summed as integers, high and low bits apart, so
    that neither sum overflows at trillions of rows in one group. Values too large
    for that are added as doubles. Non-finite values count as missing.
    """
    finite = F.when(F.abs(column) < float("inf"), F.col(column))
    millionths = F.rint(finite * 1e6).try_cast("bigint")
    return {
        "high": F.sum(F.shiftright(millionths, LOW_BITS)),
        "low": F.sum(millionths.bitwiseAND((1 << LOW_BITS) - 1)),
        "wide": F.sum(F.when(millionths.isNull(), finite)),
        "n": F.count(finite),
    }


def average_of(parts: dict[str, Column]) -> Column:
    """The average that ``sum_parts``, or sums of them, stand for."""
    whole = F.lit(0).cast("decimal(38,0)")
    high = F.coalesce(parts["high"].cast("decimal(38,0)"), whole)
    low = F.coalesce(parts["low"].cast("decimal(38,0)"), whole)
    total = (high * F.lit(1 << LOW_BITS).cast("decimal(10,0)") + low).cast("double") / 1e6
    return F.when(parts["n"] > 0, (total + F.coalesce(parts["wide"], F.lit(0.0))) / parts["n"])


def exact_avg(column: str) -> Column:
    """Average whose result does not depend on the order rows are added in."""
    return average_of(sum_parts(column))


def keyed_jitter(keys: list[Column], amplitude: Column, seed: int = 0) -> Column:
    """Noise factor in [1 - amplitude, 1 + amplitude) drawn from the row's keys.

    The same keys and seed give the same factor in every run, retry and query.
    52 bits of an MD5 digest serve as the uniform draw.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    draw = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")
    uniform = draw / F.lit(float(1 << 52))
    return F.lit(1.0) + (uniform * 2.0 - 1.0) * amplitude
