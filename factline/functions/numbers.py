"""Rules on pairs of figures, as column expressions; usable inside higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Split ratios, scale factors and tolerances of the rules.
SPLIT_RATIOS = (2, 3, 4, 5, 7, 8, 10, 15, 20, 25, 50)
SPLIT_TOLERANCE = 0.02
CENT_ROUNDING = 0.0051
SCALE_FACTORS = (100, 1_000, 1_000_000)
SCALE_TOLERANCE = 0.02


def same_sign(a: Column, b: Column) -> Column:
    """Neither is zero and both lie on one side of it."""
    return (a != 0) & (b != 0) & ((a > 0) == (b > 0))


def _size(a: Column, b: Column) -> tuple[Column, Column]:
    return F.greatest(F.abs(a), F.abs(b)), F.least(F.abs(a), F.abs(b))


def first_scale(x: Column, low: int, high: int, close) -> Column:
    """The first k in low..high with ``close(x rounded to k places, x)``, else high."""
    return F.coalesce(*[F.when(close(F.bround(x, k), x), F.lit(k)) for k in range(low, high + 1)], F.lit(high))


def decimals(x: Column) -> Column:
    """Decimal places in use, 0 to 6."""
    return first_scale(x, 0, 6, lambda r, v: F.abs(r - v) <= 1e-12)


def precision(x: Column) -> Column:
    """Decimal places a figure is reported to; negative for thousands, millions."""
    return first_scale(x, -9, 6, lambda r, v: F.abs(r - v) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(v)))


def significant_digits(x: Column) -> Column:
    """Digits of the figure written with twelve, without zeros at either end."""
    digits = F.regexp_replace(F.substring_index(F.format_string("%.11e", F.abs(x)), "e", 1), r"\.", "")
    return F.length(F.regexp_replace(digits, "^0+|0+$", ""))


def distinctive(x: Column) -> Column:
    """Four significant digits or more, counted from hundredths."""
    digits = F.bround(F.abs(x) * 100, 0).cast("decimal(38,0)").cast("string")
    return F.length(F.regexp_replace(digits, "0+$", "")) >= 4


def last_digit(x: Column) -> Column:
    """Half a unit of the figure's last decimal place."""
    return F.lit(0.5) * F.pow(F.lit(10.0), -decimals(x))


def scale_factor(old: Column, new: Column, half: Column) -> Column:
    """The factor if one figure is about 100, 1,000 or 1,000,000 times the other, else null; ``half`` is the smaller one's last_digit."""
    big, small = _size(old, new)
    hit = lambda f: F.abs(big / f - small) <= F.greatest(SCALE_TOLERANCE * small, half)
    return F.when(same_sign(old, new), F.coalesce(*[F.when(hit(f), F.lit(f)) for f in SCALE_FACTORS]))


def scale_jump(old: Column, new: Column) -> Column:
    """scale_factor of two figures by themselves."""
    return scale_factor(old, new, last_digit(_size(old, new)[1]))


def detect_split(old: Column, new: Column, unit: Column) -> Column:
    """The split ratio that explains a change of a share count or per-share figure, else null."""
    big, small = _size(old, new)
    cents = unit.endswith("/shares") & (small >= 0.10)
    hit = lambda r: (F.abs(big / r - small) <= SPLIT_TOLERANCE * small) | (cents & (F.abs(big / r - small) <= CENT_ROUNDING))
    fits = (unit == "shares") | unit.endswith("/shares")
    return F.when(fits & same_sign(old, new), F.coalesce(*[F.when(hit(r), F.lit(r)) for r in SPLIT_RATIOS]))


def _rounds_to(fine: Column, coarse: Column) -> Column:
    whole = F.greatest(F.lit(1.0), F.abs(coarse))
    # the fine figure at the first scale that leaves the coarse one as it is
    rounded = F.coalesce(*[F.when(F.abs(F.bround(coarse, k) - coarse) <= 1e-9 * whole, F.bround(fine, k)) for k in range(-9, 7)], F.bround(fine, 6))
    return (significant_digits(coarse) >= 3) & (F.abs(rounded - coarse) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(coarse)))


def is_rounding(old: Column, new: Column) -> Column:
    """The same figure reported to different places: at most half a percent apart, and one rounds to the other.

    Ties round half-even on the decimal text, so a figure whose binary value lies just off a tie may differ
    from binary rounding."""
    big, _ = _size(old, new)
    near = F.abs(new - old) <= 0.005 * big
    return F.coalesce((old != new) & ((old > 0) == (new > 0)) & near & (_rounds_to(old, new) | _rounds_to(new, old)), F.lit(False))


def pct_change(old: Column, new: Column) -> Column:
    return 100 * F.try_divide(new - old, F.abs(old))


def stable_id(*parts: Column) -> Column:
    """24 hex digits of a SHA-256; nulls keep their place."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, 24)
