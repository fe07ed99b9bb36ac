"""Levels as column expressions: decibel and energy, validity, classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 46_800  # 07:00 to 20:00
EXCLUDING_FLAGS = 1 | 2 | 8  # held maximum, held minimum, gap
#: Lower limits of wind forces 1 to 12 in m/s; fixed values.
BEAUFORT = [0.3, 1.6, 3.4, 5.5, 8.0, 10.8, 13.9, 17.2, 20.8, 24.5, 28.5, 32.7]


def energy(level: Column) -> Column:
    return F.pow(F.lit(10.0), level / 10)


def level_of(e: Column) -> Column:
    """dB of an energy; null for energies that are not positive."""
    return 10 * F.log10(e)


def laeq(level: Column) -> Column:
    """Energetic mean (aggregate); null for an empty group."""
    return level_of(F.avg(energy(level)))


def valid(level: Column, top: float = 160.0) -> Column:
    """0 < level <= top; false for null and NaN (NaN is above every number)."""
    return F.coalesce((level > 0) & (level <= top), F.lit(False))


def countable_flags(flags: Column) -> Column:
    """Unknown flags exclude."""
    return F.coalesce(flags, F.lit(EXCLUDING_FLAGS)).bitwiseAND(F.lit(EXCLUDING_FLAGS)) == 0


def parse_level(text: Column) -> Column:
    """Text with decimal comma or point -> double, null if it is no number."""
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("double")


def tier(coverage: Column) -> Column:
    return F.when(coverage >= 0.9, "valid").when(coverage >= 0.7, "partial").when(coverage > 0, "window").otherwise("none")


def tier_of_count(n: Column) -> Column:
    return F.when(n >= 42_120, "hoch").when(n >= 32_760, "teil").when(n > 0, "fenster").otherwise("keine")


def rain_class(intensity: Column, light: float = 2.5, heavy: float = 10.0) -> Column:
    return F.when(intensity.isNull() | F.isnan(intensity), "unbekannt").when(intensity < light, "leicht").when(intensity <= heavy, "mäßig").otherwise("stark")


def beaufort(ms: Column) -> Column:
    """Number of thresholds not above the speed; null stays null."""
    return F.when(ms.isNotNull(), reduce(lambda a, t: a + F.when(ms >= t, 1).otherwise(0), BEAUFORT, F.lit(0)))


def plausibility(lmin: Column, lmax: Column) -> Column:
    return F.when(lmin < 50, "UNTER_50").when(lmax > 100, "UEBER_100").otherwise("OK")


def segment(second_of_day: Column) -> Column:
    """Local day: before 7, 7 to 20, from 20 on."""
    return F.when(second_of_day < 7 * 3600, "vor07").when(second_of_day < 20 * 3600, "07-20").otherwise("ab20")


def filled_up(level: Column, seconds: Column, rest: Column, assumed: float) -> Column:
    """Level if ``rest`` unmeasured seconds had the assumed level."""
    return level_of((seconds * energy(level) + rest * energy(F.lit(assumed))) / (seconds + rest))


def lower_bound(level: Column, seconds: Column, reference: int = DAY_SECONDS) -> Column:
    """Level if nothing had sounded in the unmeasured seconds."""
    return level + level_of(seconds / F.lit(float(reference)))


def borderline(level: Column, limits=(55.0, 60.0), reach: float = 2.5) -> Column:
    return reduce(lambda a, b: a | b, [F.abs(level - x) <= reach for x in limits])


def beside(x: Column, y: Column, tolerance: float) -> Column:
    """Near each other; null is not."""
    return F.coalesce(F.abs(x - y) <= tolerance, F.lit(False))


def in_force(day: Column, first: str, last: str) -> Column:
    """A rule's days, both inclusive."""
    return day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def regime(day: Column, changes: list[tuple[str, str]], before: str) -> Column:
    """Name of the setup in force on a day: ``changes`` are (first day, name), in order; before the first one ``before``."""
    return reduce(lambda c, x: F.when(day >= F.lit(x[0]).cast("date"), x[1]).otherwise(c), changes, F.lit(before))
