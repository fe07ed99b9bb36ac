"""Mixed timestamp formats and time zones -> one instant in UTC (milliseconds).

Three steps, all of them JVM column expressions:

1. ``parse_text`` / ``parse_epoch`` read digits, order of parts, precision and any
   zone mark: ``(wall_ms, offset_ms, epoch_ms)`` are the wall clock as if it were
   UTC, the offset the text itself names, and the instant if the value is a number.
2. ``by_reference``, ``by_order`` and ``between_known`` estimate, for values that carry no
   zone, which zone (UTC, Europe/Berlin, ...) breaks the distance to a reference clock, or
   the order of arrival, least often.  They decide for each unit of a source (a day, a
   session, a stretch of arrivals), so a source may change its zone; ``history`` gives
   the changes.
3. ``to_utc`` converts.  A repeated wall-clock hour is the first one, a skipped one
   has the offset before the change (java.time's rules, which Spark uses).

Unreadable or null values give a null instant; nothing raises.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Zone marks with a fixed offset in hours. Fixed values.
MARKS = {"Z": 0, "UTC": 0, "GMT": 0, "CET": 1, "MEZ": 1, "CEST": 2, "MESZ": 2}
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]

ISO_DAY = r"^(\d{4})[-/.]?(\d{2})[-/.]?(\d{2})(?=[T ,]|$)"
DOT_DAY = r"^(\d{1,2})\.(\d{1,2})\.(\d{4})(?=[T ,]|$)"
US_DAY = r"^([A-Z]{3})[A-Z]*\.? (\d{1,2}), ?(\d{4})(?=[T ,]|$)"
MAIL_DAY = r"^(?:[A-Z]{3}, ?)?(\d{1,2}) ([A-Z]{3})[A-Z]* (\d{4})(?=[T ,]|$)"
CLOCK = (
    r"^T?(\d{1,2})([AB])?[:.H]?(\d{2})(?:[:.M]?(\d{2})S?)?(?:[.,](\d{1,9}))?"
    r" ?(?:UHR)? ?([AP]\.?M\.?)? ?(Z|UTC|GMT|CEST|CET|MESZ|MEZ|[+-]\d{2}(?::?\d{2})?)?$"
)


def _whole(a: Column, k: int) -> Column:
    """Floor division of integers; exact for 19 digits, unlike '/'."""
    return F.call_function("div", a - F.pmod(a, F.lit(k).cast("long")), F.lit(k).cast("long"))


def parse_epoch(value: Column) -> Column:
    """Epoch number of unknown unit -> ms, by its magnitude; digits below 1 ms are cut.

    Under 1e11 it counts as seconds, under 1e14 as ms, under 1e17 as us, else as ns.
    """
    v = value.cast("long")
    a = F.abs(v)
    return (
        F.when(a < 100_000_000_000, v * 1000)
        .when(a < 100_000_000_000_000, v)
        .when(a < 100_000_000_000_000_000, _whole(v, 1000))
        .otherwise(_whole(v, 1_000_000))
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value computed once: without it, nested uses are inlined into each other until the generated code is too large to compile."""
    return F.transform(F.array(value), body)[0]


def parse_text(text: Column, day: Column | None = None) -> Column:
    """Text -> struct(wall_ms, offset_ms, epoch_ms).

    ``day`` is a date column for texts that hold only a clock time; a date inside the
    text wins over it.  Digits that are not given are 0; digits below 1 ms are cut.
    A letter A or B after the hour marks the first or second pass of a repeated hour
    of Central European time.
    """
    whole = F.upper(F.trim(F.regexp_replace(text, r"\s+", " ")))
    for pattern, order in ((ISO_DAY, "$1-$2-$3 "), (DOT_DAY, "$3-$2-$1 "), (US_DAY, "$3-$1-$2 "), (MAIL_DAY, "$3-$2-$1 ")):
        whole = F.regexp_replace(whole, pattern, order)
    head = r"^(\d{4})-([0-9A-Z]{1,3})-(\d{1,2}) "
    item = lambda c, k: F.try_element_at(c, F.lit(k))
    given_day = F.unix_date(day.cast("date")) if day is not None else F.lit(None).cast("int")

    def split(s: Column) -> Column:
        return F.struct(
            F.split(F.regexp_extract(s, head, 0), "[- ]").alias("ymd"),
            # hour | A or B | minute | second | fraction | half of the day | zone
            F.split(F.regexp_replace(F.regexp_replace(s, rf"^(?:{head[1:]})?[ ,T]*", ""), CLOCK, "$1|$2|$3|$4|$5|$6|$7"), r"\|", -1).alias("hms"),
            F.split(F.regexp_extract(s, r"^\d{9,19}(?:\.\d+)?$", 0), r"\.").alias("num"),
        )

    def numbers(p: Column) -> Column:
        ymd, hms, num = p["ymd"], p["hms"], p["num"]
        zone, month = item(hms, 7), item(ymd, 2)
        digits = F.regexp_replace(zone, "[^0-9]", "")
        named = F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), month), F.lit(0).cast("long")).cast("string")
        minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
        cut = lambda c: F.rpad(F.substring(c, 1, 3), 3, "0").try_cast("int")
        return F.struct(
            item(hms, 1).try_cast("int").alias("h"),
            F.when(F.size(hms) == 7, item(hms, 3).try_cast("int")).alias("m"),
            F.coalesce(item(hms, 4).try_cast("int"), F.lit(0)).alias("s"),
            F.coalesce(cut(item(hms, 5)), F.lit(0)).alias("ms"),
            F.substring(item(hms, 6), 1, 1).alias("half"),
            F.coalesce(
                F.try_element_at(F.create_map(*[F.lit(x) for k, v in MARKS.items() for x in (k, v * 60)]), zone),
                F.when(zone.startswith("-"), -minutes).when(zone.startswith("+"), minutes),
                F.when(item(hms, 2) == "A", 120).when(item(hms, 2) == "B", 60),
            ).alias("offset"),
            F.coalesce(
                F.unix_date(F.concat_ws("-", item(ymd, 1), F.lpad(F.coalesce(named, month), 2, "0"), F.lpad(item(ymd, 3), 2, "0")).try_cast("date")),
                given_day,
            ).alias("day"),
            (parse_epoch(item(num, 1).try_cast("long")) + F.coalesce(cut(item(num, 2)), F.lit(0))).alias("epoch"),
        )

    def result(q: Column) -> Column:
        h = F.when(q["half"] == "A", q["h"] % 12).when(q["half"] == "P", q["h"] % 12 + 12).otherwise(q["h"])
        wall = q["day"].cast("long") * 86_400_000 + (h * 3600 + q["m"] * 60 + q["s"]).cast("long") * 1000 + q["ms"]
        valid = (h < 24) & (q["m"] < 60) & (q["s"] < 60) & q["epoch"].isNull()
        return F.struct(
            F.when(valid, wall).alias("wall_ms"),
            F.when(valid, q["offset"].cast("long") * 60_000).alias("offset_ms"),
            q["epoch"].alias("epoch_ms"),
        )

    return _let(whole, lambda s: _let(split(s), lambda p: _let(numbers(p), result)))


def wall_to_utc(wall_ms: Column, zone: Column | str) -> Column:
    """Wall clock (ms as if it were UTC) in a zone -> instant; independent of the session's zone."""
    return F.unix_millis(F.to_utc_timestamp(F.timestamp_millis(wall_ms), zone))


def utc_to_wall(utc_ms: Column, zone: Column | str) -> Column:
    return F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(utc_ms), zone))


def local_day(utc_ms: Column, zone: Column | str) -> Column:
    """Days since 1970 of the local calendar day."""
    return _whole(utc_to_wall(utc_ms, zone), 86_400_000).cast("int")


def to_utc(parsed: Column, zone: Column | str) -> Column:
    """The instant of a parsed value; ``zone`` is used only where the value names none."""
    return F.coalesce(
        parsed["epoch_ms"],
        parsed["wall_ms"] - parsed["offset_ms"],
        wall_to_utc(parsed["wall_ms"], zone),
    )


ZONES = ("UTC", "Europe/Berlin")


def violations(first_ms: Column, last_ms: Column, lo_ms: Column, hi_ms: Column, zone: str, slack_ms: int) -> Column:
    """How many ends of the wall-clock interval [first, last], read in ``zone``, lie outside of the instants [lo, hi] by more than the slack; unknown bounds allow anything."""
    early = F.coalesce(wall_to_utc(first_ms, zone) < lo_ms - slack_ms, F.lit(False))
    late = F.coalesce(wall_to_utc(last_ms, zone) > hi_ms + slack_ms, F.lit(False))
    return early.cast("long") + late.cast("long")


def _chosen(default: Column, votes: list[Column], zones: tuple[str, ...], least: int) -> Column:
    """struct(zone, violations): the stated zone, unless it has ``least`` violations or more and another one has less than half of them."""
    own = reduce(lambda c, vz: F.when(default == vz[1], vz[0]).otherwise(c), zip(votes, zones), F.lit(None).cast("long"))
    best = F.array_min(F.array(*[F.struct(v.alias("v"), F.lit(k).alias("k"), F.lit(z).alias("z")) for k, (v, z) in enumerate(zip(votes, zones))]))
    other = default.isNull() | ((own >= least) & (best["v"] * 2 < own))
    return F.struct(F.when(other, best["z"]).otherwise(default).alias("zone"), F.when(other, best["v"]).otherwise(own).alias("violations"))


def by_reference(rows: DataFrame, unit: list[str], wall_ms: str, ref_ms: str, default: str, zones: tuple[str, ...] = ZONES, slack_ms: int = 900_000, least: int = 3) -> DataFrame:
    """rows with ``zone`` and ``violations`` of their unit, by the rows of it that have a reference clock too.

    ``default`` is a column with the zone the source is said to use.  ``unit`` must bound a group (a
    station and day): rows are counted and marked in one pass, in one task per unit.  Rows of a unit
    without votes, or with a null in the unit, keep the default.
    """
    w = Window.partitionBy(*unit)
    wall, ref = F.col(wall_ms), F.col(ref_ms)
    each = [F.when(wall.isNotNull() & ref.isNotNull(), violations(wall, wall, ref, ref, z, slack_ms)) for z in zones]
    marked = rows.withColumns({f"_v{k}": v for k, v in enumerate(each)})
    known = reduce(lambda a, b: a & b, [F.col(u).isNotNull() for u in unit])
    votes = [F.when(known, F.coalesce(F.sum(f"_v{k}").over(w), F.lit(0))).otherwise(F.lit(0)) for k in range(len(zones))]
    out = marked.withColumns({f"_s{k}": v for k, v in enumerate(votes)}).withColumn("_c", _chosen(F.col(default), [F.col(f"_s{k}") for k in range(len(zones))], zones, least))
    drop = [f"_{x}{k}" for x in "vs" for k in range(len(zones))]
    return out.withColumns({"zone": F.col("_c.zone"), "violations": F.col("_c.violations")}).drop("_c", *drop)


def _doubtful(wall_ms: Column, zone: Column | str) -> Column:
    """A wall clock that the zone shows twice or not at all within an hour."""
    t = wall_to_utc(wall_ms, zone)
    return (utc_to_wall(t + 3_600_000, zone) == wall_ms) | (utc_to_wall(t, zone) != wall_ms)


def by_order(units: DataFrame, source: str, seq: str, first_ms: str, last_ms: str, default: str, zones: tuple[str, ...] = ZONES, slack_ms: int = 60_000, halo_ms: int = 21_600_000) -> DataFrame:
    """units (a session each: its first and last wall clock) with ``zone`` and ``violations``, by their neighbours in order of arrival.

    A unit lies between the end of the one before and the beginning of the one after, each read in its
    stated zone.  Another zone wins if the stated one breaks that and the other doesn't; where a neighbour
    could as well be the wrong one, the statement stands.  Wall clocks that the zone shows twice have no say.
    Windows hold a source's day and ``halo_ms`` around it, so a source with a third of all units is many tasks.
    Units with a null in source, order or walls keep the default.
    """
    day, stated = 86_400_000, lambda c: F.coalesce(*[F.when(F.col(default) == z, F.when(~_doubtful(c, z), wall_to_utc(c, z))) for z in zones])
    first, last = F.col(first_ms), F.col(last_ms)
    home = _whole(first, day)
    reach = F.array_distinct(F.array(home, _whole(first - halo_ms, day), _whole(last + halo_ms, day)))
    named = F.coalesce(F.col(source).cast("string"), F.lit(""))
    known = F.col(source).isNotNull() & F.col(seq).isNotNull() & first.isNotNull() & last.isNotNull()
    rest = units.filter(~known).withColumns({"zone": F.col(default), "violations": F.lit(0).cast("long")})
    rows = units.filter(known).withColumn("_day", F.explode(reach)).withColumns({"_own": F.col("_day") == home, "_a": stated(first), "_z": stated(last)})
    w = Window.partitionBy(named, "_day").orderBy(seq, first_ms)
    rows = rows.withColumns({"_lo": F.lag("_z").over(w), "_hi": F.lead("_a").over(w)})
    doubt = lambda c: reduce(lambda a, z: F.when(F.col(default) == z, _doubtful(c, z)).otherwise(a), zones, F.lit(False))
    a, z = F.when(~doubt(first), first), F.when(~doubt(last), last)
    rows = rows.withColumns({f"_v{k}": violations(a, z, F.col("_lo"), F.col("_hi"), zone, slack_ms) for k, zone in enumerate(zones)})
    rows = rows.withColumn("_c", _chosen(F.col(default), [F.col(f"_v{k}") for k in range(len(zones))], zones, 1))
    rows = rows.withColumn("_other", F.coalesce((F.col("_c.zone") != F.col(default)) & (F.col("_c.violations") == 0), F.lit(False)))
    alone = F.col("_other") & ~F.coalesce(F.lag("_other").over(w) | F.lead("_other").over(w), F.lag("_other").over(w), F.lead("_other").over(w), F.lit(False))
    own = reduce(lambda c, kz: F.when(F.col(default) == kz[1], F.col(f"_v{kz[0]}")).otherwise(c), enumerate(zones), F.lit(0).cast("long"))
    rows = rows.withColumn("_alone", alone).filter("_own")
    out = rows.withColumns({"zone": F.when(F.col("_alone"), F.col("_c.zone")).otherwise(F.col(default)), "violations": F.when(F.col("_alone"), F.lit(0).cast("long")).otherwise(own)})
    return out.select(*units.columns, "zone", "violations").unionByName(rest)


def between_known(rows: DataFrame, seq: str, wall_ms: str, known_ms: str, default: str, zones: tuple[str, ...] = ZONES, slack_ms: int = 1000, block: int = 4096, halo: int = 64, least: int = 3) -> DataFrame:
    """rows with ``zone`` and ``violations`` of their stretch of ``block`` arrivals: walls without zone must lie between the known instants around them.

    Rows near the border of a stretch are also seen, but not counted, by the next one.  Rows without ``seq`` keep the default.
    """
    s = F.col(seq).cast("long")
    home = _whole(s, block)
    rest = rows.filter(s.isNull()).withColumns({"zone": F.col(default), "violations": F.lit(0).cast("long")})
    near = rows.filter(s.isNotNull()).withColumn("_b", F.explode(F.array_distinct(F.array(home, _whole(s - halo, block), _whole(s + halo, block))))).withColumn("_own", F.col("_b") == home)
    order = Window.partitionBy("_b").orderBy(seq, known_ms)
    lo = F.last(known_ms, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    back = Window.partitionBy("_b").orderBy(F.desc(seq), F.desc(known_ms))
    hi = F.last(known_ms, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))
    near = near.withColumns({"_lo": lo, "_hi": hi})
    wall = F.when(F.col("_own") & F.col(known_ms).isNull(), F.col(wall_ms))
    w = Window.partitionBy("_b")
    near = near.withColumns({f"_v{k}": violations(wall, wall, F.col("_lo"), F.col("_hi"), z, slack_ms) for k, z in enumerate(zones)})
    near = near.withColumns({f"_s{k}": F.sum(f"_v{k}").over(w) for k in range(len(zones))})
    near = near.withColumn("_c", _chosen(F.col(default), [F.col(f"_s{k}") for k in range(len(zones))], zones, least)).filter("_own")
    return near.withColumns({"zone": F.col("_c.zone"), "violations": F.col("_c.violations")}).select(*rows.columns, "zone", "violations").unionByName(rest)


def history(rows: DataFrame, source: str, unit: str) -> DataFrame:
    """rows (source, unit, zone, violations) -> (source, von, bis, zone, violations, values): neighbouring units of one zone as one stretch.

    A source's units must be few (days); they are combined before the shuffle.
    """
    units = rows.filter(F.col(unit).isNotNull()).groupBy(source, unit).agg(F.min("zone").alias("zone"), F.max("violations").alias("violations"), F.count(F.lit(1)).alias("values"))
    w = Window.partitionBy(source).orderBy(unit)
    new = F.coalesce(F.lag("zone").over(w) != F.col("zone"), F.lit(True)).cast("int")
    runs = units.withColumn("_n", new).withColumn("_r", F.sum("_n").over(w))
    return runs.groupBy(source, "_r").agg(
        F.min(unit).alias("von"), F.max(unit).alias("bis"), F.min("zone").alias("zone"), F.sum("violations").alias("violations"), F.sum("values").alias("values")
    ).drop("_r")
