"""Statistics over the days before a row's own day, counted in days that occur in the data."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.operators.joins import join_groups
from lanewise.sources.tables import stage, stage_all


def calendar_index(df: DataFrame, date_col: str, out: str = "index") -> DataFrame:
    """One row per distinct date with its position, counting from 1; a null date comes first.

    The numbering runs in one task, over distinct dates only. That is why the column must be a date: the whole
    range of the type has under 3.7 million values, however many rows there are.
    """
    if not isinstance(df.schema[date_col].dataType, T.DateType):
        raise TypeError(f"{date_col} must be a date, not {df.schema[date_col].dataType.simpleString()}")
    dates = df.select(date_col).distinct()
    return dates.withColumn(out, F.row_number().over(Window.orderBy(F.col(date_col).asc_nulls_first())))


def with_calendar_index(df: DataFrame, calendar: DataFrame, date_col: str) -> DataFrame:
    """Add the calendar's index to the rows; rows without a date drop out."""
    return df.join(F.broadcast(calendar), date_col)


# A statistic is built from parts that can be merged over days. Spread is carried as each day's squared distances from its
# own mean, and as the days' means measured from the mean of their group, so that neither large values nor groups at
# different levels cancel out.
_PARTS = {"n": F.count, "total": F.sum, "low": F.min, "high": F.max, "m2": lambda x: F.var_pop(x) * F.count(x)}
_MERGE = {"n": F.sum, "total": F.sum, "low": F.min, "high": F.max, "within": F.sum, "moved": F.sum}


def _average(part) -> Column:
    return F.when(part("n") > 0, part("total").cast("double") / part("n"))


def _stddev(part) -> Column:
    spread = part("within") - part("moved") * part("moved") / part("n")
    return F.when(part("n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (part("n") - 1)))


_STATS = {
    "avg": (("n", "total"), _average),
    "sum": (("total",), lambda part: part("total")),
    "count": (("n",), lambda part: F.coalesce(part("n"), F.lit(0))),
    "min": (("low",), lambda part: part("low")),
    "max": (("high",), lambda part: part("high")),
    "stddev": (("n", "total", "m2"), _stddev),
}


def trailing_name(stat: str, days: tuple[int, int], value: str, group: list[str]) -> str:
    return "_".join([stat, *map(str, days), value, *group])


#: Positions in a range from which prefixes are cheaper than a frame that is gathered anew for each row.
WIDE = 128
_SUMS = ("avg", "sum", "count")


def _takes_prefix(strategy: str, stat: str, days: tuple[int, int], kind: T.DataType) -> bool:
    """The rule of `strategy`: "auto" takes prefixes for wide ranges where they give the very same numbers as a frame does.

    That is so for least and greatest values and for counts of any type, and for sums of whole numbers; a difference of two
    sums of fractions has other last digits. Spread is always taken from frames.
    """
    if strategy not in ("auto", "window", "prefix"):
        raise ValueError(f"strategy must be auto, window or prefix, not {strategy}")
    if strategy == "window" or stat == "stddev":
        return False
    exact = stat in ("count", "min", "max") or isinstance(kind, T.IntegralType)
    return strategy == "prefix" or exact and days[1] - days[0] + 1 >= WIDE


def trailing_stats(
    df: DataFrame,
    values: list[str],
    groups: list[list[str]],
    ranges: list[tuple[int, int]],
    date_col: str,
    stat: str | list[str] = "avg",
    default: float | None = 1.0,
    index_col: str = "index",
    strategy: str = "auto",
    known_by: str | None = None,
    to: DataFrame | None = None,
) -> DataFrame:
    """Add a statistic of each value per group and range of days, named by `trailing_name`.

    A range such as (-28, -1) reaches from 28 to 1 positions before the row's date in `calendar_index`, so a
    row's own day is never in it. Null group values form groups. Where a range holds no value, `default` is
    taken (a count is 0 there already). Rows without a date drop out.

    `known_by` names a column with the date on which a row's values became known. A statistic then takes only values known
    on or before the row's own day, so that it looks at nothing that lay ahead; values without such a date are never taken.
    Only avg, sum and count can be had that way.

    `to` holds the rows that the statistics are added to, where these are not all of `df`: what they are taken from stays `df`.

    `strategy` says how ranges are gathered: "window" by frames, "prefix" by prefix sums, and for least and greatest values by
    a table of ranges whose lengths are powers of two; "auto" by the rule of `_takes_prefix`.

    Per grouping the rows are reduced to one per day and group, in a pass that combines before the shuffle. Windows run over
    those, where a group has at most one row per day: the size of a group in rows does not matter. The groupings are worked
    on side by side and staged, so the rows themselves are joined with tables of known size and need no shuffle as long as
    these are small. `df` is read once for each grouping and twice more: stage it first unless it is a table.
    """
    stats = [stat] if isinstance(stat, str) else list(stat)
    unknown = [name for name in stats if name not in _STATS]
    if unknown:
        raise ValueError(f"unknown statistic {', '.join(unknown)}; known: {', '.join(_STATS)}")
    if known_by is not None and set(stats) - set(_SUMS):
        raise ValueError(f"with known_by only {', '.join(_SUMS)} can be had")
    part_names = list(dict.fromkeys([*(["n"] if known_by else []), *(part for name in stats for part in _STATS[name][0])]))
    calendar = stage(calendar_index(df, date_col, index_col), name="calendar")
    dated = with_calendar_index(df, calendar, date_col)
    if known_by is not None:
        dated = _with_known_index(dated, calendar, date_col, known_by, index_col)

    summaries, keys = {}, {}
    for group in groups:
        if known_by is None:
            summary = _summary(dated, values, group, ranges, stats, part_names, index_col, strategy, default)
        else:
            summary = _known_summary(dated, values, group, ranges, stats, part_names, index_col, default)
        name = "trailing-" + "-".join(group)
        summaries[name], keys[name] = summary, [index_col, *group]

    result = with_calendar_index(df if to is None else to, calendar, date_col)
    for name, summary in stage_all(summaries).items():
        result = join_groups(result, summary, keys[name])
    return result


def _part_col(number: int, part: str) -> str:
    return f"__{part}_{number}"


def _or_default(statistic: Column, default: float | None, value: T.DataType, stat: str) -> Column:
    return statistic if default is None else F.coalesce(statistic, F.lit(default).cast(_result_type(value, stat)))


def _summary(dated, values, group, ranges, stats, part_names, index_col, strategy, default) -> DataFrame:
    """One row per day and group with the statistics of each value and range."""
    parts = [_PARTS[part](F.col(value)).alias(_part_col(number, part)) for number, value in enumerate(values) for part in part_names]
    per_day = dated.groupBy(index_col, *group).agg(*parts)
    whole = Window.partitionBy(*group)
    if "m2" in part_names:
        for number in range(len(values)):
            n, total, m2 = (F.col(_part_col(number, part)) for part in ("n", "total", "m2"))
            mean = F.when(n > 0, total.cast("double") / n)
            per_day = per_day.withColumn("__level", mean - F.avg(mean).over(whole))
            per_day = per_day.withColumn(_part_col(number, "moved"), n * F.col("__level"))
            per_day = per_day.withColumn(_part_col(number, "within"), m2 + n * F.col("__level") * F.col("__level"))
    statistics, extremes = [], []
    for number, value in enumerate(values):
        kind = dated.schema[value].dataType
        for days in ranges:
            for name in stats:
                out = trailing_name(name, days, value, group)
                prefix = _takes_prefix(strategy, name, days, kind)
                if prefix and name in ("min", "max"):
                    extremes.append((out, _part_col(number, _STATS[name][0][0]), name, days, kind))
                    continue
                part = _by_prefix(whole, index_col, number, days) if prefix else _by_frame(whole, index_col, number, days)
                statistics.append(_or_default(_STATS[name][1](part), default, kind, name).alias(out))
    if not extremes:
        return per_day.select(index_col, *group, *statistics)
    held = list(dict.fromkeys(column for _, column, _, _, _ in extremes))
    found = stage(per_day.select(index_col, *group, *held, *statistics), name="days")
    tables = {}
    for _, column, name, _, _ in extremes:
        widest = max(days[1] - days[0] + 1 for _, other, stat, days, _ in extremes if (other, stat) == (column, name))
        if (column, name) not in tables:
            tables[column, name] = _range_table(found, column, name, widest, group, index_col)
    tables = dict(zip(tables, stage_all({f"ranges-{number}": table for number, table in enumerate(tables.values())}).values()))
    for out, column, name, days, kind in extremes:
        found = _with_extreme(found, tables[column, name], out, name, days, group, index_col)
        found = found.withColumn(out, _or_default(F.col(f"`{out}`"), default, kind, name))
    return found.drop(*held)


def _by_frame(whole, index_col: str, number: int, days: tuple[int, int]):
    window = whole.orderBy(index_col).rangeBetween(*days)
    return lambda part: _MERGE[part](F.col(_part_col(number, part))).over(window)


def _by_prefix(whole, index_col: str, number: int, days: tuple[int, int]):
    """A sum over a range is the sum up to its end less the sum up to its start; both frames only ever grow."""

    def up_to(take, part: str, last: int) -> Column:
        return take(F.col(_part_col(number, part))).over(whole.orderBy(index_col).rangeBetween(Window.unboundedPreceding, last))

    def part(name: str) -> Column:
        """Null, not zero, where the range holds no value."""
        inside = up_to(F.sum, name, days[1]) - F.coalesce(up_to(F.sum, name, days[0] - 1), F.lit(0))
        return F.when(up_to(F.count, name, days[1]) > up_to(F.count, name, days[0] - 1), inside)

    return part


def _range_table(rows: DataFrame, column: str, name: str, widest: int, group: list[str], index_col: str) -> DataFrame:
    """Per day of a group, by rank: the least or greatest value of the 1, 2, 4, ... days up to it, each from two of the one before."""
    pick = F.least if name == "min" else F.greatest
    order = Window.partitionBy(*group).orderBy(index_col)
    table = rows.select(*group, index_col, F.row_number().over(order).alias("__of"), F.col(column).alias("__power_0"))
    powers = range(widest.bit_length())
    for power in powers[1:]:
        below = F.col(f"__power_{power - 1}")
        table = table.withColumn(f"__power_{power}", pick(below, F.lag(below, 1 << (power - 1)).over(order)))
    return table.select(*group, "__of", F.array(*[f"__power_{power}" for power in powers]).alias("__ranges"))


def _with_extreme(rows: DataFrame, table: DataFrame, out: str, name: str, days: tuple[int, int], group: list[str], index_col: str) -> DataFrame:
    """Add the least or greatest value over a range: that of two of the table's, of the largest power that fits, which cover it."""
    order = Window.partitionBy(*group).orderBy(index_col)
    last = F.count(F.lit(1)).over(order.rangeBetween(Window.unboundedPreceding, days[1]))
    before = F.count(F.lit(1)).over(order.rangeBetween(Window.unboundedPreceding, days[0] - 1))
    asked = rows.withColumns({"__last": last, "__first": before + 1})
    size = F.col("__last") - F.col("__first") + 1
    power = F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))).cast("int")
    asked = asked.withColumn("__power", F.when(size > 0, power))
    asked = asked.withColumn("__mid", F.col("__first") + F.expr("cast(pow(2, __power) as long)") - 1)
    for at, end in (("__last", "__right"), ("__mid", "__left")):
        side = table.withColumnsRenamed({key: f"__key_{key}" for key in group} | {"__ranges": end})
        same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"__key_{key}")) for key in group], F.col(at) == F.col("__of"))
        asked = asked.join(side, same, "left").drop("__of", *[f"__key_{key}" for key in group])
    pick = F.least if name == "min" else F.greatest
    entries = [F.get(end, F.col("__power")) for end in ("__right", "__left")]
    return asked.withColumn(out, F.when(size > 0, pick(*entries))).select(*[F.col(f"`{column}`") for column in rows.columns], F.col(f"`{out}`"))


def _with_known_index(dated: DataFrame, calendar: DataFrame, date_col: str, known_by: str, index_col: str) -> DataFrame:
    """Add `__known`: the first position of the calendar on or after the day in `known_by`; null where there is none.

    Days between two of the calendar belong to the later one. They are spread out once, over distinct days.
    """
    if not isinstance(dated.schema[known_by].dataType, T.DateType):
        raise TypeError(f"{known_by} must be a date, not {dated.schema[known_by].dataType.simpleString()}")
    days = calendar.select(F.col(date_col).alias("__day"), F.col(index_col).alias("__known")).where("__day IS NOT NULL")
    asked = dated.select(F.col(known_by).alias("__day")).where("__day IS NOT NULL").distinct()
    marked = asked.select("__day", F.lit(None).cast("int").alias("__known")).unionByName(days)
    marked = marked.groupBy("__day").agg(F.max("__known").alias("__known"))
    ahead = Window.orderBy("__day").rowsBetween(0, Window.unboundedFollowing)
    known = stage(marked.select("__day", F.min("__known").over(ahead).alias("__known")), name="known")
    return dated.join(F.broadcast(known), F.col(known_by) == F.col("__day"), "left").drop("__day")


def _known_summary(dated, values, group, ranges, stats, part_names, index_col, default) -> DataFrame:
    """One row per day and group with statistics over values already known, by a sweep along the calendar.

    A value of day s, known from position k on, counts for the days from s - hi (or k, if later) to s - lo. It is added at the
    first of them and taken away after the last; what stands at a day is the running sum of these changes.
    """
    starts = dated.where("__known IS NOT NULL")
    days_of = dated.select(index_col, *group).distinct()
    found = None
    for lo, hi in ranges:
        first = F.greatest(F.col(index_col) - hi, F.col("__known"))
        after = F.col(index_col) - lo + 1
        parts = [_PARTS[part](F.col(value)).alias(_part_col(number, part)) for number, value in enumerate(values) for part in part_names]
        names = [_part_col(number, part) for number in range(len(values)) for part in part_names]
        spans = starts.withColumns({"__first": first, "__after": after}).where("__first < __after").groupBy(*group, "__first", "__after").agg(*parts)
        ends = F.explode(F.array(F.struct(F.col("__first").alias("at"), F.lit(1).alias("sign")), F.struct(F.col("__after").alias("at"), F.lit(-1).alias("sign"))))
        changes = spans.select(*group, *names, ends.alias("__end"))
        changes = changes.select(*group, F.col("__end.at").alias(index_col), *[(F.col("__end.sign") * F.coalesce(F.col(name), F.lit(0))).alias(name) for name in names], F.lit(False).alias("__asked"))
        zeros = days_of.select(*group, index_col, *[F.lit(0).alias(name) for name in names], F.lit(True).alias("__asked"))
        steps = changes.unionByName(zeros).groupBy(index_col, *group).agg(*[F.sum(name).alias(name) for name in names], F.max("__asked").alias("__asked"))
        along = Window.partitionBy(*group).orderBy(index_col).rowsBetween(Window.unboundedPreceding, 0)
        steps = steps.select(index_col, *group, "__asked", *[F.sum(name).over(along).alias(name) for name in names]).where("__asked")
        statistics = []
        for number, value in enumerate(values):
            kind = dated.schema[value].dataType
            for name in stats:
                n = F.col(_part_col(number, "n"))
                part = lambda part, number=number, n=n: F.col(_part_col(number, part)) if part == "n" else F.when(n > 0, F.col(_part_col(number, part)))
                statistics.append(_or_default(_STATS[name][1](part), default, kind, name).alias(trailing_name(name, (lo, hi), value, group)))
        one = steps.select(index_col, *group, *statistics)
        found = one if found is None else join_groups(found, one, [index_col, *group])
    return found


def _result_type(value: T.DataType, stat: str) -> T.DataType:
    if stat in ("avg", "stddev"):
        return T.DoubleType()
    if stat == "count":
        return T.LongType()
    if stat == "sum":
        return T.LongType() if isinstance(value, T.IntegralType) else T.DoubleType()
    return value
