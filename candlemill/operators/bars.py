"""Ticks to bars: open, close and edge times of every month or day.

A tick table has ``time``, ``open`` and ``close``; ``keys`` are further grouping
columns (an instrument), ``tie`` the columns that order ticks of equal time. A ``tie``
that maps whole numbers to their digits is packed with the time into one number, and bars
take one scan and no sort. Where time is unique, as in a tick file, none is needed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill.functions.periods import DAY, MONTH, period_columns
from candlemill.operators.order_key import MARKS, edge_marks, order_key, several_prices, tie_of_key
from candlemill.session import fresh_dir

BOUNDS = ("first_time", "last_time")


def with_period(ticks: DataFrame, period: Sequence[str] = MONTH) -> DataFrame:
    """Add the key columns of ``period``."""
    return ticks.withColumns(period_columns(F.col("time"), period))


def period_bounds(
    ticks: DataFrame, period: Sequence[str] = MONTH, keys: Sequence[str] = ()
) -> DataFrame:
    """First and last tick time of each period. Reads the time column alone."""
    return (
        with_period(ticks, period)
        .groupBy(*keys, *period)
        .agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"))
        .filter(F.col("first_time").isNotNull())
    )


def _at_bounds(ticks: DataFrame, period: Sequence[str], edges: Sequence[str]) -> DataFrame:
    """Ticks at a period's first or last time.

    The broadcast side holds at most two rows per calendar month or day, however
    many ticks there are. A month or day edge lies in one period only, so time
    alone is the join key.
    """
    times = period_bounds(ticks, period).select(
        F.explode(F.array(*edges)).alias("time")
    )
    return ticks.join(F.broadcast(times), "time", "left_semi")


def _timed(price: str) -> Column:
    """The time of a tick that has this price: a missing price decides no bar."""
    return F.when(F.col(price).isNotNull(), F.col("time"))


_HAS_EDGE = "open_time IS NOT NULL OR close_time IS NOT NULL"


def _at_keyed_bounds(
    ticks: DataFrame, period: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Ticks at the first or last time of a period of their key.

    The edges are a hash aggregation; how many there are grows with the keys, so Spark
    chooses the join by their size.
    """
    edges = period_bounds(ticks, period, keys)
    edges = edges.select(*[F.col(k).alias(f"_{k}") for k in keys], F.explode(F.array(*BOUNDS)).alias("_time"))
    same = F.col("time") == F.col("_time")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return ticks.join(edges, same, "left_semi")


def _edges_by_time(
    ticks: DataFrame,
    period: Sequence[str],
    keys: Sequence[str],
    more: Sequence[Column] = (),
    untimed: bool = False,
) -> DataFrame:
    """Bars of ticks with unique times: one hash aggregation.

    Ticks without a time are dropped afterwards, as the group without edge times, unless
    ``untimed``: a filter before would parse the time of a text file twice.
    """
    found = ticks.groupBy(*keys, *period).agg(
        F.min_by("open", _timed("open")).alias("open"),
        F.max_by("close", _timed("close")).alias("close"),
        F.min(_timed("open")).alias("open_time"),
        F.max(_timed("close")).alias("close_time"),
        *more,
    )
    return found if untimed else found.filter(_HAS_EDGE)


def _edges_by_tie(
    ticks: DataFrame, period: Sequence[str], keys: Sequence[str], tie: Sequence[str]
) -> DataFrame:
    """Bars of ticks whose times repeat. A struct as order makes Spark sort its input."""
    first = F.when(_timed("open").isNotNull(), F.struct("time", *tie, "open"))
    last = F.when(_timed("close").isNotNull(), F.struct("time", *tie, "close"))
    return (
        ticks.groupBy(*keys, *period)
        .agg(
            F.min_by("open", first).alias("open"),
            F.max_by("close", last).alias("close"),
            F.min(_timed("open")).alias("open_time"),
            F.max(_timed("close")).alias("close_time"),
        )
        .filter(_HAS_EDGE)
    )


def _edges_by_one_tie(ticks: DataFrame, period: Sequence[str], tie: str) -> DataFrame:
    """The same for one tie column and few times per period: settle each time first,
    then the period. Both steps are hash aggregations."""
    times = ticks.groupBy(*period, "time").agg(
        F.min_by("open", F.when(F.col("open").isNotNull(), F.col(tie))).alias("open"),
        F.max_by("close", F.when(F.col("close").isNotNull(), F.col(tie))).alias("close"),
    )
    return _edges_by_time(times, period, ())


def _edges_by_key(
    ticks: DataFrame, period: Sequence[str], keys: Sequence[str], tie: Mapping[str, int]
) -> DataFrame:
    """Bars of ticks whose times repeat, ordered by one number: a hash aggregation."""
    order = F.col("_order")
    rows = with_period(ticks, period).withColumn("_order", order_key("time", period, tie))
    return (
        rows.groupBy(*keys, *period)
        .agg(
            F.min_by("open", F.when(F.col("open").isNotNull(), order)).alias("open"),
            F.max_by("close", F.when(F.col("close").isNotNull(), order)).alias("close"),
            F.min(_timed("open")).alias("open_time"),
            F.max(_timed("close")).alias("close_time"),
        )
        .filter(_HAS_EDGE)
    )


def bars_with_marks(
    ticks: DataFrame,
    period: Sequence[str] = MONTH,
    keys: Sequence[str] = (),
    more: Sequence[Column] = (),
    untimed: bool = False,
) -> DataFrame:
    """:func:`bars` of ticks that should have unique times, with ``tied`` where they have not.

    One hash aggregation over one scan: extremes of time and price hash tell an edge with
    several prices. Its bar is to be settled by :func:`settled`.
    """
    found = bars(ticks, period, keys, more=[*more, *edge_marks()], untimed=untimed)
    return found.withColumn("tied", several_prices()).drop(*MARKS)


def settled(found: DataFrame, ticks: DataFrame, keys: Sequence[str], period: Sequence[str] = MONTH) -> DataFrame:
    """``found`` (of :func:`bars_with_marks`, stored) with its tied bars by time, then price.

    ``ticks`` are read again, cut to the edge times of the tied bars.
    """
    on = [*keys, *period]
    edges = found.filter("tied").select(*keys, F.explode(F.array("open_time", "close_time")).alias("time"))
    exact = bars_by_price(ticks.join(edges.distinct(), [*keys, "time"], "left_semi"), period, keys)
    exact = exact.select(*on, *[F.col(c).alias(f"_{c}") for c in ("open", "close", "tied")])
    joined = found.join(exact, on, "left")
    again = F.col("_tied").isNotNull()
    mended = {c: F.when(again, F.col(f"_{c}")).otherwise(F.col(c)) for c in ("open", "close", "tied")}
    return joined.withColumns(mended).select(*found.columns)


def _back(time: str) -> Column:
    """Falls as the time rises."""
    return F.lit(dt.datetime(9999, 12, 31, 23, 59, 59)).cast("timestamp_ntz") - F.col(time)


def bars_by_price(
    ticks: DataFrame, period: Sequence[str] = MONTH, keys: Sequence[str] = ()
) -> DataFrame:
    """Bars whose order is defined without a tie: by time, then by price.

    Where the first time of a period comes with several opens, the lowest is taken; of
    several closes at the last time, the highest. ``tied`` says whether there was such a
    choice. The order of the rows changes nothing. A struct as order makes Spark sort its
    input, so this is for a micro-batch or for ticks that are cut to the edges.
    """
    opens = F.when(_timed("open").isNotNull(), F.struct("time", "open"))
    closes = F.when(_timed("close").isNotNull(), F.struct("time", "close"))
    found = with_period(ticks, period).groupBy(*keys, *period).agg(
        F.min(opens).alias("_open"),
        F.max(closes).alias("_close"),
        F.max_by("open", F.when(opens.isNotNull(), F.struct(_back("time"), "open"))).alias("_high"),
        F.min_by("close", F.when(closes.isNotNull(), F.struct(_back("time"), "close"))).alias("_low"),
    )
    tied = (F.col("_open.open") != F.col("_high")) | (F.col("_close.close") != F.col("_low"))
    return found.select(
        *keys,
        *period,
        F.col("_open.open").alias("open"),
        F.col("_close.close").alias("close"),
        F.col("_open.time").alias("open_time"),
        F.col("_close.time").alias("close_time"),
        F.coalesce(tied, F.lit(False)).alias("tied"),
    ).filter(_HAS_EDGE)


def _bars_at(
    ticks: DataFrame, period: Sequence[str], tie: Sequence[str], edges: Sequence[str]
) -> DataFrame:
    """Bars of the ticks at the named edges; no ``tie`` means unique times."""
    rows = with_period(_at_bounds(ticks, period, edges), period)
    if not tie:
        return _edges_by_time(rows, period, ())
    if len(tie) == 1:
        return _edges_by_one_tie(rows, period, tie[0])
    return _edges_by_tie(rows, period, (), tie)


def bars(
    ticks: DataFrame,
    period: Sequence[str] = MONTH,
    keys: Sequence[str] = (),
    tie: Sequence[str] | Mapping[str, int] = (),
    more: Sequence[Column] = (),
    untimed: bool = False,
) -> DataFrame:
    """One row per key and period: open, close, open_time, close_time.

    With unique times this is a single hash aggregation whose partial step leaves
    one row per period and task, so a period with most of the ticks is no burden.
    So it is with a ``tie`` of whole numbers and their digits, whatever the keys.
    With any other ``tie`` the ticks are first cut to those at the period edges, by a second
    scan, and only those are put in order. With ``keys`` as well the number of edges
    has no bound, and the join that cuts the ticks is left to Spark.
    ``more`` adds aggregates over all ticks and goes with unique times; ``untimed`` keeps
    the group of the ticks without a time, for which there is no bar. A tick that lacks a
    price does not decide that price.
    """
    if not tie:
        return _edges_by_time(with_period(ticks, period), period, keys, more, untimed)
    if more or untimed:
        raise ValueError("aggregates over all ticks need ticks of unique time")
    if isinstance(tie, Mapping):
        return _edges_by_key(ticks, period, keys, tie)
    if keys:
        rows = with_period(_at_keyed_bounds(ticks, period, keys), period)
        return _edges_by_tie(rows, period, keys, tie)
    return _bars_at(ticks, period, tie, BOUNDS)


def _days_with_month(
    ticks: DataFrame, keys: Sequence[str], tie: Sequence[str]
) -> DataFrame:
    """Day bars with their month; of the days at a month's edge alone where times
    repeat, since the others cannot hold its open or close."""
    if tie and not keys and not isinstance(tie, Mapping):
        ticks = _at_bounds(ticks, MONTH, BOUNDS)
        days = _edges_by_tie(with_period(ticks, DAY), DAY, (), tie)
    else:
        days = bars(ticks, DAY, keys, tie)
    return days.withColumns(period_columns(F.col("day"), MONTH))


def month_bars_by_window(
    ticks: DataFrame, keys: Sequence[str] = (), tie: Sequence[str] = ()
) -> DataFrame:
    """Month bars with FIRST/LAST over a full frame, then one row kept per month.

    The window runs over day bars, at most 31 rows per month, not over ticks.
    """
    month = Window.partitionBy(*keys, *MONTH)
    frame = month.orderBy("day").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    return (
        _days_with_month(ticks, keys, tie)
        .select(
            *keys,
            *MONTH,
            F.first("open").over(frame).alias("open"),
            F.last("close").over(frame).alias("close"),
        )
        .dropDuplicates([*keys, *MONTH])
    )


MONTH_BARS_SQL = """
SELECT DISTINCT year, month,
       FIRST_VALUE(open) OVER (PARTITION BY year, month ORDER BY day) AS open,
       FIRST_VALUE(close) OVER (PARTITION BY year, month ORDER BY day DESC) AS close
FROM {days}
"""


def month_bars_by_sql(ticks: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Month bars with ascending and descending FIRST_VALUE and DISTINCT."""
    days = _days_with_month(ticks, (), tie)
    return ticks.sparkSession.sql(MONTH_BARS_SQL, days=days)


def last_ticks(
    ticks: DataFrame, period: Sequence[str] = MONTH, tie: Sequence[str] | Mapping[str, int] = ()
) -> DataFrame:
    """The last tick of each period, by ROW_NUMBER over descending time.

    Spark cuts every task to one row per period before the shuffle
    (WindowGroupLimit), so no period gathers in one task. With a ``tie`` of whole numbers
    and their digits the row is that of the greatest order instead, in a hash aggregation
    over one scan.
    """
    if isinstance(tie, Mapping):
        rows = with_period(ticks, period).withColumn("_order", order_key("time", period, tie))
        others = [c for c in ticks.columns if c != "time" and c not in tie]
        last = rows.filter(F.col("time").isNotNull()).groupBy(*period).agg(
            F.max("time").alias("time"),
            F.max("_order").alias("_order"),
            *[F.max_by(c, "_order").alias(c) for c in others],
        )
        kinds = dict(ticks.dtypes)
        found = tie_of_key(F.col("_order"), period, tie)
        return last.select(
            *period, *[found[c].cast(kinds[c]).alias(c) if c in tie else c for c in ticks.columns]
        )
    order = [F.desc(c) for c in ("time", *tie)]
    rank = F.row_number().over(Window.partitionBy(*period).orderBy(*order))
    return (
        with_period(_at_bounds(ticks, period, ["last_time"]), period)
        .withColumn("row_number", rank)
        .filter(F.col("row_number") == 1)
        .drop("row_number")
    )


def edge_ticks(
    ticks: DataFrame, period: Sequence[str] = MONTH, tie: Sequence[str] = ()
) -> DataFrame:
    """First and last tick of each period; a period with one tick gives two rows.

    One left-semi join on the edge times serves both edges; the tie columns settle ticks
    that share a time.
    """
    rows = with_period(_at_bounds(ticks, period, BOUNDS), period)
    order, tick = F.struct("time", *tie), F.struct(*ticks.columns)
    edges = rows.groupBy(*period).agg(
        F.array(
            F.struct(F.lit("first").alias("edge"), F.min_by(tick, order).alias("tick")),
            F.struct(F.lit("last").alias("edge"), F.max_by(tick, order).alias("tick")),
        ).alias("edges")
    )
    return edges.select(*period, F.explode("edges").alias("e")).select(*period, "e.tick.*", "e.edge")


def bars_by_join(
    ticks: DataFrame, period: Sequence[str] = MONTH, tie: Sequence[str] = ()
) -> DataFrame:
    """Bars as an inner join of first-tick and last-tick rows on the period keys.

    Both sides are parts of one set of edge ticks, computed once and stored.
    """
    ends = edge_ticks(ticks.select("time", "open", "close", *tie), period, tie)
    path = fresh_dir(ticks.sparkSession, "edges")
    ends.select(*period, "time", "open", "close", "edge").write.parquet(path)
    ends = ticks.sparkSession.read.parquet(path)
    first = ends.filter("edge = 'first'").select(*period, "open", F.col("time").alias("open_time"))
    last = ends.filter("edge = 'last'").select(*period, "close", F.col("time").alias("close_time"))
    return first.join(last, list(period)).select(
        *period, "open", "close", "open_time", "close_time"
    )


def repeated_times(ticks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Times that break the key of the tick table, with their number of rows."""
    return (
        ticks.groupBy(*keys, "time")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )
