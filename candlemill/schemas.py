"""Column layouts of the stored tables and files."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed value: header of a raw tick file, trailing blank included.
TICK_HEADER = ["Time (UTC)", "Open", "High", "Low", "Close", "Volume "]

TICK_COLUMNS = ["time", "open", "high", "low", "close", "volume"]
PRICE_COLUMNS = ["open", "high", "low", "close", "volume"]

# Schemas are matched to files by position, so plain names are used.
TICK_RAW = T.StructType([T.StructField(c, T.StringType()) for c in TICK_COLUMNS])

# Landing table with one column more than the file: it reads as NULL.
TICK_LANDING = T.StructType(
    [*TICK_RAW.fields, T.StructField("modified_timestamp", T.TimestampNTZType())]
)

TICK_PRICE = T.DecimalType(9, 5)

MONTH_BAR = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("prev_close", T.DoubleType()),
    ]
)

# Bars that carry their edge times can absorb late files.
TIMED_BAR = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("open_time", T.TimestampNTZType()),
        T.StructField("close_time", T.TimestampNTZType()),
    ]
)

DAY_BAR = T.StructType([T.StructField("day", T.DateType()), *TIMED_BAR.fields[2:]])

FILE_AUDIT = T.StructType(
    [
        T.StructField("checksum", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("market", T.StringType()),
        T.StructField("task_name", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("start_timestamp", T.TimestampNTZType()),
        T.StructField("lines", T.LongType()),
        T.StructField("instrument", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
    ]
)

# What a load saw in the files of one batch.
LOAD_METRICS = T.StructType(
    [
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("task_name", T.StringType()),
        T.StructField("files", T.LongType()),
        T.StructField("lines", T.LongType()),
        T.StructField("bad_lines", T.LongType()),
        T.StructField("bars", T.LongType()),
        T.StructField("tied_bars", T.LongType()),
    ]
)

# Rows of every flavour and mode in one layout; the flavours' own headings are not kept.
REPORT_CELLS = [f"m{m:02d}" for m in range(1, 13)] + ["total"]
REPORT_AUDIT = T.StructType(
    [
        T.StructField("instrument", T.StringType()),
        T.StructField("year", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in REPORT_CELLS],
        T.StructField("flavour", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("load_timestamp", T.TimestampNTZType()),
        T.StructField("task_name", T.StringType()),
    ]
)

# Month and weekday headings of the reports.
MONTHS_SHORT = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
MONTHS_LONG = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
