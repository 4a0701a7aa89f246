"""Log-line parsing as column expressions (whole-stage codegen, no UDF).

A line is stripped, then split on single spaces.  Tokens 0 and 1 form the
timestamp text, token 2 is the level, token 3 the component and the rest,
joined by single spaces, the message.  Fewer than four tokens is a parse
failure: only ``raw_log``/``source_file``/``collected_at`` and ``parse_error``
are set.  Empty tokens from double spaces are kept.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .constants import PARSE_ERROR_TEXT, TS_FORMAT

#: Digits of TS_FORMAT; the cast checks the values.
TS_SHAPE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"

#: A line that starts with such a text and has a level and a component (three spaces at least).
LINE_SHAPE = TS_SHAPE.replace(r"\z", r" [^ ]* ")

# Characters removed by Python's str.strip() (str.isspace() set).
_WS = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
       "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def stripped(col: Column) -> Column:
    """Remove leading/trailing whitespace like ``str.strip`` (a character-set
    trim, much cheaper than a regular expression)."""
    return F.btrim(col, F.lit(_WS))


def is_blank(col: Column) -> Column:
    return F.length(stripped(col)) == 0


def parsed_struct(line: Column) -> Column:
    """Struct of the parsed fields for one raw line.

    ``split(s, ' ', 5)`` yields the four leading tokens and, as fifth element,
    the untouched remainder — equal to joining tokens 5.. with single spaces.
    """
    s = stripped(line)
    parts = F.split(s, " ", 5)
    ok = F.size(parts) >= 4
    tok = lambda i: F.try_element_at(parts, F.lit(i))  # noqa: E731  (1-based)
    return F.struct(
        F.when(ok, F.concat_ws(" ", tok(1), tok(2))).alias("timestamp"),
        F.when(ok, tok(3)).alias("log_level"),
        F.when(ok, tok(4)).alias("component"),
        F.when(ok, F.coalesce(tok(5), F.lit(""))).alias("message"),
        s.alias("raw_log"),
        F.when(~ok, F.lit(PARSE_ERROR_TEXT)).alias("parse_error"),
    )


def parse_lines(df: DataFrame, line_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Drop blank lines and parse the rest.  ``keep`` columns are carried along
    (e.g. ``source_file``, ``collected_at``)."""
    keep = keep or []
    p = parsed_struct(F.col(line_col)).alias("p")
    return (df.where(~is_blank(F.col(line_col)))
              .select(*keep, p)
              .select(*keep, "p.timestamp", "p.log_level", "p.component", "p.message",
                      "p.raw_log", "p.parse_error"))


def event_time(ts_text: Column) -> Column:
    """Typed event time: null unless the text is exactly ``yyyy-MM-dd HH:mm:ss``.
    Cast straight to TIMESTAMP_NTZ, so hours the session zone skips stay as written."""
    return F.when(ts_text.rlike(TS_SHAPE), ts_text.try_cast("timestamp_ntz"))


def line_time(stripped_line: Column) -> Column:
    """:func:`event_time` of the timestamp that :func:`parsed_struct` finds in a
    stripped line, without splitting it: a filter on it is pushed down to the raw
    lines, where the tokens would be made anew for each mention."""
    return F.when(stripped_line.rlike(LINE_SHAPE), F.substring(stripped_line, 1, 19).try_cast("timestamp_ntz"))


def zoned(ts: Column) -> Column:
    """The instant that reads as ``ts`` in UTC, for watermarks (they need a zoned
    TIMESTAMP); keeps order and gaps in every session zone."""
    part = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long") % 1_000_000
    return F.timestamp_micros(epoch_seconds(ts) * 1_000_000 + part)


def from_zoned(at: Column) -> Column:
    """Inverse of :func:`zoned`."""
    seconds = (F.unix_micros(at).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970-01-01 of a TIMESTAMP_NTZ (fractions cut), independent of
    the session zone: ``timestamp_diff`` would read the fields in that zone."""
    day = F.date_diff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return day * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def ts_text(ts: Column) -> Column:
    return F.date_format(ts, TS_FORMAT)
