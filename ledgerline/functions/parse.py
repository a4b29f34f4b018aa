"""Column-level parsers. All are built-in Spark expressions (codegen'd,
no Python UDF), so they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import constants as C


#: A time of which every part has its full width.
FULL_WIDTH_TIME = r"^\d{8}T\d{6}\.\d{1,6}\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def matches(c: Column | str, pattern: str) -> Column:
    """Full-string regex test; NULL input counts as the empty string."""
    return F.coalesce(_col(c), F.lit("")).rlike(pattern)


def parse_amount(c: Column | str, dtype: str = C.AMOUNT_TYPE) -> Column:
    """Remove every '$' and ',' and try-cast to decimal(11,2). One underscore
    between two digits separates them and is dropped, as SQL literals allow.

    Unparseable or overflowing text gives NULL; rounding is half-up.
    """
    cleaned = F.replace(F.replace(_col(c), F.lit("$"), F.lit("")), F.lit(","), F.lit(""))
    plain = F.when(cleaned.contains("_"), F.regexp_replace(cleaned, r"(?<=[0-9])_(?=[0-9])", "")).otherwise(cleaned).try_cast(dtype)
    return F.when(~cleaned.rlike(r"[^\x00-\x7F]"), plain)      # other scripts' digits are no number


def parse_ts(c: Column | str) -> Column:
    """Parse ``YYYYMMDDTHHMMSS.f`` (1-6 fraction digits) to TIMESTAMP_NTZ.

    White space around the value is ignored, and month, day, hour, minute
    and second may have one digit: each takes two if it can. The shape is
    checked and brought to full width by one regex (upper-case T only); the
    calendar (Feb 29, hour 24, second 60, ...) by the strict datetime
    parser, which yields NULL for impossible dates. The text is read as UTC
    (explicit ``Z``) and the instant turned into a wall-clock value by adding
    its microseconds to the epoch, so the result does not depend on the
    session time zone. A value that has its full width already is cast as it
    is, without the regexes.
    """
    s = F.trim(_col(c), F.lit(" \t\n\x0b\f\r"))
    part = lambda at, n: F.substring(s, at, n)
    cast = F.concat(part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 5), F.lit(":"), part(12, 2), F.lit(":"),
                    part(14, 9)).try_cast("timestamp_ntz")
    # a zero before each part, of which the last two digits count
    wide = F.regexp_replace(s, C.TRANSACTION_TIME_RE, "$1-0$2-0$3T0$4:0$5:0$6.$7")
    full = F.regexp_replace(wide, r"([-T:])0(\d\d)(?=[-T:.])", "$1$2")
    instant = F.try_to_timestamp(F.concat(full, F.lit("Z")),
                                 F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    wall = F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)
    return F.when(s.rlike(FULL_WIDTH_TIME), cast).when(s.rlike(C.TRANSACTION_TIME_RE), wall)


def batch_date_of(path: Column | str, file_re: str) -> Column:
    """Batch date text (YYYYMMDD) from a file name/path; '' when no match."""
    return F.regexp_extract(_col(path), file_re, 1)


def batch_date_to_date(c: Column | str, strict: bool = True) -> Column:
    """Strict YYYYMMDD → DATE. With ``strict`` a bad value fails the query
    (ANSI), otherwise it becomes NULL."""
    fn = F.to_date if strict else F.try_to_date
    return fn(_col(c), "yyyyMMdd")


def md5_uuid(c: Column | str) -> Column:
    """UUID-shaped text (8-4-4-4-12) from the md5 of a string (one md5 per
    row: the dashes are inserted by a single regex replace)."""
    return F.regexp_replace(F.md5(_col(c)), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$",
                            "$1-$2-$3-$4-$5")
