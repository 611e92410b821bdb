"""Column rules whose results differ between engines, each pinned to one meaning.

All functions take and return Columns, so they stay inside code generation.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the business's local time zone.
LOCAL_ZONE = "America/Mexico_City"
# Fixed value: the date that stands for "no end".
OPEN_END = "2100-01-01"
# Labels of the three size bands and their open top.
SIZE_BANDS = ((10, "1 - 9"), (20, "10 - 19"), (50, "20 - 49"))
SIZE_TOP = "50 or more"
# Fixed value: sales tax divisor on a copay.
TAX_DIVISOR = Decimal("1.16")


def _extreme(pick, cols: Sequence[Column], null_policy: str) -> Column:
    if null_policy not in ("skip", "propagate"):
        raise ValueError("null_policy is 'skip' or 'propagate'")
    picked = pick(*cols)
    if null_policy == "skip":
        return picked
    any_null = cols[0].isNull()
    for c in cols[1:]:
        any_null = any_null | c.isNull()
    return F.when(~any_null, picked)


def least_of(*cols: Column, null_policy: str = "skip") -> Column:
    """Smallest argument. ``skip`` ignores NULLs; ``propagate`` is NULL once any argument is."""
    return _extreme(F.least, cols, null_policy)


def greatest_of(*cols: Column, null_policy: str = "skip") -> Column:
    return _extreme(F.greatest, cols, null_policy)


def money(cents: Column) -> Column:
    """Integer cents as an exact decimal amount."""
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def to_money(amount: Column) -> Column:
    """A float amount rounded half up to cents, as a decimal, so that sums are exact."""
    return amount.cast("decimal(18,2)")


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL where den is zero or either side is NULL."""
    return F.try_divide(num, den)


def trunc_digits(x: Column, digits: int) -> Column:
    """Cut (towards zero) after ``digits`` decimals."""
    scaled = x.cast("decimal(28,10)") * F.lit(Decimal(10) ** digits)
    whole = F.when(scaled >= 0, F.floor(scaled)).otherwise(F.ceil(scaled))
    return (whole.cast("decimal(24,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(28,{digits})")


def date_diff(end: Column, start: Column, unit: str) -> Column:
    """DAY counts days; MONTH and YEAR count calendar boundaries crossed, not whole units."""
    if unit == "DAY":
        return F.datediff(end, start)
    years = F.year(end) - F.year(start)
    if unit == "YEAR":
        return years
    if unit == "MONTH":
        return years * 12 + F.month(end) - F.month(start)
    raise ValueError(unit)


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from start to end (both timestamps of one kind)."""
    return F.floor((F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(60_000_000))


_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
_MICROSECOND = "interval '0.000001' second"
_DAY_MICROS = 86_400_000_000


def _local_micros(ts: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` as microseconds since 1970-01-01 00:00 there. All in long arithmetic: the zone's name
    is read once, not for every row, and no decimal is made."""
    since = F.call_function("div", ts.cast("timestamp_ntz") - F.expr(_EPOCH), F.expr(_MICROSECOND))
    utc = F.when(F.typeof(ts) == "timestamp", F.unix_micros(ts.cast("timestamp"))).otherwise(since)
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(utc), zone))


def local_time(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """An instant, or a zone-less timestamp in UTC, as wall-clock time in ``zone``.

    Neither depends on the session's zone: an instant is counted from the epoch, not read off the session's clock.
    """
    return F.expr(_EPOCH) + F.expr(_MICROSECOND) * _local_micros(ts, zone)


def local_date(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """The day of ``local_time``, of whose microseconds whole days are cut (downwards, also before 1970)."""
    micros, day = _local_micros(ts, zone), F.lit(_DAY_MICROS)
    return F.date_from_unix_date(F.call_function("div", micros - F.pmod(micros, day), day).cast("int"))


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def days_in_month(d: Column) -> Column:
    return F.dayofmonth(F.last_day(d))


def size_band(n: Column) -> Column:
    """Head count to band. Zero counts as the lowest band and NULL as the top one."""
    out = None
    for upper, label in SIZE_BANDS:
        out = F.when(n < upper, label) if out is None else out.when(n < upper, label)
    return out.otherwise(SIZE_TOP)


def range_band(x: Column, bands: Sequence[tuple[float | None, float | None, str]], default: str = "Unknown") -> Column:
    """Closed ranges in order; a None bound is open. Values between two ranges get the default."""
    out = None
    for low, high, label in bands:
        cond = F.lit(True)
        if low is not None:
            cond = cond & (x >= low)
        if high is not None:
            cond = cond & (x <= high)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default)


def sentinel_to_null(df: DataFrame, columns: Sequence[str], also_empty: Sequence[str] = (), sentinel: str = "None") -> DataFrame:
    """Turn the source's textual null marker (and '' in ``also_empty``) into NULL."""
    cleaned = {}
    for name in columns:
        c = F.nullif(F.col(name), F.lit(sentinel))
        cleaned[name] = F.nullif(c, F.lit("")) if name in also_empty else c
    return df.withColumns(cleaned)


def number_text(x: Column) -> Column:
    """Text of a float without a trailing '.0'."""
    return F.regexp_replace(x.cast("string"), r"\.0$", "")


def thousands(x: Column) -> Column:
    """Whole number with grouping commas."""
    return F.format_number(x.cast("bigint"), 0)


def json_text(js: Column, key: str) -> Column:
    """A top-level JSON field as unquoted text."""
    return F.get_json_object(js, f"$.{key}")


def nonempty(arr: Column) -> Column:
    """An empty array counts as no array."""
    return F.when(F.size(arr) > 0, arr)


def joined(arr: Column, sep: str = ", ") -> Column:
    return F.array_join(nonempty(arr), sep)


def signed(amount: Column, code: Column, negative_codes: Sequence[str]) -> Column:
    """Amount with its sign flipped for the given codes."""
    return F.when(code.isin(*negative_codes), -amount).otherwise(amount)


def round_ratio(num: Column, den: Column, digits: int) -> Column:
    """Decimal num / den rounded half up; NULL where den is zero."""
    return F.round(F.try_divide(num.cast("decimal(24,2)"), den.cast("decimal(24,2)")), digits)


# Characters after which a word starts when text is title-cased, besides white space.
TITLE_BREAKS = r"""\s\[\](){}/|<>!?@"^#$&~_,.:;*%+\-"""


def title_text(s: Column) -> Column:
    """Upper-case the first letter of each word, lower-case the rest; punctuation separates words too."""
    words = F.split(F.lower(s), f"(?<=[{TITLE_BREAKS}])")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), "")
