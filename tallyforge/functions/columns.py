"""Column expressions. All of them are native Spark expressions, so they stay inside
whole-stage code generation and can be pushed down where Spark knows how."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

# Month names in calendar order.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# Country codes kept as they are, and the codes counted as Europe.
KEPT_COUNTRIES = ("GB", "US", "IN", "UNKNOWN")
EUROPEAN_COUNTRIES = (
    "BE", "BG", "CZ", "DK", "DE", "EE", "IE", "EL", "ES", "FR", "HR", "IT", "CY", "LV", "LT", "LU",
    "HU", "MT", "NL", "AT", "PL", "PT", "RO", "SI", "SK", "FI", "SE", "CH", "IS", "NO", "LI", "EU",
)

# Fixed values: (share in percent that must be exceeded, score), highest first.
ENGAGEMENT_BUCKETS = ((90.0, 10), (50.0, 4), (25.0, 2))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_timestamp(df: DataFrame, name: str) -> Column:
    """The column as a timestamp. Text that is no timestamp becomes null instead of failing."""
    kind = dict(df.dtypes)[name]
    if kind == "string":
        return F.try_to_timestamp(F.col(name))
    return F.col(name)


def as_double(df: DataFrame, name: str) -> Column:
    """The column as a double. Text that is no number becomes null instead of failing."""
    kind = dict(df.dtypes)[name]
    return F.col(name).try_cast("double") if kind == "string" else F.col(name).cast("double")


def month_name(ts: Column | str) -> Column:
    """English month name."""
    return F.date_format(_col(ts), "MMMM")


def month_number(name: Column | str) -> Column:
    """Zero-based number of an English month name (January = 0). A bad name raises."""
    return F.month(F.to_date(_col(name), "MMMM")) - 1


def try_month_number(name: Column | str) -> Column:
    """As :func:`month_number`, but null for a bad name."""
    return F.month(F.try_to_timestamp(_col(name), F.lit("MMMM"))) - 1


def name_of_month(number: Column | str) -> Column:
    """Month name of a calendar number 1..12; null for null."""
    index = _col(number).cast("int")
    return F.when(index.isNotNull(), F.element_at(F.array(*[F.lit(m) for m in MONTHS]), index))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, null where the denominator is zero."""
    return F.try_divide(_col(numerator), _col(denominator))


def scaled(c: Column | str, factor: float = 100) -> Column:
    return _col(c) * F.lit(factor)


def percentage(part: Column | str, whole: Column | str) -> Column:
    return F.try_divide(F.lit(100.0) * _col(part), _col(whole))


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def zero_nulls(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Null becomes 0 in the named columns, in one projection."""
    return df.withColumns({c: zero_if_null(c) for c in cols})


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    """Null and NaN become ``value`` in every numeric column; other columns stay."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.na.fill(value, subset=numeric) if numeric else df


def at_least(c: Column | str, bound: float) -> Column:
    """1 where the value reaches ``bound``, else 0 (null counts as 0)."""
    return F.when(_col(c) >= bound, F.lit(1)).otherwise(F.lit(0))


def not_above(c: Column | str, bound: float = 0) -> Column:
    """0 where the value exceeds ``bound``, else 1 (null counts as 1)."""
    return F.when(_col(c) > bound, F.lit(0)).otherwise(F.lit(1))


def bucket_score(
    share: Column | str,
    buckets: Sequence[tuple[float, int]] = ENGAGEMENT_BUCKETS,
    default: int = 0,
) -> Column:
    """Score of the first bucket whose bound the share exceeds."""
    share = _col(share)
    score = F.lit(default)
    for bound, value in sorted(buckets):
        score = F.when(share > bound, F.lit(value)).otherwise(score)
    return score


def country_group(country: Column | str) -> Column:
    """Kept codes as they are, European codes as EUROPE, all others as OTHER."""
    country = _col(country)
    return (
        F.when(country.isin(*KEPT_COUNTRIES), country)
        .when(country.isin(*EUROPEAN_COUNTRIES), F.lit("EUROPE"))
        .otherwise(F.lit("OTHER"))
    )


def letters_only(text: Column | str) -> Column:
    """Lower-case text without anything but ASCII letters and spaces."""
    return F.lower(F.regexp_replace(_col(text), "[^a-zA-Z ]", ""))


def words_of(text: Column | str) -> Column:
    """Array of the space-separated words; holds empty strings where spaces repeat."""
    return F.split(letters_only(text), " ")


def field(line: Column | str, n: int, sep: str = ",") -> Column:
    """The n-th (from 1) separated field of a line."""
    return F.split_part(_col(line), F.lit(sep), F.lit(n))


def text_of(binary: Column | str) -> Column:
    return _col(binary).cast("string")


def rounded(c: Column | str, digits: int = 2) -> Column:
    return F.round(_col(c), digits)
