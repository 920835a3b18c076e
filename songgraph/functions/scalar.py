"""Native column expressions (no Python UDF anywhere).

Two different "missing year" predicates exist on purpose: the exploration
query counts ``year = 0`` only, the imputation treats ``null or 0`` as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the nostalgia score: the listener's peak year is the year
# they turned 16, the bell width is 5 years, a song without a year scores
# -1e9, the default birth year is 1990.
PEAK_AGE = 16
SIGMA = 5.0
NO_YEAR_SCORE = -1e9
DEFAULT_BIRTH_YEAR = 1990


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def valid_year(year="year") -> Column:
    """FLT1: year known and not the sentinel 0 (null -> false)."""
    y = _c(year)
    return y.isNotNull() & (y != 0)


def missing_year(year="year") -> Column:
    """FLT2: year null or the sentinel 0."""
    y = _c(year)
    return y.isNull() | (y == 0)


def sql_year_known(year="year") -> Column:
    """FLT4: SQL ``year <> 0``; a null year is unknown, so the row is dropped."""
    return F.coalesce(_c(year) != 0, F.lit(False))


def not_nan(x) -> Column:
    """FLT5: SQL ``x <> 'NaN'``: drops NaN and null."""
    c = _c(x)
    return c.isNotNull() & ~F.isnan(c)


def nostalgia_score(year="year", birth_year=None) -> Column:
    """SC4: exp(-0.5 * ((year - (birth + 16)) / 5)^2); null year -> -1e9."""
    b = F.lit(DEFAULT_BIRTH_YEAR) if birth_year is None else _c(birth_year)
    y = _c(year)
    z = (y - (b + PEAK_AGE)) / F.lit(SIGMA)
    return (F.when(y.isNull(), F.lit(NO_YEAR_SCORE))
             .otherwise(F.exp(F.lit(-0.5) * z * z)))


def sql_nostalgia_score(year: str = '"year"', birth_year: str = "1990") -> str:
    return (f"CASE WHEN {year} IS NULL THEN -1e9 ELSE "
            f"exp(-0.5 * (({year} - ({birth_year} + 16)) / 5.0) "
            f"* (({year} - ({birth_year} + 16)) / 5.0)) END")


def log_duration(duration="duration") -> Column:
    """SC1 / PRJ6: ln(duration + 0.001); null where the argument is <= 0."""
    return F.log(_c(duration) + F.lit(1e-3))


def tempo_norm(tempo="tempo") -> Column:
    """PRJ6: tempo / 200."""
    return _c(tempo) / F.lit(200.0)


def round_year(pred="prediction") -> Column:
    """SC2: round a predicted year to an int; NaN/overflow -> null."""
    return F.expr(f"try_cast(round({pred}) AS int)") if isinstance(pred, str) \
        else F.round(pred).try_cast("int")


def first_of(df: DataFrame, name: str, kind: str = "double") -> Column:
    """SC11: the first element of an array column, or the value itself, as
    ``kind``; a value of the wrong type (or an empty array) gives null."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.ArrayType):
        value = F.get(value, 0)
    return value.try_cast(kind)


def clean_key(x) -> Column:
    """SC15: a key typed by a person, trimmed and in lower case; blank -> null."""
    return F.nullif(F.lower(F.trim(_c(x))), F.lit(""))
