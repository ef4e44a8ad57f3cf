"""Column expressions for raw review fields.

All parsers are built-in Spark expressions (no Python worker). Unparseable input
gives null instead of an error, which is what the reference intended but does
not get under ANSI mode (Spark 4 default).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from revue.fixed import NUMERIC, PRICE_MISSING, PRICE_STRIP, TITLE_DROP, VOTES


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_price(raw: str | Column) -> Column:
    """null / '' / 'unknown' -> null; keep digits and dots; must then be numeric."""
    raw = _c(raw)
    digits = F.regexp_replace(raw, PRICE_STRIP, "")
    return (
        F.when(raw.isNull() | raw.isin(*PRICE_MISSING), F.lit(None).cast("double"))
        .when(digits.rlike(NUMERIC), digits.try_cast("double"))
    )


def parse_rating(raw: str | Column, fraction_scale: float = 1.0) -> Column:
    """'a/b' -> a/b (null when b is '0' or unparseable); numeric text -> float; else null.

    ``fraction_scale`` multiplies the fraction form (1.0 keeps the reference's
    mixed scale, where '4/5' is 0.8 but '4' is 4.0).
    """
    raw = _c(raw)
    parts = F.split(raw, "/")
    num = F.get(parts, 0).try_cast("double")
    den = F.get(parts, 1).try_cast("double")
    frac = F.try_divide(num, den)
    if fraction_scale != 1.0:
        frac = frac * F.lit(float(fraction_scale))
    return (
        F.when(raw.contains("/"),
               F.when(F.get(parts, 1) == "0", F.lit(None).cast("double")).otherwise(frac))
        .when(raw.rlike(NUMERIC), raw.try_cast("float").cast("double"))
    )


def parse_helpfulness(raw: str | Column) -> Column:
    """'a/b' -> a as int; anything else -> null."""
    raw = _c(raw)
    return F.when(raw.rlike(VOTES), F.get(F.split(raw, "/"), 0).try_cast("int"))


def normalise_title(title: str | Column) -> Column:
    """coalesce(title, '') -> lower -> drop everything but ASCII letters, digits, blanks."""
    return F.regexp_replace(F.lower(F.coalesce(_c(title), F.lit(""))), TITLE_DROP, "")


def tokenize(text: str | Column) -> Column:
    """Lower-case, split on single blank characters like ``ml.feature.Tokenizer``.

    Java's ``String.split`` keeps leading and inner empty tokens and drops
    trailing ones; an all-blank string gives an empty array.
    """
    stripped = F.regexp_replace(F.lower(_c(text)), r"\s+$", "")
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, r"\s", -1))


# First and last day of the years 1 to 9999, in days from 1970-01-01.
EPOCH_DAYS = (-719162, 2932896)


def epoch_to_date(epoch_seconds: str | Column) -> Column:
    """Epoch seconds -> 'dd/MM/yyyy' (UTC calendar day); null, 0 or a day outside the years 1 to 9999 -> 'N/A'."""
    t = _c(epoch_seconds)
    number = F.floor(t / 86400)
    known = t.isNotNull() & (t != 0) & number.between(*EPOCH_DAYS)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.when(known, number).cast("int"))
    return F.coalesce(F.when(known, F.date_format(day, "dd/MM/yyyy")), F.lit("N/A"))


def label(name: str | Column, key: str | Column) -> Column:
    """Dashboard label 'name (key)'; null when name is null."""
    return F.concat(_c(name), F.lit(" ("), _c(key), F.lit(")"))
