"""Scalar cleaning rules (Column -> Column) for landing and silver data."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Four decimals cover every ISO 4217 currency, and 18 digits keep the value in
# one machine word, so sums stay exact and fast.
MONEY = T.DecimalType(18, 4)

# The characters Unicode counts as white space, in code order.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The words a CSV field may hold to mean "no value".
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Source wording of a payment method and its standard code.
METHOD_CODES = {
    "Swipe Transaction": "SWIPE",
    "Chip Transaction": "CHIP",
    "Online Transaction": "ONLINE",
}
UNKNOWN_METHOD = "UNKNOWN"
NO_ERROR = "NO_ERROR"


def strip_text(column: Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.btrim(column.cast("string"), F.lit(WHITESPACE))


def null_words_to_null(column: Column) -> Column:
    return F.when(~column.isin(*NULL_WORDS), column)


def parse_int64(column: Column, data_type: T.DataType) -> Column:
    """Whole number as bigint; text that is not a whole number becomes null."""
    if isinstance(data_type, T.IntegralType):
        return column.cast("bigint")
    text = strip_text(column)
    plain = F.regexp_extract(text, r"^([+-]?\d+)(?:\.0*)?$", 1)
    if isinstance(data_type, T.StringType):
        return F.when(plain != "", plain.try_cast("bigint"))
    exact = column.try_cast("decimal(38,6)")
    return F.when(column == F.floor(column), exact.try_cast("bigint"))


def parse_money(column: Column) -> Column:
    """``$1,234.50`` as an exact decimal; refunds stay negative, bad text is null."""
    text = F.replace(column.cast("string"), F.lit("$"), F.lit(""))
    text = F.replace(text, F.lit(","), F.lit(""))
    return strip_text(text).try_cast(MONEY)


def assemble_timestamp(year: Column, month: Column, day: Column, time: Column) -> Column:
    """Wall-clock timestamp from calendar parts and ``H:M`` text, null when invalid.

    The parts need not be zero-padded. The cast target has no zone, so the result
    does not depend on the session time zone.
    """
    year_text = year.cast("string")
    year_text = F.lpad(year_text, F.greatest(F.lit(4), F.length(year_text)), F.lit("0"))
    text = F.concat(
        year_text, F.lit("-"), month.cast("string"), F.lit("-"), day.cast("string"),
        F.lit(" "), strip_text(time),
    )
    shape = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}$"
    return F.when(text.rlike(shape), F.concat(text, F.lit(":00")).try_cast("timestamp_ntz"))


def method_code(column: Column) -> Column:
    text = strip_text(column)
    code = F.lit(UNKNOWN_METHOD)
    for wording, standard in METHOD_CODES.items():
        code = F.when(text == wording, F.lit(standard)).otherwise(code)
    return code


def zip_text(column: Column, data_type: T.DataType) -> Column:
    """Postal code as text without a decimal tail; null stays null."""
    if isinstance(data_type, T.FractionalType):
        value = column.cast("double")
        whole = F.when(value == F.floor(value), value.try_cast("bigint").cast("string"))
        return F.when(~F.isnan(value), F.coalesce(whole, value.cast("string")))
    return strip_text(F.regexp_replace(column.cast("string"), r"\.0$", ""))


def error_text(column: Column) -> Column:
    text = strip_text(column)
    return F.when(text != "", text).otherwise(F.lit(NO_ERROR))


def has_error(column: Column) -> Column:
    return F.coalesce(column, F.lit(NO_ERROR)) != NO_ERROR


def fraud_flag(column: Column) -> Column:
    text = strip_text(column)
    return F.when(text == "Yes", True).when(text == "No", False)


def date_key(column: Column) -> Column:
    """Calendar day as the number yyyymmdd."""
    return (F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)).cast("bigint")


# ---------------------------------------------------------------- aggregates


def money(column: Column) -> Column:
    return column.cast(MONEY)


def round2(column: Column) -> Column:
    """An exact decimal rounded half up, as double."""
    return F.round(column, 2).cast("double")


def whole(column: Column) -> Column:
    """A count or an amount in ten-thousandths, as a whole number."""
    return (column.cast("decimal(24,4)") * 10000).cast("decimal(28,0)")


def quotient2(numerator: Column, denominator: Column) -> Column:
    """Quotient of two whole numbers with two decimals, rounded half up exactly once.

    Null when the denominator is zero or missing. No intermediate value is rounded: the
    remainder of the whole-number division decides.
    """
    top = (F.abs(numerator).cast("decimal(36,0)") * 200).cast("decimal(38,0)")
    below = F.abs(denominator).cast("decimal(36,0)")
    bottom = (below * 2).cast("decimal(38,0)")
    top = (top + below).cast("decimal(38,0)")
    steps = ((top - top % bottom) / bottom).cast("decimal(30,0)")
    signed = F.when((numerator < 0) != (denominator < 0), -steps).otherwise(steps)
    return F.when(denominator != 0, (signed / 100).cast("decimal(32,2)"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, null when the denominator is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, True))
