"""Guarded ratios, coercions and labels as Column expressions."""

from pyspark.sql import functions as F

# Calendar month names.
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

BLANKS = " \t\r\n\f\u000b"

# A decimal number as Python's float() reads it, digits optionally grouped by "_".
_DIGITS = r"[0-9](?:_?[0-9])*"
_FLOAT_TEXT = (
    rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
    r"|^[+-]?(?i:inf|infinity|nan)$"
)
_PLAIN_NUMBER = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity|nan)$"


def trimmed(c):
    return F.btrim(c, F.lit(BLANKS))


def blank_to_null(c):
    return F.nullif(trimmed(c), F.lit(""))


def nan_to_null(c):
    return F.nanvl(c, F.lit(None).cast("double"))


def or_zero(c):
    return F.coalesce(c, F.lit(0))


def total(c):
    """A sum that is 0, not NULL, when nothing is present."""
    return F.coalesce(F.sum(c), F.lit(0))


def ratio_zero(num, den):
    """num/den, or 0.0 when the denominator is not positive."""
    return F.when(den > 0, F.try_divide(num.cast("double"), den)).otherwise(F.lit(0.0))


def ratio_null(num, den):
    """num/den, or NULL when the denominator is zero."""
    return F.try_divide(num.cast("double"), den)


def two_decimals(c):
    """Rounded half to even after scaling, as column stores round floating-point numbers."""
    return F.rint(c * F.lit(100.0)) / F.lit(100.0)


def percent(num, den):
    """Share in percent with two decimals; NULL when the denominator is zero."""
    return two_decimals(F.try_divide(num * F.lit(100.0), den))


def clamp(c, low, high):
    """c limited to low..high. c must not be NULL or NaN."""
    return F.greatest(F.least(c, high), low)


def number_from_text(text):
    """Text to double by Python's float() rules; NULL when it is not a number."""
    t = trimmed(text)
    return F.when(t.rlike(_FLOAT_TEXT), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))


def number_or_missing(c):
    """Loosely typed column to double; NULL when unparsable or NaN."""
    text = trimmed(c.cast("string"))
    return nan_to_null(F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("double")))


def to_uint(number, maximum):
    """Truncate toward zero and clamp to 0..maximum; missing is 0.

    The double is clamped before the cast, so values beyond bigint reach the maximum.
    """
    known = F.coalesce(nan_to_null(number), F.lit(0.0))
    return clamp(known, F.lit(0.0), F.lit(float(maximum))).cast("bigint")


def to_nonneg(number):
    """Non-negative double; missing, NaN and negative are 0.0, +inf is kept."""
    known = nan_to_null(number)
    return F.when(known >= 0, known).otherwise(F.lit(0.0))


def is_infinite(number):
    return F.abs(number) == F.lit(float("inf"))


def month_name(month):
    """English month name; an unknown number is shown as text."""
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    known = F.when(month.between(1, 12), F.element_at(names, month.cast("int")))
    return F.coalesce(known, month.cast("string"))


def month_label(month):
    """Slicer label such as '03 - March'."""
    return F.concat(F.lpad(month.cast("string"), F.greatest(F.lit(2), F.length(month.cast("string"))), F.lit("0")),
                    F.lit(" - "), month_name(month))


def month_partition(year, month):
    return year * 100 + month


def computed_once(df, keep, columns):
    """Select keep plus the named columns, each computed once per row.

    Spark moves a filter below a projection by copying the filtered expression,
    and with it everything it is built from. A generated row stops that.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))
