"""Expressions that turn dirty text into typed values.

All conversions give NULL on malformed input (``try_cast``), with ANSI mode left on.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Junk markers found in the sources.
SSN_JUNK = "#F%$D@*&8"
OCCUPATION_JUNK = "_______"
CREDIT_MIX_JUNK = "_"
PAYMENT_BEHAVIOUR_JUNK = "!@9#%8"
UNKNOWN = "Unknown"

# The accepted age range.
AGE_MIN, AGE_MAX = 18, 100

# Formats of the credit history text.
HISTORY_YEARS = r"^(\d+)\s*Years"
HISTORY_MONTHS = r"and\s*(\d+)\s*Months"


def safe_cast(text: Column, type_name: str) -> Column:
    """``try_cast`` of text, skipped for what is plainly no number.

    A failing cast costs an exception per value; no number holds an underscore or an inner blank,
    and nothing is left to cast in an empty text.
    """
    hopeless = text.contains("_") | F.trim(text).contains(" ") | (text == "")
    return F.when(~hopeless, text.try_cast(type_name))


def lenient_int(c: Column) -> Column:
    """Text to int as a non-ANSI cast does it: a decimal part is cut off, junk gives NULL."""
    text = c.cast("string")
    whole = F.regexp_extract(F.trim(text), r"^([+-]?\d+)\.\d*$", 1)
    return F.when(text.contains("."), safe_cast(whole, "int")).otherwise(safe_cast(text, "int"))


def early_cast(c: Column, type_name: str) -> Column:
    """Type a raw value before any cleansing."""
    if type_name == "int":
        return lenient_int(c)
    return safe_cast(c.cast("string"), type_name) if type_name == "double" else c.try_cast(type_name)


def strip_underscores(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), "_", "")


def plausible_age(age: Column) -> Column:
    """An int age inside the accepted range, else 0."""
    return F.coalesce(F.when(age.between(AGE_MIN, AGE_MAX), age), F.lit(0))


def age_cast_first(raw: Column) -> Column:
    """Age typed before it is cleansed: a trailing underscore loses the value."""
    return plausible_age(lenient_int(raw))


def age_strip_first(raw: Column) -> Column:
    """Age with underscores removed, kept if only digits remain."""
    digits = strip_underscores(raw)
    return plausible_age(F.when(digits.rlike(r"^\d+$"), digits.try_cast("int")))


def null_if_contains(c: Column, marker: str) -> Column:
    return F.when(~c.contains(marker), c)


def or_unknown(c: Column) -> Column:
    return F.coalesce(c, F.lit(UNKNOWN))


def reject(c: Column, missing=None, above=None, below=None) -> Column:
    """NULL for a sentinel value or a value beyond a bound."""
    bad = F.lit(False)
    if missing is not None:
        bad = bad | (c == missing)
    if above is not None:
        bad = bad | (c > above)
    if below is not None:
        bad = bad | (c < below)
    return F.when(~bad, c)


def history_months(text: Column) -> Column:
    """``N Years and M Months`` as months; a part that does not parse counts 0."""

    def part(pattern: str) -> Column:
        return F.coalesce(safe_cast(F.regexp_extract(text, pattern, 1), "double"), F.lit(0.0))

    return F.coalesce(part(HISTORY_YEARS) * 12 + part(HISTORY_MONTHS), F.lit(0.0))
