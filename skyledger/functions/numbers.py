"""Tolerant numeric parsing and exact rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number formats accepted from text (digits may be grouped by "_").
FLOAT_TEXT = r"^\s*[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"
INT_TEXT = r"^\s*[+-]?\d+(_\d+)*\s*$"

def finite(col: Column) -> Column:
    return F.when(F.abs(col) < F.lit(float("inf")), col)


def text_to_double(col: Column) -> Column:
    """Text to a finite double, else null.

    The pattern keeps out spellings that only the JVM accepts, such as "1.5d".
    """
    digits = F.replace(col, F.lit("_"), F.lit(""))
    return F.when(col.rlike(FLOAT_TEXT), finite(digits.try_cast("double")))


def integral(col: Column) -> Column:
    """A double holding a whole number as BIGINT; anything else is null."""
    return F.when(col == F.floor(col), col.try_cast("bigint"))


def variant_double(value: Column) -> Column:
    """A variant's number, numeric text or boolean as a finite double, else null."""
    text = F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "double")
    return F.when(F.schema_of_variant(value) == "STRING", text_to_double(text)).otherwise(finite(number))


def variant_doubles(values: list[Column]) -> Column:
    """``variant_double`` of each value, as an array.

    One lambda instead of the same code once per value keeps the generated
    method small enough for the JVM to compile it.
    """
    return F.transform(F.array(*values), variant_double)


def variant_int(variant: Column, path: str) -> Column:
    """Like an integer cast: numbers truncate, integer text parses, "87.5" as text is null."""
    text = F.try_variant_get(variant, path, "string")
    number = F.try_variant_get(variant, path, "int")
    grouped = F.when(text.rlike(INT_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("int"))
    return F.coalesce(number, grouped)


def unscaled(col: Column, scale: int) -> Column:
    """A decimal with ``scale`` digits as a whole number of its smallest unit.

    Sums of these are plain BIGINT additions: exact, order-independent and in
    generated code, where sums of wide decimals are objects. 10^13 readings of
    up to five digits plus two decimals fit.
    """
    return (col * F.lit(10**scale)).cast("bigint")


def rounded_mean(total: Column, count: Column, scale: int, digits: int) -> Column:
    """The mean ``total / 10**scale / count``, rounded half away from zero to ``digits``.

    Whole-number arithmetic throughout: the built-in decimal average keeps only
    four more digits than its input and would round twice.
    """
    up, step = 10 ** max(digits - scale, 0), 10 ** max(scale - digits, 0)
    half_up = F.call_function("div", F.abs(total) * (2 * up) + count * step, count * (2 * step))
    signed = F.when(total < 0, -half_up).otherwise(half_up).cast("decimal(18,0)")
    return F.when(count > 0, (signed / F.lit(10**digits)).cast(f"decimal(20,{digits})"))


def fixed_text(x: Column, digits: int) -> Column:
    """A double with ``digits`` decimals, 0 to 2, rounded half to even on its exact binary value.

    ``format_string`` rounds the shortest decimal spelling half up: 4.25 becomes 4.3, and so
    does 4.35, which in binary is less than that. Here the fraction is taken apart into
    whole 2^-62ths, which is exact for all doubles from 2^-9 on, and smaller ones round to nought.
    Null stays null; values beyond 2^53 are whole already.
    """
    size = F.abs(x)
    whole = F.floor(size)
    fraction = F.when(size >= F.lit(2.0**-9), ((size - whole) * F.lit(2.0**62)).cast("bigint")).otherwise(F.lit(0))
    scaled = fraction.cast("decimal(20,0)") * F.lit(10**digits).cast("decimal(4,0)")
    one = F.lit(2**62).cast("decimal(20,0)")
    below = whole * 10**digits + F.call_function("div", scaled, one)
    rest, half = scaled % one, F.lit(2**61).cast("decimal(20,0)")
    up = (rest > half) | ((rest == half) & (F.pmod(below, F.lit(2)) == 1))
    units = below + up.cast("bigint")
    text = F.call_function("div", units, F.lit(10**digits)).cast("string")
    if digits:
        text = F.concat(text, F.lit("."), F.lpad(F.pmod(units, F.lit(10**digits)).cast("string"), digits, "0"))
    return F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")), text)
