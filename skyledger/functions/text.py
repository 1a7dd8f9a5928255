"""Text functions: stripping, title case, missing-value tokens, token sorting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings that an all-text scan reads as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_EDGE_SPACE = r"(?U)^\s+|\s+$"


def strip(col: Column) -> Column:
    """Remove leading and trailing Unicode white space (``trim`` knows only U+0020)."""
    return F.regexp_replace(col, _EDGE_SPACE, "")


def na_to_null(col: Column) -> Column:
    return F.when(~col.isin(NA_TOKENS), col)


def title_case(col: Column) -> Column:
    """Upper-case the first letter of each run of letters and lower-case the rest.

    ``initcap`` splits on spaces only and would leave "o'neill" and
    "jammu-kashmir" half done.
    """
    runs = F.regexp_extract_all(col, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    cased = F.transform(runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.lower(F.substr(run, F.lit(2)))))
    return F.array_join(cased, "")


def lookup_key(col: Column) -> Column:
    """The normalised form under which names are looked up exactly."""
    return F.lower(strip(col))


def is_blank(col: Column) -> Column:
    return col.isNull() | (strip(col) == "")


def sort_tokens(col: Column) -> Column:
    """Split on white space, sort the tokens, join them by one space."""
    return F.array_join(F.array_sort(F.split(strip(col), r"(?U)\s+")), " ")
