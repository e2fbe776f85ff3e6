"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters dropped from numbers and money, texts read as missing.
THOUSANDS = ",，"
CURRENCY = "￥¥"
MISSING_TEXT = ("", "nan")
LABEL_STOPS = "（）()"


def strip_thousands(c: Column) -> Column:
    """Drop ASCII and full-width commas."""
    return F.translate(c, THOUSANDS, "")


def trim_or_null(c: Column) -> Column:
    """Trim; blank cells and the text of a missing number become NULL."""
    cut = F.trim(c)
    return F.when(~F.lower(cut).isin(*MISSING_TEXT), cut)


def money(c: Column) -> Column:
    """``￥1,234.50`` to 1234.5; unreadable text to NULL."""
    return F.trim(F.translate(c, CURRENCY + THOUSANDS, "")).try_cast("double")


def clip_text(c: Column, size: int = 100) -> Column:
    return F.substring(c, 1, size)


def double_quotes(c: Column) -> Column:
    """Write each ``'`` twice, for tables that were filled with quoted literals."""
    return F.replace(c, F.lit("'"), F.lit("''"))


def drop_trailing_commas(c: Column) -> Column:
    return F.rtrim(c, F.lit(","))


def present_names(names: list[str]) -> Column:
    """Array with the names of the non-NULL columns, in the given order."""
    return F.array_compact(F.array(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in names]))


def comma_list(names: Column) -> Column:
    """``[a001, a002]`` to ``'a001,a002,'`` (a comma after every entry)."""
    return F.concat_ws("", F.transform(names, lambda n: F.concat(n, F.lit(","))))


def header_name(label: str, renames: dict[str, str] | None = None) -> str:
    """Column name for a sheet label: mapped if listed, else cut at a bracket, ``-`` to ``_``, lower case."""
    if renames and label in renames:
        return renames[label]
    for stop in LABEL_STOPS:
        label = label.partition(stop)[0]
    return label.strip().replace("-", "_").lower()
