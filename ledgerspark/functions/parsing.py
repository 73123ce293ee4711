"""Column -> Column parsers for the text cells of accounting exports.

All of them are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for what a workbook stores of a number; published tables round to cents (see sources.sinks).
MONEY = "decimal(28,6)"

DATE_FORMATS = ("d.M.yyyy", "M/d/yyyy")
DATETIME_FORMATS = ("d.M.yyyy H:m:s", "M/d/yyyy h:m:s a")


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_locale_number(c: Column | str, strict: bool = True) -> Column:
    """``"1 234,50"`` -> 1234.50; null stays null.

    Plain and non-breaking spaces are dropped. ``strict`` fails the job on text that is not a
    number (ANSI cast); otherwise such cells become null, and ``operators.rejected_cells`` lists them.
    """
    digits = F.translate(as_column(c), ", \u00a0", ".")
    return digits.cast(MONEY) if strict else digits.try_cast(MONEY)


def parse_multi_datetime(c: Column | str, formats: Iterable[str] = DATETIME_FORMATS) -> Column:
    """The first format that fits the whole text wins; null when none does.

    A format is tried only on text of its shape: a failed parse costs an exception per cell, and
    most cells of a stacked column are no dates.
    """
    c = as_column(c)
    return F.coalesce(*[F.when(F.rlike(c, F.lit(_shape(f))), F.try_to_timestamp(c, F.lit(f))) for f in formats])


def _shape(pattern: str) -> str:
    parts = {"yyyy": r"\d{4}", "a": "[AaPp][Mm]"}
    return "^" + re.sub(
        r"[A-Za-z]+|[^A-Za-z]", lambda m: parts.get(m[0], r"\d{1,2}" if m[0].isalpha() else re.escape(m[0])), pattern
    ) + "$"


def parse_multi_date(c: Column | str, formats: Iterable[str] = DATE_FORMATS, strict: bool = True) -> Column:
    """The date in the first format that fits; null stays null.

    ``strict`` fails the job on text that no format fits; otherwise such cells become null, and
    ``operators.rejected_cells`` lists them.
    """
    c = as_column(c)
    date = parse_multi_datetime(c, formats).cast("date")
    if not strict:
        return date
    return F.when(c.isNotNull() & date.isNull(), F.raise_error(F.concat(F.lit("not a date: "), c)).cast("date")).otherwise(date)


def clean_tax_id(c: Column | str) -> Column:
    """Remove every literal ``.0`` that a numeric cell leaves in an id."""
    return F.replace(as_column(c), F.lit(".0"), F.lit(""))


def label_with_id(name: Column | str, tax_id: Column | str) -> Column:
    """``name (ИНН: id)`` when there is an id, the bare name otherwise.

    A missing name next to a present id is written as ``nan``, as in the published tables.
    """
    name, tax_id = as_column(name), as_column(tax_id)
    labelled = F.concat(F.coalesce(name, F.lit("nan")), F.lit(" (ИНН: "), tax_id, F.lit(")"))
    return F.when(tax_id.isNotNull(), labelled).otherwise(name)


def split_last_comma(c: Column | str) -> Column:
    """``"name,id"`` -> ``"name (ИНН: id)"``, cutting at the last comma.

    A tail of exactly one space means "no id": the last two characters go. Text without a comma
    is both head and tail.
    """
    c = as_column(c)
    tail = F.substring_index(c, ",", -1)
    head = F.when(F.contains(c, F.lit(",")), F.left(c, F.length(c) - F.length(tail) - 1)).otherwise(c)
    labelled = F.concat(head, F.lit(" (ИНН: "), tail, F.lit(")"))
    return F.when(tail != " ", labelled).otherwise(F.left(c, F.length(c) - 2))


def file_group(name: Column | str, strict: bool = False) -> Column:
    """Company group: the text after the first ``(`` of a file name.

    A name without one has the group ``''``; ``strict`` fails the job on it.
    """
    name = as_column(name)
    group = F.regexp_extract(name, r"\(([^()]*)", 1)
    if not strict:
        return group
    return F.when(group == "", F.raise_error(F.concat(F.lit("no (group) in the name of "), name)).cast("string")).otherwise(group)


def file_company(name: Column | str) -> Column:
    """Company: the text after the last ``_`` up to the following ``.``."""
    return F.substring_index(F.substring_index(as_column(name), "_", -1), ".", 1)
