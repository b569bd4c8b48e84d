"""Scalar column expressions. Dates of reference are always parameters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SUFFIX = r"^(.*?)(?:-(\d+))?$"
SUBJECT = r"\[SUPPLY \| [^\]]*\]\s*Instalação\s+(.+?)\s+Deal ID:"


def days_since(col: Column, as_of: dt.date) -> Column:
    return F.datediff(F.lit(as_of), col)


def as_date(col: Column) -> Column:
    """Cast to date; text that is no date becomes NULL instead of an error."""
    return col.try_cast("date")


def first_known(*cols: Column, default=None) -> Column:
    return F.coalesce(*cols, *([] if default is None else [F.lit(default)]))


def sorted_label_set(col: Column, sep: str = ", ") -> Column:
    """Aggregate: distinct labels, sorted and joined."""
    return F.array_join(F.sort_array(F.collect_set(col)), sep)


def days_open(col: Column, as_of: dt.datetime) -> Column:
    """Fractional days between a timestamp and ``as_of``."""
    elapsed = F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(col.cast("timestamp"))
    return elapsed / F.lit(86_400_000_000)


def is_stale(col: Column, as_of: dt.datetime, days: int = 2) -> Column:
    return col.cast("timestamp") < F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))


def split_suffix(col: Column) -> tuple[Column, Column]:
    """``123-4`` -> (``123``, 4); without a suffix -> (text, NULL)."""
    number = F.nullif(F.regexp_extract(col, SUFFIX, 2), F.lit(""))
    return F.regexp_extract(col, SUFFIX, 1), number.try_cast("int")


def split_list(col: Column) -> tuple[Column, Column]:
    """Serial text separated by ``,`` ``/`` or ``|`` -> (trimmed list, count)."""
    parts = F.filter(F.transform(F.split(col, r"[,/|]"), lambda x: F.trim(x)), lambda x: x != "")
    items = F.coalesce(parts, F.array().cast("array<string>"))
    return items, F.size(items)


def display_name(subject: Column, company_name: Column) -> Column:
    """Company name if known, else the name inside the subject, else the subject."""
    inner = F.nullif(F.regexp_extract(subject, SUBJECT, 1), F.lit(""))
    return F.coalesce(company_name, inner, subject)


def risk_status(col: Column, limit: int = 3) -> Column:
    """NULL compares as unknown and therefore counts as ``ok``."""
    return F.when(col < limit, "em_risco").otherwise("ok")


def bucket(col: Column, bounds) -> Column:
    """Label of the (low, high) range holding the value; NULL outside all."""
    label = F.lit(None).cast("string")
    for low, high in reversed(list(bounds)):
        inside = col >= low if high is None else col.between(low, high)
        label = F.when(inside, f"{low}+" if high is None else f"{low}-{high}").otherwise(label)
    return label
