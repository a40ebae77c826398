"""Expressions over film titles such as ``Film (2012/I)  [Role]``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_series(title: Column) -> Column:
    """Television titles are quoted."""
    return F.startswith(title, F.lit('"'))


def up_to_year(title: Column) -> Column:
    """The title up to and including its first ``)``; empty when it has none."""
    return F.substr(title, F.lit(1), F.locate(")", title))


def title_year(title: Column) -> Column:
    """The four digits after the first ``(``; NULL when the first parenthesis holds anything else."""
    opening = F.locate("(", title)
    inside = F.substr(title, opening + 1, F.locate(")", title) - opening - 1)
    return F.nullif(F.regexp_extract(inside, r"^[0-9]{4}", 0), F.lit("")).cast("int")
