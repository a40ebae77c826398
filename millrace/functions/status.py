"""Expressions over the text and language code of a status."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def language_names(spark: SparkSession) -> dict[str, str]:
    """English names of all ISO 639 codes, from the JVM's own table."""
    locale = spark._jvm.java.util.Locale
    return {code: locale.forLanguageTag(code).getDisplayLanguage(locale.ENGLISH) for code in locale.getISOLanguages()}


def clean_status(text: Column) -> Column:
    """Text without its first ``RT``, without ``@names`` and without links."""
    first_rt = F.locate("RT", text)
    no_rt = F.when(first_rt > 0, F.concat(F.substr(text, F.lit(1), first_rt - 1), F.substr(text, first_rt + 2))).otherwise(text)
    return F.regexp_replace(F.regexp_replace(no_rt, r"@\p{L}+", ""), r"https?://\S+\s?", "")


def has_hiragana(text: Column) -> Column:
    return F.regexp_like(text, F.lit(r"\p{InHiragana}"))


def has_hangul(text: Column) -> Column:
    return F.regexp_like(text, F.lit(r"\p{IsHangul}"))


def language_name(code: Column, names: dict[str, str]) -> Column:
    """English name of a code; an unknown code names itself."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(table[code], code)
