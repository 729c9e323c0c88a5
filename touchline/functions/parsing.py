"""Strict parsers as column functions: what is not wholly in the format is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_seconds(text: Column) -> Column:
    """``HH:MM:SS`` or ``MM:SS``, with a fraction or without, as seconds."""
    part = lambda i: F.nullif(F.regexp_extract(text, r"^(?:([0-9]+):)?([0-9]+):([0-5][0-9](?:\.[0-9]+)?)$", i), F.lit(""))
    return F.coalesce(part(1).cast("double"), F.lit(0.0)) * 3600 + part(2).cast("double") * 60 + part(3).cast("double")


def exact_millimetres(text: Column) -> Column:
    """A decimal number of metres as whole millimetres; null if it has finer digits than that."""
    return F.when(text.rlike(r"^-?[0-9]+(\.[0-9]{1,3}0*)?$"), (text.cast("decimal(30,12)") * 1000).cast("long"))


def access_tier(flag: Column, provider: Column, allowed: list[str]) -> Column:
    """``public`` if flagged so, or without a flag if the provider is on the list; everything else is ``restricted``."""
    public = F.coalesce(flag == "public", F.lit(False)) | (flag.isNull() & F.coalesce(provider.isin(allowed), F.lit(False)))
    return F.when(public, "public").otherwise("restricted")
