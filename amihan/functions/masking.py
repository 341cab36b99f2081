"""Masks for personal data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mask_ends(value: Column) -> Column:
    """First letter, three stars, last letter; NULL stays NULL."""
    return F.concat(F.substring(value, 1, 1), F.lit("***"), F.substring(value, F.length(value), 1))


def mask_tail(value: Column) -> Column:
    """Three stars and the last four characters; NULL stays NULL."""
    return F.concat(F.lit("***"), F.right(value, F.lit(4)))


def _mask_name(value: Column) -> Column:
    last_two = F.substring(value, F.length(value) - 1, 2)
    return F.concat(F.substring(value, 1, 1), F.lit("***"), last_two)


def _mask_email(value: Column) -> Column:
    domain = F.substring(value, F.instr(value, "@") + 1, F.length(value))
    return F.concat(F.substring(value, 1, 1), F.lit("***@"), domain)


_KINDS = {
    "name": _mask_name,
    "account": mask_tail,
    "document": mask_tail,
    "phone": mask_tail,
    "email": _mask_email,
}


def mask_pii(value: Column, kind: str = "name") -> Column:
    """Mask by kind; an unknown kind gives NULL."""
    mask = _KINDS.get(kind)
    return mask(value) if mask else F.lit(None).cast("string")


def mask_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Mask the named columns of a table, each by its kind."""
    return df.withColumns({name: mask_pii(F.col(name), kind) for name, kind in kinds.items()})
