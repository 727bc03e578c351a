"""Pseudonymisation of configured columns. It runs before validation, so quarantined rows hold no clear values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from plumbline.functions.geometry import translate
from plumbline.functions.text import pseudonym, quoted, sql_name


@dataclass(frozen=True)
class Privacy:
    """What to hide. Salt and offsets have no defaults on purpose: an unset salt would hide nothing."""

    salt: str
    dx: float
    dy: float
    text_columns: Sequence[str] = ()
    geometry_columns: Sequence[str] = ()
    prefix: str = "ANON"


def pseudonymise(df: DataFrame, privacy: Privacy) -> DataFrame:
    """Hash the text columns and move the geometry columns; columns the frame lacks are skipped."""
    hidden = {
        name: pseudonym(quoted(name), privacy.salt, privacy.prefix)
        for name in privacy.text_columns if name in df.columns
    }
    hidden |= {
        name: translate(sql_name(name), privacy.dx, privacy.dy)
        for name in privacy.geometry_columns if name in df.columns
    }
    return df.withColumns(hidden) if hidden else df


def clear_siblings(mapping: Mapping[str, Mapping], text_columns: Sequence[str]) -> dict[str, list[str]]:
    """Characteristics that show the same source field as a hidden one but are not hidden themselves."""
    hidden = set(text_columns)
    leaks = {}
    for code in text_columns:
        field = (mapping.get(code) or {}).get("field")
        others = [c for c, m in mapping.items() if field is not None and m.get("field") == field and c not in hidden]
        if others:
            leaks[code] = others
    return leaks
