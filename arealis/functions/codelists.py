"""Value-to-label dictionaries and their lookups."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Published code lists, stated as they must appear in results.
CODE_LISTS: dict[str, dict[str, str]] = {
    "escolar": {"1": "Sin educacion", "2": "Primaria", "3": "Secundaria", "4": "Superior"},
    "escolar2": {"1": "Sin educacion", "2": "Primaria", "3": "Secundaria", "4": "Superior"},
    "anoest": {
        "1": "Sin educacion",
        "2": "1 - 6 años",
        "3": "7 - 12 años",
        "4": "Más de 12",
        "98": "No aplica",
        "99": "NS/NR",
    },
    "sexo": {"1": "Hombre", "2": "Mujer"},
    "etnia": {"1": "Indigena", "2": "Afro", "3": "Otro"},
    "edad": {"1": "0 -14", "2": "15 - 29", "3": "30 - 44", "4": "45 - 64", "5": "65 - más"},
    "discapacidad": {"0": "No discapacitado", "1": "Discapacitado"},
    "area": {"0": "Rural", "1": "Urbana"},
}
EMPLOYMENT = {"1": "Ocupado", "2": "Desocupado", "3": "Inactivo"}
AGE_SHARE_NAMES = {"1": "edad_0_14", "2": "edad_15_29", "3": "edad_30_44", "4": "edad_45_64", "5": "edad_65_más"}
SCHOOLING_SHARE_NAMES = {"1": "Sin_educacion", "2": "años1_6", "3": "años7_12", "4": "Más_de_12"}
# Display titles of the faceting variables in map grids.
FACET_TITLES = {
    "edad": "Edad",
    "anoest": "Escolar",
    "etnia": "Etnia",
    "sexo": "Sexo",
    "discapacidad": "Discapacitado",
    "discapacitado": "Discapacitado",
    "area": "Área",
}


def code_lists() -> dict[str, dict[str, str]]:
    """Return a copy of every code list."""
    return {k: dict(v) for k, v in CODE_LISTS.items()}


def _as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_literal(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def recode(col: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed codes, keep every other value as it is."""
    c = _as_column(col).cast("string")
    return F.coalesce(F.element_at(map_literal(mapping), c), c)


def relabel(name: str, col: str | Column | None = None, missing: str = "error", passthrough: tuple[str, ...] = ("depto",)) -> Column:
    """Label a coded variable from its code list.

    ``missing`` says what happens when ``name`` has no list: ``error`` raises, ``warn`` warns and keeps the
    codes.  Names in ``passthrough`` keep their codes silently.
    """
    c = _as_column(name if col is None else col)
    if name in CODE_LISTS:
        return recode(c, CODE_LISTS[name])
    if name not in passthrough:
        if missing == "error":
            raise KeyError(f"no code list for variable {name!r}")
        warnings.warn(f"no code list for variable {name!r}; codes are kept", stacklevel=2)
    return c.cast("string")


def fix_codes(col: str | Column, mapping: Mapping[str, str]) -> Column:
    """Apply point corrections to area codes."""
    return recode(col, mapping)
