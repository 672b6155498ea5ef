"""Filters, presets, counts and orders over the people's summary."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrimonia.functions.text import fold_text, norm_text

#: Minimum filters and the columns that they look at.
MINIMA = {
    "min_homes": "n_viviendas", "min_shared_homes": "n_viviendas_compartidas", "min_properties": "n_inmuebles", "min_provinces": "n_provincias",
    "min_cadastral": "valor_catastral", "min_accounts": "cuentas", "min_assets": "otros_bienes", "min_debts": "pasivo", "min_income": "rentas",
}
#: Named filters; each keeps the choice of active people as it is.
PRESETS: Mapping[str, Mapping[str, Any]] = {
    "Con vivienda": {"min_homes": 1},
    "Más de 2 viviendas": {"min_homes": 3},
    "Vivienda compartida": {"min_shared_homes": 1},
    "Sin ningún inmueble": {"no_property": True},
    "Inmuebles en 3 provincias": {"min_provinces": 3},
    "Más de 50.000 € en cuentas": {"min_accounts": 50000},
    "Con hipoteca": {"mortgage": True},
}


def people_predicate(
    text: str | None = None, group: str | None = None, district: str | None = None, active: bool | None = True, province: str | None = None,
    mortgage: bool = False, review: bool = False, no_property: bool = False, **minima: float | None,
) -> Column:
    """All of the given conditions. A null amount counts as 0 against a minimum, but not as having no property."""
    wanted: list[Column] = [F.lit(True)]
    if text:
        wanted.append(fold_text(F.concat_ws(" ", F.coalesce("nombre", F.lit("")), F.coalesce("apellidos", F.lit("")))).contains(fold_text(F.lit(text))))
    if group:
        wanted.append(F.col("grupo") == group)
    if district:
        wanted.append(F.col("circunscripcion") == district)
    if active is not None:
        wanted.append(F.col("en_activo") == active)
    if province:
        wanted.append(F.array_contains("provincias_inmuebles", province))
    for name, least in minima.items():
        if least is not None:
            wanted.append(F.coalesce(F.col(MINIMA[name]), F.lit(0)) >= least)
    if mortgage:
        wanted.append(F.coalesce("tiene_hipoteca", F.lit(False)))
    if review:
        wanted.append(F.coalesce("revisar", F.lit(False)))
    if no_property:
        wanted.append(F.col("n_inmuebles") == 0)
    return reduce(lambda a, b: a & b, wanted)


def filter_people(people: DataFrame, **conditions: Any) -> DataFrame:
    """People who meet all conditions of ``people_predicate``; only active ones unless ``active`` says otherwise."""
    return people.where(people_predicate(**conditions))


def preset_filter(people: DataFrame, name: str, active: bool | None = True) -> DataFrame:
    """People of a named filter."""
    return filter_people(people, active=active, **PRESETS[name])


def preset_counts(people: DataFrame, active: bool | None = True) -> DataFrame:
    """(preset, n): how many people each named filter keeps, in one pass."""
    counts = people.agg(*(F.count_if(people_predicate(active=active, **p)).alias(f"c{i}") for i, p in enumerate(PRESETS.values())))
    rows = F.array(*(F.struct(F.lit(name).alias("preset"), F.col(f"c{i}").alias("n")) for i, name in enumerate(PRESETS)))
    return counts.select(F.explode(rows).alias("r")).select("r.preset", "r.n")


def order_people(people: DataFrame) -> DataFrame:
    """Active people first, then by normalised surname and name."""
    return people.orderBy(F.desc("en_activo"), norm_text("apellidos"), norm_text("nombre"))


def order_view(people: DataFrame, column: str = "apellidos", descending: bool | None = None) -> DataFrame:
    """By any column: texts by their folded form, numbers with nulls lowest. Numbers come largest first unless told."""
    is_text = dict(people.dtypes)[column] == "string"
    key = fold_text(column) if is_text else F.col(column)
    down = not is_text if descending is None else descending
    return people.orderBy(key.desc_nulls_last() if down else key.asc_nulls_first())


def headline_counts(people: DataFrame, active: bool | None = True, **conditions: Any) -> DataFrame:
    """Six counts over the filtered people, and how many the choice of active people leaves without filters."""
    kept = people_predicate(active=active, **conditions)
    base = F.lit(True) if active is None else F.col("en_activo") == active
    n = lambda c: F.count_if(kept & F.coalesce(c, F.lit(False)))
    return people.agg(
        F.count_if(kept).alias("n_vista"), n(F.col("n_viviendas") >= 1).alias("n_con_vivienda"), n(F.col("n_viviendas") >= 3).alias("n_tres_o_mas"),
        n(F.col("n_inmuebles") == 0).alias("n_sin_inmueble"), n(F.col("tiene_hipoteca")).alias("n_con_hipoteca"),
        n(F.col("n_inmuebles").isNull()).alias("n_sin_leer"), F.count_if(base).alias("n_base"),
    )


def facets(people: DataFrame) -> DataFrame:
    """(facet, value): distinct non-empty groups, districts and provinces of properties, in order."""
    each = lambda name, c: people.select(F.lit(name).alias("facet"), c.alias("value"))
    all_ = each("grupo", F.col("grupo")).unionByName(each("circunscripcion", F.col("circunscripcion"))).unionByName(each("provincia", F.explode("provincias_inmuebles")))
    return all_.where("value <> ''").distinct().orderBy("facet", "value")
