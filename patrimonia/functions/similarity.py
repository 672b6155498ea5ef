"""Similarity of short texts, and provinces by name. The ratio is measured in Python, on distinct pairs only."""

from __future__ import annotations

from difflib import SequenceMatcher
from unicodedata import category, normalize

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from patrimonia.functions.text import _col, compact_norm, let, norm_text

# The provinces' names, and other names of some.
PROVINCES = (
    "Álava", "Albacete", "Alicante", "Almería", "Asturias", "Ávila", "Badajoz", "Barcelona", "Burgos", "Cáceres", "Cádiz", "Cantabria",
    "Castellón", "Ciudad Real", "Córdoba", "Cuenca", "Girona", "Granada", "Guadalajara", "Gipuzkoa", "Huelva", "Huesca", "Illes Balears",
    "Jaén", "A Coruña", "La Rioja", "Las Palmas", "León", "Lleida", "Lugo", "Madrid", "Málaga", "Murcia", "Navarra", "Ourense", "Palencia",
    "Pontevedra", "Salamanca", "Santa Cruz de Tenerife", "Segovia", "Sevilla", "Soria", "Tarragona", "Teruel", "Toledo", "Valencia",
    "Valladolid", "Bizkaia", "Zamora", "Zaragoza", "Ceuta", "Melilla",
)
OTHER_NAMES = {
    "ALACANT": "Alicante", "CASTELLO": "Castellón", "CASTELLON DE LA PLANA": "Castellón", "CASTELLO DE LA PLANA": "Castellón",
    "VALENCIA": "Valencia", "BALEARES": "Illes Balears", "ISLAS BALEARES": "Illes Balears", "MALLORCA": "Illes Balears",
    "IBIZA": "Illes Balears", "VIZCAYA": "Bizkaia", "BISCAIA": "Bizkaia", "GUIPUZCOA": "Gipuzkoa", "GERONA": "Girona", "LERIDA": "Lleida",
    "TEROL": "Teruel", "CONCA": "Cuenca", "LA CORUNA": "A Coruña", "ORENSE": "Ourense", "SARAGOSSA": "Zaragoza", "MURCIA": "Murcia",
    "OSCA": "Huesca", "ALBACETE": "Albacete", "TENERIFE": "Santa Cruz de Tenerife",
}
# What the form prints in its cells, and how alike a text must be to count as that.
FORM_LABELS = (
    "Descripción", "Descripció", "Valor (euros)", "Clave (*)", "Tipo (**)", "Situación (provincia)", "Valor catastral",
    "Valor catastral del conjunto", "Valor global conjunto",
)
LABEL_ALIKE, PROVINCE_ALIKE = 0.72, 0.8


def _plain_upper(text: str) -> str:
    return "".join(c for c in normalize("NFD", text) if category(c) != "Mn").upper()


PROVINCE_KEYS = {_plain_upper(p): p for p in PROVINCES} | OTHER_NAMES


@pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """2 * matched / total characters over the longest common blocks, found one after the other; 0 if either is empty.

    The order counts: swapped texts may give another ratio.
    """
    out = [SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)]
    return pd.Series(out, dtype="float64")


def similarity(a: Column | str, b: Column | str) -> Column:
    """The ratio of two texts without accents, case, signs and spaces. Use it on distinct pairs."""
    return ratio(compact_norm(a), compact_norm(b))


def length_bound(a: Column, b: Column, least: float) -> Column:
    """False where lengths alone keep the ratio of two texts below ``least``."""
    la, lb = F.length(a), F.length(b)
    return 2 * F.least(la, lb) >= least * (la + lb)


def is_label(df: DataFrame, text: str, out: str = "is_label") -> DataFrame:
    """``df`` with whether ``text`` resembles a label that the form prints. Distinct texts are measured once."""
    texts = df.select(F.col(text).alias("_text")).where(F.col("_text").isNotNull()).distinct().withColumn("_norm", compact_norm("_text"))
    pairs = texts.select("_norm").distinct().withColumn("_label", F.explode(F.array(*(F.lit(x) for x in _labels()))))
    near = pairs.where(length_bound(F.col("_norm"), F.col("_label"), LABEL_ALIKE)).where(ratio("_norm", "_label") > LABEL_ALIKE).select("_norm").distinct()
    hits = texts.join(near, "_norm").select("_text", F.lit(True).alias("_hit"))
    return df.join(hits, F.col(text) == F.col("_text"), "left").withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_text", "_hit")


def _labels() -> list[str]:
    return sorted({"".join(c for c in _plain_upper(x) if c.isascii() and c.isalnum()) for x in FORM_LABELS})


def province_by_word(c: Column | str) -> Column:
    """The province whose key a text is, or else the longest key that it holds as whole words; null without one."""
    return let(norm_text(c), _province)


def _province(norm: Column) -> Column:
    keys = sorted(PROVINCE_KEYS, key=lambda k: -len(k))
    whole = F.array(*(F.struct(F.lit(k).alias("key"), F.lit(PROVINCE_KEYS[k]).alias("province")) for k in keys))
    exact = F.get(F.filter(whole, lambda x: x["key"] == norm), F.lit(0))["province"]
    padded = F.concat(F.lit(" "), norm, F.lit(" "))
    held = F.get(F.filter(whole, lambda x: padded.contains(F.concat(F.lit(" "), x["key"], F.lit(" ")))), F.lit(0))["province"]
    return F.coalesce(exact, held)


def resolve_province(df: DataFrame, text: str, out: str = "provincia") -> DataFrame:
    """``df`` with the province of ``text``: exact, else by whole words, else the most alike key of 0.8 or more.

    Distinct texts are resolved once; only those without an exact or whole-word key are measured. Of equally
    alike keys the last in code-point order counts.
    """
    texts = df.select(F.col(text).alias("_text")).where(F.col("_text").isNotNull()).distinct()
    texts = texts.withColumns({"_norm": norm_text("_text"), "_sure": province_by_word("_text")})
    keys = F.array(*(F.struct(F.lit(k).alias("key"), F.lit(v).alias("province")) for k, v in PROVINCE_KEYS.items()))
    open_ = texts.where("_sure is null and _norm <> ''").select("_norm").distinct().select("_norm", F.explode(keys).alias("k"))
    near = open_.where(length_bound(F.col("_norm"), F.col("k.key"), PROVINCE_ALIKE)).withColumn("r", ratio("k.key", "_norm")).where(F.col("r") >= PROVINCE_ALIKE)
    best = near.groupBy("_norm").agg(F.max(F.struct("r", "k.key", "k.province")).alias("best")).select("_norm", F.col("best.province").alias("_near"))
    told = texts.join(best, "_norm", "left").select("_text", F.coalesce("_sure", "_near").alias("_province"))
    return df.join(told, F.col(text) == F.col("_text"), "left").withColumn(out, F.col("_province")).drop("_text", "_province")
