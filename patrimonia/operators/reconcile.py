"""Sums of items against the totals that a person declares, and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrimonia.functions.amounts import parse_amount
from patrimonia.functions.codes import classify_asset

#: A sum may miss the total by so much.
TOLERANCE = 1
MONEY = "decimal(20,4)"
# Notes that the published tables carry.
UNRELIABLE = "Formulario escrito a mano o muy borroso: el OCR no es fiable"
REPEATED_ASSETS = "El total de otros bienes repite el valor catastral y no tiene detalle: no se cuenta"
REPEATED_DEBTS = "El total de deudas repite el de otro apartado y no tiene detalle: no se cuenta"
MISFILED = "Hay cuentas u otros bienes anotados en el apartado de deudas (se mantienen como están declarados)"


def _near(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= TOLERANCE


def conditional_sum(value: Column | str, condition: Column | None = None) -> Column:
    """The sum of the known values that meet a condition, to the cent; 0 without any."""
    value = F.col(value) if isinstance(value, str) else value
    counted = value if condition is None else F.when(condition, value)
    return F.coalesce(F.round(F.sum(counted.cast(MONEY)), 2).cast("double"), F.lit(0.0))


def _sums(items: DataFrame, value: str, share: str | None) -> DataFrame:
    part = F.col(share) if share else F.lit(None).cast("double")
    return items.groupBy("decl_id").agg(
        F.count("*").alias("n"), F.count(value).alias("known"), F.count(part).alias("shared"),
        F.sum(F.col(value).cast(MONEY)).cast("double").alias("whole"), F.sum((F.col(value) * part / 100).cast(MONEY)).cast("double").alias("weighted"),
    )


def reconcile_totals(items: DataFrame, totals: DataFrame, value: str = "valor", share: str | None = None) -> DataFrame:
    """(decl_id, cuadra) for each row of ``totals(decl_id, total)``.

    True if the lines, or their shares where every line has one, add up to the total within 1; null without a
    total or lines, or with an unknown value.
    """
    known = F.col("total").isNotNull() & (F.col("n") > 0) & (F.col("known") == F.col("n"))
    fits = _near(F.col("whole"), F.col("total")) | (F.coalesce(F.col("shared") == F.col("n"), F.lit(False)) & F.coalesce(_near(F.col("weighted"), F.col("total")), F.lit(False)))
    return totals.join(_sums(items, value, share), "decl_id", "left").select("decl_id", F.when(known, fits).alias("cuadra"))


def repair_with_alternatives(items: DataFrame, totals: DataFrame, value: str = "valor", share: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(items, flags): where a total isn't met, the first other reading of one item that meets it is taken.

    Items are tried by ``pos`` and their ``alts`` in order, one at a time. ``flags(decl_id, cuadra)`` as in
    ``reconcile_totals``, after the repair; a repaired item is ``corregido`` and no longer doubtful.
    """
    flags = reconcile_totals(items, totals, value, share)
    sums = _sums(items, value, share).join(totals, "decl_id").join(flags.where("cuadra = false").select("decl_id"), "decl_id", "left_semi")
    part = (F.col(share) if share else F.lit(None).cast("double")).alias("part")
    open_ = items.join(sums.select("decl_id"), "decl_id", "left_semi")
    tried = open_.select("decl_id", "pos", F.col(value).alias("was"), part, F.posexplode("alts").alias("alt_pos", "alt")).withColumn("v", parse_amount("alt")).where("v is not null")
    delta = F.col("v") - F.col("was")
    fits = _near(F.col("whole") + delta, F.col("total")) | (F.coalesce(F.col("shared") == F.col("n"), F.lit(False)) & F.coalesce(_near(F.col("weighted") + delta * F.col("part") / 100, F.col("total")), F.lit(False)))
    best = tried.join(sums, "decl_id").where(fits).groupBy("decl_id").agg(F.min(F.struct("pos", "alt_pos", "v", "alt")).alias("fix"))
    fixes = best.select("decl_id", F.col("fix.pos").alias("pos"), F.col("fix.v").alias("_v"), F.col("fix.alt").alias("_alt"))
    fixed = F.col("_v").isNotNull()
    out = items.join(fixes, ["decl_id", "pos"], "left").withColumns(
        {value: F.coalesce("_v", value), "valor_txt": F.coalesce("_alt", "valor_txt"), "dudoso": F.when(fixed, False).otherwise(F.col("dudoso")), "corregido": fixed}
    )
    flags = flags.join(best.select("decl_id", F.lit(True).alias("_fixed")), "decl_id", "left").select("decl_id", F.coalesce("_fixed", "cuadra").alias("cuadra"))
    return out.select(*items.columns, *([] if "corregido" in items.columns else ["corregido"])), flags


def clear_doubt(items: DataFrame, flags: DataFrame) -> DataFrame:
    """``items`` without doubts in tables whose sum meets the total."""
    sure = flags.where("cuadra").select("decl_id", F.lit(True).alias("_sure"))
    return items.join(sure, "decl_id", "left").withColumn("dudoso", F.when(F.col("_sure"), False).otherwise(F.col("dudoso"))).select(*items.columns)


def flag_illegible(declarations: DataFrame, items: DataFrame) -> DataFrame:
    """``declarations(decl_id, metodo, avisos, sums)`` with ilegible, and the warning that goes with it.

    Scanned, three items or more in ``items(decl_id, dudoso)`` of all tables, no sum met and half of them doubtful.
    """
    seen = items.groupBy("decl_id").agg(F.count("*").alias("_n"), F.count_if(F.coalesce("dudoso", F.lit(False))).alias("_d"))
    met = F.coalesce(F.col("suma_inmuebles_cuadra"), F.lit(False)) | F.coalesce("suma_otros_cuadra", F.lit(False)) | F.coalesce("suma_pasivo_cuadra", F.lit(False))
    bad = F.coalesce((F.col("metodo") == "ocr") & (F.col("_n") >= 3) & ~met & (F.col("_d") * 2 >= F.col("_n")), F.lit(False))
    out = declarations.join(seen, "decl_id", "left").withColumn("ilegible", bad)
    warned = F.concat(F.coalesce("avisos", F.array().cast("array<string>")), F.array(F.lit(UNRELIABLE)))
    return out.withColumn("avisos", F.when(F.col("ilegible"), warned).otherwise(F.col("avisos"))).drop("_n", "_d")


def repeated_totals(n_assets: Column, n_debts: Column) -> Column:
    """Names of totals without lines that repeat another section's total: slips that don't count."""
    assets, debts, cadastral = F.col("total_otros_bienes"), F.col("total_pasivo"), F.col("total_catastral")
    same = lambda a, b: F.coalesce(a == b, F.lit(False))
    names = F.array(
        F.when((n_assets == 0) & same(assets, cadastral), "total_otros_bienes"),
        F.when((n_debts == 0) & (same(debts, assets) | same(debts, cadastral)), "total_pasivo"),
    )
    return F.filter(names, lambda x: x.isNotNull())


def flag_repeated_totals(declarations: DataFrame, assets: DataFrame, debts: DataFrame) -> DataFrame:
    """``declarations`` with totales_repetidos, and a note for each."""
    count = lambda t, c: t.groupBy("decl_id").agg(F.count("*").alias(c))
    out = declarations.join(count(assets, "_a"), "decl_id", "left").join(count(debts, "_d"), "decl_id", "left")
    out = out.withColumn("totales_repetidos", repeated_totals(F.coalesce("_a", F.lit(0)), F.coalesce("_d", F.lit(0))))
    note = F.transform("totales_repetidos", lambda x: F.when(x == "total_pasivo", REPEATED_DEBTS).otherwise(REPEATED_ASSETS))
    return out.withColumn("notas", F.concat(F.coalesce("notas", F.array().cast("array<string>")), note)).drop("_a", "_d")


def flag_misfiled_assets(debts: DataFrame) -> DataFrame:
    """``debts(categoria, descripcion, ...)`` where accounts, pensions and vehicles among them are ``posible_bien``."""
    own = F.col("categoria").isin("cuenta", "otros") & classify_asset("descripcion").isin("cuentas", "pensiones", "vehiculos")
    return debts.withColumn("categoria", F.when(own, "posible_bien").otherwise(F.col("categoria")))

