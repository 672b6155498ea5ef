"""Declarations of a person: the one in force, the history, corrections, and what is published of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patrimonia.functions.codes import classify_asset, classify_liability

# Notices that the published tables carry.
PARTIAL_NOTICE = (
    "Hay una modificación posterior (BOCV {}) que parece parcial: no repite los inmuebles. Se muestra la declaración completa anterior"
)
EMPTY_NOTICE = "La última declaración publicada (BOCV {}) no trae bienes; se muestran los de la anterior"
TRANSCRIBED, RENAMED = "Transcrita a mano del original", "Nombre corregido a mano"
TOTALS = ("total_catastral", "total_otros_bienes", "total_pasivo")


def _true(c: str) -> Column:
    return F.coalesce(F.col(c) != 0, F.lit(False))


def has_assets(has_items: Column | None = None) -> Column:
    """Whether a declaration lists anything or states a total other than 0."""
    items = F.coalesce(F.col("has_items") if has_items is None else has_items, F.lit(False))
    return items | _true("total_catastral") | _true("total_otros_bienes") | _true("total_pasivo")


def _notice(text: str, number: Column) -> Column:
    before, after = text.split("{}")
    return F.concat(F.lit(before), number.cast("string"), F.lit(after))


def current_declaration(declarations: DataFrame) -> DataFrame:
    """(person_id, decl_id, aviso): the declaration in force of each person, and a notice where it isn't the last.

    ``declarations(person_id, decl_id, fecha_registro, numero, pos, tipo, has_property, has_items, totals)``. The
    last one counts, by date (none comes first), number and position, unless it is a modification without
    property or has no assets: then the latest earlier one with property, else the latest with assets, else it.
    """
    newest = Window.partitionBy("person_id").orderBy(F.col("fecha_registro").desc_nulls_last(), F.desc("numero"), F.desc("pos"))
    prop = F.coalesce("has_property", F.lit(False)) | _true("total_catastral")
    ranked = declarations.select("person_id", "decl_id", "numero", "tipo", has_assets().alias("full"), prop.alias("prop"), F.row_number().over(newest).alias("rn"))
    at = lambda cond: F.min(F.when(cond, F.struct("rn", "decl_id", "numero", "full", "prop", "tipo")))
    rn = F.col("rn")
    each = ranked.groupBy("person_id").agg(at(rn == 1).alias("last"), at((rn > 1) & F.col("prop")).alias("before"), at(F.col("full")).alias("some"))
    stands = F.col("last.full") & (F.col("last.prop") | (F.col("last.tipo") != "modificacion"))
    back = ~stands & F.col("before").isNotNull()
    notice = F.when(F.col("last.full"), _notice(PARTIAL_NOTICE, F.col("last.numero"))).otherwise(_notice(EMPTY_NOTICE, F.col("last.numero")))
    chosen = F.when(stands, F.col("last.decl_id")).when(back, F.col("before.decl_id")).otherwise(F.coalesce("some.decl_id", "last.decl_id"))
    return each.select("person_id", chosen.alias("decl_id"), F.when(back, notice).alias("aviso"))


def declaration_ref() -> Column:
    """How a declaration is referred to in histories."""
    return F.struct(
        "tipo", "fecha_registro", "sello", F.col("numero").alias("bocv"), "fecha_bocv",
        F.array(F.element_at("paginas", 1), F.element_at("paginas", -1)).alias("paginas"),
        F.concat("url_pdf", F.lit("#page="), F.element_at("paginas", 1).cast("string")).alias("url"), "metodo",
    )


def declaration_history(declarations: DataFrame) -> DataFrame:
    """(person_id, historico): references to all declarations of a person, by date (none comes first), number and position."""
    order = F.struct(F.coalesce(F.col("fecha_registro").cast("string"), F.lit("")).alias("d"), F.col("numero").alias("n"), F.col("pos").alias("p"))
    listed = declarations.groupBy("person_id").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), declaration_ref().alias("ref")))).alias("h"))
    return listed.select("person_id", F.transform("h", lambda x: x["ref"]).alias("historico"))


def publishable(declarations: DataFrame) -> DataFrame:
    """What is published of ``declarations`` with nested items: nothing read from an illegible one."""
    bad = F.coalesce("ilegible", F.lit(False))
    types = dict(declarations.dtypes)
    empty = {c: F.when(bad, F.array().cast(types[c])).otherwise(F.col(c)) for c in ("inmuebles", "otros_bienes", "pasivo")}
    return declarations.select("decl_id", declaration_ref().alias("ref"), *(v.alias(k) for k, v in empty.items()), *(F.when(~bad, F.col(t)).alias(t) for t in TOTALS)).select(
        "decl_id", "ref.*", "inmuebles", "otros_bienes", "pasivo", *TOTALS
    )


def correct_declarations(declarations: DataFrame, corrections: DataFrame) -> DataFrame:
    """``declarations`` with manual ``corrections(seal, motivo, persona, inmuebles, totals, ...)`` by seal.

    The person's known fields are always taken over. With items (``inmuebles`` not null) the totals are replaced,
    the method is ``manual``, and warnings, notes and doubts go; without, a note is added. ``corrected`` tells
    which items to replace.
    """
    c = corrections.select(F.col("seal").alias("sello"), F.struct(*(x for x in corrections.columns if x != "seal")).alias("c"))
    full, any_ = F.col("c.inmuebles").isNotNull(), F.col("c").isNotNull()
    person = F.struct(*(F.coalesce(f"c.persona.{x}", f"persona.{x}").alias(x) for x in ("nombre", "apellidos", "circunscripcion", "partido")))
    none = F.array().cast("array<string>")
    put = {t: F.when(full, F.col(f"c.{t}")).otherwise(F.col(t)) for t in TOTALS}
    put |= {
        "persona": F.when(any_, person).otherwise(F.col("persona")),
        "notas": F.when(full, F.array(F.coalesce("c.motivo", F.lit(TRANSCRIBED)))).when(any_, F.concat(F.coalesce("notas", none), F.array(F.coalesce("c.motivo", F.lit(RENAMED))))).otherwise(F.col("notas")),
        "avisos": F.when(full, none).otherwise(F.col("avisos")),
        "totales_repetidos": F.when(full, none).otherwise(F.col("totales_repetidos")),
        "metodo": F.when(full, F.lit("manual")).otherwise(F.col("metodo")),
        "ilegible": F.when(full, F.lit(False)).otherwise(F.col("ilegible")),
        "corrected": F.coalesce(full, F.lit(False)),
    }
    return declarations.join(c, "sello", "left").withColumns(put).drop("c")


def corrected_items(items: DataFrame, declarations: DataFrame, corrections: DataFrame, table: str) -> DataFrame:
    """``items`` of a table with those of corrected declarations replaced; ``declarations`` comes from correct_declarations."""
    done = declarations.where("corrected").select("decl_id", "sello", F.element_at("paginas", 1).alias("pagina"))
    kept = items.join(done.select("decl_id"), "decl_id", "left_anti")
    rows = done.join(corrections.select(F.col("seal").alias("sello"), F.col(table).alias("x")), "sello").select("decl_id", "pagina", F.posexplode("x").alias("pos", "x"))
    rows = rows.select("decl_id", "pagina", "pos", "x.*")
    rows = rows.withColumns({"valor_txt": F.lit(""), "dudoso": F.lit(False)})
    if table == "inmuebles":
        text = {f"{c}_txt": F.coalesce(F.col(c), F.lit("")) for c in ("clave", "tipo", "provincia")}
        rows = rows.withColumns(text | {"porcentaje_txt": F.lit("")})
    else:
        rows = rows.withColumn("categoria", classify_asset("descripcion") if table == "otros_bienes" else classify_liability("descripcion"))
    own = [F.col(c).cast(t).alias(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in kept.dtypes]
    return kept.unionByName(rows.select(*own))
