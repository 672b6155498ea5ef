"""One row for each person: sums of items, quality of the reading, income, published tables and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrimonia.operators.reconcile import MONEY, conditional_sum

# Texts and column lists of the published tables.
NO_DECLARATION = "No se ha localizado su declaración de bienes en los boletines"
QUOTA_CONCEPT = "Cuota IRPF del año anterior"
SUMS = (("suma_inmuebles_cuadra", "los inmuebles"), ("suma_otros_cuadra", "los otros bienes"), ("suma_pasivo_cuadra", "las deudas"))
OWNER = ("id", "apellidos", "nombre", "grupo")
PEOPLE_COLUMNS = (
    "id", "apellidos", "nombre", "ambito", "cargo", "en_activo", "grupo", "circunscripcion", "n_inmuebles", "n_viviendas",
    "n_viviendas_compartidas", "n_locales", "n_rusticos", "n_otros_urbanos", "n_provincias", "provincias_inmuebles", "provincias_viviendas",
    "valor_catastral", "cuentas", "vehiculos", "n_vehiculos", "inversiones", "otros_bienes", "pasivo", "tiene_hipoteca",
    "patrimonio_declarado", "rentas", "salarios", "otras_rentas", "cuota_irpf", "metodo_lectura", "revisar", "motivos_revision",
    "fecha_declaracion", "bocv", "url_declaracion", "url_ficha",
)
PROPERTY_COLUMNS = (*OWNER, "clave", "tipo", "porcentaje", "provincia", "valor_catastral", "clave_txt", "tipo_txt", "provincia_txt", "valor_txt", "bocv", "pagina", "metodo_lectura", "dudoso")
ITEM_COLUMNS = (*OWNER, "descripcion", "categoria", "valor", "valor_txt", "bocv", "pagina", "metodo_lectura", "dudoso")
INCOME_COLUMNS = (*OWNER, "fecha_registro", "apartado", "concepto", "origen", "importe")


def _money(x: Column) -> Column:
    return F.round(x.cast(MONEY), 2).cast("double")


def summarize_properties(items: DataFrame) -> DataFrame:
    """Counts, provinces and the cadastral sum of each declaration's properties."""
    homes = F.col("tipo") == "V"
    of = lambda t: F.count_if(F.coalesce(F.col("tipo") == t, F.lit(False))).cast("int")
    return items.groupBy("decl_id").agg(
        F.count("*").cast("int").alias("n_inmuebles"), of("V").alias("n_viviendas"),
        F.count_if(F.coalesce(homes & (F.col("porcentaje") < 100), F.lit(False))).cast("int").alias("n_viviendas_compartidas"),
        of("L").alias("n_locales"), of("R").alias("n_rusticos"), of("O").alias("n_otros_urbanos"),
        F.array_sort(F.collect_set(F.nullif("provincia", F.lit("")))).alias("provincias_inmuebles"),
        F.array_sort(F.collect_set(F.when(homes, F.nullif("provincia", F.lit(""))))).alias("provincias_viviendas"),
        conditional_sum("valor_catastral").alias("suma_catastral"),
    )


def summarize_assets(items: DataFrame) -> DataFrame:
    """Sums by class of each declaration's other assets."""
    of = lambda *names: F.col("categoria").isin(*names)
    return items.groupBy("decl_id").agg(
        conditional_sum("valor", of("cuentas")).alias("cuentas"), conditional_sum("valor", of("vehiculos")).alias("vehiculos"),
        F.count_if(of("vehiculos")).cast("int").alias("n_vehiculos"),
        conditional_sum("valor", of("inversiones", "pensiones", "seguros")).alias("inversiones"), conditional_sum("valor").alias("suma_otros"),
    )


def summarize_debts(items: DataFrame) -> DataFrame:
    """The sum of each declaration's debts, and whether one is a mortgage."""
    return items.groupBy("decl_id").agg(conditional_sum("valor").alias("suma_pasivo"), F.coalesce(F.bool_or(F.col("categoria") == "hipoteca"), F.lit(False)).alias("tiene_hipoteca"))


_COUNTS = ("n_inmuebles", "n_viviendas", "n_viviendas_compartidas", "n_locales", "n_rusticos", "n_otros_urbanos")


def summarize_people(declarations: DataFrame, properties: DataFrame, assets: DataFrame, debts: DataFrame) -> DataFrame:
    """The summary of each of ``declarations(decl_id, ilegible, totals, totales_repetidos, ...)``; its other columns stay.

    Each item table is added up before it is joined. The declared cadastral total counts where there is one; of
    the other sections the larger of lines and total, but no repeated total. An illegible declaration, and a row
    without decl_id, gets nulls and empty lists.
    """
    out = declarations
    for part in (summarize_properties(properties), summarize_assets(assets), summarize_debts(debts)):
        out = out.join(part, "decl_id", "left")
    return summed(out)


def summed(out: DataFrame) -> DataFrame:
    """Declarations with the sums and counts of their items as they are published, by the rules of ``summarize_people``."""
    bad = F.coalesce("ilegible", F.lit(False)) | F.col("decl_id").isNull()
    put = lambda c, other: F.when(~bad, F.coalesce(c, other))
    total = lambda c: F.when(~F.array_contains(F.coalesce("totales_repetidos", F.array().cast("array<string>")), c), F.col(c))
    none = F.array().cast("array<string>")
    out = out.withColumns({c: put(F.col(c), F.lit(0)) for c in (*_COUNTS, "n_vehiculos")})
    out = out.withColumns({c: F.when(bad, none).otherwise(F.coalesce(c, none)) for c in ("provincias_inmuebles", "provincias_viviendas")})
    out = out.withColumns({c: put(F.col(c), F.lit(0.0)) for c in ("cuentas", "vehiculos", "inversiones")})
    out = out.withColumns(
        {
            "n_provincias": F.when(~bad, F.size("provincias_inmuebles")),
            "valor_catastral": F.when(~bad, F.coalesce("total_catastral", "suma_catastral", F.lit(0.0))),
            "otros_bienes": F.when(~bad, F.greatest(F.coalesce("suma_otros", F.lit(0.0)), F.coalesce(total("total_otros_bienes"), F.lit(0.0)))),
            "pasivo": F.when(~bad, F.greatest(F.coalesce("suma_pasivo", F.lit(0.0)), F.coalesce(total("total_pasivo"), F.lit(0.0)))),
            "tiene_hipoteca": put(F.col("tiene_hipoteca"), F.lit(False)),
        }
    )
    worth = F.col("valor_catastral").cast(MONEY) + F.col("otros_bienes").cast(MONEY) - F.col("pasivo").cast(MONEY)
    return out.withColumn("patrimonio_declarado", F.round(worth, 2).cast("double")).drop("suma_catastral", "suma_otros", "suma_pasivo")


def attach_income(people: DataFrame, income: DataFrame) -> DataFrame:
    """``people(id, ...)`` with rentas, salarios, otras_rentas and cuota_irpf of ``income(person_id, ...)``; null without one."""
    own = income.select(
        F.col("person_id").alias("id"), F.lit(True).alias("tiene_renta"), F.col("total_rentas").alias("rentas"), F.col("total_salarios").alias("salarios"),
        _money(F.coalesce(F.col("total_rentas").cast(MONEY), F.lit(0).cast(MONEY)) - F.coalesce(F.col("total_salarios").cast(MONEY), F.lit(0).cast(MONEY))).alias("otras_rentas"), "cuota_irpf",
    )
    return people.join(own, "id", "left").withColumn("tiene_renta", F.coalesce("tiene_renta", F.lit(False)))


def income_totals(items: DataFrame, key: str = "doc_id") -> DataFrame:
    """Totals by section and overall of ``items(key, apartado, importe)``, to the cent."""
    of = lambda s: conditional_sum("importe", F.col("apartado") == s).alias(f"total_{s}")
    return items.groupBy(key).agg(of("salarios"), of("dividendos"), of("intereses"), of("otras"), conditional_sum("importe").alias("total_rentas"))


def quality_report(declarations: DataFrame, items: DataFrame) -> DataFrame:
    """``declarations`` with revisar, comprobado and motivos.

    ``items(decl_id, table, tipo, provincia, dudoso)`` holds all items, table being ``inmuebles`` for properties.
    Reading problems ask for a review; what the person wrote is a note. A sum that isn't met is a reading problem
    in scanned forms only. A row without decl_id has no declaration.
    """
    prop = F.col("table") == "inmuebles"
    seen = items.groupBy("decl_id").agg(
        F.count_if(F.coalesce("dudoso", F.lit(False))).alias("_doubt"), F.count_if(prop & F.col("tipo").isNull()).alias("_type"), F.count_if(prop & F.col("provincia").isNull()).alias("_prov")
    )
    return rated(declarations.join(seen, "decl_id", "left"))


def rated(out: DataFrame) -> DataFrame:
    """Declarations with counts of doubts, unknown types and provinces (_doubt, _type, _prov) as ``quality_report`` rates them."""
    legible, ocr = ~F.coalesce("ilegible", F.lit(False)), F.coalesce(F.col("metodo") == "ocr", F.lit(False))
    counted = lambda c, text: F.when(legible & (F.col(c) > 0), F.concat(F.col(c).cast("string"), F.lit(text)))
    wrong = lambda c: legible & F.coalesce(~F.col(c), F.lit(False))
    sentence = lambda name: f"La suma de {name} no coincide con el total declarado"
    known = lambda *xs: F.filter(F.array(*xs), lambda x: x.isNotNull())
    none = F.array().cast("array<string>")
    reading = F.concat(
        F.coalesce("avisos", none),
        known(
            counted("_doubt", " dato(s) con lectura dudosa del OCR"),
            *(F.when(wrong(c) & ocr, sentence(n)) for c, n in SUMS),
            counted("_type", " inmueble(s) sin tipo reconocible"),
            counted("_prov", " inmueble(s) sin provincia reconocible"),
        ),
    )
    notes = F.concat(F.coalesce("notas", none), known(*(F.when(wrong(c) & ~ocr, sentence(n) + " (así consta en el original)") for c, n in SUMS)))
    missing = F.col("decl_id").isNull()
    made = F.array(*(F.col(c) for c, _ in SUMS))
    done = F.exists(made, lambda x: x.isNotNull()) & F.forall(made, lambda x: F.coalesce(x, F.lit(True)))
    return out.withColumns(
        {
            "revisar": missing | (F.size(reading) > 0),
            "comprobado": ~missing & done,
            "motivos": F.when(missing, F.array(F.lit(NO_DECLARATION))).otherwise(F.concat(reading, notes)),
        }
    ).drop("_doubt", "_type", "_prov")


def put_notice_first(df: DataFrame) -> DataFrame:
    """Rows with an ``aviso`` have it as their first reason and ask for a review."""
    has = F.col("aviso").isNotNull()
    return df.withColumns({"motivos": F.when(has, F.concat(F.array("aviso"), "motivos")).otherwise(F.col("motivos")), "revisar": has | F.col("revisar")})


def run_metadata(people: DataFrame) -> DataFrame:
    """Eight counts over ``people``."""
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return people.agg(
        F.count("*").alias("n_personas"), count(F.col("en_activo")).alias("n_en_activo"), F.count("decl_id").alias("n_con_declaracion"),
        count(F.col("metodo") == "ocr").alias("n_por_ocr"), count(F.col("comprobado")).alias("n_comprobadas"), count(F.col("ilegible")).alias("n_ilegibles"),
        count(F.col("revisar")).alias("n_revisar"), count(F.col("tiene_renta")).alias("n_con_renta"),
    )


def bulletin_counts(pages: DataFrame, insertions: DataFrame, declarations: DataFrame) -> DataFrame:
    """Pages, insertions and declarations of each bulletin that has pages."""
    n = lambda t, c: t.groupBy("bulletin_id").agg(F.count("*").alias(c))
    out = n(pages, "n_paginas").join(n(insertions, "n_inserciones"), "bulletin_id", "left").join(n(declarations, "n_declaraciones"), "bulletin_id", "left")
    return out.fillna(0, ["n_inserciones", "n_declaraciones"])


def flatten_items(people: DataFrame, items: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Items of the declarations in force, with their owner and source: ``columns`` of the published table.

    ``people(id, apellidos, nombre, grupo, decl_id, bocv, metodo, ilegible)``; illegible declarations publish no items.
    """
    owner = people.where(~F.coalesce("ilegible", F.lit(False))).select(*OWNER, "decl_id", "bocv", F.col("metodo").alias("metodo_lectura"))
    return items.join(owner, "decl_id").select(*columns)


def union_income_quota(people: DataFrame, items: DataFrame, statements: DataFrame) -> DataFrame:
    """The income table: items of each person, and one row for a tax quota where there is one."""
    owner = people.select(*OWNER)
    dates = statements.select(F.col("person_id").alias("id"), "fecha_registro", "cuota_irpf")
    lines = items.withColumnRenamed("person_id", "id").join(dates.drop("cuota_irpf"), "id").join(owner, "id").select(*INCOME_COLUMNS)
    quota = dates.where("cuota_irpf is not null").join(owner, "id").select(
        *OWNER, "fecha_registro", F.lit("irpf").alias("apartado"), F.lit(QUOTA_CONCEPT).alias("concepto"), F.lit("").alias("origen"), F.col("cuota_irpf").alias("importe")
    )
    return lines.unionByName(quota)
