"""A declaration with its items in its row: sums, repairs, doubts, flags, quality and summary as columns.

Items are brought to their declaration by one exchange; everything from there to the summary is row by row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrimonia.functions.amounts import parse_amount
from patrimonia.functions.codes import classify_asset, classify_liability
from patrimonia.operators import declarations as D
from patrimonia.operators import reconcile as R
from patrimonia.operators import summary as S

#: Table: (its declared total, whether its sum meets that, whether shares may be summed instead).
TABLES = {"inmuebles": ("total_catastral", "suma_inmuebles_cuadra", True), "otros_bienes": ("total_otros_bienes", "suma_otros_cuadra", False), "pasivo": ("total_pasivo", "suma_pasivo_cuadra", False)}
_SUM = "decimal(38,4)"
_TEXTS = "array<string>"


def nest(declarations: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``declarations(decl_id, ...)`` with the rows of each of ``tables(decl_id, pos, valor, ...)`` as an array by pos.

    A value is named ``valor`` in all tables. Declarations without items have empty arrays; items of no declaration are
    left out.
    """
    rows = None
    for name in TABLES:
        own = tables[name].withColumnRenamed("valor_catastral", "valor")
        own = own.select("decl_id", F.struct("pos", *(c for c in own.columns if c not in ("decl_id", "pos"))).alias(name))
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    each = rows.groupBy("decl_id").agg(*(F.array_sort(F.collect_list(t)).alias(t) for t in TABLES))
    out = declarations.join(each, "decl_id", "left")
    return out.withColumns({t: _items(out, t) for t in TABLES})


def _items(df: DataFrame, table: str) -> Column:
    return F.coalesce(table, F.array().cast(df.schema[table].dataType))


def items_of(nested: DataFrame, table: str) -> DataFrame:
    """The items of a table, a row each."""
    rows = nested.select("decl_id", F.explode(table).alias("x")).select("decl_id", "x.*")
    return rows.withColumnRenamed("valor", "valor_catastral") if table == "inmuebles" else rows


def _total(items: Column | str, value) -> Column:  # noqa: ANN001
    return F.aggregate(items, F.lit(0).cast(_SUM), lambda acc, x: (acc + F.coalesce(value(x).cast(R.MONEY), F.lit(0).cast(R.MONEY))).cast(_SUM))


def _count(items: Column | str, keep) -> Column:  # noqa: ANN001
    return F.size(F.filter(items, lambda x: F.coalesce(keep(x), F.lit(False))))


def _sums(table: str) -> Column:
    """struct(n, known, shared, whole, weighted) of a table's items."""
    shares = TABLES[table][2]
    part = lambda x: x["porcentaje"] if shares else F.lit(None).cast("double")
    return F.struct(
        F.size(table).alias("n"), _count(table, lambda x: x["valor"].isNotNull()).alias("known"), _count(table, lambda x: part(x).isNotNull()).alias("shared"),
        _total(table, lambda x: x["valor"]).cast("double").alias("whole"), _total(table, lambda x: x["valor"] * part(x) / 100).cast("double").alias("weighted"),
    )


def _fits(sums: Column, total: Column, more: Column, more_weighted: Column) -> Column:
    near = lambda a: F.coalesce(F.abs(a - total) <= R.TOLERANCE, F.lit(False))
    return near(sums["whole"] + more) | ((sums["shared"] == sums["n"]) & near(sums["weighted"] + more_weighted))


def sums_met(df: DataFrame) -> DataFrame:
    """``df`` with each table's sums (``_s_`` columns) and whether they meet its total: null without a total or items, or with an unknown value."""
    df = df.withColumns({f"_s_{t}": _sums(t) for t in TABLES})
    zero = F.lit(0.0)

    def met(t: str) -> Column:
        s, total = F.col(f"_s_{t}"), F.col(TABLES[t][0])
        return F.when(total.isNotNull() & (s["n"] > 0) & (s["known"] == s["n"]), _fits(s, total, zero, zero))

    return df.withColumns({flag: met(t) for t, (_, flag, _) in TABLES.items()})


def _fix(table: str) -> Column:
    """The first other reading of one item that meets the total, where the sum doesn't: struct(i, v, alt)."""
    total, flag, shares = TABLES[table]
    s = F.col(f"_s_{table}")
    tried = F.flatten(F.transform(table, lambda x, i: F.transform(F.coalesce(x["alts"], F.array().cast(_TEXTS)), lambda a: F.struct(
        i.alias("i"), parse_amount(a).alias("v"), a.alias("alt"), x["valor"].alias("was"), (x["porcentaje"] if shares else F.lit(None).cast("double")).alias("part")))))
    right = lambda y: _fits(s, F.col(total), y["v"] - y["was"], (y["v"] - y["was"]) * y["part"] / 100)
    return F.when(~F.col(flag), F.get(F.filter(tried, right), F.lit(0)))


def check_rows(nested: DataFrame) -> DataFrame:
    """Sums against totals, repairs from other readings, and what follows for doubts, legibility, totals and misfiled items.

    ``nested(decl_id, metodo, totals, avisos, notas, inmuebles, otros_bienes, pasivo, ...)``; null warnings and notes are
    none. Adds the flags of sums, ilegible, totales_repetidos, has_property, has_items, and corregido in items.
    """
    df = sums_met(nested)
    df = df.withColumns({f"_f_{t}": _fix(t) for t in TABLES})
    df = df.withColumns({flag: F.when(F.col(f"_f_{t}").isNotNull(), True).otherwise(F.col(flag)) for t, (_, flag, _) in TABLES.items()})

    def repaired(t: str) -> Column:
        fix, met = F.col(f"_f_{t}"), F.coalesce(TABLES[t][1], F.lit(False))
        hit = lambda i: F.coalesce(fix["i"] == i, F.lit(False))
        return F.transform(t, lambda x, i: x.withField("valor", F.when(hit(i), fix["v"]).otherwise(x["valor"])).withField("valor_txt", F.when(hit(i), fix["alt"]).otherwise(x["valor_txt"])).withField("dudoso", x["dudoso"] & ~met).withField("corregido", hit(i)))

    df = df.withColumns({t: repaired(t) for t in TABLES})
    doubtful = lambda x: x["dudoso"]
    n = F.size("inmuebles") + F.size("otros_bienes") + F.size("pasivo")
    doubt = _count("inmuebles", doubtful) + _count("otros_bienes", doubtful) + _count("pasivo", doubtful)
    met = F.lit(False)
    for _, flag, _ in TABLES.values():
        met = met | F.coalesce(flag, F.lit(False))
    misfiled = lambda x: x["categoria"].isin("cuenta", "otros") & classify_asset(x["descripcion"]).isin("cuentas", "pensiones", "vehiculos")
    df = df.withColumns({
        "ilegible": F.coalesce((F.col("metodo") == "ocr") & (n >= 3) & ~met & (2 * doubt >= n), F.lit(False)), "totales_repetidos": R.repeated_totals(F.size("otros_bienes"), F.size("pasivo")),
        "pasivo": F.transform("pasivo", lambda x: x.withField("categoria", F.when(misfiled(x), "posible_bien").otherwise(x["categoria"]))), "has_property": F.size("inmuebles") > 0, "has_items": n > 0,
    })
    none = F.array().cast(_TEXTS)
    repeated = F.transform("totales_repetidos", lambda x: F.when(x == "total_pasivo", R.REPEATED_DEBTS).otherwise(R.REPEATED_ASSETS))
    put = F.when(F.exists("pasivo", lambda x: F.coalesce(x["categoria"] == "posible_bien", F.lit(False))), F.array(F.lit(R.MISFILED))).otherwise(none)
    warned = F.when(F.col("ilegible"), F.array(F.lit(R.UNRELIABLE))).otherwise(none)
    df = df.withColumns({"avisos": F.concat(F.coalesce("avisos", none), warned), "notas": F.concat(F.coalesce("notas", none), repeated, put)})
    return df.drop(*(f"_{k}_{t}" for t in TABLES for k in "sf"))


def correct_rows(checked: DataFrame, corrections: DataFrame) -> DataFrame:
    """``check_rows`` output with manual corrections by seal, which come after all that was read and checked.

    Transcribed declarations have their items, totals and sums from the correction, and no repeated totals, misfiled
    items, doubts or warnings; corrections of the person only add a note to what was found.
    """
    c = corrections.select(F.col("seal").alias("sello"), *(F.col(t).alias(f"_c_{t}") for t in TABLES))
    df = D.correct_declarations(checked, corrections).join(c, "sello", "left")
    first = F.element_at("paginas", 1)

    def transcribed(t: str) -> Column:
        def item(x: Column, i: Column) -> Column:
            known = {"pos": i, "valor_txt": F.lit(""), "dudoso": F.lit(False), "corregido": F.lit(False), "pagina": first, "alts": F.array()}
            if t == "inmuebles":
                known |= {k: x[k] for k in ("clave", "tipo", "porcentaje", "provincia")} | {"valor": x["valor_catastral"], "porcentaje_txt": F.lit("")} | {f"{k}_txt": F.coalesce(x[k], F.lit("")) for k in ("clave", "tipo", "provincia")}
            else:
                known |= {"descripcion": x["descripcion"], "valor": x["valor"], "categoria": (classify_asset if t == "otros_bienes" else classify_liability)(x["descripcion"])}
            fields = checked.schema[t].dataType.elementType.fields
            return F.struct(*(known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))

        return F.when(F.col("corrected"), F.transform(F.coalesce(f"_c_{t}", F.array().cast(corrections.schema[t].dataType)), item)).otherwise(F.col(t))

    df = df.withColumns({t: transcribed(t) for t in TABLES}).drop(*(f"_c_{t}" for t in TABLES))
    read = {flag: F.col(flag) for _, flag, _ in TABLES.values()}
    df = df.withColumns({f"_r_{flag}": c for flag, c in read.items()})
    df = sums_met(df).withColumns({flag: F.when(F.col("corrected"), F.col(flag)).otherwise(F.col(f"_r_{flag}")) for flag in read})
    n = F.size("inmuebles") + F.size("otros_bienes") + F.size("pasivo")
    return df.withColumns({"has_property": F.size("inmuebles") > 0, "has_items": n > 0}).drop(*(f"_r_{flag}" for flag in read), *(f"_s_{t}" for t in TABLES))


def rate_rows(checked: DataFrame) -> DataFrame:
    """``checked`` with revisar, comprobado and motivos, as ``quality_report`` gives."""
    seen = {"_doubt": F.lit(0), "_type": _count("inmuebles", lambda x: x["tipo"].isNull()), "_prov": _count("inmuebles", lambda x: x["provincia"].isNull())}
    for t in TABLES:
        seen["_doubt"] = seen["_doubt"] + _count(t, lambda x: x["dudoso"])
    return S.rated(checked.withColumns(seen))


def summarize_rows(checked: DataFrame) -> DataFrame:
    """``checked`` with the sums and counts of its items, as ``summarize_people`` gives; items stay under ``lista_`` and the table's name."""
    df = checked.withColumnsRenamed({t: f"lista_{t}" for t in TABLES})
    homes, assets, debts = (f"lista_{t}" for t in TABLES)
    of = lambda k: lambda x: x["tipo"] == k
    cents = lambda c: F.round(c, 2).cast("double")
    total = lambda items, *kinds: cents(_total(items, lambda x: F.when(x["categoria"].isin(*kinds), x["valor"]) if kinds else x["valor"]))
    places = lambda keep: F.array_sort(F.array_distinct(F.transform(F.filter(homes, lambda x: keep(x) & (x["provincia"] != "")), lambda x: x["provincia"])))
    df = df.withColumns({
        "n_inmuebles": F.size(homes), "n_viviendas": _count(homes, of("V")), "n_viviendas_compartidas": _count(homes, lambda x: (x["tipo"] == "V") & (x["porcentaje"] < 100)), "n_locales": _count(homes, of("L")),
        "n_rusticos": _count(homes, of("R")), "n_otros_urbanos": _count(homes, of("O")), "provincias_inmuebles": places(lambda x: x["provincia"].isNotNull()), "provincias_viviendas": places(of("V")), "suma_catastral": cents(_total(homes, lambda x: x["valor"])),
        "cuentas": total(assets, "cuentas"), "vehiculos": total(assets, "vehiculos"), "n_vehiculos": _count(assets, lambda x: x["categoria"] == "vehiculos"), "inversiones": total(assets, "inversiones", "pensiones", "seguros"), "suma_otros": total(assets),
        "suma_pasivo": total(debts), "tiene_hipoteca": F.exists(debts, lambda x: F.coalesce(x["categoria"] == "hipoteca", F.lit(False))),
    })
    return S.summed(df.withColumn("suma_catastral", F.when(F.size(homes) > 0, F.col("suma_catastral"))))
