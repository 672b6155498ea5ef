"""Declarations checked, corrected, rated and summarised in their rows, against the operators on item tables."""

import random

from pyspark.sql import functions as F

from patrimonia.operators import nested as N
from patrimonia.operators import reconcile as R
from patrimonia.operators import summary as S
from patrimonia.sources.tables import parse_corrections

HOME = "decl_id long, pos int, clave string, tipo string, porcentaje double, provincia string, valor double, valor_txt string, pagina int, dudoso boolean, alts array<string>"
ITEM = "decl_id long, pos int, descripcion string, categoria string, valor double, valor_txt string, pagina int, dudoso boolean, alts array<string>"
DECLARATION = (
    "decl_id long, sello string, metodo string, paginas array<int>, persona struct<nombre:string,apellidos:string,circunscripcion:string,partido:string>, total_catastral double, "
    "total_otros_bienes double, total_pasivo double, avisos array<string>, notas array<string>"
)
PERSON = ("Ana", "Ros", None, None)


def tables(spark, homes, assets, debts):
    return {"inmuebles": spark.createDataFrame(homes, HOME), "otros_bienes": spark.createDataFrame(assets, ITEM), "pasivo": spark.createDataFrame(debts, ITEM)}


def some(seed, n):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, 10.0, 20.0, 20.0, 35.5])
    other = lambda: rng.choice([[], ["x", "30"], ["12", "45,5"]])
    homes, assets, debts, declared = [], [], [], []
    for d in range(n):
        for p in range(rng.randrange(4)):
            homes.append((d, p, "P", rng.choice(["V", "L", None]), rng.choice([None, 50.0, 100.0]), rng.choice(["Madrid", None, "", "Valencia"]), value() or 10.0, "", 1, rng.random() < 0.5, other()))
        for p in range(rng.randrange(3)):
            assets.append((d, p, "x", rng.choice(["cuentas", "vehiculos", "otros"]), value(), "", 1, rng.random() < 0.5, other()))
        for p in range(rng.randrange(3)):
            debts.append((d, p, rng.choice(["Cuenta en el banco", "Coche", "deuda"]), rng.choice(["cuenta", "otros", "hipoteca"]), value(), "", 1, None, None))
        total = lambda: rng.choice([None, 0.0, 20.0, 30.0, 40.0, 55.5])
        declared.append((d, f"X{d}", rng.choice(["ocr", "texto"]), [3, 4], PERSON, total(), total(), total(), rng.choice([None, ["a"]]), None))
    return declared, homes, assets, debts


def test_rows_equal_the_operators_on_tables(spark):
    declared, *items = some(1, 150)
    d, t = spark.createDataFrame(declared, DECLARATION), tables(spark, *items)
    checked = N.check_rows(N.nest(d, t)).cache()
    flat, out = {}, d
    for name, (total, flag, shares) in N.TABLES.items():
        fixed, flags = R.repair_with_alternatives(t[name], d.select("decl_id", F.col(total).alias("total")), "valor", "porcentaje" if shares else None)
        flat[name] = R.clear_doubt(fixed, flags)
        out = out.join(flags.withColumnRenamed("cuadra", flag), "decl_id", "left")
    flat["pasivo"] = R.flag_misfiled_assets(flat["pasivo"])
    for name in N.TABLES:
        columns = ["decl_id", "pos", "valor", "valor_txt", "dudoso", "corregido"] + ([] if name == "inmuebles" else ["categoria"])
        own = N.items_of(checked, name)
        own = own.withColumnRenamed("valor_catastral", "valor")
        assert sorted(map(str, own.select(columns).collect())) == sorted(map(str, flat[name].select(columns).collect())), name
    parts = [flat[t].select("decl_id", F.lit(t).alias("table"), *(F.col(c) if t == "inmuebles" else F.lit(None).cast("string").alias(c) for c in ("tipo", "provincia")), "dudoso") for t in N.TABLES]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    out = R.flag_repeated_totals(R.flag_illegible(out, every), flat["otros_bienes"], flat["pasivo"])
    shown = ["decl_id", *(f for _, f, _ in N.TABLES.values()), "ilegible", "totales_repetidos"]
    assert sorted(map(str, checked.select(shown).collect())) == sorted(map(str, out.select(shown).collect()))
    wrong = [r for r in checked.select("pasivo", "notas").collect() if any(x.categoria == "posible_bien" for x in r.pasivo) != (R.MISFILED in r.notas)]
    assert not wrong
    rated, told = N.rate_rows(checked), S.quality_report(out.withColumn("notas", F.col("notas")), every)
    assert sorted(map(str, rated.select("decl_id", "revisar", "comprobado").collect())) == sorted(map(str, told.select("decl_id", "revisar", "comprobado").collect()))
    columns = ["decl_id", "n_inmuebles", "n_viviendas", "n_viviendas_compartidas", "n_provincias", "provincias_inmuebles", "provincias_viviendas", "valor_catastral", "cuentas", "n_vehiculos", "otros_bienes", "pasivo", "tiene_hipoteca", "patrimonio_declarado"]
    summed = S.summarize_people(out, flat["inmuebles"].withColumnRenamed("valor", "valor_catastral"), flat["otros_bienes"], flat["pasivo"])
    assert sorted(map(str, N.summarize_rows(checked).select(columns).collect())) == sorted(map(str, summed.select(columns).collect()))


def test_transcribed_declarations_are_not_flagged_again(spark):
    declared = [(1, "X1", "ocr", [7], PERSON, 5.0, 5.0, None, ["aviso"], None), (2, "X2", "ocr", [8], PERSON, 5.0, 5.0, None, ["aviso"], None)]
    read = tables(spark, [], [], [(1, 0, "Cuenta corriente", "cuenta", 3.0, "3", 7, True, None), (2, 0, "Cuenta corriente", "cuenta", 3.0, "3", 8, True, None)])
    text = """{"_ayuda": "x", "X1": {"inmuebles": [], "pasivo": [{"descripcion": "Cuenta corriente", "valor": 9}], "total_catastral": 100, "total_otros_bienes": 100, "total_pasivo": 9}, "X2": {"persona": {"nombre": "Eva"}}}"""
    fixes = parse_corrections(spark.createDataFrame([(text,)], "value string"))
    done = {r.decl_id: r for r in N.summarize_rows(N.correct_rows(N.check_rows(N.nest(spark.createDataFrame(declared, DECLARATION), read)), fixes)).collect()}
    one, two = done[1], done[2]
    assert (one.metodo, one.totales_repetidos, one.avisos, one.notas, one.suma_pasivo_cuadra, one.suma_otros_cuadra) == ("manual", [], [], ["Transcrita a mano del original"], True, None)
    assert [(x.categoria, x.valor, x.pagina, x.dudoso) for x in one.lista_pasivo] == [("cuenta", 9.0, 7, False)] and one.otros_bienes == 100.0 and not one.has_property
    assert two.totales_repetidos == ["total_otros_bienes"] and two.notas == [R.REPEATED_ASSETS, R.MISFILED, "Nombre corregido a mano"] and two.persona.nombre == "Eva" and two.avisos == ["aviso"]
    assert [x.categoria for x in two.lista_pasivo] == ["posible_bien"] and two.otros_bienes == 0.0


def test_no_items_and_no_declarations(spark):
    none = tables(spark, [], [], [])
    assert N.check_rows(N.nest(spark.createDataFrame([], DECLARATION), none)).collect() == []
    r = N.check_rows(N.nest(spark.createDataFrame([(1, None, None, None, None, None, None, None, None, None)], DECLARATION), none)).first()
    assert (r.inmuebles, r.ilegible, r.suma_pasivo_cuadra, r.avisos, r.notas, r.has_items) == ([], False, None, [], [], False)
