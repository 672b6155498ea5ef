"""The weekly run from pages to published tables, on the forms that the queries make."""

import os

from pyspark.sql import functions as F

from patrimonia.jobs import bulletins as B
from patrimonia.jobs import people as P
from patrimonia.jobs.summary_queries import _bulletins

SF = "/root/testdata/sf0.001"
STATEMENTS = "person_id string, fecha_registro date, total_rentas double, total_salarios double, total_dividendos double, total_intereses double, total_otras double, cuota_irpf double"


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


def test_run_from_pages_to_tables(spark, tmp_path):
    checked = B.read_bulletins(*_bulletins(spark, SF))
    roster = spark.createDataFrame([("p1", "Marc", "Puig Martí", "Grupo", "Valencia", 1), ("p2", "Nadie", "Zzyzx", "Grupo", "Alicante", 2)], "id string, nombre string, apellidos string, grupo string, circunscripcion string, roster_pos long")
    owned, people = B.link_people(checked, roster)
    owner = {r.sello: (r.person_id, r.nombre, r.apellidos) for r in owned.select("sello", "person_id", "persona.nombre", "persona.apellidos").collect()}
    assert len(owner) == checked.count() and all(p for p, _, _ in owner.values())
    assert all(p == "p1" for p, n, a in owner.values() if (n, a) == ("Marc", "Puig Martí"))
    told = {r.id: r for r in people.collect()}
    assert {"p1", "p2"} <= set(told) and {p for p, _, _ in owner.values()} <= set(told)
    assert all(r.circunscripcion for r in told.values())  # former people have their declaration's district
    statements = spark.createDataFrame([("p1", None, 10.0, 10.0, 0.0, 0.0, 0.0, 2.0)], STATEMENTS)
    items = spark.createDataFrame([("p1", 1, "salarios", "sueldo", "", 10.0)], "person_id string, pos int, apartado string, concepto string, origen string, importe double")
    built = P.build(people.withColumn("url_ficha", F.lit(None).cast("string")), owned, statements, "cortes")
    B.publish(built, owned, items, statements, str(tmp_path))
    shown = {r.id: r for r in spark.read.parquet(f"{tmp_path}/parquet/personas").collect()}
    assert set(shown) == set(told) and shown["p2"].n_inmuebles is None and shown["p1"].n_inmuebles == 1 and shown["p1"].rentas == 10.0 and shown["p1"].ambito == "cortes"
    homes = spark.read.parquet(f"{tmp_path}/parquet/inmuebles").collect()
    assert len(homes) == sum(r.n_inmuebles or 0 for r in shown.values()) and all(r.valor_catastral > 0 for r in homes)
    assert spark.read.parquet(f"{tmp_path}/parquet/otros_bienes").count() >= 2 and spark.read.parquet(f"{tmp_path}/parquet/rentas").count() == 2
    docs = {r.id: r for r in spark.read.json(f"{tmp_path}/json/personas").collect()}
    assert docs["p1"].renta.rentas == 10.0 and len(docs["p1"].declaracion.inmuebles) == 1 and docs["p1"].historico and docs["p2"].declaracion is None and docs["p2"].calidad.revisar
    declared = spark.read.json(f"{tmp_path}/json/declaraciones")
    assert declared.count() == checked.count() and declared.where("size(inmuebles) = 1").count() == checked.count()

    # a later run of one bulletin replaces its folder and leaves the others' files
    before = files(f"{tmp_path}/json/declaraciones")
    B.publish(built, owned.where("bulletin_id = 'B1'").limit(1), items, statements, str(tmp_path))
    after = files(f"{tmp_path}/json/declaraciones")
    same = lambda x: {f: t for f, t in x.items() if "bulletin_id=B1/" not in f}
    assert same(before) == same(after) and before != after
    assert spark.read.json(f"{tmp_path}/json/declaraciones").where("bulletin_id = 'B1'").count() == 1
