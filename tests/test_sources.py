"""Files in and out, with invented content."""

import json

from pyspark.sql import functions as F

from patrimonia.sources import tables


def test_read_pages(spark, tmp_path):
    word = {"t": "hola", "x0": 1.0, "x1": 2.0, "y0": 3.0, "y1": 4.0, "v": 0}
    (tmp_path / "B7.json").write_text(json.dumps([{"num": 1, "ancho": 595.0, "alto": 842.0, "metodo": "texto", "palabras": [word], "casillas": []}, {"num": 2, "error": "roto"}], indent=1))
    got = tables.read_pages(spark, str(tmp_path)).orderBy("num").collect()
    assert [(r.bulletin_id, r.num, r.error) for r in got] == [("B7", 1, None), ("B7", 2, "roto")] and got[0].palabras[0].t == "hola"


def test_broken_files_are_rejected_and_counted(spark, tmp_path):
    good = {"num": 1, "alto": 842.0, "palabras": [], "casillas": []}
    (tmp_path / "B1.json").write_text(json.dumps([good, {"num": 2, "error": "roto"}]))
    (tmp_path / "B2.json").write_text(json.dumps([good, good])[:-20])
    (tmp_path / "B3.json").write_text("esto no es JSON")
    assert [(r.bulletin_id, r.num) for r in tables.read_pages(spark, str(tmp_path)).orderBy("num").collect()] == [("B1", 1), ("B1", 2)]
    assert sorted((r.bulletin_id, r.num, r.reason) for r in tables.rejected_pages(spark, str(tmp_path)).collect()) == [("B1", 2, "roto"), ("B2", None, "broken file"), ("B3", None, "broken file")]
    texts = spark.createDataFrame([("no",), ('{"_ayuda": "x", "X1": {"total_pasivo": 5}, "X2": {"total_pasivo": "cinco"}}',)], "value string")
    assert [r.seal for r in tables.parse_corrections(texts).collect()] == ["X1"]
    assert sorted((r.seal or "", r.reason) for r in tables.rejected_corrections(texts).collect()) == [("", "broken file"), ("X2", "broken entry")]


def test_insertions_keep_their_order_over_files(spark, tmp_path):
    for name, ids in (("b", "34"), ("a", "12"), ("c", "15")):
        (tmp_path / f"{name}.json").write_text(json.dumps({"dades": {"inserciones": [{"id_bocv": i, "titulo": f"{name}{i}"} for i in ids]}}))
    got = tables.read_insertions(spark, str(tmp_path)).repartition(5)
    assert [r.id_bocv for r in got.orderBy("pos").collect()] == list("123415")
    assert {r.titulo for r in tables.first_by_key(got, "id_bocv", "pos").collect()} == {"a1", "a2", "b3", "b4", "c5"}


def test_read_insertions(spark, tmp_path):
    raw = '{"dades": {"inserciones": [{"id_bocv": "1", "numero_bocv": "12", "titulo": "<HTML>Modificación\tde bienes en €</HTML>", "fecha_publicacion": "20240131"}, {"id_bocv": "2", "numero_bocv": "13", "titulo": "Declaración final\r\nde bienes", "fecha_publicacion": "mal"}]}}'
    (tmp_path / "lista.json").write_bytes(raw.encode("iso-8859-15"))
    got = tables.read_insertions(spark, str(tmp_path / "lista.json")).orderBy("pos").collect()
    assert [(r.numero, str(r.fecha), r.titulo, r.tipo) for r in got] == [(12, "2024-01-31", "Modificación de bienes en €", "modificacion"), (13, "None", "Declaración final de bienes", "final")]


def test_read_corrections(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"_ayuda": "cómo usarlo", "X1": {"motivo": "m", "inmuebles": [], "total_pasivo": 5}, "X2": {"persona": {"nombre": "Ada"}}}))
    got = {r.seal: r for r in tables.read_corrections(spark, str(tmp_path / "c.json")).collect()}
    assert set(got) == {"X1", "X2"} and got["X1"].inmuebles == [] and got["X2"].inmuebles is None and got["X2"].persona.nombre == "Ada" and got["X1"].total_pasivo == 5.0


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], 1.5)], "id long, provincias array<string>, v double")
    tables.write_tables({"personas": df}, str(tmp_path / "t"))
    assert spark.read.option("header", True).csv(str(tmp_path / "t/csv/personas")).first().provincias == "a; b"
    tables.write_documents(df, df, df, str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d/json/personas")).first().provincias == ["a", "b"]
    people = df.select(*(F.lit('di "go; x').alias(c) if c == "nombre" else F.array(F.lit("A"), F.lit("B")).alias(c) if c == "provincias_inmuebles" else F.lit(2.5).alias(c) if c == "pasivo" else F.lit(None).cast("string").alias(c) for c in tables.EXPORT_COLUMNS))
    tables.export_filtered(people, str(tmp_path / "e"))
    text = "".join(p.read_text(encoding="utf-8") for p in sorted((tmp_path / "e").glob("part-*")))
    assert text.startswith("﻿apellidos;nombre;") and ';"di ""go; x";' in text and '"A; B"' in text and ';"2,5";' in text
