"""Reading page layouts, insertions, rosters and corrections; writing the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patrimonia.functions.codes import classify_insertion, parse_pub_date

WORD = "struct<t:string,x0:double,x1:double,y0:double,y1:double,v:int>"
BOX = "struct<x0:double,y0:double,x1:double,y1:double,t:string,dudoso:int,alt:string>"
PAGE = f"num int, ancho double, alto double, metodo string, palabras array<{WORD}>, casillas array<{BOX}>, sello array<{WORD}>, error string"
INSERTIONS = "dades struct<inserciones: array<struct<id_bocv:string,numero_bocv:string,titulo:string,fecha_publicacion:string>>>"
CORRECTION = (
    "motivo string, persona struct<nombre:string,apellidos:string,circunscripcion:string,partido:string>, "
    "inmuebles array<struct<clave:string,tipo:string,porcentaje:double,provincia:string,valor_catastral:double>>, "
    "otros_bienes array<struct<descripcion:string,valor:double>>, pasivo array<struct<descripcion:string,valor:double>>, "
    "total_catastral double, total_otros_bienes double, total_pasivo double"
)
# Characters of ISO-8859-15 where ISO-8859-1, which Spark reads, has others.
LATIN1, LATIN9 = "¤¦¨´¸¼½¾", "€ŠšŽžŒœŸ"
#: Columns of the filtered export.
EXPORT_COLUMNS = (
    "apellidos", "nombre", "cargo", "grupo", "circunscripcion", "n_viviendas", "n_viviendas_compartidas", "n_inmuebles", "n_locales",
    "n_rusticos", "n_provincias", "provincias_inmuebles", "valor_catastral", "cuentas", "vehiculos", "inversiones", "otros_bienes", "pasivo",
    "tiene_hipoteca", "rentas", "cuota_irpf",
)


def _raw_pages(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(f"{PAGE}, _broken string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").json(path)
    if "bulletin_id" in raw.columns:
        return raw.withColumn("bulletin_id", F.col("bulletin_id").cast("string"))
    return raw.withColumn("bulletin_id", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.[A-Za-z]+)*$", 1))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page layouts of bulletins: files of JSON arrays of pages, named after their bulletin or in a folder ``bulletin_id=...`` each.

    Files that aren't JSON have no pages here; pages that failed when they were decoded have an ``error``, and no words.
    ``rejected_pages`` lists both.
    """
    return _raw_pages(spark, path).where("_broken IS NULL").drop("_broken")


def rejected_pages(spark: SparkSession, path: str) -> DataFrame:
    """(file, bulletin_id, num, reason) of what ``read_pages`` can't use: broken files (num is null), and pages with an error."""
    raw = _raw_pages(spark, path).select(F.col("_metadata.file_path").alias("file"), "bulletin_id", "num", "error", F.col("_broken").isNotNull().alias("broken"))
    return raw.where("broken OR error IS NOT NULL").select("file", "bulletin_id", F.when(~F.col("broken"), F.col("num")).alias("num"), F.when(F.col("broken"), "broken file").otherwise(F.col("error")).alias("reason"))


def read_insertions(spark: SparkSession, path: str) -> DataFrame:
    """(id_bocv, numero, fecha, titulo, tipo, pos) of search results in ISO-8859-15 with raw tabs and line ends in their texts.

    ``pos`` ascends with the file's path and the place in it, on every partitioning, so that the first of several files
    comes first. Broken files are left out.
    """
    raw = spark.read.schema(INSERTIONS).option("multiLine", True).option("encoding", "ISO-8859-1").option("allowUnquotedControlChars", True).json(path)
    rows = raw.select(F.col("_metadata.file_path").alias("_file"), F.posexplode("dades.inserciones").alias("_at", "x"))
    files = rows.select("_file").distinct().withColumn("_rank", F.row_number().over(Window.orderBy("_file")) - 1)  # a row for each file
    rows = rows.join(files, "_file")
    text = F.regexp_replace(F.translate("x.titulo", LATIN1, LATIN9), r"\t|\r\n", " ")
    title = F.trim(F.regexp_replace(text, "</?HTML>", ""))
    return rows.select(
        "x.id_bocv", F.col("x.numero_bocv").cast("int").alias("numero"), parse_pub_date("x.fecha_publicacion").alias("fecha"), title.alias("titulo"),
        classify_insertion(title).alias("tipo"), (F.col("_rank").cast("long") * (1 << 32) + F.col("_at")).alias("pos"),
    )


def filter_insertions(insertions: DataFrame, term: str) -> DataFrame:
    """Insertions that announce declarations of activities and assets of the legislature ``term`` (a Roman number)."""
    low = F.lower("titulo")
    other = low.rlike(r"\b[ivx]+ legislatura\b") & ~low.contains(f"de la {term.lower()} legislatura")
    return insertions.where(low.contains("actividades") & low.contains("bienes") & ~low.contains("pregunta") & ~other)


def order_insertions(insertions: DataFrame) -> DataFrame:
    """By date, number and kind."""
    return insertions.orderBy("fecha", "numero", "tipo")


def first_by_key(df: DataFrame, key: str, position: str) -> DataFrame:
    """The first row of each key by position."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(position))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def select_bulletins(df: DataFrame, wanted: DataFrame, key: str = "bulletin_id") -> DataFrame:
    """Rows whose bulletin is among ``wanted``."""
    return df.join(wanted.select(key), key, "left_semi")


def extract_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` exploded to the links of their HTML: position, href and text without tags."""
    found = F.regexp_extract_all(html, F.lit(r"(?s)(<a [^>]*>.*?</a>)"), F.lit(1))
    link = pages.select(*(c for c in pages.columns if c != html), F.posexplode(found).alias("pos", "link"))
    href = F.regexp_extract("link", r'href="([^"]*)"', 1)
    return link.withColumns({"href": href, "texto": F.trim(F.regexp_replace("link", "<[^>]*>", ""))}).drop("link")


def extract_roster(pages: DataFrame) -> DataFrame:
    """(id, slug, nombre, apellidos, grupo, circunscripcion, roster_pos) of ``pages(page_id, html)``: table rows with a link to a person.

    A person's link ends in ``/composicion/diputados/<term>/<slug>/<32 hex digits>``. The second cell is
    "Surname, Name", the third an image whose description names the group, the fourth the district. The first row
    of each id counts, by page and position.
    """
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?s)(<tr\b.*?</tr>)"), F.lit(1))).alias("n", "tr"))
    person = r'<a\b[^>]*href="[^"]*/composicion/diputados/[a-z]+/([^/"]+)/([0-9a-f]{32})'
    cells = F.regexp_extract_all("tr", F.lit(r"(?s)<td\b[^>]*>(.*?)</td>"), F.lit(1))
    text = lambda i: F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(F.get("cells", F.lit(i)), F.lit("")), "<[^>]*>", " "), r"\s+", " "))
    image = F.regexp_extract(F.coalesce(F.get("cells", F.lit(2)), F.lit("")), r"<img\b[^>]*>", 0)
    described = F.coalesce(F.nullif(F.regexp_extract(image, r'\balt="([^"]*)"', 1), F.lit("")), F.regexp_extract(image, r'\btitle="([^"]*)"', 1))
    out = rows.withColumns({"id": F.regexp_extract("tr", person, 2), "slug": F.regexp_extract("tr", person, 1), "cells": cells}).where("id <> ''")
    whole = text(1)
    out = out.select(
        "id", "slug", F.when(whole.contains(","), F.trim(F.regexp_replace(whole, "^[^,]*,", ""))).otherwise("").alias("nombre"), F.trim(F.substring_index(whole, ",", 1)).alias("apellidos"),
        F.trim(F.regexp_replace(described, r"^Foto de\s+", "")).alias("grupo"), text(3).alias("circunscripcion"), F.struct("page_id", "n").alias("roster_pos"),
    )
    return first_by_key(out, "id", "roster_pos")


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """Manual corrections: one JSON object keyed by seal; entries that aren't objects are help texts."""
    return parse_corrections(spark.read.text(path, wholetext=True))


def parse_corrections(texts: DataFrame) -> DataFrame:
    """(seal, motivo, persona, items, totals) of ``texts(value)``, each a whole file; what can't be read is left out."""
    entries = texts.select(F.explode(F.from_json("value", "map<string,string>")).alias("seal", "body")).where(F.ltrim("body").startswith("{"))
    read = entries.select("seal", F.from_json("body", f"{CORRECTION}, _broken string", {"columnNameOfCorruptRecord": "_broken"}).alias("c")).where("c._broken IS NULL")
    return read.select("seal", F.col("c").dropFields("_broken").alias("c")).select("seal", "c.*")


def rejected_corrections(texts: DataFrame) -> DataFrame:
    """(seal, reason) of what ``parse_corrections`` leaves out: broken files (seal is null), and entries with another form."""
    whole = texts.select(F.from_json("value", "map<string,string>").alias("m"))
    files = whole.where("m IS NULL OR size(m) = 0").select(F.lit(None).cast("string").alias("seal"), F.lit("broken file").alias("reason"))
    entries = whole.select(F.explode("m").alias("seal", "body")).where(F.ltrim("body").startswith("{"))
    read = entries.select("seal", F.from_json("body", f"{CORRECTION}, _broken string", {"columnNameOfCorruptRecord": "_broken"}).alias("c"))
    return files.unionByName(read.where("c._broken IS NOT NULL").select("seal", F.lit("broken entry").alias("reason")))


def listed(df: DataFrame, separator: str = "; ") -> DataFrame:
    """``df`` with its lists joined to texts, as CSV files hold them."""
    return df.select(*(F.array_join(c, separator).alias(c) if t.startswith("array<") else F.col(c) for c, t in df.dtypes))


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Each table as CSV with a header, lists joined, and as Parquet with lists as they are."""
    for name, df in tables.items():
        listed(df).write.mode("overwrite").option("header", True).csv(f"{folder}/csv/{name}")
        df.write.mode("overwrite").parquet(f"{folder}/parquet/{name}")


def write_documents(people: DataFrame, declarations: DataFrame, meta: DataFrame, folder: str, by: str = "bulletin_id") -> None:
    """Nested JSON lines: people, all declarations, and the run's counts.

    Declarations lie in a folder for each value of ``by``, where they have that column: those of the values in
    ``declarations`` are replaced, and all other files stay. The others are replaced whole.
    """
    for name, df in (("personas", people), ("declaraciones", declarations), ("meta", meta)):
        out = df.write.mode("overwrite")
        if name == "declaraciones" and by in df.columns:
            out = out.option("partitionOverwriteMode", "dynamic").partitionBy(by)
        out.json(f"{folder}/json/{name}")


def export_rows(people: DataFrame) -> DataFrame:
    """The export's columns as texts: decimal commas, lists joined by ``; ``, nulls empty."""
    kind = dict(people.dtypes)

    def told(c: str):  # noqa: ANN202
        if kind[c].startswith("array<"):
            return F.array_join(c, "; ")
        if kind[c] in ("double", "float") or kind[c].startswith("decimal"):
            whole = F.col(c) == F.floor(c)
            return F.replace(F.when(whole, F.col(c).cast("decimal(38,0)").cast("string")).otherwise(F.col(c).cast("string")), F.lit("."), F.lit(","))
        return F.col(c).cast("string")

    return people.select(*(F.coalesce(told(c), F.lit("")).alias(c) for c in EXPORT_COLUMNS))


def export_lines(people: DataFrame) -> DataFrame:
    """One text for each row of the export: ``;`` between cells, quotes only where a cell needs them."""
    rows = export_rows(people)
    quoted = lambda c: F.when(F.col(c).rlike('[",\n;]'), F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.col(c))
    return rows.select(F.concat_ws(";", *(quoted(c) for c in EXPORT_COLUMNS)).alias("value"))


def export_filtered(people: DataFrame, path: str) -> None:
    """The export for spreadsheets; each file begins with a byte-order mark and the header."""
    head = "﻿" + ";".join(EXPORT_COLUMNS)
    export_lines(people).withColumnRenamed("value", head).write.mode("overwrite").option("header", True).option("quote", "").option("sep", "\u0001").csv(path)
