"""Queries on whole texts, amounts in print, stamps and titles."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patrimonia.functions import amounts as A
from patrimonia.functions import codes as C
from patrimonia.functions import text as T
from patrimonia.jobs.driver import DECLARATIONS, FORENAMES, ROSTER, SURNAMES, declarations, items, pick, read, roster, sql_pick
from patrimonia.operators import layout as L
from patrimonia.operators import sequence as Q
from patrimonia.sources import tables as IO
from patrimonia.sources.store import save, shared_folder

NORM = f"trim(regexp_replace(regexp_replace(upper(replace(translate(regexp_replace(coalesce({{}}, ''), '\\p{{{{Mn}}}}+', '', 'g'), '{T.ACCENTED}', '{T.PLAIN}'), 'ß', 'SS')), '[^A-Z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"


def sql_norm(c: str) -> str:
    return NORM.format(c)


PLAIN = f"translate(regexp_replace(coalesce(text, ''), '\\p{{Mn}}+', '', 'g'), '{T.ACCENTED}', '{T.PLAIN}')"


def _texts(function) -> Callable[[SparkSession, str], DataFrame]:  # noqa: ANN001
    return lambda spark, sf_dir: read(spark, sf_dir, "documents").select("doc_id", F.md5(F.coalesce(function("text"), F.lit("")).cast("binary")).alias("digest"))


def parse_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals printed in eight ways, and read back."""
    cents = F.round(F.col("o_totalprice").cast("decimal(20,4)") * 100).cast("long")
    whole, rest = F.floor(cents / 100), F.lpad((cents % 100).cast("string"), 2, "0")
    grouped = lambda sign: F.replace(F.format_number(whole, 0), F.lit(","), F.lit(sign))
    plain = whole.cast("string")
    ways = [
        F.concat(grouped("."), F.lit(","), rest, F.lit(" €")), F.concat(grouped(" "), F.lit(","), rest, F.lit("€")), F.concat(plain, F.lit(","), rest), F.concat(plain, F.lit("."), rest, F.lit(" EUR")),
        F.concat(plain, F.lit("'"), rest), F.concat(F.lit("-"), grouped("."), F.lit(","), rest), F.concat(grouped("."), F.lit(" euros")), F.lit("sin datos"),
    ]
    key = F.col("o_orderkey")
    text = F.get(F.array(*ways), F.pmod(key, F.lit(len(ways))).cast("int"))
    return read(spark, sf_dir, "orders").select("o_orderkey", A.parse_amount(text).alias("result"))


PARSE_AMOUNT = """
WITH c AS (SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(20,4)) * 100) AS BIGINT) AS cents FROM orders)
SELECT o_orderkey, CASE o_orderkey % 8 WHEN 5 THEN -(CAST(cents AS DOUBLE) / 100) WHEN 6 THEN CAST(cents // 100 AS DOUBLE) WHEN 7 THEN NULL ELSE CAST(cents AS DOUBLE) / 100 END AS result FROM c
"""


def slug_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    name, surname = pick((*FORENAMES, None), key), pick((*SURNAMES, None, ""), key)
    return read(spark, sf_dir, "orders").select("o_orderkey", T.slug_id(surname, name, F.concat(F.lit("X"), key.cast("string"))).alias("result"))


SLUG_ID = f"""
WITH n AS (SELECT o_orderkey, coalesce({sql_pick((*SURNAMES, None, ""), "o_orderkey")}, '') || ' ' || coalesce({sql_pick((*FORENAMES, None), "o_orderkey")}, '') AS full_name FROM orders)
SELECT o_orderkey, 'ex-' || coalesce(nullif(replace(lower({sql_norm("full_name")}), ' ', '-'), ''), 'X' || o_orderkey) AS result FROM n
"""


def extract_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps in each event's page: in the stamp words, in a scan's boxes and words near its top, or nowhere."""
    e = read(spark, sf_dir, "events")
    key = F.col("event_id")
    number, day = F.lpad((key % 1000000).cast("string"), 6, "0"), F.lpad((key % 28 + 1).cast("string"), 2, "0")
    seal = F.concat(F.lit("Registro X1"), number, F.lit(" "), day, F.lit("/03/2021 10:15"))
    word = lambda t, y: F.array(F.struct(t.alias("t"), F.lit(1.0).alias("x0"), F.lit(9.0).alias("x1"), y.alias("y0"), (y + 6).alias("y1"), F.lit(0).alias("v")))
    box = F.array(F.struct(F.lit(1.0).alias("x0"), F.lit(100.0).alias("y0"), F.lit(90.0).alias("x1"), F.when(key % 2 == 0, 110.0).otherwise(200.0).alias("y1"), seal.alias("t"), F.lit(0).alias("dudoso"), F.lit(None).cast("string").alias("alt")))
    pages = e.select(
        "event_id", F.when(key % 3 == 0, "ocr").otherwise("texto").alias("metodo"), F.when(key % 5 == 0, word(seal, F.lit(10.0))).alias("sello"), box.alias("casillas"),
        word(F.when(key % 7 == 0, seal).otherwise(F.lit("nada")), F.lit(300.0)).alias("palabras"),
    )
    return L.extract_stamp(pages).select("event_id", "seal", "fecha")


EXTRACT_STAMP = """
WITH e AS (SELECT event_id, event_id % 5 = 0 OR (event_id % 3 = 0 AND event_id % 2 = 0) OR (event_id % 3 <> 0 AND event_id % 7 = 0) AS has FROM events)
SELECT event_id, CASE WHEN has THEN 'XI' || lpad(CAST(event_id % 1000000 AS VARCHAR), 6, '0') END AS seal,
  CASE WHEN has THEN make_date(2021, 3, CAST(event_id % 28 + 1 AS INTEGER)) END AS fecha FROM e
"""


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised text of documents as pages of words, every third word written vertically."""
    words = F.transform(F.split(F.coalesce("text", F.lit("")), " "), lambda t, i: F.struct(t.alias("t"), F.when(i % 3 == 2, 1).otherwise(0).alias("v")))
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(L.page_text(words).cast("binary")).alias("digest"))


PAGE_TEXT = f"""
WITH w AS (SELECT doc_id, string_split(coalesce(text, ''), ' ') AS w FROM documents),
k AS (SELECT doc_id, array_to_string(list_filter(w, lambda x, i: i % 3 <> 0), ' ') AS t FROM w)
SELECT doc_id, md5({sql_norm("t")}) AS digest FROM k
"""


def source_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = declarations(spark, sf_dir, items(spark, sf_dir))
    return d.select("decl_id", C.source_links("url_pdf", "paginas").alias("l")).select("decl_id", "l.*")


SOURCE_LINKS = f"WITH {DECLARATIONS} SELECT decl_id, url_pdf || '#page=' || primera AS url, primera, ultima FROM de"


def reading_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    method = pick(("ocr", "texto", "manual"), key)
    return read(spark, sf_dir, "orders").select("o_orderkey", C.reading_status(key % 7 != 0, key % 5 == 0, method, key % 2 == 0).alias("result"))


READING_STATUS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 5 = 0 THEN 'sin leer' WHEN o_orderkey % 3 = 2 THEN 'a mano'
  WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'OCR ✓' WHEN o_orderkey % 3 = 0 THEN 'OCR' ELSE '' END AS result FROM orders
"""

TITLES = (
    "Declaraciones de actividades y bienes de la XI legislatura", "Declaraciones de actividades y bienes de la X legislatura", "Modificación de actividades y bienes",
    "Pregunta sobre actividades y bienes", "Declaración final de bienes", "Declaraciones finales de actividades y de bienes",
)


def _insertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(
        key.alias("pos"), (key % 500).alias("bulletin_id"), (key % 97).cast("int").alias("numero"), F.col("o_orderdate").cast("date").alias("fecha"), pick(TITLES, key).alias("titulo"), C.classify_insertion(pick(TITLES, key)).alias("tipo")
    )


def filter_insertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return IO.filter_insertions(_insertions(spark, sf_dir), "XI").select("pos", "titulo", "tipo")


FILTER_INSERTIONS = f"""
SELECT o_orderkey AS pos, {sql_pick(TITLES, "o_orderkey")} AS titulo, {sql_pick(("inicial", None, "modificacion", None, None, "final"), "o_orderkey")} AS tipo
FROM orders WHERE o_orderkey % 6 IN (0, 2, 5)
"""


def positions(ordered: DataFrame) -> DataFrame:
    """``ordered`` with position, from 1 in its order: rows are numbered within the sort's partitions, and those in a row."""
    rows = save(ordered.withColumn("_n", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_n", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as partitions
    starts = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.withColumn("part", part).join(starts, "part").withColumn("position", F.col("_n") - F.shiftleft("part", 33) + F.col("start") + 1).drop("part", "start", "_n")


def places(ordered: DataFrame, *keys: str) -> DataFrame:
    """The places that each value of the sort keys takes: from first to last, without gaps."""
    return positions(ordered).groupBy(*keys).agg(F.min("position").alias("first"), F.max("position").alias("last"), F.count("*").alias("n"))


def order_insertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places(IO.order_insertions(_insertions(spark, sf_dir)), "fecha", "numero", "tipo")


ORDER_INSERTIONS = f"""
WITH i AS (
  SELECT CAST(o_orderdate AS DATE) AS fecha, CAST(o_orderkey % 97 AS INTEGER) AS numero, {sql_pick(("inicial", "inicial", "modificacion", "inicial", "final", "final"), "o_orderkey")} AS tipo FROM orders),
r AS (SELECT *, row_number() OVER (ORDER BY fecha, numero, tipo) AS position FROM i)
SELECT fecha, numero, tipo, min(position) AS first, max(position) AS last, count(*) AS n FROM r GROUP BY ALL
"""


def first_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return IO.first_by_key(_insertions(spark, sf_dir), "bulletin_id", "pos").select("bulletin_id", "pos")


def select_bulletins(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("bulletin_id"))
    return IO.select_bulletins(read(spark, sf_dir, "documents").select(F.col("doc_id").alias("bulletin_id"), "lang"), wanted)


def extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return IO.extract_links(read(spark, sf_dir, "pages").select("page_id", "html"))


EXTRACT_LINKS = r"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '(?s)<a [^>]*>.*?</a>') AS ls FROM pages),
e AS (SELECT page_id, unnest(range(1, len(ls) + 1)) AS n, ls FROM l)
SELECT page_id, CAST(n - 1 AS INTEGER) AS pos, regexp_extract(ls[n], 'href="([^"]*)"', 1) AS href, trim(regexp_replace(ls[n], '<[^>]*>', '', 'g')) AS texto FROM e
"""


def extract_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster pages made of customers, ten rows each, some rows twice."""
    key = F.col("id")
    link = F.concat(F.lit('<a href="/es/composicion/diputados/xi/persona-'), key.cast("string"), F.lit("/"), F.md5(key.cast("string").cast("binary")), F.lit('">ficha</a>'))
    image = F.when(key % 4 == 0, F.concat(F.lit('<img title="'), F.col("grupo"), F.lit('">'))).otherwise(F.concat(F.lit('<img src="x.png" alt="Foto de  '), F.col("grupo"), F.lit('"/>')))
    row = F.concat(F.lit("<tr class='p'><td>"), link, F.lit("</td><td> "), F.col("apellidos"), F.lit(",\n  <b>"), F.col("nombre"), F.lit("</b></td><td>"), image, F.lit("</td><td>"), F.col("circunscripcion"), F.lit("</td></tr>"))
    rows = roster(spark, sf_dir).select("id", row.alias("tr"), F.floor(key / 10).alias("page_id"))
    rows = rows.unionByName(rows.where(key % 3 == 0).withColumn("page_id", F.col("page_id") + 1_000_000))
    html = F.concat(F.lit("<table><tbody><tr><td>sin ficha</td></tr>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "tr"))), lambda x: x["tr"]), "\n"), F.lit("</tbody></table>"))
    return IO.extract_roster(rows.groupBy("page_id").agg(html.alias("html"))).drop("roster_pos")


EXTRACT_ROSTER = f"""
WITH {ROSTER} SELECT md5(CAST(id AS VARCHAR)) AS id, 'persona-' || id AS slug, nombre, apellidos, grupo, circunscripcion FROM ro
"""


def read_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correction files made of customers, each with a help text and a full or person-only entry for every order status."""
    name = F.concat(F.lit("Persona "), F.col("c_custkey").cast("string"))
    person = F.struct(F.struct(name.alias("nombre")).alias("persona"), F.lit("solo nombre").alias("motivo"))
    full = F.struct(
        F.struct(name.alias("apellidos")).alias("persona"), F.array(F.struct(F.lit("P").alias("clave"), F.lit("V").alias("tipo"), F.lit(50.0).alias("porcentaje"), F.col("c_acctbal").alias("valor_catastral"))).alias("inmuebles"),
        F.array(F.struct(F.lit("Coche").alias("descripcion"), F.lit(1000.0).alias("valor"))).alias("otros_bienes"), F.col("c_acctbal").alias("total_catastral"),
    )
    body = F.when(F.col("c_custkey") % 2 == 0, F.to_json(full)).otherwise(F.to_json(person))
    text = F.concat(F.lit('{"_ayuda": "texto", "S'), F.col("c_custkey").cast("string"), F.lit('": '), body, F.lit("}"))
    out = IO.parse_corrections(read(spark, sf_dir, "customer").select(text.alias("value")))
    return out.select("seal", "motivo", "persona.nombre", "persona.apellidos", F.get("inmuebles", F.lit(0))["valor_catastral"].alias("valor"), F.size(F.coalesce("otros_bienes", F.array().cast(dict(out.dtypes)["otros_bienes"]))).alias("n_otros"), "total_catastral")


PARSE_CORRECTIONS = """
SELECT 'S' || c_custkey AS seal, CASE WHEN c_custkey % 2 = 1 THEN 'solo nombre' END AS motivo, CASE WHEN c_custkey % 2 = 1 THEN 'Persona ' || c_custkey END AS nombre,
  CASE WHEN c_custkey % 2 = 0 THEN 'Persona ' || c_custkey END AS apellidos, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS valor,
  CAST(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_otros, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS total_catastral FROM customer
"""


def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page files of each user, a page for each event, written and read again."""
    e = read(spark, sf_dir, "events")
    page = F.to_json(F.struct(F.col("event_id").cast("int").alias("num"), F.lit(842.0).alias("alto"), F.when(F.col("event_id") % 3 == 0, "ocr").otherwise("texto").alias("metodo"), F.array(F.struct(F.col("event_type").alias("t"), F.col("value").alias("x0"))).alias("palabras")))
    files = e.groupBy(F.concat(F.lit("B"), F.col("user_id").cast("string")).alias("bulletin_id")).agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list(page), ",\n"), F.lit("]")).alias("value"))
    path = f"{shared_folder(spark)}/tables/pages-{uuid.uuid4().hex}"
    files.write.partitionBy("bulletin_id").text(path)
    return IO.read_pages(spark, path).select("bulletin_id", "num", "metodo", F.get("palabras.t", F.lit(0)).alias("t"), F.get("palabras.x0", F.lit(0)).alias("x0"))


READ_PAGES = "SELECT 'B' || user_id AS bulletin_id, CAST(event_id AS INTEGER) AS num, CASE WHEN event_id % 3 = 0 THEN 'ocr' ELSE 'texto' END AS metodo, event_type AS t, value AS x0 FROM events"


def rejected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page files of each user, some cut short, some with pages that failed; what is rejected, by bulletin and reason."""
    e = read(spark, sf_dir, "events")
    failed = F.when(F.col("event_id") % 5 == 0, "roto")
    page = F.to_json(F.struct(F.col("event_id").cast("int").alias("num"), F.lit(842.0).alias("alto"), failed.alias("error")))
    text = F.concat(F.lit("["), F.array_join(F.collect_list(page), ","), F.when(F.col("user_id") % 4 == 0, "").otherwise("]"))
    files = e.groupBy("user_id").agg(text.alias("value")).select(F.concat(F.lit("B"), F.col("user_id").cast("string")).alias("bulletin_id"), "value")
    path = f"{shared_folder(spark)}/tables/pages-{uuid.uuid4().hex}"
    files.write.partitionBy("bulletin_id").text(path)
    return IO.rejected_pages(spark, path).groupBy("bulletin_id", "reason").agg(F.count("*").alias("n"), F.count("num").alias("n_paginas"))


REJECTED_PAGES = """
SELECT 'B' || user_id AS bulletin_id, 'broken file' AS reason, 1::BIGINT AS n, 0::BIGINT AS n_paginas FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 4 = 0)
UNION ALL SELECT 'B' || user_id, 'roto', count(*), count(*) FROM events WHERE user_id % 4 <> 0 AND event_id % 5 = 0 GROUP BY user_id
"""


def read_insertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search results of twenty files in ISO-8859-15, with tabs and line ends in their titles, written and read again."""
    key = F.col("o_orderkey")
    title = F.concat(F.lit("<HTML>"), F.regexp_replace(pick(TITLES, key), " y ", "\ty\r\n"), F.lit(" en ¤</HTML>"))
    one = F.struct(key.cast("string").alias("id_bocv"), (key % 97).cast("string").alias("numero_bocv"), title.alias("titulo"), F.date_format("o_orderdate", "yyyyMMdd").alias("fecha_publicacion"))
    files = read(spark, sf_dir, "orders").groupBy((key % 20).alias("part")).agg(F.struct(F.collect_list(one).alias("inserciones")).alias("dades"))
    path = f"{shared_folder(spark)}/tables/insertions-{uuid.uuid4().hex}"
    files.write.partitionBy("part").option("encoding", "ISO-8859-1").json(path)
    return IO.read_insertions(spark, path).drop("pos")


READ_INSERTIONS = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id_bocv, CAST(o_orderkey % 97 AS INTEGER) AS numero, CAST(o_orderdate AS DATE) AS fecha, replace({sql_pick(TITLES, "o_orderkey")}, ' y ', ' y ') || ' en €' AS titulo,
  {sql_pick(("inicial", "inicial", "modificacion", "inicial", "final", "final"), "o_orderkey")} AS tipo FROM orders
"""


def _turns(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Conversations as bulletins: the second word of each turn as a title, and the turns as pages."""
    turns = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("bulletin_id"), (F.col("turn") + 1).cast("int").alias("num"), "text")
    titles = turns.select("bulletin_id", F.col("num").alias("pos"), F.coalesce(F.get(F.split("text", " "), F.lit(1)), F.lit("")).alias("word"))
    return titles, turns


SQL_TURNS = """
p AS (SELECT conv_id, CAST(turn + 1 AS INTEGER) AS num, text FROM conversations),
k AS (SELECT conv_id, num AS pos, coalesce(string_split(text, ' ')[2], '') AS word FROM p)"""


def title_start_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last turn of a conversation that holds a turn's second word."""
    titles, turns = _turns(spark, sf_dir)
    titles = titles.withColumn("titulo", F.concat("word", F.lit(" [1234]")))
    return Q.title_start_page(titles, turns.select("bulletin_id", "num", T.norm_text("text").alias("texto"))).select("bulletin_id", "pos", "inicio")


TITLE_START_PAGE = f"""
WITH {SQL_TURNS}, n AS (SELECT conv_id, num, {sql_norm("text")} AS t FROM p), w AS (SELECT conv_id, pos, substr({sql_norm("word")}, 1, 70) AS key FROM k)
SELECT w.conv_id AS bulletin_id, w.pos, CAST(coalesce(max(n.num), 0) AS INTEGER) AS inicio FROM w LEFT JOIN n ON w.conv_id = n.conv_id AND w.key <> '' AND contains(n.t, w.key) GROUP BY 1, 2
"""


def contains_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation that hold the second word of one of its turns."""
    titles, turns = _turns(spark, sf_dir)
    return Q.contains_join(titles, turns, "bulletin_id", "word", "text").select("bulletin_id", "pos", "num")


CONTAINS_JOIN = f"WITH {SQL_TURNS} SELECT k.conv_id AS bulletin_id, k.pos, p.num FROM k JOIN p ON k.conv_id = p.conv_id AND k.word <> '' AND contains(p.text, k.word)"


def flag_disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two readings of a line's price: the same in other print, another number, a text, or none."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    a = F.replace(price.cast("string"), F.lit("."), F.lit(","))
    b = F.when(F.col("l_partkey") % 4 == 0, F.concat(price.cast("string"), F.lit(" €"))).when(F.col("l_partkey") % 4 == 1, (price + 1).cast("string")).when(F.col("l_partkey") % 4 == 2, F.lit("ilegible"))
    return read(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey")).agg(F.count_if(F.coalesce(L.disagreement(a, b), F.lit(False))).alias("n_dudosos"), F.count(L.disagreement(a, b)).alias("n_dobles"))


FLAG_DISAGREEMENT = "SELECT l_partkey, count(*) FILTER (l_partkey % 4 IN (1, 2)) AS n_dudosos, count(*) FILTER (l_partkey % 4 <> 3) AS n_dobles FROM lineitem GROUP BY l_partkey"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        parse_amount, slug_id, extract_stamp, page_text, source_links, reading_status, filter_insertions, order_insertions, first_by_key, select_bulletins,
        extract_links, extract_roster, read_corrections, read_pages, rejected_pages, read_insertions, title_start_page, contains_join, flag_disagreement,
    )
    return {"strip_accents": _texts(T.strip_accents), "norm_text": _texts(T.norm_text), "fold_text": _texts(T.fold_text)} | {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    digest = "SELECT doc_id, md5({}) AS digest FROM documents"
    return {
        "strip_accents": digest.format(PLAIN), "norm_text": digest.format(sql_norm("text")), "fold_text": digest.format(f"lower({PLAIN})"),
        "parse_amount": PARSE_AMOUNT, "slug_id": SLUG_ID, "extract_stamp": EXTRACT_STAMP, "page_text": PAGE_TEXT, "source_links": SOURCE_LINKS, "reading_status": READING_STATUS,
        "filter_insertions": FILTER_INSERTIONS, "order_insertions": ORDER_INSERTIONS, "first_by_key": "SELECT o_orderkey % 500 AS bulletin_id, min(o_orderkey) AS pos FROM orders GROUP BY 1",
        "select_bulletins": "SELECT doc_id AS bulletin_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
        "extract_links": EXTRACT_LINKS, "extract_roster": EXTRACT_ROSTER, "read_corrections": PARSE_CORRECTIONS, "read_pages": READ_PAGES, "rejected_pages": REJECTED_PAGES, "read_insertions": READ_INSERTIONS, "title_start_page": TITLE_START_PAGE, "contains_join": CONTAINS_JOIN,
        "flag_disagreement": FLAG_DISAGREEMENT,
    }
