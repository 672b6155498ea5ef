"""Queries on ordered pages, lines and declarations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patrimonia.jobs import income as I
from patrimonia.jobs.driver import DECLARATIONS, declarations, items, pick, read, sql_pick
from patrimonia.operators import declarations as D
from patrimonia.operators import layout as L
from patrimonia.operators import sequence as Q
from patrimonia.operators import summary as S


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bulletin for each user: its events are pages, signups covers."""
    key = F.col("event_id")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("bulletin_id"), F.row_number().over(order).alias("num"), (F.col("event_type") == "signup").alias("is_cover"),
        F.when(key % 4 != 0, F.concat(F.lit("X"), (key % 3).cast("string"))).alias("seal"), F.when(key % 5 < 3, "ocr").otherwise("texto").alias("metodo"),
        F.col("ts").cast("date").alias("fecha"), "event_id", "event_type",
    )


PAGES = """
pg AS (
  SELECT user_id AS bulletin_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS num, event_type = 'signup' AS is_cover,
    CASE WHEN event_id % 4 <> 0 THEN 'X' || (event_id % 3) END AS seal, CASE WHEN event_id % 5 < 3 THEN 'ocr' ELSE 'texto' END AS metodo, CAST(ts AS DATE) AS fecha, event_id, event_type
  FROM events)"""
#: The sequential rule, page by page: gid counts covers that start; opened tells whether a declaration goes on.
SESSIONS = f"""{PAGES},
ses AS (
  SELECT bulletin_id, num, seal, metodo, fecha, CASE WHEN is_cover AND (seal IS NOT NULL OR metodo = 'ocr') THEN 1 ELSE 0 END AS gid,
    is_cover AND (seal IS NOT NULL OR metodo = 'ocr') AS opened, seal AS s0, metodo AS m0 FROM pg WHERE num = 1
  UNION ALL
  SELECT p.bulletin_id, p.num, p.seal, p.metodo, p.fecha, s.gid + CASE WHEN p.is_cover AND (p.seal IS NOT NULL OR p.metodo = 'ocr') THEN 1 ELSE 0 END,
    (p.is_cover AND (p.seal IS NOT NULL OR p.metodo = 'ocr')) OR (s.opened AND coalesce(p.seal = s.s0, FALSE)) OR (s.opened AND p.seal IS NULL AND p.metodo = 'ocr' AND s.m0 = 'ocr'),
    CASE WHEN p.is_cover AND (p.seal IS NOT NULL OR p.metodo = 'ocr') THEN p.seal ELSE s.s0 END, CASE WHEN p.is_cover AND (p.seal IS NOT NULL OR p.metodo = 'ocr') THEN p.metodo ELSE s.m0 END
  FROM ses s JOIN pg p ON p.bulletin_id = s.bulletin_id AND p.num = s.num + 1)"""


def sessionize_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.sessionize_pages(_pages(spark, sf_dir)).select("bulletin_id", "num", "gid")


def declaration_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = Q.declaration_header(Q.sessionize_pages(_pages(spark, sf_dir)))
    return out.select("decl_id", "sello", "fecha_registro", F.size("paginas").alias("n_paginas"), F.element_at("paginas", -1).alias("ultima"), "metodo")


DECLARATION_HEADER = f"""
WITH RECURSIVE {SESSIONS}
SELECT bulletin_id || ':' || gid AS decl_id, coalesce(arg_min(seal, num) FILTER (num = first), 'sin-sello-p' || min(num)) AS sello, arg_min(fecha, num) AS fecha_registro,
  CAST(count(*) AS INTEGER) AS n_paginas, CAST(max(num) AS INTEGER) AS ultima, CASE WHEN bool_or(metodo = 'ocr') THEN 'ocr' ELSE 'texto' END AS metodo
FROM (SELECT *, min(num) OVER (PARTITION BY bulletin_id, gid) AS first FROM ses WHERE opened) GROUP BY bulletin_id, gid
"""


def asof_insertion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the last view of its user that comes before it, else the user's first."""
    p = _pages(spark, sf_dir)
    views = p.where("event_type = 'view'").select("bulletin_id", F.col("num").alias("inicio"), F.col("event_id").alias("pos"), F.col("event_id").alias("insertion"), F.col("metodo").alias("tipo"))
    bought = p.where("event_type = 'purchase'").select("bulletin_id", F.col("num").alias("first_page"), "event_id")
    return Q.asof_insertion(bought, views, ["insertion", "tipo"]).select("event_id", "insertion", "tipo")


ASOF_INSERTION = f"""
WITH {PAGES},
v AS (SELECT bulletin_id, num, event_id AS insertion, metodo AS tipo FROM pg WHERE event_type = 'view'),
f AS (SELECT bulletin_id, arg_min(insertion, num) AS insertion, arg_min(tipo, num) AS tipo FROM v GROUP BY bulletin_id),
b AS (SELECT bulletin_id, num, event_id FROM pg WHERE event_type = 'purchase')
SELECT b.event_id, coalesce(v.insertion, f.insertion) AS insertion, coalesce(v.tipo, f.tipo) AS tipo
FROM b ASOF LEFT JOIN v ON b.bulletin_id = v.bulletin_id AND b.num >= v.num LEFT JOIN f ON f.bulletin_id = b.bulletin_id
"""


def bulletin_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _pages(spark, sf_dir)
    heads = Q.declaration_header(Q.sessionize_pages(p))
    return S.bulletin_counts(p.select("bulletin_id"), p.where("event_type = 'view'").select("bulletin_id"), heads.select("bulletin_id"))


BULLETIN_COUNTS = f"""
WITH RECURSIVE {SESSIONS},
d AS (SELECT bulletin_id, count(DISTINCT gid) AS n FROM ses WHERE opened GROUP BY bulletin_id)
SELECT p.bulletin_id, count(*) AS n_paginas, count(*) FILTER (event_type = 'view') AS n_inserciones, coalesce(any_value(d.n), 0) AS n_declaraciones
FROM pg p LEFT JOIN d ON d.bulletin_id = p.bulletin_id GROUP BY p.bulletin_id
"""

_MARKS = ("I.", "II.", "III.", "IV.", "V.")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of income forms: a turn of a conversation each, by turn a section mark, column titles, civil status or an amount."""
    c = read(spark, sf_dir, "conversations")
    key, turn, size = F.col("conv_id"), F.col("turn"), F.length(F.coalesce("text", F.lit("")))
    w = lambda *pairs: F.array(*(F.struct(t.alias("t"), x.cast("double").alias("x0")) for t, x in pairs))
    text = F.lit
    mark = pick(_MARKS, key + turn)
    columns = w((text("Concepte"), F.lit(50)), (text("Origen"), key % 50 + 200), (text("Quantia"), key % 50 + 400))
    amount = w((text("(cid:3)Nomina+"), F.lit(50)), (text("Empresa"), F.lit(320)), (F.concat(size.cast("string"), F.lit(",50")), F.lit(500)), (text("€"), F.lit(530)))
    status = F.when(key % 2 == 0, w((text("Estat"), F.lit(50)), (text("civil"), F.lit(70)))).otherwise(w((text("Casada"), F.lit(50)), (text("Gananciales"), F.lit(300))))
    words = F.when(turn % 4 == 0, w((mark, F.lit(10)), (text("a"), F.lit(20)), (text("b"), F.lit(30)), (text("c"), F.lit(40)))).when((turn % 4 == 1) & (key % 3 == 0), columns).when((turn % 4 == 2) & (key % 5 != 0), status).otherwise(amount)
    return c.select(key.alias("doc_id"), F.lit(0).alias("page"), turn.alias("line"), words.alias("words"))


LINES = f"""
li AS (
  SELECT conv_id AS doc_id, turn, length(coalesce(text, '')) AS size,
    CASE WHEN turn % 4 = 0 THEN 'section' WHEN turn % 4 = 1 AND conv_id % 3 = 0 THEN 'columns' WHEN turn % 4 = 2 AND conv_id % 5 <> 0 THEN CASE WHEN conv_id % 2 = 0 THEN 'status' ELSE 'name' END ELSE 'amount' END AS k,
    {sql_pick(("salarios", "dividendos", "intereses", "otras", "irpf"), "(conv_id + turn)")} AS mark FROM conversations),
ca AS (
  SELECT *, last_value(CASE WHEN k = 'section' THEN mark END IGNORE NULLS) OVER w AS section, count(*) FILTER (k = 'status') OVER w AS asked,
    coalesce(last_value(CASE WHEN k = 'columns' THEN conv2 + 197.0 END IGNORE NULLS) OVER w, 290.0) AS x_origin, coalesce(last_value(CASE WHEN k = 'columns' THEN conv2 + 397.0 END IGNORE NULLS) OVER w, 430.0) AS x_amount
  FROM (SELECT *, doc_id % 50 AS conv2 FROM li) WINDOW w AS (PARTITION BY doc_id ORDER BY turn)),
va AS (SELECT *, k IN ('name', 'amount') AND asked > 0 AND row_number() OVER (PARTITION BY doc_id, asked, k IN ('name', 'amount') ORDER BY turn) = 1 AS is_value FROM ca),
inl AS (
  SELECT doc_id, turn, section AS apartado, CAST(size AS DOUBLE) + 0.5 AS importe, section = 'irpf' AS is_quota, CASE WHEN section = 'salarios' THEN CASE WHEN 320 < x_origin THEN 'Nomina+ Empresa' ELSE 'Nomina' END ELSE 'Nomina+ Empresa' END AS concepto,
    CASE WHEN section = 'salarios' AND 320 >= x_origin THEN 'Empresa' ELSE '' END AS origen FROM va WHERE k = 'amount' AND NOT is_value AND section IS NOT NULL)"""


def carry_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = Q.carry_sections(_lines(spark, sf_dir))
    return out.select("doc_id", "line", (F.col("kind") == "value").alias("is_value"), "section", "x_origin", "x_amount")


def civil_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.civil_status(Q.carry_sections(_lines(spark, sf_dir)))


CIVIL_STATUS = f"""
WITH {LINES}, x AS (SELECT doc_id, arg_max(k, turn) AS k, arg_max(size, turn) AS size FROM va WHERE is_value GROUP BY doc_id)
SELECT doc_id, CASE k WHEN 'name' THEN 'Casada' ELSE '(cid:3)Nomina+' END AS estado_civil, CASE k WHEN 'name' THEN 'Gananciales' ELSE 'Empresa ' || size || ',50 €' END AS regimen_matrimonial FROM x
"""


def income_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.income_lines(Q.carry_sections(_lines(spark, sf_dir))).drop("page")


def income_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.income_totals(Q.income_lines(Q.carry_sections(_lines(spark, sf_dir))).where("not is_quota"))


def _total(section: str) -> str:
    return f"CAST(coalesce(round(sum(CAST(importe AS DECIMAL(20,4))) FILTER (apartado = '{section}'), 2), 0) AS DOUBLE) AS total_{section}"


INCOME_TOTALS = f"""
WITH {LINES} SELECT doc_id, {", ".join(_total(s) for s in ("salarios", "dividendos", "intereses", "otras"))},
  CAST(coalesce(round(sum(CAST(importe AS DECIMAL(20,4))), 2), 0) AS DOUBLE) AS total_rentas FROM inl WHERE NOT is_quota GROUP BY doc_id
"""


def _income_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as pages of eight, a stamp on top of the first; some forms have a page more that failed, and some failed whole."""
    line = F.struct(F.col("line"), F.transform("words", lambda w: F.struct(w["t"].alias("t"), w["x0"].alias("x0"), (w["x0"] + 5).alias("x1"), (110.0 + F.col("line") % 8 * 20).alias("y0"), (116.0 + F.col("line") % 8 * 20).alias("y1"), F.lit(0).alias("v"))).alias("w"))
    num = (F.floor(F.col("line") / 8) + 1).cast("int")
    stamp = lambda t, x: F.struct(F.lit(t).alias("t"), F.lit(x).alias("x0"), F.lit(x + 5).alias("x1"), F.lit(50.0).alias("y0"), F.lit(56.0).alias("y1"), F.lit(0).alias("v"))
    pages = _lines(spark, sf_dir).groupBy(F.col("doc_id").alias("person_id"), num.alias("num")).agg(F.flatten(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["w"])).alias("w"))
    words = F.when(F.col("num") == 1, F.concat(F.array(stamp("05/03/2021", 400.0), stamp("10:15", 460.0)), "w")).otherwise(F.col("w"))
    pages = pages.select("person_id", "num", F.lit(842.0).alias("alto"), words.alias("palabras"), F.when(F.col("person_id") % 7 == 3, "roto").alias("error"))
    return pages.unionByName(pages.where("num = 1 AND person_id % 6 = 0").withColumns({"num": F.lit(99), "error": F.lit("roto")}))


def income_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.read_income(_income_pages(spark, sf_dir)).statements


INCOME_STATEMENTS = f"""
WITH {LINES},
x AS (SELECT doc_id, arg_max(k, turn) AS k, arg_max(size, turn) AS size FROM va WHERE is_value GROUP BY doc_id),
q AS (SELECT doc_id, arg_max(importe, turn) AS cuota_irpf FROM inl WHERE is_quota GROUP BY doc_id),
t AS (SELECT doc_id, {", ".join(_total(s) for s in ("salarios", "dividendos", "intereses", "otras"))}, CAST(coalesce(round(sum(CAST(importe AS DECIMAL(20,4))), 2), 0) AS DOUBLE) AS total_rentas FROM inl WHERE NOT is_quota GROUP BY doc_id)
SELECT d.doc_id AS person_id, DATE '2021-03-05' AS fecha_registro, CASE x.k WHEN 'name' THEN 'Casada' WHEN 'amount' THEN '(cid:3)Nomina+' END AS estado_civil,
  CASE x.k WHEN 'name' THEN 'Gananciales' WHEN 'amount' THEN 'Empresa ' || x.size || ',50 €' END AS regimen_matrimonial, coalesce(total_salarios, 0) AS total_salarios, coalesce(total_dividendos, 0) AS total_dividendos,
  coalesce(total_intereses, 0) AS total_intereses, coalesce(total_otras, 0) AS total_otras, coalesce(total_rentas, 0) AS total_rentas, q.cuota_irpf, CASE WHEN d.doc_id % 6 = 0 THEN 1 ELSE 0 END::BIGINT AS paginas_fallidas
FROM (SELECT DISTINCT conv_id AS doc_id FROM conversations WHERE conv_id % 7 <> 3) d LEFT JOIN x USING (doc_id) LEFT JOIN q USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def income_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.read_income(_income_pages(spark, sf_dir)).items.groupBy("person_id", "apartado", "concepto", "origen").agg(F.count("*").alias("n"), F.sum("importe").alias("importe"))


def income_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of income forms that couldn't be read, by person."""
    return I.read_income(_income_pages(spark, sf_dir)).failed


def _decls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declarations(spark, sf_dir, items(spark, sf_dir))


def current_declaration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.current_declaration(_decls(spark, sf_dir))


_TRUE = "coalesce({} <> 0, FALSE)"
FULL = f"(has_items OR {_TRUE.format('total_catastral')} OR {_TRUE.format('total_otros_bienes')} OR {_TRUE.format('total_pasivo')})"
CURRENT = f"""
rk AS (
  SELECT *, {FULL} AS is_full, has_property OR {_TRUE.format("total_catastral")} AS prop, row_number() OVER (PARTITION BY person_id ORDER BY fecha_registro DESC NULLS LAST, numero DESC, pos DESC) AS rn FROM de),
la AS (SELECT person_id, decl_id, numero, is_full, prop, tipo, is_full AND (prop OR tipo <> 'modificacion') AS stands FROM rk WHERE rn = 1),
pr AS (SELECT person_id, arg_min(decl_id, rn) AS decl_id FROM rk WHERE rn > 1 AND prop GROUP BY person_id),
so AS (SELECT person_id, arg_min(decl_id, rn) AS decl_id FROM rk WHERE is_full GROUP BY person_id),
cu AS (
  SELECT la.person_id, CASE WHEN stands THEN la.decl_id WHEN pr.decl_id IS NOT NULL THEN pr.decl_id ELSE coalesce(so.decl_id, la.decl_id) END AS decl_id,
    CASE WHEN NOT stands AND pr.decl_id IS NOT NULL THEN CASE WHEN is_full
      THEN 'Hay una modificación posterior (BOCV ' || numero || ') que parece parcial: no repite los inmuebles. Se muestra la declaración completa anterior'
      ELSE 'La última declaración publicada (BOCV ' || numero || ') no trae bienes; se muestran los de la anterior' END END AS aviso
  FROM la LEFT JOIN pr USING (person_id) LEFT JOIN so USING (person_id))"""


def declaration_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = D.declaration_history(_decls(spark, sf_dir))
    told = F.transform("historico", lambda x: F.concat_ws("/", x["sello"], x["bocv"].cast("string"), x["url"]))
    return h.select("person_id", F.size("historico").alias("n"), F.array_join(told, ",").alias("historico"))


DECLARATION_HISTORY = f"""
WITH {DECLARATIONS} SELECT person_id, CAST(count(*) AS INTEGER) AS n,
  string_agg(sello || '/' || numero || '/' || url_pdf || '#page=' || primera, ',' ORDER BY coalesce(CAST(fecha_registro AS VARCHAR), ''), numero, pos) AS historico FROM de GROUP BY person_id
"""


def has_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decls(spark, sf_dir).select("decl_id", D.has_assets().alias("result"))


def publishable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declarations with their items nested; every seventh one illegible."""
    own = items(spark, sf_dir)
    d = declarations(spark, sf_dir, own).withColumn("ilegible", F.col("decl_id") % 7 == 0)
    for name in ("inmuebles", "otros_bienes", "pasivo"):
        nested = own.where(F.col("table") == name).groupBy("decl_id").agg(F.array_sort(F.collect_list(F.struct("pos", "valor", "valor_txt", "pagina", "dudoso"))).alias(name))
        d = d.join(nested, "decl_id", "left")
    return D.publishable(d).select("decl_id", "url", *(F.coalesce(F.size(c), F.lit(-1)).alias(f"n_{c}") for c in ("inmuebles", "otros_bienes", "pasivo")), *D.TOTALS)


PUBLISHABLE = f"""
WITH {DECLARATIONS}, k AS (SELECT *, decl_id % 7 = 0 AS bad FROM de)
SELECT decl_id, url_pdf || '#page=' || primera AS url, CAST(CASE WHEN bad THEN 0 ELSE coalesce(n_a, -1) END AS INTEGER) AS n_inmuebles, CAST(CASE WHEN bad THEN 0 ELSE coalesce(n_b, -1) END AS INTEGER) AS n_otros_bienes,
  CAST(CASE WHEN bad THEN 0 ELSE coalesce(n_c, -1) END AS INTEGER) AS n_pasivo, CASE WHEN NOT bad THEN total_catastral END AS total_catastral, CASE WHEN NOT bad THEN total_otros_bienes END AS total_otros_bienes,
  CASE WHEN NOT bad THEN total_pasivo END AS total_pasivo FROM k
"""


def apply_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ninth declaration corrected: by name only, or with one property and a car."""
    own = items(spark, sf_dir)
    base = declarations(spark, sf_dir, own).withColumns({"persona": F.struct(F.lit("N").alias("nombre"), F.lit("A").alias("apellidos"), F.lit(None).cast("string").alias("circunscripcion"), F.lit("P").alias("partido")), "totales_repetidos": F.array(F.lit("total_pasivo")), "ilegible": F.lit(True)})
    key = F.col("decl_id")
    base = base.withColumn("sello", F.concat(F.lit("XI"), key.cast("string")))  # the tables' seals have six digits, which declarations from 1,000,000 on share
    home = F.array(F.struct(F.lit("P").alias("clave"), F.lit("V").alias("tipo"), F.lit(50.0).alias("porcentaje"), F.lit("Valencia").alias("provincia"), key.cast("double").alias("valor_catastral")))
    car = F.array(F.struct(F.lit("Coche").alias("descripcion"), F.lit(1000.0).alias("valor")))
    fixes = base.where(key % 9 == 0).select(
        F.col("sello").alias("seal"), F.when(key % 2 == 0, "motivo").alias("motivo"), F.struct(F.lit("Nueva").alias("nombre"), F.lit(None).cast("string").alias("apellidos"), F.lit("Valencia").alias("circunscripcion"), F.lit(None).cast("string").alias("partido")).alias("persona"),
        F.when(key % 18 == 0, home).alias("inmuebles"), F.when(key % 18 == 0, car).alias("otros_bienes"), F.lit(None).cast(dict(base.select(car.alias("x")).dtypes)["x"]).alias("pasivo"),
        *(F.when(key % 18 == 0, key.cast("double")).alias(t) for t in D.TOTALS),
    )
    done = D.correct_declarations(base, fixes)
    counted = None
    for name in ("inmuebles", "otros_bienes", "pasivo"):
        part = D.corrected_items(own.where(F.col("table") == name).withColumn("valor_catastral", F.col("valor")), done, fixes, name).groupBy("decl_id").agg(F.count("*").alias("n"))
        counted = part if counted is None else counted.unionByName(part)
    counted = counted.groupBy("decl_id").agg(F.sum("n").alias("n_items"))
    return done.join(counted, "decl_id", "left").select("decl_id", "persona.*", "metodo", "ilegible", F.size("totales_repetidos").alias("n_rep"), F.array_join("notas", "|").alias("notas"), F.size("avisos").alias("n_avisos"), "total_catastral", F.coalesce("n_items", F.lit(0)).alias("n_items"))


APPLY_CORRECTIONS = f"""
WITH {DECLARATIONS}, k AS (SELECT *, decl_id % 9 = 0 AS c, decl_id % 18 = 0 AS f FROM de)
SELECT decl_id, CASE WHEN c THEN 'Nueva' ELSE 'N' END AS nombre, 'A' AS apellidos, CASE WHEN c THEN 'Valencia' END AS circunscripcion, 'P' AS partido, CASE WHEN f THEN 'manual' ELSE metodo END AS metodo, NOT f AS ilegible,
  CASE WHEN f THEN 0 ELSE 1 END AS n_rep, CASE WHEN f THEN CASE WHEN decl_id % 2 = 0 THEN 'motivo' ELSE 'Transcrita a mano del original' END WHEN c THEN CASE WHEN decl_id % 2 = 0 THEN 'motivo' ELSE 'Nombre corregido a mano' END ELSE '' END AS notas,
  CASE WHEN NOT f AND decl_id % 13 = 0 THEN 1 ELSE 0 END AS n_avisos, CASE WHEN f THEN CAST(decl_id AS DOUBLE) ELSE total_catastral END AS total_catastral,
  CASE WHEN f THEN 2 ELSE coalesce(n_a, 0) + coalesce(n_b, 0) + coalesce(n_c, 0) END AS n_items FROM k
"""


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of words: a user's events, placed by value and number."""
    k = F.get_json_object("props", "$.k").cast("int")
    return read(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("t"), (F.col("event_id") % 500 + F.col("event_id") / 1e6).alias("x0"), (k * 1.5).alias("y0"), (F.col("event_id") % 10 == 0).cast("int").alias("v"))


def words_to_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.struct("t", "x0", (F.col("x0") + 20).alias("x1"), "y0", (F.col("y0") + 6).alias("y1"), "v", "event_id")
    pages = _points(spark, sf_dir).groupBy("user_id").agg(F.array_sort(F.collect_list(w)).alias("palabras"))
    lines = L.words_to_lines(pages).select("user_id", F.posexplode("lineas").alias("line", "l"))
    return lines.select("user_id", "line", F.posexplode("l").alias("at", "w")).select("user_id", "line", "at", "w.event_id")


POINTS = """
pt AS (SELECT user_id, event_id, event_id % 500 + event_id / 1e6 AS x0, CAST(json_extract(props, '$.k') AS INTEGER) * 1.5 AS y0, event_id % 10 = 0 AS v FROM events)"""
WORDS_TO_LINES = f"""
WITH RECURSIVE {POINTS},
o AS (SELECT user_id, event_id, x0, CAST(y0 + 3 AS DOUBLE) AS c, row_number() OVER (PARTITION BY user_id ORDER BY y0, x0) AS n FROM pt WHERE NOT v),
r AS (
  SELECT user_id, event_id, x0, c, n, 0 AS line, c AS total, 1 AS many FROM o WHERE n = 1
  UNION ALL
  SELECT o.user_id, o.event_id, o.x0, o.c, o.n, CASE WHEN abs(o.c - r.total / r.many) <= 2.5 THEN r.line ELSE r.line + 1 END, CASE WHEN abs(o.c - r.total / r.many) <= 2.5 THEN r.total + o.c ELSE o.c END,
    CASE WHEN abs(o.c - r.total / r.many) <= 2.5 THEN r.many + 1 ELSE 1 END FROM r JOIN o ON o.user_id = r.user_id AND o.n = r.n + 1)
SELECT user_id, CAST(line AS INTEGER) AS line, CAST(row_number() OVER (PARTITION BY user_id, line ORDER BY x0) - 1 AS INTEGER) AS at, event_id FROM r
"""


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _points(spark, sf_dir)
    key = F.col("event_id")
    return p.select("user_id", key.alias("box"), "x0", "y0", (F.col("x0") + 20 + key % 7 * 40).alias("x1"), (F.col("y0") + 10 + key % 5 * 10).alias("y1"))


BOXES = f"""{POINTS},
bx AS (SELECT user_id, event_id AS box, x0, y0, x0 + 20 + event_id % 7 * 40 AS x1, y0 + 10 + event_id % 5 * 10 AS y1 FROM pt)"""


def words_in_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _points(spark, sf_dir).withColumns({"x1": F.col("x0") + 20, "y1": F.col("y0") + 6})
    return L.words_in_boxes(w.select("user_id", F.col("event_id").cast("string").alias("t"), "x0", "x1", "y0", "y1"), _boxes(spark, sf_dir), ["user_id"]).select("box", "t")


WORDS_IN_BOXES = f"""
WITH {BOXES}
SELECT b.box, coalesce(string_agg(CAST(p.event_id AS VARCHAR), ' ' ORDER BY round(p.y0 / 3), p.x0), '') AS t FROM bx b
LEFT JOIN pt p ON p.user_id = b.user_id AND p.x0 + 10 BETWEEN b.x0 - 1 AND b.x1 + 1 AND p.y0 + 3 BETWEEN b.y0 - 1 AND b.y1 + 1 GROUP BY b.box
"""


def drop_container_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.drop_container_boxes(_boxes(spark, sf_dir), ["user_id"]).select("user_id", "box")


DROP_CONTAINER_BOXES = f"""
WITH {BOXES}
SELECT user_id, box FROM bx b WHERE NOT EXISTS (
  SELECT 1 FROM bx o WHERE o.user_id = b.user_id AND o.box <> b.box AND o.x0 >= b.x0 - 0.6 AND o.y0 >= b.y0 - 0.6 AND o.x1 <= b.x1 + 0.6 AND o.y1 <= b.y1 + 0.6
    AND (o.x1 - o.x0) * (o.y1 - o.y0) < 0.98 * (b.x1 - b.x0) * (b.y1 - b.y0))
"""


def boxes_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _boxes(spark, sf_dir).withColumn("y1", F.col("y0") + 9)
    pages = b.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("x0", "y0", "x1", "y1", "box"))).alias("boxes"))
    out = L.boxes_to_rows(pages, "boxes", F.lit(20.0), F.lit(120.0), "rows")
    return out.select("user_id", F.posexplode("rows").alias("row", "r")).select("user_id", "row", F.explode("r.box").alias("box"))


BOXES_TO_ROWS = f"""
WITH RECURSIVE {BOXES},
o AS (SELECT user_id, box, x0, CAST(y0 + 4.5 AS DOUBLE) AS c, row_number() OVER (PARTITION BY user_id ORDER BY y0, x0) AS n FROM bx WHERE y0 + 4.5 >= 20 AND y0 + 4.5 < 120),
r AS (
  SELECT user_id, box, c, n, 0 AS line, c AS total, 1 AS many FROM o WHERE n = 1
  UNION ALL
  SELECT o.user_id, o.box, o.c, o.n, CASE WHEN abs(o.c - r.total / r.many) <= 4 THEN r.line ELSE r.line + 1 END, CASE WHEN abs(o.c - r.total / r.many) <= 4 THEN r.total + o.c ELSE o.c END,
    CASE WHEN abs(o.c - r.total / r.many) <= 4 THEN r.many + 1 ELSE 1 END FROM r JOIN o ON o.user_id = r.user_id AND o.n = r.n + 1)
SELECT user_id, CAST(line AS INTEGER) AS row, box FROM r
"""


def dedup_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row of boxes for each user and kind of event, drawn again half a point lower: a box meets its first drawing if that is among the last twelve."""
    at = F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy("event_id")) - 1
    once = read(spark, sf_dir, "events").select("user_id", "event_type", at.alias("box"), (at * 10.0).alias("x0"), (at * 10.0 + 5).alias("x1"), F.lit(100.0).alias("y0"), F.lit(109.0).alias("y1"), F.lit("texto").alias("t"))
    twice = once.unionByName(once.withColumns({"y0": F.col("y0") + 0.5, "y1": F.col("y1") + 0.5}))
    pages = twice.groupBy("user_id", "event_type").agg(F.collect_list(F.struct("x0", "y0", "x1", "y1", "t", "box")).alias("boxes"))
    kept = L.dedup_boxes(pages, "boxes").select("user_id", "event_type", F.explode("boxes").alias("b"))
    return kept.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.countDistinct("b.box").alias("n_boxes"))


DEDUP_BOXES = "SELECT user_id, event_type, CASE WHEN count(*) > 12 THEN 2 * count(*) ELSE count(*) END AS n, count(*) AS n_boxes FROM events GROUP BY ALL"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        sessionize_pages, declaration_header, asof_insertion, bulletin_counts, carry_sections, civil_status, income_lines, income_totals, income_statements, income_items, income_failures, current_declaration, declaration_history,
        has_assets, publishable, apply_corrections, words_to_lines, boxes_to_rows, words_in_boxes, drop_container_boxes, dedup_boxes,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "sessionize_pages": f"WITH RECURSIVE {SESSIONS} SELECT bulletin_id, num, gid FROM ses WHERE opened", "declaration_header": DECLARATION_HEADER, "asof_insertion": ASOF_INSERTION,
        "bulletin_counts": BULLETIN_COUNTS, "carry_sections": f"WITH {LINES} SELECT doc_id, turn AS line, is_value, section, x_origin, x_amount FROM va", "civil_status": CIVIL_STATUS,
        "income_lines": f"WITH {LINES} SELECT doc_id, turn AS line, apartado, concepto, origen, importe, is_quota FROM inl", "income_totals": INCOME_TOTALS, "income_statements": INCOME_STATEMENTS,
        "income_items": f"WITH {LINES} SELECT doc_id AS person_id, apartado, concepto, origen, count(*) AS n, sum(importe) AS importe FROM inl WHERE NOT is_quota AND doc_id % 7 <> 3 GROUP BY ALL",
        "income_failures": "SELECT conv_id AS person_id, CASE WHEN conv_id % 7 = 3 THEN max(turn // 8) + 1 ELSE 0 END + CASE WHEN conv_id % 6 = 0 THEN 1 ELSE 0 END AS pages FROM conversations WHERE conv_id % 7 = 3 OR conv_id % 6 = 0 GROUP BY conv_id",
        "current_declaration": f"WITH {DECLARATIONS},{CURRENT} SELECT * FROM cu", "declaration_history": DECLARATION_HISTORY, "has_assets": f"WITH {DECLARATIONS} SELECT decl_id, {FULL} AS result FROM de",
        "publishable": PUBLISHABLE, "apply_corrections": APPLY_CORRECTIONS, "words_to_lines": WORDS_TO_LINES, "boxes_to_rows": BOXES_TO_ROWS, "words_in_boxes": WORDS_IN_BOXES,
        "drop_container_boxes": DROP_CONTAINER_BOXES, "dedup_boxes": DEDUP_BOXES,
    }
