"""The library's tables made from the driver's tables, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patrimonia.operators.reconcile import MONEY

DESCRIPTIONS = (
    "Cuenta corriente", "Plan de pensiones", "Coche Seat", "Acciones de bolsa", "Seguro de vida", "Joyas", "Préstamo hipotecario",
    "Préstamo personal", "Tarjeta de crédito", "Fondo de inversión", "Moto", "Libreta de ahorro",
)
FORENAMES = ("ANA", "LUIS", "MARIA DEL MAR", "Pere", "Núria", "JOSE I", "Eva", "Ramon", "Àngel", "SONIA")
SURNAMES = ("GARCIA LOPEZ", "Puig i Ferrer", "DE LA TORRE", "Martí Roig", "SANZ", "Núñez Gil", "Ibáñez Soler", "VIDAL", "Mas Oltra")
#: Second surnames: the hexadecimal digits of a hash as letters.
HEX, LETTERS = "0123456789abcdef", "BCDFGLMNPRAEIOUS"
DISTRICTS = ("Alicante", "Castellón", "Valencia", "")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def pick(values: tuple[str | None, ...], key: Column) -> Column:
    """The value at ``key`` modulo their number."""
    return F.element_at(F.array(*(F.lit(v).cast("string") for v in values)), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def invented(key: Column) -> Column:
    """A surname of twelve letters that no other key has."""
    return F.translate(F.substring(F.md5(key.cast("string").cast("binary")), 1, 12), HEX, LETTERS)


def sql_invented(key: str) -> str:
    return f"translate(substr(md5(CAST({key} AS VARCHAR)), 1, 12), '{HEX}', '{LETTERS}')"


def sql_list(values: tuple[object, ...]) -> str:
    def one(v: object) -> str:  # noqa: ANN001
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return "[" + ", ".join(one(v) for v in values) + "]"


def sql_pick(values: tuple[object, ...], key: str) -> str:
    return f"({sql_list(values)})[CAST({key} % {len(values)} AS INTEGER) + 1]"


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of declarations: a line of an order each."""
    nation = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    line = read(spark, sf_dir, "lineitem").join(nation, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    key, part, supp, number = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    share = F.when(key % 2 == 0, F.when(number % 2 == 0, 100.0).otherwise(50.0)).otherwise(F.when(number % 3 != 0, 100.0))
    value = F.when(part % 29 != 0, F.col("l_extendedprice"))
    other = F.when(value.isNotNull(), (value.cast("decimal(18,2)") + 500).cast("string"))
    return line.select(
        key.alias("decl_id"), F.row_number().over(order).alias("pos"),
        F.when(F.col("l_returnflag") == "R", "inmuebles").when(F.col("l_returnflag") == "A", "otros_bienes").otherwise("pasivo").alias("table"),
        pick(("P", "N", "M", "U"), supp).alias("clave"), pick(("V", "V", "V", "L", "R", "O", None), part).alias("tipo"), share.alias("porcentaje"),
        F.when(supp % 10 != 0, F.col("n_name")).alias("provincia"), value.alias("valor"), pick(DESCRIPTIONS, part).alias("descripcion"),
        F.lit("").alias("valor_txt"), F.array(F.lit("sin datos"), other).alias("alts"), number.alias("pagina"), (F.col("l_quantity") < 25).alias("dudoso"),
    )


ITEMS = f"""
it AS (
  SELECT l_orderkey AS decl_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_shipdate) AS pos,
    CASE l_returnflag WHEN 'R' THEN 'inmuebles' WHEN 'A' THEN 'otros_bienes' ELSE 'pasivo' END AS tab,
    {sql_pick(("P", "N", "M", "U"), "l_suppkey")} AS clave, {sql_pick(("V", "V", "V", "L", "R", "O", None), "l_partkey")} AS tipo,
    CASE WHEN l_orderkey % 2 = 0 THEN CASE WHEN l_linenumber % 2 = 0 THEN 100.0 ELSE 50.0 END WHEN l_linenumber % 3 <> 0 THEN 100.0 END::DOUBLE AS porcentaje,
    CASE WHEN l_suppkey % 10 <> 0 THEN n_name END AS provincia, CASE WHEN l_partkey % 29 <> 0 THEN l_extendedprice END AS valor,
    {sql_pick(DESCRIPTIONS, "l_partkey")} AS descripcion, l_linenumber AS pagina, l_quantity < 25 AS dudoso, l_partkey AS part
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey)"""


def table_of(all_items: DataFrame, name: str) -> DataFrame:
    """One table's items, with the column names of that table."""
    own = all_items.where(F.col("table") == name)
    return own.withColumnRenamed("valor", "valor_catastral") if name == "inmuebles" else own


def _totals(all_items: DataFrame) -> DataFrame:
    out = None
    for name in ("inmuebles", "otros_bienes", "pasivo"):
        part = all_items.where(F.col("table") == name).groupBy("decl_id").agg(
            F.round(F.sum(F.col("valor").cast(MONEY)), 2).cast("double").alias(f"s_{name}"),
            F.round(F.sum((F.col("valor") * F.col("porcentaje") / 100).cast(MONEY)), 2).cast("double").alias(f"w_{name}"), F.count("*").alias(f"n_{name}"),
        )
        out = part if out is None else out.join(part, "decl_id", "full")
    return out


def _total(name: str, shift: int) -> Column:
    turn = (F.col("decl_id") + shift) % 5
    s = F.col(f"s_{name}")
    return F.when(turn == 0, s).when(turn == 1, F.col(f"w_{name}")).when(turn == 2, F.round(s + 500, 2)).when(turn == 4, F.col("o_totalprice"))


def declarations(spark: SparkSession, sf_dir: str, all_items: DataFrame) -> DataFrame:
    """Declarations: an order each, with totals that meet the lines, their shares, another reading of one, or nothing."""
    key = F.col("o_orderkey")
    page = (key % 500 + 1).cast("int")
    own = read(spark, sf_dir, "orders").withColumn("decl_id", key).join(_totals(all_items), "decl_id", "left")
    own = own.withColumn("total_catastral", _total("inmuebles", 0))
    assets = F.when(F.col("n_otros_bienes").isNull() & (key % 2 == 0), F.col("total_catastral")).otherwise(_total("otros_bienes", 1))
    debts = F.when(F.col("n_pasivo").isNull() & (key % 3 == 0), F.col("total_catastral")).otherwise(_total("pasivo", 2))
    date = F.col("o_orderdate").cast("date")
    return own.withColumns({"total_otros_bienes": assets, "total_pasivo": debts}).select(
        "decl_id", F.col("o_custkey").alias("person_id"), F.concat(F.lit("B"), (key % 50).cast("string")).alias("bulletin_id"), (key % 50).cast("int").alias("numero"),
        F.date_add(date, 30).alias("fecha_bocv"), F.concat(F.lit("https://boletin.example/"), (key % 50).cast("string")).alias("url_pdf"),
        F.when(F.col("o_orderstatus") == "F", "inicial").when(F.col("o_orderstatus") == "P", "final").otherwise("modificacion").alias("tipo"),
        F.concat(F.lit("XI"), F.lpad(key.cast("string"), 6, "0")).alias("sello"), F.when(key % 11 != 0, date).alias("fecha_registro"),
        F.sequence(page, page + (key % 3).cast("int")).alias("paginas"), F.when(key % 4 == 0, "ocr").otherwise("texto").alias("metodo"),
        "total_catastral", "total_otros_bienes", "total_pasivo", F.col("n_inmuebles").isNotNull().alias("has_property"),
        F.coalesce("n_inmuebles", "n_otros_bienes", "n_pasivo").isNotNull().alias("has_items"), key.alias("pos"),
        F.when(key % 13 == 0, F.array(F.lit("aviso"))).otherwise(F.array().cast("array<string>")).alias("avisos"), F.array().cast("array<string>").alias("notas"),
    )


def _sql_totals(name: str) -> str:
    return f"""
t_{name} AS (
  SELECT decl_id, CAST(round(sum(CAST(valor AS DECIMAL(20,4))), 2) AS DOUBLE) AS s, CAST(round(sum(CAST(valor * porcentaje / 100 AS DECIMAL(20,4))), 2) AS DOUBLE) AS w,
    count(*) AS n, count(valor) AS known, count(porcentaje) AS shared FROM it WHERE tab = '{name}' GROUP BY decl_id)"""


def _sql_total(alias: str, shift: int) -> str:
    turn = f"(o_orderkey + {shift}) % 5"
    return f"CASE {turn} WHEN 0 THEN {alias}.s WHEN 1 THEN {alias}.w WHEN 2 THEN round({alias}.s + 500, 2) WHEN 4 THEN o_totalprice END"


DECLARATIONS = f"""{ITEMS},{_sql_totals("inmuebles")},{_sql_totals("otros_bienes")},{_sql_totals("pasivo")},
de0 AS (
  SELECT o_orderkey AS decl_id, o_custkey AS person_id, 'B' || (o_orderkey % 50) AS bulletin_id, CAST(o_orderkey % 50 AS INTEGER) AS numero,
    CAST(o_orderdate AS DATE) + 30 AS fecha_bocv, 'https://boletin.example/' || (o_orderkey % 50) AS url_pdf,
    CASE o_orderstatus WHEN 'F' THEN 'inicial' WHEN 'P' THEN 'final' ELSE 'modificacion' END AS tipo, 'XI' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') AS sello,
    CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS fecha_registro, CAST(o_orderkey % 500 + 1 AS INTEGER) AS primera, CAST(o_orderkey % 500 + 1 + o_orderkey % 3 AS INTEGER) AS ultima,
    CASE WHEN o_orderkey % 4 = 0 THEN 'ocr' ELSE 'texto' END AS metodo, {_sql_total("a", 0)} AS total_catastral,
    {_sql_total("b", 1)} AS t_b, {_sql_total("c", 2)} AS t_c, a.n AS n_a, b.n AS n_b, c.n AS n_c, o_orderkey
  FROM orders LEFT JOIN t_inmuebles a ON a.decl_id = o_orderkey LEFT JOIN t_otros_bienes b ON b.decl_id = o_orderkey LEFT JOIN t_pasivo c ON c.decl_id = o_orderkey),
de AS (
  SELECT *, CASE WHEN n_b IS NULL AND o_orderkey % 2 = 0 THEN total_catastral ELSE t_b END AS total_otros_bienes,
    CASE WHEN n_c IS NULL AND o_orderkey % 3 = 0 THEN total_catastral ELSE t_c END AS total_pasivo, n_a IS NOT NULL AS has_property,
    coalesce(n_a, n_b, n_c) IS NOT NULL AS has_items, o_orderkey AS pos FROM de0)"""


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People: a customer each."""
    key = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        key.alias("id"), pick(FORENAMES, key).alias("nombre"), F.concat(F.when(key % 50 < 9, pick(SURNAMES, key)).otherwise(invented(key + 1)), F.lit(" "), invented(key)).alias("apellidos"), F.col("c_mktsegment").alias("grupo"),
        pick(DISTRICTS, key).alias("circunscripcion"), (key % 3 != 0).alias("en_activo"), F.concat(F.lit("https://fichas.example/"), key.cast("string")).alias("url_ficha"), key.alias("roster_pos"),
    )


ROSTER = f"""
ro AS (
  SELECT c_custkey AS id, {sql_pick(FORENAMES, "c_custkey")} AS nombre, CASE WHEN c_custkey % 50 < 9 THEN {sql_pick(SURNAMES, "c_custkey")} ELSE {sql_invented("c_custkey + 1")} END || ' ' || {sql_invented("c_custkey")} AS apellidos, c_mktsegment AS grupo,
    {sql_pick(DISTRICTS, "c_custkey")} AS circunscripcion, c_custkey % 3 <> 0 AS en_activo, 'https://fichas.example/' || c_custkey AS url_ficha FROM customer)"""


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income items of people: an event each."""
    e = read(spark, sf_dir, "events")
    section = pick(("salarios", "dividendos", "intereses", "otras"), F.col("event_id"))
    return e.select(F.col("user_id").alias("person_id"), F.col("event_id").alias("pos"), section.alias("apartado"), F.col("event_type").alias("concepto"), F.lit("").alias("origen"), F.col("value").alias("importe"))


INCOME = """
inc AS (
  SELECT user_id AS person_id, event_id AS pos, (['salarios', 'dividendos', 'intereses', 'otras'])[CAST(event_id % 4 AS INTEGER) + 1] AS apartado, event_type AS concepto,
    '' AS origen, value AS importe FROM events),
st AS (
  SELECT person_id,
    CAST(coalesce(round(sum(CAST(importe AS DECIMAL(20,4))) FILTER (apartado = 'salarios'), 2), 0) AS DOUBLE) AS total_salarios,
    CAST(coalesce(round(sum(CAST(importe AS DECIMAL(20,4))) FILTER (apartado = 'dividendos'), 2), 0) AS DOUBLE) AS total_dividendos,
    CAST(coalesce(round(sum(CAST(importe AS DECIMAL(20,4))) FILTER (apartado = 'intereses'), 2), 0) AS DOUBLE) AS total_intereses,
    CAST(coalesce(round(sum(CAST(importe AS DECIMAL(20,4))) FILTER (apartado = 'otras'), 2), 0) AS DOUBLE) AS total_otras,
    CAST(coalesce(round(sum(CAST(importe AS DECIMAL(20,4))), 2), 0) AS DOUBLE) AS total_rentas,
    CASE WHEN person_id % 2 = 0 THEN CAST(person_id * 10 AS DOUBLE) END AS cuota_irpf, DATE '2024-01-01' + CAST(person_id % 100 AS INTEGER) AS fecha_registro
  FROM inc GROUP BY person_id)"""


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income statements: one for each user of the events."""
    from patrimonia.operators.summary import income_totals

    sums = income_totals(income(spark, sf_dir), "person_id")
    key = F.col("person_id")
    return sums.withColumns({"cuota_irpf": F.when(key % 2 == 0, (key * 10).cast("double")), "fecha_registro": F.date_add(F.lit("2024-01-01").cast("date"), (key % 100).cast("int"))})
