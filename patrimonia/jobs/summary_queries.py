"""Queries on sums, people, filters and forms."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patrimonia.jobs import bulletins as B
from patrimonia.jobs import people as P
from patrimonia.jobs.driver import DECLARATIONS, DISTRICTS, FORENAMES, INCOME, ROSTER, SURNAMES, declarations, income, items, pick, read, roster, sql_pick, statements, table_of
from patrimonia.jobs.order_queries import CURRENT
from patrimonia.jobs.text_queries import places, positions, sql_norm
from patrimonia.operators import declarations as D
from patrimonia.operators import explore as E
from patrimonia.operators import layout as L
from patrimonia.operators import nested as N
from patrimonia.operators import people as W
from patrimonia.operators import reconcile as R
from patrimonia.operators import sequence as Q
from patrimonia.operators import summary as S
from patrimonia.sources import tables as IO
from patrimonia.sources.store import save, shared_folder

DEC = "DECIMAL(20,4)"


def _read(spark: SparkSession, sf_dir: str) -> P.Read:
    own = save(items(spark, sf_dir), "items")
    return P.Read(declarations(spark, sf_dir, own), table_of(own, "inmuebles"), table_of(own, "otros_bienes"), table_of(own, "pasivo"))


def _debts(r: P.Read) -> DataFrame:
    from patrimonia.functions.codes import classify_liability

    return r.pasivo.withColumn("categoria", classify_liability("descripcion"))


def _assets(r: P.Read) -> DataFrame:
    from patrimonia.functions.codes import classify_asset

    return r.otros_bienes.withColumn("categoria", classify_asset("descripcion"))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _read(spark, sf_dir)
    return P.check(P.Read(r.declarations, r.inmuebles, _assets(r), _debts(r)))


# Classes of the twelve descriptions, by hand.
ASSET_CLASS = ("cuentas", "pensiones", "vehiculos", "inversiones", "seguros", "otros", "otros", "otros", "otros", "inversiones", "vehiculos", "cuentas")
DEBT_CLASS = ("posible_bien", "posible_bien", "posible_bien", "otros", "otros", "otros", "hipoteca", "prestamo", "prestamo", "otros", "posible_bien", "posible_bien")
TABLES = ("inmuebles", "otros_bienes", "pasivo")


def _near(a: str, b: str) -> str:
    return f"abs({a} - {b}) <= 1"


def _sql_flag(name: str, total: str, weighted: bool) -> str:
    """Flag and repaired item of a table: other readings are the value plus 500."""
    shares = f"OR (t.shared = t.n AND {_near('t.w', f'd.{total}')})" if weighted else ""
    plus = f"OR (t.shared = t.n AND {_near('t.w + 500 * i.porcentaje / 100', f'd.{total}')})" if weighted else ""
    return f"""
f_{name} AS (
  SELECT d.decl_id, CASE WHEN d.{total} IS NOT NULL AND t.n > 0 AND t.known = t.n THEN {_near("t.s", f"d.{total}")} {shares} END AS ok FROM de d LEFT JOIN t_{name} t ON t.decl_id = d.decl_id),
x_{name} AS (
  SELECT i.decl_id, min(i.pos) AS pos FROM it i JOIN f_{name} f ON f.decl_id = i.decl_id AND f.ok = FALSE JOIN t_{name} t ON t.decl_id = i.decl_id JOIN de d ON d.decl_id = i.decl_id
  WHERE i.tab = '{name}' AND ({_near("t.s + 500", f"d.{total}")} {plus}) GROUP BY i.decl_id),
g_{name} AS (SELECT f.decl_id, CASE WHEN x.decl_id IS NOT NULL THEN TRUE ELSE f.ok END AS ok FROM f_{name} f LEFT JOIN x_{name} x USING (decl_id))"""


CHECKED = f"""{DECLARATIONS},{_sql_flag("inmuebles", "total_catastral", True)},{_sql_flag("otros_bienes", "total_otros_bienes", False)},{_sql_flag("pasivo", "total_pasivo", False)},
xx AS (SELECT * FROM x_inmuebles UNION ALL SELECT * FROM x_otros_bienes UNION ALL SELECT * FROM x_pasivo),
gg AS (SELECT decl_id, 'inmuebles' AS tab, ok FROM g_inmuebles UNION ALL SELECT decl_id, 'otros_bienes', ok FROM g_otros_bienes UNION ALL SELECT decl_id, 'pasivo', ok FROM g_pasivo),
ci AS (
  SELECT i.* EXCLUDE (valor, dudoso), CASE WHEN x.pos IS NOT NULL THEN valor + 500 ELSE valor END AS valor, CASE WHEN x.pos IS NOT NULL OR coalesce(g.ok, FALSE) THEN FALSE ELSE i.dudoso END AS dudoso, x.pos IS NOT NULL AS corregido,
    CASE i.tab WHEN 'otros_bienes' THEN {sql_pick(ASSET_CLASS, "part")} WHEN 'pasivo' THEN {sql_pick(DEBT_CLASS, "part")} END AS categoria
  FROM it i LEFT JOIN xx x ON x.decl_id = i.decl_id AND x.pos = i.pos LEFT JOIN gg g ON g.decl_id = i.decl_id AND g.tab = i.tab),
cd AS (
  SELECT d.*, a.ok AS ok_a, b.ok AS ok_b, c.ok AS ok_c, coalesce(z.n, 0) AS n_all, coalesce(z.doubt, 0) AS n_doubt, coalesce(z.no_type, 0) AS no_type, coalesce(z.no_prov, 0) AS no_prov, coalesce(z.misfiled, 0) > 0 AS misfiled,
    n_b IS NULL AND coalesce(total_otros_bienes = total_catastral, FALSE) AS rep_b, n_c IS NULL AND (coalesce(total_pasivo = total_otros_bienes, FALSE) OR coalesce(total_pasivo = total_catastral, FALSE)) AS rep_c
  FROM de d JOIN g_inmuebles a USING (decl_id) JOIN g_otros_bienes b USING (decl_id) JOIN g_pasivo c USING (decl_id)
  LEFT JOIN (SELECT decl_id, count(*) AS n, count(*) FILTER (dudoso) AS doubt, count(*) FILTER (tab = 'inmuebles' AND tipo IS NULL) AS no_type, count(*) FILTER (tab = 'inmuebles' AND provincia IS NULL) AS no_prov, count(*) FILTER (categoria = 'posible_bien') AS misfiled FROM ci GROUP BY decl_id) z USING (decl_id)),
ck AS (
  SELECT *, metodo = 'ocr' AND n_all >= 3 AND NOT (coalesce(ok_a, FALSE) OR coalesce(ok_b, FALSE) OR coalesce(ok_c, FALSE)) AND n_doubt * 2 >= n_all AS ilegible FROM cd)"""


def conditional_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = items(spark, sf_dir)
    return own.groupBy("provincia").agg(R.conditional_sum("valor").alias("suma"), R.conditional_sum("valor", F.col("tipo") == "V").alias("viviendas"), R.conditional_sum("valor", F.col("tipo") == "nada").alias("nada"))


CONDITIONAL_SUM = f"""
WITH {DECLARATIONS.split(",\nt_inmuebles")[0]}
SELECT provincia, CAST(round(sum(CAST(valor AS {DEC})), 2) AS DOUBLE) AS suma, CAST(coalesce(round(sum(CAST(valor AS {DEC})) FILTER (tipo = 'V'), 2), 0) AS DOUBLE) AS viviendas, CAST(0 AS DOUBLE) AS nada FROM it GROUP BY provincia
"""


def reconcile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _read(spark, sf_dir)
    return R.reconcile_totals(r.inmuebles, r.declarations.select("decl_id", F.col("total_catastral").alias("total")), "valor_catastral", "porcentaje")


def repair_with_alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _read(spark, sf_dir)
    out, _ = R.repair_with_alternatives(r.inmuebles, r.declarations.select("decl_id", F.col("total_catastral").alias("total")), "valor_catastral", "porcentaje")
    return out.where("corregido").select("decl_id", "pos", "valor_catastral", "dudoso")


def clear_doubt(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _read(spark, sf_dir)
    flags = R.reconcile_totals(r.otros_bienes, r.declarations.select("decl_id", F.col("total_otros_bienes").alias("total")))
    return R.clear_doubt(r.otros_bienes, flags).groupBy("decl_id").agg(F.count("*").alias("n"), F.count_if(F.col("dudoso")).alias("n_dudosos"))


CLEAR_DOUBT = f"""
WITH {CHECKED} SELECT i.decl_id, count(*) AS n, count(*) FILTER (i.dudoso AND NOT coalesce(f.ok, FALSE)) AS n_dudosos FROM it i LEFT JOIN f_otros_bienes f USING (decl_id) WHERE i.tab = 'otros_bienes' GROUP BY i.decl_id
"""


def flag_illegible(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _checked(spark, sf_dir)
    return d.select("decl_id", "ilegible", *(flag for _, flag, _ in N.TABLES.values()), F.array_join("avisos", "|").alias("avisos"))


FLAG_ILLEGIBLE = f"""
WITH {CHECKED} SELECT decl_id, ilegible, ok_a AS suma_inmuebles_cuadra, ok_b AS suma_otros_cuadra, ok_c AS suma_pasivo_cuadra,
  concat_ws('|', CASE WHEN decl_id % 13 = 0 THEN 'aviso' END, CASE WHEN ilegible THEN 'Formulario escrito a mano o muy borroso: el OCR no es fiable' END) AS avisos FROM ck
"""


def flag_repeated_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _read(spark, sf_dir)
    d = R.flag_repeated_totals(r.declarations, r.otros_bienes, r.pasivo)
    return d.select("decl_id", F.array_join("totales_repetidos", ",").alias("repetidos"), F.size("notas").alias("n_notas"))


FLAG_REPEATED = f"""
WITH {CHECKED} SELECT decl_id, concat_ws(',', CASE WHEN rep_b THEN 'total_otros_bienes' END, CASE WHEN rep_c THEN 'total_pasivo' END) AS repetidos, CAST(rep_b AS INTEGER) + CAST(rep_c AS INTEGER) AS n_notas FROM cd
"""


def flag_misfiled_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.flag_misfiled_assets(_debts(_read(spark, sf_dir))).groupBy("descripcion", "categoria").agg(F.count("*").alias("n"))


def _summed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.summarize_rows(_checked(spark, sf_dir))


_SUMMARY = ("n_inmuebles", "n_viviendas", "n_viviendas_compartidas", "n_locales", "n_rusticos", "n_otros_urbanos", "n_provincias", "valor_catastral", "cuentas", "vehiculos", "n_vehiculos", "inversiones", "otros_bienes", "pasivo", "tiene_hipoteca", "patrimonio_declarado")


def summarize_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summed(spark, sf_dir).select("decl_id", *_SUMMARY, F.array_join("provincias_inmuebles", ";").alias("provincias_inmuebles"), F.array_join("provincias_viviendas", ";").alias("provincias_viviendas"))


def _sum(cond: str) -> str:
    return f"coalesce(round(sum(CAST(valor AS {DEC})) FILTER ({cond}), 2), 0)"


SUMMARY = f"""
ag AS (
  SELECT decl_id, count(*) FILTER (tab = 'inmuebles') AS n, count(*) FILTER (tab = 'inmuebles' AND tipo = 'V') AS v, count(*) FILTER (tab = 'inmuebles' AND tipo = 'V' AND porcentaje < 100) AS vc, count(*) FILTER (tab = 'inmuebles' AND tipo = 'L') AS l,
    count(*) FILTER (tab = 'inmuebles' AND tipo = 'R') AS r, count(*) FILTER (tab = 'inmuebles' AND tipo = 'O') AS o,
    list_sort(list_distinct(list(provincia) FILTER (tab = 'inmuebles' AND provincia IS NOT NULL))) AS p, list_sort(list_distinct(list(provincia) FILTER (tab = 'inmuebles' AND tipo = 'V' AND provincia IS NOT NULL))) AS pv,
    {_sum("tab = 'inmuebles'")} AS s_a, {_sum("tab = 'otros_bienes' AND categoria = 'cuentas'")} AS cu, {_sum("tab = 'otros_bienes' AND categoria = 'vehiculos'")} AS ve, count(*) FILTER (tab = 'otros_bienes' AND categoria = 'vehiculos') AS nv,
    {_sum("tab = 'otros_bienes' AND categoria IN ('inversiones', 'pensiones', 'seguros')")} AS inv, {_sum("tab = 'otros_bienes'")} AS s_b, {_sum("tab = 'pasivo'")} AS s_c, coalesce(bool_or(categoria = 'hipoteca') FILTER (tab = 'pasivo'), FALSE) AS hip
  FROM ci GROUP BY decl_id),
sm AS (
  SELECT k.*, CASE WHEN NOT ilegible THEN CAST(coalesce(n, 0) AS INTEGER) END AS n_inmuebles, CASE WHEN NOT ilegible THEN CAST(coalesce(v, 0) AS INTEGER) END AS n_viviendas, CASE WHEN NOT ilegible THEN CAST(coalesce(vc, 0) AS INTEGER) END AS n_viviendas_compartidas,
    CASE WHEN NOT ilegible THEN CAST(coalesce(l, 0) AS INTEGER) END AS n_locales, CASE WHEN NOT ilegible THEN CAST(coalesce(r, 0) AS INTEGER) END AS n_rusticos, CASE WHEN NOT ilegible THEN CAST(coalesce(o, 0) AS INTEGER) END AS n_otros_urbanos,
    CASE WHEN NOT ilegible THEN CAST(coalesce(len(p), 0) AS INTEGER) END AS n_provincias, CASE WHEN ilegible THEN '' ELSE coalesce(array_to_string(p, ';'), '') END AS provincias_inmuebles, CASE WHEN ilegible THEN '' ELSE coalesce(array_to_string(pv, ';'), '') END AS provincias_viviendas,
    CASE WHEN NOT ilegible THEN coalesce(total_catastral, CAST(s_a AS DOUBLE), 0) END AS valor_catastral, CASE WHEN NOT ilegible THEN CAST(coalesce(cu, 0) AS DOUBLE) END AS cuentas, CASE WHEN NOT ilegible THEN CAST(coalesce(ve, 0) AS DOUBLE) END AS vehiculos,
    CASE WHEN NOT ilegible THEN CAST(coalesce(nv, 0) AS INTEGER) END AS n_vehiculos, CASE WHEN NOT ilegible THEN CAST(coalesce(inv, 0) AS DOUBLE) END AS inversiones,
    CASE WHEN NOT ilegible THEN greatest(CAST(coalesce(s_b, 0) AS DOUBLE), coalesce(CASE WHEN NOT rep_b THEN total_otros_bienes END, 0)) END AS otros_bienes,
    CASE WHEN NOT ilegible THEN greatest(CAST(coalesce(s_c, 0) AS DOUBLE), coalesce(CASE WHEN NOT rep_c THEN total_pasivo END, 0)) END AS pasivo, CASE WHEN NOT ilegible THEN coalesce(hip, FALSE) END AS tiene_hipoteca
  FROM ck k LEFT JOIN ag ON ag.decl_id = k.decl_id),
sw AS (SELECT *, CAST(round(CAST(valor_catastral AS {DEC}) + CAST(otros_bienes AS {DEC}) - CAST(pasivo AS {DEC}), 2) AS DOUBLE) AS patrimonio_declarado FROM sm)"""
SUMMARIZE = f"WITH {CHECKED},{SUMMARY} SELECT decl_id, {', '.join(_SUMMARY)}, provincias_inmuebles, provincias_viviendas FROM sw"


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.rate_rows(_checked(spark, sf_dir)).select("decl_id", "revisar", "comprobado", F.array_join("motivos", "|").alias("motivos"))


def _wrong(ok: str, name: str, scan: bool) -> str:
    where = "metodo = 'ocr'" if scan else "metodo <> 'ocr'"
    tail = "" if scan else " (así consta en el original)"
    return f"CASE WHEN NOT ilegible AND {ok} = FALSE AND {where} THEN 'La suma de {name} no coincide con el total declarado{tail}' END"


_NAMES = (("ok_a", "los inmuebles"), ("ok_b", "los otros bienes"), ("ok_c", "las deudas"))
QUALITY = f"""
qu AS (
  SELECT *, concat_ws('|', CASE WHEN decl_id % 13 = 0 THEN 'aviso' END, CASE WHEN ilegible THEN 'Formulario escrito a mano o muy borroso: el OCR no es fiable' END,
      CASE WHEN NOT ilegible AND n_doubt > 0 THEN n_doubt || ' dato(s) con lectura dudosa del OCR' END, {", ".join(_wrong(a, b, True) for a, b in _NAMES)},
      CASE WHEN NOT ilegible AND no_type > 0 THEN no_type || ' inmueble(s) sin tipo reconocible' END, CASE WHEN NOT ilegible AND no_prov > 0 THEN no_prov || ' inmueble(s) sin provincia reconocible' END) AS lectura,
    concat_ws('|', CASE WHEN rep_b THEN 'El total de otros bienes repite el valor catastral y no tiene detalle: no se cuenta' END, CASE WHEN rep_c THEN 'El total de deudas repite el de otro apartado y no tiene detalle: no se cuenta' END, CASE WHEN misfiled THEN '{R.MISFILED}' END,
      {", ".join(_wrong(a, b, False) for a, b in _NAMES)}) AS escrito,
    coalesce(ok_a, ok_b, ok_c) IS NOT NULL AND coalesce(ok_a, TRUE) AND coalesce(ok_b, TRUE) AND coalesce(ok_c, TRUE) AS comprobado FROM ck)"""
QUALITY_REPORT = f"WITH {CHECKED},{QUALITY} SELECT decl_id, lectura <> '' AS revisar, comprobado, concat_ws('|', nullif(lectura, ''), nullif(escrito, '')) AS motivos FROM qu"


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.build(roster(spark, sf_dir), _checked(spark, sf_dir), statements(spark, sf_dir))


_SHOWN = ("id", "cargo", "decl_id", "revisar", "comprobado", *_SUMMARY, "rentas", "salarios", "otras_rentas", "cuota_irpf", "tiene_renta", "bocv", "fecha_declaracion")


def assemble_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir).select(*_SHOWN, F.array_join("motivos_revision", "|").alias("motivos"), F.coalesce(F.size("historico"), F.lit(-1)).alias("n_historico"))


PEOPLE = f"""{CHECKED},{CURRENT},{SUMMARY},{QUALITY},{ROSTER},{INCOME},
hi AS (SELECT person_id, CAST(count(*) AS INTEGER) AS n FROM de GROUP BY person_id),
pe AS (
  SELECT ro.*, CASE WHEN en_activo THEN 'Diputado/a' ELSE 'Exdiputado/a' END AS cargo, cu.decl_id, CASE WHEN cu.decl_id IS NULL THEN TRUE ELSE cu.aviso IS NOT NULL OR qu.lectura <> '' END AS revisar, coalesce(qu.comprobado, FALSE) AS comprobado,
    {", ".join(f"sw.{c}" for c in _SUMMARY)}, coalesce(sw.provincias_inmuebles, '') AS provincias, sw.metodo, sw.ilegible, sw.numero AS bocv, sw.fecha_registro AS fecha_declaracion, coalesce(hi.n, -1) AS n_historico,
    CASE WHEN cu.decl_id IS NULL THEN 'No se ha localizado su declaración de bienes en los boletines' ELSE concat_ws('|', cu.aviso, nullif(qu.lectura, ''), nullif(qu.escrito, '')) END AS motivos,
    st.person_id IS NOT NULL AS tiene_renta, st.total_rentas AS rentas, st.total_salarios AS salarios, CAST(round(CAST(st.total_rentas AS {DEC}) - CAST(st.total_salarios AS {DEC}), 2) AS DOUBLE) AS otras_rentas, st.cuota_irpf
  FROM ro LEFT JOIN cu ON cu.person_id = ro.id LEFT JOIN sw ON sw.decl_id = cu.decl_id LEFT JOIN qu ON qu.decl_id = cu.decl_id LEFT JOIN hi ON hi.person_id = ro.id LEFT JOIN st ON st.person_id = ro.id)"""
W_PEOPLE = f"WITH {PEOPLE}"


def many_homes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active people with more than two homes, their provinces and net worth, in order."""
    out = E.order_people(E.filter_people(_people(spark, sf_dir), min_homes=3))
    return out.select("id", "apellidos", "nombre", "n_viviendas", F.array_join("provincias_viviendas", ";").alias("provincias"), "patrimonio_declarado")


def attach_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.attach_income(roster(spark, sf_dir).select("id"), statements(spark, sf_dir))


def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.run_metadata(_people(spark, sf_dir))


def headline_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.headline_counts(_people(spark, sf_dir), active=True, min_provinces=1)


def preset_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.preset_counts(_people(spark, sf_dir))


def filter_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = E.filter_people(_people(spark, sf_dir), text="PUIG", active=None, min_cadastral=1000, min_income=0, review=True)
    return found.select("id", "apellidos")


def filter_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People by group and district, by a province and least properties and assets, and by shared homes, debts and mortgages."""
    people = _people(spark, sf_dir)
    found = [
        E.filter_people(people, group="BUILDING", district="Valencia", active=None).select(F.lit("place").alias("filtro"), "id"),
        E.filter_people(people, province="GERMANY", min_properties=2, min_assets=30000).select(F.lit("province").alias("filtro"), "id"),
        E.filter_people(people, min_shared_homes=1, min_debts=40000, min_accounts=1, mortgage=True, active=False).select(F.lit("debts").alias("filtro"), "id"),
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


def order_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions(E.order_people(roster(spark, sf_dir))).select("id", "en_activo", "position")


def order_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places that people take by their debts, the largest first."""
    return places(E.order_view(_people(spark, sf_dir), "pasivo"), "pasivo")


def facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.facets(_people(spark, sf_dir))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"


def export_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export's lines, written and read again; the header once, though each file has it."""
    path = _folder(spark, "export")
    IO.export_filtered(E.filter_people(_people(spark, sf_dir), active=None, min_homes=1), path)
    return spark.read.text(path).select(F.col("value").alias("line")).distinct()


def _csv(c: str, number: bool) -> str:
    if number:
        return f"coalesce(replace(CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS DECIMAL(38,0)) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END, '.', ','), '')"
    return f"coalesce(CAST({c} AS VARCHAR), '')"


_NUMBERS = ("valor_catastral", "cuentas", "vehiculos", "inversiones", "otros_bienes", "pasivo", "rentas", "cuota_irpf")
_CELLS = [_csv("replace(provincias, ';', '; ')" if c == "provincias_inmuebles" else c, c in _NUMBERS) for c in IO.EXPORT_COLUMNS]
_QUOTED = ", ".join(f"""CASE WHEN regexp_matches({c}, '[",\n;]') THEN '"' || replace({c}, '"', '""') || '"' ELSE {c} END""" for c in _CELLS)
EXPORT_FILTERED = f"{W_PEOPLE} SELECT concat_ws(';', {_QUOTED}) AS line FROM pe WHERE coalesce(n_viviendas, 0) >= 1 UNION SELECT '{';'.join(IO.EXPORT_COLUMNS)}'"


def write_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The people's table, written as CSV and Parquet; the lists of both as they are read again."""
    path = _folder(spark, "published")
    IO.write_tables({"personas": _people(spark, sf_dir).select(*S.PEOPLE_COLUMNS)}, path)
    told = spark.read.option("header", True).csv(f"{path}/csv/personas")
    kept = spark.read.parquet(f"{path}/parquet/personas").select(F.col("id"), F.size("motivos_revision").alias("n_motivos"))
    own = told.select(F.col("id").cast("long").alias("id"), "cargo", "provincias_inmuebles", "motivos_revision", F.col("bocv").cast("int").alias("bocv"))
    return own.join(kept, "id").withColumns({c: F.coalesce(c, F.lit("")) for c in ("provincias_inmuebles", "motivos_revision")})


def write_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories as nested JSON documents, one for each person, written and read again."""
    path = _folder(spark, "documents")
    h = D.declaration_history(_checked(spark, sf_dir)).select("person_id", "historico")
    IO.write_documents(h.select("person_id"), h, h.agg(F.count("*").alias("n")), path)
    found = spark.read.schema("person_id long, historico array<struct<sello:string>>").json(f"{path}/json/declaraciones")
    return found.select("person_id", F.size("historico").alias("n"), F.get("historico.sello", F.lit(0)).alias("first"))


WRITE_DOCUMENTS = f"WITH {DECLARATIONS} SELECT person_id, CAST(count(*) AS INTEGER) AS n, arg_min(sello, (coalesce(CAST(fecha_registro AS VARCHAR), ''), numero, pos)) AS first FROM de GROUP BY person_id"


def flatten_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = _checked(spark, sf_dir)
    p = P.build(roster(spark, sf_dir), checked, statements(spark, sf_dir)).select(*S.OWNER, "decl_id", "bocv", "metodo", "ilegible")
    return S.flatten_items(p, N.items_of(checked, "otros_bienes"), S.ITEM_COLUMNS).drop("valor_txt")


FLATTEN_ITEMS = f"""
{W_PEOPLE} SELECT pe.id, apellidos, nombre, grupo, i.descripcion, i.categoria, i.valor, bocv, i.pagina, metodo AS metodo_lectura, i.dudoso
FROM pe JOIN ci i ON i.decl_id = pe.decl_id WHERE i.tab = 'otros_bienes' AND NOT ilegible
"""


def union_income_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.union_income_quota(roster(spark, sf_dir), income(spark, sf_dir), statements(spark, sf_dir))


UNION_INCOME = f"""
WITH {ROSTER},{INCOME}
SELECT id, apellidos, nombre, grupo, fecha_registro, apartado, concepto, origen, importe FROM inc JOIN st USING (person_id) JOIN ro ON ro.id = person_id
UNION ALL SELECT id, apellidos, nombre, grupo, fecha_registro, 'irpf', 'Cuota IRPF del año anterior', '', cuota_irpf FROM st JOIN ro ON ro.id = person_id WHERE cuota_irpf IS NOT NULL
"""


def _declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as declarations have them: a customer's in other case, with the surname's last letter twice, by surname only, or of nobody."""
    key = F.col("id")
    r = roster(spark, sf_dir)
    name = F.when(key % 4 == 2, F.lit(None).cast("string")).otherwise(F.upper("nombre"))
    surname = F.when(key % 4 == 1, F.concat("apellidos", F.substring("apellidos", -1, 1))).when(key % 4 == 3, F.concat(F.lit("9"), F.translate(F.md5((-key).cast("string").cast("binary")), "abcdef", "012345"))).otherwise(F.lower("apellidos"))
    return r.select(key.alias("decl_id"), name.alias("nombre"), surname.alias("apellidos"), F.lit("S").alias("sello"), key.alias("ord"))


#: A name in other case scores 1; with one letter more the surname's ratio is 2n / (2n + 1), beside an equal name; a
#: surname alone is met by its equal only, and digits meet nobody.
MATCH_PEOPLE = f"""
WITH {ROSTER},
k AS (SELECT id, len(replace({sql_norm("apellidos")}, ' ', '')) AS s, len(replace({sql_norm("nombre || ' ' || apellidos")}, ' ', '')) AS a FROM ro)
SELECT id AS decl_id, CASE WHEN id % 4 <> 3 THEN id END AS person_id,
  CASE id % 4 WHEN 0 THEN 1.0 WHEN 1 THEN greatest(2.0 * a / (2 * a + 1), 0.75 * 2.0 * s / (2 * s + 1) + 0.25) WHEN 2 THEN greatest(2.0 * s / (s + a), 0.75) END::DOUBLE AS score FROM k
"""


def match_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.match_people(_declared(spark, sf_dir).select("decl_id", "nombre", "apellidos"), roster(spark, sf_dir)).select("decl_id", "person_id", "score")


def resolve_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' people: five spellings of each name in turn."""
    key = F.col("s_suppkey")
    who = F.floor(key / 5)
    surname = F.concat(pick(SURNAMES, who), F.lit(" "), F.substring(F.md5(who.cast("string").cast("binary")), 1, 12))
    return W.resolve_unmatched(read(spark, sf_dir, "supplier").select(
        key.alias("decl_id"), F.when(key % 5 != 4, F.upper(pick(FORENAMES, who))).alias("nombre"), F.when(key % 5 == 1, F.regexp_replace(surname, "^.", "X")).otherwise(surname).alias("apellidos"), F.lit("S").alias("sello"), key.alias("ord"),
    )).select("decl_id", "leader")


def union_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = roster(spark, sf_dir)
    return W.union_people(r.where("en_activo").drop("en_activo"), r.where("not en_activo").select("id", "nombre", "apellidos")).select("id", "grupo", "en_activo")


#: People of the forms: single words, in mixed case.
_GIVEN, _FAMILY, _PLACES = ("Berta", "Marc", "Neus", "Oriol"), (("Ejemplo", "Ficticia"), ("Puig", "Martí"), ("Soler", "Vidal")), (("Alacant", "Alicante"), ("València", "Valencia"), ("Castelló", "Castellón"))


#: The forms' words and boxes: (page of a long form, y, text), words from x 60 on; a name in braces stands for a value.
_WORDS = (
    (1, 130, L.TITLES[0]), (1, 150, "DATOS PERSONALES"), (1, 165, "NOMBRE {given} APELLIDOS {family} {family2}"), (1, 180, "CIRCUNSCRIPCIÓN ELECTORAL {place}"), (1, 240, "DECLARACIÓN DE ACTIVIDADES"),
    (1, 300, "1.- Bienes inmuebles urbanos"), (1, 315, "CLAVE TIPO SITUACIÓN (PROVINCIA) VALOR CATASTRAL"), (1, 370, "VALOR CATASTRAL DEL CONJUNTO"), (1, 400, "2.- Bienes y derechos de naturaleza no inmobiliaria"),
    (1, 415, "DESCRIPCIÓN VALOR (EUROS)"), (2, 520, "3.- PASIVO"), (2, 535, "DESCRIPCIÓN VALOR (EUROS)"), (2, 740, "ESTOS DATOS SE DEBERÁN ACTUALIZAR"), (3, 260, "sin otras actividades"),
)
_BOXES = (
    (1, 60, 100, 335, "{right}"), (1, 105, 145, 335, "{kind}"), (1, 150, 200, 335, "50%"), (1, 205, 330, 335, "{province}"), (1, 335, 440, 335, "{value}"), (1, 300, 440, 370, "{value}"),
    (1, 60, 300, 435, "Cuenta corriente"), (1, 310, 440, 435, "{account}"), (1, 60, 300, 450, "Coche Seat"), (1, 310, 440, 450, "3.000"), (1, 300, 440, 480, "{assets}"),
    (2, 60, 300, 555, "Préstamo hipotecario"), (2, 310, 440, 555, "{debt}"), (2, 300, 440, 590, "{debt}"),
)


def _template(words: tuple, boxes: tuple) -> list[tuple]:
    """A form's words and boxes: (what, page, text, x0, x1, y0, y1, other reading)."""
    rows = []
    for page, y, text in words:
        x = 60.0
        for t in text.split():
            size = 45 if t[0] == "{" else 5 * len(t)
            rows.append(("w", page, t, x, x + size, float(y), float(y + 6), None))
            x += size + 3
    rows += [("b", page, t, float(x0), float(x1), float(y), float(y + 9), alt) for page, x0, x1, y, t, alt in ((*x, None)[:6] for x in boxes)]
    return rows


def _filled(spark: SparkSession, keys: DataFrame, words: tuple, boxes: tuple, values: dict[str, Column]) -> DataFrame:
    """``keys(k, lower, ...)`` with the words and boxes of the template as arrays of struct(what, p, t, x0, x1, y0, y1, alt), in its order."""
    known = {t for _, _, t, *_ in _template(words, boxes)} | {r[-1] for r in _template(words, boxes)}
    named = F.create_map(*(x for n, v in values.items() if "{" + n + "}" in known for x in (F.lit("{" + n + "}"), v)))
    fixed = F.from_json(F.lit(json.dumps([dict(zip(("what", "p", "t", "x0", "x1", "y0", "y1", "alt"), r, strict=True)) for r in _template(words, boxes)])), "array<struct<what:string,p:int,t:string,x0:double,x1:double,y0:double,y1:double,alt:string>>")
    fill = lambda c: F.coalesce(F.element_at("named", c), c)
    shift = lambda x: F.when((x["what"] == "b") | (x["y0"] >= 240), F.col("lower")).otherwise(0.0)
    put = lambda x: F.struct(x["what"].alias("what"), x["p"].alias("p"), fill(x["t"]).alias("t"), x["x0"].alias("x0"), x["x1"].alias("x1"), (x["y0"] + shift(x)).alias("y0"), (x["y1"] + shift(x)).alias("y1"), fill(x["alt"]).alias("alt"))
    return keys.withColumn("named", named).withColumn("items", F.transform(fixed, put)).drop("named")


def _side(items: Column | str, what: str, pages: Column) -> Column:
    """A page's words or boxes."""
    own = F.filter(items, lambda x: (x["what"] == what) & F.array_contains(pages, x["p"]))
    word = lambda x: F.struct(*(x[c].alias(c) for c in ("t", "x0", "x1", "y0", "y1")), F.lit(0).alias("v"))
    box = lambda x: F.struct(*(x[c].alias(c) for c in ("x0", "y0", "x1", "y1", "t")), F.lit(0).alias("dudoso"), x["alt"].alias("alt"))
    return F.transform(own, word if what == "w" else box)


def _money(c: Column) -> Column:
    return F.concat(F.floor(c / 100).cast("string"), F.lit(","), F.lpad((c % 100).cast("string"), 2, "0"))


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, cents, lower) of suppliers: an amount from the balance, and how much lower the form's sections lie."""
    cents = F.abs(F.round(F.col("s_acctbal").cast("decimal(20,4)") * 100).cast("long")) + 100
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), cents.alias("cents"), (F.col("s_suppkey") % 4 * 5).cast("double").alias("lower"))


def _forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A form of each supplier: a person, a property, two assets and a debt, with amounts from its balance.

    Sections lie lower or higher by supplier, some have a line more, and every third form goes on to a second page.
    """
    key, cents = F.col("k"), F.col("cents")
    values = {
        "given": pick(_GIVEN, key), "family": pick(tuple(f[0] for f in _FAMILY), key), "family2": pick(tuple(f[1] for f in _FAMILY), key), "place": pick(tuple(p[0] for p in _PLACES), key),
        "right": pick(("P", "Nuda propiedad", "U"), key), "kind": pick(("Vivienda", "R", "Local", "Plaza"), key), "province": pick(("Alacant", "MADRID", "xx"), key), "value": _money(cents),
        "account": _money(cents + 500), "assets": _money(cents + 300500), "debt": _money(cents + 7),
    }
    filled = _filled(spark, _keys(spark, sf_dir), _WORDS, _BOXES, values)
    more = F.when(key % 2 == 1, F.array(F.lit(1), F.lit(3))).otherwise(F.array(F.lit(1)))
    parts = F.when(key % 3 == 0, F.array(more, F.array(F.lit(2)))).otherwise(F.array(F.concat(more, F.array(F.lit(2)))))  # the debts may stand on a page of their own
    return filled.select("k", "items", F.posexplode(parts).alias("n", "parts")).select(
        F.col("k").cast("string").alias("decl_id"), (F.col("n") + 1).alias("num"), F.lit(842.0).alias("alto"), F.lit("texto").alias("metodo"), _side("items", "w", F.col("parts")).alias("palabras"),
        _side("items", "b", F.col("parts")).alias("casillas"), F.array(F.struct(F.concat(F.lit("XI"), F.lpad(F.col("k").cast("string"), 6, "0"), F.lit(" 05/03/2021 10:15")).alias("t"))).alias("sello"), F.lit("B1").alias("bulletin_id"),
    )


#: Scanned forms. Parts: 1 all; 2 and 3 a person in boxes or in capitals; 4, 5 and 6 a second row of four cells, of six, or of noise; 7 the total's label.
_SCAN_WORDS = (
    (1, 130, L.TITLES[0]), (1, 190, "DATOS PERSONALES"), (3, 205, "NOMBRE {given} APELLIDOS DEL RIO"), (3, 222, "CIRCUNSCRIPCIÓN ELECTORAL Castelló"), (1, 240, "DECLARACIÓN DE ACTIVIDADES"), (1, 300, "1.- Bienes inmuebles urbanos"),
    (1, 315, "CLAVE TIPO SITUACIÓN (PROVINCIA) VALOR CATASTRAL"), (7, 370, "VALOR CATASTRAL DEL CONJUNTO"), (1, 400, "2.- Bienes y derechos de naturaleza no inmobiliaria"), (1, 415, "DESCRIPCIÓN VALOR (EUROS)"),
    (1, 520, "3.- PASIVO"), (1, 535, "DESCRIPCIÓN VALOR (EUROS)"), (1, 740, "ESTOS DATOS SE DEBERÁN ACTUALIZAR"),
)
_SCAN_BOXES = (
    (2, 60, 200, 199, "{given}"), (2, 300, 440, 199, "Ejemplo Ficticia"), (2, 60, 200, 211, "Alacant"), (2, 60, 200, 223, "Partido Imaginario"),
    (1, 60, 100, 335, "{right}", "{right2}"), (1, 105, 145, 335, "{kind}"), (1, 150, 200, 335, "50%", "50 %"), (1, 205, 330, 335, "{province}"), (1, 335, 440, 335, "{value}", "{value2}"),
    (4, 60, 100, 350, "P"), (4, 105, 145, 350, "V"), (4, 150, 200, 350, "50%"), (4, 205, 330, 350, "Madrid"),
    (5, 60, 100, 350, "P"), (5, 105, 145, 350, "V"), (5, 150, 200, 350, "50%"), (5, 205, 270, 350, "Madrid"), (5, 275, 330, 350, "x"), (5, 335, 440, 350, "1"),
    (6, 60, 100, 350, "|"), (6, 105, 145, 350, ""), (6, 150, 200, 350, ""), (6, 205, 330, 350, ""), (6, 335, 440, 350, "7"), (1, 300, 440, 370, "{value}"),
    (1, 60, 300, 425, "Descripeion"), (1, 310, 440, 425, "Valor(euros)"), (1, 60, 300, 437, "Cuenta corriente", "Cuenta corrienle"), (1, 310, 440, 437, "{account}", "{account2}"), (1, 60, 300, 450, "Coche Seat ]"), (1, 310, 440, 450, "3:000"),
    (1, 60, 300, 465, "il"), (1, 310, 440, 465, ""), (1, 300, 440, 480, "{assets}"), (1, 60, 300, 555, "Préstamo hipotecario"), (1, 310, 440, 555, "{debt}"), (1, 300, 440, 590, "{debt}"),
)


def _scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scanned form of each supplier, with second readings, swapped and misread codes, rows of four and six cells, and the person by place or in capitals."""
    key, cents = F.col("k"), F.col("cents")
    none = F.lit(None).cast("string")
    values = {
        "given": pick(("BERTA", "MARC", "NEUS", "ORIOL"), key), "right": pick(("P", "Vivienda", "F", "zzzz"), key), "right2": pick(("P", "Vivienda", "F", "Nuda"), key), "kind": pick(("Vivienda", "Pleno", "Y", "Local"), key),
        "province": pick(("Alacant", "MADRJD", "VALENCIA"), key), "value": _money(cents), "value2": F.when(key % 3 == 0, F.concat(_money(cents), F.lit(" €"))).when(key % 3 == 1, _money(cents + 1)).otherwise(none),
        "account": _money(cents + 500), "account2": F.when(key % 3 == 1, F.lit("ilegible")).otherwise(none), "assets": _money(cents + 300500), "debt": _money(cents + 7),
    }
    filled = _filled(spark, _keys(spark, sf_dir), _SCAN_WORDS, _SCAN_BOXES, values)
    filled = filled.withColumn("items", F.transform("items", lambda x: x.withField("alt", F.when(x["alt"].startswith("{"), none).otherwise(x["alt"]))))
    parts = F.array_compact(F.array(F.lit(1), F.when(key % 2 == 0, 2).otherwise(3), F.when(key % 5 < 3, (key % 5).cast("int") + 4), F.when(key % 2 == 0, 7)))
    return filled.withColumn("parts", parts).select(
        key.cast("string").alias("decl_id"), F.lit(1).alias("num"), F.lit(842.0).alias("alto"), F.lit("ocr").alias("metodo"), _side("items", "w", F.col("parts")).alias("palabras"), _side("items", "b", F.col("parts")).alias("casillas"),
    )


def scan_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of scanned forms, with doubts and other readings, the total beside its label or below the rows, and warnings."""
    d = L.read_forms(_scans(spark, sf_dir))
    return d.select("decl_id", F.explode("inmuebles").alias("i"), "total_catastral", F.array_join("avisos", "|").alias("avisos")).select("decl_id", "i.clave", "i.tipo", "i.porcentaje", "i.provincia", "i.valor", "i.dudoso", F.size("i.alts").alias("n_alts"), "total_catastral", "avisos")


def scan_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets and debts of scanned forms: no misread header, no noise."""
    d = L.read_forms(_scans(spark, sf_dir))
    both = d.select("decl_id", F.explode("otros_bienes").alias("i"), F.col("total_otros_bienes").alias("total")).unionByName(d.select("decl_id", F.explode("pasivo").alias("i"), F.col("total_pasivo").alias("total")))
    return both.select("decl_id", "i.descripcion", "i.categoria", "i.valor", "i.dudoso", F.array_join("i.alts", "|").alias("alts"), "total")


def scan_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People of scanned forms, in boxes by place or in a line of capitals."""
    return L.read_forms(_scans(spark, sf_dir)).select("decl_id", "persona.*")


_MONEY = "abs(CAST(round(CAST(s_acctbal AS DECIMAL(20,4)) * 100) AS BIGINT)) + 100"


def flow_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = L.flow_pages(_forms(spark, sf_dir))
    n = lambda df, c: df.groupBy("decl_id").agg(F.count("*").cast("int").alias(c))
    return n(flow.lines, "n_lines").join(n(flow.boxes, "n_boxes"), "decl_id")


def find_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.find_sections(L.flow_pages(_forms(spark, sf_dir))).select("decl_id", "y_act", "y_inm", "y_noinm", "y_pas", "y_fin")


def property_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = L.read_forms(_forms(spark, sf_dir))
    return d.select("decl_id", F.explode("inmuebles").alias("i")).select("decl_id", "i.clave", "i.tipo", "i.porcentaje", "i.provincia", "i.valor")


def property_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.read_forms(_forms(spark, sf_dir)).select("decl_id", "total_catastral")


def asset_liability_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = L.read_forms(_forms(spark, sf_dir))
    both = d.select("decl_id", F.explode("otros_bienes").alias("i")).unionByName(d.select("decl_id", F.explode("pasivo").alias("i")))
    return both.select("decl_id", "i.descripcion", "i.categoria", "i.valor")


def person_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.read_forms(_forms(spark, sf_dir)).select("decl_id", "persona.*", "total_otros_bienes", "total_pasivo")


def detect_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms with their title, with a misread one, or with another."""
    f = _forms(spark, sf_dir)
    key = F.col("decl_id").cast("long")
    title = F.when(key % 3 == 0, F.col("palabras")).when(key % 3 == 1, F.transform("palabras", lambda w: w.withField("t", F.regexp_replace(w["t"], "INTERESES|REGISTRO", "INTERESFS")))).otherwise(F.transform("palabras", lambda w: w.withField("t", F.lit("otra"))))
    return L.detect_cover(f.withColumn("palabras", title), ["decl_id", "num"]).select("decl_id", "num", "is_cover")


def _bulletins(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The forms in ten bulletins, a page of something else behind every fifth; two insertions each; corrections by seal."""
    f = _forms(spark, sf_dir).withColumn("k", F.col("decl_id").cast("long")).drop("decl_id").withColumn("bulletin_id", F.concat(F.lit("B"), (F.col("k") % 10).cast("string")))
    other = f.where("num = 1 and k % 5 = 0").withColumns({"num": F.lit(3), "sello": F.lit(None).cast(dict(f.dtypes)["sello"]), "palabras": F.slice("palabras", 8, 2), "casillas": F.slice("casillas", 1, 0)})
    pages = f.unionByName(other).withColumn("num", F.row_number().over(Window.partitionBy("bulletin_id").orderBy("k", "num"))).drop("k")
    one = lambda pos, title, kind: f.select("bulletin_id").distinct().select("bulletin_id", F.lit(pos).alias("pos"), F.lit(title).alias("titulo"), F.lit(kind).alias("tipo"), F.lit(7).alias("numero"), F.lit("2021-04-01").cast("date").alias("fecha"), F.lit("https://boletin.example/7").alias("url_pdf"))
    insertions = one(1, "Declaraciones de bienes [1]", "inicial").unionByName(one(2, "Datos personales [2]", "modificacion"))
    text = F.concat(F.lit('{"XI'), F.lpad(F.col("s_suppkey").cast("string"), 6, "0"), F.lit('": {"motivo": "a mano", "persona": {"nombre": "Otra"}, "inmuebles": [{"clave": "P", "tipo": "V", "porcentaje": 100, "valor_catastral": 1000.5}], "total_catastral": 1000.5}}'))
    return pages, insertions, IO.parse_corrections(read(spark, sf_dir, "supplier").where("s_suppkey % 7 = 0").select(text.alias("value")))


def bulletin_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to checked declarations: seal, pages, kind by insertion, person, totals and sums, with corrections."""
    d = B.read_bulletins(*_bulletins(spark, sf_dir))
    return d.select("sello", "bulletin_id", F.size("paginas").alias("n_paginas"), "tipo", "metodo", "persona.nombre", "persona.apellidos", "total_catastral", "total_otros_bienes", "suma_inmuebles_cuadra", "suma_otros_cuadra", "suma_pasivo_cuadra", "has_property")


def bulletin_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run's people: a roster of one of the forms' people, and those that only declarations name, with how many declarations each has."""
    roster_ = spark.createDataFrame([("p1", "Berta", "Ejemplo Ficticia", "Grupo", "Alicante", 1)], "id string, nombre string, apellidos string, grupo string, circunscripcion string, roster_pos long")
    owned, people = B.link_people(B.read_bulletins(*_bulletins(spark, sf_dir)), roster_)
    n = owned.groupBy(F.col("person_id").alias("id")).agg(F.count("*").alias("n"))
    return people.join(n, "id", "left").select("id", "nombre", "apellidos", "circunscripcion", "en_activo", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


#: Everybody of the first family is the roster's one person of that surname; of the others the first declaration makes a person.
BULLETIN_PEOPLE = f"""
o AS (
  SELECT k % 3 AS r, CASE WHEN k % 7 = 0 THEN 'Otra' ELSE {sql_pick(_GIVEN, "k")} END AS given, {sql_pick(tuple(" ".join(x) for x in _FAMILY), "k")} AS family, {sql_pick(tuple(x[1] for x in _PLACES), "k")} AS place,
    row_number() OVER (PARTITION BY k % 3 ORDER BY 'B' || (k % 10), k) AS n, count(*) OVER (PARTITION BY k % 3) AS many FROM f)
SELECT CASE WHEN r = 0 THEN 'p1' ELSE 'ex-' || replace(lower(strip_accents(family || ' ' || given)), ' ', '-') END AS id, CASE WHEN r = 0 THEN 'Berta' ELSE given END AS nombre, family AS apellidos,
  CASE WHEN r = 0 THEN 'Alicante' ELSE place END AS circunscripcion, r = 0 AS en_activo, many AS n FROM o WHERE n = 1
"""


def published_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run's declarations as published documents, in a folder for each bulletin, written and read again."""
    path = _folder(spark, "documents")
    checked = B.read_bulletins(*_bulletins(spark, sf_dir)).withColumn("person_id", F.lit("p"))
    told = checked.select("decl_id", "bulletin_id", "person_id").join(D.publishable(checked), "decl_id")
    IO.write_documents(told.select("person_id").distinct(), told, told.agg(F.count("*").alias("n")), path)
    lists = "array<struct<valor:double>>"
    found = spark.read.schema(f"sello string, inmuebles {lists}, otros_bienes {lists}, pasivo {lists}, total_catastral double, bulletin_id string").json(f"{path}/json/declaraciones")
    return found.select("bulletin_id", "sello", *(F.size(t).alias(f"n_{t}") for t in N.TABLES), "total_catastral", F.get("inmuebles.valor", F.lit(0)).alias("valor"))


BULLETIN_RUN = """
s AS (SELECT f.*, k % 10 AS b, k % 7 = 0 AS m, k = max(k) OVER (PARTITION BY k % 10) AS last FROM f)"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        conditional_sum, reconcile_totals, repair_with_alternatives, clear_doubt, flag_illegible, flag_repeated_totals, flag_misfiled_assets, summarize_people, quality_report, assemble_people, many_homes,
        attach_income, run_metadata, headline_counts, preset_filters, filter_people, filter_by_place, order_people, order_view, facets, export_filtered, write_tables, write_documents, flatten_items, union_income_quota,
        match_people, resolve_unmatched, union_people, flow_pages, find_anchor, property_rows, property_total, asset_liability_rows, person_fields, scan_properties, scan_items, scan_people, detect_cover, bulletin_run, bulletin_people, published_documents,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    active = "FROM pe WHERE en_activo"
    preset = [("Con vivienda", "n_viviendas >= 1"), ("Más de 2 viviendas", "n_viviendas >= 3"), ("Vivienda compartida", "n_viviendas_compartidas >= 1"), ("Sin ningún inmueble", "n_inmuebles = 0"), ("Inmuebles en 3 provincias", "n_provincias >= 3"), ("Más de 50.000 € en cuentas", "cuentas >= 50000"), ("Con hipoteca", "tiene_hipoteca")]
    forms = f"WITH f AS (SELECT CAST(s_suppkey AS VARCHAR) AS decl_id, s_suppkey AS k, {_MONEY} AS c FROM supplier)"
    return {
        "conditional_sum": CONDITIONAL_SUM, "reconcile_totals": f"WITH {CHECKED} SELECT decl_id, ok AS cuadra FROM f_inmuebles",
        "repair_with_alternatives": f"WITH {CHECKED} SELECT decl_id, pos, valor AS valor_catastral, FALSE AS dudoso FROM ci WHERE corregido AND tab = 'inmuebles'",
        "clear_doubt": CLEAR_DOUBT, "flag_illegible": FLAG_ILLEGIBLE, "flag_repeated_totals": FLAG_REPEATED,
        "flag_misfiled_assets": f"WITH {DECLARATIONS} SELECT descripcion, {sql_pick(DEBT_CLASS, 'part')} AS categoria, count(*) AS n FROM it WHERE tab = 'pasivo' GROUP BY ALL",
        "summarize_people": SUMMARIZE, "quality_report": QUALITY_REPORT, "assemble_people": f"{W_PEOPLE} SELECT {', '.join(_SHOWN)}, motivos, n_historico FROM pe",
        "many_homes": f"{W_PEOPLE} SELECT pe.id, apellidos, nombre, pe.n_viviendas, s.provincias_viviendas AS provincias, pe.patrimonio_declarado FROM pe JOIN sw s USING (decl_id) WHERE en_activo AND pe.n_viviendas >= 3",
        "attach_income": f"WITH {ROSTER},{INCOME} SELECT id, st.person_id IS NOT NULL AS tiene_renta, total_rentas AS rentas, total_salarios AS salarios, CAST(round(CAST(total_rentas AS {DEC}) - CAST(total_salarios AS {DEC}), 2) AS DOUBLE) AS otras_rentas, cuota_irpf FROM ro LEFT JOIN st ON person_id = id",
        "run_metadata": f"{W_PEOPLE} SELECT count(*) AS n_personas, count(*) FILTER (en_activo) AS n_en_activo, count(decl_id) AS n_con_declaracion, count(*) FILTER (metodo = 'ocr') AS n_por_ocr, count(*) FILTER (comprobado) AS n_comprobadas, count(*) FILTER (ilegible) AS n_ilegibles, count(*) FILTER (revisar) AS n_revisar, count(*) FILTER (tiene_renta) AS n_con_renta FROM pe",
        "headline_counts": f"{W_PEOPLE}, v AS (SELECT * {active} AND coalesce(n_provincias, 0) >= 1) SELECT count(*) AS n_vista, count(*) FILTER (n_viviendas >= 1) AS n_con_vivienda, count(*) FILTER (n_viviendas >= 3) AS n_tres_o_mas, count(*) FILTER (n_inmuebles = 0) AS n_sin_inmueble, count(*) FILTER (tiene_hipoteca) AS n_con_hipoteca, count(*) FILTER (n_inmuebles IS NULL) AS n_sin_leer, (SELECT count(*) {active}) AS n_base FROM v",
        "preset_filters": f"{W_PEOPLE} " + " UNION ALL ".join(f"SELECT '{n}' AS preset, count(*) FILTER ({c}) AS n {active}" for n, c in preset),
        "filter_people": f"{W_PEOPLE} SELECT id, apellidos FROM pe WHERE contains(lower(strip_accents(nombre || ' ' || apellidos)), 'puig') AND coalesce(valor_catastral, 0) >= 1000 AND coalesce(rentas, 0) >= 0 AND revisar",
        "filter_by_place": f"{W_PEOPLE} SELECT 'place' AS filtro, id FROM pe WHERE grupo = 'BUILDING' AND circunscripcion = 'Valencia' UNION ALL SELECT 'province', id FROM pe WHERE en_activo AND list_contains(string_split(provincias, ';'), 'GERMANY') AND n_inmuebles >= 2 AND otros_bienes >= 30000"
        " UNION ALL SELECT 'debts', id FROM pe WHERE NOT en_activo AND n_viviendas_compartidas >= 1 AND pasivo >= 40000 AND cuentas >= 1 AND tiene_hipoteca",
        "order_people": f"WITH {ROSTER} SELECT id, en_activo, row_number() OVER (ORDER BY en_activo DESC, {sql_norm('apellidos')}, {sql_norm('nombre')}) AS position FROM ro",
        "order_view": f"{W_PEOPLE}, r AS (SELECT pasivo, row_number() OVER (ORDER BY pasivo DESC NULLS LAST) AS position FROM pe) SELECT pasivo, min(position) AS first, max(position) AS last, count(*) AS n FROM r GROUP BY pasivo",
        "facets": f"{W_PEOPLE} SELECT DISTINCT 'grupo' AS facet, grupo AS value FROM pe WHERE grupo <> '' UNION SELECT 'circunscripcion', circunscripcion FROM pe WHERE circunscripcion <> '' UNION SELECT 'provincia', p FROM (SELECT unnest(string_split(provincias, ';')) AS p FROM pe) WHERE p <> ''",
        "export_filtered": EXPORT_FILTERED, "write_tables": f"{W_PEOPLE} SELECT id, cargo, replace(provincias, ';', '; ') AS provincias_inmuebles, replace(motivos, '|', '; ') AS motivos_revision, bocv, CAST(CASE WHEN motivos = '' THEN 0 ELSE len(string_split(motivos, '|')) END AS INTEGER) AS n_motivos FROM pe",
        "write_documents": WRITE_DOCUMENTS, "flatten_items": FLATTEN_ITEMS, "union_income_quota": UNION_INCOME,
        "match_people": MATCH_PEOPLE, "resolve_unmatched": "SELECT s_suppkey AS decl_id, s_suppkey // 5 * 5 AS leader FROM supplier",
        "union_people": f"WITH {ROSTER} SELECT id, CASE WHEN en_activo THEN grupo END AS grupo, en_activo FROM ro",
        "flow_pages": f"{forms} SELECT decl_id, CAST(16 + k % 2 AS INTEGER) AS n_lines, 14 AS n_boxes FROM f",
        "find_anchor": f"{forms}, s AS (SELECT decl_id, CAST(k % 4 * 5 AS DOUBLE) AS y, CASE WHEN k % 3 = 0 THEN 10000.0 ELSE 0.0 END AS p FROM f) SELECT decl_id, 240 + y AS y_act, 300 + y AS y_inm, 400 + y AS y_noinm, 520 + y + p AS y_pas, 740 + y + p AS y_fin FROM s",
        "property_rows": f"{forms} SELECT decl_id, (['P', 'P', 'U'])[CAST(k % 3 AS INTEGER) + 1] AS clave, (['V', 'R', 'L', 'O'])[CAST(k % 4 AS INTEGER) + 1] AS tipo, CAST(50 AS DOUBLE) AS porcentaje, (['Alicante', 'Madrid', NULL])[CAST(k % 3 AS INTEGER) + 1] AS provincia, CAST(c AS DOUBLE) / 100 AS valor FROM f",
        "property_total": f"{forms} SELECT decl_id, CAST(c AS DOUBLE) / 100 AS total_catastral FROM f",
        "asset_liability_rows": f"{forms} SELECT decl_id, 'Cuenta corriente' AS descripcion, 'cuentas' AS categoria, CAST(c + 500 AS DOUBLE) / 100 AS valor FROM f UNION ALL SELECT decl_id, 'Coche Seat', 'vehiculos', 3000.0 FROM f UNION ALL SELECT decl_id, 'Préstamo hipotecario', 'hipoteca', CAST(c + 7 AS DOUBLE) / 100 FROM f",
        "person_fields": f"{forms} SELECT decl_id, {sql_pick(_GIVEN, 'k')} AS nombre, {sql_pick(tuple(' '.join(x) for x in _FAMILY), 'k')} AS apellidos, {sql_pick(tuple(x[1] for x in _PLACES), 'k')} AS circunscripcion, CAST(NULL AS VARCHAR) AS partido, CAST(c + 300500 AS DOUBLE) / 100 AS total_otros_bienes, CAST(c + 7 AS DOUBLE) / 100 AS total_pasivo FROM f",
        "scan_properties": f"{forms} SELECT decl_id, (['P', 'P', 'P', 'N'])[CAST(k % 4 AS INTEGER) + 1] AS clave, (['V', 'V', 'V', 'L'])[CAST(k % 4 AS INTEGER) + 1] AS tipo, CAST(50 AS DOUBLE) AS porcentaje, (['Alicante', 'Madrid', 'Valencia'])[CAST(k % 3 AS INTEGER) + 1] AS provincia, CAST(c AS DOUBLE) / 100 AS valor,"
        f" k % 3 = 1 AS dudoso, CAST(CASE WHEN k % 3 = 2 THEN 0 ELSE 1 END AS INTEGER) AS n_alts, CAST(c AS DOUBLE) / 100 AS total_catastral, CASE WHEN k % 5 < 2 THEN '{L.ODD_ROW}' ELSE '' END AS avisos FROM f",
        "scan_items": f"{forms} SELECT decl_id, 'Cuenta corriente' AS descripcion, 'cuentas' AS categoria, CAST(c + 500 AS DOUBLE) / 100 AS valor, k % 3 = 1 AS dudoso, CASE WHEN k % 3 = 1 THEN 'ilegible' ELSE '' END AS alts, CAST(c + 300500 AS DOUBLE) / 100 AS total FROM f"
        " UNION ALL SELECT decl_id, 'Coche Seat', 'vehiculos', 3000.0, FALSE, '', CAST(c + 300500 AS DOUBLE) / 100 FROM f UNION ALL SELECT decl_id, 'Préstamo hipotecario', 'hipoteca', CAST(c + 7 AS DOUBLE) / 100, FALSE, '', CAST(c + 7 AS DOUBLE) / 100 FROM f",
        "scan_people": f"{forms} SELECT decl_id, (['BERTA', 'MARC', 'NEUS', 'ORIOL'])[CAST(k % 4 AS INTEGER) + 1] AS nombre, CASE WHEN k % 2 = 0 THEN 'Ejemplo Ficticia' ELSE 'DEL RIO' END AS apellidos, CASE WHEN k % 2 = 0 THEN 'Alicante' ELSE 'Castellón' END AS circunscripcion, CASE WHEN k % 2 = 0 THEN 'Partido Imaginario' END AS partido FROM f",
        "bulletin_run": f"{forms},{BULLETIN_RUN} SELECT 'XI' || lpad(CAST(k AS VARCHAR), 6, '0') AS sello, 'B' || b AS bulletin_id, CAST(CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END AS INTEGER) AS n_paginas, CASE WHEN last THEN 'modificacion' ELSE 'inicial' END AS tipo, CASE WHEN m THEN 'manual' ELSE 'texto' END AS metodo,"
        f" CASE WHEN m THEN 'Otra' ELSE {sql_pick(_GIVEN, 'k')} END AS nombre, {sql_pick(tuple(' '.join(x) for x in _FAMILY), 'k')} AS apellidos, CASE WHEN m THEN 1000.5 ELSE CAST(c AS DOUBLE) / 100 END AS total_catastral, CASE WHEN NOT m THEN CAST(c + 300500 AS DOUBLE) / 100 END AS total_otros_bienes,"
        " TRUE AS suma_inmuebles_cuadra, CASE WHEN NOT m THEN TRUE END AS suma_otros_cuadra, CASE WHEN NOT m THEN TRUE END AS suma_pasivo_cuadra, TRUE AS has_property FROM s",
        "bulletin_people": f"{forms}, {BULLETIN_PEOPLE}",
        "published_documents": f"{forms} SELECT 'B' || (k % 10) AS bulletin_id, 'XI' || lpad(CAST(k AS VARCHAR), 6, '0') AS sello, 1::INTEGER AS n_inmuebles, CASE WHEN k % 7 = 0 THEN 0 ELSE 2 END::INTEGER AS n_otros_bienes, CASE WHEN k % 7 = 0 THEN 0 ELSE 1 END::INTEGER AS n_pasivo, CASE WHEN k % 7 = 0 THEN 1000.5 ELSE CAST(c AS DOUBLE) / 100 END AS total_catastral, CASE WHEN k % 7 = 0 THEN 1000.5 ELSE CAST(c AS DOUBLE) / 100 END AS valor FROM f",
        "detect_cover": f"{forms} SELECT decl_id, 1 AS num, k % 3 <> 2 AS is_cover FROM f UNION ALL SELECT decl_id, 2, FALSE FROM f WHERE k % 3 = 0",
    }
