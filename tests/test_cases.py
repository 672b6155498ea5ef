"""Functions on cases worked out by hand."""

from collections.abc import Callable

import pytest
from pyspark.sql import Column
from pyspark.sql import functions as F

from patrimonia.functions import amounts as A
from patrimonia.functions import codes as C
from patrimonia.functions import similarity as S
from patrimonia.functions import text as T

Case = tuple[str | None, object]

#: job: (function, result type in SQL, cases)
CASES: dict[str, tuple[Callable[[Column], Column], str, tuple[Case, ...]]] = {
    "parse_share": (
        A.parse_share, "DOUBLE",
        (("50%", 50.0), ("1/2", 50.0), ("33,33 %", 33.33), ("P", None), ("3/2", 150.0), ("1/0", 1.0), ("101", None), ("2/3", 66.67), (None, None), ("100", 100.0), ("-5", None)),
    ),
    "title_case_name": (
        T.title_case_name, "VARCHAR",
        (("MARIA DE LA O", "Maria de la O"), ("pere i roig", "Pere i Roig"), ("Ana mixta", "Ana mixta"), (None, ""), ("  LUIS   DEL RIO ", "Luis del Rio"), ("123", "123"), ("ÀNGELA", "Àngela")),
    ),
    "clean_ocr_edges": (
        T.clean_ocr_edges, "VARCHAR",
        (("PERUGA po", "PERUGA"), ("| Casa _", "Casa"), ("(MADRID", "MADRID"), ("a  b", "a b"), (None, None), ("VALOR  -- ;", "VALOR"), ("", "")),
    ),
    "clean_income_cell": (
        T.clean_income_cell, "VARCHAR",
        (("(cid:12)Sueldo+", "Sueldo"), ("Renta ++", "Renta"), (" Otros ", "Otros"), ("a+b", "a+b"), (None, None)),
    ),
    "has_word": (
        T.has_word, "BOOLEAN",
        (("Coche", True), ("aaa", False), ("xyz", False), ("a b c", False), (None, False), ("Ñandú 3", True), ("12345", False), ("eeea", False), ("ll la casa", True)),
    ),
    "code_right": (
        lambda c: C.code_right(c, ocr=F.lit(True)), "VARCHAR",
        (("Pleno dominio", "P"), ("NUDA PROPIEDAD", "P"), ("nua", "N"), ("Multipropiedad", "M"), ("Usufructo 50", "U"), ("u", "U"), ("F", "P"), ("xx", None), (None, None), ("D.", "P"), ("casa grande", None)),
    ),
    "code_type": (
        lambda c: C.code_type(c, ocr=F.lit(True)), "VARCHAR",
        (("Vivienda", "V"), ("PLAZA de garaje", "O"), ("Local", "L"), ("finca rústica", "R"), ("0", "O"), ("Y", "V"), ("K", "R"), ("Z", None), (None, None), ("solar", "O"), ("PIS", "V"), ("PISCINA", None)),
    ),
    "classify_asset": (
        C.classify_asset, "VARCHAR",
        (
            ("Plan de pensiones en banco", "pensiones"), ("Compte corrent", "cuentas"), ("Bancal de naranjos", "cuentas"), ("Participación en sociedad", "inversiones"), ("Seguro de vida", "seguros"),
            ("Volkswagen Golf", "vehiculos"), ("Motor de riego", "vehiculos"), ("Cuadro", "otros"), (None, "otros"), ("Obra S.L.", "inversiones"), ("Slalom", "otros"),
        ),
    ),
    "classify_liability": (
        C.classify_liability, "VARCHAR",
        (("Préstamo hipotecario", "hipoteca"), ("PRESXTAMO", "prestamo"), ("Pòlissa de crèdit", "prestamo"), ("Tarjeta VISA", "tarjeta"), ("Cuenta", "cuenta"), ("Deuda", "otros"), (None, "otros")),
    ),
    "parse_pub_date": (
        lambda c: C.parse_pub_date(c), "DATE",
        (("20240115", "2024-01-15"), ("19991231", "1999-12-31"), ("2024-01-15", None), ("20240230", None), (None, None), ("abc", None)),
    ),
    "classify_insertion": (
        C.classify_insertion, "VARCHAR",
        (("Modificaciones de las declaraciones", "modificacion"), ("Declaraciones finales de actividades", "final"), ("Declaración final", "final"), ("Declaraciones de bienes", "inicial"), ("La modificación", "inicial")),
    ),
    "decode_labels": (
        lambda c: F.concat_ws("|", C.decode_label(c, C.TYPE_LABELS), C.decode_label(c, C.RIGHT_LABELS, F.lit("texto")), C.decode_label(c, C.KIND_LABELS)), "VARCHAR",
        (("V", "Vivienda|texto|—"), ("P", "—|Pleno dominio|—"), ("final", "—|texto|Declaración final"), (None, "—|texto|—"), ("R", "Rústico|texto|—")),
    ),
}
#: Cases that need the helper for ratios: resolved on distinct texts.
PROVINCE_CASES: tuple[Case, ...] = (
    ("CASTELLÓN", "Castellón"), ("Alacant", "Alicante"), ("VALÈNCIA", "Valencia"), ("ELCHE (ALICANTE)", "Alicante"), ("VALENCLA", "Valencia"), ("xx", None), (None, None),
    ("Santa Cruz de Tenerife", "Santa Cruz de Tenerife"), ("Castellón de la Plana", "Castellón"), ("MALAGAA", "Málaga"), ("Las Palmas de G.C.", "Las Palmas"),
)
LABEL_CASES: tuple[Case, ...] = (
    ("Descripcion", True), ("Coche", False), ("VALOR (EUROS)", True), ("Valor catastral del conjunt", True), (None, False), ("Clave", True), ("Cuenta corriente", False), ("Situacion provincia", True)
)
SIMILAR_CASES: tuple[tuple[str, str, float], ...] = (
    ("Ñúñez", "nunez", 1.0), ("ABCD", "BCDE", 0.75), ("", "A", 0.0), ("Perez Lopez", "Lopez Perez", 0.5), ("tide", "diet", 0.25), ("diet", "tide", 0.5),
)


@pytest.mark.parametrize("name", CASES)
def test_function(spark, name):
    function, kind, cases = CASES[name]
    got = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string").select("i", function(F.col("t")).alias("r")).orderBy("i").collect()
    assert [str(r.r) if kind == "DATE" and r.r else r.r for r in got] == [c[1] for c in cases]


@pytest.mark.parametrize(("function", "cases"), [(S.resolve_province, PROVINCE_CASES), (S.is_label, LABEL_CASES)])
def test_function_with_ratios(spark, function, cases):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string")
    assert [r.r for r in function(df, "t", "r").orderBy("i").collect()] == [c[1] for c in cases]


def test_similarity(spark):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(SIMILAR_CASES)], "i int, a string, b string, want double")
    assert df.withColumn("got", S.similarity("a", "b")).where("abs(got - want) > 1e-9").collect() == []
