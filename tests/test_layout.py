"""Form pages: an invented page from end to end, and the helpers against sequential rules."""

import random

import numpy as np
from pyspark.sql import Row
from pyspark.sql import functions as F

from patrimonia.operators import layout as L
from patrimonia.sources.tables import BOX, WORD

PAGES = f"decl_id string, num int, alto double, metodo string, palabras array<{WORD}>, casillas array<{BOX}>, sello array<{WORD}>"


def words(text, x, y):
    out = []
    for t in text.split():
        out.append(Row(t=t, x0=float(x), x1=float(x + 5 * len(t)), y0=float(y), y1=float(y + 6), v=0))
        x += 5 * len(t) + 3
    return out


def box(x0, x1, y, text, alt=None):
    return Row(x0=float(x0), y0=float(y), x1=float(x1), y1=float(y + 9), t=text, dudoso=None, alt=alt)


def form_page():
    w = []
    for y, x, t in [
        (130, 60, "REGISTRO DE ACTIVIDADES, BIENES E INTERESES"), (150, 60, "DATOS PERSONALES"),
        (165, 60, "NOMBRE Berta Inventada APELLIDOS Ejemplo Ficticia"), (180, 60, "CIRCUNSCRIPCIÓN ELECTORAL Alacant"),
        (195, 60, "PARTIDO QUE FIGURA EN LAS ELECCIONES Partido Imaginario"), (240, 60, "DECLARACIÓN DE ACTIVIDADES"),
        (300, 60, "1.- Bienes inmuebles urbanos y rústicos"), (315, 60, "CLAVE TIPO DOMINIO SITUACIÓN (PROVINCIA) VALOR CATASTRAL"),
        (370, 60, "VALOR CATASTRAL DEL CONJUNTO"), (400, 60, "2.- Bienes y derechos de naturaleza no inmobiliaria"), (415, 60, "DESCRIPCIÓN VALOR (EUROS)"),
        (480, 60, "VALOR GLOBAL CONJUNTO"), (520, 60, "3.- PASIVO"), (535, 60, "DESCRIPCIÓN VALOR (EUROS)"), (590, 60, "VALOR GLOBAL CONJUNTO"),
        (740, 60, "ESTOS DATOS SE DEBERÁN ACTUALIZAR"),
    ]:
        w += words(t, x, y)
    xs = [(60, 100), (105, 145), (150, 200), (205, 330), (335, 440)]
    b = [box(x0, x1, 335, t) for (x0, x1), t in zip(xs, ["P", "V", "100%", "Alacant", "45.000,50 €"])]
    b += [box(300, 440, 370, "45.000,50")]
    for y, d, v in [(435, "Cuenta corriente en el banco", "1.200,00"), (450, "Coche de ocasión marca Seat", "3.000")]:
        b += [box(60, 300, y, d), box(310, 440, y, v)]
    b += [box(300, 440, 480, "4.200,00")]
    b += [box(60, 300, 555, "Préstamo hipotecario"), box(310, 440, 555, "20.000"), box(300, 440, 590, "20.000")]
    return ("d1", 1, 842.0, "texto", w, b, words("X1000157 02/03/2021 10:15", 400, 20))


def test_form_page(spark):
    pages = spark.createDataFrame([form_page()], PAGES)
    stamped = L.detect_cover(L.extract_stamp(pages), ["decl_id", "num"]).select("seal", F.col("fecha").cast("string"), "is_cover").first()
    assert tuple(stamped) == ("XI000157", "2021-03-02", True)
    d = L.read_forms(pages).first()
    assert d.persona.asDict() == {"nombre": "Berta Inventada", "apellidos": "Ejemplo Ficticia", "circunscripcion": "Alicante", "partido": "Partido Imaginario"}
    assert [(i.clave, i.tipo, i.porcentaje, i.provincia, i.valor, i.dudoso) for i in d.inmuebles] == [("P", "V", 100.0, "Alicante", 45000.5, False)]
    assert [(i.descripcion, i.categoria, i.valor) for i in d.otros_bienes] == [("Cuenta corriente en el banco", "cuentas", 1200.0), ("Coche de ocasión marca Seat", "vehiculos", 3000.0)]
    assert [(i.categoria, i.valor) for i in d.pasivo] == [("hipoteca", 20000.0)]
    assert (d.total_catastral, d.total_otros_bienes, d.total_pasivo, d.avisos) == (45000.5, 4200.0, 20000.0, [])


def test_form_without_sections(spark):
    page = ("d2", 1, 842.0, "texto", words("Otra cosa", 60, 300), [], [])
    d = L.read_forms(spark.createDataFrame([page], PAGES)).first()
    assert (d.inmuebles, d.otros_bienes, d.pasivo, d.total_catastral, d.avisos) == ([], [], [], None, [L.NO_PROPERTIES])


def test_scanned_form(spark):
    """Boxes by place, capitals by runs, readings that differ, and the larger number of valid cells asked of scans."""
    _, num, alto, _, w, b, _ = form_page()
    w = [x for x in w if not 160 <= x.y0 <= 200] + words("NOMBRE MARTA APELLIDOS DEL RIO", 60, 165)
    b = [x if x.t != "1.200,00" else Row(**{**x.asDict(), "alt": "1.300,00"}) for x in b]
    b += [box(60, 100, 345, "|"), box(105, 145, 345, ""), box(150, 200, 345, ""), box(205, 330, 345, ""), box(335, 440, 345, "7")]
    d = L.read_forms(spark.createDataFrame([("d3", num, alto, "ocr", w, b, [])], PAGES)).first()
    assert (d.persona.nombre, d.persona.apellidos) == ("MARTA", "DEL RIO")
    assert len(d.inmuebles) == 1 and [i.dudoso for i in d.otros_bienes] == [True, False] and d.otros_bienes[0].alts == ["1.300,00"]


def test_running_mean_lines():
    """A slow drift stays near its neighbours but leaves the line's mean."""
    y = np.array([0.0, 2.0, 4.0, 6.0])
    assert L.cluster(y, np.zeros(4), 2.5).tolist() == [0, 0, 1, 1]
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randrange(1, 30)
        y, x = np.array([rng.choice([0, 1, 2.5, 3, 5, 7.5]) for _ in range(n)]), np.array([rng.randrange(5) for _ in range(n)], float)
        lines = []
        for i in sorted(range(n), key=lambda i: (y[i], x[i])):
            if lines and abs(y[i] - sum(y[j] for j in lines[-1]) / len(lines[-1])) <= 2.5:
                lines[-1].append(i)
            else:
                lines.append([i])
        assert L.cluster(y, x, 2.5).tolist() == [next(k for k, line in enumerate(lines) if i in line) for i in range(n)]


def test_boxes(spark):
    rows = [(1, "outer", 0.0, 0.0, 100.0, 50.0), (1, "inner", 10.0, 10.0, 90.0, 40.0), (1, "same", 0.0, 60.0, 100.0, 90.0), (1, "twin", 0.3, 60.2, 100.0, 90.0), (2, "alone", 0.0, 0.0, 100.0, 50.0)]
    boxes = spark.createDataFrame(rows, "p int, box string, x0 double, y0 double, x1 double, y1 double")
    assert {r.box for r in L.drop_container_boxes(boxes, ["p"]).collect()} == {"inner", "same", "twin", "alone"}
    w = spark.createDataFrame([(1, "b", 50.0, 60.0, 20.0, 26.0), (1, "a", 20.0, 30.0, 20.5, 26.0), (1, "out", 200.0, 210.0, 20.0, 26.0)], "p int, t string, x0 double, x1 double, y0 double, y1 double")
    assert {r.box: r.t for r in L.words_in_boxes(w, boxes, ["p"]).collect()} == {"outer": "a b", "inner": "a b", "same": "", "twin": "", "alone": ""}
