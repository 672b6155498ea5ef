"""Needles in texts and boxes on pages against all pairs; income forms with failed pages."""

import random

from pyspark.sql import Row
from pyspark.sql import functions as F

from patrimonia.jobs.income import read_income
from patrimonia.operators import layout as L
from patrimonia.operators import sequence as Q


def test_contains_join_equals_all_pairs(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["ab", "b", "abc", "cab", "", "bca", "aab"])
    text = lambda n: " ".join(word() for _ in range(rng.randrange(n)))
    pages = [(rng.choice("xy"), i, text(14)) for i in range(60)] + [("x", 60, None), ("z", 61, "ab ab")]
    titles = [(rng.choice("xy"), i, rng.choice([text(9), text(3), *(p[2][rng.randrange(3) : rng.randrange(3, 30)] for p in pages[:40])])) for i in range(150)] + [("x", 150, None), ("w", 151, "ab"), ("x", 152, "b"), ("x", 152, "b")]
    needles, texts = spark.createDataFrame(titles, "k string, pos int, needle string"), spark.createDataFrame(pages, "k string, num int, body string")
    want = [(k, a, n, b, t) for k, a, n in titles for q, b, t in pages if k == q and n and t and n in t]
    for direct in (0, sum(1 for t in titles if t[0] == "x" and t[2]) * sum(1 for q in pages if q[0] == "x" and q[2]) - 1, 10**6):
        got = Q.contains_join(needles, texts, "k", "needle", "body", direct)
        assert got.columns == ["k", "pos", "needle", "num", "body"] and sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 300


def test_grid_equals_all_pairs(spark):
    rng = random.Random(4)
    boxes = []
    for p in range(3):
        for i in range(60):
            x, y, size = rng.uniform(-50, 900), rng.uniform(-50, 900), rng.choice([5, 30, 200, 3000])
            boxes.append((p, i, x, y, x + rng.uniform(0, size), y + rng.uniform(0, size)))
    boxes.append((0, 60, None, None, None, None))
    words = [(p, f"{p}-{i}", x := rng.uniform(-60, 1000), x + 20, y := rng.uniform(-60, 1000), y + 6) for p in range(4) for i in range(80)] + [(0, "nowhere", None, None, None, None)]
    b = spark.createDataFrame(boxes, "p int, box int, x0 double, y0 double, x1 double, y1 double")
    w = spark.createDataFrame(words, "p int, t string, x0 double, x1 double, y0 double, y1 double")

    def inside(c, v):
        return c[2] is not None and v[2] is not None and c[0] == v[0] and c[2] - 1 <= (v[2] + v[3]) / 2 <= c[4] + 1 and c[3] - 1 <= (v[4] + v[5]) / 2 <= c[5] + 1

    want = {(c[0], c[1]): sorted(v[1] for v in words if inside(c, v)) for c in boxes}
    assert {(r.p, r.box): sorted(r.t.split()) for r in L.words_in_boxes(w, b, ["p"]).collect()} == want

    def holds(c, o):
        area = lambda z: (z[4] - z[2]) * (z[5] - z[3])
        return c != o and c[0] == o[0] and None not in (c[2], o[2]) and o[2] >= c[2] - 0.6 and o[3] >= c[3] - 0.6 and o[4] <= c[4] + 0.6 and o[5] <= c[5] + 0.6 and area(o) < 0.98 * area(c)

    assert {(r.p, r.box) for r in L.drop_container_boxes(b, ["p"]).collect()} == {c[:2] for c in boxes if not any(holds(c, o) for o in boxes)}


PAGES = "person_id string, num int, alto double, palabras array<struct<t:string,x0:double,x1:double,y0:double,y1:double,v:int>>, error string"


def words(*lines):
    return [Row(t=t, x0=float(x), x1=float(x + 5), y0=float(y), y1=float(y + 6), v=0) for y, line in lines for x, t in line]


def test_income_forms(spark):
    first = words(
        (50, [(400, "05/03/2021"), (450, "10:15")]), (110, [(50, "Estat"), (80, "civil")]), (125, [(50, "Estado"), (90, "civil")]), (140, [(50, "Soltera"), (300, "Ninguno")]),
        (160, [(10, "I."), (20, "a"), (30, "b"), (40, "c")]), (180, [(50, "Nómina"), (300, "Empresa"), (450, "1.200,50"), (500, "€")]), (800, [(10, "II."), (20, "a"), (30, "b"), (40, "c")]),
    )
    second = words((120, [(50, "Otra"), (450, "100"), (500, "€")]), (140, [(10, "V."), (20, "a"), (30, "b"), (40, "c")]), (160, [(50, "Quota"), (450, "77,10"), (500, "€")]))
    pages = [("a", 1, 842.0, first, None), ("a", 2, 842.0, second, None), ("a", 3, 842.0, None, "roto"), ("b", 1, 842.0, [], "roto"), ("c", 1, 842.0, [], None), (None, 1, 842.0, first, None)]
    got = read_income(spark.createDataFrame(pages, PAGES))
    a, c = sorted(got.statements.collect(), key=lambda r: r.person_id)
    assert (str(a.fecha_registro), a.estado_civil, a.regimen_matrimonial, a.total_salarios, a.total_rentas, a.cuota_irpf, a.paginas_fallidas) == ("2021-03-05", "Soltera", "Ninguno", 1300.5, 1300.5, 77.1, 1)
    assert (c.person_id, c.fecha_registro, c.estado_civil, c.total_rentas, c.cuota_irpf, c.paginas_fallidas) == ("c", None, None, 0.0, None, 0)
    assert [(r.apartado, r.concepto, r.origen, r.importe) for r in got.items.orderBy("pos").collect()] == [("salarios", "Nómina", "Empresa", 1200.5), ("salarios", "Otra", "", 100.0)]
    assert {r.person_id: r.pages for r in got.failed.collect()} == {"a": 1, "b": 1}
    none = read_income(spark.createDataFrame([], PAGES))
    assert none.statements.where(F.lit(True)).collect() == none.items.collect() == none.failed.collect() == []
