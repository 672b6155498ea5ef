"""Form pages as words and boxes: lines, rows, anchors and the form's tables, as tables of lines, boxes and rows.

A page's lines and boxes are found within its row. From then on a line and a box is a row of its own, so that each rule
is a column: lines that mark something give a declaration's sections, boxes are dealt by declaration once, and windows
and groups by declaration follow without another exchange. Python is used for what needs the order of a running mean or
of kept boxes, and for ratios of texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructType

from patrimonia.functions.amounts import parse_amount, parse_share
from patrimonia.functions.codes import classify_asset, classify_liability, code_pair
from patrimonia.functions.similarity import FORM_LABELS, LABEL_ALIKE, PROVINCE_ALIKE, PROVINCE_KEYS, _plain_upper, province_by_word
from patrimonia.functions.text import clean_ocr_edges, compact_norm, has_word, norm_text
from patrimonia.sources.store import save, settings

LINE_TOLERANCE, ROW_TOLERANCE = 2.5, 4.0
#: Pages of a declaration stand below each other at this distance.
PAGE_STEP = 10_000
STAMP_HEIGHT, STAMP_BOTTOM, FOOT_HEIGHT = 190, 185, 95
SAME_BOX, KEPT_BACK = 2.5, 12
COVER_LINES, COVER_ALIKE = 40, 0.8
# Titles, anchors and marks of the form, on normalised text.
TITLES = ("REGISTRO DE ACTIVIDADES, BIENES E INTERESES", "REGISTRE D'ACTIVITATS, BÉNS I INTERESSOS")
COVER_TITLES = ("REGISTRO DE ACTIVIDADES BIENES E INTERESES", "REGISTRE D ACTIVITATS BENS I INTERESSOS")
SEAL, STAMP_DATE = r"\b(X[I1l]?[0-9]{5,7})\b", r"\b([0-9]{2})/([0-9]{2})/([0-9]{4})\s+[0-9]{2}:[0-9]{2}\b"
ACTIVITIES = (r"DECLARACI\w* D ?E? ?ACTIVI",)
PROPERTIES = (r"\b1 \w{3,7} (INMUEBLES|IMMOBLES)", r"(INMUEBLES|IMMOBLES) URBAN")
OTHER_ASSETS = (r"NATURALE[SZ]A ?NO I[NM]MOBILI", r"DERECHOS DE ?NATUR", r"DRETS DE NATUR", r"NO INMOBILIARIA", r"NO IMMOBILIARIA")
DEBTS = (r"\b3 (PASIVO|PASSIU)", r"^\W*(\w\s+)?(PASIVO|PASSIU)\b")
END = (r"ESTOS DATOS SE DEBERAN", r"AQUESTES DADES CALDRA", r"DECLARO? QUE L[OE]S DA", r"PROTECCIO DE DADES", r"PROTECCION DE DATOS")
PROPERTY_TOTAL = (r"(CATASTRAL|CADASTRAL|CATASIRAL) DEL CONJU",)
PROPERTY_HEADER, ITEM_HEADER = r"SITUACI|PROVINCI|CATASTRAL|CADASTRAL", r"DESCRIP"
PERSON_TITLE, PERSON_DATA = (r"REGISTR[OE] D ?E? ?ACTIVI", r"BIENES E INTERES", r"BENS I INTERESSOS"), (r"DAD?ES PERSONALS", r"DATOS PERSONALES")
PERSON_NOISE = r"DECLARA|PRIMERA|MODIFICACI|FINALI|LEGISLATURA|REGISTR|DADES PERSONALS|DATOS PERSONALES"
NAME_LABELS = (("NOM", "COGNOMS"), ("NOMBRE", "APELLIDOS"))
DISTRICTS = ("Alicante", "Castellón", "Valencia")
# Warnings that the published tables carry.
NO_PROPERTIES = "No se ha encontrado el apartado de bienes inmuebles"
NO_ASSETS = "No se ha encontrado el apartado de bienes no inmobiliarios"
NO_DEBTS = "No se ha encontrado el apartado de pasivo"
ODD_ROW = "Fila de inmuebles con un número raro de casillas"


KINDS = StructType().add("label", BooleanType()).add("header", BooleanType()).add("near", StringType())
#: Texts whose kind a Python worker remembers.
REMEMBERED = 50_000


# ---- helpers in Python ----------------------------------------------------------------------------------------------
def cluster(centre: np.ndarray, x: np.ndarray, tolerance: float) -> np.ndarray:
    """The number of each point's line: by centre and x, a point joins the line before if it lies near its running mean."""
    out = np.zeros(len(centre), np.int32)
    line, total, count = -1, 0.0, 0
    for i in np.lexsort((x, centre)):
        if count and abs(centre[i] - total / count) <= tolerance:
            total, count = total + centre[i], count + 1
        else:
            line, total, count = line + 1, centre[i], 1
        out[i] = line
    return out


def in_lines(centre: np.ndarray, x: np.ndarray, tolerance: float) -> list[np.ndarray]:
    """The points of each line of ``cluster``, by x and then by centre."""
    if not len(centre):
        return []
    line = cluster(centre, x, tolerance)
    order = np.lexsort((centre, x, line))
    return np.split(order, np.flatnonzero(np.diff(line[order])) + 1)


@pandas_udf(ArrayType(ArrayType(IntegerType())))
def cluster_rows(centre: pd.Series, x: pd.Series, tolerance: pd.Series) -> pd.Series:
    """``in_lines`` for each row's arrays."""
    return pd.Series([None if c is None else in_lines(np.asarray(c, float), np.asarray(a, float), t) for c, a, t in zip(centre, x, tolerance, strict=True)])


@pandas_udf(ArrayType(BooleanType()))
def keep_boxes(edges: pd.Series) -> pd.Series:
    """For arrays of edges in order: which boxes aren't within 2.5, on every side, of one of the last 12 kept."""
    out = []
    for e in edges:
        if e is None:
            out.append(None)
            continue
        a = np.array([np.asarray(v, float) for v in e]).reshape(len(e), 4)
        kept: list[int] = []
        flags = np.zeros(len(a), bool)
        for i in range(len(a)):
            if not kept or not (np.abs(a[kept[-KEPT_BACK:]] - a[i]) < SAME_BOX).all(axis=1).any():
                kept.append(i)
                flags[i] = True
        out.append(flags)
    return pd.Series(out)


def _alike(a: str, b: str, least: float) -> bool:
    if not a or not b or 2 * min(len(a), len(b)) <= least * (len(a) + len(b)):
        return False
    return SequenceMatcher(None, a, b).ratio() > least


def _compact(text: str) -> str:
    return re.sub("[^A-Z0-9]", "", _plain_upper(text))


@lru_cache(REMEMBERED)
def _printed(bare: str) -> tuple[bool, bool]:
    """Whether a text without spaces is like a label of the form, and like its word for description."""
    return any(_alike(bare, x, LABEL_ALIKE) for x in map(_compact, FORM_LABELS)), _alike(bare, "DESCRIPCION", 0.5)


@lru_cache(REMEMBERED)
def _nearest(text: str) -> str | None:
    """The province of the most alike key; of equally alike keys the last."""
    best = None
    for key, province in PROVINCE_KEYS.items():
        if 2 * min(len(key), len(text)) >= PROVINCE_ALIKE * (len(key) + len(text)):
            r = SequenceMatcher(None, key, text).ratio()
            if r >= PROVINCE_ALIKE and (best is None or (r, key) > best[:2]):
                best = (r, key, province)
    return best[2] if best else None


@pandas_udf(KINDS)
def text_kinds(norm: pd.Series, open_: pd.Series) -> pd.DataFrame:
    """For normalised texts: like a label of the form, like its word for description; the province most alike to ``open_``, if any."""
    printed = [_printed(t.replace(" ", "")) if t else (False, False) for t in norm]
    near = [_nearest(t) if isinstance(t, str) and t else None for t in open_]
    return pd.DataFrame({"label": [p[0] for p in printed], "header": [p[1] for p in printed], "near": pd.Series(near, dtype=object)})


@pandas_udf(ArrayType(StringType()))
def capital_runs(lines: pd.Series) -> pd.Series:
    """Runs of words in capitals that aren't the form's labels, letters only."""
    labels = ("NOMBRE", "NOM", "APELLIDOS", "COGNOMS")

    def runs(text: str) -> list[str]:
        out: list[str] = []
        open_: list[str] = []
        for token in text.split():
            bare = re.sub("[^A-Za-zÀ-ÿ]", "", token)
            if len(bare) >= 2 and bare.isupper() and not any(_alike(_compact(bare), x, 0.7) for x in labels):
                open_.append(bare)
            elif open_:
                out.append(" ".join(open_))
                open_ = []
        return [*out, " ".join(open_)] if open_ else out

    return pd.Series([runs(t or "") for t in lines])


@pandas_udf(BooleanType())
def differ(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether two normalised texts have a ratio below 0.6."""
    return pd.Series([bool(not x or not y or SequenceMatcher(None, x, y).ratio() < 0.6) for x, y in zip(a.fillna(""), b.fillna(""), strict=True)])


def pinned(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that a Python function gives: a row generator keeps the planner from moving the call into a lambda, where it can't run."""
    return df.withColumn(name, value).withColumn(name, F.explode(F.array(name)))


# ---- words and boxes of a page ---------------------------------------------------------------------------------------
def _centre(w: Column) -> Column:
    return (w["y0"] + w["y1"]) / 2


def horizontal(words: Column | str) -> Column:
    """The words that aren't written vertically."""
    return F.filter(words, lambda w: F.coalesce(w["v"], F.lit(0)) == 0)


def _clustered(df: DataFrame, out: str, items: Column, tolerance: float) -> DataFrame:
    df = df.withColumn("_items", F.coalesce(items, F.filter(items, lambda _: F.lit(False))))
    df = pinned(df, "_ids", cluster_rows(F.transform("_items", _centre), F.transform("_items", lambda w: w["x0"]), F.lit(tolerance)))
    return df.withColumn(out, F.transform("_ids", lambda line: F.transform(line, lambda i: F.get("_items", i)))).drop("_items", "_ids")


def words_to_lines(pages: DataFrame, words: str = "palabras", out: str = "lineas", tolerance: float = LINE_TOLERANCE) -> DataFrame:
    """``pages`` with their horizontal words in lines, top to bottom and left to right."""
    return _clustered(pages, out, horizontal(words), tolerance)


def boxes_to_rows(df: DataFrame, boxes: str, top: Column, bottom: Column, out: str) -> DataFrame:
    """``df`` with the boxes whose centre lies from ``top`` to below ``bottom`` in rows; none where a bound is null."""
    within = F.filter(boxes, lambda c: F.coalesce((_centre(c) >= F.col("_top")) & (_centre(c) < F.col("_bottom")), F.lit(False)))
    return _clustered(df.withColumns({"_top": top, "_bottom": bottom}), out, within, ROW_TOLERANCE).drop("_top", "_bottom")


#: The grid's finest cells, and how often they double: a box lies in a few cells of the level that fits its size.
CELL_SIDE, CELL_LEVELS = 32.0, 6


def _side(level: Column) -> Column:
    return F.lit(CELL_SIDE) * F.pow(F.lit(2.0), level)


def _touched(boxes: DataFrame, spare: float) -> DataFrame:
    """``boxes(x0, y0, x1, y1, ...)`` in each cell (_level, _i, _j) that they touch with ``spare`` around them."""
    size = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(1.0)) + 2 * spare
    level = F.least(F.greatest(F.ceil(F.log2(size / CELL_SIDE)), F.lit(0)), F.lit(CELL_LEVELS - 1))
    out = boxes.withColumn("_level", level)
    span = lambda a, b: F.sequence(F.floor((F.least(a, b) - spare) / _side(F.col("_level"))), F.floor((F.greatest(a, b) + spare) / _side(F.col("_level"))))
    return out.withColumn("_i", F.explode(span("x0", "x1"))).withColumn("_j", F.explode(span("y0", "y1")))


def _placed(points: DataFrame, x: Column, y: Column) -> DataFrame:
    """``points`` in the cell of each level that they lie in."""
    out = points.withColumn("_level", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(CELL_LEVELS - 1).cast("long"))))
    return out.withColumns({"_i": F.floor(x / _side(F.col("_level"))), "_j": F.floor(y / _side(F.col("_level")))})


_GRID = ["_level", "_i", "_j"]


def words_in_boxes(words: DataFrame, boxes: DataFrame, page: list[str]) -> DataFrame:
    """``boxes(page, box, x0, y0, x1, y1)`` with the text of ``words(page, t, x0, x1, y0, y1)`` whose centre lies in them, with 1 to spare.

    Boxes and words meet in the cells of a grid, not page by page. Words without a place lie nowhere; a box without one,
    or without words, has an empty text.
    """
    w = words.select(*page, "t", F.col("x0").alias("_x"), ((F.col("x0") + F.col("x1")) / 2).alias("_cx"), ((F.col("y0") + F.col("y1")) / 2).alias("_cy"), F.round(F.col("y0") / 3).alias("_line"))
    inside = F.col("_cx").between(F.col("x0") - 1, F.col("x1") + 1) & F.col("_cy").between(F.col("y0") - 1, F.col("y1") + 1)
    cells = _touched(boxes.select(*page, "box", "x0", "y0", "x1", "y1"), 1.0)
    found = cells.join(_placed(w, F.col("_cx"), F.col("_cy")), [*page, *_GRID]).where(inside).groupBy(*page, "box").agg(F.array_sort(F.collect_list(F.struct("_line", "_x", "t"))).alias("_w"))
    return boxes.join(found, [*page, "box"], "left").withColumn("t", F.coalesce(F.array_join(F.transform("_w", lambda x: x["t"]), " "), F.lit(""))).drop("_w")


def drop_container_boxes(boxes: DataFrame, page: list[str], tolerance: float = 0.6) -> DataFrame:
    """``boxes(page, box, x0, y0, x1, y1)`` but those that hold a box of clearly smaller area on the same page.

    A box that is held has its centre in a cell that the holder touches. Boxes without a place hold nothing and stay.
    """
    o = boxes.select(*page, *(F.col(c).alias(f"_{c}") for c in ("box", "x0", "y0", "x1", "y1")))
    area = lambda p: (F.col(f"{p}x1") - F.col(f"{p}x0")) * (F.col(f"{p}y1") - F.col(f"{p}y0"))
    holds = (
        (F.col("_box") != F.col("box")) & (F.col("_x0") >= F.col("x0") - tolerance) & (F.col("_y0") >= F.col("y0") - tolerance)
        & (F.col("_x1") <= F.col("x1") + tolerance) & (F.col("_y1") <= F.col("y1") + tolerance) & (area("_") < 0.98 * area(""))
    )
    inner = _placed(o, (F.col("_x0") + F.col("_x1")) / 2, (F.col("_y0") + F.col("_y1")) / 2)
    cells = _touched(boxes.select(*page, "box", "x0", "y0", "x1", "y1"), tolerance)
    outer = cells.join(inner, [*page, *_GRID]).where(holds).select(*page, "box").distinct()
    return boxes.join(outer, [*page, "box"], "left_anti")


def dedup_boxes(df: DataFrame, boxes: str) -> DataFrame:
    """``df`` without the boxes that are drawn twice, in the order of top, left and longer text."""
    order = F.array_sort(F.transform(boxes, lambda c, i: F.struct(c["y0"].alias("a"), c["x0"].alias("b"), (-F.length(c["t"])).alias("l"), i.alias("i"), c.alias("c"))))
    df = df.withColumn("_b", F.transform(order, lambda x: x["c"]))
    df = pinned(df, "_keep", keep_boxes(F.transform("_b", lambda c: F.array(c["x0"], c["x1"], c["y0"], c["y1"]))))
    return df.withColumn(boxes, F.filter("_b", lambda c, i: F.get("_keep", i))).drop("_b", "_keep")


def page_text(words: Column | str) -> Column:
    """The normalised text of a page's horizontal words, in reading order."""
    return norm_text(F.array_join(F.transform(horizontal(words), lambda w: w["t"]), " "))


def _told(items: Column, keep=None) -> Column:  # noqa: ANN001
    items = items if keep is None else F.filter(items, keep)
    return F.coalesce(F.array_join(F.transform(items, lambda w: w["t"]), " "), F.lit(""))


def extract_stamp(pages: DataFrame) -> DataFrame:
    """``pages(sello, casillas, palabras, metodo)`` with seal and fecha: the first hit of the stamp, the top of a scan, or a text page's words."""
    scan = F.col("metodo") == "ocr"
    high = lambda w: w["y1"] < STAMP_HEIGHT
    sources = F.array(_told(F.col("sello")), F.when(scan, _told(F.col("casillas"), high)).otherwise(_told(F.col("palabras"))), F.when(scan, _told(F.col("palabras"), high)).otherwise(""))
    first = lambda values: F.get(F.filter(values, lambda x: x != ""), F.lit(0))
    seal = first(F.transform(sources, lambda t: F.regexp_extract(t, SEAL, 1)))
    date = first(F.transform(sources, lambda t: F.regexp_replace(F.regexp_extract(t, STAMP_DATE, 0), r"^([0-9]{2})/([0-9]{2})/([0-9]{4}).*$", "$3-$2-$1")))
    return pages.withColumns({"seal": F.regexp_replace(seal, "^X[1l](?=[0-9]{6}$)", "XI"), "fecha": F.try_to_timestamp(date, F.lit("yyyy-MM-dd")).cast("date")})


def detect_cover(pages: DataFrame, key: list[str], words: str = "palabras") -> DataFrame:
    """``pages`` with is_cover: the text holds the form's title, or one of the first 40 lines is much like it."""
    from patrimonia.functions.similarity import length_bound, ratio

    out = pages.withColumn("_text", page_text(words))
    sure = F.col("_text").contains(COVER_TITLES[0]) | F.col("_text").contains(COVER_TITLES[1])
    out = out.withColumn("_sure", sure)
    lines = words_to_lines(out.where("not _sure").select(*key, words), words).select(*key, F.explode(F.slice("lineas", 1, COVER_LINES)).alias("l"))
    lines = lines.withColumn("_bare", compact_norm(F.array_join(F.transform("l", lambda w: w["t"]), " ")))
    titles = F.array(*(F.lit(_compact(t)) for t in TITLES))
    near = lines.select("_bare").distinct().withColumn("_title", F.explode(titles)).where(length_bound(F.col("_bare"), F.col("_title"), COVER_ALIKE)).where(ratio("_bare", "_title") > COVER_ALIKE)
    hit = lines.join(near.select("_bare").distinct(), "_bare", "left_semi").select(*key, F.lit(True).alias("_hit")).distinct()
    return out.join(hit, key, "left").withColumn("is_cover", F.col("_sure") | F.coalesce("_hit", F.lit(False))).drop("_text", "_sure", "_hit")


# ---- a declaration's pages, one below the other -----------------------------------------------------------------------
def disagreement(text: Column, other: Column) -> Column:
    """Whether two readings of a box differ both as texts and as amounts; null without a second one."""
    cleaned = clean_ocr_edges(other)
    same = (norm_text(text) == norm_text(cleaned)) | F.coalesce(parse_amount(text) == parse_amount(cleaned), F.lit(False))
    return F.when(other.isNotNull(), ~same)


def _page_boxes(words: Column, offset: Column) -> Column:
    scan = F.col("metodo") == "ocr"

    def box(c: Column) -> Column:
        within = lambda w: ((w["x0"] + w["x1"]) / 2).between(c["x0"] - 1, c["x1"] + 1) & _centre(w).between(c["y0"] - 1, c["y1"] + 1)
        inner = F.transform(F.array_sort(F.transform(F.filter(words, within), lambda w: F.struct(w["x0"].alias("x"), w["t"].alias("t")))), lambda w: w["t"])
        own = F.when(scan, clean_ocr_edges(c["t"])).when(c["t"].endswith("+"), F.trim(F.regexp_replace(c["t"], r"\++$", ""))).otherwise(c["t"])
        return F.struct(
            c["x0"].alias("x0"), (c["y0"] + offset).alias("y0"), c["x1"].alias("x1"), (c["y1"] + offset).alias("y1"), F.coalesce(own, F.lit("")).alias("t"),
            F.when(scan, c["alt"]).alias("alt"), F.when(scan, F.array_join(inner, " ")).alias("inner"),
        )

    inside = F.filter("casillas", lambda c: (c["y1"] >= STAMP_BOTTOM) & (c["y0"] <= F.col("alto") - FOOT_HEIGHT))
    return F.coalesce(F.transform(inside, box), F.filter(F.transform(inside, box), lambda _: F.lit(False)))


@dataclass
class Flow:
    """The pages of declarations below each other: a row for each declaration, each line and each box.

    heads(decl_id, n_pages, scan); lines(decl_id, y0, page, side, at, y1, x0, t, n, words) with side 1 for a wide box that
    stands as a line; boxes(decl_id, page, at, x0, y0, x1, y1, t, alts, dudoso, ocr, num, amount, share, province, label,
    header, word).
    """

    heads: DataFrame
    lines: DataFrame
    boxes: DataFrame


def flow_pages(pages: DataFrame) -> Flow:
    """All pages of a declaration below each other, of ``pages(decl_id, num, alto, metodo, palabras, casillas)``.

    Boxes of the stamp and the foot are left out, and all but the first drawing of a box; wide boxes with a longer text
    are lines too. Pages without words or boxes (null) give none; a null method is that of a text page. Other columns
    play no part.
    """
    own = pages.select("decl_id", "num", "alto", "metodo", "palabras", "casillas")
    own = own.withColumn("page", F.row_number().over(Window.partitionBy("decl_id").orderBy("num")) - 1).withColumn("_dy", F.col("page") * PAGE_STEP)
    own = words_to_lines(own).withColumn("boxes", _page_boxes(horizontal("palabras"), F.col("_dy")))
    own = own.withColumn("boxes", F.array_sort(F.transform("boxes", lambda c, i: F.struct(c["y0"].alias("a"), c["x0"].alias("b"), (-F.length(c["t"])).alias("l"), i.alias("i"), c.alias("c")))))
    own = pinned(own, "kept", keep_boxes(F.transform("boxes.c", lambda c: F.array(c["x0"], c["x1"], c["y0"], c["y1"]))))
    own = save(own.select("decl_id", "page", "num", "_dy", (F.col("metodo") == "ocr").alias("ocr"), "lineas", F.col("boxes.c").alias("boxes"), "kept"), "flow")

    heads = own.groupBy("decl_id").agg(F.count("*").alias("n_pages"), F.coalesce(F.min_by("ocr", "page"), F.lit(False)).alias("scan"))
    line = own.select("decl_id", "page", "_dy", F.posexplode("lineas").alias("at", "l"))
    text = F.array_join("l.t", " ")
    words = F.transform("l", lambda w: F.struct(w["t"].alias("t"), w["x0"].alias("x0")))
    line = line.select(
        "decl_id", (F.array_min("l.y0") + F.col("_dy")).alias("y0"), "page", F.lit(0).alias("side"), "at", (F.array_max("l.y1") + F.col("_dy")).alias("y1"), F.get("l.x0", F.lit(0)).alias("x0"),
        text.alias("t"), norm_text(text).alias("n"), words.alias("words"),
    )
    box = own.select("decl_id", "page", "num", "ocr", "kept", F.posexplode("boxes").alias("at", "c")).select("decl_id", "page", "num", "ocr", "at", F.get("kept", F.col("at")).alias("kept"), "c.*", norm_text("c.t").alias("n"))
    sign = box.where((F.length("n") >= 9) & (F.col("x1") - F.col("x0") > 200)).select("decl_id", "y0", "page", F.lit(1).alias("side"), "at", "y1", "x0", "t", "n", F.array().cast(dict(line.dtypes)["words"]).alias("words"))
    return Flow(heads, line.unionByName(sign), _typed(box.where("kept")))


def _typed(boxes: DataFrame) -> DataFrame:
    """Boxes with other readings and doubt, and with their text as amount, share, province and kind."""
    out = boxes.withColumns({"alt": clean_ocr_edges("alt"), "inner": F.when((F.col("inner") != "") & (F.col("t") != ""), clean_ocr_edges("inner"))})
    out = out.withColumns({"amount": parse_amount("t"), "_other": parse_amount("alt"), "_alt": norm_text("alt"), "_sure": province_by_word("t")})
    same = (F.col("n") == F.col("_alt")) | F.coalesce(F.col("amount") == F.col("_other"), F.lit(False))
    others = F.filter(F.array("alt", "inner"), lambda a: a.isNotNull() & (a != "") & (a != F.col("t")))
    out = out.withColumns({"alts": F.when(F.coalesce("ocr", F.lit(False)), others).otherwise(F.array().cast("array<string>")), "dudoso": F.coalesce(F.col("alt").isNotNull() & ~same, F.lit(False)), "ocr": F.coalesce("ocr", F.lit(False))})
    out = out.withColumns({"share": parse_share("t"), "word": has_word("t"), "_k": text_kinds(F.col("n"), F.when(F.col("_sure").isNull(), F.col("n")))})
    out = out.withColumns({"province": F.coalesce("_sure", "_k.near"), "label": F.col("_k.label"), "header": F.col("_k.header")})
    return out.select("decl_id", "page", "at", "x0", "y0", "x1", "y1", "t", "n", "alts", "dudoso", "ocr", "num", "amount", "share", "province", "label", "header", "word")


# ---- sections ---------------------------------------------------------------------------------------------------------
#: What a line may mark, by patterns on its normalised text.
MARKS = {
    "activities": ACTIVITIES, "properties": PROPERTIES, "others": OTHER_ASSETS, "debts": DEBTS, "end": END, "total": PROPERTY_TOTAL, "property_head": (PROPERTY_HEADER,),
    "item_head": (ITEM_HEADER,), "title": PERSON_TITLE, "data": PERSON_DATA, "voting": ("ELECTORAL",),
}


def _fits(patterns: tuple[str, ...]) -> Column:
    return F.col("n").rlike("|".join(f"(?:{p})" for p in patterns))


def _named(words: list[str]) -> Column:
    """The place of the first of a line's words that is one of ``words``, from 1; 0 without one."""
    return F.coalesce(F.array_position("k", F.lit(words[0])) if len(words) == 1 else F.greatest(*(F.array_position("k", F.lit(w)) for w in words)), F.lit(0)).cast("int")


def _part(begin: Column, end: Column | None = None) -> Column:
    """The words after place ``begin`` and before place ``end``."""
    length = F.lit(1 << 20) if end is None else F.greatest(end - begin - 1, F.lit(0))
    return F.nullif(F.trim(F.array_join(F.slice("words.t", begin + 1, length), " ")), F.lit(""))


def find_marks(lines: DataFrame) -> DataFrame:
    """The lines that mark something: ``lines`` with a flag for each of ``MARKS``, and what they say of a person beside its label."""
    out = lines.withColumn("k", F.transform("words.t", norm_text)).withColumns({m: _fits(p) for m, p in MARKS.items()})
    pairs = [(_named([a]), _named([b])) for a, b in NAME_LABELS]
    both = [(i > 0) & (j > 0) for i, j in pairs]
    start = F.array_join(F.slice("k", 1, 2), " ")
    district = start.isin("CIRCUMSCRIPCIO ELECTORAL", "CIRCUNSCRIPCION ELECTORAL") & (F.size("words") > 2)
    election = _named(["ELECCIONS", "ELECCIONES"])
    out = out.withColumns({
        "p_name": F.coalesce(*(F.when(ok, _part(i, j)) for ok, (i, j) in zip(both, pairs, strict=True))), "p_surname": F.coalesce(*(F.when(ok, _part(j)) for ok, (_, j) in zip(both, pairs, strict=True))),
        "p_district": F.when(district, _part(F.lit(2))), "p_party": F.when((election > 0) & F.get("k", F.lit(0)).isin("PARTIT", "PARTIDO"), _part(election)),
    })
    said = ["p_name", "p_surname", "p_district", "p_party"]
    some = F.lit(False)
    for c in (*MARKS, *(F.col(c).isNotNull() for c in said)):
        some = some | (F.col(c) if isinstance(c, str) else c)
    return out.where(some).select("decl_id", "y0", "page", "side", "at", "y1", "x0", "t", F.col("n").contains("CONJUNT").alias("joint"), *MARKS, *said)


def find_anchor(mark: str, after: Column | None = None, before: Column | None = None) -> Column:
    """The first of a declaration's ``marks`` of a kind below ``after`` and above ``before``; null without one."""

    def fits(l: Column) -> Column:  # noqa: E741
        ok = l[mark]
        ok = ok if after is None else ok & (l["y0"] > F.coalesce(after, F.lit(-1.0)))
        return ok if before is None else ok & (l["y0"] < before)

    return F.get(F.filter("marks", fits), F.lit(0))


def header_bottom(mark: str, top: Column, bottom: Column) -> Column:
    """Where a table's header ends: the lowest of its lines near ``top``, or ``top`` itself."""
    own = F.filter("marks", lambda l: l[mark] & (l["y0"] >= top) & (l["y0"] < bottom) & ~l["joint"] & (l["y1"] - top < 60))
    return F.coalesce(F.array_max(F.transform(own, lambda l: l["y1"])), top)


def find_sections(flow: Flow) -> DataFrame:
    """A row for each declaration: its marks, and the heights of the form's sections; null where one wasn't found.

    Written once, without the planner's search for filters that follow from the heights' definitions: each builds on those
    before, so that the search would double with every one, and finds nothing.
    """
    marks = find_marks(flow.lines)
    each = marks.groupBy("decl_id").agg(F.array_sort(F.collect_list(F.struct(*(c for c in marks.columns if c != "decl_id")))).alias("marks"))
    out = flow.heads.join(each, "decl_id", "left")
    foot = (F.col("n_pages") + 1) * F.lit(float(PAGE_STEP))
    out = out.withColumns({"y_act": find_anchor("activities")["y0"], "y_inm": find_anchor("properties")["y0"]})
    out = out.withColumn("y_noinm", find_anchor("others", F.col("y_inm"))["y0"])
    out = out.withColumn("y_pas", find_anchor("debts", F.coalesce("y_noinm", "y_inm"))["y0"])
    out = out.withColumn("y_fin", F.coalesce(find_anchor("end", F.coalesce("y_pas", "y_noinm", "y_inm"))["y0"], foot))
    out = out.withColumns({"end_inm": F.coalesce("y_noinm", "y_pas", "y_fin"), "end_noinm": F.coalesce("y_pas", "y_fin"), "end_person": F.coalesce("y_act", "y_inm", foot), "data": find_anchor("data"), "title": find_anchor("title")})
    out = out.withColumns({
        "total": find_anchor("total", F.col("y_inm"), F.col("end_inm")), "cab_inm": header_bottom("property_head", F.col("y_inm"), F.col("end_inm")),
        "cab_noinm": header_bottom("item_head", F.col("y_noinm"), F.col("end_noinm")), "cab_pas": header_bottom("item_head", F.col("y_pas"), F.col("y_fin")),
        "data_below": find_anchor("data", F.col("title.y0")),
    })
    with settings(out.sparkSession, {"spark.sql.constraintPropagation.enabled": "false"}):
        return save(out, "sections")


# ---- rows of the form's tables ----------------------------------------------------------------------------------------
CELL = ("x0", "y0", "x1", "y1", "t", "n", "alts", "dudoso", "ocr", "num", "amount", "share", "province", "label", "header", "word")


def _between(centre: Column, top: Column, bottom: Column) -> Column:
    return F.coalesce((centre >= top) & (centre < bottom), F.lit(False))


def table_rows(boxes: DataFrame, sections: DataFrame) -> DataFrame:
    """(decl_id, area, row, cells, margin) of the boxes that lie in a table, with total_beside on rows of the area ``under``.

    Areas: inmuebles, otros_bienes, pasivo, persona, and under: below the rows of properties, where their total may stand
    if none stands beside its label; total: the boxes beside that label. Boxes are dealt by declaration once; what follows keeps that.
    """
    near = sections.select("decl_id", "y_inm", "y_noinm", "y_pas", "y_fin", "end_inm", "end_noinm", "end_person", "total", "cab_inm", "cab_noinm", "cab_pas", "title", "data_below")
    own = boxes.join(near, "decl_id").withColumns({"cy": (F.col("y0") + F.col("y1")) / 2, "wide": F.col("x1") - F.col("x0") > 120})
    whole = Window.partitionBy("decl_id")
    beside = F.col("wide") & F.col("amount").isNotNull() & (F.col("cy") >= F.col("total.y0") - 8) & (F.col("cy") <= F.col("total.y1") + 10) & (F.col("x0") > F.col("total.x0") + 40)
    narrow = (F.col("x1") - F.col("x0") < 120) & (F.col("y0") >= F.col("cab_inm")) & (F.col("y0") < F.col("end_inm"))
    margin = lambda top, bottom: F.min(F.when(_between(F.col("cy"), F.col(top) - 12, F.col(bottom)), F.col("x0"))).over(whole)
    own = own.withColumns({
        "total_beside": F.min(F.when(beside, F.struct("page", "at", "amount"))).over(whole)["amount"], "low": F.coalesce(F.max(F.when(narrow, F.col("y1"))).over(whole), F.col("cab_inm")),
        "margin_noinm": margin("y_noinm", "end_noinm"), "margin_pas": margin("y_pas", "y_fin"),
    })
    top = F.coalesce("data_below.y1", "title.y1", F.lit(0.0))
    areas = {
        "inmuebles": (F.col("cab_inm") - 2, F.coalesce(F.col("total.y0") - 3, F.col("end_inm")), None), "under": (F.col("low") - 2, F.col("end_inm"), None),
        "otros_bienes": (F.col("cab_noinm") - 2, F.col("end_noinm"), "margin_noinm"), "pasivo": (F.col("cab_pas") - 2, F.col("y_fin"), "margin_pas"),
        "persona": (top, F.when(F.col("data_below").isNotNull(), F.least(F.col("end_person"), top + 80)).otherwise(F.col("end_person")), None),
    }
    inside = F.array(*(F.when(_between(F.col("cy"), a, b), F.struct(F.lit(name).alias("area"), (F.col(m) if m else F.lit(None).cast("double")).alias("margin"))) for name, (a, b, m) in areas.items()), F.when(F.coalesce(beside, F.lit(False)), F.struct(F.lit("total").alias("area"), F.lit(None).cast("double").alias("margin"))))
    own = own.withColumn("_in", F.explode(F.filter(inside, lambda x: x.isNotNull())))
    each = own.groupBy("decl_id", "_in.area", "_in.margin", "total_beside").agg(F.array_sort(F.collect_list(F.struct("cy", F.col("x0").alias("x"), "page", "at", F.struct(*CELL).alias("cell")))).alias("found"))
    each = pinned(each, "_ids", cluster_rows(F.col("found.cy"), F.col("found.x"), F.lit(ROW_TOLERANCE)))
    rows = each.select("decl_id", "area", "margin", "total_beside", "found", F.posexplode("_ids").alias("row", "ids"))
    return rows.select("decl_id", "area", "margin", "total_beside", "row", F.transform("ids", lambda i: F.get("found.cell", i)).alias("cells"))


def _cell(i: int) -> Column:
    return F.get("cells", F.lit(i))


def _some_text() -> Column:
    return F.exists("cells", lambda c: c["t"] != "")


def property_rows(rows: DataFrame) -> DataFrame:
    """``table_rows`` of properties with ``item`` (null for a row that is none) and ``odd``: another number of cells than five.

    Rows with two labels or under four cells are no rows of the table. A row of five cells is an item if one of its values
    is known, or two in a scan.
    """
    own = rows.where((F.col("area") == "inmuebles") & (F.size("cells") >= 4) & _some_text() & (F.size(F.filter("cells", lambda c: (c["t"] != "") & c["label"])) < 2))
    own = own.withColumns({"odd": F.size("cells") != 5, **dict(zip(("right", "kind", "part", "place", "value"), map(_cell, range(5)), strict=True))})
    own = own.withColumn("code", code_pair(F.col("right.t"), F.col("kind.t"), F.col("right.alts"), F.col("kind.alts"), F.col("right.ocr")))
    known = sum((F.col(c).isNotNull().cast("int") for c in ("code.clave", "code.tipo", "part.share", "place.province", "value.amount")), F.lit(0))
    doubt = F.exists(F.array("part", "place", "value"), lambda c: (c["t"] != "") & c["dudoso"])
    item = F.struct(
        F.col("code.clave").alias("clave"), F.col("right.t").alias("clave_txt"), F.col("code.tipo").alias("tipo"), F.col("kind.t").alias("tipo_txt"), F.col("part.share").alias("porcentaje"),
        F.col("part.t").alias("porcentaje_txt"), F.col("place.province").alias("provincia"), F.col("place.t").alias("provincia_txt"), F.col("value.amount").alias("valor"), F.col("value.t").alias("valor_txt"),
        F.col("right.num").alias("pagina"), doubt.alias("dudoso"), F.col("value.alts").alias("alts"), F.col("right.ocr").alias("ocr"),
    )
    return own.withColumn("item", F.when(~F.col("odd") & (known >= F.when(F.col("right.ocr"), 2).otherwise(1)), item)).select("decl_id", "row", "odd", "item")


def property_total(rows: DataFrame) -> DataFrame:
    """(decl_id, row, amount): single wide boxes below the rows of properties that hold an amount and no word; the first may be the total."""
    c = _cell(0)
    alone = (F.col("area") == "under") & (F.size("cells") == 1) & (c["x1"] - c["x0"] > 120) & (c["y1"] - c["y0"] < 30) & c["amount"].isNotNull() & ~c["word"]
    return rows.where(alone).select("decl_id", "row", c["amount"].alias("amount"))


def asset_liability_rows(rows: DataFrame) -> DataFrame:
    """(decl_id, area, row, item, total): items of the tables of assets and debts, and the row that holds their total.

    A row that is shifted to the right of the table's margin and holds an amount is the total, and ends the table.
    Rows of labels, boxes of running text and rows of a scan's noise are no items.
    """
    own = rows.where(F.col("area").isin("otros_bienes", "pasivo") & _some_text()).withColumns({"d": _cell(0), "v": _cell(1)})
    own = own.withColumn("shifted", F.coalesce(F.col("d.x0") > F.col("margin") + 30, F.lit(False)))
    sums = F.filter("cells", lambda c: c["amount"].isNotNull() & ~c["word"])
    own = own.withColumn("total", F.when(F.col("shifted"), F.get(sums, F.lit(0))["amount"]))
    stop = F.min(F.when(F.col("total").isNotNull(), F.col("row"))).over(Window.partitionBy("decl_id", "area"))
    own = own.withColumn("stop", stop).where("stop IS NULL OR row <= stop")
    none, text = F.col("v.amount").isNull(), F.col("d.t")
    label = F.col("d.label") | ((text == "") & F.col("v.label"))
    prose = F.col("d.x1") - F.col("d.x0") > 0.85 * (F.col("v.x1") - F.col("d.x0"))
    noise = ~F.col("d.word") & (none | F.col("v.dudoso"))
    scrap = none & F.col("d.ocr") & ~text.rlike("[A-Za-zÀ-ÿ]{4,}")
    head = none & (F.size(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != "")) <= 1) & (F.col("v.word") | F.col("d.header"))
    kept = ~F.col("shifted") & (F.size("cells") == 2) & ~(label | prose | noise | scrap | head)
    own = own.withColumn("description", F.when(F.col("d.word") | text.rlike("[0-9]"), text).otherwise(""))
    own = own.withColumn("category", F.when(F.col("area") == "otros_bienes", classify_asset("description")).otherwise(classify_liability("description")))
    item = F.struct(
        F.col("description").alias("descripcion"), F.col("category").alias("categoria"), F.col("v.amount").alias("valor"), F.col("v.t").alias("valor_txt"), F.col("d.num").alias("pagina"),
        F.col("v.dudoso").alias("dudoso"), F.col("v.alts").alias("alts"),
    )
    return own.select("decl_id", "area", "row", F.when(kept, item).alias("item"), "total")


# ---- the person -------------------------------------------------------------------------------------------------------
def _first(field: str) -> Column:
    """The first that the lines of a text form above the person's end say of a field."""
    said = F.filter("marks", lambda l: ~F.col("scan") & (l["y0"] <= F.col("end_person")) & l[field].isNotNull())
    return F.get(said, F.lit(0))[field]


def person_fields(flow: Flow, sections: DataFrame, rows: DataFrame) -> DataFrame:
    """(decl_id, persona): name, surname, district and party of the cover.

    Text forms have them beside their labels; other forms in boxes below the title, by place; scans also in runs
    of capitals near the heading. The first that is found counts; what isn't found is null.
    """
    own = rows.where("area = 'persona'").withColumn("cells", F.filter("cells", lambda c: (c["t"] != "") & ~c["label"] & ~c["n"].rlike(PERSON_NOISE))).where(F.size("cells") > 0)
    side = lambda left: F.get(F.filter("cells", lambda c: (c["x0"] < 250) if left else (c["x0"] >= 250)), F.lit(0))["t"]
    placed = own.groupBy("decl_id").agg(F.array_sort(F.collect_list(F.struct("row", side(True).alias("left"), side(False).alias("right"), _cell(0)["t"].alias("t")))).alias("placed"))
    at = lambda i, c: F.get("placed", F.lit(i))[c]
    out = sections.select("decl_id", "scan", "data", "end_person", "marks").join(placed, "decl_id", "left")
    out = out.select("decl_id", "scan", "data", F.get(F.filter("marks", lambda l: l["voting"]), F.lit(0))["t"].alias("voting"), "placed", *(_first(f"p_{f}").alias(f) for f in ("name", "surname", "district", "party")))
    open_ = F.col("name").isNull() | F.col("surname").isNull()
    by_place = {"name": at(0, "left"), "surname": at(0, "right"), "district": at(1, "t"), "party": at(2, "t")}
    out = out.withColumns({f: F.coalesce(F.col(f), F.when(open_, c)) for f, c in by_place.items()}).drop("placed")

    wanted = out.where("scan AND (name IS NULL OR surname IS NULL) AND data IS NOT NULL").select("decl_id", "name", "surname", F.col("data.y1").alias("_y"))
    line = flow.lines.where("side = 0").join(wanted, "decl_id").where(F.col("y0").between(F.col("_y") - 2, F.col("_y") + 22) & (F.col("y0") != F.col("_y") - 2) & (F.col("y0") != F.col("_y") + 22) & ~F.col("n").contains("PERSONAL"))
    line = line.withColumn("runs", capital_runs("t")).where(F.size("runs") > 0)
    line = line.withColumn("apart", differ(compact_norm(F.get("runs", F.lit(0))), compact_norm("surname")))
    line = line.where((F.size("runs") >= 2) | (F.col("surname").isNotNull() & F.col("name").isNull() & F.col("apart")))
    runs = line.groupBy("decl_id").agg(F.min_by("runs", F.struct("y0", "page", "at")).alias("runs"))
    out = out.join(runs, "decl_id", "left").withColumns({
        "name": F.coalesce("name", F.get("runs", F.lit(0))), "surname": F.coalesce("surname", F.when(F.size("runs") >= 2, F.array_join(F.slice("runs", 2, 1 << 20), " "))),
    })

    out = out.withColumn("said", F.coalesce("district", F.when(F.col("scan"), F.col("voting"))))
    out = out.withColumn("sure", province_by_word("said")).withColumn("n", norm_text("said"))
    out = out.withColumn("k", text_kinds(F.col("n"), F.when(F.col("sure").isNull(), F.col("n")))).withColumn("province", F.coalesce("sure", "k.near"))
    district = F.when(F.col("province").isin(*DISTRICTS), F.col("province")).otherwise(F.coalesce("district", F.when(F.col("scan"), F.col("province"))))
    return out.select("decl_id", F.struct(F.col("name").alias("nombre"), F.col("surname").alias("apellidos"), district.alias("circunscripcion"), F.col("party").alias("partido")).alias("persona"))


def read_forms(pages: DataFrame) -> DataFrame:
    """(decl_id, persona, inmuebles, otros_bienes, pasivo, totals, avisos) of ``pages(decl_id, num, alto, metodo, palabras, casillas)``.

    A declaration without its section of properties has no items and no totals, and a warning; one whose other sections
    are missing has a warning for each. Every declaration of ``pages`` has a row.
    """
    flow = flow_pages(pages)
    sections = find_sections(flow)
    rows = save(table_rows(flow.boxes, sections), "rows")
    homes, others, below = property_rows(rows), asset_liability_rows(rows), property_total(rows)
    nested = lambda item, when: F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("row", item)))), lambda x: x["item"])
    homes = homes.groupBy("decl_id").agg(nested("item", F.col("item").isNotNull()).alias("inmuebles"), F.count_if("odd").alias("odd"))
    table = lambda name: F.col("area") == name
    others = others.groupBy("decl_id").agg(
        *(nested("item", table(t) & F.col("item").isNotNull()).alias(t) for t in ("otros_bienes", "pasivo")), *(F.max(F.when(table(t), F.col("total"))).alias(f"total_{t}") for t in ("otros_bienes", "pasivo"))
    )
    beside = rows.groupBy("decl_id").agg(F.max("total_beside").alias("beside"))
    below = below.groupBy("decl_id").agg(F.min_by("amount", "row").alias("below"))
    out = sections.select("decl_id", "y_inm", "y_noinm", "y_pas")
    for part in (person_fields(flow, sections, rows), homes, others, beside, below):
        out = out.join(part, "decl_id", "left")
    lost = F.col("y_inm").isNull()
    kind = dict(out.dtypes)
    items = {t: F.when(lost | F.col(t).isNull(), F.array().cast(kind[t])).otherwise(F.col(t)) for t in ("inmuebles", "otros_bienes", "pasivo")}
    totals = {"total_catastral": F.coalesce("beside", "below"), "total_otros_bienes": F.col("total_otros_bienes"), "total_pasivo": F.col("total_pasivo")}
    missing = F.array_compact(F.array(F.when(F.col("y_noinm").isNull(), NO_ASSETS), F.when(F.col("y_pas").isNull(), NO_DEBTS)))
    warned = F.concat(F.array_repeat(F.lit(ODD_ROW), F.coalesce(F.col("odd"), F.lit(0)).cast("int")), missing)
    return out.select(
        "decl_id", "persona", *(c.alias(t) for t, c in items.items()), *(F.when(~lost, c).alias(t) for t, c in totals.items()),
        F.when(lost, F.array(F.lit(NO_PROPERTIES))).otherwise(warned).alias("avisos"),
    )
