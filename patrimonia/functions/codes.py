"""Codes, categories, kinds and labels, as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from patrimonia.functions.text import _col, let, norm_text

# The form's codes, the words that stand for them, and letters that scans confuse.
RIGHT_WORDS = (
    ("P", ("PLENO", "PLE", "PLENA", "PROPIEDAD", "PROPIETAT", "DOMINIO", "DOMINI")),
    ("N", ("NUDA", "NUA")),
    ("M", ("MULTIPROPIEDAD", "MULTIPROPIETAT")),
    ("U", ("USUFRUCTO", "USDEFRUIT", "USUFRUIT")),
)
TYPE_WORDS = (
    ("V", ("VIVIENDA", "VIVENDA", "HABITATGE", "PISO", "PIS", "CASA", "APARTAMENTO", "CHALET", "ADOSADO")),
    ("L", ("LOCAL", "LOCALES", "LOCALS", "OFICINA", "NAVE")),
    ("R", ("RUSTICO", "RUSTICA", "RUSTIC", "RUSTICS", "RUSTICOS", "FINCA", "TERRENO", "PARCELA", "HUERTO")),
    ("O", ("OTROS", "ALTRES", "GARAJE", "GARATGE", "PLAZA", "TRASTERO", "SOLAR", "URBANO", "URBANA")),
)
TYPE_CONFUSION = {"Y": "V", "0": "O", "Q": "O", "D": "O", "U": "V", "K": "R"}
RIGHT_CONFUSION = {"F": "P", "D": "P"}

# Patterns on normalised descriptions, in the order in which they apply.
ASSET_PATTERNS = (
    ("pensiones", r"PENSION|JUBILACI|EPSV"),
    (
        "cuentas",
        r"CUENTA|COMPTE|\bCC\b|\bCTA\b|PLAZO|IMPOSICI|SALDO|CORRIENTE|CORRENT|AHORRO|ESTALVI|DEPOSITO|DEPOSIT|DIPOSIT|LIBRETA|BANC|CAIXA|CAJA"
        r"|EFECTIVO|EFECTIU|IPF|IBERCAJA|OPENBANK|\bING\b|BBVA|SANTANDER|SABADELL|CAJAMAR|UNICAJA|KUTXA|ABANCA|BANKINTER",
    ),
    (
        "inversiones",
        r"ACCION|ACCIO|FONDO|FONS|PARTICIPACI|VALORES|VALORS|BOLSA|BORSA|INVERSI|LETRAS|LLETRES|DEUDA PUBLICA|BONOS|SOCIEDAD|SOCIETAT"
        r"|\bS L\b|\bSL\b|\bSA\b|CAPITAL SOCIAL|CRIPTO|BITCOIN|\bCB\b|COMUNIDAD DE BIENES",
    ),
    ("seguros", r"SEGURO|ASSEGURAN"),
    (
        "vehiculos",
        r"VEHICUL|VEHICLE|COCHE|COTXE|TURISMO|TURISME|MOTO|FURGON|AUTOMOVIL|AUTOMOBIL|REMOLQUE|CARAVANA|BARCO|EMBARCACI"
        r"|SEAT|RENAULT|PEUGEOT|CITROEN|FORD|OPEL|VOLKSWAGEN|\bVW\b|AUDI|BMW|MERCEDES|TOYOTA|NISSAN|HYUNDAI|\bKIA\b"
        r"|SKODA|VOLVO|FIAT|DACIA|MAZDA|HONDA|\bMINI\b|TESLA|LEXUS|JEEP|SUZUKI|YAMAHA|VESPA|PIAGGIO|MITSUBISHI|SMART"
        r"|CUPRA|LAND ROVER|PORSCHE|JAGUAR|ALFA ROMEO|SSANGYONG|SSNAGYONG|\bMG\b|SUBARU|CHEVROLET|KAWASAKI|DUCATI",
    ),
)
LIABILITY_PATTERNS = (
    ("hipoteca", r"HIPOTEC"),
    ("prestamo", r"PRES\w?TAMO|PRESTEC|PTMO|CREDITO|CREDIT|CRECITO|LEASING|RENTING|FINANC|POLIZA"),
    ("tarjeta", r"TARJETA|TARGETA"),
    ("cuenta", r"CUENTA|COMPTE"),
)
TYPE_LABELS = {"V": "Vivienda", "L": "Local", "O": "Otro urbano", "R": "Rústico"}
RIGHT_LABELS = {"P": "Pleno dominio", "N": "Nuda propiedad", "M": "Multipropiedad", "U": "Usufructo"}
KIND_LABELS = {"inicial": "Declaración inicial", "modificacion": "Modificación", "final": "Declaración final"}


def _first_match(norm: Column, patterns: Sequence[tuple[str, str]], other: str) -> Column:
    out = F
    for name, pattern in patterns:
        out = out.when(norm.rlike(pattern), name)
    return out.otherwise(other)


def classify_asset(description: Column | str) -> Column:
    """The class of an asset by its description; the first pattern that fits wins."""
    return let(norm_text(description), lambda n: _first_match(n, ASSET_PATTERNS, "otros"))


def classify_liability(description: Column | str) -> Column:
    """The class of a debt by its description; the first pattern that fits wins."""
    return let(norm_text(description), lambda n: _first_match(n, LIABILITY_PATTERNS, "otros"))


def _lookup(table: Mapping[str, str], key: Column) -> Column:
    out = F
    for k, v in table.items():
        out = out.when(key == k, v)
    return out.otherwise(F.lit(None).cast("string")) if table else F.lit(None).cast("string")


def _code(text: Column, ocr: Column, words: Sequence[tuple[str, Sequence[str]]], confusion: Mapping[str, str]) -> Column:
    return let(norm_text(text), lambda norm: _code_of_norm(norm, ocr, words, confusion))


def _code_of_norm(norm: Column, ocr: Column, words: Sequence[tuple[str, Sequence[str]]], confusion: Mapping[str, str]) -> Column:
    valid = [code for code, _ in words]
    letters = F.replace(norm, F.lit(" "), F.lit(""))
    first = F.substring(letters, 1, 1)
    short = F.when(first.isin(*valid), first).when(ocr & _lookup(confusion, first).isNotNull(), _lookup(confusion, first))
    if "O" in valid:
        short = short.when(first == "0", "O")
    out = F.when(norm == "", F.lit(None).cast("string"))
    for code, names in words:
        out = out.when(norm.rlike(r"\b(" + "|".join(names) + r")\b"), code)
    return out.when(F.length(letters) <= 2, short)


def _code_of(text: Column | str, alternatives: Column | None, ocr: Column | None, words: Sequence[tuple[str, Sequence[str]]], confusion: Mapping[str, str]) -> Column:
    ocr = F.lit(False) if ocr is None else F.coalesce(ocr, F.lit(False))
    own = _code(_col(text), ocr, words, confusion)
    if alternatives is None:
        return own
    others = F.filter(F.transform(alternatives, lambda t: _code(t, ocr, words, confusion)), lambda x: x.isNotNull())
    return F.coalesce(own, F.get(others, F.lit(0)))


def code_right(text: Column | str, alternatives: Column | None = None, ocr: Column | None = None, confusion: Mapping[str, str] = RIGHT_CONFUSION) -> Column:
    """P, N, M or U for a property right: by word, else by the letter of a cell of one or two; other readings come next."""
    return _code_of(text, alternatives, ocr, RIGHT_WORDS, confusion)


def code_type(text: Column | str, alternatives: Column | None = None, ocr: Column | None = None, confusion: Mapping[str, str] = TYPE_CONFUSION) -> Column:
    """V, L, R or O for a property type, as ``code_right``."""
    return _code_of(text, alternatives, ocr, TYPE_WORDS, confusion)


def code_pair(right: Column, kind: Column, right_alts: Column | None = None, kind_alts: Column | None = None, ocr: Column | None = None) -> Column:
    """struct(clave, tipo): the codes of both cells, or of the swapped cells where only that makes both valid."""
    own = F.struct(code_right(right, right_alts, ocr).alias("clave"), code_type(kind, kind_alts, ocr).alias("tipo"))
    swapped = F.struct(code_right(kind, kind_alts, ocr, {}).alias("clave"), code_type(right, right_alts, ocr, {}).alias("tipo"))
    valid = lambda x: x["clave"].isNotNull() & x["tipo"].isNotNull()
    return let(own, lambda x: F.when(~valid(x), let(swapped, lambda y: F.when(valid(y), y).otherwise(x))).otherwise(x))


def parse_pub_date(c: Column | str) -> Column:
    """A date written yyyymmdd; null for anything else."""
    text = _col(c).cast("string")
    return F.when(text.rlike("^[0-9]{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"))


def classify_insertion(title: Column | str) -> Column:
    """The kind of declarations that a title announces."""
    low = F.lower(_col(title))
    final = low.contains("declaraciones finales") | low.contains("declaración final")
    return F.when(low.startswith("modificaci"), "modificacion").when(final, "final").otherwise("inicial")


def source_links(url: Column | str, pages: Column | str) -> Column:
    """struct(url, primera, ultima): a link to the declaration's first page, and its page range."""
    first = F.element_at(_col(pages), 1)
    return F.struct(F.concat(_col(url), F.lit("#page="), first.cast("string")).alias("url"), first.alias("primera"), F.element_at(_col(pages), -1).alias("ultima"))


def decode_label(code: Column | str, labels: Mapping[str, str], raw: Column | str | None = None) -> Column:
    """The label of a code, else the raw text, else a dash."""
    text = F.lit(None).cast("string") if raw is None else F.nullif(_col(raw), F.lit(""))
    return F.coalesce(_lookup(labels, _col(code)), text, F.lit("—"))


def reading_status(has_declaration: Column, illegible: Column, method: Column, verified: Column) -> Column:
    """How a person's declaration was read: ``sin leer``, ``a mano``, ``OCR ✓``, ``OCR`` or empty."""
    return (
        F.when(~F.coalesce(has_declaration, F.lit(False)) | F.coalesce(illegible, F.lit(False)), "sin leer")
        .when(method == "manual", "a mano")
        .when((method == "ocr") & verified, "OCR ✓")
        .when(method == "ocr", "OCR")
        .otherwise("")
    )
