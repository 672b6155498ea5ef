"""Functions on texts that the tables' columns make up, and SQL that states their rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patrimonia.functions import amounts as A
from patrimonia.functions import codes as C
from patrimonia.functions import similarity as S
from patrimonia.functions import text as T
from patrimonia.jobs.driver import DESCRIPTIONS, invented, pick, read, sql_invented, sql_list, sql_pick
from patrimonia.jobs.text_queries import sql_norm

Query = Callable[[SparkSession, str], DataFrame]


def _documents(text: Callable[[], Column], function: Callable[[Column], Column]) -> Query:
    """``function`` of a text that each document makes up."""
    return lambda spark, sf_dir: read(spark, sf_dir, "documents").select("doc_id", text().alias("t")).select("doc_id", function(F.col("t")).alias("result"))


def _sql(text: str, rule: str) -> str:
    return f"WITH d AS (SELECT doc_id, {text} AS t FROM documents) SELECT doc_id, {rule} AS result FROM d"


def _key() -> Column:
    return F.col("doc_id")


def _text() -> Column:
    return F.coalesce(F.replace("text", F.lit("ß"), F.lit("ss")), F.lit(""))


SQL_TEXT = "replace(coalesce(text, ''), 'ß', 'ss')"


def _piece(first: Column, size: int) -> Column:
    return F.substring(_text(), first, F.lit(size))


# -- shares: whole, fraction, decimals, none, spaced fraction, negative


def parse_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, d, c = (F.col(x).cast("string") for x in ("n", "d", "c"))
    ways = (F.concat(n, F.lit("%")), F.concat(n, F.lit("/"), d), F.concat(n, F.lit(","), F.lpad(c, 2, "0"), F.lit(" %")), F.lit("parte"), F.concat(n, F.lit(" / "), (F.col("d") + 1).cast("string")), F.concat(F.lit("-"), (F.col("n") + 1).cast("string")))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 250).alias("n"), (F.col("o_custkey") % 12).alias("d"), (F.col("o_custkey") % 100).alias("c"))
    text = F.get(F.array(*ways), F.pmod(F.col("o_orderkey"), F.lit(len(ways))).cast("int"))
    return orders.select("o_orderkey", A.parse_share(text).alias("result"))


PARSE_SHARE = """
WITH o AS (SELECT o_orderkey, o_orderkey % 250 AS n, o_custkey % 12 AS d, o_custkey % 100 AS c FROM orders),
v AS (
  SELECT o_orderkey, CASE o_orderkey % 6 WHEN 1 THEN CASE WHEN d > 0 THEN round(100.0::DOUBLE * n / d, 2) END WHEN 4 THEN round(100.0::DOUBLE * n / (d + 1), 2) END AS fraction,
    CASE WHEN o_orderkey % 6 IN (0, 1) THEN CAST(n AS DOUBLE) WHEN o_orderkey % 6 = 2 THEN CAST(100 * n + c AS DOUBLE) / 100 END AS amount FROM o)
SELECT o_orderkey, coalesce(fraction, CASE WHEN amount BETWEEN 0 AND 100 THEN amount END) AS result FROM v
"""

# -- names: the first words of a text in capitals, in small letters, or as they are

def _first_words() -> Column:
    return F.array_join(F.slice(F.split(_text(), " "), 1, 6), " ")

def _name() -> Column:
    return F.when(_key() % 3 == 0, F.upper(_first_words())).when(_key() % 3 == 1, F.lower(_first_words())).otherwise(_first_words())

TITLE_CASE = rf"""
WITH w AS (SELECT doc_id, array_to_string(string_split({SQL_TEXT}, ' ')[1:6], ' ') AS w FROM documents),
n AS (SELECT doc_id, regexp_replace(CASE doc_id % 3 WHEN 0 THEN upper(w) WHEN 1 THEN lower(w) ELSE w END, '^\s+|\s+$', '', 'g') AS t FROM w)
SELECT doc_id, CASE WHEN (t = upper(t) OR t = lower(t)) AND upper(t) <> lower(t)
  THEN array_to_string(list_transform(regexp_split_to_array(t, '\s+'), lambda x: CASE WHEN list_contains({sql_list(T.PARTICLES)}, lower(x)) THEN lower(x) ELSE upper(x[1]) || lower(x[2:]) END), ' ')
  ELSE t END AS result FROM n
"""

# -- cells: pieces of texts between signs and stray letters of a scan

_HEADS, _TAILS = ("| ", "(", "", "= [", "— "), (" _", " po", "  -- ;", " Ñ", "", " (a", ") ~")
def _scanned() -> Column:
    return F.concat(pick(_HEADS, _key()), F.when(_key() % 2 == 0, F.upper(_piece(_key() % 50 + 1, 14))).otherwise(_piece(_key() % 50 + 1, 14)), pick(_TAILS, _key()))

_SQL_PIECE = f"substr({SQL_TEXT}, CAST(doc_id % 50 + 1 AS INTEGER), 14)"
_SQL_SCANNED = f"{sql_pick(_HEADS, 'doc_id')} || CASE WHEN doc_id % 2 = 0 THEN upper({_SQL_PIECE}) ELSE {_SQL_PIECE} END || {sql_pick(_TAILS, 'doc_id')}"


def _sql_edges() -> str:
    signs = r"""|\[\]_—\-.,:;''`"<>=~"""
    steps, n = [f"s0 AS (SELECT doc_id, trim(regexp_replace({_SQL_SCANNED}, '\\s+', ' ', 'g')) AS t FROM documents)"], 0
    for _ in range(3):
        tail = rf"regexp_replace(t, '\s+[{signs}()]+$', '')"
        noise = r"CASE WHEN regexp_matches(t, '[A-ZÀ-Ý0-9]{2}') THEN regexp_replace(t, '^(.*?)\s+(?:[a-zà-ÿñ]{1,2}|[ÑI|]{1,2})$', '\1') ELSE t END"
        head = rf"regexp_replace(t, '^[{signs}]+\s*', '')"
        for rule in (tail, noise, head):
            steps.append(f"s{n + 1} AS (SELECT doc_id, {rule} AS t FROM s{n})")
            n += 1
    more = "len(t) - len(replace(t, '(', '')) > len(t) - len(replace(t, ')', ''))"
    return f"WITH {', '.join(steps)} SELECT doc_id, trim(CASE WHEN {more} AND starts_with(t, '(') THEN substr(t, 2) ELSE t END) AS result FROM s{n}"


def _cell() -> Column:
    return F.concat(F.when(_key() % 2 == 0, F.concat(F.lit("(cid:"), _key().cast("string"), F.lit(") "))).otherwise(""), _piece(F.lit(1), 12), F.repeat(F.lit("+"), (_key() % 3).cast("int")))

_SQL_CELL = f"CASE WHEN doc_id % 2 = 0 THEN '(cid:' || doc_id || ') ' ELSE '' END || substr({SQL_TEXT}, 1, 12) || repeat('+', CAST(doc_id % 3 AS INTEGER))"
INCOME_CELL = r"trim(regexp_replace(trim(regexp_replace(t, '\(cid:[0-9]+\)', '', 'g'), ' '), '\++$', ''), ' ')"

def _short() -> Column:
    return _piece(_key() % 40 + 1, 5)

_SQL_SHORT = f"substr({SQL_TEXT}, CAST(doc_id % 40 + 1 AS INTEGER), 5)"
HAS_WORD = f"""
coalesce(list_bool_or(list_transform(list_transform(regexp_extract_all(t, '[A-Za-zÀ-ÿ]{{3,}}'), lambda x: {sql_norm("x")}),
  lambda x: len(list_distinct(string_split(x, ''))) >= 2 AND regexp_matches(x, '[AEIOU]') AND regexp_matches(x, '[^AEIOU]'))), FALSE)"""

# -- codes: the form's words beside words of a text, and cells of one or two letters of a text


def _coded(words: tuple[tuple[str, tuple[str, ...]], ...]) -> Column:
    flat = tuple(w for _, names in words for w in names)
    beside = F.concat(F.lower(pick(flat, _key())), F.lit(". "), _piece(F.lit(1), 8))
    return F.when(_key() % 3 == 0, beside).when(_key() % 3 == 1, _piece(_key() % 40 + 1, 1)).otherwise(_piece(_key() % 40 + 1, 2))


def _sql_coded(words: tuple[tuple[str, tuple[str, ...]], ...]) -> str:
    flat, at = tuple(w for _, names in words for w in names), "CAST(doc_id % 40 + 1 AS INTEGER)"
    return f"CASE doc_id % 3 WHEN 0 THEN lower({sql_pick(flat, 'doc_id')}) || '. ' || substr({SQL_TEXT}, 1, 8) WHEN 1 THEN substr({SQL_TEXT}, {at}, 1) ELSE substr({SQL_TEXT}, {at}, 2) END"


def _sql_code(text: str, words: tuple[tuple[str, tuple[str, ...]], ...], confusion: dict[str, str]) -> str:
    whole = " ".join(rf"WHEN regexp_matches(n, '\b({'|'.join(names)})\b') THEN '{code}'" for code, names in words)
    first = "substr(replace(n, ' ', ''), 1, 1)"
    letters = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in {**{c: c for c, _ in words}, **confusion}.items())
    return f"""WITH d AS (SELECT doc_id, {text} AS t FROM documents), k AS (SELECT doc_id, {sql_norm("t")} AS n FROM d)
SELECT doc_id, CASE WHEN n = '' THEN NULL {whole} WHEN len(replace(n, ' ', '')) <= 2 THEN CASE {first} {letters} END END AS result FROM k"""



# -- classes: descriptions followed by words of a text

def _described() -> Column:
    return F.when(_key() % 4 == 3, _piece(_key() % 40 + 1, 30)).otherwise(F.concat(pick(DESCRIPTIONS, _key()), F.lit(", "), _piece(_key() % 40 + 1, 20)))

_SQL_AT = f"{SQL_TEXT}, CAST(doc_id % 40 + 1 AS INTEGER)"
_SQL_DESCRIBED = f"CASE WHEN doc_id % 4 = 3 THEN substr({_SQL_AT}, 30) ELSE {sql_pick(DESCRIPTIONS, 'doc_id')} || ', ' || substr({_SQL_AT}, 20) END"


def _sql_class(patterns: tuple[tuple[str, str], ...]) -> str:
    whens = " ".join(f"WHEN regexp_matches(n, '{p}') THEN '{name}'" for name, p in patterns)
    return f"WITH d AS (SELECT doc_id, {_SQL_DESCRIBED} AS t FROM documents), k AS (SELECT doc_id, {sql_norm('t')} AS n FROM d) SELECT doc_id, CASE {whens} ELSE 'otros' END AS result FROM k"


# -- dates and titles


def parse_pub_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as yyyymmdd, in ISO, with the 31st as the day, or without the last digit."""
    day = F.date_format("o_orderdate", "yyyyMMdd")
    ways = (day, F.date_format("o_orderdate", "yyyy-MM-dd"), F.concat(F.substring(day, 1, 6), F.lit("31")), F.substring(day, 1, 7))
    text = F.get(F.array(*ways), F.pmod("o_orderkey", F.lit(len(ways))).cast("int"))
    return read(spark, sf_dir, "orders").select("o_orderkey", C.parse_pub_date(text).alias("result"))


PARSE_PUB_DATE = """
WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS d FROM orders),
t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN d WHEN 1 THEN substr(d, 1, 4) || '-' || substr(d, 5, 2) || '-' || substr(d, 7, 2) WHEN 2 THEN substr(d, 1, 6) || '31' ELSE substr(d, 1, 7) END AS t FROM o)
SELECT o_orderkey, CASE WHEN regexp_matches(t, '^[0-9]{8}$') THEN CAST(try_strptime(t, '%Y%m%d') AS DATE) END AS result FROM t
"""

_OPENINGS = ("MODIFICACIONES de ", "Declaraciones finales de ", "Una declaración final de ", "Declaraciones de ", "La modificación de ")
def _title() -> Column:
    return F.concat(pick(_OPENINGS, _key()), _piece(F.lit(1), 40))

_SQL_TITLE = f"{sql_pick(_OPENINGS, 'doc_id')} || substr({SQL_TEXT}, 1, 40)"
CLASSIFY_INSERTION = "CASE WHEN starts_with(lower(t), 'modificaci') THEN 'modificacion' WHEN contains(lower(t), 'declaraciones finales') OR contains(lower(t), 'declaración final') THEN 'final' ELSE 'inicial' END"


def decode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters of texts as codes of type and right, with the language as the raw text, and kinds."""
    d = read(spark, sf_dir, "documents").select("doc_id", "lang", F.upper(_piece(_key() % 40 + 1, 1)).alias("code"), pick((*C.KIND_LABELS, None), _key()).alias("kind"))
    told = (C.decode_label("code", C.TYPE_LABELS), C.decode_label("code", C.RIGHT_LABELS, "lang"), C.decode_label("kind", C.KIND_LABELS))
    return d.select("doc_id", F.concat_ws("|", *told).alias("result"))


def _sql_labels() -> str:
    case = lambda c, labels: f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items()) + " END"
    return f"""
WITH d AS (SELECT doc_id, lang, upper(substr({_SQL_AT}, 1)) AS code, {sql_pick((*C.KIND_LABELS, None), "doc_id")} AS kind FROM documents)
SELECT doc_id, coalesce({case("code", C.TYPE_LABELS)}, '—') || '|' || coalesce({case("code", C.RIGHT_LABELS)}, nullif(lang, ''), '—') || '|' || coalesce({case("kind", C.KIND_LABELS)}, '—') AS result FROM d"""


# -- ratios: names with a letter twice, in longer texts, or nowhere near

def _customer() -> Column:
    return F.col("c_custkey")



def _doubled(text: Column, key: Column) -> Column:
    """``text`` with its letter at a place that ``key`` names written twice."""
    at = (F.pmod(key, F.length(text)) + 1).cast("int")
    return F.concat(F.substring(text, F.lit(1), at), F.substring(text, at, F.length(text)))


def resolve_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of provinces: as they are, among other words, with a letter twice; and customers' names."""
    name = pick(tuple(S.PROVINCE_KEYS), _customer())
    text = F.when(_customer() % 5 == 0, F.col("c_name")).when(_customer() % 5 == 1, F.lower(name)).when(_customer() % 5 == 2, F.concat(F.lit("prov. de "), name, F.lit(" ("), F.col("c_mktsegment"), F.lit(")"))).otherwise(_doubled(name, F.floor(_customer() / 5)))
    df = read(spark, sf_dir, "customer").select("c_custkey", text.alias("t"))
    return S.resolve_province(df, "t", "result").select("c_custkey", "result")


RESOLVE_PROVINCE = f"SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN {sql_pick(tuple(S.PROVINCE_KEYS.values()), 'c_custkey')} END AS result FROM customer"


def is_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form's labels as they are and with a letter twice, and customers' names."""
    label = pick(S.FORM_LABELS, _customer())
    text = F.when(_customer() % 4 == 0, F.col("c_name")).when(_customer() % 4 == 1, F.upper(label)).otherwise(_doubled(label, F.floor(_customer() / 4)))
    df = read(spark, sf_dir, "customer").select("c_custkey", text.alias("t"))
    return S.is_label(df, "t", "result").select("c_custkey", "result")


def similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve letters of each customer against the same with digits behind, with digits for the first letters, or against none."""
    k = _customer() % 11 + 1
    name, digits = invented(_customer()), F.substring(F.lit("12345678901"), F.lit(1), k.cast("int"))
    other = F.when(_customer() % 3 == 0, F.concat(F.lower(name), F.lit(" "), digits)).when(_customer() % 3 == 1, F.concat(digits, F.substring(name, (k + 1).cast("int"), F.lit(12)))).when(_customer() % 2 == 0, digits)
    df = read(spark, sf_dir, "customer").select("c_custkey", name.alias("a"), other.alias("b"))
    told = df.select("a", "b").distinct().withColumn("result", S.similarity("a", "b"))
    return df.alias("d").join(told.alias("t"), (F.col("d.a") == F.col("t.a")) & F.col("d.b").eqNullSafe(F.col("t.b"))).select("c_custkey", "result")


SIMILARITY = """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 24.0 / (25 + c_custkey % 11) WHEN c_custkey % 3 = 1 THEN 2.0 * (11 - c_custkey % 11) / 24 ELSE 0 END::DOUBLE AS result FROM customer
"""


def queries() -> dict[str, Query]:
    own = (parse_share, parse_pub_date, decode_labels, resolve_province, is_label, similarity)
    return {f.__name__: f for f in own} | {
        "title_case_name": _documents(_name, T.title_case_name),
        "clean_ocr_edges": _documents(_scanned, T.clean_ocr_edges),
        "clean_income_cell": _documents(_cell, T.clean_income_cell),
        "has_word": _documents(_short, T.has_word),
        "code_right": _documents(lambda: _coded(C.RIGHT_WORDS), lambda t: C.code_right(t, ocr=F.lit(True))),
        "code_type": _documents(lambda: _coded(C.TYPE_WORDS), lambda t: C.code_type(t, ocr=F.lit(True))),
        "classify_asset": _documents(_described, C.classify_asset),
        "classify_liability": _documents(_described, C.classify_liability),
        "classify_insertion": _documents(_title, C.classify_insertion),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "parse_share": PARSE_SHARE, "parse_pub_date": PARSE_PUB_DATE, "decode_labels": _sql_labels(), "resolve_province": RESOLVE_PROVINCE, "is_label": "SELECT c_custkey, c_custkey % 4 <> 0 AS result FROM customer",
        "similarity": SIMILARITY, "title_case_name": TITLE_CASE, "clean_ocr_edges": _sql_edges(), "clean_income_cell": _sql(_SQL_CELL, INCOME_CELL), "has_word": _sql(_SQL_SHORT, HAS_WORD),
        "code_right": _sql_code(_sql_coded(C.RIGHT_WORDS), C.RIGHT_WORDS, C.RIGHT_CONFUSION), "code_type": _sql_code(_sql_coded(C.TYPE_WORDS), C.TYPE_WORDS, {**C.TYPE_CONFUSION}),
        "classify_asset": _sql_class(C.ASSET_PATTERNS), "classify_liability": _sql_class(C.LIABILITY_PATTERNS), "classify_insertion": _sql(_SQL_TITLE, CLASSIFY_INSERTION),
    }
