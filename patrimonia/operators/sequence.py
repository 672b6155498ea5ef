"""Ordered work on pages and lines: declarations out of page runs, sections of income forms, as-of insertions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patrimonia.functions.amounts import parse_amount
from patrimonia.functions.text import clean_income_cell, norm_text
from patrimonia.sources.store import save

# The income form's section marks and words.
SECTIONS = {"I.": "salarios", "II.": "dividendos", "III.": "intereses", "IV.": "otras", "V.": "irpf"}
ORIGIN_X, AMOUNT_X = 290.0, 430.0
STATUS_X = 250.0
TITLE_CHARS = 70


def sessionize_pages(pages: DataFrame) -> DataFrame:
    """``pages(bulletin_id, num, is_cover, seal, metodo)`` that belong to a declaration, with gid (from 1 in a bulletin).

    A declaration starts at a cover page that has a seal or was scanned. Pages go on with it while they carry its
    seal, or while a scanned page without a seal follows in a scanned declaration. Any other page ends it, and
    what follows stays out up to the next start.
    """
    order = Window.partitionBy("bulletin_id").orderBy("num")
    start = F.coalesce("is_cover", F.lit(False)) & (F.col("seal").isNotNull() | (F.col("metodo") == "ocr"))
    run = pages.withColumn("_start", start).withColumn("gid", F.sum(F.col("_start").cast("int")).over(order))
    inside = Window.partitionBy("bulletin_id", "gid").orderBy("num")
    first = lambda c: F.first(c).over(inside)
    same = F.col("seal").isNotNull() & (F.col("seal") == first("seal"))
    unread = F.col("seal").isNull() & (F.col("metodo") == "ocr") & (first("metodo") == "ocr")
    run = run.withColumn("_bad", (~(F.col("_start") | F.coalesce(same, F.lit(False)) | unread)).cast("int"))
    ended = F.max("_bad").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return run.withColumn("_ended", ended).where("gid > 0 and _ended = 0").withColumn("gid", F.col("gid").cast("int")).drop("_start", "_bad", "_ended")


def declaration_header(pages: DataFrame) -> DataFrame:
    """(decl_id, bulletin_id, gid, sello, fecha_registro, paginas, metodo) of ``pages(bulletin_id, gid, num, seal, fecha, metodo)``.

    Seal and date are the first page's; a declaration without a seal is named after that page.
    """
    first = lambda c: F.min_by(c, "num")
    out = pages.groupBy("bulletin_id", "gid").agg(
        first("seal").alias("_seal"), F.min("num").alias("_num"), first("fecha").alias("fecha_registro"),
        F.sort_array(F.collect_list("num")).alias("paginas"), F.bool_or(F.col("metodo") == "ocr").alias("_ocr"),
    )
    return out.select(
        F.concat_ws(":", "bulletin_id", "gid").alias("decl_id"), "bulletin_id", "gid",
        F.coalesce("_seal", F.concat(F.lit("sin-sello-p"), F.col("_num").cast("string"))).alias("sello"),
        "fecha_registro", "paginas", F.when(F.col("_ocr"), "ocr").otherwise("texto").alias("metodo"),
    )


#: Needles of three words or more are filed by up to so many of their inner words, others by up to so many characters.
RUN_WORDS, RUN_CHARS = 3, 8
#: A key of so many pairs or fewer is compared pair by pair, which costs less than looking up its texts' runs.
DIRECT_PAIRS = 10_000


def _filed(needle: str) -> tuple[Column, Column]:
    """What a needle is filed by: the kind (a number of words, or minus a number of characters) and a hash."""
    words = F.split(needle, " ")
    run = F.least(F.size(words) - 2, F.lit(RUN_WORDS))
    short = F.least(F.length(needle), F.lit(RUN_CHARS))
    by_words = F.xxhash64(F.array_join(F.slice(words, 2, F.greatest(run, F.lit(0))), " "))
    return F.when(run > 0, run).otherwise(-short), F.when(run > 0, by_words).otherwise(F.xxhash64(F.substring(needle, F.lit(1), short)))


def _runs(text: str, kind: str) -> Column:
    """The distinct hashes of a text's runs of ``kind``."""
    words, n = F.split(text, " "), F.col(kind)
    places = lambda last: F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    by_words = F.transform(places(F.size(words) - n + 1), lambda i: F.xxhash64(F.array_join(F.slice(words, i, n), " ")))
    by_chars = F.transform(places(F.length(text) + n + 1), lambda i: F.xxhash64(F.substring(F.col(text), i, -n)))
    return F.array_distinct(F.when(n > 0, by_words).otherwise(by_chars))


def _looked_up(titles: DataFrame, pages: DataFrame, key: str, needle: str, text: str) -> DataFrame:
    """The pairs of ``contains_join`` by an equi-join on key and run."""
    titles = save(titles.withColumn("_t", F.monotonically_increasing_id()), "needles")
    pages = save(pages.withColumn("_p", F.monotonically_increasing_id()), "texts")
    kind, code = _filed(needle)
    filed = titles.select(key, kind.alias("_kind"), code.alias("_code"), "_t")
    kinds = filed.select(key, "_kind").distinct()
    runs = pages.select(key, "_p", text).join(kinds, key).select(key, "_kind", "_p", F.explode(_runs(text, "_kind")).alias("_code"))
    found = runs.join(filed, [key, "_kind", "_code"]).select("_t", "_p").distinct()
    return titles.join(found, "_t").join(pages.drop(key), "_p").drop("_t", "_p")


def contains_join(titles: DataFrame, pages: DataFrame, key: str, needle: str, text: str, direct_pairs: int = DIRECT_PAIRS) -> DataFrame:
    """Pairs of rows of the same ``key`` where ``text`` holds ``needle`` (an empty or null needle is held nowhere).

    A needle's inner words stand in a text that holds it as whole words, next to each other. Needles are filed by a run of
    these, short ones by their first characters, and texts look up their runs of the kinds that their key's needles have:
    an equi-join on key and run, so that the work of a key with many rows is dealt out by runs. Pairs that it finds are
    then compared in full. Keys of at most ``direct_pairs`` pairs are compared pair by pair; the pairs are the same. Rows
    that repeat are pairs each; columns that both sides have, other than ``key``, clash.
    """
    titles, pages = titles.where(F.col(needle) != ""), pages.where(F.col(text) != "")
    n = lambda df, c: df.groupBy(key).agg(F.count("*").alias(c))
    large = n(titles, "_n").join(n(pages, "_m"), key).where(F.col("_n") * F.col("_m") > direct_pairs).select(key)
    columns = [key, *(c for c in titles.columns if c != key), *(c for c in pages.columns if c != key)]
    if large.isEmpty():
        pairs = titles.join(pages, key).select(columns)
    else:
        large = save(large, "large")
        pairs = titles.join(large, key, "left_anti").join(pages, key).select(columns)
        pairs = pairs.unionByName(_looked_up(titles.join(large, key, "left_semi"), pages.join(large, key, "left_semi"), key, needle, text).select(columns))
    return pairs.where(F.col(text).contains(F.col(needle)))


def title_start_page(insertions: DataFrame, pages: DataFrame) -> DataFrame:
    """``insertions(bulletin_id, pos, titulo, ...)`` with inicio: the last page whose text holds the title's begin, else 0.

    ``pages(bulletin_id, num, texto)`` has normalised texts. The title counts up to its first bracket.
    """
    key = F.substring(norm_text(F.substring_index("titulo", "[", 1)), 1, TITLE_CHARS)
    titles = insertions.select("bulletin_id", "pos", key.alias("_key"))
    found = contains_join(titles, pages.select("bulletin_id", "num", "texto"), "bulletin_id", "_key", "texto")
    last = found.groupBy("bulletin_id", "pos").agg(F.max("num").alias("_last"))
    return insertions.join(last, ["bulletin_id", "pos"], "left").withColumn("inicio", F.coalesce("_last", F.lit(0)).cast("int")).drop("_last")


def asof_insertion(declarations: DataFrame, insertions: DataFrame, take: list[str]) -> DataFrame:
    """``declarations(bulletin_id, first_page, ...)`` with ``take`` of the insertion in force on its first page.

    That is the last of its bulletin that starts at or before the page (``insertions(bulletin_id, inicio, pos)``,
    of equal starts the last), else the bulletin's first; null without one. Only bulletins and pages go through the window,
    each once.
    """
    given = F.struct(*take)
    own = insertions.select("bulletin_id", F.col("inicio").alias("_at"), F.lit(0).alias("_side"), F.col("pos").cast("long").alias("_pos"), given.alias("_given"))
    asked = declarations.select("bulletin_id", F.col("first_page").alias("_at")).distinct().select("bulletin_id", "_at", F.lit(1).alias("_side"), F.lit(0).cast("long").alias("_pos"))
    both = own.unionByName(asked, allowMissingColumns=True)
    order = Window.partitionBy("bulletin_id").orderBy("_at", "_side", "_pos")
    whole = Window.partitionBy("bulletin_id")
    first = F.min(F.when(F.col("_side") == 0, F.struct("_at", "_pos", "_given"))).over(whole)["_given"]
    found = both.withColumn("_found", F.coalesce(F.last("_given", ignorenulls=True).over(order), first)).where("_side = 1")
    found = found.select(F.col("bulletin_id").alias("_bulletin"), F.col("_at").alias("_page"), *(F.col(f"_found.{c}").alias(f"_{c}") for c in take))
    met = declarations.join(found, F.equal_null("bulletin_id", "_bulletin") & F.equal_null("first_page", "_page"), "left")
    return met.select(*declarations.columns, *(F.col(f"_{c}").alias(c) for c in take))


def carry_sections(lines: DataFrame) -> DataFrame:
    """``lines(doc_id, page, line, words)`` with kind, section and the columns' places, carried forward within a document.

    words is an array of struct(t, x0). kind: section, columns, status (the line that opens the civil status),
    title (its second language), value (the line that holds the status) or line.
    """
    order = Window.partitionBy("doc_id").orderBy("page", "line")
    t0 = F.element_at("words.t", 1)
    text = F.array_join("words.t", " ")
    kind = (
        F.when(t0.isin(*SECTIONS) & (F.size("words") > 3), "section").when(t0.isin("Concepte", "Concepto"), "columns")
        .when(text.startswith("Estat civil"), "status").when(text.startswith("Estado civil"), "title").otherwise("line")
    )
    at = lambda names: F.element_at(F.filter("words", lambda w: w["t"].isin(*names)), -1)["x0"] - 3
    has = lambda names: F.exists("words", lambda w: w["t"].isin(*names))
    is_columns = F.col("kind") == "columns"
    section = F.lit(None).cast("string")
    for mark, name in SECTIONS.items():
        section = F.when(F.col("t0") == mark, name).otherwise(section)
    carried = lambda c: F.last(c, ignorenulls=True).over(order)
    out = lines.withColumns({"t0": t0, "txt": text}).withColumn("kind", kind)
    out = out.withColumn("_asked", F.sum((F.col("kind") == "status").cast("int")).over(order))
    rank = F.row_number().over(Window.partitionBy("doc_id", "_asked", "kind").orderBy("page", "line"))
    out = out.withColumn("kind", F.when((F.col("kind") == "line") & (F.col("_asked") > 0) & (rank == 1), "value").otherwise(F.col("kind")))
    return out.withColumns(
        {
            "section": carried(F.when(F.col("kind") == "section", section)),
            "x_origin": F.coalesce(carried(F.when(is_columns & has(["Origen"]), at(["Origen"]))), F.lit(ORIGIN_X)),
            "x_amount": F.coalesce(carried(F.when(is_columns & has(["Quantia", "Cuantía"]), at(["Quantia", "Cuantía"]))), F.lit(AMOUNT_X)),
        }
    ).drop("_asked")


def _joined(words: Column, keep) -> Column:  # noqa: ANN001
    return F.array_join(F.transform(F.filter(words, keep), lambda w: w["t"]), " ")


def civil_status(carried: DataFrame) -> DataFrame:
    """(doc_id, estado_civil, regimen_matrimonial) from the last value line of ``carry_sections``; empty parts are null."""
    value = carried.where("kind = 'value'")
    part = lambda keep: F.nullif(_joined(F.col("words"), keep), F.lit(""))
    named = value.select("doc_id", F.struct("page", "line").alias("_at"), part(lambda w: w["x0"] < STATUS_X).alias("s"), part(lambda w: w["x0"] >= STATUS_X).alias("r"))
    return named.groupBy("doc_id").agg(F.max_by("s", "_at").alias("estado_civil"), F.max_by("r", "_at").alias("regimen_matrimonial"))


def income_lines(carried: DataFrame) -> DataFrame:
    """(doc_id, page, line, apartado, concepto, origen, importe, is_quota) of the lines of ``carry_sections`` that state an amount."""
    words = F.col("words")
    amount = parse_amount(_joined(words, lambda w: w["x0"] >= F.col("x_amount")))
    salary = F.col("section") == "salarios"
    edge = F.when(salary, F.col("x_origin")).otherwise(F.col("x_amount"))
    out = carried.where(F.col("kind").isin("line", "title") & F.col("section").isNotNull() & F.col("txt").contains("€")).withColumn("importe", amount).where("importe is not null")
    out = out.withColumn("is_quota", F.col("section") == "irpf").where(F.col("is_quota") | ~F.col("t0").isin("Quantia", "Cuantía"))
    concept = clean_income_cell(_joined(words, lambda w: w["x0"] < edge))
    origin = clean_income_cell(_joined(words, lambda w: (w["x0"] >= F.col("x_origin")) & (w["x0"] < F.col("x_amount"))))
    return out.select("doc_id", "page", "line", F.col("section").alias("apartado"), concept.alias("concepto"), F.when(salary, origin).otherwise("").alias("origen"), "importe", "is_quota")
