"""Yearly income forms: from pages of words to a statement for each person, its items and its tax quota."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrimonia.operators import layout as L
from patrimonia.operators import sequence as Q
from patrimonia.operators import summary as S
from patrimonia.sources.store import save, scratch

#: Words above and below these distances from a page's edges are its head and foot.
HEAD, FOOT = 100, 60


@dataclass
class Income:
    """statements: a row for each person; items: a row for each line that states an amount; failed: how many pages of each person couldn't be read."""

    statements: DataFrame
    items: DataFrame
    failed: DataFrame


def read_income(pages: DataFrame) -> Income:
    """Statements and items of ``pages(person_id, num, alto, palabras, error)``, the pages of each person's form.

    A page with an error, or without words, is skipped; pages with an error are counted in ``failed(person_id, pages)``
    and in the statement. A person without any readable page has no statement. A form without amounts has totals of 0,
    one without a quota null. Of several quotas and civil statuses the last counts. Rows without person_id are left out.
    Sections and column places are carried from line to line by windows over a person's lines, which one exchange deals
    out and which take time in proportion to the lines.
    """
    own = pages.where("person_id IS NOT NULL").select("person_id", "num", "alto", "palabras", "error")
    failed = own.where("error IS NOT NULL").groupBy("person_id").agg(F.count("*").alias("pages"))
    good = own.where("error IS NULL AND palabras IS NOT NULL")
    with scratch(pages.sparkSession):
        text = F.array_join("palabras.t", " ")
        date = F.regexp_replace(F.regexp_extract(text, L.STAMP_DATE, 0), r"^([0-9]{2})/([0-9]{2})/([0-9]{4}).*$", "$3-$2-$1")
        date = F.try_to_timestamp(F.nullif(date, F.lit("")), F.lit("yyyy-MM-dd")).cast("date")
        body = F.filter("palabras", lambda w: (w["y0"] > HEAD) & (w["y0"] < F.col("alto") - FOOT))
        paged = save(L.words_to_lines(good.select("person_id", "num", date.alias("fecha"), body.alias("palabras"))).select("person_id", "num", "fecha", "lineas"), "income-pages")
        words = F.transform("l", lambda w: F.struct(w["t"].alias("t"), w["x0"].alias("x0")))
        lines = paged.select(F.col("person_id").alias("doc_id"), F.col("num").alias("page"), F.posexplode("lineas").alias("line", "l")).select("doc_id", "page", "line", words.alias("words"))
        carried = save(Q.carry_sections(lines), "income-lines")
        told = save(Q.income_lines(carried), "income-told")
        position = F.struct("page", "line")
        quota = told.where("is_quota").groupBy("doc_id").agg(F.max_by("importe", position).alias("cuota_irpf"))
        items = told.where("not is_quota").withColumn("pos", F.struct("page", "line"))
        out = paged.groupBy("person_id").agg(F.min_by("fecha", F.when(F.col("fecha").isNotNull(), F.col("num"))).alias("fecha_registro"))
        for part in (Q.civil_status(carried), S.income_totals(items), quota):
            out = out.join(part.withColumnRenamed("doc_id", "person_id"), "person_id", "left")
        out = out.join(failed, "person_id", "left").withColumn("paginas_fallidas", F.coalesce("pages", F.lit(0))).drop("pages")
        totals = [c for c in out.columns if c.startswith("total_")]
        statements = save(out.fillna(0.0, totals), "statements", keep=True)
        items = save(items.select(F.col("doc_id").alias("person_id"), "pos", "apartado", "concepto", "origen", "importe"), "income-items", keep=True)
    return Income(statements, items, failed)
