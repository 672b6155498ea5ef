"""The weekly run: from bulletins' pages to checked declarations, from those to people, and to what is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrimonia.jobs.people import PLAIN
from patrimonia.operators import declarations as D
from patrimonia.operators import layout as L
from patrimonia.operators import nested as N
from patrimonia.operators import people as W
from patrimonia.operators import sequence as Q
from patrimonia.operators import summary as S
from patrimonia.sources import tables as IO
from patrimonia.sources.store import save, scratch, settings


def declared(pages: DataFrame, insertions: DataFrame) -> DataFrame:
    """Declarations with nested items of ``pages(bulletin_id, num, alto, metodo, palabras, casillas, sello)``.

    ``insertions(bulletin_id, pos, titulo, tipo, numero, fecha, url_pdf)`` gives the kind: that of the insertion in force
    on a declaration's first page. Pages that belong to no declaration are left out; a bulletin without insertions
    leaves the kind null.
    """
    with scratch(pages.sparkSession):
        stamped = save(L.detect_cover(L.extract_stamp(pages), ["bulletin_id", "num"]), "stamped")
        inside = save(Q.sessionize_pages(stamped).withColumn("decl_id", F.concat_ws(":", "bulletin_id", "gid")), "sessions")
        header = Q.declaration_header(inside).withColumn("first_page", F.element_at("paginas", 1))
        starts = Q.title_start_page(insertions, stamped.select("bulletin_id", "num", L.page_text("palabras").alias("texto")))
        dated = Q.asof_insertion(header, starts, ["tipo", "numero", "fecha", "url_pdf"]).withColumnRenamed("fecha", "fecha_bocv")
        read = L.read_forms(inside.select("decl_id", "num", "alto", "metodo", "palabras", "casillas"))
        out = dated.join(read.withColumns({t: _numbered(read, t) for t in N.TABLES}), "decl_id", "left").withColumns({"notas": F.array().cast("array<string>"), "pos": F.struct("bulletin_id", "gid")})
        return save(out, "declared", keep=True)


def _numbered(read: DataFrame, table: str) -> Column:
    """A form's items with their place as pos; a form that wasn't read has none."""
    fields = read.schema[table].dataType.elementType.names
    return F.transform(table, lambda x, i: F.struct(i.alias("pos"), *(x[f].alias(f) for f in fields)))


def read_bulletins(pages: DataFrame, insertions: DataFrame, corrections: DataFrame) -> DataFrame:
    """Checked and corrected declarations of all bulletins, with their items in their rows (``nested.correct_rows``)."""
    spark = pages.sparkSession
    with scratch(spark), settings(spark, PLAIN):
        read = declared(pages, insertions)
        checked = save(N.check_rows(read.withColumns({t: N._items(read, t) for t in N.TABLES})), "checked")
        return save(N.correct_rows(checked, corrections), "corrected", keep=True)


def _order(number: Column | str = "numero") -> Column:
    return F.struct(F.coalesce(F.col("fecha_registro").cast("string"), F.lit("")).alias("d"), F.coalesce(number, F.lit(0)).alias("n"), "pos")


def link_people(checked: DataFrame, roster: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``checked`` with each declaration's person_id, and all people: ``roster`` and those that only declarations name.

    A former person has the name, district and party of the declaration that made it.
    """
    with scratch(checked.sparkSession):
        names = checked.select("decl_id", "persona.nombre", "persona.apellidos", "sello", _order().alias("ord"))
        matched = save(W.match_people(names, roster), "matches")
        known = matched.where("person_id is not null").select("decl_id", F.col("person_id").cast("string").alias("person_id"))
        former = save(W.resolve_unmatched(matched.where("person_id is null").select("decl_id", "nombre", "apellidos", "sello", "ord")), "former", keep=True)
        owner = known.unionByName(former.select("decl_id", "person_id"))
        owned = save(checked.join(owner, "decl_id"), "owned", keep=True)
    said = checked.select(F.col("decl_id").alias("leader"), "persona.circunscripcion", F.col("persona.partido").alias("grupo"))
    made = former.where("decl_id = leader").join(said, "leader").select(F.col("person_id").alias("id"), "leader", "nombre", "apellidos", "circunscripcion", "grupo")
    first = lambda c: F.min_by(c, "leader").alias(c)
    ids = made.groupBy("id").agg(*(first(c) for c in ("nombre", "apellidos", "circunscripcion", "grupo")))
    return owned, W.union_people(roster.withColumn("id", F.col("id").cast("string")), ids)


def documents(people: DataFrame, checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is published as documents: people, each with its declaration in force, history, income and quality; and all declarations with their items.

    An illegible declaration has no items and no totals. A person without a declaration or an income has null for it.
    """
    told = D.publishable(checked)
    shown = told.select("decl_id", F.struct(*(c for c in told.columns if c != "decl_id")).alias("declaracion"))
    income = F.when(F.col("tiene_renta"), F.struct("rentas", "salarios", "otras_rentas", "cuota_irpf"))
    own = people.select("id", "nombre", "apellidos", "cargo", "grupo", "circunscripcion", "decl_id", "historico", income.alias("renta"), F.struct("revisar", "comprobado", F.col("motivos_revision").alias("motivos")).alias("calidad"))
    return own.join(shown, "decl_id", "left").drop("decl_id"), checked.select("decl_id", "bulletin_id", "person_id").join(told, "decl_id")


def publish(people: DataFrame, checked: DataFrame, income_items: DataFrame, statements: DataFrame, folder: str) -> None:
    """The five tables and the nested documents of a run, from the output of ``jobs.people.build``.

    Declarations' documents lie in a folder for each bulletin; a run replaces the folders of the bulletins in ``checked``
    and leaves all others' files as they are.
    """
    own = save(people, "people")
    items = {t: S.flatten_items(own, N.items_of(checked, t), S.ITEM_COLUMNS) for t in ("otros_bienes", "pasivo")}
    items["inmuebles"] = S.flatten_items(own, N.items_of(checked, "inmuebles"), S.PROPERTY_COLUMNS)
    items["rentas"] = S.union_income_quota(own, income_items, statements)
    IO.write_tables({"personas": own.select(*(c for c in S.PEOPLE_COLUMNS if c in own.columns)), **items}, folder)
    IO.write_documents(*documents(own, checked), S.run_metadata(own), folder)
