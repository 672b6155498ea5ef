"""From declarations and items to one row for each person: the chain of the library's operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrimonia.operators import declarations as D
from patrimonia.operators import nested as N
from patrimonia.operators import summary as S
from patrimonia.operators.people import assemble_people
from patrimonia.sources.store import save, settings

#: The rows of ``nested`` build columns on columns: the planner's search for filters that follow from them finds nothing and takes long.
PLAIN = {"spark.sql.constraintPropagation.enabled": "false"}


@dataclass
class Read:
    """Declarations and their item tables."""

    declarations: DataFrame
    inmuebles: DataFrame
    otros_bienes: DataFrame
    pasivo: DataFrame


def check(read: Read) -> DataFrame:
    """Declarations with their items in their rows, checked (``nested.check_rows``); written once."""
    tables = {t: getattr(read, t) for t in N.TABLES}
    with settings(read.declarations.sparkSession, PLAIN):
        return save(N.check_rows(N.nest(read.declarations, tables)), "checked")


def build(people: DataFrame, checked: DataFrame, income: DataFrame, ambito: str | None = None) -> DataFrame:
    """One row for each of ``people(id, en_activo, ...)``: summary, quality, role and history of its declarations.

    ``checked`` comes from ``check`` or ``jobs.bulletins``; ``ambito`` is the body that the people belong to, as published.
    """
    current = D.current_declaration(checked)
    with settings(checked.sparkSession, PLAIN):
        summed = save(N.summarize_rows(N.rate_rows(checked)).drop(*(f"lista_{t}" for t in N.TABLES)), "summed")
    summed = S.put_notice_first(summed.join(current.select("decl_id", "aviso"), "decl_id"))
    summed = summed.withColumns({"bocv": F.col("numero"), "fecha_declaracion": F.col("fecha_registro"), "url_declaracion": D.declaration_ref()["url"]})
    keep = [c for c in summed.columns if c not in ("person_id", "aviso", "bulletin_id", "pos")]
    out = assemble_people(people, current, summed.select(*keep), D.declaration_history(checked))
    none = F.array().cast("array<string>")
    out = out.withColumns({
        "revisar": F.coalesce("revisar", F.lit(True)), "comprobado": F.coalesce("comprobado", F.lit(False)), "metodo_lectura": F.col("metodo"), "motivos_revision": F.coalesce("motivos", F.array(F.lit(S.NO_DECLARATION))),
        "provincias_inmuebles": F.coalesce("provincias_inmuebles", none), "provincias_viviendas": F.coalesce("provincias_viviendas", none), "ambito": F.lit(ambito).cast("string"),
    })
    return S.attach_income(out, income)
