"""Amounts and shares written in free text, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patrimonia.functions.text import _col, let

# Fixed value: the first number of a text, with thousands in groups of three, or in one piece with separators.
AMOUNT = r"-?\s*(?:[0-9]{1,3}(?:[ .][0-9]{3})+(?:[,.'][0-9]{1,2})?(?![0-9])|[0-9]+(?:[.,'][0-9]+)*)"


def _only(s: Column, sign: str) -> Column:
    """A number with one kind of separator: one or two digits after the last are decimals, else all mark thousands."""
    pattern = "\\" + sign
    decimals = F.regexp_extract(s, pattern + "([0-9]{1,2})$", 1)
    digits = F.replace(s, F.lit(sign), F.lit(""))
    return F.when(decimals != "", F.concat(F.substring(digits, F.lit(1), F.length(digits) - F.length(decimals)), F.lit("."), decimals)).otherwise(digits)


def parse_amount(c: Column | str) -> Column:
    """The first amount in a text, whatever its separators; null without one."""
    t = F.regexp_replace(_col(c), "€|EUR|euros", " ")
    t = F.regexp_replace(t, r"^\s+|\s+$", "")
    t = F.regexp_replace(t, r"(?<=[0-9])[:;](?=[0-9]{3}\b)", ".")  # a scan reads 4:622,51 for 4.622,51
    t = let(t, lambda x: F.when(x.rlike(r"^[0-9Oo., ]+$") & x.rlike("[0-9]"), F.translate(x, "Oo", "00")).otherwise(x))
    return let(F.regexp_replace(F.regexp_extract(t, AMOUNT, 0), r"\s", ""), _value)


def _value(found: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(found, "^-+", ""), "'([0-9]{1,2})$", ",$1")
    s = F.regexp_replace(F.replace(s, F.lit("'"), F.lit("")), "[.,]+$", "")
    value = F.nullif(let(s, _plain), F.lit("")).try_cast("double")
    return let(value, lambda x: F.when(found.startswith("-"), -x).otherwise(x))


def _plain(s: Column) -> Column:
    """Digits with a point before the decimals, if any."""
    comma, point = F.instr(F.reverse(s), ","), F.instr(F.reverse(s), ".")  # places from the end, 0: none
    swapped = F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return (
        F.when((comma > 0) & (point > 0) & (comma < point), swapped)
        .when((comma > 0) & (point > 0), F.replace(s, F.lit(","), F.lit("")))
        .when(comma > 0, _only(s, ","))
        .when(point > 0, _only(s, "."))
        .otherwise(s)
    )


def parse_share(c: Column | str) -> Column:
    """A percentage or fraction as 0 to 100 (a fraction as it is, even beyond); null for anything else."""
    text = _col(c)
    pattern = r"([0-9]+)\s*/\s*([0-9]+)"
    over, under = (F.nullif(F.regexp_extract(text, pattern, i), F.lit("")).try_cast("double") for i in (1, 2))
    amount = parse_amount(F.replace(text, F.lit("%"), F.lit(" ")))
    return F.coalesce(F.when(under > 0, F.round(100 * over / under, 2)), let(amount, lambda x: F.when(x.between(0, 100), x)))
