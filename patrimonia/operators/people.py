"""People behind declarations: blocked fuzzy matching with a roster, and ordered clustering of the rest."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patrimonia.functions.similarity import ratio
from patrimonia.functions.text import compact_norm, norm_text, slug_id, title_case_name
from patrimonia.sources.store import drop, save, scratch

MATCH, SURNAME_MATCH = 0.84, 0.92
SURNAME_WEIGHT, NAME_WEIGHT = 0.75, 0.25
#: A score of MATCH needs a surname ratio of this at least, unless the full names' ratio is MATCH.
SURNAME_NEEDED = (MATCH - NAME_WEIGHT) / SURNAME_WEIGHT
NO_NAME = "(nombre ilegible)"


def keyed_names(df: DataFrame, name: str, surname: str, prefix: str) -> DataFrame:
    """``df`` with the texts that names are compared by."""
    full = F.concat_ws(" ", F.coalesce(name, F.lit("")), F.coalesce(surname, F.lit("")))
    return df.withColumns({f"{prefix}_all": compact_norm(full), f"{prefix}_sur": compact_norm(surname), f"{prefix}_nom": compact_norm(name), f"{prefix}_tokens": norm_text(name)})


#: Texts of a side that meet in one cell, and the fewest that are cut off for more tasks.
LIST_ROWS, LEAST_ROWS = 16384, 1000
#: Rows of a cell that are compared with its columns at once, and pairs whose sequences are.
_STEP_ROWS, _STEP_PAIRS = 512, 1 << 18
#: Characters of a text that are compared in order; longer texts are only counted.
_WIDEST = 4096
#: Classes of characters, which letters and digits have one each of, and how often one is counted in a text.
_CLASSES, _COUNTED = 64, 4


def _coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, codes, counts) of texts: the class of each character, padded with one that no text has, and each class's number."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    rows = np.repeat(np.arange(len(texts)), sizes)
    found = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64) % _CLASSES
    codes = np.full((len(texts), min(int(sizes.max(initial=0)), _WIDEST)), _CLASSES, dtype=np.uint8)
    place = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    near = place < _WIDEST
    codes[rows[near], place[near]] = found[near]
    return sizes, codes, np.bincount(rows * _CLASSES + found, minlength=len(texts) * _CLASSES).reshape(-1, _CLASSES)


def _in_order(a: np.ndarray, sizes: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The longest sequence of classes that texts ``a[i]``, of 64 characters at most, and ``b[j]`` have in common in order."""
    at = np.zeros((len(a), _CLASSES + 1), dtype=np.uint64)
    for k in range(min(a.shape[1], 64)):
        at[np.arange(len(a)), a[:, k]] |= np.uint64(1 << k)
    at[:, _CLASSES] = 0
    flat, start, left = at.ravel(), i * (_CLASSES + 1), np.full(len(i), 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for k in range(b.shape[1]):
        same = left & flat[start + b[j, k]]
        left = (left + same) | (left - same)
    return np.bitwise_count(~left & np.where(sizes[i] < 64, (np.uint64(1) << (sizes[i] % 64).astype(np.uint64)) - np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)))


def _alike(left: list[str], right: list[str], least: float) -> Iterator[tuple[str, str]]:
    """Pairs of ``left`` and ``right`` with a ratio of ``least``, by bounds from above first.

    A ratio of t needs t / 2 of both texts' characters matched, in order. No more match than both texts have of each
    character, which a product of matrices gives for all pairs, nor than their longest common sequence.
    """
    if not left or not right:
        return
    (la, a, na), (lb, b, nb) = _coded(left), _coded(right)
    levels = [(c, n) for c in range(_CLASSES) for n in range(1, 1 + min(_COUNTED, int(na[:, c].max()), int(nb[:, c].max())))]
    classes, number = np.array([c for c, _ in levels], dtype=np.int64), np.array([n for _, n in levels])
    more = np.maximum(na - _COUNTED, 0).sum(axis=1)
    x = np.column_stack([na[:, classes] >= number, more - least / 2 * la + 1e-3 + 1e-5 * la, np.ones(len(la))]).astype(np.float32)
    y = np.ascontiguousarray(np.column_stack([nb[:, classes] >= number, np.ones(len(lb)), -least / 2 * lb]).astype(np.float32).T)
    for at in range(0, len(left), _STEP_ROWS):
        part = slice(at, at + _STEP_ROWS)
        hits = np.flatnonzero(x[part] @ y >= 0)
        for first in range(0, len(hits), _STEP_PAIRS):
            i, j = np.divmod(hits[first : first + _STEP_PAIRS], len(right))
            long = (la[part][i] > 64) | (lb[j] > _WIDEST)
            keep = long.copy()
            keep[~long] = _in_order(a[part], la[part], b, i[~long], j[~long]) >= least / 2 * (la[part][i] + lb[j])[~long] - 1e-6
            matcher, last = SequenceMatcher(None), None
            for to, of in sorted(zip(j[keep].tolist(), i[keep].tolist(), strict=True)):
                if to != last:
                    matcher.set_seq2(right[to])
                    last = to
                matcher.set_seq1(left[at + of])
                if matcher.ratio() >= least - 1e-9:
                    yield left[at + of], right[to]


def _parts(texts: DataFrame, least: float) -> tuple[Column, list[tuple[int, int]]]:
    """The part that each of ``texts(text)`` lies in, and the shortest and longest length in each part.

    Neighbouring lengths share a part until it is full; a length of more texts has several, by hash.
    """
    held = sorted((r["size"], r["n"]) for r in texts.groupBy(F.length("text").alias("size")).agg(F.count("*").alias("n")).collect())
    full = min(LIST_ROWS, max(LEAST_ROWS, sum(n for _, n in held) // 8))
    bounds, ranges, filled = [], [], full
    for size, n in held:
        if n > full:
            many, filled = -(-n // full), full
            ranges.append((size, len(bounds), many))
            bounds += [(size, size)] * many
        elif filled + n <= full and 2 * bounds[-1][0] >= least * (bounds[-1][0] + size):
            filled += n
            ranges.append((size, len(bounds) - 1, 1))
            bounds[-1] = (bounds[-1][0], size)
        else:
            filled = n
            ranges.append((size, len(bounds), 1))
            bounds.append((size, size))
    by = F.create_map(*(x for size, first, many in ranges for x in (F.lit(size), F.struct(F.lit(first).alias("first"), F.lit(many).alias("many"))))) if ranges else F.lit(None).cast("map<int,struct<first:int,many:int>>")
    own = by[F.length("text")]
    return (own["first"] + F.pmod(F.xxhash64("text"), own["many"].cast("long"))).cast("int"), bounds


def _near_texts(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b) of the distinct ``left(text)`` and ``right(text)`` with a ratio of ``least``.

    Every pair whose lengths allow that is compared, in cells of one part of each side: bounded in memory, a row of a
    side going to as many cells as the other side has parts of its length.
    """
    (p, mine), (q, theirs) = _parts(left, least), _parts(right, least)
    fits = lambda x, y: x[0] <= y[1] and y[0] <= x[1] or 2 * min(x[1], y[1]) >= least * (min(x[1], y[1]) + max(x[0], y[0]))
    met = [[j for j, y in enumerate(theirs) if fits(x, y)] for x in mine]
    faced = [[i for i, x in enumerate(mine) if fits(x, y)] for y in theirs]
    cells = sum(map(len, met))
    spark = left.sparkSession
    if not cells:
        return spark.createDataFrame([], "a string, b string")

    def dealt(texts: DataFrame, part: Column, others: list[list[int]], own: str, other: str) -> DataFrame:
        to = spark.createDataFrame(list(enumerate(others)), f"{own} int, others array<int>")
        return texts.withColumn(own, part).join(F.broadcast(to), own).select("text", own, F.explode("others").alias(other), F.lit(own == "p").alias("mine")).select("p", "q", "mine", "text")

    rows = dealt(left, p, met, "p", "q").unionByName(dealt(right, q, faced, "q", "p"))

    def compared(cell: pa.Table) -> pa.Table:
        side, texts = cell["mine"].to_numpy(), cell["text"].to_pylist()
        found = list(_alike([t for t, m in zip(texts, side, strict=True) if m], [t for t, m in zip(texts, side, strict=True) if not m], least))
        return pa.table({"a": pa.array([a for a, _ in found], pa.string()), "b": pa.array([b for _, b in found], pa.string())})

    tasks = min(cells, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, "p", "q").groupBy("p", "q").applyInArrow(compared, "a string, b string")


def candidate_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """Distinct (left_id, right_id) that may reach MATCH, by full names or by surnames.

    ``left`` and ``right`` come from ``keyed_names`` with the prefixes ``d`` and ``r``. Texts are paired once each,
    however many names have them; surnames' ratios are measured before names meet.
    """
    found = None
    for part, least in (("all", MATCH), ("sur", SURNAME_NEEDED)):
        d, r = (x.select(F.col(k).alias("key"), F.col(f"{side}_{part}").alias("text")).where("text <> ''") for x, k, side in ((left, left_id, "d"), (right, right_id, "r")))
        near = save(_near_texts(*(save(x.select("text").distinct(), "texts") for x in (d, r)), least), "near")
        pairs = d.select(F.col("key").alias(left_id), F.col("text").alias("a")).join(near, "a").join(r.select(F.col("key").alias(right_id), F.col("text").alias("b")), "b").select(left_id, right_id)
        found = pairs if found is None else found.unionByName(pairs)
    return found.distinct()


def score_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` of keyed names with s_sur and score, declared name first."""
    first = lambda c: F.substring_index(c, " ", 1)
    holds = lambda tokens, word: (word != "") & F.array_contains(F.split(tokens, " "), word)
    scored = pairs.withColumns({"s_all": ratio("d_all", "r_all"), "s_sur": ratio("d_sur", "r_sur"), "_nom": ratio("d_nom", "r_nom")})
    shared = holds(F.col("r_tokens"), first("d_tokens")) | holds(F.col("d_tokens"), first("r_tokens"))
    nom = F.greatest("_nom", shared.cast("double"))
    return scored.withColumn("score", F.greatest("s_all", SURNAME_WEIGHT * F.col("s_sur") + NAME_WEIGHT * nom)).drop("_nom")


def match_people(declared: DataFrame, roster: DataFrame) -> DataFrame:
    """``declared(nombre, apellidos, ...)`` with person_id and score of the roster's best match, or nulls.

    ``roster(id, nombre, apellidos, roster_pos)``; of equal scores the first position counts. A score of 0.84 is a
    match; else a surname of ratio 0.92 that no other person has. Blank names (null, empty or without letters) match
    nobody. Distinct names of both sides are matched once and joined back: first those that nothing can beat (the same
    full name, or the same surname and a forename in common), then the rest by blocks that lose no match.
    """
    spark = declared.sparkSession
    with scratch(spark):
        names = declared.select(F.coalesce("nombre", F.lit("")).alias("_n"), F.coalesce("apellidos", F.lit("")).alias("_a")).where("_n <> '' or _a <> ''").distinct()
        left = save(keyed_names(names.withColumn("_key", F.xxhash64("_n", "_a")), "_n", "_a", "d"), "declared")
        known = keyed_names(roster.select("id", "nombre", "apellidos", "roster_pos"), "nombre", "apellidos", "r")
        texts = [c for c in known.columns if c.startswith("r_")]
        known = known.groupBy(*texts).agg(F.min(F.struct("roster_pos", "id")).alias("first"), F.count("*").alias("people"))
        right = save(known.withColumn("_to", F.xxhash64(*texts)), "roster")

        word = lambda side: F.nullif(F.substring_index(f"{side}_tokens", " ", 1), F.lit(""))
        tokens = lambda side: F.array_distinct(F.split(f"{side}_tokens", " "))
        mine, theirs = left.where("d_sur <> ''").select("_key", F.col("d_sur").alias("sur"), word("d").alias("first_word"), F.explode(tokens("d")).alias("word")), right.where("r_sur <> ''").select(F.col("r_sur").alias("sur"), word("r").alias("first_word"), F.explode(tokens("r")).alias("word"), "first")
        sure = [
            left.where("d_all <> ''").select("_key", F.col("d_all").alias("r_all")).join(right.select("r_all", "first"), "r_all").select("_key", "first"),
            mine.select("_key", "sur", F.col("first_word").alias("word")).distinct().join(theirs.select("sur", "word", "first"), ["sur", "word"]).select("_key", "first"),
            mine.select("_key", "sur", "word").join(theirs.select("sur", F.col("first_word").alias("word"), "first").distinct(), ["sur", "word"]).select("_key", "first"),
        ]
        sure = save(sure[0].unionByName(sure[1]).unionByName(sure[2]).groupBy("_key").agg(F.min("first").alias("first")), "sure")
        rest = save(left.join(sure, "_key", "left_anti"), "rest")
        scored = score_pairs(candidate_pairs(rest, right, "_key", "_to").join(rest, "_key").join(right, "_to"))
        best = F.max(F.struct("score", (-F.col("first.roster_pos")).alias("p"), F.col("first.id").alias("id")))
        same = F.col("s_sur") >= SURNAME_MATCH
        told = scored.groupBy("_key", "_a").agg(best.alias("best"), F.sum(F.when(same, F.col("people"))).alias("same"), F.max(F.when(same, F.struct("first.id", "score"))).alias("only"))
        chosen = F.when(F.col("best.score") >= MATCH, F.struct("best.id", "best.score")).when((F.col("_a") != "") & (F.col("same") == 1), F.struct("only.id", "only.score"))
        told = told.select("_key", chosen.alias("m")).where("m is not null").unionByName(sure.select("_key", F.struct("first.id", F.lit(1.0).alias("score")).alias("m")))
        told = save(left.select("_key", "_n", "_a").join(told, "_key").drop("_key"), "matched", keep=True)
    keyed = declared.withColumns({"_n": F.coalesce("nombre", F.lit("")), "_a": F.coalesce("apellidos", F.lit(""))})
    return keyed.join(told, ["_n", "_a"], "left").select(*declared.columns, F.col("m.id").alias("person_id"), F.col("m.score").alias("score"))


def _next_rows(open_: DataFrame, rows: DataFrame) -> DataFrame:
    """(key, at): the first of a name's rows after ``open_(key, after)``."""
    return rows.join(open_, "key").where(F.col("o") > F.col("after")).groupBy("key").agg(F.min("o").alias("at"))


def _elect(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(key, one, two): when the first and the second person was made of each name, for ``rows(key, o)`` in order of o.

    ``links(key, to, hit, sur)``: a row of ``key`` joins a person made of ``to`` before it by its score (hit), or by its
    surname if only one such person is there (sur). A row that joins nobody makes a person. A name that joins by its score
    is done. One that joins by its surname stays so until a name that it depends on, through others of its kind, makes a
    person: it goes on behind the earliest row where that may be, or is done. The rest make a person in the first round
    where no such row is before theirs; the earliest of all always does. A name is open until none of its later rows can
    make a first or second person, so that rounds don't grow with the rows of a name.
    """
    own = links.where("key = to").select("key", "hit")
    now = rows.groupBy("key").agg(F.min("o").alias("at")).join(own, "key", "left")
    never = F.lit(None).cast(dict(rows.dtypes)["o"])
    now = save(now.select("key", "at", never.alias("one"), never.alias("two"), F.coalesce("hit", F.lit(False)).alias("knows_itself")), "names")
    others = links.where("key <> to").select("key", "to")
    earlier = lambda c: F.coalesce(F.col(c) < F.col("at"), F.lit(False))
    while True:
        there = now.select(F.col("key").alias("to"), F.col("one").alias("to_one"), F.col("two").alias("to_two"))
        later = lambda c: F.when(F.col(c) > F.col("at"), F.col(c))
        seen = now.where("at IS NOT NULL").select("key", "at").join(links, "key").join(there, "to").groupBy("key").agg(
            F.coalesce(F.bool_or(F.col("hit") & earlier("to_one")), F.lit(False)).alias("joins"), F.min(F.least(later("to_one"), later("to_two"))).alias("later"),
            F.sum(F.when(F.col("sur"), earlier("to_one").cast("int") + earlier("to_two").cast("int")).otherwise(0)).alias("same"),
        )
        told = now.join(seen, "key", "left").withColumns({"joins": F.coalesce("joins", F.lit(False)), "rests": F.coalesce(F.col("same") == 1, F.lit(False))})
        # when the first person may be made that changes what a name does: by itself, or by those that it depends on
        told = save(told.where("at IS NOT NULL AND NOT joins").select("key", "at", "rests", F.when(F.col("rests"), F.col("later")).otherwise(F.col("at")).alias("may")), "open")
        while True:
            near = others.join(told.select(F.col("key").alias("to"), F.col("may").alias("to_may")), "to").groupBy("key").agg(F.min("to_may").alias("before"))
            after = save(told.select("key", "at", "rests", "may").join(near, "key", "left").withColumn("was", F.col("may")).withColumn("may", F.when(F.col("rests"), F.least("may", "before")).otherwise(F.col("may"))), "open")
            drop(told)
            told = after
            if told.where("NOT (may <=> was)").isEmpty():
                break
        told = told.select("key", F.lit(True).alias("open"), "rests", "may", "before")
        told = now.join(told, "key", "left").withColumn("open", F.coalesce("open", F.lit(False)))
        leads = F.col("open") & ~F.col("rests") & ~F.coalesce(F.col("before") < F.col("at"), F.lit(False))
        told = told.withColumn("leads", F.coalesce(leads, F.lit(False))).withColumns({
            "one": F.when(F.col("leads") & F.col("one").isNull(), F.col("at")).otherwise(F.col("one")), "two": F.when(F.col("leads") & F.col("one").isNotNull(), F.col("at")).otherwise(F.col("two")),
        })
        stays = F.col("open") & ~F.col("leads") & (~F.col("rests") | F.coalesce(F.col("may") < F.col("at"), F.lit(False)))
        # a name that doesn't know itself may make a second person; one that rests goes on where something changes
        more = F.when(F.col("leads") & ~F.col("knows_itself") & F.col("two").isNull(), F.col("at")).when(F.col("open") & F.col("rests") & F.col("two").isNull() & ~stays, F.col("may"))
        told = told.select("key", F.when(stays, F.col("at")).alias("at"), "one", "two", "knows_itself", more.alias("after"))
        nexts = _next_rows(told.where("after IS NOT NULL").select("key", "after"), rows)
        after = save(told.join(nexts.withColumnRenamed("at", "next"), "key", "left").select("key", F.coalesce("at", "next").alias("at"), "one", "two", "knows_itself"), "names")
        drop(now)
        now = after
        if now.where("at IS NOT NULL").isEmpty():
            return now.select("key", "one", "two")


def resolve_unmatched(declarations: DataFrame) -> DataFrame:
    """``declarations(decl_id, nombre, apellidos, sello, ord, ...)`` that match nobody, with the person that they make: (decl_id, leader, person_id, nombre, apellidos).

    In the order of ``ord`` (then of decl_id) each joins the best person made before it, by the rules of
    ``match_people``, or makes one; a person without a name is stored with a text in its place. Blank ones make a person
    each. Names that the rules accept, in either direction, are linked; rounds of joins settle which rows make a person,
    each distinct name once or twice, and every row is then given to the best of the people before it: no task ever holds
    a group of names.
    """
    spark = declarations.sparkSession
    kind = dict(declarations.dtypes)["decl_id"]
    with scratch(spark):
        kept = declarations.select("decl_id", "nombre", "apellidos", "sello", F.struct("ord", "decl_id").alias("o"))
        stored = F.when(F.trim(F.coalesce("nombre", F.lit(""))) == "", NO_NAME).otherwise(F.col("nombre"))
        both = keyed_names(keyed_names(kept.withColumn("_stored", stored), "nombre", "apellidos", "d"), "_stored", "apellidos", "r")
        texts = [c for c in both.columns if c[:2] in ("d_", "r_")]
        both = save(both.withColumn("key", F.xxhash64(*texts)), "names")
        names = save(both.where("d_all <> ''").select("key", *texts).distinct(), "distinct")
        left, right = names.select("key", *(c for c in texts if c[0] == "d")), names.select(F.col("key").alias("to"), *(c for c in texts if c[0] == "r"))
        near = candidate_pairs(left, right, "key", "to").unionByName(names.select("key", F.col("key").alias("to"))).distinct()
        scored = score_pairs(near.join(left, "key").join(right, "to")).select("key", "to", "score", (F.col("score") >= MATCH).alias("hit"), ((F.col("d_sur") != "") & (F.col("s_sur") >= SURNAME_MATCH)).alias("sur"))
        links = save(scored.where("hit OR sur"), "links")
        rows = both.where("d_all <> ''").select("key", "decl_id", "o")
        made = save(_elect(rows.select("key", "o"), links), "made")

        # of the people that a name's score accepts, the best before a row; else the only one of its surname
        people = links.join(made.withColumnRenamed("key", "to"), "to").where("one IS NOT NULL")
        hits = people.where("hit").groupBy("key").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("one").alias("o")))).alias("hits"))
        both_times = people.where("sur").select("key", F.explode(F.array("one", "two")).alias("o")).where("o IS NOT NULL")
        two = Window.partitionBy("key").orderBy("o")
        sames = both_times.withColumn("n", F.row_number().over(two)).where("n <= 2").groupBy("key").agg(F.min("o").alias("same"), F.max(F.when(F.col("n") == 2, F.col("o"))).alias("second"))
        led = rows.join(hits, "key", "left").join(sames, "key", "left")
        best = F.get(F.filter("hits", lambda h: h["o"] < F.col("o")), F.lit(0))["o"]
        only = F.when((F.col("same") < F.col("o")) & F.coalesce(F.col("second") >= F.col("o"), F.lit(True)), F.col("same"))
        led = led.select("decl_id", F.coalesce(best, only, F.col("o"))["decl_id"].cast(kind).alias("leader"))
        led = led.unionByName(both.where("d_all = ''").select("decl_id", F.col("decl_id").alias("leader")))
        heads = kept.select(F.col("decl_id").alias("leader"), title_case_name("nombre").alias("_n"), title_case_name("apellidos").alias("apellidos"), "sello")
        named = heads.select("leader", slug_id("apellidos", "_n", "sello").alias("person_id"), F.when(F.col("_n") == "", NO_NAME).otherwise(F.col("_n")).alias("nombre"), "apellidos")
        return save(led.join(named, "leader").select("decl_id", "leader", "person_id", "nombre", "apellidos"), "former", keep=True)


def union_people(roster: DataFrame, former: DataFrame) -> DataFrame:
    """Active people of the roster and those that only declarations know."""
    own = roster.withColumn("en_activo", F.lit(True))
    return own.unionByName(former.withColumn("en_activo", F.lit(False)), allowMissingColumns=True)


def assemble_people(people: DataFrame, current: DataFrame, summary: DataFrame, history: DataFrame) -> DataFrame:
    """One row for each of ``people(id, en_activo, ...)``: role, declaration in force, summary and history, or nulls."""
    role = F.when(F.col("en_activo"), "Diputado/a").otherwise("Exdiputado/a")
    out = people.withColumn("cargo", role).join(current.withColumnRenamed("person_id", "id"), "id", "left").join(summary, "decl_id", "left")
    return out.join(history.withColumnRenamed("person_id", "id"), "id", "left")
