"""Pairs of alike texts against brute force, and how many of them are measured."""

import random
from difflib import SequenceMatcher

from patrimonia.operators import people


def brute(left, right, least):
    return {(a, b) for a in left for b in right if SequenceMatcher(None, a, b).ratio() >= least - 1e-9}


def texts(rng, letters, n, size):
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(1, size))) for _ in range(n)]


def test_alike_is_exact():
    rng = random.Random(1)
    for letters, size in (("ABC", 12), ("ABCDEFGHIJ", 30), ("AÑ€😀X", 70), ("AB0", 150)):
        left = list(dict.fromkeys(texts(rng, letters, 90, size)))
        right = list(dict.fromkeys(texts(rng, letters, 90, size) + [x[: len(x) // 2] + x[len(x) // 2 + 1 :] for x in left if len(x) > 1]))
        for least in (people.MATCH, people.SURNAME_NEEDED):
            got = list(people._alike(left, right, least))
            assert len(got) == len(set(got)) and set(got) == brute(left, right, least)
    assert list(people._alike([], ["A"], 0.84)) == list(people._alike(["A"], [], 0.84)) == []
    long = "".join(chr(0x4E00 + i) for i in range(5000))
    assert set(people._alike([long, "A"], [long[1:], "A"], 0.84)) == {(long, long[1:]), ("A", "A")}


def test_names_of_one_surname_are_hardly_measured(spark, monkeypatch):
    """Pairs that share their surname share most pairs of characters, but only the alike ones are worth a ratio."""
    rng, measured = random.Random(2), []

    class Counted(SequenceMatcher):
        def ratio(self):
            measured.append(1)
            return super().ratio()

    monkeypatch.setattr(people, "SequenceMatcher", Counted)
    names = ["GARCIALOPEZ" + "".join(rng.choice("0123456789ABCDEF") for _ in range(12)) for _ in range(300)]
    got = set(people._alike(names, names, people.SURNAME_NEEDED))
    assert got == brute(names, names, people.SURNAME_NEEDED) and len(measured) < 0.02 * 300 * 300
    monkeypatch.undo()
    monkeypatch.setattr(people, "LIST_ROWS", 64)
    left, right = (spark.createDataFrame([(x,) for x in names[part]], "text string") for part in (slice(200), slice(100, 300)))
    assert {tuple(r) for r in people._near_texts(left, right, people.SURNAME_NEEDED).collect()} == brute(names[:200], names[100:], people.SURNAME_NEEDED)


def test_rounds_do_not_grow_with_the_rows_of_names_that_rest(spark, monkeypatch):
    """Two names that join the one person of their surname, in turn: no row of theirs can change what the other's do."""
    saved, save = [], people.save
    monkeypatch.setattr(people, "save", lambda df, name, keep=False: saved.append(name) or save(df, name, keep))
    given = [("Ana", "Puig Soler")] + [("Xavier", "Puig Soler"), ("Oriol", "Puig Soler")] * 10
    rows = spark.createDataFrame([(i, a, b, "S", i) for i, (a, b) in enumerate(given)], "decl_id long, nombre string, apellidos string, sello string, ord long")
    assert {r.leader for r in people.resolve_unmatched(rows).collect()} == {0}
    assert saved.count("names") <= 6
