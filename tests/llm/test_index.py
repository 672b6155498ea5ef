"""Ranked search, exact duplicates and the Merkle manifest against plain Python, and on odd rows."""

import math
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from patrimonia.llm.exactdup import exact_duplicates, hash_128
from patrimonia.llm.lexical import ranked_search
from patrimonia.llm.merkle import fold, merkle_manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def plain_duplicates(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            out[i, keep, len(ids), i == keep, sha256(text.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("hashed", [hash_128, lambda t: F.unhex(F.substring(F.md5(t.cast("binary")), 1, 1)), lambda t: F.lit(b"")])
def test_exact_duplicates_are_told_by_their_bytes(spark, hashed):
    random.seed(5)
    texts = ["", None, " ", "a b", "a\t\n b", "a\x0bb", "a b ", "A b", "a b", "é", "é", "x" * 200_000, "x" * 199_999 + "y"]
    rows = [(random.choice([*range(60), None]), random.choice(texts)) for _ in range(300)]
    rows += [(1000 + i, "a third of all rows") for i in range(150)]
    df = spark.createDataFrame([(*r, 1, 2, "k") for r in rows], "doc_id long, text string, hash int, group_size int, keep_id string").repartition(7)
    assert rows_of(exact_duplicates(df, hashed)) == plain_duplicates(rows)


def test_exact_duplicates_of_nothing(spark):
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_search(docs, items, k=10):
    held = [(d, Counter(plain_terms(t))) for d, t in docs if plain_terms(t)]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    asked = defaultdict(Counter)
    for i, t in items:
        asked[i].update(plain_terms(t))
    out = Counter()
    for i, query in asked.items():
        found = []
        for d, c in held:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // length
            weigh = lambda w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
            score = sum(times * weigh(w) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m)) for w, times in query.items() if c[w])
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        for rank, (score, _, _, d) in enumerate(sorted(found)[:k], 1):
            out[i, rank, d, -score] += 1
    return out


def test_ranked_search_equals_plain_scores(spark):
    random.seed(6)
    words = ["Uno", "dos", "tres", "Ünder", "ünder", "x1", "zz", "the", "THE", "ÀB", "cd", "e_f", "g-h"]
    docs = [(i, " ".join(random.choices(words, k=random.choice([0, 1, 3, 30])))) for i in range(120)]
    docs += [(None, "uno dos"), (None, None), (7, "uno dos"), (7, "uno dos"), (900, "the " * 40_000), (901, " .,;\n"), (902, None), (903, "")]
    docs += [(1000 + i, "same words here zz") for i in range(40)]
    items = [(1, "uno dos tres"), (1, "uno"), (2, "The the THE under ünder"), (3, None), (4, ""), (5, "nowhere"), (None, "zz zz x1"), (6, "g h e f àb"), (6, "g h e f àb"), (7, "same words")]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, term int, row string").repartition(5)
    q = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, score int")
    assert rows_of(ranked_search(d, q)) == plain_search(docs, items)
    assert rows_of(ranked_search(d, q, k=3)) == plain_search(docs, items, 3)


def test_ranked_search_by_shuffled_items_is_the_same(spark, monkeypatch):
    import patrimonia.llm.lexical as lexical

    docs = spark.createDataFrame([(i, f"w{i % 7} common w{i % 3}") for i in range(200)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"w{i} common w1") for i in range(9)], "item_id long, text string")
    whole = rows_of(ranked_search(docs, items))
    monkeypatch.setattr(lexical, "SENT_TERMS", 0)
    assert rows_of(ranked_search(docs, items)) == whole


def test_ranked_search_in_empty_tables(spark):
    none, one = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "doc_id long, text string")
    no_items, item = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search(none, item).collect() == ranked_search(one, no_items).collect() == ranked_search(none, no_items).collect() == []
    assert [tuple(r)[:3] for r in ranked_search(one, item).collect()] == [(1, 1, 1)]


def plain_manifest(rows, chosen, fan=8):
    h = lambda *x: sha256("".join(x).encode()).hexdigest()
    sized = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    digest = lambda d, text: h(*(sized(v) for v in (d[0], d[3], d[2], d[4], text)))

    def tree(nodes):
        """The root and each node's levels of (before, after)."""
        steps, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
        while len(level) > 1:
            for i, a in enumerate(at):
                run = level[a // fan * fan : a // fan * fan + fan]
                steps[i].append((run[: a % fan], run[a % fan + 1 :]))
            level, at = [h(*level[i : i + fan]) for i in range(0, len(level), fan)], [a // fan for a in at]
        return level[0], steps

    groups = defaultdict(list)
    for d in rows:
        groups[d[2]].append((d[0] is not None, d[0] or 0, digest(d, d[1]), d))
    if not groups:
        return Counter()
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    told = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, upper = tree([told[g][0] for g in names])
    out = Counter()
    for g, above in zip(names, upper, strict=True):
        for (_, _, leaf, d), below in zip(sorted(groups[g], key=lambda x: x[:3]), told[g][1], strict=True):
            claimed = digest(d, d[1].translate(LOWER)) if d[1] is not None and chosen(d[0]) else leaf
            proof = ""
            for left, right in [*below, *above]:
                claimed, proof = h(*left, claimed, *right), proof + "".join(left + right)
            out[d[0], leaf, told[g][0], root, h(proof), claimed, claimed == root] += 1
    return out


def manifest(df, **settings):
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    told = merkle_manifest(df, claims={"text": F.when(F.col("doc_id") % 3 == 0, lowered).otherwise(F.col("text"))}, **settings)
    return told.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def chosen(doc_id):
    return doc_id is not None and doc_id % 3 == 0


@pytest.mark.parametrize("settings", [{}, {"block_levels": 1, "top_nodes": 3}, {"block_levels": 2, "top_nodes": 1, "proofs": False}])
@pytest.mark.parametrize("langs", [["en", None, "", "é", "z"], [f"l{i}" for i in range(70)]])
def test_manifest_equals_plain_trees(spark, settings, langs):
    random.seed(7)
    rows = [(random.choice([*range(300), None]), random.choice(["Abc", None, "", "no capital", "É x"]), random.choice(langs), random.choice([None, "s", "Ä"]), random.choice([None, 0, 12])) for _ in range(200)]
    rows += [(5, "Same", langs[0], "s", 1)] * 300  # over half of all rows alike
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS + ", tree int, pos string").repartition(6)
    assert rows_of(manifest(df, **settings)) == plain_manifest(rows, chosen)


def test_manifest_of_one_row_of_nothing_and_of_full_runs(spark):
    assert manifest(spark.createDataFrame([], DOCS)).collect() == []
    for n in (1, 2, 8, 9, 64, 65):
        rows = [(i, "T" * i, "en", "s", i) for i in range(n)]
        assert rows_of(manifest(spark.createDataFrame(rows, DOCS), block_levels=1, top_nodes=2)) == plain_manifest(rows, chosen), n


def test_a_proof_folds_to_the_root_only_with_its_row(spark):
    rows = [(i, f"text {i}", "en" if i % 3 else "fr", "s", i) for i in range(90)]
    for r in merkle_manifest(spark.createDataFrame(rows, DOCS)).collect():
        places = list(zip(r.places[::2], r.places[1::2], strict=True))
        assert fold(r.leaf, places, r.siblings) == r.root == r.folded_root
        assert fold(sha256(b"other").hexdigest(), places, r.siblings) != r.root
