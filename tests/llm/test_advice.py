"""What a review found missing: each test would have failed before its finding was settled."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from patrimonia.llm import linedup, neardup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows], DOCS)


def mixed(rng, kind, n):
    return " ".join(rng.choice({"good": "libro casa cielo a b c", "toxic": "maldito bobo a b"}[kind].split()) for _ in range(n))


def edited(rng, words, k):
    spots = set(rng.sample(range(len(words)), k))
    return [w if i not in spots else f"e{rng.randrange(10**9)}" for i, w in enumerate(words)]


def components_of(rows):
    """The smallest id that links of similarity 0.8 reach from each."""
    sets = {i: frozenset(tuple(w[k : k + 5]) for w in [t.split()] for k in range(len(w) - 4)) for i, t in rows}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
    return root


def test_near_copies_just_unlike_make_no_rows_of_pairs(spark, monkeypatch):
    """A crowd of edits of one text, most of them a little less alike than is asked for: tables grow with the texts, not with their pairs."""
    rng = random.Random(12)
    base = [f"b{i}" for i in range(400)]
    rows = [(i, " ".join(edited(rng, base, rng.choice([5, 6, 6])))) for i in range(300)]
    written, save = {}, neardup.save
    monkeypatch.setattr(neardup, "save", lambda df, name: written.setdefault(name, []).append(save(df, name)) or written[name][-1])
    monkeypatch.setattr(neardup, "drop", lambda table: None)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(documents(spark, rows), percent=80).collect()}
    assert got == components_of(rows) and len(set(got.values())) > 20
    # a text meets the head of each of its bands
    assert [t.count() for name in ("pairs", "links", "ties") for t in written.get(name, []) if t.count() > neardup.layout(80)[0] * len(rows)] == []


def test_ties_of_a_bucket(spark, monkeypatch):
    """All members of a bucket, each a component of its own: the links found tie together what brute force does, in parts of the bucket too."""
    rng = random.Random(13)
    base = [f"b{i}" for i in range(300)]
    rows = [(i, " ".join(edited(rng, base, rng.choice([1, 3, 5])))) for i in range(120)]
    text = documents(spark, rows).select("doc_id", "text", F.xxhash64("text").alias("h"))
    form = "doc_id long, h long, n long, node long, bands array<long>, " + ", ".join(f"{x} long" for x in neardup.BITS)
    classes = text.mapInArrow(neardup._sketches(5, *neardup.layout(80)), form).withColumn("rep", F.struct("doc_id", "h")).cache()
    node = {r.node: r.doc_id for r in classes.collect()}
    for part in (25, 4096):
        monkeypatch.setattr(neardup, "LIST_NODES", part)
        for out in (F.lit(True), F.col("doc_id") > 0):
            rest = classes.select(F.lit(5).cast("long").alias("token"), F.col("node").alias("id"), F.col("node").alias("comp"), out.alias("out"))
            root = {i: i for i, _ in rows}
            ties = neardup._ties(rest, text, classes, 5, 80).collect()
            for a, b in ties:
                old, new = sorted((root[node[a]], root[node[b]]), reverse=True)
                root = {i: new if r == old else r for i, r in root.items()}
            assert root == components_of(rows) and 0 < len(ties) < (len(rows) if part > 1000 else 15 * len(rows))


def test_mixing_drops_few_toxic_documents(spark, tmp_path):
    """At 0.5 % of the tokens, and at less than the fit's tolerance, toxic documents go, and clean ones stay once each."""
    for clean, toxic, size in ((800, 4, 40), (1200, 2, 4)):
        rng = random.Random(clean)
        rows = [(i, mixed(rng, "good", 40 if size == 40 else 60)) for i in range(clean)] + [(10_000 + i, "maldito bobo " * (size // 2)) for i in range(toxic)]
        docs = documents(spark, rows)
        folder = str(tmp_path / str(clean))
        labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") >= 10_000).cast("int").alias("toxic"))
        labels.write.parquet(f"{folder}/labels.parquet")
        kept = sorted(r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, folder).collect())
        assert kept == list(range(clean))


def test_mixing_holds_shares_of_low_tokens(spark, tmp_path):
    """Low documents are thinned out or repeated up to their share of the copies' tokens; good ones all stay, and toxic ones go."""
    words = {"good": "libro casa cielo a b c", "low": "| --- | x1 a b", "toxic": "maldito bobo a b"}
    for good, low in ((600, 600), (1200, 60)):
        rng = random.Random(good)
        kinds = ["good"] * good + ["low"] * low + ["toxic"] * 60
        docs = documents(spark, [(i, " ".join(rng.choice(words[k].split()) for _ in range(rng.choice([40, 60])))) for i, k in enumerate(kinds)])
        folder = str(tmp_path / str(good))
        spark.createDataFrame([(i, int(k != "low"), int(k == "toxic")) for i, k in enumerate(kinds) if i % 2], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        tokens, seen = dict.fromkeys(words, 0), set()
        for r in corpus_pipeline.mix_sources(spark, docs, folder).collect():
            tokens[kinds[r.doc_id]] += len(r.text.split())
            seen.add(r.doc_id)
        assert abs(tokens["low"] / sum(tokens.values()) - 0.14) < 0.02 and tokens["toxic"] == 0
        assert sum(i in seen for i in range(good)) >= 0.99 * good


def jaccard(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_near_copies_from_eighty_percent(spark):
    """Pairs of similarity 0.80 to 0.85 lose their copy in the pipeline; those below 0.80 keep it."""
    rng = random.Random(3)
    rows, gone, similar = [], set(), []
    for i in range(60):
        w = [f"w{rng.randrange(10**6)}" for _ in range(204)]
        copy = list(w)
        for place in (20, 60, 100, 140) if i % 2 else (20, 60, 100, 140, 180):
            copy[place] = "otra"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(copy))]
        similar.append(jaccard(rows[-2][1], rows[-1][1]))
        gone |= {2 * i + 1} if similar[-1] >= 0.8 else set()
    assert len(gone) == 30 and all(0.8 <= s < 0.85 for s in similar[1::2])
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), "").collect()}
    assert kept == {i for i, _ in rows} - gone


def test_bands_and_bits_follow_percent():
    """Signatures of pairs at the limit itself: what differs stays within the bits, and bands meet."""
    for percent in (80, 85, 90):
        bands, rows = neardup.layout(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= 1.01e-7
    assert neardup.layout(85) == (28, 5)
    n, each = 3000, 180  # 160 of 200 elements shared
    rng = np.random.default_rng(1)
    whole = rng.integers(0, 2**63, (n, 200)).astype(np.uint64)
    bands, rows = neardup.layout(80)
    sides = []
    for part in (whole[:, :each], whole[:, 20:]):
        sides.append(neardup.superminhash(np.repeat(np.arange(n), each), np.sort(part, axis=1).ravel(), n, bands * rows))
    differ = np.bitwise_count(neardup._slot_bits(sides[0]) ^ neardup._slot_bits(sides[1])).sum(axis=1)
    assert differ.max() <= neardup.most_bits(80) and 24 < differ.mean() < 27
    met = (sides[0] == sides[1]).reshape(n, bands, rows).all(axis=2).any(axis=1)
    assert met.all()


def test_stages_judge_rows_by_their_own_text(spark, tmp_path):
    """Null and shared ids: copies, benchmark passages and toxic texts go, and clean documents stay, whatever their id."""
    rng = random.Random(6)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    base, passage, lone = text(100), text(60), [text(80) for _ in range(4)]
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, base), (None, base), (None, base), (5, base + " fin"), (7, lone[0]), (7, lone[1]), (None, lone[2]), (None, lone[3]), (8, None), (9, "")]
    kept = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), "").select("doc_id", "text").collect()]
    assert sorted(kept, key=str) == sorted([(1, base), (7, lone[0]), (7, lone[1]), (None, lone[2]), (None, lone[3]), (8, None), (9, "")], key=str)

    rows = [(None, passage), (7, text(30) + " " + passage), (7, lone[0]), (None, lone[1])]
    kept = [tuple(r) for r in corpus_pipeline.drop_benchmark_passages(spark, documents(spark, rows), str(tmp_path)).select("doc_id", "text").collect()]
    assert sorted(kept, key=str) == sorted([(7, lone[0]), (None, lone[1])], key=str)

    clean = [(i, mixed(rng, "good", 40)) for i in range(200)]
    toxic = [(1000 + i, "maldito bobo " * 20) for i in range(40)]
    rows = clean + toxic + [(None, "maldito bobo " * 15), (5000, "maldito bobo " * 18), (5000, "libro casa cielo " * 9), (None, "libro casa cielo " * 8)]
    labels = spark.createDataFrame([(i, 1, int(i >= 1000)) for i, _ in clean[::2] + toxic[::2]], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = [tuple(r) for r in corpus_pipeline.mix_sources(spark, documents(spark, rows), str(tmp_path)).select("doc_id", "text").collect()]
    assert sorted(kept, key=str) == sorted([*clean, *rows[-2:]], key=str)


def test_lines_of_rows_that_share_a_doc_id(spark):
    """Two texts under one id: each line keeps its own set, in whatever order the rows come; equal rows count once."""
    near = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, "uno dos tres\n" + near), (1, "cuatro cinco\notra cosa que nada tiene que ver"), (2, near + " lambda"), (3, "seis siete"), (3, "seis siete"), (4, "siete seis")]
    for order in (rows, rows[::-1]):
        got = {r.doc_id: r for r in linedup.line_duplicates(documents(spark, order)).collect()}
        assert (got[2].removed, got[2].n_links, got[1].n_links, got[1].n_lines) == ([0], 1, 1, 4)
        assert (got[3].n_lines, got[3].removed, got[4].removed, got[3].n_links) == (1, [], [0], 0)


def test_lines_in_parts_of_long_lists(spark, monkeypatch):
    """A crowd of lines that share their rarest word: parts of it are verified apart, and no link is lost or counted twice."""
    monkeypatch.setattr(linedup, "LIST_SETS", 7)
    rng = random.Random(4)
    base = [f"b{i}" for i in range(20)]
    rows = [(i, " ".join(w for k, w in enumerate(base) if k not in (drop := {rng.randrange(1, 20) for _ in range(2)})) + f" c{rng.randrange(3)}") for i in range(60)]
    sets = {t: frozenset(t.split()) for _, t in rows}
    links = {t: sum(o != t and len(sets[o] & sets[t]) * 100 >= 80 * len(sets[o] | sets[t]) for o in sets) for t in sets}
    got = {r.doc_id: r.n_links for r in linedup.line_duplicates(documents(spark, rows)).collect()}
    assert got == {i: links[t] for i, t in rows} and sum(got.values()) > 300


def test_stages_with_clashing_columns_and_empty_tables(spark, tmp_path):
    """Columns named as the stages' own, null ids, repeated rows: each stage returns the columns of its input, and nothing of nothing."""
    rng = random.Random(9)
    spark.createDataFrame([(1, " ".join(f"q{i}" for i in range(30)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    names = ("row", "key_of_row", "node", "copies", "rate", "copy", "col", "p", "n", "rejected", "score", "component_id", "shard")
    form = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in names)
    text = lambda: " ".join(rng.choice(["casa", "libro", "cielo", "verde", "agua", "tren", f"w{rng.randrange(10**6)}"]) for _ in range(60))
    rows = [(i if i % 7 else None, text(), "es", *names) for i in range(40)]
    rows += [rows[3], (50, None, None, *names), (51, "", "es", *names)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (spark.createDataFrame(rows, form), spark.createDataFrame([], form)):
            out = stage(spark, df, str(tmp_path))
            assert out.columns == df.columns, name
            got = out.collect()
            assert all(tuple(r[3:]) == names for r in got) and (not df.isEmpty() or not got), name
            assert df.isEmpty() or len(got) >= 39, name


def test_bitmaps_of_sets_count_no_more_than_they_differ_in():
    rng = np.random.default_rng(7)
    pool = rng.integers(0, 2**63, 900, dtype=np.uint64)
    sets = [rng.choice(pool[: 3 * n], n, replace=False) for n in [1, 2, 15, 16, 17, 33, 60, 128, 129, 250, 300]]
    size = np.array([len(x) for x in sets])
    bits, pieces = linedup._sketches(np.concatenate(sets), size)
    assert ((pieces * linedup.SKETCH_WORDS >= size) & (pieces & (pieces - 1) == 0)).all()
    sketches = linedup._Sketches(pa.table({"sketch": linedup._list_array(pieces, bits.view(np.int64))}), np.arange(len(sets)))
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    differ = np.array([len(set(sets[i]) ^ set(sets[j])) for i, j in zip(a, b, strict=True)])
    apart = sketches.apart(a, b)
    assert (apart <= differ).all() and (apart[a == b] == 0).all() and ((differ - apart) % 2 == 0).all()
    assert (apart[a != b] > 0).any()


def test_stars_take_no_rounds(spark, monkeypatch):
    """Edges that are stars when each partition has joined its own are written once; others take rounds, with the same components."""
    from patrimonia.llm import components as C

    rng, written, save = random.Random(3), [], C.save
    monkeypatch.setattr(C, "save", lambda df, name: written.append(name) or save(df, name))
    monkeypatch.setattr(C, "drop", lambda table: None)
    for parts, rounds in ((1, 0), (8, None)):
        edges = [(i, i + 1) for i in range(60)] + [(200 + rng.randrange(60), 200 + rng.randrange(60)) for _ in range(40)] + [(500, i) for i in range(501, 560)]
        rng.shuffle(edges)
        root = {x: x for e in edges for x in e if e[0] != e[1]}
        for a, b in edges:
            if a != b and root[a] != root[b]:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
        written.clear()
        got = C.components(spark.createDataFrame(edges, "a long, b long").repartition(parts), "a", "b").collect()
        assert len(got) == len(root) and {r.node: r.component for r in got} == root
        assert rounds is None or len(written) == 1 + rounds
    assert C.components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long"), "a", "b").count() == 0


def test_plain_words_are_the_same_words():
    """Words by pieces of eight bytes: as many as by prefix sums, equal where those are, of every length and at every place."""
    rng = random.Random(5)
    texts = [" ".join(("aB" * 80)[rng.randrange(2) : rng.randrange(1, 150)] for _ in range(40)) for _ in range(20)] + ["", None, " \tñ\n", "x" * 70 + "\r\n" + "X" * 70 + " " + "x" * 71]
    raw, at = neardup.W.text_bytes(pa.array(texts))
    word, _, _, first = neardup.W.words(raw, at)
    plain, own = neardup.W.plain_words(raw, at)
    pairs = set(zip(word.tolist(), plain.tolist(), strict=True))
    assert own.tolist() == first.tolist() and len(pairs) == len(set(word.tolist())) == len(set(plain.tolist()))
