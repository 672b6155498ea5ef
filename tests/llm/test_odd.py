"""Inputs that an operator once couldn't take: an item larger than a block, query rows that share an id, unseen
languages, targets out of reach, one document on a third of the rows."""

import random
import time
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from patrimonia.llm import langid, mixing, pii, sharding
from patrimonia.llm.decontaminate import contaminated
from patrimonia.llm.maxscore import top_k


def test_an_item_larger_than_a_block_is_found(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long, short = text(300), text(30)
    halves = long.split()
    docs = [(1, f"{text(50)} {long} {text(50)}"), (2, " ".join(halves[:260])), (3, " ".join(halves[:150])), (4, short), (5, None), (6, "a b"), (1, long), (7, f"{short} {long}")]
    items = [(10, long), (11, short), (12, "a b"), (13, None), (10, "a b")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, contaminated(d, i).collect()))
    assert sorted(map(tuple, contaminated(d, i, block_shingles=100).collect())) == whole
    assert {r[:2] for r in whole} >= {(1, 10), (2, 10), (7, 10), (4, 11), (7, 11), (6, 12)} and (3, 10) not in {r[:2] for r in whole} and len([r for r in whole if r[:2] == (1, 10)]) == 2


def test_query_rows_that_share_an_id_ask_the_smallest_vector_in_every_order(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), *((i, [float(i), float(10 - i)]) for i in range(1, 10))]
    told = []
    for given in (rows, rows[::-1]):
        got = top_k(spark.createDataFrame(given, "vec_id long, embedding array<float>").coalesce(1), k=3)
        told.append(sorted((r["rank"], r.vec_id) for r in got.collect() if r.query_id == 0))
    assert told[0] == told[1] == [(1, 1), (2, 2), (3, 3)]


def test_unseen_languages_and_noise_are_rejected(spark):
    rng = random.Random(5)
    parts = {"en": ["the", "and", "ing", "tion", "wh"], "fr": ["eau", "que", "é", "oi", "leur"], "de": ["sch", "ung", "ä", "ein", "pf"]}
    strange = {"fi": ["kkä", "yys", "lla", "uo", "hti"], "hu": ["ség", "nak", "gy", "őz", "tek"]}
    word = lambda bits: "".join(rng.choice(bits) for _ in range(rng.choice([1, 2, 3])))
    text = lambda bits: " ".join(word(bits) for _ in range(rng.choice([30, 100])))
    langs = [rng.choice(list(parts)) for _ in range(600)]
    rows = [(i, text(parts[k]), k) for i, k in enumerate(langs)]
    rows += [(1000 + i, text(strange["fi" if i % 2 else "hu"]), None) for i in range(40)]
    rows += [(2000 + i, "".join(rng.sample(t := text(parts["en"]), len(t))), None) for i in range(20)]
    rows += [(3000, "すべての人間は、生まれながらにして自由であり", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.predict_language(docs).collect()}
    assert all(got[i].rejected for i in got if i >= 1000)
    assert sum(got[i].rejected for i in range(600)) <= 3
    assert all(got[i].lang_pred == langs[i] for i in range(600) if not got[i].rejected)


def test_rows_that_repeat_one_doc_id_do_not_widen_the_training_sample(spark):
    one = next(i for i in range(100) if spark.range(i, i + 1).select(langid.fold_of_training(F.col("id"))).first()[0])
    rows = [(one, f"texto {i}", "es") for i in range(3000)] + [(one, "igual", "es")] * 3000 + [(i, f"otro {i}", "es") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    chosen = langid.sample(docs, 200).collect()
    assert 120 < len(chosen) < 300 and len(set(chosen)) == len(chosen)
    assert len({r.doc_id for r in chosen}) > 40


def nearest(p, n, goal):
    """The smallest distance of the goal from totals that some rates of 0 or more give: three documents are enough."""
    columns, best = (p * n[:, None]).T, np.inf
    for size in (1, 2, 3):
        for chosen in combinations(range(len(n)), size):
            rate = np.linalg.lstsq(columns[:, chosen], goal, rcond=None)[0]
            if (rate >= 0).all():
                best = min(best, np.linalg.norm(columns[:, chosen] @ rate - goal))
    return best


def test_rates_come_as_near_to_targets_as_rates_can(spark):
    rng = np.random.default_rng(5)
    p, n = rng.dirichlet([1, 1, 1], 40), rng.integers(1, 400, 40)
    members = spark.createDataFrame([(int(a), [float(x) for x in row]) for a, row in zip(n, p, strict=True)], "n_tokens long, p array<double>").coalesce(1)
    for shares in ((0.1, 0.1, 0.8), (0.02, 0.96, 0.02), (0.001, 0.001, 0.998)):
        out, _ = mixing.fit_rates(members, dict(zip(mixing.DOMAINS, shares, strict=True)))
        rows = out.collect()
        sums, goal = np.sum([np.array(r.p) * r.n_tokens * r.rate for r in rows], axis=0), np.array(shares) * n.sum()
        assert all(r.rate >= 0 for r in rows)
        assert np.linalg.norm(sums - goal) <= nearest(p, n.astype(float), goal) + 2e-4 * n.sum(), shares


def test_rows_that_repeat_one_document_fill_many_windows(spark, monkeypatch):
    rows = [(7, "igual")] * 400 + [(i, f"texto {i}") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    windows = []
    save = sharding.save
    monkeypatch.setattr(sharding, "save", lambda df, name: windows.append(save(df, name)) or windows[-1])
    got = sharding.shard_documents(docs).collect()
    counts, slots = {}, set()
    for r in got:
        counts[r.shard] = counts.get(r.shard, 0) + 1
        slots.add((r.shard, r.slot))
    assert len(got) == 1200 and set(counts.values()) == {75} and len(slots) == 1200
    dealt = next(t for t in windows if "window" in t.columns and "row" in t.columns)
    same = [r["n"] for r in dealt.where("doc_id = 7").groupBy("shard", "window").agg(F.count("*").alias("n")).collect()]
    assert len(same) >= 8 and max(same) < 400 / 4


def _cards(rng, n):
    """Texts with a number and an address in two prints, and others in one."""
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    return [f"call +34{(p := digits(9))} or {p}, write u{(k := digits(3))}@mail.org or u{k} (at) mail (dot) org, ref {digits(7)} tel {digits(9)}" for _ in range(n)]


def test_a_megabyte_of_numbers_takes_seconds_and_keeps_its_spans():
    rng = random.Random(4)
    field = pii.train(_cards(rng, 50))
    numbers = ["6" + "".join(rng.choice("0123456789") for _ in range(8)) for _ in range(50_000)]
    text = "\n".join(f"+34{n}" for n in numbers[:1000]) + "\n" + "\n".join(numbers) + "\n" + "\n".join(numbers[::-1])
    assert len(text) > 1_000_000
    base, start = pii.base_spans(text), time.process_time()
    added = pii.added_spans(text, base, field)
    assert time.process_time() - start < 20
    assert len(base) == 1000 and all(not (a < y and x < b) for (_, a, b), (_, x, y) in zip(added, base))
    shown = {text[a:b] for _, a, b in added}
    assert set(numbers[:1000]) <= shown


def test_messages_equal_those_summed_edge_by_edge():
    rng = random.Random(6)
    field = pii.train(_cards(rng, 50))
    for text in [*(" ".join(_cards(rng, k)) for k in (1, 2, 4) * 5), "", "a@b.co", "12345678"]:
        nodes = pii.Nodes(text, pii.base_spans(text))
        got, n = field.marginals(nodes), len(nodes.start)
        unary = np.exp(nodes.features @ field.weights.astype(float))
        unary /= unary.sum(axis=1, keepdims=True)
        for i, known in enumerate(nodes.known):
            if known >= 0:
                unary[i] = np.exp(-30.0)
                unary[i, known] = 1
        hubs = [np.ones(pii.LABELS) for _ in range(nodes.hub.max(initial=-1) + 1)]
        for h in range(len(hubs)):
            told = nodes.known[(nodes.hub == h) & (nodes.known >= 0)]
            if len(told):
                hubs[h] = np.maximum(np.bincount(told, minlength=pii.LABELS), 1e-13) / len(told)
        local = [*unary, *hubs]
        edges = [(i, i + 1, np.exp(field.chain)) for i in nodes.chain] + [(i, n + h, np.exp(field.skip)) for i, h in enumerate(nodes.hub) if h >= 0]
        sent = {(a, b): np.full(pii.LABELS, 1 / pii.LABELS) for x, y, _ in edges for a, b in ((x, y), (y, x))}
        at = lambda i, but=None: local[i] * np.prod([m for (a, b), m in sent.items() if b == i and a != but] or [np.ones(pii.LABELS)], axis=0)  # noqa: B023, E731
        for _ in range(60):
            new = {(x, y): at(x, y) @ p for x, y, p in edges} | {(y, x): p @ at(y, x) for x, y, p in edges}
            sent = {k: m / m.sum() for k, m in new.items()}
        for i in range(n):
            assert np.allclose(got[i], at(i) / at(i).sum(), atol=2e-3), text


def test_addresses_longer_than_mail_allows_are_no_mentions():
    field = pii.train(_cards(random.Random(4), 50))
    for local, names in (("a" * 65, "mail (dot) org"), ("ana", "m" * 256 + " (dot) org"), ("a" * 300_000, "mail (dot) org")):
        nodes = pii.Nodes(f"{local} (at) {names} y {local} (at) {names}", [])
        assert not len(nodes.start)
    text = f"{'a' * 64} (at) mail (dot) org"
    nodes = pii.Nodes(text, [])
    assert list(zip(nodes.start, nodes.end)) == [(0, len(text))]
    assert field is not None


def test_repeated_rows_count_once_in_the_field(spark):
    rows = list(enumerate(_cards(random.Random(8), 40)))
    fields = [pii.learn(spark.createDataFrame(r, "doc_id long, text string").repartition(3)) for r in (rows, rows + rows, rows + rows[:1] * 50)]
    for f in fields[1:]:
        assert np.array_equal(f.weights, fields[0].weights) and np.allclose(f.chain, fields[0].chain) and np.allclose(f.skip, fields[0].skip)
