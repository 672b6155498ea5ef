"""Soft-membership mixing: posteriors of domains from a labelled-table classifier, and document rates by least squares.

DataFrame operations and Spark's own classifier only. A document belongs to each domain by its posterior, so it
adds posterior * tokens * rate to the domain's expected total. Projected gradient steps fit nonnegative rates
to the domains' target totals: a step is two aggregations of a few sums for each domain.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrimonia.llm.store import drop, save

#: Labelled rows that the classifier is fitted on at most (about), by a hash of doc_id.
FIT_ROWS = 8_000
DOMAINS = ("good", "low", "toxic")
#: Shares of the mixed corpus's tokens. A mix may leave domains out: they keep the tokens that they have.
TARGETS: Mapping[str, float] = {"good": 0.85, "low": 0.14, "toxic": 0.01}
#: Steps after which the rates so far are written, so that a step's work doesn't grow with their number.
STEPS_KEPT = 6
FEATURES = 1 << 15
#: Parts of the step by the Gram matrix, and multiples of the plain gradient step, that one pass tries.
_PARTS, _TIMES = (1.0, 0.25, 0.0625), (1.0, 16.0, 256.0, 4096.0, 65536.0)


def domain_of(toxic: Column, quality: Column) -> Column:
    """Position in DOMAINS; null without a label."""
    return F.when(toxic == 1, 2).when(quality == 0, 1).when(toxic.isNotNull() | quality.isNotNull(), 0)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D.,;:!?]+"), lambda w: w != "")


def posteriors(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, n_tokens, p) for each row of ``docs``: p holds a posterior for each domain.

    Where a domain has no labelled document (or there are no labels) its posterior comes from what remains: with
    fewer than two domains seen, everything belongs to the one seen, or else to the first.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = text.select("doc_id", _words(F.col("text")).alias("words"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(domain_of(F.col("toxic"), F.col("quality"))).alias("label")).where("label is not null")
    total = known.count()
    few = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**30)) < int(min(1.0, fit_rows / max(1, total)) * 2**30)) if total > fit_rows else known
    few = save(few, "labelled")
    if few.count() > 2 * fit_rows:
        raise ValueError("the labelled sample is larger than its bound")
    hashed = HashingTF(inputCol="words", outputCol="features", numFeatures=FEATURES, binary=True)
    # one text of each doc_id, so that the bound is one of rows
    sample = text.join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").cast("double").alias("label"))
    sample = save(sample, "sample").select(_words(F.col("text")).alias("words"), "label")
    seen = sorted(int(x["label"]) for x in sample.select("label").distinct().collect())
    if len(seen) < 2:
        p = F.array(*(F.lit(1.0 if k == (seen or [0])[0] else 0.0) for k in range(len(DOMAINS))))
        return own.select("doc_id", F.size("words").cast("long").alias("n_tokens"), p.alias("p"))
    model = LogisticRegression(maxIter=40, regParam=0.002, family="multinomial").fit(hashed.transform(sample))
    scored = model.transform(hashed.transform(own)).withColumn("p", vector_to_array("probability"))
    p = F.array(*(F.coalesce(F.get("p", F.lit(k)), F.lit(0.0)) for k in range(len(DOMAINS))))
    return scored.select("doc_id", F.size("words").cast("long").alias("n_tokens"), p.alias("p"))


def fit_rates(members: DataFrame, targets: Mapping[str, float], tolerance: float = 2e-5, nearness: float = 1e-4) -> tuple[DataFrame, list[dict[str, float]]]:
    """``members(n_tokens, p, ...)`` with rate, and the domains' totals after each step.

    Minimises the distance of the expected domain totals from target share * total tokens, over rates of 0 or
    more, from rates of 1. A step moves the rates that are above 0 or that the gradient raises, and cuts them at 0. One
    pass tries several steps: parts of the one that would reach the targets were no rate cut (by the Gram matrix of the
    rates that move), and multiples of the plain gradient step, whose first always brings the totals nearer; the best is
    taken. It ends when all totals are within ``tolerance`` of all tokens, or, with targets proven out of reach, when
    the distance is proven to be within ``nearness`` of all tokens of the smallest possible: a direction in which every
    document's posterior grows bounds the distance from below. Each document's change is in proportion to its
    posteriors, whatever its length.
    A target of 0 leaves its domain out, however small the domain's share is: documents that most likely belong to it
    get rate 0, and the others are fitted to the other domains' totals, which are theirs alone.
    """
    k = len(DOMAINS)
    none = [i for i, d in enumerate(DOMAINS) if targets.get(d) == 0]
    gone = (F.array_position("p", F.array_max("p")) - 1).isin(none)
    p = [F.lit(0.0) if i in none else F.get("p", F.lit(i)) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    members = members.withColumn("rate", F.lit(1.0))
    n = F.when(gone, 0.0).otherwise(F.col("n_tokens").cast("double"))
    steps: list[list[list[float]]] = []

    def totals(tried: list[list[float]], gradient: list[float]) -> np.ndarray:
        """The domains' totals after each of the steps tried."""
        now = members.select(n.alias("n"), "p", _rate(steps).alias("r"))
        rates = F.transform(F.lit(tried), lambda step: _moved(F.col("r"), F.lit(gradient), step))
        now = now.withColumn("tried", rates)
        row = now.agg(*(F.sum(F.col("n") * p[i] * F.get("tried", F.lit(c))) for c in range(len(tried)) for i in range(k))).first()
        return np.array([float(x or 0) for x in row]).reshape(len(tried), k)

    def look(gradient: list[float]) -> tuple[float, np.ndarray]:
        """The least growth along the gradient for a share of posteriors, and the Gram matrix of the rates that move."""
        now = members.select(n.alias("n"), "p", _rate(steps).alias("r")).withColumn("up", _dot(F.lit(gradient)))
        now = now.withColumn("free", F.when((F.col("r") > 0) | (F.col("up") < 0), F.col("n")).otherwise(0.0))
        least = F.min(F.when(F.col("n") > 0, F.col("up") / sum(p, F.lit(0.0))))
        row = now.agg(least.alias("least"), *(F.sum(F.col("free") * p[i] * p[j]).alias(f"g{i}{j}") for i, j in pairs)).first()
        gram = np.zeros((k, k))
        for i, j in pairs:
            gram[i, j] = gram[j, i] = float(row[f"g{i}{j}"] or 0)
        return float(row["least"] or 0), gram

    now = totals([[0.0] * k], [0.0] * k)[0]
    history, total = [dict(zip(DOMAINS, now.tolist(), strict=True))], now.sum()
    goal = _goal(targets, now)
    while total > 0 and np.abs(now - goal).max() > tolerance * total:
        gradient = now - goal
        least, gram = look(gradient.tolist())
        bound = gradient + max(0.0, -least) * ~np.isin(np.arange(k), none)
        smallest = max(0.0, -float(bound @ goal)) / max(1e-300, float(np.linalg.norm(bound)))
        steepest = float(np.linalg.eigvalsh(gram)[-1])
        near = nearness if smallest > tolerance * total else tolerance
        if np.linalg.norm(gradient) - smallest <= near * total or steepest <= 0:
            break
        newton = np.linalg.pinv(gram, rcond=1e-10) @ gradient
        tried = [(part * newton).tolist() for part in _PARTS] + [(times / steepest * gradient).tolist() for times in _TIMES]
        after = totals(tried, gradient.tolist())
        best = int(((after - goal) ** 2).sum(axis=1).argmin())
        if ((after[best] - goal) ** 2).sum() >= (1 - 1e-12) * (gradient**2).sum():
            break  # doubles can't tell the totals apart
        steps, now = [*steps, [gradient.tolist(), tried[best]]], after[best]
        history.append(dict(zip(DOMAINS, now.tolist(), strict=True)))
        if len(steps) == STEPS_KEPT:
            earlier, members, steps = members, save(members.withColumn("rate", _rate(steps)), "rates"), []
            if len(history) > STEPS_KEPT + 1:
                drop(earlier)
    return members.withColumn("rate", F.when(gone, 0.0).otherwise(_rate(steps))), history


def _goal(targets: Mapping[str, float], now: np.ndarray) -> np.ndarray:
    """Token totals that the targets ask for. With a target for every domain they sum up to the corpus's."""
    given = np.array([targets.get(d, np.nan) for d in DOMAINS])
    open_ = np.isnan(given)
    if not open_.any():
        return given / given.sum() * now.sum()
    return np.where(open_, now, np.nan_to_num(given) / max(1e-9, 1 - np.nansum(given)) * now[open_].sum())


def _dot(step: Column) -> Column:
    return F.aggregate(F.zip_with("p", step, lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)


def _moved(rate: Column, gradient: Column, step: Column) -> Column:
    return F.when((rate > 0) | (_dot(gradient) < 0), F.greatest(F.lit(0.0), rate - _dot(step))).otherwise(rate)


def _rate(steps: list[list[list[float]]]) -> Column:
    """The rate after further (gradient, step). The steps are one array literal, so that all rounds share one plan."""
    if not steps:
        return F.col("rate")
    return F.aggregate(F.lit(steps), F.col("rate"), lambda r, step: _moved(r, step[0], step[1]))


def mix(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, n_tokens, p_good, p_low, p_toxic, rate) for each row of ``docs(doc_id, text)``.

    ``labels(doc_id, quality, toxic)``: toxic 1 is the domain toxic, else quality 0 is low, else good; rows with
    both null tell nothing, and a document with several labels has the last domain of them. Tokens are runs of
    lower-cased characters between ASCII white space and ``.,;:!?``. A null or empty text has no tokens: its rate
    moves by its posteriors like others', and adds nothing. Repeated rows get one result each; null doc_ids have
    no label. Other columns play no part. With no tokens at all every rate is 1; no rows give no rows. Targets that
    rates of 0 or more can't meet are met as nearly as they can be.
    """
    members = save(posteriors(docs, labels, fit_rows), "members")
    out, _ = fit_rates(members, targets)
    return out.select("doc_id", "n_tokens", *(F.get("p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(DOMAINS)), "rate")
