"""URL filtering by a fixed host and path policy and by association rules that FP-growth mines from labels.

DataFrame operations and Spark's own FP-growth only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrimonia.llm.store import save

#: (verdict, host and path)
POLICY = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BAD = "label=block"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def policy_rule(host: Column, path: Column, policy: Sequence[tuple[str, str]] = POLICY) -> Column:
    """The longest rule that fits, as struct(length, rule, verdict), or null."""
    fits = []
    for verdict, rule in policy:
        own, slash, rest = rule.partition("/")
        fit = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        fits.append(F.when(fit, F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.greatest(*fits, F.lit(None).cast("struct<size:int,rule:string,verdict:string>"))


def tokens(url: Column) -> Column:
    """Distinct items of a URL: scheme, host suffixes, first label, path segments, and query keys."""
    labels = F.split("host", r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, n), ".")))
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    keys = F.regexp_extract_all(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(r"(?:^|&)([^=&]+)"), F.lit(1))
    return F.array_distinct(
        F.concat(
            F.array(F.concat(F.lit("scheme="), F.lower(F.substring_index(url, "://", 1))), F.concat(F.lit("first="), labels[0])),
            suffixes,
            F.transform(segments, lambda s: F.concat(F.lit("path="), s)),
            F.transform(keys, lambda s: F.concat(F.lit("key="), s)),
        )
    )


def lower_bound(share: Column, rows: Column, z: float) -> Column:
    """Wilson's lower bound of a share seen in so many rows: few rows prove little, at every size of the table."""
    spread = z * F.sqrt(share * (1 - share) / rows + z * z / (4 * rows * rows))
    return (share + z * z / (2 * rows) - spread) / (1 + z * z / rows)


def filed(rules: DataFrame, sets: DataFrame) -> DataFrame:
    """The inverted index of ``rules(needs, ...)``: each under the one of its tokens that fewest of ``sets(items)`` hold."""
    index = rules.withColumn("token", F.explode("needs"))
    seen = sets.select(F.explode("items").alias("token")).join(index.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    own = [c for c in rules.columns if c != "needs"]
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))
    return index.join(seen, "token", "left").groupBy("needs", *own).agg(rarest.alias("at")).select("needs", *own, F.col("at.token").alias("token"))


def holding(sets: DataFrame, index: DataFrame) -> DataFrame:
    """``sets(items, ...)`` with each rule of the index whose tokens they all hold."""
    met = sets.withColumn("token", F.explode("items")).join(index, "token")
    return met.where(F.size(F.array_except("needs", "items")) == 0).drop("token", "items")


def mine(labelled: DataFrame, support: float, confidence: float, z: float = 2.58) -> DataFrame:
    """(needs, confidence, support): token sets that imply a block, none of which adds to a smaller one.

    ``labelled(items, bad)``. Support is the share of all labelled rows that hold the tokens and are bad. A rule counts
    if the lower bound (at ``z`` deviations) of the share of bad rows among those that hold its tokens is ``confidence``
    or more, so that labels which have nothing to do with the tokens make no rule.
    """
    baskets = save(labelled.select(F.when(F.col("bad"), F.array_append("items", F.lit(_BAD))).otherwise(F.col("items")).alias("items")), "baskets")
    rows = baskets.count()
    if not rows:
        return labelled.sparkSession.createDataFrame([], "needs array<string>, confidence double, support double")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent")[0] == _BAD).select(F.array_sort("antecedent").alias("needs"), "confidence", "support")
    held = F.round(F.col("support") * rows / F.col("confidence"))
    rules = save(rules.where(lower_bound(F.col("confidence"), held, z) >= confidence), "rules")
    # pruned: a rule that a rule on fewer of its tokens matches in confidence says nothing new
    sets = rules.select(F.col("needs").alias("items"), F.col("needs").alias("own"), F.col("confidence").alias("own_confidence"))
    index = filed(rules.select("needs", "confidence"), sets)
    covered = holding(sets, index).where("needs <> own and confidence >= own_confidence").select(F.col("own").alias("needs")).distinct()
    return rules.join(covered, "needs", "left_anti").select("needs", "confidence", "support")


def judge_urls(
    pages: DataFrame, labels: DataFrame, policy: Sequence[tuple[str, str]] = POLICY, support: float = 0.002, confidence: float = 0.5
) -> DataFrame:
    """(page_id, host, path, rule, verdict, confidence) for each row of ``pages(page_id, url)``.

    The longest policy rule that fits a URL decides. Elsewhere mined rules do: ``labels(doc_id, quality, toxic)``
    names good and bad pages by their id (bad: toxic or of quality 0), and a page is blocked if it holds all
    tokens of a rule of at least ``support`` (a share of the labelled rows, at every size) and of which at least
    ``confidence`` is proven (see ``mine``); confidence is the best such rule's, else null.
    Other columns play no part. Null URLs and those without ``://`` have empty host and path, and mined rules
    don't match them: allow. Repeated rows give one result each. Labels with null values count as good; a page
    with several labels is bad if one of them is. Without labels no rule is mined. No pages give no rows.
    """
    url = F.col("url")
    base = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"))
    parsed = base.withColumns({"host": host_of(url), "path": path_of(url)})
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(F.max(F.coalesce((F.col("toxic") == 1) | (F.col("quality") == 0), F.lit(False))).alias("bad"))
    open_ = save(parsed.where("host <> ''").select("url", "host", "path").distinct().withColumn("items", tokens(url)).select("url", "items"), "urls")
    labelled = parsed.where("host <> ''").join(known, "page_id").withColumn("items", tokens(url)).select("items", "bad")
    rules = save(mine(labelled, support, confidence).select("needs", "confidence"), "rules")
    hit = holding(open_, filed(rules, open_))
    blocked = save(hit.groupBy("url").agg(F.max("confidence").alias("confidence")), "blocked")
    out = parsed.withColumn("fit", policy_rule(F.col("host"), F.col("path"), policy)).join(blocked, "url", "left")
    mined = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", mined).alias("verdict"), "confidence")
