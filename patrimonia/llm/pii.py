"""Personal data: pattern spans, and a skip-chain conditional random field that adds spans consistent with them.

The field's nodes are a document's pattern spans and its further mentions: groups of digits in any print, and
tokens around an ``@`` or a written-out one. Neighbouring nodes share a chain potential. Nodes with similar tokens
(the same last digits, the same address whatever its dots and case) share a skip potential through one hub for each
key, however far apart and however many they are. Pattern spans are evidence: their labels are clamped, and loopy
sum-product messages carry them to all mentions of the document until they settle. Potentials are learnt piecewise
from a bounded sample of documents.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1
#: Documents that the field is fitted on at most (about), by a hash of the row.
FIT_DOCS = 2_000

# A match of an address holds one @: the run before it and the names behind it.
_BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]++")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_NOT_ALNUM = re.compile(r"[^A-Za-z0-9]+")
_CHAIN = re.compile(r"(?<![0-9])[0-9]++(?:[\x20\xa0./()_-]{1,2}+[0-9]++)*+")
_AT = re.compile(r"@|\s?[(\[{<]\s?(?:at|AT|arroba|@)\s?[)\]}>]\s?|\sAT\s")
_NAMES = re.compile(r"[A-Za-z0-9-]+(?:(?:\s?[(\[{<]\s?(?:dot|DOT|punto|\.)\s?[)\]}>]\s?|\sDOT\s|[.,])[A-Za-z0-9-]+)*+")
_WORD = re.compile(r"[^\W\d_]+")
#: Digits that make two numbers similar, the most of a mention, and the characters between neighbouring nodes at most.
SUFFIX, MOST_DIGITS, NEAR = 8, 19, 40
#: Characters of an address before and behind its mark at most, as mail allows: what is longer is no mention at all.
MOST_LOCAL, MOST_NAMES = 64, 255

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _byte(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part) <= 255


def _emails(text: str) -> list[Span]:
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and _BEFORE_AT.match(text[begin - 1]):
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((0, begin, m.end()))
            done = m.end()
        else:
            done = at + 1  # a run that begins before this @ can't go beyond it
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns, leftmost and non-overlapping for each kind, without those that fail a kind's test. Linear in the text."""
    out = _emails(text)
    if _DIGITS.search(text):
        for m in _DOTTED.finditer(text):
            runs = [x.span() for x in _DIGITS.finditer(text, m.start(), m.end())]
            for i in range(0, len(runs) - 3, 4):
                if all(_byte(text[a:b]) for a, b in runs[i : i + 4]):
                    out.append((1, runs[i][0], runs[i + 3][1]))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((3, m.start(), m.end()))
    return sorted(out)


def _number_key(parts: list[str]) -> str | None:
    """What makes numbers similar: an address's four parts, or the last digits."""
    if len(parts) == 4 and all(_byte(p) for p in parts):
        return "ip " + ".".join(str(int(p)) for p in parts)
    digits = "".join(parts)
    return digits[-SUFFIX:] if SUFFIX <= len(digits) <= MOST_DIGITS else None


def _address_key(local: str, names: str) -> str | None:
    own, first = _NOT_ALNUM.sub("", local).lower(), _NOT_ALNUM.split(names, maxsplit=1)[0].lower()
    return f"@{own}@{first}" if own and first else None


class Nodes:
    """A document's pattern spans and further mentions: places, known labels (-1: none known), features, neighbours and keys."""

    CONTEXT = 24
    WIDTH = 16 + CONTEXT

    def __init__(self, text: str, base: list[Span]) -> None:
        self.text = text
        found: list[tuple[int, int, int, str | None]] = []  # start, end, label, key
        for kind, a, b in base:
            local, at, names = text[a:b].partition("@")
            found.append((a, b, kind + 1, _address_key(local, names) if at else _number_key(_DIGITS.findall(text, a, b))))
        self.taken = sorted((a, b) for _, a, b in base)
        self.taken_from = [a for a, _ in self.taken]
        reach, furthest = 0, []
        for _, b in self.taken:
            furthest.append(reach := max(reach, b))
        self.furthest = furthest
        found += self._numbers() + self._addresses()
        found.sort(key=lambda x: x[:3])
        self.start, self.end, self.known = (np.array([x[i] for x in found], np.int64) for i in range(3))
        self.features = np.array([self._features(a, b) for a, b, _, _ in found], np.float32).reshape(len(found), self.WIDTH)
        hubs: dict[str, int] = {}
        self.hub = np.array([-1 if x[3] is None else hubs.setdefault(x[3], len(hubs)) for x in found], np.int64)
        # neighbours that share a key have the skip potential, and no other
        near = (self.start[1:] - self.end[:-1] <= NEAR) & ((self.hub[1:] != self.hub[:-1]) | (self.hub[1:] < 0))
        self.chain = np.flatnonzero(near)

    def _free(self, a: int, b: int) -> bool:
        """No pattern span reaches into a to b."""
        i = bisect_left(self.taken_from, b)
        return not i or self.furthest[i - 1] <= a

    def _numbers(self) -> list[tuple[int, int, int, str | None]]:
        out = []
        for m in _CHAIN.finditer(self.text):
            if m.end() - m.start() < 7:
                continue
            group: list[tuple[int, int]] = []
            pieces: list[list[tuple[int, int]]] = []
            for run in _DIGITS.finditer(self.text, m.start(), m.end()):
                a, b = run.span()
                lone = b - a >= 7 or not self._free(a, b)
                if lone or sum(y - x for x, y in group) + b - a > MOST_DIGITS:
                    pieces.append(group)
                    group = []
                if not lone:
                    group.append((a, b))
                elif self._free(a, b):
                    pieces.append([(a, b)])
            for piece in [*pieces, group]:
                parts = [self.text[a:b] for a, b in piece]
                if sum(map(len, parts)) >= 7 or len(parts) == 4:
                    out.append((piece[0][0], piece[-1][1], -1, _number_key(parts)))
        return out

    def _addresses(self) -> list[tuple[int, int, int, str | None]]:
        out, done = [], 0
        for m in _AT.finditer(self.text):
            begin = m.start()
            while begin > done and _BEFORE_AT.match(self.text[begin - 1]):  # ends at the mark before at the latest
                begin -= 1
            names = _NAMES.match(self.text, m.end())
            if not names or names.end() - names.start() > MOST_NAMES:
                continue
            if 0 < m.start() - begin <= MOST_LOCAL and self._free(begin, names.end()):
                out.append((begin, names.end(), -1, _address_key(self.text[begin : m.start()], names[0])))
                done = names.end()
        return out

    def _features(self, a: int, b: int) -> list[float]:
        """Shape and the words before, but not the print that makes a pattern match: other prints are to be judged by the same weights."""
        text = self.text[a:b]
        parts = _DIGITS.findall(text)
        n, address = sum(map(len, parts)), bool(_AT.search(text))
        x = [
            1, address, not address and n < 7, not address and n == 7, not address and 8 <= n <= 11, not address and 12 <= n <= 15, not address and 16 <= n <= 19, not address and n > 19,
            not address and len(parts) == 1, not address and 2 <= len(parts) <= 3, not address and len(parts) == 4, not address and len(parts) > 4,
            not address and 16 <= n <= 19 and luhn("".join(parts)), not address and len(parts) == 4 and all(_byte(p) for p in parts), any(c.isalpha() for c in text), len(text) > 24,
        ]
        context = [0.0] * self.CONTEXT
        for word in _WORD.findall(self.text[max(0, a - 24) : a])[-2:]:
            context[zlib.crc32(word.lower().encode()) % self.CONTEXT] = 1.0
        return [float(v) for v in x] + context


class Field:
    """Node weights and log potentials of chain and skip edges over the labels none, email, ip, card and phone."""

    def __init__(self, weights: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> None:
        self.weights, self.chain, self.skip = weights, chain, skip

    def marginals(self, nodes: Nodes, rounds: int = 500, damping: float = 0.3) -> np.ndarray:
        """Beliefs of all nodes. Messages stop when none moves by 1e-4 any more (damped, so that loops settle), or after ``rounds``."""
        unary = _log_softmax(nodes.features @ self.weights).astype(float)
        clamped = np.flatnonzero(nodes.known >= 0)
        unary[clamped] = -30.0
        unary[clamped, nodes.known[clamped]] = 0.0
        # the hub of a key is a node of its own, where what its members say about each other meets: where pattern spans
        # have the key, their labels are the hub's evidence, so that no number of unsure mentions outvotes them
        member = np.flatnonzero(nodes.hub >= 0)
        member = member[np.argsort(nodes.hub[member], kind="stable")]
        of = nodes.hub[member]
        begin = np.flatnonzero(np.diff(of, prepend=-1))
        seen = np.zeros((len(begin), LABELS))
        told = clamped[nodes.hub[clamped] >= 0]
        np.add.at(seen, (nodes.hub[told], nodes.known[told]), 1)
        told_hub = seen.any(axis=1)[:, None]
        seen = np.where(told_hub, np.log(np.maximum(seen, 1e-13) / np.maximum(seen.sum(axis=1, keepdims=True), 1)), 0.0)
        left, right = nodes.chain, nodes.chain + 1
        chain, skip = np.exp(self.chain), np.exp(self.skip)
        onward, backward = np.zeros((len(left), LABELS)), np.zeros((len(left), LABELS))
        up, down = np.zeros((len(member), LABELS)), np.zeros((len(member), LABELS))

        def believed() -> np.ndarray:
            out = unary.copy()
            out[left] += backward
            out[right] += onward
            out[member] += down
            return out

        for _ in range(rounds if len(left) or len(member) else 0):
            belief = believed()
            hub = seen + np.add.reduceat(up, begin) if len(begin) else seen
            fresh = _sent(belief[left] - backward, chain), _sent(belief[right] - onward, chain.T), _sent(belief[member] - down, skip), _sent(hub[of] - up, skip.T)
            moved = max(np.abs(new - old).max(initial=0) for new, old in zip(fresh, (onward, backward, up, down), strict=True))
            onward, backward, up, down = (damping * old + (1 - damping) * new for new, old in zip(fresh, (onward, backward, up, down), strict=True))
            if moved < 1e-4:
                break
        return np.exp(_log_softmax(believed()))


def _sent(known: np.ndarray, potential: np.ndarray) -> np.ndarray:
    """The log messages that nodes of such log beliefs send through a potential."""
    out = np.einsum("ns,st->nt", np.exp(known - known.max(axis=1, keepdims=True)), potential)  # too small for threads of a matrix product
    return np.log(out / out.sum(axis=1, keepdims=True))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _log_softmax(x: np.ndarray) -> np.ndarray:
    return x - _log_sum(x, -1)[..., None]


def examples(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, labels, chain counts, skip counts) of a document. Mentions similar to a pattern span are of unknown label and left out; the others are none."""
    nodes = Nodes(text, base_spans(text))
    label, chain, skip = nodes.known.copy(), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))
    spread = np.isin(nodes.hub, nodes.hub[(nodes.known > 0) & (nodes.hub >= 0)])
    label[(label < 0) & ~spread] = 0
    near = nodes.chain[(label[nodes.chain] >= 0) & (label[nodes.chain + 1] >= 0)]
    np.add.at(chain, (label[near], label[near + 1]), 1)
    member = np.flatnonzero((nodes.hub >= 0) & (label >= 0))
    member = member[np.argsort(nodes.hub[member], kind="stable")]
    twin = nodes.hub[member[1:]] == nodes.hub[member[:-1]]
    np.add.at(skip, (label[member[:-1]][twin], label[member[1:]][twin]), 1)
    return nodes.features[label >= 0], label[label >= 0], chain, skip


def fit(features: np.ndarray, target: np.ndarray, chain: np.ndarray, skip: np.ndarray, steps: int = 4000, rate: float = 0.5, seed: int = 3) -> Field:
    """Piecewise: a softmax for nodes, and log ratios of observed to independent label pairs for edges."""
    rng = np.random.default_rng(seed)
    weights = np.zeros((Nodes.WIDTH, LABELS), np.float32)
    for step in range(steps):
        part = rng.integers(0, len(target), 64)
        error = np.exp(_log_softmax(features[part] @ weights))
        error[np.arange(len(part)), target[part]] -= 1
        weights -= rate * (1 - step / steps) * (features[part].T @ error / len(part) + 5e-3 * weights)
    share = (np.bincount(target, minlength=LABELS) + 0.5) / (len(target) + 0.5 * LABELS)

    alone = np.outer(share, share)

    def ratio(count: np.ndarray, before: np.ndarray) -> np.ndarray:
        count = count + count.T + before
        return np.log(count / count.sum() / alone)

    # neighbours are held to be independent in part, as a sample shows few of their orders; equal labels are the rule
    # among similar tokens, even for kinds that the sample repeats nowhere
    return Field(weights, ratio(chain, (1 + 0.2 * chain.sum()) * alone), ratio(skip + np.diag(len(target) * share), np.full((LABELS, LABELS), 0.5 / LABELS**2)))


def train(texts: list[str]) -> Field | None:
    """The field of whole texts; None if they have no node."""
    parts = [examples(t) for t in texts]
    if not sum(len(p[1]) for p in parts):
        return None
    return fit(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), sum(p[2] for p in parts), sum(p[3] for p in parts))


def added_spans(text: str, base: list[Span], field: Field, least: float = 0.95) -> list[Span]:
    """Mentions outside the pattern spans whose marginal for a kind is ``least`` or more.

    A mention that nothing else in the document resembles isn't added: its label would rest on its shape alone.
    """
    nodes = Nodes(text, base)
    shared = np.bincount(nodes.hub[nodes.hub >= 0], minlength=1) > 1
    free = np.flatnonzero((nodes.known < 0) & (nodes.hub >= 0) & shared[nodes.hub])
    if not len(free):
        return []
    p = field.marginals(nodes)
    best = p.argmax(axis=1)
    return [(int(best[i]) - 1, int(nodes.start[i]), int(nodes.end[i])) for i in free if best[i] and p[i, best[i]] >= least]


def _told(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            features, label, chain, skip = examples(text)
            # equal rows of a node count, but aren't sent twice
            kinds, count = np.unique(np.concatenate([features, label[:, None].astype(np.float32)], axis=1), axis=0, return_counts=True)
            if len(kinds):
                yield pa.record_batch([pa.array([doc_id], pa.int64()), *(pa.array([x.tobytes()]) for x in (kinds, count, chain, skip))], ["doc_id", "kinds", "n", "chain", "skip"])


def _fit(rows: pa.Table) -> pa.Table:
    """The field of the sample's nodes, as one row."""
    rows = rows.sort_by([("doc_id", "ascending"), ("kinds", "ascending")])
    kinds = np.concatenate([np.frombuffer(x.as_py(), np.float32).reshape(-1, Nodes.WIDTH + 1) for x in rows.column("kinds")])
    many = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in rows.column("n")])
    # a kind of node counts in proportion to the logarithm of how often one document repeats it
    nodes = np.repeat(kinds, 1 + np.log2(many).astype(np.int64), axis=0)
    chain, skip = (sum(np.frombuffer(x.as_py()).reshape(LABELS, LABELS) for x in rows.column(c)) for c in ("chain", "skip"))
    field = fit(nodes[:, :-1], nodes[:, -1].astype(np.int64), chain, skip)
    return pa.table({"weights": [field.weights.astype(np.float32).tobytes()], "chain": [field.chain.tobytes()], "skip": [field.skip.tobytes()]})


def learn(text: DataFrame, fit_docs: int = FIT_DOCS) -> Field | None:
    """The field of a sample of ``text(doc_id, text)``: examples are made where the rows are, one task fits, the driver gets the potentials."""
    some = text.where(F.col("text").rlike("[0-9@]"))
    row_hash = F.xxhash64("doc_id", "text")
    total = some.agg(F.approx_count_distinct(row_hash, 0.01)).first()[0]
    if total > fit_docs:
        some = some.where(F.pmod(row_hash, F.lit(2**30)) < int(fit_docs / total * 2**30))
    # rows that repeat share their hash: they count once in the number of rows and in the sample, at every size
    made = some.dropDuplicates(["doc_id", "text"]).mapInArrow(_examples, "doc_id long, kinds binary, n binary, chain binary, skip binary")
    row = made.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(_fit, "weights binary, chain binary, skip binary").first()
    if row is None:
        return None
    weights = np.frombuffer(row["weights"], np.float32).reshape(Nodes.WIDTH, LABELS)
    return Field(weights, *(np.frombuffer(row[c]).reshape(LABELS, LABELS) for c in ("chain", "skip")))


def _find(field: Field | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            digest, told, added = [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                more = added_spans(text, base, field) if field is not None else []
                for kind, own in enumerate(counts):
                    own.append(sum(s[0] == kind for s in base))
                digest.append(hashlib.sha256(_told(base).encode()).hexdigest())
                told.append(_told(base + more))
                added.append(len(more))
            yield pa.record_batch(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest, pa.string()), pa.array(told, pa.string()), pa.array(added, pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    return run


def personal_data(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for each row of ``docs(doc_id, text)``.

    The counts and the digest are of the pattern spans; spans holds those and the field's (n_added of them), as
    kind:start:end by kind and start, in code points, end exclusive. Added spans don't overlap pattern spans. Null and
    empty texts have none. A mention of more than MOST_DIGITS digits, or of more than MOST_LOCAL characters before an
    address's mark or MOST_NAMES behind it, isn't added. Messages of a document that don't settle end after 500 rounds.
    Repeated rows give one result each and count once in learning, and null doc_ids stay null; other columns play no part.
    Without a document that holds a digit or an ``@`` there is nothing to learn from, and nothing is added. An empty
    table gives an empty result. The field is learnt from about ``fit_docs`` documents by a hash of the row (all, if
    there are no more).
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    form = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"
    return text.mapInArrow(_find(learn(text, fit_docs)), form)
