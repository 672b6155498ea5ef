"""Language identification: averaged hashed subword embeddings, a linear softmax, and calibrated rejection.

Trained by stochastic gradient descent in numpy on a bounded sample of labelled rows. As the document vector
is a mean and the classifier is linear, prediction needs only the product of embeddings and classifier: one
score for each bucket and language, which every task looks up for all subwords of whole texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrimonia.llm import words as W
from patrimonia.llm.store import save

#: Labelled rows of each language that training uses at most, by the order of a hash of doc_id.
ROWS_PER_LANGUAGE = 1000
BUCKETS, DIM = 1 << 16, 16
#: Whether a subword is known is told by finer codes than buckets, most of which some text fills.
CODE_BITS = 20
#: Training texts that must hold a subword for it to be known.
KNOWN_TEXTS = 2
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] = _FOLD[97:123]
_FOLD[W.NON_ALNUM] = 0
_FOLD[48:58] = 0  # digits tell nothing about the language
_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = True


def subwords(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of all words and of all 3- and 4-byte runs that don't go beyond a word and its neighbouring gaps.

    A code has ``CODE_BITS`` bits; its upper 16 are the subword's bucket.
    """
    word, start, _, first = W.words(raw, at, _FOLD == 0)
    rows = [np.repeat(np.arange(len(first) - 1), np.diff(first))]
    codes = [(word >> np.uint64(64 - CODE_BITS)).astype(np.int64)]
    code = _FOLD[raw]
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for n in (3, 4):
        if len(raw) < n:
            continue
        size = len(raw) - n + 1
        inside = (row[:size] == row[n - 1 :]) & (code[1 : size + 1] > 0)
        if n == 4:
            inside &= code[2 : size + 2] > 0
        gram = np.zeros(size, np.uint64)
        for j in range(n):
            gram = gram * np.uint64(256) + code[j : size + j]
        gram = gram[inside] + np.uint64(n << 32)
        rows.append(row[:size][inside])
        codes.append(((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CODE_BITS)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(codes)


class Model:
    """Scores by bucket and language, a temperature that calibrates them, and what a text must have not to be rejected.

    A text must score ``reject_below``, and the share of its subwords that are known must reach ``known_share``, less
    an allowance for few subwords (1 / sqrt of their number).
    """

    def __init__(
        self, langs: list[str], scores: np.ndarray, bias: np.ndarray, temperature: float = 1.0, reject_below: float = 0.0,
        known: np.ndarray | None = None, known_share: float = 0.0,
    ) -> None:
        self.langs, self.scores, self.bias, self.temperature, self.reject_below = langs, scores.astype(np.float32), bias, temperature, reject_below
        self.known, self.known_share = np.ones(1 << CODE_BITS, bool) if known is None else known, known_share

    def judge(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities by row and language, whether each row's text is of a known language)."""
        n = len(at) - 1
        row, code = subwords(raw, at)
        bucket, size = code >> (CODE_BITS - 16), np.bincount(row, minlength=n)
        total = np.stack([np.bincount(row, self.scores[bucket, j], n) for j in range(len(self.langs))], axis=1)
        p = _softmax((total / np.maximum(size, 1)[:, None] + self.bias) / self.temperature)
        return p, (p.max(axis=1) >= self.reject_below) & _enough(np.bincount(row, self.known[code], n), size, self.known_share)


def _enough(known: np.ndarray, size: np.ndarray, share: float) -> np.ndarray:
    return known >= share * size - np.sqrt(size)


def _known_share(codes: list[np.ndarray], y: np.ndarray, held: np.ndarray, used: np.ndarray, mixed: list[np.ndarray], lost: float) -> float:
    """The share of known subwords that tells held texts from texts of a language that training lacks, and from noise.

    Each language's held texts are looked up once among all languages' subwords and once among the other languages'
    alone; ``mixed`` are the held texts with their letters shuffled. Where the lower end of the first (a share ``lost``
    of them) lies above the upper end of the others (a hundredth), the value halfway parts them; else it is the lower end.
    """
    count = np.zeros((int(y.max()) + 1, 1 << CODE_BITS), np.int32)
    for i in used:
        count[y[i], codes[i]] += 1
    all_, both = count.sum(axis=0), np.isin(held, used)
    own = [(all_[codes[i]] - again >= KNOWN_TEXTS).mean() for i, again in zip(held, both, strict=True) if len(codes[i])]
    strange = [(all_[codes[i]] - count[y[i], codes[i]] >= KNOWN_TEXTS).mean() for i in held if len(codes[i]) and len(count) > 1]
    strange += [(all_[c] >= KNOWN_TEXTS).mean() for c in mixed if len(c)]
    if not own:
        return 0.0
    low = float(np.sort(own)[int(lost * len(own))])
    high = float(np.quantile(strange, 0.99)) if strange else low
    return (low + high) / 2 if high < low else low


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _nll(logits: np.ndarray, y: np.ndarray, temperature: float) -> float:
    return float(-np.log(_softmax(logits / temperature)[np.arange(len(y)), y] + 1e-12).mean())


def _shuffled(text: str, rng: np.random.Generator) -> np.ndarray:
    """Subwords of the text's characters in another order."""
    letters = rng.permutation(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32))
    raw = np.frombuffer(letters.tobytes().decode("utf-32-le", "replace").encode("utf-8", "replace"), np.uint8)
    return subwords(raw, np.array([0, len(raw)]))[1]


def train(rows: Iterable[tuple[str, str]], epochs: int = 6, rate: float = 0.5, seed: int = 11, lost: float = 0.001) -> Model | None:
    """Fit on four fifths of the (text, lang) rows; the rest sets the temperature and the rejection, which loses a share ``lost`` of them by each measure at most."""
    features, labels, codes, texts = [], [], [], []
    for text, lang in rows:
        labels.append(lang)
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        _, code = subwords(raw, np.array([0, len(raw)]))
        codes.append(np.unique(code).astype(np.int32))
        texts.append(text)
        bucket, count = np.unique((code >> (CODE_BITS - 16)).astype(np.uint16), return_counts=True)
        features.append((bucket, (count / max(1, count.sum())).astype(np.float32)))
    langs = sorted(set(labels))
    if not langs:
        return None
    y = np.array([langs.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(labels))
    held, used = (order[: len(order) // 5], order[len(order) // 5 :]) if len(order) >= 20 else (order, order)
    table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    weight, bias = rng.normal(0, 0.1, (DIM, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)
    scale = 20.0  # subword shares are small: embeddings take larger steps
    steps, step = epochs * len(used), 0
    for _ in range(epochs):
        for i in rng.permutation(used):
            bucket, share = features[i]
            if not len(bucket):
                continue
            now = rate * (1 - step / steps)
            step += 1
            hidden = share @ table[bucket]
            error = _softmax(hidden @ weight + bias)
            error[y[i]] -= 1
            back = weight @ error
            weight -= now * np.outer(hidden, error)
            bias -= 0.1 * now * error
            table[bucket] -= (now * scale) * share[:, None] * back
    model = Model(langs, table @ weight, bias)
    logits = np.stack([(f[1] @ model.scores[f[0]] if len(f[0]) else np.zeros(len(langs))) + bias for f in (features[i] for i in held)])
    model.temperature = min(np.geomspace(0.05, 20, 60), key=lambda t: _nll(logits, y[held], t))
    best = np.sort(_softmax(logits / model.temperature).max(axis=1))
    model.reject_below = float(min(0.5, best[int(lost * len(best))]))
    noise = [np.unique(_shuffled(texts[i], rng)) for i in held]
    model.known_share = _known_share(codes, y, held, used, noise, lost)
    model.known = sum((np.bincount(c, minlength=1 << CODE_BITS) for c in codes), np.zeros(1 << CODE_BITS, np.int64)) >= min(KNOWN_TEXTS, len(codes))
    return model


def fold_of_training(doc_id: Column) -> Column:
    """Rows to learn from: the other quarter is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def sample(docs: DataFrame, per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """(doc_id, text, lang) of at most about ``per_language`` different rows of each language, chosen by a hash of the row.

    Rows that repeat one another count once, also in a language's size (an approximate distinct count).
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & fold_of_training(F.col("doc_id")))
    row = F.xxhash64("doc_id", "text")
    sizes = known.groupBy("lang").agg(F.approx_count_distinct(row, 0.02).alias("size"))
    limits = save(sizes.select("lang", (F.least(F.lit(1.0), per_language / F.col("size")) * 2**30).cast("long").alias("limit")), "languages")
    chosen = known.join(limits, "lang").where(F.pmod(row, F.lit(2**30)) < F.col("limit"))
    return chosen.select("doc_id", "text", "lang").distinct()


def _fit(rows: pa.Table) -> pa.Table:
    """The model of a bounded sample, as one row."""
    rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending"), ("lang", "ascending")])
    model = train((t.as_py(), x.as_py()) for t, x in zip(rows.column("text"), rows.column("lang"), strict=True))
    numbers = [model.temperature, model.reject_below, model.known_share]
    fields = {"langs": [model.langs], "scores": [model.scores.tobytes()], "bias": [model.bias.astype(np.float64).tolist()], "numbers": [[float(x) for x in numbers]], "known": [np.packbits(model.known).tobytes()]}
    return pa.table(fields, pa.schema([("langs", pa.list_(pa.string())), ("scores", pa.binary()), ("bias", pa.list_(pa.float64())), ("numbers", pa.list_(pa.float64())), ("known", pa.binary())]))


def fit(docs: DataFrame, per_language: int = ROWS_PER_LANGUAGE) -> Model | None:
    """The model of a sample of ``docs``, trained in one task; the driver gets its scores only."""
    form = "langs array<string>, scores binary, bias array<double>, numbers array<double>, known binary"
    row = sample(docs, per_language).withColumn("one", F.lit(1)).groupBy("one").applyInArrow(_fit, form).first()
    if row is None:
        return None
    scores = np.frombuffer(row["scores"], np.float32).reshape(BUCKETS, len(row["langs"]))
    temperature, reject_below, known_share = row["numbers"]
    known = np.unpackbits(np.frombuffer(row["known"], np.uint8)).astype(bool)
    return Model(list(row["langs"]), scores, np.array(row["bias"]), temperature, reject_below, known, known_share)


def _predict(model: Model | None, ids: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, at in W.chunks(batch):
                n = part.num_rows
                seen = np.concatenate([[0], np.cumsum(_LETTERS[raw])])
                letters = seen[at[1:]] > seen[at[:-1]]
                text = part.column(part.schema.get_field_index("text"))
                for i in np.flatnonzero(~letters):
                    letters[i] = any(c.isalpha() for c in text[int(i)].as_py() or "")
                if model is None:
                    best, score, sure = np.zeros(n, int), np.zeros(n), np.zeros(n, bool)
                    names = ["und"]
                else:
                    p, fits = model.judge(raw, at)
                    best, score, names = p.argmax(axis=1), p.max(axis=1), model.langs
                    sure = letters & fits
                pred = [names[b] if has else "und" for b, has in zip(best, letters, strict=True)]
                yield pa.record_batch(
                    [*(part.column(part.schema.get_field_index(c)) for c in ids), pa.array(pred, pa.string()), pa.array(np.where(letters, score, 0.0)), pa.array(~sure)],
                    [*ids, "lang_pred", "score", "rejected"],
                )

    return run


def predict_language(docs: DataFrame, per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """``docs(doc_id, text, lang, ...)`` with lang_pred, score (0 to 1) and rejected, for every row and whole text.

    Learns from rows with a lang and a doc_id outside the held-out fold, at most about ``per_language`` of each
    language; predictions use the text alone. Without letters (or with a null or empty text) a row gets ``und``
    and score 0. rejected: no letters, a calibrated score below the threshold that the calibration rows set, or too few
    subwords that training knows, as in texts of other languages and in noise (a few words may pass for want of evidence).
    Of languages of equal score the first by code points is predicted. Repeated rows count once in training.
    With nothing to learn from, every row is ``und`` and rejected. All columns but those three are kept, and
    columns of those names are replaced. Rows with a null doc_id or lang are predicted like others.
    """
    model = fit(docs, per_language)
    docs = docs.drop("lang_pred", "score", "rejected")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    text = docs.withColumn("text", F.col("text").cast("string")) if dict(docs.dtypes)["text"] != "string" else docs
    return text.mapInArrow(_predict(model, docs.columns), f"{fields}, lang_pred string, score double, rejected boolean")
