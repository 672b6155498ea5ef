"""Line deduplication by an exact set-similarity join of lines' word sets.

Words are ordered by rarity (occurrences by hash bucket, then hash), the same order everywhere. Two sets of
similarity t share a word among the first n - ceil(t n) + 1 of each, so only those words are posted, and sets meet
in the posting lists of their words. There the lengths, the places of the shared word and a parity bitmap rule most
pairs out. Sets that may have a partner come to the lists again with a parity bitmap that grows with the set, and
those that still may, whole: pairs are verified and counted where they meet first. No row stands for a pair, so that
rows grow with the lines, however many of them are alike. Long lists are dealt out by both ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrimonia.llm import words as W
from patrimonia.llm.store import drop, pruning, save

#: Buckets of the word counts: what every task receives has this size at any corpus size.
BUCKET_BITS, SLICES = 20, 64
#: Sets of a posting list that one part of it takes, and words of pairs that are looked up at once.
LIST_SETS, STEP_WORDS = 4_096, 1_000_000
#: Words whose buckets are counted at once.
COUNT_WORDS = 1 << 20
#: Words of a set for each 64 bits of its bitmap (a power of two in all).
SKETCH_WORDS = 16
#: A token is a word's count above the first bits of its hash: tokens sort as words do by rarity.
TOKEN_BITS = 32
_U = np.uint64
_POSTING = ["token", "cell", "side", "id"]


def line_offsets(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of all lines (each with its line feed), and of each row's lines among them. Empty rows have no line."""
    begin = np.unique(np.concatenate([at[:-1][at[:-1] < at[1:]], np.flatnonzero(raw == 10) + 1]))
    begin = begin[begin < len(raw)]
    return np.append(begin, len(raw)), np.searchsorted(begin, at)


def line_sets(raw: np.ndarray, at: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, word) of all lines' distinct words, by line, rarity and word, and the offsets of each row's lines."""
    lines, of_row = line_offsets(raw, at)
    word, first = W.plain_words(raw, lines)
    rank = np.zeros(len(word), np.uint64) if counts is None else counts[(word >> _U(64 - BUCKET_BITS)).astype(np.int64)].astype(np.uint64)
    if len(lines) > 1 << 22:
        line = np.repeat(np.arange(len(lines) - 1), np.diff(first))
        order = np.lexsort((word, rank, line))
        line, word = line[order], word[order]
        keep = np.concatenate([[True], (line[1:] != line[:-1]) | (word[1:] != word[:-1])])[: len(word)]
        return line[keep], word[keep], of_row
    key = np.repeat(np.arange(len(lines) - 1, dtype=np.uint64) << _U(42), np.diff(first))
    key |= (rank << _U(20)) | (word >> _U(44))
    order = np.argsort(key)
    key, word = key[order], word[order]
    same = key[1:] == key[:-1]
    mixed = np.flatnonzero(same & (word[1:] != word[:-1]))
    if len(mixed):  # different words of a line that share a key: such runs are put in order by whole words
        run = np.flatnonzero(np.isin(key, key[mixed]))
        word[run] = word[run][np.lexsort((word[run], key[run]))]
        same &= word[1:] == word[:-1]
    keep = np.concatenate([[True], ~same])[: len(word)]
    return (key[keep] >> _U(42)).astype(np.int64), word[keep], of_row


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    seen: list[np.ndarray] = []

    def add() -> None:
        if seen:
            np.add(total, np.bincount(np.concatenate(seen), minlength=len(total)), out=total)
            seen.clear()

    for batch in batches:
        for _, raw, at in W.chunks(batch):
            word, _ = W.plain_words(raw, at)
            seen.append((word >> _U(64 - BUCKET_BITS)).astype(np.int32))
            if sum(map(len, seen)) >= COUNT_WORDS:
                add()
    add()
    parts = total.reshape(SLICES, -1)
    task = TaskContext.get().partitionId()
    used = [np.flatnonzero(p) for p in parts]
    keep = [i for i in range(SLICES) if len(used[i])]
    if keep:
        yield pa.record_batch(
            [pa.array(keep, pa.int32()), pa.array([task // 64] * len(keep), pa.int32()), pa.array([used[i].astype(np.int32).tobytes() for i in keep]), pa.array([parts[i][used[i]].tobytes() for i in keep])],
            ["slice", "batch", "bucket", "n"],
        )


def _add(table: pa.Table) -> pa.Table:
    total = np.zeros((1 << BUCKET_BITS) // SLICES, np.int64)
    for bucket, n in zip(table.column("bucket"), table.column("n"), strict=True):
        total[np.frombuffer(bucket.as_py(), np.int32)] += np.frombuffer(n.as_py(), np.int64)
    used = np.flatnonzero(total)
    return pa.table({"slice": table.column("slice")[:1], "batch": table.column("batch")[:1], "bucket": pa.array([used.astype(np.int32).tobytes()]), "n": pa.array([total[used].tobytes()])})


def word_counts(text: DataFrame) -> np.ndarray:
    """Occurrences of words, summed by the word's hash bucket, over all rows."""
    form = "slice int, batch int, bucket binary, n binary"
    counts = text.mapInArrow(_count, form).groupBy("slice", "batch").applyInArrow(_add, form).groupBy("slice").applyInArrow(_add, form)
    total = np.zeros((SLICES, (1 << BUCKET_BITS) // SLICES), np.int64)
    for x in counts.collect():
        total[x["slice"], np.frombuffer(x["bucket"], np.int32)] = np.frombuffer(x["n"], np.int64)
    return total.ravel()


def _names(line: np.ndarray, word: np.ndarray, lines: int) -> np.ndarray:
    """A hash of each line's set of words; ``line`` is sorted."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(word, 41), dtype=np.uint64)])
    at = np.searchsorted(line, np.arange(lines + 1))
    return W.mix(total[at[1:]] - total[at[:-1]], 1).view(np.int64)


def _parity(line: np.ndarray, word: np.ndarray, lines: int) -> np.ndarray:
    """A bit for each value of a word's last six bits: whether an odd number of a line's words have it."""
    odd = np.bincount(line * 64 + (word & _U(63)).astype(np.int64), minlength=lines * 64) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _tokens(word: np.ndarray, size: np.ndarray, wanted: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many words each of the ``wanted`` sets posts, and their tokens; words are by set and rarity."""
    prefix = np.where(wanted & (size > 0), size - -(-percent * size // 100) + 1, 0)
    rare = word[np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size) < np.repeat(prefix, size)]
    return prefix, ((counts[(rare >> _U(64 - BUCKET_BITS)).astype(np.int64)].astype(np.uint64) << _U(TOKEN_BITS)) | (rare >> _U(64 - TOKEN_BITS))).view(np.int64)


def _list_array(size: np.ndarray, flat: np.ndarray, **more: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(flat), **more)


def _occurrences(counts: np.ndarray, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: set[int] = set()
            for part, raw, at in W.chunks(batch):
                line, word, of_row = line_sets(raw, at, counts)
                lines = int(of_row[-1])
                size = np.bincount(line, minlength=lines)
                parity = _parity(line, word, lines)
                cid = _names(line, word, lines)
                fresh = np.zeros(lines, bool)  # a batch gives a set's prefix once
                names, at_first = (x.tolist() for x in np.unique(cid, return_index=True))
                fresh[[i for i, name in zip(at_first, names, strict=True) if name not in known]] = True
                known.update(names)
                prefix, token = _tokens(word, size, fresh, counts, percent)
                row = np.repeat(np.arange(part.num_rows), np.diff(of_row))
                number = np.arange(lines) - of_row[row]
                full = np.flatnonzero(size)
                held = _list_array(prefix[full], token, mask=pa.array(~fresh[full]))
                yield pa.record_batch(
                    [part.column(0).take(pa.array(row[full])), pa.array(number[full].astype(np.int32)), pa.array(cid[full]), pa.array(size[full].astype(np.int32)), pa.array(parity[full]), held],
                    ["doc_id", "line_no", "cid", "n", "parity", "prefix"],
                )

    return run


def _each(begin: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair, place) of so many places from each pair's first."""
    pair = np.repeat(np.arange(len(many)), many)
    return pair, np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(len(pair))


def _sketches(word: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity bitmaps of sets whose words follow one another, in 64-bit pieces, and how many pieces each has."""
    pieces = 1 << np.ceil(np.log2(np.maximum(size, 1) / SKETCH_WORDS)).clip(0).astype(np.int64)
    begin = np.cumsum(pieces) - pieces
    bit = np.repeat(begin * 64, size) + (word & (np.repeat(pieces, size) * 64 - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(bit, minlength=int(pieces.sum()) * 64) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64), pieces


def _sets_of(counts: np.ndarray, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The sets of the lines that ``lines`` names by number, where the line has that set: rows may share a doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, at in W.chunks(batch):
                line, word, of_row = line_sets(raw, at, counts)
                wanted = part.column(2)
                row = np.repeat(np.arange(part.num_rows), wanted.value_lengths().to_numpy(zero_copy_only=False))
                flat = wanted.flatten()
                number, cid, own = (flat.field(c).to_numpy() for c in ("line_no", "cid", "id"))
                place = of_row[row] + number
                here = np.flatnonzero(place < of_row[row + 1])
                here = here[_names(line, word, int(of_row[-1]))[place[here]] == cid[here]]
                lo, hi = np.searchsorted(line, place[here]), np.searchsorted(line, place[here], "right")
                size = hi - lo
                of, at_word = _each(lo, size)
                held = word[at_word]
                sketch, pieces = _sketches(held, size)
                prefix, token = _tokens(held, size, np.ones(len(size), bool), counts, percent)
                yield pa.record_batch(
                    [
                        pa.array(own[here]), part.column(0).take(pa.array(row[here])), pa.array(number[here]), pa.array(size.astype(np.int32)), pa.array(_parity(of, held, len(size))),
                        _list_array(prefix, token), _list_array(size, held.view(np.int64)), _list_array(pieces, sketch.view(np.int64)),
                    ],
                    ["id", "doc_id", "line_no", "n", "parity", "prefix", "words", "sketch"],
                )

    return run


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches that are sorted by their first two columns, cut anew so that a list lies within one table, and sorted by n in it. Lists of one row are left out."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = [batch.column(i).to_numpy() for i in (0, 1)]
        change = np.flatnonzero((key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1]))
        fresh = bool(kept) and any(kept[-1].column(i)[-1].as_py() != key[i][0] for i in (0, 1))
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut or fresh:
            done = [*kept, batch.slice(0, cut)] if cut else kept
            lists = _by_size(pa.Table.from_batches(done).combine_chunks())
            if lists.num_rows:
                yield lists
            kept = []
        kept.append(batch.slice(cut))
    if kept and (lists := _by_size(pa.Table.from_batches(kept).combine_chunks())).num_rows:
        yield lists


def _list_of(table: pa.Table) -> np.ndarray:
    token, cell = (table.column(c).to_numpy() for c in ("token", "cell"))
    return np.cumsum(np.concatenate([[0], (token[1:] != token[:-1]) | (cell[1:] != cell[:-1])]))


def _by_size(table: pa.Table) -> pa.Table:
    """The lists of two rows or more, each by n."""
    of, n = _list_of(table), table.column("n").to_numpy()
    near = of[1:] == of[:-1]
    many = np.flatnonzero(np.append(near, False) | np.append(False, near))
    return table.take(pa.array(many[np.argsort((of[many] << 32) | n[many])]))


def _meetings(table: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one list that lengths and parity allow, n rising within a list; of two parts of a list, pairs across them."""
    side, own, n, parity = (table.column(c).to_numpy() for c in ("side", "id", "n", "parity"))
    n, parity, of = n.astype(np.int64), parity.view(np.uint64), _list_of(table)
    i = np.arange(len(of))
    for step in range(1, len(of)):
        i = i[i + step < len(of)]
        i = i[(of[i] == of[i + step]) & (100 * n[i] >= percent * n[np.minimum(i + step, len(of) - 1)])]  # further ones are longer still
        if not len(i):
            return
        j = i + step
        fit = (own[i] != own[j]) & ((side[i] < 0) | (side[i] != side[j]))
        fit &= np.bitwise_count(parity[i] ^ parity[j]).astype(np.int64) * (100 + percent) <= (n[i] + n[j]) * (100 - percent)
        if fit.any():
            yield i[fit], j[fit]


def _active(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rows of lists that may have a partner there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _lists(batches):
            n, at, prior = (table.column(c).to_numpy().astype(np.int64) for c in ("n", "at", "prior"))
            prior = np.where(prior < 0, -1 - np.arange(len(prior)), prior)  # none: like no other
            hit = np.zeros(len(n), bool)
            for i, j in _meetings(table, percent):
                # a pair that shares the token before too has been met there
                fit = (prior[i] != prior[j]) & (np.minimum(n[i] - at[i], n[j] - at[j]) * (100 + percent) >= (n[i] + n[j]) * percent)
                hit[i[fit]] = hit[j[fit]] = True
            yield from table.select(_POSTING).take(pa.array(np.flatnonzero(hit))).to_batches()

    return run


class _Held:
    """A list column of the distinct sets ``row`` of a table, to look values up in."""

    def __init__(self, table: pa.Table, name: str, row: np.ndarray) -> None:
        lists = table.column(name).combine_chunks()
        lists = (lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists).take(pa.array(row))
        self.size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.names, self.value = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        self.held = np.sort(np.repeat(np.arange(len(row)), self.size) * len(self.names) + self.value)

    def shared(self, a: np.ndarray, b: np.ndarray, below: np.ndarray | None = None) -> np.ndarray:
        """How many values of set a the set b holds, of each pair; only those under ``below`` where it is given."""
        pair, at = _each(self.begin[a], self.size[a])
        if below is not None:
            low = self.value[at] < np.searchsorted(self.names, below)[pair]
            pair, at = pair[low], at[low]
        asked = b[pair] * len(self.names) + self.value[at]
        found = self.held[np.minimum(np.searchsorted(self.held, asked), len(self.held) - 1)] == asked
        return np.bincount(pair[found], minlength=len(a))


class _Sketches:
    """The bitmaps of the distinct sets ``row`` of a table."""

    def __init__(self, table: pa.Table, row: np.ndarray) -> None:
        lists = table.column("sketch").combine_chunks()
        lists = (lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists).take(pa.array(row))
        self.pieces = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.begin = np.cumsum(self.pieces) - self.pieces
        self.bits = lists.flatten().to_numpy().view(np.uint64)

    def _folded(self, of: np.ndarray, width: int) -> np.ndarray:
        out = self.bits[self.begin[of][:, None] + np.arange(width)]
        for k in range(1, int(self.pieces[of].max()) // width):
            more = np.flatnonzero(self.pieces[of] > k * width)
            out[more] ^= self.bits[self.begin[of][more][:, None] + k * width + np.arange(width)]
        return out

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that one set of a pair has and the other hasn't: no fewer than this."""
        out = np.zeros(len(a), np.int64)
        width = np.minimum(self.pieces[a], self.pieces[b])
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            out[at] = np.bitwise_count(self._folded(a[at], int(w)) ^ self._folded(b[at], int(w))).sum(axis=1)
        return out


def _steps(i: np.ndarray, j: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs in runs of about STEP_WORDS words."""
    step = np.cumsum(n[i]) // STEP_WORDS
    cut = np.flatnonzero(step[1:] != step[:-1]) + 1
    yield from zip(np.split(i, cut), np.split(j, cut), strict=True)


def _sure(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rows of lists where a set meets one first that its whole bitmap doesn't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _lists(batches):
            _, row, of = np.unique(table.column("id").to_numpy(), return_index=True, return_inverse=True)
            sketches, posted = _Sketches(table, row), _Held(table, "prefix", row)
            token, n = table.column("token").to_numpy(), table.column("n").to_numpy().astype(np.int64)
            hit = np.zeros(len(n), bool)
            for some in _meetings(table, percent):
                for i, j in _steps(*some, n):
                    fit = sketches.apart(of[i], of[j]) * (100 + percent) <= (n[i] + n[j]) * (100 - percent)
                    i, j = i[fit], j[fit]
                    fit = posted.shared(of[i], of[j], token[i]) == 0
                    hit[i[fit]] = hit[j[fit]] = True
            yield from table.select(_POSTING).take(pa.array(np.flatnonzero(hit))).to_batches()

    return run


def _fates(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, n_links, later): links of sets that count in a list, and whether one of them leads to an earlier line.

    A pair counts in the list of the rarest posted word that it shares.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _lists(batches):
            _, row, of = np.unique(table.column("id").to_numpy(), return_index=True, return_inverse=True)
            words, posted = _Held(table, "words", row), _Held(table, "prefix", row)
            token, n = table.column("token").to_numpy(), table.column("n").to_numpy().astype(np.int64)
            age = np.empty(len(token), np.int64)
            age[np.lexsort((table.column("line_no").to_numpy(), table.column("doc_id").to_numpy()))] = np.arange(len(token))
            links, later = np.zeros(len(token), np.int64), np.zeros(len(token), bool)
            for some in _meetings(table, percent):
                for i, j in _steps(*some, n):
                    first = posted.shared(of[i], of[j], token[i]) == 0
                    i, j = i[first], j[first]
                    shared = words.shared(of[i], of[j])
                    fit = 100 * shared >= percent * (n[i] + n[j] - shared)
                    i, j = i[fit], j[fit]
                    np.add.at(links, i, 1)
                    np.add.at(links, j, 1)
                    later[np.where(age[i] > age[j], i, j)] = True
            met = pa.array(np.flatnonzero(links))
            told = pa.table({"id": table.column("id"), "n_links": links, "later": later}).take(met)
            yield from told.to_batches()

    return run


def _posted(classes: DataFrame) -> DataFrame:
    """(token, cell, side, id, n, parity, at, prior), sorted by list: the posting lists, long ones in parts.

    A list of more than LIST_SETS sets has parts by a hash of the set; a cell compares one with itself, or two with each other.
    """
    posting = classes.select(F.posexplode("prefix").alias("at", "token"), "id", "n", "parity", F.col("prefix").alias("all"))
    posting = posting.withColumn("prior", F.coalesce(F.when(F.col("at") > 0, F.get("all", F.col("at") - 1)), F.lit(-1))).drop("all")
    posting = posting.where(F.shiftright("token", TOKEN_BITS) > 1)  # a word that occurs once is in one set
    # a list is no longer than its word's count, which the token begins with
    busy = save(posting.where(F.shiftright("token", TOKEN_BITS) > LIST_SETS).groupBy("token").agg(F.count("*").alias("size")).where(F.col("size") > LIST_SETS).select("token", F.ceil(F.col("size") / LIST_SETS).cast("int").alias("parts")), "busy")
    return in_lists(posting, busy)


def in_lists(rows: DataFrame, busy: DataFrame) -> DataFrame:
    """``rows(token, id, ...)`` with cell and side, sorted by list; lists that ``busy(token, parts)`` names come in parts."""
    whole = F.struct(F.lit(0).alias("cell"), F.lit(-1).alias("side"))
    whole_lists = busy.isEmpty()
    if whole_lists:
        dealt = rows.withColumn("to", whole)
    else:
        own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
        cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: F.struct(x.alias("x"), own.alias("own")))
        cells = F.transform(cells, lambda c: F.struct((F.least(c["x"], c["own"]) * F.col("parts") + F.greatest(c["x"], c["own"])).alias("cell"), F.when(c["x"] == c["own"], -1).otherwise((c["own"] > c["x"]).cast("int")).alias("side")))
        dealt = rows.join(busy, "token", "left").withColumn("to", F.explode(F.when(F.col("parts").isNull(), F.array(whole)).otherwise(cells)))
    dealt = dealt.select("token", "to.cell", "to.side", *(c for c in rows.columns if c != "token")).repartition("token", "cell")
    # without parts a token is a list, and one number sorts faster than two
    return dealt.sortWithinPartitions("token") if whole_lists else dealt.sortWithinPartitions("token", "cell")


def similar_lines(text: DataFrame, percent: int = 80) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(occurrences, classes, fates) of the lines of ``text(doc_id, text)``.

    occurrences(doc_id, line_no, cid): lines with a word, each once. classes(cid, first): a class is a set of words, and first
    its first place as struct(doc_id, line_no). fates(cid, n_links, later): how many other classes are of similarity
    percent / 100 or more, for classes with any, and whether one of them has an earlier first place.
    """
    repeats = not text.groupBy("doc_id").count().where("count > 1").isEmpty()
    counts = np.minimum(word_counts(text), 2**22 - 1).astype(np.uint32)
    full = save(text.mapInArrow(_occurrences(counts, percent), "doc_id long, line_no int, cid long, n int, parity long, prefix array<long>"), "lines")
    classes = full.groupBy("cid").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), *(F.first(c, ignorenulls=True).alias(c) for c in ("n", "parity", "prefix")))
    classes = save(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    occurrences = full.select("doc_id", "line_no", "cid")
    occurrences = save(occurrences.distinct() if repeats else occurrences, "occurrences")
    drop(full)
    active = save(_posted(classes).mapInArrow(_active(percent), "token long, cell int, side int, id long"), "active")
    places = save(classes.select("id", "cid", "first"), "places")
    drop(classes)
    wanted = active.select("id").distinct().join(places.where("cid is not null"), "id")
    lines = wanted.groupBy(F.col("first.doc_id").alias("doc_id")).agg(F.collect_list(F.struct("id", "cid", F.col("first.line_no").alias("line_no"))).alias("lines"))
    lines = save(lines, "wanted")
    with pruning(text.sparkSession):
        sets = text.join(lines.where("lines is not null"), "doc_id").select("doc_id", "text", "lines").mapInArrow(
            _sets_of(counts, percent), "id long, doc_id long, line_no int, n int, parity long, prefix array<long>, words array<long>, sketch array<long>"
        )
        sets = save(sets.dropDuplicates(["id"]) if repeats else sets, "sets")
    drop(lines)
    listed = lambda rows, *more: rows.join(sets, "id").select(*_POSTING, "n", "parity", *more).repartition("token", "cell").sortWithinPartitions("token", "cell")
    sure = save(listed(active, "prefix", "sketch").mapInArrow(_sure(percent), "token long, cell int, side int, id long"), "sure")
    fates = listed(sure, "doc_id", "line_no", "prefix", "words").mapInArrow(_fates(percent), "id long, n_links long, later boolean").groupBy("id").agg(F.sum("n_links").alias("n_links"), F.bool_or("later").alias("later"))
    fates = save(places.join(fates, "id").select("cid", "n_links", "later"), "fates")
    for table in (active, sets, sure):
        drop(table)
    return occurrences, places.select("cid", "first"), fates


def line_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_lines, n_links, removed) for each doc_id of ``docs(doc_id, text)``.

    Lines end at line feeds; a line's set holds its distinct words (A-Z lower-cased, between ASCII white space), and
    lines without words count for nothing and stay. A line is removed if a line before it, by (doc_id, line number),
    has a set of Jaccard similarity ``percent`` / 100 or more, removed itself or not. removed lists line numbers from
    0 in order, n_lines counts lines with words, and n_links adds up, over those lines, how many different sets
    resemble theirs. Null, empty and wordless texts have no lines. Rows that repeat a doc_id count as one document
    with the lines of each; a line that two of them have alike in the same place counts once. Rows with a null doc_id
    are left out. An empty table gives an empty result. Other columns play no part.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    occurrences, classes, fates = similar_lines(text.where("text is not null"), percent)
    each = occurrences.join(classes.join(fates, "cid", "left"), "cid")
    gone = F.coalesce("later", F.lit(False)) | (F.struct("doc_id", "line_no") != F.col("first"))
    each = each.groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.sum(F.coalesce("n_links", F.lit(0))).alias("n_links"), F.array_sort(F.collect_set(F.when(gone, F.col("line_no")))).alias("removed")
    )
    none = F.array().cast("array<int>")
    return text.select("doc_id").distinct().join(each, "doc_id", "left").select(
        "doc_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_lines", "n_links")), F.coalesce("removed", none).alias("removed")
    )


def without_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` with the lines that ``removed(doc_id, removed)`` names taken out of text; other columns as they are."""
    key, own = "__removed_of", "__removed_lines"  # no column of ``docs``
    named = removed.select(F.col("doc_id").alias(key), F.col("removed").alias(own))
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.when(~F.array_contains(own, i), x)), lambda x: x.isNotNull())
    cleaned = F.when(F.col(own).isNull(), F.col("text")).otherwise(F.array_join(lines, "\n"))
    return docs.join(named, docs["doc_id"] == named[key], "left").withColumn("text", cleaned).select(*docs.columns)
