"""Hashes of words and of word shingles for Arrow batches of texts, by whole-array numpy operations.

A word's hash is a polynomial over its bytes modulo 2**64, mixed by a bijection. Prefix sums give all
words of a batch at once. Two different words share a hash with a chance near 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text that the arrays of one step cover: small enough for a core's cache.
CHUNK_BYTES = 1 << 18

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
#: Bytes of a word that are hashed eight at a time; longer words are hashed by prefix sums.
SHORT_BYTES = 64
_PIECE = np.uint64(0x9FB21C651E98DF25)
_LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
#: Everything in ASCII but letters and digits; bytes of other characters belong to words.
NON_ALNUM = np.ones(256, bool)
NON_ALNUM[48:58] = NON_ALNUM[65:91] = NON_ALNUM[97:123] = NON_ALNUM[128:] = False

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("step", ())) < n:
        size = max(n, CHUNK_BYTES * 2)
        for name, base in (("step", _STEP), ("back", _BACK)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["step"], _powers["back"]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over all output bits."""
    x = x ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in one array, and the offsets of its rows; nulls are empty."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``limit`` bytes of text (a longer text stands alone), as (rows, bytes, offsets)."""
    raw, at = text_bytes(batch.column(batch.schema.get_field_index(text)))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(at, at[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin), raw[at[begin] : at[end]], at[begin : end + 1] - at[begin]
        begin = end


def words(raw: np.ndarray, at: np.ndarray, apart: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each word in the bytes ``raw``, and the offsets of each row's words."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    gap = apart[raw]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = gap[:-1], gap[1:]
    before[at[:-1][at[:-1] < n]] = True
    after[at[1:][at[1:] > 0] - 1] = True
    start, end = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
    step, back = _power_tables(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * step[:n], out=total[1:])
    value = (total[end] - total[start]) * back[start]
    return mix(value + (end - start).astype(np.uint64) * _STEP), start, end, np.searchsorted(start, at)


def plain_words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, offsets) of the words that ``words`` finds between ASCII white space, with hashes of another kind that take half its time."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    inside = ~((raw == 32) | (raw - np.uint8(9) < 5))
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin, end = at[:-1][at[:-1] < n], at[1:][at[1:] > 0] - 1
    first[begin], last[end] = inside[begin], inside[end]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    lower = np.zeros(n + 8, np.uint8)
    np.add(raw, (raw - np.uint8(65) < 26).view(np.uint8) << np.uint8(5), out=lower[:n])
    eight = np.ndarray((n + 1,), "<u8", lower.data, 0, (1,))  # the eight bytes from each place
    size = end - start
    value = mix((eight[start] & _LOW_BYTES[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * _STEP))
    more = np.flatnonzero((size > 8) & (size <= SHORT_BYTES))
    for k in range(8, SHORT_BYTES, 8):
        if not len(more):
            break
        left = size[more] - k
        value[more] = mix(value[more] * _PIECE ^ (eight[start[more] + k] & _LOW_BYTES[np.minimum(left, 8)]))
        more = more[left > 8]
    long = np.flatnonzero(size > SHORT_BYTES)
    if len(long):
        step, back = _power_tables(n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[raw] * step[:n], out=total[1:])
        value[long] = mix((total[end[long]] - total[start[long]]) * back[start[long]] + size[long].astype(np.uint64) * _STEP)
    return value, np.searchsorted(start, at)


def shingles(word: np.ndarray, at: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``k`` words; a row with fewer words gives its whole sequence as one."""
    count = np.diff(at)
    rows, values = [], []
    if len(word) >= k:
        value = np.zeros(len(word) - k + 1, np.uint64)
        for j in range(k):
            value += word[j : len(word) - k + 1 + j] * _PLACE[j]
        row = np.repeat(np.arange(len(count)), count)
        inside = np.arange(len(value)) + k <= at[1:][row[: len(value)]]
        rows.append(row[: len(value)][inside])
        values.append(mix(value[inside], k))
    for size in range(1, k):  # hashed as a run of so many words is
        short = np.flatnonzero(count == size)
        if len(short):
            value = np.zeros(len(short), np.uint64)
            for j in range(size):
                value += word[at[short] + j] * _PLACE[j]
            rows.append(short)
            values.append(mix(value, size))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(values)


def distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (row, value) once, ordered by row and then value."""
    if not len(row):
        return row, value
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[first], value[first]
