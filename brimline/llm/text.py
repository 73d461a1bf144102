"""Words and their hashes for whole columns of text, as numpy arrays inside Arrow tasks.

A text is looked at as UTF-8 bytes. Spans are hashed with a polynomial over prefix sums modulo 2**64, so that a hash of any
span costs the same whatever its length, and mixed afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

#: Words are runs of bytes outside this set (space, tab to carriage return).
SPACES = b" \t\n\v\f\r"


def table_of(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


SPACE_TABLE = table_of(SPACES)
#: Everything in ASCII that is neither a letter nor a digit.
NOT_ALNUM = table_of(bytes(i for i in range(128) if not chr(i).isalnum()))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int) -> np.ndarray:
    """base ** 0 .. n modulo 2**64; kept in the worker for lengths of one chunk."""
    known = _powers.get(base)
    if known is not None and len(known) > n:
        return known[: n + 1]
    out = np.empty(n + 1, np.uint64)
    out[0], filled = 1, 1
    while filled <= n:
        step = min(filled, n + 1 - filled)
        out[filled : filled + step] = out[:step] * np.uint64(pow(base, filled, 1 << 64))
        filled += step
    if n <= 2 * CHUNK_BYTES:
        _powers[base] = out
    return out


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hash of values[start:end] for each span; it depends on the values and their number only."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(n, _BASE)[:n], out=total[1:])
    sums = (total[ends] - total[starts]) * powers(n, _INVERSE)[starts]
    return mix(sums + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def utf8(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets between them; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays([c.cast(pa.large_string()) for c in texts.chunks]) if texts.num_chunks else pa.array(
            [], pa.large_string())
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(
        texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(texts: pa.ChunkedArray | pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of whole texts of about `size` bytes; a longer text is a run of its own."""
    data, offsets = utf8(texts)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE_TABLE) -> tuple[np.ndarray, ...]:
    """Starts and ends of words in bytes, and the n + 1 offsets of texts in words. Words never cross texts."""
    inside = ~breaks[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False,
                breaks: np.ndarray = SPACE_TABLE) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and the offsets of texts in words."""
    data = LOWER[data] if lower else data
    starts, ends, firsts = words(data, offsets, breaks)
    return span_hashes(data, starts, ends), firsts


def all_word_hashes(texts: pa.ChunkedArray | pa.Array, lower: bool = False,
                    breaks: np.ndarray = SPACE_TABLE) -> tuple[np.ndarray, np.ndarray]:
    """As word_hashes, for a whole column, chunk after chunk."""
    parts, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for _, data, offsets in chunks(texts):
        h, firsts = word_hashes(data, offsets, lower, breaks)
        parts.append(h)
        counts.append(np.diff(firsts))
    return np.concatenate(parts), np.cumsum(np.concatenate(counts))


def windows(values: np.ndarray, firsts: np.ndarray, size: int, short: bool = False) -> tuple[np.ndarray, ...]:
    """Hash, text number and first word of every run of `size` words within a text.

    With short, a text of fewer words, but not none, is one run; without, it has none.
    """
    n = np.diff(firsts)
    runs = np.maximum(n - size + 1, ((n > 0) if short else np.zeros(len(n), bool)).astype(np.int64))
    text = np.repeat(np.arange(len(n)), runs)
    at = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
    begin = firsts[text] + at
    return span_hashes(values, begin, np.minimum(begin + size, firsts[text + 1])), text, at
