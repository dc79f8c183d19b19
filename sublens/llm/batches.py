"""Arrow batches of texts: bytes with offsets, words with hashes, all as numpy arrays.

Texts come as one byte array per slice of a batch. Slices hold about ``SLICE`` bytes or a single
longer text, so a task's memory follows the longest text, not the size of a partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

SLICE = 2 << 20
ROWS = 1000

# Separators of the two kinds of words; bytes from 0x80 on always belong to words.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_table(separators: bytes) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and n + 1 offsets. A null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    _, offsets = bytes_of(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def mapped(
    df: DataFrame,
    added: dict[str, T.DataType],
    start: Callable[[], Callable[[pa.Array], list]],
    keep: list[str],
    text: str = "text",
    limit: int = SLICE,
) -> DataFrame:
    """Columns ``keep`` of ``df`` and, by their names, what the function makes of each slice's texts.

    ``start`` is called once per task and returns that function, which returns an array per added column.
    Columns travel by position, so names may clash.
    """
    spark = df.sparkSession
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    kinds = [to_arrow_type(kind) for kind in added.values()]
    carried = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in batches:
            for part in slices(batch, carried, limit):
                made = function(part.column(carried))
                arrays = [x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:carried], *[x.cast(k) for x, k in zip(arrays, kinds)]],
                    [f"c{i}" for i in range(carried + len(arrays))],
                )

    fields = [T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(keep)]
    fields += [T.StructField(f"c{carried + i}", kind) for i, kind in enumerate(added.values())]
    given = df.select(*[df[c].alias(f"c{i}") for i, c in enumerate(keep)], df[text].alias(f"c{carried}"))
    return given.mapInArrow(run, T.StructType(fields)).toDF(*keep, *added)


class Words:
    """Words of some texts: byte ranges start..end in ``data`` (A-Z lower-cased), word range of text t
    is first[t]..first[t + 1]."""

    def __init__(self, texts: pa.Array, separators: bytes):
        raw, self.offsets = bytes_of(texts)
        self.data = _LOWER[raw]
        self.separators = separators
        inside = word_table(separators)[self.data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        borders = self.offsets[1:-1]
        borders = borders[(borders > 0) & (borders < len(raw))]
        opens[borders] = inside[borders]
        closes[borders - 1] = inside[borders - 1]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, self.offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def room(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.start))

    def hashes(self) -> np.ndarray:
        return hashed(self.data, self.start, self.end, _codes(self.separators))


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FACTOR = np.uint64(0xD1342543DE82EF95)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """_FACTOR ** i for i < n."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers)), _FACTOR)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the word."""
    h = h ^ (h >> np.uint64(32))
    h = h * _MULTIPLIER
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64))


def _codes(separators: bytes) -> np.ndarray:
    codes = BYTE_CODES.copy()
    codes[list(separators)] = 0
    return codes


def hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray, codes: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """64-bit hash of each byte range; between ranges there are only bytes of code 0."""
    out = np.zeros(len(start), np.uint64)
    for a in range(0, len(start), block):
        s, e = start[a : a + block], end[a : a + block]
        base = s[0]
        spans = np.diff(np.append(s, e[-1]))
        place = np.arange(e[-1] - base) - np.repeat(s - base, spans)
        out[a : a + block] = np.add.reduceat(
            codes[data[base : e[-1]]] * powers(int(spans.max()))[place], s - base
        )
    return mixed(out)


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive word hashes; len(words) - n + 1 of them, ends of texts not minded."""
    count = max(0, len(words) - n + 1)
    out = np.full(count, n, np.uint64)
    for k in range(n):
        out *= _FACTOR
        out += words[k : k + count]
    return mixed(out)
