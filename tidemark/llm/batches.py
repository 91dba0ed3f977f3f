"""Arrow batches as flat byte buffers, and the words in them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE_BYTES = 4 << 20
PIECE_ROWS = 50_000
STEP_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: words as contracts 3 and 5 cut them: everything but blank and the controls 9 to 13
SPACED = np.ones(256, dtype=bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
#: words as contract 8 cuts them: letters, digits and every byte of a non-ASCII character
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, one text after the other, and the len + 1 borders; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    size = np.dtype(np.int64).itemsize
    borders = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * size)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[borders[0] : borders[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, borders - borders[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows of at most PIECE_BYTES of text; a longer text comes alone and whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, borders = flat(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(borders, borders[at] + PIECE_BYTES, side="right")) - 1
            end = min(max(end, at + 1), at + PIECE_ROWS, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def with_text_columns(
    docs: DataFrame,
    text: str,
    compute: Callable[[np.ndarray, np.ndarray], dict[str, pa.Array]],
    fields: Sequence[T.StructField],
    keep: Sequence[str],
) -> DataFrame:
    """``keep`` columns plus what ``compute(bytes, borders)`` makes of the text, in Arrow batches.

    A kept column with the name of a computed one gives way to it.
    """
    names = {f.name for f in fields}
    keep = [c for c in keep if c not in names]
    carried = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = T.StructType([carried.schema[c] for c in keep] + list(fields))

    def run(batches):
        for piece in pieces(batches, "__text"):
            made = compute(*flat(piece.column("__text")))
            yield pa.RecordBatch.from_arrays(
                [piece.column(c) for c in keep] + [made[f.name] for f in fields], names=[f.name for f in schema]
            )

    return carried.mapInArrow(run, schema)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class Powers:
    """Powers of BASE and of its inverse modulo 2**64, as many as asked for."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> None:
        if len(cls.up) < n:
            n = max(n, STEP_BYTES + 1)
            for name, base in (("up", BASE), ("down", np.uint64(_inverse(int(BASE))))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Words:
    """Borders, 64-bit hashes (of lower-cased bytes) and per-text ranges of all words of a run of texts."""

    def __init__(self, data: np.ndarray, borders: np.ndarray, table: np.ndarray, hashes: bool = True):
        inside = table[data]
        before = np.concatenate(([False], inside[:-1])) if len(data) else inside
        first = borders[:-1][np.diff(borders) > 0]
        before[first] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.concatenate((inside[1:], [False])) if len(data) else inside
        after[first[1:] - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.bounds = np.searchsorted(self.start, borders)
        self.count = np.diff(self.bounds)
        self.hash = self._hashes(data) if hashes else None

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.start), np.uint64)
        at = 0
        while at < len(out):
            base = self.start[at]
            to = max(int(np.searchsorted(self.end, base + STEP_BYTES, side="right")), at + 1)
            part = LOWER[data[base : self.end[to - 1]]].astype(np.uint64) + np.uint64(1)
            Powers.upto(len(part) + 1)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * Powers.up[: len(part)], dtype=np.uint64)))
            a, b = self.start[at:to] - base, self.end[at:to] - base
            out[at:to] = (sums[b] - sums[a]) * Powers.down[a]
            at = to
        return mixed(out)

    def owner(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.count)), self.count)
