"""Two tables met without a shuffle of pairs: one is sent to the workers in blocks of bounded size, the other streams by.

Every block is a broadcast of its own. Executors keep them as files; a worker reads one, uses it for a tile of the rows
that stream by, and lets it go: it holds one block and one tile, however many there are. Each table is read once.
"""
from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

TILE_BYTES = 1 << 24


def opened(block):
    """The value of a broadcast, which the worker does not keep."""
    value = block.value
    if getattr(block, "_path", None) is not None and hasattr(block, "_value"):
        del block._value  # read from its file the next time
    return value


def trim() -> None:
    """Give free memory back: the worker stays for tasks of other steps."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def tiled(batches, rows: int) -> Iterator[pa.Table]:
    """Consecutive Arrow batches as tables of at most ``rows`` rows, and of about ``TILE_BYTES``."""
    held, n, size = [], 0, 0
    for b in batches:
        at = 0
        while at < len(b):
            part = b.slice(at, rows - n)
            held.append(part)
            at, n, size = at + len(part), n + len(part), size + part.nbytes
            if n == rows or size >= TILE_BYTES:
                yield pa.Table.from_batches(held)
                held, n, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def matrix(column, width: int | None = None) -> np.ndarray:
    """An array column as rows of doubles; all of one length, none null."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = rows.value_lengths().to_numpy(zero_copy_only=False)
    width = width if width is not None and not len(size) else int(size[0]) if len(size) else 0
    if (size != width).any():
        raise ValueError("vectors of different length")
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), width)


def drop_self(s: np.ndarray, qids: np.ndarray, cids: np.ndarray) -> None:
    """-inf where a query meets itself; only rows of queries among the candidates are looked at."""
    rows = np.flatnonzero(np.isin(qids, cids))
    if len(rows):
        at, col = np.nonzero(qids[rows][:, None] == cids[None, :])
        s[rows[at], col] = -np.inf


def hits(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the true cells, few of many."""
    return np.divmod(np.flatnonzero(mask), max(1, mask.shape[1]))


class Rows:
    """Columns of some rows: numpy arrays by name, of array columns matrices."""

    def __init__(self, columns: dict[str, np.ndarray]):
        self.columns = columns

    @classmethod
    def of(cls, table: pa.Table, names) -> Rows:
        return cls({n: matrix(table[n]) if pa.types.is_list(table.schema.field(n).type) or pa.types.is_large_list(table.schema.field(n).type)
                    else table[n].to_numpy() for n in names})

    def __len__(self) -> int:
        return len(self.columns["id"])

    def __getitem__(self, name: str) -> np.ndarray:
        return self.columns[name]

    def take(self, of) -> Rows:
        return Rows({n: c[of] for n, c in self.columns.items()})
