"""What the operators with Python workers share: bounded Arrow batches and the shared folder's files."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs

#: Rows are handled in slices of at most so many bytes of text (one longer text is a slice of its own).
SLICE_BYTES = 8 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that `column` holds about `most` bytes in each.

    Pieces are copies: some of Arrow's string kernels misread the offsets of a slice.
    Memory freed since the last slice goes back to the system, so that a worker that
    serves one task after another stays as small as its largest slice needs.
    """
    for batch in batches:
        n, size = batch.num_rows, batch.column(batch.schema.get_field_index(column)).nbytes
        step = max(1, n * most // max(size, 1)) if size > most else n
        for i in range(0, n, max(step, 1)):
            yield batch if step >= n else batch.take(pa.array(np.arange(i, min(i + step, n))))
            give_back()


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it


def give_back() -> None:
    """Return what Arrow's pool and the C library hold free."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """Null texts become empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's URI, and the folder's path in it."""
    if not urlparse(folder).scheme:
        return pafs.LocalFileSystem(), folder
    return pafs.FileSystem.from_uri(folder)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column as large strings (over 2 GB fit), nulls as empty texts."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(name)).cast(pa.large_string()), "")


def word_codes(array: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Of large strings without nulls: (distinct words, codes, offsets).  Words offsets[i] up to offsets[i + 1] of codes are text i's, split at ASCII white space."""
    blank = np.arange(256, dtype=np.uint8)
    blank[9:14] = 32
    _, ends, data = array.buffers()
    if data is not None:  # white space is a byte of its own in UTF-8, so bytes can be replaced in place
        data = pa.py_buffer(blank[np.frombuffer(data, np.uint8)])
    split = pc.split_pattern(pa.LargeStringArray.from_buffers(len(array), ends, data, offset=array.offset), " ")
    offsets = np.asarray(split.offsets, dtype=np.int64)
    flat = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    names, codes, offsets = flat.dictionary.to_numpy(zero_copy_only=False).tolist(), np.asarray(flat.indices, dtype=np.int64), offsets - offsets[0]
    if "" in names:  # between neighbouring blanks
        gone = codes == names.index("")
        left = np.concatenate([[0], np.cumsum(~gone)])
        codes, offsets = codes[~gone], left[offsets]
    return names, codes, offsets


class Ragged:
    """Arrays of integers by key, kept in one flat array; `gather` concatenates those of many keys at once."""

    def __init__(self, dtype: str):
        self.dtype, self.number, self.flat, self.ends = dtype, {}, np.empty(1024, dtype), np.zeros(1025, np.int64)
        self.count = self.used = 0

    def extend(self, keys: list, lengths: np.ndarray, values: np.ndarray) -> None:
        n = self.count + len(keys)
        if n + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(max(n, len(self.ends)), np.int64)])
        if self.used + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(len(values), len(self.flat)), self.dtype)])
        self.flat[self.used : self.used + len(values)] = values
        self.ends[self.count + 1 : n + 1] = self.used + np.cumsum(lengths)
        self.number.update(zip(keys, range(self.count, n)))
        self.count, self.used = n, self.used + len(values)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, lengths) of the keys with these numbers, in order."""
        begin = self.ends[numbers]
        lengths = self.ends[numbers + 1] - begin
        shift = np.repeat(begin - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(begin) else begin, lengths)
        return self.flat[shift + np.arange(len(shift))], lengths
