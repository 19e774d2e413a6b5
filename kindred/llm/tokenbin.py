"""Token ids as files: blocks of ids, transposed into byte planes, each compressed with zstandard.

File: chunks, then a JSON index, then its length (8 bytes) and the magic.  A
chunk holds up to CHUNK ids as little-endian unsigned 32-bit integers, as four
byte planes; plane k holds byte k of every id.  The index lists for each chunk
its offset, its number of ids and its planes' lengths, and for the file's
documents, as compressed integer arrays, their ids and lengths.  A reader can
fetch any chunk alone.

Documents are written in ascending id order: rows are dealt out by ranges of
ids, so file k holds smaller ids than file k + 1.  Every attempt of a task
writes a file of its own name, and only the files listed in the written index
table are read; what a lost task left behind is never looked at.

Texts are encoded word by word where the tokenizer's file shows that no
pre-token crosses white space, and marks behind Latin letters are words of
their own (WORDWISE).  A word of Latin letters alone is what its normalizer and
pre-tokenizer leave it, but for case and spelling by bytes, so it goes straight
to the model; other words take the library's whole way.  A worker keeps the ids of words it has met, up to
CACHE_BYTES of them, and drops them all when these are full or the task ends.
Texts are encoded whole with any other tokenizer.

Files.  Their number grows with the bytes of text, FILE_BYTES at most in each
but for one longer text; a reader gives rows back READ_DOCS at a time, so
neither end holds more than a chunk and a file's index.

Defined results.  A null text counts as empty: it has the end id alone.  Null
document ids come first.  Rows that repeat an id, ties and copies among them,
follow one another and are all kept.  A very long text is encoded and written
whole, over as many chunks as it takes.  Only the id and text columns are read,
so others may have any name.  An empty table writes no file and gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, compress, islice, repeat
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.arrow import Ragged, column, filesystem, slices, word_codes
from kindred.llm.common import materialize, new_folder, ship, text_of

CHUNK, END_ID, MAGIC = 1 << 16, 1, b"BPLANES1"
CACHE_BYTES, SLICE, FILE_BYTES, READ_DOCS = 48 << 20, 2 << 20, 128 << 20, 4096
#: What a kept word takes beside its characters and ids: its string's head, its place in the table, its number.
WORD_BYTES = 170
#: A Latin letter and the ASCII marks behind it at a word's end; no apostrophe, no < > |.
_TAIL = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-;=?-@\[-`{}~]+)(\s|$)"
#: Words that are one pre-token: composed letters whose small form is one letter.
_LETTERS = re.compile("[a-zÀ-ÖØ-öø-ÿ]+")
#: What the byte-level pre-tokenizer writes for bytes of these letters (of ß, à, í) that aren't their own sign.
_BYTES = {"\x9f": "\u0141", "\xa0": "\u0142", "\xad": "\u0143"}
#: The normalizer and pre-tokenizer under which words may be encoded apart.
WORDWISE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, lengths) of lists of ids."""
    return np.fromiter(chain.from_iterable(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids))


class WordEncoder:
    """Ids of texts, by a tokenizers file; the ids of words are kept between calls."""

    def __init__(self, path: str):
        # A task has one core.  Threads of the library's own would each keep a heap, which grows from task to task.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # Added tokens are looked for first: with <| and no blank in each, they are in no word of letters and in one word whole.
        added = [t["content"] for t in spec.get("added_tokens") or []]
        self.wordwise = all(spec.get(k) == v for k, v in WORDWISE.items()) and all("<|" in t and not re.search(r"\s", t) for t in added)
        self.forget()

    def forget(self) -> None:
        self.known, self.held = Ragged("<u4"), 0

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of texts, as the tokenizer gives them."""
        return _flat([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def _letter_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words of _LETTERS, by the model alone."""
        spelled = "\n".join(words).lower().encode().decode("latin-1")
        for byte, sign in _BYTES.items():
            spelled = spelled.replace(byte, sign)
        tokenize = self.tokenizer.model.tokenize
        return _flat([[t.id for t in tokenize(w)] for w in spelled.split("\n")])

    def __call__(self, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): unsigned 32-bit ids of all texts, text i's from offsets[i] on, the end id last."""
        if not self.wordwise:
            values, lengths = self._ids(batch.to_pylist())
            ends = np.concatenate([[0], np.cumsum(lengths)])
        else:
            if self.held > CACHE_BYTES:
                self.forget()
            # Lower-casing first, as the normalizer would, and marks set apart make fewer distinct words; not where a special token or a combining mark could be met.
            plain = pc.replace_substring_regex(pc.ascii_lower(batch), _TAIL, r"\1 \2\3")
            words, codes, offsets = word_codes(pc.if_else(pc.match_substring_regex(batch, r"<\||\p{M}"), batch, plain))
            number = self.known.number
            numbers = np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words))
            at = np.flatnonzero(numbers < 0)
            new = [words[i] for i in at]
            letters = [_LETTERS.fullmatch(w) is not None for w in new]
            for some, ids in ((list(compress(new, letters)), self._letter_ids), (list(compress(new, map(not_, letters))), self._ids)):
                for i in range(0, len(some), 5_000):
                    values, lengths = ids(part := some[i : i + 5_000])
                    self.known.extend(part, lengths, values)
                    self.held += sum(map(len, part)) + WORD_BYTES * len(part) + values.nbytes
            numbers[at] = np.fromiter(map(number.__getitem__, new), np.int64, len(new))
            values, lengths = self.known.gather(numbers[codes])
            ends = np.concatenate([[0], np.cumsum(lengths)])[offsets]
        return np.insert(values, ends[1:], END_ID).astype("<u4", copy=False), ends + np.arange(len(ends))


def planes(ids: np.ndarray, level: int = 3) -> list[bytes]:
    """The four byte planes of ids, compressed."""
    z = zstandard.ZstdCompressor(level=level)
    table = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return [z.compress(p.tobytes()) for p in table]


def unplanes(parts: list[bytes], n: int) -> np.ndarray:
    z = zstandard.ZstdDecompressor()
    table = np.empty((4, n), np.uint8)
    for k, p in enumerate(parts):
        table[k] = np.frombuffer(z.decompress(p, max_output_size=max(n, 1)), np.uint8)
    return np.ascontiguousarray(table.T).view("<u4").reshape(-1)


class Writer:
    """One file; ids come in by documents and leave by chunks."""

    def __init__(self, out):
        self.out, self.pending, self.held, self.at, self.chunks = out, [], 0, 0, []
        self.doc_ids, self.lengths = [], []

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= CHUNK:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.empty(0, "<u4")
        end = len(ids) if all_of_it else len(ids) // CHUNK * CHUNK
        for i in range(0, end, CHUNK):
            parts = planes(part := ids[i : min(i + CHUNK, end)])
            self.chunks.append([self.at, len(part), [len(p) for p in parts]])
            for p in parts:
                self.out.write(p)
                self.at += len(p)
        self.pending, self.held = [ids[end:]], len(ids) - end

    def close(self) -> int:
        """The number of ids in the file."""
        self._flush(True)
        index = zstandard.compress(json.dumps({"chunks": self.chunks, "doc_ids": self.doc_ids, "lengths": self.lengths}).encode())
        self.out.write(index + len(index).to_bytes(8, "little") + MAGIC)
        self.out.close()
        return sum(self.lengths)


def read_index(f) -> dict:
    size = f.size()
    f.seek(size - 16)
    tail = f.read(16)
    assert tail[8:] == MAGIC, "not a file of byte planes"
    n = int.from_bytes(tail[:8], "little")
    f.seek(size - 16 - n)
    return json.loads(zstandard.decompress(f.read(n)))


def read_documents(f) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, ids) of each document of an open file, chunk by chunk."""
    index = read_index(f)
    chunks, buffer = iter(index["chunks"]), np.empty(0, "<u4")
    for doc_id, n in zip(index["doc_ids"], index["lengths"]):
        parts, have = [buffer], len(buffer)
        while have < n:
            at, m, lengths = next(chunks)
            f.seek(at)
            parts.append(unplanes([f.read(k) for k in lengths], m))
            have += m
        whole = np.concatenate(parts) if len(parts) > 1 else buffer
        yield doc_id, whole[:n]
        buffer = whole[n:]


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write docs' ids; the index table: part, path, docs, tokens, a row for each file."""
    spark = docs.sparkSession
    ship(spark)
    folder = folder or new_folder(spark, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer = None
        for batch in slices(batches, "text", SLICE):
            if writer is None:
                fs, root = filesystem(folder)
                fs.create_dir(root, recursive=True)
                name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.planes"
                writer, encode = Writer(fs.open_output_stream(f"{root}/{name}")), WordEncoder(tokenizer)
            ids, ends = encode(column(batch, "text"))
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                writer.add(doc_id, ids[ends[k] : ends[k + 1]])
        if writer is not None:
            n = writer.close()
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "path": [name], "docs": [len(writer.lengths)], "tokens": [n]}, pa.schema([("part", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(F.col(text_col)).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 64)).head()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    ordered = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    files = ordered.mapInArrow(run, "part int, path string, docs long, tokens long")
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens")
    files = materialize(files, "token-files")  # written once: the files it lists are the ones that count
    return files.withColumns({"start": before, "folder": F.lit(folder)})


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files that an index table lists."""
    ship(files.sparkSession)
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in chain.from_iterable(b.to_pylist() for b in batches):
            fs, root = filesystem(row["folder"])
            at = row["start"]
            with fs.open_input_file(f"{root}/{row['path']}") as f:
                documents = ((doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for doc_id, ids in read_documents(f))
                while some := list(islice(documents, READ_DOCS)):
                    doc_ids, counts, sums = zip(*some)
                    ends = at + np.cumsum(counts, dtype=np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc_ids, [at, *ends[:-1]], counts, sums)], names=names)
                    at = int(ends[-1])

    n = max(1, files.count())
    return files.repartition(n, "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def report(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Encode docs, write the files, read them back."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return read(write(docs, tokenizer))
