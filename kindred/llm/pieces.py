"""SentencePiece encoding and decoding by a shared-prefix forward pass.

A text becomes marked words: each blank turns into the mark, one mark is put in
front, and a word is a run of marks with what follows up to the next mark.  No
piece of the model has a mark behind another character, so words are encoded
apart.  The distinct words of a slice are sorted, which lays them out as a trie
in depth-first order; each word keeps the forward states of the prefix it
shares with the word before it and computes only the rest.

Two forward passes, by the model file's type:

- Unigram: Viterbi.  A state is the best total score of a prefix and the start
  of its last piece; a longer word takes over the scores of the shared prefix.
- BPE: its segmentation is not that of the best total score, so a state holds no
  score.  The segmentation of a prefix ends in one piece t, and what precedes t
  is the segmentation of the shorter prefix; t fits if merging t and the piece
  before it gives these two again.  Exactly one piece fits at each position, so
  a state is the last piece, found among the vocabulary's pieces that end there,
  longest first.

Models that change characters or drop blanks before encoding are refused.
Ids equal those of the public library; tests hold this on all test texts for
the public BPE model, and for a unigram model of a few pieces.  Other types
(word, char) are refused.

With byte fallback, characters that no piece covers become byte pieces; else a
run of them is one unknown id.

Defined results.  Null and empty texts have no ids and decode to the empty
text.  Decoding gives the exact text back, except that a mark in the text
itself comes back as a blank, as with the public library, and unknown ids as
nothing.  Very long texts are one word list, encoded whole.  Every row is
encoded on its own account, repeated ones and ties too.  Only the id and text
columns are read, so others may have any name.  An empty table gives no rows.
A worker keeps KEPT_WORDS words and KEPT_PAIRS pairs of pieces at most between
slices of SLICE bytes.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.arrow import Ragged, column, slices
from kindred.llm.common import ship, text_of

KEPT_WORDS, KEPT_PAIRS, SLICE = 250_000, 400_000, 2 << 20
UNIGRAM, BPE = 1, 2
MARK = "▁"
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def marked(text: str) -> list[str]:
    """The marked words of a text."""
    return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message, its fixed-width fields left out."""
    i = 0

    def varint() -> int:
        nonlocal i
        out = shift = 0
        while True:
            byte = data[i]
            i, out, shift = i + 1, out | (byte & 127) << shift, shift + 7
            if byte < 128:
                return out

    while i < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            n = varint()
            yield key >> 3, data[i : i + n]
            i += n
        else:
            i += {1: 8, 5: 4}[kind]


def model_spec(path: str) -> tuple[dict, dict]:
    """The trainer's and the normalizer's settings in a model file, by field number."""
    with open(path, "rb") as f:
        parts = {k: v for k, v in _fields(f.read()) if k in (2, 3)}
    # Fixed values, of the format: 3 the type, 35 byte fallback; 2 a table of characters, 3 a mark in front, 4 extra blanks removed, 5 blanks as marks.
    return {3: UNIGRAM, 35: 0} | dict(_fields(parts.get(2, b""))), {2: b"", 3: 1, 4: 1, 5: 1} | dict(_fields(parts.get(3, b"")))


class Model:
    """Pieces and scores of a SentencePiece model file, with its forward pass."""

    def __init__(self, path: str):
        import sentencepiece

        spec, normal = model_spec(path)
        self.type = spec[3]
        if self.type not in (UNIGRAM, BPE) or normal[2] or [normal[k] for k in (3, 4, 5)] != [1, 0, 1]:
            raise ValueError(f"not a unigram or BPE model that leaves characters and blanks as they are: {path}")
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n, self.fallback = sp.get_piece_size(), bool(spec[35])
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        self.ids = {self.piece[i]: i for i in range(n) if not special[i]}
        self.rank = {self.piece[i]: -sp.get_score(i) for i in range(n) if not special[i]}
        self.score = {p: -r for p, r in self.rank.items()}
        self.unknown, self.lowest = sp.unk_id(), min(self.score.values(), default=0.0) - 10.0  # fixed value: an unknown character scores 10 under the least piece
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.bytes)} if self.fallback else {}
        self.control = {i for i in range(n) if special[i]} - self.byte_of.keys()
        self.longest = max(map(len, self.ids), default=1)
        self.cuts = self.type == BPE and not any("\n" in p and p != "\n" for p in self.ids)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known, self.raw = Ragged("<i4"), None

    def merge(self, text: str) -> list[str]:
        """Plain BPE: join the adjacent parts whose union has the best rank, leftmost first, while there are any."""
        parts = list(text)
        while len(parts) > 1:
            best = min(((self.rank[u], i) for i in range(len(parts) - 1) if (u := parts[i] + parts[i + 1]) in self.rank), default=None)
            if best is None:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def fits(self, a: str, b: str) -> bool:
        """Whether a and b stay apart when only they are merged."""
        if (got := self.pairs.get((a, b))) is None:
            if len(self.pairs) > KEPT_PAIRS:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merge(a + b) == [a, b]
        return got

    def forward(self, words: list[str]) -> Iterator[list[str]]:
        """The pieces of each of the sorted distinct words."""
        return self._viterbi(words) if self.type == UNIGRAM else self._bpe(words)

    def _viterbi(self, words: list[str]) -> Iterator[list[str]]:
        """best[i], start[i]: of the first i characters, the best total score and where its last piece starts; ties go to the longer piece."""
        best, start, before, score = [0.0], [0], "", self.score
        for word in words:
            shared = len(os.path.commonprefix((before, word)))
            del best[shared + 1 :], start[shared + 1 :]
            for i in range(shared + 1, len(word) + 1):
                top = None
                for a in range(max(0, i - self.longest), i):
                    own = score.get(word[a:i], self.lowest if a == i - 1 else None)
                    if own is not None and (top is None or best[a] + own > top):
                        top, at = best[a] + own, a
                best.append(top), start.append(at)
            before, out, i = word, [], len(word)
            while i:
                out.append(word[start[i] : i])
                i = start[i]
            yield out[::-1]

    def _bpe(self, words: list[str]) -> Iterator[list[str]]:
        """last[i]: the last piece of the segmentation of the first i characters."""
        last, before, rank, pairs, longest = [""], "", self.rank, self.pairs, self.longest
        for word in words:
            shared = len(os.path.commonprefix((before, word)))
            del last[shared + 1 :]
            for i in range(shared + 1, len(word) + 1):
                for n in range(1, min(longest, i - 1) + 1):
                    t = word[i - n : i]
                    if (n == 1 or t in rank) and (got if (got := pairs.get((a := last[i - n], t))) is not None else self.fits(a, t)):
                        break
                else:  # the whole prefix is one piece
                    t = word[:i]
                    assert i == 1 or t in rank and self._whole(t), t
                last.append(t)
            before, out, i = word, [], len(word)
            while i:
                out.append(last[i])
                i -= len(last[i])
            yield out[::-1]

    def _whole(self, t: str) -> bool:
        """Whether merging the characters of piece t gives t."""
        if (got := self.pairs.get(("", t))) is None:
            got = self.pairs["", t] = self.merge(t) == [t]
        return got

    def to_ids(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            if p in self.ids:
                out.append(self.ids[p])
            elif self.fallback:
                out += [self.bytes[b] for b in p.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def _learn(self, new: list[str]) -> None:
        """Encode words not met before.  Where nothing merges with a line feed, words are cut at them first."""
        cut = {w: re.findall("\n|[^\n]+", w) for w in new if "\n" in w} if self.cuts else {}
        parts = sorted(p for p in {*(w for w in new if w not in cut), *chain.from_iterable(cut.values())} if p not in self.known.number)
        ids = [self.to_ids(p) for p in self.forward(parts)]
        self.known.extend(parts, np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter(chain.from_iterable(ids), np.int32))
        cut = {w: ps for w, ps in cut.items() if w not in self.known.number}
        if cut:
            number, many = self.known.number, np.fromiter(map(len, cut.values()), np.int64, len(cut))
            values, lengths = self.known.gather(np.fromiter((number[p] for ps in cut.values() for p in ps), np.int64, int(many.sum())))
            self.known.extend(list(cut), np.add.reduceat(lengths, np.concatenate([[0], np.cumsum(many)[:-1]])), values)

    def encode(self, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of all texts."""
        if self.known.count > KEPT_WORDS:
            self.known = Ragged("<i4")
        # Texts of words between single blanks are split by Arrow, others by the pattern.
        odd = np.asarray(pc.match_substring_regex(batch, f"^$|^ | $|  |{MARK}").to_numpy(zero_copy_only=False), bool)
        plain = pc.split_pattern(batch.filter(pa.array(~odd)), " ")
        offsets = np.asarray(plain.offsets, np.int64)
        flat = plain.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        names = [MARK + w for w in flat.dictionary.to_numpy(zero_copy_only=False).tolist()]
        others = [marked(t) for t in batch.filter(pa.array(odd)).to_pylist()]
        number = self.known.number
        if new := [w for w in dict.fromkeys(chain(names, *others)) if w not in number]:
            self._learn(new)
        numbers = np.fromiter(map(number.__getitem__, chain(names, *others)), np.int64)
        codes = np.concatenate([numbers[np.asarray(flat.indices, np.int64)], numbers[len(names) :]])
        # Codes of the plain texts come first, then those of the others: gather them in the texts' order.
        counts = np.empty(len(odd), np.int64)
        counts[~odd], counts[odd] = np.diff(offsets), np.fromiter(map(len, others), np.int64, len(others))
        first = np.empty(len(odd), np.int64)
        in_turn = np.concatenate([counts[~odd], counts[odd]])
        starts = np.cumsum(in_turn) - in_turn
        first[~odd], first[odd] = starts[: int((~odd).sum())], starts[int((~odd).sum()) :]
        ends = np.concatenate([[0], np.cumsum(counts)])
        order = np.repeat(first - ends[:-1], counts) + np.arange(ends[-1])
        values, lengths = self.known.gather(codes[order])
        return values, np.concatenate([[0], np.cumsum(lengths)])[ends]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The UTF-8 texts of many arrays of ids, laid end to end."""
        if self.raw is None:
            raw = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.control else p.replace(MARK, " ").encode() for i, p in enumerate(self.piece)]
            self.raw = Ragged("u1")
            self.raw.extend(list(range(len(raw))), np.fromiter(map(len, raw), np.int64, len(raw)), np.frombuffer(b"".join(raw), np.uint8))
        values, lengths = self.raw.gather(ids.astype(np.int64))
        at = np.concatenate([[0], np.cumsum(lengths)])[offsets]
        whole = values.tobytes()
        return [whole[a + 1 : b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]  # without the mark put in front


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers), exact (decoding gave the text back) for each row."""
    path = path or default_model()
    ship(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("exact", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in slices(batches, "text", SLICE):
            source = column(batch, "text")
            ids, ends = m.encode(source)
            each = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
            back = [a == b for a, b in zip(m.decode(ids, ends), source.cast(pa.large_binary()).to_pylist())]
            sums = [zlib.crc32(x.astype("<u4").tobytes()) for x in each]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), lists, pa.array(np.diff(ends), pa.int64()), pa.array(sums, pa.int64()), pa.array(back)], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(F.col(text_col)).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, ids_crc32 long, exact boolean")


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text for each row of ids."""
    path = path or default_model()
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            lists = [np.asarray(x or [], np.int64) for x in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, lists)])
            out = m.decode(np.concatenate([np.empty(0, np.int64), *lists]), ends)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.decode("utf-8", "replace") for x in out], pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, text string")
