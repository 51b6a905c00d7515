"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by piece score, then by position, and merges the best until none
is in the vocabulary; symbols outside it fall back to bytes. No piece holds the space mark after another character, so a text
is the sequence of its chunks (space marks, then what is not a space mark), which merge on their own, and chunks met before
come from a bounded memory. The new short chunks of a batch are merged side by side: each is a row of symbols and a row of
the scores of its pairs, its agenda, and each step takes the best pair of every row. Other chunks have a heap each.
The library encodes every whole text and decodes the ids; `agrees` tells if both are as here.

Edge cases: null and empty texts have no ids and decode to the empty text; every character, NUL and the text of control
pieces included, is ordinary text; a vocabulary that is not of this kind raises ValueError.
"""

from __future__ import annotations

import hashlib
import math
import re
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

MARK = "▁"
MEMORY = 800_000
"""Chunks remembered by a worker before it starts anew with the next batch."""
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
SHORT = 40
"""Characters of a chunk that is merged side by side with others (if it has one mark), and remembered."""
NONE = np.int32(np.iinfo(np.int32).max)


class PairTable:
    """Symbols as numbers in the order of their scores, and the number of what a pair of them gives (NONE: no piece)."""

    def __init__(self, score: dict[str, float]):
        ranked = sorted(score, key=score.__getitem__)
        letters = sorted(({c for p in ranked for c in p} | set(map(chr, range(128)))) - score.keys())
        self.text = ranked + letters
        number = {p: i for i, p in enumerate(self.text)}
        self.of_letter = np.full(0x110000, -1, np.int32)
        for p, i in number.items():
            if len(p) == 1:
                self.of_letter[ord(p)] = i
        self.symbols = len(self.text) + 1  # the last stands for padding
        found = [(number[p[:k]] * self.symbols + number[p[k:]], number[p]) for p in ranked for k in range(1, len(p)) if p[:k] in number and p[k:] in number]
        bits = max(10, (8 * len(found)).bit_length())
        self.shift, self.size = np.uint64(64 - bits), 1 << bits
        self.keys, self.gives = np.full(self.size, -1, np.int64), np.full(self.size, NONE, np.int32)
        key, value = np.array([k for k, _ in found], np.int64), np.array([v for _, v in found], np.int32)
        at = self._slot(key)
        while len(key):
            free = self.keys[at] < 0
            slots, first = np.unique(at[free], return_index=True)
            self.keys[slots], self.gives[slots] = key[free][first], value[free][first]
            left = self.keys[at] != key
            key, value, at = key[left], value[left], (at[left] + 1) % self.size

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) * self.symbols + b).ravel()
        at = self._slot(key)
        there = self.keys[at]
        out = np.where(there == key, self.gives[at], NONE)
        open_ = np.flatnonzero((there != key) & (there >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % self.size
            there = self.keys[at[open_]]
            out[open_] = np.where(there == key[open_], self.gives[at[open_]], NONE)
            open_ = open_[(there != key[open_]) & (there >= 0)]
        return out.reshape(a.shape)

    def merge(self, symbols: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, their final symbols) in parts; symbols: (rows, width), padded at the end."""
        rows, done = np.arange(len(symbols)), []
        agenda = self.pair(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            at = agenda.argmin(1) if agenda.shape[1] else np.zeros(len(rows), np.int64)  # of equal scores the first place
            best = agenda[np.arange(len(rows)), at] if agenda.shape[1] else np.full(len(rows), NONE)
            over = best == NONE
            if over.any():
                done.append((rows[over], symbols[over]))
                go = ~over
                rows, symbols, agenda, at, best = rows[go], symbols[go], agenda[go], at[go], best[go]
            n, k = len(rows), np.arange(len(rows))
            if not n:
                break
            symbols[k, at] = best
            keep = np.ones(symbols.shape, bool)
            keep[k, at + 1] = False
            symbols = symbols[keep].reshape(n, -1)
            keep = np.ones(agenda.shape, bool)
            keep[k, at] = False
            agenda = agenda[keep].reshape(n, -1)
            left, right = at > 0, at < agenda.shape[1]
            agenda[k[left], at[left] - 1] = self.pair(symbols[k[left], at[left] - 1], best[left])
            agenda[k[right], at[right]] = self.pair(best[right], symbols[k[right], at[right] + 1])
        return done


class PieceCodec(dict):
    """Also the memory of encoded chunks: chunk -> ids as packed integers."""

    def __init__(self, model_file: str):
        super().__init__()
        lib = self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = lib.get_piece_size()
        text = [lib.id_to_piece(i) for i in range(size)]
        special = [i for i in range(size) if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)]
        byte = [i for i in special if lib.is_byte(i)]
        if len(byte) != 256 or any(lib.is_unused(i) for i in range(size)) or any(MARK in p.lstrip(MARK) for p in text) or lib.encode(" a  ", out_type=str)[0][0] != MARK:
            raise ValueError("not a byte-fallback BPE vocabulary with marks in front")
        self.byte_id = {int(text[i][3:5], 16): i for i in byte}
        self.ids = {p: i for i, p in enumerate(text) if i not in set(special)}
        self.score = {p: -lib.get_score(i) for p, i in self.ids.items()}
        self.piece = [p.replace(MARK, " ").encode() for p in text]
        for b, i in self.byte_id.items():
            self.piece[i] = bytes([b])
        for i in special:
            if not lib.is_byte(i):
                self.piece[i] = " ⁇ ".encode() if lib.is_unknown(i) else b""
        self.bytes_from = set(byte)
        self.decimal = [str(i) for i in range(size)]
        self.packed = np.dtype(np.uint16 if size <= 1 << 16 else np.uint32)
        # runs of marks may have one score for all; of the others the score alone must decide
        single = {p: x for p, x in self.score.items() if p[:2] != MARK * 2}
        self.pairs = PairTable(single) if len({*single.values()}) == len(single) else None
        if self.pairs:
            ids = self.ids | {chr(b): i for b, i in self.byte_id.items() if b < 128 and chr(b) not in self.ids}
            self.id_of_symbol = np.array([ids.get(p, -1) for p in self.pairs.text] + [-1], np.int64)

    def merge(self, chunk: str) -> list[str]:
        """The symbols that are left when no adjacent pair of them is a piece."""
        symbols, n, score = list(chunk), len(chunk), self.score
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(score[p], i, p) for i, p in enumerate(map(str.__add__, symbols, symbols[1:])) if p in score]
        heapify(agenda)
        while agenda:
            _, i, p = heappop(agenda)
            j = after[i]
            if symbols[i] is None or j >= n or symbols[i] + symbols[j] != p:
                continue  # one of the two has changed meanwhile
            symbols[i], symbols[j] = p, None
            k, h = after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                q = p + symbols[k]
                if q in score:
                    heappush(agenda, (score[q], i, q))
            if h >= 0:
                q = symbols[h] + p
                if q in score:
                    heappush(agenda, (score[q], h, q))
        return [s for s in symbols if s is not None]

    def __missing__(self, chunk: str) -> bytes:
        ids: list[int] = []
        for s in self.merge(chunk):
            i = self.ids.get(s)
            if i is None:
                ids += [self.byte_id[b] for b in s.encode()]
            else:
                ids.append(i)
        out = np.array(ids, self.packed).tobytes()
        if len(chunk) <= SHORT:
            self[chunk] = out
        return out

    def learn(self, chunks: list[str]) -> None:
        """Remember chunks: those whose characters are symbols are merged side by side, the others when they are met."""
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        letters = self.pairs.of_letter[np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)]
        first = np.cumsum(lengths) - lengths
        plain = np.minimum.reduceat(letters, first) >= 0
        for low, high in pairwise((0, 6, 9, 12, 16, 24, SHORT)):
            some = np.flatnonzero(plain & (lengths > low) & (lengths <= high))
            if not len(some):
                continue
            j = np.arange(high)
            inside = j < lengths[some, None]
            symbols = np.where(inside, letters[np.minimum(first[some, None] + j, len(letters) - 1)], self.pairs.symbols - 1)
            for rows, final in self.pairs.merge(symbols):
                real = final != self.pairs.symbols - 1
                ids = self.id_of_symbol[final]
                ok = ((ids >= 0) | ~real).all(1)
                flat = ids[ok][real[ok]].astype(self.packed).tobytes()
                ends = (np.cumsum(real[ok].sum(1)) * self.packed.itemsize).tolist()
                self.update(zip([chunks[i] for i in some[rows[ok]].tolist()], map(flat.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))

    def agrees(self, texts: list[str], ids: list[list[int]], back: list[str]) -> list[bool]:
        """Whether the library gives the same ids for each text and the same text for its ids."""
        theirs, decoded = self.library.encode(texts, num_threads=1), self.library.decode(ids, num_threads=1)
        return [i == t and b == d for i, t, b, d in zip(ids, theirs, back, decoded, strict=True)]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        chunks = [_CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self) >= MEMORY:
            self.clear()
        new = [c for c in set(chain.from_iterable(chunks)).difference(self) if len(c) <= SHORT and c[:2] != MARK * 2]
        if new and self.pairs:
            self.learn(new)
        return [np.frombuffer(b"".join(map(self.__getitem__, c)), self.packed).tolist() for c in chunks]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        """Pieces joined, the mark that encoding put in front taken off; bytes that are no UTF-8 become U+FFFD each."""
        raw = b"".join(map(self.piece.__getitem__, ids))
        try:
            out = raw.decode()
        except UnicodeDecodeError:
            out = self._decode_runs(ids)
        return out[1:] if out[:1] == " " and self.piece[ids[0]][:1] == b" " and ids[0] not in self.bytes_from else out

    def _decode_runs(self, ids: list[int]) -> str:
        out: list[str] = []
        run = b""
        for i in [*ids, None]:
            if i in self.bytes_from:
                run += self.piece[i]
                continue
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[:n].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    n = 1
                run = run[n:]
            if i is not None:
                out.append(self.piece[i].decode())
        return "".join(out)


_codecs: dict[str, PieceCodec] = {}


def codec(model_file: str) -> PieceCodec:
    """One for each worker process and model."""
    if model_file not in _codecs:
        _codecs[model_file] = PieceCodec(model_file)
    return _codecs[model_file]


def encode_texts(docs: DataFrame, model_file: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, agrees[, ids]) for each row of docs (doc_id, text)."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean" + ", ids array<int>" * with_ids

    def run(batches):
        c = codec(model_file)
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ours = c.encode_all(texts)
                texts_back = [c.decode(ids) for ids in ours]
                agree = c.agrees(texts, ours, texts_back)
                sha = [hashlib.sha256(",".join(map(c.decimal.__getitem__, ids)).encode()).hexdigest() for ids in ours]
                back = [hashlib.sha256(t.encode()).hexdigest() for t in texts_back]
                columns = [part.column(0), pa.array(map(len, ours), pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string()), pa.array(agree, pa.bool_())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
                if with_ids:
                    columns, names = [*columns, pa.array(ours, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids decode to the empty text."""
    def run(batches):
        c = codec(model_file)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.decode(ids or []) for ids in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
