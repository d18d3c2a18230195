"""SentencePiece encoding and decoding (BPE models) in vectorised merge rounds.

Words of many documents are merged together: their symbols lie in one flat
array, each round takes the smallest pair rank of every word (a segmented
minimum) and merges its leftmost occurrences at once, then closes the gaps,
until no word has a pair left. The model file is read on the driver (its size
does not depend on the data) and travels with the task.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grimlake.llm.common import id_as_text, text_or_empty

SCHEMA = "doc_id string, ids array<int>, decoded string"
#: Characters handled at once, and distinct words kept between rounds.
CHUNK_CHARS = 2_000_000
KEPT_WORDS = 600_000
#: Fixed values of the model format: piece types, and the space mark.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MARK = "▁"
UNIT = re.compile(f"{MARK}+[^{MARK}]*")
NO_RANK = np.iinfo(np.int32).max


def read_bytes(spark, path: str) -> bytes:
    """The model file, through Spark's readers (any store)."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value) of a protocol-buffer message: integers and byte strings."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at:at + n]
            at += n


def _per_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("grimlake_per_byte", _per_byte)


class PieceModel:
    """Tables of one BPE model: pair ranks for merging, bytes for decoding."""

    def __init__(self, data: bytes):
        pieces, scores, types = [], [], []
        trainer: dict = {}
        normalizer: dict = {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                pieces.append(piece[1].decode())
                scores.append(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0])
                types.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normalizer = dict(_fields(value))
        inner = [p for p, t in zip(pieces, types) if t == NORMAL and MARK in p.lstrip(MARK)]
        if (trainer.get(3) != 2 or normalizer.get(2) or normalizer.get(4, 1) or inner
                or not normalizer.get(3, 1) or not normalizer.get(5, 1) or trainer.get(24)
                or set(types) - {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError("only BPE models without text normalisation, with a leading space, are read")
        self.n_pieces = len(pieces)
        self.unknown = types.index(UNKNOWN)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(pieces, types)) if t == BYTE}
        # Symbols: the normal pieces, then single characters that only occur inside pieces.
        self.symbols = {p: i for i, (p, t) in enumerate(zip(pieces, types)) if t == NORMAL}
        for p in list(self.symbols):
            for ch in p:
                self.symbols.setdefault(ch, len(pieces) + len(self.symbols))
        order = {s: r for r, s in enumerate(sorted({float(s) for s in scores}, reverse=True))}
        rank = [order[float(s)] for s in scores]
        keys, ranks, merged, slow = [], [], [], set()
        for piece, i in list(self.symbols.items()):
            if i >= len(pieces) or len(piece) < 2:
                continue
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is None or right is None:
                    continue
                keys.append(left << 32 | right)
                ranks.append(rank[i])
                merged.append(i)
                # Merging to this side can give a pair that must go first: such
                # sides are merged one at a time, all others simultaneously.
                slow.update(rank[s] for s in (left, right) if s < len(pieces) and rank[i] <= rank[s])
        by_key = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.array(keys, np.int64)[by_key]
        self.ranks = np.array(ranks, np.int32)[by_key]
        self.merged = np.array(merged, np.int64)[by_key]
        self.one_by_one = np.zeros(len(order) + 1, bool)
        self.one_by_one[list(slow)] = True
        surface = trainer.get(44, " ⁇ ".encode())
        shown = [surface if t == UNKNOWN else b"" if t == CONTROL else bytes([int(p[3:5], 16)]) if t == BYTE
                 else p.replace(MARK, " ").encode() for p, t in zip(pieces, types)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_len = np.array([len(x) for x in shown], np.int64)
        self.shown_at = np.concatenate([[0], np.cumsum(self.shown_len)[:-1]])
        self.marked = np.array([t == NORMAL and p.startswith(MARK) for p, t in zip(pieces, types)])

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; NO_RANK where the pair makes no piece."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_RANK).astype(np.int32), self.merged[at]

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, n): all words' ids in one array, and the number of each word."""
        chars = "".join(words)
        distinct = {ch: self.symbols.get(ch, -1) for ch in set(chars)}
        extra, table = [], {}
        for ch, s in distinct.items():
            if s < 0 or s >= self.n_pieces:
                if s < 0:
                    s = 1 << 31 | len(extra)  # in no piece: never merges
                extra.append((s, [self.byte_ids[b] for b in ch.encode()] if self.byte_ids else [self.unknown]))
            table[ch] = s
        sym = np.fromiter(map(table.__getitem__, chars), np.int64, len(chars))
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        rank, made = self._neighbours(sym, word, None)
        done_sym, done_word = [], []
        while len(sym):
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[start, len(sym)])
            least = np.repeat(np.minimum.reduceat(rank, start), size)
            open_ = least != NO_RANK
            if not open_.all():
                done_sym.append(sym[~open_])
                done_word.append(word[~open_])
                sym, word, rank, made, least = sym[open_], word[open_], rank[open_], made[open_], least[open_]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == least)
            begins = np.r_[True, hit[1:] != hit[:-1] + 1]
            run = hit[np.flatnonzero(begins)][np.cumsum(begins) - 1]
            take = (hit - run) % 2 == 0  # leftmost first, without overlap
            first = np.r_[True, word[hit[1:]] != word[hit[:-1]]]
            hit = hit[np.where(self.one_by_one[rank[hit]], first, take)]
            sym[hit] = made[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            moved = np.cumsum(keep) - 1
            sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
            changed = np.zeros(len(sym) + 1, bool)
            changed[moved[hit]] = True
            changed[moved[hit] - 1] = True  # before the first symbol: the spare last place
            touched = np.flatnonzero(changed[:-1])
            rank[touched], made[touched] = self._neighbours(sym, word, touched)
        sym = np.concatenate(done_sym) if done_sym else np.zeros(0, np.int64)
        word = np.concatenate(done_word) if done_word else np.zeros(0, np.int64)
        back = np.argsort(word, kind="stable")
        sym, word = sym[back], word[back]
        # Symbols that are no pieces become the ids of their bytes.
        width = np.ones(len(sym), np.int64)
        for s, ids in extra:
            width[sym == s] = len(ids)
        out = np.repeat(sym, width)
        starts = np.cumsum(width) - width
        for s, ids in extra:
            where = starts[sym == s]
            for k, i in enumerate(ids):
                out[where + k] = i
        return out.astype(np.int32), np.bincount(np.repeat(word, width), minlength=len(words))

    def _neighbours(self, sym, word, at):
        if at is None:
            at = np.arange(len(sym))
        nxt = np.minimum(at + 1, len(sym) - 1)
        rank, made = self.pairs(sym[at], sym[nxt])
        rank[(nxt == at) | (word[nxt] != word[at])] = NO_RANK
        return rank, made

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Texts of ``len(sizes)`` id sequences that lie one after another in ``ids``."""
        ids = ids.astype(np.int64)
        length = self.shown_len[ids]
        ends = np.cumsum(length)
        flat = self.shown[np.repeat(self.shown_at[ids] - (ends - length), length) + np.arange(int(length.sum()))]
        data = flat.tobytes()
        id_end = np.cumsum(sizes)
        texts = []
        for a, b in zip(id_end - sizes, id_end):
            lo, hi = (0, 0) if a == b else (ends[a] - length[a], ends[b - 1])
            if a < b and self.marked[ids[a]]:
                lo += 1
            texts.append(data[lo:hi].decode("utf-8", "grimlake_per_byte"))
        return texts


class Encoder:
    """Encodes texts with one model and keeps the ids of words seen before, up
    to ``KEPT_WORDS``, then starts again: memory stays bounded."""

    def __init__(self, data: bytes):
        self.model = PieceModel(data)
        self._forget()

    def _forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.ids = [np.zeros(0, np.int32)]
        self.n = [np.zeros(0, np.int64)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of the texts, one after another."""
        if len(self.seen) > KEPT_WORDS:
            self._forget()
        per_text = [UNIT.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        flat_units = [w for units in per_text for w in units]
        new = list(set(flat_units).difference(self.seen))
        if new:
            ids, n = self.model.merge_words(new)
            self.seen.update(zip(new, range(len(self.seen), len(self.seen) + len(new))))
            self.ids = [np.concatenate([*self.ids, ids])]
            self.n = [np.concatenate([*self.n, n])]
        cat, n = self.ids[0], self.n[0]
        at = np.cumsum(n) - n
        unit = np.fromiter(map(self.seen.__getitem__, flat_units), np.int64, len(flat_units))
        text = np.repeat(np.arange(len(texts)), np.fromiter(map(len, per_text), np.int64, len(texts)))
        width = n[unit]
        ends = np.cumsum(width)
        flat = cat[np.repeat(at[unit] - (ends - width), width) + np.arange(int(width.sum()))]
        return flat, np.bincount(text, weights=width, minlength=len(texts)).astype(np.int64)


_ENCODERS: dict[int, tuple[bytes, Encoder]] = {}


def encoder(data: bytes) -> Encoder:
    """One encoder per worker process and model."""
    key = hash(data)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = (data, Encoder(data))
    return _ENCODERS[key][1]


def chunks(texts: list[str], chars: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``chars`` characters, one text at least."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > chars:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, ids (array<int>), decoded (their text).

    Ids are those of the sentencepiece library, without begin or end ids.
    Null text counts as empty and gives no ids and an empty text. Rows keep
    their ids, null or repeated ones too; an empty table gives an empty
    result; a very long text is one row like others, in memory once. Works on
    one row at a time with no shuffle.
    """
    data = read_bytes(docs.sparkSession, model_path)
    doc_id, kind = id_as_text(docs, id_col)
    rows = docs.select(doc_id.alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(data)
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in chunks(texts):
                ids, sizes = enc.encode(texts[a:b])
                yield pd.DataFrame({
                    "doc_id": frame["doc_id"].iloc[a:b].to_numpy(),
                    "ids": np.split(ids, np.cumsum(sizes)[:-1]),
                    "decoded": enc.model.decode(ids, sizes)})

    return rows.mapInPandas(run, SCHEMA).withColumn("doc_id", F.col("doc_id").cast(kind))


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
