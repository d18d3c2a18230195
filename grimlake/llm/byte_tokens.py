"""Byte-level BPE by prefix dynamic programming.

The encoding of a byte string is fixed by the encodings of its prefixes: each
prefix has exactly one last token that may follow the encoding of the bytes
before it. A table keeps that token per prefix. All tokens that end at a byte
come from an Aho-Corasick automaton over the vocabulary; of these, one forms a
valid pair with the last token of the prefix that it leaves. Reading the table
backwards gives the ids, more bytes only add entries, and after an edit the
entries are made anew from there until they meet the old ones again.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grimlake.llm.common import text_or_empty
from grimlake.llm.piece_tokens import chunks, read_bytes

#: Characters handled at once; distinct pieces, their bytes, and pairs kept between batches.
CHUNK_CHARS = 2_000_000
KEPT_PIECES, KEPT_BYTES, KEPT_PAIRS = 400_000, 16_000_000, 2_000_000
NEVER = 1 << 60


def read_ranks(data: bytes) -> list[bytes]:
    """Tokens by id, from lines of base64 and rank."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must be 0, 1, 2, ... and cover every byte")
    return tokens


def parents(tokens: list[bytes]) -> np.ndarray:
    """Per id the two tokens that merging its bytes joins last, (-1, -1) for
    single bytes."""
    rank = {t: i for i, t in enumerate(tokens)}
    out = np.full((len(tokens), 2), -1, np.int32)
    for i, token in enumerate(tokens):
        parts = [token[k:k + 1] for k in range(len(token))]
        while len(parts) > 2:
            least, at = min((rank.get(parts[k] + parts[k + 1], NEVER), k) for k in range(len(parts) - 1))
            if least == NEVER:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            out[i] = rank[parts[0]], rank[parts[1]]
        if len(parts) > 2 or out[i].max() >= i:
            raise ValueError(f"token {i} is not made by merging tokens of lower rank")
    return out


class Vocabulary:
    """Tokens, what they are made of, and which pairs may stand side by side."""

    def __init__(self, tokens: list[bytes], made_of: np.ndarray):
        self.tokens, self.rank = tokens, {t: i for i, t in enumerate(tokens)}
        self.size = [len(t) for t in tokens]
        self.longest = max(self.size)
        self.made_of = made_of.tolist()
        self.pairs: dict[int, bool] = {}
        self.matches = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, t in enumerate(tokens):
            self.matches.add_word(t.decode("latin-1"), i)
        self.matches.make_automaton()

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(token, rank at which it becomes part of the next) of the tokens that
        stand at this side of ``token`` while it is merged, the byte first."""
        out, upto = [], NEVER
        while token >= 0:
            out.append((token, upto))
            upto, token = token, self.made_of[token][side]
        return out[::-1]

    def side_by_side(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both leaves just these two tokens: at no
        time does the pair at the border come before the next merges beside it
        (of equal ranks the left merge is first)."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._side_by_side(left, right)
        return known

    def _side_by_side(self, left: int, right: int) -> bool:
        a, b = self.edge(left, 1), self.edge(right, 0)
        i = j = 0
        while True:
            (x, x_upto), (y, y_upto) = a[i], b[j]
            joined = self.rank.get(self.tokens[x] + self.tokens[y], NEVER)
            if joined < x_upto and joined <= y_upto and joined != NEVER:
                return False
            if x_upto == y_upto == NEVER:
                return True
            if x_upto <= y_upto:
                i += 1
            else:
                j += 1


class Prefixes:
    """A byte string and the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, data, []
        self._extend(0, None, 0)

    def append(self, more: bytes) -> None:
        """Exactly as if the whole had been encoded anew."""
        self.data += more
        self._extend(len(self.last), None, 0)

    def cut(self, n: int) -> None:
        """Keep the first ``n`` bytes."""
        del self.last[n:]
        self.data = self.data[:n]

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` for the bytes from start to end; returns how many entries
        were made anew. As soon as as many entries as the longest token has
        bytes agree with the old ones, all further ones do."""
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[:start]
        return self._extend(start, old, shift, start + len(new))

    def _extend(self, at: int, old: list[int] | None, shift: int, after: int = 0) -> int:
        v, last, n = self.vocabulary, self.last, len(self.data)
        size, known, side_by_side = v.size, v.pairs.get, v.side_by_side
        from_ = max(0, at - v.longest + 1)
        alike, next_ = 0, len(last)
        for end, token in v.matches.iter(self.data[from_:].decode("latin-1")):
            end += from_
            if end != next_:  # before the new entries, or already found
                continue
            start = end + 1 - size[token]
            if start:
                if start < 0:
                    continue
                left = last[start - 1]
                fits = known(left << 32 | token)
                if not (side_by_side(left, token) if fits is None else fits):
                    continue
            last.append(token)
            next_ += 1
            if old is not None and end >= after:
                alike = alike + 1 if old[end - shift] == token else 0
                # Tokens that end later than this begin after the edit.
                if alike > v.longest and end + 1 - after >= v.longest:
                    last.extend(old[end + 1 - shift:])
                    break
        assert len(last) == n
        return next_ - at

    def ids(self) -> list[int]:
        out, at, size = [], len(self.last), self.vocabulary.size
        while at:
            out.append(self.last[at - 1])
            at -= size[out[-1]]
        return out[::-1]


def classes(pattern: str) -> tuple[str, str]:
    """(pattern for Python's ``re``, characters): the pattern with its Unicode
    classes written out as ranges, and the characters that ``regex`` puts into
    other classes. What a letter, a number and white space is differs between
    Unicode versions; the library that defines the encoding is asked for its own."""
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))

    def ranges(name: str) -> str:
        found = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        chars = bytes(found).decode()
        others.update(set(chars).symmetric_difference(regex.findall(name, every)))
        codes = np.array([ord(c) for c in chars])
        first = np.flatnonzero(np.r_[True, np.diff(codes) > 1])
        ends = np.r_[first[1:], len(codes)] - 1
        return "".join(f"{re.escape(chr(codes[a]))}-{re.escape(chr(codes[b]))}" for a, b in zip(first, ends))

    others: set[str] = set()
    out, inside, at = [], False, 0
    for m in re.finditer(r"\\[pP]\{\w+\}|\\[sS]|\\.|\[|\]", pattern):
        out.append(pattern[at:m.start()])
        at, s = m.end(), m[0]
        if s in "[]":
            inside = s == "["
            out.append(s)
        elif s[1] in "pPsS":
            r = ranges(s if s[1] in "ps" else "\\" + s[1:].lower() if s[1] == "S" else "\\p" + s[2:])
            if inside and s[1] in "PS":
                raise ValueError(f"{s} inside a set")
            out.append(r if inside else f"[{'^' * (s[1] in 'PS')}{r}]")
        else:
            out.append(s)
    return "".join(out) + pattern[at:], "".join(sorted(others))


class Encoder:
    """Encodes texts piece by piece; pieces seen before are kept up to a bound."""

    def __init__(self, tokens: list[bytes], made_of: np.ndarray, pattern: str, own: tuple[str, str] | None = None):
        self.vocabulary = Vocabulary(tokens, made_of)
        exact, others = own or classes(pattern)
        # The same matches, faster, in texts without characters on which the two differ.
        self.exact, self.fast, self.others = re.compile(exact).findall, regex.compile(pattern).findall, frozenset(others)
        sizes = np.array(self.vocabulary.size, np.int64)
        self.shown, self.shown_len = np.frombuffer(b"".join(tokens), np.uint8), sizes
        self.shown_at = np.cumsum(sizes) - sizes
        self._forget()

    def _forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.held = 0
        self.cat, self.n = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def split(self, text: str) -> list[str]:
        return (self.fast if self.others.isdisjoint(text) else self.exact)(text)

    def pieces(self, pieces: list[bytes]) -> Iterator[list[int]]:
        """Ids of the pieces, which are sorted: one's table begins with the
        entries of the prefix that it has in common with the one before."""
        whole, table = self.vocabulary.rank.get, Prefixes(self.vocabulary)
        for data in pieces:
            if (token := whole(data)) is not None:
                yield [token]
                continue
            n = min(len(data), len(table.data))
            if table.data[:n] != data[:n]:
                n = next(i for i in range(n) if table.data[i] != data[i])
            table.cut(n)
            table.append(data[n:])
            yield table.ids()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of the texts, one after another."""
        if len(self.seen) > KEPT_PIECES or self.held > KEPT_BYTES:
            self._forget()
        per_text = [self.split(t) for t in texts]
        flat = [p for pieces in per_text for p in pieces]
        new = sorted(set(flat).difference(self.seen))  # by code point, as by byte
        if new:
            ids = list(self.pieces([p.encode() for p in new]))
            self.seen.update(zip(new, range(len(self.seen), len(self.seen) + len(new))))
            self.held += sum(map(len, new))
            self.cat = np.concatenate([self.cat, *(np.array(x, np.int32) for x in ids)])
            self.n = np.concatenate([self.n, np.fromiter(map(len, ids), np.int64, len(ids))])
        at = np.cumsum(self.n) - self.n
        piece = np.fromiter(map(self.seen.__getitem__, flat), np.int64, len(flat))
        text = np.repeat(np.arange(len(texts)), np.fromiter(map(len, per_text), np.int64, len(texts)))
        width = self.n[piece]
        ends = np.cumsum(width)
        out = self.cat[np.repeat(at[piece] - (ends - width), width) + np.arange(int(width.sum()))]
        return out, np.bincount(text, weights=width, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, ends) of ``len(sizes)`` id sequences, one after another."""
        length = self.shown_len[ids]
        ends = np.cumsum(length)
        flat = self.shown[np.repeat(self.shown_at[ids] - (ends - length), length) + np.arange(int(length.sum()))]
        return flat, np.r_[0, ends][np.cumsum(sizes)]


_ENCODERS: dict[int, Encoder] = {}


def encoder(tokens: list[bytes], made_of: np.ndarray, pattern: str, own: tuple[str, str]) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = hash((pattern, *tokens))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokens, made_of, pattern, own)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, ids (array<int>), decoded (binary: the ids' bytes).

    Each match of ``pattern`` is encoded by itself, without special tokens; a
    match that is a token is that token. Null text counts as empty and gives no
    ids and no bytes. Rows keep their ids, null or repeated ones too; an empty
    table gives an empty result; a very long text is one row like others, and
    a very long match takes time in proportion to its bytes. One row at a time,
    with no shuffle; the vocabulary travels with the tasks, its size does not
    depend on the data.
    """
    tokens = read_ranks(read_bytes(docs.sparkSession, ranks_path))
    made_of, own = parents(tokens), classes(pattern)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokens, made_of, pattern, own)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(texts, CHUNK_CHARS):
                ids, sizes = enc.encode(texts[a:b])
                data, ends = enc.decode(ids, sizes)
                offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                binary = pa.Array.from_buffers(pa.binary(), b - a, [
                    None, pa.py_buffer(np.r_[0, ends].astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))),
                     binary], names=["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256 of the ids as little-endian 32-bit numbers, decoded_sha256)."""
    rows = encoded.select("doc_id", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            ends = ids.offsets.to_numpy().astype(np.int64)
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy().astype("<u4"))).cast("B")
            sha = [hashlib.sha256(data[4 * a:4 * b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(ends)), pa.array(sha, pa.string()), batch.column("decoded_sha256")],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, schema)
