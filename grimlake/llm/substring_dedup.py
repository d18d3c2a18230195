"""Substring dedup with repeated-phrase automata.

A window is 13 consecutive words of one document; a word goes if a window that
covers it also starts in a document with a smaller id.

1. Each shard sends its anchors: of every window the smallest of its 5-word
   hashes. Equal windows have equal anchors, and about one position in five is
   one, so this is a fifth of the windows.
2. Shards that share an anchor send the windows around it, each with the
   smallest id it has there; every shard learns the smallest id anywhere of
   its windows. Windows with a smaller id elsewhere are confirmed to recur.
3. Each shard compiles phrases that span its recurring passages, as sequences
   of word numbers, into an Aho-Corasick automaton, and streams all of its documents through it
   to find every occurrence, word by word, not by hash.
"""

from __future__ import annotations

from itertools import chain, compress

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grimlake.llm.common import id_as_text
from grimlake.llm.shards import rolling, sharded

WINDOW = 13
ANCHOR = 5
SHARD_CHARS = 6_000_000
#: Order of rows without an id: after all others.
LAST = 2**63 - 1


class Shard:
    """The windows of one shard's documents: hash, order key and place. The words
    of all documents are one array; windows that reach into the next document
    are left out."""

    def __init__(self, frame: pd.DataFrame, window: int, anchor: int):
        self.window = window
        # The white space at which bytes are split is that of the words.
        self.words = [t.encode().split() for t in frame["text"]]
        self.order = frame["o"].to_numpy(np.int64)
        every = np.empty(sum(map(len, self.words)), object)
        every[:] = list(chain.from_iterable(self.words))
        numbers, distinct = pd.factorize(every)
        size = np.array([len(w) for w in self.words], np.int64)
        end = np.cumsum(size)
        self.numbers = [numbers[b - n:b] for n, b in zip(size, end)]
        own = pd.util.hash_array(distinct, categorize=False)[numbers] if len(distinct) else np.zeros(0, np.uint64)
        doc = np.repeat(np.arange(len(size)), size)
        at = np.flatnonzero(doc[:max(0, len(doc) - window + 1)] == doc[window - 1:])
        self.hash = rolling(own, window)[at]
        self.anchor = least_of(rolling(own, anchor), window - anchor + 1)[at]
        self.doc, self.start = doc[at], at - (end - size)[doc[at]]


def least_of(x: np.ndarray, n: int) -> np.ndarray:
    """Smallest of every ``n`` consecutive entries, by doubling."""
    if len(x) < n:
        return x[:0]
    out, have = x, 1
    while have < n:
        step = min(have, n - have)
        out, have = np.minimum(out[:len(out) - step], out[step:]), have + step
    return out


def smallest(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the smallest value of each."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.minimum.reduceat(values[order], first)


def member(x: np.ndarray, sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is in, place) of ``x`` in sorted distinct keys."""
    if not len(sorted_keys):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)
    return sorted_keys[at] == x, at


def spaced(shard: Shard, recurs: np.ndarray) -> np.ndarray:
    """Of each document's runs of recurring windows every ``window``-th and the
    last: they cover the words that the whole run covers."""
    at = np.flatnonzero(recurs)
    if not len(at):
        return at
    joins = (at[1:] == at[:-1] + 1) & (shard.doc[at[1:]] == shard.doc[at[:-1]])
    begins, ends = np.r_[True, ~joins], np.r_[~joins, True]
    run = at[np.flatnonzero(begins)][np.cumsum(begins) - 1]
    return at[((at - run) % shard.window == 0) | ends]


def occurrences(shard: Shard, phrase_at: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Per document, which words the phrases cover whose owner is a smaller id.

    ``phrase_at`` picks a window for each phrase, ``owner`` is the smallest id
    that has it. All documents are streamed through the phrases' automaton.
    """
    masks = [np.zeros(len(n), bool) for n in shard.numbers]
    if not len(phrase_at):
        return masks
    size = shard.window
    phrases = np.array([shard.numbers[i][a:a + size] for i, a in zip(shard.doc[phrase_at], shard.start[phrase_at])])
    words = np.unique(phrases)
    # A word is two symbols, so that no state has very many ways to go on.
    base = int(np.ceil(np.sqrt(len(words)))) or 1
    code = np.full(max(int(n.max()) for n in shard.numbers if len(n)) + 1, -1)
    code[words] = np.arange(len(words))

    def symbols(numbers: np.ndarray) -> np.ndarray:
        c = code[numbers]
        return np.stack([c // base, base + c % base], -1).reshape(*numbers.shape[:-1], -1)

    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for k, phrase in enumerate(map(tuple, symbols(phrases).tolist())):
        automaton.add_word(phrase, k)
    automaton.make_automaton()
    for i, numbers in enumerate(shard.numbers):
        # A word of no phrase is in no match: the text is read between such words.
        other = np.flatnonzero(np.r_[True, code[numbers] < 0, True])
        steps = np.zeros(len(numbers) + 1, np.int64)
        for a, b in zip(other[:-1], other[1:] - 1):
            if b - a < size:
                continue
            found = list(automaton.iter(tuple(symbols(numbers[a:b]).tolist())))
            if found:
                end, phrase = np.array(found).T
                end = a + end[owner[phrase] < shard.order[i]] // 2
                np.add.at(steps, end - size + 1, 1)
                np.add.at(steps, end + 1, -1)
        masks[i] = np.cumsum(steps[:-1]) > 0
    return masks


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   anchor: int = ANCHOR, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept (the kept words
    joined by one space).

    Ids are integers; rows without one come after all others, and rows with
    equal ids (or none) remove nothing from each other. Null texts have no
    words; texts shorter than a window lose nothing. Windows are judged on
    the input. An empty table gives an empty result. A very long text is part
    of one shard, which is that much larger.
    """
    o = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    rows = sharded(docs, id_col, text_col, shard_chars, o=o)
    by_shard = rows.groupBy("shard")

    def anchors(frame: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(frame, window, anchor)
        found = np.unique(shard.anchor)
        return pd.DataFrame({"anchor": found.view(np.int64), "shard": frame["shard"].iloc[0]}).astype({"shard": "int32"})

    sent = by_shard.applyInPandas(anchors, "anchor long, shard int")
    elsewhere = F.count(F.lit(1)).over(Window.partitionBy("anchor")) > 1
    shared = sent.withColumn("elsewhere", elsewhere).filter("elsewhere").select("shard", "anchor")

    def candidates(frame: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
        if frame.empty or side.empty:
            return pd.DataFrame({"hash": [], "shard": [], "o": []}).astype(
                {"hash": "int64", "shard": "int32", "o": "int64"})
        shard = Shard(frame, window, anchor)
        use, _ = member(shard.anchor, np.sort(side["anchor"].to_numpy(np.int64).view(np.uint64)))
        keys, least = smallest(shard.hash[use], shard.order[shard.doc[use]])
        return pd.DataFrame({"hash": keys.view(np.int64), "shard": np.int32(frame["shard"].iloc[0]), "o": least})

    held = by_shard.cogroup(shared.groupBy("shard")).applyInPandas(candidates, "hash long, shard int, o long")
    everywhere = Window.partitionBy("hash")
    smaller = (held.withColumn("least", F.min("o").over(everywhere)).filter("least < o")
               .select("shard", "hash", "least"))

    def cut(frame: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(frame, window, anchor)
        keys, least = smallest(shard.hash, shard.order[shard.doc])
        if not side.empty:
            known, at = member(side["hash"].to_numpy(np.int64).view(np.uint64), keys)
            np.minimum.at(least, at[known], side["least"].to_numpy(np.int64)[known])
        _, at = member(shard.hash, keys)
        later = least[at] < shard.order[shard.doc] if len(keys) else np.zeros(0, bool)
        chosen = spaced(shard, later)
        phrase_at = chosen[np.unique(at[chosen], return_index=True)[1]]
        masks = occurrences(shard, phrase_at, least[at[phrase_at]])
        return pd.DataFrame({
            "doc_id": frame["doc_id"].to_numpy(), "n_words": [len(w) for w in shard.words],
            "n_removed": [int(m.sum()) for m in masks],
            "kept": [b" ".join(compress(w, ~m) if m.any() else w).decode() for w, m in zip(shard.words, masks)]})

    kind = id_as_text(docs, id_col)[1]
    return by_shard.cogroup(smaller.groupBy("shard")).applyInPandas(
        cut, "doc_id string, n_words long, n_removed long, kept string").withColumn("doc_id", F.col("doc_id").cast(kind))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
windows AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS x FROM starts),
least AS (SELECT x, min(doc_id) AS lo FROM windows GROUP BY x),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM windows JOIN least USING (x) WHERE lo < doc_id
), words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (
  SELECT doc_id, count(c.j) AS n_removed,
         string_agg(word, ' ' ORDER BY words.j) FILTER (c.j IS NULL) AS kept
  FROM words LEFT JOIN covered c USING (doc_id, j) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
