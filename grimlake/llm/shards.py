"""Documents dealt to shards of bounded size, for operators that exchange
facts about words or phrases between all documents.

A shard is the unit of work of one Python call. Text is shuffled to its shard
once; each later step sends only hashes, one row per shard at most for
anything that is frequent, so a phrase that a third of all documents share
costs as many rows as there are shards.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grimlake.llm.common import id_as_text, text_or_empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: The end of a text as a token; no word can be a space.
LAST_WORD = " "
PRIME = np.uint64(0x9E3779B185EBCA87)


def shard_count(docs: DataFrame, text_col: str, chars: int) -> int:
    """Shards of about ``chars`` characters, from the table's total."""
    total = docs.agg(F.coalesce(F.sum(F.char_length(text_or_empty(text_col))), F.lit(0)).alias("n")).first()["n"]
    return max(1, -(-int(total) // chars))


def sharded(docs: DataFrame, id_col: str, text_col: str, chars: int, shards: int | None = None,
            **extra: Column) -> DataFrame:
    """(shard, doc_id as text, ..., text), partitioned by shard; about ``chars``
    characters a shard, or as many ``shards`` as were counted before."""
    n = shards or shard_count(docs, text_col, chars)
    rows = docs.select(id_as_text(docs, id_col)[0].alias("doc_id"), text_or_empty(text_col).alias("text"))
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")
    return rows.select(shard.alias("shard"), "doc_id", *[c.alias(k) for k, c in extra.items()], "text").repartition(
        n, "shard")


class Vocabulary:
    """Numbers the words of one shard and knows their 64-bit hashes."""

    def __init__(self):
        self.ids: dict[str, int] = {}

    def number(self, words: list[str]) -> np.ndarray:
        ids = self.ids
        for w in set(words).difference(ids):
            ids[w] = len(ids)
        return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))

    def hashes(self) -> np.ndarray:
        words = np.array(list(self.ids), object)
        return pd.util.hash_array(words, categorize=False) if len(words) else np.zeros(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive entries of ``h``: a polynomial, made by doubling."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out, length, power = h, 1, int(PRIME)
    for bit in bin(n)[3:]:
        out = out[:len(out) - length] * np.uint64(power) + out[length:]
        length, power = 2 * length, power * power % 2**64
        if bit == "1":
            out = out[:len(out) - 1] * PRIME + h[length:]
            length, power = length + 1, power * int(PRIME) % 2**64
    return mix(out)
