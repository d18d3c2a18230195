"""LM scoring with a probabilistic suffix tree over the bytes of words.

A text is its words in lower case (A-Z), each followed by a space, and an end
mark. The tree holds byte contexts of up to DEPTH symbols. A context is
considered if it is frequent enough, and retained if its next-symbol
distribution diverges from that of its longest proper suffix by enough
likelihood over the corpus. Distributions are smoothed towards the suffix's;
a text is scored by the longest retained context at each position.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grimlake.llm.common import id_as_text, stored
from grimlake.llm.shards import PRIME, mix, shard_count, sharded

DEPTH = 5
#: Occurrences that a context must have, at every size of the corpus: the tree
#: grows with the text.
LEAST_COUNT = 8
#: Gain in log-likelihood (nats) that a context must bring over the corpus, and
#: its least divergence per occurrence.
LEAST_GAIN = 10.0
LEAST_DIVERGENCE = 0.001
#: Occurrences that the suffix's distribution weighs in smoothing, and nats
#: that a context must gain, for each different next symbol.
WEIGHT = 2.0
COST = 2.0
SHARD_CHARS = 8_000_000
CHUNK = 1024
BLOCK = 4096
BATCH_SYMBOLS = 2_000_000
#: Shards whose distinct grams, in number, make a part of the grams.
SHARDS_PER_PART = 4
#: Symbols: bytes, the end mark, and a start mark that is only ever context.
SPACE, END, START, SYMBOLS = 32, 256, 257, 258
BITS = 9
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: What a symbol adds to the hash of its word: nothing, if a start mark.
SYMBOL_HASH = np.r_[mix(np.arange(1, START + 1, dtype=np.uint64) * PRIME), np.uint64(0)]


def symbols(texts: list[str], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, starts): texts one after another, each behind ``depth`` start
    marks and closed by the end mark; ``starts`` are their first own symbols."""
    bodies = [b" ".join([*t.encode().translate(LOWER).split(), b""]) for t in texts]
    size = np.array([len(b) + 1 + depth for b in bodies], np.int64)
    begin = np.cumsum(size) - size
    out = np.full(int(size.sum()), START, np.int64)
    for b, at in zip(bodies, begin.tolist()):
        out[at + depth:at + depth + len(b)] = np.frombuffer(b, np.uint8)
        out[at + depth + len(b)] = END
    return out, begin + depth


def grams(sym: np.ndarray, depth: int) -> np.ndarray:
    """Key of each own symbol with its ``depth`` symbols before, oldest first."""
    n = len(sym) - depth
    if n <= 0:
        return np.zeros(0, np.int64)
    key = np.zeros(n, np.int64)
    for k in range(depth + 1):
        key = key << BITS | sym[k:n + k]
    return key[sym[depth:] != START]


def packed(a: np.ndarray) -> bytes:
    """An array as bytes: planes of its values' first, second, ... bytes, compressed."""
    return zlib.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes(), 1)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(zlib.decompress(data), np.uint8).reshape(size, -1).T.copy().reshape(-1).view(kind)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part that each gram belongs to; parts are even, whatever the text."""
    return (mix(keys.view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def numbered_grams(sym: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct :func:`grams`, ascending, and the place among them of each.

    A gram and its position are sorted as one number, over the symbols that
    occur; only where that takes more than 64 bits, the grams are sorted apart.
    """
    n = max(0, len(sym) - depth)
    there = np.bincount(sym, minlength=SYMBOLS) > 0
    kinds, bits = int(there.sum()), n.bit_length()
    if not n or kinds ** (depth + 1) << bits > 1 << 64:
        keys, at = np.unique(grams(sym, depth), return_inverse=True)
        return keys, at.astype(np.int32)
    code = (np.cumsum(there) - 1).astype(np.uint64)[sym]
    rank = code[:n].copy()
    for k in range(1, depth + 1):
        rank *= np.uint64(kinds)
        rank += code[k:n + k]
    own = np.flatnonzero(sym[depth:] != START)
    rank = rank[own]
    rank <<= np.uint64(bits)
    rank |= np.arange(len(own), dtype=np.uint64)
    rank.sort()
    nth = (rank & np.uint64((1 << bits) - 1)).astype(np.int64)
    rank >>= np.uint64(bits)
    first = np.r_[True, rank[1:] != rank[:-1]]
    at = np.empty(len(own), np.int32)
    at[nth] = np.cumsum(first, dtype=np.int32) - np.int32(1)
    start = own[nth[first]]
    keys = np.zeros(len(start), np.int64)
    for k in range(depth + 1):
        keys = keys << BITS | sym[start + k]
    return keys, at


def word_hashes(sym: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable 64-bit hash of each token (words, and a text's end), and how many
    tokens each text has. All words are hashed at once, by differences of one
    running sum over their symbols' hashes, each times a power of its place."""
    n = len(sym)
    end = np.flatnonzero((sym == SPACE) | (sym == END))
    last = sym[end] == END
    begin = np.r_[0, end[:-1] + 1][:len(end)] + depth * np.r_[True, last[:-1]][:len(end)]
    power = np.cumprod(np.full(n, PRIME))
    total = np.r_[np.uint64(0), np.cumsum(SYMBOL_HASH[sym] * power)]
    # The inverse of the power at each beginning, from one to the next.
    step = np.diff(begin, prepend=-1)
    back = np.cumprod(np.full(int(step.max(initial=0)), np.uint64(pow(int(PRIME), -1, 1 << 64))))
    back = np.cumprod(back[step - 1])
    # A text's end is a token of itself, one symbol long; a word goes up to its space.
    h = mix((total[end + last] - total[begin]) * back + (end - begin).astype(np.uint64))
    return h.view(np.int64), np.diff(np.r_[-1, np.flatnonzero(last)])


class Keys:
    """The distinct keys of a shard's texts, by part, then key, and where they stand."""

    def __init__(self, n_texts: int, parts: int, batches: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
        """``batches``: distinct keys, ascending; the place among them at each
        position; the numbers of the texts; and how many positions each has."""
        self.n_texts, self.batches = n_texts, batches
        keys = np.sort(np.concatenate([b[0] for b in self.batches]))
        keys = keys[np.r_[True, keys[1:] != keys[:-1]][:len(keys)]]
        part = part_of(keys, parts)
        self.order = np.argsort(part.astype(np.min_scalar_type(parts)), kind="stable")
        self.sorted, self.keys = keys, keys[self.order]
        self.bounds = np.searchsorted(part[self.order], np.arange(parts + 1))

    def cuts(self) -> list[slice]:
        """The keys of each part."""
        return [slice(a, b) for a, b in zip(self.bounds[:-1], self.bounds[1:])]

    def counts(self, counted: np.ndarray) -> np.ndarray:
        """Occurrences of ``keys`` in the texts that are ``counted``."""
        out = np.zeros(len(self.sorted), np.int64)
        for keys, at, mine, sizes in self.batches:
            n = np.bincount(at, weights=np.repeat(counted[mine], sizes), minlength=len(keys))
            out[np.searchsorted(self.sorted, keys)] += n.astype(np.int64)
        return out[self.order]

    def placed(self, values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(texts, sizes, the values at their positions) of ``values``, one for each of ``keys``."""
        table = np.zeros(len(values), values.dtype)
        table[self.order] = values
        for keys, at, mine, sizes in self.batches:
            yield mine, sizes, table[np.searchsorted(self.sorted, keys)][at]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per text the sum of ``values``, one for each of ``keys``, over its positions."""
        out = np.zeros(self.n_texts)
        for mine, sizes, own in self.placed(values):
            out[mine] = np.bincount(np.repeat(np.arange(len(mine)), sizes), weights=own, minlength=len(mine))
        return out


def shard_keys(texts: list[str], depth: int, parts: int) -> tuple[Keys, Keys]:
    """The grams and the words of a shard's texts, which are read in batches
    that bound the memory."""
    by_gram, by_word = [], []
    size = np.cumsum([len(t) for t in texts]) // BATCH_SYMBOLS
    for k in np.unique(size):
        mine = np.flatnonzero(size == k)
        sym, starts = symbols([texts[i] for i in mine], depth)
        ends = np.r_[starts[1:] - depth, len(sym)]
        by_gram.append((*numbered_grams(sym, depth), mine, ends - starts))
        hashes, n_tokens = word_hashes(sym, depth)
        words, at = np.unique(hashes, return_inverse=True)
        by_word.append((words, at.astype(np.int32), mine, n_tokens))
    return Keys(len(texts), parts, by_gram), Keys(len(texts), parts, by_word)


def shard_pairs(by_shard: GroupedData, depth: int, parts: int) -> DataFrame:
    """(shard, part, grams, n, words, word_n): the distinct grams and words of
    each shard, packed, and their counts in the rows that are not held out; 0
    for those only in others."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list[bytes]] = {}
        for own, keys, counts in zip(shard_keys(frame["text"].tolist(), depth, parts), ("grams", "words"), ("n", "word_n")):
            n = own.counts(~frame["held_out"].to_numpy(bool))
            out[keys] = [packed(np.diff(own.keys[c], prepend=0)) for c in own.cuts()]
            out[counts] = [packed(n[c]) for c in own.cuts()]
        return pd.DataFrame({"shard": np.int32(frame["shard"].iloc[0]), "part": np.arange(parts, dtype=np.int32), **out})

    return by_shard.applyInPandas(run, "shard int, part int, grams binary, n binary, words binary, word_n binary")


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the sum of ``n`` over each."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def read_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.int64))


def word_totals(pairs: DataFrame) -> DataFrame:
    """(part, shard, totals, tokens, kinds): counts over all shards of each
    shard's distinct words, in their order, packed; the first row of a part has
    the sum of its words' counts and how many words have one, others have 0."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        own = [read_keys(w) for w in frame["words"]]
        words, n = summed(np.concatenate(own), np.concatenate([unpacked(x, np.int64) for x in frame["word_n"]]))
        rest = [0] * (len(frame) - 1)
        return frame[["part", "shard"]].assign(
            totals=[packed(n[np.searchsorted(words, w)]) for w in own],
            tokens=[int(n.sum()), *rest], kinds=[int((n > 0).sum()), *rest])

    return pairs.select("part", "shard", "words", "word_n").groupBy("part").applyInPandas(
        run, "part int, shard int, totals binary, tokens long, kinds long")


def gram_counts(pairs: DataFrame) -> DataFrame:
    """(part, gram, n) over all shards."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        keys, n = summed(np.concatenate([read_keys(g) for g in frame["grams"]]),
                         np.concatenate([unpacked(x, np.int64) for x in frame["n"]]))
        return pd.DataFrame({"part": np.int32(frame["part"].iloc[0]), "gram": keys, "n": n})

    return pairs.select("part", "grams", "n").groupBy("part").applyInPandas(run, "part int, gram long, n long")


def low(column: str, symbols_: int) -> Column:
    """The newest symbols of a key."""
    return F.col(column).bitwiseAND((1 << BITS * symbols_) - 1)


def gram_scores(counts: DataFrame, depth: int = DEPTH, least_count: int = LEAST_COUNT, least_gain: float = LEAST_GAIN,
                divergence: float = LEAST_DIVERGENCE, weight: float = WEIGHT, cost: float = COST) -> DataFrame:
    """(part, gram, logp): log10 probability of each gram's symbol after its
    longest retained context. ``counts`` has (part, gram, n), n = 0 for grams
    that are not learnt from.

    The tree is a table a level, one row per context and symbol that occur.
    A level is smoothed by joining it with the level of its suffixes, and a
    context's gain is a sum over its rows. No join meets more rows of a key
    than there are symbols, so no task, and no process, holds the tree.
    """
    levels = {depth: counts.withColumnRenamed("gram", "key")}
    for d in range(depth - 1, -1, -1):
        levels[d] = stored(levels[d + 1].groupBy(low("key", d + 1).alias("key")).agg(F.sum("n").alias("n")),
                           f"op6-level{d}")
    total = levels[0].agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    done = {0: levels[0].select("key", F.array((F.col("n") + 1.0) / (total + END + 1.0)).alias("p"))}
    context = F.shiftright("key", BITS)
    for d in range(1, depth + 1):
        same = Window.partitionBy("context")
        rows = levels[d].withColumn("context", context).withColumns({
            "all": F.sum("n").over(same), "kinds": F.sum(F.when(F.col("n") > 0, 1.0).otherwise(0.0)).over(same)})
        base = done[d - 1].select(F.col("key").alias("short"), F.col("p").alias("before"))
        rows = rows.withColumn("short", low("key", d)).join(base, "short").withColumn("base", F.element_at("before", -1))
        enough = F.col("all") >= max(1, least_count)
        rows = rows.withColumn("now", F.when(
            enough, (F.col("n") + weight * F.col("kinds") * F.col("base")) / (F.col("all") + weight * F.col("kinds")))
            .otherwise(F.col("base")))
        gain = F.sum(F.when(F.col("n") > 0, F.col("n") * F.log(F.col("now") / F.col("base"))).otherwise(0.0)).over(same)
        rows = rows.withColumn("gain", gain)
        own = (enough & (F.col("gain") >= divergence * F.col("all"))
               & (F.col("gain") >= F.greatest(F.lit(least_gain), cost * F.col("kinds"))))
        done[d] = stored(rows.select(*[c for c in ("part",) if d == depth], "key", "context", own.alias("own"),
                                     F.array_append("before", F.col("now")).alias("p")), f"op6-smooth{d}")
    # With a context its suffixes are retained: from the longest on, each level
    # gives its own to the next.
    kept: dict[int, DataFrame] = {}
    for d in range(depth, 0, -1):
        mine = done[d].filter("own").select("context")
        if d < depth:
            mine = mine.unionAll(kept[d + 1].select(low("context", d).alias("context")))
        kept[d] = stored(mine.distinct(), f"op6-kept{d}")
    # Length of the longest retained suffix of every context.
    longest = None
    for d in range(1, depth + 1):
        names = done[d].select("context").distinct()
        names = names.join(kept[d].withColumn("is", F.lit(d)), "context", "left")
        if d > 1:
            names = names.withColumn("short", low("context", d - 1)).join(
                longest.select(F.col("context").alias("short"), "len"), "short")
        else:
            names = names.withColumn("len", F.lit(0))
        longest = names.select("context", F.coalesce("is", "len").alias("len"))
    return done[depth].join(longest, "context").select(
        "part", F.col("key").alias("gram"), F.log10(F.element_at("p", F.col("len") + 1)).alias("logp"))


def shard_scores(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """(shard, part, logp): scores of each shard's distinct grams, in their order, packed."""

    def run(frame: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("gram")
        keys, logp = table["gram"].to_numpy(np.int64), table["logp"].to_numpy(np.float32)
        return pd.DataFrame({"shard": frame["shard"].to_numpy(), "part": frame["part"].to_numpy(), "logp": [
            packed(logp[np.searchsorted(keys, read_keys(g))]) for g in frame["grams"]]})

    return pairs.select("part", "shard", "grams").groupBy("part").cogroup(scores.groupBy("part")).applyInPandas(
        run, "shard int, part int, logp binary")


class Tree:
    """The same tree in one process, for small tables: a suffix tree as an automaton: ``step[state, symbol]`` is the longest
    retained context after the symbol, ``logp`` the log10 probabilities."""

    def __init__(self, rows: pd.DataFrame, depth: int, gain_share: float = 0.0,
                 divergence: float = LEAST_DIVERGENCE, weight: float = WEIGHT, cost: float = COST):
        self.depth = depth
        level, context, symbol, n = (rows[c].to_numpy(np.int64) for c in ("depth", "context", "symbol", "n"))
        contexts, parents, smoothed, passed = [], [], [], []
        gain = max(LEAST_GAIN, gain_share * float(n[level == 0].sum()))
        for d in range(depth + 1):
            at = np.flatnonzero(level == d)
            at = at[np.argsort(context[at], kind="stable")]
            names, first, row = np.unique(context[at], return_index=True, return_inverse=True)
            if d == 0 and not len(names):  # nothing to learn from
                names, first = np.zeros(1, np.int64), np.zeros(1, np.int64)
            bounds = np.r_[first, len(at)]
            up = np.searchsorted(contexts[-1], self.suffix(names, d)) if d else np.zeros(1, np.int64)
            keep, tables = np.ones(len(names), bool), []
            for lo in range(0, len(names), BLOCK):  # blocks bound the driver's memory
                hi = min(lo + BLOCK, len(names))
                mine = at[bounds[lo]:bounds[hi]]
                counts = np.zeros((hi - lo, END + 1), np.float32)
                counts[row[bounds[lo]:bounds[hi]] - lo, symbol[mine]] = n[mine]
                total = counts.sum(axis=1, dtype=np.float64)[:, None].astype(np.float32)
                if d == 0:
                    tables.append((counts + 1) / (total + END + 1))
                    continue
                seen, base = counts > 0, smoothed[-1][up[lo:hi]]
                kinds = seen.sum(axis=1)[:, None].astype(np.float32)
                smooth = (counts + weight * kinds * base) / (total + weight * kinds)
                # divergence from the suffix: per occurrence, and in all
                ratio = np.zeros_like(counts)
                np.log(smooth / base, out=ratio, where=seen)
                kl = (counts * ratio).sum(axis=1) / total[:, 0]
                keep[lo:hi] = (kl >= divergence) & (kl * total[:, 0] >= np.maximum(gain, cost * kinds[:, 0]))
                # of the longest contexts only the retained ones are needed later
                tables.append(smooth if d < depth else smooth[keep[lo:hi]])
            contexts.append(names)
            parents.append(up)
            smoothed.append(np.concatenate(tables) if tables else np.zeros((0, END + 1), np.float32))
            passed.append(keep)
        # With a context its suffixes are retained. Prefixes of states are states
        # too, so that one symbol leads from state to state; the ones added for
        # that predict as their longest retained suffix.
        for d in range(depth, 0, -1):
            passed[d - 1][parents[d][passed[d]]] = True
        states = [p.copy() for p in passed]
        for d in range(depth, 0, -1):
            states[d - 1][parents[d][states[d]]] = True
            prefix = np.unique(contexts[d][states[d]] >> BITS)
            states[d - 1][np.searchsorted(contexts[d - 1], prefix)] = True
        sizes = [int(k.sum()) for k in states]
        first = np.cumsum([0, *sizes])
        self.step = np.zeros((first[-1], SYMBOLS), np.int32)
        self.logp = np.zeros((first[-1], END + 1), np.float32)
        number = [first[d] + np.cumsum(states[d]) - 1 for d in range(depth + 1)]
        for d in range(depth + 1):
            mine = slice(first[d], first[d + 1])
            names = contexts[d][states[d]]
            own = passed[d][states[d]]
            self.logp[mine] = np.log10(smoothed[d][states[d]] if d < depth else smoothed[d])
            smoothed[d] = None
            if d:
                up = number[d - 1][parents[d][states[d]]]
                self.step[mine] = self.step[up]
                self.logp[mine][~own] = self.logp[up[~own]]
            if d < depth:
                longer = contexts[d + 1][states[d + 1]]
                self.step[first[d] + np.searchsorted(names, longer >> BITS), longer & ((1 << BITS) - 1)] = (
                    first[d + 1] + np.arange(len(longer)))
        self.states, self.retained = int(first[-1]), int(sum(p.sum() for p in passed))

    @staticmethod
    def suffix(context: np.ndarray, d: int) -> np.ndarray:
        """Contexts of ``d`` symbols without their oldest one."""
        return context & ((1 << BITS * (d - 1)) - 1)

    def score(self, texts: list[str]) -> np.ndarray:
        """log10 probability of each text. Long texts are cut into chunks that
        are read side by side, each after the ``depth`` symbols before it,
        which fix its first state."""
        sym, starts = symbols(texts, self.depth)
        ends = np.r_[starts[1:] - self.depth, len(sym)] if len(starts) else starts
        size = ends - starts
        per = -(-size // CHUNK)
        text = np.repeat(np.arange(len(texts)), per)
        nth = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
        a = starts[text] + nth * CHUNK
        b = np.minimum(a + CHUNK, ends[text])
        order = np.argsort(a - b, kind="stable")  # longest first: finished chunks fall off the end
        text, a, b = text[order], a[order], b[order]
        state = np.zeros(len(a), np.int64)
        for k in range(self.depth):
            state = self.step[state, sym[a - self.depth + k]].astype(np.int64)
        total = np.zeros(len(a))
        length = b - a
        for k in range(int(length.max(initial=0))):
            live = int(np.searchsorted(-length, -k))  # chunks longer than k
            s = sym[a[:live] + k]
            total[:live] += self.logp[state[:live], s]
            state[:live] = self.step[state[:live], s]
        return np.bincount(text, weights=total, minlength=len(texts))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
          least_count: int = LEAST_COUNT, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    Rows whose crc32(doc_id as text) mod 7 is 2 are held out, all others are
    learnt from; a null id counts as an empty text there. Null texts count as
    empty: their only token is the end. Rows repeated count as often as they
    occur. Without training rows all counts are 0 and the tree is its uniform
    root. An empty table gives an empty result. Whole texts are counted and
    scored. The tree is never in one place: grams are counted and scored by
    joins, and a shard gets the scores of the grams that it has. Word counts
    are exact, over 64-bit word hashes, and shared between shards, packed by
    shard and part like the grams. A shard's texts go to Python twice: to be
    counted and to be scored.
    """
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2
    shards = shard_count(docs, text_col, shard_chars)
    rows = sharded(docs, id_col, text_col, shard_chars, shards, held_out=held)
    by_shard = rows.groupBy("shard")
    parts = max(1, shards // SHARDS_PER_PART)
    pairs = stored(shard_pairs(by_shard, depth, parts), "op6-pairs")
    totals = stored(word_totals(pairs), "op6-words")
    learnt = stored(gram_counts(pairs), "op6-grams")
    scores = shard_scores(pairs, gram_scores(learnt, depth, least_count))
    once = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
                      F.coalesce(F.sum("kinds"), F.lit(0)).alias("kinds")).first()
    side_rows = scores.select("shard", "part", F.lit(True).alias("of_grams"), F.col("logp").alias("data")).unionByName(
        totals.select("shard", "part", F.lit(False).alias("of_grams"), F.col("totals").alias("data")))

    def judge(frame: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
        side = side.sort_values("part")
        of_grams = side["of_grams"].to_numpy(bool)
        logp = np.concatenate([unpacked(x, np.float32) for x in side["data"][of_grams]])
        n = np.concatenate([unpacked(x, np.int64) for x in side["data"][~of_grams]])
        by_gram, by_word = shard_keys(frame["text"].tolist(), depth, parts)
        n_tokens, n_known = (np.zeros(len(frame), np.int64) for _ in range(2))
        logs = np.zeros(len(frame))
        for mine, sizes, own in by_word.placed(n):
            ends = np.cumsum(sizes)
            known, log = np.r_[0, np.cumsum(own > 0)], np.log10(own + 1.0)
            n_tokens[mine], n_known[mine] = sizes, known[ends] - known[ends - sizes]
            logs[mine] = [log[b - k:b].sum() for b, k in zip(ends.tolist(), sizes.tolist())]
        return pd.DataFrame({
            "doc_id": frame["doc_id"].to_numpy(), "held_out": frame["held_out"].to_numpy(bool),
            "n_tokens": n_tokens, "n_known": n_known, "logs": logs, "score": by_gram.sums(logp.astype(float))})

    kind = id_as_text(docs, id_col)[1]
    judged = by_shard.cogroup(side_rows.groupBy("shard")).applyInPandas(
        judge, "doc_id string, held_out boolean, n_tokens long, n_known long, logs double, score double")
    tokens, kinds = F.lit(once["tokens"]).cast("long"), F.lit(once["kinds"]).cast("long")
    return judged.select(
        F.col("doc_id").cast(kind).alias("doc_id"), "held_out", "n_tokens", "n_known", tokens.alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.log10((tokens + kinds + 1).cast("double"))).alias("base_score"), "score")
