"""N-gram Jaccard join: documents whose shingle sets are similar, exactly.

1. Documents with equal shingle sets become one class; its smallest id stands
   for it.
2. A set of n shingles shares at least t = ceil(n * similarity) of them with
   any set it is similar to. So, in one order of all shingles, two similar sets
   have a shingle in common among the first n - t + 1 of each. The order is by
   number of occurrences, the rarest first: a passage that many documents share
   comes last, and most sets have so many shingles of their own that they are
   in no pair. Classes that share such a shingle are linked to one of them, and
   the connected components of those links are clusters that no link leaves.
3. Within a cluster, each class searches the others by T-occurrence: the
   shortest inverted lists are merged, the long ones only probed by binary
   search for documents that can still reach the required overlap (DivideSkip).
   Large clusters are searched block by block.
4. The links' connected components give the result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grimlake.llm.common import drop_stored, id_as_text, id_key, pick_rows, row_hash, stored, text_or_empty
from grimlake.llm.piece_tokens import chunks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SHINGLE = 3
#: Similarity as a fraction: 100 * common >= 90 * union.
SIMILAR, OF = 90, 100
#: Classes and shingles that one block of a cluster holds at most, about.
BLOCK_DOCS = 8192
BLOCK_SHINGLES = 6_000_000
CHUNK_CHARS = 4_000_000
#: Characters of texts whose shingles are counted as one chunk, and shingles
#: that are counted in one call, about.
COUNT_CHARS = 16_000_000
COUNT_SHINGLES = 2_000_000
#: Bits of a shingle by which it is counted: two that agree in them count as one.
KEY_BITS = 48
WORD_CHARS = 500_000
#: Bits of class names that are exchanged to find clusters: two that agree in
#: them only put more into one cluster.
LABEL = (1 << 48) - 1
#: Work of one binary probe, in list entries read.
PROBE_COST = 16
#: Members of small clusters that are searched in one call, about.
BIN_DOCS = 2048


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser of integers (wrapping arithmetic)."""
    x = x.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Stable 64-bit hashes of words in lower case, kept between texts up to a
    bound: words seen before are neither lowered nor hashed again."""

    KEPT = 400_000

    def __init__(self):
        self.seen: dict[str, int] = {}

    def hashes(self, words: list[str]) -> np.ndarray:
        new = list(set(words).difference(self.seen))
        if new:
            if len(self.seen) > self.KEPT:
                self.seen.clear()
                new = list(set(words))
            lower = "\n".join(new).translate(LOWER).split("\n")  # no word holds a line end
            values = pd.util.hash_array(np.array(lower, object), categorize=False)
            self.seen.update(zip(new, values.tolist()))
        return np.fromiter(map(self.seen.__getitem__, words), np.uint64, len(words))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(31) + h[k:len(h) - n + 1 + k], k)
    return out


def shingle_sets(texts: list[str], words: Words, shingle: int) -> list[np.ndarray]:
    """Per text the sorted distinct shingle hashes; a shorter text is one shingle,
    an empty one none. The words of all texts are handled as one array."""
    lists = [WORD.findall(t) for t in texts]
    h = words.hashes([w for x in lists for w in x])
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    end = np.cumsum(size)
    n_sets = np.where(size >= shingle, size - shingle + 1, np.minimum(size, 1))
    out_end = np.cumsum(n_sets)
    flat = np.zeros(int(n_sets.sum()), np.uint64)
    long_ = size >= shingle
    # Windows over the whole array, but those that begin near a text's end.
    every = windows(h, shingle)
    start = np.repeat(end - size - (out_end - n_sets), n_sets) + np.arange(len(flat))
    at = np.repeat(long_, n_sets)
    flat[at] = every[start[at]]
    for i in np.flatnonzero((size > 0) & ~long_):
        flat[out_end[i] - 1] = windows(h[end[i] - size[i]:end[i]], int(size[i]))[0] + np.uint64(size[i])
    for a, b in zip((out_end - n_sets).tolist(), out_end.tolist()):
        flat[a:b].sort()
    first = np.r_[True, flat[1:] != flat[:-1]][:len(flat)]
    first[(out_end - n_sets)[n_sets > 0]] = True
    kept = np.r_[0, np.cumsum(first)]
    return np.split(flat[first], kept[out_end[:-1]]) if len(texts) else []


def set_names(sets: list[np.ndarray]) -> np.ndarray:
    """Each set's 64-bit name: equal sets have equal names."""
    size = np.array([len(s) for s in sets], np.int64)
    sums = np.r_[np.uint64(0), np.cumsum(mixed(np.concatenate(sets), 6), dtype=np.uint64)] if len(sets) else np.zeros(1, np.uint64)
    end = np.cumsum(size)
    return mixed(sums[end] - sums[end - size] + size.astype(np.uint64), 7).view(np.int64)


def local_components(who: np.ndarray, sig: np.ndarray, n: int) -> np.ndarray:
    """Smallest set number that each of ``n`` sets is connected to by shared
    signatures; ``who`` and ``sig`` are in order of ``sig``."""
    label = np.arange(n)
    start = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
    size = np.diff(np.r_[start, len(sig)])
    start, size = start[size > 1], size[size > 1]
    if not len(start):
        return label
    inside = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    who, at = who[inside], np.cumsum(size) - size
    while True:
        least = np.repeat(np.minimum.reduceat(label[who], at), size)
        if (least == label[who]).all():
            return label
        np.minimum.at(label, who, least)
        label = label[label]


def parts_of(frames: Iterator[pd.DataFrame], shingle: int, chars: int = CHUNK_CHARS) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Bounded parts of the frames, with the shingle sets of their texts."""
    words = Words()
    for frame in frames:
        size = frame["text"].str.len().cumsum() // chars
        for _, part in frame.groupby(size, sort=False):
            # Words of few texts at a time are held as strings.
            texts = part["text"].tolist()
            yield part, [s for a, b in chunks(texts, WORD_CHARS) for s in shingle_sets(texts[a:b], words, shingle)]


def named(rows: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, k, h, n, node) of rows (doc_id, k, h, text); ``node`` names the set."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, sets in parts_of(frames, shingle):
            yield part[["doc_id", "k", "h"]].assign(n=[len(s) for s in sets], node=set_names(sets))

    return rows.mapInPandas(run, "doc_id string, k long, h long, n long, node long")


def planes(a: np.ndarray) -> bytes:
    """An array as planes of its values' first, second, ... bytes: those that
    are zero throughout cost nothing once the shuffle compresses them."""
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().reshape(-1).view(kind)


def chunk_parts(sets: list[np.ndarray], parts: int) -> pd.DataFrame:
    """(part, chunk, slices, names, sizes, keys, docs) of the distinct sets of a
    chunk: its shingles' keys with the number of the set that has them, dealt by
    key. The first row also has the names and sizes of the sets, and how many
    rows there are. The chunk is named by its sets, so a task that runs again,
    or another one with equal texts, names it alike."""
    names, first = np.unique(set_names(sets), return_index=True)
    sets = [sets[i] for i in first]
    sizes = np.array([len(x) for x in sets], np.int64)
    names, sets, sizes = names[sizes > 0], [x for x in sets if len(x)], sizes[sizes > 0]
    if not len(names):
        return pd.DataFrame()
    keys, docs = by_key(sets, sizes)
    # A part is a range of keys: those whose leading 32 bits, as a fraction, fall into it.
    lowest = np.array([-(-(p << 32) // parts) for p in range(1, parts)], np.uint64) << np.uint64(KEY_BITS - 32)
    bounds = np.r_[0, np.searchsorted(keys, lowest), len(keys)]
    part = np.flatnonzero(bounds[1:] > bounds[:-1])
    cuts = [slice(a, b) for a, b in zip(bounds[part], bounds[part + 1])]
    return pd.DataFrame({
        "part": part, "chunk": int.from_bytes(hashlib.blake2b(names.tobytes(), digest_size=8).digest(), "little", signed=True),
        "slices": [len(part)] + [0] * (len(part) - 1), "names": [names.tobytes()] + [b""] * (len(part) - 1),
        "sizes": [planes(sizes)] + [b""] * (len(part) - 1),
        "keys": [planes(np.diff(keys[c], prepend=np.uint64(0))) for c in cuts],
        "docs": [planes(docs[c]) for c in cuts]})


def by_key(sets: list[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, number of the set that has it) of all shingles, in this order. Sorted
    in place as one number where both fit into 64 bits."""
    keys = np.concatenate(sets)
    keys >>= np.uint64(64 - KEY_BITS)
    docs = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
    if len(sets) > 1 << 64 - KEY_BITS:
        order = np.argsort(keys, kind="stable")
        return keys[order], docs[order]
    keys <<= np.uint64(64 - KEY_BITS)
    keys |= docs
    keys.sort()
    np.bitwise_and(keys, np.uint64((1 << 64 - KEY_BITS) - 1), out=docs, casting="unsafe")
    keys >>= np.uint64(64 - KEY_BITS)
    return keys, docs


def often(frame: pd.DataFrame) -> pd.DataFrame:
    """The rows of a part with, of their shingles, those that occur more than
    once, and how often they do. One array of the part's keys is held, the rows'
    own are unpacked one row at a time."""
    frame = frame.drop_duplicates("chunk")

    def keys_of(data: bytes) -> np.ndarray:
        return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)

    every = np.empty(sum(map(len, frame["keys"])) // 8, np.uint64)
    end = 0
    for data in frame["keys"]:
        mine = keys_of(data)
        every[end:end + len(mine)] = mine
        end += len(mine)
    every.sort()
    again = every[1:][every[1:] == every[:-1]]
    del every
    first = np.flatnonzero(np.r_[True, again[1:] != again[:-1]][:len(again)])
    shared, times = again[first], np.diff(np.r_[first, len(again)]) + 1
    del again, first
    out: dict[str, list[bytes]] = {"keys": [], "docs": [], "n": []}
    for data, d in zip(frame["keys"], frame["docs"]):
        k = keys_of(data)
        at = np.searchsorted(shared, k)
        more = at < len(shared)
        more[more] = shared[at[more]] == k[more]
        for name, x in (("keys", k[more]), ("docs", from_planes(d, np.uint32)[more]), ("n", times[at[more]])):
            out[name].append(planes(x))
    return frame[["chunk", "slices", "names", "sizes"]].assign(**out)


def rare_shared(frame: pd.DataFrame, similar: int, of: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, set number, key) of a chunk: the keys that occur more than once
    among each set's rarest n - t + 1. Shingles that occur once come before them."""
    head = frame[frame["slices"] > 0]
    if len(head) != 1 or len(frame) != head["slices"].iloc[0]:
        raise RuntimeError("a text was read otherwise by a task that ran again")
    names = np.frombuffer(head["names"].iloc[0], np.int64)
    sizes = from_planes(head["sizes"].iloc[0], np.int64)
    keys, docs, n = (np.concatenate([from_planes(x, kind) for x in frame[c]])
                     for c, kind in (("keys", np.uint64), ("docs", np.uint32), ("n", np.int64)))
    docs = docs.astype(np.int64)
    order = np.lexsort((keys, n, docs))
    keys, docs = keys[order], docs[order]
    held = np.bincount(docs, minlength=len(names))
    place = np.arange(len(docs)) - (np.cumsum(held) - held)[docs] + (sizes - held)[docs]
    take = place < (sizes + (-sizes * similar // of) + 1)[docs]
    # shingles of a set that agree in their key are one
    take[1:] |= take[:-1] & (docs[1:] == docs[:-1]) & (keys[1:] == keys[:-1])
    return names, docs[take], keys[take]


def near_classes(rows: DataFrame, shingle: int, similar: int, of: int, parts: int) -> DataFrame:
    """Distinct links (a, b) of classes that share one of their rarest shingles,
    each to the smallest class that has it. Chunks of texts send their shingles,
    packed, to be counted, and get back those that are not theirs alone. Classes
    of one chunk are connected there: each leaves one link, and a shingle one
    row, of the class that stands for its classes. So however common a shingle
    or large a group is, it costs a row per chunk at most, and a link per class."""

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, sets in parts_of(frames, shingle, COUNT_CHARS):
            if len(out := chunk_parts(sets, parts)):
                yield out

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        names, who, sig = rare_shared(frame, similar, of)
        order = np.argsort(sig, kind="stable")
        who, sig = who[order], sig[order]
        local = local_components(who, sig, len(names))
        first = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]][:len(sig)])
        label = names & LABEL
        below = np.flatnonzero(local != np.arange(len(names)))
        return pd.DataFrame({
            "sig": np.r_[sig[first].astype(np.int64), label[local[below]]],
            "linked": np.r_[np.zeros(len(first), bool), np.ones(len(below), bool)],
            "a": np.r_[label[local[who[first]]], label[below]]})

    binary = "names binary, sizes binary, keys binary, docs binary"
    sent = rows.select("text").mapInPandas(send, f"part long, chunk long, slices long, {binary}")
    counted = sent.groupBy("part").applyInPandas(often, f"chunk long, slices long, {binary}, n binary")
    # Rows of a link name the class they are linked to in place of a shingle.
    signed = stored(counted.groupBy("chunk").applyInPandas(link, "sig long, linked boolean, a long"), "op3-rare")
    of_sig = signed.filter("NOT linked")
    hubs = of_sig.groupBy("sig").agg(F.min("a").alias("b"), F.max("a").alias("most")).filter("b < most").select("sig", "b")
    found = of_sig.join(hubs, "sig").select("a", "b").unionByName(
        signed.filter("linked").select("a", F.col("sig").alias("b")))
    out = stored(found.filter("a != b").distinct(), "op3-near")
    drop_stored(signed)
    return out


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, component) of every node of the links (a, b): the smallest node
    it is connected to. Each round gives every node the smallest label around
    it and then its label's label, until nothing changes. Sums are combined
    before they are shuffled, so a node with very many links is no hot spot."""
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .distinct(), f"{name}-links")
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("component"))
    before = labels = stored(labels, f"{name}-labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("m"))
                .select(F.col("a").alias("node"), "m"))
        step = labels.join(near, "node").select(
            "node", F.least("component", "m").alias("to"), (F.col("m") < F.col("component")).alias("changed"))
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("further"))
        step = stored(step.join(jump, "to").select(
            "node", F.least("to", "further").alias("component"), "changed"), f"{name}-labels")
        drop_stored(before)
        before, labels = step, step.select("node", "component")
        if not step.filter("changed").limit(1).count():
            drop_stored(both)
            return labels


def search(query: list[np.ndarray], index: list[np.ndarray], same: bool, similar: int,
           of: int) -> Iterator[tuple[int, np.ndarray]]:
    """T-occurrence search: (i, js) of each query set and the index sets similar
    to it; if ``same``, both are one list and a set isn't similar to itself."""
    sizes = np.array([len(s) for s in index], np.int64)
    flat = np.concatenate(index)
    doc = np.repeat(np.arange(len(index)), sizes)
    order = np.argsort(flat, kind="stable")  # postings of a shingle in order of documents
    flat, doc = flat[order], doc[order]
    start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    terms, ends = flat[start], np.r_[start[1:], len(flat)]
    for i, q in enumerate(query):
        at = np.searchsorted(terms, q)
        at = at[(at < len(terms)) & (terms[np.minimum(at, len(terms) - 1)] == q)]
        n = len(q)
        least_size = -(-n * similar // of)
        need_min = -(-(n + least_size) * similar // (of + similar))  # T for the smallest partner
        if len(at) < need_min:
            continue
        length = ends[at] - start[at]
        at = at[np.argsort(length, kind="stable")]
        # The long lists that are probed: all but so many that a partner must
        # be in one of the merged ones.
        probed = need_min - 1
        short, long_ = at[:len(at) - probed], at[len(at) - probed:]
        count = np.bincount(np.concatenate([doc[start[t]:ends[t]] for t in short]), minlength=len(index))
        found = np.flatnonzero(count)
        m = sizes[found]
        ok = (m * of >= n * similar) & (n * of >= m * similar)
        ok &= count[found] + probed >= -(-(n + m) * similar // (of + similar))
        if same:
            ok &= found != i
        found = found[ok]
        need = -(-(n + sizes[found]) * similar // (of + similar))
        length = ends[long_] - start[long_]
        if len(found) * len(long_) * PROBE_COST > length.sum() + len(index):
            # so many candidates that reading the long lists is less work
            if len(long_) and len(found):
                count = count + np.bincount(np.concatenate([doc[start[t]:ends[t]] for t in long_]),
                                            minlength=len(index))
            found = found[count[found] >= need]
        else:
            count = count[found]
            for left, t in enumerate(long_):
                if not len(found):
                    break
                posting = doc[start[t]:ends[t]]
                where = np.minimum(np.searchsorted(posting, found), len(posting) - 1)
                count = count + (posting[where] == found)
                ok = count + (probed - left - 1) >= need
                if not ok.all():
                    found, count, need = found[ok], count[ok], need[ok]
        if len(found):
            yield i, found


def search_group(i: int, j: int, frame: pd.DataFrame, similar: int, of: int) -> list[tuple[int, int, int]]:
    """(node, b, links) for the sets of block ``i`` of a cluster against block
    ``j``: the number of rows each is linked with there, and one class that it
    is connected to. All pairs are found; a row per class leaves."""
    left = frame[frame["block"] == i]
    right = left if i == j else frame[frame["block"] == j]
    if left.empty or right.empty:
        return []
    a_node, b_node = left["node"].tolist(), right["node"].tolist()
    a_copies, b_copies = left["copies"].to_numpy(), right["copies"].to_numpy()
    a_sets = [np.frombuffer(b, np.uint64) for b in left["shingles"]]
    b_sets = a_sets if i == j else [np.frombuffer(b, np.uint64) for b in right["shingles"]]
    links = dict.fromkeys([*a_node, *b_node], 0)
    parent = {v: v for v in links}

    def root(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for q, found in search(a_sets, b_sets, i == j, similar, of):
        links[a_node[q]] += int(b_copies[found].sum())
        top = root(a_node[q])
        for x in found.tolist():
            if i != j:
                links[b_node[x]] += int(a_copies[q])
            other = root(b_node[x])
            if other != top:
                top, low = min(top, other), max(top, other)
                parent[low] = top
    return [(v, root(v), n) for v, n in links.items() if n]


def cluster_links(rows: DataFrame, classes: DataFrame, clusters: DataFrame, shingle: int, similar: int, of: int,
                  block_docs: int, block_shingles: int) -> DataFrame:
    """(a, b, links) of the classes in clusters. A cluster beyond a block's
    bounds is dealt to blocks by hash, and every pair of blocks is searched by
    itself; small clusters are searched many in a call. Only texts of
    clustered classes are shingled and sent."""
    members = classes.withColumn("label", F.col("node").bitwiseAND(F.lit(LABEL))).join(
        clusters.select(F.col("node").alias("label"), "component"), "label")
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("held"))
    sizes = stored(sizes.select(F.col("component").alias("cluster"), "docs", F.greatest(
        F.ceil(F.col("docs") / block_docs), F.ceil(F.col("held") / block_shingles)).cast("long").alias("blocks")),
        "op3-clusters")
    small = sizes.filter("blocks = 1").agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("n")).first()["n"]
    bins = max(1, -(-int(small) // BIN_DOCS))
    members = stored(members.join(sizes, F.col("component") == F.col("cluster")).select(
        "k", "node", "copies", "cluster", "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("long").alias("block")), "op3-members")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, sets in parts_of(frames, shingle):
            mine = set_names(sets)
            out = part.drop(columns="text").assign(shingles=[s.tobytes() for s in sets])
            yield out[out["node"] == mine]

    # The same plan at every size: by key, never by broadcasting members, which grow with the input.
    sets = rows.select("k", "text").join(members.hint("merge"), "k").select(
        "node", "copies", "cluster", "blocks", "block", "text").mapInPandas(
        run, "node long, copies long, cluster long, blocks long, block long, shingles binary")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    big = F.col("blocks") > 1
    tasks = sets.withColumn("other", other).select(
        big.alias("big"), F.when(big, F.col("cluster")).otherwise(
            F.pmod(F.xxhash64("cluster"), F.lit(bins))).alias("bin"),
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "cluster", "block", "node", "copies", "shingles")

    def find(key: tuple[Any, ...], frame: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        for _, one in frame.drop_duplicates("node").sort_values(["cluster", "node"]).groupby("cluster", sort=False):
            out += search_group(int(key[2]), int(key[3]), one, similar, of)
        return pd.DataFrame(out, columns=["a", "b", "links"]).astype("int64")

    return tasks.groupBy("big", "bin", "i", "j").applyInPandas(find, "a long, b long, links long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       similar: int = SIMILAR, of: int = OF, block_docs: int = BLOCK_DOCS,
                       block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, n_links, k, h, kept.

    ``component_id`` is the smallest doc_id reachable over links, the row's
    own included; ``n_links`` counts the rows it is linked with, rows with an
    equal set included; ``kept`` marks one row of each component: one with the
    smallest id (rows repeated in full are all marked). (k, h) are hashes of
    the id and the row. Words are lower-cased in A-Z; a text with fewer words
    than a shingle is one shingle; null texts and texts without words have no
    shingles and no links. Rows that repeat an id with other texts are
    documents of their own; null ids come after all others. An empty table
    gives an empty result. Whole texts are read. Sets and shingles are known
    by 64-bit hashes.
    """
    doc_id, kind = id_as_text(docs, id_col)
    base = docs.select(doc_id.alias("doc_id"), id_key(id_col).alias("k"), row_hash(docs).alias("h"),
                       text_or_empty(text_col).alias("text"))
    rows = stored(named(base, shingle).withColumn("doc_id", F.col("doc_id").cast(kind)), "op3-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("h"))).alias("first")
    classes = stored(rows.filter("n > 0").groupBy("node").agg(
        first, F.min("k").alias("k"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")), "op3-classes")
    shingles = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    near = near_classes(base, shingle, similar, of, max(1, -(-int(shingles) // COUNT_SHINGLES)))
    clusters = components(near, "op3-near")
    drop_stored(near)
    found = stored(cluster_links(base, classes, clusters, shingle, similar, of, block_docs, block_shingles), "op3-links")
    linked = components(found, "op3-found")
    n_links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    grouped = classes.join(linked, "node", "left").join(n_links, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"), "first",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    tops = grouped.groupBy(F.col("component").alias("top")).agg(F.min("first").alias("top_first"))
    per_node = stored(grouped.join(tops, F.col("component") == F.col("top")).select(
        "node", "n_links", "top_first"), "op3-result")
    kept = F.col("doc_id").eqNullSafe(F.col("top_first.doc_id")) & (F.col("h") == F.col("top_first.h"))
    some = rows.filter("n > 0").join(per_node, "node").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("top_first.doc_id").alias("component_id"),
        F.col("n_links").cast("long").alias("n_links"), "k", "h", kept.alias("kept"))
    none = rows.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.lit(0).cast("long").alias("n_links"), "k", "h", F.lit(True).alias("kept"))
    return some.unionByName(none)


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                  similar: int = 80, of: int = 100) -> DataFrame:
    """The rows of ``docs`` of which one of each component stays: those that
    :func:`jaccard_components` keeps, one of rows repeated in full."""
    found = jaccard_components(docs, id_col, text_col, shingle, similar, of)
    return pick_rows(docs, found.filter("kept").select("k", "h", F.lit(1).alias("copies")).distinct(), id_col)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0
), s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS x FROM starts),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 90 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r) AS component_id,
       (SELECT count(*) FROM links WHERE links.a = d.doc_id) AS n_links
FROM d LEFT JOIN n USING (doc_id) JOIN reach USING (doc_id) GROUP BY d.doc_id, n.n
"""
