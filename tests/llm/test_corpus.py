"""N-gram join, substring dedup, suffix tree and the pipeline against brute force."""

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from grimlake.llm import exact_dedup, ngram_join, substring_dedup, suffix_tree
from tests.llm import odd


def sets_of(rows, shingle):
    out = []
    for _, t, _ in rows:
        w = odd.WORD.findall((t or "").translate(odd.LOWER))
        n = min(shingle, len(w))
        out.append(frozenset(tuple(w[a:a + n]) for a in range(len(w) - n + 1)) if w else frozenset())
    return out


def brute_links(sets, similar):
    links = {i: set() for i in range(len(sets))}
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= similar * len(a | b):
                links[i].add(j)
                links[j].add(i)
    return links


def reach(links):
    top = {}
    for i in links:
        if i not in top:
            todo, seen = [i], {i}
            while todo:
                for j in links[todo.pop()] - seen:
                    seen.add(j)
                    todo.append(j)
            top |= dict.fromkeys(seen, frozenset(seen))
    return top


def near_copies(seed, n, words):
    r = random.Random(seed)
    base = [r.choice("abcdefghij") + str(r.randint(0, 99)) for _ in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(r.randint(0, 2)):
            w[r.randrange(words)] = f"z{r.randint(0, 9)}"
        out.append((1000 * seed + i, " ".join(w), "n"))
    return out


@pytest.mark.parametrize("shingle,similar,block", [(3, 90, 4096), (5, 80, 4)])
def test_join(spark, shingle, similar, block):
    rows = odd.texts() + near_copies(2, 15, 90) + near_copies(3, 12, 60)
    got = ngram_join.jaccard_components(odd.frame(spark, rows), shingle=shingle, similar=similar, block_docs=block).collect()
    sets = sets_of(rows, shingle)
    links = brute_links(sets, similar)
    top = reach(links)
    want = Counter()
    for i, (doc, _, _) in enumerate(rows):
        least = min((rows[j][0] for j in top[i] if rows[j][0] is not None), default=None)
        want[doc, len(sets[i]), least, len(links[i])] += 1
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got) == want
    docs = odd.frame(spark, rows)
    stay = ngram_join.one_per_group(docs, shingle=shingle, similar=similar)
    # texts without shingles are groups of their own; rows repeated in full are one
    groups = {top[i] for i in range(len(rows)) if sets[i]}
    lone = {(rows[i][0], rows[i][1] or "") for i in range(len(rows)) if not sets[i]}
    assert stay.columns == docs.columns and stay.count() == len(groups) + len(lone)


@pytest.mark.parametrize("parts,bits", [(1, 48), (7, 48), (3, 34)])
def test_rare_shared_shingles_lose_no_pair(monkeypatch, parts, bits):
    monkeypatch.setattr(ngram_join, "KEY_BITS", bits)
    r = np.random.default_rng(5)
    passage = r.integers(0, 2**64, 150, dtype=np.uint64)  # in many sets
    for similar in (90, 80):
        sets = []
        for trial in range(40):
            n = int(r.integers(1, [12, 40, 200][trial % 3]))
            base = np.r_[r.integers(0, 2**64, n, dtype=np.uint64), passage[:n % 60]]
            for _ in range(4):
                k = int(r.integers(0, n // 5 + 2))
                a = np.r_[np.delete(base, r.permutation(n)[:k]), r.integers(0, 2**64, k, dtype=np.uint64)]
                sets.append(np.unique(a))
        plain = [set(s.tolist()) for s in sets]
        true = {(i, j) for i in range(len(sets)) for j in range(i)
                if 100 * len(plain[i] & plain[j]) >= similar * len(plain[i] | plain[j])}
        # chunks of 30 sets, one of them twice
        sent = pd.concat([ngram_join.chunk_parts(sets[a:a + 30], parts) for a in [*range(0, len(sets), 30), 0]])
        counted = pd.concat([ngram_join.often(x) for _, x in sent.groupby("part")])
        have, name_of = defaultdict(set), ngram_join.set_names(sets).tolist()
        for _, x in counted.groupby("chunk"):
            names, who, keys = ngram_join.rare_shared(x, similar, 100)
            for w, k in zip(names[who].tolist(), keys.tolist()):
                have[w].add(k)
        assert all(have[name_of[i]] & have[name_of[j]] for i, j in true if plain[i] != plain[j])
        # what a passage shares with others alone is no reason to compare
        assert sum(map(len, have.values())) < 0.5 * sum(map(len, sets))
        with pytest.raises(RuntimeError):
            ngram_join.rare_shared(counted[counted["chunk"] == counted["chunk"].iloc[0]].iloc[1:], similar, 100)
        found = {(i, j) for i, js in ngram_join.search(sets, sets, True, similar, 100) for j in js.tolist() if j < i}
        assert found == true


@pytest.mark.parametrize("cost", [0, 10**9])
def test_probing_and_merging_agree(monkeypatch, cost):
    monkeypatch.setattr(ngram_join, "PROBE_COST", cost)
    r = np.random.default_rng(6)
    base = np.unique(r.integers(0, 2**63, 120).astype(np.uint64))
    sets = [np.unique(np.r_[np.delete(base, r.permutation(len(base))[:k % 9]), r.integers(0, 2**63, k % 7).astype(np.uint64)])
            for k in range(60)]
    plain = [set(s.tolist()) for s in sets]
    true = {(i, 30 + j) for i in range(30) for j in range(30)
            if 10 * len(plain[i] & plain[30 + j]) >= 9 * len(plain[i] | plain[30 + j])}
    assert {(i, 30 + j) for i, js in ngram_join.search(sets[:30], sets[30:], False, 90, 100) for j in js.tolist()} == true


def brute_cut(rows, window=13):
    order = [2**63 - 1 if i is None else i for i, _, _ in rows]
    words = [odd.WORD.findall(t or "") for _, t, _ in rows]
    least = {}
    for o, w in zip(order, words):
        for a in range(len(w) - window + 1):
            x = tuple(w[a:a + window])
            least[x] = min(o, least.get(x, o))
    out = Counter()
    for (i, _, _), o, w in zip(rows, order, words):
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if least[tuple(w[a:a + window])] < o:
                gone[a:a + window] = [True] * window
        out[i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)] += 1
    return out


@pytest.mark.parametrize("chars", [10**9, 3000])
def test_repeats_are_cut(spark, chars):
    rows = odd.texts() + near_copies(4, 6, 80)
    got = substring_dedup.remove_repeats(odd.frame(spark, rows), shard_chars=chars).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == brute_cut(rows)


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def test_base_scores(spark):
    rows = odd.texts()
    got = suffix_tree.score(odd.frame(spark, rows), shard_chars=20_000).collect()
    tokens = [odd.WORD.findall((t or "").translate(odd.LOWER)) + [" "] for _, t, _ in rows]
    count = Counter()
    for (i, _, _), w in zip(rows, tokens):
        if not held(i):
            count.update(w)
    n, v = sum(count.values()), len(count)
    want = Counter((i, held(i), len(w), sum(count[x] > 0 for x in w), n,
                    round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 5))
                   for (i, _, _), w in zip(rows, tokens))
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5))
                   for r in got) == want
    assert all(r.score < 0 for r in got)
    assert suffix_tree.score(odd.empty(spark)).count() == 0


def gram_rows(texts, depth, least):
    key, n = np.unique(suffix_tree.grams(suffix_tree.symbols(texts, depth)[0], depth), return_counts=True)
    out = []
    for d in range(depth + 1):
        part = pd.DataFrame({"context": (key >> 9) & ((1 << 9 * d) - 1), "symbol": key & 511, "n": n})
        part = part.groupby(["context", "symbol"]).n.sum().reset_index()
        part = part[(part.groupby("context").n.transform("sum") >= least) | (d == 0)]
        part.insert(0, "depth", d)
        out.append(part)
    return pd.concat(out)


def test_tree_scores_by_longest_suffix():
    r = random.Random(7)
    texts = [" ".join(r.choice(["the", "then", "other", "Thing", "été"]) for _ in range(80)) for _ in range(40)]
    depth, rows = 3, gram_rows(texts, 3, 12)
    tree = suffix_tree.Tree(rows, depth, gain_share=0, divergence=0.01, weight=1.5, cost=0.0)
    counts = defaultdict(dict)
    for x in rows.itertuples():
        counts[x.depth, x.context][x.symbol] = x.n
    up = lambda d, c: (d - 1, c & ((1 << 9 * (d - 1)) - 1))
    smooth, keep = {}, {(0, 0)}
    for d, c in sorted(counts):
        n = np.zeros(257)
        n[list(counts[d, c])] = list(counts[d, c].values())
        if not d:
            smooth[d, c] = (n + 1) / (n.sum() + 257)
            continue
        base, kinds = smooth[up(d, c)], (n > 0).sum()
        smooth[d, c] = (n + 1.5 * kinds * base) / (n.sum() + 1.5 * kinds)
        gain = (n[n > 0] * np.log(smooth[d, c][n > 0] / base[n > 0])).sum()
        if gain >= max(suffix_tree.LEAST_GAIN, 0.01 * n.sum()):
            while d:
                keep.add((d, c))
                d, c = up(d, c)
    assert tree.retained == len(keep) > 20
    texts = texts[:3] + ["", "A b", "unseen wörds" * 300]
    for text, got in zip(texts, tree.score(texts)):
        s, total = suffix_tree.symbols([text], depth)[0], 0.0
        for i in range(depth, len(s)):
            for d in range(depth, -1, -1):
                c = 0
                for q in s[i - d:i]:
                    c = c << 9 | int(q)
                if (d, c) in keep:
                    break
            total += np.log10(smooth[d, c][s[i]])
        assert got == pytest.approx(total, rel=1e-4)
    assert (10.0 ** tree.logp.astype(float)).sum(1) == pytest.approx(1, abs=1e-5)


def test_tree_comes_near_the_source_on_held_out_text(spark):
    """Words are 2 to 5 of 8 stems: held-out texts score close to the log
    probability that the generator itself gives them."""
    r = random.Random(8)
    stems = ["wal", "spr", "stra", "kin", "gar", "ten", "lum", "bor"]
    rows, truth = [], {}
    for i in range(600):
        parts = [[r.choice(stems) for _ in range(r.randint(2, 5))] for _ in range(120)]
        truth[i] = sum(math.log10(1 / 4) + len(p) * math.log10(1 / 8) for p in parts)
        rows.append((i, " ".join("".join(p) for p in parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [x for x in suffix_tree.score(docs).collect() if x.held_out]
    # five symbols see two stems at most, not how many a word has: some percent are lost
    assert sum(x.score for x in got) > 1.06 * sum(truth[x.doc_id] for x in got)


def test_rare_contexts_are_kept_in_large_corpora(spark):
    """A word that occurs 20 times is learnt among 9 million other positions."""
    ids = [i for i in range(200) if not held(i)]
    rare = next(i for i in range(200) if held(i))
    rows = [(i, "ab " * 60_000) for i in ids[:50]] + [(i, "qzxv") for i in ids[50:70]] + [(rare, "qzxv")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    score = {x.doc_id: x.score for x in suffix_tree.score(docs).collect()}
    # "q" opens a text 20 times in 70; after it each symbol is as good as certain
    assert score[rare] > -1.5


def test_texts_are_read_twice_and_words_go_packed(spark):
    """Once to be counted, before, and once to be scored; no row for each word."""
    plan = suffix_tree.score(odd.frame(spark, odd.texts()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapCoGroupsInPandas") == 2 and "FlatMapGroupsInPandas" not in plan and "Window" not in plan


@pytest.mark.parametrize("texts", [[""], ["", "A a\t\nA", "  ", "é É ü\x85x", "\x00 \x00", "x" * 99, "ab ba aab"],
                                   ["".join(map(chr, range(32, 0x2fff))) * 20]])
def test_grams_and_words_are_numbered_alike(texts):
    """As one number where that fits into 64 bits, and apart; a word has one hash wherever it stands."""
    for some in (texts, texts[::-1]):
        sym, _ = suffix_tree.symbols(some, 5)
        keys, at = np.unique(suffix_tree.grams(sym, 5), return_inverse=True)
        got = suffix_tree.numbered_grams(sym, 5)
        assert (got[0] == keys).all() and (got[1] == at).all()
        words = [odd.WORD.findall(t.translate(odd.LOWER)) + [" "] for t in some]
        hashes, n = suffix_tree.word_hashes(sym, 5)
        assert n.tolist() == [len(w) for w in words]
        seen = dict(zip([x for w in words for x in w], hashes.tolist(), strict=True))
        assert [seen[x] for w in words for x in w] == hashes.tolist() and len(set(seen.values())) == len(seen)
        if some is texts:
            before = seen
    assert seen == before


def test_scores_of_the_tables_are_those_of_the_tree(spark, monkeypatch):
    """Equal to the tree in one process, which scoring must not build."""
    rows = odd.texts()
    learnt = [t or "" for i, t, _ in rows if not held(i)]
    tree = suffix_tree.Tree(gram_rows(learnt, 5, suffix_tree.LEAST_COUNT), 5)
    assert tree.retained > 50
    want = Counter((i, round(float(x), 2)) for (i, _, _), x in zip(rows, tree.score([t or "" for _, t, _ in rows])))
    monkeypatch.setattr(suffix_tree, "Tree", None)
    monkeypatch.setattr(suffix_tree, "BATCH_SYMBOLS", 3000)
    monkeypatch.setattr(suffix_tree, "SHARDS_PER_PART", 1)
    got = suffix_tree.score(odd.frame(spark, rows), shard_chars=20_000).collect()
    near = lambda c: sorted(c.elements(), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    for (i, a), (j, b) in zip(near(Counter((r.doc_id, round(r.score, 2)) for r in got)), near(want), strict=True):
        assert i == j and a == pytest.approx(b, rel=1e-3)


def peak_of(run):
    """Its result, and the most bytes it held at once."""
    tracemalloc.start()
    out = run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, peak


def test_shingles_are_counted_in_little_memory():
    """Packed, and counted, in a few times the bytes of the shingles; every
    shingle that occurs more than once comes back with its sets and its count."""
    r = np.random.default_rng(5)
    chunks = [[np.unique(r.integers(0, 2**64, 1000, dtype=np.uint64)) for _ in range(200)] for _ in range(3)]
    for c in chunks[1:]:
        c[0] = np.unique(np.r_[c[0], chunks[0][0][:40]])
    bytes_of = [8 * sum(map(len, c)) for c in chunks]
    sent = []
    for c, size in zip(chunks, bytes_of):
        out, peak = peak_of(lambda: ngram_join.chunk_parts(c, 3))
        assert peak < 5 * size
        sent.append(out)
    want = Counter(int(x) >> 64 - ngram_join.KEY_BITS for c in chunks for s in c for x in s)
    found = Counter()
    for _, frame in pd.concat(sent).groupby("part"):
        out, peak = peak_of(lambda: ngram_join.often(frame))
        assert peak < 4 * sum(bytes_of) / 3
        for keys, n in zip(out["keys"], out["n"]):
            for k, times in zip(ngram_join.from_planes(keys, np.uint64).tolist(), ngram_join.from_planes(n, np.int64).tolist()):
                assert times == want[k]
                found[k] += 1
    assert found == Counter({k: n for k, n in want.items() if n > 1}) and len(found) == 40


def test_pipeline_stages(spark, tmp_path):
    r = random.Random(9)
    rows = odd.texts() + near_copies(5, 8, 90)
    labels = []
    for i in range(2000, 2200):
        bad = i % 4 == 0
        w = [r.choice("abcdefghijk") * 2 + str(r.randint(0, 30)) for _ in range(30)] + (["scum", "idiot"] if bad else [])
        rows.append((i, " ".join(w), r.choice(["a", "b"])))
        labels.append((i, 1, int(bad)))
    docs = odd.frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = [(x.doc_id, x.text, x.source) for x in now.collect()]
    left = seen["toxicity"]
    assert {i for i, _, _ in left if 2000 <= (i or 0) < 2200} == {i for i in range(2000, 2200) if i % 4}
    assert Counter(x for x in left if not 2000 <= (x[0] or 0) < 2200) == Counter(x for x in rows if not 2000 <= (x[0] or 0) < 2200)
    norm = lambda t: odd.SPACE.sub(" ", t or "")
    texts = {norm(t) for _, t, _ in left}
    assert sorted(norm(t) for _, t, _ in seen["exact_dedup"]) == sorted(texts)
    sets = sets_of(seen["exact_dedup"], 5)
    top = reach(brute_links(sets, 80))
    want = Counter()
    for i, group in top.items():
        if i == min(group, key=lambda j: (seen["exact_dedup"][j][0] is None, seen["exact_dedup"][j][0] or 0)):
            want[seen["exact_dedup"][i][1]] += 1
    assert Counter(t for _, t, _ in seen["ngram_join"]) == want
    mixed = Counter(seen["mixing"])
    assert set(mixed) <= set(seen["ngram_join"]) and max(mixed.values()) <= 3
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(x.doc_id for x in got) == Counter(i for i, _, _ in seen["mixing"])
    assert corpus_pipeline.STAGES[-1][1](spark, now.limit(0), str(tmp_path)).count() == 0
    none = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0


def test_exact_dedup_counts_null_as_empty(spark):
    got = exact_dedup.exact_dedup(spark.createDataFrame([(5, None), (3, "")], "doc_id long, text string")).collect()
    assert {(x.doc_id, x.keep_id, x.kept) for x in got} == {(5, 3, False), (3, 3, True)}
