"""Exact dedup, mixing and fingerprints against brute force."""

import hashlib
from collections import Counter, defaultdict

import pytest

from grimlake.llm import exact_dedup, fingerprints, mixing
from tests.llm import odd


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.mark.parametrize("key_bits", [64, 3])
def test_exact_dedup(spark, key_bits):
    rows = odd.texts()
    got = exact_dedup.exact_dedup(odd.frame(spark, rows), key_bits=key_bits, bucket_bytes=500, max_depth=6).collect()
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[odd.SPACE.sub(" ", t or "")].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids), sha(t)] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter({sha(t): 1 for t in groups})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_directory_doubles_only_where_full(spark):
    entries = spark.range(4096).selectExpr("xxhash64(id) AS key", "100L AS bytes")
    slots = exact_dedup.directory(entries, 10_000, 12).collect()
    assert all(r.held <= 10_000 for r in slots) and sum(r.texts for r in slots) == 4096
    assert sum(2.0 ** -r.depth for r in slots) == pytest.approx(1)  # the buckets share out the key space


def test_index_is_stored_by_owner(spark):
    docs = odd.frame(spark, odd.texts())
    entries = exact_dedup.chained(docs, "text", 4)
    index = exact_dedup.build_index(entries, 500, 4, 4)
    rows = index.collect()
    assert len(rows) == entries.count() and max(r.chain for r in rows) >= 1  # collisions are chained
    assert Counter((r.key, r.chain) for r in rows).most_common(1)[0][1] == 1


def test_keep_first_returns_whole_rows(spark):
    docs = odd.frame(spark, odd.texts())
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({odd.SPACE.sub(" ", t or "") for _, t, _ in odd.texts()})


def targets(sizes, passes=3):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), set(order)
    while True:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > passes * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = float(passes * sizes[s])
        left -= sum(target[s] for s in over)
        open_ -= over


@pytest.mark.parametrize("block_words", [2048, 40])
def test_mix(spark, block_words):
    rows = odd.texts()
    docs = odd.frame(spark, rows)
    got = mixing.mix(docs, block_words=block_words).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(odd.WORD.findall(t or ""))
    want = targets(sizes)
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    again = mixing.mix(docs.repartition(5), block_words=block_words).collect()
    assert Counter(got) == Counter(again)


def test_schedule_is_spread(spark):
    """Every stretch of the schedule has each source close to its share."""
    docs = spark.createDataFrame([(i, "w " * 100, "s%d" % (i % 5)) for i in range(200)], "doc_id long, text string, source string")
    rows = mixing.sized_rows(docs, "doc_id", "text", "source", 0)
    sources = mixing.source_targets(rows, 50)
    slots = sorted(mixing.schedule(sources).collect())
    n = len(slots)
    assert [r.slot for r in slots] == list(range(n)) and n & (n - 1) == 0
    share = {r.source: r.slots / n for r in sources.collect()}
    for m in (n // 8, n // 4, n // 2, n - 1):
        seen = Counter(r.source for r in slots[:m])
        assert all(abs(seen[s] - share[s] * m) <= 12 for s in share)
    for s in share:
        own = [r for r in slots if r.source == s]
        assert [r.block for r in own] == list(range(len(own)))
        assert all(a.hi == b.lo for a, b in zip(own, own[1:]))


def test_mixed_repeats_rows(spark):
    docs = odd.frame(spark, odd.texts())
    out = mixing.mixed(docs, block_words=40)
    taken = sum(-(-r.taken // r.size) for r in mixing.mix(docs, block_words=40).collect() if r.size)
    assert out.columns == docs.columns and out.count() == taken


def test_fingerprints(spark):
    rows = [x for x in odd.texts() if x[0] is not None]
    docs = odd.frame(spark, rows)
    got = fingerprints.edited_fingerprints(docs).collect()
    distinct = {(i, t or "") for i, t, _ in rows}
    assert len(got) == len(rows)
    ids = Counter(i for i, _ in distinct)
    order = sorted((x for x in distinct if ids[x[0]] == 1), reverse=True)  # ids with one text
    full = sorted(distinct, key=lambda x: -x[0])
    by_id = {r.doc_id: r for r in got}
    for (i, t), (j, u) in zip(full, full[1:] + full[:1]):
        if (i, t) in order and (j, u) in order:
            k = len(t) // 3
            assert by_id[i].edited_sha256 == sha(t[:len(t) - k] + u[:k]) and by_id[i].n_chars == len(t)
            same = sum(by_id[i].fingerprint[4 * x:4 * x + 4] == by_id[j].fingerprint[4 * x:4 * x + 4]
                       for x in range(fingerprints.SAMPLES))
            assert by_id[i].near_next == same / fingerprints.SAMPLES
    prints = defaultdict(set)
    for r in got:
        if ids[r.doc_id] == 1:
            prints[next(t for i, t in distinct if i == r.doc_id)].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_likeness_is_generalised_jaccard(spark):
    """With many samples the share of equal ones comes near min / max of the counts."""
    a = ["u"] * 9 + ["v"] * 3 + ["w"] * 2 + ["x"] + list("abcdefgh")
    b = ["u"] * 3 + ["v"] * 6 + ["y"] * 2 + ["x"] + list("abcdpqrs")
    ca, cb = Counter(a), Counter(b)
    want = sum((ca & cb).values()) / sum((ca | cb).values())
    docs = spark.createDataFrame([(0, " ".join(a)), (1, " ".join(b))], "doc_id long, text string")
    f = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(docs, ["doc_id"], "text", 200).collect()}
    same = sum(f[0][4 * x:4 * x + 4] == f[1][4 * x:4 * x + 4] for x in range(200)) / 200
    assert abs(same - want) < 0.13


def test_nulls_and_empty_tables(spark):
    none = odd.empty(spark)
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.keep_first(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert fingerprints.edited_fingerprints(none).count() == 0
    blank = odd.frame(spark, [(None, None, None), (1, "", "a")])
    assert {r.taken for r in mixing.mix(blank).collect()} == {0}
    got = fingerprints.edited_fingerprints(odd.frame(spark, odd.texts())).collect()
    assert len(got) == len(odd.texts())
