"""Ids and rows stay what they are: ids over 2^53 beside null ids, and rows that
differ only in a column that no operator reads."""

import pytest

import corpus_pipeline as P
from grimlake.llm import (byte_tokens, exact_dedup, fingerprints, html_text, mixing, ngram_join, pii, piece_tokens,
                          substring_dedup, suffix_tree, toxicity)
from grimlake.llm.queries import piece_model
from tests.llm import odd

BIG = 9007199254740993
ROWS = [(BIG, "one text with some words", "a"), (None, "another text of some words", "a"), (BIG + 2, None, "b"),
        (7, "a third text", "b"), (-BIG, "the last one of all", None)]


def labels(spark):
    return spark.createDataFrame([(BIG, 1, 0), (7, 0, 1)], "doc_id long, quality int, toxic int")


def ranks():
    import public_tokenizers
    return "file://" + public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


OPERATORS = {
    "piece_tokens": lambda s, d: piece_tokens.encode_documents(d, piece_model()),
    "pii": lambda s, d: pii.find(d, steps=2),
    "ngram_join": lambda s, d: ngram_join.jaccard_components(d),
    "substring_dedup": lambda s, d: substring_dedup.remove_repeats(d),
    "toxicity": lambda s, d: toxicity.detect(d, labels(s)),
    "suffix_tree": lambda s, d: suffix_tree.score(d),
    "mixing": lambda s, d: mixing.mix(d),
    "fingerprints": lambda s, d: fingerprints.edited_fingerprints(d),
    "exact_dedup": lambda s, d: exact_dedup.exact_dedup(d),
    "byte_tokens": lambda s, d: byte_tokens.encode_documents(d, *ranks()),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_large_ids_beside_null(spark, name):
    out = OPERATORS[name](spark, odd.frame(spark, ROWS, parts=1))
    assert out.schema["doc_id"].dataType.simpleString() == "bigint"
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(i) for i, _, _ in ROWS)


def test_large_page_ids_beside_null(spark):
    rows = [(BIG, "u", "<p>x</p>"), (None, None, None), (3, "v", "")]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(1)).collect()
    assert sorted((str(r.page_id), str(r.url)) for r in out) == sorted((str(i), str(u)) for i, u, _ in rows)


def test_rows_that_differ_in_source_only_keep_it(spark):
    text = "a text of six words here"
    rows = [(1, text, "A"), (1, text, "B"), (2, "other words of another document entirely", "A"), (2, None, "B")]
    docs = odd.frame(spark, rows)
    got = sorted((r.doc_id, r.source) for r in mixing.mixed(docs).collect())
    taken = {(r.doc_id, r.source): -(-r.taken // r["size"]) for r in mixing.mix(docs).collect() if r.taken}
    assert {x: got.count(x) for x in got} == taken and {(1, "A"), (1, "B")} <= set(got)
    for one in (exact_dedup.keep_first, ngram_join.one_per_group, lambda d: P.drop_copies(spark, d, "")):
        assert sum(r.doc_id == 1 for r in one(docs).collect()) == 1
