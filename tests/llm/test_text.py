"""SentencePiece, HTML, PII and toxicity: library, rules and held-out checks."""

import random

import numpy as np
import pytest

from grimlake.llm import html_text, pii, piece_tokens, toxicity
from grimlake.llm.queries import piece_model
from tests.llm import odd


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=piece_model().removeprefix("file://"))


def test_pieces_as_the_library(spark, library):
    rows = odd.texts()
    got = piece_tokens.encode_documents(odd.frame(spark, rows), piece_model()).collect()
    want = [(i, library.encode(t or "")) for i, t, _ in rows]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, list(r.ids)) for r in got), key=key) == sorted(want, key=key)
    assert all(r.decoded == library.decode(list(r.ids)) for r in got)
    assert piece_tokens.digests(piece_tokens.encode_documents(odd.empty(spark), piece_model())).count() == 0


def test_pieces_fuzz(library):
    r = random.Random(2)
    enc = piece_tokens.Encoder(open(piece_model().removeprefix("file://"), "rb").read())
    texts = ["", " ", "   ", "\n", "a" * 500, " " * 77 + "x", "▁▁ x"]
    texts += ["".join(r.choice("abcdetho niréü▁ \n\t漢字😀0123.,-\x00") for _ in range(r.randint(1, 60))) for _ in range(600)]
    texts += ["".join(r.choice(" ab") for _ in range(r.randint(1, 80))) for _ in range(100)]
    ids, n = enc.encode(texts)
    for t, out, text in zip(texts, np.split(ids, np.cumsum(n)[:-1]), enc.model.decode(ids, n)):
        assert out.tolist() == library.encode(t) and text == library.decode(out.tolist())
    for _ in range(300):
        seq = [r.choice([r.randint(0, 31999), r.randint(3, 258), 259, 28705]) for _ in range(r.randint(0, 6))]
        assert enc.model.decode(np.array(seq, np.int64), np.array([len(seq)])) == [library.decode(seq)]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class=top><a href=/>Home</a></header><nav><ul><li><a href=1>One</a></li></ul></nav><div class="cookie-notice">We use
cookies.</div><article><h1>Title &amp; more</h1><p><b>First  part.<br>Second<p>Third&nbsp;x</p><div class=ad>Buy!</div>
<section id=comments><p>I was the first of them to say it.</p></section></article><aside>Side</aside><form>Name<input></form>
<footer>&copy; x</footer></body></html>"""


def test_article_without_the_rest():
    assert html_text.main_text(PAGE) == "Title & more First part. Second Third x"


def test_pages_without_an_article():
    story = ("It was the best of times and it was the worst of times, for all that they had to see in the days of that "
             "year, and there were many of them to be had by all who were not there to see it with their own eyes.")
    page = (f"<div id=menu><a href=1>One</a> <a href=2>Two</a></div><div class=content><h2>A heading</h2><p>{story}</p>"
            f"<p>Short.</p><p>{story}</p></div><div><a href=3>Some other page of this site</a></div><footer>End</footer>")
    assert html_text.main_text(page) == f"A heading {story} Short. {story}"
    assert html_text.main_text("") == "" and html_text.main_text("<p>") == "" and html_text.main_text("</div></p><ul>") == ""


def test_article_is_a_prior_only():
    story = ("It was the best of times and it was the worst of times, for all that they had to see in the days of that "
             "year, and there were many of them to be had by all who were not there to see it with their own eyes.")
    page = f"<div><p>{story}</p><p>{story}</p></div><article><p>A teaser card.</p></article><div>Short words</div>"
    assert html_text.main_text(page) == f"{story} {story} A teaser card."
    links = "<p><a href=1>One thing here</a> <a href=2>Another thing there</a></p>"
    assert html_text.main_text(f"<main><p>{story}</p>{links}<p>End.</p></main>") == f"{story} End."


def test_head_without_end_and_named_wrappers():
    head = "<html><head><meta charset=utf-8><title>T</title><script>x</script>"
    for start in ("<body>", "", "<div>", "<hr>"):
        assert html_text.main_text(f"{head}{start}<article><p>The story.</p></article></html>") == "The story."
    for wrapper in ('class="content has-sidebar"', 'id=page class="header-fixed"'):
        page = f"<body><div {wrapper}><p>Menu</p><article><p>The story.</p><div class=ad>Buy</div></article></div></body>"
        assert html_text.main_text(page) == "The story."
    # inside the article, or in an element that is no text, an article stays out
    assert html_text.main_text("<article><p>A b.</p><div class=related><article>Other</article></div></article>") == "A b."
    assert html_text.main_text("<main><p>A b.</p></main><aside><article>Other</article></aside>") == "A b."


def test_pages_odd_rows(spark):
    rows = [(1, "u", PAGE), (1, None, None), (None, "v", ""), (2, "w", "<article>" + "<p>a b</p>" * 20000 + "</article>")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in html_text.extract(pages).collect()}
    assert got[1, None] == ("", 0) and got[None, "v"] == ("", 0) and got[2, "w"][1] == 20000 * 4 - 1
    assert html_text.extract(pages.limit(0)).count() == 0


def test_base_spans():
    text = "a.b@c.de x@y 1.2.3.4 1.2.3.256 4539 1488 0343 6467 4539148803436468 +1 (212) 555-0199 +12 é"
    found = [(pii.KINDS[k], text[a:b]) for k, a, b in pii.base_spans(text)]
    assert found == [("email", "a.b@c.de"), ("ip", "1.2.3.4"), ("phone", "+1 (212) 555-0199 +12"[:17])] or (
        found[0] == ("email", "a.b@c.de") and found[1] == ("ip", "1.2.3.4"))


def test_base_spans_brute_force():
    import re
    r = random.Random(3)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card = re.compile(r"[0-9]([\x20-]?[0-9])+")
    phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    for _ in range(3000):
        t = "".join(r.choice("ab1234567890.@+-() é\n") for _ in range(r.randint(0, 70)))
        want = [(0, m.start(), m.end()) for m in email.finditer(t)]
        want += [(1, m.start(), m.end()) for m in ip.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
        want += [(2, m.start(), m.end()) for m in card.finditer(t)
                 if 16 <= len(pii.digits(m[0])) <= 19 and pii.luhn(pii.digits(m[0]))]
        want += [(3, m.start(), m.end()) for m in phone.finditer(t) if 8 <= len(pii.digits(m[0])) <= 15]
        assert pii.base_spans(t) == want
    pii.base_spans("1" * 200_000 + "a" * 200_000 + "@" * 1000)  # linear in runs


def test_tagger_gradients():
    tagger = pii.Tagger(1)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    r = np.random.default_rng(0)
    ids, tags = r.integers(0, pii.SYMBOLS, (6, 3)), r.integers(0, pii.TAGS, (6, 3))
    _, grads = tagger.gradients(ids, tags)
    for name, grad in grads.items():
        at = (int(ids[0, 0]), 2) if name == "embed" else tuple(r.integers(0, s) for s in grad.shape)
        was = tagger.p[name][at]
        tagger.p[name][at] = was + 1e-4
        up = tagger.gradients(ids, tags)[0]
        tagger.p[name][at] = was - 1e-4
        down = tagger.gradients(ids, tags)[0]
        tagger.p[name][at] = was
        assert (up - down) / 2e-4 == pytest.approx(grad[at], rel=0.05, abs=2e-3)


def test_reconcile_takes_the_best_set():
    found = {(0, 0, 10): 3.0, (1, 8, 12): 2.0, (2, 10, 20): 2.5, (3, 5, 15): 5.0, (0, 30, 31): -1.0}
    assert pii.reconcile(found) == [(0, 0, 10), (2, 10, 20)]


class Whole:
    """A tagger that calls each run of small letters, dots and brackets an email."""

    def decode(self, ids):
        mine = (ids > 65) & (ids < 92) | (ids == 9) | (ids == 10) | (ids == 15)
        first = mine & ~np.vstack([np.zeros((1, ids.shape[1]), bool), mine[:-1]])
        return np.where(first, 1, np.where(mine, 2, 0)), np.ones(ids.shape)


@pytest.mark.parametrize("size", [40, 48, 70, 94, 120, 150])
def test_long_spans_are_found_at_every_offset(size):
    for left in (9, size // 2, size - 20):
        span = "a" * left + "(at)" + "b" * (size - left - 12) + "(dot)com"
        texts = ["X " * 100 + "X" * (k % 2) + " " * (k // 2) + " " + span + " " + "X " * 100 for k in range(96)]
        for text, (base, added) in zip(texts, pii.all_spans(texts, Whole())):
            at = text.index(span)
            assert base == [] and added == [(0, at, at + len(span))]


def test_accepted_forms():
    for kind, left, span, right in (
            (3, '"phone": "', "555-123-4567", '"'), (3, "tel=", "555-123-4567", ""), (3, "", "555-123-4567", "/555-123-4568"),
            (0, '"', "john (at) example.com", '"'), (3, "call ", "06 12 34 56 78", "."), (3, "", "030 12345678", "")):
        text, a = left + span + right, len(left)
        assert pii.accepted(kind, text, a, a + len(span)) == (kind, a, a + len(span))
    for kind, text in ((3, "2024-01-15 10"), (3, "x555-123-4567"), (3, "12 34"), (2, "1234 5678 9012 3456")):
        assert pii.accepted(kind, text, 0, len(text)) is None


def test_pii_adds_spans_on_held_out_text(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("aeioulmnrst") for _ in range(r.randint(2, 7)))
    line = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, f"{line(30)} {word()}@mail{i}.example.com {line(9)} +1 (212) 555-{1000 + i} {line(20)}", "a") for i in range(60)]
    rows += [(1000, f"{line(12)} call (212) 555-0199 {line(9)} jane.doe (at) mail7.example.org {line(12)}", "a"),
             (1001, line(300), "a"), (1002, None, "a"), (None, "x@y.de", "a"), (1003, f'{line(9)} token = "{"9af3" * 10}" {line(9)}', "a")]
    got = {x.doc_id: x for x in pii.find(odd.frame(spark, rows), steps=400).collect()}
    assert len(got) == len(rows)
    text = rows[60][1]
    a, b = text.index("(212)"), text.index("jane")
    assert f"phone:{a}:{a + 14}" in got[1000].spans and f"email:{b}:{b + 31}" in got[1000].spans
    assert got[1000].n_phone == got[1000].n_email == 0 and got[1000].base == ""
    assert got[1001].spans == got[1002].spans == got[1003].spans == "" and got[None].spans == "email:0:6"
    assert all(x.base in x.spans or x.n_added for x in got.values())


class Edges(pii.Tagger):
    """Marks spans at one edge or both of every window, or all of it."""

    def __init__(self, how):
        self.how, self.rounds = how, 0

    def decode(self, ids):
        self.rounds += 1
        assert self.rounds < 200
        tags, steps = np.zeros(ids.shape, np.int64), len(ids)
        n = 5 if self.how == "edges" else steps
        if self.how != "right":
            tags[:n], tags[0] = 8, 7
        if self.how in ("right", "edges"):
            tags[-n if n < steps else steps // 2:], tags[-n if n < steps else steps // 2] = 8, 7
        return tags, np.ones(ids.shape, np.float32)


@pytest.mark.parametrize("how", ["edges", "right", "all"])
def test_pii_windows_only_grow(how):
    r = random.Random(1)
    texts = ["".join(r.choice("12 (a") for _ in range(n)) for n in (0, 1, 95, 97, 600, 3000, 9000)]
    found = pii.all_spans(texts, Edges(how))
    assert len(found) == len(texts) and all(0 <= a < b <= len(t) for t, (x, y) in zip(texts, found) for _, a, b in x + y)


def test_pii_spans_that_windows_cut():
    """A tagger that knows one form marks what it sees of it; long spans at
    every offset come out whole."""
    address = "firstname.lastname [at] research.department [dot] university [dot] edu"

    class Knows(pii.Tagger):
        def __init__(self):
            pass

        def decode(self, ids):
            tags = np.zeros(ids.shape, np.int64)
            want = pii.symbols(address)
            for n in range(ids.shape[1]):
                row = ids[:, n]
                for at in range(-len(want) + 1, len(row)):
                    a, b = max(at, 0), min(at + len(want), len(row))
                    if b - a >= 12 and (row[a:b] == want[a - at:b - at]).all():
                        tags[a:b, n], tags[a, n] = 2, 1
            return tags, np.ones(ids.shape, np.float32)

    texts = ["x" * (k - 1) + " " + address + " " + "y" * 150 for k in range(1, 100, 7)]
    for k, (base, added) in zip(range(1, 100, 7), pii.all_spans(texts, Knows())):
        assert added == [(0, k, k + len(address))]


def test_pii_apart_and_reconcile_against_brute_force():
    r = random.Random(2)
    for _ in range(300):
        base = [(0, a, a + r.randint(1, 9)) for a in r.sample(range(60), r.randint(0, 4))]
        new = sorted({(1, a, a + r.randint(1, 9)) for a in r.sample(range(60), r.randint(0, 8))}, key=lambda x: x[1:])
        want = []
        for k, a, b in new:
            if not any(x < b and a < y for _, x, y in base + want):
                want.append((k, a, b))
        assert pii.apart(new, base) == want
        found = {(0, a, a + r.randint(1, 9)): r.randint(1, 5) for a in r.sample(range(30), r.randint(0, 7))}
        best = 0
        for mask in range(1 << len(found)):
            some = sorted([x for i, x in enumerate(found) if mask >> i & 1], key=lambda x: x[1])
            if all(x[2] <= y[1] for x, y in zip(some, some[1:])):
                best = max(best, sum(found[x] for x in some))
        assert sum(found[x] for x in pii.reconcile(found)) == best


def test_pii_of_nothing_and_repeated_rows(spark):
    assert pii.find(odd.empty(spark), steps=2).count() == 0
    rows = [(1, "a@b.de 1.2.3.4", "a")] * 3 + [(9007199254740993, "x 1 " * 3000, "a"), (None, None, "a")]
    got = pii.find(odd.frame(spark, rows), steps=2).collect()
    assert sorted((str(x.doc_id), x.n_email, x.n_ip) for x in got) == sorted(
        [("1", 1, 1)] * 3 + [("9007199254740993", 0, 0), ("None", 0, 0)])


def test_chain_on_held_out_rows(spark):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(700):
        bad = r.random() < 0.3
        words = [r.choice("abcdefghijklmnop") * 2 + str(r.randint(0, 40)) for _ in range(40)]
        if bad:
            words[r.randrange(40)] = r.choice(["idiot,", "Scum", "loser!"])
        rows.append((i, " ".join(words), "a"))
        if i < 500:
            labels.append((i, int(not bad and r.random() < 0.8), int(bad)))
    rows += [(None, None, "a"), (700, "", "a"), (701, "idiot " * 5000, "a")]
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    docs = odd.frame(spark, rows)
    got = {x.doc_id: x for x in toxicity.detect(docs, marks).collect()}
    want = {i: any(w in t for w in ("idiot", "Scum", "loser")) for i, t, _ in rows if t}
    wrong = [i for i in range(500, 700) if got[i].toxic != want[i]]
    assert len(wrong) <= 6 and got[701].toxic and not got[700].toxic and not got[None].toxic
    clean = toxicity.reject(docs, marks)
    assert clean.columns == docs.columns
    assert {x.doc_id for x in clean.collect()} == {i for i, x in got.items() if not x.toxic}
    nothing = toxicity.detect(docs, marks.limit(0)).collect()
    assert len(nothing) == len(rows) and not any(x.toxic for x in nothing)
    assert toxicity.detect(odd.empty(spark), marks).count() == 0


def test_chain_uses_out_of_fold_log_odds():
    r = np.random.default_rng(1)
    x = r.integers(0, 2, (400, 6)).astype(float)
    ys = np.stack([x[:, 0] > 0, (x[:, 0] > 0) & (x[:, 1] > 0)], 1).astype(int)
    weights = toxicity.fit_chain(x, ys, np.arange(400) % toxicity.FOLDS)
    assert len(weights[1]) == len(weights[0]) + 1 and weights[1][6] > 0  # leans on the category before
    p = toxicity.Chain([str(k) for k in range(6)], weights).predict(x)
    assert ((p > 0.5) == ys).mean() > 0.99
