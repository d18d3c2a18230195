"""Personal data: rules, and a character-level BiLSTM with CRF transitions.

The rules give the base spans. The tagger is trained in numpy from labelled
spans: windows of the documents with their base spans, and the same windows
with made-up spans written in, among them forms that the rules don't know
(phone numbers without a plus, addresses with "(at)"). Overlapping windows of
every text are decoded one by one, and the best set of spans that don't
overlap is chosen over the whole text.
"""

from __future__ import annotations

import bisect
import itertools
import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grimlake.llm.common import id_as_text, stored, text_or_empty

KINDS = ("email", "ip", "card", "phone")
# FIXED VALUES: the rules of the contract. Matches of LOCAL, "@" and DOMAIN are
# leftmost matches of the email pattern; a match of IP can only begin at the
# first digit of a run.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Forms that decoded spans must have to be added.
ADDED = {
    "email": re.compile(r"[a-z0-9._%+-]+\s?(?:@|[(\[]\s?at\s?[)\]])\s?[a-z0-9-]+(?:\s?(?:\.|[(\[]\s?dot\s?[)\]])\s?[a-z0-9-]+)+",
                        re.I),
    "ip": re.compile(r"[0-9]{1,3}(?:\s?[(\[]\.[)\]]\s?[0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9](?:[ ./-]{0,3}[0-9])+"),
    # Any grouping, or none behind a zero; not a date.
    "phone": re.compile(r"(?!(?:19|20)[0-9]{2}[-. ][0-9]{2}[-. ][0-9]{2}(?![0-9]))\+?(?:\(?[0-9]{2,8}\)?"
                        r"(?:[ .-]{1,2}\(?[0-9]{2,8}\)?)+|0[0-9]{9,10})"),
}
TRIGGER = re.compile(r"[0-9@]|[(\[]\s?at\s?[)\]]", re.I)

WINDOW, STRIDE = 96, 48
#: Spans that a window cuts are read again in wider ones, up to this width; no
#: valid form is longer (an address has at most 320 characters).
WIDEST = 1536
#: Windows of the documents used for training, at most: those with the smallest hashes.
TRAIN_WINDOWS = 1200
#: Windows with made-up spans, at least.
MADE_UP_ROWS = 3000
STEPS, BATCH, RATE = 700, 32, 0.02
EMBED, HIDDEN = 12, 24
TAGS = 1 + 2 * len(KINDS)
SYMBOLS = 98  # 0: padding, 1-95: printable ASCII, 96: other letters, 97: the rest


def digits(s: str) -> str:
    return "".join(ch for ch in s if "0" <= ch <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(number)):
        d = ord(ch) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the rules' matches, by kind, then start. Each rule
    reads the text once, however long its runs of letters or digits are."""
    out = []
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((0, start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    if re.search("[0-9]", text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((1, m.start(), m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(n := digits(m[0])) <= 19 and luhn(n):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= len(digits(m[0])) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


def symbols(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    plain = (code >= 32) & (code < 127)
    letter = np.array([ch.isalpha() for ch in text], bool) if not plain.all() else np.zeros(len(code), bool)
    return np.where(plain, code - 31, np.where(letter, 96, 97))


def window_starts(text: str) -> list[int]:
    """Starts of the windows, STRIDE apart, that hold a digit, an "@" or a
    bracketed "at"; no span of these kinds is without one."""
    found = set()
    for m in TRIGGER.finditer(text):
        k = m.start() // STRIDE
        found.add(k * STRIDE)
        if k:
            found.add((k - 1) * STRIDE)
    return sorted(found)


class Tagger:
    """The network: embedding, one LSTM each way, emissions, CRF transitions."""

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        glorot = lambda *s: r.normal(0, np.sqrt(2.0 / sum(s)), s)
        self.p = {"embed": r.normal(0, 0.3, (SYMBOLS, EMBED)), "out": glorot(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS),
                  "trans": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}
        for d in "fb":
            self.p |= {f"{d}x": glorot(EMBED, 4 * HIDDEN), f"{d}h": glorot(HIDDEN, 4 * HIDDEN), f"{d}b": np.zeros(4 * HIDDEN)}
            self.p[f"{d}b"][HIDDEN:2 * HIDDEN] = 1.0  # remember at first
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def direction(self, ids: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (T, B, H) of ids (T, B) in reading order."""
        table = self.p["embed"] @ self.p[f"{d}x"] + self.p[f"{d}b"]
        h = c = np.zeros((ids.shape[1], HIDDEN), np.float32)
        out = np.zeros((*ids.shape, HIDDEN), np.float32)
        for t in range(len(ids)):
            z = table[ids[t]] + h @ self.p[f"{d}h"]
            gates = 1 / (1 + np.exp(-z[:, :3 * HIDDEN]))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            before, c = c, f * c + i * g
            tc = np.tanh(c)
            if keep is not None:
                keep.append((h, before, i, f, o, g, tc))
            h = o * tc
            out[t] = h
        return out

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        hidden = np.concatenate([self.direction(ids, "f"), self.direction(ids[::-1], "b")[::-1]], 2)
        return hidden @ self.p["out"] + self.p["bias"]

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of a batch, and its gradients."""
        keep: dict[str, list] = {"f": [], "b": []}
        hf, hb = self.direction(ids, "f", keep["f"]), self.direction(ids[::-1], "b", keep["b"])[::-1]
        hidden = np.concatenate([hf, hb], 2)
        em = hidden @ self.p["out"] + self.p["bias"]
        steps, batch, _ = em.shape
        trans = self.p["trans"]
        lse = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis))
        alpha, beta = np.zeros_like(em), np.zeros_like(em)
        alpha[0] = self.p["first"] + em[0]
        for t in range(1, steps):
            alpha[t] = lse(alpha[t - 1][:, :, None] + trans, 1) + em[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = lse(trans + (em[t + 1] + beta[t + 1])[:, None, :], 2)
        z = lse(alpha[-1], 1)
        d_em = np.exp(alpha + beta - z[None, :, None])
        pair = np.zeros_like(trans)
        for t in range(1, steps):
            pair += np.exp(alpha[t - 1][:, :, None] + trans + (em[t] + beta[t])[:, None, :] - z[:, None, None]).sum(0)
        rows = np.arange(batch)
        gold = self.p["first"][tags[0]] + em[0, rows, tags[0]]
        for t in range(1, steps):
            gold = gold + trans[tags[t - 1], tags[t]] + em[t, rows, tags[t]]
        np.add.at(pair, (tags[:-1].ravel(), tags[1:].ravel()), -1.0)
        first = d_em[0].sum(0) - np.bincount(tags[0], minlength=TAGS)
        np.add.at(d_em, (np.arange(steps)[:, None], rows[None, :], tags), -1.0)
        d_em /= batch
        flat = d_em.reshape(-1, TAGS)
        grads = {"trans": pair / batch, "first": first / batch, "bias": flat.sum(0),
                 "out": hidden.reshape(-1, 2 * HIDDEN).T @ flat, "embed": np.zeros_like(self.p["embed"])}
        d_hidden = d_em @ self.p["out"].T
        for d, order, dh in (("f", ids, d_hidden[:, :, :HIDDEN]), ("b", ids[::-1], d_hidden[::-1, :, HIDDEN:])):
            w = self.p[f"{d}h"]
            d_table = np.zeros((SYMBOLS, 4 * HIDDEN), np.float32)
            d_w = np.zeros_like(w)
            back_h = back_c = np.zeros((batch, HIDDEN), np.float32)
            for t in range(steps - 1, -1, -1):
                h, c, i, f, o, g, tc = keep[d][t]
                gh = dh[t] + back_h
                gc = back_c + gh * o * (1 - tc * tc)
                dz = np.concatenate([gc * g * i * (1 - i), gc * c * f * (1 - f), gh * tc * o * (1 - o),
                                     gc * i * (1 - g * g)], 1)
                np.add.at(d_table, order[t], dz)
                d_w += h.T @ dz
                back_h, back_c = dz @ w.T, gc * f
            grads[f"{d}h"] = d_w
            grads[f"{d}b"] = d_table.sum(0)
            grads[f"{d}x"] = self.p["embed"].T @ d_table
            grads["embed"] += d_table @ self.p[f"{d}x"].T
        return float((z - gold).mean()), grads

    def train(self, ids: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = 0) -> float:
        """Adam over batches of the windows (N, T); returns the last losses' mean."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses = []
        for k in range(1, steps + 1):
            pick = r.integers(0, len(ids), BATCH)
            loss, grads = self.gradients(ids[pick].T, tags[pick].T)
            losses.append(loss)
            rate = RATE * min(1.0, 2.0 * (1 - k / (steps + 1)))
            for name, g in grads.items():
                m[name] += 0.1 * (g - m[name])
                s[name] += 0.01 * (g * g - s[name])
                self.p[name] = self.p[name] - rate * (m[name] / (1 - 0.9 ** k)) / (np.sqrt(s[name] / (1 - 0.99 ** k)) + 1e-8)
        return float(np.mean(losses[-20:]))

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (T, B) by Viterbi, and each character's score against O."""
        em = self.emissions(ids)
        steps, batch, _ = em.shape
        best = self.p["first"] + em[0]
        back = np.zeros((steps, batch, TAGS), np.int8)
        for t in range(1, steps):
            x = best[:, :, None] + self.p["trans"]
            back[t] = x.argmax(1)
            best = x.max(1) + em[t]
        tags = np.zeros((steps, batch), np.int64)
        tags[-1] = best.argmax(1)
        rows = np.arange(batch)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t, rows, tags[t]]
        own = np.take_along_axis(em, tags[:, :, None], 2)[:, :, 0]
        return tags, own - em[:, :, 0]


def labelled(window: str, spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, tags) of one window, padded; tag 1 + 2 k begins kind k, 2 + 2 k goes on."""
    ids, tags = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
    ids[:len(window)] = symbols(window)
    for kind, a, b in spans:
        tags[a:b] = 2 + 2 * kind
        tags[a] = 1 + 2 * kind
    return ids, tags


def made_up(r: random.Random) -> tuple[int, str]:
    """A span of a random kind (-1: none of them, but like them)."""
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice("abcdefghiklmnoprstuwz") for _ in range(r.randint(3, 9)))
    kind = r.choice([0, 0, 1, 2, 2, 3, 3, -1, -1])
    if kind == 0:
        at = r.choice(["@", "@", "(at)", "[at]", " (at) ", " [at] "])
        dot = "." if at == "@" else r.choice([".", "(dot)", " [dot] ", "[dot]"])
        local = r.choice([word(), f"{word()}.{word()}", f"{word()}{number(2)}", f"{word()}.{number(2)}", f"{word()}_{word()}"])
        return kind, local + at + word() + r.choice(["", number(1)]) + dot + r.choice([f"example{dot}com", "com", "org", "net", "de"])
    if kind == 1:
        return kind, r.choice([".", ".", "[.]", "(.)"]).join(str(r.randint(0, 255)) for _ in range(4))
    if kind == 2:
        n = number(15)
        n += next(d for d in "0123456789" if luhn(n + d))
        return kind, r.choice(["", "", " ", "-", ".", "  "]).join([n[:4], n[4:8], n[8:12], n[12:]])
    if kind == 3:
        plus = r.choice(["+1 ", "+44 ", "+", "", "", ""])
        return kind, plus + r.choice([f"({number(3)}) {number(3)}-{number(4)}", f"{number(3)}-{number(3)}-{number(4)}",
                                      f"{number(3)} {number(3)} {number(4)}", f"{number(3)}.{number(3)}.{number(4)}",
                                      f"0{number(1)} " + " ".join(number(2) for _ in range(4)),
                                      f"0{number(2)} {number(8)}", f"0{number(r.choice([9, 10]))}"])
    hexes = "".join(r.choice("0123456789abcdef") for _ in range(r.choice([8, 16, 32, 40])))
    return -1, r.choice([f'token = "{hexes}"', hexes, number(r.randint(1, 9)), f"{number(4)}-{number(2)}-{number(2)}",
                         f"v{number(1)}.{number(1)}.{number(2)}", f"{number(2)}:{number(2)}", f"{number(3)}%", f"({number(4)})",
                         f"{number(1)}.{number(2)}", f"@{word()}", f"look (at) {word()}",
                         f"{number(2)}, {number(2)}, {number(3)}", f"{number(4)}-{number(2)}-{number(2)} {number(2)}:{number(2)}"])


def around(r: random.Random) -> tuple[str, str]:
    """What a made-up span stands in: mostly nothing, else quotes, a key or a slash."""
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    key = r.choice(["tel", "phone", "contact", "mail", "id", "value"])
    return r.choice([("", "")] * 6 + [('"', '"'), (f'"{key}": "', '"'), (f"{key}=", ""), (f'{key}="', '"'),
                                      ("", f"/{number(3)}"), (f"{key}/", "")])


def training_set(windows: list[tuple[str, list]], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Each window as it is, and at least twice with a made-up span written in
    between words; a few windows are used more often."""
    r = random.Random(seed)
    out = []
    copies = max(2, -(-MADE_UP_ROWS // len(windows)))
    for text, spans in windows:
        out.append(labelled(text, spans))
        for _ in range(copies):
            kind, made = made_up(r)
            pre, post = around(r)
            free = [m.start() for m in re.finditer(r"(?<=\s)", text) if not any(a <= m.start() <= b for _, a, b in spans)]
            at = r.choice(free or [0])
            end = r.choice([" ", " ", ". ", ", "])
            put = pre + made + post + end
            new = text[:at] + put + text[at:]
            moved = [(k, a + len(put), b + len(put)) if a >= at else (k, a, b) for k, a, b in spans]
            moved += [(kind, at + len(pre), at + len(pre) + len(made))] if kind >= 0 else []
            out.append(labelled(new[:WINDOW], [x for x in moved if x[2] <= min(len(new), WINDOW)]
                                if all(x[2] <= WINDOW or x[1] >= WINDOW for x in moved) else
                                [(k, a, min(b, WINDOW)) for k, a, b in moved if a < WINDOW]))
    return np.array([x for x, _ in out]), np.array([y for _, y in out])


def unlabelled(window: str, spans: list[tuple[int, int, int]]) -> bool:
    """Whether the window has a valid form that the rules don't label: as an
    example of plain text it would teach the tagger to pass over it."""
    return any(accepted(k, window, m.start(), m.end()) and not any(a < m.end() and m.start() < b for _, a, b in spans)
               for k, name in enumerate(KINDS) for m in ADDED[name].finditer(window))


def training_windows(rows: DataFrame, limit: int) -> list[tuple[str, list]]:
    """At most ``limit`` windows of the texts that hold something like a span,
    with the rules' spans in them; those with the smallest hashes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text in frame["text"]:
                starts = window_starts(text)
                if not starts:
                    continue
                spans = base_spans(text)
                for a in starts:
                    inside = [(k, x - a, y - a) for k, x, y in spans if x >= a and y <= a + WINDOW]
                    if any(x < a < y or x < a + WINDOW < y for _, x, y in spans):
                        continue  # cuts a span
                    if unlabelled(text[a:a + WINDOW], inside):
                        continue
                    out.append((text[a:a + WINDOW], ",".join(f"{k}:{x}:{y}" for k, x, y in inside)))
            yield pd.DataFrame(out, columns=["window", "spans"])

    found = stored(rows.select("text").mapInPandas(run, "window string, spans string").distinct(), "op2-windows")
    order = F.xxhash64("window", "spans")
    picked = []
    for has in (True, False):  # with and without spans, half each
        part = found.filter((F.col("spans") != "") if has else (F.col("spans") == ""))
        picked += part.orderBy(order, "window", "spans").limit(limit // 2).collect()
    return [(p["window"], [tuple(map(int, x.split(":"))) for x in p["spans"].split(",") if x]) for p in picked]


def fit(rows: DataFrame, limit: int = TRAIN_WINDOWS, steps: int = STEPS) -> Tagger:
    windows = training_windows(rows, limit) or [(" ", [])]
    tagger = Tagger()
    tagger.train(*training_set(windows), steps=steps)
    return tagger


def reconcile(found: dict[tuple[int, int, int], float]) -> list[tuple[int, int, int]]:
    """The spans that don't overlap and have the largest total score, chosen
    over the whole text (weighted intervals, by end)."""
    spans = sorted((b, a, k, v) for (k, a, b), v in found.items() if v > 0)
    ends = [s[0] for s in spans]
    total, take = [0.0], []
    for n, (b, a, _, v) in enumerate(spans):
        j = bisect.bisect_right(ends, a, 0, n)
        take.append(j if total[j] + v > total[n] else -1)
        total.append(max(total[n], total[j] + v))
    out, n = [], len(spans)
    while n:
        if take[n - 1] >= 0:
            b, a, k, _ = spans[n - 1]
            out.append((k, a, b))
            n = take[n - 1]
        else:
            n -= 1
    return out[::-1]


def accepted(kind: int, text: str, a: int, b: int) -> tuple[int, int, int] | None:
    """A decoded span at its full form, or None. The form must be that of its
    kind, its numbers valid, and it must stand by itself."""
    m = next((m for m in ADDED[KINDS[kind]].finditer(text, max(0, a - 2), min(len(text), b + 2))
              if m.start() <= a + 2 and m.end() >= b - 2), None)
    if m is None:
        return None
    near = text[max(0, m.start() - 1):m.start()] + text[m.end():m.end() + 1]
    number = digits(m[0])
    if any(ch.isalnum() or ch in "+_@" for ch in near):
        return None
    if kind == 1 and any(int(x) > 255 for x in re.findall("[0-9]+", m[0])):
        return None
    if kind == 2 and not (16 <= len(number) <= 19 and luhn(number)):
        return None
    if kind == 3 and not 10 <= len(number) <= 15:
        return None
    return kind, m.start(), m.end()


def decoded(texts: list[str], jobs: list[tuple[int, int, int]], tagger: Tagger,
            batch: int) -> Iterator[tuple[int, int, int, int, int, int, float]]:
    """(text, job's start, its end, kind, start, end, score) of the spans that
    the tagger finds in the jobs (text, start, end)."""
    jobs = sorted(jobs, key=lambda x: x[2] - x[1])
    k = 0
    while k < len(jobs):
        width = max(WINDOW, jobs[k][2] - jobs[k][1])  # padded a little, so that near widths share a batch
        width = -(-width // STRIDE) * STRIDE
        part = [j for j in jobs[k:k + max(1, batch * WINDOW // width)] if j[2] - j[1] <= width]
        k += len(part)
        ids = np.zeros((width, len(part)), np.int64)
        for n, (i, a, b) in enumerate(part):
            ids[:b - a, n] = symbols(texts[i][a:b])
        tags, score = tagger.decode(ids)
        for n, s in np.argwhere(tags.T % 2 == 1).tolist():
            i, a, b = part[n]
            kind = int(tags[s, n] - 1) // 2
            e = s + 1
            while e < width and tags[e, n] == 2 + 2 * kind:
                e += 1
            if a + s < b:
                yield i, a, b, kind, a + s, min(a + e, b), float(score[s:e, n].sum())


def merged(windows: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Windows that overlap as one, unless that would be over WIDEST."""
    out: list[tuple[int, int, int]] = []
    for i, a, b in sorted(windows):
        if out and out[-1][0] == i and a < out[-1][2] and max(b, out[-1][2]) - out[-1][1] <= WIDEST:
            out[-1] = (i, out[-1][1], max(b, out[-1][2]))
        else:
            out.append((i, a, b))
    return out


def all_spans(texts: list[str], tagger: Tagger, batch: int = 512) -> list[tuple[list, list]]:
    """(base, added) spans of each text. A window that cuts a span is read again
    with its own width more on each side that cuts, until none is cut or it has
    WIDEST characters or more; windows that overlap then are read as one.
    Windows contain those that they come from, so this ends after as many
    rounds as WIDEST has doublings."""
    jobs = [(i, a, min(a + WINDOW, len(t))) for i, t in enumerate(texts) for a in window_starts(t)]
    scored: list[dict] = [{} for _ in texts]
    while jobs:
        wider: dict[tuple[int, int, int], tuple[int, int]] = {}
        for i, a, b, kind, s, e, score in decoded(texts, jobs, tagger, batch):
            left, right = s == a > 0, e == b < len(texts[i])
            if (left or right) and b - a < WIDEST:
                # A window only grows, by its own width at least: it ends at WIDEST after a few doublings.
                x, y = wider.get((i, a, b), (a, b))
                wider[i, a, b] = (min(x, max(0, a - (b - a))) if left else x, max(y, min(len(texts[i]), b + (b - a))) if right else y)
            else:
                # Whole, or as much as the widest window holds.
                scored[i][kind, s, e] = scored[i].get((kind, s, e), 0.0) + score
        jobs = merged((i, x, y) for (i, _, _), (x, y) in wider.items())
    out = []
    for text, found in zip(texts, scored):
        base = base_spans(text)
        new = sorted({x for s in reconcile(found) if (x := accepted(s[0], text, s[1], s[2]))}, key=lambda x: x[1:])
        out.append((base, apart(new, base)))
    return out


def apart(new: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans of ``new``, sorted by start, that overlap no base span and no
    taken one: one sweep over both."""
    out, end = [], 0
    fixed = sorted((a, b) for _, a, b in base)
    reached = list(itertools.accumulate((b for _, b in fixed), max))  # furthest end so far
    starts = [a for a, _ in fixed]
    for k, a, b in new:
        at = bisect.bisect_left(starts, b)  # base spans that begin before b
        if a >= end and not (at and reached[at - 1] > a):
            out.append((k, a, b))
            end = b
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = TRAIN_WINDOWS,
         steps: int = STEPS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base, spans (kind:start:end by kind, then start; code points, end
    exclusive; ``spans`` has the added ones too), n_added.

    Null texts count as empty and have no spans. Ids are passed through, null
    and repeated ones too; equal texts get equal spans; an empty table gives
    an empty result. Whole texts are read. The tagger is fitted on at most
    ``limit`` windows, and its few thousand weights travel with the tasks.
    """
    doc_id, kind = id_as_text(docs, id_col)
    rows = docs.select(doc_id.alias("doc_id"), text_or_empty(text_col).alias("text"))
    tagger = fit(rows, limit, steps)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), 2000):
                part = frame.iloc[k:k + 2000]
                found = all_spans(part["text"].tolist(), tagger)
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(),
                    **{f"n_{name}": [sum(s[0] == n for s in base) for base, _ in found] for n, name in enumerate(KINDS)},
                    "base": [joined(base) for base, _ in found], "spans": [joined(base + added) for base, added in found],
                    "n_added": [len(added) for _, added in found]})

    out = rows.mapInPandas(run, "doc_id string, " + "".join(f"n_{k} long, " for k in KINDS)
                           + "base string, spans string, n_added long")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))
