"""Personal data by a character-level bidirectional LSTM with CRF transitions.

Base spans are found by their patterns. The tagger adds what the patterns miss:
phone numbers without a plus sign, addresses written with ``(at)``, card numbers
with other digits behind them. Its labelled spans are the base spans of a bounded
sample of documents, as they stand and rewritten in such ways, in their own
surroundings, beside numbers that are none (dates, versions, prices). Network
and transitions are fitted together, in numpy, by the chain's log-likelihood.

A span of any kind has a digit, an ``@`` or a bracketed ``at``: texts are read in
stretches that reach ``REACH`` characters to both sides of each of these, which
leaves no place out where a span could be. A stretch is cut into overlapping
windows; each window gives a score per character and tag, scores of several
windows are averaged with the weight of the distance to the window's edge, and
one Viterbi pass over the whole stretch reconciles them. A decoded span is added
if it is of its kind's form (digits, Luhn, parts of an address) and touches no
base span.

Fit: at most ``FIT_DOCS`` documents of at most ``FIT_CHARS`` characters, in one
task; the model is some 8,000 numbers. Finding is one scan with one Arrow pass.

Defined results: null and empty texts have no spans; without any base span in
the sample there is no tagger and nothing is added; texts are read whole, a
stretch of more than ``PART`` characters in parts that go on from the tag before;
repeated rows are read each; an empty table gives no rows; other columns are
ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import io
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradewh.llm.common import pick

FIT_DOCS, FIT_CHARS = 1500, 20_000
#: Windows that the fit sees at most, and how often it takes a batch of them.
FIT_WINDOWS, STEPS, BATCH, HIDDEN = 6000, 300, 64, 16
WINDOW, STRIDE, REACH, PART, LOOK = 96, 64, 40, 1 << 16, 256
KINDS = ("email", "ip", "card", "phone")
ANCHOR = re.compile(r"[0-9@]|[(\[]at[)\]]", re.I)
OUT = 0  # tags: 0 none, then per kind its first and its further characters
TAGS = 1 + 2 * len(KINDS)

# -- patterns --------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_PARTS = re.compile(r"[0-9]++(?:\.[0-9]++)++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_ip(parts: list[str]) -> bool:
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p[-3:] or 0) <= 255 and p for p in parts)


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def patterns(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """(base spans, by kind and start; places of matches that fail their test).

    The matches are those of the kinds' patterns, leftmost and non-overlapping,
    each found in one pass: an address from its @ outwards, four parts at a time
    of a chain of numbers.
    """
    spans, failed, end = [], [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            spans.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    for m in _PARTS.finditer(text):
        parts, start = m.group().split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = start + sum(map(len, four)) + 3
            if _is_ip(four):
                spans.append(("ip", start, end))
            else:
                failed.append((start, end))
            start = end + 1
    for m in _CARD.finditer(text):
        if _is_card(m.group()):
            spans.append(("card", *m.span()))
        elif len(_digits(m.group())) >= 13:
            failed.append(m.span())
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            spans.append(("phone", *m.span()))
        else:
            failed.append(m.span())
    return spans, failed


_AT = re.compile(r"@|[(\[]\s?at\s?[)\]]|\sat\s", re.I)


def plausible(kind: str, text: str) -> bool:
    """Whether a decoded span has its kind's form."""
    if kind == "email":
        sides = _AT.split(text)
        return len(sides) == 2 and all(re.search("[A-Za-z0-9]", s) for s in sides) and bool(re.search(r"\.|dot", sides[1]))
    if kind == "ip":
        return re.fullmatch(r"[0-9.]+", text) is not None and _is_ip(text.split("."))
    if kind == "card":
        return _is_card(text) and re.fullmatch(r"[0-9 -]+", text) is not None
    return 7 <= len(_digits(text)) <= 15 and re.fullmatch(r"[+(0-9][ ().0-9/-]*[0-9]", text) is not None


# -- network ----------------------------------------------------------------------

_SYMBOLS = 101


def _symbols() -> np.ndarray:
    """Code point -> symbol: ASCII signs for themselves, then line ends and tabs,
    other Latin letters, other letters' blocks and all the rest."""
    table = np.full(0x250, 96, np.int64)
    table[:32] = 95
    table[32:127] = np.arange(95)
    table[0xA0] = 0
    table[0xC0:] = 97
    return table


_TABLE = _symbols()


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < len(_TABLE), _TABLE[np.minimum(codes, len(_TABLE) - 1)], 98 + (codes >= 0x2000))


PAD = 100


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (1 + np.tanh(np.float32(0.5) * x))


def _lstm(x: np.ndarray, inputs: np.ndarray, back: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states (T, B, H) of symbols x (T, B); with ``keep`` what the gradient needs."""
    t_max, b = x.shape
    size = back.shape[0]
    h, c = np.zeros((b, size), np.float32), np.zeros((b, size), np.float32)
    out, kept = np.empty((t_max, b, size), np.float32), []
    for t in range(t_max):
        z = inputs[x[t]] + h @ back
        gates = _sigmoid(z[:, :3 * size])
        i, f, o = gates[:, :size], gates[:, size:2 * size], gates[:, 2 * size:]
        g = np.tanh(z[:, 3 * size:])
        before, last = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[t] = h
        if keep:
            kept.append((i, f, o, g, before, tc, last))
    return out, kept


def _lstm_grad(x: np.ndarray, back: np.ndarray, kept: list, d_out: np.ndarray, d_inputs: np.ndarray) -> np.ndarray:
    d_back = np.zeros_like(back)
    dh = np.zeros(d_out.shape[1:], np.float32)
    dc = np.zeros_like(dh)
    for t in range(len(kept) - 1, -1, -1):
        i, f, o, g, before, tc, last = kept[t]
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate((dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)), axis=1)
        np.add.at(d_inputs, x[t], dz)
        d_back += last.T @ dz
        dh, dc = dz @ back.T, dc * f
    return d_back


def scores(p: dict[str, np.ndarray], x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
    """Scores (T, B, tags) of symbols x (T, B)."""
    hf, kf = _lstm(x, p["in_f"], p["back_f"], keep)
    hb, kb = _lstm(x[::-1], p["in_b"], p["back_b"], keep)
    h = np.concatenate((hf, hb[::-1]), axis=2)
    return h @ p["out"] + p["bias"], (h, kf, kb)


# -- chain ------------------------------------------------------------------------

def forbidden() -> np.ndarray:
    """True where a tag can't follow: further characters come behind their own kind's."""
    no = np.zeros((TAGS, TAGS), bool)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        no[:, inside] = True
        no[[inside - 1, inside], inside] = False
    return no


_NEVER = np.float32(-1e4)


def _total(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis=axis)) + top.squeeze(axis)


def chain_grad(e: np.ndarray, y: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Negative log-likelihood per sequence of tags y (T, B) under scores e (T, B,
    tags), and its gradients by scores, transitions and start."""
    t_max, b, k = e.shape
    fwd, bwd = np.empty_like(e), np.zeros_like(e)
    fwd[0] = start + e[0]
    for t in range(1, t_max):
        fwd[t] = _total(fwd[t - 1][:, :, None] + trans, 1) + e[t]
    for t in range(t_max - 2, -1, -1):
        bwd[t] = _total(trans + (e[t + 1] + bwd[t + 1])[:, None, :], 2)
    log_z = _total(fwd[-1], 1)
    d_e = np.exp(fwd + bwd - log_z[:, None])
    d_trans = np.zeros_like(trans)
    for t in range(1, t_max):
        d_trans += np.exp(fwd[t - 1][:, :, None] + trans + (e[t] + bwd[t] - log_z[:, None])[:, None, :]).sum(axis=0)
    at, d_start = np.arange(b), d_e[0].sum(axis=0)
    score = start[y[0]] + e[0][at, y[0]]
    for t in range(1, t_max):
        score = score + trans[y[t - 1], y[t]] + e[t][at, y[t]]
    np.add.at(d_start, y[0], -1)
    np.add.at(d_trans, (y[:-1].ravel(), y[1:].ravel()), -1)
    d_e[np.arange(t_max)[:, None], at, y] -= 1
    return float((log_z - score).mean()), d_e / b, d_trans / b, d_start / b


def viterbi(e: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The best tags of scores e (T, tags)."""
    frm = np.empty(e.shape, np.uint8)
    best = start + e[0]
    for t in range(1, len(e)):
        ways = best[:, None] + trans
        frm[t] = ways.argmax(axis=0)
        best = ways.max(axis=0) + e[t]
    tags = np.empty(len(e), np.uint8)
    tags[-1] = best.argmax()
    for t in range(len(e) - 1, 0, -1):
        tags[t - 1] = frm[t, tags[t]]
    return tags


# -- fit --------------------------------------------------------------------------

# Months for dates that are no personal data.
_MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def rewritten(kind: str, span: str, rng: random.Random) -> tuple[str, str, str]:
    """(before, span, behind): the span as it is, or written in another way."""
    way = rng.random()
    if kind == "email" and way < 0.5:
        at = rng.choice([" (at) ", "(at)", " [at] ", "[at]", " (AT) "])
        dot = rng.choice([".", ".", " (dot) ", " dot ", "[dot]"])
        name, host = span.split("@", 1)
        return "", name + at + host.replace(".", dot), ""
    if kind == "phone" and way < 0.7:
        d = _digits(span)
        local = d[-10:]
        return "", rng.choice([
            f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}-{local[3:6]}-{local[6:]}", f"{local[:3]}.{local[3:6]}.{local[6:]}",
            f"00{d[:2]} {d[2:5]} {d[5:]}", f"0{local[:3]}/{local[3:]}", f"{local[:3]} {local[3:6]} {local[6:]}"]), ""
    if kind == "card" and way < 0.6:
        d = _digits(span)
        shown = rng.choice([d, " ".join(d[i:i + 4] for i in range(0, len(d), 4)), "-".join(d[i:i + 4] for i in range(0, len(d), 4))])
        return "", shown, rng.choice(["", "", f" {rng.randint(1, 12):02d}/{rng.randint(24, 39)}", f" {rng.randint(100, 999)}"])
    if kind == "ip" and way < 0.3:
        return rng.choice(["", "host ", "http://"]), span, rng.choice([f":{rng.randint(80, 9999)}", "/", ""])
    return "", span, ""


def harmless(rng: random.Random) -> str:
    """A number that is no personal data."""
    y, m, d, n = rng.randint(1900, 2040), rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 99_999)
    return rng.choice([
        f"{y}", f"{n}", f"{y}-{m:02d}-{d:02d}", f"{d:02d}.{m:02d}.{y}", f"{d}/{m}/{y}", f"{d} {rng.choice(_MONTHS)} {y}", f"{m}:{d:02d}",
        f"{m}.{d}", f"v{m}.{d}.{n % 20}", f"{n:,}.{d:02d}", f"{m}%", f"§ {d}", f"{y}-{(y + 1) % 100:02d}", f"{n}-{m}", f"ISBN 978-{m}-{n:05d}-{y % 1000}-{d % 10}",
        f"@{rng.choice(_MONTHS).lower()}{m}", f"{m} @ {d}", f"{m:02d}:{d:02d}:{n % 60:02d}", "%032x" % rng.getrandbits(128)])


def labelled_windows(texts: list[str], most: int = FIT_WINDOWS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags (windows, WINDOW) around the base spans of texts."""
    rng = random.Random(seed)
    xs, ys = [], []
    known: list[tuple] = []  # spans of earlier texts

    def add(parts: list[tuple[str, int | None]], main: int) -> None:
        """A window that shows (much of) part ``main``."""
        at = sum(len(t) for t, _ in parts[:main]) - rng.randint(0, max(0, WINDOW - len(parts[main][0])))
        whole = "".join(t for t, _ in parts)
        text = whole[max(0, at):][:WINDOW]
        x, y = np.full(WINDOW, PAD), np.zeros(WINDOW, np.int64)
        x[:len(text)] = symbols(text)
        lo = -max(0, at)
        for t, kind in parts:
            hi = lo + len(t)
            if kind is not None and hi > 0 and lo < WINDOW:
                y[max(0, lo):hi] = 2 + 2 * kind
                if lo >= 0:
                    y[lo] = 1 + 2 * kind
            lo = hi
        # What other spans stand in the window keep their own tags.
        for other, lo, hi in patterns(text)[0]:
            if not y[lo:hi].any():
                y[lo:hi] = 2 + 2 * KINDS.index(other)
                y[lo] = 1 + 2 * KINDS.index(other)
        xs.append(x)
        ys.append(y)

    for text in texts:
        spans, failed = patterns(text)
        for kind, lo, hi in spans[:6]:
            left, right = text[max(0, lo - WINDOW):lo], text[hi:hi + WINDOW]
            if any(a < hi + WINDOW and b > lo - WINDOW for a, b in failed) or hi - lo > WINDOW // 2:
                continue
            for _ in range(3):
                pre, span, post = rewritten(kind, text[lo:hi], rng)
                parts = [(left + pre, None), (span, KINDS.index(kind)), (post, None)]
                if rng.random() < 0.4:  # another one beside it
                    other, a, b = rng.choice(spans) if rng.random() < 0.3 or not known else rng.choice(known)
                    pre, span, post = rewritten(other, a if b is None else text[a:b], rng)
                    parts += [(rng.choice([" ", ", ", " or ", "; ", "\n", " / "]) + pre, None), (span, KINDS.index(other)), (post, None)]
                add([*parts, (right, None)], 1)
            known.append((kind, text[lo:hi], None))
            add([(left, None), (harmless(rng), None), (right, None)], 1)
        if len(xs) >= most:
            break
    return np.array(xs[:most]).reshape(-1, WINDOW), np.array(ys[:most]).reshape(-1, WINDOW)


def fit(texts: list[str], steps: int = STEPS, seed: int = 7) -> dict[str, np.ndarray] | None:
    """The tagger, by Adam on the chain's log-likelihood; None without a span."""
    x, y = labelled_windows(texts, seed=seed)
    if not len(x):
        return None
    rng, h = np.random.default_rng(seed), HIDDEN
    normal = lambda *shape: rng.normal(0, 0.2, shape).astype(np.float32)
    p = {"in_f": normal(_SYMBOLS, 4 * h), "back_f": normal(h, 4 * h), "in_b": normal(_SYMBOLS, 4 * h), "back_b": normal(h, 4 * h),
         "out": normal(2 * h, TAGS), "bias": np.zeros(TAGS, np.float32), "trans": np.zeros((TAGS, TAGS), np.float32), "start": np.zeros(TAGS, np.float32)}
    no = forbidden()
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        at = rng.integers(0, len(x), BATCH)
        xb, yb = x[at].T, y[at].T
        e, (hidden, kf, kb) = scores(p, xb, keep=True)
        _, d_e, d_trans, d_start = chain_grad(e, yb, np.where(no, _NEVER, p["trans"]), p["start"])
        d_h = d_e @ p["out"].T
        grads = {"out": np.einsum("tbh,tbk->hk", hidden, d_e), "bias": d_e.sum(axis=(0, 1)), "trans": np.where(no, 0, d_trans), "start": d_start,
                 "in_f": np.zeros_like(p["in_f"]), "in_b": np.zeros_like(p["in_b"])}
        grads["back_f"] = _lstm_grad(xb, p["back_f"], kf, np.ascontiguousarray(d_h[:, :, :h]), grads["in_f"])
        grads["back_b"] = _lstm_grad(xb[::-1], p["back_b"], kb, np.ascontiguousarray(d_h[::-1, :, h:]), grads["in_b"])
        rate = 0.02 * (1 - 0.9 * step / steps)
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            p[k] -= (rate * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return p | {"trans": np.where(no, _NEVER, p["trans"])}


def fit_personal(docs: DataFrame, fit_docs: int = FIT_DOCS, fit_chars: int = FIT_CHARS) -> bytes | None:
    """The tagger as bytes, fitted on a bounded sample of ``docs``: of those with a
    digit or an @ the ones of the smallest hashes, among some thirty times as many."""
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 32))
    some = pick(docs, doc_id="long", text="string")
    limit = int((1 << 32) * min(1.0, 30 * fit_docs / max(1, some.count())))
    some = some.where((place <= limit) & (F.length("text") <= fit_chars) & F.col("text").rlike("[0-9@]"))
    sample = some.orderBy(place, "doc_id", "text").limit(fit_docs)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        model, out = fit(sorted(rows["text"])), io.BytesIO()
        if model is not None:
            np.savez(out, **model)
        return pd.DataFrame({"model": [out.getvalue()]})

    got = sample.groupBy(F.lit(0).alias("one")).applyInPandas(run, "model binary").collect()  # one row, of bounded size
    return bytes(got[0]["model"]) or None if got else None


# -- reading texts ------------------------------------------------------------------

def stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text that reach ``REACH`` characters to both sides of anchors."""
    out: list[list[int]] = []
    for m in ANCHOR.finditer(text):
        lo, hi = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def windows(n: int) -> list[int]:
    """Starts of the overlapping windows over n characters."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


class Tagger:
    """``find``: decoded spans of several texts, their windows scored together."""

    _near = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)

    def __init__(self, model: bytes, together: int = 1024):
        with np.load(io.BytesIO(model)) as got:
            self.p = {k: got[k] for k in got.files}
        self.together = together

    def _averaged(self, parts: list[np.ndarray]) -> Iterator[np.ndarray]:
        """Scores of each part (symbols), averaged over its windows."""
        rows, owner = [], []
        for k, x in enumerate(parts):
            for lo in windows(len(x)):
                row = np.full(WINDOW, PAD)
                row[:min(WINDOW, len(x))] = x[lo:lo + WINDOW]
                rows.append(row)
                owner.append((k, lo))
        sums = [np.zeros((len(x), TAGS), np.float32) for x in parts]
        weight = [np.zeros((len(x), 1), np.float32) for x in parts]
        for at in range(0, len(rows), self.together):
            e = scores(self.p, np.array(rows[at:at + self.together]).T)[0]
            for i, (k, lo) in enumerate(owner[at:at + self.together]):
                n = min(WINDOW, len(sums[k]) - lo)
                sums[k][lo:lo + n] += e[:n, i] * self._near[:n, None]
                weight[k][lo:lo + n] += self._near[:n, None]
        return (s / w for s, w in zip(sums, weight))

    def tags(self, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, start, tags) of each stretch, in parts where it is long."""
        jobs = [(k, lo, hi, at) for k, text in enumerate(texts) for lo, hi in stretches(text) for at in range(lo, hi, PART)]
        at, last = 0, OUT
        while at < len(jobs):
            some, size = [], 0
            while at < len(jobs) and (not some or size < 1 << 18):
                some.append(jobs[at])
                size += min(jobs[at][2] - jobs[at][3], PART + LOOK)
                at += 1
            cut = [symbols(texts[k][a:min(hi, a + PART + LOOK)]) for k, _, hi, a in some]
            for (k, lo, hi, a), e in zip(some, self._averaged(cut)):
                start = self.p["trans"][last] if a > lo else np.where(forbidden()[OUT], _NEVER, self.p["start"])
                found = viterbi(e, self.p["trans"], start)[:PART]
                last = int(found[-1])
                yield k, a, found

    def find(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """(kind, start, end) per text, of their kinds' forms."""
        runs: list[list[list]] = [[] for _ in texts]
        for k, lo, tags in self.tags(texts):
            edges = np.flatnonzero((tags != OUT) & ((tags % 2 == 1) | (np.concatenate(([OUT], tags[:-1])) == OUT)))
            for i in edges:
                j = i + 1
                while j < len(tags) and tags[j] and tags[j] % 2 == 0:
                    j += 1
                kind = KINDS[(tags[i] - 1) // 2]
                if tags[i] % 2 == 0 and runs[k] and runs[k][-1][2] == lo + i:  # goes on from the part before
                    runs[k][-1][2] = int(lo + j)
                else:
                    runs[k].append([kind, int(lo + i), int(lo + j)])
        return [[(kind, a, b) for kind, a, b in own if plausible(kind, text[a:b])] for text, own in zip(texts, runs)]


def spans_of(texts: list[str], tagger: Tagger | None) -> list[list[tuple[str, int, int, bool]]]:
    """(kind, start, end, whether it is a base span) per text, by kind and start."""
    base = [patterns(t)[0] if ANCHOR.search(t) else [] for t in texts]
    more = tagger.find(texts) if tagger else [[] for _ in texts]
    out = []
    for own, found in zip(base, more):
        taken = sorted((a, b) for _, a, b in own)
        starts = np.array([a for a, _ in taken])
        ends = np.maximum.accumulate(np.array([b for _, b in taken])) if taken else starts
        spans = [(kind, a, b, True) for kind, a, b in own]
        for kind, a, b in found:
            before = int(np.searchsorted(starts, b))  # base spans that start before the end
            if not before or ends[before - 1] <= a:
                spans.append((kind, a, b, False))
        out.append(sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])


def find_personal(docs: DataFrame, model: bytes | None) -> DataFrame:
    """One row per row of ``docs``: doc_id and spans (kind, start, end, base), by kind and start."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value) if shared.value else None
        for batch in batches:
            found: list = []
            texts, part, size = [t or "" for t in batch.column("text").to_pylist()], [], 0
            for t in texts:
                part.append(t)
                size += len(t)
                if size >= 4_000_000:
                    found += spans_of(part, tagger)
                    part, size = [], 0
            found += spans_of(part, tagger)
            spans = [[dict(zip(("kind", "start", "end", "base"), s)) for s in own] for own in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.list_(_SPAN))], ["doc_id", "spans"])

    return pick(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, base spans per kind, the SHA-256 of the base spans and all spans as text."""
    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    counts = [of_kind(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"))
