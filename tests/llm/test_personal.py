"""Personal data: base spans against the patterns as written, the chain and the
network against enumeration and differences, the tagger on held-out texts."""

import hashlib
import io
import itertools
import random
import re

import numpy as np
import pytest

from tests.llm.conftest import SF
from tradewh.llm import personal, queries

# The patterns of the four kinds.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c.isascii() and c.isdigit()]
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((kind, *m.span()))
    return out


def as_text(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_patterns_equal_the_patterns_as_written():
    rng = random.Random(1)
    cards = ["4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", "1.2.3.4", "256.1.1.1", "+1 (743) 555-3824", "a@b.c", "a@b@c.de", "٣٤"]
    for n in range(4000):
        text = "".join(rng.choice([*"ab1 .@-+()%_5é", *cards] if n % 2 else [*"1.@-+ a", "255"]) for _ in range(rng.randint(0, 30)))
        assert personal.patterns(text)[0] == brute(text), text
    long = "1" * 60_000 + "@" * 60_000 + "a" * 60_000 + "1." * 60_000 + "+1" + " " * 60_000
    assert [s for s in personal.patterns(long)[0] if s[0] != "ip"] == [] and len(personal.patterns(long)[0]) == 14_999 + 1


def test_chain_gradient_and_best_path_equal_enumeration():
    rng = np.random.default_rng(2)
    k, n = personal.TAGS, 3
    e, trans, start = rng.normal(size=(n, 1, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    ways = list(itertools.product(range(k), repeat=n))
    score = np.array([start[w[0]] + sum(trans[a, b] for a, b in zip(w, w[1:])) + sum(e[t, 0, y] for t, y in enumerate(w)) for w in ways])
    p = np.exp(score - score.max())
    p /= p.sum()
    y = np.array([[1], [2], [0]])
    loss, d_e, d_trans, d_start = personal.chain_grad(e, y, trans, start)
    assert loss == pytest.approx(-np.log(p[ways.index((1, 2, 0))]))
    for t in range(n):
        marginal = np.array([p[[w[t] == q for w in ways]].sum() for q in range(k)])
        assert np.allclose(d_e[t, 0], marginal - np.eye(k)[y[t, 0]])
    pairs = sum(q * np.bincount([a * k + b for a, b in zip(w, w[1:])], minlength=k * k) for w, q in zip(ways, p)).reshape(k, k)
    pairs[1, 2] -= 1
    pairs[2, 0] -= 1
    assert np.allclose(d_trans, pairs) and np.allclose(d_start, d_e[0, 0])
    assert tuple(personal.viterbi(e[:, 0], trans, start)) == ways[int(score.argmax())]


def test_network_gradient_equals_differences():
    rng = np.random.default_rng(3)
    x = rng.integers(0, personal._SYMBOLS, (6, 2))
    h = 3
    inputs, back = rng.normal(size=(personal._SYMBOLS, 4 * h)), rng.normal(size=(h, 4 * h))
    weight = rng.normal(size=(6, 2, h)).astype(np.float32)
    loss = lambda a, b: float((personal._lstm(x, a, b, False)[0].astype(float) * weight).sum())
    _, kept = personal._lstm(x, inputs, back, True)
    d_inputs = np.zeros_like(inputs)
    d_back = personal._lstm_grad(x, back, kept, weight, d_inputs)
    for array, grad, at in ((inputs, d_inputs, (x[0, 0], 1)), (inputs, d_inputs, (x[4, 1], 7)), (back, d_back, (1, 5)), (back, d_back, (2, 11))):
        old, step = array[at], 1e-2
        array[at] = old + step
        up = loss(inputs, back)
        array[at] = old - step
        down = loss(inputs, back)
        array[at] = old
        assert grad[at] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=0.01)


def test_windows_and_stretches_cover_all():
    for n in (1, 50, 96, 97, 160, 161, 500):
        covered = np.zeros(n, int)
        for lo in personal.windows(n):
            covered[lo:lo + personal.WINDOW] += 1
        assert covered.all()
    text = "x" * 500 + "1" + "y" * 79 + "@" + "z" * 500 + "(at)"
    assert personal.stretches(text) == [(460, 621), (1041, len(text))]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("length(text) < 20000 AND text RLIKE '[0-9@]'")
    return [r["text"] for r in rows.orderBy("doc_id").limit(800).collect()]


@pytest.fixture(scope="module")
def tagger(texts):
    out = io.BytesIO()
    np.savez(out, **personal.fit(texts[:400]))
    return personal.Tagger(out.getvalue())


def test_held_out_spans_and_rewritten_ones(texts, tagger):
    held = [t for t in texts[400:] if t not in set(texts[:400])]
    base = [set(personal.patterns(t)[0]) for t in held]
    found = [set(f) for f in tagger.find(held)]
    assert sum(len(b & f) for b, f in zip(base, found)) >= 0.9 * sum(map(len, base)) > 100
    rng, hits, all_ = random.Random(5), 0, 0
    for text, own in zip(held, base):
        for kind, lo, hi in sorted(own)[:1]:
            pre, span, post = personal.rewritten(kind, text[lo:hi], rng)
            lo += len(pre)
            got = personal.spans_of([text[:lo - len(pre)] + pre + span + post + text[hi:]], tagger)[0]
            hits += any((k, a, b) == (kind, lo, lo + len(span)) for k, a, b, _ in got)
            all_ += 1
    assert hits >= 0.85 * all_ > 50
    wrong = sum(any(not s[3] for s in personal.spans_of([f"{t[:200]} {personal.harmless(rng)} {t[200:400]}"], tagger)[0]) for t in held)
    assert wrong <= 0.05 * len(held)


def test_long_stretches_and_base_spans_stay(tagger):
    line = "call (743) 555-3824 or 743-555-3824, card 4111 1111 1111 1111 12/27, a@b.co. "
    text = line * 1500
    spans = personal.spans_of([text], tagger)[0]
    assert [s[:3] for s in spans if s[3]] == brute(text)
    own = [(a, b) for _, a, b, base in spans if base]
    assert all(not any(a < y and b > x for x, y in own[:50]) for _, a, b, base in spans if not base)
    assert sum(text[a:b] == "743-555-3824" for _, a, b, _ in spans) > 1400


def test_query_equals_the_patterns(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op12_personal_data(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        assert tuple(r[f"n_{k}"] for k in PATTERNS) == tuple(sum(s[0] == k for s in base) for k in PATTERNS)
        assert r["base_sha256"] == hashlib.sha256(as_text(base).encode()).hexdigest()
        shown = [s for s in r["spans"].split(",") if s]
        assert set(as_text(base).split(",")) - {""} <= set(shown) and len(shown) == len(base) + r["n_added"]
        keys = [(list(PATTERNS).index(s.split(":")[0]), int(s.split(":")[1])) for s in shown]
        assert keys == sorted(keys)


def test_edges(spark, docs, no_docs):
    found = personal.digest(personal.find_personal(docs, personal.fit_personal(docs))).collect()
    texts = [r["text"] for r in docs.select("text").collect()]
    assert len(found) == len(texts) and all(r["spans"] == "" for r in found)
    assert personal.fit_personal(no_docs) is None and personal.find_personal(no_docs, None).collect() == []
