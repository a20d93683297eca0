"""Toxicity: a two-state linear-chain conditional random field over words.

Labels mark whole documents, so the tokens of the fitting sample are labelled
first: a word, or a stem of four to eight letters, that occurs in many toxic
documents and (nearly) never in clean ones marks its tokens as toxic. The CRF
is then fitted to these labelled tokens (word and stem weights, transitions,
start), and scoring runs forward-backward over every sentence of every text.
A document's score joins its token marginals; offending spans are runs of
tokens with a marginal of 0.5 or more, as character offsets of the text.

Fit: a bounded sample (``FIT_DOCS`` documents of each class, none longer than
``FIT_CHARS`` characters), fitted in one task. The model has at most one
weight per distinct word or stem of that sample, so its broadcast is bounded
by the same parameters. Scoring is one scan with one Arrow pass: no shuffle.

Defined results: null and empty texts have no tokens and score 0; without a
labelled document of each class every text scores 0; repeated label rows count
once (toxic if any says so); label rows without doc_id, label or document are
ignored; of several texts with one doc_id the least is fitted to, all are scored;
texts and sentences of any length are scored whole;
of like hashes the smaller doc_id is sampled; repeated rows score alike; an empty
table gives no rows; other columns are ignored or passed through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tradewh.llm.common import in_fold, pick

FIT_DOCS = 1500
FIT_CHARS = 20_000
#: Letters of the stems that stand beside a word.
STEMS = range(4, 9)
#: Words of a sequence that are stepped through one by one; longer ones in blocks.
BLOCK = 64
TOKEN = re.compile(r"\w+|[.!?\n]")
#: A sequence ends at these marks.
_BREAKS = frozenset(".!?\n")


# -- chain arithmetic --------------------------------------------------------
# Two states, so forward and backward variables are kept as log-odds of state
# 1 against state 0: one number per token.

def _columns(lengths: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Order of the sequences, longest first, and how many are longer than t, for each t."""
    order = np.argsort(-lengths, kind="stable")
    most = int(lengths[order[0]]) if len(order) else 0
    return order, [int(np.searchsorted(-lengths[order], -t, side="left")) for t in range(most)]


def _odds(v: np.ndarray, a: float, b: float, c: float, d: float) -> np.ndarray:
    """log((a + b e^v) / (c + d e^v))"""
    x = np.exp(np.clip(v, -40, 40))
    return np.log((a + b * x) / (c + d * x))


def _forward(emit: np.ndarray, starts: np.ndarray, lengths: np.ndarray, t: np.ndarray, start: float) -> np.ndarray:
    """Forward log-odds of each token.

    All blocks move in step: step k handles the k-th token of every block that
    has one. What a whole block does to the odds x it is entered with is a
    fraction (p x + q) / (r x + s), so the blocks of a long sequence are entered
    with the odds that the fractions of those before them give.
    """
    out = np.empty(len(emit))
    odds = lambda v: _odds(v, t[0, 1], t[1, 1], t[0, 0], t[1, 0])

    def within(first: np.ndarray, size: np.ndarray, entry: np.ndarray) -> None:
        order, active = _columns(size)
        first = first[order]
        out[first] = emit[first] + entry[order]
        for k in range(1, len(active)):
            at = first[:active[k]] + k
            out[at] = emit[at] + odds(out[at - 1])

    within(starts, np.minimum(lengths, BLOCK), np.full(len(starts), float(start)))
    later = -(-lengths // BLOCK) - 1  # blocks after the first
    if not later.any():
        return out
    order, active = _columns(later)
    order = order[:active[0]]
    later, begin, size = later[order], starts[order], lengths[order]
    base = np.cumsum(later) - later
    nth = np.arange(later.sum()) - np.repeat(base, later) + 1
    first = np.repeat(begin, later) + nth * BLOCK
    left = np.minimum(BLOCK, np.repeat(begin + size, later) - first)
    p, q, r, s = np.ones(len(first)), np.zeros(len(first)), np.zeros(len(first)), np.ones(len(first))
    whole = np.flatnonzero(left == BLOCK)
    for k in range(BLOCK if len(whole) else 0):
        e = np.exp(np.clip(emit[first[whole] + k], -40, 40))
        a, b, c, d = p[whole], q[whole], r[whole], s[whole]
        four = np.stack([e * (t[1, 1] * a + t[0, 1] * c), e * (t[1, 1] * b + t[0, 1] * d), t[1, 0] * a + t[0, 0] * c, t[1, 0] * b + t[0, 0] * d])
        p[whole], q[whole], r[whole], s[whole] = np.maximum(four / four.max(0), 1e-280)
    entry, v = np.empty(len(first)), out[begin + BLOCK - 1]
    for j, n in enumerate(active):
        at = base[:n] + j
        entry[at] = odds(v[:n])
        x = np.exp(np.clip(v[:n], -40, 40))
        v = np.log((p[at] * x + q[at]) / (r[at] * x + s[at]))
    within(first, left, entry)
    return out


def forward_backward(emit: np.ndarray, starts: np.ndarray, lengths: np.ndarray, trans: np.ndarray,
                     start: float) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log-odds of each token; sequences lie at ``starts``.

    ``trans[a, b]`` is the potential of going from state a to b. Backward is
    forward from the other end, over the transposed transitions.
    """
    if not len(starts):
        return np.empty(len(emit)), np.zeros(len(emit))
    t = np.exp(trans)
    back = _forward(emit[::-1], len(emit) - starts - lengths, lengths, t.T, 0.0)[::-1]
    return _forward(emit, starts, lengths, t, start), back - emit


def sequences(is_break: np.ndarray, doc_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kept, starts, lengths): word positions, and the runs of words between
    breaks within one document."""
    words = np.flatnonzero(~is_break)
    if not len(words):
        return words, words, words
    new = np.ones(len(words), bool)
    new[1:] = (np.diff(words) > 1) | (np.diff(doc_of[words]) != 0)
    begin = np.flatnonzero(new)
    return words, begin, np.diff(np.append(begin, len(words)))


# -- features and fit --------------------------------------------------------

def features(token: str) -> list[str]:
    """The word, and its stems."""
    w = token.lower()
    return [w] + [f"{w[:k]}-" for k in STEMS if len(w) >= k]


def _near_copies_out(texts: list[str], toxic: list[int]) -> list[int]:
    """Indexes of documents, but of toxic ones that share one of two min-hashes
    of their word triples only the first, so that copies count once."""
    seen, keep = set(), []
    for i, text in enumerate(texts):
        if not toxic[i]:
            keep.append(i)
            continue
        w = text.encode("utf-8", "surrogatepass").lower().split()
        grams = [b" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))]
        keys = {(s, min(xxhash.xxh64_intdigest(g, s) for g in grams)) for s in (1, 2)}
        if not keys & seen:
            keep.append(i)
        seen |= keys
    return keep


def label_stems(sets: list[set[str]], toxic: np.ndarray) -> set[str]:
    """Features of many toxic documents that clean ones (nearly) never have.

    Of so many features, chance would give none that often: the probability
    that all documents with it are toxic is under 5 % over the number of features.
    """
    pos, neg = Counter(), Counter()
    for s, y in zip(sets, toxic):
        (pos if y else neg).update(s)
    n1, n0 = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    chance = math.log(0.05 / max(1, len(pos))) / math.log(n1 / (n1 + n0))
    return {f for f, n in pos.items() if n >= max(chance, 0.01 * n1) and neg[f] / n0 <= 0.02 * n / n1}


def fit(texts: list[str], toxic: list[int], rounds: int = 30, l2: float = 1e-3) -> dict:
    """Weights of the CRF: {"w": {feature: weight}, "trans": 2x2, "start": s, "bias": b}."""
    keep = _near_copies_out(texts, toxic)
    texts, y_doc = [texts[i] for i in keep], np.array([toxic[i] for i in keep], np.int64)
    if not y_doc.any() or y_doc.all():
        return {"w": {}, "trans": [[0.0, 0.0], [0.0, 0.0]], "start": 0.0, "bias": -40.0}
    vocab: dict[str, int] = {}
    toks, docs, sets = [], [], []
    for d, text in enumerate(texts):
        ids = [vocab.setdefault(t.lower(), len(vocab)) for t in TOKEN.findall(text)]
        toks.append(np.array(ids, np.int64))
        docs.append(np.full(len(ids), d))
        sets.append(ids)
    words = list(vocab)
    feats = [features(w) if w not in _BREAKS else [] for w in words]
    chosen = label_stems([{f for i in set(ids) for f in feats[i]} for ids in sets], y_doc)
    seen = Counter(f for fs in feats for f in fs)
    index = {f: k for k, f in enumerate(sorted(f for f, n in seen.items() if n > 1 or f in chosen or not f.endswith("-")))}
    wide = np.full((len(words), 1 + len(STEMS)), len(index))
    for i, fs in enumerate(feats):
        own = [index[f] for f in fs if f in index]
        wide[i, :len(own)] = own
    tok, doc = np.concatenate(toks), np.concatenate(docs)
    is_break = np.array([w in _BREAKS for w in words])[tok]
    kept, starts, lengths = sequences(is_break, doc)
    if not len(kept):
        return {"w": {}, "trans": [[0.0, 0.0], [0.0, 0.0]], "start": 0.0, "bias": -40.0}
    tok = tok[kept]
    marked = np.array([any(f in chosen for f in fs) for fs in feats], float)
    y = marked[tok] * y_doc[doc[kept]]
    inner = np.ones(len(tok), bool)
    inner[starts] = False
    nxt = np.flatnonzero(inner)  # tokens with one before them
    y_pair = [((y[nxt - 1] == a) & (y[nxt] == b)).sum() for a in (0, 1) for b in (0, 1)]
    w, theta = np.zeros(len(index) + 1), np.array([0.0, 0.0, 0.0, 0.0, 0.0, -4.0])  # 4 transitions, start, bias
    caches = [np.zeros_like(w), np.zeros_like(theta)]
    n = len(tok)
    for _ in range(rounds):
        w[-1] = 0
        emit = w[wide].sum(1)[tok] + theta[5]
        trans = theta[:4].reshape(2, 2)
        fwd, bwd = forward_backward(emit, starts, lengths, trans, theta[4])
        p = 1 / (1 + np.exp(-np.clip(fwd + bwd, -40, 40)))
        g = y - p
        by_word = np.bincount(tok, g, len(words))
        grad = np.zeros(len(w))
        for k in range(wide.shape[1]):
            grad += np.bincount(wide[:, k], by_word, len(w))
        r, v = np.clip(fwd[nxt - 1], -40, 40), np.clip(emit[nxt] + bwd[nxt], -40, 40)
        four = np.stack([np.exp(a * r + b * v + trans[a, b]) for a in (0, 1) for b in (0, 1)])
        pair = (four / four.sum(0)).sum(1)
        grads = [grad - l2 * n * w / len(w), np.concatenate([np.array(y_pair) - pair, [g[starts].sum(), g.sum()]])]
        for x, dx, cache, rate in ((w, grads[0], caches[0], 0.5), (theta, grads[1], caches[1], 0.2)):
            cache *= 0.9
            cache += 0.1 * dx * dx
            x += rate * dx / (np.sqrt(cache) + 1e-3)
    return {"w": {f: float(w[k]) for f, k in index.items() if abs(w[k]) >= 0.3}, "trans": theta[:4].reshape(2, 2).tolist(),
            "start": float(theta[4]), "bias": float(theta[5])}


def fit_toxicity(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, fit_chars: int = FIT_CHARS) -> dict:
    """The model, fitted on a bounded sample of the labelled documents."""
    labels = pick(labels, doc_id="long", toxic="int").dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    docs = pick(docs, doc_id="long", text="string").where(F.length("text") <= fit_chars)
    # Labels of documents that aren't there (any more) take no place in the sample.
    labels = labels.join(docs.select("doc_id").dropna(), "doc_id", "left_semi")
    labels = labels.withColumn("toxic", (F.col("toxic") != 0).cast("int"))
    sizes = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    ids = None
    for y in (0, 1):
        # Those of the smallest hashes, looked for among some twice as many.
        place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
        some = labels.where((F.col("toxic") == y) & (place <= int((1 << 32) * min(1.0, 2 * fit_docs / max(1, sizes.get(y, 0))))))
        some = some.orderBy(place, "doc_id").limit(fit_docs)
        ids = some if ids is None else ids.unionByName(some)
    # At most 2 x fit_docs rows of two numbers, so the broadcast is bounded.
    sample = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        m = fit(rows["text"].tolist(), (rows["toxic"] != 0).astype(int).tolist())
        extra = {" start": m["start"], " bias": m["bias"], **{f" {a}{b}": m["trans"][a][b] for a in (0, 1) for b in (0, 1)}}
        return pd.DataFrame({"feature": [*m["w"], *extra], "weight": [*m["w"].values(), *extra.values()]})

    rows = sample.groupBy(F.lit(0).alias("one")).applyInPandas(run, "feature string, weight double").toPandas()
    got = dict(zip(rows["feature"], rows["weight"]))
    return {"trans": [[got.pop(f" {a}{b}", 0.0) for b in (0, 1)] for a in (0, 1)], "start": got.pop(" start", 0.0),
            "bias": got.pop(" bias", -40.0), "w": got}


# -- scoring -----------------------------------------------------------------

class _Emit(dict):
    """Word -> emission, filled on demand; starts anew when it grows too large."""

    def __init__(self, weights: dict[str, float], bias: float, most: int = 500_000):
        self.weights, self.bias, self.most = weights, bias, most

    def __missing__(self, token: str) -> float:
        if len(self) >= self.most:
            self.clear()
        get = self.weights.get
        e = math.nan if token in _BREAKS else self.bias + sum(get(f, 0.0) for f in features(token))
        self[token] = e
        return e


def marginals(texts: list[str], model: dict, emits: _Emit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(p, is word, tokens before each text): marginals of all tokens in a row."""
    found = [np.fromiter(map(emits.__getitem__, toks := TOKEN.findall(t)), float, len(toks)) for t in texts]
    sizes = np.array([len(x) for x in found], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    emit = np.concatenate([*found, np.empty(0)])
    doc = np.repeat(np.arange(len(texts)), sizes)
    kept, starts, lengths = sequences(np.isnan(emit), doc)
    fwd, bwd = forward_backward(emit[kept], starts, lengths, np.asarray(model["trans"]), model["start"])
    p = np.zeros(len(emit))
    p[kept] = 1 / (1 + np.exp(-np.clip(fwd + bwd, -40, 40)))
    return p, ~np.isnan(emit), offsets


def score_texts(texts: list[str], model: dict, emits: _Emit) -> list[tuple[float, list[tuple[int, int, float]]]]:
    """Per text: score, and offending spans (start, end, marginal) as offsets.

    The score is the largest token marginal, or with offending spans the
    probability that at least one of them is toxic; it reaches 0.5 exactly when
    there is an offending span.
    """
    p, _, offsets = marginals(texts, model, emits)
    out = []
    for k, text in enumerate(texts):
        own = p[offsets[k]:offsets[k + 1]]
        most = float(own.max()) if len(own) else 0.0
        spans: list[list] = []
        if most >= 0.5:
            bad = set(np.flatnonzero(own >= 0.5).tolist())
            last = -2
            for i, m in enumerate(TOKEN.finditer(text)):
                if i in bad:
                    if last == i - 1:
                        spans[-1][1:] = [m.end(), max(spans[-1][2], float(own[i]))]
                    else:
                        spans.append([m.start(), m.end(), float(own[i])])
                    last = i
            most = 1 - math.prod(1 - s[2] for s in spans)
        out.append((min(1.0, max(0.0, most)), [tuple(s) for s in spans]))
    return out


def _scored(texts: list[str | None], model: dict, emits: _Emit, chars: int = 2_000_000) -> Iterator[tuple]:
    """score_texts over slices of bounded size."""
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(t or "")
        if size >= chars:
            yield from score_texts(part, model, emits)
            part, size = [], 0
    if part:
        yield from score_texts(part, model, emits)


def score_toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted and the offending spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emits = _Emit(shared.value["w"], shared.value["bias"])
        for batch in batches:
            got = list(_scored(batch.column("text").to_pylist(), shared.value, emits))
            spans = [[{"start": a, "end": b, "marginal": m} for a, b, m in s] for _, s in got]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s for s, _ in got], pa.float64()),
                 pa.array([int(s >= 0.5) for s, _ in got], pa.int32()), pa.array(spans, kind)],
                ["doc_id", "score", "predicted", "spans"])

    return pick(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, score double, predicted int, spans array<struct<start:long,end:long,marginal:double>>")


def keep_clean(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns as they are."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emits = _Emit(shared.value["w"], shared.value["bias"])
        for batch in batches:
            got = _scored(batch.column(at).to_pylist(), shared.value, emits)
            yield batch.filter(pa.array([s < 0.5 for s, _ in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def training_rows(labels: DataFrame, modulus: int = 5, held_out: int = 0) -> DataFrame:
    """Label rows outside the held-out fold."""
    return labels.where(~in_fold("doc_id", modulus, held_out))
