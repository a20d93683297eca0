"""LM scoring: subword lattice likelihood.

A word's lattice has an arc for every piece of an existing vocabulary that
matches in it, weighed by the piece's probability. A word's probability is the
sum over all its segmentations, by forward recursion in log space; a text's is
the product over its words (no piece reaches over a word's end) and an end,
whose probability is learned. A piece that starts a word (its mark) is what ends
the word before.

The vocabulary file ranks its pieces and states no probabilities: they are
Zipf's law on the rank. ``rounds`` of expectation maximisation over all distinct
training words can re-estimate them (none by default).

Beside the score stand the add-one word unigram ``base_score`` and
``score_mixed``, which shares the probability of the words between the lattices
(``DISCOUNT`` of each distinct word's count) and whole words by their discounted
frequency in training.

1. Counts: tasks count words in a table of bounded size and hand on (word,
   times in training, times in all); an aggregate adds them up. This table
   grows with the corpus and is never broadcast or collected.
2. Every distinct word gets its lattice probability once.
3. Texts: the ``FREQUENT`` most frequent words (a bounded table: a word of more
   than ``FREQUENT_BYTES`` bytes stands there as its digest) are looked up in the
   tasks; only the rare words go through a join on the word. So no join key is hot.

Defined results: a null or empty text is the end alone; words and texts of any
length are taken whole; rows without an id belong to training; repeated rows
count and are scored once each; of equally frequent words all or none are looked
up, the scores are the same; without training tokens only the end's probability
is another; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tradewh.llm.common import pick
from tradewh.llm.pieces import VOCABULARY, Vocabulary, vocabulary
from tradewh.operators.materialize import materialize

ROUNDS = 0
DISCOUNT = 0.75
FREQUENT = 100_000
FREQUENT_BYTES = 64
#: Pieces count as often as this many by Zipf's law before the corpus is seen.
PRIOR = 1000.0
_LOG10 = math.log(10)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words between white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


# -- lattices ----------------------------------------------------------------

class PieceTrie:
    """All pieces made of ``CHARS`` characters (Latin-1, and the most used
    others), as a table (node, character) -> node, so that the words of a batch
    walk in step.

    Node 0 is the root, the last one a dead end.
    """

    CHARS = 250

    def __init__(self, v: Vocabulary):
        counts = Counter(c for p in v.ids for c in p)
        used = sorted(counts, key=lambda c: (ord(c) > 255, -counts[c], c))[:self.CHARS]
        self.cls = np.zeros(0x110000, np.uint8)  # 0: any other character
        for k, c in enumerate(used, 1):
            self.cls[ord(c)] = k
        self.other = re.compile(f"[^{re.escape(''.join(used))}]").search
        own = [(p, i) for p, i in v.ids.items() if all(self.cls[ord(c)] for c in p)]
        steps: dict[tuple[int, int], int] = {}
        ends: list[int] = [-1]
        for piece, i in own:
            node = 0
            for c in piece:
                key = (node, int(self.cls[ord(c)]))
                if key not in steps:
                    steps[key] = len(ends)
                    ends.append(-1)
                node = steps[key]
            ends[node] = i
        self.dead, self.width = len(ends), self.CHARS + 1
        self.piece = np.array(ends + [-1], np.int32)
        self.step = np.full((self.dead + 1) * self.width, self.dead, np.int32)
        for (node, c), to in steps.items():
            self.step[node * self.width + c] = to


_TRIES: dict[int, PieceTrie] = {}


def _trie(v: Vocabulary) -> PieceTrie:
    if id(v) not in _TRIES:
        _TRIES[id(v)] = PieceTrie(v)
    return _TRIES[id(v)]


def _edges(words: list[str], v: Vocabulary) -> Iterator[tuple[int, int, np.ndarray]]:
    """(i, j, piece of characters i to j of each word, or -1) for words of one
    length; spans longer than one character that no word has a piece for may be
    left out."""
    n, get, trie = len(words[0]), v.ids.get, _trie(v)
    codes = np.array(words, dtype=f"U{n}").view(np.uint32).reshape(len(words), n)
    cls = trie.cls[codes]
    if (cls == 0).any() or (codes == 0).any():  # rare characters: look pieces up one by one
        for j in range(1, n + 1):
            for i in range(max(0, j - v.longest), j):
                yield i, j, np.fromiter(map(get, [w[i:j] for w in words], repeat(-1)), np.int32, len(words))
        return
    cls = np.ascontiguousarray(cls.T).astype(np.int64)
    for i in range(n):
        node = np.zeros(len(words), np.int64)
        for j in range(i + 1, min(n, i + v.longest) + 1):
            node = trie.step[node * trie.width + cls[j - 1]].astype(np.int64)
            yield i, j, trie.piece[node]
            if (node == trie.dead).all():
                break


def _spelling(words: list[str], j: int, unknown: np.ndarray, v: Vocabulary, lp: np.ndarray) -> np.ndarray:
    """Log probability of the bytes of character j - 1, where it has no piece."""
    out = np.full(len(words), -np.inf)
    for k in np.flatnonzero(unknown).tolist():
        out[k] = sum(lp[v.bytes_[b]] for b in words[k][j - 1].encode("utf-8", "surrogatepass"))
    return out


def lattice(words: list[str], v: Vocabulary, lp: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probabilities of words of one length; with weights, also the expected
    times each piece occurs in them. ``lp`` ends with -inf for "no piece"."""
    n, size = len(words[0]), len(words)
    into: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(n + 1)]
    out_of: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(n + 1)]
    for i, j, ids in _edges(words, v):
        missing = ids < 0
        if i < j - 1 and missing.all():
            continue
        s = lp[ids]
        if i == j - 1 and missing.any():
            s = np.where(missing, _spelling(words, j, missing, v, lp), s)
        into[j].append((i, ids, s))
        out_of[i].append((j, s))
    fwd, bwd = np.zeros((n + 1, size)), np.zeros((n + 1, size))
    for j in range(1, n + 1):
        fwd[j] = _log_sum([fwd[i] + s for i, _, s in into[j]])
    if weights is None:
        return fwd[n], None
    for i in range(n - 1, -1, -1):
        bwd[i] = _log_sum([bwd[j] + s for j, s in out_of[i]])
    all_ids, all_post, spelt = [], [], Counter()
    for j in range(1, n + 1):
        ahead = bwd[j] - fwd[n]
        for i, ids, s in into[j]:
            post = np.exp(fwd[i] + s + ahead) * weights
            all_ids.append(ids)
            all_post.append(post)
            if i == j - 1:
                for k in np.flatnonzero((ids < 0) & (post > 0)).tolist():
                    for b in words[k][j - 1].encode("utf-8", "surrogatepass"):
                        spelt[v.bytes_[b]] += post[k]
    # "No piece" is -1, one before the first: shifted to 0 and left out.
    expected = np.append(np.bincount(np.concatenate(all_ids) + 1, np.concatenate(all_post), len(lp))[1:], 0.0)
    for piece, times in spelt.items():
        expected[piece] += times
    return fwd[n], expected


def _log_sum(rows: list[np.ndarray]) -> np.ndarray:
    """log of the sum of exp of each column; every column has a finite row."""
    m = np.stack(rows)
    top = m.max(0)
    return top + np.log(np.exp(m - top).sum(0))


def word_logp(words: list[str], v: Vocabulary, lp: np.ndarray, weights: np.ndarray | None = None, most: int = 4096,
              cells: int = 4_000_000) -> tuple[np.ndarray, np.ndarray | None]:
    """``lattice`` over words of any lengths; a group has one length and at most
    ``most`` words (fewer, if long)."""
    by_size = defaultdict(list)
    other = _trie(v).other
    for k, w in enumerate(words):  # words of characters that the trie knows, apart from others
        by_size[len(w), other(w) is None].append(k)
    out, expected = np.zeros(len(words)), None if weights is None else np.zeros(len(lp))
    for (n, _), at in by_size.items():
        step = max(1, min(most, cells // ((n + 1) * 16)))
        for a in range(0, len(at), step):
            part = at[a:a + step]
            got, e = lattice([words[k] for k in part], v, lp, None if weights is None else weights[part])
            out[part] = got
            if e is not None:
                expected += e
    return out, expected


# -- fit ---------------------------------------------------------------------

def word_counts(docs: DataFrame, training: Column, flush: int = 300_000) -> DataFrame:
    """word, c (times in training rows), n (times in all), and on a row with a null word the numbers of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = (Counter(), Counter()), [0, 0]

        def give() -> pa.RecordBatch:
            keys = list({*counts[0], *counts[1]})
            c = [counts[1][k] for k in keys]
            n = [counts[0][k] + x for k, x in zip(keys, c)]
            return pa.RecordBatch.from_arrays([pa.array([k.decode("utf-8", "replace") for k in keys] + [None], pa.string()),
                                               pa.array(c + [rows[1]], pa.int64()), pa.array(n + [sum(rows)], pa.int64())], ["word", "c", "n"])

        for batch in batches:
            for text, learn in zip(batch.column("text").to_pylist(), batch.column("learn").to_pylist()):
                counts[learn].update(words_of(text))
                rows[learn] += 1
                if len(counts[0]) + len(counts[1]) >= flush:
                    yield give()
                    counts, rows = (Counter(), Counter()), [0, 0]
        yield give()

    rows = docs.select("text", training.alias("learn")).mapInArrow(run, "word string, c long, n long")
    return rows.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def _log_table(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.append(np.log(p), -np.inf)


def fit(words: DataFrame, rounds: int = ROUNDS, name: str = VOCABULARY, prior: float = PRIOR) -> np.ndarray:
    """Log probability by piece, with -inf behind the last."""
    zipf = np.exp(np.array(vocabulary(name).logp))
    p, spark = zipf, words.sparkSession

    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(_log_table(p))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            v, total = vocabulary(name), np.zeros(len(shared.value))
            for batch in batches:
                own = [" " + w for w in batch.column("word").to_pylist()]
                total += word_logp(own, v, shared.value, np.ones(len(own)))[1]
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.float64())], ["piece", "times"])

        seen = words.where("c > 0").select("word").mapInArrow(run, "piece int, times double")
        # One row per piece of the vocabulary at most.
        rows = seen.groupBy("piece").agg(F.sum("times").alias("times")).orderBy("piece").toPandas()
        shared.unpersist()
        times = prior * zipf
        times[rows["piece"].to_numpy(np.int64)] += rows["times"].to_numpy()
        p = times / times.sum()
    return _log_table(p)


# -- scoring -----------------------------------------------------------------

def _most_frequent(words: DataFrame, most: int) -> DataFrame:
    """The words of the largest counts, ``most`` at most: counts are grouped by
    their logarithm (a thousand groups or so), and all groups above a limit are
    taken, so nothing is sorted and no task sends more than the rows it keeps."""
    level = F.floor(F.log2("n") * 16)
    sizes = words.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("level")).collect()
    least, total = math.inf, 0
    for r in sizes:
        total += r["rows"]
        if total > most:
            break
        least = r["level"]
    return words.where(level >= F.lit(float(least)))


def score_documents(docs: DataFrame, training: Column, rounds: int = ROUNDS, name: str = VOCABULARY, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, learned, n_tokens, n_known, train_tokens, base_score, score, score_mixed; a row per row of ``docs``.

    ``training`` is a condition on ``doc_id``.
    """
    spark = docs.sparkSession
    docs = pick(docs, doc_id="long", text="string")
    counted = materialize(word_counts(docs, training), "words")
    sums = counted.agg(F.sum("c"), F.count(F.when((F.col("c") > 0) & F.col("word").isNotNull(), 1)),
                       F.sum(F.when(F.col("word").isNull(), F.col("c")))).first()
    docs_learned = int(sums[2] or 0)
    total = int(sums[0] or 0)  # words and ends
    types = int(sums[1] or 0) + (docs_learned > 0)
    # log10((c + 1) / low) for a token seen c times
    low = math.log10(total + types + 1)
    words = counted.where("word IS NOT NULL")
    table = spark.sparkContext.broadcast(fit(words, rounds, name))
    # Of the words' probability, what whole-word arcs give away to the pieces.
    n_words, n_types = total - docs_learned, types - (docs_learned > 0)
    given = DISCOUNT * n_types / n_words if n_words else 1.0
    p_end = (docs_learned + 1) / (total + 2)
    end, rest = math.log(p_end), math.log1p(-p_end)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(name)
        for batch in batches:
            got, _ = word_logp([" " + w for w in batch.column("word").to_pylist()], v, table.value)
            whole = np.maximum(batch.column("c").to_numpy() - DISCOUNT, 0.0) / max(1, n_words)
            with np.errstate(divide="ignore"):
                mixed = rest + np.logaddexp(got + math.log(given), np.log(whole))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), batch.column("n"), pa.array((rest + got) / _LOG10),
                                              pa.array(mixed / _LOG10)], ["word", "c", "n", "lp", "mixed"])

    rated = materialize(words.mapInArrow(rate, "word string, c long, n long, lp double, mixed double"), "rated")
    # FREQUENT rows of FREQUENT_BYTES bytes at most: bounded whatever the corpus holds.
    raw = F.encode("word", "UTF-8")
    key = F.when(F.octet_length("word") <= FREQUENT_BYTES, raw).otherwise(F.concat(F.lit(b" "), F.unhex(F.md5(raw))))
    top = _most_frequent(rated, frequent).select(key.alias("key"), "c", "lp", "mixed").toPandas()
    known = {bytes(w): k for k, w in enumerate(top["key"])}
    top_c = top["c"].to_numpy(np.int64)
    often = spark.sparkContext.broadcast((known, top_c > 0, np.log10(top_c + 1.0) - low, top["lp"].to_numpy(float), top["mixed"].to_numpy(float)))
    base_end, end = math.log10(docs_learned + 1) - low, end / _LOG10

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, base, score, mixed = often.value
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                at = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
                rare = []
                for k in np.flatnonzero(at < 0).tolist():
                    if len(words[k]) > FREQUENT_BYTES and (found := known.get(b" " + hashlib.md5(words[k]).digest())) is not None:
                        at[k] = found
                    else:
                        rare.append(words[k].decode("utf-8", "replace"))
                at = at[at >= 0]
                row = (len(words) + 1, int(seen[at].sum()) + (docs_learned > 0), float(base[at].sum()) + base_end,
                       float(score[at].sum()) + end, float(mixed[at].sum()) + end, rare)
                for col, x in zip(out, row):
                    col.append(x)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(c, k) for c, k in zip(out, kinds)],
                                             ["doc_id", "n_tokens", "n_seen", "base", "lm", "lm_mixed", "rare"])

    parts = docs.mapInArrow(run, "doc_id long, n_tokens long, n_seen long, base double, lm double, lm_mixed double, rare array<string>")
    parts = materialize(parts.withColumn("row", F.monotonically_increasing_id()), "lm-parts")
    looked = parts.select("row", F.explode("rare").alias("word")).join(rated.select("word", "c", "lp", "mixed"), "word")
    more = looked.groupBy("row").agg(F.count(F.when(F.col("c") > 0, 1)).alias("n2"),
                                     F.sum(F.log10(F.col("c") + 1.0) - F.lit(low)).alias("b2"), F.sum("lp").alias("s2"), F.sum("mixed").alias("m2"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return parts.drop("rare").join(more, "row", "left").select(
        "doc_id", training.alias("learned"), "n_tokens", (F.col("n_seen") + zero(F.col("n2"))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + zero(F.col("b2"))).alias("base_score"),
        (F.col("lm") + zero(F.col("s2"))).alias("score"), (F.col("lm_mixed") + zero(F.col("m2"))).alias("score_mixed"))
