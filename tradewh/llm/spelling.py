"""Spelling variants: words one code point apart, by bidirectional FM-index search.

A vocabulary (word, n) stands as one text ``_word_word_…`` in an index of both
its directions: the Burrows-Wheeler ranks of the text and of its reverse, with
one interval of suffixes in each that move together. A word with one error has
one half without any, so each word is searched twice: one half is matched exactly
from the middle to its outer delimiter, and the search then goes on from the
middle across the other half, where one code point may be replaced, added or
missing, up to the other delimiter. All words of a shard with halves of one
length step together, as arrays.

At scale: near words share a half, so words are dealt by their halves. Let a be
the length of the shorter of two near words; they share the first a div 2 code
points or the last a - a div 2. A word is posted under both halves for a equal
to its own length (it finds equally long and longer words) and to one less (it
finds shorter ones): four rows. Postings meet in shards of some ``SHARD`` code
points with an index each. A group of words with one half that is larger than
that is cut into parts and every part meets every part in a cell of its own, so
no task holds more, and none is left out. Tasks return a count and a best word
per posting, never the pairs.

Counting is DataFrame work with partial counts in the scan. Roots follow the
forms by doubling: a form is at least ten times as frequent as its word, so a
chain has at most eighteen links and five joins reach its end.

Defined results: null texts have no words, a null doc_id is the empty text in
the hashed key; words of any length are taken whole; of like counts the word
first in code-point order wins; repeated rows count again; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import string

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tradewh.llm.common import pick
from tradewh.operators.materialize import materialize

LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
#: Code points of the postings that meet in a shard, about.
SHARD = 100_000
#: Cells of a rank table; beyond, ranks are looked up among sorted places.
DENSE = 30_000_000
#: Tasks that the shards are dealt to, at most.
TASKS = 20_000


# -- the index -------------------------------------------------------------------

class Ranks:
    """Ranks of the symbols of one direction: ``smaller[c]`` symbols below c, and
    how many of each symbol stand in the first i rows."""

    def __init__(self, text: np.ndarray, symbols: int):
        n = len(text)
        rank, h = text.astype(np.int64), 1
        while True:  # rotations in order, by doubling the length they are compared by
            key = rank * (n + symbols) + np.roll(rank, -h)
            self.order = np.argsort(key, kind="stable")
            sorted_key = key[self.order]
            new = np.empty(n, np.int64)
            new[self.order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
            rank, h = new, 2 * h
            if rank[self.order[-1]] == n - 1 or h >= 2 * n:
                break
        before = text[self.order - 1]
        self.symbols = symbols
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(before, minlength=symbols))))[:symbols]
        self.table = None
        if (n + 1) * symbols <= DENSE:
            self.table = np.zeros((n + 1, symbols), np.int32)
            self.table[np.arange(1, n + 1), before] = 1
            np.cumsum(self.table, axis=0, out=self.table)
        else:
            self.n, self.places = n + 1, np.sort(before.astype(np.int64) * (n + 1) + np.arange(n))

    def upto(self, i: np.ndarray) -> np.ndarray:
        """(len(i), symbols) counts of the symbols in the first i rows."""
        if self.table is not None:
            return self.table[i].astype(np.int64)
        c = np.arange(self.symbols)
        return np.searchsorted(self.places, c * self.n + i[:, None]) - self.smaller


class Index:
    """Words (bytes, sorted, distinct) between delimiters, in both directions."""

    def __init__(self, words: list[bytes]):
        raw = np.frombuffer(b"\0" + b"\0".join(words), np.uint8)
        present = np.unique(raw)
        self.code = np.zeros(256, np.int64)
        self.code[present] = np.arange(len(present))
        text = self.code[raw]
        self.forward, self.reverse = Ranks(text, len(present)), Ranks(text[::-1].copy(), len(present))
        self.size = len(text)
        self.word_at = np.cumsum(raw == 0) - 1

    def found(self, starts: np.ndarray) -> np.ndarray:
        """The words whose opening delimiter is the text of these forward rows."""
        return self.word_at[self.forward.order[starts]]


def _extended(side: Ranks, lo: np.ndarray, other: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals extended on one side by every symbol: (m, symbols) each."""
    first = side.upto(lo)
    counts = side.upto(lo + size) - first
    return side.smaller + first, other[:, None] + np.cumsum(counts, axis=1) - counts, counts


class States:
    """Searches under way: the query, its interval's start on both sides, its size."""

    def __init__(self, query: np.ndarray, lo: np.ndarray, other: np.ndarray, size: np.ndarray):
        self.query, self.lo, self.other, self.size = query, lo, other, size

    def take(self, side: Ranks, symbol: np.ndarray) -> "States":
        """Those that go on with each one's symbol."""
        if not len(self.query):
            return self
        lo, other, size = _extended(side, self.lo, self.other, self.size)
        at = np.arange(len(self.query))
        keep = size[at, symbol] > 0
        at, symbol = at[keep], symbol[keep]
        return States(self.query[keep], lo[at, symbol], other[at, symbol], size[at, symbol])

    def branch(self, side: Ranks, barred: np.ndarray) -> "States":
        """Those that go on with any symbol but the delimiter and each one's barred one."""
        if not len(self.query):
            return self
        lo, other, size = _extended(side, self.lo, self.other, self.size)
        size[:, 0] = 0
        size[np.arange(len(barred)), barred] = 0
        at, symbol = np.nonzero(size)
        return States(self.query[at], lo[at, symbol], other[at, symbol], size[at, symbol])

    def only(self, keep: np.ndarray) -> "States":
        return States(self.query[keep], self.lo[keep], self.other[keep], self.size[keep])

    def __add__(self, more: "States") -> "States":
        return States(*(np.concatenate((getattr(self, k), getattr(more, k))) for k in ("query", "lo", "other", "size")))


def search(index: Index, words: np.ndarray, half: int, first: bool, shorter: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``words``, word of the index) of all words that differ by one error
    outside the half; ``words``: (m, length) symbols.

    ``first``: the first ``half`` code points are matched exactly, else the last.
    ``shorter``: words with one code point less are found, else those with one
    replaced or one more. In a run of like code points only the last (from the
    exact half) is taken away, and added behind it, so each word is found once.
    """
    m, length = words.shape
    inner, outer = (index.forward, index.reverse) if first else (index.reverse, index.forward)
    exact, rest = (words[:, :half][:, ::-1], words[:, half:]) if first else (words[:, length - half:], words[:, :length - half][:, ::-1])
    query, none = np.arange(m), np.zeros(m, np.int64)
    clean = States(query, none, none, np.full(m, index.size))
    for j in range(half):
        clean = clean.take(inner, exact[clean.query, j])
    clean = clean.take(inner, none[clean.query])
    clean = States(clean.query, clean.other, clean.lo, clean.size)  # from here on the other side is extended
    used = clean.only(np.zeros(len(clean.query), bool))
    r = rest.shape[1]
    rest = np.concatenate((rest, np.zeros((m, 1), np.int64)), axis=1)
    for j in range(r + 1):
        if shorter:
            used = used.take(outer, rest[used.query, j])
            if j < r:
                here = rest[clean.query, j]
                used += clean.only(here != rest[clean.query, j + 1])
        else:
            other = clean.branch(outer, rest[clean.query, j])
            used = used + other
            used = used.take(outer, rest[used.query, j])
            if j < r:
                used += other
        if j < r:
            clean = clean.take(outer, rest[clean.query, j])
    starts = used.other if first else used.lo
    return used.query, index.found(starts)


def near_in_shard(postings: pd.DataFrame) -> pd.DataFrame:
    """word, n_near, form_n, form of each posting that asks and finds any near
    word posted in its own cell."""
    raw = postings["word"].str.encode("latin-1")
    words, place = np.unique(raw.to_numpy(dtype=object), return_inverse=True)
    lengths = np.array([len(w) for w in words])
    index = Index(list(words))
    counts = np.zeros(len(words), np.int64)
    counts[place] = postings["n"].to_numpy()
    cells, cell = np.unique(postings["cell"].to_numpy(), return_inverse=True)
    posted = np.unique((cell * len(words) + place)[postings["indexed"].to_numpy()])
    asked = postings["asked"].to_numpy()
    first, a = postings["first"].to_numpy(), postings["a"].to_numpy()
    found = []
    steps = pd.DataFrame({"first": first, "length": lengths[place], "a": a})[asked].groupby(["first", "length", "a"]).indices
    rows = np.flatnonzero(asked)
    for (is_first, length, shorter), at in steps.items():
        at = rows[at]
        half = shorter // 2 if is_first else shorter - shorter // 2
        symbols = index.code[np.frombuffer(b"".join(words[place[at]]), np.uint8)].reshape(len(at), length)
        query, near = search(index, symbols, half, is_first, shorter < length)
        query = at[query]
        if not is_first:  # the words that share the first half as well are found by it
            k = shorter // 2
            keep = np.array([words[place[q]][:k] != words[w][:k] for q, w in zip(query, near)], bool)
            query, near = query[keep], near[keep]
        own = np.isin(cell[query] * len(words) + near, posted)
        found.append((query[own], near[own]))
    query, near = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))
    order = np.lexsort((near, -counts[near], query))
    query, near = query[order], near[order]
    heads, starts, sizes = np.unique(query, return_index=True, return_counts=True)
    as_text = np.array([w.decode("latin-1") for w in words], object)
    return pd.DataFrame({"word": pd.Series(as_text[place[heads]], dtype=object), "n_near": sizes, "form_n": counts[near[starts]],
                         "form": pd.Series(as_text[near[starts]], dtype=object)})


# -- the vocabulary and its forms ---------------------------------------------------

def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the runs of letters in lower case (A-Z only), every thirty-first
    (by the crc32 of ``doc_id:run``) with one code point taken out."""
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"([{LETTERS}]{{{least_length},}})"), F.lit(1))
    df = pick(docs, doc_id="long", text="string").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(runs).alias("run"))
    df = df.select("d", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    df = df.select("run", F.crc32(F.concat("d", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % 31 == 0, less).otherwise(F.col("run"))
    df = df.select(word.alias("word")).where(F.length("word") >= least_length)
    return df.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _halves(least_length: int) -> Column:
    """The (first, a, half) that a word is posted under."""
    length = F.length("word")
    out = []
    for a in (length, length - 1):
        k = F.floor(a / 2).cast("int")
        out += [F.struct(F.lit(True).alias("first"), a.alias("a"), F.substring(F.col("word"), F.lit(1), k).alias("half")),
                F.struct(F.lit(False).alias("first"), a.alias("a"), F.right(F.col("word"), a - k).alias("half"))]
    return F.filter(F.array(*out), lambda x: x["a"] >= least_length)


def near_words(words: DataFrame, shard: int = SHARD, least_length: int = LEAST_LENGTH) -> DataFrame:
    """Per word of ``words`` (word, n; distinct, in Latin-1): word, n, n_near
    (words one error away), form_n and form (the largest count among them, the
    first word of that)."""
    postings = words.select("word", "n", F.explode(_halves(least_length)).alias("p")).select(
        "word", "n", "p.first", "p.a", F.xxhash64("p.first", "p.a", "p.half").alias("key"))
    large = postings.groupBy("key").agg(F.sum(F.length("word")).alias("size")).where(F.col("size") > shard).select(
        F.col("key").alias("_key"), F.ceil(F.col("size") / shard).cast("int").alias("parts"))
    df = postings.join(large, F.col("key") == F.col("_key"), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    df = df.withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    asks = F.transform(every, lambda i: F.struct(i.alias("i"), F.col("own").alias("j"), F.lit(True).alias("asked"), (i == F.col("own")).alias("indexed")))
    stands = F.transform(F.filter(every, lambda j: j != F.col("own")), lambda j: F.struct(
        F.col("own").alias("i"), j.alias("j"), F.lit(False).alias("asked"), F.lit(True).alias("indexed")))
    df = df.select("word", "n", "first", "a", "key", F.explode(F.concat(asks, stands)).alias("c"))
    df = df.select("word", "n", "first", "a", F.xxhash64("key", "c.i", "c.j").alias("cell"), "c.asked", "c.indexed")
    size = words.agg(F.sum(F.length("word"))).first()[0] or 0  # one number
    shards = max(1, -(-4 * size // shard))
    df = df.withColumn("shard", F.pmod("cell", F.lit(shards))).repartition(min(shards, TASKS), "shard")
    near = df.groupBy("shard").applyInPandas(near_in_shard, "word string, n_near long, form_n long, form string")
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form"))
    near = near.select("word", F.lit(None).cast("long").alias("n"), "n_near", "form_n", "form")
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("k"), F.col("form").alias("form"))))
    out = none.unionByName(near).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    return out.select("word", "n", "n_near", (-F.col("best.k")).alias("form_n"), "best.form")


def forms(near: DataFrame, times: int = TIMES) -> DataFrame:
    """word, n, n_near, form_n, form, root: the form only where it is at least
    ``times`` as frequent as its word; the root at the end of the forms."""
    has = F.col("form_n") >= times * F.col("n")
    near = materialize(near.withColumns({"form": F.when(has, F.col("form")), "form_n": F.when(has, F.col("form_n"))}), "word-forms")
    links = near.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    hops = 1
    while times ** hops < 1 << 63:  # a count is below 2 ** 63, and each link multiplies it
        further = links.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        step = links.join(further, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved"))
        step = materialize(step, "word-roots")
        links, hops = step.drop("moved"), 2 * hops
        if step.where("moved").isEmpty():
            break
    roots = links.select(F.col("word").alias("_w"), "root")
    return near.join(roots, F.col("word") == F.col("_w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of ``docs``."""
    return forms(near_words(materialize(vocabulary(docs), "words"), shard))
