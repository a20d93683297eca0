"""Spelling variants against edit distances of all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tradewh.llm import queries, spelling


def one_off(a, b):
    """Whether one inserted, deleted or replaced code point turns a into b."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def wildcards(w):
    return [(len(w), i, w[:i] + w[i + 1:]) for i in range(len(w))] + [(len(w) + 1, i, w) for i in range(len(w) + 1)]


def brute(counts):
    """word -> (form, root, n, n_near, form_n); near words share a text with one place open."""
    groups = {}
    for w in counts:
        for k in wildcards(w):
            groups.setdefault(k, set()).add(w)
    near = {w: {v for k in wildcards(w) for v in groups[k] if one_off(w, v)} for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts}


def counted(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def got(df):
    rows = df.collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def random_words(rng, n, letters="abß", longest=11):
    return {"".join(rng.choices(letters, k=rng.randint(7, longest))): rng.choice([2, 3, 30, 30, 400, 5000]) for _ in range(n)}


def test_ranks_of_both_kinds_count_symbols(monkeypatch):
    rng = random.Random(1)
    text = np.array([rng.randint(0, 3) for _ in range(200)] + [4])
    dense = spelling.Ranks(text, 5)
    monkeypatch.setattr(spelling, "DENSE", 0)
    sparse = spelling.Ranks(text, 5)
    rows = sorted(range(len(text)), key=lambda i: [*text[i:], *text[:i]])
    assert dense.order.tolist() == rows == sparse.order.tolist()
    before = [text[i - 1] for i in rows]
    want = [[before[:i].count(c) for c in range(5)] for i in range(len(text) + 1)]
    at = np.arange(len(text) + 1)
    assert dense.upto(at).tolist() == want == sparse.upto(at).tolist()


@pytest.mark.parametrize("letters", ["a", "ab", "abÿ", "abcdefgh"])
def test_search_finds_each_word_with_one_error_once(letters):
    rng = random.Random(2)
    words = sorted({"".join(rng.choices(letters, k=rng.randint(7, 10))).encode("latin-1") for _ in range(150)})
    index = spelling.Index(words)
    for length in {len(w) for w in words}:
        mine = [w for w in words if len(w) == length]
        symbols = np.array([list(w) for w in mine])
        symbols = index.code[symbols]
        for a in (length, length - 1):
            for first in (True, False):
                half = a // 2 if first else a - a // 2
                query, near = spelling.search(index, symbols, half, first, a < length)
                pairs = Counter((mine[q], words[w]) for q, w in zip(query, near))
                same = (lambda x, y: x[:half] == y[:half]) if first else (lambda x, y: x[-half:] == y[-half:])
                want = {(x, y) for x in mine for y in words if one_off(x, y) and same(x, y) and (len(y) < length) == (a < length)}
                assert set(pairs) == want and all(n == 1 for n in pairs.values())


@pytest.mark.parametrize("shard", [60, 500, 100_000])
def test_near_words_of_hot_halves(spark, shard):
    """Two letters give few halves, so groups are larger than small shards."""
    rng = random.Random(3)
    words = random_words(rng, 400, "ab") | random_words(rng, 150, "abÿ×") | {"prefixx" + c: 2 for c in "abcdefghijkl"} | {"x" * 3000: 9, "x" * 3001: 100}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(spelling.forms(spelling.near_words(table, shard))) == brute(words)


def test_chains_of_forms_have_one_root(spark):
    words = {"abcdefg" + "h" * k: 3 * 10 ** k for k in range(13)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    out = got(spelling.forms(spelling.near_words(table)))
    assert out == brute(words) and {r[1] for r in out.values()} == {"abcdefg" + "h" * 12}


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(counted(docs))
    assert got(queries.op11_spelling_variants(spark, SF)) == want and any(r[0] for r in want.values())


def test_edges(spark, docs, no_docs):
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(spelling.variants(docs)) == brute(counted(texts))
    assert spelling.variants(no_docs).collect() == []
    extra = docs.limit(0).select(F.lit(1).cast("long").alias("doc_id"), F.lit("").alias("text"))
    odd = spark.createDataFrame([(None, "Straßen-straßen STRASSEN strassen Strassenx ÀÀÀÀÀÀÀÀ àààààààà ÀÀÀÀÀÀÀÀ àààààààà×÷" * 40), (2, None)], "doc_id long, text string")
    assert got(spelling.variants(extra.unionByName(odd))) == brute(counted([(None, odd.first()["text"]), (2, None)]))


def test_shard_without_near_words():
    rows = pd.DataFrame({"word": ["abcdefg"], "n": [2], "first": [True], "a": [7], "cell": [1], "asked": [True], "indexed": [True]})
    assert len(spelling.near_in_shard(rows)) == 0
