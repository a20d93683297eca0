"""Per-text operators (licence scan, quality, SentencePiece, toxicity, LM) against brute force."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF, TEXTS
from tradewh.llm import lattice_lm, licenses, pieces, quality, queries, toxicity


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# -- licence scan ------------------------------------------------------------

def brute_licence(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_licence_base_equals_brute_force(documents, docs):
    extra = documents.sparkSession.createDataFrame(
        [(-1, "CC-BY cc by CC by. All Rights\nReserved all rights reserved"), (-2, "general public license general public license"),
         (-3, "cc cc by all rights all rights reserved general public public license")], "doc_id long, text string")
    all_docs = documents.select("doc_id", "text").unionByName(docs.select("doc_id", "text")).unionByName(extra)
    got = licenses.scan_licenses(all_docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    want = [(r["doc_id"], *brute_licence(r["text"])) for r in all_docs.collect()]
    assert plain(got) == plain(want)


def test_licences_of_an_empty_table(no_docs):
    assert licenses.scan_licenses(no_docs).collect() == []


def test_automaton_matching_statistics_equal_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        seqs = [[rng.randint(1, 3) for _ in range(rng.randint(1, 7))] for _ in range(rng.randint(1, 4))]
        auto = licenses.Automaton(seqs)
        text = [rng.randint(1, 4) for _ in range(20)]
        subs = {tuple(s[i:j]): 0 for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        state = n = 0
        for e, c in enumerate(text, 1):
            state, n = auto.step(state, n, c)
            want = max((k for k in range(e + 1) if tuple(text[e - k:e]) in subs), default=0)
            assert n == want
            if n:
                own = tuple(text[e - n:e])
                ends = {(t, i + n) for t, s in enumerate(seqs) for i in range(len(s)) if tuple(s[i:i + n]) == own}
                assert set(auto.ends[state]) == ends


def test_licence_templates_label_texts_and_give_spans():
    s = licenses.Scanner()
    for label, texts in licenses.TEMPLATES.items():
        for t in texts:
            lead = "some prose before it "
            got = s.scan(licenses.words_of(f"{lead}{t} and prose behind"))["spans"]
            mine = [x for x in got if x[2] == label and x[3] == 1.0]
            assert (4, 4 + len(licenses.words_of(t))) in [(a, b) for a, b, _, _ in mine]
    changed = "Permission is hereby granted, free of charge, to anyone obtaining a copy of this software and its documentation files, to deal in the Software without restriction"
    assert "mit" in [x[2] for x in s.scan(licenses.words_of(changed))["spans"]]
    assert s.scan(licenses.words_of("the permission of the copy is hereby without files and in the software"))["spans"] == []


def test_licences_outside_the_list_get_no_label():
    s = licenses.Scanner()
    label = lambda t: licenses._digest(s, t)[5]
    for name in ["Eclipse Public License 2.0", "Mozilla Public License", "ISC License", "Artistic License", "EUPL", "terms of the agreement"]:
        for lead in ["Licensed under the", "Released under the", "This work is licensed under the"]:
            assert label(f"{lead} {name} and more") == "" and licenses._digest(s, f"{lead} {name}")[6] == 0
    assert label("licensed under a Creative Commons Attribution-NonCommercial 4.0 International License") == ""
    assert label("Licensed under the Eclipse License. See the MIT Press catalogue") == ""
    assert label("under the terms of the GNU Library General Public License") == "gpl"
    assert label("Released under the GNU General Public License") == "gpl"
    for text, want in [("Licensed under the terms of the MIT License", "mit"), ("licensed under the BSD 3-clause License", "bsd"),
                       ("licensed under the new BSD license", "bsd"),
                       ("Licensed under the Apache License version 2", "apache-2.0"),
                       ("Licensed under the Eclipse License. Licensed under the MIT License.", "mit"),
                       ("licensed under the Creative Commons Attribution License", "cc-by"),
                       ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa")]:
        assert label(text) == want


def test_phrases_of_one_word():
    s = licenses.Scanner(phrases={"gplv3": "gpl", "all rights reserved": "reserved"})
    got = licenses._digest(s, "Code is GPLv3 here, gplv3 gplv3; all rights reserved gplv3")
    assert got[1:5] == (5, 2, 9, "gpl,reserved")
    assert licenses._digest(s, "gplv3")[1:5] == (1, 0, 0, "gpl") and licenses._digest(s, "none here")[1] == 0


# -- quality -----------------------------------------------------------------

def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    marked = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked),
            len(words) < 20 or 100 * len(marked) > 30 * len(words))


def test_quality_base_equals_brute_force(documents, docs):
    extra = documents.sparkSession.createDataFrame(
        [(-1, "a b c d e f g h i " * 4), (-2, "a a a a a a a a a"), (-3, "x\n x\nx\n\n\nx \nx")], "doc_id long, text string")
    all_docs = documents.select("doc_id", "text").unionByName(docs.select("doc_id", "text")).unionByName(extra)
    got = quality.quality_report(all_docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert plain(got) == plain([(r["doc_id"], *brute_quality(r["text"])) for r in all_docs.collect()])


def test_quality_rules_and_verdicts(docs, no_docs):
    fails = {"Home | About | News | Contact": "navigation", "an%%% odd&&& line$$$ of### symbols***": "symbols",
             "STOP!! THIS!! NOW!!": "shouting", "We use cookies on this site": "boilerplate",
             "word word word word word word word": "stutter", "eight words or more but no mark behind any": "punctuation"}
    for line, rule in fails.items():
        assert quality.line_failure(line) == rule
    for line in ("", "A plain sentence of words, and its end.", "A heading", "Call +1 (555) 555-0199 now. Ask for someone who knows it"):
        assert quality.line_failure(line) is None
    good = "A plain sentence of ten words stands here in line one.\n" * 1 + "Another plain sentence of some more words stands in line two."
    bad = good + "\n" + "\n".join(f"Nav {i} | a | b | c | d | e | f | g | h" for i in range(6))
    assert quality.judge(good)["kept"] and not quality.judge(bad)["kept"]
    assert "Nav" not in quality.judge(bad)["clean_text"]
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect() if r["doc_id"]) == [1, 5, 5]
    assert quality.keep_good(no_docs).count() == quality.quality_report(no_docs).count() == 0


def test_quality_against_labels(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op2_quality_rules(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = got.where("not base_failed").select("kept", "quality").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) >= 0.98 * len(rows) and d.count() >= len(rows)


# -- SentencePiece -----------------------------------------------------------

def brute_viterbi(text, v):
    """Best score over the whole text at once."""
    t = " " + text
    best = [0.0] + [-math.inf] * len(t)
    for j in range(1, len(t) + 1):
        for i in range(max(0, j - v.longest), j):
            if (p := v.ids.get(t[i:j])) is not None:
                best[j] = max(best[j], best[i] + v.logp[p])
        if t[j - 1] not in v.ids:
            best[j] = max(best[j], best[j - 1] + sum(v.logp[v.bytes_[b]] for b in t[j - 1].encode()))
    return best[-1]


def test_sentencepiece_scores_equal_viterbi_over_the_whole_text(documents):
    coder = pieces.PieceEncoder()
    texts = [t for _, t in TEXTS if t and len(t) < 10_000] + [" a", "a ", "  ", "a   b", "▁a ▁", "日本 語\n\n", "a▁ b", "<s> </s> <0x0A>"]
    texts += [r["text"] for r in documents.where("length(text) < 3000").limit(20).collect()]
    for t in texts:
        ids = np.frombuffer(coder.encode(t), np.uint32)
        assert coder.decode(ids.tobytes()) == t
        assert sum(coder.v.logp[i] for i in ids) == pytest.approx(brute_viterbi(t, coder.v), abs=1e-6)


def test_sentencepiece_round_trip_of_all(spark, docs, no_docs):
    got = queries.op3_sentencepiece(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.where("not round_trip").isEmpty()
    edge = {(r["doc_id"], r["n_pieces"] > 0, r["round_trip"]) for r in pieces.encode_documents(docs).collect()}
    assert (2, False, True) in edge and (3, False, True) in edge and (7, True, True) in edge and all(x[2] for x in edge)
    assert pieces.encode_documents(no_docs).count() == 0


def test_sentencepiece_starts_anew_when_full():
    small, large = pieces.PieceEncoder(most=5), pieces.PieceEncoder()
    for t in ("a b c d e f g h", "i j k a b", "a b c d e f g h"):
        assert small.encode(t) == large.encode(t)


# -- toxicity ----------------------------------------------------------------

def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 8):
        emit, trans, start = rng.normal(size=n), rng.normal(size=(2, 2)), 0.7
        weight = {y: math.exp(sum(e for e, b in zip(emit, y) if b) + start * y[0] + sum(trans[a, b] for a, b in zip(y, y[1:])))
                  for y in itertools.product((0, 1), repeat=n)}
        want = [sum(w for y, w in weight.items() if y[k]) / sum(weight.values()) for k in range(n)]
        fwd, bwd = toxicity.forward_backward(np.concatenate([emit, emit[:1]]), np.array([n, 0]), np.array([1, n]), trans, start)
        assert np.allclose(1 / (1 + np.exp(-(fwd + bwd)))[:n], want)


def test_sequences_cover_every_word_once():
    rng = np.random.default_rng(1)
    for _ in range(50):
        size = int(rng.integers(1, 400))
        br, doc = rng.random(size) < rng.choice([0.0, 0.05, 0.6]), np.sort(rng.integers(0, 3, size))
        kept, starts, lengths = toxicity.sequences(br, doc)
        at = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, lengths)]) if len(kept) else kept
        assert np.array_equal(kept, np.flatnonzero(~br)) and np.array_equal(at, np.arange(len(kept)))
        # Sequences end where a break or another document follows, and nowhere else.
        ends = kept[(starts + lengths - 1)] if len(kept) else kept
        assert all(e + 1 == size or br[e + 1] or doc[e + 1] != doc[e] for e in ends)


@pytest.mark.parametrize("scale", [1.0, 30.0])
def test_long_sequences_are_one_chain(scale):
    rng = np.random.default_rng(5)
    lengths = np.array([1, 64, 65, 300, 128, 2, 129, 1000, 63])
    starts = np.cumsum(lengths) - lengths
    emit, trans, start = rng.normal(size=lengths.sum()) * scale, rng.normal(size=(2, 2)) * 2, -1.5
    fwd, bwd = toxicity.forward_backward(emit, starts, lengths, trans, start)
    for at, n in zip(starts, lengths):
        e = emit[at:at + n]
        f = [np.array([0.0, e[0] + start])]
        for x in e[1:]:
            f.append(np.logaddexp(f[-1][0] + trans[0], f[-1][1] + trans[1]) + np.array([0.0, x]))
        b = [np.zeros(2)]
        for x in e[:0:-1]:
            z = b[-1] + np.array([0.0, x])
            b.append(np.logaddexp(trans[:, 0] + z[0], trans[:, 1] + z[1]))
        want = np.array([x[1] - x[0] + y[1] - y[0] for x, y in zip(f, b[::-1])])
        got = (fwd + bwd)[at:at + n]
        p = lambda v: 1 / (1 + np.exp(-np.clip(v, -40, 40)))
        assert np.allclose(p(got), p(want), rtol=1e-9, atol=1e-12)


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op5_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").select("toxic", "predicted").collect()
    hit = Counter((r["toxic"], r["predicted"]) for r in rows)
    assert hit[0, 1] <= 0.02 * (hit[0, 0] + hit[0, 1])
    assert hit[1, 1] >= 0.9 * (hit[1, 1] + hit[1, 0])


def test_toxicity_spans_and_edges(spark, docs, no_docs):
    rng = random.Random(9)
    prose = lambda: " ".join(rng.choices("some plain words that any text may hold in whatever order they come".split(), k=12))
    toxic = [(100 + i, f"{prose()} gnurf {prose()}. {prose()}.") for i in range(40)]
    clean = [(200 + i, f"{prose()} and {prose()}. {prose()}.") for i in range(40)]
    train = spark.createDataFrame(toxic + clean, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 200)) for i, _ in toxic + clean] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(train, labels)
    got = toxicity.score_toxicity(spark.createDataFrame([(1, "ok then. what a gnurf, no?")], "doc_id long, text string"), model).first()
    assert got["predicted"] == 1 and any("ok then. what a gnurf, no?"[s["start"]:s["end"]] == "gnurf" for s in got["spans"])
    edge = toxicity.score_toxicity(docs, model).collect()
    assert len(edge) == len(TEXTS) and all(0 <= r["score"] < 0.5 for r in edge)
    assert all(r["score"] == 0 for r in edge if r["doc_id"] in (2, 3, 6))
    assert toxicity.score_toxicity(no_docs, model).count() == 0
    assert toxicity.keep_clean(docs, model).columns == docs.columns and toxicity.keep_clean(docs, model).count() == len(TEXTS)
    # Labels of absent documents don't use up the sample.
    absent = labels.unionByName(spark.range(10_000, 14_000).select("id", (F.col("id") % 2).cast("int")).toDF("doc_id", "toxic"))
    few = toxicity.fit_toxicity(train, absent, fit_docs=100)
    assert toxicity.score_toxicity(train.where("doc_id < 200"), few).where("predicted = 1").count() == 40
    none = toxicity.fit_toxicity(train, labels.where("false"))
    assert all(r["score"] < 1e-6 for r in toxicity.score_toxicity(train, none).collect())


# -- lattice LM --------------------------------------------------------------

def segmentations(word, v):
    if not word:
        yield []
    for j in range(1, len(word) + 1):
        if (p := v.ids.get(word[:j])) is not None:
            head = [p]
        elif j == 1:
            head = [v.bytes_[b] for b in word[0].encode()]
        else:
            continue
        for tail in segmentations(word[j:], v):
            yield head + tail


def test_lattice_equals_sum_over_segmentations():
    v = pieces.vocabulary()
    lp = np.append(np.array(v.logp), -np.inf)
    words = [" the", " thing", " é日", " a", " " + "ab" * 4, " ☃x"]
    got, expected = lattice_lm.word_logp(words, v, lp, np.ones(len(words)))
    times = np.zeros(len(lp))
    for w, g in zip(words, got):
        segs = list(segmentations(w, v))
        ps = [math.exp(sum(lp[i] for i in s)) for s in segs]
        assert g == pytest.approx(math.log(sum(ps)), abs=1e-9)
        for s, p in zip(segs, ps):
            for i in s:
                times[i] += p / sum(ps)
    assert np.allclose(expected, times)


def test_lm_base_equals_brute_force(spark, docs):
    rows = [r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [r for r in docs.select("doc_id", "text").collect()]
    low = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter()
    for i, t in rows:
        if not held(i):
            c.update(low(t) + [None])
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(low(t)) + 1, sum(c[w] > 0 for w in low(t) + [None]), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in low(t) + [None]), 5)) for i, t in rows)
    from tradewh.llm.common import in_fold

    table = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string")
    for frequent in (100_000, 50):  # all words looked up, or nearly all joined
        got = lattice_lm.score_documents(table, ~in_fold("doc_id", 7, 2), frequent=frequent).collect()
        assert sorted((str(r["doc_id"]), not r["learned"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got) == want
        assert all(r["score"] < 0 for r in got)


def word_likelihood(word, v, known={}):
    """Log of the sum over all segmentations, from the word's end to its start."""
    if word not in known:
        ahead = [0.0] * (len(word) + 1)
        for i in range(len(word) - 1, -1, -1):
            ways = [v.logp[p] + ahead[j] for j in range(i + 1, min(len(word), i + v.longest) + 1) if (p := v.ids.get(word[i:j])) is not None]
            if v.ids.get(word[i]) is None:
                ways.append(sum(v.logp[v.bytes_[b]] for b in word[i].encode()) + ahead[i + 1])
            ahead[i] = max(ways) + math.log(sum(math.exp(w - max(ways)) for w in ways))
        known[word] = ahead[0]
    return known[word]


def test_lm_scores_equal_brute_force(spark, docs):
    """Whole scores of whole texts: the vocabulary's scores over all segmentations, and
    the mixture with whole words; frequent long words are looked up as well."""
    long = "z" * 70 + "é"
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("length(text) < 3000").collect()]
    rows += [(900_000 + i, f"{long} {long} the {'q' * (60 + i)}") for i in range(8)] + [(None, None), (2, "")]
    v = pieces.vocabulary()
    low = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    learned = [low(t) for i, t in rows if not held(i)]
    c = Counter(w for t in learned for w in t)
    n, p_end = sum(c.values()), (len(learned) + 1) / (sum(c.values()) + len(learned) + 2)
    rest, given = math.log(1 - p_end), lattice_lm.DISCOUNT * len(c) / n

    def mixed(w):
        return math.log(given * math.exp(word_likelihood(" " + w, v)) + max(0, c[w] - lattice_lm.DISCOUNT) / n) if c[w] else math.log(given) + word_likelihood(" " + w, v)

    want = sorted((str(i), sum(word_likelihood(" " + w, v) + rest for w in low(t)) + math.log(p_end),
                   sum(mixed(w) + rest for w in low(t)) + math.log(p_end)) for i, t in rows)
    from tradewh.llm.common import in_fold

    table = spark.createDataFrame(rows, "doc_id long, text string")
    for frequent in (100_000, 30):
        got = sorted((str(r["doc_id"]), r["score"] * math.log(10), r["score_mixed"] * math.log(10))
                     for r in lattice_lm.score_documents(table, ~in_fold("doc_id", 7, 2), frequent=frequent).collect())
        assert [g[0] for g in got] == [w[0] for w in want]
        for g, w in zip(got, want):
            assert g[1:] == pytest.approx(w[1:], rel=1e-9)


def test_lm_words_and_end_add_up_and_edges(spark, docs, no_docs):
    assert lattice_lm.score_documents(no_docs, F.lit(True)).count() == 0
    got = {r["doc_id"]: r for r in lattice_lm.score_documents(docs.where("doc_id in (2, 3)"), F.lit(True)).collect()}
    assert got[2]["n_tokens"] == 1 and got[2]["train_tokens"] == 2 and got[2]["score"] == got[3]["score"]
    nothing = lattice_lm.score_documents(docs, F.lit(False)).collect()
    assert len(nothing) == len(TEXTS) and all(r["n_known"] == 0 and r["base_score"] == 0 and math.isfinite(r["score"]) for r in nothing)


def test_lm_query_score_learns_the_corpus(spark, tmp_path):
    """Held-out scores are near the add-one base, mostly of words seen in training."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(400)]
    weights = [1 / k for k in range(1, 401)]
    rows = [(i, " ".join(rng.choices(words, weights, k=60))) for i in range(150)] + [(1000, None), (1001, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op8_lattice_lm(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in got) == [i for i, _ in rows]
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    held = [r for r in got if r["held_out"] and r["n_tokens"] > 1]
    assert held and all(r["score"] > 1.15 * r["base_score"] for r in held)


def test_lm_prefers_known_prose(spark):
    words = "alpha beta gamma delta epsilon".split()
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(words, k=30))) for i in range(30)] + [(100, "alpha beta gamma"), (101, "zq xj vkw"), (102, "alphabet gammadelta")]
    scored = lattice_lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") < 100).collect()
    for column in ("score", "score_mixed"):
        got = {r["doc_id"]: r[column] for r in scored}
        assert got[100] > got[102] > got[101] - 10 and got[100] > got[101]
    assert next(r["score_mixed"] > r["score"] for r in scored if r["doc_id"] == 100)
