"""Operators on whole tables (packing, files, index, WARC, near-dedup, pipeline) against brute force."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF, TEXTS
from tradewh.llm import arrow_files, encode, packing, permutation_index, queries, simhash, warc
from tradewh.llm.common import store


def library_ids(name, text):
    return encode.encoder(name).library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name, documents):
    rng = random.Random(1)
    coder = encode.Encoder(name, most=200)
    texts = [t for _, t in TEXTS if len(t or "") < 10_000] + ["'s 'll don't we're", "x\n\n y", "a \nb", "١٢ ² ½ ªº µ ſ K ﬁ Å", "<|endoftext|>"]
    texts += ["".join(rng.choice("ab Z\n'st.%é1 0\t’") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    texts += [r["text"] for r in documents.where("length(text) < 4000").limit(40).collect()]
    for t in texts:
        assert np.frombuffer(coder.encode(t), np.uint32).tolist() == library_ids(name, t)


# -- packing -----------------------------------------------------------------

def check_packing(rows, texts, capacity=2048):
    """rows of the operator against ids by the library."""
    want = sorted((str(i), k, start, n, zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes()))
                  for i, t in texts for ids in [library_ids("byte_bpe_50k.json", t) + [0]]
                  for k, (start, n) in enumerate(packing.cut(len(ids), capacity)))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by_sequence), -(-sum(r["length"] for r in rows) // capacity)


def test_cut():
    assert packing.cut(1) == [(0, 1)] and packing.cut(2048) == [(0, 2048)]
    assert packing.cut(2049) == [(0, 1), (1, 2048)] and packing.cut(4096) == [(0, 2048), (2048, 2048)]


def test_packing_of_documents(spark, documents):
    texts = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    used, least = check_packing(queries.op4_best_fit_packing(spark, SF).collect(), texts)
    assert used <= least * 1.02 + 1


def test_packing_of_edges(docs, no_docs):
    used, least = check_packing(packing.pack_documents(docs).collect(), TEXTS)
    assert used <= least + 1
    assert packing.pack_documents(no_docs).count() == 0


def test_sequences_hold_their_pieces(docs):
    packed = packing.pack_documents(docs, with_ids=True)
    got = packing.sequences(packed).collect()
    assert all(len(r["ids"]) == 4 * r["length"] <= 4 * 2048 for r in got)
    assert sum(r["length"] for r in got) == sum(r["length"] for r in packed.collect())


def test_local_search_empties_bins():
    rng = random.Random(7)
    better = 0
    for _ in range(300):
        lengths = [rng.randint(1, 60) for _ in range(rng.randint(0, 40))]
        first = packing.best_fit(lengths, 100)
        last = packing.local_search([list(b) for b in first], lengths, 100)
        assert sorted(i for b in last for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 100 for b in last) and len(last) <= len(first)
        assert sum(sum(lengths[i] for i in b) ** 2 for b in last) >= sum(sum(lengths[i] for i in b) ** 2 for b in first)
        better += len(last) < len(first)
    start = [[0, 1], [2, 3], [4, 5]]  # 60 + 30, 50 + 30, 20 + 10: fits in two
    assert len(packing.local_search(start, [60, 30, 50, 30, 20, 10], 100)) == 2
    assert better > 0  # bins were emptied in some of them


def test_local_search_ends_at_the_bound_or_without_an_exchange():
    rng = random.Random(3)
    for _ in range(60):
        top = rng.choice([30, 60, 99])
        lengths = [rng.randint(rng.choice([1, top // 3]), top) for _ in range(rng.randint(2, 60))]
        last = packing.local_search(packing.best_fit(lengths, 100), lengths, 100)
        assert sorted(i for b in last for i in b) == list(range(len(lengths)))
        if len(last) == -(-sum(lengths) // 100):
            continue
        sizes = [[lengths[i] for i in b] for b in last]
        for j, give in enumerate(sizes):
            for k, own in enumerate(sizes):
                if j != k and sum(give) <= sum(own) < 100:
                    back = {0, *own, *(x + y for p, x in enumerate(own) for y in own[:p])}
                    assert not any(0 < n - s <= 100 - sum(own) for n in give for s in back)


def test_local_search_of_a_whole_shard():
    rng = random.Random(1)
    for low, high, most in [(300, 900, 1.02), (500, 1000, 1.08)]:
        lengths = [rng.randint(low, high) for _ in range(packing.SHARD)]
        which, offset = packing.pack_lengths(lengths)
        fill = np.bincount(which, lengths)
        assert fill.max() <= 2048 and offset.max() < 2048
        assert np.count_nonzero(fill) <= most * (-(-sum(lengths) // 2048))


# -- Arrow files -------------------------------------------------------------

def brute_stream(texts):
    at, out = 0, []
    for i, t in texts:
        ids = np.array(library_ids("word_bpe_49k.json", t) + [2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_arrow_files_round_trip(spark, documents):
    texts = [tuple(r) for r in documents.orderBy("doc_id").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op7_arrow_sequences(spark, SF).orderBy("start").collect()]
    assert got == brute_stream(texts)


def test_arrow_files_of_edges(docs, no_docs):
    got = [tuple(r) for r in arrow_files.read_documents(arrow_files.write(docs)).collect()]
    assert len(got) == len(TEXTS) and sorted(g[0] for g in got if g[0])[-1] == 8
    got.sort(key=lambda g: g[1])
    assert got[0][0] is None and [g[1] for g in got] == np.cumsum([0] + [g[2] for g in got[:-1]]).tolist()
    sizes = {(i, n, c) for i, _, n, c in got}
    assert sizes == {(i, n, c) for i, _, n, c in brute_stream(TEXTS)}
    assert arrow_files.read_documents(arrow_files.write(no_docs)).count() == 0


def test_ids_that_do_not_fit_are_an_error(docs):
    with pytest.raises(Exception, match="don't fit uint8"):
        arrow_files.write(docs, id_type=pa.uint8()).collect()


def test_arrow_sequences_are_mapped_in_place(documents):
    manifest = arrow_files.write(documents, length=64)
    part = manifest.orderBy("part").first()
    fs, path = store(part["folder"])
    reader = pa.ipc.open_file(pa.memory_map(f"{path}/{part['name']}.arrow"))
    n = sum(reader.get_batch(k).num_rows for k in range(reader.num_record_batches))
    assert n == -(-part["n_ids"] // 64) and reader.schema.field("ids").type.list_size == 64
    ids = np.concatenate([x[m] for x, m in (arrow_files.sequence(part["folder"], part["name"], k) for k in range(n))])
    first = documents.orderBy("doc_id").first()
    own = library_ids("word_bpe_49k.json", first["text"]) + [2]
    assert len(ids) == part["n_ids"] and ids[:len(own)].tolist() == own
    before = pa.total_allocated_bytes()
    view = reader.get_batch(0).column(0)
    assert pa.total_allocated_bytes() == before and view.nbytes > 0


# -- permutation index -------------------------------------------------------

def brute_nearest(rows, k, is_query):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)}
    out = {}
    for q in filter(is_query, ok):
        out[q] = sorted(((-float(v @ ok[q]), i) for i, v in ok.items() if i != q))[:k]
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute_nearest(rows, 20, lambda i: i % 20 == 0)
    got = {}
    for r in queries.op6_permutation_index(spark, f"/root/testdata/{sf}").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want)
    vec = dict(rows)
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and found == sorted(found, key=lambda f: (-f[2], f[1]))
        assert all(s == pytest.approx(float(np.array(vec[q], float) @ np.array(vec[i], float)), abs=1e-12) for _, i, s in found)
    recall = np.mean([len({i for _, i in w} & {f[1] for f in got[q]}) / len(w) for q, w in want.items()])
    assert recall >= 0.9


def recall_of(spark, vectors, queries, k=20, **options):
    """Recall of the index on (id, vector) rows, for a set of queries."""
    x = np.array([v for _, v in vectors])
    ids = np.array([i for i, _ in vectors])
    table = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in vectors], "vec_id long, embedding array<double>")
    got = {}
    for r in permutation_index.nearest(table, F.col("id").isin(queries), k=k, **options).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert set(got) == set(queries)
    recalls = []
    for q in queries:
        score = x @ x[np.flatnonzero(ids == q)[0]]
        score[ids == q] = -np.inf
        # Of rows that tie, the smallest ids count.
        recalls.append(len(got[q] & set(ids[np.lexsort((ids, -score))[:k]].tolist())) / k)
    return float(np.mean(recalls))


@pytest.mark.parametrize("noise", [0.0, 0.001, 0.01])
def test_recall_with_a_third_of_copies(spark, noise):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    rng = np.random.default_rng(2)
    first, one = max(i for i, _ in rows) + 1, np.array(rows[7][1], float)
    copies = [(first + j, one + noise * rng.standard_normal(len(one))) for j in range(len(rows) // 2)]
    others = [i for i, _ in rows[::20]]
    assert recall_of(spark, rows + copies, others) >= 0.9
    assert recall_of(spark, rows + copies, [i for i, _ in copies[::25]]) >= 0.9


@pytest.mark.parametrize("sd", [0.5, 1.0])
def test_recall_with_unequal_lengths(spark, sd):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    rng = np.random.default_rng(4)
    scaled = [(i, np.array(v, float) * np.exp(sd * rng.standard_normal())) for i, v in rows]
    assert recall_of(spark, scaled, [i for i, _ in rows[::20]]) >= 0.9


@pytest.fixture()
def visited(monkeypatch):
    """Numbers of cells that queries were sent to, and of all cells."""
    seen, measure = [], permutation_index.cells_needed

    def record(placed, queries, near_cells, n_cells, *rest):
        seen.append((measure(placed, queries, near_cells, n_cells, *rest), n_cells))
        return seen[-1][0]

    monkeypatch.setattr(permutation_index, "cells_needed", record)
    return seen


def test_clustered_vectors_need_a_few_cells(spark, visited):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((40, 48)) * 2
    rows = [(i, centres[i % 40] + 0.5 * rng.standard_normal(48)) for i in range(4000)]
    assert recall_of(spark, rows, list(range(0, 4000, 20)), cell=100) >= 0.9
    assert visited[0][1] == 40 and visited[0][0] <= 8


@pytest.mark.parametrize("copies", [0, 1000])
def test_cells_without_structure(spark, visited, copies):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    first, one = max(i for i, _ in rows) + 1, np.array(rows[7][1], float)
    rng = np.random.default_rng(7)
    near = [(first + j, one + 0.01 * rng.standard_normal(len(one))) for j in range(copies)]
    # The hot cell is cut into parts, and queries into blocks.
    assert recall_of(spark, rows + near, [i for i, _ in rows[::20]], cell=100, shard=1 << 14, block=1 << 12) >= 0.9
    assert 1 < visited[0][0] <= visited[0][1]


def test_pivots_are_apart():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((60, 8))
    near = x[5] + 1e-4 * rng.standard_normal((500, 8))
    got = permutation_index.spread_out(np.vstack([near, x, 2 * x]), 50)
    unit = got / np.linalg.norm(got, axis=1, keepdims=True)
    assert len(got) == 50 and np.max(unit @ unit.T - 2 * np.eye(50)) < 1 - 1e-6


def test_nearness_is_footrule():
    rng = np.random.default_rng(0)
    perm = np.array([rng.permutation(12)[:5] for _ in range(30)])
    files = permutation_index.InvertedFiles(perm, 12)
    place = lambda p: np.array([np.flatnonzero(p == k)[0] if k in p else 5 for k in range(12)])
    q = rng.permutation(12)[:5]
    footrule = np.array([np.abs(place(q) - place(p)).sum() for p in perm])
    assert len(set((footrule + 2 * files.nearness(q)).tolist())) == 1


def test_index_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [0.0, -1.0]), (20, [0.0, -1.0]), (40, [0.5, 0.5])]
    table = spark.createDataFrame([(*r, 7, 0.5) for r in rows], "vec_id long, embedding array<double>, id int, score double")
    got = permutation_index.nearest(table, F.col("id") % 20 == 0).collect()
    good = [r for r in rows if r[0] in (0, 1, 2, 20, 40)]
    want = brute_nearest(dict(good).items(), 20, lambda i: i % 20 == 0)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == sorted((q, k, i) for q, w in want.items() for k, (_, i) in enumerate(w, 1))
    assert permutation_index.nearest(table.where("false"), F.col("id") % 20 == 0).count() == 0
    many = spark.createDataFrame([(i, [1.0, 0.0] if i < 300 else [0.0, 1.0]) for i in range(400)], "vec_id long, embedding array<double>")
    small = permutation_index.nearest(many, F.col("id") == 200, k=5, n_pivots=8, shard=50, block=1).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(small, key=lambda r: r["rank"])] == [(k + 1, k) for k in range(5)]


# -- WARC --------------------------------------------------------------------

def test_warc_equals_its_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    got = queries.op9_warc(spark, SF)
    want = con.execute(queries.ORACLE["op9_warc"])
    cols = [d[0] for d in want.description]
    assert sorted(map(str, map(tuple, got.select(*cols).collect()))) == sorted(map(str, want.fetchall()))


def test_warc_copies_edges_and_nested_rows(spark):
    big, odd = "<p>é</p>" * 200, "x" * 1000
    rows = [(1, "http://a/1", big), (2, "http://b/2?q=ü", big), (9, None, big), (3, "http://c", odd), (4, "http://d\r\nx", "small"), (5, "http://e", "small"),
            (6, "u", None), (7, "u", ""), (None, "u", big), (8, "u", odd), (8, "u", odd), (10, "u", "y" * 999), (11, "u", "y" * 999)]
    pages = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, digest string")
    captures = warc.assemble(warc.read_records(warc.write(pages))).cache()
    assert captures.count() == len(rows)
    assert captures.where("request is null or metadata is null").isEmpty()
    for r in captures.where("head.type = 'response'").collect():
        assert hashlib.sha1(r["head"]["payload"]).hexdigest() == r["head"]["digest"] and len(r["head"]["payload"]) == r["head"]["payload_bytes"]
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.page_digest(captures).collect())
    nb, no = len(big.encode()), 1000
    assert got == sorted([("1", nb, "revisit", 9), ("2", nb, "revisit", 9), ("9", nb, "response", None), ("None", nb, "revisit", 9),
                          ("3", no, "revisit", 8), ("8", no, "response", None), ("8", no, "revisit", 8), ("4", 5, "response", None),
                          ("5", 5, "response", None), ("6", 0, "response", None), ("7", 0, "response", None), ("10", 999, "response", None),
                          ("11", 999, "response", None)])
    assert warc.page_digest(warc.assemble(warc.read_records(warc.write(pages.where("false"))))).count() == 0


def test_warc_thousands_of_copies(spark):
    """A third of all pages share a payload; responses meet no join."""
    same = "<p>same</p>" * 100
    pages = spark.range(9000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), F.col("id")).alias("url"), F.when(
        F.col("id") % 3 == 0, F.lit(same)).otherwise(F.concat(F.repeat(F.lit("x"), 1100), (F.col("id") % 7000).cast("string"))).alias("html"))
    captures = warc.assemble(warc.read_records(warc.write(pages), with_payload=False))
    digest = warc.page_digest(captures)
    plan = digest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") == 1 and "LeftOuter" in plan and "Union" in plan
    want = {}
    for i in range(9000):
        key = same if i % 3 == 0 else i % 7000
        want[key] = max(want.get(key, 0), i)
    keys = {i: same if i % 3 == 0 else i % 7000 for i in range(9000)}
    got = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in digest.collect()}
    size = lambda k: len(same) if k == same else 1100 + len(str(k))
    assert got == {i: ("response", None, size(k)) if want[k] == i else ("revisit", want[k], size(k)) for i, k in keys.items()}
    assert sum(v[0] == "revisit" for v in got.values()) > 3000


# -- near-dedup --------------------------------------------------------------

def brute_fingerprint(text):
    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in low.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if x]
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    """(id, fp) pairs -> smallest id reachable, by all pairs."""
    distinct = sorted({f for _, f in fps})
    up = {f: f for f in distinct}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                up[root(a)] = root(b)
    least = {}
    for i, f in fps:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return sorted((str(i), f"{f:016x}", least.get(root(f))) for i, f in fps)


def test_near_dedup_equals_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op10_simhash_near_dedup(spark, sf).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got) == brute_components([(i, brute_fingerprint(t)) for i, t in texts])


def test_near_dedup_of_edges(spark, docs, no_docs):
    got = simhash.near_duplicates(docs).collect()
    mask = (1 << 64) - 1
    assert sorted((str(r["doc_id"]), f"{r['fp'] & mask:016x}", r["component_id"]) for r in got) == brute_components([(i, brute_fingerprint(t)) for i, t in TEXTS])
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect()) == sorted(["1", "2", "4", "7", "8", "None"])
    assert simhash.keep_one(no_docs).count() == 0


def test_keep_one_of_unlike_texts_with_one_id(spark):
    one, two = "the cat sat on the mat and looked at the bird in the tree", "prices rose by a tenth last year while wages stood still"
    rows = spark.createDataFrame([(1, one), (1, two), (2, one), (3, two)], "doc_id long, text string")
    assert sorted(tuple(r) for r in simhash.keep_one(rows).collect()) == sorted([(1, one), (1, two)])


@pytest.mark.parametrize("tree", [4096, 40, 7])
def test_links_of_dense_groups(spark, tree):
    """Hot blocks and chains; small trees force the second deal and the shards."""
    rng = random.Random(11)
    base = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    fps = set(base)
    for b in base[:4]:
        x = b
        for _ in range(60):
            x ^= 1 << rng.randrange(64) if rng.random() < 0.7 else 0b1111 << rng.randrange(60)
            fps.add(x)
    fps |= {(0xBEEF << 48) | rng.getrandbits(30) for _ in range(150)} | {0xABCD123 << 36 | rng.getrandbits(12) for _ in range(80)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    table = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    edges = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in simhash.links(table, tree=tree).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    ids = [(i, f) for i, f in enumerate(sorted(fps))]
    want = brute_components(ids)
    roots = {r["node"] & (1 << 64) - 1: r["root"] & (1 << 64) - 1 for r in simhash.components(simhash.links(table, tree=tree)).collect()}
    least = {}
    for i, f in ids:
        r = roots.get(f, f)
        least[r] = min(i, least.get(r, i))
    assert sorted((str(i), f"{f:016x}", least[roots.get(f, f)]) for i, f in ids) == want


def test_bk_tree_finds_all_within():
    rng = random.Random(4)
    items = {rng.getrandbits(10) for _ in range(300)}
    tree = simhash.BKTree(3)
    for x in items:
        tree.add(x)
    for _ in range(50):
        q = rng.getrandbits(10)
        assert sorted(tree.within(q)) == sorted(x for x in items if (x ^ q).bit_count() <= 3)


# -- pipeline ----------------------------------------------------------------

def test_pipeline_equals_its_stages_by_hand(spark, tmp_path):
    import corpus_pipeline
    from tradewh.llm import quality, toxicity
    from tradewh.llm.common import table

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "SimHash near-dedup", "best-fit packing"]
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    good = [(i, t) for i, t in rows if quality.judge(t)["kept"]]
    frame = spark.createDataFrame(good, "doc_id long, text string")
    model = toxicity.fit_toxicity(frame, toxicity.training_rows(table(spark, sf, "labels")))
    scores = toxicity.score_texts([t for _, t in good], model, toxicity._Emit(model["w"], model["bias"]))
    clean = [x for x, (s, _) in zip(good, scores) if s < 0.5]
    named = brute_components([(i, brute_fingerprint(t)) for i, t in clean])
    stay = {int(i) for i, _, c in named if int(i) == c}
    got = corpus_pipeline.run(spark, sf).collect()
    used, least = check_packing(got, [(i, t) for i, t in clean if i in stay])
    assert used <= least * 1.02 + 1


def test_pipeline_keeps_columns_and_takes_edges(spark, docs, no_docs):
    import corpus_pipeline

    for frame in (docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            if name != "best-fit packing":
                assert out.columns == docs.columns
            out.collect()
