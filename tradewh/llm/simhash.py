"""SimHash near-dedup with BK-trees.

1. Fingerprint: 64 bits per text, a bit is set when more than half of the XXH64
   hashes of its three-word shingles have it. One scan, one Arrow pass.
2. Links: fingerprints within three bits agree on one of four 16-bit blocks at
   least, so distinct fingerprints are dealt out by (block, value). Groups of
   more than ``TREE`` fingerprints are dealt again by 12-bit parts of the other
   48 bits (again one of four must agree); what is still larger is cut into
   shards of about ``TREE`` nodes. Every shard is a BK-tree: a child hangs
   below its parent at their Hamming distance, and a search follows only edges
   whose distance lies within the radius of the distance to the node. All
   fingerprints of a group search every shard tree of that group, so no pair
   is missed, and no tree grows beyond its shard.
3. Within a tree only links that join two parts are kept (a spanning forest),
   so thousands of mutual near copies give thousands of links, not millions.
4. Components over the links, by alternating star rounds over tables written
   to the shared folder; the smallest doc_id of a component names it.

Defined results: null and empty texts have fingerprint zero, which links like
any other; repeated rows stay repeated; a row without doc_id takes part in
links but cannot name a component unless none of it has an id (then null);
texts of any length are hashed whole; of rows that could stay the smallest doc_id
stays, then the smallest text hash; an empty table gives no rows; other columns are
ignored or passed through.

What the trees do: blocks bring the pairs together (most groups hold one or two
fingerprints), so trees mainly verify there; they search where blocks are
crowded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tradewh.llm.common import pick
from tradewh.operators.materialize import materialize

SHINGLE = 3
RADIUS = 3
TREE = 4096
_SEED = 42
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first, last = [0, *ends.tolist()], (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, _SEED)]
    else:
        hashes = [digest(joined[a:b], _SEED) for a, b in zip(first, last[shingle - 1:])]
    octets = np.array(hashes, np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash (64 bits of the whole text) and fp (signed 64 bits), a row per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(fps, pa.int64())],
                                             ["doc_id", "text_hash", "fp"])

    rows = pick(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


# -- links -------------------------------------------------------------------

class BKTree:
    """Burkhard-Keller tree of 64-bit integers under Hamming distance."""

    def __init__(self, radius: int = RADIUS):
        self.radius, self.root = radius, None

    def add(self, x: int) -> None:
        if self.root is None:
            self.root = (x, {})
            return
        node = self.root
        while True:
            d = (node[0] ^ x).bit_count()
            child = node[1].get(d)
            if child is None:
                node[1][d] = (x, {})
                return
            node = child

    def within(self, x: int) -> list[int]:
        """All members at most ``radius`` bits from x."""
        found, todo, r = [], [self.root] if self.root else [], self.radius
        while todo:
            value, children = todo.pop()
            d = (value ^ x).bit_count()
            if d <= r:
                found.append(value)
            if children:
                todo += [c for k, c in children.items() if d - r <= k <= d + r]
        return found


class _Forest:
    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = x = up.get(p, p)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[a] = b
        return a != b


def _tree_links(radius: int):
    """Links of each shard; rows come sorted by group and shard, the shard's own nodes first."""
    mask = (1 << 64) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree, forest = None, BKTree(radius), _Forest()
        for batch in batches:
            left, right = [], []
            for key, shard, guest, fp in zip(*(batch.column(c).to_pylist() for c in ("key", "shard", "guest", "fp"))):
                if (key, shard) != now:
                    now, tree, forest = (key, shard), BKTree(radius), _Forest()
                x = fp & mask
                near = tree.within(x) if tree.root else []
                if guest:  # belongs to another shard's tree: a link to each part it touches
                    near = {forest.root(y): y for y in near}.values()
                else:
                    near = [y for y in near if forest.join(x, y)]
                    tree.add(x)
                left += [fp] * len(near)
                right += [y - (1 << 64) if y >> 63 else y for y in near]
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def _parts(fp: Column, width: int) -> Column:
    """The four (index, value) parts of the low ``4 * width`` bits, as one number each."""
    return F.array(*[F.shiftrightunsigned(fp, k * width).bitwiseAND((1 << width) - 1) + F.lit(k << width) for k in range(4)])


def links(distinct: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """(a, b) links that join all fingerprints of ``distinct.fp`` (no repeats)
    into the same components as all pairs within ``radius`` (three at most) do."""
    if radius > 3:
        raise ValueError("four blocks find pairs within three bits only")
    fp = F.col("fp")
    dealt = distinct.select("fp", F.explode(_parts(fp, 16)).alias("key"))
    large = materialize(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tree), "bk-large")
    if not large.isEmpty():
        # The 48 bits beside the shared block, closed up, in four parts of 12.
        at = F.shiftright("key", 16).cast("int") * 16
        low = fp.bitwiseAND(F.expr("shiftleft(1L, cast(shiftright(key, 16) as int) * 16) - 1"))
        high = F.expr("shiftleft(shiftrightunsigned(shiftrightunsigned(fp, cast(shiftright(key, 16) as int) * 16), 16),"
                      " cast(shiftright(key, 16) as int) * 16)")
        marked = dealt.join(large, "key", "left")
        small = marked.where("n IS NULL").select("fp", "key")
        again = (marked.where("n IS NOT NULL").withColumn("rest", low.bitwiseOR(high))
                 .select("fp", "key", F.explode(_parts(F.col("rest"), 12)).alias("part"))
                 # (key, part) as one number above all the plain keys
                 .select("fp", ((F.col("key") + 1) * F.lit(1 << 20) + F.col("part")).alias("key")))
        dealt = materialize(small.unionByName(again), "bk-dealt")
        large = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tree)
        shards = F.coalesce(F.ceil(F.col("n") / tree), F.lit(1)).cast("int")
        dealt = (dealt.join(large, "key", "left").withColumn("shards", shards)
                 .select("fp", "key", F.pmod(F.xxhash64("fp"), "shards").alias("own"),
                         F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
                 .select("fp", "key", "shard", (F.col("own") != F.col("shard")).alias("guest")))
    else:
        dealt = dealt.select("fp", "key", F.lit(0).alias("shard"), F.lit(False).alias("guest"))
    rows = dealt.repartition("key", "shard").sortWithinPartitions("key", "shard", "guest", "fp")
    return rows.mapInArrow(_tree_links(radius), "a long, b long").distinct()


# -- components --------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of ``edges(a, b)`` the smallest node it reaches.

    Each round lets every node point its larger neighbours, then its smaller
    ones, at the smallest, until nothing changes; the rounds needed grow with the
    logarithm of the longest chain. Every round is a written table.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Now u > v everywhere, so the smaller neighbours of u are all its v.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        now = materialize(
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc")
        got = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if got == state:
            break
        state = got
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """doc_id, text_hash, fp, component_id (the smallest doc_id) and root (the component
    itself: its smallest fingerprint), one row per row of ``docs``."""
    rows = materialize(fingerprints(docs, shingle), "fps")
    # Copies meet here: one row per distinct fingerprint goes on.
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp-distinct")
    roots = components(links(distinct.select("fp"), radius, tree))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(ids, "root").select("fp", "component_id", "root")
    return rows.join(by_fp, "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest doc_id (of
    repeated rows any one; without ids, that of the smallest text hash)."""
    found = materialize(near_duplicates(docs, shingle, radius), "near")
    # By the component itself: two of them can have the same smallest id, or none.
    first = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "text_hash")).alias("s"))
    stays = first.select(F.col("s.doc_id").alias("_stay_id"), F.col("s.text_hash").alias("_stay_hash")).distinct()
    per_key = found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = per_key.select(F.col("doc_id").alias("_stay_id"), F.col("text_hash").alias("_stay_hash"), F.lit(True).alias("_many"))
    stays = stays.join(repeated, stays["_stay_id"].eqNullSafe(repeated["_stay_id"]) & (stays["_stay_hash"] == repeated["_stay_hash"]), "left"
                       ).select(stays["_stay_id"], stays["_stay_hash"], "_many")
    same = docs["doc_id"].cast("long").eqNullSafe(stays["_stay_id"]) & (F.xxhash64(docs["text"].cast("string")) == stays["_stay_hash"])
    kept = docs.join(stays, same)
    single = kept.where("_many IS NULL").select(*[docs[f"`{c}`"] for c in docs.columns])
    many = kept.where("_many").dropDuplicates(["_stay_id", "_stay_hash"]).select(*[docs[f"`{c}`"] for c in docs.columns])
    return single.unionByName(many)
