"""Best-fit packing of documents into sequences of a fixed capacity.

1. Pieces: every text's token ids and an end id; only texts longer than the
   capacity are cut, into full pieces, the first of which may be shorter. One
   scan, one Arrow pass; what follows handles one small row per piece.
2. Full pieces are sequences by themselves. The others are dealt evenly into
   shards of about ``SHARD`` pieces, each packed in a task of its own: pieces
   in falling order into the fullest bin that takes them, then swap-based local
   search over the underfull bins: a piece moves to a fuller bin, or changes
   places with a smaller one there (one for one) or with two smaller ones (two
   for one), found by looking up what open bins can give back and their rooms.
   Each step increases the sum of squared fills; bins that run empty are gone.
   The search ends at the lower bound or when no step is left, nowhere else.
   A shard wastes less than a bin or two of some thousands, so sharding costs
   next to nothing, and shards grow in number, not in size.

Defined results: a null or empty text is one piece, the end id alone; repeated
rows and rows without doc_id are packed like any other; no rows, no sequences;
like bins are taken in their order; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradewh.llm.common import pick
from tradewh.llm.encode import encoder
from tradewh.operators.materialize import materialize

CAPACITY = 2048
SHARD = 20_000
VOCABULARY = "byte_bpe_50k.json"


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document of n ids."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = 0, capacity: int = CAPACITY,
           with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, on demand, the ids (little-endian, 32 bits)."""
    end = end_id.to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(text) + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start:4 * (start + length)]
                    for col, v in zip(out, (doc_id, k, start, length, zlib.crc32(own), own)):
                        col.append(v)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return pick(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


# -- one shard ---------------------------------------------------------------

def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indexes by bin: longest first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set while some bin has room r
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        n = lengths[i]
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        room -= n
        by_room.setdefault(room, []).append(b)
        rooms |= 1 << room
    return bins


class _Receivers:
    """For each sum of up to two lengths that some listed bin can give back, the
    largest room among the bins that can: one lookup finds the best exchange."""

    def __init__(self, capacity: int):
        self.heaps: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity)]
        self.reach = np.full(capacity, -1, np.int64)  # sum given back + largest room: the longest piece taken for it
        self.version: dict[int, int] = {}
        self.listed: dict[int, set[int]] = {}

    def add(self, b: int, room: int, own: list[int]) -> None:
        v = self.version[b] = self.version.get(b, 0) + 1
        counts = Counter(own)
        several = sorted(counts)
        sums = {0, *several, *(x + y for k, x in enumerate(several) for y in several[k + (counts[x] == 1):])}
        self.listed[b] = sums
        for s in sums:
            heapq.heappush(self.heaps[s], (-room, b, v))
            if s + room > self.reach[s]:
                self.reach[s] = s + room

    def drop(self, b: int) -> None:
        self.version[b] += 1
        for s in self.listed.pop(b):
            heap = self.heaps[s]
            while heap and self.version[heap[0][1]] != heap[0][2]:
                heapq.heappop(heap)
            self.reach[s] = s - heap[0][0] if heap else -1

    def exchange(self, own: list[int]) -> tuple[int, int, int, int] | None:
        """(gain, bin, length to give, sum to take back) of the largest gain for a bin of these lengths."""
        give = np.array(sorted(set(own)), np.int64)
        back = np.searchsorted(np.maximum.accumulate(self.reach), give)  # the smallest sum whose bin takes the piece
        k = int(np.argmax(give - back))
        gain, s = int(give[k] - back[k]), int(back[k])
        return (gain, self.heaps[s][0][1], int(give[k]), s) if gain > 0 else None


def _of_sum(own: list[int], lengths: list[int], s: int) -> list[int]:
    """At most two of the pieces ``own`` with lengths that add up to ``s``."""
    if not s:
        return []
    seen: dict[int, int] = {}
    pair = None
    for i in own:
        if lengths[i] == s:
            return [i]
        if pair is None and s - lengths[i] in seen:
            pair = [seen[s - lengths[i]], i]
        seen.setdefault(lengths[i], i)
    return pair


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Exchange pieces between underfull bins until bins empty or no exchange helps.

    The emptiest bin gives: a piece of it moves to a fuller bin, or changes
    places there with one or two pieces that are smaller together, whichever
    gains most. Every step makes the fuller bin fuller and the emptier emptier,
    so the sum of squared fills grows and the search ends. A bin without an
    exchange is set aside for the pass; a pass without any exchange is the last.
    """
    bound = -(-sum(lengths) // capacity)
    fill = [sum(lengths[i] for i in b) for b in bins]
    alive = sum(1 for f in fill if f)
    moved = True
    while alive > bound and moved:
        moved = False
        index = _Receivers(capacity)
        list_it = lambda b: index.add(b, capacity - fill[b], [lengths[i] for i in bins[b]])
        givers = [(fill[b], b) for b in range(len(bins)) if 0 < fill[b] < capacity]
        heapq.heapify(givers)
        for _, b in givers:
            list_it(b)
        tried: deque[tuple[int, int]] = deque()  # without an exchange, emptiest first
        while givers and alive > bound:
            was, low = heapq.heappop(givers)
            if was != fill[low]:
                continue  # has received since
            while tried and tried[0][0] < was:  # emptier than what comes now: no receivers any more
                before, b = tried.popleft()
                if before == fill[b]:
                    index.drop(b)
            index.drop(low)
            while bins[low]:
                best = index.exchange([lengths[i] for i in bins[low]])
                if best is None:
                    break
                moved = True
                gain, a, n, back = best
                index.drop(a)
                y, taken = next(i for i in bins[low] if lengths[i] == n), _of_sum(bins[a], lengths, back)
                bins[a] = [i for i in bins[a] if i not in taken] + [y]
                bins[low] = [i for i in bins[low] if i != y] + taken
                fill[a] += gain
                fill[low] -= gain
                if fill[a] < capacity:
                    list_it(a)
                    heapq.heappush(givers, (fill[a], a))
            if bins[low]:
                if fill[low] == was:
                    list_it(low)  # bins as empty as it may still give to it
                    tried.append((was, low))
            else:
                alive -= 1
    return [b for b in bins if b]


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length."""
    which, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for b, members in enumerate(local_search(best_fit(lengths, capacity), lengths, capacity)):
        at = 0
        for i in members:
            which[i], offset[i] = b, at
            at += lengths[i]
    return which, offset


# -- all shards --------------------------------------------------------------

def pack(rows: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``rows`` (any columns, with ``length`` from 1 to ``capacity``) with
    ``sequence_id`` and the gapless ``offset`` inside it.

    ``rows`` should be a written table: each row gets a number that both the
    packing and its result go by.
    """
    numbered = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    partial = numbered.where(F.col("length") < capacity)
    # One bin of room more than the mean keeps shards even; their count follows the input.
    shards = max(1, -(-partial.count() // shard))
    slim = partial.select("_row", "length", F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("long").alias("_shard"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_row"], ascending=[False, True])
        which, offset = pack_lengths(rows["length"].tolist(), capacity)
        return pd.DataFrame({"_row": rows["_row"].to_numpy(), "sequence_id": (rows["_shard"].to_numpy() << 40) + which,
                             "offset": offset})

    placed = slim.groupBy("_shard").applyInPandas(run, "_row long, sequence_id long, offset long")
    whole = numbered.where(F.col("length") >= capacity)
    # Full pieces: their own row number, below zero, so no shard uses it.
    whole = whole.select(*rows.columns, (-F.col("_row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return partial.join(placed, "_row").select(*rows.columns, "sequence_id", "offset").unionByName(whole)


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = 0, capacity: int = CAPACITY,
                   with_ids: bool = False) -> DataFrame:
    """The pieces of ``docs`` with their places."""
    return pack(pieces(docs, vocabulary, end_id, capacity, with_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length, ids (binary) and the (doc_id, piece, offset) list of
    each sequence of ``pack_documents(..., with_ids=True)``; a group is one
    sequence, so it never holds more than the capacity."""
    parts = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))).alias("p"))
    joined = F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))")
    return parts.select("sequence_id", "length", joined.alias("ids"),
                        F.expr("transform(p, x -> struct(x.doc_id, x.piece, x.offset))").alias("documents"))
