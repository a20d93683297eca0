"""Token-ID output: Arrow files of equal-length sequences and masks.

Layout of a data set: parts in ascending doc_id order, each an Arrow IPC file
of record batches of ``BATCH`` rows with two fixed-size-list columns, ``ids``
and ``mask``, ``length`` long. The ids of a part's documents follow each other
without gaps; the mask is false on the padding behind the last one. Row k of a
part is row ``k % BATCH`` of batch ``k // BATCH``, so any sequence is read in
place, without a copy, from a mapped file. Beside each part lies an index file
(doc_id, start, n_tokens).

Writing: rows are ranged by doc_id and sorted, each task streams its rows into
one part (memory: a batch of sequences), under a name of its own, and only the
manifest (a written table of one small row per part) makes a part count: a
task that runs twice leaves a file that nobody reads.

Defined results: a null or empty text is the end id alone; rows without doc_id
come first; repeated rows are written once each, ordered by text hash; an empty
table gives a manifest without parts.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tradewh.llm.common import pick, shared_folder, store
from tradewh.llm.encode import encoder
from tradewh.operators.materialize import materialize

VOCABULARY = "word_bpe_49k.json"
LENGTH = 2048
BATCH = 64
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def schema(length: int, id_type: pa.DataType) -> pa.Schema:
    return pa.schema([pa.field("ids", pa.list_(pa.field("item", id_type, False), length), False),
                      pa.field("mask", pa.list_(pa.field("item", pa.bool_(), False), length), False)])


class PartWriter:
    """Streams documents' ids into one part and its index."""

    def __init__(self, folder: str, name: str, length: int, id_type: pa.DataType, pad_id: int):
        fs, path = store(folder)
        fs.create_dir(path, recursive=True)
        self.length, self.pad, self.dtype = length, pad_id, np.dtype(id_type.to_pandas_dtype())
        self.schema = schema(length, id_type)
        self.files = [fs.open_output_stream(f"{path}/{name}{end}") for end in (".arrow", ".index.arrow")]
        self.data, self.index = pa.ipc.new_file(self.files[0], self.schema), pa.ipc.new_file(self.files[1], _INDEX)
        self.waiting, self.held, self.n_ids, self.docs = [], 0, 0, []
        self.n_docs = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, self.n_ids, len(ids)))
        self.n_ids += len(ids)
        self.n_docs += 1
        self.waiting.append(ids.astype(self.dtype))
        self.held += len(ids)
        if self.held >= self.length * BATCH:
            self._flush()
        if len(self.docs) >= 10_000:
            self._flush_index()

    def _write(self, ids: np.ndarray, valid: int) -> None:
        mask = np.arange(len(ids)) < valid
        cols = [pa.FixedSizeListArray.from_arrays(pa.array(x, self.schema.field(k).type.value_type), type=self.schema.field(k).type)
                for k, x in enumerate((ids, mask))]
        self.data.write_batch(pa.RecordBatch.from_arrays(cols, schema=self.schema))

    def _flush(self) -> None:
        ids, step = np.concatenate([*self.waiting, np.empty(0, self.dtype)]), self.length * BATCH
        whole = len(ids) // step * step
        for k in range(0, whole, step):
            self._write(ids[k:k + step], step)
        self.waiting, self.held = [ids[whole:].copy()], len(ids) - whole

    def _flush_index(self) -> None:
        if self.docs:
            self.index.write_batch(pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*self.docs)], schema=_INDEX))
            self.docs = []

    def close(self) -> None:
        self._flush()
        if self.held:
            ids = self.waiting[0]
            rest = -len(ids) % self.length
            self._write(np.concatenate([ids, np.full(rest, self.pad, self.dtype)]), len(ids))
        self._flush_index()
        for x in (self.data, self.index, *self.files):
            x.close()


def write(docs: DataFrame, folder: str | None = None, vocabulary: str = VOCABULARY, end_id: int = 2, length: int = LENGTH,
          id_type: pa.DataType = pa.uint16(), pad_id: int = 0) -> DataFrame:
    """Write the data set; returns its manifest: part, name, n_docs, n_ids, first (ids before it), folder.

    ``id_type`` must hold every id of the vocabulary (16 bits do for 49,408); one
    that doesn't is an error before anything is written.
    """
    folder = folder or shared_folder(docs.sparkSession, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, out, part = encoder(vocabulary), None, TaskContext.get().partitionId()
        encode, largest = coder.encode, max(coder.library.get_vocab_size() - 1, end_id, pad_id)
        if largest > np.iinfo(id_type.to_pandas_dtype()).max:
            raise ValueError(f"ids up to {largest} don't fit {id_type}")
        name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                out = out or PartWriter(folder, name, length, id_type, pad_id)
                out.add(doc_id, np.frombuffer(encode(text) + end_id.to_bytes(4, "little"), "<u4"))
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "name": [name],
                                              "n_docs": pa.array([out.n_docs], pa.int64()), "n_ids": pa.array([out.n_ids], pa.int64())})

    rows = pick(docs, doc_id="long", text="string").withColumn("h", F.xxhash64("text"))
    parts = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text").mapInArrow(
        run, "part long, name string, n_docs long, n_ids long")
    parts = materialize(parts, "manifest")
    # One row per part; the window runs over these rows only.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).withColumn("folder", F.lit(folder))


def _documents(folder: str, name: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start in the part, ids) of a part's documents, batch by batch."""
    fs, path = store(folder)
    with fs.open_input_file(f"{path}/{name}.arrow") as f, fs.open_input_file(f"{path}/{name}.index.arrow") as g:
        data, index = pa.ipc.open_file(f), pa.ipc.open_file(g)
        held, begin, at = np.empty(0, np.uint32), 0, 0
        for b in range(index.num_record_batches):
            rows = index.get_batch(b)
            for doc_id, start, n in zip(*(rows.column(c).to_pylist() for c in range(3))):
                if begin + len(held) < start + n:
                    more = [held[start - begin:]]
                    have = begin + len(held) - start
                    while have < n:
                        batch = data.get_batch(at)
                        at += 1
                        ids, mask = (np.asarray(batch.column(c).values.to_numpy(zero_copy_only=False)) for c in (0, 1))
                        more.append(ids[mask])
                        have += int(mask.sum())
                    held, begin = np.concatenate(more), start
                yield doc_id, start, held[start - begin:start - begin + n]


def sequence(folder: str, name: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """ids and mask of the k-th sequence of a part: random access to one batch;
    on a local folder the file is mapped and the ids are a view of it."""
    fs, path = store(folder)
    from pyarrow import fs as pafs

    f = pa.memory_map(f"{path}/{name}.arrow") if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(f"{path}/{name}.arrow")
    batch = pa.ipc.open_file(f).get_batch(k // BATCH)
    row = k % BATCH
    return tuple(batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in (0, 1))


def read_documents(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files.

    One task per part or so; each reads its parts batch by batch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "start", "n_tokens", "ids_crc32"])

        out: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                for doc_id, start, ids in _documents(row["folder"], row["name"]):
                    out.append((doc_id, row["first"] + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(out) >= 5000:
                        yield flush()
                        out = []
        if out:
            yield flush()

    n = max(1, manifest.count())
    return manifest.repartitionByRange(n, "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
