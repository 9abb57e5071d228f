"""Token ids as Arrow IPC files of equal-length sequences with masks.

Documents in ascending id order form one stream of ids (each ends with ``end_id``), cut into
sequences of ``seq_len``. A file holds a run of that stream, one per task:

* ``*.tokens.arrow``: Arrow IPC file, uncompressed, one row per sequence with ``ids`` (fixed
  size list of the smallest unsigned integer that holds the vocabulary) and ``mask`` (fixed
  size list of booleans, false where the last sequence is padded). All batches but the last
  have ``BATCH`` rows, so a token's batch, row and place follow from its number, and a
  memory-mapped file is read without copying;
* ``*.docs.arrow``: id, first token within the file and token count of each document.

Files carry the task attempt in their names and become part of the dataset only by their row
in the manifest, which Spark takes from the one attempt that succeeded: a lost executor or a
speculative copy leaves files that nothing names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, stored
from .tokens import encoded_slices, encoder

BATCH = 256


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class _Sink:
    """One ``*.tokens.arrow`` file being written."""

    def __init__(self, stream, dtype: np.dtype, seq_len: int):
        self.dtype, self.seq_len = dtype, seq_len
        self.schema = pa.schema([
            ("ids", pa.list_(pa.from_numpy_dtype(dtype), seq_len)), ("mask", pa.list_(pa.bool_(), seq_len)),
        ])
        self.writer = pa.ipc.new_file(stream, self.schema)
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.size += len(ids)
        whole = BATCH * self.seq_len
        if self.size >= whole:
            flat = np.concatenate(self.held)
            cut = len(flat) // whole * whole
            for a in range(0, cut, whole):
                self._write(flat[a:a + whole], whole)
            self.held, self.size = [flat[cut:]], len(flat) - cut

    def close(self) -> None:
        if self.size:
            flat = np.concatenate(self.held)
            padded = -(-len(flat) // self.seq_len) * self.seq_len
            real = len(flat)
            self._write(np.concatenate([flat, np.zeros(padded - real, self.dtype)]), real)
        self.writer.close()

    def _write(self, flat: np.ndarray, real: int) -> None:
        mask = np.arange(len(flat)) < real
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.seq_len)
            for values in (flat.astype(self.dtype, copy=False), mask)
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))


class SequenceFile:
    """Random access to one ``*.tokens.arrow`` file."""

    def __init__(self, uri: str):
        filesystem, path = _filesystem(uri)
        local = filesystem.type_name == "local"
        self.reader = pa.ipc.open_file(pa.memory_map(path) if local else filesystem.open_input_file(path))
        self.seq_len = self.reader.schema.field("ids").type.list_size
        self._last: tuple[int, np.ndarray] = (-1, np.empty(0))

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence ``k``."""
        batch, row = self.reader.get_batch(k // BATCH), k % BATCH
        return batch.column(0)[row].values.to_numpy(), batch.column(1)[row].values.to_numpy(zero_copy_only=False)

    def _flat(self, b: int) -> np.ndarray:
        if self._last[0] != b:
            self._last = (b, self.reader.get_batch(b).column(0).flatten().to_numpy())
        return self._last[1]

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of the file's stream."""
        whole, parts, end = BATCH * self.seq_len, [], start + n
        while start < end:
            b = start // whole
            stop = min(end, (b + 1) * whole)
            parts.append(self._flat(b)[start - b * whole:stop - b * whole])
            start = stop
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint16)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    seq_len: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the files below ``folder`` (a URI all executors share); returns the manifest.

    The manifest has one row per file, in stream order: ``part``, ``file`` (URI without its
    ending), ``n_docs``, ``n_tokens`` and ``first_token`` (ids in all earlier files). Null
    texts are empty ones, a null id comes first, repeated rows are documents of their own
    (equal ids in the order of their texts), other columns are left out.
    """
    schema = "part int, file string, n_docs long, n_tokens long"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        part = task.partitionId()
        name = f"{folder}/part-{part:06d}-{task.taskAttemptId()}"
        dtype = np.dtype("<u2" if len(encoder(tokenizer).first_of_run) <= 1 << 16 else "<u4")
        end = np.asarray([end_id], "<u4").tobytes()
        sink = docs_out = None
        n_docs = n_tokens = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if sink is None:
                filesystem, path = _filesystem(name)
                filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
                streams = [filesystem.open_output_stream(f"{path}.{kind}.arrow") for kind in ("tokens", "docs")]
                sink = _Sink(streams[0], dtype, seq_len)
                docs_schema = pa.schema([("id", batch.schema.field(0).type), ("start", pa.int64()), ("n_tokens", pa.int64())])
                docs_out = pa.ipc.new_file(streams[1], docs_schema)
            for first, encoded in encoded_slices(tokenizer, batch.column(1)):
                sizes = []
                for raw in encoded:
                    ids = np.frombuffer(raw + end, "<u4").astype(dtype)
                    sink.add(ids)
                    sizes.append(len(ids))
                sizes = np.asarray(sizes, np.int64)
                starts = n_tokens + np.cumsum(sizes) - sizes
                docs_out.write_batch(pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(sizes)), pa.array(starts), pa.array(sizes)], schema=docs_schema,
                ))
                n_docs, n_tokens = n_docs + len(sizes), n_tokens + int(sizes.sum())
        if sink is not None:
            sink.close()
            docs_out.close()
            for s in streams:
                s.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([name]), pa.array([n_docs]), pa.array([n_tokens])],
                names=["part", "file", "n_docs", "n_tokens"],
            )

    ordered = docs.select(id_col, text_col).repartitionByRange(id_col).sortWithinPartitions(id_col, text_col)
    files = stored(ship(ordered).mapInArrow(write, schema), "token-files")
    # one row per file: the running sum over them is small however large the data are
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read_token_files(manifest: DataFrame, id_type: T.DataType, id_col: str = "doc_id") -> DataFrame:
    """Documents read back from the files: id_col, start (in the whole stream), n_tokens, ids.

    ``ids`` are little-endian unsigned 32-bit integers. One task per file.
    """
    schema = T.StructType([
        T.StructField(id_col, id_type),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = SequenceFile(f"{name}.tokens.arrow")
                filesystem, path = _filesystem(f"{name}.docs.arrow")
                with filesystem.open_input_file(path) as f:
                    index = pa.ipc.open_file(f)
                    for b in range(index.num_record_batches):
                        part = index.get_batch(b)
                        ids = [
                            tokens.ids(s, n).astype("<u4").tobytes()
                            for s, n in zip(part.column(1).to_pylist(), part.column(2).to_pylist())
                        ]
                        start = pa.array(part.column(1).to_numpy() + base)
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0), start, part.column(2), pa.array(ids, pa.binary())], names=schema.names,
                        )

    n_files = max(1, manifest.count())
    dealt = manifest.select("file", "first_token", "part").repartitionByRange(n_files, "part").drop("part")
    return ship(dealt).mapInArrow(read, schema)
