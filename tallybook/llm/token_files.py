"""Token ids in Arrow files of equal-length sequences.

A file is in the Arrow IPC file format. Its batches have two columns of fixed-size lists:
``tokens`` and ``mask`` (true for real tokens). A sequence is row ``i % BATCH`` of batch
``i // BATCH``, at a known place in the file, so a memory-mapped reader gets it without
copying or decoding. Documents follow one another; only the last sequence of a
file is padded. An index table says where each document begins.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.shared import new_folder, saved
from tallybook.llm.tokenizing import encoder

#: Ids of a sequence, and sequences of a batch.
LENGTH = 2048
BATCH = 64
END = 2


def _schema(width: np.dtype, length: int) -> pa.Schema:
    return pa.schema(
        [
            ("tokens", pa.list_(pa.from_numpy_dtype(width), length)),
            ("mask", pa.list_(pa.bool_(), length)),
        ]
    )


def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address and the folder's path in it."""
    system, path = fs.FileSystem.from_uri(folder)
    return system, path.rstrip("/")


class SequenceWriter:
    """Writes ids as they come; holds no more than one batch."""

    def __init__(self, sink, width: np.dtype, length: int = LENGTH, batch: int = BATCH) -> None:
        self._schema, self._width, self._length = _schema(width, length), width, length
        self._file = pa.ipc.new_file(sink, self._schema)
        self._full = length * batch
        self._held: list[np.ndarray] = []
        self._n_held = 0
        self.written = 0

    def append(self, ids: np.ndarray) -> None:
        self.written += len(ids)
        while len(ids):
            part = ids[: self._full - self._n_held]
            self._held.append(part)
            self._n_held += len(part)
            ids = ids[len(part) :]
            if self._n_held == self._full:
                self._flush()

    def _flush(self) -> None:
        rows = -(-self._n_held // self._length)
        tokens = np.zeros(rows * self._length, self._width)
        tokens[: self._n_held] = np.concatenate(self._held)
        mask = np.arange(len(tokens)) < self._n_held
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self._length)
            for values in (tokens, mask)
        ]
        self._file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self._schema))
        self._held, self._n_held = [], 0

    def close(self) -> None:
        if self._n_held:
            self._flush()
        self._file.close()


class SequenceReader:
    """Random access to a file of sequences; a local one is memory-mapped."""

    def __init__(self, system: fs.FileSystem, path: str) -> None:
        local = isinstance(system, fs.LocalFileSystem)
        self._source = pa.memory_map(path) if local else system.open_input_file(path)
        self._file = pa.ipc.open_file(self._source)
        self.length = self._file.schema.field("tokens").type.list_size
        self._at: tuple[int, pa.RecordBatch] | None = None

    def _batch(self, i: int) -> pa.RecordBatch:
        if self._at is None or self._at[0] != i:
            self._at = i, self._file.get_batch(i)
        return self._at[1]

    def sequence(self, i: int, batch: int = BATCH) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of sequence ``i``; the ids are a view of the file."""
        row = self._batch(i // batch)
        k = i % batch
        return row.column("tokens")[k].values.to_numpy(), row.column("mask")[k].values

    def ids(self, first: int, n: int, batch: int = BATCH) -> np.ndarray:
        """``n`` ids from the file's id ``first`` on."""
        full, parts = self.length * batch, []
        while n > 0:
            values = self._batch(first // full).column("tokens").flatten().to_numpy()
            part = values[first % full : first % full + n]
            parts.append(part)
            first, n = first + len(part), n - len(part)
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def close(self) -> None:
        self._source.close()


def write_sequences(
    df: DataFrame, folder: str, path: str, text: str = "text", key: str = "doc_id", end: int = END
) -> DataFrame:
    """Writes ``df`` in ascending order of its key; (id, file, part, first, n) of each document.

    Texts are dealt to tasks by ranges of the key and sorted there; each task writes one
    file and holds one batch. A repeated task writes a file of a new name, and the index,
    which is written to the shared folder, names only the files of tasks that count.
    """
    rows = (
        df.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
        .repartitionByRange(F.col("id"))
        .sortWithinPartitions("id", "text")
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = encoder(path)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.arrow"
        system, where = open_store(folder)
        writer = sink = None
        for b in batches:
            if writer is None:
                system.create_dir(where)
                sink = system.open_output_stream(f"{where}/{name}")
                writer = SequenceWriter(sink, tool.width)
            first, n = [], []
            for t in b["text"]:
                ids = np.frombuffer(tool.ids(t), tool.width)
                first.append(writer.written)
                n.append(len(ids) + 1)
                writer.append(ids)
                writer.append(np.array([end], tool.width))
            yield pd.DataFrame(
                {"id": b["id"], "file": name, "part": part, "first": first, "n": n}
            )
        if writer is not None:
            writer.close()
            sink.close()

    return saved(rows.mapInPandas(write, "id long, file string, part int, first long, n long"), "index")


def file_starts(index: DataFrame) -> DataFrame:
    """(file, before): ids in all files before. One number per file comes to the driver."""
    sizes = index.groupBy("file", "part").agg(F.sum("n").alias("n")).collect()
    total, out = 0, []
    for r in sorted(sizes, key=lambda r: r["part"]):
        out.append((r["file"], total))
        total += r["n"]
    return index.sparkSession.createDataFrame(out, "file string, before long")


def read_documents(index: DataFrame, folder: str) -> DataFrame:
    """(id, file, first, n, ids_crc32) of every document, its ids read back from the files.

    Rows are sorted by place, so that a task reads its files front to back.
    """

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, where = open_store(folder)
        name, reader = None, None
        for b in batches:
            crc = []
            for file, first, n in zip(b["file"], b["first"], b["n"], strict=True):
                if file != name:
                    if reader is not None:
                        reader.close()
                    name, reader = file, SequenceReader(system, f"{where}/{file}")
                crc.append(zlib.crc32(reader.ids(first, n).astype("<u4").tobytes()))
            yield b.assign(ids_crc32=crc)
        if reader is not None:
            reader.close()

    placed = index.select("id", "file", "first", "n").repartitionByRange("file", "first")
    return placed.sortWithinPartitions("file", "first").mapInPandas(
        read, "id long, file string, first long, n long, ids_crc32 long"
    )


def token_file_report(
    df: DataFrame, path: str, folder: str | None = None, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of each document, from files written in ``folder``.

    Null and empty texts are their end id alone. Rows without a key come first, repeated
    rows one after the other; an empty table gives no rows and no file.
    """
    folder = folder or new_folder(df.sparkSession, "sequences")
    index = write_sequences(df, folder, path, text, key)
    found = read_documents(index, folder)
    starts = F.broadcast(file_starts(index))
    return found.join(starts, "file").select(
        F.col("id").alias(key),
        (F.col("before") + F.col("first")).alias("start"),
        F.col("n").alias("n_tokens"),
        "ids_crc32",
    )
