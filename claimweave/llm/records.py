"""Token ids in files of length-delimited binary records, with an offset index.

A record is framed as: length of the payload (8 bytes), masked checksum of these 8
bytes (4), payload, masked checksum of the payload (4).  The payload is one flag
byte (bit 0: doc_id is NULL; bit 1: ids take 4 bytes, else 2), doc_id (8 bytes) and
the ids.  All numbers are little-endian.  A checksum is the CRC-32, rotated right by
15 bits, plus a constant, so that a checksum over data that holds checksums is sound.
Beside ``part-N.rec`` lies ``part-N.idx``: one (offset, number of ids) pair of 8-byte
numbers per record, by which single records can be read in any order.

Files hold ascending ranges of doc_id.  Each is written by one task under a name of
the attempt and then renamed, so a task that is run again replaces equal content.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimweave.llm.base import scratch, slices, text_or_empty
from claimweave.llm.pretokens import encoder

END_ID = 1
BLOCK_BYTES, READ_BYTES = 4 << 20, 8 << 20
MASK = 0xA282EAD8
HEAD, NULL_ID, WIDE = struct.Struct("<Bq"), 1, 2
INDEX = np.dtype([("offset", "<u8"), ("n_ids", "<u8")])


def masked(data: bytes | memoryview) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def unframe(data: memoryview) -> memoryview:
    """Payload of the record that ``data`` starts with, not copied; damage is an error."""
    (n,) = struct.unpack_from("<Q", data, 0)
    if struct.unpack_from("<I", data, 8)[0] != masked(data[:8]) or len(data) < n + 16:
        raise ValueError("damaged record length")
    payload = data[12 : 12 + n]
    if struct.unpack_from("<I", data, 12 + n)[0] != masked(payload):
        raise ValueError("damaged record")
    return payload


def payload_of(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = len(ids) > 0 and int(ids.max()) > 0xFFFF
    head = HEAD.pack((NULL_ID if doc_id is None else 0) | (WIDE if wide else 0), doc_id or 0)
    return head + ids.astype("<u4" if wide else "<u2").tobytes()


def parse(payload: bytes | memoryview) -> tuple[int | None, np.ndarray]:
    flags, doc_id = HEAD.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=HEAD.size).astype("<u4")
    return None if flags & NULL_ID else doc_id, ids


def place(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a local path or a URI that pyarrow knows (file, s3, gs, hdfs, abfs)."""
    return fs.FileSystem.from_uri(folder)


def write_records(df: DataFrame, folder: str, path: str, end_id: int = END_ID) -> DataFrame:
    """Write the ids of all texts, each with ``end_id`` appended; returns the manifest (part, records, ids).

    Records are in the order of doc_id, NULL first, and of a hash of the text, within and
    across files; part numbers ascend with doc_id.  One doc_id, and copies of one row, may
    fill many files.  NULL text is empty.  Repeated rows are records of their own; no rows
    give an empty manifest.  The manifest is written beside the files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        store, root = place(folder)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        names = {kind: f"{root}/part-{part:06d}.{kind}" for kind in ("rec", "idx")}
        out, index, at, ids_written = None, [], 0, 0
        for batch in slices(batches, "text", BLOCK_BYTES):
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{names['rec']}.{attempt}")
            ids, starts = encode(batch.column(1).to_pylist())
            records = []
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                own = np.append(ids[starts[k] : starts[k + 1]], np.uint32(end_id))
                records.append(frame(payload_of(doc_id, own)))
                index.append((at, len(own)))
                at, ids_written = at + len(records[-1]), ids_written + len(own)
            out.write(b"".join(records))
        if out is None:
            return
        out.close()
        with store.open_output_stream(f"{names['idx']}.{attempt}") as f:
            f.write(np.array(index, INDEX).tobytes())
        for name in names.values():
            store.move(f"{name}.{attempt}", name)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "records": pa.array([len(index)], pa.int64()), "ids": pa.array([ids_written], pa.int64())})

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumns({"_hash": F.xxhash64("text"), "_copy": F.monotonically_increasing_id()})
    order = ["doc_id", "_hash", "_copy"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    manifest = ordered.mapInArrow(write, "part long, records long, ids long")
    manifest.write.parquet(f"{folder.rstrip('/')}/manifest")
    return df.sparkSession.read.schema("part long, records long, ids long").parquet(f"{folder.rstrip('/')}/manifest")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, read from the files; start counts the ids before it.

    One row of the manifest per file is summed up in order; there are as many tasks as
    files, which are read by their index, a few megabytes at a time, and every checksum is
    tested.
    """
    manifest = spark.read.schema("part long, records long, ids long").parquet(f"{folder.rstrip('/')}/manifest")
    before = W.partitionBy(F.lit(0)).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    files = manifest.select("part", "records", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = place(folder)
        for batch in batches:
            for part, records, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                name = f"{root}/part-{part:06d}"
                with store.open_input_stream(f"{name}.idx") as f:
                    index = np.frombuffer(f.read(), INDEX)
                if len(index) != records:
                    raise ValueError(f"{name}: {len(index)} records, {records} in the manifest")
                with store.open_input_file(f"{name}.rec") as f:
                    yield from _read_file(f, index, start)

    return files.repartition(max(1, manifest.count()), "part").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _read_file(f: pa.NativeFile, index: np.ndarray, start: int) -> Iterator[pa.RecordBatch]:
    ends = np.append(index["offset"][1:], np.uint64(f.size())).astype(np.int64)
    offsets = index["offset"].astype(np.int64)
    first = 0
    while first < len(index):
        last = max(first + 1, int(np.searchsorted(ends, offsets[first] + READ_BYTES, side="right")))
        data = memoryview(f.read_at(int(ends[last - 1] - offsets[first]), int(offsets[first])))
        rows = []
        for k in range(first, last):
            doc_id, ids = parse(unframe(data[offsets[k] - offsets[first] : ends[k] - offsets[first]]))
            if len(ids) != index["n_ids"][k]:
                raise ValueError("index and record disagree")
            rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])
        first = last


def record_digests(docs: DataFrame, path: str) -> DataFrame:
    """Write all documents to a new shared folder and return what its files hold."""
    folder = scratch(docs.sparkSession, "records")
    write_records(docs, folder, path)
    return read_records(docs.sparkSession, folder)
