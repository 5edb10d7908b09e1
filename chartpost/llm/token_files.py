"""Token ids in files: frequency ranks in a byte-aligned code with separate control bytes."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartpost.llm.tables import new_folder, session, shuffles_freed, store
from chartpost.llm.tokens import slices, token_ids, with_end
from chartpost.session import shuffle_partitions

# A file is blocks: this header, then doc ids (8 bytes each), null marks (1), lengths (4),
# and the ids: control bytes and data bytes, or the bare ids while ranks are unknown.
HEADER = struct.Struct("<4sIQQQ")
CODED = b"TKV1"
# Bare ids take two bytes each where the vocabulary allows, else four.
PLAIN = {"<u2": b"TKP2", "<u4": b"TKP4"}
BLOCK_IDS = 1 << 19
# Bytes of the four values under each control byte, two bits a value, lowest first.
SIZES = ((np.arange(256)[:, None] >> np.arange(0, 8, 2)) & 3).astype(np.uint8) + 1
FILES = "bucket int, path string, n_docs long, n_ids long, counts binary"
# Files whose id counts are summed by one task before they are summed over all.
FILES_PER_SUM = 64
FILE_SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("counts", pa.binary())]
)
# Ranges per shuffle partition; several small ones even out.
RANGES = 3


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes (two bits a value: its bytes less one) and data bytes."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    control = codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    size = SIZES[np.frombuffer(control, np.uint8)].ravel()[:count]
    ranks = np.zeros((count, 4), np.uint8)
    ranks[np.arange(4) < size[:, None]] = np.frombuffer(data, np.uint8)
    return ranks.view("<u4").ravel()


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class BlockWriter:
    """Writes documents to one file, a block at a time."""

    def __init__(self, folder: str, prefix: str):
        store_at, path = open_folder(folder)
        # A name of its own per attempt: only files that a finished task names are read.
        self.name = f"{prefix}-{uuid.uuid4().hex}.tok"
        self.stream = store_at.open_output_stream(f"{path}/{self.name}")
        self.docs = self.ids = 0

    def write(self, doc_ids: list[int | None], lengths: list[int], kind: bytes, control: bytes, data: bytes):
        self.docs, self.ids = self.docs + len(doc_ids), self.ids + sum(lengths)
        self.stream.write(HEADER.pack(kind, len(doc_ids), sum(lengths), len(control), len(data)))
        self.stream.write(np.array([i or 0 for i in doc_ids], "<i8").tobytes())
        self.stream.write(bytes(i is None for i in doc_ids))
        self.stream.write(np.array(lengths, "<u4").tobytes())
        self.stream.write(control)
        self.stream.write(data)

    def close(self) -> str:
        self.stream.close()
        return self.name


def read_blocks(folder: str, name: str) -> Iterator[tuple[list[int | None], np.ndarray, bytes, bytes, bytes]]:
    """(doc ids, lengths, kind, control bytes, data bytes) of each block in file order."""
    store_at, path = open_folder(folder)
    with store_at.open_input_stream(f"{path}/{name}") as stream:
        while head := stream.read(HEADER.size):
            kind, docs, _, n_control, n_data = HEADER.unpack(head)
            doc_ids = np.frombuffer(stream.read(8 * docs), "<i8").tolist()
            nulls = stream.read(docs)
            lengths = np.frombuffer(stream.read(4 * docs), "<u4").astype(np.int64)
            ids = [None if null else doc_id for doc_id, null in zip(doc_ids, nulls)]
            yield ids, lengths, kind, stream.read(n_control), stream.read(n_data)


def id_type(tokenizer: str, end_id: int) -> str:
    """The narrowest type of ids that holds the whole vocabulary and the end id."""
    return "<u2" if max(token_ids(tokenizer).largest, end_id) < 1 << 16 else "<u4"


def _binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Stretches of ``values`` between ``offsets`` as one binary value each."""
    ends = (offsets * values.itemsize).astype(np.int64)
    whole = pa.Array.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))]
    )
    return whole.cast(pa.binary())


def _encode(tokenizer: str, end_id: int, bounds: list[int], kind: str) -> Callable:
    """Documents -> their range of doc_id and their ids."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_ids(tokenizer)
        cuts, seen = np.array(bounds, np.int64), 0
        for doc_ids, texts in slices(batches):
            ids, offsets = with_end(*encoder.encode(texts), end_id)
            key = doc_ids.fill_null(np.iinfo(np.int64).min).to_numpy()
            low, high = np.searchsorted(cuts, key, "left"), np.searchsorted(cuts, key, "right")
            # An id that is a cut more than once fills several ranges; its rows are dealt to them.
            spread = np.where(high > low + 1, (seen + np.arange(len(key))) % np.maximum(high - low, 1), 0)
            seen += len(key)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(low + spread, pa.int32()),
                    doc_ids,
                    pa.array(np.diff(offsets), pa.int64()),
                    _binary(ids.astype(kind), offsets),
                ],
                ["bucket", "doc_id", "n_tokens", "ids"],
            )

    return encode


def _write_plain(folder: str, kind: str) -> Callable:
    """Sorted documents -> one file of plain ids per range, and how often each id is in it."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, bucket, writer = zstandard.ZstdCompressor(3), None, None
        counts = np.zeros(0, np.int64)
        doc_ids, lengths, held, waiting = [], [], [], 0

        def flush():
            nonlocal counts, waiting
            if not doc_ids:
                return
            raw = b"".join(held)
            found = np.bincount(np.frombuffer(raw, kind), minlength=len(counts))
            found[: len(counts)] += counts
            counts = found
            writer.write(doc_ids, lengths, PLAIN[kind], b"", raw)
            doc_ids.clear(), lengths.clear(), held.clear()
            waiting = 0

        def finish():
            nonlocal counts
            flush()
            row = {
                "bucket": [bucket],
                "path": [writer.close()],
                "n_docs": [writer.docs],
                "n_ids": [writer.ids],
                "counts": [press.compress(counts.astype("<i8").tobytes())],
            }
            counts = np.zeros(0, np.int64)
            return pa.RecordBatch.from_pydict(row, FILE_SCHEMA)

        for batch in batches:
            for now, doc_id, length, raw in zip(*(column.to_pylist() for column in batch.columns)):
                if now != bucket:
                    if writer:
                        yield finish()
                    bucket, writer = now, BlockWriter(folder, f"plain-{now:06d}")
                doc_ids.append(doc_id)
                lengths.append(length)
                held.append(raw)
                waiting += length
                if waiting >= BLOCK_IDS:
                    flush()
        if writer:
            yield finish()

    return write


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each id over the files of a task."""
    unpress, total = zstandard.ZstdDecompressor(), np.zeros(0, np.int64)
    for batch in batches:
        for blob in batch.column(0):
            counts = np.frombuffer(unpress.decompress(blob.as_py()), "<i8").copy()
            if len(counts) < len(total):
                counts, total = total, counts
            counts[: len(total)] += total
            total = counts
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])


def _write_coded(folder: str, vocabulary: np.ndarray, kind: str) -> Callable:
    """Each plain file -> one of ranks in the byte-aligned code."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.zeros(int(vocabulary.max(initial=0)) + 1, "<u4")
        rank[vocabulary] = np.arange(len(vocabulary))
        for batch in batches:
            for row in batch.to_pylist():
                writer = BlockWriter(folder, f"ids-{row['bucket']:06d}")
                for doc_ids, lengths, _, _, data in read_blocks(folder, row["path"]):
                    writer.write(doc_ids, lengths.tolist(), CODED, *encode_ranks(rank[np.frombuffer(data, kind)]))
                yield pa.RecordBatch.from_pylist([{**row, "path": writer.close()}], batch.schema)

    return write


def write_token_files(documents: DataFrame, tokenizer: str, folder: str, end_id: int) -> DataFrame:
    """Encode documents (doc_id, text; others ignored) and write them in doc_id order.

    Returns the manifest (bucket, path, n_docs, n_ids), in file order by bucket.  Rows of
    one doc_id stand side by side in no set order, and may cross a file border where one
    id fills more than a file; a null doc_id comes first; a null text is its end id alone.
    An empty table gives no files.  Ids are ranked by count over all documents, ties by id;
    the ranks, at most one per vocabulary entry, are the file ``vocabulary.u32``.
    """
    spark = session(documents.sparkSession)
    at, path = open_folder(folder)
    at.create_dir(path, recursive=True)
    parts = shuffle_partitions(spark)
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    shares = [k / (RANGES * parts) for k in range(1, RANGES * parts)]
    bounds = rows.agg(F.percentile_approx("doc_id", shares, 10 * RANGES * parts)).first()[0] or []
    kind = id_type(tokenizer, end_id)
    coded = rows.mapInArrow(
        _encode(tokenizer, end_id, bounds, kind), "bucket int, doc_id long, n_tokens long, ids binary"
    )
    with shuffles_freed(spark):
        files = store(
            coded.repartition(parts, "bucket")
            .sortWithinPartitions("bucket", "doc_id")
            .mapInArrow(_write_plain(folder, kind), FILES),
            "plain-files",
        )
    summed = files.select("counts").repartition(-(-files.count() // FILES_PER_SUM) or 1)
    counts = summed.mapInArrow(_sum_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ranked = counts.orderBy(F.desc("n"), "id")
    vocabulary = np.array([row.id for row in ranked.collect()], np.int64)
    with at.open_output_stream(f"{path}/vocabulary.u32") as stream:
        stream.write(vocabulary.astype("<u4").tobytes())
    manifest = files.select("bucket", "path", "n_docs", "n_ids")
    schema = "bucket int, path string, n_docs long, n_ids long"
    return store(
        manifest.repartition(RANGES * parts).mapInArrow(_write_coded(folder, vocabulary, kind), schema), "manifest"
    )


def _read_coded(folder: str, with_ids: bool) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, path = open_folder(folder)
        with at.open_input_stream(f"{path}/vocabulary.u32") as stream:
            vocabulary = np.frombuffer(stream.read(), "<u4")
        for batch in batches:
            for row in batch.to_pylist():
                start = row["first"]
                for doc_ids, lengths, _, control, data in read_blocks(folder, row["path"]):
                    ends = np.cumsum(lengths)
                    ids = vocabulary[decode_ranks(control, data, int(ends[-1]))]
                    begins = (ends - lengths).tolist()
                    blobs = [ids[a:b] for a, b in zip(begins, ends.tolist())]
                    columns = {
                        "doc_id": pa.array(doc_ids, pa.int64()),
                        "start": pa.array(start + ends - lengths, pa.int64()),
                        "n_tokens": pa.array(lengths, pa.int64()),
                        "ids_crc32": pa.array([crc32(blob) for blob in blobs], pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array([blob.tobytes() for blob in blobs], pa.binary())
                    yield pa.RecordBatch.from_pydict(columns)
                    start += int(ends[-1])

    return read


def read_token_files(
    spark: SparkSession, manifest: DataFrame, folder: str, with_ids: bool = True
) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, ids_crc32, and ids as 32-bit bytes."""
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return files.repartition(RANGES * shuffle_partitions(spark)).mapInArrow(_read_coded(folder, with_ids), schema)


def token_table(documents: DataFrame, tokenizer: str, end_id: int, with_ids: bool = False) -> DataFrame:
    """Write the documents' ids to files in the shared folder and read them back."""
    spark = session(documents.sparkSession)
    folder = new_folder(spark, "token-files")
    manifest = write_token_files(documents, tokenizer, folder, end_id)
    return read_token_files(spark, manifest, folder, with_ids)
