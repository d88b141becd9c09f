"""Token ids of a corpus as flat binary files.

Each file set holds documents in ascending id order, over the file sets of a manifest:
``.bin`` is the ids as unsigned integers without a header (16 bits if the vocabulary allows,
else 32, little-endian), ``.off`` the documents' places as 64-bit offsets from the start of
the whole corpus (one more than documents), ``.arrow`` the documents' ids and lengths.  A
reader maps ``.bin`` and ``.off`` into memory.

One range exchange puts the documents into order.  Each task encodes its range and streams the
ids into files, under names of its own; only the listing that Spark commits counts, so a lost or
repeated task leaves nothing doubled.  Prefix sums over the listing (one row a file) give
each file's base, with which the offsets are then written.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.bpe_codec import encoder
from lakekit.llm.common import focus, staged
from lakekit.llm.packing import _id_bytes
from lakekit.session import work_dir

END_ID = 2
FILE_TOKENS = 128 << 20     # a file is closed beyond so many ids,
FILE_DOCS = 1 << 20         # or documents
TASK_BYTES = 512 << 20      # text that a task sorts and encodes
LEAST_BYTES = 4 << 20       # small corpora: a task for so much, up to four for each core
READ_TOKENS = 4 << 20       # ids looked at together by a reader


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    """Hadoop writes local folders as file:/x."""
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri if ":" in uri else f"file://{uri}"))


def id_type(ids: int) -> np.dtype:
    """The narrowest unsigned type for ``ids`` different ids."""
    return np.dtype("<u2") if ids <= 1 << 16 else np.dtype("<u4")


class TokenFile:
    """One file set, opened for reading: ``docs`` (ids and lengths), ``offsets``, ``tokens(start, stop)``."""

    def __init__(self, path: str, dtype: str):
        self.store, place = _store(path)
        self.dtype = np.dtype(dtype)
        self.ids = f"{place}.bin"
        if isinstance(self.store, pafs.LocalFileSystem):
            self.offsets = np.memmap(f"{place}.off", dtype="<u8", mode="r")
            self.flat = np.memmap(self.ids, dtype=self.dtype, mode="r")
            self.docs = pa.ipc.open_file(pa.memory_map(f"{place}.arrow"))
        else:       # an object store can't be mapped: ranges are read
            with self.store.open_input_file(f"{place}.off") as f:
                self.offsets = np.frombuffer(f.read(), dtype="<u8")
            self.flat, self.docs = None, pa.ipc.open_file(self.store.open_input_file(f"{place}.arrow"))

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to ``stop``, counted over the whole corpus."""
        base = int(self.offsets[0])
        if self.flat is not None:
            return self.flat[start - base: stop - base]
        with self.store.open_input_file(self.ids) as f:
            width = self.dtype.itemsize
            return np.frombuffer(f.read_at((stop - start) * width, (start - base) * width), dtype=self.dtype)

    def documents(self) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        """(ids of documents, their offsets and the end, their tokens), some documents at a time."""
        at = 0
        for k in range(self.docs.num_record_batches):
            ids = self.docs.get_batch(k).column(0)
            done = 0
            while done < len(ids):
                places = self.offsets[at: at + len(ids) - done + 1].astype(np.int64)
                n = max(1, int(np.searchsorted(places, places[0] + READ_TOKENS, side="right")) - 1)
                yield ids.slice(done, n), places[: n + 1], self.tokens(int(places[0]), int(places[n]))
                done, at = done + n, at + n


def _write_files(path: str, end_id: int, folder: str, dtype: np.dtype, file_tokens: int, file_docs: int):
    """Encode sorted (id, text) rows and stream them into files: one row (part, file, path, docs, tokens) each."""
    end = end_id.to_bytes(4, "little")

    def write(batches):
        focus(encoder, _id_bytes)
        ids_of = _id_bytes(path)
        part, number = TaskContext.get().partitionId(), 0
        out = None
        for batch in batches:
            encoded = [np.frombuffer(ids_of(t or "") + end, dtype="<u4").astype(dtype) for t in batch.column(1).to_pylist()]
            n = np.array([len(x) for x in encoded], np.int64)
            at = 0
            while at < len(n):
                if out is None:
                    store, place = _store(f"{folder}/{part:06d}-{number:04d}-{uuid.uuid4().hex[:12]}")
                    out, side = store.open_output_stream(f"{place}.bin"), store.open_output_stream(f"{place}.arrow")
                    table = pa.ipc.new_file(side, pa.schema([("id", batch.schema.field(0).type), ("n", pa.int64())]))
                    docs = tokens = 0
                # as many documents as the file takes: at least one
                fits = int(np.searchsorted(np.cumsum(n[at:]), file_tokens - tokens, side="right"))
                stop = at + max(1 if not docs else 0, min(fits, file_docs - docs))
                if stop > at:
                    out.write(np.concatenate(encoded[at:stop]).tobytes())
                    table.write_batch(pa.RecordBatch.from_arrays([batch.column(0).slice(at, stop - at), pa.array(n[at:stop])], names=["id", "n"]))
                docs, tokens, full = docs + stop - at, tokens + int(n[at:stop].sum()), stop < len(n)
                at = stop
                if full:
                    yield listed(part, number, place, docs, tokens, out, table, side)
                    out, number = None, number + 1
        if out is not None:
            yield listed(part, number, place, docs, tokens, out, table, side)

    def listed(part, number, place, docs, tokens, out, table, side):
        table.close(), side.close(), out.close()
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([f"{folder}/{place.rsplit('/', 1)[1]}"]),
                                           pa.array([docs], pa.int64()), pa.array([tokens], pa.int64())], names=["part", "file", "path", "docs", "tokens"])

    return write


def write_token_files(docs: DataFrame, path: str, end_id: int = END_ID, folder: str | None = None, file_tokens: int = FILE_TOKENS,
                      file_docs: int = FILE_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text (NULL: empty) with the vocabulary file ``path``, append
    ``end_id``, and write the ids into ``folder`` (default: a new shared one) in ascending
    order of the documents' ids.

    Returns the manifest, one row a file: part, file, path (without suffix), docs, tokens,
    first_doc and first_token (what lies before it), dtype.  Repeated rows stay; rows with the
    same id lie next to each other, ordered by a hash of their text; a NULL id comes before
    all others; an empty table gives no file; other columns are left out.  ``docs`` is read
    twice (sizes and ranges, then texts) and must give its rows in the same order, as tables do.
    """
    spark = docs.sparkSession
    dtype = id_type(max(encoder(path).library.get_vocab_size(), end_id + 1))
    folder = folder or work_dir(spark, "token-files")
    store, place = _store(folder)
    store.create_dir(place, recursive=True)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    n_docs, n_bytes = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()
    least = min(4 * spark.sparkContext.defaultParallelism, -(-n_bytes // LEAST_BYTES))
    parts = max(1, -(-n_bytes // TASK_BYTES), -(-n_docs // file_docs), least)
    order = ["_id", "_hash", "_tie"]    # the tie splits rows that are alike over ranges
    keyed = rows.withColumn("_hash", F.xxhash64("_text")).withColumn("_tie", F.monotonically_increasing_id())
    ranged = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("_id", "_text")
    write = _write_files(path, end_id, folder, dtype, file_tokens, file_docs)
    listing = staged(ranged.mapInArrow(write, "part int, file int, path string, docs bigint, tokens bigint"), "token-listing")
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)      # one small row a file
    based = listing.select("*", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"first_{name}") for c, name in (("docs", "doc"), ("tokens", "token"))))

    def offsets(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("first_token").to_pylist()):
                store, place = _store(path)
                with store.open_input_file(f"{place}.arrow") as f, store.open_output_stream(f"{place}.off") as out:
                    table, at = pa.ipc.open_file(f), base
                    out.write(np.array([at], dtype="<u8").tobytes())
                    for k in range(table.num_record_batches):
                        ends = at + np.cumsum(table.get_batch(k).column(1).to_numpy())
                        out.write(ends.astype("<u8").tobytes())
                        at = int(ends[-1])
            yield batch

    manifest = _spread(based).mapInArrow(offsets, based.schema).withColumn("dtype", F.lit(dtype.str))
    return staged(manifest, "token-manifest")


def _spread(files: DataFrame) -> DataFrame:
    """Rows that stand for files, dealt evenly over tasks."""
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartitionByRange(n, "path")


def _read(manifest: DataFrame, id_type: str, columns: str, row) -> DataFrame:
    def read(batches):
        focus()
        for batch in batches:
            for path, dtype in zip(batch.column("path").to_pylist(), batch.column("dtype").to_pylist()):
                for ids, places, tokens in TokenFile(path, dtype).documents():
                    yield row(ids, places, tokens)

    return _spread(manifest.select("path", "dtype")).mapInArrow(read, f"doc_id {id_type}, {columns}")


def read_token_files(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """doc_id, start (ids of all documents before it), ids: the documents as they lie in the files."""
    def row(ids, places, tokens):
        values = pa.ListArray.from_arrays(pa.array((places - places[0]).astype(np.int32)), pa.array(tokens.astype(np.int64)))
        return pa.RecordBatch.from_arrays([ids, pa.array(places[:-1]), values], names=["doc_id", "start", "ids"])

    return _read(manifest, id_type, "start bigint, ids array<bigint>", row)


def token_file_digests(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""
    def row(ids, places, tokens):
        data, at = memoryview(tokens.astype("<u4").tobytes()), (4 * (places - places[0])).tolist()
        crc = [zlib.crc32(data[a:b]) for a, b in zip(at, at[1:])]
        return pa.RecordBatch.from_arrays([ids, pa.array(places[:-1]), pa.array(np.diff(places)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _read(manifest, id_type, "start bigint, n_tokens bigint, ids_crc32 bigint", row)


def round_trip(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Write all documents' ids and read the files back: one row a document, as ``token_file_digests``."""
    return token_file_digests(write_token_files(docs, path, end_id), docs.schema["doc_id"].dataType.simpleString())
