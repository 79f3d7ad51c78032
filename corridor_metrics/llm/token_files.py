"""Token ids in Arrow files of equal-length sequences, readable in place.

``write_token_files`` encodes texts in document order and writes one Arrow file (the
streaming format with a footer) per partition: fixed-size lists of ids and of mask bits,
every batch with the same number of sequences, so that sequence ``i`` stands in batch
``i // rows`` and any token is found by division. Only the last sequence of a file is
padded, with mask 0. A second small file per partition holds each document's place.
A memory-mapped file is read without copying.

Files are written under a name of the attempt and then moved to their final name, so a task
that runs twice leaves one file with the same content.

Defined results: NULL texts count as empty (they hold only the end id); documents are in
ascending id, NULL ids first, equal ids by the CRC-32 of their text; a repeated row is
written as often as it occurs; an empty table writes no documents.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corridor_metrics.llm.common import gathered, payload, spread

SEQUENCE = 1024
ROWS = 1024  # sequences per batch
CHUNK_BYTES = 6 << 20  # text encoded at a time
MEMO_BYTES = 208 << 20  # of words remembered per worker and their ids, as estimated when they are added
ENTRY = 150  # bytes of a remembered word beside its own and those of its ids
MARK = b"~"  # stands between words that are encoded together
LINE = 256  # words encoded together

MANIFEST = "shard int, path string, n_docs long, n_tokens long"
PLACED = "doc_id long, shard int, begin long, n_tokens long, ids_crc32 long"


class WordEncoder:
    """Ids of whole texts from the tokenizers library, remembered by word.

    For tokenizers that drop white space and never look across it: a text's ids are those of
    its ASCII-space separated words in turn.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[bytes, bytes] = {}
        self.size = 0
        (self.mark,) = self._encode([MARK])[0].ids
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")

    def _encode(self, texts: list[bytes]) -> list:
        return self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)

    def _learn(self, words: list[bytes]) -> None:
        """Of distinct words, new ones go to the library many to a line, with a mark between them that has an id of its own."""
        memo = self.memo
        fresh = [w for w in words if w not in memo]
        if self.size + sum(map(len, fresh)) + ENTRY * len(fresh) > MEMO_BYTES:
            memo.clear()
            self.size = 0
            fresh = words
        plain = [w for w in fresh if MARK not in w]
        for at in range(0, len(plain), 32 * LINE):
            lines = [plain[i : i + LINE] for i in range(at, min(at + 32 * LINE, len(plain)), LINE)]
            found = self._encode([(b" " + MARK + b" ").join(line) for line in lines])
            for line, encoded in zip(lines, found):
                ids = np.array(encoded.ids, self.dtype)
                cuts = np.flatnonzero(ids == self.mark) * ids.itemsize
                data = ids.tobytes()
                starts, stops = [0, *(cuts + ids.itemsize).tolist()], [*cuts.tolist(), len(data)]
                memo.update((w, data[a:b]) for w, a, b in zip(line, starts, stops))
                self.size += sum(map(len, line)) + len(data) + ENTRY * len(line)
        marked = [w for w in fresh if MARK in w]
        for word, encoded in zip(marked, self._encode(marked)):
            memo[word] = np.array(encoded.ids, self.dtype).tobytes()
            self.size += len(word) + len(memo[word]) + ENTRY

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a binary column: words are split and numbered by Arrow, and looked up once each."""
        split = pc.ascii_split_whitespace(texts.cast(pa.large_binary()).cast(pa.large_string(), safe=False))
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        numbered = split.flatten().cast(pa.large_binary()).dictionary_encode()
        words = numbered.dictionary.to_pylist()
        self._learn(words)
        known = [self.memo[w] for w in words]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // self.dtype.itemsize
        pool = np.frombuffer(b"".join(known), self.dtype)
        code = numbered.indices.to_numpy()
        count = sizes[code]
        ends = np.cumsum(count)
        begin = np.cumsum(sizes) - sizes
        ids = pool[np.repeat(begin[code] - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)]
        edge = np.append(0, ends)[offsets]
        return [ids[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a worker, so that its words stay known."""
    return WordEncoder(path)


def _schema(ids: pa.DataType, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])


INDEX = pa.schema([("doc_id", pa.int64()), ("begin", pa.int64()), ("n_tokens", pa.int64())])


class SequenceWriter:
    """Packs a stream of ids into one file."""

    def __init__(self, sink, dtype: np.dtype, length: int, rows: int):
        self.dtype, self.length, self.batch_ids = dtype, length, length * rows
        self.schema = _schema(pa.from_numpy_dtype(dtype), length)
        self.file = ipc.new_file(sink, self.schema)
        self.held: list[bytes] = []
        self.size = 0  # bytes held
        self.n_tokens = 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.size += len(ids)
        self.n_tokens += len(ids) // self.dtype.itemsize
        full = self.batch_ids * self.dtype.itemsize
        if self.size >= full:
            data = b"".join(self.held)
            whole = len(data) // full * full
            for at in range(0, whole, full):
                self._batch(np.frombuffer(data[at : at + full], self.dtype))
            self.held, self.size = [data[whole:]], len(data) - whole

    def _batch(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        padded = np.zeros(rows * self.length, self.dtype)
        padded[: len(ids)] = ids
        mask = np.zeros(len(padded), bool)
        mask[: len(ids)] = True
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (padded, mask)]
        self.file.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        if self.size:
            self._batch(np.frombuffer(b"".join(self.held), self.dtype))
        self.file.close()


class SequenceFile:
    """Sequences and masks of one file, as views of its pages where it can be mapped."""

    def __init__(self, filesystem: fs.FileSystem, path: str):
        local = isinstance(filesystem, fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else filesystem.open_input_file(path)
        self.file = ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 1
        self._batch: tuple[int, pa.RecordBatch | None] = (-1, None)

    def batch(self, k: int) -> pa.RecordBatch:
        if self._batch[0] != k:
            self._batch = (k, self.file.get_batch(k))
        return self._batch[1]

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of one sequence, uncopied."""
        batch, row = self.batch(i // self.rows), i % self.rows
        at = row * self.length
        return self._flat(batch)[at : at + self.length], batch.column(1).values.slice(at, self.length)

    @staticmethod
    def _flat(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(0).values.to_numpy(zero_copy_only=True)

    def tokens(self, begin: int, count: int) -> Iterator[np.ndarray]:
        """Views that together hold ``count`` ids from ``begin`` on."""
        full = self.rows * self.length
        while count > 0:
            at = begin % full
            piece = self._flat(self.batch(begin // full))[at : at + count]
            yield piece
            begin += len(piece)
            count -= len(piece)


def _write(path: str, folder: str, end_id: int, length: int, rows: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        filesystem, base = fs.FileSystem.from_uri(folder)
        encode = word_encoder(path)
        name, attempt = f"{base}/part-{shard:06d}", uuid.uuid4().hex
        end = np.array([end_id], encode.dtype).tobytes()
        n_docs = 0
        with filesystem.open_output_stream(f"{name}.{attempt}") as sink, filesystem.open_output_stream(f"{name}.{attempt}.i") as side:
            writer, index = SequenceWriter(sink, encode.dtype, length, rows), ipc.new_file(side, INDEX)
            for batch in gathered(batches, "text", CHUNK_BYTES):
                places = []
                for ids in encode(batch.column("text").combine_chunks()):
                    places.append(writer.n_tokens)
                    writer.add(ids.tobytes() + end)
                begin = np.array(places, np.int64)
                count = np.diff(np.append(begin, writer.n_tokens))
                docs = batch.column("doc").combine_chunks()
                index.write_batch(pa.record_batch([docs, pa.array(begin), pa.array(count)], schema=INDEX))
                n_docs += len(places)
            writer.close()
            index.close()
        filesystem.move(f"{name}.{attempt}", f"{name}.arrow")
        filesystem.move(f"{name}.{attempt}.i", f"{name}.index.arrow")
        yield pa.record_batch(
            [pa.array([shard], pa.int32()), pa.array([name]), pa.array([n_docs]), pa.array([writer.n_tokens])],
            names=["shard", "path", "n_docs", "n_tokens"],
        )

    return write


def write_token_files(
    df: DataFrame, tokenizer: str, folder: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    length: int = SEQUENCE, rows: int = ROWS,
) -> DataFrame:
    """Write the files and return their manifest, which is also stored in ``folder``."""
    filesystem, base = fs.FileSystem.from_uri(folder)
    filesystem.create_dir(base, recursive=True)
    docs = df.select(F.col(id_col).cast("long").alias("doc"), payload(text_col).alias("text"))
    ordered = docs.withColumn("crc", F.crc32("text")).repartitionByRange("doc", "crc").sortWithinPartitions("doc", "crc")
    manifest = ordered.select("doc", "text").mapInArrow(_write(tokenizer, folder, end_id, length, rows), MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return df.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _read(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for shard, path in zip(batch.column("shard").to_pylist(), batch.column("path").to_pylist()):
                tokens = SequenceFile(filesystem, f"{path}.arrow")
                with filesystem.open_input_file(f"{path}.index.arrow") as side:
                    index = ipc.open_file(side)
                    for k in range(index.num_record_batches):
                        places = index.get_batch(k)
                        sums = []
                        for begin, count in zip(places.column("begin").to_pylist(), places.column("n_tokens").to_pylist()):
                            crc = 0
                            for piece in tokens.tokens(begin, count):
                                crc = zlib.crc32(piece.astype("<u4"), crc)
                            sums.append(crc)
                        n = places.num_rows
                        yield pa.record_batch(
                            [places.column("doc_id"), pa.array([shard] * n, pa.int32()), places.column("begin"), places.column("n_tokens"), pa.array(sums, pa.int64())],
                            names=["doc_id", "shard", "begin", "n_tokens", "ids_crc32"],
                        )

    return read


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document's place and checksum, read from the files: doc_id, shard, begin, start, n_tokens, ids_crc32."""
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    placed = spread(manifest.select("shard", "path"), "shard").mapInArrow(_read(folder), PLACED)
    return placed.join(F.broadcast(bases), "shard").select(
        "doc_id", "shard", "begin", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"
    )
