"""Token ids in Arrow files: fixed-size-list batches of equal-length sequences with masks."""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from folioflow.llm.arrays import run_starts, spread
from folioflow.llm.common import shared_folder, slices, table, texts

SEQUENCE = 2048
#: Sequences per record batch: 1024 * 2048 ids of two bytes are 4 MB.
BATCH_SEQUENCES = 1024
#: Documents per file aimed at; files are written by one task each.
FILE_DOCUMENTS = 20_000
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a worker keeps; the store is emptied when it is full.
CACHE_WORDS = 1_000_000

_INDEX = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("_order", pa.int64()),
        ("file", pa.string()),
        ("file_start", pa.int64()),
        ("n_tokens", pa.int64()),
    ]
)
_INDEX_DDL = "doc_id long, _order long, file string, file_start long, n_tokens long"


class WordEncoder:
    """Encodes texts through the words between blanks and line ends.

    The tokenizer drops white space before its merges, so no token reaches over a blank or a
    line end and the ids of a text are those of its words in order. Each different word goes
    to the library once per worker, as long as the store holds it.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self._empty()

    def _empty(self) -> None:
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.lengths = np.zeros(0, np.int64)

    def _learn(self) -> None:
        """Encode the words that were numbered since the last call."""
        new = list(islice(reversed(self.number), len(self.number) - len(self.lengths)))[::-1]
        if not new:
            return
        found = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        total = int(lengths.sum())
        if self.used + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + total))
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        self.used += total
        self.lengths = np.concatenate([self.lengths, lengths])
        self.starts = run_starts(self.lengths)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, flat, and their counts."""
        if len(self.number) > CACHE_WORDS:
            self._empty()
        words = [text.replace("\n", " ").split(" ") for text in texts]
        per_text = np.fromiter(map(len, words), np.int64, len(words))
        total = int(per_text.sum())
        which = np.fromiter(map(self.number.__getitem__, chain.from_iterable(words)), np.int64, total)
        self._learn()
        lengths = self.lengths[which]
        ids = self.ids[spread(self.starts[which], lengths)]
        ends = np.r_[0, np.cumsum(lengths)][np.r_[0, np.cumsum(per_text)]]
        return ids, np.diff(ends)


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker and vocabulary, kept between tasks."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def id_type(vocabulary: int) -> np.dtype:
    """The smallest unsigned type of two bytes or more that holds every id."""
    return np.dtype(np.uint16 if vocabulary <= 1 << 16 else np.uint32)


def file_schema(sequence: int, kind: np.dtype) -> pa.Schema:
    """Ids as integers, masks as bits."""
    return pa.schema(
        [
            ("input_ids", pa.list_(pa.field("item", pa.from_numpy_dtype(kind), False), sequence)),
            ("attention_mask", pa.list_(pa.field("item", pa.bool_(), False), sequence)),
        ]
    )


class TokenFileWriter:
    """Appends ids to one file; the last sequence is padded with 0 under a false mask.

    It holds one record batch, so memory does not depend on the file or on a document.
    """

    def __init__(
        self, sink, vocabulary: int, sequence: int = SEQUENCE, batch_sequences: int = BATCH_SEQUENCES
    ) -> None:
        self.sequence = sequence
        self.schema = file_schema(sequence, id_type(vocabulary))
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.buffer = np.zeros(sequence * batch_sequences, id_type(vocabulary))
        self.used = 0
        self.total = 0

    def append(self, ids: np.ndarray) -> int:
        """Add ids of documents; returns where they start in the file."""
        start = self.total
        self.total += len(ids)
        while len(ids):
            n = min(len(ids), len(self.buffer) - self.used)
            self.buffer[self.used : self.used + n] = ids[:n]
            self.used += n
            ids = ids[n:]
            if self.used == len(self.buffer):
                self._flush()
        return start

    def _flush(self) -> None:
        if not self.used:
            return
        rows = -(-self.used // self.sequence)
        ids = np.zeros(rows * self.sequence, self.buffer.dtype)
        ids[: self.used] = self.buffer[: self.used]
        mask = np.arange(rows * self.sequence) < self.used
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(v), type=f.type)
            for v, f in zip((ids, mask), self.schema)
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.used = 0

    def close(self) -> None:
        self._flush()
        self.writer.close()


class TokenFile:
    """Random access to one file. Over a memory map the arrays are views of the file's bytes."""

    def __init__(self, source) -> None:
        self.reader = pa.ipc.open_file(source)
        self.sequence = self.reader.schema.field("input_ids").type.list_size
        self._at = (-1, None)
        self.batch_sequences = self._batch(0).num_rows if self.reader.num_record_batches else 0

    def _batch(self, k: int) -> pa.RecordBatch:
        if self._at[0] != k:
            self._at = (k, self.reader.get_batch(k))
        return self._at[1]

    def _ids(self, k: int) -> np.ndarray:
        return self._batch(k).column("input_ids").values.to_numpy(zero_copy_only=True)

    def row(self, number: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of one sequence, as views."""
        k, i = divmod(number, self.batch_sequences)
        mask = self._batch(k).column("attention_mask").values
        return (
            self._ids(k)[i * self.sequence : (i + 1) * self.sequence],
            mask.slice(i * self.sequence, self.sequence),
        )

    def pieces(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from position `start` on, as views of the batches they lie in."""
        size = self.batch_sequences * self.sequence
        while n > 0:
            k, i = divmod(start, size)
            part = self._ids(k)[i : min(i + n, size)]
            yield part
            start, n = start + len(part), n - len(part)


def _open(path: str, create: bool = False):
    """A stream for a path of any file system Arrow knows; local files are mapped."""
    store, name = fs.FileSystem.from_uri(path)
    if create:
        return store.open_output_stream(name)
    if isinstance(store, fs.LocalFileSystem):
        return pa.memory_map(name)
    return store.open_input_file(name)


@dataclass(frozen=True)
class TokenDataset:
    """Where the files are and the index of documents: doc_id, start, file, file_start, n_tokens."""

    folder: str
    index: DataFrame
    sequence: int


def _uri(folder: str) -> str:
    """Hadoop writes file:/x for file:///x."""
    return folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder


def write_token_files(
    docs: DataFrame,
    load_encoder: Callable[[], WordEncoder],
    folder: str,
    end_id: int = END_ID,
    sequence: int = SEQUENCE,
    batch_sequences: int = BATCH_SEQUENCES,
    file_documents: int = FILE_DOCUMENTS,
) -> TokenDataset:
    """Encode every text, append the end id, and write all ids in ascending doc_id order.

    Documents are range-partitioned by id; one task writes one file, streaming. A file name
    holds a new random part for every attempt, and the index (a Parquet table committed by
    Spark) names only files of attempts that counted, so a lost executor or a second attempt
    leaves at most an unnamed file. Global starts are sums over the files' totals, one row each.

    Defined cases: a null text is the empty one, whose document is the end id alone; null ids
    come first; rows with the same id follow each other in the order of their texts; an empty
    table gives an index without rows. The last sequence of a file is padded under a
    false mask.
    """
    spark = docs.sparkSession
    root = _uri(folder)
    rows = texts(docs)
    n_files = max(1, -(-rows.count() // file_documents))
    ordered = rows.repartitionByRange(n_files, "_id", "_text_hash").sortWithinPartitions(
        "_id", "_text_hash", "text"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder()
        writer = sink = None
        name = ""
        for batch in batches:
            for first, last, _, _ in slices(batch):
                part = batch.slice(first, last - first)
                if writer is None:
                    name = f"tokens-{uuid.uuid4().hex}.arrow"
                    sink = _open(f"{root}/{name}", create=True)
                    writer = TokenFileWriter(sink, encoder.size, sequence, batch_sequences)
                ids, counts = encoder.encode(part.column("text").to_pylist())
                ends = np.cumsum(counts)
                # The end id goes behind each document.
                starts = writer.append(np.insert(ids, ends, end_id)) + np.r_[0, (ends + np.arange(1, len(ends) + 1))[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("_id"),
                        pa.array([name] * len(counts), pa.string()),
                        pa.array(starts, pa.int64()),
                        pa.array(counts + 1, pa.int64()),
                    ],
                    schema=_INDEX,
                )
        if writer is not None:
            writer.close()
            sink.close()

    folder_of = spark._jvm.org.apache.hadoop.fs.Path(folder)
    folder_of.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder_of)
    ordered.mapInArrow(write, _INDEX_DDL).write.parquet(f"{folder}/index")
    index = spark.read.schema(_INDEX_DDL).parquet(f"{folder}/index")
    files = index.groupBy("file").agg(
        F.min(F.struct("_order", "file")).alias("first"), F.sum("n_tokens").alias("total")
    )
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = index.join(bases, "file").select(
        "doc_id", (F.col("base") + F.col("file_start")).alias("start"), "file", "file_start", "n_tokens"
    )
    return TokenDataset(root, placed, sequence)


def read_documents(data: TokenDataset) -> DataFrame:
    """Read every document back from the files: doc_id, start, n_tokens, ids_crc32.

    The crc runs over the ids as little-endian unsigned 32-bit integers, view by view.
    """
    root = data.folder

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            sums, sizes = [], []
            columns = [batch.column(c).to_pylist() for c in ("file", "file_start", "n_tokens")]
            for file, start, n in zip(*columns):
                if file != name:
                    name, source = file, TokenFile(_open(f"{root}/{file}"))
                crc = found = 0
                for part in source.pieces(start, n):
                    crc = zlib.crc32(part.astype("<u4", copy=False), crc)
                    found += len(part)
                sums.append(crc)
                sizes.append(found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("start"),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    ordered = data.index.repartition("file").sortWithinPartitions("file", "file_start")
    return ordered.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_arrow_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token files in the shared folder and read them back."""
    import public_tokenizers

    path = public_tokenizers.path(TOKENIZER)
    data = write_token_files(
        table(spark, sf_dir, "documents"),
        lambda: word_encoder(path),
        shared_folder(spark, "tokens"),
    )
    return read_documents(data)
