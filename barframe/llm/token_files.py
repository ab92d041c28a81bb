"""Token-id output: Parquet files of id lists that can be read in part.

Documents are range-partitioned by id and sorted, so that the files in name order hold the documents in id order. The
text is what is shuffled, once; a partition is tokenized in its final order and written straight away, so the (larger)
ids never move. A file row holds the document's id, the ids as a list column, their number and the row's place: its
partition and the number of ids before it in the partition. The list column is dictionary-encoded (a vocabulary has
few distinct ids) with delta encoding of the integers where a dictionary would not pay (Parquet's second data-page
version), the row groups and pages are bounded, and column and offset indexes are written, so that a reader of the
metadata, or of a range of documents, reads neither the id pages nor the row groups beside it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barframe.config import shared_dir
from barframe.llm.bpe_trie import BATCH_ROWS, WORD_END, WordMemory, default_path, worker

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000

# Pieces handed to the library as one text.
TOGETHER = 1_000


class LibraryWorker(WordMemory):
    """Values are ids as little-endian 32-bit integers, by the tokenizers library. The library's splitter never joins
    what white space parts and every piece ends in a word-end token, so many pieces are encoded as one text and their
    ids are told apart by these tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.ends = np.zeros(self.lib.get_vocab_size(), bool)
        self.ends[[i for t, i in self.lib.get_vocab().items() if t.endswith(WORD_END)]] = True

    def of_pieces(self, pieces: list[str]):
        runs = [pieces[k:k + TOGETHER] for k in range(0, len(pieces), TOGETHER)]
        for run, found in zip(runs, self.lib.encode_batch_fast([" ".join(r) for r in runs], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            cuts = [0, *((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()]
            raw = ids.tobytes()
            yield from zip(run, [raw[s:e] for s, e in zip(cuts, cuts[1:])], strict=True)

    def of_odd_words(self, words: list[str]):
        for w, found in zip(words, self.lib.encode_batch_fast(words, add_special_tokens=False)):
            yield w, np.array(found.ids, "<u4").tobytes()

    def joined(self, values: list) -> bytes:
        return b"".join(values)


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int | None = 2,
                      id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> None:
    """Tokenize whole texts and write them to ``path`` in ascending order of ``id_col``.

    Null text is an empty text: its list holds the end id alone (or nothing without one). Null ids come first.
    Repeated ids are ordered by their text, and rows equal in both are interchangeable. Other columns are not read.
    An empty table writes files without rows. ``partitions`` defaults to the session's shuffle partitions.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or default_path()
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches):
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for b in (b.slice(k, BATCH_ROWS) for b in batches for k in range(0, b.num_rows, BATCH_ROWS)):
            texts = [t or "" for t in b.column(1).to_pylist()]
            found = [x + tail for x in worker(LibraryWorker, tokenizer).encode(texts)]
            sizes = np.array([len(x) // 4 for x in found], np.int64)
            ends = np.cumsum(sizes)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()),
                                             pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), lists, pa.array(sizes), pa.array(np.full(len(found), part, np.int32)),
                 pa.array(before + ends - sizes)], names=["id", "ids", "n_tokens", "part", "part_start"])
            before += int(ends[-1]) if len(ends) else 0

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    # The ranges are cut from a sample of keys that the driver sees. Of a text only its beginning is part of the key, which
    # orders as the text does: equal keys share a partition, and the sort puts them in order of the whole text.
    (rows.repartitionByRange(n, F.col("id").asc_nulls_first(), F.substring("text", 1, 32))
     .sortWithinPartitions(F.col("id").asc_nulls_first(), F.col("text"))
     .mapInArrow(run, f"id {kind}, ids array<int>, n_tokens bigint, part int, part_start bigint")
     .withColumnRenamed("id", id_col)
     .write.option("compression", "zstd").option("parquet.writer.version", "v2")
     .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
     .option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path))


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """The files' rows with ``start``, the number of ids in all documents before. Only the columns asked for are read.

    The partitions' sizes are one row per partition that was written (at most the shuffle partitions), so their
    running sum is one small window and that side is broadcast; it is made from the two narrow columns alone.
    """
    rows = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (rows.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
             .select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("base")))
    return (rows.join(F.broadcast(bases), "part")
            .select(id_col, "ids", "n_tokens", (F.col("base") + F.col("part_start")).alias("start")))


def list_crc32(ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of rows read from token files."""

    def run(batches):
        for b in batches:
            lists = b.column(3)
            flat = np.asarray(lists.values, dtype="<u4")
            ends = np.asarray(lists.offsets)
            crcs = [zlib.crc32(flat[ends[i]:ends[i + 1]].tobytes()) for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(crcs, pa.int64())],
                                             names=["id", "start", "n_tokens", "ids_crc32"])

    rows = ids.select(ids[id_col].alias("id"), "start", "n_tokens", "ids")
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(run, f"id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
            .withColumnRenamed("id", id_col))


def token_file_digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    spark = docs.sparkSession
    path = shared_dir(spark, "token-files")
    write_token_files(docs, path, tokenizer)
    return list_crc32(read_token_files(spark, path))
