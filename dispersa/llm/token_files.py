"""Token-id files: Parquet list columns with delta-encoded ids, controlled row groups and page indexes.

``write_tokens`` sorts the documents by id (range partitioning, so file k holds smaller ids than file
k + 1), encodes each text with the tokenizers library, appends an end id and writes per file, in id order:

    doc_id, file_no, file_start (ids before the document in its file), n_tokens, tokens array<int>

Row groups and pages are small enough for selective reads: Parquet's column indexes hold the minimum and
maximum doc_id of each page, so a filter on ``doc_id`` reads few pages, and metadata columns are read
without the tokens. Format version 2 writes ids as DELTA_BINARY_PACKED once the dictionary is off.
``read_tokens`` adds ``start``, the number of ids of all documents before.

Encoding is cached per worker. Plain texts (ASCII and Latin-1 letters) are cut into pre-tokens here, whose ids
come from the library's model; other texts are cut at white space, plain pieces are treated likewise and anything
else goes through the library's whole chain.

Defined results: NULL and empty texts have only the end id; rows with equal ids follow each other in the
order of their text's hash, exact repeats in any order (they are alike); rows with a NULL id come first; an
empty table gives no rows. Extra columns are not written.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispersa.llm import text as T
from dispersa.llm.shared import RecentCache, new_path, per_worker

CACHED_CHUNKS = 20_000  # per generation in a worker
CACHED_WORDS = 100_000  # some 15 MB
BROADCAST_FILES = 100_000  # file starts up to this number are sent to all executors (2 MB)
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10

# What the vocabulary's own pre-tokenizer does to lower-case ASCII and Latin-1 letters.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")
_PLAIN_TEXT = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
_WORDS = re.compile("[a-zß-öø-ÿ]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^\t-\r a-z0-9ß-öø-ÿ]+")  # its cases, frequent ones first


class Encoder:
    """Ids of texts as little-endian 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.plain = _splits_words(path)
        self.model = self.library.model
        # The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
        other = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
        self.alphabet = {b: 256 + i for i, b in enumerate(other)}
        self.chunks, self.words = RecentCache(CACHED_CHUNKS), RecentCache(CACHED_WORDS)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case pre-tokens, straight from the library's model."""
        tokenize, alphabet = self.model.tokenize, self.alphabet
        found = [[t.id for t in tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(alphabet))] for w in words]
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in found]

    def _chunk_ids(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of white-space chunks."""
        out: list[bytes] = [b""] * len(chunks)
        words: list[str] = []
        cuts: list[tuple[int, int, int]] = []
        other: list[int] = []
        for i, raw in enumerate(chunks):
            chunk = raw.decode()
            if self.plain and _PLAIN.fullmatch(chunk) and "<|" not in chunk:
                found = _WORDS.findall(chunk.lower())
                cuts.append((i, len(words), len(words) + len(found)))
                words += found
            else:
                other.append(i)
        ids = self.words.get_all(words, self._word_ids)
        for i, lo, hi in cuts:
            out[i] = b"".join(ids[lo:hi])
        if other:
            for i, x in zip(other, self._library([chunks[i].decode() for i in other])):
                out[i] = x
        return out

    def encode(self, text: bytes) -> bytes:
        whole = text.decode()
        if self.plain and _PLAIN_TEXT.fullmatch(whole) and "<|" not in whole:
            return b"".join(self.words.get_all(_WORDS.findall(whole.lower()), self._word_ids))
        return b"".join(self.chunks.get_all(text.split(), self._chunk_ids))


def _splits_words(path: str) -> bool:
    """True if the file's pre-tokenizer is the one that ``_WORDS`` follows, after lower-casing."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    want = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
    return kinds == ["NFC", "Replace", "Lowercase"] and first.get("pattern") == {"Regex": want}


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Encodes and writes all documents. One shuffle of the texts (range partitioning by id)."""
    kind = dict(docs.dtypes)[id_col]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(("tokenizers", tokenizer_path), lambda: Encoder(tokenizer_path))
        file_no, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in T.slices(batch.column(1), T.TEXT_BYTES):
                raw, b = part.data.tobytes(), part.bounds.tolist()
                ids = [encoder.encode(raw[b[r]: b[r + 1]]) + end for r in range(part.rows)]
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                at = before + np.concatenate([[0], np.cumsum(sizes)])
                tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                                                  pa.array(np.frombuffer(b"".join(ids), "<i4")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, part.rows), pa.array(np.full(part.rows, file_no), pa.int32()),
                     pa.array(at[:-1], pa.int64()), pa.array(sizes, pa.int64()), tokens],
                    [id_col, "file_no", "file_start", "n_tokens", "tokens"])
                before = int(at[-1])

    # The text's hash keeps rows with one id apart, so even a very frequent id spreads over files.
    order = [F.col(id_col), F.xxhash64(text_col)]
    ordered = docs.select(F.col(id_col), F.col(text_col)).repartitionByRange(*order).sortWithinPartitions(*order)
    (ordered.mapInArrow(run, f"`{id_col}` {kind}, file_no int, file_start long, n_tokens long, tokens array<int>")
     .write
     .option("parquet.block.size", str(ROW_GROUP_BYTES))
     .option("parquet.page.size", str(PAGE_BYTES))
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", "false")
     .option("compression", "zstd")
     .parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``start``: ids of all documents before, over all files."""
    rows = spark.read.parquet(path)
    sizes = rows.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    # One row per file. Running totals go through the driver as two numbers a file.
    total, starts = 0, []
    for r in sorted(sizes.collect(), key=lambda r: r.file_no):
        starts.append((r.file_no, total))
        total += r.n
    files = spark.createDataFrame(starts, "file_no int, files_before long")
    if len(starts) <= BROADCAST_FILES:
        files = F.broadcast(files)
    return (rows.join(files, "file_no")
            .withColumn("start", F.col("files_before") + F.col("file_start"))
            .drop("files_before"))


def digests(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers."""
    kind = dict(tokens.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ids = np.asarray(lists.flatten(), "<u4").tobytes()
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]) * 4
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(at) // 4, pa.int64()), pa.array(crc, pa.int64())],
                [id_col, "start", "n_tokens", "ids_crc32"])

    return tokens.select(id_col, "start", "tokens").mapInArrow(
        run, f"`{id_col}` {kind}, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Writes the files into a new folder under the checkpoint folder and reads them back."""
    spark = docs.sparkSession
    path = new_path(spark, "token-files")
    write_tokens(docs, path, tokenizer_path, end_id, id_col, text_col)
    return read_tokens(spark, path)
