"""Token ids as Parquet list columns.

The file format is plain Parquet that any reader opens: ``doc_id``, ``n_tokens`` and ``ids``
(list of int). Rows are sorted by id over all files, ``ids`` is delta-packed in version 2 pages
without a dictionary, and row groups and pages are kept small, so that page indexes let a reader
fetch a range of ids, or only counts, without the rest.

Encoding splits texts at ASCII white space, which the tokenizer drops and no token crosses, and
encodes each different piece once; ``tests/llm`` compares with whole texts. A tokenizer whose
tokens hold white space needs another splitter.

Defined cases: null and empty texts have the end id only; repeated rows stay repeated; texts of
any length are one list; an empty table writes a file without rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tickfold.session import ship_package

ROWS_SCHEMA = "doc_id long, n_tokens int, ids array<int>"
READ_SCHEMA = "doc_id long, n_tokens long, ids_crc32 long, file string, row long"
PIECES_KEPT = 450_000  # of each generation; a few hundred bytes each
PIECES_AT_ONCE = 1000
TEXT_PART = 1 << 23  # characters encoded at a time


class Encoder:
    """Encodes batches of texts; each different piece between white space once.

    Pieces are kept in two generations: when the younger one is full it becomes the older one,
    which takes along what was used lately and forgets the rest."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def pieces(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as 32-bit integers."""
        if len(self.young) + len(texts) > PIECES_KEPT:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = []
        for t in texts:
            if t not in young:
                ids = old.get(t)
                if ids is None:
                    new.append(t)
                else:
                    young[t] = ids
        for i in range(0, len(new), PIECES_AT_ONCE):
            some = new[i : i + PIECES_AT_ONCE]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, "<i4")
            count = np.bincount(np.array(found.word_ids, np.int64), minlength=len(some))
            raw, edges = ids.tobytes(), (np.cumsum(count) * 4).tolist()
            young.update(
                (t, raw[a:b]) for t, a, b in zip(some, [0, *edges], edges, strict=False)
            )
        return [young[t] for t in texts]

    def __call__(self, texts: pa.Array, end_id: int) -> pa.ListArray:
        """A list of ids for each text, ``end_id`` last."""
        split = pc.ascii_split_whitespace(_plainer(texts))
        coded = split.values.slice(
            split.offsets[0].as_py(), split.offsets[-1].as_py() - split.offsets[0].as_py()
        ).dictionary_encode()
        ids = self.pieces(coded.dictionary.to_pylist())
        # Places fit 32 bits, as those of the list that is returned do.
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<i4")
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        which = coded.indices.to_numpy(zero_copy_only=False)
        # Tokens before each piece, and before each text with the end ids of those before it.
        before = np.zeros(len(which) + 1, np.int32)
        np.cumsum(sizes[which], out=before[1:])
        edges = split.offsets.to_numpy() - split.offsets[0].as_py()
        n = len(texts)
        offsets = before[edges] + np.arange(n + 1, dtype=np.int32)
        out = np.full(int(offsets[-1]), end_id, np.int32)
        # A token's place in ``flat``: its own place, moved by where its piece was coded.
        source = np.repeat(starts[which] - before[:-1], sizes[which])
        source += np.arange(int(before[-1]), dtype=np.int32)
        keep = np.ones(len(out), bool)
        keep[offsets[1:] - 1] = False
        out[keep] = flat[source]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out))


@functools.cache
def _encoder(path: str) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(path)


def _plainer(texts: pa.Array) -> pa.Array:
    """Texts with the same tokens and fewer different pieces: A-Z lowered, which the tokenizer
    does itself, and a space between a letter and a punctuation mark, where it always cuts.

    Not so where a mark combines with the letter before it, which lowering first could change,
    or where a special token may be spelled out."""
    special = pc.match_substring(texts, "<|")
    marks = pc.match_substring_regex(texts, "[\u0300-\u036f]")
    cut = "(\\pL)([!-&(-/:-;=-@])"  # ASCII marks but the apostrophe and <
    plain = pc.replace_substring_regex(pc.ascii_lower(texts), cut, "\\1 \\2")
    return pc.if_else(pc.or_(special, marks), texts, plain)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a bounded number of characters, or of one text."""
    sizes = np.cumsum(np.asarray(pc.binary_length(batch.column("text"))))
    at = 0
    while at < len(sizes):
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + TEXT_PART, "right")))
        yield batch.slice(at, to - at)
        at = to


def encode(
    df: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_tokens and ids of whole texts; ``tokenizer`` is a file all executors have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for whole in batches:
            for batch in _parts(whole):
                texts = batch.column("text").cast(pa.string())
                ids = encoder(texts, end_id)
                sizes = pc.list_value_length(ids)
                columns = [batch.column("doc_id"), sizes, ids]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"])

    ship_package(df.sparkSession)
    docs = df.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return docs.mapInArrow(run, ROWS_SCHEMA)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    files: int,
    row_group_mb: int = 8,
    page_kb: int = 64,
    **names: str,
) -> None:
    """Files in ascending order of id. Texts are dealt by ranges of ids and sorted, and each
    task encodes what it writes, so ids are never shuffled."""
    doc_id, text = names.get("doc_id", "doc_id"), names.get("text", "text")
    ordered = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(files, "doc_id")
        .sortWithinPartitions("doc_id")
    )
    (
        encode(ordered, tokenizer, end_id)
        .write.option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.block.size", row_group_mb << 20)
        .option("parquet.page.size", page_kb << 10)
        .option("compression", "zstd")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str, columns: str = ROWS_SCHEMA) -> DataFrame:
    """The rows, or with fewer columns in ``columns`` only those pages."""
    return spark.read.schema(columns).parquet(path)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        edges = lists.offsets.to_numpy()
        sums = [
            zlib.crc32(values[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pc.list_value_length(lists).cast(pa.int64()),
                pa.array(sums, pa.int64()),
                batch.column("file"),
                batch.column("row"),
            ],
            names=["doc_id", "n_tokens", "ids_crc32", "file", "row"],
        )


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files.

    Files hold ranges of ids in order, so a start is the tokens of the files before plus a
    running sum inside one file. There is one row per file in the small table."""
    ship_package(spark)
    place = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")]
    rows = read_tokens(spark, path).select("doc_id", "ids", *place)
    checked = rows.mapInArrow(_checked, READ_SCHEMA)
    sizes = (
        read_tokens(spark, path, "n_tokens int")
        .select("n_tokens", F.col("_metadata.file_name").alias("file"))
        .groupBy("file")
        .agg(F.sum("n_tokens").alias("n"))
    )
    # Files are numbered by task; as text 100000 would come before 99999.
    number = F.regexp_extract("file", "part-([0-9]+)", 1).cast("long")
    before = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = (
        Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        checked.join(first, "file")
        .withColumn(
            "start", F.col("first") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
        )
        .select("doc_id", "start", "n_tokens", "ids_crc32")
    )
