"""Operator 3: token ids in length-delimited, checksummed binary records.

A record file is a sequence of frames:

    length  uint64   bytes of the payload
    check   uint32   masked CRC-32 of the eight length bytes
    payload          kind uint8, doc_id int64, ids
    check   uint32   masked CRC-32 of the payload
    end     0x0A

all little-endian. Bit 0 of ``kind`` marks a null doc_id, bit 1 ids of 32 bits
(16 bits where every id fits). A separate parquet index holds file, offset,
length and the number of ids before each record, for reads in any order.

Spark's own text writer writes the frames (the end byte is its line end), so
files appear through its commit protocol: a lost executor leaves no half file,
and any store that Spark can write will do.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cascara.llm.common import load_table, map_rows, query, scratch_path
from cascara.llm.encode import default_tokenizer, encoder, in_slices

# Fixed value: what masked checksums of record files add.
MASK = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_KEY = struct.Struct("<Bq")
_CHECK = struct.Struct("<I")
_INDEX = ("doc_id long, file string, file_no long, offset long, length long, "
          "start_in_file long, n_tokens long, ids_crc32 long")


def masked(data: bytes) -> int:
    """CRC-32, rotated and shifted so that stored checksums do not disturb the
    checksum of data that holds them."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    """One record without its end byte; ``ids`` are uint32 bytes."""
    wide = np.frombuffer(ids, dtype="<u4")
    narrow = not len(wide) or int(wide.max()) < 1 << 16
    payload = (_KEY.pack((doc_id is None) | (not narrow) << 1, doc_id or 0)
               + (wide.astype("<u2").tobytes() if narrow else ids))
    size = struct.pack("<Q", len(payload))
    return size + _CHECK.pack(masked(size)) + payload + _CHECK.pack(masked(payload))


def frames(data: bytes, offset: int = 0, end: int | None = None):
    """(offset, length, doc_id, uint32 ids) of each record; raises on damage."""
    end = len(data) if end is None else end
    while offset < end:
        size, check = _HEAD.unpack_from(data, offset)
        if masked(data[offset:offset + 8]) != check:
            raise ValueError(f"bad length checksum at {offset}")
        at = offset + _HEAD.size
        payload = data[at:at + size]
        length = _HEAD.size + size + _CHECK.size + 1
        if len(payload) < size or masked(payload) != _CHECK.unpack_from(data, at + size)[0]:
            raise ValueError(f"bad payload checksum at {offset}")
        if data[offset + length - 1:offset + length] != b"\n":
            raise ValueError(f"record at {offset} has no end")
        kind, doc_id = _KEY.unpack_from(payload)
        ids = np.frombuffer(payload, dtype="<u4" if kind & 2 else "<u2", offset=_KEY.size)
        yield offset, length, None if kind & 1 else doc_id, ids.astype("<u4")
        offset += length


def write_records(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2,
                  id_col: str = "doc_id", text_col: str = "text",
                  file_text_bytes: int = 16 << 20) -> None:
    """Encode every whole text, append ``end_id`` and write the records in
    ascending order of ``id_col`` over the files' numbers.

    Null ids come first; a null text is the empty text (one id: the end).
    Repeated ids and rows are all written, ordered by their text. An empty
    table writes no record. Other columns are not read. One sorted shuffle of
    the texts; a file holds about ``file_text_bytes`` of text.
    """
    tokenizer = tokenizer or default_tokenizer()
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tail = np.array([end_id], dtype="<u4").tobytes()

    def encode(batch):
        keys, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
        for a, b in in_slices(texts):
            yield {"frame": [frame(k, x + tail)
                             for k, x in zip(keys[a:b], encoder(tokenizer).encode(texts[a:b]))]}

    # The text's hash spreads a doc_id that very many rows share, a number the
    # rows that share the text too.
    ranged = (docs.withColumns({"_h": F.xxhash64("text"), "_r": F.monotonically_increasing_id()})
              .repartitionByRange(total // file_text_bytes + 1, "doc_id", "_h", "_r")
              .sortWithinPartitions("doc_id", "_h", "text").drop("_h", "_r"))
    (map_rows(ranged, encode, "frame binary", encodes=True)
     .select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", "\n").text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .where("length > 0").select("path", "content"))


def index_records(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """Read every record back, check both checksums and write the index:
    (doc_id, file, file_no, offset, length, start, n_tokens, ids_crc32), where
    ``start`` counts the ids of all records before. Returns the written table."""
    def scan(batch):
        for file, data in zip(batch["path"], batch["content"]):
            # The file as it lies in the batch: records are looked at, not copied.
            file, data = file.as_py(), memoryview(data.as_buffer())
            no = int(re.search(r"part-(\d+)", file.rsplit("/", 1)[1])[1])
            rows, start = [], 0
            for offset, length, doc_id, ids in frames(data):
                rows.append((doc_id, file, no, offset, length, start, len(ids),
                             zlib.crc32(ids.tobytes())))
                start += len(ids)
            if rows:
                names = [f.split()[0] for f in _INDEX.split(", ")]
                yield dict(zip(names, map(list, zip(*rows))))

    raw = index_path.rstrip("/") + "-unnumbered"
    map_rows(_files(spark, path), scan, _INDEX).write.parquet(raw)
    index = spark.read.schema(_INDEX).parquet(raw)
    # One row per file: bounded by the number of files, not of records.
    before = (index.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
              .select("file_no", F.coalesce(F.sum("n").over(
                  Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)),
                  F.lit(0)).alias("before")))
    (index.join(before, "file_no")
     .withColumn("start", F.col("before") + F.col("start_in_file"))
     .drop("before", "start_in_file").write.parquet(index_path))
    return spark.read.parquet(index_path)


def read_shuffled(spark: SparkSession, path: str, index: DataFrame, seed: int) -> DataFrame:
    """(position, doc_id, ids) in an order set by ``seed``: the index gives each
    record its place, files are read once and records cut out by offset."""
    place = F.xxhash64(F.lit(seed), "file", "offset").alias("place")
    wanted = (index.select("file", F.struct("offset", "length", place).alias("r"))
              .groupBy("file").agg(F.collect_list("r").alias("rows")))  # one file's records

    def cut(batch):
        for data, rows in zip(batch["content"], batch["rows"]):
            data, got = data.as_py(), []
            for r in rows.as_py():
                end = r["offset"] + r["length"]
                got += [(r["place"], k, x.tolist())
                        for _, _, k, x in frames(data, r["offset"], end)]
            yield dict(zip(("place", "doc_id", "ids"), map(list, zip(*got))))

    joined = _files(spark, path).join(wanted, F.col("path") == F.col("file")).select("content", "rows")
    return (map_rows(joined, cut, "place long, doc_id long, ids array<long>")
            .orderBy("place", "doc_id"))


@query("op3_token_records")
def op3(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "records")
    write_records(load_table(spark, d, "documents"), path)
    return (index_records(spark, path, path + "-index")
            .select("doc_id", "start", "n_tokens", "ids_crc32"))
