import gc
import struct
import weakref
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from cascara.llm.alignment import default_model
from cascara.llm import encode
from cascara.llm.common import PART_BYTES, SCAN_ROWS, map_rows
from cascara.llm.encode import Encoder, PieceEncoder, default_tokenizer, encoder, forget_encoders
from cascara.llm.token_counts import token_counts
from cascara.llm.token_records import frame, frames, index_records, read_shuffled, write_records
from cascara.session import scratch_path
from cascara.sources.tables import load_table
from llm_fixtures import docs, no_docs  # noqa: F401
from conftest import SF_SMALL

PLAIN = Tokenizer.from_file(default_tokenizer())
SMALL = Encoder(default_tokenizer(), limit=50)
MODEL = PieceEncoder(default_model(), limit=50)


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.text(max_size=30), st.text(alphabet=" \n\t\r \x85\x1c　ab'sZ9é!#", max_size=40),
    st.sampled_from(["<|endoftext|>", "a  <|endoftext|>", "I'll we've\n\n\nx   y"])), max_size=6))
def test_pieces_equal_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in SMALL.encode(texts)] == [plain(t) for t in texts]
    assert SMALL.count(texts) == [len(plain(t)) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in MODEL.encode(texts)] == MODEL.sp.encode(texts)


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_words_of_equal_hashes(n):
    """A Thue-Morse word and its complement agree in every polynomial hash of
    these lengths modulo 2^64 with an odd base."""
    word = "".join("ab"[i.bit_count() & 1] for i in range(n))
    other = word.translate({97: 98, 98: 97})
    for coder in (Encoder(default_tokenizer()), PieceEncoder(default_model())):
        whole = coder._whole([f"x {word}", f"x {other} {word}", f"x {word} {other} {word}"])
        assert coder.encode([f"x {word}", f"x {other} {word}", f"x {word} {other} {word}"]) == whole


def test_plain_reads_special_strings_as_text():
    coder, library = Encoder(default_tokenizer(), plain=True), Tokenizer.from_file(default_tokenizer())
    library.encode_special_tokens = True
    text = "a <|endoftext|> b<|endoftext|>"
    assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == library.encode(text).ids != plain(text)


def test_counts_of_a_table_and_of_the_edge_cases(spark, docs):
    table = load_table(spark, SF_SMALL, "documents")
    for frame_ in (table, docs):
        out = token_counts(frame_, scratch_path(spark, "cache"))
        assert out.columns == [*frame_.columns, "n_bytes", "n_tokens"]
        got = sorted((r["doc_id"] or -1, r["text"] or "", r["n_bytes"], r["n_tokens"]) for r in out.collect())
        want = sorted((r["doc_id"] or -1, r["text"] or "", len((r["text"] or "").encode()), len(plain(r["text"])))
                      for r in frame_.collect())
        assert got == want


def test_only_missing_contents_are_encoded(spark, docs, no_docs):
    path = scratch_path(spark, "cache")
    assert token_counts(no_docs, path).count() == 0
    first = docs.where("doc_id <= 5")
    token_counts(first, path)
    one = spark.read.parquet(path).count()
    assert one == first.fillna("", "text").select("text").distinct().count()
    out = token_counts(docs, path)
    assert out.count() == docs.count()
    rows = spark.read.parquet(path)
    assert rows.count() == docs.fillna("", "text").select("text").distinct().count()
    # Stored counts are used: a changed one shows.
    folder = [r[0] for r in rows.select("tokenizer").distinct().collect()]
    assert len(folder) == 1
    changed = docs.where("doc_id = 9")
    (changed.select(F.unhex(F.sha2("text", 256)).alias("content"), F.lit(10**6).cast("long").alias("n_tokens"))
     .write.mode("append").parquet(f"{path}/tokenizer={folder[0]}"))
    assert token_counts(changed, path).first()["n_tokens"] == 10**6


def test_frames_round_trip_and_notice_damage():
    records = [(1, [5, 6, 2]), (None, [2]), (-7, [70_000, 2]), (2**40, list(range(999)))]
    data = b"".join(frame(k, np.array(x, "<u4").tobytes()) + b"\n" for k, x in records)
    assert [(k, ids.tolist()) for _, _, k, ids in frames(data)] == records
    offset, length = [(o, n) for o, n, _, _ in frames(data)][2]
    assert [k for _, _, k, _ in frames(data, offset, offset + length)] == [-7]
    for at in (0, 9, 20, len(data) - 3, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises((ValueError, struct.error)):
            list(frames(bytes(broken)))


@pytest.mark.parametrize("size", [1 << 30, 40_000])
def test_records_and_index(spark, docs, size):
    for table in (docs, load_table(spark, SF_SMALL, "documents")):
        path = scratch_path(spark, "records")
        write_records(table, path, file_text_bytes=size)
        index = index_records(spark, path, path + "-index")
        got = [tuple(r) for r in index.orderBy("start").select(
            "doc_id", "start", "n_tokens", "ids_crc32").collect()]
        rows = sorted(((r["doc_id"], plain(r["text"]) + [2]) for r in table.collect()),
                      key=lambda r: (r[0] is not None, r[0] or 0))
        assert [r[0] for r in got] == [k for k, _ in rows]
        assert sorted((r[0] or -1, r[2], r[3]) for r in got) == sorted(
            (k or -1, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in rows)
        starts = np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
        assert [r[1] for r in got] == starts
        shuffled = [(r["doc_id"], r["ids"]) for r in read_shuffled(spark, path, index, 1).collect()]
        other = [(r["doc_id"], r["ids"]) for r in read_shuffled(spark, path, index, 2).collect()]
        key = lambda r: (r[0] or -1, r[1])
        assert sorted(shuffled, key=key) == sorted(rows, key=key) == sorted(other, key=key)
        assert shuffled != other


def test_no_records_of_an_empty_table(spark, no_docs):
    path = scratch_path(spark, "records")
    write_records(no_docs, path)
    assert index_records(spark, path, path + "-index").count() == 0


def test_repeated_rows_are_spread_over_files(spark):
    path = scratch_path(spark, "records")
    rows = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same text " * 20).alias("text"))
    write_records(rows.repartition(4), path, file_text_bytes=100_000)
    index = index_records(spark, path, path + "-index")
    sizes = [r["count"] for r in index.groupBy("file").count().collect()]
    assert sum(sizes) == 4000 and len(sizes) >= 8 and max(sizes) < 1200
    starts = [r["start"] for r in index.orderBy("start").collect()]
    assert starts == [k * (starts[1] - starts[0]) for k in range(4000)]


@pytest.mark.parametrize("path", [default_tokenizer(), default_model()])
def test_forgotten_encoders_are_gone_at_once(path):
    held = weakref.ref(encoder(path))
    gc.disable()
    try:
        forget_encoders()
        assert held() is None
    finally:
        gc.enable()


def test_a_stage_frees_the_encoders_of_the_stage_before(spark):
    class Frame:
        def mapInArrow(self, run, schema):
            return run

    def held(batch):
        yield {"n": [len(encode._ENCODERS)]}

    def seen(**options):
        encoder(default_tokenizer())
        batch = pa.RecordBatch.from_pydict({"id": [1]})
        return next(map_rows(Frame(), held, "n long", **options)(iter([batch]))).to_pydict()["n"][0]

    assert seen(encodes=True) > 0
    assert seen() == 0


def test_a_worker_is_sent_few_long_rows_at_once(spark):
    def sent(batch):  # a part lies in the buffer of the whole batch
        yield {"n": [batch["text"].buffers()[2].size]}

    keys = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    for key in keys:
        spark.conf.unset(key)
    rows = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    sizes = [r["n"] for r in map_rows(rows, sent, "n long").collect()]
    assert max(sizes) <= 3 * PART_BYTES
    assert [spark.conf.get(key) for key in keys] == [str(PART_BYTES), str(SCAN_ROWS)]


def test_a_bound_of_the_caller_stands(spark):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    spark.conf.set(key, "300")
    try:
        map_rows(spark.range(1), lambda batch: [{"id": batch["id"]}], "id long")
        assert spark.conf.get(key) == "300"
    finally:
        spark.conf.unset(key)
