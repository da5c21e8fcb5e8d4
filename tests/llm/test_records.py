"""Record files: sums, round trips, orders, damage."""

import random
import struct
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagweave.llm.records import (
    byte_bpe_encoder,
    crc32c,
    frame,
    masked_crc,
    masked_crc_of_lengths,
    read_digests,
    read_shuffled,
    unframe,
    write_records,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string"


def slow_crc(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksums():
    assert crc32c([b"123456789"]) == [0xE3069283]  # the check value of CRC-32C
    rng = random.Random(1)
    strings = [rng.randbytes(n) for n in [*range(4, 40), 511, 512, 513, 1024, 5000]]
    rng.shuffle(strings)
    assert crc32c(strings) == [slow_crc(s) for s in strings]
    lengths = [0, 1, 255, 1 << 20, (1 << 40) + 3]
    assert masked_crc_of_lengths(lengths) == masked_crc([struct.pack("<Q", n) for n in lengths])


def test_frames():
    payloads = [b"abcd", b"x" * 700]
    records = frame(payloads)
    assert [bytes(p) for p in unframe(records, str)] == payloads
    assert records[0][:8] == struct.pack("<Q", 4)
    for at in range(len(records[0])):
        broken = bytearray(records[0])
        broken[at] ^= 4
        with pytest.raises(ValueError, match="damaged"):
            unframe([bytes(broken)], str)
    for short in (records[1][:-1], records[0][:10], records[0] + b"x"):
        with pytest.raises(ValueError, match="damaged|cut off"):
            unframe([short], str)


def test_ids_are_those_of_the_tokenizer():
    tokenizer = Tokenizer.from_file(PATH)
    encode, width = byte_bpe_encoder(PATH)()
    rng = random.Random(2)
    marks = "aB c  \n\t'sllé1²½ÀØ×÷,.\x0b\x85\x1c —’“…😀ɐ中  ⁠_-"
    parts = ["'re", "'ll", " foo", " bar's", "  ", "<|endoftext|>", "\r\n"]
    for _ in range(5000):
        text = "".join(
            rng.choice(marks) if rng.random() < 0.8 else rng.choice(parts) for _ in range(rng.randint(0, 14))
        )
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert encode(text) == np.array(ids, f"<u{width}").tobytes(), repr(text)


def expected(rows):
    tokenizer, out, start = Tokenizer.from_file(PATH), [], 0
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_in_order_of_ids(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i * 3 - 50, rng.choice([None, "", "some words, ", "né " * i, "\x00 odd"])) for i in range(200)]
    rows.append((10_000, "long text " * 600_000))  # 6 MB
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    for name in ("tie", "row", "file", "at", "start", "part"):
        docs = docs.withColumn(name, F.lit("x"))
    dataset = write_records(docs, str(tmp_path / "set"), byte_bpe_encoder(PATH), file_bytes=4000)
    found = sorted(tuple(r) for r in read_digests(dataset).collect())
    assert found == sorted(expected(rows))
    files = [r.file for r in dataset.index().select("file").distinct().collect()]
    assert len(files) > 3 and all((tmp_path / "set" / f).exists() for f in files)
    # the files alone tell the same: records stand one behind the other
    sizes = {f: 0 for f in files}
    for row in dataset.index().collect():
        sizes[row.file] += row["size"]
    assert sizes == {f: (tmp_path / "set" / f).stat().st_size for f in files}


def test_repeated_and_missing_ids(spark, tmp_path):
    rows = [(5, "b"), (5, "b"), (5, "a b c"), (None, "first"), (None, None), (1, "x")]
    dataset = write_records(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "set"), byte_bpe_encoder(PATH))
    found = read_digests(dataset).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found) == sorted(
        (d is not None, d or 0, n, c) for d, _, n, c in expected(rows)
    )
    in_order = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == [None, None, 1, 5, 5, 5]
    assert [r.start for r in in_order] == np.cumsum([0, *[r.n_tokens for r in in_order[:-1]]]).tolist()


def test_one_id_of_a_third_of_all_rows_is_dealt_over_tasks(spark, tmp_path):
    rows = [(7 if i % 3 == 0 else i, f"text {i % 5}") for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dataset = write_records(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "set"), byte_bpe_encoder(PATH))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = dataset.index().filter("doc_id = 7").select("file").distinct().count()
    assert files > 1
    found = sorted((r.start, r.doc_id) for r in read_digests(dataset).collect())
    assert [d for _, d in found] == sorted(d for d, _ in rows)


def test_shuffled_reads(spark, tmp_path):
    rows = [(i, f"doc {i}") for i in range(300)]
    dataset = write_records(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "set"), byte_bpe_encoder(PATH))
    encode, width = byte_bpe_encoder(PATH)()
    first = [(r.doc_id, bytes(r.ids)) for r in read_shuffled(dataset, 1).collect()]
    again = [(r.doc_id, bytes(r.ids)) for r in read_shuffled(dataset, 1).collect()]
    other = [(r.doc_id, bytes(r.ids)) for r in read_shuffled(dataset, 2).collect()]
    assert first == again != other
    want = {i: np.frombuffer(encode(t), f"<u{width}").astype("<u4").tobytes() + b"\2\0\0\0" for i, t in rows}
    assert dict(first) == dict(other) == want and first != sorted(first)


def test_damaged_file_is_an_error(spark, tmp_path):
    rows = [(i, f"doc {i}") for i in range(20)]
    dataset = write_records(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "set"), byte_bpe_encoder(PATH))
    file = next(Path(tmp_path / "set").glob("*.records"))
    data = bytearray(file.read_bytes())
    data[len(data) // 2] ^= 1
    file.write_bytes(bytes(data))
    # the local file system keeps sums of its own files only if Hadoop wrote them
    with pytest.raises(Exception, match="damaged"):
        read_digests(dataset).collect()


def test_empty_table(spark, tmp_path):
    dataset = write_records(spark.createDataFrame([], SCHEMA), str(tmp_path / "set"), byte_bpe_encoder(PATH))
    assert read_digests(dataset).collect() == [] and read_shuffled(dataset, 1).collect() == []
