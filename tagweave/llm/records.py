"""Token sequences as length-delimited binary records.

A record is framed as in TFRecord files: eight bytes of length, the masked CRC-32C of these, the
payload, the masked CRC-32C of that. Payloads hold the document's id and its token ids. An index
with the place of every record is a table of its own, so records can be read in any order.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagweave.llm.common import SLICE_ROWS
from tagweave.session import delete_folder

END_ID = 2  # follows the ids of every document
FILE_BYTES = 1 << 28  # a task begins a new file after this many
READ_BYTES = 1 << 26  # what a reading task gets of them, about
BLOCK_BYTES = 512  # folded together for the sums
MEMO = 1 << 20  # pieces whose ids a Python worker remembers

# Fixed values of the format.
POLYNOMIAL = 0x82F63B78  # CRC-32C, reflected
MASK_DELTA = 0xA282EAD8
_HEAD = "<qBB"  # document id, bytes per token id, 1 if there is no document id


# --- masked CRC-32C ------------------------------------------------------------------------------


@cache
def _lanes() -> np.ndarray:
    """Row j: remainder of each pair of bytes with j pairs after it, in a word of eight bytes."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    rows = [table]
    for _ in range(7):
        rows.append((rows[-1] >> 8) ^ table[rows[-1] & 0xFF])
    pairs = np.arange(1 << 16)
    return np.array([rows[2 * j + 1][pairs & 0xFF] ^ rows[2 * j][pairs >> 8] for j in range(4)])


@cache
def _skip(level: int) -> np.ndarray:
    """Tables that move a remainder past 2^level words of zeros, one for each half of it."""
    if level == 0:
        return _lanes()[[3, 2]]
    halves = np.arange(1 << 16, dtype=np.uint32)
    return np.array([_moved(half, level - 1, 2) for half in (halves, halves << np.uint32(16))])


def _moved(state: np.ndarray, level: int, times: int = 1) -> np.ndarray:
    low, high = _skip(level)
    for _ in range(times):
        state = low[state & 0xFFFF] ^ high[state >> np.uint32(16)]
    return state


def _of_words(words: np.ndarray) -> np.ndarray:
    """Remainders of words of eight bytes, given as rows of four pairs."""
    first, second, third, fourth = _lanes()[::-1]
    return first[words[:, 0]] ^ second[words[:, 1]] ^ third[words[:, 2]] ^ fourth[words[:, 3]]


def _mask(crc):
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def crc32c(strings: list[bytes | memoryview]) -> list[int]:
    """CRC-32C of byte strings of four bytes and more, all at once.

    Zeros in front change nothing while the initial state is zero, so strings are padded there to
    whole blocks; the real initial state inverts their first four bytes. Blocks are folded in
    halves, all together, and then put together string by string.
    """
    if not strings:
        return []
    size = np.array([len(s) for s in strings])
    blocks = -(-size // BLOCK_BYTES)
    ends = np.cumsum(blocks) * BLOCK_BYTES
    padded = np.zeros(int(ends[-1]), np.uint8)
    for string, n, end in zip(strings, size.tolist(), ends.tolist(), strict=True):
        padded[end - n : end] = np.frombuffer(string, np.uint8)
    padded[(ends - size)[:, None] + np.arange(4)] ^= 0xFF
    state = _of_words(padded.view("<u2").reshape(-1, 4))
    level = 0
    while len(state) > len(padded) // BLOCK_BYTES:
        state = _moved(state[::2], level) ^ state[1::2]
        level += 1
    low, high = _skip(level)
    out, states, at = [], state.tolist(), 0
    for n in blocks.tolist():
        crc = states[at]
        for following in states[at + 1 : at + n]:
            crc = int(low[crc & 0xFFFF]) ^ int(high[crc >> 16]) ^ following
        out.append(crc ^ 0xFFFFFFFF)
        at += n
    return out


def masked_crc(strings: list[bytes | memoryview]) -> list[int]:
    return list(map(_mask, crc32c(strings)))


def masked_crc_of_lengths(lengths: list[int]) -> list[int]:
    words = np.array(lengths, "<u8").view("<u2").reshape(-1, 4)
    return _mask((_of_words(words ^ np.array([0xFFFF, 0xFFFF, 0, 0], "<u2")) ^ 0xFFFFFFFF).astype(np.int64)).tolist()


def frame(payloads: list[bytes]) -> list[bytes]:
    """Records of payloads of four bytes and more."""
    sizes = [len(p) for p in payloads]
    sums = zip(payloads, sizes, masked_crc_of_lengths(sizes), masked_crc(payloads), strict=True)
    return [
        b"".join((struct.pack("<QI", size, of_size), payload, struct.pack("<I", of_payload)))
        for payload, size, of_size, of_payload in sums
    ]


def unframe(records: list[bytes], place: Callable[[int], str]) -> list[memoryview]:
    """The payloads; a record that does not fit its length or sums is an error that tells its place."""
    heads = []
    for i, record in enumerate(records):
        if len(record) < 20:
            raise ValueError(f"record cut off at {place(i)}")
        heads.append(struct.unpack_from("<QI", record))
    payloads = [memoryview(r)[12:-4] for r in records]
    checks = zip(heads, masked_crc_of_lengths([h[0] for h in heads]), payloads, masked_crc(payloads), strict=True)
    for i, ((size, of_size), right, payload, of_payload) in enumerate(checks):
        if of_size != right or size != len(payload):
            raise ValueError(f"damaged record length at {place(i)}")
        if struct.unpack_from("<I", records[i], 12 + size)[0] != of_payload:
            raise ValueError(f"damaged record at {place(i)}")
    return payloads


# --- tokenizer -----------------------------------------------------------------------------------

# Letters, digits and marks of the characters for which the splitting below is exact.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGITS = "0-9²³¹¼-¾"
_OTHER_CHARACTERS = re.compile(r"[\x1c-\x1f\x85\u0250-\u200f\u2028-\u202f\u205f-\U0010ffff]")
_PIECE = re.compile(
    rf" ?[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_DIGITS}]+| ?[^\s{_LETTERS}{_DIGITS}]+|\s+(?!\S)|\s+"
)


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary of a byte-level BPE."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Pieces(dict):
    """Token ids of pieces of text, worked out when they are first asked for."""

    def __init__(self, model, code: str):
        super().__init__()
        self.model, self.code, self.letters = model, code, byte_letters()

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        mapped = piece.encode().decode("latin-1").translate(self.letters)
        ids = array(self.code, [token.id for token in self.model.tokenize(mapped)])
        if sys.byteorder == "big":
            ids.byteswap()
        self[piece] = found = ids.tobytes()
        return found


@cache
def _loaded(path: str):
    """The tokenizer of a file, and the pieces that this Python worker knows the ids of."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    code = "H" if tokenizer.get_vocab_size() <= 1 << 16 else "I"
    return tokenizer, special, _Pieces(tokenizer.model, code), np.dtype(f"<{code}")


def byte_bpe_encoder(path: str) -> Callable[[], tuple[Callable[[str], bytes], int]]:
    """Encoder of texts by a byte-level BPE file of the tokenizers library, without special tokens
    added; it gives ids as little-endian numbers, and the bytes per id.

    Merges never cross the pieces that the tokenizer splits a text into, and pieces repeat, so
    their ids are remembered. Texts with characters whose class is not certain here, or with the
    string of a special token, are left to the tokenizer as a whole.
    """

    def start():
        tokenizer, special, pieces, kind = _loaded(path)

        def encode(text: str) -> bytes:
            if _OTHER_CHARACTERS.search(text) or any(s in text for s in special):
                return np.array(tokenizer.encode(text, add_special_tokens=False).ids, kind).tobytes()
            return b"".join(map(pieces.__getitem__, _PIECE.findall(text)))

        return encode, kind.itemsize

    return start


# --- writing -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Dataset:
    """Files of records in a folder, and the index in ``index`` below it."""

    spark: SparkSession
    folder: str

    def index(self) -> DataFrame:
        """(file, at, size, doc_id, n_tokens, start): where each record is, in the global order;
        ``start`` counts the ids of all records before it."""
        return self.spark.read.parquet(f"{self.folder}/index")


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` as a URI that names its file system on every machine."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    uri = place.getFileSystem(conf).makeQualified(place).toString()
    return re.sub("^file:/+", "file:///", uri)


def _open_folder(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder)


class _Writer:
    """Record files of one task; names are its own, so a second attempt cannot meet the first."""

    def __init__(self, folder: str, limit: int):
        self.files, self.path = _open_folder(folder)
        self.part = TaskContext.get().partitionId()
        self.own = f"part-{self.part:06d}-{uuid.uuid4().hex}"
        self.number, self.limit, self.out = 0, limit, None

    def put(self, record: bytes) -> tuple[int, str, int]:
        """(number of the file in this task, its name, place in it)"""
        if self.out is not None and self.out.tell() + len(record) > self.limit and self.out.tell():
            self.close()
            self.number += 1
        if self.out is None:
            self.name = f"{self.own}-{self.number:04d}.records"
            self.out = self.files.open_output_stream(f"{self.path}/{self.name}", compression=None)
        at = self.out.tell()
        self.out.write(record)
        return self.number, self.name, at

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


_PLACES = "part int, number int, file string, at bigint, size bigint, doc_id bigint, n_tokens bigint, before bigint"


def write_records(
    docs: DataFrame,
    folder: str,
    encoder: Callable[[], tuple[Callable[[str], bytes], int]],
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    file_bytes: int = FILE_BYTES,
) -> Dataset:
    """The tokens of all documents in record files, in the order of ``doc_id``, and their index.

    Each document is followed by ``end_id``. Null and empty texts have that id only; documents
    without an id come first; equal ids are ordered by a hash of the text; an empty table gives
    an empty index and no files. ``doc_id`` must be an integer; other columns are not read.

    Texts are shuffled once, by range; equal ids are dealt over several tasks. Each task writes
    files of bounded size and Spark commits the index, so only files of finished attempts count
    and a lost executor's are written anew under other names. Starts are sums over files, one row
    each, on top of sums inside a file.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    files, path = _open_folder(folder)
    files.create_dir(path, recursive=True)
    order = ["doc_id", "tie", "row"]
    dealt = (
        docs.select(
            F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
        )
        .withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (encode, width), writer, before, last = encoder(), _Writer(folder, file_bytes), 0, 0
        end = int(end_id).to_bytes(width, "little")
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE_ROWS):
                part, rows = batch.slice(first, SLICE_ROWS), []
                ids, texts = (part.column(c).to_pylist() for c in ("doc_id", "text"))
                tokens = [encode(value) + end for value in texts]
                heads = [struct.pack(_HEAD, doc or 0, width, doc is None) for doc in ids]
                records = frame([head + t for head, t in zip(heads, tokens, strict=True)])
                for doc, t, record in zip(ids, tokens, records, strict=True):
                    number, name, at = writer.put(record)
                    before = before if number == last else 0
                    n = len(t) // width
                    rows.append((writer.part, number, name, at, len(record), doc, n, before))
                    before, last = before + n, number
                yield _batch(_PLACES, rows)
        writer.close()

    parts = f"{folder}/places"
    dealt.mapInArrow(run, _PLACES).write.parquet(parts)
    places = spark.read.parquet(parts)
    totals = places.groupBy("part", "number", "file").agg(F.sum("n_tokens").alias("n"))
    so_far = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("first"))
    index = places.join(starts, "file").select(
        "file", "at", "size", "doc_id", "n_tokens", (F.col("first") + F.col("before")).alias("start")
    )
    index.write.parquet(f"{folder}/index")
    delete_folder(spark, parts)
    return Dataset(spark, folder)


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names, types = zip(*[c.split() for c in schema.split(", ")], strict=True)
    arrays = [
        pa.array(v, type=kinds[t])
        for v, t in zip(zip(*rows, strict=True) if rows else [()] * len(names), types, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=list(names))


# --- reading -------------------------------------------------------------------------------------


def token_ids(payload: memoryview) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of a payload."""
    doc, width, missing = struct.unpack_from(_HEAD, payload)
    return None if missing else doc, np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(_HEAD))


def _map_records(places: DataFrame, folder: str, schema: str, of_record) -> DataFrame:
    """Rows that ``of_record`` (place, document id, token ids) gives, in the order of ``places``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open_folder(folder)
        name, source = None, None
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE_ROWS):
                places, records = batch.slice(first, SLICE_ROWS).to_pylist(), []
                for place in places:
                    if place["file"] != name:
                        name = place["file"]
                        source = files.open_input_file(os.path.join(path, name))
                    source.seek(place["at"])
                    records.append(source.read(place["size"]))
                payloads = unframe(records, lambda i: f"{places[i]['file']}:{places[i]['at']}")
                rows = [of_record(p, *token_ids(v)) for p, v in zip(places, payloads, strict=True)]
                yield _batch(schema, rows)

    return places.mapInArrow(run, schema)


def _tasks(index: DataFrame) -> int:
    total = index.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return max(1, -(-total // READ_BYTES))


def read_digests(dataset: Dataset) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all records, as read from the files.

    Every length and sum is verified; a damaged file is an error. Tasks get stretches of files.
    """
    index = dataset.index()
    stretch = F.floor(F.col("at") / F.lit(READ_BYTES))
    dealt = index.repartition(_tasks(index), "file", stretch).sortWithinPartitions("file", "at")

    def digest(place, doc, ids):
        return doc, place["start"], len(ids), zlib.crc32(ids.astype("<u4").tobytes())

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return _map_records(dealt, dataset.folder, schema, digest)


def read_shuffled(dataset: Dataset, seed: int) -> DataFrame:
    """(doc_id, ids) of all records in a random order that ``seed`` fixes; ids are little-endian
    32-bit numbers. The index is dealt and sorted by a hash of its places, texts are not touched."""
    index = dataset.index()
    key = F.xxhash64("file", "at", F.lit(seed))
    dealt = index.withColumn("key", key).repartitionByRange(_tasks(index), "key").sortWithinPartitions("key")
    return _map_records(
        dealt, dataset.folder, "doc_id bigint, ids binary", lambda _, doc, ids: (doc, ids.astype("<u4").tobytes())
    )
