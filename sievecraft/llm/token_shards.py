"""Training-order token shards.

Texts are tokenised and laid end to end in the order of their positions, an end token after each, and the stream is cut
into sequences of one length. A keyed Feistel permutation of the sequence numbers, walked along its cycles until it falls
into their range, gives every sequence its slot in the training order. Slots are cut into ranges; each range is a shard
of fixed-stride records in slot order, so a reader can go through them in sequence and resume at any slot.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.errors import AnalysisException

from sievecraft.llm import texts
from sievecraft.llm.common import saved
from sievecraft.operators.joins import lookup_join

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256
# Fixed value: how the vocabulary's tokeniser splits texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LENGTH = 1024  # tokens of a sequence
PER_SHARD = 4096  # sequences of a shard
ROUNDS = 6
KEY = 0x5EED


def _half_bits(size: int) -> int:
    return max(1, ((size - 1).bit_length() + 1) // 2)


def _cross(numbers: np.ndarray, half: int, key: int, inverse: bool) -> np.ndarray:
    """One pass of the network over numbers of 2 x half bits."""
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = numbers >> shift, numbers & mask
    for round_ in range(ROUNDS)[:: -1 if inverse else 1]:
        if inverse:
            left, right = right ^ (texts.mix(left + np.uint64((key + round_ * 0x1000003) & (2**64 - 1))) & mask), left
        else:
            left, right = right, left ^ (texts.mix(right + np.uint64((key + round_ * 0x1000003) & (2**64 - 1))) & mask)
    return left << shift | right


def permuted(numbers: np.ndarray, size: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """A bijection of 0 .. size - 1, applied to an array; inverse: back again."""
    half = _half_bits(size)
    out = _cross(numbers.astype(np.uint64), half, key, inverse)
    outside = np.flatnonzero(out >= size)
    while len(outside):
        out[outside] = _cross(out[outside], half, key, inverse)
        outside = outside[out[outside] >= size]
    return out.astype(np.int64)


def vocabulary(path: str = VOCABULARY) -> bytes:
    """The vocabulary file, read where the driver is; tasks get its content."""
    with open(path, "rb") as file:
        return file.read()


_ENCODERS: dict[int, object] = {}


def encoder(content: bytes):
    """The tokeniser of a vocabulary; strings of special tokens are ordinary text."""
    known = _ENCODERS.get(hash(content))
    if known is None:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        known = tiktoken.Encoding("of the file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        _ENCODERS[hash(content)] = known
    return known


_NONE = np.zeros(0, np.uint16)


def _ids(column: pa.Array, content: bytes) -> list[np.ndarray]:
    """Tokens of each text and an end; nothing for a null or empty text."""
    encode = encoder(content).encode_ordinary
    return [np.frombuffer(array("H", [*encode(x), END]), np.uint16) if x else _NONE for x in column.to_pylist()]


_AT = ["file_path", "row_index"]


def _rows(docs: DataFrame) -> DataFrame:
    """Texts with their file and place in it. Other than file tables are saved first."""
    names = [F.col(f"_metadata.{name}") for name in _AT]
    try:
        return docs.select(*names, F.col("text").cast("string").alias("text"))
    except AnalysisException:
        return saved(docs.select("text")).select(*names, F.col("text").cast("string").alias("text"))


def _running(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Columns key and `first`: the sum of the values before it. For tables of one row a file."""
    before = F.sum(value).over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1))
    return rows.select(key, F.coalesce(before, F.lit(0)).alias("first"))


_CHUNKS = "file_path string, first long, size long, ids binary"


def _coded(content):
    """One row for each stretch of about a megabyte of texts that follow each other in a file: its first row, and its tokens."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.slices(batches):
            ids = _ids(batch.column("text"), content.value)
            row, path = batch.column("row_index").to_numpy(), batch.column("file_path")
            other = pc.not_equal(path.slice(1), path.slice(0, len(path) - 1)).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(other | (np.diff(row) != 1)) + 1).tolist(), len(ids)]
            parts = [np.concatenate(ids[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            first = pa.array(np.array(edges[:-1]))
            yield pa.RecordBatch.from_arrays(
                [
                    path.take(first),
                    batch.column("row_index").take(first),
                    pa.array([len(x) for x in parts], pa.int64()),
                    pa.array([x.tobytes() for x in parts], pa.binary()),
                ],
                names=["file_path", "first", "size", "ids"],
            )

    return coded


_PARTS = "slot long, sequence long, start int, ids binary"


def _cut(length: int, sequences: int, key: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, raw in zip(batch.column("at").to_pylist(), batch.column("ids")):
                ids = np.frombuffer(raw.as_py(), np.uint16)
                # Where the stretch and the sequences in it begin, from the start of the stretch.
                begin = np.append(0, np.arange(length - at % length, len(ids), length))
                place = at + begin
                numbers = place // length
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(permuted(numbers, sequences, key)),
                        pa.array(numbers),
                        pa.array((place % length).astype(np.int32)),
                        pa.array([ids[a:b].tobytes() for a, b in zip(begin, np.append(begin[1:], len(ids)))], pa.binary()),
                    ],
                    names=["slot", "sequence", "start", "ids"],
                )

    return cut


_SHARDS = "shard long, slot long, byte_offset long, sequence long, n_tokens int, ids binary"


def _assemble(length: int, per_shard: int):
    """Records from their parts, which come in order of slot and start."""

    def record(slot: int, sequence: int, parts: list[bytes]) -> tuple:
        ids = b"".join(parts)
        full = np.full(length, END, np.uint16)
        full[: len(ids) // 2] = np.frombuffer(ids, np.uint16)
        return slot // per_shard, slot, slot % per_shard * length * 2, sequence, len(ids) // 2, full.tobytes()

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, sequence, parts = -1, -1, []
        for batch in batches:
            rows = []
            for s, q, ids in zip(*(batch.column(x).to_pylist() for x in ("slot", "sequence", "ids"))):
                if s != slot:
                    if parts:
                        rows.append(record(slot, sequence, parts))
                    slot, sequence, parts = s, q, []
                parts.append(ids)
            if rows:
                yield _batch(rows)
        if parts:
            yield _batch([record(slot, sequence, parts)])

    return assemble


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    names = [x.split()[0] for x in _SHARDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], names=names)


def token_shards(
    docs: DataFrame,
    content: bytes | None = None,
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    key: int = KEY,
) -> DataFrame:
    """Rows (shard, slot, byte_offset, sequence, n_tokens, ids), one for each sequence; each partition is one shard in slot order.

    The order of the stream is that of the paths of files and of rows in them. ids: `length` little-endian 16-bit tokens; the last sequence
    of the stream is filled up with end tokens, which n_tokens does not count. Null and empty texts have no tokens. Only
    the text is read, and tokenised once: its ids are saved, and lengths, cuts and records come from them.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary() if content is None else content)
    rows = _rows(docs)
    name = F.concat_ws(":", "file_path", "first").alias("chunk")
    coded = saved(rows.mapInArrow(_coded(shared), _CHUNKS)).select("*", name)
    sizes = coded.drop("ids")
    files = _running(sizes.groupBy("file_path").agg(F.sum("size").alias("n")), "file_path", "n")
    before = Window.partitionBy("file_path").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.select("chunk", "file_path", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("inside"))
    starts = inside.join(files, "file_path").select("chunk", (F.col("first") + F.col("inside")).alias("at"))
    tokens = sizes.agg(F.sum("size")).first()[0] or 0
    sequences = -(-tokens // length)
    # One start for each megabyte of text: broadcast up to a measured bound, so that tokens move only to their slots.
    parts = lookup_join(coded.filter("size > 0").select("chunk", "ids"), starts, "chunk", ["chunk"], "inner")
    cut = parts.select("at", "ids").mapInArrow(_cut(length, max(sequences, 1), key), _PARTS)
    shards = max(-(-sequences // per_shard), 1)
    ranges = cut.repartitionById(int(shards), F.floor(F.col("slot") / per_shard).cast("int"))
    return ranges.sortWithinPartitions("slot", "start").mapInArrow(_assemble(length, per_shard), _SHARDS)


def write_shards(sequences: DataFrame, path: str) -> None:
    """One Parquet file for each shard, in a folder of its number; records have one size and follow each other by slot."""
    sequences.write.mode("overwrite").partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, slot: int = 0, per_shard: int = PER_SHARD) -> DataFrame:
    """The records from a slot on; shards before it are not opened."""
    return spark.read.parquet(path).filter((F.col("shard") >= slot // per_shard) & (F.col("slot") >= slot))
