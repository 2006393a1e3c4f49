"""Alignment of two tokenisers by divide and conquer at shared cuts.

Both tokenise the same bytes. Within a text, an end that both have near the middle is located by bisecting one list of ends
for an end of the other; it cuts the text in two, and both halves are cut in the same way until no cut is left inside. These
leaves are the groups: the smallest stretches that either tokeniser writes as whole tokens. Tokens that end together are
linked, and links are counted over the whole corpus.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sievecraft.llm import texts
from sievecraft.llm.common import id_key, saved
from sievecraft.llm.token_shards import PATTERN, vocabulary
from sievecraft.operators.joins import lookup_join

FIRST = "/opt/tokenizers/byte_bpe_50k.json"
SECOND = "/opt/tokenizers/piece_bpe_32k.model"
SHIFT = 32  # a pair of ids is one number: first << SHIFT | second


def _letters() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable ones for themselves, the others, in
    order, for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class _Bytes:
    """Bytes of the tokens of a vocabulary, and the texts of their numbers."""

    def __init__(self, pieces: list[bytes], mark: str):
        self._objects = np.array(pieces, object)
        self.sizes = np.array([len(x) for x in pieces], np.int64)
        self.inner = np.array([f"{k}," for k in range(len(pieces))], object)
        self.last = np.array([f"{k}{mark}" for k in range(len(pieces))], object)

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(self._objects[ids].tolist())


class Pair:
    """Both tokenisers, made from the contents of their files."""

    def __init__(self, first: bytes, second: bytes):
        import sentencepiece
        import tiktoken

        known = json.loads(first)  # left behind when this returns; its merges are not needed
        letters, special = _letters(), {x["id"] for x in known["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in token): number
            for token, number in known["model"]["vocab"].items()
            if number not in special
        }
        pieces = [b""] * (max(known["model"]["vocab"].values()) + 1)
        for token, number in ranks.items():
            pieces[number] = token
        self.a = _Bytes(pieces, "|")
        # The merges of such a vocabulary are in the order of its ids; special tokens are left out, as their texts are plain.
        self._first = tiktoken.Encoding("of the file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._second = sentencepiece.SentencePieceProcessor(model_proto=second)
        size = self._second.get_piece_size()
        self.b = _Bytes([self._piece(k) for k in range(size)], ";")

    def _piece(self, number: int) -> bytes:
        piece = self._second.id_to_piece(number)
        if self._second.is_byte(number):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encoded(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids by both of a space and the text; None if there is no text or either does not give back its bytes."""
        if not text:
            return None
        text = " " + text
        ids = self._first.encode_ordinary(text), self._second.encode(text[1:])
        a, b = (np.frombuffer(array("i", x), np.int32) for x in ids)
        whole = text.encode()
        if self.a.joined(a) != whole or self.b.joined(b) != whole:
            return None
        return a, b


_PAIRS: dict[int, Pair] = {}


def tokenisers(first: bytes, second: bytes) -> Pair:
    key = hash((first, second))
    if key not in _PAIRS:
        _PAIRS[key] = Pair(first, second)
    return _PAIRS[key]


def shared_cuts(a: np.ndarray, b: np.ndarray, texts_: np.ndarray) -> np.ndarray:
    """Numbers of the A tokens that end where a B token does, in order.

    a, b: the ends of all tokens, rising; texts_: the numbers of the last A token of each text, whose end both have. The
    texts, and then their halves, are cut together, one level of the recursion at a time.
    """
    cuts = [texts_]
    low = np.concatenate([[0], texts_[:-1] + 1]) if len(texts_) else texts_
    high = texts_  # intervals [low, high) of A tokens that may hold a cut; the end of token `high` is one
    while True:
        open_ = low < high
        low, high = low[open_], high[open_]
        if not len(low):
            return np.sort(np.concatenate(cuts))
        middle = (low + high - 1) // 2
        found = np.full(len(low), -1, np.int64)
        waiting, step = np.arange(len(low)), 0
        while len(waiting):
            # The middle, then one to the right, one to the left, two to the right, ...
            away = (step + 1) // 2 * (1 if step % 2 else -1)
            at = middle[waiting] + away
            inside = (at >= low[waiting]) & (at < high[waiting])
            at = np.where(inside, at, low[waiting])
            place = np.searchsorted(b, a[at])
            common = inside & (b[np.minimum(place, len(b) - 1)] == a[at])
            found[waiting[common]] = at[common]
            more = ~common & (middle[waiting] - (step + 1) // 2 >= low[waiting])
            more |= ~common & (middle[waiting] + (step + 2) // 2 < high[waiting])
            waiting, step = waiting[more], step + 1
        cut = found >= 0
        cuts.append(found[cut])
        low, high = np.concatenate([low[cut], found[cut] + 1]), np.concatenate([found[cut], high[cut]])


def _written_groups(pair: Pair, a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> list[str]:
    """The ids of all tokens in the order in which groups are written, each with the mark that follows it: `a1,` `a2|` `b1;`."""
    words = np.empty(len(a) + len(b), object)
    # Before a group's A tokens come the B tokens of all groups before, and before its B tokens its A tokens too.
    a_steps = np.zeros(len(a), np.int64)
    a_steps[a_cuts[:-1] + 1] = np.diff(b_cuts, prepend=-1)[:-1]
    a_place = np.arange(len(a)) + np.cumsum(a_steps)
    b_steps = np.zeros(len(b), np.int64)
    b_steps[np.append(0, b_cuts[:-1] + 1)] = np.diff(a_cuts, prepend=-1)
    b_place = np.arange(len(b)) + np.cumsum(b_steps)
    words[a_place] = pair.a.inner[a]
    words[b_place] = pair.b.inner[b]
    words[a_place[a_cuts]] = pair.a.last[a[a_cuts]]
    words[b_place[b_cuts]] = pair.b.last[b[b_cuts]]
    return words.tolist()


_CHUNKS = "chunk long, rows binary, ids binary, at binary, pairs binary, counts binary, digests binary, groups array<string>"


def _aligned(first, second, digest: bool):
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenisers(first.value, second.value)
        chunk = TaskContext.get().partitionId() << 32
        for batch in texts.slices(batches):
            coded = [pair.encoded(x) for x in batch.column("text").to_pylist()]
            with_ids = [x for x in coded if x is not None]
            a_all = np.concatenate([x[0] for x in with_ids]) if with_ids else np.zeros(0, np.int32)
            b_all = np.concatenate([x[1] for x in with_ids]) if with_ids else np.zeros(0, np.int32)
            a_ends, b_ends = np.cumsum(pair.a.sizes[a_all]), np.cumsum(pair.b.sizes[b_all])
            a_sizes = np.array([len(x[0]) for x in with_ids], np.int64)
            last = np.cumsum(a_sizes) - 1
            a_cuts = shared_cuts(a_ends, b_ends, last)
            b_cuts = np.searchsorted(b_ends, a_ends[a_cuts])
            links = a_all[a_cuts].astype(np.int64) << SHIFT | b_all[b_cuts]
            pairs, at = np.unique(links, return_inverse=True)
            counts = np.bincount(at, minlength=len(pairs))
            numbers = np.zeros((len(coded), 3), np.int64)  # tokens of A, of B, groups
            groups: list[str] = []
            words = _written_groups(pair, a_all, b_all, a_cuts, b_cuts) if with_ids else []
            ends = iter((np.searchsorted(a_cuts, last) + 1).tolist())
            word_from = cut_from = 0
            for row, known in enumerate(coded):
                if known is None:
                    groups.append("")
                    continue
                a, b = known
                cut_to = next(ends)
                numbers[row] = len(a), len(b), cut_to - cut_from
                word_to = word_from + len(a) + len(b)
                groups.append("".join(words[word_from:word_to])[:-1])
                word_from, cut_from = word_to, cut_to
            digests = [hashlib.sha256(x.encode()).digest() if x else bytes(32) for x in groups] if digest else []
            data = (numbers, batch.column("d").to_numpy(zero_copy_only=False), at.astype(np.uint32), pairs, counts.astype(np.uint32))
            packed = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in data]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk]),
                    *packed,
                    pa.array([b"".join(digests)], pa.binary()),
                    pa.array([[] if digest else groups], pa.list_(pa.string())),
                ],
                names=[x.split()[0] for x in _CHUNKS.split(", ")],
            )
            chunk += 1

    return aligned


def _pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            pairs = np.frombuffer(batch.column("pairs")[row].as_py(), np.int64)
            counts = np.frombuffer(batch.column("counts")[row].as_py(), np.uint32).astype(np.int64)
            chunk = np.full(len(pairs), batch.column("chunk")[row].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (chunk, pairs, counts)], names=["chunk", "pair", "n"])


_SUMMED = (
    "d long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, "
    "groups string"
)


def _summed(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums over the links of each document of a chunk, with the corpus counts of the chunk's pairs."""
    get = lambda name: left.column(name)[0].as_py()
    numbers = np.frombuffer(get("rows"), np.int64).reshape(-1, 3)
    at = np.frombuffer(get("at"), np.uint32)
    told = right.column("told").to_numpy()[np.argsort(right.column("pair").to_numpy())]  # in the order of the chunk's pairs
    ends = np.concatenate([[0], np.cumsum(numbers[:, 2])])
    sums = []
    for values in (told & 1, told >> 1):
        running = np.concatenate([[0], np.cumsum(values[at])])
        sums.append(running[ends[1:]] - running[ends[:-1]])
    digests, groups = get("digests"), get("groups")
    rows = len(numbers)
    if not digests:
        hashed = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in groups]
    else:
        hashed = [digests[32 * k : 32 * k + 32].hex() if numbers[k, 0] else "" for k in range(rows)]
    columns = [np.frombuffer(get("ids"), np.int64), *numbers.T, numbers[:, 2], *sums]
    return pa.table(
        [*(pa.array(np.ascontiguousarray(x)) for x in columns), pa.array(hashed), pa.array(groups or [None] * rows, pa.string())],
        names=[x.split()[0] for x in _SUMMED.split(", ")],
    )


def pair_counts(chunks: DataFrame) -> DataFrame:
    """Rows (chunk, pair, told) for each pair that a chunk links: twice its corpus count, and one more if no other partner of its
    B id has a higher one. Only a chunk's distinct pairs are shuffled, with their counts."""
    rows = chunks.select("chunk", "pairs", "counts").mapInArrow(_pairs_of, "chunk long, pair long, n long")
    totals = saved(rows.groupBy("pair").agg(F.sum("n").alias("total")))
    second = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))
    highest = totals.groupBy(second.alias("b")).agg(F.max("total").alias("highest"))
    best = (F.col("total") == F.col("highest")).cast("long")
    judged = totals.withColumn("b", second).join(highest, "b").select("pair", (F.col("total") * 2 + best).alias("told"))
    return lookup_join(rows.select("chunk", "pair"), judged, "pair", ["chunk"], how="inner")


def aligned(
    docs: DataFrame,
    first: bytes | None = None,
    second: bytes | None = None,
    id_column: str = "doc_id",
    digest: bool = True,
) -> DataFrame:
    """Rows (d, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups), one for each document.

    A: a byte-level vocabulary (the content of its JSON file); B: a SentencePiece model. groups is the text
    `a1,a2|b1;a3|b2,b3` of ids, null with digest. n_best counts the links whose corpus count is the highest of their B id,
    ties included; count_sum adds the corpus counts up. Texts that are null or empty, or that either does not give back
    byte by byte (with a space in front), have no tokens: zeros and ''. Repeated rows are documents of their own, all of
    which count; d of a null id is the smallest long. Only id and text are read.
    """
    context = docs.sparkSession.sparkContext
    files = [context.broadcast(vocabulary(path) if given is None else given) for given, path in ((first, FIRST), (second, SECOND))]
    rows = docs.select(id_key(id_column).alias("d"), F.col("text").cast("string").alias("text"))
    chunks = saved(rows.mapInArrow(_aligned(*files, digest), _CHUNKS))
    # A chunk holds a bounded piece of text (or one text), so its pairs are bounded too.
    rest = chunks.select("chunk", "rows", "ids", "at", "digests", "groups").groupBy("chunk")
    return rest.cogroup(pair_counts(chunks).groupBy("chunk")).applyInArrow(_summed, _SUMMED)
