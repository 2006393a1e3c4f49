"""Scoring of texts with a probabilistic suffix tree.

Contexts grow from coarse to fine: nothing, the symbol before, the two symbols before, the word before, the two words
before. Symbols are the COMMON most frequent words, the end of a text, and classes of all other words by their spelling;
words are all words of the corpus, so the tree grows with it. A context is a state if a divergence test says that what
follows it differs from what follows its suffix: sum of c log(P(next | context) / P(next | suffix)) against half a
logarithm of the corpus for each distinct follower; two words only below a word that is a state. Next-symbol distributions
are smoothed with those of the suffix, and a token is scored in the longest state that ends before it. Contexts of words
tell the spelling class of what follows, contexts of symbols the symbol within the class, and counts the word within the
symbol: P(token) = P(class | words) P(symbol | class, symbols) P(word | symbol), a proper distribution over the known words
and one unknown word of each class.

Neither word counts nor contexts of the whole corpus ever meet in one place. Blocks of texts send their distinct words,
with what follows them, packed, to shards by the hash of the word, fewer than blocks; shards test the contexts, and send each block the totals
of just its words and the probabilities of just what follows in it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sievecraft.llm import texts
from sievecraft.llm.common import id_key, saved

BLOCK = 5 << 20  # bytes of text in a block; the work of a task, without effect on results
BLOCKS_OF_SHARD = 2
PART_KEYS = 1 << 18  # contexts tested at a time, besides those of one word
COMMON, CLASSES = 127, 128
SYMBOLS = 1 + COMMON + CLASSES  # 0 ends a text
KINDS = 1 + CLASSES  # the end and the spelling classes, in which contexts of words tell what follows
SALTS = 16  # tasks that first add up the counts of one last symbol
_END = int(texts.mix(np.array([1 << 40], np.uint64))[0])


def _tokens(column: pa.Array):
    """Hash, spelling class and text of each token, the end after each text's words; offsets of the texts."""
    data, offsets = texts.text_bytes(column, True)
    starts, ends, cuts = texts.words(data, offsets)
    eights = np.ndarray((len(data) - 7,), np.dtype("<u8"), data, 0, (1,))
    first = eights[starts] & np.uint64(0xFFFF)
    first = np.where(ends - starts > 1, first, first & np.uint64(0xFF))
    spelling = (texts.mix(first) % np.uint64(CLASSES)).astype(np.uint8)
    count = np.diff(cuts)
    owner = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(starts)) + owner
    hashes = np.full(len(starts) + len(count), _END, np.uint64)
    classes = np.zeros(len(hashes), np.uint8)
    hashes[place], classes[place] = texts.word_hashes(data, starts, ends), spelling
    return hashes, classes, np.repeat(np.arange(len(count)), count + 1), cuts + np.arange(len(count) + 1)


def _block_words(table: pa.Table):
    """Sorted distinct token hashes of a block, their classes and counts in its training texts."""
    column = table.column("text").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    hashes, classes, owner, offsets = _tokens(column)
    words, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    train = table.column("train").to_numpy()
    count = np.bincount(inverse, weights=train[owner], minlength=len(words)).astype(np.int64)
    return words, classes[at], count, inverse, owner, offsets, hashes, classes


def _kinds(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return np.where(hashes == np.uint64(_END), 0, classes.astype(np.int64) + 1)


def _context_keys(inverse, kinds, offsets, end_word: int, bits: int) -> np.ndarray:
    """For each token: the number of the word before, that of the one before that, of so many bits, and the token's kind."""
    last, older = np.full(len(kinds), end_word, np.int64), np.full(len(kinds), end_word, np.int64)
    last[1:], older[2:] = inverse[:-1], inverse[:-2]
    first = offsets[:-1]
    last[first], older[first] = end_word, end_word
    second = first + 1
    older[second[second < len(older)]] = end_word  # of the next text's first token, after a text without words
    return last << bits + 8 | older << 8 | kinds


def _followers(words, inverse, owner, offsets, hashes, classes):
    """Distinct context keys of a block, the key of each token, and the bits that number a word in a key."""
    end_word, bits = int(np.searchsorted(words, np.uint64(_END))), len(words).bit_length()
    keys = _context_keys(inverse, _kinds(hashes, classes), offsets, end_word, bits)
    return *np.unique(keys, return_inverse=True), bits


def _narrow(values: np.ndarray) -> bytes:
    """Numbers in the least width that holds them all."""
    return values.astype(np.min_scalar_type(values.max())).tobytes() if len(values) else b""


def _bits(values: np.ndarray) -> bytes:
    """Numbers in the least number of bits that holds them all, after this and their number."""
    width = max(int(values.max()).bit_length(), 1) if len(values) else 1
    digits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little", count=width)
    return struct.pack("<BI", width, len(values)) + np.packbits(digits).tobytes()


def _unbits(raw: bytes) -> np.ndarray:
    """Numbers packed by `_bits`."""
    width, number = struct.unpack_from("<BI", raw)
    digits = np.unpackbits(np.frombuffer(raw, np.uint8, offset=5), count=number * width).reshape(number, width)
    eights = np.zeros((number, 8), np.uint8)
    eights[:, : -(-width // 8)] = np.packbits(digits, axis=1, bitorder="little")
    return eights.view("<u8").ravel()


def _rising(hashes: np.ndarray) -> bytes:
    """Sorted hashes: the first, and what each other is above the one before."""
    return hashes[:1].tobytes() + _bits(np.diff(hashes)) if len(hashes) else b""


def _risen(raw: bytes) -> np.ndarray:
    """Hashes packed by `_rising`."""
    first = np.frombuffer(raw[:8], np.uint64)
    return np.cumsum(np.concatenate([first, _unbits(raw[8:])]), dtype=np.uint64) if raw else first


def _wide(raw: bytes, number: int) -> np.ndarray:
    """So many numbers packed by `_narrow`."""
    return np.frombuffer(raw, f"<u{len(raw) // number}" if number else np.uint8).astype(np.int64)


def _count_kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often a token of one kind follows one of another; a text begins as if after an end."""
    dense = np.zeros(KINDS**2, np.int64)
    for batch in texts.slices(batches):
        hashes, classes, _, offsets = _tokens(batch.column("text"))
        kinds = _kinds(hashes, classes)
        last = np.zeros_like(kinds)
        last[1:] = kinds[:-1]
        last[offsets[:-1]] = 0
        dense += np.bincount(last * KINDS + kinds, minlength=KINDS**2)
    at = np.flatnonzero(dense)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(dense[at])], names=["cell", "n"])


@dataclass
class Kinds:
    """What follows a word of each kind, smoothed with what follows any; the number of tokens."""

    share: np.ndarray
    tokens: int


def kinds_of(count: np.ndarray) -> Kinds:
    root = (count.sum(axis=0) + 1) / (count.sum() + KINDS)
    different = np.count_nonzero(count, axis=1)[:, None]
    total = count.sum(axis=1, keepdims=True)
    share = np.where(total > 0, (count + different * root) / np.maximum(total + different, 1), root)
    return Kinds(share, int(count.sum()))


_WORDS = (
    "block int, shard int, words binary, classes binary, counts binary, sizes binary, olders binary, older binary, "
    "next binary, seen binary"
)
_TOTALS = (
    "block int, shard int, totals binary, chances binary, n long, v long, states long, sums array<long>, "
    "kinds array<long>, top array<struct<c:long,h:long,k:int>>"
)


def _send(shards: int):
    def send(table: pa.Table) -> pa.Table:
        words, classes, count, inverse, owner, offsets, hashes, classes_of = _block_words(table)
        keys, which, bits = _followers(words, inverse, owner, offsets, hashes, classes_of)
        seen = np.bincount(which, weights=table.column("train").to_numpy()[owner], minlength=len(keys)).astype(np.uint32)
        del inverse, owner, offsets, hashes, classes_of, which  # as large as the block, while its pieces are packed
        shard = ((words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
        cut = np.searchsorted(shard, np.arange(shards + 1))
        sizes = np.bincount(keys >> bits + 8, minlength=len(words))
        cut = [*zip(cut, np.searchsorted(keys >> bits + 8, cut))]
        rows = []
        for (a, c), (b, d) in zip(cut[:-1], cut[1:]):
            older, place = np.unique(keys[c:d] >> 8 & (1 << bits) - 1, return_inverse=True)
            next_ = (keys[c:d] & 0xFF).astype(np.uint8).tobytes()
            own = _rising(words[a:b]), classes[a:b].tobytes(), _narrow(count[a:b]), _narrow(sizes[a:b])
            rows.append((*own, _rising(words[older]), _bits(place), next_, _narrow(seen[c:d])))
        block = table.column("block")[0].as_py()
        names = ("words", "classes", "counts", "sizes", "olders", "older", "next", "seen")
        return pa.table(
            {"block": pa.array([block] * shards, pa.int32()), "shard": pa.array(range(shards), pa.int32())}
            | {name: pa.array(column, pa.binary()) for name, column in zip(names, zip(*rows))}
        )

    return send


def _sums(values: np.ndarray, groups: np.ndarray, number: int) -> np.ndarray:
    return np.bincount(groups, weights=values, minlength=number)


def _differ(count, parent, groups, number: int, corpus: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For groups of (count, share under the suffix) pairs: whether they are states, their totals and numbers of followers."""
    total, different = _sums(count, groups, number), _sums(count > 0, groups, number)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(count > 0, count * np.log(count / total[groups] / parent), 0.0)
    return _sums(gain, groups, number) > 0.5 * different * np.log(max(corpus, 2)), total, different


def word_states(keys: np.ndarray, seen: np.ndarray, kinds: np.ndarray, known: Kinds, bits: int = 16):
    """For distinct (word, older, next) keys, sorted: the probability of `next` in the longest state of words, 0 if there is
    none; and the number of states. kinds: those of the words; bits: those of `older` in a key."""
    word_of = keys >> bits + 8
    pair, pair_of = np.unique(word_of << 8 | keys & 0xFF, return_inverse=True)
    word, next_ = pair >> 8, pair & 0xFF
    count = _sums(seen, pair_of, len(pair))
    parent = known.share[kinds[word], next_]
    state, total, different = _differ(count, parent, word, len(kinds), known.tokens)
    share = (count + different[word] * parent) / np.maximum(total + different, 1)[word]
    longer, longer_of = np.unique(keys >> 8, return_inverse=True)
    below, parent = word_of, share[pair_of]
    more, total, different = _differ(seen, parent, longer_of, len(longer), known.tokens)
    more &= state[longer >> bits]
    finer = (seen + different[longer_of] * parent) / np.maximum(total + different, 1)[longer_of]
    chance = np.where(more[longer_of], finer, np.where(state[below], parent, 0.0))
    return chance.astype(np.float32), int(state.sum() + more.sum())


def _all_wide(table: pa.Table, name: str, numbers) -> np.ndarray:
    return np.concatenate([_wide(x.as_py(), number) for x, number in zip(table.column(name), numbers)])


def _older_words(table: pa.Table, rows_of: list[int]) -> tuple[np.ndarray, int]:
    """The older word of each key of a shard, numbered over all blocks by its whole hash, and the bits of these numbers."""
    held = [_risen(x.as_py()) for x in table.column("olders")]
    every, number = np.unique(np.concatenate(held), return_inverse=True)
    starts = np.repeat(np.cumsum([0, *map(len, held)])[:-1], rows_of)
    place = np.concatenate([_unbits(x.as_py()) for x in table.column("older")]).astype(np.int64)
    return number[starts + place], len(every).bit_length()


def _states_of_parts(keys, seen, kinds, known: Kinds, bits: int) -> tuple[np.ndarray, int]:
    """`word_states` of some words at a time, as words do not depend on each other."""
    cuts = np.unique(np.searchsorted(keys, np.append(keys[::PART_KEYS] >> bits + 8 << bits + 8, np.int64(len(kinds)) << bits + 8)))
    chances, states = [np.zeros(0, np.float32)], 0
    for a, b in zip(cuts[:-1], cuts[1:]):
        low, high = int(keys[a] >> bits + 8), int(keys[b - 1] >> bits + 8) + 1
        chance, found = word_states(keys[a:b] - (low << bits + 8), seen[a:b], kinds[low:high], known, bits)
        chances.append(chance)
        states += found
    return np.concatenate(chances), states


def _total(table: pa.Table, kinds_known: Kinds) -> pa.Table:
    """Totals of one shard's words and chances of what follows them, block by block, and a row of sums with block -1."""
    parts = [_risen(x.as_py()) for x in table.column("words")]
    every = np.concatenate(parts)
    words, at, inverse = np.unique(every, return_index=True, return_inverse=True)
    counts = _all_wide(table, "counts", map(len, parts))
    classes = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in table.column("classes")])[at]
    total = np.bincount(inverse, weights=counts, minlength=len(words)).astype(np.int64)
    cut = np.cumsum([0, *map(len, parts)])
    back = [total[inverse[a:b]].tobytes() for a, b in zip(cut[:-1], cut[1:])]
    next_ = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in table.column("next")])
    rows_of = [len(x.as_py()) for x in table.column("next")]
    own = np.repeat(inverse, _all_wide(table, "sizes", map(len, parts)))
    older, bits = _older_words(table, rows_of)
    keys = own << bits + 8 | older << 8 | next_
    del own, older, next_
    keys, which = np.unique(keys, return_inverse=True)
    seen = np.bincount(which, weights=_all_wide(table, "seen", rows_of), minlength=len(keys))
    chance, states = _states_of_parts(keys, seen, _kinds(words, classes), kinds_known, bits)
    del keys, seen
    chance = chance[which]
    followed = np.cumsum([0, *rows_of])
    order = np.lexsort((words, -total))[: COMMON + 1]
    order = order[total[order] > 0]
    top = [{"c": int(total[k]), "h": int(words[k].view(np.int64)), "k": int(classes[k])} for k in order]
    rows, none = len(parts), [None]
    real = words != _END
    sums = np.bincount(classes, weights=total * real, minlength=CLASSES).astype(np.int64)
    kinds = np.bincount(classes, weights=(total > 0) & real, minlength=CLASSES).astype(np.int64)
    shard = table.column("shard")[0].as_py()
    many = pa.list_(pa.int64())
    tops = pa.list_(pa.struct([("c", pa.int64()), ("h", pa.int64()), ("k", pa.int32())]))
    return pa.table(
        {
            "block": pa.array([*table.column("block").to_pylist(), -1], pa.int32()),
            "shard": pa.array([shard] * (rows + 1), pa.int32()),
            "totals": pa.array([*back, b""], pa.binary()),
            "chances": pa.array([*(chance[a:b].tobytes() for a, b in zip(followed[:-1], followed[1:])), b""], pa.binary()),
            "n": pa.array([*none * rows, int(total.sum())], pa.int64()),
            "v": pa.array([*none * rows, int((total > 0).sum())], pa.int64()),
            "states": pa.array([*none * rows, states], pa.int64()),
            "sums": pa.array([*none * rows, sums.tolist()], many),
            "kinds": pa.array([*none * rows, kinds.tolist()], many),
            "top": pa.array([*none * rows, top], tops),
        }
    )


@dataclass
class Alphabet:
    common: np.ndarray  # sorted hashes
    symbol: np.ndarray  # of each of them
    n: int
    v: int
    share: np.ndarray  # of each symbol, smoothed
    inside: np.ndarray  # count and distinct words of each symbol, smoothed: what (c + 1) is divided by
    kind: np.ndarray = field(default_factory=lambda: np.r_[np.zeros(1 + COMMON, np.int64), 1:KINDS])  # of each symbol

    def symbols(self, hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
        out = classes.astype(np.int64) + 1 + COMMON
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
            out = np.where(self.common[at] == hashes, self.symbol[at], out)
        return np.where(hashes == np.uint64(_END), 0, out)


def alphabet(totals: DataFrame) -> Alphabet:
    """Symbols and their shares, from one row of sums for each shard."""
    sums = totals.filter("block = -1")
    n, v = (x or 0 for x in sums.agg(F.sum("n"), F.sum("v")).first())
    wide = [[0] * CLASSES, [0] * CLASSES]
    for k, name in enumerate(("sums", "kinds")):
        for row in sums.select(F.posexplode(name)).groupBy("pos").agg(F.sum("col").alias("x")).collect():
            wide[k][row["pos"]] = row["x"]
    tokens, kinds = np.array(wide[0], np.float64), np.array(wide[1], np.float64)
    end = int(np.array([_END], np.uint64).view(np.int64)[0])
    top = sums.select(F.explode("top").alias("x")).select("x.*")
    ends = top.filter(F.col("h") == end).agg(F.sum("c")).first()[0] or 0
    best = top.filter(F.col("h") != end).orderBy(F.desc("c"), "h").limit(COMMON).collect()
    inside = np.ones(SYMBOLS)
    inside[0] = ends + 1
    for k, row in enumerate(best):
        inside[1 + k] = row["c"] + 1
        tokens[row["k"]] -= row["c"]
        kinds[row["k"]] -= 1
    inside[1 + COMMON :] = tokens + kinds + 1
    hashes = np.array([row["h"] for row in best], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    share = inside.copy()
    share[1 + len(best) : 1 + COMMON] = 0
    kind = np.r_[0, [row["k"] + 1 for row in best], np.zeros(COMMON - len(best)), 1:KINDS].astype(np.int64)
    return Alphabet(hashes[order], 1 + order, n, v, share / share.sum(), inside, kind)


def _contexts(alphabet_) -> object:
    """Counts of (before last, last, next), one row for each last symbol and task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = alphabet_.value
        dense, any_ = np.zeros(SYMBOLS**3, np.int32), False
        for batch in texts.slices(batches):
            any_ = True
            hashes, classes, owner, offsets = _tokens(batch.column("text"))
            here = known.symbols(hashes, classes)
            last, older = _history(here, offsets)
            keys = (last * SYMBOLS + older) * SYMBOLS + here
            at, found = np.unique(keys, return_counts=True)
            dense[at] += found.astype(np.int32)
        if any_:
            for last in range(SYMBOLS):
                part = dense[last * SYMBOLS**2 : (last + 1) * SYMBOLS**2]
                at = np.flatnonzero(part)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([last], pa.int32()),
                            pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                            pa.array([part[at].astype(np.int64).tobytes()], pa.binary()),
                        ],
                        names=["last", "cells", "counts"],
                    )

    return count


def _history(symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbol before each token and the one before that; a text begins as if after an end."""
    last, older = np.zeros_like(symbols), np.zeros_like(symbols)
    last[1:], older[2:] = symbols[:-1], symbols[:-2]
    first = offsets[:-1]
    last[first], older[first] = 0, 0
    second = first + 1
    second = second[second < len(symbols)]
    older[second] = 0
    return last, older


_CELLS = "last int, cells binary, counts binary"


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for row in batch.to_pylist():
            dense = held.setdefault(row["last"], np.zeros(SYMBOLS**2, np.int64))
            dense[np.frombuffer(row["cells"], np.uint16)] += np.frombuffer(row["counts"], np.int64)
    for last, dense in held.items():
        at = np.flatnonzero(dense)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([last], pa.int32()),
                pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                pa.array([dense[at].tobytes()], pa.binary()),
            ],
            names=["last", "cells", "counts"],
        )


def diverges(count: np.ndarray, parent: np.ndarray, corpus: float) -> np.ndarray:
    """For rows of next-symbol counts: whether they differ from the parent's shares by more than they must."""
    total = count.sum(axis=-1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(count > 0, count * np.log(count / total / parent), 0.0).sum(axis=-1)
    return gain > 0.5 * (count > 0).sum(axis=-1) * np.log(max(corpus, 2))


def _keep(corpus: int):
    """Of each last symbol, its own row (older -1) and those of the longer contexts that differ from it."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dense = np.zeros(SYMBOLS**2, np.int64)
                dense[np.frombuffer(row["cells"], np.uint16)] = np.frombuffer(row["counts"], np.int64)
                dense = dense.reshape(SYMBOLS, SYMBOLS)
                own = dense.sum(axis=0)
                kept = np.flatnonzero(diverges(dense, own / own.sum(), corpus))
                rows = [own, *dense[kept]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["last"]] * len(rows), pa.int32()),
                        pa.array([-1, *kept.tolist()], pa.int32()),
                        pa.array([np.flatnonzero(x).astype(np.uint8).tobytes() for x in rows], pa.binary()),
                        pa.array([x[x > 0].tobytes() for x in rows], pa.binary()),
                    ],
                    names=["last", "older", "next", "counts"],
                )

    return keep


@dataclass
class Tree:
    state: np.ndarray  # [last, older]: row of the longest state
    log10: np.ndarray  # [row, next]
    kinds: np.ndarray  # [row, kind of next]: the same added up


def tree(rows: list, known: Alphabet) -> Tree:
    """States and smoothed distributions from the kept contexts, at most SYMBOLS^2 + SYMBOLS + 1 of them."""
    contexts = {}
    for row in rows:
        count = np.zeros(SYMBOLS)
        count[np.frombuffer(row["next"], np.uint8)] = np.frombuffer(row["counts"], np.int64)
        contexts[row["last"], row["older"]] = count

    def smoothed(count: np.ndarray, parent: np.ndarray) -> np.ndarray:
        kinds = np.count_nonzero(count)
        return (count + kinds * parent) / (count.sum() + kinds)

    out, state = [known.share], np.zeros((SYMBOLS, SYMBOLS), np.int32)
    longer = {last for last, older in contexts if older >= 0}
    for last in range(SYMBOLS):
        own = contexts.get((last, -1))
        if own is None or not (last in longer or diverges(own, known.share, known.n)):
            continue
        state[last] = len(out)
        out.append(smoothed(own, known.share))
    for (last, older), count in sorted(contexts.items()):
        if older >= 0:
            parent = out[state[last, 0] if state[last, older] == 0 else state[last, older]]
            state[last, older] = len(out)
            out.append(smoothed(count, parent))
    shares = np.array(out)
    kinds = np.zeros((KINDS, len(out)))
    np.add.at(kinds, known.kind, shares.T)
    log10 = lambda x: np.log10(np.maximum(x, 1e-300)).astype(np.float32)
    return Tree(state, log10(shares), log10(kinds.T))


def scores(count: np.ndarray, chance: np.ndarray, hashes, classes, owner, offsets, known: Alphabet, model: Tree):
    """Base and model log10 probabilities of texts from each token's training count and the chance of its kind after the words
    before it (0: these are no state)."""
    rows = len(offsets) - 1
    base = np.log10((count + 1) / (known.n + known.v + 1))
    here = known.symbols(hashes, classes)
    last, older = _history(here, offsets)
    own = np.log10((count + 1) / known.inside[here])
    row = model.state[last, older]
    told = np.log10(np.maximum(chance, 1e-30)) - model.kinds[row, _kinds(hashes, classes)]
    value = model.log10[row, here] + np.where(chance > 0, told, 0.0) + np.where(
        (here > 0) & (here <= COMMON) | (here == 0), np.minimum(own, 0.0), own
    )
    return [np.bincount(owner, weights=x, minlength=rows) for x in (base, value)]


_SCORES = "d long, t long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(alphabet_, model_):
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({x.split()[0]: [] for x in _SCORES.split(", ")})
        known, model = alphabet_.value, model_.value
        words, _, _, inverse, owner, offsets, hashes, classes = _block_words(left)
        _, which, _ = _followers(words, inverse, owner, offsets, hashes, classes)
        order = np.argsort(right.column("shard").to_numpy())
        read = lambda name: b"".join(right.column(name)[int(k)].as_py() for k in order)
        count = np.frombuffer(read("totals"), np.int64)[inverse]
        chance = np.frombuffer(read("chances"), np.float32)[which].astype(np.float64)
        base, value = scores(count, chance, hashes, classes, owner, offsets, known, model)
        rows = left.num_rows
        return pa.table(
            {
                "d": left.column("d"),
                "t": left.column("t"),
                "train": left.column("train"),
                "n_tokens": pa.array(np.diff(offsets)),
                "n_known": pa.array(np.bincount(owner, weights=count > 0, minlength=rows).astype(np.int64)),
                "train_tokens": pa.array([known.n] * rows, pa.int64()),
                "base_score": pa.array(base),
                "score": pa.array(value),
            }
        )

    return score


def scored(docs: DataFrame, train) -> DataFrame:
    """Rows (d, t, train, n_tokens, n_known, train_tokens, base_score, score), one for each row of `docs`.

    train: a condition on `docs`; texts that fulfil it are learned from. Tokens are the words (lower-case A-Z) and one end;
    a null text is its end alone. base_score adds log10((c + 1) / (N + V + 1)) over the tokens; score is the log10
    probability under the suffix tree. Only doc_id, text and what `train` reads are used.
    """
    spark = docs.sparkSession
    rows = docs.select(
        id_key("doc_id").alias("d"),
        F.xxhash64("text").alias("t"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    blocks = 1 + size // BLOCK
    placed = rows.withColumn("block", F.pmod(F.xxhash64("d", "t"), F.lit(blocks)).cast("int"))
    words = placed.groupBy("block").applyInArrow(_send(-(-blocks // BLOCKS_OF_SHARD)), _WORDS)
    cells = rows.filter("train").select("text").mapInArrow(_count_kinds, "cell int, n long").groupBy("cell").agg(F.sum("n"))
    dense = np.zeros(KINDS**2)
    for cell, n in cells.collect():
        dense[cell] = n
    kinds = spark.sparkContext.broadcast(kinds_of(dense.reshape(KINDS, KINDS)))
    totals = saved(words.groupBy("shard").applyInArrow(lambda table: _total(table, kinds.value), _TOTALS))
    known = alphabet(totals)
    shared = spark.sparkContext.broadcast(known)
    cells = rows.filter("train").select("text").mapInArrow(_contexts(shared), _CELLS)
    salted = cells.withColumn("salt", F.spark_partition_id() % SALTS).repartition("last", "salt").drop("salt")
    whole = salted.mapInArrow(_add_up, _CELLS).repartition("last").mapInArrow(_add_up, _CELLS)
    kept = whole.mapInArrow(_keep(known.n), "last int, older int, next binary, counts binary")
    model = spark.sparkContext.broadcast(tree(kept.collect(), known))
    back = totals.filter("block >= 0").select("block", "shard", "totals", "chances")
    return placed.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_score(shared, model), _SCORES)
