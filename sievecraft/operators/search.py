"""Exact search for very many needles in very many texts, without moving the texts.

Both sides are cut into anchors that content alone decides: of the hashes of all pieces of eight bytes, those that are the
least of some window. A needle is at least as long as a window of its class, so wherever it occurs the text has the same
anchors there. Each needle is filed under the one of its anchors that the fewest needles have. Texts emit their anchors
with the bytes around, as far as a filter of the filed ones lets them pass; an equi-join by anchor finds the needles, and
comparing bytes decides.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from sievecraft.operators.joins import lookup_join

# Classes of needles by their size in bytes: (least size, bytes of a piece, pieces of a window). Shorter needles are a
# single piece of their own size.
SIZE_CLASSES = ((12, 8, 5), (8, 8, 1), *((size, size, 1) for size in range(7, 0, -1)))
# The filter of each class is a Bloom filter of FILTER_RATE to twice as many bits a needle, which lets less than a hundredth
# of the other anchors pass, within these bounds of 2 and 32 MB. With more than 16 million needles of a class it lets more
# pass, which costs time but no result.
FILTER_RATE, FILTER_PROBES = 16, 4
FILTER_BITS, MOST_FILTER_BITS = 1 << 24, 1 << 28


def _hashing():
    """Functions of tasks, as closures, so that executors need no copy of this package."""
    import numpy as np

    def mixed(values):
        values = values + np.uint64(0x9E3779B97F4A7C15)
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))

    def slid(values, width, least):
        """Least (or largest) value of every `width` neighbours."""
        out, have = values, 1
        while have < width:
            step = min(have, width - have)
            out = least(out[: len(out) - step], out[step:])
            have += step
        return out

    def pieces(data, size, piece, number):
        """Hash of the `piece` bytes at each place of data[:size]; eight more bytes follow."""
        places = max(size - piece + 1, 0)
        eights = np.ndarray((places,), np.dtype("<u8"), data, 0, (1,)) if places else np.zeros(0, np.uint64)
        mask = np.uint64((1 << 8 * piece) - 1)
        return mixed((eights & mask) ^ np.uint64((number + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1))

    def anchors(data, size, piece, window, number):
        """Places and hashes of the anchors of data[:size]."""
        hashes = pieces(data, size, piece, number)
        if len(hashes) < window:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        if window == 1:
            return np.arange(len(hashes)), hashes
        lows = slid(hashes, window, np.minimum)
        # A place is the least of some window if it is the largest of the least values of its windows.
        edge = np.zeros(window - 1, np.uint64)
        tops = slid(np.concatenate([edge, lows, edge]), window, np.maximum)
        places = np.flatnonzero(tops == hashes)
        return places, hashes[places]

    return anchors


def _needle_anchors():
    classes, anchors = SIZE_CLASSES, _hashing()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows = []
            for needle in batch.column("needle").to_pylist():
                raw = needle.encode()
                number = next(k for k, (least, _, _) in enumerate(classes) if len(raw) >= least)
                _, piece, window = classes[number]
                places, hashes = anchors(raw + bytes(8), len(raw), piece, window, number)
                _, first = np.unique(hashes, return_index=True)
                keys = hashes[first].view(np.int64).tolist()
                rows += [(needle, number, key, at, len(raw)) for key, at in zip(keys, places[first].tolist())]
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32())
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, kinds)], names=["needle", "class", "anchor", "before", "size"]
            )

    return run


def _text_anchors(filters, reach, key):
    """filters: broadcast (class, words) pairs; reach: bytes before and after an anchor, by class."""
    classes, probes, anchors = SIZE_CLASSES, FILTER_PROBES, _hashing()

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        low_half = np.uint64((1 << 32) - 1)
        masks = {number: np.frombuffer(words, np.uint64) for number, words in filters.value.items()}

        def found(part):
            column = part.column("text").fill_null("").cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            start, end = int(offsets[0]), int(offsets[-1])
            raw = (bytes(column.buffers()[2][start:end]) if end > start else b"") + bytes(8)
            offsets = offsets - start
            for number, words in masks.items():
                _, piece, window = classes[number]
                places, hashes = anchors(raw, len(raw) - 8, piece, window, number)
                for probe in range(probes):
                    bit = (hashes & low_half) + np.uint64(probe) * (hashes >> np.uint64(32)) & np.uint64(64 * len(words) - 1)
                    passed = (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)
                    picked = np.flatnonzero(passed)
                    places, hashes = places[picked], hashes[picked]
                owner = np.searchsorted(offsets, places, side="right") - 1
                before, after = reach[number]
                low = np.maximum(places - before, offsets[owner])
                high = np.minimum(places + after, offsets[owner + 1])
                around = [raw[a:b] for a, b in zip(low.tolist(), high.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(key).take(pa.array(owner)),
                        pa.array(hashes.view(np.int64)),
                        pa.array((places - low).astype(np.int32)),
                        pa.array(around, pa.binary()),
                    ],
                    names=[key, "anchor", "at", "around"],
                )

        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes + 16)
            row = 0
            while row < batch.num_rows:  # about a megabyte at once; a longer text by itself
                base = ends[row - 1] if row else 0
                to = max(row + 1, int(np.searchsorted(ends, base + (1 << 20), side="right")))
                yield from found(batch.slice(row, to - row))
                row = to

    return run


def found_needles(
    texts: DataFrame, needles: DataFrame, key: str = "id", text: str = "text", needle: str = "needle"
) -> DataFrame:
    """Distinct rows (key, needle) for every needle that a text contains, byte by byte.

    Null and empty needles are in no text, a null text holds none. Only anchors are shuffled, each with as many bytes as
    the longest needle of its class, never a text. `key` may be of any type that Arrow knows, and repeated.
    """
    distinct = needles.select(F.col(needle).alias("needle")).filter(F.col("needle") != "").distinct()
    options = distinct.mapInArrow(
        _needle_anchors(), "needle string, class int, anchor long, before int, size int"
    )
    shared = options.groupBy("anchor").agg(F.count("*").alias("sharing"))
    pick = F.min_by(F.struct("anchor", "before"), F.struct("sharing", "anchor"))
    filed = (
        options.join(shared, "anchor")
        .groupBy("needle", "class", "size")
        .agg(pick.alias("pick"))
        .select("needle", "class", "size", "pick.anchor", "pick.before")
        .persist(StorageLevel.DISK_ONLY)  # a row a needle, read five times and dear to make
    )

    after = F.max(F.col("size") - F.col("before")).alias("after")
    sizes = filed.groupBy("class").agg(F.max("before").alias("before"), after, F.count("*").alias("n")).collect()
    reach = {row["class"]: (row["before"], row["after"]) for row in sizes}
    spark = texts.sparkSession
    filters = spark.sparkContext.broadcast(_filter_words(filed, {row["class"]: filter_bits(row["n"]) for row in sizes}))
    rows = texts.select(F.col(key), F.col(text).cast("string").alias("text"))
    kind = rows.schema[key].dataType.simpleString()
    emitted = rows.mapInArrow(
        _text_anchors(filters, reach, key), f"`{key}` {kind}, anchor long, at int, around binary"
    )
    lookup = filed.select("anchor", "before", "needle")
    pairs = lookup_join(emitted, lookup, "anchor", [key, "at"], "inner")
    start = F.col("at") - F.col("before") + 1
    raw = F.col("needle").cast("binary")
    same = (start >= 1) & (F.substr("around", start, F.octet_length("needle")) == raw)
    return pairs.filter(same).select(key, "needle").distinct()


def filter_bits(needles: int) -> int:
    """Bits of the filter of so many needles, a power of two."""
    return min(max(FILTER_BITS, 1 << (FILTER_RATE * needles).bit_length()), MOST_FILTER_BITS)


def _filter_words(filed: DataFrame, bits: dict[int, int]) -> dict[int, bytes]:
    """FILTER_PROBES bits for each filed anchor, by class. The driver gets at most MOST_FILTER_BITS bits of a class."""
    import numpy as np

    # Halves of the anchor as unsigned numbers; sizes are powers of two.
    low, high = F.col("anchor").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned("anchor", 32)
    out = {}
    for one, size in bits.items():
        probes = F.array(*[(low + probe * high).bitwiseAND(F.lit(size - 1)) for probe in range(FILTER_PROBES)])
        placed = filed.filter(F.col("class") == one).select(F.explode(probes).alias("bit"))
        value = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)).cast("int"))
        words = placed.groupBy(F.shiftright("bit", 6).cast("int").alias("word")).agg(F.bit_or(value).alias("bits"))
        word, found = (x.to_numpy() for x in words.toArrow().columns)
        filled = np.zeros(size // 64, np.int64)
        filled[word] = found
        out[one] = filled.tobytes()
    return out
