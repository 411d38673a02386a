"""Best-fit packing of token pieces after Martello-Toth dominance reduction.

Sequences hold at most ``capacity`` tokens, so pieces have at most ``capacity`` different
lengths.  Both the reduction and the best-fit step work on the counts of those lengths (a
table of at most ``capacity`` rows, whatever the input) and give *patterns*: how many
sequences hold which lengths.  Pieces then look their place up by length and rank, in
parallel; no piece passes through the driver.

Reduction, longest piece first (Martello and Toth, bin packing, sets of up to three items
that dominate all others): a piece that no other fits beside stays alone; if at most one
other fits, or the longest that fits fills the sequence, the two are fixed; if at most two
fit, the longest single is fixed if it is at least as long as the best two together, or the
two are if one of them is as long as that single and no two longer than the other fit.  What remains
is packed best-fit, longest first.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import input_table, materialize, slices, table
from touchline.llm.tokens import VOCABULARY, WordEncoder

CAPACITY = 2048
END_ID = 0
#: Pieces of one length are ranked in blocks of about this many.
RANK_BLOCK = 1 << 18


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, little-endian) of every document.

    A null text is an empty one.  Only documents of more than ``capacity`` ids are cut.
    """
    import binascii

    fields = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(vocabulary)
        for batch in slices(batches, "text", 8 << 20):
            ids, counts = encoder.encode(batch.column("text"))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id).astype("<u4")
            counts = counts + 1
            begins = np.cumsum(counts) - counts
            pieces = -(-counts // capacity)
            owner = np.repeat(np.arange(len(counts)), pieces)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = number * capacity
            length = np.minimum(capacity, counts[owner] - start)
            raw, at = memoryview(ids.tobytes()), (begins[owner] + start) * 4
            cuts = [raw[a : a + n] for a, n in zip(at.tolist(), (length * 4).tolist())]
            out = {
                "doc_id": batch.column("doc_id").take(pa.array(owner)),
                "piece": pa.array(number.astype(np.int32)),
                "start": pa.array(start.astype(np.int64)),
                "length": pa.array(length.astype(np.int64)),
                "ids_crc32": pa.array([binascii.crc32(x) for x in cuts], pa.int64()),
            }
            if with_ids:
                out["ids"] = pa.array([bytes(x) for x in cuts], pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    return input_table(docs, doc_id="long", text="string").mapInArrow(cut, fields)


def _fixed_set(lengths: list[int], count: dict[int, int], w: int, room: int) -> tuple[int, ...] | None:
    """The lengths that go with one piece of length w (already taken out), or None.

    lengths: those with a count, ascending.
    """
    smallest = []
    for x in lengths:
        smallest += [x] * min(count[x], 3 - len(smallest))
        if len(smallest) == 3:
            break
    if not smallest or smallest[0] > room:
        return ()
    best = lengths[bisect_right(lengths, room) - 1]
    if best == room or len(smallest) < 2 or smallest[0] + smallest[1] > room:
        return (best,)
    if len(smallest) == 3 and sum(smallest) <= room:
        return None
    # At most two fit: the longest two that fit together.
    pair, low, high = (0, 0, 0), 0, len(lengths) - 1
    while low <= high:
        a, b = lengths[low], lengths[high]
        if a + b > room:
            high -= 1
        elif low == high and count[a] < 2:
            break
        else:
            pair = max(pair, (a + b, b, a))
            low += 1
    if best >= pair[0]:
        return (best,)
    if best == pair[1]:
        # Any other two have one no longer than the shorter of these, if no two longer ones fit.
        used, above = Counter(pair[1:]), []
        for x in lengths[bisect_left(lengths, pair[2]):]:
            above += [x] * min(count[x] - (used[x] if x == pair[2] else 0), 2 - len(above))
            if len(above) == 2:
                break
        if len(above) < 2 or sum(above) > room:
            return (pair[1], pair[2])
    return None


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, tuple[tuple[int, int], ...]]], dict]:
    """Patterns (number of sequences, ((length, pieces in each), ...)) and what the steps did.

    counts: pieces by length, 1 to capacity.  Work and result depend on the number of
    different lengths only.
    """
    left = {w: n for w, n in counts.items() if n}
    lengths = sorted(left)
    found: list[tuple[int, tuple[int, ...]]] = []

    def take(w: int, n: int) -> None:
        left[w] -= n
        if not left[w]:
            del left[w]
            del lengths[bisect_left(lengths, w)]

    fixed = 0
    for w in sorted(counts, reverse=True):
        while left.get(w):
            take(w, 1)
            with_it = _fixed_set(lengths, left, w, capacity - w)
            if with_it is None:
                left[w] = left.get(w, 0) + 1
                if left[w] == 1:
                    lengths.insert(bisect_left(lengths, w), w)
                break
            # As often as each of them is there; what fits only gets less meanwhile.
            need = Counter(with_it)
            times = min([(left.get(x, 0) + (x == w)) // (k + (x == w)) for x, k in need.items()], default=left.get(w, 0) + 1)
            times = min(times, left.get(w, 0) + 1 if w not in need else times)
            if len(with_it) == 2:
                times = 1 if times < 1 else min(times, max(1, min(left[x] for x in need) // 4))
            need[w] += 1
            for x, k in need.items():
                n = times * k - (x == w)
                if n:
                    take(x, n)
            found.append((times, tuple(need.elements())))
            fixed += times * (1 + len(with_it))

    # Best fit, longest first: sequences by room, each a stack of (number, lengths).
    rooms: list[int] = []
    open_: dict[int, list[tuple[int, tuple[tuple[int, int], ...]]]] = {}

    def put(room: int, number: int, pattern: tuple[tuple[int, int], ...]) -> None:
        if room not in open_:
            rooms.insert(bisect_left(rooms, room), room)
            open_[room] = []
        open_[room].append((number, pattern))

    for w in sorted(left, reverse=True):
        n = left[w]
        while n:
            at = bisect_left(rooms, w)
            if at == len(rooms):
                # One piece after another goes where the last one went while it fits.
                each = min(n, capacity // w)
                number = n // each
                put(capacity - each * w, number, ((w, each),))
                n -= number * each
                continue
            room = rooms[at]
            number, pattern = open_[room].pop()
            if not open_[room]:
                del open_[room]
                del rooms[at]
            each = min(n, room // w)
            used = min(number, n // each)
            if used < number:
                put(room, number - used, pattern)
            put(room - each * w, used, (*pattern, (w, each)))
            n -= used * each
    patterns = [(n, tuple(sorted(Counter(p).items(), reverse=True))) for n, p in found]
    patterns += [x for room in rooms for x in open_[room]]
    return patterns, {"fixed": fixed, "pieces": sum(counts.values()), "sequences": sum(n for n, _ in patterns)}


def places(patterns: list[tuple[int, tuple[tuple[int, int], ...]]]) -> dict[str, np.ndarray]:
    """For each length and first rank in it: the first sequence, pieces in each, and offset."""
    rows, first, given = [], 0, Counter()
    for number, pattern in patterns:
        offset = 0
        for w, each in pattern:
            rows.append((w, given[w], first, each, offset))
            given[w] += number * each
            offset += w * each
        first += number
    rows.sort()
    columns = np.array(rows or [(0, 0, 0, 1, 0)], dtype=np.int64).T
    return dict(zip(("length", "rank", "sequence", "each", "offset"), columns))


def ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Adds rank, from 0 in each length.

    A length is dealt out to blocks by a hash of the piece, so that a length that many
    pieces have (full ones above all) is ranked by many tasks.
    """
    most = max(counts.values(), default=0)
    blocks = max(1, -(-most // RANK_BLOCK)) * 8
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)))
    upto = (dealt.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
            .select("length", "block", (F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n")).alias("before")))
    own = F.row_number().over(Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32"))
    return (dealt.withColumn("own", own).join(upto, ["length", "block"])
            .withColumn("rank", F.col("before") + F.col("own") - 1).drop("block", "own", "before"))


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """Token pieces of the documents with their place: sequence_id and offset.

    One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and
    ids (little-endian 32-bit) on request.  Sequences hold at most ``capacity`` ids and
    have no gaps.  Null texts are empty and have the end id alone; null and repeated
    doc_ids are kept, row by row; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    pieces = materialize(token_pieces(docs, vocabulary or default_vocabulary(), capacity, end_id, with_ids), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.sparkContext.broadcast(places(pack_lengths(counts, capacity)[0]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        most = int(max(p["rank"].max(), 0)) + 1
        wide = 1 << max(40, most.bit_length())
        keys = p["length"] * wide + p["rank"]
        for batch in batches:
            length, rank = (np.asarray(batch.column(x)).astype(np.int64) for x in ("length", "rank"))
            at = np.searchsorted(keys, length * wide + rank, side="right") - 1
            nth = rank - p["rank"][at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in kept), pa.array(p["sequence"][at] + nth // p["each"][at]),
                 pa.array(p["offset"][at] + nth % p["each"][at] * length)],
                names=[*kept, "sequence_id", "offset"])

    kept = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.select(*kept).schema)
    return ranked(pieces, counts).mapInArrow(place, f"{fields}, sequence_id long, offset long")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token piece of all documents with its sequence and offset; null texts have the end id alone."""
    return pack(table(spark, sf_dir, "documents"))
