"""Line deduplication by a segment-partition edit join.

Lines of at least ``least_chars`` code points whose texts are within ``most_edits`` edits of each
other are linked; of every component of links (equal lines are one node) the first line in order
of doc_id and place stays, all others are removed.

The join: a line is cut into ``most_edits + 1`` segments.  Two lines within that many edits
have a segment of the shorter one in the longer one, at nearly its place, so each line is put in
the index under its segments (with its length and the segment's number) and probes it
with those of its substrings that can be such segments for lines of its own length or up to
``most_edits`` shorter ones.  Index entries and probes are hashes that meet by one shuffle
of small rows.  Only lines that meet another one there are fetched with their text, and
verified by a banded bit-parallel edit distance, many pairs at a time.

A bucket of more than ``CELL_ROWS`` lines is cut into blocks whose pairs are buckets of
their own.  Buckets return spanning forests, not all pairs.  A line that very many documents
have is sent once by each task that meets it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import input_table, joined_ranges, materialize, slices, table
from touchline.llm.components import components
from touchline.llm.simhash import _forest

MOST_EDITS = 2
LEAST_CHARS = 30
CELL_ROWS = 1024
#: Lines a task remembers as sent; then it starts anew.
SEEN_LINES = 500_000
#: Size of the bitmap that keeps lines without a partner from being fetched.
BITMAP_BITS = 24
SECOND_SEED = 7


def segments(length: int, most_edits: int = MOST_EDITS) -> list[tuple[int, int]]:
    """(start, length) of each segment: as even as can be, the longer ones last."""
    n = most_edits + 1
    size, longer = divmod(length, n)
    sizes = [size + (i >= n - longer) for i in range(n)]
    return [(sum(sizes[:i]), s) for i, s in enumerate(sizes)]


def probes(length: int, most_edits: int = MOST_EDITS) -> list[tuple[int, int, int, int]]:
    """(indexed length, segment number, start, end) of the substrings that a line of this length looks up.

    Before segment i there are at most i edits if it is the first that matches, and after it at
    most most_edits - i if it is the last, so that only starts near its place are needed.
    """
    out = []
    for short in range(max(0, length - most_edits), length + 1):
        shift = length - short
        for i, (at, size) in enumerate(segments(short, most_edits)):
            low = max(0, at - i, at + shift - (most_edits - i))
            high = min(length - size, at + i, at + shift + (most_edits - i))
            out += [(short, i, start, start + size) for start in range(low, high + 1) if shift or start != at]
    return out


class Keys:
    """Bucket keys of lines; the places depend on the length alone and are kept by it."""

    def __init__(self, most_edits: int):
        self.most_edits, self.places = most_edits, {}

    def __call__(self, line: str) -> tuple[list[int], int]:
        """Signed 64-bit keys: of the segments, then of the probes; and how many are segments."""
        from xxhash import xxh64_intdigest

        n = len(line)
        if n not in self.places:
            own = [(n, i, a, a + s) for i, (a, s) in enumerate(segments(n, self.most_edits))]
            self.places[n] = [(length * 64 + i, a, z) for length, i, a, z in own + probes(n, self.most_edits)]
        return [xxh64_intdigest(line[a:z], seed) for seed, a, z in self.places[n]], self.most_edits + 1


def _unique_lines(batches: Iterator[pa.RecordBatch], least_chars: int) -> Iterator[tuple[list[str], list[int]]]:
    """Lines long enough, and their hashes, each about once a task."""
    from xxhash import xxh64_intdigest

    seen: set[int] = set()
    for batch in slices(batches, "text"):
        lines, hashes = [], []
        for text in batch.column("text").to_pylist():
            for line in (text or "").split("\n"):
                if len(line) >= least_chars and (h := xxh64_intdigest(line, 42)) not in seen:
                    seen.add(h)
                    lines.append(line)
                    hashes.append(h)
        if lines:
            yield lines, hashes
        if len(seen) > SEEN_LINES:
            seen.clear()


def bucket_rows(texts: DataFrame, most_edits: int = MOST_EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """key, probe (false for a segment), h (the line): what buckets get to see."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of = Keys(most_edits)
        for lines, hashes in _unique_lines(batches, least_chars):
            keys, counts = [], []
            for line in lines:
                own, n = keys_of(line)
                keys += own
                counts.append(len(own))
            counts = np.array(counts)
            nth = joined_ranges(np.zeros(len(counts), np.int64), counts)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.array(keys, dtype=np.uint64).view(np.int64)), pa.array(nth > most_edits),
                pa.array(np.repeat(np.array(hashes, dtype=np.uint64).view(np.int64), counts))], names=["key", "probe", "h"])

    return texts.select("text").mapInArrow(deal, "key long, probe boolean, h long")


def shared_buckets(rows: DataFrame) -> DataFrame:
    """Only the rows (each once) of keys that have an indexed line and another one."""
    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by key, probe, h. last: the key that goes on, its first line, and
        # whether it is open (a line so far), live (rows go out) or dead (probes alone).
        last: tuple[int, int, str] | None = None
        before: tuple[int, bool, int] | None = None
        for batch in batches:
            key, probe, h = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False)) for c in ("key", "probe", "h"))
            if not len(key):
                continue
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (probe[1:] != probe[:-1]) | (h[1:] != h[:-1])
            new[0] = before != (key[0], probe[0], h[0])
            before = (key[-1], probe[-1], h[-1])
            key, probe, h = key[new], probe[new], h[new]
            if not len(key):
                continue
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(key))))
            first = h[starts].copy()
            indexed = ~probe[starts]
            goes_on = last is not None and last[0] == key[0]
            if goes_on:
                first[0], indexed[0] = last[1], last[2] != "dead"
            mixed = np.bitwise_or.reduceat((h != first[run]).astype(np.int8), starts).astype(bool)
            if goes_on and last[2] == "live":
                mixed[0] = True
            keep = (indexed & mixed)[run]
            if goes_on and last[2] == "open" and indexed[0] and mixed[0]:
                yield pa.RecordBatch.from_pydict({"key": [int(key[0])], "probe": [False], "h": [int(first[0])]})
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(probe[keep]), pa.array(h[keep])], names=["key", "probe", "h"])
            last = (int(key[-1]), int(first[-1]), "dead" if not indexed[-1] else "live" if mixed[-1] else "open")

    sorted_ = rows.repartition("key").sortWithinPartitions("key", "probe", "h")
    return sorted_.mapInArrow(prune, "key long, probe boolean, h long")


def lines_of(texts: DataFrame, wanted: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """h, node (the line's 128 bits), line: the lines whose hash is wanted, each once.

    A bitmap of fixed size, made from all wanted hashes, holds back most others before the shuffle.
    """
    words = wanted.groupBy(F.shiftrightunsigned("h", 64 - BITMAP_BITS + 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(h, 40) & 63 as int))")).alias("bits"))
    found = words.collect()  # at most 2 ** (BITMAP_BITS - 6) rows
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    if found:
        bitmap[[r["word"] for r in found]] = [r["bits"] for r in found]
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value.view(np.uint64)
        for lines, hashes in _unique_lines(batches, least_chars):
            h = np.array(hashes, dtype=np.uint64)
            slot = h >> np.uint64(64 - BITMAP_BITS)
            at = np.flatnonzero((bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array([lines[i] for i in at])], names=["h", "line"])

    some = texts.select("text").mapInArrow(pick, "h long, line string")
    return some.join(wanted, "h", "left_semi").select("h", node_of("line"), "line").dropDuplicates(["node"])


def node_of(line: str) -> Column:
    """128 bits of a line, in hexadecimal."""
    return F.concat(F.hex(F.xxhash64(line)), F.lit("-"), F.hex(F.xxhash64(F.lit(SECOND_SEED), F.col(line)))).alias("node")


def within_edits(left: np.ndarray, left_size: np.ndarray, right: np.ndarray, right_size: np.ndarray, most_edits: int) -> np.ndarray:
    """Which pairs of lines (columns of code points, padded) are within most_edits edits.

    Bit k of a pair's word stands for the cell of the band where the right line is k - most_edits
    ahead of the left one; words[d] has the cells reached with at most d edits.  One step over
    a code point of the left lines moves all cells of all pairs at once.
    """
    band, n = 2 * most_edits + 1, len(left_size)
    kind = np.uint8 if band <= 7 else np.uint64
    shift = right_size - left_size
    ok = np.abs(shift) <= most_edits
    length = int(left_size.max(initial=0))
    # Beyond a line's end are code points that differ from all others.
    ahead = np.full((length + band, n), -2, dtype=np.int32)
    height = min(len(right), length + most_edits)
    ahead[most_edits : most_edits + height] = np.where(np.arange(height)[:, None] < right_size, right[:height], -2)
    words = [np.full(n, sum(1 << (most_edits + j) for j in range(d + 1)), dtype=kind) for d in range(most_edits + 1)]
    final = [w.copy() for w in words]
    full = kind((1 << band) - 1)
    for i in range(length):
        equal = np.zeros(n, dtype=kind)
        for k in range(band):
            equal |= (ahead[i + k] == left[i]).astype(kind) << kind(k)
        above = None
        for d in range(most_edits + 1):
            new = words[d] & equal
            if d:
                new |= old | (old >> kind(1)) | ((above << kind(1)) & full)
            old, words[d] = words[d], new
            above = new
        done = left_size == i + 1
        if done.any():
            for f, w in zip(final, words):
                f[done] = w[done]
    target = np.clip(shift + most_edits, 0, band - 1).astype(kind)
    return ok & (((final[most_edits] >> target) & kind(1)) == 1)


def linked_lines(cell: np.ndarray, side: np.ndarray, probe: np.ndarray, lines: list[str], most_edits: int,
                 pairs_at_once: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Links (a forest of each cell) among the lines of equal cell, of which one at least is indexed."""
    size = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    order = np.lexsort((size, cell))
    cell, side, probe, size = cell[order], side[order], probe[order], size[order]
    coded = [np.frombuffer(lines[i].encode("utf-32-le", "surrogatepass"), dtype="<i4") for i in order]
    root, n = np.arange(len(cell)), len(cell)

    def verify(u: np.ndarray, v: np.ndarray) -> None:
        nonlocal root
        # Pairs of like lengths together, in lots of bounded code points.
        order = np.argsort(size[v], kind="stable")
        u, v = u[order], v[order]
        while len(u):
            apart = root[u] != root[v]
            u, v = u[apart], v[apart]
            lot = min(pairs_at_once, max(1, (1 << 21) // max(1, int(size[v[:pairs_at_once]].max(initial=1)))))
            p, q, u, v = u[:lot], v[:lot], u[lot:], v[lot:]
            if len(p):
                close = within_edits(*_padded(coded, p, size), *_padded(coded, q, size), most_edits)
                if close.any():
                    root = _forest(np.concatenate([p[close], np.arange(n)]), np.concatenate([q[close], root]), n)

    step, at = 1, np.arange(max(0, n - 1))
    while len(at):
        at = at[(cell[at] == cell[at + step]) & (size[at + step] - size[at] <= most_edits)]
        met = at[((side[at] == 0) | (side[at] != side[at + step])) & ~(probe[at] & probe[at + step])]
        if len(met):
            verify(met, met + step)
        step += 1
        at = at[at + step < n]
    linked = np.flatnonzero(root != np.arange(n))
    return order[linked], order[root[linked]]


def _padded(coded: list[np.ndarray], rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' code points as columns, and their lengths."""
    sizes = size[rows]
    height = int(sizes.max(initial=0))
    out = np.full((len(rows), height), -1, dtype=np.int32)
    if len(rows):
        out[np.arange(height) < sizes[:, None]] = np.concatenate([coded[r] for r in rows])
    return np.ascontiguousarray(out.T), sizes


def line_links(texts: DataFrame, most_edits: int = MOST_EDITS, least_chars: int = LEAST_CHARS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """u, v (nodes): links of different lines whose components are those of all links.

    texts: a column text.
    """
    met = materialize(shared_buckets(bucket_rows(texts, most_edits, least_chars)), "line-buckets")
    lines = lines_of(texts, met.select("h").distinct(), least_chars)
    large = (met.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell_rows)
             .select("key", F.ceil(F.col("n") / cell_rows).cast("int").alias("blocks")))
    # Block numbers are dealt before the texts come, which then go where they are needed.
    dealt = met.join(large, "key", "left").withColumn("own", F.pmod(F.xxhash64("h", F.lit(1)), F.coalesce("blocks", F.lit(1))).cast("int"))
    cut = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    cells = cut.select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"), "probe", "h")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Cells are whole: the last one of a batch waits for the next.
        rest: list[dict] = []

        def found(rows: list[dict]) -> Iterator[pa.RecordBatch]:
            if len(rows) > 1:
                cell, side, probe = (np.array([r[c] for r in rows]) for c in ("cell", "side", "probe"))
                u, v = linked_lines(cell, side, probe, [r["line"] for r in rows], most_edits)
                if len(u):
                    yield pa.RecordBatch.from_pydict({"u": [rows[i]["node"] for i in u], "v": [rows[i]["node"] for i in v]})

        for batch in slices(batches, "line"):
            rows = rest + batch.to_pylist()
            upto = len(rows)
            while upto and rows[upto - 1]["cell"] == rows[-1]["cell"]:
                upto -= 1
            yield from found(rows[:upto])
            rest = rows[upto:]
        yield from found(rest)

    placed = cells.join(lines, "h").repartition("cell").sortWithinPartitions("cell")
    return placed.select("cell", "side", "probe", "node", "line").mapInArrow(match, "u string, v string")


def _doc_key() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_key"), F.xxhash64(F.col("text").cast("string")).alias("text_key")]


def repeated_lines(docs: DataFrame, most_edits: int = MOST_EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_key, text_key, line_no (from 0), class (node of a line of the class), doc_id: the lines to remove.

    Every line whose class has an earlier line, by doc_id (null first), text and place.
    """
    rows = input_table(docs, doc_id="long", text="string")
    found = components(line_links(rows, most_edits, least_chars))
    lines = rows.select("doc_id", *_doc_key(), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    places = materialize(lines.filter(F.char_length("line") >= least_chars).select("doc_id", "doc_key", "text_key", "line_no", node_of("line")), "lines")
    classed = places.join(found, "node", "left").withColumn("class", F.coalesce("root", "node")).drop("root", "node")
    place = F.struct("doc_id", "doc_key", "text_key", "line_no")
    several = classed.groupBy("class").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return classed.join(several, "class").filter(place != F.col("first")).select("doc_key", "text_key", "line_no", "class", "doc_id")


def without_repeated_lines(docs: DataFrame, most_edits: int = MOST_EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """whole (a struct of all columns), rest (the text without repeated lines), n_removed for each document.

    Shorter lines always stay.  Null texts stay null; rows that have the same doc_id and text
    are one document and are treated alike; an empty table gives no rows.
    """
    gone = (repeated_lines(docs, most_edits, least_chars).groupBy("doc_key", "text_key")
            .agg(F.sort_array(F.collect_set("line_no")).alias("gone")))
    joined = docs.select(F.struct("*").alias("whole"), *_doc_key()).join(gone, ["doc_key", "text_key"], "left")
    text = F.col("whole.text").cast("string")
    # The lines are bound to a name, or they'd be split again for each of them.
    kept = F.transform(F.array(F.split(text, "\n", -1)), lambda lines: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")), lambda i: F.get(lines, i)))
    rest = F.array_join(kept[0], "\n")
    return joined.select("whole", F.when(F.col("gone").isNull(), text).otherwise(rest).alias("rest"),
                         F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("n_removed"))


def drop_repeated_lines(docs: DataFrame, most_edits: int = MOST_EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The documents, all columns, with their repeated lines removed from ``text``.

    A document that had lines and of which none is left with a word goes altogether: earlier documents
    have all of it.  Documents without a repeated line are returned as they are.
    """
    out = without_repeated_lines(docs, most_edits, least_chars)
    out = out.filter((F.col("n_removed") == 0) | F.col("rest").rlike(r"[^\x20\x09-\x0D]"))
    return out.select(*[F.col("rest").alias(c) if c == "text" else F.col(f"whole.`{c}`").alias(c) for c in docs.columns])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_removed, rest_chars, rest_sha256 (of what stays) for each document."""
    found = without_repeated_lines(table(spark, sf_dir, "documents"))
    rest = F.coalesce("rest", F.lit(""))
    return found.select(F.col("whole.doc_id").alias("doc_id"), F.col("n_removed").cast("long").alias("n_removed"),
                        F.char_length(rest).cast("long").alias("rest_chars"), F.sha2(F.encode(rest, "UTF-8"), 256).alias("rest_sha256"))
