"""SimHash near-duplicates by pivot distance tables.

Fingerprints that differ in at most ``most_bits`` bits are linked; components of links are
groups of near-duplicates.  Equal fingerprints are one node, whatever the number of copies.

Which pairs meet: cut into ``2 + most_bits`` bands, two fingerprints that differ in at most
``most_bits`` bits agree in two bands at least, so every linked pair shares one of the 15
(for 4 bits) pairs of bands.  Pivots alone don't divide the work: two random fingerprints'
distances to a pivot differ by at most 4 in more than half of all cases, so a cell of a grid of
pivot distances holds a large part of all rows.  Within a cell of equal bands the pivot
table decides: every fingerprint's Hamming distances to many reference fingerprints are
computed once; by the triangle inequality a pair whose distances to any pivot differ by more
than ``most_bits`` is discarded, and the survivors are verified bit by bit.  Rows of a cell are sorted
by their first coordinate, so that pairs too far apart in it aren't even formed.

A cell that has more than ``CELL_ROWS`` fingerprints is cut into blocks, and every two blocks of
it are a cell of their own: all pairs still meet, in many bounded tasks.  A cell returns a
spanning forest of its links (fewer than it has rows), never all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import input_table, materialize, slices, table, unsigned_hex
from touchline.llm.components import components

SHINGLE_WORDS = 4
MOST_BITS = 4
PIVOTS = 32
CELL_ROWS = 4096


def fingerprints(texts: list[str | None], shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Unsigned 64-bit fingerprints: a bit is set if it is in over half the shingles' hashes."""
    from xxhash import xxh64_intdigest

    out = np.zeros(len(texts), dtype=np.uint64)
    for k, text in enumerate(texts):
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        begins = np.concatenate([[0], ends[:-1] + 1])
        n = max(1, len(words) - shingle_words + 1)
        last = ends[shingle_words - 1 :] if len(words) >= shingle_words else ends[-1:]
        hashes = np.fromiter((xxh64_intdigest(joined[a:b], 42) for a, b in zip(begins[:n].tolist(), last.tolist())), dtype=np.uint64, count=n)
        votes = np.zeros(64, dtype=np.int64)
        for at in range(0, n, 1 << 15):
            bits = np.unpackbits(hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes += bits.sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0]
    return out


def with_fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_hash, fp (the fingerprint's 64 bits as a signed integer); a null text has no words."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fp = fingerprints(batch.column("text").to_pylist(), shingle_words).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(fp)], names=["doc_id", "text_hash", "fp"])

    rows = input_table(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(mark, "doc_id long, text_hash long, fp long")


def band_masks(most_bits: int = MOST_BITS) -> list[int]:
    """The bits of every two bands, as signed 64-bit masks."""
    n = most_bits + 2
    edges = [64 * i // n for i in range(n + 1)]
    bands = [sum(1 << b for b in range(a, z)) for a, z in zip(edges, edges[1:])]
    return [int(np.uint64(a | b).view(np.int64)) for a, b in combinations(bands, 2)]


def pivots(n: int = PIVOTS, seed: int = 17) -> np.ndarray:
    """Reference fingerprints: the first n values of a fixed generator."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, size=n, dtype=np.uint64)


def _forest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The smallest index of each of n nodes' component under the links u, v."""
    root = np.arange(n)
    while len(u):
        a, b = root[u], root[v]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_ = low < high
        if not open_.any():
            break
        u, v = u[open_], v[open_]
        np.minimum.at(root, high[open_], low[open_])
        while True:
            after = root[root]
            if (after == root).all():
                break
            root = after
    return root


def linked_in_cells(cell: np.ndarray, side: np.ndarray, fp: np.ndarray, refs: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (pairs of row numbers, a forest of each cell) among rows of equal cell.

    side: 0 for cells whose rows all meet; 1 and 2 for those in which rows of either meet the other's.
    """
    first = np.bitwise_count(fp ^ refs[0])
    order = np.lexsort((first, cell))
    cell, side, fp = cell[order], side[order], fp[order]
    distances = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.int8)
    same = np.concatenate([cell[1:] == cell[:-1], [False]])
    us, vs, held = [], [], 0
    at, step = np.flatnonzero(same), 1
    root = np.arange(len(fp))
    while len(at):
        # Sorted by the first coordinate: once a row's partner is too far, so are all later ones.
        near = (cell[at] == cell[at + step]) & (distances[at + step, 0] - distances[at, 0] <= most_bits)
        at = at[near]
        met = at[(side[at] == 0) | (side[at] != side[at + step])]
        for k in range(1, len(refs)):
            if not len(met):
                break
            met = met[np.abs(distances[met, k] - distances[met + step, k]) <= most_bits]
        if len(met):
            met = met[np.bitwise_count(fp[met] ^ fp[met + step]) <= most_bits]
            us.append(met)
            vs.append(met + step)
            held += len(met)
            if held > 1 << 22:
                root = _forest(np.concatenate([*us, np.arange(len(fp))]), np.concatenate([*vs, root]), len(fp))
                us, vs, held = [], [], 0
        step += 1
        at = at[at + step < len(fp)]
    if us:
        root = _forest(np.concatenate([*us, np.arange(len(fp))]), np.concatenate([*vs, root]), len(fp))
    linked = np.flatnonzero(root != np.arange(len(root)))
    return order[linked], order[root[linked]]


def cells(fps: DataFrame, most_bits: int = MOST_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """cell, side, fp: each fingerprint once for every two bands; large cells cut into pairs of blocks."""
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(band_masks(most_bits))]
    spread = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    large = (spread.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell_rows)
             .select(F.col("key").alias("large_key"), F.ceil(F.col("n") / cell_rows).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int")
    dealt = spread.join(large, spread["key"] == large["large_key"], "left")
    whole = dealt.filter("blocks IS NULL").select(F.col("key").alias("cell"), F.lit(0).alias("side"), "fp")
    parts = (dealt.filter("blocks IS NOT NULL").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
                     F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"), "fp"))
    return whole.unionByName(parts)


def links(fps: DataFrame, most_bits: int = MOST_BITS, n_pivots: int = PIVOTS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """u, v: links between different fingerprints whose components are those of all links."""
    refs = pivots(n_pivots)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by cell; a cell's rows (bounded) are looked at together.
        rest: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros(0, np.uint64)]

        def found(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if len(rows[0]) > 1:
                u, v = linked_in_cells(rows[0], rows[1], rows[2], refs, most_bits)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(rows[2][x].view(np.int64)) for x in (u, v)], names=["u", "v"])

        for batch in batches:
            new = [np.asarray(batch.column("cell")), np.asarray(batch.column("side")).astype(np.int8), np.asarray(batch.column("fp")).view(np.uint64)]
            rows = [np.concatenate(x) for x in zip(rest, new)]
            if not len(rows[0]):
                continue
            upto = int(np.searchsorted(rows[0], rows[0][-1], side="left"))
            yield from found([x[:upto] for x in rows])
            rest = [x[upto:] for x in rows]
        yield from found(rest)

    dealt = cells(fps, most_bits, cell_rows).repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(match, "u long, v long")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """doc_id, text_hash, fp, root (of its component), component_id (the smallest doc_id reachable over links, itself included) of all documents.

    Null and empty texts have fingerprint zero, linked like any other.  Every row counts,
    also with a repeated doc_id; null doc_ids are larger than all others, and the id of a component that
    has no other.
    """
    marked = materialize(with_fingerprints(docs, shingle_words), "fingerprints")
    fps = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = components(links(fps.select("fp"), most_bits))
    rooted = fps.join(found, fps["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    return marked.join(materialize(named, "fingerprint-components"), "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """One document of each group, the one with the smallest doc_id (null is the largest), all columns.

    Of rows that tie, one of those with the smallest text hash stays.
    """
    groups = near_duplicates(docs, shingle_words, most_bits)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    stay = groups.groupBy("root").agg(first).select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    wide = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("hash"))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash"))
    return wide.join(stay, same, "left_semi").dropDuplicates(["id", "hash"]).select("row.*")


def op3_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of each document; texts without words have fingerprint zero and are linked by it."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")
