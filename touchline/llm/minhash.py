"""MinHash near-duplicates by min-max hashing.

A document's set are its distinct word shingles, as 64-bit hashes.  Under each of ``PERMUTATIONS``
hash functions both the least and the greatest value of the set are kept (min-max hashing): either
agrees between two sets with a probability of their Jaccard similarity, so n evaluations give a signature
of 2n values, whose estimate is unbiased and varies less than that of 2n minima.  Bands are made of
``BAND_ROWS`` minima or of as many maxima; at a similarity of exactly 0.8 a pair misses all of the
32 bands of 5 values with a probability of 3e-6, above it less.

Equal sets are one node (128-bit digest), whatever the number of copies.  Links are confirmed on full sets:

1. Every node of a bucket meets the bucket's smallest node; a node with many partners is cut into chunks.
2. The components of those links are made.  Buckets whose nodes are in one component need no more.
3. In the others all pairs of different components meet, in cells of bounded size: a large bucket is
   cut into blocks, and every two blocks are a cell.  Buckets with the same nodes are one cell.

No pair that shares a bucket is left out, except those that links already connect.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import input_table, materialize, slices, table
from touchline.llm.components import components

SHINGLE_WORDS = 2
LEAST_PERCENT = 80
PERMUTATIONS = 80
BAND_ROWS = 5
CHUNK = 64
CELL_ROWS = 256
CELL_SHINGLES = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, shingle_words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all texts, one text after another, and the number of each.

    Words are runs of characters other than the six ASCII blanks, A-Z as a-z; a text of fewer than
    shingle_words words has one shingle of all; null and wordless texts have none.
    """
    from xxhash import xxh64_intdigest

    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    flat, bounds = split.flatten(), np.asarray(split.offsets).astype(np.int64)
    bounds = bounds - bounds[0]
    coded = flat.dictionary_encode()
    distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter((xxh64_intdigest(w.lower(), 7) for w in distinct), dtype=np.uint64, count=len(distinct))
    full = np.asarray(pc.not_equal(flat, "")).astype(bool)
    upto = np.concatenate([[0], np.cumsum(full)])
    bounds = upto[bounds]
    words = hashes[np.asarray(coded.indices)[full]] if len(flat) else np.zeros(0, np.uint64)

    def joined(parts: np.ndarray) -> np.ndarray:
        # The hash of a sequence of words, from its length on.
        x = np.full(parts.shape[1], len(parts), dtype=np.uint64)
        for part in parts:
            x = _mixed(x + part)
        return x

    k = shingle_words
    runs = joined(np.lib.stride_tricks.sliding_window_view(words, k).T) if len(words) >= k else np.zeros(0, np.uint64)
    out, sizes = [], np.zeros(len(bounds) - 1, dtype=np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if b > a:
            found = np.unique(runs[a : b - k + 1]) if b - a >= k else joined(words[a:b].reshape(-1, 1))
            out.append(found)
            sizes[i] = len(found)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), sizes


def permutation_keys(n: int = PERMUTATIONS, seed: int = 29) -> np.ndarray:
    """Two words for each hash function: what is added first, and an odd factor."""
    keys = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, size=(n, 2), dtype=np.uint64)
    keys[:, 1] |= np.uint64(1)
    return keys


def signatures(shingles: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minima and maxima of each non-empty set under each hash function: two arrays [function, set]."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    least = np.empty((len(keys), len(starts)), dtype=np.uint64)
    most = np.empty_like(least)
    for i, (add, factor) in enumerate(keys):
        x = (shingles + add) * factor
        x ^= x >> np.uint64(29)
        x *= factor
        least[i] = np.minimum.reduceat(x, starts)
        most[i] = np.maximum.reduceat(x, starts)
    return least, most


def bands(least: np.ndarray, most: np.ndarray, band_rows: int = BAND_ROWS) -> np.ndarray:
    """[set, band]: a 64-bit key of every band_rows minima, then of every band_rows maxima; the band's number is part of it."""
    out = []
    for values in (least, most):
        for at in range(0, len(values) - band_rows + 1, band_rows):
            x = np.full(values.shape[1], len(out) + 1, dtype=np.uint64)
            for row in values[at : at + band_rows]:
                x = _mixed(x + row)
            out.append(x)
    return np.stack(out, axis=1)


def with_bands(docs: DataFrame, shingle_words: int, permutations: int, band_rows: int) -> DataFrame:
    """doc_id, h1, h2 (hashes of the text), n_shingles, node (digest of the set, null if empty), bands."""
    from xxhash import xxh3_128_digest

    keys = permutation_keys(permutations)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            shingles, sizes = shingle_sets(batch.column("text"), shingle_words)
            upto = np.cumsum(sizes)
            nodes = [xxh3_128_digest(shingles[b - n : b].tobytes()) if n else None for b, n in zip(upto.tolist(), sizes.tolist())]
            n_bands = 2 * (permutations // band_rows)
            found = bands(*signatures(shingles, sizes, keys), band_rows) if len(shingles) else np.zeros((0, n_bands), np.uint64)
            has = np.concatenate([[0], np.cumsum(sizes > 0)]) * n_bands
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h1"), batch.column("h2"), pa.array(sizes), pa.array(nodes, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(has, pa.int32()), pa.array(found.reshape(-1).view(np.int64)))],
                names=["doc_id", "h1", "h2", "n_shingles", "node", "bands"])

    rows = input_table(docs, doc_id="long", text="string").withColumns(text_hashes("text"))
    return rows.mapInArrow(mark, "doc_id long, h1 long, h2 long, n_shingles long, node binary, bands array<long>")


def text_hashes(column: str) -> dict:
    return {"h1": F.xxhash64(column), "h2": F.xxhash64(F.lit(1), column)}


def with_sets(docs: DataFrame, wanted: DataFrame, shingle_words: int) -> DataFrame:
    """node, set (its sorted hashes' bytes) of the wanted nodes (node, h1, h2), from one text of each."""
    texts = input_table(docs, text="string").withColumns(text_hashes("text")).join(wanted, ["h1", "h2"])
    one = texts.groupBy("node").agg(F.first("text").alias("text"))  # copies meet before the shuffle

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            shingles, sizes = shingle_sets(batch.column("text"), shingle_words)
            upto = np.cumsum(sizes)
            sets = [shingles[b - n : b].tobytes() for b, n in zip(upto.tolist(), sizes.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "set"])

    return one.mapInArrow(build, "node binary, set binary")


def similar_to(one: np.ndarray, others: list[np.ndarray], least_percent: int = LEAST_PERCENT) -> np.ndarray:
    """Which of the other sorted sets have 100 * intersection >= least_percent * union with one."""
    if not others:
        return np.zeros(0, dtype=bool)
    sizes = np.fromiter(map(len, others), dtype=np.int64, count=len(others))
    small, large = np.minimum(sizes, len(one)), np.maximum(sizes, len(one))
    out = 100 * small >= least_percent * large
    at = np.flatnonzero(out)
    if len(at):
        every = np.concatenate([others[i] for i in at])
        place = np.searchsorted(one, every)
        place[place == len(one)] = 0
        shared = np.add.reduceat((one[place] == every).astype(np.int64), np.cumsum(sizes[at]) - sizes[at])
        out[at] = 100 * shared >= least_percent * (sizes[at] + len(one) - shared)
    return out


def linked_in_cell(side: list[int], group: list, sets: list[np.ndarray], least_percent: int) -> list[tuple[int, int]]:
    """Links among the rows of a cell that connect different groups, enough to connect all that are linked.

    side: rows of side 0 meet all rows, those of side 1 only those of side 2.
    """
    root: dict = {g: g for g in group}

    def find(g):
        while root[g] != g:
            root[g] = root[root[g]]
            g = root[g]
        return g

    found = []
    for i in range(len(sets) - 1):
        if side[i] == 2:
            continue
        own = find(group[i])
        rest = [j for j in range(i + 1, len(sets)) if (side[i] == 0 or side[j] == 2) and find(group[j]) != own]
        for j in np.array(rest, dtype=np.int64)[similar_to(sets[i], [sets[j] for j in rest], least_percent)].tolist():
            a, b = find(group[i]), find(group[j])
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((i, j))
    return found


def confirmed(cells: DataFrame, sets: DataFrame, least_percent: int) -> DataFrame:
    """u, v: confirmed links of cells (cell, side, node, grp); rows of a cell are read together."""
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def found() -> Iterator[pa.RecordBatch]:
            side, node, group, held = zip(*rows)
            links = linked_in_cell(side, group, [np.frombuffer(x, dtype="<u8") for x in held], least_percent)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([node[p[x]] for p in links], pa.binary()) for x in (0, 1)], names=["u", "v"])

        for batch in batches:
            columns = [batch.column(x) for x in ("cell", "side", "node", "grp", "set")]
            for cell, *row in zip(*(c.to_pylist() for c in columns)):
                if cell != now:
                    if len(rows) > 1:
                        yield from found()
                    now, rows = cell, []
                rows.append(row)
        if len(rows) > 1:
            yield from found()

    dealt = cells.join(sets, "node").select("cell", "side", "node", "grp", "set").repartition("cell").sortWithinPartitions("cell", "side", "node")
    return dealt.mapInArrow(match, "u binary, v binary")


def star_cells(buckets: DataFrame) -> DataFrame:
    """Cells of a bucket's smallest node (side 1) and up to about CHUNK of the nodes that share a bucket with it."""
    pairs = buckets.filter("node > least").select("least", "node").distinct()
    many = pairs.groupBy("least").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    dealt = pairs.join(many, "least").select("least", "node", F.pmod(F.xxhash64("node"), F.col("chunks")).alias("chunk"))
    cell = F.xxhash64("least", "chunk").alias("cell")
    members = dealt.select(cell, F.lit(2).alias("side"), "node", F.col("node").alias("grp"))
    heads = many.select("least", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    return members.unionByName(heads.select(cell, F.lit(1).alias("side"), F.col("least").alias("node"), F.col("least").alias("grp")))


def open_cells(buckets: DataFrame, grouped: DataFrame, cell_rows: int = CELL_ROWS, cell_shingles: int = CELL_SHINGLES) -> DataFrame:
    """Cells of the buckets whose nodes are in several groups (grouped: node, grp)."""
    rows = buckets.join(grouped, "node", "left").select("bucket", "node", "n_shingles", F.coalesce("grp", "node").alias("grp"))
    kept = (rows.groupBy("bucket").agg(F.min("grp").alias("a"), F.max("grp").alias("z"), F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"),
                                       F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("who"))
            .filter("a < z").select("bucket", "n", "who", F.greatest(F.ceil(F.col("n") / cell_rows), F.ceil(F.col("s") / cell_shingles)).alias("blocks")))
    dealt = rows.join(kept, "bucket")
    whole = dealt.filter("blocks = 1").select(F.xxhash64("n", "who").alias("cell"), F.lit(0).alias("side"), "node", "grp").distinct()
    parts = (dealt.filter("blocks > 1").withColumn("own", F.pmod(F.xxhash64(F.lit(2), "node"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
                     F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"), "node", "grp"))
    return whole.unionByName(parts)


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, least_percent: int = LEAST_PERCENT,
                    permutations: int = PERMUTATIONS, band_rows: int = BAND_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, n_shingles, node (digest of the set), component_id (the smallest doc_id reachable over links, itself included), kept of all documents.

    Null, empty and wordless texts have an empty set, a null node and their own doc_id as component.  Every row
    counts, also with a repeated doc_id; null doc_ids are larger than all others, never kept, and the
    component_id of a component that has no other.
    """
    marked = materialize(with_bands(docs, shingle_words, permutations, band_rows), "min-max")
    nodes = marked.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("h1", "h2")).alias("h"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    nodes = materialize(nodes, "sets-by-digest")

    spread = nodes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    buckets = materialize(spread.join(shared, "bucket"), "shared-buckets")

    wanted = buckets.select("node").distinct().join(nodes.select("node", "h.h1", "h.h2"), "node")
    sets = materialize(with_sets(docs, wanted, shingle_words), "shingle-sets")
    links = materialize(confirmed(star_cells(buckets), sets, least_percent), "star-links")
    grouped = materialize(components(links).toDF("node", "grp"), "star-components")
    more = materialize(confirmed(open_cells(buckets, grouped, cell_rows), sets, least_percent), "further-links")
    found = components(links.union(more)).toDF("node", "root")

    rooted = nodes.select("node", "least_id").join(found, "node", "left").select("node", "least_id", F.coalesce("root", "node").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "root").select("node", "component_id")
    named = materialize(named, "set-components")
    # Rows without a set keep away from the join: their null is no key.
    full = marked.filter("node IS NOT NULL").join(named, "node").select("doc_id", "n_shingles", "node", "component_id")
    empty = marked.filter("node IS NULL").select("doc_id", "n_shingles", "node", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op13_minmax_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with 80 % of their two-word shingles in common, over all documents.

    Null and wordless texts are alone; repeated rows all come back; empty tables give no rows.
    """
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
