"""A Merkle manifest of a dataset, its digests stored in van Emde Boas order.

Every value of the group column is a binary tree over its rows in order; the trees' roots are the leaves of
one more tree, whose root stands for the dataset.  A tree is cut into aligned subtrees of ``BLOCK_LEVELS``
levels.  A block is an array of digests in van Emde Boas order: the subtree is split at half its height, the
top part comes first, then the bottom parts from left to right, each laid out in the same way again, so that
a path from leaf to root touches few memory blocks of whatever size.  Parents are found while
a block is built, and siblings while a proof is read, by the same address arithmetic (``address``).  The
roots of the blocks are the leaves of blocks of the next tier, up to a tier of one block.

A block holds at most 2^BLOCK_LEVELS leaves, whatever the size of a group, and ranks within a group are
dealt out by ranges, so a group with a third of all rows is many tasks.  Digests go into others as
lower-case hexadecimal text; the last node of an odd level is hashed alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import input_table, materialize, table
from touchline.llm.ranks import ranked
from touchline.llm.sqltext import CRC_TABLE, crc32_of

BLOCK_LEVELS = 11
FIELDS = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}
EMPTY = sha256(b"").hexdigest()
#: What a step of a proof does: nothing beside the node, a sibling before it, a sibling after it.
ALONE, BEFORE, AFTER = b"\x00", b"\x01", b"\x02"


def digest(*parts: bytes) -> bytes:
    """SHA-256 of digests, which go in as hexadecimal text."""
    return sha256("".join(p.hex() for p in parts).encode()).digest()


def address(height: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes of a depth (0: the root) of a complete tree of so many levels lie in van Emde Boas order."""
    index = np.asarray(index, dtype=np.int64)
    at = np.zeros(len(index), dtype=np.int64)
    while height > 1:
        top = height // 2
        if depth < top:
            height = top
            continue
        bottom = height - top
        depth -= top
        at += (1 << top) - 1 + (index >> depth) * ((1 << bottom) - 1)
        index = index & ((1 << depth) - 1)
        height = bottom
    return at


@lru_cache(maxsize=64)
def _addresses(height: int, up: int) -> np.ndarray:
    """Addresses of the nodes so many levels above the leaves."""
    return address(height, height - 1 - up, np.arange(1 << (height - 1 - up)))


def built(leaves: list[bytes], height: int) -> np.ndarray:
    """The block over the leaves: digests of 32 bytes in van Emde Boas order, zeros where no node is."""
    nodes = np.zeros(((1 << height) - 1, 32), dtype=np.uint8)
    level = leaves
    for up in range(height):
        if up:
            at = _addresses(height, up - 1)[: len(level)]
            below = [row.tobytes() for row in nodes[at]]
            level = [digest(*below[i : i + 2]) for i in range(0, len(below), 2)]
        nodes[_addresses(height, up)[: len(level)]] = np.frombuffer(b"".join(level), dtype=np.uint8).reshape(-1, 32)
    return nodes


def siblings(nodes: np.ndarray, size: int, height: int, leaf: int) -> bytes:
    """The steps from a leaf to the block's root, 33 bytes each: what it does, and the sibling's digest."""
    out = []
    for up in range(height - 1):
        other = (leaf >> up) ^ 1
        if other >= -(-size >> up):
            out.append(ALONE + bytes(32))
        else:
            out.append((BEFORE if other < leaf >> up else AFTER) + nodes[_addresses(height, up)[other]].tobytes())
    return b"".join(out)


def steps(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    for at in range(0, len(path), 33):
        yield path[at : at + 1], path[at + 1 : at + 33]


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its proof give."""
    for what, other in steps(path):
        leaf = digest(leaf) if what == ALONE else digest(other, leaf) if what == BEFORE else digest(leaf, other)
    return leaf


def proof_hash(path: bytes) -> str:
    found = [other for what, other in steps(path) if what != ALONE]
    return digest(*found).hex()


def leaf_digest(columns: dict[str, Column]) -> Column:
    """SHA-256 of the values one after another: "-" for null, else the length in bytes, ":" and the value as text."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.unhex(F.sha2(F.concat(*[part(c) for c in columns.values()]), 256))


def tree_name(group: str) -> Column:
    """A group's value as text that is never null and sorts like it, null first."""
    return F.coalesce(F.concat(F.lit("1"), F.col(group)), F.lit("0"))


def _grouped(rows: DataFrame, *more: str) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *more)


def tier(leaves: DataFrame, block_levels: int) -> DataFrame:
    """tree, n, block, size, height, nodes, root: the blocks over leaves (tree, n: leaves in the tree, rank, digest)."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def made() -> pa.RecordBatch:
            tree, n, block = now
            # A tree of one block ends at its root, others go up whole blocks.
            height = 1 + (block_levels if n > 1 << block_levels else (n - 1).bit_length())
            nodes = built(held, height)
            row = [tree, n, block, len(held), height, nodes.tobytes(), nodes[0].tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, BLOCK_TYPES.values())], names=list(BLOCK_TYPES))

        for batch in batches:
            for tree, n, block, d in zip(*(batch.column(c).to_pylist() for c in ("tree", "n", "block", "digest"))):
                if (tree, n, block) != now:
                    if held:
                        yield made()
                    now, held = (tree, n, block), []
                held.append(d)
        if held:
            yield made()

    rows = leaves.withColumn("block", F.shiftright("rank", block_levels))
    return _grouped(rows, "rank").select("tree", "n", "block", "digest").mapInArrow(build, BLOCK_SCHEMA)


BLOCK_TYPES = {"tree": pa.string(), "n": pa.int64(), "block": pa.int64(), "size": pa.int64(), "height": pa.int64(), "nodes": pa.binary(), "root": pa.binary()}
BLOCK_SCHEMA = "tree string, n long, block long, size long, height long, nodes binary, root binary"


def tiers(leaves: DataFrame, block_levels: int = BLOCK_LEVELS) -> list[DataFrame]:
    """The written tiers of blocks over leaves (tree, n, rank, digest), from the leaves upwards."""
    out = [materialize(tier(leaves, block_levels), "merkle-tier")]
    while (most := out[-1].agg(F.max("n")).first()[0] or 0) > 1 << block_levels:
        up = out[-1].filter(F.col("n") > 1 << block_levels)
        next_n = F.ceil(F.col("n") / (1 << block_levels)).cast("long")
        out.append(materialize(tier(up.select("tree", next_n.alias("n"), F.col("block").alias("rank"), F.col("root").alias("digest")), block_levels), "merkle-tier"))
    return out


def roots(levels: list[DataFrame], block_levels: int) -> DataFrame:
    """tree, root of every tree."""
    out = None
    for blocks in levels:
        ended = blocks.filter(F.col("n") <= 1 << block_levels).select("tree", "root")
        out = ended if out is None else out.unionByName(ended)
    return out


def with_paths(rows: DataFrame, blocks: DataFrame, upper: DataFrame, block_levels: int, columns: str) -> DataFrame:
    """rows (tree, block, rank and columns) with path: their block's siblings, then those of upper (tree, block, path).

    A block comes before its rows and is the only one held; the rows stream by.
    """
    names = [c.strip().split(" ")[0] for c in columns.split(",")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out, kept = [], []
            fields = (batch.column(c).to_pylist() for c in ("rank", "size", "height", "nodes", "path"))
            for i, (rank, size, height, nodes, path) in enumerate(zip(*fields)):
                if rank is None:
                    held = np.frombuffer(nodes, dtype=np.uint8).reshape(-1, 32), size, height, path or b""
                else:
                    out.append(siblings(*held[:3], rank & ((1 << block_levels) - 1)) + held[3])
                    kept.append(i)
            if kept:
                found = batch.take(pa.array(kept))
                yield pa.RecordBatch.from_arrays([*(found.column(c) for c in names), pa.array(out, pa.binary())], names=[*names, "path"])

    heads = blocks.join(upper, ["tree", "block"], "left").select("tree", "block", "size", "height", "nodes", "path")
    both = heads.unionByName(rows, allowMissingColumns=True)
    return _grouped(both, "rank").mapInArrow(read, f"{columns}, path binary")


@dataclass
class Manifest:
    """leaves: tree, n, rank, digest and the rows' ids; levels: the blocks, tier by tier; top: the tree over the trees' roots."""

    leaves: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame
    block_levels: int

    def root(self) -> str | None:
        """The dataset's root in hexadecimal, null without rows."""
        found = roots(self.top, self.block_levels).first()
        return found["root"].hex() if found else None

    def block_paths(self, levels: list[DataFrame], ends: DataFrame) -> DataFrame:
        """tree, block, path: the proof of each block's root of the lowest tier; ends: tree, path of the trees' roots."""
        width = F.col("n") <= 1 << self.block_levels
        upper = levels[-1].filter(width).select("tree", "block").join(ends, "tree", "left")
        for above, below in zip(levels[:0:-1], levels[-2::-1]):
            rows = below.filter(~width).select("tree", F.shiftright("block", self.block_levels).alias("block"), F.col("block").alias("rank"))
            found = with_paths(rows, above, upper, self.block_levels, "tree string, rank long")
            own = below.filter(width).select("tree", "block").join(ends, "tree", "left")
            upper = materialize(found.select("tree", F.col("rank").alias("block"), "path").unionByName(own), "merkle-paths")
        return upper

    def proofs(self, columns: str) -> DataFrame:
        """The leaves' named columns ("name type, ...") and path, the siblings from the leaf up to the dataset's root."""
        def block_of(rank: str) -> Column:
            return F.shiftright(rank, self.block_levels)

        none = self.top[0].select("tree", F.lit(b"").alias("path")).distinct()
        tops = self.subroots.select(F.lit("*").alias("tree"), block_of("rank").alias("block"), "rank", F.col("tree").alias("name"))
        ends = with_paths(tops, self.top[0], self.block_paths(self.top, none), self.block_levels, "name string")
        upper = self.block_paths(self.levels, ends.toDF("tree", "path"))
        rows = self.leaves.withColumn("block", block_of("rank"))
        return with_paths(rows, self.levels[0], upper, self.block_levels, columns)


def manifest(docs: DataFrame, fields: dict[str, str] = FIELDS, group: str = "lang", order: str = "doc_id", block_levels: int = BLOCK_LEVELS,
             changed: dict[str, Column] | None = None) -> Manifest:
    """Builds and writes the manifest of a dataset.

    fields: the columns that are hashed, with their types, in this order; further columns are ignored.  In a
    tree rows ascend by order (null first), ties by digest; repeated rows are leaves of their own.  The trees
    ascend by group, null first, by bytes.  changed: columns in whose place other values come for
    a second digest of each row, ``altered``, which a proof can be tried with.
    """
    columns = {c: F.col(c) for c in fields}
    rows = input_table(docs, **{c: kind for c, kind in fields.items()}).select(
        tree_name(group).alias("tree"), F.col(order).alias("id"), leaf_digest(columns).alias("digest"),
        leaf_digest({**columns, **(changed or {})}).alias("altered"))
    numbered = materialize(ranked(materialize(rows, "leaf-digests"), ["id", "digest"], group="tree"), "leaves")
    sizes = numbered.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    leaves = numbered.join(sizes, "tree")
    levels = tiers(leaves.select("tree", "n", "rank", "digest"), block_levels)
    subroots = materialize(ranked(roots(levels, block_levels), ["tree"]), "subroots")
    count = subroots.count()
    top = tiers(subroots.select(F.lit("*").alias("tree"), F.lit(count).cast("long").alias("n"), "rank", F.col("root").alias("digest")), block_levels)
    return Manifest(leaves, levels, top, subroots, block_levels)


def verified(m: Manifest) -> DataFrame:
    """Each row's id, leaf, subroot, root, proof_sha256, folded_root (of its altered digest) and whether that is the root."""
    root = m.root()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            again = [folded(leaf, path).hex() for leaf, path in zip(batch.column("altered").to_pylist(), paths)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("tree"), pa.array([d.hex() for d in batch.column("digest").to_pylist()]),
                 pa.array([proof_hash(p) for p in paths], pa.string()), pa.array(again, pa.string()), pa.array([r == root for r in again], pa.bool_())],
                names=["id", "tree", "leaf", "proof_sha256", "folded_root", "verified"])

    found = m.proofs("id long, tree string, digest binary, altered binary").mapInArrow(
        check, "id long, tree string, leaf string, proof_sha256 string, folded_root string, verified boolean")
    named = m.subroots.select("tree", F.lower(F.hex("root")).alias("subroot"))
    return found.join(named, "tree").withColumn("root", F.lit(root).cast("string"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, and what root comes of it where 7 divides the CRC-32 of its id and n_chars is one more.

    Nulls are hashed as "-"; null doc_ids come first; repeated rows are leaves of their own; an empty table
    gives no rows.
    """
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = verified(manifest(table(spark, sf_dir, "documents"), changed={"n_chars": tampered}))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _sql_leaf(n_chars: str) -> str:
    def part(c: str) -> str:
        text = f"CAST({c} AS VARCHAR)"
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({text})) || ':' || {text} END"

    return "sha256(" + " || ".join(part(n_chars if c == "n_chars" else c) for c in FIELDS) + ")"


OP12_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, d AS (
  SELECT doc_id, lang, {_sql_leaf("n_chars")} AS leaf,
    {_sql_leaf("(n_chars + CASE WHEN x % 7 = 0 THEN 1 ELSE 0 END)")} AS altered
  FROM (SELECT *, coalesce({crc32_of("encode(CAST(doc_id AS VARCHAR))")}, 1) AS x FROM documents, crc_table)
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n FROM d
), nodes AS (
  SELECT lang, 0 AS up, r, leaf AS h, n FROM leaves
  UNION ALL
  SELECT lang, up + 1, r // 2, sha256(string_agg(h, '' ORDER BY r)), max((n + 1) // 2) FROM nodes WHERE n > 1 GROUP BY lang, up, r // 2
), subroots AS (
  SELECT lang, up AS height, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS trees FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS up, place AS r, h, trees AS n FROM subroots
  UNION ALL
  SELECT up + 1, r // 2, sha256(string_agg(h, '' ORDER BY r)), max((n + 1) // 2) FROM tops WHERE n > 1 GROUP BY up, r // 2
), top AS (
  SELECT up AS height, h FROM tops WHERE n = 1
), asked AS (
  SELECT l.*, s.height, s.place, s.h AS subroot, top.height AS top_height, top.h AS root, row_number() OVER () AS row
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang, top
), steps AS (
  SELECT row, lang, up, r >> up AS at, true AS own FROM (SELECT *, unnest(range(height)) AS up FROM asked)
  UNION ALL
  SELECT row, lang, height + up, place >> up, false FROM (SELECT *, unnest(range(top_height)) AS up FROM asked)
), found AS (
  SELECT t.row, t.up, CASE WHEN n.r < t.at THEN 'L' ELSE 'R' END AS side, n.h
  FROM steps t JOIN nodes n ON t.own AND n.lang IS NOT DISTINCT FROM t.lang AND n.up = t.up AND n.r = xor(t.at, 1)
  UNION ALL
  SELECT t.row, t.up, CASE WHEN n.r < t.at THEN 'L' ELSE 'R' END, n.h
  FROM steps t JOIN asked a USING (row) JOIN tops n ON NOT t.own AND n.up = t.up - a.height AND n.r = xor(t.at, 1)
), proofs AS (
  SELECT row, list(coalesce(f.side || f.h, '-') ORDER BY t.up) AS path, string_agg(f.h, '' ORDER BY t.up) AS others
  FROM steps t LEFT JOIN found f USING (row, up) GROUP BY row
), again AS (
  SELECT a.*, coalesce(others, '') AS others, list_reduce(list_concat([altered], coalesce(path, [])), lambda h, s:
    CASE s[1] WHEN 'L' THEN sha256(s[2:] || h) WHEN 'R' THEN sha256(h || s[2:]) ELSE sha256(h) END) AS folded_root
  FROM asked a LEFT JOIN proofs USING (row)
)
SELECT doc_id, leaf, subroot, root, sha256(others) AS proof_sha256, folded_root, folded_root = root AS verified FROM again
"""
