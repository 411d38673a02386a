import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents
from touchline.llm.merkle import address, built, digest, folded, manifest, op12_merkle_manifest, siblings, verified

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def proof(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((i % 2, level[i ^ 1]) if i ^ 1 < len(level) else None)
        i //= 2
    return out


def brute(rows):
    """rows: the five fields, in any order."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built_trees = {}
    for name in names:
        own = sorted(trees[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built_trees[name] = own, levels_of([leaf(r) for r in own])
    top = levels_of([built_trees[n][1][-1][0] for n in names])
    root, out = top[-1][0], []
    for k, name in enumerate(names):
        own, levels = built_trees[name]
        for i, r in enumerate(own):
            path = proof(levels, i) + proof(top, k)
            other = r
            if r[0] is not None and crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                other = (*r[:3], r[3] + 1, r[4])
            d = leaf(other)
            for step in path:
                d = h(d) if step is None else h(step[1], d) if step[0] else h(d, step[1])
            out.append((r[0], leaf(r), levels[-1][0], root, h(*(s[1] for s in path if s)), d, d == root))
    return sorted(out, key=str)


def got(df):
    cols = ("id" if "id" in df.columns else "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


@pytest.mark.parametrize("height", range(1, 9))
def test_addresses_are_a_van_emde_boas_order(height):
    def order(root, levels):
        # The nodes (depth, index) of a subtree, laid out by the rule itself.
        if levels == 1:
            return [root]
        top = levels // 2
        out = order(root, top)
        d, i = root
        for k in range(1 << top):
            out += order((d + top, (i << top) + k), levels - top)
        return out

    want = {node: place for place, node in enumerate(order((0, 0), height))}
    assert len(want) == (1 << height) - 1
    for depth in range(height):
        assert address(height, depth, np.arange(1 << depth)).tolist() == [want[depth, i] for i in range(1 << depth)]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 13])
def test_block_and_its_proofs(size):
    leaves = [digest(bytes([i])) for i in range(size)]
    for height in {1 + (size - 1).bit_length(), 6}:
        nodes = built(leaves, height)
        assert {folded(d, siblings(nodes, size, height, i)) for i, d in enumerate(leaves)} == {nodes[0].tobytes()}


ROWS = [
    (1, "s", "en", 5, "hello"), (1, "s", "en", 5, "hello"), (1, "s", "en", 6, "hello!"), (None, None, None, None, None), (2, None, None, 0, ""),
    (3, "ü", "", None, "ÄÖ 漢字 \U0001f600"), (7, "x", "zz", 10, "word " * 50_000), (None, "a", "en", 1, "a\x00b"), (-4, "s", "de", -1, " \n"),
] + [(i, "hot", "fr", i % 9, f"text {i}") for i in range(100, 180)]


def tampered():
    return {"n_chars": F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


def frame(spark, rows):
    wide = [(*r, i, "tree", b"x") for i, r in enumerate(rows)]
    return spark.createDataFrame(wide, "doc_id long, source string, lang string, n_chars long, text string, rank int, tree string, path binary")


@pytest.mark.parametrize("block_levels", [11, 3, 1])
def test_against_brute_force(spark, block_levels):
    rows = ROWS[:]
    random.Random(2).shuffle(rows)
    m = manifest(frame(spark, rows).repartition(5), block_levels=block_levels, changed=tampered())
    want = brute(rows)
    assert got(verified(m)) == want
    assert m.root() == want[0][3]
    assert any(w[6] for w in want) and not all(w[6] for w in want)


def test_one_row_and_none(spark):
    one = manifest(frame(spark, ROWS[:1]), changed=tampered())
    assert got(verified(one)) == brute(ROWS[:1]) and one.root() == leaf(ROWS[0])
    none = manifest(frame(spark, []))
    assert none.root() is None and verified(none).collect() == []


def test_any_change_shows(spark):
    for column, value in (("text", F.concat("text", F.lit("."))), ("source", F.lit(None).cast("string")), ("lang", F.lit("q"))):
        found = verified(manifest(frame(spark, ROWS[9:30]), changed={column: value})).collect()
        assert len(found) == 21 and not any(r.verified for r in found)


def test_given_documents(spark):
    rows = [(d[0], d[3], d[2], d[4], d[1]) for d in documents()]
    assert got(op12_merkle_manifest(spark, "/root/testdata/sf0.001")) == brute(rows)
