import random
import re

import numpy as np
import xxhash

from tests.llm.helpers import ODD, docs, prose
from touchline.llm.components import components
from touchline.llm.simhash import fingerprints, keep_one, links, linked_in_cells, near_duplicates, pivots, with_fingerprints


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(values, linked):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprints():
    texts = [t for _, t in ODD] + ["A b", "a B c d", "A b c d E", prose(1, 500)]
    assert fingerprints(texts).tolist() == [plain_fingerprint(t) for t in texts]


def near_copies(seed, n):
    r = random.Random(seed)
    out = []
    for _ in range(n // 4):
        base = r.getrandbits(64)
        out.append(base)
        for _ in range(3):
            x = base if r.random() < 0.7 else out[-1]
            for b in r.sample(range(64), r.randint(0, 6)):
                x ^= 1 << b
            out.append(x)
    return list(dict.fromkeys(out))


def test_all_links_are_found_also_in_cut_cells(spark):
    fps = near_copies(3, 300)
    signed = [(int(np.uint64(x).view(np.int64)),) for x in fps]
    want = groups(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    df = spark.createDataFrame(signed, "fp long")
    for cell_rows in (4096, 2):
        found = {r.node: r.root for r in components(links(df, cell_rows=cell_rows)).collect()}
        got = {}
        for i, (x,) in enumerate(signed):
            got.setdefault(found.get(x, x), []).append(i)
        expected = {}
        for i, g in enumerate(want):
            expected.setdefault(g, []).append(i)
        assert sorted(got.values()) == sorted(expected.values())


def test_pivot_table_discards_no_link():
    fps = np.array(near_copies(7, 400), dtype=np.uint64)
    zero = np.zeros(len(fps), dtype=np.int64)
    u, v = linked_in_cells(zero, zero.astype(np.int8), fps, pivots(), 4)
    assert (np.bitwise_count(fps[u] ^ fps[v]) <= 64).all()
    got = list(range(len(fps)))
    for a, b in sorted(zip(v.tolist(), u.tolist())):
        got[b] = a
    find = lambda i: i if got[i] == i else find(got[i])
    assert len({find(i) for i in range(len(fps))}) == len(set(groups(fps.tolist(), lambda a, b: (a ^ b).bit_count() <= 4)))


def test_components_of_chains_and_stars(spark):
    pairs = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("x", f"y{i}") for i in range(50)] + [("a", "a"), ("b", "c"), ("c", "b")]
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u string, v string")).collect()}
    assert {found[f"n{i:03d}"] for i in range(61)} == {"n000"}
    assert {found[k] for k in found if k[0] in "xy"} == {"x"}
    assert found["c"] == found["b"] == "b" and "a" not in found
    assert components(spark.createDataFrame([], "u string, v string")).collect() == []


def test_groups_of_documents(spark):
    base = prose(11, 900)
    rows = [(10, base), (11, base), (12, base.replace(base.split()[5], "changed", 1)), (13, prose(12, 900)), *ODD]
    got = near_duplicates(docs(spark, rows)).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    root = groups(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (d, _), g in zip(rows, root):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    want = sorted((str(d), f, str(least.get(g))) for (d, _), f, g in zip(rows, fps, root))
    assert sorted((str(r.doc_id), int(np.int64(r.fp).view(np.uint64)), str(r.component_id)) for r in got) == want


def test_one_of_each_group_stays_with_all_columns(spark):
    base = prose(11, 900)
    df = docs(spark, [(10, base), (11, base), (11, base), (13, prose(12, 900)), (13, prose(14, 900)), *ODD])
    kept = keep_one(df).collect()
    assert keep_one(df).columns == df.columns
    n_groups = near_duplicates(df).select("root").distinct().count()
    assert len(kept) == n_groups
    assert [r.doc_id for r in kept if r.text == base] == [10]
    assert sum(r.doc_id == 13 for r in kept) == 2
    assert keep_one(docs(spark, [])).collect() == []
    assert with_fingerprints(docs(spark, [])).collect() == []
