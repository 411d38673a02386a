import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import ODD, docs, documents, prose
from touchline.llm.minhash import bands, linked_in_cell, near_duplicates, op13_minmax_neardup, permutation_keys, shingle_sets, signatures


def plain_set(text, k=2):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def linked(a, b):
    n = len(a & b)
    return bool(a and b) and 100 * n >= 80 * (len(a) + len(b) - n)


def brute(rows, k=2):
    """(doc_id, n_shingles, component_id, kept) of all rows, null doc_ids last."""
    sets = [plain_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None] if sets[i] else [d]
        least = min((x for x in ids if x is not None), default=None)
        out.append((d, len(sets[i]), least, d is not None and d == least))
    return sorted(out, key=str)


def changed(text, seed, share):
    r = random.Random(seed)
    return " ".join(f"new{r.randrange(10**6)}" if r.random() < share else w for w in text.split())


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def copies():
    rows, n = [], 100
    for base in range(12):
        text = prose(base, 150)
        for i in range(14):
            rows.append((n := n + 1, changed(text, n, [0.0, 0.01, 0.03, 0.05, 0.08][i % 5])))
    # A chain: neighbours are alike, ends aren't.
    words = prose(77, 260).split()
    rows += [(1000 - i, " ".join(words[12 * i : 12 * i + 160])) for i in range(9)]
    # Shared parts, but not enough.
    rows += [(2000 + i, " ".join(words[:100]) + " " + prose(500 + i, 60)) for i in range(6)]
    return rows


def test_shingle_sets():
    texts = [t for _, t in ODD] + ["A b a B a b", "One", prose(1, 300)]
    for k in (1, 2, 5):
        hashes, sizes = shingle_sets(pa.array(texts), k)
        assert sizes.tolist() == [len(plain_set(t, k)) for t in texts]
        cut = np.split(hashes, np.cumsum(sizes)[:-1])
        assert all((np.diff(x.astype(object)) > 0).all() for x in cut)
        seen = {}
        for t, x in zip(texts, cut):
            assert seen.setdefault(frozenset(plain_set(t, k)), frozenset(x.tolist())) == frozenset(x.tolist())
        assert len(set(seen.values())) == len(seen)
    # A slice of a longer array.
    whole, part = pa.array(["ÄÄ x y", "A B c", "d E f"]), pa.array(["A B c", "d E f"])
    assert shingle_sets(whole[1:])[0].tolist() == shingle_sets(part)[0].tolist()


def test_minima_and_maxima_agree_as_often_as_sets_do():
    r = random.Random(5)
    keys = permutation_keys(400)
    for share in (0.3, 0.6, 0.9):
        both = [r.getrandbits(64) for _ in range(int(1000 * share))]
        a, b = (np.unique(np.array(both + [r.getrandbits(64) for _ in range(int(1000 * (1 - share) / 2))], dtype=np.uint64)) for _ in "ab")
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        least, most = signatures(np.concatenate([a, b]), np.array([len(a), 0, len(b)]), keys)
        assert least.shape == most.shape == (400, 2)
        assert abs(np.concatenate([least[:, 0] == least[:, 1], most[:, 0] == most[:, 1]]).mean() - true) < 0.07


def test_bands_hold_minima_and_maxima():
    least = np.arange(20, dtype=np.uint64).reshape(10, 2)
    most = least + np.uint64(100)
    found = bands(least, most, 5)
    assert found.shape == (2, 4) and len(np.unique(found)) == 8
    most[9, 0] += np.uint64(1)
    assert (bands(least, most, 5) != found).tolist() == [[False, False, False, True], [False] * 4]


def test_links_of_a_cell_connect_what_is_alike():
    sets = [np.unique(np.array(x, dtype=np.uint64)) for x in (range(100), range(10, 105), range(50, 100), range(90), range(300, 400))]
    assert linked_in_cell([0] * 5, [0, 1, 2, 3, 4], sets, 80) == [(0, 1), (0, 3)]
    assert linked_in_cell([0] * 5, [0, 1, 2, 0, 4], sets, 80) == [(0, 1)]
    assert linked_in_cell([1, 2, 2, 2, 2], [0, 0, 2, 3, 4], sets, 80) == [(0, 3)]


@pytest.mark.parametrize("cell_rows", [256, 3])
def test_against_brute_force(spark, cell_rows):
    rows = ODD + copies()
    random.Random(9).shuffle(rows)
    assert got(near_duplicates(docs(spark, rows), cell_rows=cell_rows)) == brute(rows)


def test_longer_shingles_and_nothing(spark):
    rows = ODD + copies()[::3]
    assert got(near_duplicates(docs(spark, rows), shingle_words=5)) == brute(rows, 5)
    assert near_duplicates(docs(spark, [])).collect() == []
    assert got(near_duplicates(docs(spark, [(None, None), (1, "")]))) == [(1, 0, 1, True), (None, 0, None, False)]


def test_given_documents(spark):
    want = brute([(d[0], d[1]) for d in documents()])
    assert got(op13_minmax_neardup(spark, "/root/testdata/sf0.001")) == want
