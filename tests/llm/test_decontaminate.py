import re

import pytest

from tests.llm.helpers import ODD, docs, prose
from touchline.llm.decontaminate import decontaminate, hits


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def brute(rows, items):
    out = []
    for d, text in rows:
        w, places, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            k = min(10, len(v))
            windows = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if v else set()
            for i in range(len(w) - k + 1):
                if v and tuple(w[i : i + k]) in windows:
                    places |= set(range(i + 1, i + k + 1))
                    found.add(str(item))
        out.append((str(d), len(w), sorted(places), sorted(found)))
    return sorted(out)


P = prose(1, 40)
ITEMS = [(1, P), (2, "Short item, three-part!"), (2, "short ITEM three part"), (3, None), (4, "..."), (None, "null id words"), (5, P), (10, "Äpfel é 漢字")]
ROWS = [
    (100, f"{prose(2, 30)}. {P.upper()}! {prose(3, 30)}"), (101, " ".join(P.split()[:9])), (102, " ".join(P.split()[5:15])),
    (103, "a short item three part of it; short, item three -- part"), (104, "null id words"), (105, prose(4, 3000)),
    (106, "äpfel É 漢字 Äpfel é 漢字"), *ODD, (107, P), (107, P),
]


@pytest.mark.parametrize("most", [200_000, 1])
def test_hits_by_brute_force_on_both_ways(spark, most):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = hits(docs(spark, ROWS), benchmark, most_windows=most).collect()
    items = [(i, t) for i, t in ITEMS if i is not None]
    want = brute(ROWS, items)
    got = sorted((str(r.doc_id), r.n_words, list(r.hit_words), [x for x in r.item_ids]) for r in got)
    # An item without an id marks words but has no id to list.
    null = brute(ROWS, [("null", "null id words")])
    want = [(d, n, sorted({*p, *q}), f) for (d, n, p, f), (_, _, q, _) in zip(want, null)]
    assert got == want


def test_documents_and_spans_are_removed(spark):
    benchmark = spark.createDataFrame([(1, P)], "item_id long, text string")
    df = docs(spark, ROWS)
    left = decontaminate(df, benchmark).collect()
    dirty = {d for d, _, p, _ in brute(ROWS, [(1, P)]) if p}
    assert sorted(str(r.doc_id) for r in left) == sorted(str(d) for d, _ in ROWS if str(d) not in dirty)
    assert decontaminate(df, benchmark).columns == df.columns
    cut = decontaminate(df, benchmark, remove="spans")
    assert cut.columns == df.columns
    rest = {(r.doc_id, r.text) for r in cut.collect()}
    assert (100, f"{prose(2, 30)}. {prose(3, 30)}") in rest and (107, "") in rest
    assert all((d, t) in rest for d, t in ROWS if str(d) not in dirty)
    with pytest.raises(ValueError):
        decontaminate(df, benchmark, remove="other")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert hits(docs(spark, []), spark.createDataFrame(ITEMS, "item_id long, text string")).collect() == []
    got = hits(docs(spark, ROWS), none).collect()
    assert len(got) == len(ROWS) and all(r.hit_words == [] and r.item_ids == [] for r in got)
    assert decontaminate(docs(spark, ROWS), none).count() == len(ROWS)
