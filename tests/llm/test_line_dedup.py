import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import ODD, docs, prose
from tests.llm.test_simhash import groups
from touchline.llm.line_dedup import Keys, _padded, drop_repeated_lines, repeated_lines, within_edits, without_repeated_lines


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab😀", min_size=0, max_size=12), min_size=2, max_size=8), st.integers(1, 4))
def test_banded_distance(lines, most):
    coded = [np.frombuffer(x.encode("utf-32-le"), "<i4") for x in lines]
    size = np.array([len(x) for x in lines])
    u, v = (np.array(x) for x in zip(*[(i, j) for i in range(len(lines)) for j in range(len(lines))]))
    got = within_edits(*_padded(coded, u, size), *_padded(coded, v, size), most)
    assert got.tolist() == [edits(lines[i], lines[j]) <= most for i, j in zip(u, v)]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=6, max_size=30), st.integers(1, 3), st.data())
def test_lines_within_the_edits_share_a_key(line, most, data):
    other = list(line)
    for _ in range(data.draw(st.integers(0, most))):
        kind, at = data.draw(st.sampled_from("ird")), data.draw(st.integers(0, max(0, len(other) - 1)))
        if kind == "i":
            other.insert(at, data.draw(st.sampled_from("abc")))
        elif kind == "d" and len(other) > 1:
            del other[at]
        elif other:
            other[at] = data.draw(st.sampled_from("abc"))
    keys = Keys(most)
    a, n = keys(line)
    b, m = keys("".join(other))
    assert line == "".join(other) or set(a[:n]) & set(b) or set(b[:m]) & set(a)


def case():
    r = random.Random(2)
    lines = [prose(i, 9)[: r.randint(30, 60)] for i in range(25)]
    lines += ["the page header of this site number %04d follows" % i for i in range(40)]
    near = []
    for line in lines:
        x = list(line)
        for _ in range(r.randint(0, 3)):
            x[r.randrange(len(x))] = r.choice("xyz")
        near.append("".join(x))
    pool = lines + near + ["short line", ""]
    return [(i, "\n".join(r.choice(pool) for _ in range(r.randint(1, 8)))) for i in range(60)] + ODD


def brute(rows):
    places = sorted({((d is not None, d or 0, k), line) for d, t in rows if t is not None for k, line in enumerate(t.split("\n")) if len(line) >= 30})
    different = sorted({line for _, line in places})
    root = dict(zip(different, groups(different, lambda a, b: abs(len(a) - len(b)) <= 2 and edits(a, b) <= 2)))
    first, gone = {}, set()
    for place, line in places:
        if first.setdefault(root[line], place) != place:
            gone.add(place)
    return gone


def test_repeated_lines_by_brute_force(spark):
    # Repeated doc_ids are told apart by their text, which this plain version doesn't.
    rows = [x for x in case() if x[0] not in (1, 6) or len(x[1] or "") < 400]
    got = {(r.doc_id is not None, r.doc_id or 0, r.line_no) for r in repeated_lines(docs(spark, rows)).collect()}
    ids = [d for d, _ in rows]
    once = {(d is not None, d or 0) for d in ids if ids.count(d) == 1}
    assert {x for x in got if x[:2] in once} == {x for x in brute(rows) if x[:2] in once}


def test_texts_and_columns(spark):
    line, near = "a line that many documents have at their end", "a line that many documents hove at their end."
    rows = [(1, f"first own text\n{line}"), (2, f"second\n\n{near}\nrest"), (3, line), (4, "short\nshort"), (5, None), (6, ""), (7, f"{line}\n{line}")]
    df = docs(spark, rows)
    out = drop_repeated_lines(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: rows[0][1], 2: "second\n\nrest", 4: "short\nshort", 5: None, 6: ""}
    counts = {r.whole.doc_id: r.n_removed for r in without_repeated_lines(df).collect()}
    assert counts == {1: 0, 2: 1, 3: 1, 4: 0, 5: 0, 6: 0, 7: 2}
    assert drop_repeated_lines(docs(spark, [])).collect() == []


def test_cut_cells_find_the_same(spark):
    from touchline.llm.components import components
    from touchline.llm.line_dedup import line_links

    df = docs(spark, case()).select("text")
    whole, cut = ({r.node: r.root for r in components(line_links(df, cell_rows=n)).collect()} for n in (1024, 3))
    assert whole and whole == cut
