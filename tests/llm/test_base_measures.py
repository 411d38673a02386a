import random
import re

import pyarrow as pa

from tests.llm.helpers import ODD, documents, docs, prose
from touchline.llm.perplexity import base_measures, op4_perplexity_rules, quality_rules

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SF = "/root/testdata/sf0.001"


def plain(text):
    """The base measures of one text, word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    repeated = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


def failed(n_words, n_repeat_words):
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def check(texts):
    got = base_measures(pa.array(texts, pa.string()))
    assert list(zip(*(got[n].tolist() for n in NAMES))) == [plain(t) for t in texts]


def test_made_texts():
    r = random.Random(5)
    pieces = ["a", "b", "ab", "é", "漢", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "　", "\r\n", "#", "$%", "<b>", "a b c ", "\x00"]
    check(["".join(r.choice(pieces) for _ in range(r.randrange(60))) for _ in range(3000)])
    check([t for _, t, *_ in ODD])
    # Windows must not reach over the border of two texts, nor repeats count across them.
    check(["a b", "c a b c", "a b c", "a b c a b c", "", None, "a b c"])
    check([])
    check([None])
    check(["x y z\n" * 20_000 + prose(1, 500)])


def test_the_query_on_its_whole_table(spark):
    rows = {d[0]: d for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == len(documents())
    got = op4_perplexity_rules(spark, SF).collect()
    assert len(got) == len(rows)
    for g in got:
        want = plain(rows[g.doc_id].text)
        assert tuple(g[n] for n in NAMES) == want
        assert g.base_failed == failed(want[0], want[4])
        assert not (g.base_failed and g.kept)
    assert any(g.n_dup_lines for g in got) or any(g.n_repeat_words for g in got)


def test_edges_of_the_rules(spark):
    words = [f"w{i}" for i in range(200)]
    half = " ".join(words[:25] + words[:25] + words[50:100])  # 50 of 100 words are repeated: not too many
    texts = [" ".join(words[:49]), " ".join(words[:50]), half, half + " w0 w1 w2"]
    got = {r.doc_id: r for r in quality_rules(docs(spark, list(enumerate(texts)))).collect()}
    assert [got[i].base_failed for i in range(4)] == [failed(*(plain(t)[k] for k in (0, 4))) for t in texts] == [True, False, False, True]
