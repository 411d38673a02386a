import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import ODD, docs
from touchline.llm.packing import op1_best_fit_packing, pack, pack_lengths
from touchline.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def best_fit(counts, capacity):
    rooms = []
    for w in sorted(Counter(counts).elements(), reverse=True):
        fits = [r for r in rooms if r >= w]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - w)
        else:
            rooms.append(capacity - w)
    return len(rooms)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_patterns_hold_all_pieces_and_no_more_sequences_than_best_fit(counts):
    patterns, about = pack_lengths(counts, 40)
    held = Counter()
    for n, pattern in patterns:
        assert sum(w * k for w, k in pattern) <= 40
        for w, k in pattern:
            held[w] += n * k
    assert held == Counter(counts)
    assert about["sequences"] == sum(n for n, _ in patterns) <= best_fit(counts, 40)


def smallest_number(items, capacity):
    """Fewest sequences, by trying all ways."""
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in sorted({x for x in rooms if x >= items[i]}):
            rest = list(rooms)
            rest.remove(r)
            go(i + 1, [*rest, r - items[i]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def test_reduction_keeps_the_optimum_within_reach():
    r = random.Random(5)
    for _ in range(120):
        items = sorted((r.randint(1, 20) for _ in range(9)), reverse=True)
        patterns, about = pack_lengths(dict(Counter(items)), 20)
        assert about["sequences"] <= smallest_number(items, 20) + 1
    # A set that best-fit alone packs worse: 10 + 10 fill a sequence as 7 + 7 + 6 do.
    assert pack_lengths({10: 2, 7: 2, 6: 1}, 20)[1]["sequences"] == 2


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text("aZ.,' \né<|>endoftext", max_size=40), max_size=8))
def test_word_cache_gives_the_ids_of_the_whole_text(texts):
    import pyarrow as pa

    encoder = WordEncoder.of(PATH)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    want = [Tokenizer_.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


Tokenizer_ = Tokenizer.from_file(PATH)


def test_full_cache_keeps_results():
    import pyarrow as pa

    small = WordEncoder(PATH, most_words=5)
    texts = ["One two, three.", "four five six seven eight.", "One nine ten, four"]
    for _ in range(3):
        ids, _ = small.encode(pa.array(texts))
        assert ids.tolist() == [i for t in texts for i in Tokenizer_.encode(t, add_special_tokens=False).ids]


def test_known_words_are_not_encoded_again_in_other_forms():
    import pyarrow as pa

    encoder, asked = WordEncoder(PATH, most_words=100), []
    own = encoder.tokenizer

    class Counting:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return own.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counting()
    words = [f"{a}{b}{c}" for a in "bcdf" for b in "aeiou" for c in "kln"]
    encoder.encode(pa.array([" ".join(f"{w} {w.title()} {w}," for w in words)]))
    assert asked
    asked.clear()
    text = " ".join(f"{w}. {w.upper()} {w.title()}," for w in words)
    assert encoder.encode(pa.array([text]))[0].tolist() == Tokenizer_.encode(text, add_special_tokens=False).ids
    assert asked == []


def check_rows(rows, texts, capacity):
    by_place = {}
    for r in rows:
        by_place.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_place.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = Counter()
    for doc_id, text in texts:
        ids = np.array([*Tokenizer_.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            want[doc_id, k, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert got == want


def test_odd_rows(spark):
    check_rows(pack(docs(spark, ODD), capacity=64).collect(), ODD, 64)
    assert pack(docs(spark, [])).collect() == []


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_query_packs_whole_table(spark, sf_dir):
    rows = op1_best_fit_packing(spark, sf_dir).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check_rows(rows, texts, 2048)


def test_ids_on_request(spark):
    rows = pack(docs(spark, [(1, "one two three")]), with_ids=True).collect()
    assert np.frombuffer(bytes(rows[0].ids), "<u4").tolist() == [*Tokenizer_.encode("one two three", add_special_tokens=False).ids, 0]
