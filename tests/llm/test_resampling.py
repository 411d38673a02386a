import hashlib
import math
import random
import re
import zlib

import pytest

from tests.llm.helpers import ODD, docs, documents, prose
from touchline.llm import resampling
from touchline.llm.ranks import ranked
from touchline.llm.resampling import features, resample


def plain_features(text, longest):
    words = re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").encode().lower())
    return words, [b" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, percent, longest, buckets, least_words):
    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for f in plain_features(t, longest)[1]:
                out[zlib.crc32(f) % buckets] += 1
        return out

    s, t = counts([x for _, x in rows]), counts(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for d, text in rows:
        words, found = plain_features(text, longest)
        weight = sum(gain[zlib.crc32(f) % buckets] for f in found)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((d, len(words), len(found), weight, score))
    enough = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[1:]))
    drawn = percent * len(enough) // 100
    ranks = [r + (i + 1 if i < drawn else None,) for i, r in enumerate(enough)]
    return sorted(ranks + [r + (None,) for r in out if r[1] < least_words], key=str)


ROWS = ODD + [(100 + i, prose(i, 5 + 7 * i % 60, 30)) for i in range(60)] + [(100, prose(0, 30)), (100, prose(0, 30)), (None, prose(3, 50, 30))]
TARGET = [(1, prose(900, 300, 10)), (2, None), (3, ""), (4, "ÄÖ 漢字 word")]


@pytest.mark.parametrize("longest,words_at_once", [(1, 1 << 18), (3, 1 << 18), (3, 7)])
def test_features_do_not_cross_documents(monkeypatch, longest, words_at_once):
    monkeypatch.setattr(resampling, "WORDS_AT_ONCE", words_at_once)
    texts = [(t or "").encode() for _, t in ROWS[:40]]
    found = [[] for _ in texts]
    for _, doc, bucket in features(texts, longest, 997):
        for d, b in zip(doc.tolist(), bucket.tolist()):
            found[d].append(b)
    for (_, t), b in zip(ROWS, found):
        assert sorted(b) == sorted(zlib.crc32(f) % 997 for f in plain_features(t, longest)[1])


@pytest.mark.parametrize("longest,percent", [(1, 10), (2, 35)])
def test_against_brute_force(spark, longest, percent):
    rows = ROWS[:]
    random.Random(1).shuffle(rows)
    found = resample(docs(spark, rows), docs(spark, TARGET), percent, longest, 500)
    got = sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()), key=str)
    assert got == brute(rows, [t for _, t in TARGET], percent, longest, 500, 20)


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(map(tuple, resampling.op11_importance_resampling(spark, sf).collect()), key=str)
    want = brute([(d[0], d[1]) for d in documents()], [b[1] for b in documents("benchmark")], 10, 1, 10_000, 20)
    assert got == sorted(((r[0], *r[2:]) for r in want), key=str)


def test_nothing(spark):
    assert resample(docs(spark, []), docs(spark, TARGET)).collect() == []
    found = resample(docs(spark, ROWS[:3]), docs(spark, [])).collect()
    assert len(found) == 3 and all(r["rank"] is None for r in found)


def test_ranks_of_hot_values_and_repeats(spark, monkeypatch):
    import touchline.llm.ranks as ranks

    monkeypatch.setattr(ranks, "REPEAT_BLOCK", 4)
    r = random.Random(4)
    rows = [(g, r.choice([None, 1, 1, 1, 2, 3]), r.choice("ab")) for g in ("x", "x", "x", "y") for _ in range(50)] + [("z", 5, "a")] * 30
    df = spark.createDataFrame(rows, "g string, k long, v string").repartition(5)
    got = sorted(map(tuple, ranked(df, ["k"], "g").collect()), key=str)
    want = []
    for g in "xyz":
        own = sorted((x for x in rows if x[0] == g), key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
        want += [(*x, i) for i, x in enumerate(own)]
    assert got == sorted(want, key=str)
    down = ranked(df.select("k"), ["-k"]).orderBy("rank").collect()
    ks = [x.k for x in down]
    assert ks == sorted((x[1] for x in rows), key=lambda k: (k is None, -(k or 0)))
