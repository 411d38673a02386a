from collections import Counter

import corpus_pipeline as p

from tests.llm.helpers import ODD, docs, prose
from touchline.llm.common import materialize
from touchline.llm.simhash import fingerprints

SF = "/root/testdata/sf0.01"


def test_each_stage_on_what_its_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    assert [n for n, _ in p.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    kept = {}
    for name, stage in p.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), "t")
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        counts.append(len(kept[name]))
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.6 * counts[0]
    fps = fingerprints(list(kept["simhash_near_dedup"].values()))
    assert len(set(fps.tolist())) == len(fps)
    rows = p.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in rows} == set(kept["benchmark_decontamination"])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept["quality_classifier"] for d in good) > 0.99 * len(good)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in p.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_odd_rows_and_clashing_columns_through_the_chain(spark):
    given = [(r.doc_id + 1000, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    long_text = "\n".join(prose(i, 60) for i in range(2000))
    odd = [*ODD, (9, long_text), (None, prose(7, 300)), (None, prose(7, 300)), (10, prose(8, 300)), (10, prose(8, 300)), (10, prose(9, 300))]
    rows = docs(spark, [*given, *odd])
    columns, before = rows.columns, Counter((r.doc_id, r.text) for r in rows.collect())
    texts = {}
    for name, stage in p.STAGES[:-1]:
        rows = materialize(stage(spark, rows, SF), "t")
        assert rows.columns == columns
        after = Counter((r.doc_id, r.text) for r in rows.collect())
        if name == "line_dedup":  # texts may lose lines; no document comes in or comes more often
            ids, had = Counter(), Counter()
            for (i, _), n in after.items():
                ids[i] += n
            for (i, _), n in before.items():
                had[i] += n
            assert ids <= had
        else:
            assert after <= before
        texts[name] = before = after
    assert all(t for _, t in texts["quality_classifier"])
    assert max(texts["simhash_near_dedup"].values()) == 1
    pieces = p.STAGES[-1][1](spark, rows, SF).collect()
    assert Counter(r.doc_id for r in pieces if r.piece == 0) == Counter(i for i, _ in before)
    filled = Counter()
    for r in pieces:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048
