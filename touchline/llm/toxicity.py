"""Toxicity scores by a counterfactually regularised linear classifier.

Training documents have a second version in which the names of groups of people are exchanged
for others of their kind (or, where there are none, one is put in).  The squared difference of
the two versions' scores is added to the loss, so that naming a group neither raises nor
lowers a score and neutral mentions are not taken for insults.

Words are features if the training sample shows them with one label much more often than with the
other; the names of groups always are.  The sample has about ``SAMPLE`` labelled documents
at most, and a model at most ``FEATURES`` words, whatever the size of the tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import input_table, materialize, slices, table
from touchline.llm.linear import fit, sigmoid
from touchline.llm.perplexity import _words

SAMPLE = 20_000
FEATURES = 5_000
LEAST_DOCS = 5
LEAST_Z = 5.0
TWIN_PENALTY = 5.0
THRESHOLD = 0.5
FOLDS = 5
# Names of groups of people; words in one line may stand for one another.
IDENTITY_TERMS = [
    "women men girls boys transgender nonbinary",
    "woman man girl boy",
    "black white asian latino hispanic african american european arab indian",
    "muslim christian jewish hindu buddhist catholic protestant atheist",
    "muslims christians jews hindus buddhists catholics protestants atheists",
    "gay lesbian bisexual queer straight heterosexual homosexual",
    "immigrants refugees foreigners migrants citizens",
    "disabled blind deaf autistic",
    "elderly old young",
    "frauen männer mädchen jungen",
    "muslime christen juden hindus buddhisten",
    "schwarze weiße asiaten araber",
    "schwule lesben transsexuelle",
    "ausländer flüchtlinge einwanderer migranten",
    "femmes hommes filles garçons",
    "musulmans chrétiens juifs hindous bouddhistes",
    "noirs blancs asiatiques arabes",
    "homosexuels lesbiennes",
    "immigrés réfugiés étrangers",
    "mujeres hombres niñas niños",
    "musulmanes cristianos judíos hindúes budistas",
    "negros blancos asiáticos árabes",
    "homosexuales lesbianas",
    "inmigrantes refugiados extranjeros",
]
GROUPS = [line.split() for line in IDENTITY_TERMS]
TERMS = sorted({t for g in GROUPS for t in g})
LETTERS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """One document of FOLDS is never trained on."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(FOLDS)) == 0


def _text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Of all chunks of the texts: the text, the code, and the words (runs of letters, lower case) of each code."""
    chunks, owner = _words(texts)
    coded = chunks.dictionary_encode()
    return owner, np.asarray(coded.indices).astype(np.int64), [LETTERS.findall(x) for x in pc.utf8_lower(coded.dictionary).to_pylist()]


def present(texts: pa.Array, index: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every feature that is in a text, once each."""
    owner, code, words = _text_words(texts)
    known = [[index[w] for w in x if w in index] for x in words]
    rows, ids = [], []
    for nth in range(max(map(len, known), default=0)):
        of = np.array([x[nth] if len(x) > nth else -1 for x in known], dtype=np.int64)
        at = of[code]
        rows.append(owner[at >= 0])
        ids.append(at[at >= 0])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.unique(np.concatenate(rows) * len(index) + np.concatenate(ids))
    return key // len(index), key % len(index)


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text, toxic of about ``sample`` labelled documents at most, none of them held out.

    Chosen by a hash of doc_id.  Of several labels of a document the highest counts; documents
    without a label, a doc_id or a text are left out.
    """
    known = input_table(labels, doc_id="long", toxic="int").filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    share = min(1.0, sample / max(1, known.count()))
    chosen = lambda c: F.pmod(F.xxhash64(F.col(c)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))
    few = known.filter(chosen("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = input_table(docs, doc_id="long", text="string").filter(F.col("text").isNotNull()).filter(chosen("doc_id"))
    # The chosen labels are about ``sample`` rows at most.
    return rows.join(F.broadcast(few), "doc_id")


def telling_words(sample: DataFrame, most: int = FEATURES) -> list[str]:
    """Words whose share of toxic documents differs from that of others by LEAST_Z standard errors."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            owner, code, words = _text_words(batch.column("text"))
            index = {w: i for i, w in enumerate(dict.fromkeys(w for x in words for w in x))}
            if not index:
                continue
            row, feature = present(batch.column("text"), index)
            toxic = np.asarray(batch.column("toxic")).astype(np.int64)
            a = np.bincount(feature, toxic[row], minlength=len(index)).astype(np.int64)
            b = np.bincount(feature, 1 - toxic[row], minlength=len(index)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(index)), pa.array(a), pa.array(b)], names=["word", "a", "b"])

    total = sample.agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0")).first()
    n1, n0 = total["n1"] or 0, total["n0"] or 0
    if not n1 or not n0:
        return []
    counts = sample.select("text", "toxic").mapInArrow(tally, "word string, a long, b long").groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    share = (F.col("a") + F.col("b")) / (n1 + n0)
    z = (F.col("a") / n1 - F.col("b") / n0) / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) * (1 / n1 + 1 / n0))
    found = counts.filter(F.col("a") + F.col("b") >= LEAST_DOCS).withColumn("z", F.abs(z)).filter(F.col("z") >= LEAST_Z)
    return [r["word"] for r in found.orderBy(F.desc("z"), "word").limit(most).collect()]


def twins(rows: np.ndarray, ids: np.ndarray, n: int, index: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The second version of each of n documents: other names of groups, or one more where there are none."""
    other = np.arange(len(index))
    for g in GROUPS:
        for t, u in zip(g, g[1:] + g[:1]):
            other[index[t]] = index[u]
    terms = np.zeros(len(index), dtype=bool)
    terms[[index[t] for t in TERMS]] = True
    has = np.zeros(n, dtype=bool)
    has[rows[terms[ids]]] = True
    lacking = np.flatnonzero(~has)
    put_in = np.array([index[t] for t in TERMS])[lacking % len(TERMS)]
    return np.concatenate([rows, lacking]), np.concatenate([other[ids], put_in])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, penalty: float = TWIN_PENALTY) -> tuple[dict[str, int], np.ndarray, float]:
    """The features by word, their weights, and the bias."""
    chosen = materialize(training_sample(docs, labels, sample), "toxicity-sample")
    words = dict.fromkeys([*TERMS, *telling_words(chosen)])
    index = {w: i for i, w in enumerate(words)}

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, feature = present(batch.column("text"), index)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.ListArray.from_arrays(ends, pa.array(feature.astype(np.int32)))], names=["doc_id", "toxic", "ids"])

    rows = chosen.mapInArrow(gather, "doc_id long, toxic int, ids array<int>").toArrow().combine_chunks().sort_by("doc_id")
    n = rows.num_rows
    if not n:
        return index, np.zeros(len(index)), 0.0
    lists = rows["ids"].combine_chunks()
    owner = np.repeat(np.arange(n), np.asarray(pc.list_value_length(lists)))
    ids = np.asarray(lists.flatten()).astype(np.int64)
    target = rows["toxic"].to_numpy().astype(float)
    weight = np.ones(n)
    r2, i2 = twins(owner, ids, n, index)
    ones = lambda x: np.ones(len(x))
    w, b = fit(owner, ids, ones(ids), target, weight, len(index), l2=1e-4, twins=(r2, i2, ones(i2)), twin_penalty=penalty)
    return index, w, b


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, penalty: float = TWIN_PENALTY) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted for every document, of its text alone.

    Null and empty texts have no words and the score of the bias; a null doc_id is not held out;
    repeated rows are scored each; without labels all scores are one half.
    """
    index, w, b = train(docs, labels, sample, penalty)
    shared = docs.sparkSession.sparkContext.broadcast((index, w, b))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, w, b = shared.value
        for batch in slices(batches, "text"):
            row, feature = present(batch.column("text"), index)
            z = np.bincount(row, w[feature], minlength=batch.num_rows) + b
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sigmoid(z))], names=["doc_id", "score"])

    scored = input_table(docs, doc_id="long", text="string").mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op2_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of each document; null and empty texts are scored as well."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
