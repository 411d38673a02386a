"""Importance resampling towards a target distribution, by hashed n-gram features.

Words of a batch of texts are found together: the texts are joined with separator sentinels (a byte
no word has), one regular expression pass finds all words, a binary search among the documents' offsets
says whose each word is, and n-grams whose first and last word are of different documents are masked
before their buckets are counted.

Bucket counts of all documents and of all target texts are summed by Spark; only the table of buckets (a
parameter's size) reaches the driver.  A document's weight is the sum of its features' log-ratio gains;
with Gumbel noise from its id added, the documents with the highest scores are a draw without
replacement in proportion to the weights' exponentials.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import input_table, materialize, slices, table
from touchline.llm.ranks import ranked
from touchline.llm.sqltext import CRC_TABLE, crc32_of

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
SENTINEL = b"\x00"
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WORDS_AT_ONCE = 1 << 18


def features(texts: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, document numbers, buckets) of the texts' n-grams of each length n, in parts of at most WORDS_AT_ONCE words.

    A-Z counts as a-z; an n-gram is its words' bytes joined by one space, its bucket their CRC-32 modulo buckets.
    """
    buffer = SENTINEL.join(texts).lower()
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    found = WORD.finditer(buffer)
    kept_words: list[bytes] = []  # the last longest - 1 words go on into the next part
    kept_docs = np.zeros(0, dtype=np.int64)
    while part := [(m.start(), m.group()) for m in islice(found, WORDS_AT_ONCE)]:
        starts, words = zip(*part)
        words = kept_words + list(words)
        docs = np.concatenate([kept_docs, np.searchsorted(ends, np.array(starts, dtype=np.int64), side="right")])
        old = len(kept_words)
        hashes = list(map(crc32, words))
        for n in range(1, longest + 1):
            if n > 1:
                hashes = [crc32(b" " + w, h) for h, w in zip(hashes, words[n - 1 :])]
            first = max(0, old - n + 1)
            a, z = docs[first : len(docs) - n + 1], docs[first + n - 1 :]
            same = a == z
            yield n, a[same], (np.array(hashes[first:], dtype=np.int64) % buckets)[same]
        if longest > 1:
            kept_words, kept_docs = words[1 - longest :], docs[1 - longest :]


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()]


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts (null: none) are in each bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in slices(batches, "text"):
            for _, _, found in features(_texts(batch), longest, buckets):
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = input_table(texts, text="string").mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of (t + 1)(S + buckets) / ((s + 1)(T + buckets))) of each bucket."""
    k, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + k) / ((s + 1) * (t_all + k))))
                     for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist())], dtype=np.int64)


def noise(doc_id: int | None, seed: str = SEED) -> int:
    """Gumbel noise in thousandths, from the id (null: the empty text)."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def with_scores(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of each document; a null text has no words."""
    known = docs.sparkSession.sparkContext.broadcast(gain)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = known.value
        for batch in slices(batches, "text"):
            rows = batch.num_rows
            n_words, n_features, weight = (np.zeros(rows, dtype=np.int64) for _ in range(3))
            for n, doc, bucket in features(_texts(batch), longest, len(g)):
                n_features += (counted := np.bincount(doc, minlength=rows))
                if n == 1:
                    n_words += counted
                # Whole numbers far below 2^53: their sums in doubles are exact.
                weight += np.bincount(doc, weights=g[bucket], minlength=rows).astype(np.int64)
            added = np.fromiter((noise(i, seed) for i in batch.column("doc_id").to_pylist()), dtype=np.int64, count=rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (n_words, n_features, weight, weight + added))],
                                             names=["doc_id", "n_words", "n_features", "weight", "score"])

    return input_table(docs, doc_id="long", text="string").mapInArrow(mark, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, longest: int = LONGEST, buckets: int = BUCKETS,
             least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of all documents; rank (1, 2, ...) is null for those not drawn.

    docs: doc_id, text; target: text.  Drawn are floor(percent * N / 100) of the N documents with at
    least least_words words, by the highest score, ties by the smaller doc_id (null: the smallest).  Null texts have no
    words and weight 0; every row counts, also with a repeated doc_id (such ties go by the other columns);
    an empty table gives no rows, an empty target has no features.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    scored = with_scores(docs, gain, longest, seed)
    scored = materialize(scored, "scores")
    enough = scored.filter(F.col("n_words") >= least_words)
    drawn = percent * enough.count() // 100
    placed = ranked(enough, ["-score", "doc_id"]).withColumn("rank", F.when(F.col("rank") < drawn, F.col("rank") + 1))
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return placed.unionByName(rest)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their weight towards the benchmark's texts, and the rank of the tenth that is drawn.

    Null texts have no words; repeated rows all come back; empty tables give no rows.
    """
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP11_SQL = f"""
WITH {CRC_TABLE}, d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), b AS (
  SELECT {_WORDS} AS w FROM benchmark
), dw AS (
  SELECT r, unnest(w) AS x FROM d
), bw AS (
  SELECT unnest(w) AS x FROM b
), x AS (
  SELECT x, {crc32_of("encode(x)")} % {BUCKETS} AS bucket FROM (SELECT x FROM dw UNION SELECT x FROM bw), crc_table
), s AS (
  SELECT bucket, count(*) AS n FROM dw JOIN x USING (x) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS n FROM bw JOIN x USING (x) GROUP BY bucket
), g AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM dw) + {BUCKETS})
         / (CAST(s.n + 1 AS DOUBLE) * ((SELECT count(*) FROM bw) + {BUCKETS})))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)
), weights AS (
  SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM dw JOIN x USING (x) JOIN g USING (bucket) GROUP BY r
), scored AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('{SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (r)
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= {LEAST_WORDS} AND place <= {PERCENT} * (SELECT count(*) FROM scored WHERE n_features >= {LEAST_WORDS}) // 100 THEN place END AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place FROM scored)
"""
