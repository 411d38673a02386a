"""Quality scores from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each document.  Expectation
maximisation over the counts of their vote patterns (at most 3 to the number of labellers, summed
by Spark over all documents) estimates how often each labeller votes what on good and on
bad documents, and so the posterior of every pattern.  The posteriors are the labels on
which a linear scorer of hashed features is trained, from a sample of at most about
``SAMPLE`` documents; it then scores all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import input_table, slices, table
from touchline.llm.linear import fit, sigmoid
from touchline.llm.perplexity import _repeated, _words

SAMPLE = 20_000
FEATURES = 1 << 14
#: Documents whose posterior of being good is below this are rejected by their score.
THRESHOLD = 0.5
# Labellers: measure, then the range that is a vote for good, and the range for bad.
LABELLERS = {
    "words": ((20, np.inf), (0, 3)),
    "symbols": ((0, 0.02), (0.15, np.inf)),
    "shouts": ((0, 0.02), (0.2, np.inf)),
    "capitals": ((0, 0.15), (0.4, 1.01)),
    "repeated": ((0, 0.2), (0.5, 1.01)),
    "same_lines": ((0, 0.1), (0.4, 1.01)),
    "bars": ((0, 0.01), (0.15, np.inf)),
    "word_length": ((2.5, 12.0), (16, np.inf)),
    "plain": ((0.85, 1.01), (0, 0.65)),
    "marks": ((0, 0.06), (0.12, 1.01)),
    "echoes": ((0, 0.05), (0.2, 1.01)),
    "variety": ((0.3, 1.01), (0, 0.1)),
}
NAMES = list(LABELLERS)


class _Shape(dict):
    """Letters become A or a, digits 0; all else stays."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        self[point] = out = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        return out


SHAPE, RUNS = _Shape(), re.compile(r"(.)\1+", re.S)


def word_shape(word: str) -> str:
    return RUNS.sub(r"\1", word.translate(SHAPE))[:12]


def measures(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, list[str]]:
    """What labellers look at, and of all words: the text, the code, and each code's word."""
    n = len(texts)
    words, owner = _words(texts)
    coded = words.dictionary_encode()
    code, different = np.asarray(coded.indices).astype(np.int64), coded.dictionary
    filled = texts.cast(pa.large_string()).fill_null("")
    n_words = np.bincount(owner, minlength=n)
    each = np.maximum(n_words, 1)
    of_words = lambda values: np.bincount(owner, np.asarray(values).astype(float)[code], minlength=n) if len(code) else np.zeros(n)
    size = pc.utf8_length(different)
    letters = of_words(pc.count_substring_regex(different, r"\pL"))
    out = {
        "words": n_words.astype(float),
        "symbols": of_words(pc.count_substring_regex(different, r"[#*$%&<>]")) / each,
        "shouts": of_words(pc.count_substring(different, "!")) / each,
        "capitals": of_words(pc.count_substring_regex(different, r"\p{Lu}")) / np.maximum(letters, 1),
        "repeated": _repeated(code, owner, n) / each,
        "bars": of_words(pc.count_substring(different, "|")) / each,
        "word_length": of_words(size) / each,
        "plain": of_words(pc.match_substring_regex(different, r"^\pL+[.,;:?!]?$")) / each,
        "marks": of_words(pc.count_substring_regex(different, r"[^\pL\pN\pM.,;:?']")) / np.maximum(of_words(size), 1),
    }
    echo = owner[1:][(owner[1:] == owner[:-1]) & (code[1:] == code[:-1])]
    out["echoes"] = np.bincount(echo, minlength=n) / each
    # Different words among at most as many as a page has, as long texts repeat theirs anyway.
    pairs = np.sort(owner * max(1, len(different)) + code)
    kinds = np.bincount(pairs[np.diff(pairs, prepend=-1) > 0] // max(1, len(different)), minlength=n)
    out["variety"] = np.where(n_words > 0, kinds / np.minimum(each, 300), 1.0).clip(0, 1)
    lines = pc.split_pattern(filled, "\n")
    line, line_owner = lines.flatten(), np.repeat(np.arange(n), np.asarray(pc.list_value_length(lines)))
    line_code = np.asarray(line.dictionary_encode().indices).astype(np.int64)
    different_lines = np.bincount(np.unique(line_owner + n * line_code) % n, minlength=n) if len(line_code) else np.zeros(n)
    n_lines = np.maximum(np.bincount(line_owner, minlength=n), 1)
    out["same_lines"] = (n_lines - np.maximum(different_lines, 1)) / n_lines
    return out, owner, code, different.to_pylist()


def patterns(found: dict[str, np.ndarray]) -> np.ndarray:
    """Votes of all labellers as the digits of a number: 0 nothing, 1 good, 2 bad."""
    out = np.zeros(len(found["words"]), dtype=np.int64)
    for i, name in enumerate(NAMES):
        good, bad = LABELLERS[name]
        x = found[name]
        vote = np.where((x >= bad[0]) & (x < bad[1]), 2, np.where((x >= good[0]) & (x < good[1]), 1, 0))
        out += vote * 3**i
    return out


def votes(pattern: np.ndarray) -> np.ndarray:
    """Rows of votes of the patterns."""
    return np.stack([pattern // 3**i % 3 for i in range(len(NAMES))], axis=1)


def estimate(pattern: np.ndarray, count: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, dict]:
    """Posterior of being good for each pattern, and the labellers' estimated behaviour.

    chances[y, i, v]: how often labeller i votes v on documents of class y (1: good).  There are
    many ways to be bad and each labeller sees some, so the start is: of their votes, one in a hundred is
    bad on good documents and three in ten on bad ones; nine documents of ten are good.
    """
    v = votes(pattern)
    chances = np.zeros((2, len(NAMES), 3))
    spread = np.stack([(count[:, None] * (v == k)).sum(axis=0) for k in range(3)], axis=1) / max(1, count.sum())
    cast = (1 - spread[:, 0])[:, None]
    chances[:, :, 0] = spread[:, 0]
    chances[1, :, 1:] = cast * [0.99, 0.01]
    chances[0, :, 1:] = cast * [0.7, 0.3]
    chances, prior, post = chances + 1e-6, 0.9, np.full(len(pattern), 0.9)
    for _ in range(rounds):
        logs = [np.log(chances[y] / chances[y].sum(axis=1, keepdims=True)) for y in (0, 1)]
        bad, good = (sum(logs[y][i][v[:, i]] for i in range(len(NAMES))) for y in (0, 1))
        post = sigmoid(good - bad + np.log(prior / (1 - prior)))
        for y, share in ((0, 1 - post), (1, post)):
            for k in range(3):
                chances[y, :, k] = ((count * share)[:, None] * (v == k)).sum(axis=0) + 0.5
        prior = float(np.clip((count * post).sum() / max(1, count.sum()), 0.5, 0.999))
    rates = chances / chances.sum(axis=2, keepdims=True)
    accuracy = {name: float((prior * rates[1, i, 1] + (1 - prior) * rates[0, i, 2]) / max(1e-9, prior * rates[1, i, 1:].sum() + (1 - prior) * rates[0, i, 1:].sum()))
                for i, name in enumerate(NAMES)}
    return post, {"prior": prior, "accuracy": accuracy}


def features(found: dict[str, np.ndarray], owner: np.ndarray, code: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) entries: shares of word shapes and pairs of shapes, and each measure's step."""
    from xxhash import xxh32_intdigest

    n = len(found["words"])
    each = np.maximum(found["words"], 1)
    shapes = np.fromiter((xxh32_intdigest(word_shape(w)) for w in words), dtype=np.int64, count=len(words))
    shape = shapes[code] if len(code) else np.zeros(0, np.int64)
    pair = (shape[:-1] * 31 + shape[1:] * 17 + 5)[owner[1:] == owner[:-1]]
    rows = [owner, owner[1:][owner[1:] == owner[:-1]]]
    ids = [shape % FEATURES, pair % FEATURES]
    values = [1 / each[rows[0]], 1 / each[rows[1]]]
    for i, name in enumerate(NAMES):
        scale = 1.0 if name in ("words", "word_length") else 50.0
        step = np.floor(np.log2(1 + scale * found[name])).astype(np.int64)
        rows.append(np.arange(n))
        ids.append((step * 1009 + i * 7919 + 104729) % FEATURES)
        values.append(np.full(n, 0.5))
    return np.concatenate(rows), np.concatenate(ids), np.concatenate(values)


def vote_patterns(docs: DataFrame) -> DataFrame:
    """pattern, n: how many documents have it."""
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            pattern, n = np.unique(patterns(measures(batch.column("text"))[0]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pattern), pa.array(n.astype(np.int64))], names=["pattern", "n"])

    texts = input_table(docs, text="string")
    return texts.mapInArrow(vote, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float, dict]:
    """Weights and bias of the scorer, and what the labellers were found to be.

    Trains on the documents with the smallest hashes, about ``sample`` of them at most.
    """
    counts = vote_patterns(docs).toPandas().sort_values("pattern")  # one for each pattern met, at most 3 ** 12
    if not len(counts):
        return np.zeros(FEATURES), 0.0, {"prior": 0.9, "accuracy": {}}
    post, about = estimate(counts["pattern"].to_numpy(), counts["n"].to_numpy().astype(float))
    posterior = dict(zip(counts["pattern"], post))
    share = min(1.0, sample / counts["n"].sum())

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found, owner, code, words = measures(batch.column("text"))
            row, column, value = features(found, owner, code, words)
            key, at = np.unique(row * FEATURES + column, return_inverse=True)
            value = np.bincount(at, value)
            ends = np.searchsorted(key // FEATURES, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("h"), pa.array(patterns(found)), pa.ListArray.from_arrays(ends, pa.array((key % FEATURES).astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(value.astype(np.float32)))], names=["h", "pattern", "ids", "vals"])

    chosen = input_table(docs, doc_id="long", text="string").withColumn("h", F.xxhash64("doc_id", "text"))
    chosen = chosen.filter(F.pmod("h", F.lit(1_000_000)) < F.lit(int(share * 1_000_000))).select("h", "text")
    rows = chosen.mapInArrow(gather, "h long, pattern long, ids array<int>, vals array<float>").toArrow().combine_chunks()
    rows = rows.sort_by("h")
    if not rows.num_rows:
        return np.zeros(FEATURES), 0.0, about
    ids, vals = rows["ids"].combine_chunks(), rows["vals"].combine_chunks()
    owner = np.repeat(np.arange(rows.num_rows), np.asarray(pc.list_value_length(ids)))
    target = np.array([posterior.get(p, about["prior"]) for p in rows["pattern"].to_pylist()])
    # Each class as a whole has the same weight.
    weight = target / max(target.sum(), 1e-9) + (1 - target) / max((1 - target).sum(), 1e-9)
    w, b = fit(owner, np.asarray(ids.flatten()).astype(np.int64), np.asarray(vals.flatten()).astype(float), target, weight, FEATURES)
    return w, b, about


def quality_scores(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text_hash, score (0 to 1, higher: better), kept (score at least THRESHOLD) of every document.

    Null and empty texts have no words, and get the score that this earns; repeated rows and
    null doc_ids are scored row by row; an empty table gives no rows.
    """
    w, b, _ = train(docs, sample)
    shared = docs.sparkSession.sparkContext.broadcast((w, b))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = shared.value
        for batch in slices(batches, "text"):
            found, owner, code, words = measures(batch.column("text"))
            row, column, value = features(found, owner, code, words)
            z = np.bincount(row, value * w[column], minlength=batch.num_rows) + b
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(sigmoid(z))], names=["doc_id", "text_hash", "score"])

    rows = input_table(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(score, "doc_id long, text_hash long, score double").withColumn("kept", F.col("score") >= THRESHOLD)


def keep_good(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents whose score is at least THRESHOLD, all columns; null and empty texts go."""
    w, b, _ = train(docs, sample)
    shared = docs.sparkSession.sparkContext.broadcast((w, b))

    @F.arrow_udf("boolean")
    def good(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # Only texts go to Python and only verdicts come back; the rows stay with Spark.
        w, b = shared.value
        for texts in arrays:
            verdicts = [np.zeros(0, dtype=bool)]
            for batch in slices([pa.RecordBatch.from_arrays([texts], names=["text"])], "text"):
                found, owner, code, words = measures(batch.column("text").cast(pa.string()))
                row, column, value = features(found, owner, code, words)
                z = np.bincount(row, value * w[column], minlength=batch.num_rows) + b
                verdicts.append((sigmoid(z) >= THRESHOLD) & (found["words"] > 0))
            yield pa.array(np.concatenate(verdicts))

    return docs.where(good(F.col("text").cast("string")))


def op6_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, score, kept for each document."""
    return quality_scores(table(spark, sf_dir, "documents")).select("doc_id", "score", "kept")
