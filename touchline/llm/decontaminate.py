"""Benchmark decontamination with DataFrame functions only.

Test items become windows of normalised words, held in a hash set that every task has.  A
training text is read once: of each window start the first and the last word are looked up
in the sets of first and last words, then the whole window's hash in the set of hashes.  The few
candidates are verified by a broadcast join on the window's own text.

The sets are literals of the plan and the joined table is broadcast only while the benchmark
has at most ``MOST_WINDOWS`` windows, which is counted first.  Beyond it every window of the
texts is made a row and joined by a shuffle: slower, with the same results.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import input_table, table

WINDOW_WORDS = 10
MOST_WINDOWS = 200_000
# Fixed value: everything in ASCII that is neither a digit nor a lower-case letter parts words.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, BREAKS), "")


def _spelled(size: int) -> Callable[[Column], Column]:
    """Place, size and text of the window at a place."""
    return lambda at: F.struct(at.alias("at"), F.lit(size).alias("size"), F.array_join(_window(at, size), " ").alias("window"))


def item_windows(benchmark: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """size, window (words, space-joined), item_ids (distinct, as strings): one row for each different window.

    An item of fewer words is one window of its own size; an item without words has none.
    """
    items = input_table(benchmark, item_id="string", text="string").select("item_id", words_of(F.col("text")).alias("words"))
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - window_words + 1, F.lit(1)))
    rows = items.filter(n > 0).select("item_id", F.least(n, F.lit(window_words)).alias("size"), "words", F.explode(starts).alias("at"))
    return (rows.select("item_id", "size", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("window"))
            .groupBy("size", "window").agg(F.collect_set("item_id").alias("item_ids")))


def _window(at: Column, size: Column | int) -> Column:
    return F.slice("words", at, size)


def _known(size: int, first: list[str], last: list[str], hashes: list[int]) -> Callable[[Column], Column]:
    """Whether the window at a place may be known: by its ends, then by its hash."""
    return lambda at: (F.element_at("words", at).isin(first) & F.element_at("words", at + F.lit(size - 1)).isin(last)
                       & F.xxhash64(_window(at, size)).isin(hashes))


def occurrences(docs: DataFrame, windows: DataFrame, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """docs (columns row, words) with a row for each place where a window of an item occurs.

    row, n_words, and at (from 1), size, item_ids -- null in the one row of a text without any.
    """
    n_words = F.size("words").cast("long").alias("n_words")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most one for each size up to the window's
    n_windows = windows.limit(most_windows + 1).count() if sizes else 0
    if not sizes:
        none = F.lit(None)
        return docs.select("row", n_words, none.cast("int").alias("at"), none.cast("int").alias("size"), none.cast("array<string>").alias("item_ids"))
    starts = {k: F.sequence(F.lit(1), F.size("words") - F.lit(k - 1)) for k in sizes}
    if n_windows <= most_windows:
        known = windows.select("size", F.split("window", " ").alias("w")).select(
            "size", F.col("w")[0].alias("first"), F.element_at("w", -1).alias("last"), F.xxhash64("w").alias("hash")).collect()
        parts = []
        for k in sizes:
            of_size = [r for r in known if r["size"] == k]
            first, last, hashes = (sorted({r[c] for r in of_size}) for c in ("first", "last", "hash"))
            # Filtering first keeps the windows' texts few.
            at_hits = F.when(F.size("words") >= k, F.filter(starts[k], _known(k, first, last, hashes))).otherwise(F.array().cast("array<int>"))
            parts.append(F.transform(at_hits, _spelled(k)))
        found = docs.select("row", n_words, F.explode_outer(F.concat(*parts)).alias("hit"))
        found = found.select("row", "n_words", F.col("hit.at").alias("at"), F.col("hit.size").alias("size"), F.col("hit.window").alias("window"))
        right = F.broadcast(windows.select(F.col("size").alias("of_size"), F.col("window").alias("of_window"), "item_ids"))
    else:
        none = F.array().cast("array<struct<at:int,size:int,window:string>>")
        parts = [F.when(F.size("words") >= k, F.transform(starts[k], _spelled(k))).otherwise(none) for k in sizes]
        found = docs.select("row", n_words, F.explode_outer(F.concat(*parts)).alias("hit"))
        found = found.select("row", "n_words", F.col("hit.at").alias("at"), F.col("hit.size").alias("size"), F.col("hit.window").alias("window"))
        right = windows.select(F.col("size").alias("of_size"), F.col("window").alias("of_window"), "item_ids")
    joined = found.join(right, (F.col("size") == F.col("of_size")) & (F.col("window") == F.col("of_window")), "left")
    place = F.col("item_ids").isNotNull()
    return joined.select("row", "n_words", F.when(place, F.col("at")).alias("at"), F.when(place, F.col("size")).alias("size"), "item_ids")


def hits(docs: DataFrame, benchmark: DataFrame, window_words: int = WINDOW_WORDS, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """doc_id, n_words, hit_words (places from 1, ascending), item_ids (strings, ascending): one row for each document.

    Null texts have no words; repeated and null doc_ids are kept row by row.
    """
    rows = input_table(docs, doc_id="long", text="string")
    # A row's own number holds within this one job, where the texts are read once.
    marked = rows.select(F.struct(F.monotonically_increasing_id().alias("nth"), "doc_id").alias("row"), words_of(F.col("text")).alias("words"))
    places = occurrences(marked, item_windows(benchmark, window_words), most_windows)
    grouped = places.groupBy("row").agg(
        F.max("n_words").alias("n_words"),
        F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "size", "item_ids"))).alias("found"))
    spots = F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda x: F.sequence(x["at"], x["at"] + x["size"] - 1)))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda x: x["item_ids"]))))
    return grouped.select(F.col("row.doc_id").alias("doc_id"), F.col("row.nth").alias("nth"), "n_words", spots.alias("hit_words"), items.alias("item_ids"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window_words: int = WINDOW_WORDS,
                  most_windows: int = MOST_WINDOWS) -> DataFrame:
    """The documents without those that hold a window of a test item, or without the spans that do.

    All columns are kept.  remove="documents" drops each document in which a window occurs;
    remove="spans" cuts the words that lie in occurrences, and what parts them, out of ``text`` and
    keeps the rest (a document of which nothing is left has an empty text).  A clean document is
    returned as it is, character by character; null and empty texts are clean.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    # What is found depends on the text alone, so 128 bits of it are the key: doc_ids may repeat or be null.
    text = F.col("text").cast("string")
    key = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(WINDOW_WORDS), text).alias("b"))
    marked = docs.select(F.struct("*").alias("whole"), key.alias("row"), words_of(text).alias("words"))
    places = occurrences(marked.select("row", "words"), item_windows(benchmark, window_words), most_windows).filter("at IS NOT NULL")
    if remove == "documents":
        return marked.select("whole", "row").join(places.select("row").distinct(), "row", "left_anti").select("whole.*")
    spots = places.select("row", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)).alias("at"))
    cut = spots.groupBy("row").agg(F.collect_set("at").alias("cut"))
    # The text as word, break, word, ...: a word keeps the break after it.
    pieces = F.regexp_extract_all(F.col("whole.text"), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"), F.lit(0))
    lead = F.regexp_extract(F.col("whole.text"), r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    left = F.filter(F.transform(pieces, lambda x, i: F.struct(x.alias("piece"), (i + 1).alias("at"))), lambda x: ~F.array_contains("cut", x["at"]))
    rest = F.concat(lead, F.array_join(F.transform(left, lambda x: x["piece"]), ""))
    text = F.when(F.col("cut").isNull(), F.col("whole.text")).otherwise(rest)
    out = marked.select("whole", "row").join(cut, "row", "left").select("whole", text.alias("rest"))
    return out.select(*[F.col("rest").alias(c) if c == "text" else F.col(f"whole.`{c}`") for c in docs.columns])


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each document; null texts have no words."""
    found = hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("item_ids", ","), "UTF-8"), 256).alias("items_sha256"), (F.size("hit_words") > 0).alias("contaminated"))


_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

OP8_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), b AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW_WORDS}) AS k, array_to_string(w[s : s + least(len(w), {WINDOW_WORDS}) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW_WORDS} + 1, 1) + 1)) AS s FROM b WHERE len(w) > 0)
), ks AS (
  SELECT DISTINCT k FROM bw
), dw AS (
  SELECT r, k, s, array_to_string(w[s : s + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, ks WHERE len(w) >= k)
), h AS (
  SELECT r, s, dw.k, item_id FROM dw JOIN bw USING (k, g)
), p AS (
  SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS pos FROM h) GROUP BY r
), i AS (
  SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN i USING (r)
"""
