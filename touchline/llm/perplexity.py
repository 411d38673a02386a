"""Quality rules with an n-gram language model of the corpus itself.

The model is over characters: orders 1 to ``ORDER`` of a text whose white space is one
space between words.  Word n-grams of a corpus are nearly all different, so their counts don't
fit in any task; character n-grams are few and repeat in every task.  Documents that a task
reads one after another are a chunk of about ``CHUNK_BYTES``, kept in a file of its own; each
chunk's different n-grams are counted and Spark sums the counts, by language.

Modified Kneser-Ney: three discounts for each order (from the counts of counts),
lower orders counted by the number of different characters before them, all orders
interpolated.  N-grams of two and more characters that were met once only are not looked
up but back off: a document is part of the corpus, and would otherwise find its own
oddities well known.  Every ORDER-gram of the corpus has a row with the logarithm of
what it is looked up as.  These rows are joined to the chunks' different n-grams and meet
the chunks' files, so a task holds one chunk's n-grams, all counted n-grams are kept,
no text is shuffled, and nothing of the model is gathered in the driver or broadcast.

Bands: for each language the quartiles of all documents' log perplexity, found from a
histogram of fixed steps; documents beyond either band are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import folder, input_table, materialize, open_folder, slices, spread_name, table

ORDER = 4
#: Text bytes of the documents that are scored with the n-grams of one chunk.
CHUNK_BYTES = 8 << 20
#: Band edges: so many interquartile ranges beyond the quartiles, 3.4 deviations of a normal distribution.
BAND = 2.0
#: Width of the histogram's steps; a range is one step at least.
STEP = 0.005
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
# Fixed value: the symbols that base rules count.
SYMBOLS = "#*$%&|<>"
# Fixed value: what parts words.
BLANKS = " \t\n\x0b\x0c\r"


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts (null: none) and the text that each belongs to."""
    parts = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    flat, owner = parts.flatten(), np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(parts)))
    real = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(real), owner[np.asarray(real)]


def base_measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    n = len(texts)
    words, owner = _words(texts)
    count = lambda at, weights=None: np.bincount(at, weights, minlength=n).astype(np.int64)
    out = {"n_words": count(owner), "word_chars": count(owner, np.asarray(pc.utf8_length(words)))}
    filled = texts.cast(pa.large_string()).fill_null("")
    out["n_symbols"] = np.asarray(pc.count_substring_regex(filled, f"[{SYMBOLS}]")).astype(np.int64)

    lines = pc.split_pattern(filled, "\n")
    flat, line_owner = lines.flatten(), np.repeat(np.arange(n), np.asarray(pc.list_value_length(lines)))
    real = np.asarray(pc.greater(pc.binary_length(pc.ascii_trim(flat, BLANKS)), 0))
    code = np.asarray(flat.dictionary_encode().indices).astype(np.int64)
    line_owner, code = line_owner[real], code[real]
    pair = np.unique(np.stack([line_owner, code]), axis=1)[0] if len(code) else line_owner
    out["n_dup_lines"] = count(line_owner) - count(pair)

    code = np.asarray(words.dictionary_encode().indices).astype(np.int64)
    out["n_repeat_words"] = _repeated(code, owner, n)
    return out


def _repeated(code: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Words that lie in a window of three found more than once in their text."""
    if len(code) < 3:
        return np.zeros(n, dtype=np.int64)
    base = int(code.max()) + 1
    at = np.flatnonzero((owner[2:] == owner[:-2]))
    # Three codes make one number, or else (over two million words) the first two are numbered anew.
    pair = code[at] * base + code[at + 1]
    if base >= 1 << 21:
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair * base + code[at + 2]
    # Stable: equal windows stay in order of their texts.
    order = np.argsort(key, kind="stable")
    same = (key[order][1:] == key[order][:-1]) & (owner[at[order]][1:] == owner[at[order]][:-1])
    often = np.zeros(len(key), dtype=bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    inside = np.zeros(len(code), dtype=bool)
    for k in range(3):
        inside[at[often] + k] = True
    return np.bincount(owner[inside], minlength=n).astype(np.int64)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER-gram that ends at each character of the texts' words, and the text it is of.

    Each word has one space before it.  An n-gram is 16 bits a character, the last one lowest;
    what is before a text's start is zero.  Characters beyond 16 bits are folded into them.
    """
    filled = pc.ascii_trim(texts.cast(pa.large_string()).fill_null(""), BLANKS)
    filled = pc.binary_join(pc.ascii_split_whitespace(filled), pa.scalar(" ", pa.large_string()))
    size = np.asarray(pc.utf8_length(filled)).astype(np.int64)
    size += size > 0
    data = "".join(" " + x for x in filled.to_pylist() if x)
    points = np.frombuffer(data.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points = ((points & 0xFFFF) ^ (points >> 16)).astype(np.uint64)
    key, starts = points.copy(), np.cumsum(size) - size
    for n in range(1, ORDER):
        part = points[:-n] << np.uint64(16 * n)
        # The first n places of a text have another text's characters n places before.
        near = (starts[size > 0][:, None] + np.arange(n)).ravel() - n
        part[near[(near >= 0) & (near < len(part))]] = 0
        key[n:] |= part
    return key, np.repeat(np.arange(len(size)), size)


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, pa.Array]]:
    langs = batch.column("lang").dictionary_encode()
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        rows = np.flatnonzero(np.asarray(langs.indices) == code)
        yield lang, rows, batch.column("text").take(pa.array(rows))


def count_grams(docs: DataFrame, held_most: int = 500_000) -> DataFrame:
    """lang, gram, c: how often each ORDER-gram is in all texts of a language.

    docs: text, lang (not null).  A task holds the sums of what it has read, and sends them when they are many.
    """
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (gram, c) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(c)], names=["lang", "gram", "c"])
            held.clear()

        for batch in slices(batches, "text"):
            for lang, _, texts in _by_language(batch):
                gram, c = np.unique(grams(texts)[0], return_counts=True)
                if lang in held:
                    both = np.concatenate([held[lang][0], gram])
                    n = np.concatenate([held[lang][1], c])
                    order = np.argsort(both, kind="stable")
                    both, n = both[order], n[order]
                    starts = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
                    gram, c = both[starts], np.add.reduceat(n, starts)
                held[lang] = gram, c.astype(np.int64)
            if sum(len(c) for _, c in held.values()) > held_most:
                yield from out()
        yield from out()

    return docs.mapInArrow(tally, "lang string, gram long, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def chunk_grams(docs: DataFrame, out: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """chunk, lang, gram, c: how often each ORDER-gram is in a chunk's texts; and a row for each chunk with path.

    docs: doc_id, text, lang (not null).  A chunk is documents that one task reads one after another.  They stay
    together in a file below out, which path names: a compressed Arrow stream, written once and never shuffled.  A
    file that a failed attempt left behind is in no row.
    """
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        chunk, size, writer = TaskContext.get().partitionId() << 32, 0, None

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, (gram, c) in held.items():
                n = len(gram)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, chunk)), pa.array([lang] * n, pa.string()), pa.array(gram.view(np.int64)), pa.array(c), pa.nulls(n, pa.string())],
                                                 names=["chunk", "lang", "gram", "c", "path"])
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((chunk, None, None, None, path), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                             names=["chunk", "lang", "gram", "c", "path"])
            held.clear()

        for part in slices(batches, "text"):
            # In order of doc_id and text, as the rows come out again.
            part = part.take(pc.sort_indices(part, [("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start"))
            if writer is None:
                system, where = open_folder(out)
                path = f"{where}/{spread_name(f'chunk-{chunk}', '.arrows')}"
                sink = system.open_output_stream(path, compression=None)
                writer = pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
            writer.write_batch(part)
            size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
            for lang, _, texts in _by_language(part):
                gram, c = np.unique(grams(texts)[0], return_counts=True)
                held[lang] = _summed([*([held[lang]] if lang in held else []), (gram, c.astype(np.int64))])
            if size >= chunk_bytes:
                writer.close()
                sink.close()
                yield from rows()
                chunk, size, writer = chunk + 1, 0, None
        if writer is not None:
            writer.close()
            sink.close()
            yield from rows()

    return docs.select("doc_id", "text", "lang").mapInArrow(tally, "chunk long, lang string, gram long, c long, path string")


def _runs(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[pa.RecordBatch]:
    """The batches cut where one of the columns (whole numbers) changes."""
    for batch in batches:
        if batch.num_rows:
            new = np.zeros(batch.num_rows, dtype=bool)
            for name in columns:
                x = batch.column(name).to_numpy(zero_copy_only=False)
                new[1:] |= x[1:] != x[:-1]
            starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            for a, z in zip(starts, starts[1:]):
                yield batch.slice(a, z - a)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The different n-grams of all parts, sorted, and the sums of their counts."""
    if len(parts) == 1:
        return parts[0]
    gram, c = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(gram, kind="stable")
    gram, c = gram[order], c[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(gram)), bool), gram[1:] != gram[:-1]]))
    return gram[starts], np.add.reduceat(c, starts) if len(gram) else c


def _orders(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order: lang, gram, c, p, seen (what the n-gram is looked up as); and lang, context, total, saved."""
    mask = lambda n: F.col("gram").bitwiseAND(F.lit(-1 if n == 4 else (1 << (16 * n)) - 1))
    tables = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        # Of lower orders: the number of different characters before.
        tables[n] = tables[n + 1].select("lang", mask(n).alias("gram")).groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("c"))
    tables = {n: materialize(t.withColumn("n", F.lit(n)), f"grams-{n}") for n, t in tables.items()}
    every = tables[1]
    for n in range(2, ORDER + 1):
        every = every.unionByName(tables[n])
    tens = every.groupBy("lang", "n").agg(*[F.sum((F.col("c") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)], F.count(F.lit(1)).alias("types"))
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    # Counts of counts that are missing (small corpora) give the discount one half.
    raw = {k: F.when((F.col(f"n{k}") > 0) & (F.col(f"n{k + 1}") > 0), k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")).otherwise(0.5) for k in (1, 2, 3)}
    discounts = materialize(tens.select("lang", "n", "types", *[F.greatest(F.least(d, F.lit(k - 0.05)), F.lit(0.05)).alias(f"d{k}") for k, d in raw.items()]), "discounts")
    lower, out = None, []
    for n in range(1, ORDER + 1):
        d = F.broadcast(discounts.filter(F.col("n") == n).drop("n"))  # a row for each language
        of = tables[n].drop("n").join(d, "lang").withColumn("context", F.shiftrightunsigned("gram", 16))
        off = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        of = of.withColumn("off", F.least(off, F.col("c")))
        sums = of.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.sum("off").alias("saved"))
        of = of.join(sums, ["lang", "context"])
        if n == 1:
            below, seen_below = 1 / F.col("types"), None
        else:
            of = of.withColumn("lower", mask(n - 1)).join(
                lower.select(F.col("lang"), F.col("gram").alias("lower"), F.col("p").alias("below"), F.col("seen").alias("seen_below")), ["lang", "lower"])
            below, seen_below = F.col("below"), F.col("seen_below")
        p = (F.col("c") - F.col("off") + F.col("saved") * below) / F.col("total")
        seen = p if n == 1 else F.when(F.col("c") > 1, p).otherwise(_weight() * seen_below)
        lower = materialize(of.select("lang", "gram", "c", p.alias("p"), seen.alias("seen")), f"probabilities-{n}")
        out.append((lower, sums))
    return out


def _weight() -> Column:
    return F.greatest(F.col("saved") / F.col("total"), F.lit(1e-9))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """kind (p: probability, b: back-off weight), n, lang, gram, value (its logarithm), c.

    All orders of the modified Kneser-Ney model of each language.  A row of kind p is an n-gram; one of kind b the
    context of n - 1 characters.
    """
    out = []
    for n, (lower, sums) in enumerate(_orders(counts), 1):
        out.append(lower.select(F.lit("p").alias("kind"), F.lit(n).alias("n"), "lang", "gram", F.log("p").alias("value"), "c"))
        out.append(sums.select(F.lit("b").alias("kind"), F.lit(n).alias("n"), "lang", F.col("context").alias("gram"), F.log(_weight()).alias("value"), F.col("total").alias("c")))
    model = out[0]
    for t in out[1:]:
        model = model.unionByName(t)
    return model


def entry_hash(lang: str, kind: str, n: int, gram: np.ndarray) -> np.ndarray:
    """The 63-bit hash under which the model has an n-gram or a context."""
    from xxhash import xxh64_intdigest

    seed = np.uint64(xxh64_intdigest(f"{kind}{n}{lang}"))
    x = (gram ^ seed) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(1)).astype(np.int64)


class Model:
    """Sorted hashes and values of each kind and order, all in memory: for texts other than the corpus's own.

    quality_rules doesn't use it; its documents' n-grams are joined to the rows of seen_grams().
    """

    def __init__(self, arrays: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]):
        self.arrays = arrays

    @classmethod
    def gathered(cls, entries: DataFrame) -> Model:
        """From kneser_ney(): hashed in the tasks."""
        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = batch.to_pandas()
                for (kind, n, lang), part in rows.groupby(["kind", "n", "lang"]):
                    h = entry_hash(lang, kind, int(n), part["gram"].to_numpy().view(np.uint64))
                    slot = np.full(len(h), n if kind == "p" else -n, np.int8)
                    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(h), pa.array(part["value"].to_numpy(np.float64))], names=["slot", "h", "value"])

        looked_up = entries.filter("kind = 'b' OR n = 1 OR c > 1")
        found = looked_up.mapInArrow(hashed, "slot tinyint, h long, value double").toArrow()
        slot, h, value = (found[x].to_numpy() for x in ("slot", "h", "value"))
        arrays = {}
        for key in [(k, i) for k in "pb" for i in range(1, ORDER + 1)]:
            at = np.flatnonzero(slot == (key[1] if key[0] == "p" else -key[1]))
            at = at[np.argsort(h[at])]
            arrays[key] = h[at], value[at]
        return cls(arrays)

    def _find(self, kind: str, n: int, lang: str, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, values = self.arrays[kind, n]
        if not len(hashes):
            return np.zeros(len(gram), bool), np.zeros(len(gram))
        h = entry_hash(lang, kind, n, gram)
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        return hashes[at] == h, values[at]

    def log_probabilities(self, lang: str, gram: np.ndarray) -> np.ndarray:
        """Of the last character of each ORDER-gram, given those before it."""
        out, weight = np.full(len(gram), -20.0), np.zeros(len(gram))
        open_ = np.arange(len(gram))
        for n in range(ORDER, 0, -1):
            cut = gram[open_] & np.uint64((1 << (16 * n)) - 1)
            found, value = self._find("p", n, lang, cut)
            out[open_[found]] = weight[open_[found]] + value[found]
            open_, cut = open_[~found], cut[~found]
            known, value = self._find("b", n, lang, cut >> np.uint64(16))
            weight[open_] += np.where(known, value, 0.0)
        return out


def train(docs: DataFrame) -> Model:
    """The model of all texts; docs: text, lang."""
    counts = materialize(count_grams(_rows(docs)), "gram-counts")
    return Model.gathered(materialize(kneser_ney(counts), "model"))


def _rows(docs: DataFrame) -> DataFrame:
    rows = input_table(docs, doc_id="long", text="string", lang="string")
    return rows.withColumn("lang", F.coalesce("lang", F.lit("")))


def seen_grams(counts: DataFrame) -> DataFrame:
    """lang, gram, value: the logarithm of what every counted ORDER-gram is looked up as."""
    return _orders(counts)[-1][0].select("lang", "gram", F.log("seen").alias("value"))


def measured(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, lang, the base measures and log_perplexity (null: no word) of every document, by the model of all of them."""
    rows = _rows(docs)
    # Partitions of less than a chunk are read together, or their n-grams would be counted apart.
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    out = folder(docs.sparkSession, "chunks")
    stored = materialize(chunk_grams(rows.coalesce(total // chunk_bytes + 1), out, chunk_bytes), "chunk-grams")
    counted = stored.filter("gram IS NOT NULL").select("chunk", "lang", "gram", "c")
    seen = seen_grams(materialize(counted.groupBy("lang", "gram").agg(F.sum("c").alias("c")), "gram-counts"))
    known = counted.select("chunk", "lang", "gram").join(seen, ["lang", "gram"]).withColumn("is_path", F.lit(False))
    both = known.unionByName(stored.filter("gram IS NULL").select("chunk", "path", F.lit(True).alias("is_path")), allowMissingColumns=True)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A chunk's n-grams come before the path of its documents.
        system, _ = open_folder(out)

        def documents(paths: list[str]) -> Iterator[pa.RecordBatch]:
            for path in paths:
                with system.open_input_file(path) as source, pa.ipc.open_stream(source) as stream:
                    yield from stream

        chunk, parts, model = None, {}, {}
        for run in _runs(batches, "chunk", "is_path"):
            if run.column("chunk")[0].as_py() != chunk:
                chunk, parts, model = run.column("chunk")[0].as_py(), {}, {}
            if not run.column("is_path")[0].as_py():
                langs = run.column("lang").dictionary_encode()
                gram, value = run.column("gram").to_numpy().view(np.uint64), run.column("value").to_numpy()
                for code, lang in enumerate(langs.dictionary.to_pylist()):
                    at = np.asarray(langs.indices) == code
                    parts.setdefault(lang, []).append((gram[at], value[at]))
                continue
            for batch in slices(documents(run.column("path").to_pylist()), "text"):
                base = base_measures(batch.column("text"))
                score = np.zeros(batch.num_rows)
                size = np.zeros(batch.num_rows)
                for lang, at, texts in _by_language(batch):
                    gram, owner = grams(texts)
                    if not len(gram):
                        continue
                    if lang not in model:
                        every, values = (np.concatenate(x) for x in zip(*parts.pop(lang)))
                        order = np.argsort(every)
                        model[lang] = every[order], values[order]
                    every, values = model[lang]
                    coded = pa.array(gram).dictionary_encode()
                    different = np.asarray(coded.dictionary)
                    place = np.minimum(np.searchsorted(every, different), len(every) - 1)
                    if (every[place] != different).any():
                        raise ValueError("an n-gram of a document was not counted")
                    score[at] = np.bincount(owner, values[place][np.asarray(coded.indices)], minlength=len(at))
                    size[at] = np.bincount(owner, minlength=len(at))
                with np.errstate(invalid="ignore", divide="ignore"):
                    log_perplexity = pa.array(-score / size, mask=size == 0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), *(pa.array(base[x]) for x in names), log_perplexity],
                                                 names=["doc_id", "lang", *names, "log_perplexity"])

    placed = both.select("chunk", "is_path", "lang", "gram", "value", "path").repartition("chunk").sortWithinPartitions("chunk", "is_path")
    return placed.mapInArrow(measure, f"doc_id long, lang string, {', '.join(f'{x} long' for x in names)}, log_perplexity double")


def bands(scores: DataFrame, band: float = BAND) -> DataFrame:
    """lang, low, high: the log perplexities that a language's documents may have.

    From the quartiles of all its documents, of a histogram with steps of STEP: counts that
    Spark sums, a row for each step and language.
    """
    from pyspark.sql import Window

    steps = scores.filter("log_perplexity IS NOT NULL").groupBy("lang", F.floor(F.col("log_perplexity") / STEP).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("lang")
    share = steps.select("lang", "step", (F.sum("n").over(by.orderBy("step")) / F.sum("n").over(by)).alias("upto"))
    quarter = lambda q: F.min(F.when(F.col("upto") >= q, F.col("step"))) * STEP
    found = share.groupBy("lang").agg(quarter(0.25).alias("q1"), quarter(0.75).alias("q3"))
    reach = band * (F.col("q3") + STEP - F.col("q1"))
    return found.select("lang", (F.col("q1") - reach).alias("low"), (F.col("q3") + STEP + reach).alias("high"))


def quality_rules(docs: DataFrame, band: float = BAND) -> DataFrame:
    """doc_id, the base measures, base_failed, log_perplexity, low, high, kept of every document.

    kept is false if a base rule fails (under MIN_WORDS words, or more than MAX_REPEATED_PERCENT of
    them in repeated windows) or the log perplexity is outside its language's band.  Null
    texts have no words and fail; a null lang is a language of its own; rows that repeat count as often; an
    empty table gives no rows.
    """
    scores = materialize(measured(docs), "measures")
    judged = scores.join(F.broadcast(bands(scores, band)), "lang", "left")  # a row for each language
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(False))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & inside)


def op4_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures, log perplexity, its language's band and the verdict of each document; null texts fail."""
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "log_perplexity", "low", "high")
