"""Quality classifier: interpolated modified Kneser-Ney model of trusted text, joined with every document.

The model is over whole characters (code points), ``ORDER`` at a time; no character stands for another.
Every map task counts the grams of its trusted texts and the counts are added up by gram. Lower orders use
continuation counts. Counts and contexts are tables sharded by their key, which grow with the corpus:
nothing of them is collected or broadcast by this module.

Documents are dealt to chunks of about ``CHUNK`` characters by ranges of doc_id. A map task sends each gram
of a chunk once; the distinct grams meet the counts, the masses of their contexts and the probabilities of
their shorter grams in joins, order by order. What comes out, a probability per gram, is joined with the
chunks that asked for it, and sorted in front of the texts of the chunk, whose log probabilities are summed
per document. Texts go there compressed. A document's perplexity is compared with a quantile of the trusted
documents of its language.

Defined results: a null text counts as empty; an empty text has the perplexity of its language's
prior mass and is kept; a language without trusted documents (or null) uses the quantile over all
trusted documents; without any trusted document everything is kept; repeated rows are counted and
scored as often as they occur; very long texts are scored in whole, in slices. Chunks are even for serial
ids; ids in any other order or range give the same results with more rows per chunk or larger chunks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.staging import saved
from clientele.session import session_settings

#: All code points, and the characters of a gram.
CLASSES, ORDER = 0x110000, 4
#: Quantile of the trusted documents' perplexity up to which documents are kept, and the number of
#: characters at the average of the language that every text is taken to begin with.
QUANTILE, PRIOR = 0.999, 100
#: Room above the quantile, as clean documents differ more than the trusted ones among them.
MARGIN = 1.1
#: Characters of a chunk, of what is worked on at once, grams that wait to be counted, and distinct grams that
#: a task holds before it sends them.
CHUNK, SLICE, WAITING, HELD = 1 << 24, 1 << 18, 1 << 19, 1 << 21
LEAD = "\n" * (ORDER - 1)
#: The characters of a gram are numbered within a task; four numbers fill 64 bits.
NUMBERS = 1 << 16


def pieces(text: str) -> Iterator[str]:
    """``text`` in slices, each with the ORDER - 1 characters before it in front."""
    text = LEAD + text
    return (text[i : i + SLICE + ORDER - 1] for i in range(0, len(text) - ORDER + 1, SLICE))


def groups(texts: Iterable[tuple[int, str]]) -> Iterator[tuple[list[int], list[str]]]:
    """(owner, text) as lists of owners and their pieces, some SLICE characters at a time."""
    owners, parts, size = [], [], 0
    for owner, text in texts:
        for part in pieces(text):
            owners.append(owner)
            parts.append(part)
            size += len(part)
            if size >= SLICE:
                yield owners, parts
                owners, parts, size = [], [], 0
    if parts:
        yield owners, parts


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def keys(numbers: np.ndarray, sizes: np.ndarray, base: int) -> np.ndarray:
    """One number per gram of every piece; sizes: their lengths, numbers: those of their characters."""
    numbers = numbers.astype(np.uint64)
    n = max(len(numbers) - ORDER + 1, 0)
    out = numbers[:n].copy()
    for k in range(1, ORDER):
        out *= np.uint64(base)
        out += numbers[k : k + n]
    inside = np.ones(n, bool)
    inside[(np.cumsum(sizes)[:-1, None] - np.arange(1, ORDER)).ravel()] = False
    return out[inside]


class Tally:
    """How often each gram occurs in the texts of each chunk."""

    def __init__(self):
        self.number = np.zeros(CLASSES, np.uint16)
        self.clear()

    def clear(self) -> None:
        self.number[:] = 0
        self.letters = np.zeros(1, np.uint32)
        self.waiting: dict[int, list[np.ndarray]] = {}
        self.counted: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.n_waiting = 0

    def add(self, chunk: int, parts: list[str]) -> Iterator[pa.RecordBatch]:
        """Counts the parts; gives what was counted before where there is no room left."""
        points = code_points("".join(parts))
        new = np.unique(points[self.number[points] == 0])
        if len(self.letters) + len(new) > NUMBERS and len(self.letters) > 1:
            yield from self.take()
            new = np.unique(points)
        if len(new) >= NUMBERS:
            # More characters than numbers: halves, down to single pieces cut in two.
            half = len(parts) // 2
            if half:
                yield from self.add(chunk, parts[:half])
                yield from self.add(chunk, parts[half:])
            else:
                middle = len(parts[0]) // 2
                yield from self.add(chunk, [parts[0][: middle + ORDER - 1]])
                yield from self.add(chunk, [parts[0][middle:]])
            return
        self.number[new] = np.arange(len(self.letters), len(self.letters) + len(new))
        self.letters = np.concatenate([self.letters, new])
        found = keys(self.number[points], np.array([len(p) for p in parts]), NUMBERS)
        self.waiting.setdefault(chunk, []).append(found)
        self.n_waiting += len(found)
        if self.n_waiting >= WAITING:
            self.fold()
            if sum(len(grams) for grams, _ in self.counted.values()) >= HELD:
                yield from self.take()

    def fold(self) -> None:
        for chunk, found in self.waiting.items():
            grams, n = np.unique(np.concatenate(found), return_counts=True)
            if chunk in self.counted:
                before, n_before = self.counted[chunk]
                every = np.union1d(before, grams)
                total = np.zeros(len(every), np.int64)
                total[np.searchsorted(every, before)] = n_before
                total[np.searchsorted(every, grams)] += n
                grams, n = every, total
            self.counted[chunk] = grams, n
        self.waiting, self.n_waiting = {}, 0

    def take(self) -> Iterator[pa.RecordBatch]:
        self.fold()
        for chunk, (grams, n) in self.counted.items():
            for i in range(0, len(grams), SLICE):
                some = grams[i : i + SLICE]
                letters = np.empty((len(some), ORDER), np.uint32)
                for k in range(ORDER):
                    letters[:, ORDER - 1 - k] = self.letters[some // np.uint64(NUMBERS**k) % np.uint64(NUMBERS)]
                text = letters.tobytes().decode("utf-32-le")
                strings = [text[j : j + ORDER] for j in range(0, len(text), ORDER)]
                columns = [pa.array(np.full(len(some), chunk)), pa.array(strings), pa.array(n[i : i + SLICE], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "gram", "n"])
        self.clear()


def tallied(texts: DataFrame) -> DataFrame:
    """(chunk, gram, n) of (chunk, text): the grams of each chunk, which a task sends once if it has room."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            rows = ((c.as_py(), t.as_py() or "") for c, t in zip(batch.column(0), batch.column(1)))
            for owners, parts in groups(rows):
                cuts = [0, *(np.flatnonzero(np.diff(owners)) + 1), len(owners)]
                for a, b in zip(cuts, cuts[1:]):
                    yield from tally.add(owners[a], parts[a:b])
        yield from tally.take()

    return texts.select("chunk", "text").mapInArrow(count, "chunk bigint, gram string, n bigint")


def count_grams(texts: DataFrame) -> DataFrame:
    """(gram, n) over all texts."""
    counts = tallied(texts.select(F.lit(0).cast("bigint").alias("chunk"), "text"))
    return counts.groupBy("gram").agg(F.sum("n").alias("n"))


def discounted(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, n, off) of one order with what is taken off each count, and (context, all, left) of its contexts."""
    row = counts.agg(*[F.sum((F.col("n") == k).cast("bigint")).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (float(x or 0) for x in row)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    d = [min(max(x, 0.05), k + 0.95) for k, x in enumerate(raw)]
    off = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
    cut = counts.withColumn("off", off)
    contexts = cut.groupBy(context().alias("context")).agg(F.sum("n").alias("all"), F.sum("off").alias("left"))
    return cut, contexts


def context() -> Column:
    return F.expr("substring(gram, 1, char_length(gram) - 1)")


def shorter() -> Column:
    return F.expr("substring(gram, 2)")


class Model:
    """Per order the discounted counts and their contexts, as tables."""

    def __init__(self, counts: DataFrame):
        self.orders = []
        for _ in range(ORDER):
            counts = saved(counts, "grams")
            self.orders.insert(0, discounted(counts))
            # A lower order counts in how many contexts a gram goes on, not how often.
            counts = counts.groupBy(shorter().alias("gram")).agg(F.count("*").alias("n"))

    def probabilities(self, asked: DataFrame) -> DataFrame:
        """(gram, p) for distinct grams of ORDER characters: P(last character | those before it)."""
        wanted = [asked.select("gram")]
        for _ in range(ORDER - 1):
            wanted.insert(0, wanted[0].select(shorter().alias("gram")).distinct())
        for k, (grams, (cut, contexts)) in enumerate(zip(wanted, self.orders)):
            known = grams.withColumn("context", context()).join(cut, "gram", "left").join(contexts, "context", "left")
            if k:
                lower = below.select(F.col("gram").alias("shorter"), F.col("p").alias("p_shorter"))
                known = known.withColumn("shorter", shorter()).join(lower, "shorter")
            else:
                known = known.withColumn("p_shorter", F.lit(1.0 / CLASSES))
            # P(w | context) = term + left(context) P(w | shorter context)
            term = F.coalesce((F.col("n") - F.col("off")) / F.col("all"), F.lit(0.0))
            left = F.coalesce(F.col("left") / F.col("all"), F.lit(1.0))
            below = saved(known.select("gram", (term + left * F.col("p_shorter")).alias("p")), "probabilities")
        return below


def log_probabilities(counts: DataFrame, contexts: int = 4) -> np.ndarray:
    """log P(character | context), for all code points and the first ``contexts`` contexts of ``counts``.

    The model written out, to look at: its size does not follow the corpus.
    """
    model = Model(counts)
    first = model.orders[-1][1].select("context").orderBy("context").limit(contexts)
    letters = model.orders[0][0].select(F.col("gram").alias("letter"))
    seen = {r.letter for r in letters.collect()}
    other = next(chr(c) for c in range(CLASSES) if chr(c) not in seen)
    letters = letters.unionByName(counts.sparkSession.createDataFrame([(other,)], "letter string"))
    asked = first.crossJoin(letters).select(F.concat("context", "letter").alias("gram"))
    p = {r.gram: r.p for r in model.probabilities(asked).collect()}
    rows = []
    for head in sorted({gram[:-1] for gram in p}):
        row = np.full(CLASSES, p[head + other])
        for letter in seen:
            row[ord(letter)] = p[head + letter]
        rows.append(row)
    return np.log(np.concatenate(rows))


class Chunk:
    """The log probabilities of the grams of a chunk."""

    def __init__(self, grams: list[str], p: np.ndarray):
        table = pd.Series(np.log(p), index=pd.Index(grams, dtype=object))
        table = table[~table.index.duplicated()]
        self.logs = table.to_numpy()
        points = code_points("".join(table.index))
        letters, numbers = np.unique(points, return_inverse=True)
        self.number = np.zeros(CLASSES, np.uint32)
        self.number[letters] = np.arange(len(letters))
        # The texts have no other grams: a base that tells these apart is exact, also beyond 64 bits.
        self.base = len(letters) | 1
        while True:
            inside = keys(numbers, np.full(len(table), ORDER), self.base)
            self.places = pd.Index(inside)
            if self.places.is_unique:
                break
            self.base += 2

    def losses(self, texts: Iterable[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Summed negative log probability and length of each of n texts, which need not be held together."""
        loss, length = np.zeros(n), np.zeros(n, np.int64)
        for owners, parts in groups(enumerate(texts)):
            sizes = np.array([len(p) for p in parts])
            np.add.at(length, owners, sizes - ORDER + 1)
            found = keys(self.number[code_points("".join(parts))], sizes, self.base)
            at = self.places.get_indexer(found)
            if len(at) and at.min() < 0:
                raise ValueError("a text has grams that were not gathered for its chunk")
            starts = np.cumsum(sizes - ORDER + 1) - (sizes - ORDER + 1)
            np.subtract.at(loss, owners, np.add.reduceat(self.logs[at], starts))
        return loss, length


def chunked(docs: DataFrame) -> Column:
    """The chunk of a document."""
    size = F.sum(F.char_length("text"))
    low, high, total = docs.agg(F.min("doc_id"), F.max("doc_id"), size).first()
    cores = docs.sparkSession.sparkContext.defaultParallelism
    n = max(-(-(total or 0) // CHUNK), min(cores, -(-(total or 0) // (CHUNK // 16))), 1)
    width = min(max(-(-((high or 0) - (low or 0) + 1) // n), 1), 2**63 - 1)
    return F.coalesce(F.expr(f"doc_id div {width}"), F.pmod(F.xxhash64("text"), F.lit(n))).cast("bigint")


def packed() -> Column:
    """The text, compressed; null as empty."""

    @F.pandas_udf("binary")
    def pack(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: zlib.compress(t.encode(), 1))

    return pack(F.coalesce("text", F.lit("")))


def fit(docs: DataFrame, trusted_ids: DataFrame) -> Model | None:
    """The model of all texts of ``docs`` whose doc_id is in ``trusted_ids`` (doc_id)."""
    # The ids grow with the corpus: the join is a shuffled one at every size. Before it, Spark may leave out
    # most other documents by a Bloom filter of the ids.
    ids = trusted_ids.select("doc_id").hint("merge")
    trusted = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    bloom = "spark.sql.optimizer.runtime.bloomFilter."
    with session_settings(
        docs.sparkSession, {f"{bloom}applicationSideScanSizeThreshold": "0", f"{bloom}creationSideThreshold": "1g"}
    ):
        counts = saved(count_grams(trusted), "counts")
    return None if counts.isEmpty() else Model(counts)


def score(docs: DataFrame, model: Model | None, with_text: bool) -> DataFrame:
    """(kept, loss, length[, text]): ``kept`` has all columns of ``docs`` but the text."""
    kept = F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != "text"]).alias("kept")
    if model is None:
        empty = [F.lit(0.0).alias("loss"), F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint").alias("length")]
        return docs.select(kept, *empty, *["text"] * with_text)
    chunk = chunked(docs)
    asked = saved(tallied(docs.select(chunk.alias("chunk"), "text")).select("chunk", "gram"), "asked")
    p = model.probabilities(saved(asked.select("gram").distinct(), "distinct"))
    texts = docs.select(chunk.alias("chunk"), kept, packed().alias("packed"), F.col("text").isNull().alias("none"))
    kind = texts.schema["kept"].dataType.simpleString()
    none = {"kept": F.lit(None).cast(texts.schema["kept"].dataType), "packed": F.lit(None).cast("binary"), "none": F.lit(None).cast("boolean")}
    answers = asked.join(p, "gram").select("chunk", *[v.alias(c) for c, v in none.items()], "gram", "p")
    rows = texts.select("*", F.lit(None).cast("string").alias("gram"), F.lit(None).cast("double").alias("p"))
    both = answers.unionByName(rows).repartition("chunk").sortWithinPartitions("chunk", F.col("packed").isNotNull())

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, table, grams, p = None, None, [], []
        for batch in batches:
            chunks = batch.column("chunk").to_numpy()
            is_text = batch.column("packed").is_valid().to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((np.diff(chunks) != 0) | (np.diff(is_text.astype(np.int8)) != 0)) + 1), len(chunks)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if chunks[a] != at:
                    at, table, grams, p = chunks[a], None, [], []
                part = batch.slice(a, b - a)
                if not is_text[a]:
                    grams += part.column("gram").to_pylist()
                    p.append(part.column("p").to_numpy())
                    continue
                if table is None:
                    table = Chunk(grams, np.concatenate([*p, np.zeros(0)]))
                    grams, p = [], []
                strings = (zlib.decompress(x.as_py()).decode() for x in part.column("packed"))
                strings = [*strings] if with_text else strings
                loss, length = table.losses(strings, b - a)
                out = {"kept": part.column("kept"), "loss": pa.array(loss), "length": pa.array(length)}
                if with_text:
                    gone = part.column("none").to_numpy(zero_copy_only=False).astype(bool)
                    out["text"] = pa.array(strings, pa.string(), mask=gone)
                yield pa.RecordBatch.from_arrays([*out.values()], names=[*out])

    return both.mapInArrow(summed, f"kept {kind}, loss double, length bigint" + ", text string" * with_text)


def judge_quality(
    docs: DataFrame,
    trusted_ids: DataFrame,
    quantile: float = QUANTILE,
    prior: int = PRIOR,
    margin: float = MARGIN,
    rows: bool = True,
) -> DataFrame:
    """doc_id and lang with perplexity, threshold and keep; with ``rows`` also ``docs`` packed as ``row``."""
    if not rows:
        docs = docs.select("doc_id", "lang", "text")
    scores = saved(score(docs, fit(docs, trusted_ids), rows), "scores")
    scores = scores.withColumns({c: F.col("kept").getField(c) for c in ("doc_id", "lang")})
    known = scores.select("doc_id", "lang", "loss", "length").join(trusted_ids.select("doc_id"), "doc_id", "left_semi")
    known = saved(known, "trusted_scores")
    # One row per language, written: Spark knows their size then and need not deal all documents by language.
    means = known.groupBy("lang").agg((F.sum("loss") / F.greatest(F.sum("length"), F.lit(1))).alias("mean"))
    means = saved(means, "means")
    everywhere = known.agg((F.sum("loss") / F.greatest(F.sum("length"), F.lit(1))).alias("mean")).first()[0] or 0.0

    def rate(loss, length, mean):
        return F.exp((loss + mean * prior) / (length + prior))

    level = F.percentile_approx(rate(F.col("loss"), F.col("length"), F.col("mean")), F.lit(quantile), F.lit(10_000))
    placed = known.join(means.withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l")))
    per_lang = placed.groupBy(F.col("lang").alias("of_lang")).agg(F.first("mean").alias("mean"), level.alias("level"))
    per_lang = saved(per_lang.where("of_lang IS NOT NULL"), "levels")
    at_all = placed.agg(level).first()[0]
    top = float("inf") if at_all is None else float(at_all)
    scored = scores.join(per_lang, F.col("lang") == F.col("of_lang"), "left")
    mean = F.coalesce("mean", F.lit(float(everywhere)))
    fields = [(F.col("text") if c == "text" else F.col("kept").getField(c)).alias(c) for c in docs.columns]
    return (
        scored.withColumn("perplexity", rate(F.col("loss"), F.col("length"), mean))
        .withColumn("threshold", F.coalesce("level", F.lit(top)) * margin)
        .withColumn("keep", (F.col("length") == 0) | (F.col("perplexity") <= F.col("threshold")))
        .select(*[F.struct(*fields).alias("row")] * rows, "doc_id", "lang", "perplexity", "threshold", "keep")
    )
