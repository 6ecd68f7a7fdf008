"""Phrase collocations from exact n-gram counts in counting quotient filters.

Texts are cut into words once. A shard is a run of documents with some ``TOKENS`` words; it is kept
as a stream of numbers and a dictionary of its own words. The dictionaries of all shards meet once:
words that occur at least ``least`` times in their language get dense numbers, and every shard's
stream is rewritten in these. No step needs a dictionary of the whole corpus.

An n-gram of word numbers is packed into 2h bits and permuted by a Feistel network, which is a
bijection. The leading bits of the result are the quotient, the others the remainder, which is kept
in full, so that a filter counts without error and its keys can be turned back into words. A filter
stores its sorted entries: the quotients in unary (one bit per entry and per slot), the remainders
in whole bytes, a byte per count with longer counts apart.

Filters are merged like a radix sort: a shard's filter is cut by the next ``FAN`` bits into pieces;
the pieces of some 2**FAN shards with the same leading bits are merged into one sorted filter, which
is cut again, until one shard is left. The permutation spreads distinct n-grams evenly and a gram is
one entry per filter however often it occurs, so a merged filter is about as large as a shard's, and
every round holds as many pieces as the one before.

A phrase that occurs often enough consists of words that do, and a triple of pairs that do. Pairs are
counted between frequent words only. Triples are counted where both pairs are in a bit map of
the frequent pairs (``BITS`` bits at any size, so false hits grow with the corpus; they cost work and
change nothing, as the triples are counted exactly).

Defined results: a null lang is ``und``; a null or empty text has no words; repeated rows count as
often as they stand; an empty table gives no rows; columns other than lang and text are not read.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.hashing import P, mix
from clientele.llm.staging import salted_join, saved

LEAST, COVER, TOP = 10, 50, 2000
#: Words of a shard; bits by which filters are cut per round; bits of the map of frequent pairs.
TOKENS, FAN, BITS = 1 << 21, 6, 1 << 26
#: Hash buckets in which words are numbered.
BUCKETS = 1024
#: A-Z in lower case, piece ends as line feeds, tabs as spaces.
_LETTERS = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" "
)
_SHARDS = "shard bigint, stream binary, lang string, word string, local int, n bigint"
_FILTER = "shard bigint, prefix bigint, slots int, places binary, upper binary, lower binary, counts binary, more binary"


# --- shards ----------------------------------------------------------------------------


def _shard_rows(shard: int, words: dict[str, dict], stream: array) -> Iterator[pa.RecordBatch]:
    numbers = np.frombuffer(stream, np.uint32)
    uses = np.bincount(numbers)
    names = ["shard", "stream", "lang", "word", "local", "n"]
    kinds = [pa.int64(), pa.binary(), pa.string(), pa.string(), pa.int32(), pa.int64()]
    row = [[shard], [numbers.tobytes()], [None], [None], [None], [None]]
    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)
    for lang, known in words.items():
        local = np.fromiter(known.values(), np.int64, len(known))
        for at in range(0, len(known), 1 << 16):
            part = local[at : at + (1 << 16)]
            spelled = pa.array(list(known)[at : at + (1 << 16)], pa.binary()).cast(pa.string())
            columns = [
                pa.array(np.full(len(part), shard)), pa.nulls(len(part), pa.binary()), pa.array([lang] * len(part)),
                spelled, pa.array(part.astype(np.int32)), pa.array(uses[part]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)


def sharded(docs: DataFrame, tokens: int = TOKENS) -> DataFrame:
    """Per shard one row with its ``stream`` (0 ends a piece) and a row per word with its number there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        stream, words, numbers = array("I"), {}, count(1)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                if lang not in words:
                    words[lang] = defaultdict(numbers.__next__)
                number = words[lang].__getitem__
                for piece in text.as_buffer().to_pybytes().translate(_LETTERS).split(b"\n"):
                    spelled = piece.split(b" ")
                    stream.extend(map(number, filter(None, spelled)))
                    stream.append(0)
                if len(stream) >= tokens:
                    yield from _shard_rows(shard, words, stream)
                    shard, stream, words, numbers = shard + 1, array("I"), {}, count(1)
        if stream:
            yield from _shard_rows(shard, words, stream)

    texts = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )
    return texts.mapInArrow(run, _SHARDS)


def numbered(shards: DataFrame, least: int) -> DataFrame:
    """(shard, local, id, f, lang, word): the frequent words of every shard.

    The uses of a word in all shards are summed where they meet, by one shuffle; f is the sum. Numbers
    are dense but for the spread of the buckets. Only one row of a word carries its spelling.
    """
    found = shards.where("word IS NOT NULL").select("shard", "lang", "word", "local", "n")
    found = found.withColumn("bucket", F.pmod(F.xxhash64("lang", "word"), F.lit(BUCKETS)).cast("int"))
    same = Window.partitionBy("bucket", "lang", "word")
    total = found.repartition("bucket").withColumns(
        {"f": F.sum("n").over(same), "first": F.row_number().over(same.orderBy("shard", "local")) == 1}
    )
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("lang", "word"))
    ranked = total.where(F.col("f") >= least).withColumn("id", (rank.cast("bigint") - 1) * BUCKETS + F.col("bucket") + 1)
    spelled = [F.when(F.col("first"), F.col(c)).alias(c) for c in ("lang", "word")]
    return ranked.select("shard", "local", "id", "f", *spelled)


def number_type(bits: int) -> type:
    return np.uint32 if bits <= 32 else np.uint64


def _rewritten(streams: pa.Table, words: pa.Table, bits: int) -> pa.Table:
    """The shard's stream in numbers of the corpus; 0 stands for the end of a piece and for rare words."""
    shard, out = [], []
    for number, stream in zip(streams["shard"].to_pylist(), streams["stream"]):
        local = np.frombuffer(stream.as_buffer(), np.uint32)
        ids = np.zeros(int(local.max(initial=0)) + 1, number_type(bits))
        ids[words["local"].to_numpy()] = words["id"].to_numpy()
        new = ids[local]
        word = np.concatenate([[False], new != 0, [False]])
        # Words without a neighbour make no phrase; one 0 is as good as many.
        new[~word[:-2] & ~word[2:]] = 0
        new = new[(new != 0) | np.concatenate([[False], new[:-1] != 0])]
        shard.append(number)
        out.append(new.tobytes())
    return pa.table({"shard": pa.array(shard, pa.int64()), "stream": pa.array(out, pa.binary())})


def rewritten(shards: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    streams = shards.where("stream IS NOT NULL").select("shard", "stream")
    met = streams.groupBy("shard").cogroup(words.select("shard", "local", "id").groupBy("shard"))
    return met.applyInArrow(lambda left, right: _rewritten(left, right, bits), "shard bigint, stream binary")


# --- filters ---------------------------------------------------------------------------


def half_bits(size: int, bits: int) -> int:
    """Half of the bits of a packed gram of ``size`` numbers of ``bits`` bits, rounded up."""
    return (size * bits + 1) // 2


def packed(ids: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of the packed grams."""
    if len(ids) == 2:
        return ids[0], ids[1]
    low = np.uint64(2 * bits - half_bits(3, bits))  # bits of the middle number in the lower half
    a, m, c = ids
    upper = (a << np.uint64(bits - int(low))) | (m >> low)
    return upper, ((m & ((np.uint64(1) << low) - np.uint64(1))) << np.uint64(bits)) | c


def unpacked(upper: np.ndarray, lower: np.ndarray, size: int, bits: int) -> list[np.ndarray]:
    if size == 2:
        return [upper, lower]
    low, b = np.uint64(2 * bits - half_bits(3, bits)), np.uint64(bits)
    high = np.uint64(bits - int(low))
    middle = ((upper & ((np.uint64(1) << high) - np.uint64(1))) << low) | (lower >> b)
    return [upper >> high, middle, lower & ((np.uint64(1) << b) - np.uint64(1))]


def _round(x: np.ndarray, turn: int, half: int) -> np.ndarray:
    return mix(x + np.uint64(int(P) * (turn + 1) % (1 << 64))) & np.uint64((1 << half) - 1)


def permuted(upper: np.ndarray, lower: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """A bijection of 2 * ``half`` bits: four rounds of a Feistel network."""
    for turn in range(4):
        upper, lower = lower, upper ^ _round(lower, turn, half)
    return upper, lower


def restored(upper: np.ndarray, lower: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for turn in reversed(range(4)):
        upper, lower = lower ^ _round(upper, turn, half), upper
    return upper, lower


Entries = tuple[np.ndarray, np.ndarray, np.ndarray]


def tallied(upper: np.ndarray, lower: np.ndarray, counts: np.ndarray | None, half: int) -> Entries:
    """Entries in order of their permuted bits, equal ones added up. Runs that are in order are merged."""
    if not len(upper):
        return upper, lower, np.zeros(0, np.int64)
    if 2 * half <= 64:
        order = np.argsort((upper << np.uint64(half)) | lower, kind="stable")
    else:
        order = np.lexsort((lower, upper))
    upper, lower = upper[order], lower[order]
    new = np.concatenate([[True], (upper[1:] != upper[:-1]) | (lower[1:] != lower[:-1])])
    starts = np.flatnonzero(new)
    sums = np.diff(np.append(starts, len(upper))) if counts is None else np.add.reduceat(counts[order], starts)
    return upper[starts], lower[starts], sums.astype(np.int64)


def _to_bytes(x: np.ndarray, bits: int) -> bytes:
    """The lowest bits of every number, in as few whole bytes as hold them."""
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)].tobytes()


def _from_bytes(data: pa.Buffer, n: int, bits: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    width = -(-bits // 8)
    if width:
        out[:, :width] = np.frombuffer(data, np.uint8).reshape(n, width)
    return out.view("<u8").ravel().astype(np.uint64)


def filter_rows(shard: int, entries: Entries, half: int, depth: int, prefix: int, fan: int) -> list[tuple]:
    """Filters of sorted entries whose first ``depth`` bits are ``prefix``, cut by the next ``fan`` bits."""
    upper, lower, counts = entries
    if depth + fan > half:
        fan = max(half - depth, 0)
    cuts = (np.uint64(prefix) << np.uint64(fan)) + np.arange((1 << fan) + 1, dtype=np.uint64)
    top = upper >> np.uint64(half - depth - fan)
    ends, rows = np.searchsorted(top, cuts), []
    for k in range(1 << fan):
        a, b = int(ends[k]), int(ends[k + 1])
        if a == b:
            continue
        rest = half - depth - fan
        # About one slot per entry.
        slots = min(rest, max(b - a, 1).bit_length())
        quotient = (upper[a:b] >> np.uint64(rest - slots)) & np.uint64((1 << slots) - 1)
        bits = np.zeros((1 << slots) + b - a, np.uint8)
        bits[quotient.astype(np.int64) + np.arange(b - a)] = 1
        tail = upper[a:b] & np.uint64((1 << (rest - slots)) - 1)
        n = counts[a:b]
        rows.append(
            (
                shard, int(cuts[k]), slots, np.packbits(bits).tobytes(), _to_bytes(tail, rest - slots),
                _to_bytes(lower[a:b], half), np.minimum(n, 255).astype(np.uint8).tobytes(), n[n >= 255].tobytes(),
            )
        )
    return rows


def read_filter(row: dict[str, pa.Scalar], half: int, depth: int) -> Entries:
    """The entries of a filter whose keys share their first ``depth`` bits."""
    counts = np.frombuffer(row["counts"].as_buffer(), np.uint8).astype(np.int64)
    n, slots, rest = len(counts), row["slots"].as_py(), half - depth
    counts[counts == 255] = np.frombuffer(row["more"].as_buffer(), np.int64)
    bits = np.unpackbits(np.frombuffer(row["places"].as_buffer(), np.uint8))
    quotient = (np.flatnonzero(bits) - np.arange(n)).astype(np.uint64)
    tail = _from_bytes(row["upper"].as_buffer(), n, rest - slots)
    upper = (np.uint64(row["prefix"].as_py()) << np.uint64(rest)) | (quotient << np.uint64(rest - slots)) | tail
    return upper, _from_bytes(row["lower"].as_buffer(), n, half), counts


def _filter_table(rows: list[tuple]) -> pa.Table:
    names = ["shard", "prefix", "slots", "places", "upper", "lower", "counts", "more"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 5]
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds)})


def pair_spots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The places of pairs of word numbers in the bit map."""
    return mix(mix(a) * P + b) % np.uint64(BITS)


def shard_filters(streams: DataFrame, size: int, bits: int, pairs=None, fan: int = FAN) -> DataFrame:
    """Filters of the grams of every shard; of triples those whose pairs the broadcast bit map has."""
    half = half_bits(size, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, stream in zip(batch.column("shard").to_pylist(), batch.column("stream")):
                ids = np.frombuffer(stream.as_buffer(), number_type(bits)).astype(np.uint64)
                good = (ids[:-1] != 0) & (ids[1:] != 0)
                if size == 3:
                    spot = pair_spots(ids[:-1], ids[1:])
                    word = pairs.value[(spot >> np.uint64(6)).astype(np.int64)]
                    good &= (word >> (spot & np.uint64(63))) & np.uint64(1) == 1
                    good = good[:-1] & good[1:]
                at = np.flatnonzero(good)
                halves = permuted(*packed([ids[at + k] for k in range(size)], bits), half)
                yield from _filter_table(filter_rows(shard, tallied(*halves, None, half), half, 0, 0, fan)).to_batches()

    return streams.select("shard", "stream").mapInArrow(run, _FILTER)


def merge_filters(filters: DataFrame, shards: int, half: int, label: str, fan: int = FAN) -> tuple[DataFrame, int]:
    """The filters of all shards as one, in pieces by their leading bits; and how many bits lead."""
    depth, turn = min(fan, half), 0
    while shards > 1:
        shards, turn = -(-shards // (1 << fan)), turn + 1
        next_fan = min(fan, half - depth) if shards > 1 else 0
        merge = _merger(half, depth, next_fan)
        group = F.pmod(F.xxhash64("shard", F.lit(turn)), F.lit(shards)).alias("group")
        filters = saved(filters.groupBy(group, "prefix").applyInArrow(merge, _FILTER), label)
        depth += next_fan
    return filters, depth


def _merger(half: int, depth: int, fan: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        group, prefix = (k.as_py() for k in key)
        parts = [read_filter(dict(zip(table.column_names, r)), half, depth) for r in zip(*table.columns)]
        entries = tallied(*(np.concatenate(c) for c in zip(*parts)), half)
        return _filter_table(filter_rows(group, entries, half, depth, prefix, fan))

    return merge


def frequent_grams(filters: DataFrame, size: int, bits: int, depth: int, least: int) -> DataFrame:
    """(w1, w2[, w3], f) and, for pairs, their ``spot`` in the bit map."""
    half = half_bits(size, bits)
    names = [f"w{k + 1}" for k in range(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns):
                upper, lower, counts = read_filter(dict(zip(batch.schema.names, row)), half, depth)
                often = counts >= least
                ids = unpacked(*restored(upper[often], lower[often], half), size, bits)
                columns = [pa.array(i.astype(np.int64)) for i in ids] + [pa.array(counts[often])]
                if size == 2:
                    columns.append(pa.array(pair_spots(*ids).astype(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, [*names, "f", *(["spot"] if size == 2 else [])])

    extra = ", spot bigint" if size == 2 else ""
    return filters.mapInArrow(run, ", ".join(f"{n} bigint" for n in names) + ", f bigint" + extra)


def bit_map(pairs: DataFrame) -> np.ndarray:
    """The map of the frequent pairs; ``BITS`` bits, so at most ``BITS`` / 64 rows reach the driver."""
    one = F.expr("shiftleft(1L, CAST(spot % 64 AS INT))")
    words = pairs.groupBy(F.expr("spot DIV 64").alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(BITS // 64, np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


# --- scores ----------------------------------------------------------------------------


def _score(a: str, left: str, right: str):
    """floor(1000000 a a / (l r)), exact up to 38 digits."""
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    top = (whole(a) * whole(a)).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), (whole(left) * whole(right)).cast("decimal(38,0)"))


def collocations(
    docs: DataFrame, least: int = LEAST, cover: int = COVER, top: int = TOP, tokens: int = TOKENS, fan: int = FAN
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two and three words per language."""
    spark = docs.sparkSession
    shards = saved(sharded(docs, tokens), "shards")
    used = shards.where("word IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    words = saved(numbered(shards, least), "words")
    spelled = words.where("word IS NOT NULL").select("id", "f", "lang", "word")
    bits = int(words.agg(F.coalesce(F.max("id"), F.lit(1))).first()[0]).bit_length()
    streams = saved(rewritten(shards, words, bits), "streams")
    n_shards = streams.count()

    def counted(size: int, pairs=None) -> DataFrame:
        label, half = f"grams{size}", half_bits(size, bits)
        filters = saved(shard_filters(streams, size, bits, pairs, fan), label)
        filters, depth = merge_filters(filters, n_shards, half, label, fan)
        return saved(frequent_grams(filters, size, bits, depth, least), f"frequent{size}")

    two = counted(2)
    pairs = spark.sparkContext.broadcast(bit_map(two))
    three = counted(3, pairs)
    pairs.destroy()
    two = two.drop("spot")

    def with_word(grams: DataFrame, word: str, name: str, *more: str) -> DataFrame:
        """The count of a word of each gram as ``name``; many grams may share it."""
        few = spelled.select(F.col("id").alias(word), F.col("f").alias(name), *more)
        return salted_join(grams, few, word, "w2" if word != "w2" else "w1")

    pair_counts = two.select(F.col("w1").alias("p1"), F.col("w2").alias("p2"), F.col("f").alias("pf"))
    inside = three.select("f", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"))
    inside = inside.groupBy(F.col("p.w1").alias("p1"), F.col("p.w2").alias("p2")).agg(F.max("f").alias("longest"))
    free = two.join(inside, (F.col("w1") == F.col("p1")) & (F.col("w2") == F.col("p2")), "left").where(
        F.expr(f"longest IS NULL OR 100 * longest < {int(cover)} * f")
    )
    free = with_word(with_word(free.select("w1", "w2", F.lit(None).cast("bigint").alias("w3"), "f"), "w1", "l", "lang"), "w2", "r")
    free = free.withColumn("score", _score("f", "l", "r"))

    # Pairs inside triples: a join on both words, whose keys repeat once per third word.
    tail = pair_counts.toDF("w2", "w3", "r1")
    head = pair_counts.toDF("w1", "w2", "l2")
    cut = three.join(tail, ["w2", "w3"]).join(head, ["w1", "w2"])
    cut = with_word(with_word(cut, "w1", "l1", "lang"), "w3", "r2")
    cut = cut.withColumns({"s1": _score("f", "l1", "r1"), "s2": _score("f", "l2", "r2")})
    early = F.col("s1") <= F.col("s2")
    cut = cut.select(
        "lang", "w1", "w2", "w3", "f", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    every = free.select(cut.columns).unionByName(cut)
    # Ties of the last place stay until their spelling is known.
    order = [F.desc("score"), F.desc("f")]
    best = every.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top)
    for k in (1, 2, 3):
        few = spelled.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"t{k}"))
        best = best.join(few, f"w{k}", "left")
    best = best.withColumn("phrase", F.concat_ws(" ", "t1", "t2", "t3"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    best = best.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= top)
    return best.join(used, "lang").select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")
