"""Near-duplicate classes by BagMinHash signatures, bands and verified multiset overlap.

A text is the multiset of its five-word shingles (fewer words: one shingle). BagMinHash splits the
weight axis of a shingle into intervals [0,1), [1,2), [2,4), ...; each carries a Poisson process in
time whose points fall on a weight and on a component of the signature. A component keeps the
earliest point below the shingle's weight, so two texts agree in a component with a probability
equal to their weighted Jaccard similarity. ``BANDS`` bands of ``ROWS`` components give candidates:
a pair at similarity 0.8 shares a bucket with probability 0.99997.

Equal texts are one node (their md5), so copies meet once. In the first round every member of a
bucket meets the bucket's most connected node, in a group of near copies mostly their origin.
Linked nodes form classes, and what remains apart goes on: buckets that still hold several classes
are cut into chunks of some ``CHUNK`` nodes, by another hash in every band and round, and every node
outside the chunk's main class is paired with its ``NEAREST`` nodes of other classes by the share of
equal signature components, until a round finds no link. These rounds only shorten what comes last:
every node outside its bucket's main class meets all nodes of other classes in the bucket, blocks of
some ``CHUNK`` against each other, one group of rows per two blocks. There
texts go along and are verified in place, so no pair is a row; what is returned is one link per two
classes. No pair of different classes that share a bucket and reach ``PROMISING`` is left untested.
Compared pairs are verified on the exact weighted Jaccard similarity of the whole texts.

Defined results: a null text counts as empty; texts without words are one node per spelling and
meet only equal texts; the class is the smallest doc_id among its rows (null if all are null);
repeated rows stay repeated; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.llm.hashing import P, mix, shingle_hashes, word_hashes
from clientele.session import session_settings, work_dir

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 4
SIZE = BANDS * ROWS
#: So many shingles are hashed at a time, and so many bytes of text sent to a Python worker at once.
SIDE_BY_SIDE, BATCH_BYTES = 50_000, 8 << 20
#: Nodes compared side by side, partners proposed per node and chunk, and the least share of equal
#: components (at similarity 0.8 it falls below this once in 10,000 pairs).
CHUNK, NEAREST, PROMISING = 2048, 3, 0.63
#: Bytes of text in a block of the last pass.
BYTES = 32 << 20


def shingle_bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of a text in order of their hash, and how often each occurs."""
    return np.unique(shingle_hashes(word_hashes(text), WORDS), return_counts=True)


def uniform(seed: np.ndarray) -> np.ndarray:
    return ((seed >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def bag_minhash(bags: list[tuple[np.ndarray, np.ndarray]], size: int = SIZE) -> np.ndarray:
    """One signature per bag (distinct shingles, weights): per component the name of its earliest point.

    The bags are worked on side by side; none may be empty.
    """
    values = np.concatenate([v for v, _ in bags])
    weights = np.concatenate([w for _, w in bags])
    owner = np.repeat(np.arange(len(bags)), [len(v) for v, _ in bags])
    total = np.bincount(owner, weights)
    # Processes: every interval of the weight axis that begins below the shingle's weight.
    which, low, width, level, begin = [np.arange(len(values))], [np.zeros(len(values))], [np.ones(len(values))], 1, 1
    seeds = [mix(values)]
    while len(high := np.flatnonzero(weights > begin)):
        which.append(high)
        seeds.append(mix(values[high] + np.array([level], np.uint64) * P))
        low.append(np.full(len(high), float(begin)))
        width.append(np.full(len(high), float(begin)))
        level, begin = level + 1, begin * 2
    which, seeds, low, width = map(np.concatenate, (which, seeds, low, width))
    limit, owner = weights[which], owner[which]
    out = np.zeros((len(bags), size), np.uint64)
    todo = np.ones(len(bags), bool)
    # Points up to a horizon: hardly a component is still empty there; if one is, look further.
    horizon = (math.log(size) + 4) / total
    while todo.any():
        alive = np.flatnonzero(todo[owner])
        t, step = np.zeros(len(alive)), 0
        times, slots, names = [], [], []
        while len(alive):
            step += 1
            name = mix(seeds[alive] ^ (np.array([step], np.uint64) * P))
            t -= np.log(uniform(name)) / (size * width[alive])
            near = t <= horizon[owner[alive]]
            alive, t, name = alive[near], t[near], name[near]
            spot = mix(name + P)
            cell = low[alive]
            wide = np.flatnonzero(width[alive] > 1)
            cell[wide] += np.floor(uniform(mix(spot[wide] + P)) * width[alive[wide]])
            good = cell < limit[alive]
            times.append(t[good])
            slots.append(owner[alive[good]] * size + (spot[good] % np.uint64(size)).astype(np.int64))
            names.append(name[good])
        times, slots, names = map(np.concatenate, (times, slots, names))
        order = np.argsort(-times, kind="stable")
        flat, filled = np.zeros(out.size, np.uint64), np.zeros(out.size, bool)
        flat[slots[order]] = names[order]  # the earliest is written last
        filled[slots] = True
        ready = todo & filled.reshape(out.shape).all(axis=1)
        out[ready] = flat.reshape(out.shape)[ready]
        todo &= ~ready
        horizon = horizon * 2
    return out


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    """BANDS hashes per signature, one after the other."""
    rows = signatures.reshape(-1, BANDS, ROWS)
    out = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(rows), 1))
    for k in range(ROWS):
        out = mix(out * P + rows[:, :, k])
    return out.ravel().view(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("node"))


def signatures(texts: pa.Array) -> Iterator[tuple[list[int], np.ndarray]]:
    """The places of the texts that have words and their signatures, some ``SIDE_BY_SIDE`` shingles at a time."""
    bags, which, held = [], [], 0
    for i, text in enumerate(texts):
        bag = shingle_bag(text.as_buffer())
        if len(bag[0]):
            bags.append(bag)
            which.append(i)
            held += len(bag[0])
        if bags and (held > SIDE_BY_SIDE or i + 1 == len(texts)):
            yield which, bag_minhash(bags)
            bags, which, held = [], [], 0


def banded(texts: DataFrame) -> DataFrame:
    """(band, node), BANDS rows per text that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for which, found in signatures(batch.column("text")):
                nodes = batch.column("node").take(pa.array(np.repeat(which, BANDS)))
                yield pa.RecordBatch.from_arrays([pa.array(band_hashes(found)), nodes], ["band", "node"])

    as_bytes = texts.select(F.col("text").cast("binary").alias("text"), "node")
    return as_bytes.mapInArrow(run, "band bigint, node binary")


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    every = a[1].sum() + b[1].sum() - both
    return float(both / every) if every else 1.0


@F.pandas_udf(T.DoubleType())
def overlap(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in batches:
        out, last, bag = [], None, None
        for a, b in zip(left, right):
            if a != last:
                last, bag = a, shingle_bag(a)
            out.append(weighted_jaccard(bag, shingle_bag(b)))
        yield pd.Series(out, dtype="float64")


@F.pandas_udf(T.DoubleType())
def alike(left: pd.Series, right: pd.Series) -> pd.Series:
    """Share of equal bytes of two sketches."""
    a, b = (np.frombuffer(b"".join(map(bytes, x)), np.uint8).reshape(-1, SIZE) for x in (left, right))
    return pd.Series((a == b).mean(axis=1))


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    folder, schema = work_dir(df.sparkSession, label), df.schema
    df.write.parquet(folder)
    return df.sparkSession.read.schema(schema).parquet(folder)


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, class): the smallest node reachable over ``links`` (a, b)."""
    both = saved(links.union(links.select("b", "a")).distinct(), "edges")
    labels = nodes.select("node", F.col("node").alias("class"))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("class").alias("near"))
        low = labels.join(near, F.col("node") == F.col("a"), "left").select(
            "node", F.col("class").alias("old"), F.least("class", F.coalesce("near", "class")).alias("class")
        )
        # A label's own label is at least as small: paths halve with every round.
        jump = low.select(F.col("node").alias("class"), F.col("class").alias("next"))
        low = saved(
            low.join(jump, "class").select("node", "old", F.least("class", "next").alias("class")), "labels"
        )
        labels = low.select("node", "class")
        if low.where("old != class").isEmpty():
            return labels


def with_sketch(bodies: DataFrame) -> DataFrame:
    """(node, text, sketch): one byte per component of the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for which, found in signatures(batch.column("text")):
                held = [batch.column(c).take(pa.array(which)) for c in ("node", "text")]
                sketches = pa.array([row.tobytes() for row in found.astype(np.uint8)], pa.binary())
                yield pa.RecordBatch.from_arrays([*held, sketches], ["node", "text", "sketch"])

    return bodies.mapInArrow(run, "node binary, text binary, sketch binary")


def promising(table: pa.Table) -> pa.Table:
    """Pairs (a, b) of a chunk: nodes outside its main class and their nearest in other classes."""
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, SIZE)
    kind = np.unique(np.array(table["class"].to_pylist(), object), return_inverse=True)[1]
    main = np.bincount(kind).argmax()
    ask = np.flatnonzero(kind != main)
    rows, others = [], []
    for part in np.array_split(ask, 1 + len(ask) // 512):
        same = np.zeros((len(part), len(kind)), np.uint8)
        for k in range(SIZE):
            same += sketch[part, k][:, None] == sketch[:, k][None, :]
        same[kind[part][:, None] == kind[None, :]] = 0
        top = np.argsort(same, axis=1, kind="stable")[:, -NEAREST:]
        x, y = np.nonzero(np.take_along_axis(same, top, 1) >= PROMISING * SIZE)
        rows.append(part[x])
        others.append(top[x, y])
    rows, others = np.concatenate(rows), np.concatenate(others)
    nodes = table["node"].combine_chunks()
    return pa.table({"a": nodes.take(pa.array(rows)), "b": nodes.take(pa.array(others))})


def links_between(table: pa.Table) -> pa.Table:
    """Links (a, b) of a block of asking nodes with a block of nodes: one per two classes that any pair links."""
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, SIZE)
    kind = np.unique(np.array(table["class"].to_pylist(), object), return_inverse=True)[1]
    asks, texts = table["asks"].to_numpy(), table["text"].combine_chunks()
    ask, met = np.flatnonzero(asks), np.flatnonzero(~asks)
    columns, bags, found = np.ascontiguousarray(sketch[met].T), {}, {}
    for x in ask:
        same = np.zeros(len(met), np.uint8)
        for k in range(SIZE):
            same += columns[k] == sketch[x, k]
        near = met[(same >= PROMISING * SIZE) & (kind[met] != kind[x])]
        near = [y for y in near if (kind[x], kind[y]) not in found]
        if not near:
            continue
        for y in near:
            if y not in bags:
                bags[y] = shingle_bag(texts[int(y)].as_buffer())
        values, counts = shingle_bag(texts[int(x)].as_buffer())
        others, weights = (np.concatenate([bags[y][k] for y in near]) for k in (0, 1))
        at = np.minimum(np.searchsorted(values, others), len(values) - 1)
        both = np.where(values[at] == others, np.minimum(counts[at], weights), 0)
        begin = np.concatenate([[0], np.cumsum([len(bags[y][0]) for y in near])[:-1]])
        both, every = np.add.reduceat(both, begin), np.add.reduceat(weights, begin) + counts.sum()
        for i in np.flatnonzero(both / (every - both) >= SIMILARITY - 1e-12):
            found.setdefault((kind[x], kind[near[i]]), (x, near[i]))
    pairs = np.array(list(found.values()), np.int64).reshape(-1, 2)
    nodes = table["node"].combine_chunks()
    return pa.table({"a": nodes.take(pa.array(pairs[:, 0])), "b": nodes.take(pa.array(pairs[:, 1]))})


def remaining_links(placed: DataFrame) -> DataFrame:
    """(a, b): a verified link for any two classes that a pair in a common bucket links.

    placed: (band, node, class, sketch, text). One of two classes is not the bucket's main one, so it is
    enough that the nodes outside it meet all others. A node that asks is sent to every block of
    nodes, a node to every block of those that ask; texts go along, so that no pair becomes a row.
    """
    size = F.octet_length("text")
    sizes = placed.groupBy("band", "class").agg(F.count("*").alias("size"), F.sum(size).alias("bytes"))
    most = F.max(F.struct("size", "class", "bytes"))
    bands = sizes.groupBy(F.col("band").alias("of")).agg(
        most["class"].alias("main"),
        F.ceil(F.greatest(F.sum("size") / CHUNK, F.sum("bytes") / BYTES)).alias("blocks"),
        F.ceil(
            F.greatest((F.sum("size") - most["size"]) / CHUNK, (F.sum("bytes") - most["bytes"]) / BYTES)
        ).alias("ask_blocks"),
    )
    rows = placed.join(bands, F.col("band") == F.col("of"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    kept = ["band", "node", "class", "sketch", "text"]
    met = rows.select(
        *kept, F.lit(False).alias("asks"), F.pmod(F.xxhash64("node", "band"), "blocks").alias("y"), every("ask_blocks").alias("x")
    )
    ask = rows.where("class != main").select(
        *kept, F.lit(True).alias("asks"), every("blocks").alias("y"), F.pmod(F.xxhash64("band", "node"), "ask_blocks").alias("x")
    )
    return met.unionByName(ask).groupBy("band", "x", "y").applyInArrow(links_between, "a binary, b binary")


def classes_of_nodes(texts: DataFrame) -> DataFrame:
    """(node, class) of the nodes that share a bucket with another text; every step is written before it returns."""
    with session_settings(texts.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        return _classes_of_nodes(texts)


def _classes_of_nodes(texts: DataFrame) -> DataFrame:
    bands = banded(texts).distinct()
    full = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = saved(bands.join(full, "band"), "buckets")
    nodes = saved(members.groupBy("node").agg(F.sum("n").alias("degree")), "nodes")
    # One text per node; further rows of the same text would only repeat a pair.
    first = texts.groupBy("node").agg(F.min("doc_id").alias("first")).join(nodes.select("node"), "node")
    on = (F.col("node") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first"))
    # Rows equal in id and text are one body.
    bodies = texts.join(first.withColumnRenamed("node", "of"), on).dropDuplicates(["node", "doc_id"])
    bodies = saved(with_sketch(bodies.select("node", F.col("text").cast("binary").alias("text"))), "bodies")
    labels = nodes.select("node", F.col("node").alias("class"))

    heads = members.join(nodes, "node").groupBy("band").agg(F.max(F.struct("degree", "node"))["node"].alias("head"))
    pairs = members.join(heads, "band").where("node != head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    tested, turn = None, 0
    while True:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        # Texts are fetched for pairs whose signatures allow the similarity.
        for end in ("a", "b"):
            pairs = pairs.join(bodies.select(F.col("node").alias(end), F.col("sketch").alias(f"sketch_{end}")), end)
        pairs = pairs.where(alike("sketch_a", "sketch_b") >= PROMISING).select("a", "b")
        left = bodies.select(F.col("node").alias("a"), F.col("text").alias("left"))
        right = bodies.select(F.col("node").alias("b"), F.col("text").alias("right"))
        judged = pairs.join(left, "a").join(right, "b").select("a", "b", overlap("left", "right").alias("likeness"))
        judged = saved(judged.distinct(), "judged")
        new = judged.where(F.col("likeness") >= SIMILARITY - 1e-12).select("a", "b")
        last = new.isEmpty()
        if not last:
            tested = judged.select("a", "b") if tested is None else tested.union(judged.select("a", "b"))
            labels = merged(labels, new)
            turn += 1
        placed = members.join(labels, "node")
        several = placed.groupBy("band").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi")
        placed = placed.join(several.select("band"), "band")
        if last:
            new = saved(remaining_links(placed.join(bodies, "node").select("band", "node", "class", "sketch", "text")), "links")
            return labels if new.isEmpty() else merged(labels, new)
        chunk = F.pmod(F.xxhash64("node", "band", F.lit(turn)), F.ceil(F.col("n") / CHUNK))
        placed = placed.join(bodies.select("node", "sketch"), "node")
        chunks = placed.select("band", chunk.alias("chunk"), "node", "class", "sketch").groupBy("band", "chunk")
        pairs = chunks.applyInArrow(promising, "a binary, b binary")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, class) after ``links`` (a, b) between nodes have joined their classes."""
    ends = links.join(labels.select(F.col("node").alias("a"), F.col("class").alias("ca")), "a").join(
        labels.select(F.col("node").alias("b"), F.col("class").alias("cb")), "b"
    )
    ends = ends.select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    tops = components(labels.select(F.col("class").alias("node")).distinct(), ends)
    tops = tops.select(F.col("node").alias("class"), F.col("class").alias("top"))
    return saved(labels.join(tops, "class").select("node", F.col("top").alias("class")), "classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_rows) per row of ``docs``."""
    texts = keyed(docs)
    labels = classes_of_nodes(texts).withColumnRenamed("node", "of_node")
    placed = texts.select("doc_id", "node").join(labels, F.col("node") == F.col("of_node"), "left")
    placed = placed.select("doc_id", F.coalesce("class", "node").alias("class"))
    heads = placed.groupBy(F.col("class").alias("of")).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_rows"))
    return placed.join(heads, F.col("class") == F.col("of")).select("doc_id", "class_id", "class_rows")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without all but one row of each class: the smallest doc_id, then the smallest text."""
    texts = keyed(docs)
    labels = classes_of_nodes(texts).withColumnRenamed("node", "of_node")
    placed = texts.select("doc_id", "node").join(labels, F.col("node") == F.col("of_node"), "left")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    kept = placed.groupBy(F.coalesce("class", "node")).agg(F.min(order).alias("kept"))
    kept = kept.select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.node").alias("kept_node"))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("id"),
        F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("node"),
    )
    on = (F.col("node") == F.col("kept_node")) & F.col("id").eqNullSafe(F.col("kept_id"))
    # Rows equal in id and text remain once.
    return rows.join(kept, on, "left_semi").dropDuplicates(["node", "id"]).select("row.*")
