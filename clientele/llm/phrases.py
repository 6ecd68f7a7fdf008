"""Document fingerprints by locally consistent parsing.

A text is parsed into a hierarchy of phrases: runs of one symbol become one symbol; deterministic
coin tossing (the lowest bit in which a symbol differs from its left neighbour, four times) labels
symbols by a few neighbours only; phrases begin at local maxima of the labels; a phrase's name is a
hash of its symbols. So equal substrings share all phrases but a few at their edges, wherever they
stand. The fingerprint is the name of the root and the ``KEEP`` smallest names of phrases of level
``LEVEL`` and above; likeness is the Jaccard estimate of these bottom sketches.

Documents are dealt by range of doc_id, so the next document is the next row or the first row of
the next partition; texts move once. Many texts are parsed side by side in one array.

Defined results: a null text counts as empty, with its own root and no phrases; two empty texts are
alike (1), an empty and another are not (0); equal texts have equal fingerprints; rows of one doc_id
are ordered by text, null ids come last; a single row is its own next document; long texts are
parsed in whole; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.hashing import P, mix, powers

LEVEL, KEEP, SIDE_BY_SIDE = 2, 64, 400_000
SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)
SYMBOLS = mix(np.arange(1, 0x10000 + 1, dtype=np.uint64) * P)


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = codes > 0xFFFF
    names = SYMBOLS[np.where(wide, 0, codes)]
    names[wide] = mix((codes[wide].astype(np.uint64) + np.uint64(1)) * P)
    return names


def coin_toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6, different for neighbours, from a symbol and four to its left."""
    label = names
    for _ in range(4):
        left = np.concatenate([label[:1], label[:-1]])
        left[first] = ~label[first]  # the first of a text tosses against its complement
        differ = label ^ left
        low = differ & (~differ + np.uint64(1))
        place = np.bitwise_count(low - np.uint64(1)).astype(np.uint64)
        label = np.uint64(2) * place + ((label >> place) & np.uint64(1))
    return label


def next_level(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and owners of the phrases over a level's symbols; no phrase crosses texts."""
    change = np.concatenate([[True], (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])])
    starts = np.flatnonzero(change)
    lengths = np.diff(np.append(starts, len(names)))
    names, owner = names[starts], owner[starts]
    long = lengths > 1
    names[long] = mix(names[long] ^ mix(lengths[long].astype(np.uint64)))
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    last = np.append(first[1:], True)
    label = coin_toss(names, first).astype(np.int8)
    peak = np.zeros(len(names), bool)
    peak[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    begin = np.flatnonzero(first | (peak & ~last))
    up, down = powers(len(names))
    sums = np.add.reduceat(names * up, begin) * down[begin]
    sizes = np.diff(np.append(begin, len(names))).astype(np.uint64)
    return mix(sums + sizes), owner[begin]


def fingerprints(texts: list[str]) -> list[tuple[int, np.ndarray]]:
    """(root, smallest phrase names) of each text."""
    parts = [symbols(t) for t in texts]
    roots = np.zeros(len(texts), np.uint64)
    sketches: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
    names = np.concatenate([*parts, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    kept, of, level = [], [], 0
    while len(names):
        names, owner = next_level(names, owner)
        level += 1
        if level >= LEVEL:
            kept.append(names)
            of.append(owner)
        counts = np.bincount(owner, minlength=len(texts))
        single = counts[owner] == 1
        roots[owner[single]] = names[single]
        if level >= LEVEL:
            names, owner = names[~single], owner[~single]
        elif single.any():  # short texts have their root as their only phrase
            kept.append(names[single])
            of.append(owner[single])
            names, owner = names[~single], owner[~single]
    if kept:
        short, whose = (np.concatenate(kept) >> np.uint64(32)).astype(np.uint32), np.concatenate(of)
        key = np.unique((whose.astype(np.uint64) << np.uint64(32)) | short)
        whose = (key >> np.uint64(32)).astype(np.int64)
        begin = np.searchsorted(whose, np.arange(len(texts) + 1))
        for i in range(len(texts)):
            sketches[i] = key[begin[i] : min(begin[i + 1], begin[i] + KEEP)].astype(np.uint32)
    return [(int(r), s) for r, s in zip(roots, sketches)]


def written(mark: tuple[int, np.ndarray]) -> str:
    return f"{mark[0]:016x}:" + mark[1].astype(">u4").tobytes().hex()


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Share of common names among the smallest of both; exact where all names are kept."""
    if a[0] == b[0]:
        return 1.0
    if not len(a[1]) or not len(b[1]):
        return 0.0
    union, times = np.unique(np.concatenate([a[1], b[1]]), return_counts=True)
    k = len(union) if max(len(a[1]), len(b[1])) < KEEP else min(KEEP, len(union))
    return float((times[:k] == 2).sum() / k)


def compared(rows: list[tuple[int | None, str]]) -> dict[str, list]:
    """The result rows of all but the last of ``rows``, each with the row after it as its next."""
    texts = [t for _, t in rows]
    edited = []
    for text, following in zip(texts, texts[1:]):
        half = len(text) // 2
        edited.append(text[: len(text) - half] + following[:half])
    marks = fingerprints(texts)
    changed = fingerprints(edited)
    out: dict[str, list] = {name.split()[0]: [] for name in SCHEMA.split(", ")}
    for i, text in enumerate(edited):
        values = (
            rows[i][0],
            len(texts[i]),
            hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
            written(marks[i]),
            written(changed[i]),
            likeness(marks[i], changed[i]),
            likeness(marks[i], marks[i + 1]),
        )
        for name, value in zip(out, values):
            out[name].append(value)
    return out


def _batch(out: dict[str, list]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
    types = [kinds[x.split()[1]] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str]]:
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            yield doc_id.as_py(), text.as_py()


def _inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a partition but its last, whose next stands in another partition."""
    held: list[tuple[int | None, str]] = []
    size = 0
    for row in _rows(batches):
        held.append(row)
        size += len(row[1]) + 64
        if size > SIDE_BY_SIDE and len(held) > 1:
            yield _batch(compared(held))
            held, size = held[-1:], len(row[1])
    if len(held) > 1:
        yield _batch(compared(held))


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last row of a partition."""
    first = last = None
    for last in _rows(batches):
        first = first or last
    if first is not None:
        part = TaskContext.get().partitionId()
        columns = [[part], [first[1]], [last[0]], [last[1]]]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.string()]
        names = ["part", "first_text", "last_id", "last_text"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield _batch(compared([(row["last_id"], row["last_text"]), (None, row["next_text"])]))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """SCHEMA per row of ``docs``: fingerprints of the text and of the edited text, likenesses."""
    # A fixed number of partitions, so that both uses below read the same ones.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    by = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text").asc()]
    ordered = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by, F.col("text").asc())
    inner = ordered.mapInArrow(_inner, SCHEMA)
    edges = ordered.mapInArrow(_edges, "part int, first_text string, last_id bigint, last_text string")
    # One row per partition: the only rows that a window over all of them sees.
    line = Window.orderBy("part")
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nexts = F.coalesce(F.lead("first_text").over(line), F.first("first_text").over(whole))
    return inner.unionByName(edges.withColumn("next_text", nexts).mapInArrow(_paired, SCHEMA))
