"""Removal of byte strings that also begin in a document with a smaller doc_id.

Suffixes are compared by sorted, front-coded runs that documents exchange, in three rounds, each of
which looks further into the suffixes that the round before left tied and never again at what is
known to be common:

1. Of every string of ``LENGTH`` bytes one suffix is chosen, the one whose first ``GRAM`` bytes have
   the least hash (equal strings choose alike). The hashes of chosen suffixes are exchanged; suffixes
   whose first bytes occur in one document only are settled.
2. The others exchange the hash of their whole context, all strings that chose them. A context that
   occurs in a smaller document is removed as a whole.
3. Where contexts with common first bytes differ, their single strings are exchanged.

Documents lie in buckets of some ``BUCKET_BYTES``, by a hash of the row, so that neither copies nor
common lines meet in one task. A bucket sends a run per range of hashes, sorted, without repeats, as
differences; a task per range merges the runs of all buckets (a stable sort, which merges runs) and
answers each with one or two bits per entry. Texts move once; all rounds read that same exchange.

Defined results: a null text has 0 bytes; a null doc_id is never smaller than another; rows of one
doc_id do not remove from each other; strings within one document do not count; texts shorter than
``LENGTH`` bytes stay; an empty table gives an empty result; long texts are read in whole.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.hashing import BYTES, P, mix, mix_in_place, powers

LENGTH, GRAM, BUCKET_BYTES = 50, 24, 6 << 20
LAST = 2**63 - 1
PLACE = np.uint64((1 << 28) - 1)
MULTIPLIERS = mix(np.arange(11, 14, dtype=np.uint64) * P) | np.uint64(1)
RUN = "part int, bucket int, run binary, past binary"
REPLY = "bucket int, part int, bits binary"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def packed(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers as compressed byte planes; the first, sorted, as differences."""
    first = np.diff(columns[0], prepend=columns[0].dtype.type(0))
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).tobytes() for c in (first, *columns[1:])]
    return struct.pack("<II", len(first), len(columns)) + zlib.compress(b"".join(planes), 1)


def unpacked(run: bytes) -> list[np.ndarray]:
    n, columns = struct.unpack("<II", run[:8])
    planes = np.frombuffer(zlib.decompress(run[8:]), np.uint8).reshape(columns, 8, n)
    out = [np.ascontiguousarray(planes[k].T).view(np.uint64).ravel() for k in range(columns)]
    return [np.cumsum(out[0], dtype=np.uint64), *out[1:]]


class Bucket:
    """The documents of a bucket end to end, and the chosen suffixes with the strings that chose them."""

    def __init__(self, table: pa.Table):
        order = sorted(range(table.num_rows), key=lambda i: (table["at"][i].as_py(), table["text"][i].as_py()))
        table = table.take(pa.array(order, pa.int64()))
        self.ids = table["doc_id"].to_pylist()
        self.at = table["at"].to_numpy().astype(np.uint64)
        texts = table["text"].to_pylist()
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.data = np.frombuffer(b"".join(texts) + bytes(LENGTH), np.uint8)
        n = len(self.data) - LENGTH
        empty = np.zeros(0, np.int64)
        self.low = self.high = self.owner = empty
        self.gram = self.context = np.zeros(0, np.uint64)
        up, self.down = powers(n + 1)
        # Arrays as long as the bucket are worked on in place: several tasks of an executor hold theirs at once.
        self.sums = np.zeros(n + 1, np.uint64)
        inner = self.sums[1:]
        np.take(BYTES, self.data[:n], out=inner, mode="clip")
        inner *= up[:n]
        np.cumsum(inner, out=inner)
        if n < LENGTH:
            return
        words = np.ndarray((n - GRAM + 1 + 16,), np.uint64, self.data.tobytes() + bytes(8), strides=(1,))
        grams, term = words[:-16] * MULTIPLIERS[0], words[8:-8] * MULTIPLIERS[1]
        grams += term
        grams += np.multiply(words[16:], MULTIPLIERS[2], out=term)
        del words, term
        grams = mix_in_place(grams)
        least = grams & ~PLACE
        least |= np.arange(len(grams), dtype=np.uint64)
        span, width = LENGTH - GRAM + 1, 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        fits = np.ones(n, bool)
        for size, end in zip(self.sizes, self.ends):
            fits[end - min(size, LENGTH - 1) : end] = False
        places = np.flatnonzero(fits)
        if not len(places):
            return
        chosen = least[places]
        chosen &= PLACE
        chosen = chosen.view(np.int64)
        del least
        begins = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        lasts = np.append(begins[1:], len(places)) - 1
        self.low, self.high = places[begins], places[lasts]
        suffix = chosen[begins]
        self.owner = np.searchsorted(self.ends, self.low, side="right")
        self.gram = grams[suffix] >> np.uint64(16)
        shape = ((suffix - self.low) * 64 + self.high - self.low).astype(np.uint64)
        self.context = mix(self.hashed(self.low, self.high + LENGTH) ^ mix(shape + np.uint64(1)))

    def hashed(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.down[begin])


def least_per(keys: tuple[np.ndarray, ...], at: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """Distinct keys in order (the last counts first), their least ``at``, and each row's entry."""
    order = np.lexsort((at, *keys))
    fresh = np.zeros(len(order), bool)
    for key in keys:
        fresh[1:] |= key[order][1:] != key[order][:-1]
    fresh[:1] = True
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(fresh) - 1
    head = order[fresh]
    return tuple(k[head] for k in keys), at[head], entry


def part_of(gram: np.ndarray, parts: int) -> np.ndarray:
    return (((gram >> np.uint64(16)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


class Rounds:
    """What a bucket knows after the replies so far; every round works it out anew from the texts."""

    def __init__(self, table: pa.Table, replies: pa.Table | None, parts: int):
        self.bucket, self.parts = Bucket(table), parts
        self.number = table["bucket"][0].as_py()
        self.replies = [{}, {}, {}]
        self.past: dict[int, list[bytes]] = {}
        for row in replies.to_pylist() if replies is not None else []:
            rounds, at = [], 0
            while at < len(row["bits"]):
                (size,) = struct.unpack_from("<I", row["bits"], at)
                rounds.append(row["bits"][at + 4 : at + 4 + size])
                at += 4 + size
            self.past[row["part"]] = rounds
            for k, bits in enumerate(rounds):
                self.replies[k][row["part"]] = bits
        b = self.bucket
        at = b.at[b.owner]
        # Round 1: first bytes of the chosen suffixes; more than one document of the bucket may have them.
        (self.grams,), low, entry = least_per((b.gram,), at)
        self.several = np.zeros(len(self.grams), bool)
        self.several[entry[at != low[entry]]] = True
        self.gram_parts = part_of(self.grams, parts)
        if not self.past:
            return
        tied = self.bits(0, self.gram_parts, 1)[:, 0].astype(bool)
        # Round 2: contexts of the suffixes that are still tied.
        self.rows = np.flatnonzero(tied[entry])
        at = at[self.rows]
        keys, self.context_low, self.context_entry = least_per((b.context[self.rows], b.gram[self.rows]), at)
        self.contexts, self.context_grams = keys
        self.context_parts = part_of(self.context_grams, parts)
        self.whole = at > self.context_low[self.context_entry]
        if not self.replies[1]:
            return
        smaller, differ = self.bits(1, self.context_parts, 2).T.astype(bool)
        self.whole |= smaller[self.context_entry]
        # Round 3: single strings of first contexts whose first bytes go on in other ways elsewhere.
        seen = np.flatnonzero(~self.whole & differ[self.context_entry])
        records = self.rows[seen]
        counts = b.high[records] - b.low[records] + 1
        self.places = np.repeat(b.low[records] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        gram, at = np.repeat(b.gram[records], counts), np.repeat(at[seen], counts)
        keys, self.string_low, self.string_entry = least_per((b.hashed(self.places, self.places + LENGTH), gram), at)
        self.strings, string_grams = keys
        self.string_parts = part_of(string_grams, parts)
        # Within a part strings go by their hash, which front coding needs.
        self.string_order = np.lexsort((self.strings, self.string_parts))
        self.known = at > self.string_low[self.string_entry]

    def bits(self, k: int, part: np.ndarray, each: int) -> np.ndarray:
        """The answers of round ``k`` to entries that lie by part."""
        out = np.zeros((len(part), each), np.uint8)
        edges = np.searchsorted(part, np.arange(self.parts + 1))
        for p, bits in self.replies[k].items():
            n = edges[p + 1] - edges[p]
            out[edges[p] : edges[p + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n * each).reshape(n, each)
        return out

    def runs(self, columns: list[np.ndarray], part: np.ndarray) -> pa.Table:
        edges = np.searchsorted(part, np.arange(self.parts + 1))
        out = []
        for p in range(self.parts):
            some = slice(edges[p], edges[p + 1])
            if edges[p] < edges[p + 1] or p in self.past:
                past = b"".join(struct.pack("<I", len(x)) + x for x in self.past.get(p, []))
                out.append((p, self.number, packed(*[c[some] for c in columns]), past))
        parts, buckets, runs, pasts = zip(*out) if out else ((), (), (), ())
        arrays = [pa.array(parts, pa.int32()), pa.array(buckets, pa.int32()), pa.array(runs, pa.binary()), pa.array(pasts, pa.binary())]
        return pa.Table.from_arrays(arrays, ["part", "bucket", "run", "past"])

    def result(self) -> pa.Table:
        b = self.bucket
        n = len(b.data) - LENGTH
        cover = np.zeros(n + LENGTH + 1, np.int32)
        b.sums = None  # the strings are hashed
        if self.past:
            done = self.rows[self.whole]
            np.add.at(cover, b.low[done], 1)
            np.add.at(cover, b.high[done] + LENGTH, -1)
            answers = np.zeros(len(self.strings), bool)
            answers[self.string_order] = self.bits(2, self.string_parts[self.string_order], 1)[:, 0].astype(bool)
            places = self.places[self.known | answers[self.string_entry]]
            np.add.at(cover, places, 1)
            np.add.at(cover, places + LENGTH, -1)
        gone = np.cumsum(cover, dtype=np.int32, out=cover)[:n] > 0
        starts = np.concatenate([[0], b.ends[:-1]])
        opens = gone & ~np.concatenate([[False], gone[:-1]])
        opens[starts[b.sizes > 0]] = gone[starts[b.sizes > 0]]
        removed, spans = ([np.count_nonzero(x[s:e]) for s, e in zip(starts, b.ends)] for x in (gone, opens))
        kept = [hashlib.sha256(b.data[s:e][~gone[s:e]].tobytes()).hexdigest() for s, e in zip(starts, b.ends)]
        columns = [b.ids, b.sizes, removed, spans, kept]
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in RESULT.split(", ")])


def merged(table: pa.Table, which: int) -> pa.Table:
    """Answers to the runs of one part: which entries occur with a smaller document, or in more ways."""
    rows = table.to_pylist()
    runs = [unpacked(r["run"]) for r in rows]
    sizes = [len(r[0]) for r in runs]
    columns = [np.concatenate(c) for c in zip(*runs)]
    total = sum(sizes)
    each = 2 if which == 2 else 1
    bits = np.zeros((total, each), np.uint8)
    if total:
        order = np.argsort(columns[0], kind="stable") if which != 2 else np.lexsort((columns[1], columns[0]))
        key = columns[0][order]
        change = np.concatenate([[True], key[1:] != key[:-1]])
        if which == 1:
            group = np.cumsum(change) - 1
            often = np.bincount(group) > 1
            often |= np.bincount(group, columns[1][order]) > 0
            bits[order, 0] = often[group]
        else:
            at = columns[-1][order]
            fine = change.copy()
            if which == 2:
                fine[1:] |= columns[1][order][1:] != columns[1][order][:-1]
            starts = np.flatnonzero(fine)
            low = np.minimum.reduceat(at, starts)[np.cumsum(fine) - 1]
            bits[order, 0] = low < at
            if which == 2:
                group = np.cumsum(change) - 1
                bits[order, 1] = (np.bincount(group, fine) > 1)[group]
    edges = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
    out = []
    for k, row in enumerate(rows):
        answer = np.packbits(bits[edges[k] : edges[k + 1]].ravel()).tobytes()
        out.append(row["past"] + struct.pack("<I", len(answer)) + answer)
    return pa.Table.from_arrays(
        [table["bucket"].combine_chunks(), table["part"].combine_chunks(), pa.array(out, pa.binary())],
        ["bucket", "part", "bits"],
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """RESULT per row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    parts = 1 + size // BUCKET_BYTES
    rows = docs.select(
        F.pmod(F.xxhash64("doc_id", text), F.lit(parts)).cast("int").alias("bucket"),
        "doc_id",
        F.coalesce("doc_id", F.lit(LAST)).alias("at"),
        text.cast("binary").alias("text"),
    )
    by_bucket = rows.groupBy("bucket")

    def first(table: pa.Table) -> pa.Table:
        r = Rounds(table, None, parts)
        return r.runs([r.grams, r.several.astype(np.uint64)], r.gram_parts)

    def second(table: pa.Table, replies: pa.Table) -> pa.Table:
        r = Rounds(table, replies, parts) if table.num_rows else None
        return r.runs([r.context_grams, r.contexts, r.context_low], r.context_parts) if r and r.past else NO_RUNS

    def third(table: pa.Table, replies: pa.Table) -> pa.Table:
        r = Rounds(table, replies, parts) if table.num_rows else None
        if not r or not r.past:
            return NO_RUNS
        o = r.string_order
        return r.runs([r.strings[o], r.string_low[o]], r.string_parts[o])

    def final(table: pa.Table, replies: pa.Table) -> pa.Table:
        return Rounds(table, replies, parts).result()

    replies = by_bucket.applyInArrow(first, RUN).groupBy("part").applyInArrow(_merger(1), REPLY)
    for which, step in ((2, second), (3, third)):
        runs = by_bucket.cogroup(replies.groupBy("bucket")).applyInArrow(step, RUN)
        replies = runs.groupBy("part").applyInArrow(_merger(which), REPLY)
    return by_bucket.cogroup(replies.groupBy("bucket")).applyInArrow(final, RESULT)


NO_RUNS = pa.table(
    {"part": pa.array([], pa.int32()), "bucket": pa.array([], pa.int32()), "run": pa.array([], pa.binary()), "past": pa.array([], pa.binary())}
)


def _merger(which: int):
    def merge(table: pa.Table) -> pa.Table:
        return merged(table, which)

    return merge
