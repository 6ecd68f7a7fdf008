"""Benchmark decontamination: BM25 retrieval by block-max WAND, then verified overlap.

An item is its first sentence (question) and the rest (answer), or one part. Its longer part, the
lead, stands in an inverted index: a postings list per term, cut into blocks of items that know
their largest weight. Every document is cut into overlapping passages, at least as long as the
longest lead, and every passage is a query. The block maxima of a passage's terms are added up for
all passages at once; only where some block can reach the threshold does WAND walk the lists, and
there again it skips what its bounds exclude. An item's threshold is what remains of its lead's score
when the terms of a fifth of its shingles are lost, so every passage holding at least 0.8 of them is
retrieved. Retrieved items are verified on five-word shingles: question and answer must each be
covered to ``SIMILARITY`` by some passage of the text, not necessarily the same one.

An index holds at most about ``SHARD_ITEMS`` items or ``SHARD_BYTES`` of text; one function goes through
the indexes of up to ``PASS_ITEMS`` items or ``PASS_BYTES``, the bound under which items are collected and
broadcast. With more items the documents are read once per pass, and each pass is written before the next.

Defined results: null and empty texts hold nothing; an item without words is never found; a part
of fewer than five words is one shingle; repeated items and repeated documents each get their own
pairs; very long documents are scanned in whole, passage by passage; empty tables give no pairs.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.staging import saved

WORDS, SIMILARITY = 5, 0.8
K1, B, POSTINGS_BLOCK = 1.2, 0.75, 4
SHARD_ITEMS, SHARD_BYTES = 512, 1 << 20
PASS_ITEMS, PASS_BYTES = 8192, 16 << 20
TOKEN = re.compile(r"\w+")
#: Thresholds are scaled to 1; single precision sums may fall short of it by so much.
ENOUGH = 1 - 1e-4
FOUND = "array<struct<item_id bigint, bm25 double, question double, answer double>>"


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + WORDS]) for i in range(max(1, len(words) - WORDS + 1))} if words else set()


def parts(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer; one of them is empty if there is one sentence."""
    cut = re.search(r"\n|[.?!]\s", text)
    split = cut.end() if cut else len(text)
    return TOKEN.findall(text[:split].lower()), TOKEN.findall(text[split:].lower())


class ItemIndex:
    """Inverted index over the leads of test items, with weights relative to each item's threshold."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = []
        for item_id, text in items:
            question, answer = parts(text or "")
            lead = question if len(question) >= len(answer) else answer
            if lead:
                self.items.append((item_id, lead, shingles(question), shingles(answer)))
        n = len(self.items)
        frequency = Counter(w for _, words, _, _ in self.items for w in set(words))
        self.idf = {w: math.log(1 + (n - f + 0.5) / (f + 0.5)) for w, f in frequency.items()}
        mean = sum(len(words) for _, words, _, _ in self.items) / n if n else 1.0
        weighed = []
        for entry in self.items:
            words = entry[1]
            norm = K1 * (1 - B + B * len(words) / mean)
            weights = {w: self.idf[w] * f * (K1 + 1) / (f + norm) for w, f in Counter(words).items()}
            # Every lost term costs at least one of the item's shingles; repeated ones count once.
            lost = math.floor((1 - SIMILARITY) * max(1, len(words) - WORDS + 1) + 1e-9)
            limit = sum(sorted(weights.values())[: max(1, len(weights) - lost)])
            weighed.append((limit, entry, weights))
        # Items of like thresholds share a block, which makes its maxima tight.
        weighed.sort(key=lambda x: (x[0], x[1][0]))
        self.items = [entry for _, entry, _ in weighed]
        self.limits = [limit for limit, _, _ in weighed]
        self.lists: dict[str, tuple[list[int], list[float]]] = {w: ([], []) for w in frequency}
        self.blocks = n // POSTINGS_BLOCK + 1
        self.number = {w: i for i, w in enumerate(self.lists)}
        self.maxima = np.zeros((len(self.lists) + 1, self.blocks), np.float32)
        for k, (limit, _, weights) in enumerate(weighed):
            for w, x in weights.items():
                self.lists[w][0].append(k)
                self.lists[w][1].append(x / limit)
                row, block = self.number[w], k // POSTINGS_BLOCK
                self.maxima[row, block] = max(self.maxima[row, block], x / limit)
        for ids, weights in self.lists.values():
            ids.append(n)
            weights.append(0.0)
        self.most = {w: max(weights) for w, (_, weights) in self.lists.items()}
        self.longest = max((len(words) for _, words, _, _ in self.items), default=1)

    def retrieve(self, terms: list[str]) -> list[tuple[int, float]]:
        """Items whose score over ``terms`` reaches their threshold (1 after scaling)."""
        lists = [self.lists[t] for t in terms]
        most = [self.most[t] for t in terms]
        rows = [self.number[t] for t in terms]
        at, n, found = [0] * len(lists), len(self.items), []

        def seek(i: int, item: int) -> None:
            at[i] = bisect_left(lists[i][0], item, at[i])

        while True:
            order = sorted(range(len(lists)), key=lambda i: lists[i][0][at[i]])
            bound, pivot = 0.0, -1
            for place, i in enumerate(order):
                bound += most[i]
                if bound >= ENOUGH:
                    pivot = place
                    break
            if pivot < 0:
                return found
            item = lists[order[pivot]][0][at[order[pivot]]]
            if item >= n:
                return found
            while pivot + 1 < len(order) and lists[order[pivot + 1]][0][at[order[pivot + 1]]] == item:
                pivot += 1
            ahead = order[: pivot + 1]
            block = item // POSTINGS_BLOCK
            if float(self.maxima[[rows[i] for i in ahead], block].sum()) < ENOUGH:
                # Nothing up to the end of the block, or to the next list's item, can reach it.
                after = min((block + 1) * POSTINGS_BLOCK, n)
                if pivot + 1 < len(order):
                    after = min(after, lists[order[pivot + 1]][0][at[order[pivot + 1]]])
                for i in ahead:
                    seek(i, after)
                continue
            score = 0.0
            for i in ahead:
                seek(i, item)
                if lists[i][0][at[i]] == item:
                    score += lists[i][1][at[i]]
                    at[i] += 1
            if score >= ENOUGH:
                found.append((item, score * self.limits[item]))

    def find(self, text: str) -> list[tuple[int, float, float, float]]:
        """(item_id, BM25, question overlap, answer overlap) of the items that ``text`` holds."""
        words = TOKEN.findall(text.lower())
        unknown = len(self.lists)
        get = self.number.get
        numbers = np.array([get(w, unknown) for w in words], np.int64)
        # A passage is two steps long and one begins at every step, so that any stretch of one
        # step lies within a passage. Its bound adds those of its two steps.
        step, found = self.longest, {}
        places = np.flatnonzero(numbers < unknown)
        if not len(places):
            return []
        keys = np.unique(places // step * (unknown + 1) + numbers[places])
        steps, terms = np.divmod(keys, unknown + 1)
        first = np.flatnonzero(np.r_[True, steps[1:] != steps[:-1]])
        bounds = np.zeros((int(steps[-1]) + 2, self.blocks), np.float32)
        bounds[steps[first]] = np.add.reduceat(self.maxima[terms], first, axis=0)
        for k in np.flatnonzero(((bounds[:-1] + bounds[1:]) >= ENOUGH).any(axis=1)):
            passage = words[k * step : (k + 2) * step]
            for item, score in self.retrieve([w for w in dict.fromkeys(passage) if w in self.lists]):
                found[item] = max(score, found.get(item, score))
        held = self.covers(words, found)
        return sorted(
            (self.items[k][0], score, *held[k]) for k, score in found.items() if min(held[k]) >= SIMILARITY
        )

    def covers(self, words: list[str], found: Iterable[int]) -> dict[int, tuple[float, float]]:
        """For the items ``found``: the best cover of question and of answer by a passage of ``words``."""
        wanted = {s for k in found for part in self.items[k][2:] for s in part}
        passages: dict[tuple[str, ...], set[int]] = {}
        for size in {len(s) for s in wanted}:
            for i in range(len(words) - size + 1):
                shingle = tuple(words[i : i + size])
                if shingle in wanted:
                    # It lies in the passage that begins with its step, and in the one before if it ends there.
                    k = i // self.longest
                    inside = (k - 1, k) if k and i + size <= (k + 1) * self.longest else (k,)
                    passages.setdefault(shingle, set()).update(inside)

        def cover(part: set[tuple[str, ...]]) -> float:
            hits = Counter(k for s in part for k in passages.get(s, ()))
            return max(hits.values(), default=0) / len(part) if part else 1.0

        return {k: (cover(self.items[k][2]), cover(self.items[k][3])) for k in found}


def with_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` packed as ``row``, with ``leaks``: the test items that each text holds."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    count, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    passes = 1 + max(count // PASS_ITEMS, size // PASS_BYTES)
    out = docs.select(F.struct("*").alias("row"), F.array().cast(FOUND).alias("leaks"))
    for k in range(passes):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        out = out.withColumn("leaks", F.concat("leaks", _search(some)(F.col("row.text"))))
        if k + 1 < passes:
            out = saved(out, "leaks")
    return out


def shards(items: list[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    """``items`` in lists of at most SHARD_ITEMS items and, but for a longer item, SHARD_BYTES characters."""
    shard, size = [], 0
    for item in items:
        if shard and (len(shard) == SHARD_ITEMS or size + len(item[1]) > SHARD_BYTES):
            yield shard
            shard, size = [], 0
        shard.append(item)
        size += len(item[1])
    if shard:
        yield shard


def _search(some: DataFrame):
    """A vectorised function from texts to the items of ``some``, one pass, that they hold."""
    rows = [tuple(r) for r in some.orderBy("item_id", "text").collect()]
    items = some.sparkSession.sparkContext.broadcast(rows)

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        indexes = [ItemIndex(shard) for shard in shards(items.value)]
        names = ("item_id", "bm25", "question", "answer")
        for texts in batches:
            yield pd.Series([[dict(zip(names, x)) for i in indexes for x in i.find(t)] if t else [] for t in texts])

    return find


def leaked_pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, bm25, question, answer), one row per document and item it holds."""
    return with_leaks(docs.select("doc_id", "text"), benchmark).select(
        F.col("row.doc_id").alias("doc_id"), F.inline("leaks")
    )
