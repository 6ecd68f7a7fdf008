"""Toxicity: a learned lexicon, matched with edits, and scores of the context of every hit.

The lexicon holds words and stems (``abc*``) that mark toxic documents among at most ``SAMPLE``
labelled ones. It is a trie; a word of a text is met by walking the trie along the word's
Levenshtein automaton, which gives every entry within the edits its length allows. Of each hit the
characters around are read: quotation marks on both sides or a reporting verb before speak for
quotation, words of address for abuse. Boosted trees turn the counts into a score.

Only texts and the toxic labels of the given training rows are read; language, source and doc_id
are never inputs of a score.

Defined results: null and empty texts have no hit and the score of such; without training rows the
score is 0 for all; a doc_id that is labelled twice counts twice; equal texts get equal scores; very
long texts are read in whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.llm.boosting import BoostedTrees

#: Bounds of the fit: labelled rows, entries of the lexicon, least number of toxic texts per entry.
SAMPLE, ENTRIES, LEAST = 6_000, 400, 5
#: Least evidence for an entry (log odds ratio, that in standard errors, share of the
#: toxic texts).
ODDS, ERRORS, SHARE = 4.0, 5.0, 0.01
STEMS, SHORTEST, CONTEXT, KNOWN = (4, 5, 6), 4, 48, 400_000
WORD = re.compile(r"[^\W\d_]+")
OPENING, CLOSING = "\"'«“„‘‹", "\"'»”“’›"
REPORTING = re.compile(
    r"\b(said|says|say|wrote|writes|quote|quoted|quotes|called|term|word|sagte|schrieb|zitat|wort|dit|écrit|mot"
    r"|citation|dijo|escribió|palabra|cita)\b"
)
ADDRESS = re.compile(r"\b(you|your|u|du|dich|dir|ihr|tu|toi|te|vous|usted|eres|ustedes|sie)\b")


def edits_allowed(length: int) -> int:
    return 0 if length < 5 else 1


class LevenshteinAutomaton:
    """States are (place in the word, edits so far) with the fewest edits per place."""

    def __init__(self, word: str, edits: int):
        self.word, self.edits = word, edits

    def start(self) -> tuple[tuple[int, int], ...]:
        return tuple((i, i) for i in range(min(self.edits, len(self.word)) + 1))

    def step(self, state: tuple[tuple[int, int], ...], char: str) -> tuple[tuple[int, int], ...]:
        best: dict[int, int] = {}
        for place, spent in state:
            moves = [(place, spent + 1)]  # char is inserted
            if place < len(self.word):
                moves.append((place + 1, spent + (self.word[place] != char)))
            for at, cost in moves:
                while cost <= self.edits and cost < best.get(at, self.edits + 1):
                    best[at] = cost
                    if at == len(self.word):
                        break
                    at, cost = at + 1, cost + 1  # a letter of the word is left out
        return tuple(sorted(best.items()))

    def distance(self, state: tuple[tuple[int, int], ...]) -> int | None:
        return state[-1][1] if state and state[-1][0] == len(self.word) else None


class Lexicon:
    def __init__(self, entries: list[tuple[str, float]]):
        self.stems = {e[:-1]: x for e, x in entries if e.endswith("*")}
        self.words = {e: x for e, x in entries if not e.endswith("*")}
        self.trie: dict = {}
        for word in self.words:
            node = self.trie
            for ch in word:
                node = node.setdefault(ch, {})
            node[""] = word
        self.stem_sizes = sorted({len(s) for s in self.stems})
        # Within k edits one of k + 1 parts of an entry is intact and moved by k places at most:
        # words that hold none are not walked.
        self.parts: dict[int, set[tuple[int, str]]] = {}
        for word in self.words:
            k = edits_allowed(len(word))
            cuts = [round(i * len(word) / (k + 1)) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                self.parts.setdefault(b - a, set()).update((a + d, word[a:b]) for d in range(-k, k + 1))
        self.longest = max(map(len, self.words), default=0) + 1
        self.shortest = min(map(len, self.words), default=0) - 1

    def nearest(self, word: str) -> tuple[str, int] | None:
        """The entry of the fewest edits, among those within what its length allows."""
        found = None
        automaton = LevenshteinAutomaton(word, edits_allowed(len(word) + 1))
        stack = [(self.trie, automaton.start())]
        while stack:
            node, state = stack.pop()
            for ch, child in node.items():
                if ch == "":
                    d = automaton.distance(state)
                    if d is not None and d <= edits_allowed(len(child)) and (found is None or (d, child) < found):
                        found = (d, child)
                elif after := automaton.step(state, ch):
                    stack.append((child, after))
        return (found[1], found[0]) if found else None

    def meets(self, word: str) -> tuple[int, float] | None:
        """(0 exact, 1 edited, 2 stem; weight) of the entry that a word meets."""
        if (weight := self.words.get(word)) is not None:
            return 0, weight
        for n in self.stem_sizes:
            if (weight := self.stems.get(word[:n])) is not None and len(word) >= n:
                return 2, weight
        if self.shortest <= len(word) <= self.longest and any(
            (i, word[i : i + n]) in parts for n, parts in self.parts.items() for i in range(len(word) - n + 1)
        ):
            if near := self.nearest(word):
                return 1, self.words[near[0]]
        return None


class Scanner:
    """Counts of hits by kind and context, as small integers."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.known = lexicon, {}

    def features(self, text: str) -> list[int]:
        low = text.lower()
        words = WORD.findall(low)
        if len(self.known) > KNOWN:
            self.known = {}
        hits = {}
        for word in set(words):
            if word not in self.known:
                self.known[word] = self.lexicon.meets(word)
            if (met := self.known[word]) is not None:
                hits[word] = met
        if not hits:
            return [0] * 8
        kinds, quoted, addressed, total = [0, 0, 0], 0, 0, 0
        for m in WORD.finditer(low):
            if m.group() in hits:
                total += 1
                before, after = low[max(0, m.start() - CONTEXT) : m.start()], low[m.end() : m.end() + CONTEXT]
                said = REPORTING.search(before) is not None
                marked = any(c in OPENING for c in before[-2:]) and any(c in CLOSING for c in after[:2])
                quoted += said or marked
                addressed += ADDRESS.search(before[-16:] + " " + after[:16]) is not None
        for kind, _ in hits.values():
            kinds[kind] += 1
        density = int(4 * math.log2(1 + 1000 * (total - quoted) / len(words)))
        most = int(max(weight for _, weight in hits.values()))
        return [*(min(k, 15) for k in kinds), min(total - quoted, 15), min(quoted, 15), min(addressed, 15), density, most]


class ToxicityModel:
    def __init__(self, lexicon: Lexicon, trees: BoostedTrees):
        self.lexicon, self.trees = lexicon, trees

    def score(self, docs: DataFrame, name: str = "score") -> DataFrame:
        """``docs`` with the score of ``text`` added."""
        model = docs.sparkSession.sparkContext.broadcast((self.lexicon, self.trees))

        @F.pandas_udf(T.DoubleType())
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            lexicon, trees = model.value
            scanner = Scanner(lexicon)
            for texts in batches:
                rows = np.array([scanner.features(t or "") for t in texts], np.int64).reshape(-1, 8)
                yield pd.Series(trees.scores(rows))

        return docs.withColumn(name, scored(F.col("text")))


def count_units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In how many toxic and other texts a word or stem stands; a task sends each once per batch."""
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for toxic, text in zip(batch["toxic"], batch["text"]):
            words = {w for w in WORD.findall((text or "").lower()) if len(w) >= SHORTEST}
            counts[toxic].update(words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n})
        units = list(counts[0].keys() | counts[1].keys())
        yield pd.DataFrame(
            {"unit": units, "pos": [counts[1][u] for u in units], "neg": [counts[0][u] for u in units]}
        )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Lexicon and trees from the texts of at most ``sample`` rows of ``labels`` (doc_id, toxic)."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .select("doc_id", (F.col("toxic") == 1).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic")
        .limit(sample)
    )
    # At most `sample` ids of 12 bytes are broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    n_toxic, n_all = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    counted = (
        rows.select("toxic", "text")
        .mapInPandas(count_units, "unit string, pos bigint, neg bigint")
        .groupBy("unit")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where((F.col("pos") >= LEAST) & (F.col("pos") >= SHARE * n_toxic))
    )
    half = F.lit(0.5)
    odds = F.log((F.col("pos") + half) / (F.lit(n_toxic) - F.col("pos") + half)) - F.log(
        (F.col("neg") + half) / (F.lit(n_all - n_toxic) - F.col("neg") + half)
    )
    error = F.sqrt(1 / (F.col("pos") + half) + 1 / (F.col("neg") + half))
    best = (
        counted.withColumn("odds", odds)
        .withColumn("errors", F.col("odds") / error)
        .where((F.col("odds") >= ODDS) & (F.col("errors") >= ERRORS))
        .orderBy(F.desc("pos"), "unit")
        .limit(10 * ENTRIES)
        .collect()
    )
    entries: list[tuple[str, float]] = []
    covered: set[str] = set()
    for r in best:
        name = r.unit.rstrip("*")
        # A stem stands for its words and longer stems; a word that is all there is of it stays a word.
        if any(name[:n] in covered for n in STEMS) or len(entries) >= ENTRIES:
            continue
        if r.unit.endswith("*"):
            whole = [w for w in best if not w.unit.endswith("*") and w.unit.startswith(name)]
            if whole and max(w.pos for w in whole) >= 0.9 * r.pos:
                continue
            covered.add(name)
        entries.append((r.unit, float(r.odds)))
    lexicon = Lexicon(entries)
    learn = ToxicityModel(lexicon, BoostedTrees(0.0, []))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(lexicon)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(shared.value)
        for texts in batches:
            yield pd.Series([scanner.features(t or "") for t in texts])

    seen = rows.select("toxic", read("text").alias("x")).groupBy("x", "toxic").agg(F.count("*").alias("n")).collect()
    seen.sort(key=lambda r: (r.x, r.toxic))
    learn.trees = BoostedTrees.fit([r.x for r in seen], [r.toxic for r in seen], [r.n for r in seen])
    return learn
