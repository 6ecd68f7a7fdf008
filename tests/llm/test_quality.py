"""The quality model against a plain dictionary version, and whole characters as its alphabet."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientele.llm import ngram_quality
from clientele.llm.ngram_quality import CLASSES, ORDER
from clientele.session import session_settings


def brute_losses(trusted, texts):
    """Summed negative log probability of each text, from dictionaries."""
    counts, models = Counter(), []
    for text in trusted:
        text = "\n" * (ORDER - 1) + text
        counts.update(text[i : i + ORDER] for i in range(len(text) - ORDER + 1))
    for _ in range(ORDER):
        n = [sum(c == k for c in counts.values()) for k in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        d = [1 - 2 * y * n[2] / n[1] if n[1] else 0.5, 2 - 3 * y * n[3] / n[2] if n[2] else 1.0, 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        d = [min(max(x, 0.05), k + 0.95) for k, x in enumerate(d)]
        every, left = defaultdict(int), defaultdict(float)
        for gram, c in counts.items():
            every[gram[:-1]] += c
            left[gram[:-1]] += d[min(c, 3) - 1]
        models.insert(0, (dict(counts), d, every, left))
        counts = Counter(gram[1:] for gram in counts)

    def p(gram):
        out = 1 / CLASSES
        for k, (count, d, every, left) in enumerate(models):
            part = gram[ORDER - 1 - k :]
            if every.get(part[:-1]):
                c = count.get(part, 0)
                out = ((c - d[min(c, 3) - 1]) if c else 0) / every[part[:-1]] + left[part[:-1]] / every[part[:-1]] * out
        return out

    padded = ["\n" * (ORDER - 1) + (t or "") for t in texts]
    return [-sum(math.log(p(t[i : i + ORDER])) for i in range(len(t) - ORDER + 1)) for t in padded]


def some_text(seed, n, letters="abcde .木火é😀"):
    dice = random.Random(seed)
    return "".join(dice.choice(letters) for _ in range(n))


def test_losses_equal_brute_force(spark, monkeypatch):
    # Chunks of some documents each, repeated rows, null and empty texts and ids, a text longer than a slice.
    monkeypatch.setattr(ngram_quality, "CHUNK", 1 << 10)
    monkeypatch.setattr(ngram_quality, "SLICE", 200)
    rows = [(i, some_text(i, 60 + i)) for i in range(0, 90, 3)]
    rows += [rows[4], rows[4], (1, None), (2, ""), (None, some_text(7, 50)), (5, some_text(8, 1500)), (-4, "zzz木zz")]
    docs = spark.createDataFrame([(i, "en", t) for i, t in rows], "doc_id bigint, lang string, text string").repartition(3)
    ids = spark.createDataFrame([(i,) for i in [*range(0, 60, 6), 5, 12, 12, None]], "doc_id bigint")
    trusted = [t or "" for i, t in rows if i in {*range(0, 60, 6), 5}]
    model = ngram_quality.fit(docs, ids)
    got = sorted(((r.kept.doc_id is None, r.kept.doc_id, r.text or "", r.length, r.loss, r.text is None) for r in ngram_quality.score(docs, model, True).collect()))
    want = sorted((i is None, i, t or "", len(t or ""), x, t is None) for (i, t), x in zip(rows, brute_losses(trusted, [t for _, t in rows])))
    assert [g[:4] + g[5:] for g in got] == [w[:4] + w[5:] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want], rel=1e-9)


def test_characters_of_one_kind_are_told_apart(spark):
    # Both kinds of text have the same classes of characters; only one is like what is trusted.
    rows = [(i, "ja", some_text(i, 300, "木火土")) for i in range(20)] + [(20 + i, "ja", some_text(i, 300, "金水日")) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    ids = spark.createDataFrame([(i,) for i in range(15)], "doc_id bigint")
    kept = {r.doc_id for r in ngram_quality.judge_quality(docs, ids, rows=False).where("keep").collect()}
    assert set(range(15)) <= kept and not kept & set(range(20, 25))


def test_rows_come_back_whole(spark):
    rows = [(1, "n", None, "x", 5), (None, "n", "abc", None, 6), (1, "n", "", "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, kept string, text string, lang string, `a b` int").select("lang", "text", "kept", "`a b`", "doc_id")
    ids = spark.createDataFrame([(1,)], "doc_id bigint")
    out = ngram_quality.judge_quality(docs, ids).select("row.*")
    assert out.columns == docs.columns and sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))


def test_more_characters_than_numbers(monkeypatch):
    monkeypatch.setattr(ngram_quality, "NUMBERS", 8)
    monkeypatch.setattr(ngram_quality, "WAITING", 10)
    texts = [some_text(i, 40, "abcdefghijklmnopqrst") for i in range(6)]
    got, tally = Counter(), ngram_quality.Tally()
    batches = [b for i, t in enumerate(texts) for b in tally.add(i % 2, list(ngram_quality.pieces(t)))] + [*tally.take()]
    for b in batches:
        for chunk, gram, n in zip(*(c.to_pylist() for c in b.columns)):
            got[chunk, gram] += n
    want = Counter()
    for i, t in enumerate(texts):
        t = ngram_quality.LEAD + t
        want.update((i % 2, t[j : j + ORDER]) for j in range(len(t) - ORDER + 1))
    assert got == want


def test_a_base_is_found_that_tells_grams_apart():
    grams = [chr(a) + chr(b) + "ab" for a in range(256, 400) for b in range(500, 540)]
    p = np.random.default_rng(1).random(len(grams)) + 0.1
    loss, length = ngram_quality.Chunk(grams, p).losses([], 0)
    assert len(loss) == len(length) == 0
    assert ngram_quality.Chunk(grams + grams[:9], np.concatenate([p, p[:9]])).places.is_unique


def test_counts_are_folded_and_sent_early(monkeypatch):
    texts, got = [some_text(i, 90) for i in range(40)], {}
    for waiting, held in ((1 << 19, 1 << 21), (100, 1 << 21), (100, 500)):
        monkeypatch.setattr(ngram_quality, "WAITING", waiting)
        monkeypatch.setattr(ngram_quality, "HELD", held)
        tally, counts = ngram_quality.Tally(), Counter()
        for b in [b for i, t in enumerate(texts) for b in tally.add(i // 20, list(ngram_quality.pieces(t)))] + [*tally.take()]:
            for chunk, gram, n in zip(*(c.to_pylist() for c in b.columns)):
                counts[chunk, gram] += n
        got[waiting, held] = counts
    assert len({frozenset(c.items()) for c in got.values()}) == 1


def test_documents_of_one_language_are_not_one_task(spark, monkeypatch):
    monkeypatch.setattr(ngram_quality, "CHUNK", 1 << 12)
    docs = spark.createDataFrame([(i, "en", some_text(i, 400)) for i in range(80)], "doc_id bigint, lang string, text string")
    trusted = spark.createDataFrame([(i,) for i in range(0, 80, 4)], "doc_id bigint")
    # So little is broadcast that estimates are above it, as those of a large table are; nothing is planned anew.
    with session_settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "8k"}):
        for rows in (True, False):
            judged = ngram_quality.judge_quality(docs, trusted, rows=rows)
            judged = judged.withColumn("task", F.spark_partition_id()).collect()
            assert len(judged) == 80 and len({r.task for r in judged}) > 2
