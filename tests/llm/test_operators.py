"""Every training-data operator on small tables: odd inputs, brute-force versions, planted cases."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clientele.llm import (
    decontaminate,
    html_text,
    mixing,
    near_dups,
    ngram_quality,
    phrases,
    pii,
    substrings,
    toxicity,
    url_filter,
)
from clientele.llm import queries as registered
from clientele.session import session_settings
from tests.llm import brute
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
CLASH = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, node string, row string"


def words(seed, n):
    dice = random.Random(seed)
    return " ".join("".join(dice.choice("abcdefgh") for _ in range(dice.randrange(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra columns of clashing names."""
    long = words(1, 20_000)
    rows = [
        (1, long, "en", "a"), (2, long, "en", "a"), (3, None, None, None), (4, "", "en", "b"),
        (5, "x", "de", None), (5, "x", "de", None), (None, words(2, 80), "en", "a"), (5, words(2, 80) + " end", None, "a"),
        (None, None, None, None), (7, " \t\n", "en", "b"),
    ]
    return spark.createDataFrame([(*r, 9, 1, "n", "r") for r in rows], CLASH)


@pytest.mark.parametrize("name", sorted(registered.ORACLE))
def test_equals_its_sql(spark, name):
    assert compare(registered.QUERIES[name](spark, SF), duck(SF), registered.ORACLE[name]) is None


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://EXAMPLE.com/en/1?q", "https://www.example.com/en/", "x://a.net/fr", "x://net/fr/#"]
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    rules = spark.createDataFrame(list(registered.URL_RULES), "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()}
    assert got[0] == got[1] == got[2] == ("", None, "allow")
    assert got[3] == ("example.com", "example.com/en/", "block")
    assert got[4] == ("www.example.com", "www.example.com/en/", "allow")
    assert got[5] == ("a.net", None, "allow") and got[6] == ("net", "net/fr/", "block")
    assert {r.verdict for r in url_filter.judge_urls(pages, rules.limit(0), "block").collect()} == {"block"}


def test_pii_equals_brute_force(spark):
    texts = [
        None, "", "a@b.c_d@e.f x@y.z, @a.b a@b me@x.co.uk", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.4",
        "4111 1111 1111 1111 and 4111-1111-1111-1112 5", "+1 (017) 555-7713, +1 +49 30 123456 ((+12 )))",
        "9" * 5000 + " " + "a" * 5000 + " " + "1 " * 900, "é😀 +1 (017) 555-7713", "10.0.0.1 " * 600,
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    spans = pii.with_spans(docs, pii.fit(docs))
    counts = [pii.counted("base", k) for k in range(4)]

    for r in spans.select("row.doc_id", *counts, F.sha2(pii.listed("base"), 256)).collect():
        assert tuple(r)[1:] == brute.pii_row(texts[r.doc_id])
    clean = {r.doc_id: r.text for r in pii.redact(docs, pii.fit(docs)).collect()}
    assert clean[0] is None and clean[7] == "é😀 [PHONE]" and clean[8] == "[IP] " * 600


def test_pii_sample_holds_the_smallest_hashes_once(spark):
    rows = [(k % 700, f"call {k % 700} or write to user{k % 700}@example.com") for k in range(1400)]
    docs = spark.createDataFrame([*rows, (0, None), (0, ""), (0, "nothing")], "doc_id bigint, text string")
    found = docs.where("text LIKE '%@%'").select("text").distinct()
    for size in (1, 100, 1000):
        expected = found.orderBy(F.xxhash64("text")).limit(size).collect()
        assert sorted(pii.sampled(docs, size).collect()) == sorted(expected)


def added(spark, texts):
    """Per text the spans that the method adds to the base ones, with a model of all texts."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    spanned = pii.with_spans(docs).select("row.doc_id", F.array_except("spans", "base").alias("more"))
    return {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.more] for r in spanned.where("size(more) > 0").collect()}


def spelled(k):
    return f"ann{k} [at] host{k}x [dot] org"


def test_loose_only_table_adds_what_has_a_cue(spark):
    texts = [f"please mail {spelled(k)} soon" if k % 2 else f"see {spelled(k)} there" for k in range(600)]
    assert added(spark, texts) == {k: [spelled(k)] for k in range(1, 600, 2)}


def test_rare_loose_spans_are_added(spark):
    texts = [f"note {k} of user{k}@example.com on day {k % 300}" for k in range(20_000)]
    texts[7000] = f"please mail {spelled(1)} soon"
    texts[15_000] = f"please contact {spelled(2)} soon"
    assert added(spark, texts) == {7000: [spelled(1)], 15_000: [spelled(2)]}


def test_base_matches_do_not_carry_wrong_loose_ones(spark):
    texts = [f"mail user{k}@example.com" for k in range(4000)] + [f"see {spelled(k)} there" for k in range(150)]
    assert added(spark, texts) == {}


def test_class_probabilities_add_up(spark):
    docs = spark.createDataFrame([(words(3, 500),), (words(4, 500),)], "text string")
    logs = ngram_quality.log_probabilities(ngram_quality.count_grams(docs))
    per_context = np.exp(logs.astype(float)).reshape(-1, ngram_quality.CLASSES).sum(axis=1)
    assert np.allclose(per_context, 1, atol=1e-3)


def test_odd_rows_pass_every_operator(spark, odd):
    n = odd.count()
    benchmark = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "item_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    assert pii.redact(odd).columns == odd.columns
    assert pii.redact(odd).count() == n
    assert sorted(r.item_id for r in decontaminate.leaked_pairs(odd, benchmark).collect()) == [3, 3]
    assert mixing.mixing_plan(odd).count() == n
    assert ngram_quality.judge_quality(odd, labels.where("quality = 1")).count() == n
    assert phrases.compare_with_next(odd).count() == n
    assert toxicity.fit(odd, labels).score(odd).count() == n
    found = near_dups.near_duplicates(odd)
    assert {(r.doc_id, r.class_id) for r in found.collect()} >= {(1, 1), (2, 1), (3, 3), (4, 3), (5, 5)}
    assert near_dups.keep_one(odd).columns == odd.columns
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = sorted(brute.repeats(rows))
    assert sorted(tuple(r)[1:] for r in substrings.remove_repeats(odd).collect()) == want


def test_a_bucket_takes_few_times_its_bytes():
    """Several tasks of an executor hold a bucket each; the arrays of one stay below 50 bytes for every byte."""
    text = np.random.default_rng(1).integers(0, 255, 2 << 20, dtype=np.uint8).tobytes()
    columns = {"bucket": pa.array([0], pa.int32()), "doc_id": pa.array([1]), "at": pa.array([1]), "text": pa.array([text])}
    substrings.powers(len(text) + 1)
    tracemalloc.start()
    try:
        substrings.Bucket(pa.table(columns))
        assert tracemalloc.get_traced_memory()[1] < 50 * len(text)
    finally:
        tracemalloc.stop()


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([], "item_id bigint, text string")
    results = [
        pii.redact(none), decontaminate.leaked_pairs(none, items), mixing.mix(none), phrases.compare_with_next(none),
        ngram_quality.judge_quality(none, labels), toxicity.fit(none, labels).score(none), near_dups.keep_one(none),
        near_dups.near_duplicates(none), substrings.remove_repeats(none),
        html_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string")),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_near_copies_meet(spark):
    base = words(5, 300).split()
    rows = [(10, " ".join(base)), (11, " ".join(base[:-6] + ["q"] * 6)), (12, " ".join(base)), (13, words(6, 300))]
    got = {r.doc_id: r.class_id for r in near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {10: 10, 11: 10, 12: 10, 13: 13}


def test_repeated_rows_cost_no_more_than_two(spark):
    # 500 rows of one document and 500 of a near one, each under a single doc_id.
    base = words(15, 300).split()
    rows = [(1, " ".join(base))] * 500 + [(2, " ".join(base[:-6] + ["q"] * 6))] * 500
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = near_dups.near_duplicates(docs).groupBy("doc_id", "class_id", "class_rows").count().collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 1000, 500), (2, 1, 1000, 500)]
    assert [r.doc_id for r in near_dups.keep_one(docs).collect()] == [1]


def test_family_without_its_origin_equals_brute_force(spark):
    # Copies of a text that is not there, three words off each: partners are seldom the nearest by sketch.
    dice, rows = random.Random(3), []
    for i in range(200):
        copy = [f"w{k}" for k in range(200)]
        for k in dice.sample(range(200), 3):
            copy[k] = f"x{i}y{k}"
        rows.append((i, " ".join(copy)))
    bags, tops = [near_dups.shingle_bag(text.encode()) for _, text in rows], list(range(200))
    for i in range(200):
        for j in range(i):
            if near_dups.weighted_jaccard(bags[i], bags[j]) >= near_dups.SIMILARITY:
                low, high = sorted((tops[i], tops[j]))
                tops = [low if t == high else t for t in tops]
    found = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r.doc_id: r.class_id for r in found.collect()} == dict(enumerate(tops))


def test_signatures_do_not_depend_on_the_batch():
    texts = [words(k, 40 + 7 * k).encode() for k in range(30)] + [b"", words(50, 60_000).encode()]
    found = {}
    for which, rows in near_dups.signatures(pa.array(texts, pa.binary())):
        found |= dict(zip(which, rows.tolist()))
    assert sorted(found) == [k for k in range(32) if k != 30]
    for k in (0, 17, 31):
        assert found[k] == near_dups.bag_minhash([near_dups.shingle_bag(texts[k])])[0].tolist()


def test_bag_minhash_is_unbiased():
    dice = np.random.default_rng(3)
    values = dice.integers(1, 2**62, 60).astype(np.uint64)
    a, b = dice.integers(1, 9, 60), dice.integers(1, 9, 60)
    want = near_dups.weighted_jaccard((np.sort(values), a[np.argsort(values)]), (np.sort(values), b[np.argsort(values)]))
    x, y = near_dups.bag_minhash([(values, a), (values, b)], 4000)
    assert abs((x == y).mean() - want) < 0.03


def test_leaks_equal_brute_force(spark):
    # Texts are fragments of items, edited or apart, between other words.
    dice = random.Random(9)
    items = [(i, words(100 + i, 12 + i % 9) + (". " + words(200 + i, dice.choice([2, 6, 20])) if i % 5 else "")) for i in range(30)]
    items += [(30, None), (31, ""), (32, "?! ."), (33, items[3][1])]
    docs = [(900, None), (901, "")]
    for k in range(120):
        pieces = [words(300 + k, dice.randrange(0, 90))]
        for i in dice.sample(range(30), 3):
            for part in items[i][1].split(". "):
                part = part.split()
                for _ in range(dice.randrange(0, 3)):
                    part[dice.randrange(len(part))] = "zzz"
                pieces += [" ".join(part), words(dice.randrange(10**6), dice.choice([0, 3, 50, 150]))]
        docs.append((k, " ".join(pieces)))
    got = decontaminate.leaked_pairs(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    want = brute.leaks(docs, items)
    assert 50 < len(want) < 360
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == want


def test_question_and_answer_may_lie_apart():
    question, answer = words(700, 22), words(701, 18)
    index = decontaminate.ItemIndex([(1, f"{question}. {answer}"), (2, words(702, 40))])
    for gap in (0, 10, 30, 60, 100, 500, 1000):
        for before in (0, 7, 20, 33):
            text = " ".join([words(703, before), question, words(704, gap), answer, words(705, 9)])
            assert [x[0] for x in index.find(text)] == [1]
            assert [x[0] for x in index.find(" ".join([answer, words(704, gap), question]))] == [1]
    assert index.find(f"{question} {words(704, 60)}") == index.find(f"{answer} {words(704, 60)}") == []


def test_many_items_need_one_function_a_pass(spark, monkeypatch):
    items = [(i, words(10_000 + i, 12)) for i in range(5000)]
    docs = spark.createDataFrame([(i, f"x y {items[i][1]} z") for i in range(0, 5000, 500)], "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.with_leaks(docs, benchmark)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("find(") <= 2
    want = sorted((i, i) for i in range(0, 5000, 500))
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaked_pairs(docs, benchmark).collect()) == want
    monkeypatch.setattr(decontaminate, "PASS_ITEMS", 2000)
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaked_pairs(docs, benchmark).collect()) == want


def test_automaton_agrees_with_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    dice = random.Random(4)
    for _ in range(400):
        a, b = ("".join(dice.choice("ab") for _ in range(dice.randrange(7))) for _ in range(2))
        machine = toxicity.LevenshteinAutomaton(a, 2)
        state = machine.start()
        for ch in b:
            state = machine.step(state, ch)
        want = distance(a, b)
        assert machine.distance(state) == (want if want <= 2 else None), (a, b)


def test_phrases_survive_a_shift():
    text = words(7, 400)
    (a, b, c) = phrases.fingerprints([text, "shifted " + text, words(8, 400)])
    assert phrases.likeness(a, b) > 0.8 and phrases.likeness(a, c) < 0.1 and phrases.likeness(a, a) == 1.0


def test_edited_text_is_the_next_documents(spark):
    rows = [(3, "abcdef"), (2, "XY"), (1, "123456789")]
    got = {r.doc_id: r.edited_sha256 for r in phrases.compare_with_next(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    want = {3: "abcXY", 2: "X1", 1: "12345abcd"}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def test_main_text_of_an_unseen_layout(spark):
    trees = html_text.fit(spark.read.parquet(f"{SF}/pages.parquet"))
    page = (
        "<header><h1>Site</h1></header><div class='cookie-notice'><p>We use cookies, accept them.</p></div><aside class=sidebar>"
        "<ul><li><a href=x>one</a><li><a>two</a></ul></aside><main><h1>T &amp; more</h1><p>First   one\n of text, with words.<p>Second."
        "<form><label>Mail</label></form><section class=comments><p>Great article, I say!</p></section></main><script>x</script>"
    )
    assert html_text.main_text(page, trees) == "T & more\n\nFirst one of text, with words.\n\nSecond."
    assert html_text.main_text(None, trees) == html_text.main_text("", trees) == ""


def test_stages_write_small_row_groups(spark, monkeypatch, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    monkeypatch.setattr(corpus_pipeline, "GROUP_BYTES", 1 << 20)
    with session_settings(spark, {"parquet.block.size": "134217728"}):
        corpus_pipeline.bounded(spark)
        spark.range(0, 100_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("text")).write.parquet(f"{tmp_path}/rows")
    (file,) = tmp_path.glob("rows/*.parquet")
    groups = pq.ParquetFile(file).metadata
    assert max(groups.row_group(i).column(0).total_compressed_size for i in range(groups.num_row_groups)) < 2 << 20


def test_pipeline_on_odd_and_empty_tables(spark, odd, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(100 + k, words(60 + k, 120), "en", "a") for k in range(12)]
    rows += [(200, words(60, 120), "en", "a"), (201, words(61, 118) + " q", "en", "b"), (202, words(65, 120) + " mail ann@x.example.com", "en", "b")]
    item = words(70, 30)
    rows += [(203, words(71, 60) + " " + item + " " + words(72, 60), "en", "b")]
    more = spark.createDataFrame([(*r, 9, 1, "n", "r") for r in rows], CLASH)
    labels = [(100 + k, 1, 0) for k in range(12)] + [(k, 1, 0) for k in range(200, 204)]
    for name, docs in (("some", odd.unionByName(more)), ("none", odd.limit(0))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
    out = corpus_pipeline.run(spark, f"{tmp_path}/some")
    assert out.columns == odd.columns
    kept = {(r.doc_id, r.text) for r in out.collect()}
    ids = {i for i, _ in kept}
    assert 203 not in ids and 200 not in ids and len(ids & set(range(100, 112))) >= 6
    assert all("@" not in (t or "") for _, t in kept)
