"""Personal data by candidate boosting, in DataFrame functions only.

Generators propose spans of high recall, which may overlap: four base patterns, whose valid matches
always stay, and looser ones (addresses spelled with "at" and "dot", telephone numbers without a
plus sign, spaced or dotted card numbers). Boosted trees score every candidate from its format and
context; a threshold per kind, calibrated on the loose candidates alone, selects what is added.

Texts fall into two halves by their hash. Each half has trees of its own, and the loose candidates of a
text are scored by the trees of the other half, which have not seen it. So the thresholds are calibrated on
every loose candidate of every document, however rare its kind; base matches, which stay anyway, have no part in them.
The trees grow from the loose candidates of all documents and the base ones of at most ``SAMPLE`` distinct
texts (those with the smallest hashes among texts that may have any), grouped by equal features; of more than
``FIT_ROWS`` such rows those with the smallest hashes are used. Labels come from rules: a base match is right
if it is valid, a loose one if a word naming its kind stands before it.

Positions are code points. They follow from the lengths of matches and of the pieces between them,
so a text is scanned twice per pattern whatever the number of matches. Patterns use possessive
groups, which neither recurse nor retry, so very long runs of digits or letters are safe.

Defined results: a null text counts as empty and has no span (redaction leaves it null); repeated
rows get equal results; an empty table gives an empty result; without candidates nothing is added;
other columns, whatever their names, pass through redaction.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.boosting import BoostedTrees, calibrated
from clientele.llm.staging import saved

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, with atomic repetition. A match begins where its run of
#: characters begins, or where the match before it ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?i)(?<![\w.+-])[\w.+-]++\s?[\[(]\s?at\s?[\])]\s?[\w-]++(?:\s?(?:\.|[\[(]\s?dot\s?[\])])\s?[\w-]++)++",
    "ip": r"(?i)(?<![0-9a-f:])(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}(?![0-9a-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[./\x20_-]{1,3}[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9]{2,5}\)?[\x20./-]{1,2}[0-9]{3,4}[\x20./-]{1,2}[0-9]{3,5}(?![0-9])",
}
#: What a text must hold at least for a pattern to be tried.
NEEDED = {"email": "@", "ip": ".", "card": None, "phone": "+"}
CUES = {
    "email": r"(?i)\b(e-?mail|mail|contact|write|address)\b",
    "ip": r"(?i)\b(ip|ipv6|host|server|address|login)\b",
    "card": r"(?i)\b(card|visa|mastercard|amex|credit|debit|payment)\b",
    "phone": r"(?i)\b(tel|phone|telephone|telefon|fax|call|mobile|cell|whatsapp|teléfono|téléphone)\b",
}
MASKS = {kind: f"[{kind.upper()}]" for kind in KINDS}
SAMPLE, FIT_ROWS, CONTEXT, PRECISION, BLOCK = 4000, 20_000, 24, 0.95, 256
#: Scores are told apart in so many steps when thresholds are chosen; each half has so many trees at most.
STEPS, ROUNDS = 1000, 15


def sums(values: Column) -> Column:
    """0 and the sums of every first k values."""
    return F.aggregate(
        values, F.array(F.lit(0).cast("bigint")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
    )


def with_running(df: DataFrame, names: list[str]) -> DataFrame:
    """``sum_<name>``: 0 and the running sums of ``length_<name>``.

    Sums are taken in blocks, so that no long array is copied per step; each stage is a column of
    its own, as an expression inside a lambda is computed anew for every element.
    """

    def in_blocks(name: str) -> Column:
        lengths = F.col(f"length_{name}")
        last = F.floor((F.size(lengths) - 1) / F.lit(BLOCK)).cast("int")
        cut = F.transform(F.sequence(F.lit(0), last), lambda j: sums(F.slice(lengths, j * BLOCK + 1, BLOCK)))
        return F.when(F.size(lengths) > 0, cut).otherwise(F.array().cast("array<array<bigint>>"))

    def spread(name: str) -> Column:
        offsets = F.col(f"offset_{name}")
        # A block begins with the last sum of the block before: drop it but in the first.
        return F.flatten(
            F.transform(
                F.col(f"block_{name}"),
                lambda b, j: F.transform(
                    F.slice(b, F.when(j == 0, 1).otherwise(2), F.size(b)), lambda x: x + F.get(offsets, j)
                ),
            )
        )

    df = df.select("*", *[in_blocks(n).alias(f"block_{n}") for n in names])
    df = df.select(
        "*", *[sums(F.transform(f"block_{n}", lambda b: F.element_at(b, -1))).alias(f"offset_{n}") for n in names]
    )
    return df.select("*", *[spread(n).alias(f"sum_{n}") for n in names])


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def worth(d: Column, i: Column) -> Column:
        n = d.cast("int")
        twice = n * 2
        return F.when(i % 2 == 0, n).when(twice > 9, twice - 9).otherwise(twice)

    values = F.transform(F.split(F.reverse(digits), "", -1), lambda d, i: worth(d, i))
    return F.aggregate(values, F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0))) % 10 == 0


def valid(kind: str, text: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        numbers = F.transform(F.split(text, r"\.", -1), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(numbers, lambda p: (F.char_length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))
    n = F.char_length(digits_of(text))
    return n.between(13, 19) & luhn(digits_of(text)) if kind == "card" else n.between(9, 15)


def _class_of(ch: Column) -> Column:
    return F.when(ch == "", 0).when(ch.rlike(r"\s"), 1).when(ch.rlike("[0-9]"), 2).when(ch.rlike(r"\p{L}"), 3).otherwise(4)


def _features(kind: str, loose: bool, text: Column, left: Column, right: Column) -> list[Column]:
    """Format and context of a candidate as small integers."""
    digits = digits_of(text)
    marks = F.regexp_replace(text, r"[\p{L}0-9]", "")
    return [
        F.lit(KINDS.index(kind)),
        F.lit(int(loose)),
        F.least(F.char_length(text), F.lit(63)),
        F.least(F.char_length(digits), F.lit(31)),
        F.least(F.char_length(marks), F.lit(15)),
        F.size(F.array_distinct(F.split(marks, "", -1))),
        F.size(F.array_distinct(F.split(digits, "", -1))),
        valid(kind, text).cast("int") if kind != "email" else F.lit(1),
        _class_of(F.right(left, F.lit(1))),
        _class_of(F.left(right, F.lit(1))),
        left.rlike(CUES[kind]).cast("int"),
        F.least(F.char_length(digits_of(F.concat(left, right))), F.lit(15)),
    ]


def _found(kind: str, pattern: str) -> tuple[Column, Column]:
    """Matches of a pattern and the pieces around them; no match costs one scan."""
    need = NEEDED[kind] if pattern == BASE[kind] else None
    there = F.col("text").contains(need) if need else F.col("text").rlike("[0-9]" if kind != "email" else r"[\[(]")
    none = F.array().cast("array<string>")
    matches = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    return F.when(there, matches).otherwise(none), F.split("text", pattern, -1)


def half_of(text: str) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(2)).cast("int")


def with_candidates(docs: DataFrame, sources: tuple[bool, ...] = (False, True)) -> DataFrame:
    """``docs`` packed as ``row`` with text and the candidates of base (False) and loose (True) patterns."""
    out = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    patterns = [(kind, loose, source[kind]) for loose, source in ((False, BASE), (True, LOOSE)) if loose in sources for kind in KINDS]
    names = [f"{kind}_{int(loose)}" for kind, loose, _ in patterns]
    out = out.select("*", *[_found(k, p)[0].alias(f"found_{n}") for n, (k, _, p) in zip(names, patterns)])
    some = lambda n, col, kind: F.when(F.size(f"found_{n}") > 0, col).otherwise(F.array().cast(kind))
    out = out.select(
        "*", *[some(n, _found(k, p)[1], "array<string>").alias(f"piece_{n}") for n, (k, _, p) in zip(names, patterns)]
    )
    lengths = lambda n: F.transform(
        F.arrays_zip(F.col(f"piece_{n}").alias("p"), F.col(f"found_{n}").alias("m")),
        lambda x: (F.char_length(x["p"]) + F.coalesce(F.char_length(x["m"]), F.lit(0))).cast("bigint"),
    )
    out = out.select("*", *[some(n, lengths(n), "array<bigint>").alias(f"length_{n}") for n in names])
    out = with_running(out, names)

    def candidates(name: str, kind: str, loose: bool) -> Column:
        def one(match: Column, i: Column) -> Column:
            start = F.get(f"sum_{name}", i) + F.char_length(F.get(f"piece_{name}", i))
            left = F.right(F.get(f"piece_{name}", i), F.lit(CONTEXT))
            right = F.left(F.get(f"piece_{name}", i + 1), F.lit(CONTEXT))
            ok = valid(kind, match)
            return F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                start.cast("bigint").alias("start"),
                (start + F.char_length(match)).cast("bigint").alias("end"),
                (F.lit(not loose) & ok).alias("base"),
                (left.rlike(CUES[kind]) if loose else ok).cast("int").alias("label"),
                F.array(*[f.cast("int") for f in _features(kind, loose, match, left, right)]).alias("f"),
            )

        return F.transform(F.col(f"found_{name}"), one)

    made = [candidates(n, k, loose).alias(f"made_{n}") for n, (k, loose, _) in zip(names, patterns)]
    return out.select("row", "text", *made).select("row", "text", F.concat(*[f"made_{n}" for n in names]).alias("made"))


class PiiModel:
    """Trees per half of the texts, and per kind the least score of a loose candidate that is added."""

    def __init__(self, trees: tuple[BoostedTrees, BoostedTrees], thresholds: dict[int, float]):
        self.trees, self.thresholds = trees, thresholds

    def score(self, half: Column, f: Column) -> Column:
        """The score of a candidate with features ``f``, by the trees that have not seen its text's half."""
        first, second = (t.column(lambda i: f[i]) for t in self.trees)
        return F.when(half == 0, second).otherwise(first)


def sampled(docs: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` distinct texts that may hold personal data: those with the smallest hashes.

    The number of hashes tells the share of their range that holds a little more than the sample, so
    no other text is moved; equal texts meet as one row per map task, then as one.
    """
    texts = docs.where(F.col("text").rlike("@|[0-9]")).select("text", F.xxhash64("text").alias("hash"))
    known = texts.agg(F.approx_count_distinct("hash", 0.02)).first()[0]
    bound = int(2**64 * min(1.0, (1.2 * sample + 100) / max(known, 1))) - 2**63 - 1
    few = texts.where(F.col("hash") <= bound).groupBy("hash").agg(F.min("text").alias("text"))
    bound = few.select("hash").orderBy("hash").limit(sample).agg(F.max("hash")).first()[0]
    return few.where(F.col("hash") <= F.lit(bound).cast("bigint")).select("text")


def fit(docs: DataFrame, sample: int = SAMPLE, precision: float = PRECISION, fit_rows: int = FIT_ROWS) -> PiiModel:
    """Trees from a bounded number of feature rows, thresholds from every loose candidate of ``docs``."""

    def grouped(some: DataFrame, sources: tuple[bool, ...]) -> DataFrame:
        # The outer form: for the inner one Catalyst filters by the array's size, and computes the array
        # for that a second time, in one expression without the stages of ``with_candidates``.
        rows = with_candidates(some, sources).select(half_of("text").alias("half"), F.explode_outer("made").alias("c"))
        rows = rows.where("c IS NOT NULL").select("half", "c.f", "c.label")
        return rows.groupBy("half", "f", "label").agg(F.count("*").alias("n"))

    loose = grouped(docs.select("text"), (True,))
    rows = saved(loose.unionByName(grouped(sampled(docs, sample), (False,))), "pii_candidates")
    known = max(1, rows.count())
    bound = int(2**64 * min(1.0, fit_rows / known)) - 2**63 - 1
    learn = rows.where(F.xxhash64("f", "label", "half") <= F.lit(bound).cast("bigint")).collect()
    learn.sort(key=lambda r: (r.half, r.f, r.label))
    trees = []
    for half in (0, 1):
        own = [r for r in learn if r.half == half]
        trees.append(BoostedTrees.fit([r.f for r in own], [r.label for r in own], [r.n for r in own], rounds=ROUNDS))
    model = PiiModel(tuple(trees), dict.fromkeys(range(len(KINDS)), 2.0))
    step = F.floor(model.score(F.col("half"), F.col("f")) * STEPS).cast("int")
    held = rows.where(F.col("f")[1] == 1).select(F.col("f")[0].alias("kind"), step.alias("step"), "label", "n")
    # At most one row per kind, step and label.
    held = held.groupBy("kind", "step", "label").agg(F.sum("n").alias("n")).collect()
    for kind in {r.kind for r in held}:
        steps, labels, n = np.array([(r.step, r.label, r.n) for r in held if r.kind == kind], float).T
        model.thresholds[kind] = calibrated(steps / STEPS, labels, n, precision)
    return model


def with_spans(docs: DataFrame, model: PiiModel | None = None) -> DataFrame:
    """``docs`` packed as ``row``, with text, base and spans (arrays of kind, start, end)."""
    model = model or fit(docs)

    def chosen(c: Column) -> Column:
        limit = F.lit(2.0)
        for kind, threshold in model.thresholds.items():
            limit = F.when(c["kind"] == kind, F.lit(threshold)).otherwise(limit)
        # Steps, as in calibration, so that a score on the threshold's step is above it here too.
        step = F.floor(model.score(half_of("text"), c["f"]) * STEPS)
        return ~c["base"] & (c["f"][1] == 1) & (step >= F.round(limit * STEPS))

    def plain(c: Column) -> Column:
        return F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))

    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    out = with_candidates(docs).select(
        "row",
        "text",
        F.array_sort(F.transform(F.filter("made", lambda c: c["base"]), plain)).alias("base"),
        F.sort_array(F.transform(F.filter("made", chosen), lambda c: F.struct(c["start"], c["end"], c["kind"]))).alias("more"),
    )
    # Of overlapping additions the leftmost stays, and none that overlaps a base span.
    more = F.filter(
        "more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    )
    apart = F.aggregate(
        more,
        none,
        lambda acc, m: F.when(
            (F.size(acc) == 0) | (F.element_at(acc, -1)["end"] <= m["start"]),
            F.concat(acc, F.array(F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end")))),
        ).otherwise(acc),
    )
    apart = F.when(F.size("more") > 0, apart).otherwise(none)
    return out.select("row", "text", "base", F.array_sort(F.concat("base", apart)).alias("spans"))


def counted(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def listed(spans: str) -> Column:
    """``kind:start:end`` by kind and start, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, model: PiiModel | None = None) -> DataFrame:
    """``docs`` with every span replaced by the name of its kind; spans that overlap count as one."""
    spanned = with_spans(docs, model)
    masks = F.array(*[F.lit(MASKS[k]) for k in KINDS])
    ordered = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("done"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.when(
            s["start"] >= acc["at"],
            F.struct(s["end"].alias("at"), F.concat(acc["done"], between, F.get(masks, s["kind"])).alias("done")),
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["done"].alias("done")))

    def finish(acc: Column) -> Column:
        return F.concat(acc["done"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.lit(2**31 - 1)))

    clean = F.when(F.size("spans") > 0, F.aggregate(ordered, start, step, finish)).otherwise(F.col("row.text"))
    out = spanned.withColumn("clean", clean)
    columns = []
    for name in docs.columns:
        kept = F.col(f"row.`{name}`")
        if name == "text":
            kept = F.col("clean")
        elif name == "n_chars":
            kept = F.when(F.size("spans") > 0, F.char_length("clean").cast(docs.schema[name].dataType)).otherwise(kept)
        columns.append(kept.alias(name))
    return out.select(*columns)
