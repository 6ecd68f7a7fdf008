"""Secrets in texts: three fixed patterns, and random strings that a tokenizer finds hard to shorten.

The vocabulary of a byte-pair tokenizer covers words and names in few tokens, random strings in many.
A candidate is a run of at least ``SHORTEST`` characters of base64, with dashes and underscores. Left out are
candidates that overlap a span of the patterns, known digests (hex strings of the lengths
of common hashes, UUIDs, subresource hashes), numbers, and identifiers: names whose parts (words, humps,
numbers) have ``PART`` characters on average, and paths, dates and the like, in which one character of
``SIGNS`` is a sign. What remains is a span of kind ``random`` if it has at most ``RATIO`` characters
per token: of random strings of 32 letters and digits all but a few have, of plain words none.

The spans of the patterns always stay: ``assign`` (a keyword, a sign, a value of 12 or more characters),
``access`` (a key id of 18 or more), ``hex`` (16 or more). Positions are code points, ends exclusive.

Defined results: a null or empty text has no spans; repeated rows are scanned alike; an empty table
gives no rows; a text of any length is scanned whole; other columns pass through packed as ``row``.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: A vocabulary is sent to every worker; files beyond this size are refused.
LARGEST_VOCABULARY = 32 << 20
SHORTEST, RATIO = 20, 2.0
PART, SIGNS = 4, 7
#: Tokens are counted in stretches of so many characters.
STRETCH = 256
KINDS = ("assign", "access", "hex", "random")

# The patterns of the contract. A run of hex digits or of a key id that is too short
# stays too short wherever a match begins in it, so their lengths are part of the pattern.
ASSIGN = re.compile(
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % SHORTEST)
# Hex digits of md5, sha1, sha224, sha256, sha384 and sha512.
DIGEST = re.compile(
    r"(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{56}|[0-9A-Fa-f]{64}|[0-9A-Fa-f]{96}|[0-9A-Fa-f]{128}"
    r"|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|sha(?:256-.{43}=|384-.{64}|512-.{86}==))"
)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
SIGN = re.compile(r"[+/_=-]")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by start and then kind as listed."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def is_excluded(string: str) -> bool:
    """Known digests, identifiers, and strings without both digits and letters or both cases."""
    if DIGEST.fullmatch(string):
        return True
    parts = PARTS.findall(string)
    if sum(map(len, parts)) >= PART * len(parts) or len(SIGN.findall(string)) * SIGNS >= len(string):
        return True
    kinds = (any(c.isdigit() for c in string), any(c.islower() for c in string), any(c.isupper() for c in string))
    return sum(kinds) < 2


def chars_per_token(string: str, tokens: Callable[[str], int]) -> float:
    parts = [string[at : at + STRETCH] for at in range(0, len(string), STRETCH)]
    return len(string) / sum(map(tokens, parts))


def random_spans(text: str, taken: list[Span], tokens: Callable[[str], int], ratio: float = RATIO) -> list[Span]:
    """Random strings of the text that no span in ``taken`` overlaps."""
    out, at = [], 0
    reach = 0  # the furthest end of the taken spans that begin before the candidate's end
    for m in CANDIDATE.finditer(text):
        while at < len(taken) and taken[at][1] < m.end():
            reach, at = max(reach, taken[at][2]), at + 1
        if reach > m.start() or is_excluded(m[0]):
            continue
        if chars_per_token(m[0], tokens) <= ratio:
            out.append(("random", m.start(), m.end()))
    return out


def vocabulary(spark: SparkSession, path: str = VOCABULARY) -> bytes:
    """The ranks file, read by Spark, so that it may lie in any store."""
    name, size, content = spark.read.format("binaryFile").load(path).select("path", "length", "content").first()
    if size > LARGEST_VOCABULARY:
        raise ValueError(f"{name} has {size} bytes, more than {LARGEST_VOCABULARY}")
    return bytes(content)


def token_counter(ranks: bytes) -> Callable[[str], int]:
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    encoding = tiktoken.Encoding(
        "ranks", pat_str=r"\p{L}+|\p{N}+|[^\p{L}\p{N}]+", mergeable_ranks=table, special_tokens={}
    )
    return lambda string: len(encoding.encode_ordinary(string))


def with_secrets(docs: DataFrame, vocabulary_path: str = VOCABULARY, ratio: float = RATIO) -> DataFrame:
    """``docs`` packed as ``row`` with ``spans``: (kind, start, end), by start and then kind."""
    ranks = docs.sparkSession.sparkContext.broadcast(vocabulary(docs.sparkSession, vocabulary_path))

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = token_counter(ranks.value)
        for texts in batches:
            rows = []
            for text in texts:
                found = base_spans(text)
                added = random_spans(text, found, tokens, ratio)
                spans = sorted(found + added, key=lambda s: (s[1], KINDS.index(s[0])))
                rows.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            yield pd.Series(rows, dtype=object)

    return docs.select(F.struct("*").alias("row"), scan(F.coalesce("text", F.lit(""))).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redact(docs: DataFrame, vocabulary_path: str = VOCABULARY, ratio: float = RATIO, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every stretch of text that spans cover replaced by ``mask``; a null text stays null."""
    found = with_secrets(docs, vocabulary_path, ratio)
    text = F.col("row.text")
    # Overlapping spans count as one: a piece of text begins where all spans so far have ended.
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda acc, s: F.struct(
        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)))
        .otherwise(acc["out"]).alias("out"),
        F.greatest(acc["at"], s["end"]).alias("at"),
    )
    clean = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.char_length(text))))
    kept = F.when(F.size("spans") > 0, clean).otherwise(text)
    return found.select(F.col("row").withField("text", kept).alias("row")).select("row.*")
