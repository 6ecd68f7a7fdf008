"""Plain single-machine versions that the operators are held against."""

import hashlib
import math
import re

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def pii(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def pii_row(text):
    spans = pii(text)
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    counts = tuple(sum(s[0] == k for s in spans) for k in PATTERNS)
    return (*counts, hashlib.sha256(joined.encode()).hexdigest())


def repeats(rows, length=50):
    """{index: (n_bytes, n_removed, n_spans, sha256)} for rows of (doc_id, text)."""
    first = {}
    order = [2**63 - 1 if i is None else i for i, _ in rows]
    data = [(t or "").encode() for _, t in rows]
    for at, b in zip(order, data):
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            first[s] = min(at, first.get(s, at))
    out = []
    for at, b in zip(order, data):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < at:
                gone[p : p + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def collocations(rows, least=10, cover=50, top=2000):
    """Rows of the best phrases for rows of (lang, text)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, used = {}, {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            used[lang] = used.get(lang, 0) + len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    key = (lang, *words[i : i + n])
                    counts[key] = counts.get(key, 0) + 1
    found = {}
    for (lang, *words), a in counts.items():
        if len(words) == 1 or a < least:
            continue
        longer = [k for k in counts if k[0] == lang and len(words) == 2 and len(k) == 4 and (list(k[1:3]) == words or list(k[2:]) == words)]
        if any(counts[k] >= least and 100 * counts[k] >= cover * a for k in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, phrases in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(phrases)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, used[lang], -score))
    return sorted(out)


def trie(rows):
    """Rows of the nodes for rows of (conv_id, turn, role, text)."""
    import zlib

    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = f"{len(role.encode())}:{role}:{text}"
            order = (turn is not None, turn or 0, hashlib.sha256(key.encode()).hexdigest())
            own.setdefault(c, []).append((order, role, text))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))  # the remainder has the sign of c, as in SQL
        made[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for node, held in members.items():
        below = [n for n in members if n[: len(node)] == node]
        childless = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in members)]
        ends = ",".join(str(c) for c in sorted(c for c in held if made[c] == node))
        out.append(
            (
                min(held), len(node), min(members[node[:-1]]) if node else None, len(held),
                sum(len(n) == len(node) + 1 for n in below), len(childless),
                sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n), hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


SECRETS = {
    "assign": r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def secret_row(text):
    spans = []
    for order, (kind, pattern) in enumerate(SECRETS.items()):
        for m in re.finditer(pattern, text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                spans.append((m.start(), order, kind, m.end()))
    joined = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))
    counts = tuple(sum(s[2] == kind for s in spans) for kind in SECRETS)
    return (*counts, hashlib.sha256(joined.encode()).hexdigest())


def leaks(docs, items):
    """(doc_id, item_id) of items whose two parts are each covered to 0.8 by some passage of the text."""

    def shingles(words):
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    split = []
    for item_id, text in items:
        question, _, answer = re.sub(r"\n|[.?!]\s", "\0", text or "", count=1).partition("\0")
        both = [re.findall(r"\w+", part.lower()) for part in (question, answer)]
        if any(both):
            split.append((item_id, both))
    step = max((len(part) for _, both in split for part in both), default=1)
    out = []
    for doc_id, text in docs:
        words = re.findall(r"\w+", (text or "").lower())
        passages = [words[i : i + 2 * step] for i in range(0, len(words), step)]
        for item_id, both in split:
            held = []
            for part in both:
                wanted = shingles(part)
                size = min(5, len(part))
                runs = [{tuple(p[i : i + size]) for i in range(len(p) - size + 1)} for p in passages] if part else [set()]
                held.append(max((len(wanted & r) / max(1, len(wanted)) for r in runs), default=0) if part else 1)
            if words and min(held) >= 0.8:
                out.append((doc_id, item_id))
    return sorted(out)
