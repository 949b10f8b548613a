"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import random
import re

BLANK = " \t\n\r\f\v"


def words(count: int, rng: random.Random, vocabulary: int = 5000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(count)]


def shingles(text: str | None, size: int = 3) -> set[tuple[str, ...]]:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return set()
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))}


def components(docs: list[tuple[int, str | None]], size: int = 3, percent: int = 90) -> list[tuple]:
    """(doc_id, n_shingles, component_id) per document; ids are distinct."""
    sets = [shingles(text, size) for _, text in docs]
    label = [i for i, _ in docs]
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    return sorted((i, len(s), c) for (i, _), s, c in zip(docs, sets, label))


def without_copies(docs: list[tuple[int, str | None]], run: int = 3) -> list[tuple]:
    """(doc_id, text, n_deleted) by ascending id; ids are distinct."""
    seen, out = set(), []
    for doc_id, text in sorted(docs):
        if text is None:
            out.append((doc_id, None, 0))
            continue
        lines = text.split("\n")
        filled = [i for i, line in enumerate(lines) if line.strip(BLANK)]
        gone: set[int] = set()
        for s in range(len(filled) - run + 1):
            key = tuple(lines[i] for i in filled[s : s + run])
            if key in seen:
                gone |= set(range(filled[s], filled[s + run - 1] + 1))
            seen.add(key)
        out.append((doc_id, "\n".join(line for i, line in enumerate(lines) if i not in gone), len(gone)))
    return out


def edit_distance(item: str, text: str) -> int:
    """Smallest edit distance of the item to any substring of the text."""
    column = list(range(len(item) + 1))
    best = column[-1]
    for c in text:
        diagonal, column[0] = column[0], 0
        for i, d in enumerate(item, 1):
            diagonal, column[i] = column[i], min(diagonal + (c != d), column[i] + 1, column[i - 1] + 1)
        best = min(best, column[-1])
    return best


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def personal(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the patterns as they are stated."""
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    patterns = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    return [
        (kind, m.start(), m.end())
        for kind, (pattern, good) in enumerate(patterns)
        for m in re.finditer(pattern, text) if good(m.group())
    ]


def runs(words: list, least: int = 24, exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run, by start, then period."""
    periods: dict[tuple[int, int], int] = {}
    for p in range(1, len(words) // exponent + 1):
        at = 0
        while at + p < len(words):
            start = at
            while at + p < len(words) and words[at] == words[at + p]:
                at += 1
            if at > start and at + p - start >= max(least, exponent * p):
                periods.setdefault((start, at + p), p)
            at = max(at, start + 1)
    return sorted((s, e - s, p) for (s, e), p in periods.items())


def encoded(text: str, ranks: dict[bytes, int], pattern: str) -> list[int]:
    """Byte pair merges by rank, the lowest first, then the leftmost, in each match of the pattern."""
    import regex

    ids = []
    for match in regex.findall(pattern, text):
        parts = [bytes([b]) for b in match.encode()]
        while len(parts) > 1:
            known = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not known:
                break
            at = min(known)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        ids += [ranks[p] for p in parts]
    return ids


def code_length(text: bytes, training: list[bytes], order: int) -> float:
    """Bits of a text by prediction by partial matching (method C), counted in the training texts."""
    from math import log2

    counts: dict[bytes, dict[int, int]] = {}
    for sample in training:
        padded = bytes(order) + sample
        for at in range(order, len(padded)):
            for o in range(order + 1):
                after = counts.setdefault(padded[at - o : at], {})
                after[padded[at]] = after.get(padded[at], 0) + 1
    bits, padded = 0.0, bytes(order) + text
    for at in range(order, len(padded)):
        for o in range(order, -1, -1):
            after = counts.get(padded[at - o : at])
            if after is None:
                continue
            whole = sum(after.values()) + len(after)
            if padded[at] in after:
                bits += log2(whole / after[padded[at]])
                break
            bits += log2(whole / len(after))
        else:
            bits += 8
    return bits
