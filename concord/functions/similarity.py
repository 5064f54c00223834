"""String similarity scores (0-100) used inside Arrow batches.

Definitions, from the published Indel-similarity family: ``ratio`` is
``200 * LCS / (len(a) + len(b))``; the LCS length is counted with the bit-parallel
recurrence of Hyyro (2004). The set, sort, partial and weighted scores are built on it.
"""

from __future__ import annotations

import re
from functools import lru_cache

# Weights of the combined score and length limits that select them.
FULL_SCORE = 100.0
TOKEN_WEIGHT = 0.95
PARTIAL_WEIGHT = 0.9
LONG_PARTIAL_WEIGHT = 0.6
PARTIAL_FROM_LENGTH_RATIO = 1.5
LONG_FROM_LENGTH_RATIO = 8.0

_NON_WORD = re.compile(r"\W")


def folded(text: str) -> str:
    """Lower case, every non-word character a space, ends trimmed."""
    return _NON_WORD.sub(" ", text).lower().strip()


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence; what both begin or end with belongs to it."""
    shortest = min(len(a), len(b))
    head = 0
    while head < shortest and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < shortest - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if not a or not b:
        return head + tail
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hits = row & where.get(ch, 0)
        row = ((row + hits) | (row - hits)) & full
    return head + tail + len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return FULL_SCORE if total == 0 else FULL_SCORE * 2 * _common(a, b) / total


def _token_parts(a: str, b: str) -> tuple[str, str, str]:
    left, right = set(a.split()), set(b.split())
    return tuple(
        " ".join(sorted(part)) for part in (left & right, left - right, right - left)
    )


@lru_cache(maxsize=200_000)
def token_set_ratio(a: str, b: str) -> float:
    """Best ratio among shared tokens, shared + rest of a, shared + rest of b."""
    if not a.split() or not b.split():
        return 0.0
    shared, only_a, only_b = _token_parts(a, b)
    if shared and not (only_a and only_b):
        return FULL_SCORE
    if not shared:
        return ratio(only_a, only_b)
    with_a, with_b = f"{shared} {only_a}", f"{shared} {only_b}"
    return max(ratio(with_a, with_b), ratio(shared, with_a), ratio(shared, with_b))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text against any window of the longer one.

    Windows have the shorter text's length, or less where they hang over an end.
    """
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return FULL_SCORE if not long else 0.0
    width = len(short)
    windows = {long[max(0, i) : i + width] for i in range(1 - width, len(long))}
    best = max(ratio(short, w) for w in windows)
    if len(short) == len(long):
        heads = {short[max(0, i) : i + width] for i in range(1 - width, width)}
        best = max(best, max(ratio(long, w) for w in heads))
    return best


def _partial_token_ratio(a: str, b: str) -> float:
    shared, only_a, only_b = _token_parts(a, b)
    if shared:
        return FULL_SCORE
    by_sort = partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    return max(by_sort, partial_ratio(only_a, only_b))


@lru_cache(maxsize=200_000)
def weighted_ratio(a: str, b: str) -> float:
    """Best of the plain, token and (for unequal lengths) partial scores, weighted."""
    if not a or not b:
        return 0.0
    stretch = max(len(a), len(b)) / min(len(a), len(b))
    plain = ratio(a, b)
    if stretch < PARTIAL_FROM_LENGTH_RATIO:
        if plain >= FULL_SCORE * TOKEN_WEIGHT or (a.split() == [a] and b.split() == [b]):
            return plain  # no token score weighs more, or each is the plain one
        tokens = max(token_sort_ratio(a, b), token_set_ratio(a, b))
        return max(plain, tokens * TOKEN_WEIGHT)
    weight = PARTIAL_WEIGHT if stretch <= LONG_FROM_LENGTH_RATIO else LONG_PARTIAL_WEIGHT
    return max(
        plain,
        partial_ratio(a, b) * weight,
        _partial_token_ratio(a, b) * TOKEN_WEIGHT * weight,
    )
