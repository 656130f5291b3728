"""Longest common subsequence of two sequences of hashes, bit-parallel over Python integers."""

from __future__ import annotations

from collections import defaultdict


def common_places(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places (in a, in b) of a longest common subsequence, in order; only items that both have take part in the work."""
    both = set(a) & set(b)
    at_a, at_b = [i for i, x in enumerate(a) if x in both], [j for j, x in enumerate(b) if x in both]
    masks: dict[int, int] = defaultdict(int)
    for bit, i in enumerate(at_a):
        masks[a[i]] |= 1 << bit
    v = ones = (1 << len(at_a)) - 1
    rows = []  # bit i of a row is 0 where the subsequence grows with item i of a
    for j in at_b:
        u = v & masks[b[j]]
        v = ((v + u) | (v - u)) & ones
        rows.append(v)
    i, j, found = len(at_a), len(at_b), []
    while i and j:
        if rows[j - 1] >> (i - 1) & 1:
            i -= 1
        elif j > 1 and not rows[j - 2] >> (i - 1) & 1:
            j -= 1
        else:
            i, j = i - 1, j - 1
            found.append((at_a[i], at_b[j]))
    return found[::-1]
