"""Common-prefix intervals of an enhanced suffix array, found by one scan with a stack."""

from __future__ import annotations

from collections.abc import Iterator, Sequence


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (differ.bit_length() + 7) // 8


def sorted_suffixes(suffixes: Sequence[bytes]) -> tuple[list[int], list[int]]:
    """Order of the suffixes, and the common prefix of each with the one before."""
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    shared = [0] + [common(suffixes[a], suffixes[b]) for a, b in zip(order, order[1:], strict=False)]
    return order, shared


def intervals(shared: Sequence[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of every interval of the tree with depth ``least`` or more.

    An interval is a largest range of neighbours that have ``depth`` characters in common;
    inner intervals come before those that hold them.
    """
    stack: list[tuple[int, int]] = []
    for i in range(1, len(shared) + 1):
        depth = shared[i] if i < len(shared) else -1
        first = i - 1
        while stack and stack[-1][0] > depth:
            found, first = stack.pop()
            if found >= least:
                yield found, first, i - 1
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def maximal_repeats(left: Sequence[bytes], right: Sequence[bytes], least: int) -> Iterator[tuple[int, int, list[int]]]:
    """(characters before, characters from the place on, places) of the repeats around places.

    ``left`` holds what stands before each place, read backwards, ``right`` what follows. An
    interval over the right sides cannot be prolonged to the right by all its places; testing
    how its left sides differ splits it into the groups that cannot be prolonged to the left
    either. Each group has all places of the repeat, not just neighbours in the array.
    """
    if len(right) == 2:
        before, after = common(left[0], left[1]), common(right[0], right[1])
        if before + after >= least:
            yield before, after, [0, 1]
        return
    order, shared = sorted_suffixes(right)
    for after, first, last in intervals(shared, 1):
        places = order[first : last + 1]
        by_left, same = sorted_suffixes([left[p] for p in places])
        for before, a, b in intervals(same, max(least - after, 0)):
            yield before, after, [places[k] for k in by_left[a : b + 1]]
