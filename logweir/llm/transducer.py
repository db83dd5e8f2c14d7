"""A lexicon as a minimal acyclic transducer in one file that workers map into memory.

The transducer reads the bytes of a word and writes its token ids. It is built from sorted words
in one pass: when the next word leaves a state behind, the state is looked up among the finished
ones by its arcs and outputs, so that equal suffixes are stored once, and outputs move towards
the start as far as words share them, which makes the machine the smallest there is.

Arcs lie in a table in which the rows of all states are laid over each other: the cell of
(state, byte) is base[state] + byte, and holds the state it belongs to, or another one's arc.
The same layout holds the merge rules, rows of which are left symbols. Many words are looked up
together, a byte of each at a time.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Sequence

import numpy as np

MAGIC = 0x4C455831
Ids = tuple[int, ...]


class _State:
    __slots__ = ("arcs", "outputs", "tail")

    def __init__(self) -> None:
        self.arcs: dict[int, int] = {}
        self.outputs: dict[int, Ids] = {}
        #: What a word that ends here still writes; None: no word ends here.
        self.tail: Ids | None = None

    def prepend(self, ids: Ids) -> None:
        for byte, out in self.outputs.items():
            self.outputs[byte] = ids + out
        if self.tail is not None:
            self.tail = ids + self.tail


def _shared(a: Sequence[int], b: Sequence[int]) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


Finished = tuple[Ids | None, tuple[tuple[int, int, Ids], ...]]


def minimal(words: Iterable[tuple[bytes, Ids]]) -> list[Finished]:
    """States (ids written at an end, (byte, next state, ids) arcs); the last one is the start.

    Words must be sorted and distinct.
    """
    known: dict[Finished, int] = {}

    def finish(state: _State) -> int:
        arcs = tuple((b, to, state.outputs[b]) for b, to in state.arcs.items())
        return known.setdefault((state.tail, arcs), len(known))

    path = [_State()]
    last = b""
    for n, (word, ids) in enumerate(words):
        if n and word <= last:
            raise ValueError("words must be sorted and distinct")
        same = _shared(last, word)
        for at in range(len(last), same, -1):
            path[at - 1].arcs[last[at - 1]] = finish(path.pop())
        for byte in word[same:]:
            path[-1].arcs[byte] = -1
            path[-1].outputs[byte] = ()
            path.append(_State())
        path[-1].tail = ()
        for at in range(same):
            out = path[at].outputs[word[at]]
            k = _shared(out, ids)
            path[at].outputs[word[at]] = out[:k]
            if k < len(out):
                path[at + 1].prepend(out[k:])
            ids = ids[k:]
        if same < len(word):
            path[same].outputs[word[same]] = ids
        else:
            path[same].tail = ids
        last = word
    for at in range(len(last), 0, -1):
        path[at - 1].arcs[last[at - 1]] = finish(path.pop())
    # The start reads longer words than every state behind it, so it is a new one.
    finish(path[0])
    return list(known)


#: Places that a row is tried at together.
WINDOW = 512


def overlay(rows: Sequence[np.ndarray], columns: int) -> tuple[np.ndarray, int]:
    """(base of each row, cells): rows laid over each other so that no two share a cell.

    Bases are 0 or more, and any column may be added to any base.
    """
    base = np.zeros(len(rows), np.int64)
    used = np.zeros(columns, bool)
    start = columns  # a row begins here or behind; holes in front are left to single entries
    several = [r for r in range(len(rows)) if len(rows[r]) > 1]
    for r in sorted(several, key=lambda r: -len(rows[r])):
        row = rows[r] - rows[r][0]
        while True:
            if len(used) < start + WINDOW + columns:
                used = np.concatenate([used, np.zeros(len(used) + WINDOW + columns, bool)])
            free = start + np.flatnonzero(~used[start : start + WINDOW])
            fits = np.flatnonzero(~used[free[:, None] + row].any(axis=1))
            if len(fits):
                break
            start += WINDOW
        place = free[fits[0]]
        base[r] = place - rows[r][0]
        used[place + row] = True
    single = np.array([r for r in range(len(rows)) if len(rows[r]) == 1], np.int64)
    if len(single):
        used = np.concatenate([used, np.zeros(len(single), bool)])
        place = columns + np.flatnonzero(~used[columns:])[: len(single)]
        base[single] = place - np.array([rows[r][0] for r in single])
    return base, int(base.max(initial=0)) + columns


def _cells(rows: Sequence[np.ndarray], columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bases, owner of each cell, cell of each entry in order of rows)."""
    base, cells = overlay(rows, columns)
    owner = np.full(cells, -1, np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = base[of] + (np.concatenate(rows) if len(of) else np.zeros(0, np.int64))
    owner[at] = of
    return base, owner, at


def compiled(words: Iterable[tuple[bytes, Ids]], merges: np.ndarray, symbols: int) -> bytes:
    """The file's content. ``merges`` has rows (left, right, merged) in order of their rank."""
    states = minimal(words)
    pool: dict[Ids, int] = {(): 0}
    written: list[int] = []

    def place(ids: Ids) -> int:
        if ids not in pool:
            pool[ids] = len(written)
            written.extend(ids)
        return pool[ids]

    tails = [(place(t), len(t)) if t is not None else (0, -1) for t, _ in states]
    rows = [np.array(sorted(b for b, _, _ in arcs), np.int64) for _, arcs in states]
    base, owner, at = _cells(rows, 256)
    arcs = [(to, place(out), len(out)) for _, state in states for _, to, out in sorted(state)]
    cells = np.zeros((len(owner), 4), np.int64)
    cells[:, 0] = owner
    cells[at, 1:] = np.array(arcs, np.int64).reshape(-1, 3)

    order = np.lexsort((merges[:, 1], merges[:, 0]))
    left = merges[order, 0]
    lefts = np.split(merges[order, 1], np.searchsorted(left, np.arange(1, symbols)))
    pair_base, pair_owner, pair_at = _cells(lefts, symbols)
    pairs = np.zeros((len(pair_owner), 2), np.int64)
    pairs[:, 0] = pair_owner
    pairs[pair_at, 1] = order
    parts = [base, np.array(tails).reshape(-1, 2), cells, np.array(written), pair_base, pairs, merges[:, 2]]
    head = np.array([MAGIC, len(states), len(cells), len(written), symbols, len(pairs), len(merges)])
    return b"".join(np.ascontiguousarray(p, "<i4").tobytes() for p in (head, *parts))


class Lexicon:
    """A file of ``compiled``, mapped: workers of a machine share its pages."""

    #: Longer words are merged symbol by symbol, shorter ones together.
    TOGETHER = 64
    NEVER = np.int32(2**31 - 1)

    def __init__(self, path: str):
        whole = np.memmap(path, np.uint8, mode="r")
        # A line feed of the writer may follow the last number.
        data = whole[: len(whole) // 4 * 4].view("<i4")
        magic, states, cells, pool, symbols, pairs, merges = (int(x) for x in data[:7])
        if magic != MAGIC:
            raise ValueError(f"{path} is not a lexicon")
        shapes = [(states,), (states, 2), (cells, 4), (pool,), (symbols,), (pairs, 2), (merges,)]
        at, parts = 7, []
        for shape in shapes:
            size = int(np.prod(shape))
            parts.append(data[at : at + size].reshape(shape))
            at += size
        self.base, self.tails, self.cells, self.pool, self.pair_base, self.pairs, self.merged = parts
        self.start = states - 1

    def find(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, ids, ids of each word) of the words ``data[offsets[i]:offsets[i + 1]]``."""
        sizes = np.diff(offsets)
        found = np.zeros(len(sizes), bool)
        live = np.arange(len(sizes))
        state = np.full(len(sizes), self.start)
        none = np.zeros(0, np.int64)
        pieces = [(none, none, none)]
        step = 0
        while len(live):
            ended = sizes[live] == step
            if ended.any():
                word, tail = live[ended], self.tails[state[ended]]
                whole = tail[:, 1] >= 0
                found[word[whole]] = True
                pieces.append((word[whole], tail[whole, 0], tail[whole, 1]))
                live, state = live[~ended], state[~ended]
            cell = self.cells[self.base[state] + data[offsets[live] + step]]
            goes = cell[:, 0] == state
            live, cell = live[goes], cell[goes]
            state = cell[:, 1]
            some = cell[:, 3] > 0
            pieces.append((live[some], cell[some, 2], cell[some, 3]))
            step += 1
        word, place, size = (np.concatenate(x) for x in zip(*pieces, strict=True))
        keep = found[word] & (size > 0)
        word, place, size = word[keep], place[keep], size[keep]
        order = np.argsort(word, kind="stable")  # a word's pieces stay in order
        ids = self.pool[ranges(place[order], size[order])]
        return found, ids, np.bincount(word, size, len(sizes)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; NEVER if there is none. -1 is no symbol."""
        cell = self.pairs[self.pair_base[left] + np.maximum(right, 0)]
        return np.where((cell[..., 0] == left) & (right >= 0) & (left >= 0), cell[..., 1], self.NEVER)

    def merge(self, words: np.ndarray) -> np.ndarray:
        """Merge the symbols of many words; rows end in -1. The lowest rank goes first, of equal
        ones the leftmost, one merge of each word a round."""
        out = np.full(words.shape, -1, np.int32)
        live = np.arange(len(words))
        words = words.astype(np.int32)
        rank = self.ranks(words[:, :-1], words[:, 1:])
        while words.shape[1] > 1 and len(words):
            best = rank.argmin(axis=1)
            lowest = rank[np.arange(len(rank)), best]
            ended = lowest == self.NEVER
            if ended.any():
                out[live[ended], : words.shape[1]] = words[ended]
                live, words, rank, best, lowest = (x[~ended] for x in (live, words, rank, best, lowest))
                if not len(live):
                    return out
            row = np.arange(len(live))
            words[row, best + 1] = self.merged[lowest]
            width = words.shape[1] - 1
            # Without the left symbol of the merge, and without its rank.
            behind = np.arange(width) >= best[:, None]
            words = np.where(behind, words[:, 1:], words[:, :-1])
            rank = np.where(behind[:, : width - 1], rank[:, 1:], rank[:, :-1])
            if width > 1:
                at = np.flatnonzero(best > 0)
                k = best[at]
                rank[at, k - 1] = self.ranks(words[at, k - 1], words[at, k])
                at = np.flatnonzero(best < width - 1)
                k = best[at]
                rank[at, k] = self.ranks(words[at, k], words[at, k + 1])
        out[live, : words.shape[1]] = words
        return out

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """Merge one long word: a heap of the pairs by rank and place."""
        ids = symbols.tolist()
        ahead, behind = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        first = self.ranks(symbols[:-1], symbols[1:])
        heap = [(int(first[i]), i) for i in np.flatnonzero(first != self.NEVER).tolist()]
        heapq.heapify(heap)
        rank = first.tolist() + [int(self.NEVER)]
        base, pairs, never = self.pair_base, self.pairs, int(self.NEVER)

        def fresh(i: int) -> None:
            j = ahead[i]
            rank[i] = never
            if j < len(ids):
                owner, r = pairs[base[ids[i]] + ids[j]]
                if owner == ids[i]:
                    rank[i] = int(r)
                    heapq.heappush(heap, (rank[i], i))

        while heap:
            r, i = heapq.heappop(heap)
            if rank[i] != r:
                continue
            j = ahead[i]
            ids[i], ids[j], rank[j] = int(self.merged[r]), -1, never
            ahead[i] = ahead[j]
            if ahead[i] < len(ids):
                behind[ahead[i]] = i
            fresh(i)
            if behind[i] >= 0:
                fresh(behind[i])
        return np.array([x for x in ids if x >= 0], np.int32)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] numbers), then those of the next, ..."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)
