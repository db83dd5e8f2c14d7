"""A gated recurrent network over word ids with a class-factored softmax, in numpy.

The output is P(class | history) * P(word | class, history). Frequent words (the head) have
classes of ``WIDTH`` words by falling frequency, with a softmax in each. All other words fall
into tail classes by their ending; there the network gives the class alone, and the caller
adds the word's share of its class from corpus counts. Biases start at the counts, so an
untrained network is the unigram model.

Texts lie one behind the other in lanes that step together. The state is carried from window
to window and set to zero where a text begins; gradients stop at a window's start. To learn, a
long text is cut into pieces for several lanes; each piece goes on from the word and the state
before it, which a pass over the text with the weights at hand has found.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

WIDTH = 128
STATE = 16
INPUT = 12
LANES = 384
WINDOW = 16
#: Longest piece of a text that is learnt in one lane; scores never cut a text.
PIECE = 1024
#: Ids that a worker packs into lanes at once to learn.
HELD_LEARN = 1_200_000


@dataclass(frozen=True)
class Vocabulary:
    """Ids: the head by falling frequency with the end mark first, then the tail classes."""

    head: int
    tail: int

    @property
    def size(self) -> int:
        return self.head + self.tail

    @property
    def head_classes(self) -> int:
        return -(-self.head // WIDTH)

    @property
    def classes(self) -> int:
        return self.head_classes + self.tail

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.head, ids // WIDTH, self.head_classes + ids - self.head)


def initial(vocabulary: Vocabulary, counts: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """Weights at the unigram model; ``counts`` are the ids' counts, all above 0."""
    rng = np.random.default_rng(seed)
    by_class = np.bincount(vocabulary.class_of(np.arange(vocabulary.size)), counts, vocabulary.classes)
    weights = {
        "emb": rng.normal(0, 0.3, (vocabulary.size, INPUT)),
        "in": rng.normal(0, 1 / np.sqrt(INPUT), (INPUT, 3 * STATE)),
        "in_bias": np.zeros(3 * STATE),
        "rec": rng.normal(0, 1 / np.sqrt(STATE), (STATE, 3 * STATE)),
        "cls": rng.normal(0, 0.01, (STATE, vocabulary.classes)),
        "cls_bias": np.log(by_class / by_class.sum()),
        "word": rng.normal(0, 0.01, (vocabulary.head, STATE)),
        "word_bias": np.log(counts[: vocabulary.head] / by_class[np.arange(vocabulary.head) // WIDTH]),
    }
    return {k: v.astype(np.float32) for k, v in weights.items()}


def lanes_of(texts: list[np.ndarray], lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(targets, inputs, text number, begin mark), each steps x lanes; -1 is padding.

    Longest first, each text goes to the shortest lane; lanes end up sorted by length. There are
    no more lanes than the longest text fills, so that few steps are padding.
    """
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    filled = -(-sum(map(len, texts)) // len(texts[order[0]]))
    heap = [(0, lane) for lane in range(min(lanes, len(texts), filled))]
    held: list[list[int]] = [[] for _ in heap]
    for i in order:
        length, lane = heapq.heappop(heap)
        held[lane].append(i)
        heapq.heappush(heap, (length + len(texts[i]), lane))
    held.sort(key=lambda x: -sum(len(texts[i]) for i in x))
    steps = sum(len(texts[i]) for i in held[0])
    target = np.full((len(held), steps), -1, dtype=np.int32)
    text = np.full((len(held), steps), -1, dtype=np.int32)
    begin = np.zeros((len(held), steps), dtype=bool)
    for lane, mine in enumerate(held):
        at = 0
        for i in mine:
            n = len(texts[i])
            target[lane, at : at + n], text[lane, at : at + n], begin[lane, at] = texts[i], i, True
            at += n
    previous = np.zeros_like(target)
    previous[:, 1:] = target[:, :-1]
    previous[begin | (previous < 0)] = 0
    return target.T.copy(), previous.T.copy(), text.T.copy(), begin.T.copy()


def pieces_of(weights: dict[str, np.ndarray], texts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Pieces of the texts, and of each the id and the state before it; first pieces have zeros."""
    texts = sorted(texts, key=len, reverse=True)
    gates = weights["emb"] @ weights["in"] + weights["in_bias"]
    pieces = [t[:PIECE] for t in texts]
    before = [np.zeros(len(texts), dtype=np.int32)]
    states = [np.zeros((len(texts), STATE), dtype=np.float32)]
    at = PIECE
    while live := sum(len(t) > at for t in texts):
        whole = np.stack([t[at - PIECE : at] for t in texts[:live]])
        inputs, h = np.column_stack([before[-1][:live], whole[:, :-1]]), states[-1][:live]
        for k in range(PIECE):
            h = _step(gates[inputs[:, k]], h @ weights["rec"], h)[2]
        pieces += [t[at : at + PIECE] for t in texts[:live]]
        before.append(whole[:, -1])
        states.append(h)
        at += PIECE
    return pieces, np.concatenate(before), np.concatenate(states)


def _picked(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log softmax at one column of each row; biases keep the logits small."""
    chosen = logits[np.arange(len(at)), at]
    return chosen - np.log(np.exp(logits, out=logits).sum(axis=1))


def _error(logits: np.ndarray, at: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Scaled gradient of the log loss at the logits."""
    np.exp(logits, out=logits)
    logits *= (scale / logits.sum(axis=1))[:, None]
    logits[np.arange(len(at)), at] -= scale
    return logits


def _step(a: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    zr = a[:, : 2 * STATE] + g[:, : 2 * STATE]
    np.negative(zr, out=zr)
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    n = np.tanh(a[:, 2 * STATE :] + zr[:, STATE:] * g[:, 2 * STATE :])
    return zr, n, n + zr[:, :STATE] * (h - n)


def _by_class(vocabulary: Vocabulary, ids: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, last) id of each head class and the positions of its ids."""
    order = np.argsort(ids, kind="stable")
    edges = np.arange(0, vocabulary.head + WIDTH, WIDTH)
    edges[-1] = vocabulary.head
    cuts = np.searchsorted(ids[order], edges)
    for c in range(vocabulary.head_classes):
        if cuts[c + 1] > cuts[c]:
            yield int(edges[c]), int(edges[c + 1]), order[cuts[c] : cuts[c + 1]]


def score(vocabulary: Vocabulary, weights: dict[str, np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """Natural log of the probability of each text's ids; the state runs through whole texts."""
    total = np.zeros(len(texts))
    if not texts:
        return total
    gates = weights["emb"] @ weights["in"] + weights["in_bias"]
    target, previous, text, begin = lanes_of(texts, LANES)
    h = np.zeros((target.shape[1], STATE), dtype=np.float32)
    for start in range(0, len(target), WINDOW):
        part = slice(start, start + WINDOW)
        live = int((target[start] >= 0).sum())  # lanes are sorted by length
        t, p, x, b = (m[part, :live] for m in (target, previous, text, begin))
        h = h[:live]
        a = gates[p]
        states = np.empty((*t.shape, STATE), dtype=np.float32)
        for k in range(len(t)):
            if b[k].any():
                h = h * ~b[k][:, None]
            h = states[k] = _step(a[k], h @ weights["rec"], h)[2]
        real = t.ravel() >= 0
        ids, flat, owner = t.ravel()[real], states.reshape(-1, STATE)[real], x.ravel()[real]
        logits = flat @ weights["cls"]
        logits += weights["cls_bias"]
        found = _picked(logits, vocabulary.class_of(ids)).astype(float)
        for first, last, at in _by_class(vocabulary, ids):
            logits = flat[at] @ weights["word"][first:last].T
            logits += weights["word_bias"][first:last]
            found[at] += _picked(logits, ids[at] - first)
        total += np.bincount(owner, found, len(texts))
    return total


def _gradient(
    vocabulary: Vocabulary,
    w: dict[str, np.ndarray],
    t: np.ndarray,
    p: np.ndarray,
    b: np.ndarray,
    h: np.ndarray,
    first_states: np.ndarray | None = None,
) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Mean gradient of the window's log loss, and the state at its end.

    ``first_states`` are the states where ``b`` marks a beginning, row by row; zeros without.
    """
    used = 0
    emb = w["emb"][p]
    a = emb @ w["in"] + w["in_bias"]
    kept = []
    states = np.empty((*t.shape, STATE), dtype=np.float32)
    for k in range(len(t)):
        h = h * ~b[k][:, None]
        if first_states is not None and (n := int(b[k].sum())):
            h[b[k]] = first_states[used : used + n]
            used += n
        g = h @ w["rec"]
        zr, n, new = _step(a[k], g, h)
        kept.append((h, g, zr, n))
        h = states[k] = new
    real = t.ravel() >= 0
    flat, ids = states.reshape(-1, STATE), np.where(real, t.ravel(), 0)
    scale = real.astype(np.float32) / np.float32(max(int(real.sum()), 1))
    grad = {k: np.zeros_like(v) for k, v in w.items() if k in ("word", "word_bias", "rec")}
    logits = flat @ w["cls"]
    logits += w["cls_bias"]
    at_class = _error(logits, vocabulary.class_of(ids), scale)
    grad["cls"], grad["cls_bias"] = flat.T @ at_class, at_class.sum(0)
    at_state = at_class @ w["cls"].T
    for first, last, at in _by_class(vocabulary, np.where(real, t.ravel(), vocabulary.size)):
        mine = flat[at]
        logits = mine @ w["word"][first:last].T
        logits += w["word_bias"][first:last]
        at_word = _error(logits, ids[at] - first, scale[at])
        grad["word"][first:last] = at_word.T @ mine
        grad["word_bias"][first:last] = at_word.sum(0)
        at_state[at] += at_word @ w["word"][first:last]
    at_state = at_state.reshape(states.shape)
    at_gates = np.empty_like(a)
    back = w["rec"].T.copy()
    dh = np.zeros_like(h)
    for k in range(len(t) - 1, -1, -1):
        before, g, zr, n = kept[k]
        z, r = zr[:, :STATE], zr[:, STATE:]
        dh = dh + at_state[k]
        dn = dh * (1 - z) * (1 - n * n)
        da = at_gates[k]
        da[:, :STATE] = dh * (before - n) * z * (1 - z)
        da[:, STATE : 2 * STATE] = dn * g[:, 2 * STATE :] * r * (1 - r)
        da[:, 2 * STATE :] = dn
        dg = da.copy()
        dg[:, 2 * STATE :] *= r
        grad["rec"] += before.T @ dg
        dh = (dh * z + dg @ back) * ~b[k][:, None]
    flat_gates = at_gates.reshape(-1, 3 * STATE)
    grad["in"] = emb.reshape(-1, INPUT).T @ flat_gates
    grad["in_bias"] = flat_gates.sum(0)
    # Sums by id: counting column by column is several times faster than adding rows in place.
    at_input, inputs = flat_gates @ w["in"].T, p.ravel()
    columns = [np.bincount(inputs, at_input[:, j], len(w["emb"])) for j in range(INPUT)]
    grad["emb"] = np.stack(columns, axis=1).astype(np.float32)
    return grad, h


class Learner:
    """Adam steps on windows of packed texts, from given weights."""

    def __init__(self, vocabulary: Vocabulary, weights: dict[str, np.ndarray], rate: float):
        self.vocabulary, self.rate, self.steps, self.learnt = vocabulary, rate, 0, 0
        self.held: list[np.ndarray] = []
        self.weights = {k: v.copy() for k, v in weights.items()}
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}

    def _move(self, grad: dict[str, np.ndarray]) -> None:
        self.steps += 1
        rate = self.rate * min(1.0, self.steps / 20)
        size = np.sqrt(sum(float(np.vdot(g, g)) for g in grad.values()))
        clip = np.float32(min(1.0, 1.0 / max(size, 1e-9)))
        fix1, fix2 = 1 - 0.9**self.steps, 1 - 0.99**self.steps
        for k, g in grad.items():
            g = g * clip
            self.first[k] += np.float32(0.1) * (g - self.first[k])
            self.second[k] += np.float32(0.01) * (g * g - self.second[k])
            spread = np.sqrt(self.second[k] / np.float32(fix2)) + np.float32(1e-6)
            self.weights[k] -= np.float32(rate / fix1) * self.first[k] / spread

    def take(self, texts: list[np.ndarray]) -> None:
        self.held += texts
        if sum(map(len, self.held)) >= HELD_LEARN:
            self.finish()

    def finish(self) -> None:
        if self.held:
            self._learn(self.held)
            self.held = []

    def _learn(self, texts: list[np.ndarray]) -> None:
        pieces, before, states = pieces_of(self.weights, texts)
        target, previous, piece, begin = lanes_of(pieces, LANES)
        previous[begin] = before[piece[begin]]
        h = np.zeros((target.shape[1], STATE), dtype=np.float32)
        for start in range(0, len(target), WINDOW):
            part = slice(start, start + WINDOW)
            live = int((target[start] >= 0).sum())
            t, p, x, b = (m[part, :live] for m in (target, previous, piece, begin))
            grad, h = _gradient(self.vocabulary, self.weights, t, p, b, h[:live], states[x[b]])
            self._move(grad)
        self.learnt += sum(map(len, pieces))


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)])


def shaped(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out
