"""Gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, carried state.

Tokens are numbers: 0 ends a document, further head words follow, then tail buckets, which stand for all rarer words. The
probability of a head word is that of its class times that within the class; a tail bucket is a class of its own.
Documents run one after another in parallel lanes; a lane's state goes on from window to window and starts from zero
where a document starts, so the log-likelihood of a document does not depend on windows, lanes or neighbours.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

#: Steps that gradients go back; lanes that run side by side in training and scoring; longest run of a lane in training.
WINDOW, TRAIN_LANES, SCORE_LANES, SEGMENT = 32, 192, 192, 1024
#: Targets whose class scores are worked out at once, so that they stay in a core's cache; targets that scoring gathers, as the last steps of
#: long documents have few; sum of weights up to which no exponential overflows.
BLOCK, SCORED_AT_ONCE, SAFE = 1024, 16_384, 60.0


class Shape:
    """Sizes of a model: head tokens in classes (``bounds``, token numbers), tail buckets, hidden units."""

    def __init__(self, bounds: list[int], buckets: int, hidden: int):
        self.bounds, self.buckets, self.hidden = np.array(bounds), buckets, hidden
        self.head = bounds[-1]
        self.tokens = self.head + buckets
        self.classes = len(bounds) - 1 + buckets
        self.class_of = np.concatenate([np.searchsorted(self.bounds, np.arange(self.head), "right") - 1, np.arange(len(bounds) - 1, self.classes)]).astype(np.uint16)
        h = hidden
        self.parts = {"embed": (self.tokens, 3 * h), "recur": (h, 3 * h), "to_class": (h, self.classes), "class_bias": (self.classes,), "to_word": (h, self.head), "word_bias": (self.head,)}
        self.size = sum(int(np.prod(s)) for s in self.parts.values())

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.parts.items():
            n = int(np.prod(shape))
            out[name] = flat[at : at + n].reshape(shape)
            at += n
        for name, choices in (("class", self.classes), ("word", self.head)):  # weights and, as their last row, biases
            at = sum(int(np.prod(s)) for s in list(self.parts.values())[: list(self.parts).index(f"to_{name}")])
            out[name] = flat[at : at + (self.hidden + 1) * choices].reshape(self.hidden + 1, choices)
        return out

    def first(self, mass: np.ndarray) -> np.ndarray:
        """Parameters before training: output biases give the corpus frequencies ``mass`` of the tokens."""
        rng = np.random.default_rng(7)
        flat = np.zeros(self.size, np.float32)
        p = self.views(flat)
        p["embed"][:] = rng.normal(0, 0.3, p["embed"].shape)
        p["embed"][:, : self.hidden] += 1  # begin with long memory
        p["recur"][:] = rng.normal(0, 1 / np.sqrt(self.hidden), p["recur"].shape)
        log = np.log(np.maximum(mass, 1e-12))
        by_class = np.bincount(self.class_of, np.maximum(mass, 1e-12), self.classes)
        p["class_bias"][:] = np.log(by_class / by_class.sum())
        p["word_bias"][:] = log[: self.head]
        return flat


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Documents dealt to lanes, the longest first, each to the shortest lane."""
    out: list[list[int]] = [[] for _ in range(min(lanes, max(1, len(lengths))))]
    heap = [(0, i) for i in range(len(out))]
    for d in np.argsort(-lengths, kind="stable"):
        filled, lane = heapq.heappop(heap)
        out[lane].append(int(d))
        heapq.heappush(heap, (filled + int(lengths[d]), lane))
    return out


def laid_out(documents: list[np.ndarray], lanes: int) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """Tokens and document numbers as (step, lane) arrays, -1 where a lane has ended; and the documents of each lane."""
    lengths = np.array([len(d) for d in documents])
    dealt = lanes_of(lengths, lanes)
    steps = max(int(lengths[lane].sum()) if lane else 0 for lane in dealt)
    tokens, owner = np.full((steps, len(dealt)), -1, np.int32), np.full((steps, len(dealt)), -1, np.int32)
    for i, lane in enumerate(dealt):
        if lane:
            run = np.concatenate([documents[d] for d in lane])
            tokens[: len(run), i] = run
            owner[: len(run), i] = np.repeat(lane, lengths[lane])
    return tokens, owner, dealt


@dataclass
class Steps:
    """What backpropagation needs of a window, as (step, unit, lane) arrays: all lanes of a unit side by side."""

    before: np.ndarray
    gates: np.ndarray
    back: np.ndarray
    new: np.ndarray


def _states(shape: Shape, p: dict, seen: np.ndarray, goes_on: np.ndarray, state: np.ndarray, kept: bool):
    """Hidden states after each token of ``seen`` (steps, lanes). Where ``goes_on`` is 0 a run starts, from a zero state."""
    h, (steps, lanes), kind = shape.hidden, seen.shape, p["recur"].dtype
    fed = np.ascontiguousarray(p["embed"][seen].transpose(0, 2, 1))
    recur = np.ascontiguousarray(p["recur"].T)
    out = np.empty((steps, lanes, h), kind)
    held = Steps(*(np.empty((steps if kept else 1, units, lanes), kind) for units in (h, 2 * h, 3 * h, h)))
    state = np.array(state.T, kind, order="C")
    for t in range(steps):
        at = t if kept else 0
        before, gates, back, n = held.before[at], held.gates[at], held.back[at], held.new[at]
        np.multiply(state, goes_on[t], out=before)
        np.matmul(recur, before, out=back)
        np.add(fed[t, : 2 * h], back[: 2 * h], out=gates)
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(gates[h:], back[2 * h :], out=n)
        n += fed[t, 2 * h :]
        np.tanh(n, out=n)
        np.subtract(before, n, out=state)
        state *= gates[:h]
        state += n
        out[t] = state.T
    return out, state.T, held if kept else None


def _choice(all_weights: np.ndarray, inputs: np.ndarray, at: np.ndarray, share: float, slope: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probability of choice ``at[i]`` by softmax for each row of ``inputs``, whose last column is 1: the last row of the weights is the bias.

    With ``slope``, the gradient of the loss, of which each row is ``share``, is added there, and that for ``inputs`` is returned. Scores are
    (choice, row) arrays: what is summed over choices adds whole rows.
    """
    by_choice = np.ascontiguousarray(all_weights.T)
    scores = by_choice @ inputs.T
    if np.abs(by_choice).sum(axis=1).max() > SAFE:  # inputs lie within -1 and 1
        scores -= scores.max(axis=0)
    places = at * len(at)
    places += np.arange(len(at))
    cells = scores.reshape(-1)
    logp = cells[places]
    np.exp(scores, out=scores)
    total = scores.sum(axis=0)
    logp -= np.log(total)
    if slope is None:
        return logp, None
    np.divide(share, total, out=total)
    scores *= total
    cells[places] -= share
    slope += (scores @ inputs).T
    return logp, scores.T @ by_choice[:, :-1]


def _outputs(shape: Shape, p: dict, hidden: np.ndarray, target: np.ndarray, slope: dict | None):
    """Natural log probability of each target; with ``slope``, gradients of the mean loss are added there and returned for ``hidden``.

    Targets are put in the order of their classes, so that those of a class lie side by side.
    """
    n, kind = len(target), shape.class_of[target]
    order = np.argsort(kind, kind="stable")  # a radix sort
    inputs = np.ones((n, shape.hidden + 1), hidden.dtype)
    inputs[:, :-1] = hidden[order]
    kind, word = kind[order].astype(np.int64), target[order].astype(np.int64)
    logp, back = np.empty(n, hidden.dtype), np.empty_like(hidden) if slope else None
    for a in range(0, n, BLOCK):
        at = slice(a, a + BLOCK)
        logp[at], of_block = _choice(p["class"], inputs[at], kind[at], 1 / n, slope and slope["class"])
        if slope:
            back[at] = of_block
    cuts = np.searchsorted(kind, np.arange(len(shape.bounds)))
    for c in range(len(shape.bounds) - 1):
        low, high = shape.bounds[c], shape.bounds[c + 1]
        if cuts[c] == cuts[c + 1] or high - low < 2:
            continue
        at, words = slice(cuts[c], cuts[c + 1]), slice(low, high)
        inside, of_class = _choice(p["word"][:, words], inputs[at], word[at] - low, 1 / n, slope and slope["word"][:, words])
        logp[at] += inside
        if slope:
            back[at] += of_class
    placed, placed_back = np.empty_like(logp), np.empty_like(back) if slope else None
    placed[order] = logp
    if slope:
        placed_back[order] = back
    return placed, placed_back


def score(shape: Shape, flat: np.ndarray, documents: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of each document (its tokens, 0 last), state carried over all its windows."""
    total = np.zeros(len(documents))
    if not documents:
        return total
    p = shape.views(flat)
    tokens, owner, _ = laid_out(documents, SCORE_LANES)
    state, last = np.zeros((tokens.shape[1], shape.hidden), np.float32), np.zeros((1, tokens.shape[1]), np.int32)
    waiting, held = [], 0
    for a in range(0, len(tokens), WINDOW):
        window = tokens[a : a + WINDOW]
        valid = window >= 0
        lanes = valid.any(axis=0)
        fed = np.maximum(np.vstack([last, window[:-1]])[:, lanes], 0)  # an end token says: a document starts
        last = window[-1:]
        hidden, new, _ = _states(shape, p, fed, (fed != 0).astype(np.float32), state[lanes], False)
        state[lanes] = new
        valid = valid[:, lanes]
        waiting.append((hidden[valid], window[:, lanes][valid], owner[a : a + WINDOW][:, lanes][valid]))
        held += len(waiting[-1][1])
        if held >= SCORED_AT_ONCE or a + WINDOW >= len(tokens):
            hidden, target, of = (np.concatenate(w) for w in zip(*waiting, strict=True))
            total += np.bincount(of, _outputs(shape, p, hidden, target, None)[0], len(documents))
            waiting, held = [], 0
    return total


class Trainer:
    """Adam on windows of parallel lanes, starting from given parameters."""

    def __init__(self, shape: Shape, flat: np.ndarray, rate: float):
        self.shape, self.flat, self.rate = shape, flat.copy(), rate
        self.first, self.second, self.steps = np.zeros_like(self.flat), np.zeros_like(self.flat), 0

    def learn(self, documents: list[np.ndarray]) -> int:
        """One pass over documents; returns the number of tokens.

        Documents of over ``SEGMENT`` tokens are learned from in segments, so that one long document does not keep a single lane running. A
        segment starts from a zero state and, where it is not a document's first, is fed the token before it.
        """
        shape, h = self.shape, self.shape.hidden
        before = [np.append(0, d[:-1]).astype(np.int32) for d in documents]
        parts, leads = ([d[a : a + SEGMENT] for d in held for a in range(0, len(d), SEGMENT)] for held in (documents, before))
        if not parts:
            return 0
        tokens, owner, dealt = laid_out(parts, TRAIN_LANES)
        seen = np.zeros_like(tokens)
        for i, lane in enumerate(dealt):
            if lane:
                run = np.concatenate([leads[d] for d in lane])
                seen[: len(run), i] = run
        goes_on = np.vstack([np.zeros((1, owner.shape[1]), bool), owner[1:] == owner[:-1]]).astype(np.float32)
        state = np.zeros((tokens.shape[1], h), np.float32)
        grad = np.zeros_like(self.flat)
        for a in range(0, len(tokens), WINDOW):
            p, g = shape.views(self.flat), shape.views(grad)
            grad[:] = 0
            fed, on, valid = seen[a : a + WINDOW], goes_on[a : a + WINDOW], tokens[a : a + WINDOW] >= 0
            hidden, state, held = _states(shape, p, fed, on, state, True)
            _, back = _outputs(shape, p, hidden[valid], tokens[a : a + WINDOW][valid], g)
            from_output = np.zeros_like(hidden)
            from_output[valid] = back
            self._backward(p, g, fed, on, held, from_output)
            self._step(grad)
        return int((tokens >= 0).sum())

    def _backward(self, p: dict, g: dict, fed: np.ndarray, on: np.ndarray, held: Steps, from_output: np.ndarray) -> None:
        """Gradients of a window's embeddings and recurrent weights from those of its states. All that does not depend on later steps is
        worked out for the whole window at once."""
        h = self.shape.hidden
        z, r = held.gates[:, :h], held.gates[:, h:]
        kept = 1 - z
        to_new = 1 - held.new * held.new
        to_new *= kept
        to_keep = held.before - held.new
        to_keep *= z
        to_keep *= kept
        to_reset = held.back[:, 2 * h :] * r
        to_reset *= 1 - r
        onward = z * on[:, None, :]
        slopes = np.ascontiguousarray(from_output.transpose(0, 2, 1))
        pre = np.empty((len(fed), 3 * h, fed.shape[1]), slopes.dtype)
        to_reset *= to_new  # of a state's slope; that of the new state is taken with it
        by_reset = to_new * r
        carried, room = np.zeros_like(slopes[0]), np.empty_like(slopes[0])
        for t in range(len(fed) - 1, -1, -1):
            d = slopes[t]
            d += carried
            np.multiply(d, to_keep[t], out=pre[t, :h])
            np.multiply(d, to_reset[t], out=pre[t, h : 2 * h])
            np.multiply(d, by_reset[t], out=pre[t, 2 * h :])
            np.matmul(p["recur"], pre[t], out=carried)
            carried *= on[t]
            np.multiply(d, onward[t], out=room)
            carried += room
        g["recur"] += np.matmul(held.before, pre.transpose(0, 2, 1)).sum(axis=0)
        np.multiply(slopes, to_new, out=pre[:, 2 * h :])  # the input of the new state is not reset
        inputs = pre.transpose(0, 2, 1).reshape(-1, 3 * h)
        seen_at = fed.reshape(-1)
        order = np.argsort(seen_at.astype(np.uint16) if self.shape.tokens < 1 << 16 else seen_at, kind="stable")
        begins = np.flatnonzero(np.diff(seen_at[order], prepend=-1))
        g["embed"][seen_at[order][begins]] = np.add.reduceat(inputs[order], begins, axis=0)

    def _step(self, grad: np.ndarray) -> None:
        self.steps += 1
        norm = float(np.sqrt(grad @ grad))
        if norm > 1:
            grad /= norm
        room = grad - self.first
        room *= 0.1
        self.first += room
        np.multiply(grad, grad, out=room)
        room -= self.second
        room *= 0.01
        self.second += room
        np.sqrt(self.second, out=room)
        room += 1e-7
        np.divide(self.first, room, out=room)
        room *= self.rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        self.flat -= room
