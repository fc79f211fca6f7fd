"""A small gated recurrent language model in numpy.

The output softmax is factored: a softmax over classes, then one over the words of the class.
Classes with a word layer hold the frequent words, cut by frequency into
classes of about equal mass; the other classes stand for rarer words, whose share in their class comes from counts
(the caller's). A batch is many lanes of documents back to back; the state is
carried from window to window and set to zero where a document begins.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

HIDDEN, WINDOW = 16, 24
RATE, CLIP, FIRST = 0.1, 1.0, 1e-3
#: States whose output is computed together in scoring.
OUTPUTS = 1 << 13


@dataclass(frozen=True)
class Shape:
    """``words`` with the word layer come first among the ids, then one id for each counted class."""

    borders: tuple[int, ...]  # first word of each class with a word layer, and their end
    counted: int
    hidden: int = HIDDEN

    @property
    def words(self) -> int:
        return self.borders[-1]

    @property
    def layered(self) -> int:
        return len(self.borders) - 1

    @property
    def classes(self) -> int:
        return self.layered + self.counted

    @property
    def sizes(self) -> dict[str, tuple[int, ...]]:
        h = self.hidden
        return {"gates": (self.words + self.counted, 3 * h), "state": (h, 3 * h), "class_w": (h, self.classes), "class_b": (self.classes,),
                "word_w": (self.words, h), "word_b": (self.words,)}

    @property
    def total(self) -> int:
        return sum(int(np.prod(s)) for s in self.sizes.values())


def classes_by_mass(counts: np.ndarray, classes: int) -> tuple[int, ...]:
    """Borders that cut words in descending order of count into at most ``classes`` of about equal mass."""
    mass = np.cumsum(counts)
    place = np.minimum((mass - counts / 2) * classes // mass[-1], classes - 1)
    return (*np.flatnonzero(np.diff(place, prepend=-1)).tolist(), len(counts))


def start(shape: Shape, counts: np.ndarray, class_counts: np.ndarray) -> np.ndarray:
    """Parameters that begin at the words' and classes' plain frequencies."""
    rng = np.random.default_rng(0)
    p = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in shape.sizes.items()}
    p["class_b"] = np.log(class_counts + 1.0).astype(np.float32)
    p["class_b"] -= p["class_b"].max()
    p["word_b"] = np.log(counts + 1.0).astype(np.float32)
    for a, b in zip(shape.borders[:-1], shape.borders[1:], strict=True):
        p["word_b"][a:b] -= p["word_b"][a:b].max()
    p["word_w"] *= 0.1
    p["class_w"] *= 0.1
    return np.concatenate([p[k].ravel() for k in shape.sizes])


def lanes(lengths: np.ndarray, most: int) -> list[np.ndarray]:
    """Documents (indices) of each lane, the lanes about equally long, the longest first."""
    n = max(1, min(most, len(lengths)))
    order = np.argsort(-lengths, kind="stable")
    heap = [(0, i) for i in range(n)]
    found: list[list[int]] = [[] for _ in range(n)]
    for d, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        load, i = heap[0]
        found[i].append(d)
        heapq.heapreplace(heap, (load + size, i))
    loads = {i: load for load, i in heap}
    return [np.array(found[i]) for i in sorted(range(n), key=lambda i: (-loads[i], i))]


def _large(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether logits could leave the range of exp; states lie between -1 and 1."""
    return bool(np.abs(weights).sum(axis=1).max() + np.abs(bias).max() > 60)


def _logits(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, large: bool) -> np.ndarray:
    """Logits, shifted by each row's largest if they could be large."""
    logits = h @ weights
    logits += bias
    if large:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.minimum(x, np.float32(80), out=x)
    np.exp(x, out=x)
    x += 1
    return np.divide(1, x, out=x)


def _by_id(ids: np.ndarray) -> np.ndarray:
    """A stable order of small integers (16 bits are sorted by digits)."""
    return np.argsort(ids.astype(np.int16) if len(ids) and ids.max() < 1 << 15 else ids, kind="stable")


def _total(e: np.ndarray) -> np.ndarray:
    """Sums by row (as a product, which is faster)."""
    return e @ np.ones(e.shape[1], np.float32)


class Gru:
    def __init__(self, shape: Shape, flat: np.ndarray):
        self.shape, self.flat = shape, flat.astype(np.float32).copy()
        self.p, at = {}, 0
        for k, s in shape.sizes.items():
            n = int(np.prod(s))
            self.p[k] = self.flat[at:at + n].reshape(s)
            at += n
        self.seen = {k: np.full(s, FIRST, dtype=np.float32) for k, s in shape.sizes.items()}
        self.class_of = np.concatenate([np.repeat(np.arange(shape.layered), np.diff(shape.borders)), shape.layered + np.arange(shape.counted)])

    # -- forward

    def window(self, ids: np.ndarray, keep: np.ndarray, h: np.ndarray, tape: list | None = None) -> np.ndarray:
        """States after each step (steps, lanes, hidden). ``ids``: inputs by step and lane; ``keep``: 0 where a document begins."""
        n, u = self.shape.hidden, self.p["state"]
        out = np.empty((*ids.shape, n), dtype=np.float32)
        for t in range(len(ids)):
            h = h * keep[t][:, None]
            x, v = self.p["gates"].take(ids[t], axis=0), h @ u
            zr = _sigmoid(x[:, :2 * n] + v[:, :2 * n])
            z, r = zr[:, :n], zr[:, n:]
            new = r * v[:, 2 * n:]
            new += x[:, 2 * n:]
            np.tanh(new, out=new)
            if tape is not None:
                tape.append((h, z, r, new, v[:, 2 * n:]))
            after = np.subtract(h, new, out=out[t])
            after *= z
            after += new
            h = after
        return out

    def output(self, h: np.ndarray, target: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray | None, dict | None, np.ndarray | None]:
        """Log-probability (natural) of each target's class, times its word's if its class has a word layer. With
        weights, instead the gradients of their weighted sum by parameter (negated, for descent) and by state."""
        p, cls = self.p, self.class_of[target]
        rows = np.arange(len(h))
        e = _logits(h, p["class_w"], p["class_b"], _large(p["class_w"].T, p["class_b"]))
        own_logit = e[rows, cls] if weight is None else None
        total = _total(np.exp(e, out=e))
        score = grads = back = None
        if weight is None:
            score = own_logit - np.log(total)
        else:
            e *= (weight / total)[:, None]
            e[rows, cls] -= weight
            grads = {"class_w": h.T @ e, "class_b": e.sum(axis=0), "word": {}}
            back = e @ p["class_w"].T
        large = _large(p["word_w"], p["word_b"])
        order = _by_id(cls)
        cuts = np.searchsorted(cls[order], np.arange(self.shape.layered + 1))
        for c in range(self.shape.layered):
            at = order[cuts[c]:cuts[c + 1]]
            a, b = self.shape.borders[c], self.shape.borders[c + 1]
            if not len(at) or b - a == 1:
                continue
            own = h[at]
            e = _logits(own, p["word_w"][a:b].T, p["word_b"][a:b], large)
            k, own_target = np.arange(len(at)), target[at] - a
            own_logit = e[k, own_target] if weight is None else None
            total = _total(np.exp(e, out=e))
            if weight is None:
                score[at] += own_logit - np.log(total)
            else:
                own_weight = weight[at]
                e *= (own_weight / total)[:, None]
                e[k, own_target] -= own_weight
                grads["word"][c] = (e.T @ own, e.sum(axis=0))
                back[at] += e @ p["word_w"][a:b]
        return score, grads, back

    # -- training

    def _descend(self, name: str, at, grad: np.ndarray, rate: float) -> None:
        np.clip(grad, -CLIP, CLIP, out=grad)
        seen = self.seen[name][at]
        seen += grad * grad
        self.seen[name][at] = seen
        self.p[name][at] -= rate * grad / np.sqrt(seen)

    def train(self, ids: np.ndarray, offsets: np.ndarray, most_lanes: int, rate: float = RATE) -> None:
        """One pass of truncated backpropagation over documents (ids back to back, each one's end last)."""
        n = self.shape.hidden
        for ids, target, keep, weight, h in chopped(ids, offsets, most_lanes, n):
            tape: list = []
            out = self.window(ids, keep, h, tape)
            h[:] = out[-1]
            flat_w = weight.ravel()
            _, grads, back = self.output(out.reshape(-1, n), target.ravel(), flat_w / max(1.0, flat_w.sum()) * 32)
            back = back.reshape(out.shape)
            inner = np.empty((*ids.shape, 3 * n), dtype=np.float32)  # by the gates' inputs from the state
            new_in = np.empty_like(out)  # by the new state's input from the token
            dh = np.zeros_like(out[0])
            before, z, r, new, v = map(np.stack, zip(*tape, strict=True))
            far, rest, flat, shut = before - new, 1 - z, 1 - new * new, 1 - r
            for t in range(len(ids) - 1, -1, -1):
                dh += back[t]
                dn = np.multiply(dh, rest[t], out=new_in[t])
                dn *= flat[t]
                dz, dr = dh * far[t], dn * v[t]
                dz *= z[t]
                dr *= r[t]
                np.multiply(dz, rest[t], out=inner[t, :, :n])
                np.multiply(dr, shut[t], out=inner[t, :, n:2 * n])
                np.multiply(dn, r[t], out=inner[t, :, 2 * n:])
                dh *= z[t]
                dh += inner[t] @ self.p["state"].T
                dh *= keep[t][:, None]
            self._descend("state", slice(None), before.reshape(-1, n).T @ inner.reshape(-1, 3 * n), rate)
            inner[:, :, 2 * n:] = new_in  # now by the inputs from the token
            order = _by_id(ids.ravel())
            ordered = ids.ravel()[order]
            begins = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
            self._descend("gates", ordered[begins], np.add.reduceat(inner.reshape(-1, 3 * n)[order], begins, axis=0), rate)
            self._descend("class_w", slice(None), grads["class_w"], rate)
            self._descend("class_b", slice(None), grads["class_b"], rate)
            for c, (w, b) in grads["word"].items():
                own = slice(self.shape.borders[c], self.shape.borders[c + 1])
                self._descend("word_w", own, w, rate)
                self._descend("word_b", own, b, rate)

    # -- scoring

    def log_likelihood(self, docs: list[np.ndarray], most_lanes: int) -> np.ndarray:
        """Natural log-probability of each whole document (ids, the end's id last), without the shares inside counted classes."""
        total = np.zeros(len(docs))
        n = self.shape.hidden
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> None:
            states, targets, owners = (np.concatenate(x) for x in zip(*waiting, strict=True))
            total[:] += np.bincount(owners, self.output(states, targets)[0], minlength=len(docs))
            waiting.clear()

        held = 0
        for ids, target, keep, owner, h in windows(docs, most_lanes, n):
            out = self.window(ids, keep, h[:ids.shape[1]])
            h[:ids.shape[1]] = out[-1]
            real = owner >= 0
            waiting.append((out[real], target[real], owner[real]))
            held += len(waiting[-1][1])
            if held >= OUTPUTS:
                flush()
                held = 0
        if waiting:
            flush()
        return total


def _sources(target: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The input before each target (a document's first is its end's id), and where documents begin."""
    heads, ends = offsets[:-1], offsets[1:] - 1
    first = np.zeros(len(target), dtype=bool)
    first[heads] = True
    source = np.empty_like(target)
    source[1:] = target[:-1]
    source[heads] = target[ends]
    return source, first


def chopped(ids: np.ndarray, offsets: np.ndarray, most_lanes: int, hidden: int):
    """For training: (inputs, targets, keep, weight, state) of windows over the whole stream cut into equal lanes; a document cut by a lane's border goes
    on with a zero state."""
    if not len(ids):
        return
    source, first = _sources(ids, offsets)
    n = max(1, min(most_lanes, -(-len(ids) // WINDOW)))
    size = -(-len(ids) // n)
    state = np.zeros((n, hidden), dtype=np.float32)
    for lo in range(0, size, WINDOW):
        step = lo + np.arange(min(WINDOW, size - lo))[:, None]
        at = np.arange(n) * size + step
        inside = at < len(ids)
        at = np.minimum(at, len(ids) - 1)
        yield source[at], ids[at], np.where(first[at] | (step == 0), 0, 1).astype(np.float32), inside.astype(np.float32), state


def windows(docs: list[np.ndarray], most_lanes: int, hidden: int):
    """For scoring: (inputs, targets, keep, document or -1, state) of each window, by step and lane. A lane holds whole documents;
    lanes that have ended leave the window. The caller updates the carried ``state``."""
    if not docs:
        return
    lengths = np.array([len(d) for d in docs])
    lane = lanes(lengths, most_lanes)
    loads = np.array([int(lengths[x].sum()) for x in lane])
    begins = np.concatenate([[0], np.cumsum(loads)])
    order = np.concatenate(lane)
    target = np.concatenate([docs[d] for d in order])
    source, first = _sources(target, np.concatenate([[0], np.cumsum(lengths[order])]))
    owner = np.repeat(order, lengths[order])
    state = np.zeros((len(lane), hidden), dtype=np.float32)
    for lo in range(0, int(loads[0]), WINDOW):
        live = int(np.searchsorted(-loads, -lo, side="left"))  # lanes longer than lo
        at = begins[:live] + lo + np.arange(min(WINDOW, int(loads[0]) - lo))[:, None]
        inside = at < begins[1:live + 1]
        at = np.where(inside, at, begins[:live])
        yield source[at], target[at], np.where(first[at] & inside, 0, 1).astype(np.float32), np.where(inside, owner[at], -1), state
