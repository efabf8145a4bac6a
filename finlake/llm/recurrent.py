"""Gated recurrent language model in numpy.

Symbols are numbered by frequency and dealt to classes of about the square root of their number, so that both softmaxes
are of like width; a symbol's probability is that of its class times that of the symbol within the class, given the state
before it. Texts run side by side in lanes, one after
the other within a lane; the state is zero where a text starts and is carried from window to window, so long texts are
scored whole. Training stops back-propagation at the window's start and steps along gradients scaled by their history.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

HIDDEN, LANES, WINDOW, RATE = 16, 384, 24, 0.1
ROWS = 1024  # taken through a softmax at once, so that its odds stay in a core's cache
HALF = np.float32(0.5)
LIMIT = np.float32(60)  # of logits, so that their odds fit
_NAMES = ("enter", "turn", "start", "to_class", "class_bias", "to_symbol", "symbol_bias")


class Lanes:
    """Texts of symbol numbers dealt to lanes, the longest first, each to the shortest lane so far."""

    def __init__(self, texts: list[np.ndarray], lanes: int):
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        heap = [(0, lane) for lane in range(min(lanes, len(texts)))]
        dealt: list[list[int]] = [[] for _ in heap]
        for i in order:
            held, lane = heapq.heappop(heap)
            dealt[lane].append(i)
            heapq.heappush(heap, (held + len(texts[i]), lane))
        dealt.sort(key=lambda own: -sum(len(texts[i]) for i in own))
        flat = [i for own in dealt for i in own]
        self.symbols = np.concatenate([texts[i] for i in flat]).astype(np.int32)
        sizes = np.array([len(texts[i]) for i in flat])
        self.text = np.repeat(np.array(flat, np.int32), sizes)
        self.begins = np.zeros(len(self.symbols), bool)
        self.begins[np.cumsum(sizes) - sizes] = True
        self.length = np.array([sum(len(texts[i]) for i in own) for own in dealt])
        self.first = np.cumsum(self.length) - self.length

    def windows(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, inside), both size x lanes still running: where to read, and which places are in the lane."""
        for at in range(0, int(self.length.max(initial=0)), size):
            running = int(np.count_nonzero(self.length > at))
            steps = at + np.arange(min(size, int(self.length[0]) - at))[:, None]
            inside = steps < self.length[None, :running]
            yield self.first[None, :running] + np.minimum(steps, self.length[None, :running] - 1), inside


def class_size(symbols: int) -> int:
    """The power of two at or below the square root, 32 at least."""
    return max(32, 1 << (max(symbols, 1).bit_length() - 1) // 2)


def new_model(counts: np.ndarray, hidden: int = HIDDEN, seed: int = 11) -> dict[str, np.ndarray]:
    """Parameters that give each symbol its share of the counts, whatever the state; a negative count marks no symbol."""
    rng = np.random.default_rng(seed)
    size = class_size(len(counts))
    classes = -(-len(counts) // size)
    padded = np.full(classes * size, -1.0)
    padded[: len(counts)] = counts
    weight = np.where(padded < 0, 0, padded + 0.5).reshape(classes, size)
    with np.errstate(divide="ignore"):
        symbol_bias = np.maximum(np.log(weight / np.maximum(weight.sum(axis=1, keepdims=True), 0.5)), -LIMIT)
        class_bias = np.maximum(np.log(weight.sum(axis=1) / weight.sum()), -LIMIT)
    model = {
        "enter": rng.normal(0, 0.3, (classes * size, 3 * hidden)), "turn": rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)),
        "start": np.zeros(3 * hidden), "to_class": np.zeros((hidden, classes)), "class_bias": class_bias,
        "to_symbol": np.zeros((classes, hidden, size)), "symbol_bias": symbol_bias,
    }
    model["start"][:hidden] = -1.0  # gates start a little open
    return {k: v.astype(np.float32) for k, v in model.items()}


def flatten(model: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([model[k].ravel() for k in _NAMES])


def unflatten(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in _NAMES:
        out[k] = values[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _forward(model, symbols, begins, state, keep_all: bool):
    """States before each step, the state after the last, and what the way back needs."""
    steps, lanes = symbols.shape
    hidden = len(model["turn"])
    entered = model["enter"][symbols]
    entered += model["start"]
    before = np.empty((steps, lanes, hidden), np.float32)
    saved = []
    turn, h, some = model["turn"], state, begins.any(axis=1).tolist()
    for t in range(steps):
        if some[t]:
            h = h * ~begins[t][:, None]
        before[t] = h
        turned = h @ turn
        a = entered[t]
        gates = a[:, : 2 * hidden] + turned[:, : 2 * hidden]
        gates *= HALF
        np.tanh(gates, out=gates)
        gates *= HALF
        gates += HALF
        z, fresh = gates[:, :hidden], gates[:, hidden:] * turned[:, 2 * hidden :]
        fresh += a[:, 2 * hidden :]
        np.tanh(fresh, out=fresh)
        if keep_all:
            saved.append((gates, fresh, turned[:, 2 * hidden :]))
        h = h - fresh
        h *= z
        h += fresh
    return before, h, saved


def _odds(rows: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    logits = rows @ weights
    logits += bias
    if len(rows) < len(weights) or (np.abs(weights).sum(axis=0) + bias).max() > LIMIT:  # states lie between -1 and 1
        np.minimum(logits, LIMIT, out=logits)
    return np.exp(logits, out=logits)


def _chance(odds: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Probability of the target in each row."""
    return odds[np.arange(len(odds)), target] / (odds @ np.ones(odds.shape[1], np.float32))


def _error(odds: np.ndarray, target: np.ndarray, scale: np.float32) -> np.ndarray:
    """Probabilities less one at the target, scaled."""
    odds *= (scale / (odds @ np.ones(odds.shape[1], np.float32)))[:, None]
    odds[np.arange(len(odds)), target] -= scale
    return odds


def _by_class(target: np.ndarray, rows: np.ndarray, size: int):
    """Targets and rows in the order of the targets' classes, that order, and (class, slice) of each class met."""
    classes = (target // size).astype(np.int16)
    order = np.argsort(classes, kind="stable")
    classes = classes[order]
    cuts = [0, *(np.flatnonzero(classes[1:] != classes[:-1]) + 1).tolist(), len(classes)]
    return target[order], rows[order], order, [(int(classes[i]), slice(i, j)) for i, j in zip(cuts, cuts[1:])]


def _pieces(classes: list[tuple[int, slice]]) -> list[tuple[int, slice]]:
    """The slices cut into ROWS rows at most."""
    return [(c, slice(i, min(i + ROWS, own.stop))) for c, own in classes for i in range(own.start, own.stop, ROWS)]


def score(model: dict[str, np.ndarray], texts: list[np.ndarray], lanes: int = LANES, window: int = WINDOW) -> np.ndarray:
    """Natural log-likelihood of each whole text of symbol numbers."""
    total = np.zeros(len(texts))
    texts_in = [t for t in texts if len(t)]
    if not texts_in:
        return total
    names = np.array([i for i, t in enumerate(texts) if len(t)])
    dealt = Lanes(texts_in, lanes)
    state = np.zeros((len(dealt.length), len(model["turn"])), np.float32)
    size = model["to_symbol"].shape[2]
    for places, inside in dealt.windows(window):
        symbols = dealt.symbols[places]
        before, state, _ = _forward(model, symbols, dealt.begins[places], state[: places.shape[1]], False)
        flat = inside.ravel()
        rows, target = before.reshape(-1, before.shape[2])[flat], symbols.ravel()[flat]
        target, rows, order, classes = _by_class(target, rows, size)
        outer, within, chance, inner = target // size, target % size, np.empty(len(target), np.float32), np.empty(len(target), np.float32)
        for _, own in _pieces([(0, slice(0, len(target)))]):
            chance[own] = _chance(_odds(rows[own], model["to_class"], model["class_bias"]), outer[own])
        for c, own in _pieces(classes):
            inner[own] = _chance(_odds(rows[own], model["to_symbol"][c], model["symbol_bias"][c]), within[own])
        logp = np.log(chance) + np.log(inner)
        total += np.bincount(names[dealt.text[places.ravel()[flat][order]]], weights=logp, minlength=len(total))
    return total


class Trainer:
    """Training of one copy of the model; ``learn`` may be called with batch after batch."""

    def __init__(self, model: dict[str, np.ndarray], rate: float = RATE):
        self.model = {k: v.copy() for k, v in model.items()}
        self.history = {k: np.full_like(v, 1e-4) for k, v in model.items()}
        self.rate, self.tokens = rate, 0

    def _step(self, name: str, gradient: np.ndarray, at=slice(None)) -> None:
        past = self.history[name][at] + gradient * gradient
        self.history[name][at] = past
        self.model[name][at] -= self.rate * gradient / np.sqrt(past)

    def learn(self, texts: list[np.ndarray], lanes: int = LANES, window: int = WINDOW) -> None:
        texts = [t for t in texts if len(t)]
        if not texts:
            return
        dealt = Lanes(texts, lanes)
        state = np.zeros((len(dealt.length), len(self.model["turn"])), np.float32)
        for places, inside in dealt.windows(window):
            # All windows of a batch weigh a token alike, also the last ones, where few long texts still run.
            scale = np.float32(1 / (window * len(dealt.length)))
            state = self._window(dealt.symbols[places], dealt.begins[places], inside, state[: places.shape[1]], scale)
        self.tokens += len(dealt.symbols)

    def _window(self, symbols, begins, inside, state, scale):
        model = self.model
        steps, lanes = symbols.shape
        hidden = len(model["turn"])
        before, after, saved = _forward(model, symbols, begins, state, True)
        flat = np.flatnonzero(inside.ravel())
        size = model["to_symbol"].shape[2]
        target, rows, order, classes = _by_class(symbols.ravel()[flat], before.reshape(-1, hidden)[flat], size)
        outer, within, ones = target // size, target % size, np.ones(len(target), np.float32)
        back, class_way = np.empty_like(rows), np.ascontiguousarray(model["to_class"].T)
        to_class, class_bias = np.zeros_like(model["to_class"]), np.zeros_like(model["class_bias"])
        for _, own in _pieces([(0, slice(0, len(target)))]):
            error = _error(_odds(rows[own], model["to_class"], model["class_bias"]), outer[own], scale)
            np.matmul(error, class_way, out=back[own])
            to_class += rows[own].T @ error
            class_bias += ones[own] @ error
        # Only classes met have a gradient.
        to_symbol = np.zeros((len(classes), hidden, size), np.float32)
        symbol_bias = np.zeros((len(classes), size), np.float32)
        for i, whole in enumerate(classes):
            for c, own in _pieces([whole]):
                inner = _error(_odds(rows[own], model["to_symbol"][c], model["symbol_bias"][c]), within[own], scale)
                back[own] += inner @ model["to_symbol"][c].T
                to_symbol[i] += rows[own].T @ inner
                symbol_bias[i] += ones[own] @ inner
        met = np.array([c for c, _ in classes])
        self._step("to_symbol", to_symbol, met)
        self._step("symbol_bias", symbol_bias, met)
        self._step("to_class", to_class)
        self._step("class_bias", class_bias)

        to_state = np.zeros((steps * lanes, hidden), np.float32)
        to_state[flat[order]] = back
        to_state = to_state.reshape(steps, lanes, hidden)
        entered, turned = np.empty((steps, lanes, 3 * hidden), np.float32), np.empty((steps, lanes, 3 * hidden), np.float32)
        later, some = np.zeros((lanes, hidden), np.float32), begins.any(axis=1).tolist()
        turn_back = np.ascontiguousarray(model["turn"].T)
        for t in range(steps - 1, -1, -1):
            gates, fresh, inner = saved[t]
            z, r = gates[:, :hidden], gates[:, hidden:]
            both, kept = entered[t], later * z
            d_fresh = both[:, 2 * hidden :]
            np.multiply(fresh, fresh, out=d_fresh)
            np.subtract(1, d_fresh, out=d_fresh)
            d_fresh *= later - kept
            np.subtract(before[t], fresh, out=both[:, :hidden])
            both[:, :hidden] *= later
            np.multiply(d_fresh, inner, out=both[:, hidden : 2 * hidden])
            both[:, : 2 * hidden] *= gates * (1 - gates)
            turned[t, :, : 2 * hidden] = both[:, : 2 * hidden]
            np.multiply(d_fresh, r, out=turned[t, :, 2 * hidden :])
            later = turned[t] @ turn_back
            later += kept
            later += to_state[t]
            if some[t]:
                later *= ~begins[t][:, None]
        into = entered.reshape(-1, 3 * hidden)
        self._step("turn", before.reshape(-1, hidden).T @ turned.reshape(-1, 3 * hidden))
        self._step("start", np.ones(len(into), np.float32) @ into)
        order = np.argsort(symbols.ravel().astype(np.int16), kind="stable")
        sorted_symbols = symbols.ravel()[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(sorted_symbols)) + 1])
        self._step("enter", np.add.reduceat(into[order], cuts, axis=0), sorted_symbols[cuts])
        return after
