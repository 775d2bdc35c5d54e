"""A small gated recurrent language model in numpy, with a class-factored softmax.

Symbols 0 and 1 are the end of a text and any word outside the vocabulary; the
others are the most frequent words.  Symbols belong to classes and classes to
groups; a symbol's probability is that of its group, times that of its class within
the group, times its own within the class.  Three quarters of the classes hold one
frequent symbol each, so that most tokens need no third step.
"""

from __future__ import annotations

import heapq

import numpy as np

END, RARE = 0, 1
HIDDEN = 16
LANES = 128
WINDOW = 16  # steps that gradients run back
SCORE_WINDOW = 32
RATE = 0.01
ROW_RATE = 0.1  # of the large parameters
BLOCK = 1 << 16  # numbers of a softmax, or of a step, computed at a time
ABSENT = -20.0  # bias of a place without a symbol
NAMES = ("table", "inner", "bias", "group_w", "group_b", "class_w", "class_b", "word_w", "word_b")
SPARSE = ("table", "word_w", "word_b")  # a window changes the rows of its own words and classes only
LEVELS = ("group", "class", "word")  # of the softmax


def tree(symbols: int) -> tuple[int, int, int]:
    """Classes of a group (and groups), classes of one symbol, and members of the other classes."""
    side = max(2, round(symbols ** (1 / 3)))
    singles = side * side * 3 // 4
    return side, singles, max(1, -(-(symbols - singles) // (side * side - singles)))


def paths(targets: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of each symbol and its place there; the place is -1 in a class of one symbol."""
    _, singles, members = tree(symbols)
    beyond = targets - singles
    return np.where(beyond < 0, targets, singles + beyond // members), np.where(beyond < 0, -1, beyond % members)


def shapes(symbols: int) -> dict[str, tuple[int, ...]]:
    """Shapes of the parameters for so many symbols."""
    side, singles, members = tree(symbols)
    return {
        "table": (symbols, 3 * HIDDEN),
        "inner": (HIDDEN, 3 * HIDDEN),
        "bias": (3 * HIDDEN,),
        "group_w": (HIDDEN, side),
        "group_b": (side,),
        "class_w": (side, HIDDEN, side),
        "class_b": (side, side),
        "word_w": (side * side - singles, HIDDEN, members),
        "word_b": (side * side - singles, members),
    }


def _log_shares(mass: np.ndarray) -> np.ndarray:
    """Logs of the shares along the last axis, ABSENT where there is no mass."""
    total = np.maximum(mass.sum(axis=-1, keepdims=True), 1e-300)
    return np.where(mass > 0, np.log(np.maximum(mass, 1e-300) / total), ABSENT).astype(np.float32)


def initial(counts: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """Parameters whose first predictions are the symbols' shares in `counts`."""
    rng = np.random.default_rng(seed)
    params = {n: (rng.standard_normal(shape) * 0.1).astype(np.float32) for n, shape in shapes(len(counts)).items()}
    params["bias"][:] = 0
    side, singles, _ = tree(len(counts))
    mass = np.zeros(singles + params["word_b"].size)
    mass[: len(counts)] = np.asarray(counts) + 0.5
    within = mass[singles:].reshape(params["word_b"].shape)
    classes = np.concatenate([mass[:singles], within.sum(axis=1)]).reshape(side, side)
    params["group_b"], params["class_b"], params["word_b"] = _log_shares(classes.sum(axis=1)), _log_shares(classes), _log_shares(within)
    for name in ("group_w", "class_w", "word_w"):
        params[name] *= 0.1
    return params


def flat(params: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([params[n].ravel() for n in NAMES])


def unflat(vector: np.ndarray, symbols: int) -> dict[str, np.ndarray]:
    """Views of a vector of floats."""
    params, at = {}, 0
    for n, shape in shapes(symbols).items():
        size = int(np.prod(shape))
        params[n] = vector[at : at + size].reshape(shape).astype(np.float32, copy=False)
        at += size
    return params


def _joined(params: dict[str, np.ndarray], name: str) -> np.ndarray:
    """Weights of a softmax with the bias as one more row, as `_rows` ends in a one."""
    if name in params:
        return params[name]
    return np.concatenate([params[f"{name}_w"], params[f"{name}_b"][..., None, :]], axis=-2)


def joined(params: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The parameters, and beside them weights and biases in one."""
    return params | {name: _joined(params, name) for name in LEVELS}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _gates(params) -> np.ndarray:
    """The weights of the state for update, reset and new state, apart from each other."""
    return np.ascontiguousarray(params["inner"].reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2))


def _forward(params, inputs: np.ndarray, resets: np.ndarray, state: np.ndarray):
    """Steps over inputs (time x lanes); what each step had, and the last state."""
    h, kept, inner_w = HIDDEN, [], _gates(params)
    table, bias = params["table"].reshape(-1, h), np.repeat(params["bias"].reshape(3, 1, h), inputs.shape[1], axis=1)
    gates = np.arange(3).reshape(3, 1)
    with np.errstate(over="ignore"):  # of the exponential, whose reciprocal is then zero
        for x, fresh in zip(3 * inputs.astype(np.intp), resets):
            if fresh.any():
                state = np.where(fresh[:, None], state.dtype.type(0), state)
            outer, inner = table.take(x + gates, axis=0), np.matmul(state, inner_w)
            outer += bias
            outer[:2] += inner[:2]
            update, reset = _sigmoid(outer[:2])
            new = outer[2]
            new += reset * inner[2]
            np.tanh(new, out=new)
            after = state - new
            after *= update
            after += new
            kept.append((state, update, reset, new, inner[2], after))
            state = after
    return kept, state


def _softmax(logits: np.ndarray) -> np.ndarray:
    """The rows' sums of exponentials, which take the place of the logits."""
    np.exp(logits, out=logits)
    return logits @ np.ones(logits.shape[1], logits.dtype)


def _bounded(logits: np.ndarray) -> np.ndarray:
    """The logits, moved by row if an exponential could leave the range of floats."""
    if logits.max() > 60 or logits.min() < -60:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


def _blocks(owner: np.ndarray, members: int):
    """Sorted owners a block at a time: where it begins and ends, and its runs as (run, owner, begin, end, whether the run begins)."""
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    step = max(1, BLOCK // members)
    edges = np.union1d(first, np.arange(0, len(owner), step))
    run = np.searchsorted(first, edges, "right") - 1
    pieces = list(zip(run.tolist(), owner[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(owner)], (first[run] == edges).tolist()))
    bounds = np.searchsorted(edges, np.arange(0, len(owner) + step, step)).tolist()
    for k, (low, high) in enumerate(zip(bounds, bounds[1:])):
        if low < high:
            yield k * step, min((k + 1) * step, len(owner)), pieces[low:high]


def _logits(rows, weights, begin, pieces, buffer) -> np.ndarray:
    for _, node, a, b, _ in pieces:
        np.matmul(rows[a:b], weights[node], out=buffer[a - begin : b - begin])
    return _bounded(buffer)


def _buffer(rows: np.ndarray, members: int) -> np.ndarray:
    return np.empty((min(len(rows), max(1, BLOCK // members)), members), rows.dtype)


def _log_within(rows, weights, owner, wanted) -> np.ndarray:
    """Natural log of the softmax of each row's owner, in sorted order, at its wanted column."""
    result, buffer = np.empty(len(owner), rows.dtype), _buffer(rows, weights.shape[-1])
    for begin, end, pieces in _blocks(owner, weights.shape[-1]) if len(owner) else ():
        logits = _logits(rows, weights, begin, pieces, buffer[: end - begin])
        picked = logits[np.arange(end - begin), wanted[begin:end]]
        result[begin:end] = picked - np.log(_softmax(logits))
    return result


def _rows(params, states: np.ndarray, targets: np.ndarray):
    """The order of the targets' classes, the states in that order with a one, and what each level of the softmax needs.

    A level has its name, its first row, the weights, and the rows' owners and wanted
    columns; classes of several words come last, so each level's owners are sorted.
    """
    symbols = len(params["table"])
    side, singles, _ = tree(symbols)
    classes, member = paths(targets, symbols)
    order = np.argsort(classes.astype(np.uint16), kind="stable")
    classes, member = classes[order], member[order]
    rows = np.ones((len(states), HIDDEN + 1), states.dtype)
    rows[:, :HIDDEN] = states.take(order, axis=0)
    group, deep = classes // side, int(np.searchsorted(classes, singles))
    levels = [
        ("group", 0, _joined(params, "group")[None], np.zeros(len(group), np.int64), group),
        ("class", 0, _joined(params, "class"), group, classes % side),
        ("word", deep, _joined(params, "word"), classes[deep:] - singles, member[deep:]),
    ]
    return order, rows, levels


def _log_probabilities(params, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log of each target's probability; states are (n x hidden)."""
    order, rows, levels = _rows(params, states, targets)
    logs = np.zeros(len(rows), states.dtype)
    for _, at, weights, owner, wanted in levels:
        logs[at:] += _log_within(rows[at:], weights, owner, wanted)
    result = np.empty_like(logs)
    result[order] = logs
    return result


def _pull_within(rows, weights, owner, wanted, scale):
    """Owners, gradients of their weights and of the rows, of the scaled losses at the wanted columns; owners are sorted."""
    seen = np.unique(owner)
    grad, back = np.empty((len(seen), *weights.shape[1:]), rows.dtype), np.empty_like(rows)
    buffer = _buffer(rows, weights.shape[-1])
    for begin, end, pieces in _blocks(owner, weights.shape[-1]) if len(owner) else ():
        over = _logits(rows, weights, begin, pieces, buffer[: end - begin])
        total = _softmax(over)
        over[np.arange(end - begin), wanted[begin:end]] -= total
        # the rows are scaled, which are shorter than the logits
        factor = (scale[begin:end] / total)[:, None]
        scaled = rows[begin:end] * factor
        for run, node, a, b, begins in pieces:
            part, mine = over[a - begin : b - begin], scaled[a - begin : b - begin]
            if begins:
                np.matmul(mine.T, part, out=grad[run])
            else:
                grad[run] += mine.T @ part
            np.matmul(part, weights[node].T, out=back[a:b])
        back[begin:end] *= factor
    return seen, grad, back


def _gradients(params, inputs, resets, targets, weights, state):
    """Gradients of the window's mean loss, and the state after it."""
    changed, last = _changes(params, inputs, resets, targets, weights, state)
    grads = {n: np.zeros(params[n].shape, np.float32) for n in NAMES}
    for n, (at, values) in changed.items():
        if n in LEVELS:
            grads[f"{n}_w"][at], grads[f"{n}_b"][at] = values[..., :HIDDEN, :], values[..., HIDDEN, :]
        else:
            grads[n][at] = values
    return grads, last


def _sums_of_runs(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, which are sorted, and the sums of their rows, added up in pairs."""
    while True:
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        if first.all():
            return keys, rows
        at = np.arange(len(keys))
        even = (at - np.maximum.accumulate(np.where(first, at, 0))) % 2 == 0
        odd = np.flatnonzero(~even)
        taken = np.flatnonzero(even)
        halved = rows.take(taken, axis=0)
        halved[np.searchsorted(taken, odd) - 1] += rows.take(odd, axis=0)
        keys, rows = keys[taken], halved


def _changes(params, inputs, resets, targets, weights, state):
    """The gradients as (rows, values), of weights with their biases: only the rows that the window has to do with."""
    h, whole = HIDDEN, slice(None)
    kept, last = _forward(params, inputs, resets, state)
    steps, lanes = inputs.shape
    states = np.concatenate([k[5] for k in kept])
    order, rows, levels = _rows(params, states, targets.ravel())
    scale = (weights.ravel() / max(1.0, weights.sum())).astype(states.dtype)[order]
    changed, down_rows = {}, np.zeros_like(rows)
    for name, at, level, owner, wanted in levels:
        seen, grad, pulled = _pull_within(rows[at:], level, owner, wanted, scale[at:])
        down_rows[at:] += pulled
        changed[name] = (whole, grad[0]) if name == "group" else (seen, grad)
    back = np.empty_like(states)
    back[order] = down_rows[:, :h]
    back = back.reshape(steps, lanes, h)
    inner_back = np.ascontiguousarray(_gates(params).transpose(0, 2, 1))
    carry = np.zeros((lanes, h), states.dtype)
    # of update, reset and new state; the last as the inner weights see it
    outer = np.empty((4, steps, lanes, h), states.dtype)
    for t in range(steps - 1, -1, -1):
        before, update, reset, new, inner_new, _ = kept[t]
        d_update, d_reset, d_new, d_inner = outer[:, t]
        down = np.add(back[t], carry, out=carry)
        rest = 1 - update
        np.multiply(new, new, out=d_new)
        np.subtract(1, d_new, out=d_new)
        d_new *= rest
        d_new *= down
        np.subtract(before, new, out=d_update)
        down *= update
        d_update *= down
        d_update *= rest
        np.multiply(d_new, reset, out=d_inner)
        np.subtract(1, reset, out=rest)
        np.multiply(d_inner, inner_new, out=d_reset)
        d_reset *= rest
        carry = down
        carry += d_update @ inner_back[0]
        carry += d_reset @ inner_back[1]
        carry += d_inner @ inner_back[2]
        if resets[t].any():
            carry[resets[t]] = 0
    befores, by_gate = np.concatenate([k[0] for k in kept]), outer.reshape(4, -1, h)
    changed["inner"] = whole, np.concatenate([befores.T @ by_gate[k] for k in (0, 1, 3)], axis=1)
    changed["bias"] = whole, np.concatenate([np.ones(len(befores), states.dtype) @ by_gate[k] for k in range(3)])
    order = np.argsort(inputs.ravel().astype(np.uint16) if len(params["table"]) <= 1 << 16 else inputs.ravel(), kind="stable")
    by_input = outer.reshape(-1, h).take(order[:, None] + len(order) * np.arange(3), axis=0)
    changed["table"] = _sums_of_runs(inputs.ravel()[order], by_input.reshape(-1, 3 * h))
    return changed, last


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Texts dealt to lanes of about equal length, the longest first."""
    dealt = [[] for _ in range(max(1, min(lanes, len(lengths))))]
    heap = [(0, i) for i in range(len(dealt))]
    for text in np.argsort(-lengths, kind="stable"):
        load, lane = heapq.heappop(heap)
        dealt[lane].append(int(text))
        heapq.heappush(heap, (load + int(lengths[text]), lane))
    return dealt


def _layout(texts: list[np.ndarray], lanes: int):
    """Targets, inputs and starts as (time x lane), the lanes' loads, and each text's lane and first step.

    Lanes are in falling order of load, so that those still running come first.
    """
    dealt = lanes_of(np.array([len(t) for t in texts]), lanes)
    dealt.sort(key=lambda lane: -sum(len(texts[i]) for i in lane))
    loads = np.array([sum(len(texts[i]) for i in lane) for lane in dealt])
    targets = np.zeros((len(dealt), loads[0]), np.int32)
    starts = np.zeros((len(dealt), loads[0]), bool)
    places = [(0, 0)] * len(texts)
    for lane, members in enumerate(dealt):
        at = 0
        for i in members:
            n = len(texts[i])
            targets[lane, at : at + n] = texts[i]
            starts[lane, at] = True
            places[i] = (lane, at)
            at += n
    inputs = np.zeros_like(targets)
    inputs[:, 1:] = targets[:, :-1]
    inputs[starts] = END
    return targets.T, inputs.T, starts.T, loads, places


def score_texts(params, texts: list[np.ndarray], lanes: int = 4 * LANES) -> np.ndarray:
    """Natural log-likelihood of each text (symbols, its end included), the state carried over all of it."""
    if not texts:
        return np.zeros(0)
    targets, inputs, starts, loads, places = _layout(texts, lanes)
    params = joined(params)
    logs = np.zeros(targets.shape[::-1], np.float32).T
    state = np.zeros((len(loads), HIDDEN), np.float32)
    for at in range(0, len(targets), SCORE_WINDOW):
        running = int((loads > at).sum())
        part = (slice(at, at + SCORE_WINDOW), slice(0, running))
        kept, state = _forward(params, inputs[part], starts[part], state[:running])
        states = np.concatenate([k[5] for k in kept])
        del kept
        logs[part] = _log_probabilities(params, states, targets[part].ravel()).reshape(-1, running)
    return np.array([logs[at : at + len(t), lane].sum(dtype=np.float64) for t, (lane, at) in zip(texts, places)])


class Trainer:
    """Truncated backpropagation with Adam over segments of texts, in order of arrival.

    The large `SPARSE` parameters take steps by their summed squared gradients
    instead, which stand still in rows that no window has to do with; `touched`
    counts the windows that had to do with a row.
    """

    def __init__(self, params: dict[str, np.ndarray]):
        self.all = {n: p.copy() if n in ("table", "inner", "bias") else p for n, p in joined(params).items()}
        for n in LEVELS:  # views of what is stepped
            self.all[f"{n}_w"], self.all[f"{n}_b"] = self.all[n][..., :HIDDEN, :], self.all[n][..., HIDDEN, :]
        self.params = {n: self.all[n] for n in NAMES}
        self.first = {n: np.zeros(self.all[n].shape, np.float32) for n in ("inner", "bias", "group", "class")}
        self.second = {n: np.zeros(p.shape, np.float32) for n, p in self.first.items()}
        # never zero, as steps are divided by their roots
        self.second |= {n: np.full(self.all[n].shape, 1e-16, np.float32) for n in ("table", "word")}
        self.touched = {n: np.zeros(len(params[n]), np.int64) for n in SPARSE}
        self.steps = self.tokens = 0

    def train(self, texts: list[np.ndarray], lanes: int = LANES) -> None:
        if not texts:
            return
        targets, inputs, starts, loads, _ = _layout(texts, lanes)
        state = np.zeros((len(loads), HIDDEN), np.float32)
        for at in range(0, len(targets), WINDOW):
            running = int((loads > at).sum())
            part = (slice(at, at + WINDOW), slice(0, running))
            steps = np.arange(at, min(at + WINDOW, len(targets)))
            weights = (steps[:, None] < loads[None, :running]).astype(np.float32)
            changed, state = _changes(self.all, inputs[part], starts[part], targets[part], weights, state[:running])
            self._step(changed)
        self.tokens += int(loads.sum())

    def release(self) -> None:
        """Let go of what only further steps would need."""
        self.first = self.second = None

    def _step(self, changed) -> None:
        self.steps += 1
        rate = np.float32(RATE * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps))
        for n, (at, grad) in changed.items():
            if n not in self.first:
                self._step_rows(n, at, grad)
                continue
            if not isinstance(at, slice):
                full = np.zeros(self.all[n].shape, np.float32)
                full[at] = grad
                grad = full
            first, second = self.first[n], self.second[n]
            first += np.float32(0.1) * (grad - first)
            second += np.float32(0.001) * (grad * grad - second)
            self.all[n] -= rate * first / (np.sqrt(second) + np.float32(1e-8))

    def _step_rows(self, n: str, at: np.ndarray, grad: np.ndarray) -> None:
        for name in SPARSE:
            if name.startswith(n):
                self.touched[name][at] += 1
        values, second = self.all[n], self.second[n]
        whole, step = len(at) == len(values), max(1, BLOCK // values[0].size)
        for k in range(0, len(at), step):
            rows = slice(k, k + step) if whole else at[k : k + step]  # a slice is a view, so nothing is copied
            part = grad[k : k + step]
            square = part * part
            sums = second[rows]
            sums += square
            np.sqrt(sums, out=square)
            np.divide(part, square, out=square)
            square *= np.float32(ROW_RATE)
            values[rows] -= square
            if not whole:
                second[rows] = sums
