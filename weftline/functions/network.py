"""Arithmetic of a small feed-forward network on numpy batches, run inside Spark tasks."""

from __future__ import annotations

import numpy as np

# The moment decays and the divisor guard of Adam.
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8

#: Cells of an array that a step of Adam takes at a time.
ADAM_CELLS = 16384

#: Classes whose weights are widened to double precision at a time.
WIDENED = 8192
#: Classes that are scored again in double precision where one of them may have the largest score.
BLOCK = 256
#: Scores of rows beyond single precision that are held at once.
PLAIN_CELLS = 4_000_000

PARAMETERS = ("w0", "b0", "w1", "b1")
#: The number of steps that a state has made; a mean over workers need not be whole.
STEPS = "t0"


def initial_parameters(n_in: int, hidden: int, n_out: int, seed: int) -> dict[str, np.ndarray]:
    """Xavier-normal weights, zero biases."""
    rng = np.random.default_rng(seed)

    def xavier(rows, columns):
        return rng.normal(0.0, np.sqrt(2.0 / (rows + columns)), (rows, columns))

    return {"w0": xavier(n_in, hidden), "b0": np.zeros(hidden), "w1": xavier(hidden, n_out), "b1": np.zeros(n_out)}


def initial_state(parameters: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Parameters with their Adam moments and the number of steps, all zero."""
    state = {**parameters, STEPS: np.zeros(1)}
    for name in PARAMETERS:
        state[f"{name}.m"] = np.zeros_like(parameters[name])
        state[f"{name}.v"] = np.zeros_like(parameters[name])
    return state


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def forward(parameters: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Class probabilities; without a hidden layer the scores of one linear layer."""
    if "w1" not in parameters:
        return linear_scores(parameters, over_positions(parameters, x))
    hidden = np.maximum(x @ parameters["w0"] + parameters["b0"], 0.0)
    return softmax(hidden @ parameters["w1"] + parameters["b1"])


def over_positions(parameters: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The inputs of a linear layer. One that is the same at every position has the weights of one: x is summed over them."""
    n_in = len(parameters["w0"])
    return x if x.shape[1] == n_in else x.reshape(len(x), -1, n_in).sum(axis=1)


def linear_scores(parameters: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Scores in double precision; weights may be stored in single, and are widened a tile at a time."""
    weights, bias = parameters["w0"], parameters["b0"]
    out = np.empty((len(x), weights.shape[1]))
    for low in range(0, weights.shape[1], WIDENED):
        tile = slice(low, low + WIDENED)
        np.matmul(x, weights[:, tile].astype(np.float64, copy=False), out=out[:, tile])
    out += bias
    return out


def best_rounded(parameters: dict[str, np.ndarray], x: np.ndarray, digits: int, tile: int) -> np.ndarray:
    """The first class of the largest rounded score of each row of a linear layer, without a matrix of all scores.

    Single precision finds the blocks of classes whose best score may be the largest: its error is bounded by the norms of
    row and weights, so no block with a largest rounded score is missed. These blocks are scored in double and rounded.
    """
    x = over_positions(parameters, x)
    weights, bias = parameters["w0"], parameters["b0"]
    n_classes = weights.shape[1]
    heights = np.zeros(n_classes)
    for row in weights:
        heights += row.astype(np.float64) ** 2
    # A dot product of k terms is off by less than (k + 2) 2^-24 times the norms, each input rounded; the bias adds one term.
    unit = (len(weights) + 8) * 2.0**-24
    reach = np.sqrt((x * x).sum(axis=1)) * np.sqrt(heights.max(initial=0.0)) + np.abs(bias).max(initial=0.0)
    slack = 2 * unit * reach + 1.01 * 10.0**-digits
    out = np.empty(len(x), np.int64)
    known = reach < 1e30  # single precision holds these; nan and inf are scored as they are
    plain = np.flatnonzero(~known)
    for low in range(0, len(plain), at_once := max(1, PLAIN_CELLS // n_classes)):
        rows = plain[low : low + at_once]
        out[rows] = linear_scores(parameters, x[rows]).round(digits).argmax(axis=1)
    if not known.any():
        return out
    x, slack = x[known], slack[known, None]
    narrow, single, low_bias = x.astype(np.float32), weights.astype(np.float32, copy=False), bias.astype(np.float32)
    tops = np.empty((len(x), -(-n_classes // BLOCK)), np.float32)
    for low in range(0, n_classes, tile := max(BLOCK, tile // BLOCK * BLOCK)):
        scores = narrow @ single[:, low : low + tile]
        scores += low_bias[low : low + tile]
        first, whole = low // BLOCK, scores.shape[1] // BLOCK
        scores[:, : whole * BLOCK].reshape(len(x), whole, BLOCK).max(axis=2, out=tops[:, first : first + whole])
        if scores.shape[1] % BLOCK:
            scores[:, whole * BLOCK :].max(axis=1, out=tops[:, first + whole])
    rows, blocks = np.nonzero(tops >= tops.max(axis=1, keepdims=True) - slack)
    best, found = np.full(len(x), -np.inf), np.zeros(len(x), np.int64)
    order = np.argsort(blocks, kind="stable")
    bounds = np.flatnonzero(np.diff(blocks[order], prepend=-1))
    for member, block in zip(np.split(rows[order], bounds[1:]), blocks[order[bounds]].tolist(), strict=True):
        part = slice(block * BLOCK, (block + 1) * BLOCK)
        scores = (x[member] @ weights[:, part].astype(np.float64, copy=False) + bias[part]).round(digits)
        at = scores.argmax(axis=1)
        top = scores[np.arange(len(member)), at]
        better = top > best[member]
        best[member[better]], found[member[better]] = top[better], at[better] + part.start
    out[known] = found
    return out


def best_class(parameters: dict[str, np.ndarray], x: np.ndarray, tile: int) -> np.ndarray:
    """The first class of the largest score of each row, over `tile` classes at a time.

    Softmax keeps the order of scores, so it is left out; a running maximum is all that is held of the classes before.
    """
    last = "w1" if "w1" in parameters else "w0"
    if last == "w1":
        x = np.maximum(x @ parameters["w0"] + parameters["b0"], 0.0)
    else:
        x = over_positions(parameters, x)
    weights, bias = parameters[last], parameters["b" + last[1:]]
    best, found = np.full(len(x), -np.inf), np.zeros(len(x), np.int64)
    for low in range(0, weights.shape[1], tile):
        scores = x @ weights[:, low : low + tile]
        scores += bias[low : low + tile]
        at = scores.argmax(axis=1)
        top = scores[np.arange(len(x)), at]
        better = top > best
        best[better], found[better] = top[better], at[better] + low
    return found


def loss_and_gradients(parameters, x: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy and its gradients."""
    rows = np.arange(len(x))
    hidden = np.maximum(x @ parameters["w0"] + parameters["b0"], 0.0)
    # One matrix of rows x classes, changed in place: scores, their exponentials, shares, errors.
    out = hidden @ parameters["w1"]
    out += parameters["b1"]
    out -= out.max(axis=1, keepdims=True)
    np.exp(out, out=out)
    total = out.sum(axis=1)
    loss = -np.log(np.maximum(out[rows, target] / total, 1e-300)).mean()
    out[rows, target] -= total
    out /= (total * len(x))[:, None]
    back = (out @ parameters["w1"].T) * (hidden > 0)
    return float(loss), {"w0": x.T @ back, "b0": back.sum(axis=0), "w1": hidden.T @ out, "b1": out.sum(axis=0)}


def adam_step(state: dict[str, np.ndarray], gradients, rate: float) -> None:
    """Update parameters, moments and the number of steps in place.

    A stretch of ADAM_CELLS cells goes through all operations while it is in the cache, and no array is made.
    """
    state[STEPS] += 1
    step = float(state[STEPS][0])
    scale = rate * np.sqrt(1 - BETA2**step) / (1 - BETA1**step)
    scratch = np.empty(ADAM_CELLS)
    for name, gradient in gradients.items():
        arrays = [state[name], state[f"{name}.m"], state[f"{name}.v"], gradient]
        flat = [a.reshape(-1) for a in arrays]
        for low in range(0, gradient.size, ADAM_CELLS):
            cells, m, v, g = (a[low : low + ADAM_CELLS] for a in flat)
            part = scratch[: len(g)]
            np.subtract(g, m, out=part)
            part *= 1 - BETA1
            m += part
            np.multiply(g, g, out=part)
            part -= v
            part *= 1 - BETA2
            v += part
            np.sqrt(v, out=part)
            part += EPSILON
            np.divide(m, part, out=part)
            part *= scale
            cells -= part


def gather(matrix: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Flattened vectors of index rows; index -1 takes the last row of the matrix, which is zero."""
    return matrix[index].reshape(len(index), -1)
