"""Softmax over many classes behind few hidden units, by an expansion that is exact to rounding.

exp(h w) is smooth: over the box that the hidden units of a block of rows lie in, it is a short sum of products of Chebyshev
polynomials, a factor of the row times a factor of the class. The units are dealt to two sides, and a sum over classes or rows
of products of both sides is a product of two matrices. Sums over classes and over rows then take rows x terms and classes x
terms operations instead of rows x classes. The number of terms follows from the box and the weights, by a bound on what is
left out; where it is too large, as with many hidden units, the caller takes all scores.
"""

from __future__ import annotations

import numpy as np

#: Bound on the relative error of an exponential.
TOLERANCE = 1e-11
#: Degrees that are tried in one hidden unit, and nodes of the cosine sums that give their coefficients.
DEGREES, NODES = 32, 64
#: Sum of the largest exponents beyond which all scores are taken instead, and terms of one side.
MOST_REACH, MOST_TERMS = 8.0, 1024
#: Cells of a matrix of terms that is held at once.
TERM_CELLS = 1 << 18
#: Work of a score, as a multiple of that of a term of a row or a class.
SCORE_WORK = 20


def _coefficients(scale: np.ndarray, degrees: int = DEGREES) -> np.ndarray:
    """Chebyshev coefficients of exp(scale x) over -1 .. 1: degrees x scales."""
    angles = (np.arange(NODES) + 0.5) * (np.pi / NODES)
    waves = np.cos(np.arange(degrees)[:, None] * angles) * (2.0 / NODES)
    waves[0] /= 2
    return waves @ np.exp(np.cos(angles)[:, None] * scale)


def _polynomials(x: np.ndarray, degrees: int) -> np.ndarray:
    """Chebyshev polynomials: degrees x values."""
    return np.cos(np.arange(degrees)[:, None] * np.arccos(np.clip(x, -1.0, 1.0)))


def _side(sizes: np.ndarray, left_out: float) -> np.ndarray | None:
    """Degrees by unit of the products of sizes (degrees x units) that are needed: the others sum to left_out at most."""
    total = float(np.prod(sizes.sum(axis=0)))
    for least in left_out / 10.0 ** np.arange(8):
        terms, held = np.zeros((1, 0), np.int64), np.ones(1)
        for size in sizes.T:
            products = held[:, None] * size
            row, degree = np.nonzero(products >= least)
            if len(row) > MOST_TERMS:
                return None
            terms, held = np.column_stack([terms[row], degree]), products[row, degree]
        if total - float(np.sort(held).sum()) <= left_out:
            return terms
    return None


def sides_of(reach: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The terms of the two sides where exponents of unit j are within reach[j]; None: too many."""
    if not np.isfinite(reach).all() or reach.sum() > MOST_REACH or len(reach) > MOST_TERMS:
        return None
    sizes, cut = np.abs(_coefficients(reach)), -(-len(reach) // 2)
    # An exponential is exp(-reach) at least, so this bounds its relative error; a side's products are at most exp(reach).
    left_out = TOLERANCE * np.exp(-2 * reach.sum()) / 2
    left = _side(sizes[:, :cut], left_out)
    right = None if left is None else _side(sizes[:, cut:], left_out)
    return None if right is None else (left, right)


class Expansion:
    """Sums over all classes for rows whose hidden units lie in a box."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, low: np.ndarray, high: np.ndarray, sides):
        self.weights, self.bias, self.sides, self.cut = weights, bias, sides, sides[0].shape[1]
        self.centre, self.half = (low + high) / 2, np.maximum((high - low) / 2, 1e-300)
        self.degrees = np.concatenate([side.max(axis=0) for side in sides]) + 1
        self.shape = (len(weights) + 1, len(sides[0]), len(sides[1]))
        self.at_once = max(1, TERM_CELLS // max(self.shape[1:]))
        self.shift = float((self.centre @ weights + bias).max())

    @classmethod
    def over(cls, weights: np.ndarray, bias: np.ndarray, hidden: np.ndarray) -> Expansion | None:
        """The expansion for these rows, or None where all their scores are less work."""
        if not (len(hidden) and np.isfinite(weights).all() and np.isfinite(bias).all() and np.isfinite(hidden).all()):
            return None
        low, high = hidden.min(axis=0), hidden.max(axis=0)
        sides = sides_of((high - low) / 2 * np.abs(weights).max(axis=1))
        rows, (units, classes) = len(hidden), weights.shape
        if sides is None or len(sides[0]) * len(sides[1]) * (units + 1) * (rows + classes) > SCORE_WORK * rows * classes:
            return None
        return cls(weights, bias, low, high, sides)

    def _factors(self, tables: list[np.ndarray]) -> list[np.ndarray]:
        """The terms of each side: terms x columns."""
        out = []
        for side, own in zip(self.sides, (tables[: self.cut], tables[self.cut :]), strict=True):
            product = np.ones((len(side), tables[0].shape[1]))
            for unit, table in enumerate(own):
                product *= table[side[:, unit]]
            out.append(product)
        return out

    def of_classes(self):
        """Stretches of classes, and their factors; the left ones hold the exponential at the centre."""
        for low in range(0, self.weights.shape[1], self.at_once):
            part = slice(low, low + self.at_once)
            w = self.weights[:, part]
            left, right = self._factors([_coefficients(r * row, d) for r, row, d in zip(self.half, w, self.degrees, strict=True)])
            left *= np.exp(self.centre @ w + self.bias[part] - self.shift)
            yield part, left, right

    def of_rows(self, hidden: np.ndarray):
        """Stretches of rows, and their factors."""
        for low in range(0, len(hidden), self.at_once):
            part = slice(low, low + self.at_once)
            places = (hidden[part] - self.centre) / self.half
            yield part, *self._factors([_polynomials(x, d) for x, d in zip(places.T, self.degrees, strict=True)])


def _gathered(left: np.ndarray, right: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Sums of the columns' terms, weighted by each row of shares."""
    return np.stack([(left * share) @ right.T for share in shares])


def _applied(sums: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The value of each sum at the columns."""
    return np.stack([((own @ right) * left).sum(axis=0) for own in sums])


def output_gradients(weights: np.ndarray, bias: np.ndarray, hidden: np.ndarray, target: np.ndarray):
    """Mean cross entropy of the rows and its gradients by hidden units (rows x units), weights and bias; None: take all scores."""
    found = Expansion.over(weights, bias, hidden)
    if found is None:
        return None
    (n, units), classes = hidden.shape, weights.shape[1]
    sums, moments = np.zeros(found.shape), np.zeros(found.shape)
    for part, left, right in found.of_classes():
        sums += _gathered(left, right, np.vstack([np.ones(left.shape[1]), weights[:, part]]))
    total, back = np.empty(n), np.empty((n, units))
    for part, left, right in found.of_rows(hidden):
        values = _applied(sums, left, right)
        total[part], back[part] = values[0], (values[1:] / values[0]).T
        moments += _gathered(left, right, np.vstack([np.ones(left.shape[1]), hidden[part].T]) / (n * values[0]))
    grown = np.empty((units + 1, classes))
    for part, left, right in found.of_classes():
        grown[:, part] = _applied(moments, left, right)
    known = (hidden * weights[:, target].T).sum(axis=1) + bias[target] - found.shift
    loss = np.minimum(np.log(total) - known, -np.log(1e-300)).mean()
    back = (back - weights[:, target].T) / n
    grown -= np.stack([np.bincount(target, share / n, minlength=classes) for share in (np.ones(n), *hidden.T)])
    return float(loss), back, grown[1:], grown[0]
