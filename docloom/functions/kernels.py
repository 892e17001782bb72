"""NumPy kernels that run inside Spark tasks on one bounded block at a time.

The module is pickled by value, so executors need neither the package nor a path to it.
Distances come from one matrix product per block; whatever lies within rounding error of
a decision (nearest centre, inside eps, n-th best score) is computed again exactly, so
results do not depend on how rows were put into blocks.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_CELLS = 4_000_000
BESIDE = 16
CACHE_CELLS = 500_000
TILE = 1024
SINGLE_LEAST, SINGLE_MOST = 1e-25, 1e25
VANISHING = 1e-20
BLOCK_CELLS = 1024
PAIR_ROWS = 256
ROUGH_MOST = 1e6
DENSE_GAIN = 7  # by which a product of all rows and components is faster, for each of its numbers


def stack(vectors: pd.Series) -> np.ndarray:
    """A column of arrays as one float64 matrix."""
    if len(vectors) == 0:
        return np.zeros((0, 0))
    return np.stack(vectors.to_numpy()).astype(np.float64, copy=False)


def _row_chunks(rows: int, columns: int):
    step = max(1, CHUNK_CELLS // max(1, columns))
    for low in range(0, rows, step):
        yield low, min(rows, low + step)


def _rough_squared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by matrix product and the rounding error to allow per row."""
    a2 = np.einsum("ij,ij->i", a, a)
    b2 = np.einsum("ij,ij->i", b, b)
    rough = (-2.0 * a) @ b.T
    rough += a2[:, None]
    rough += b2[None, :]
    slack = 1e-10 * (a2 + (b2.max() if len(b2) else 0.0)) + 1e-300
    return rough, slack


def _exact_squared(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    for low, high in _row_chunks(len(i), a.shape[1]):
        gap = a[i[low:high]] - b[j[low:high]]
        out[low:high] = (gap * gap).sum(axis=1)
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Full Euclidean distance matrix of two blocks."""
    rough, slack = _rough_squared(a, b)
    i, j = np.nonzero(rough <= 1e4 * slack[:, None])
    rough[i, j] = _exact_squared(a, b, i, j)
    return np.sqrt(np.maximum(rough, 0.0))


def _single(a: np.ndarray, b: np.ndarray) -> np.ndarray | None:
    """What rounding may add, per row of ``a``, to squared distances by a product in single precision; None where it does not fit."""
    a2, b2 = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b).max(initial=0.0)
    if not SINGLE_LEAST < b2 < SINGLE_MOST or not a2.max(initial=0.0) < SINGLE_MOST:
        return None
    return (a.shape[1] + 8) * 2.0**-23 * (a2 + b2)


def _rivals(part: np.ndarray, centres: np.ndarray, rows: np.ndarray, near: np.ndarray) -> np.ndarray:
    """For each listed row the nearest of the centres marked for it, by exact distances, first on a tie."""
    i, j = np.nonzero(near)
    gaps = _exact_squared(part, centres, rows[i], j)
    starts = np.flatnonzero(np.r_[True, np.diff(i) > 0])
    best = gaps == np.repeat(np.minimum.reduceat(gaps, starts), np.diff(np.r_[starts, len(i)]))
    found, first = np.unique(i[best], return_index=True)
    return j[best][first]


def _nearest_double(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    index = np.zeros(len(x), dtype=np.int64)
    for low, high in _row_chunks(len(x), len(centres)):
        rough, slack = _rough_squared(x[low:high], centres)
        near = rough <= (rough.min(axis=1) + slack)[:, None]
        index[low:high] = near.argmax(axis=1)
        rows = np.flatnonzero(np.count_nonzero(near, axis=1) > 1)
        if len(rows):
            index[low + rows] = _rivals(x[low:high], centres, rows, near[rows])
    return index


def nearest_index(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Row of the nearest centre, first on a tie.

    Products in single precision leave a few rows with several centres within rounding error, which are decided
    exactly; where they leave many, as far from the origin, the product is in double precision.
    """
    slack = _single(x, centres)
    if slack is None:
        return _nearest_double(x, centres)
    index = np.zeros(len(x), dtype=np.int64)
    turned = np.ascontiguousarray((-2.0 * centres).T.astype(np.float32))
    lengths = np.einsum("ij,ij->i", centres, centres).astype(np.float32)
    step = max(1, CACHE_CELLS // max(1, len(centres)))
    for low in range(0, len(x), step):
        part, margin = x[low : low + step], 2 * slack[low : low + step]
        rough = part.astype(np.float32) @ turned
        rough += lengths
        rows = np.arange(len(part))
        at = rough.argmin(axis=1)
        index[low : low + step] = at
        least = rough[rows, at]
        rough[rows, at] = np.inf
        unsure = np.flatnonzero(rough.min(axis=1) <= least + margin)
        if len(unsure) > len(part) // 4:
            index[low : low + step] = _nearest_double(part, centres)
        elif len(unsure):
            rough[rows, at] = least
            index[low + unsure] = _rivals(part, centres, unsure, rough[unsure] <= (least + margin)[unsure, None])
    return index


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of the nearest centre (first on a tie) and the squared distance to it."""
    index = nearest_index(x, centres)
    return index, _exact_squared(x, centres, np.arange(len(x)), index)


def within(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    """Boolean matrix: distance at most ``eps``."""
    rough, slack = _rough_squared(a, b)
    limit, margin = eps * eps, slack.max() if len(slack) else 0.0
    hit = rough <= limit + margin
    sure = rough <= limit - margin
    if np.count_nonzero(hit) != np.count_nonzero(sure):
        i, j = np.nonzero(hit ^ sure)
        hit[i, j] = np.sqrt(_exact_squared(a, b, i, j)) <= eps
    return hit


def hit_distances(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact distances of the listed pairs."""
    return np.sqrt(_exact_squared(a, b, i, j))


def anchors_of(x: np.ndarray, anchors: np.ndarray, eps: float) -> tuple[np.ndarray, list]:
    """Home anchor of each row and the lower-numbered anchors whose home it may reach.

    If y has home j and d(x, y) <= eps then d(x, a_j) <= d(x, home of x) + 2 eps by the
    triangle inequality, so no partner is missed. Keeping only anchors below the home
    leaves each unordered pair to exactly one anchor.
    """
    gaps = distances(x, anchors)
    home = gaps.argmin(axis=1)
    reach = gaps <= gaps.min(axis=1)[:, None] + 2.0 * eps + 1e-7
    reach &= np.arange(len(anchors))[None, :] < home[:, None]
    return home, [np.nonzero(row)[0].tolist() for row in reach]


def later_ids(homes: pd.DataFrame, members: pd.DataFrame) -> np.ndarray:
    """What a home id must stay below for each member, so that every unordered pair is held once."""
    same_home = members["home"].to_numpy() == homes["home"].to_numpy()[0]
    # a member of another home counts as later than every home row
    return np.where(same_home, members["id"].to_numpy(), np.iinfo(np.int64).max)


def level_pairs(homes: pd.DataFrame, members: pd.DataFrame, limits: np.ndarray):
    """(a, b, pieces): both matrices, and pieces of (row of a, row of b, level) for the pairs within the largest limit.

    The level is the place of the smallest limit (ascending) that is at least the distance. Every unordered pair comes once,
    and a piece looks at ``TILE`` x ``TILE`` pairs at most.
    """
    a, b = stack(homes["vec"]), stack(members["vec"])
    ids, later = homes["id"].to_numpy(), later_ids(homes, members)
    squares, a2, b2 = limits * limits, np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    slack = _single(a, b)
    kind = np.float64 if slack is None or slack.max(initial=0.0) > 1e-3 * squares[-1] else np.float32
    if kind is np.float64:
        slack = 1e-10 * (a2 + b2.max(initial=0.0)) + 1e-300
    left = np.concatenate([-2.0 * a, np.ones((len(a), 1))], axis=1).astype(kind)
    right = np.concatenate([b, b2[:, None]], axis=1).astype(kind)
    bound = (squares[-1] + slack - a2).astype(kind)
    bound = np.nextafter(bound, kind(np.inf))

    def pieces():
        for low in range(0, len(a), TILE):
            for first in range(0, len(b), TILE):
                rough = left[low : low + TILE] @ right[first : first + TILE].T
                i, j = np.divmod(np.flatnonzero(rough <= bound[low : low + TILE, None]), rough.shape[1])
                keep = ids[low + i] < later[first + j]
                i, j = i[keep], j[keep]
                gaps = rough[i, j].astype(np.float64) + a2[low + i]
                i, j = low + i, first + j
                level = np.searchsorted(squares, gaps - slack[i])
                unsure = np.flatnonzero(level != np.searchsorted(squares, gaps + slack[i]))
                level[unsure] = np.searchsorted(limits, np.sqrt(_exact_squared(a, b, i[unsure], j[unsure])))
                met = level < len(limits)
                yield i[met], j[met], level[met]

    return a, b, pieces()


def distance_tiles(a: np.ndarray, b: np.ndarray):
    """(first row of a, first row of b, distances) in pieces of at most ``TILE`` x ``TILE`` pairs."""
    for low in range(0, len(a), TILE):
        for first in range(0, len(b), TILE):
            yield low, first, distances(a[low : low + TILE], b[first : first + TILE])


def cluster_sums(a: np.ndarray, b: np.ndarray, groups_a: np.ndarray, groups_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of distances of each row of ``a`` to the groups of ``b``, and of each row of ``b`` to those of ``a``.

    Groups are numbered from 0 and in order.
    """
    to_b, to_a = np.zeros((len(a), groups_b[-1] + 1)), np.zeros((groups_a[-1] + 1, len(b)))
    for low, first, gaps in distance_tiles(a, b):
        mine, theirs = groups_a[low : low + len(gaps)], groups_b[first : first + gaps.shape[1]]
        starts_a, starts_b = (np.flatnonzero(np.r_[True, np.diff(g) > 0]) for g in (mine, theirs))
        to_b[low : low + len(gaps), theirs[starts_b]] += np.add.reduceat(gaps, starts_b, axis=1)
        to_a[mine[starts_a], first : first + gaps.shape[1]] += np.add.reduceat(gaps, starts_a, axis=0)
    return to_b, to_a.T


def levels(a: np.ndarray, b: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Matrix of the place of the smallest limit (ascending) that is at least the distance; their number if none is."""
    rough, slack = _rough_squared(a, b)
    squares, margin = limits * limits, slack.max() if len(slack) else 0.0
    found = np.searchsorted(squares, rough - margin)
    unsure = found != np.searchsorted(squares, rough + margin)
    if unsure.any():
        i, j = np.nonzero(unsure)
        found[i, j] = np.searchsorted(limits, np.sqrt(_exact_squared(a, b, i, j)))
    return found


class Links:
    """Components of two lists of ids, from pairs of places that come in pieces. An id on both sides is one node."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.ids, places = np.unique(np.concatenate([left, right]), return_inverse=True)
        self.left, self.right = places[: len(left)], places[len(left) :]
        self.root = np.arange(len(self.ids))

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs of a place on the left and one on the right."""
        self.unite(self.left[i], self.right[j])

    def unite(self, u: np.ndarray, v: np.ndarray) -> None:
        """Hooks the larger of two roots below the smaller until none differ."""
        while True:
            u, v = self.root[u], self.root[v]
            apart = u != v
            if not apart.any():
                return
            u, v = u[apart], v[apart]
            low, high = np.minimum(u, v), np.maximum(u, v)
            order = np.argsort(-low, kind="stable")
            self.root[high[order]] = low[order]  # of several the smallest is written last
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(node, smallest node of its component) of all others in it: fewer rows than nodes."""
        below = np.flatnonzero(self.root != np.arange(len(self.root)))
        return self.ids[below], self.ids[self.root[below]]


class LevelLinks:
    """``Links`` for pairs that each count from a level on."""

    def __init__(self, left: np.ndarray, right: np.ndarray, levels: int):
        self.own = [Links(left, right) for _ in range(levels)]

    def join(self, i: np.ndarray, j: np.ndarray, level: np.ndarray) -> None:
        for at, links in enumerate(self.own):
            here = level == at
            links.join(i[here], j[here])

    def forest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(node, root, level): edges that join, at each level, what is in reach at that level or below.

        Each edge joins two parts that lower levels left apart, so there are fewer edges than nodes.
        """
        parts, before = [], None
        for level, links in enumerate(self.own):
            nodes = np.arange(len(links.root))
            if before is not None:
                links.unite(nodes, before)
            roots = nodes if before is None else np.unique(before)
            roots = roots[links.root[roots] != roots]
            parts.append((links.ids[roots], links.ids[links.root[roots]], np.full(len(roots), level)))
            before = links.root.copy()
        return tuple(np.concatenate(columns) for columns in zip(*parts))


def level_forest(reach: np.ndarray, left: np.ndarray, right: np.ndarray, levels: int):
    """``LevelLinks.forest`` of a matrix of levels; ``levels`` and more is out of reach."""
    links, (i, j) = LevelLinks(left, right, levels), np.nonzero(reach < levels)
    links.join(i, j, reach[i, j])
    return links.forest()


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    norms = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(norms > 0, norms, 1.0)[:, None]


def best_scores(queries: np.ndarray, tags: np.ndarray, n: int):
    """Per query the tags whose cosine is among the ``n`` best, ties with the n-th kept.

    Takes unit-length rows; yields (query row, tag rows, scores to nine decimals).
    """
    n = min(n, len(tags))
    for low, high in _row_chunks(len(queries), len(tags)):
        rough = queries[low:high] @ tags.T
        floor = np.partition(rough, len(tags) - n, axis=1)[:, len(tags) - n] - 2e-9
        for row in range(high - low):
            rows = np.nonzero(rough[row] >= floor[row])[0]
            exact = np.round((tags[rows] * queries[low + row]).sum(axis=1), 9)
            keep = exact >= np.sort(exact)[len(exact) - n]
            yield low + row, rows[keep], exact[keep]


def gram(parts):
    """Sums of x and x x' over all frames of one task: (n, sums, products) or None."""
    n, sums, products = 0, None, None
    for part in parts:
        if len(part) == 0:
            continue
        x = stack(part["vec"])
        if sums is None:
            sums = np.zeros(x.shape[1])
            products = np.zeros((x.shape[1], x.shape[1]))
        n += len(x)
        sums += x.sum(axis=0)
        products += x.T @ x
    return None if sums is None else (n, sums, products)


def dense_chunks(batches, width: int):
    """Dense matrices of a bounded number of rows from batches of (at, x) lists: places and values of each row."""
    step = max(1, CHUNK_CELLS // max(1, width))
    for batch in batches:
        for low in range(0, batch.num_rows, step):
            part = batch.slice(low, step)
            at, values = part.column(0), part.column(1)
            rows = np.repeat(np.arange(part.num_rows), at.value_lengths().to_numpy())
            x = np.zeros((part.num_rows, width))
            x[rows, at.flatten().to_numpy()] = values.flatten().to_numpy()
            yield x


def vector_chunks(batches, rows: int = 2048):
    """Matrices of at most ``rows`` rows from batches whose only column holds vectors of one length."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            part = batch.slice(low, rows)
            yield stack_lists(part.column(0))


def stack_lists(column: pa.ListArray) -> np.ndarray:
    """An Arrow column of vectors of one length as a matrix."""
    return column.flatten().to_numpy().reshape(len(column), -1).astype(np.float64, copy=False)


def term_runs(tokens, place: dict, most: int):
    """(row, term, count) arrays of the known tokens of an Arrow list column, by row and term, in pieces of whole rows.

    Every different token of the column is looked up once. A piece has at most ``most`` entries, or one row.
    """
    flat = tokens.flatten().dictionary_encode()
    known = np.array([place.get(t, -1) for t in flat.dictionary.to_pylist()] + [-1], np.int64)
    found = known[flat.indices.fill_null(-1).to_numpy(zero_copy_only=False)]
    rows = np.repeat(np.arange(len(tokens)), tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    width = max(1, len(place))
    keys, counts = np.unique((rows * width + found)[found >= 0], return_counts=True)
    rows, found = keys // width, keys % width
    ends = np.append(np.flatnonzero(np.diff(rows)) + 1, len(rows))
    low = 0
    while low < len(rows):
        high = max(ends[np.searchsorted(ends, low, side="right")], ends[max(0, np.searchsorted(ends, low + most, side="right") - 1)])
        yield rows[low:high], found[low:high], counts[low:high]
        low = high


def pair_products(x: np.ndarray) -> np.ndarray:
    """For each row the products of all pairs of its numbers (the upper triangle), then its numbers."""
    d, turned = x.shape[1], np.ascontiguousarray(x.T)
    out, low = np.empty((d * (d + 1) // 2 + d, len(x))), 0
    for i in range(d):
        np.multiply(turned[i:], turned[i], out=out[low : low + d - i])
        low += d - i
    out[low:] = turned
    return out.T


def quadratic(constants: np.ndarray, means: np.ndarray, precisions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, constants) that give c - (x - m)' P (x - m) / 2 of each component as a product with ``pair_products``."""
    d = means.shape[1]
    upper, pulled = np.triu_indices(d), (precisions @ means[:, :, None])[:, :, 0]
    squares = (precisions * (0.5 * np.eye(d) - 1.0))[:, upper[0], upper[1]]
    return np.concatenate([squares, pulled], axis=1).T.copy(), constants - 0.5 * np.einsum("kd,kd->k", pulled, means)


def shares(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log of the sum of each row's exponentials, their shares of it), written over ``logs``."""
    top = logs.max(axis=1, keepdims=True)
    logs -= top
    np.exp(logs, out=logs)
    mass = logs.sum(axis=1, keepdims=True)
    logs /= mass
    return (top + np.log(mass))[:, 0], logs


def responsibilities(x: np.ndarray, constants: np.ndarray, means: np.ndarray, white: np.ndarray):
    """(log-likelihood of each row, probabilities of the components) of a Gaussian mixture.

    Squared lengths of whitened rows come from one product with the rows' ``pair_products`` around the middle of the means. Where
    rounding could show, as with components far narrower than their distances, rows are whitened one component after the other.
    """
    k, d = means.shape
    logs, middle = np.empty((len(x), k)), means.mean(axis=0)
    precisions = white @ white.transpose(0, 2, 1)
    away, near = x - middle, means - middle
    far = max(np.einsum("nd,nd->n", away, away).max(initial=0.0), np.einsum("kd,kd->k", near, near).max())
    if d * far * np.sqrt(np.einsum("kij,kij->k", precisions, precisions).max()) < ROUGH_MOST:
        coefficients, rest = quadratic(constants, near, precisions)
        for low in range(0, len(x), PAIR_ROWS):
            np.matmul(pair_products(away[low : low + PAIR_ROWS]), coefficients, out=logs[low : low + PAIR_ROWS])
        logs += rest
        return shares(logs)
    shift = (means[:, None, :] @ white)[:, 0, :]
    for first in range(0, k, BESIDE):
        beside = np.ascontiguousarray(white[first : first + BESIDE].transpose(1, 0, 2)).reshape(d, -1)
        gone = shift[first : first + BESIDE].ravel()
        for low in range(0, len(x), 256):
            y = x[low : low + 256] @ beside
            y -= gone
            y = y.reshape(len(y), -1, d)
            logs[low : low + 256, first : first + BESIDE] = -0.5 * np.einsum("njd,njd->nj", y, y)
    logs += constants
    return shares(logs)


def weighted_products(x: np.ndarray, r: np.ndarray, total: np.ndarray) -> None:
    """Adds x x' weighted by each column of ``r`` to ``total``.

    Where few weights count, those too small to change a sum of doubles are left out; else all components share one product.
    """
    if np.count_nonzero(r > VANISHING) * DENSE_GAIN < r.size:
        for j in range(r.shape[1]):
            rows = np.flatnonzero(r[:, j] > VANISHING)
            if len(rows):
                part = x[rows]
                total[j] += (part * r[rows, j, None]).T @ part
        return
    d = x.shape[1]
    upper = np.triu_indices(d)
    sums = np.zeros((r.shape[1], len(upper[0]) + d))
    for low in range(0, len(x), PAIR_ROWS):
        sums += r[low : low + PAIR_ROWS].T @ pair_products(x[low : low + PAIR_ROWS])
    total += unfold(sums[:, :-d], d)


def unfold(upper: np.ndarray, d: int) -> np.ndarray:
    """Symmetric matrices from rows of upper triangles."""
    out, places = np.empty((len(upper), d, d)), np.triu_indices(d)
    out[:, places[0], places[1]] = upper
    out[:, places[1], places[0]] = upper
    return out


def log_normalisers(covariances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half the log-determinant of each covariance, and a matrix W with covariance^-1 = W W'."""
    lower = np.linalg.cholesky(covariances)
    return np.log(np.einsum("kii->ki", lower)).sum(axis=1), np.linalg.inv(lower).transpose(0, 2, 1)


def maximised(n, sums, products, pooled, strength, before):
    """(weights, means, covariances) from sums of weights (k), vectors (k x d) and products (k x d x d); an empty component keeps its mean."""
    safe = np.maximum(n, 1e-300)
    means = np.where(n[:, None] > 1e-9, sums / safe[:, None], before)
    scatter = products - n[:, None, None] * means[:, :, None] * means[:, None, :]
    covariances = (scatter + strength * pooled) / (n + strength)[:, None, None]
    return n / n.sum(), means, (covariances + covariances.transpose(0, 2, 1)) / 2


def expectations(chunks, constants: np.ndarray, means: np.ndarray, white: np.ndarray, middle: np.ndarray) -> tuple[float, np.ndarray]:
    """(log-likelihood, sums) of all rows: for each component the sum of its probabilities, and of the rows' ``pair_products``
    around ``middle`` weighted by them. As ``responsibilities`` and ``weighted_products``, with one set of products for both."""
    k, d = means.shape
    precisions, near = white @ white.transpose(0, 2, 1), means - middle
    coefficients, rest = quadratic(constants, near, precisions)
    size, far = d * np.sqrt(np.einsum("kij,kij->k", precisions, precisions).max()), np.einsum("kd,kd->k", near, near).max()
    likelihood, sums, apart, upper = 0.0, np.zeros((k, 1 + len(coefficients))), None, np.triu_indices(d)
    for x in chunks:
        for low in range(0, len(x), PAIR_ROWS):
            part = x[low : low + PAIR_ROWS]
            away = part - middle
            pairs = pair_products(away)
            if size * max(far, np.einsum("nd,nd->n", away, away).max()) < ROUGH_MOST:
                logs = pairs @ coefficients
                logs += rest
                found, r = shares(logs)
            else:
                found, r = responsibilities(part, constants, means, white)
            likelihood += found.sum()
            sums[:, 0] += r.sum(axis=0)
            if np.count_nonzero(r > VANISHING) * DENSE_GAIN < r.size:
                apart = np.zeros((k, d, d)) if apart is None else apart
                weighted_products(away, r, apart)
                sums[:, -d:] += r.T @ away
            else:
                sums[:, 1:] += r.T @ pairs
    if apart is not None:
        sums[:, 1:-d] += apart[:, upper[0], upper[1]]
    return likelihood, sums


def mixture_path(x: np.ndarray, means: np.ndarray, pooled: np.ndarray, strength: float, tol: float, max_iter: int) -> tuple[list[float], float]:
    """(objective after each number of steps, log-likelihood at the end) of a mixture fitted in one task to all rows.

    Starts even, with the given means and the ``pooled`` covariance; ends when the objective gains less than ``tol``.
    """
    k, d = means.shape
    middle = x.mean(axis=0)
    x, means = x - middle, means - middle
    weights, covariances, path = np.full(k, 1 / k), np.repeat(pooled[None], k, 0), []
    while True:
        half, white = log_normalisers(covariances)
        with np.errstate(divide="ignore"):
            constants = np.log(weights) - half - d / 2 * np.log(2 * np.pi)
        likelihood, sums = expectations([x], constants, means, white, np.zeros(d))
        path.append(likelihood - strength / 2 * (2 * half.sum() + (white * (pooled @ white)).sum()))
        if len(path) > 1 and path[-1] - path[-2] < tol or len(path) > max_iter:
            return path, likelihood
        weights, means, covariances = maximised(sums[:, 0], sums[:, -d:], unfold(sums[:, 1:-d], d), pooled, strength, means)


def weighted_seeds(points: np.ndarray, weights: np.ndarray, k: int, seed: int, steps: int) -> np.ndarray:
    """At most ``k`` centres of weighted points: greedy k-means++ picks, then Lloyd steps."""
    rng = np.random.default_rng([seed, k])
    if len(points) <= k:
        return points
    lengths, trials = np.einsum("ij,ij->i", points, points), 2 + int(np.log(k))
    picked = [int(rng.choice(len(points), p=weights / weights.sum()))]
    gaps = np.maximum(lengths - 2 * (points @ points[picked[0]]) + lengths[picked[0]], 0.0)
    while True:
        gaps[picked[-1]] = 0.0
        pull = gaps * weights
        if len(picked) == k or pull.sum() <= 0:
            break
        # of a few draws the one that leaves the least cost
        drawn = rng.choice(len(points), trials, p=pull / pull.sum())
        left = points[drawn] @ points.T
        left *= -2.0
        left += lengths
        left += lengths[drawn, None]
        np.clip(left, 0.0, gaps, out=left)
        best = int((left @ weights).argmin())
        picked.append(int(drawn[best]))
        gaps = left[best].copy()
    centres = points[picked]
    for _ in range(steps):
        index = nearest_index(points, centres)
        mass = np.bincount(index, weights, minlength=len(centres))
        moved = np.stack([np.bincount(index, weights * column, minlength=len(centres)) for column in points.T], axis=1)
        after = np.where(mass[:, None] > 0, moved / np.maximum(mass, 1e-300)[:, None], centres)
        if np.array_equal(after, centres):
            break
        centres = after
    return centres


def silhouette_sum(x: np.ndarray, centres: np.ndarray, n: np.ndarray, means: np.ndarray, lengths: np.ndarray) -> float:
    """Sum of squared-Euclidean silhouettes of rows whose cluster is the nearest centre.

    ``n``, ``means`` and ``lengths`` (mean squared length) describe all rows of each cluster.
    """
    if (n > 0).sum() < 2:
        return 0.0
    index = nearest_index(x, centres)
    rows = np.arange(len(x))
    gaps = np.einsum("ij,ij->i", x, x)[:, None] - 2 * x @ means.T + lengths[None, :]
    own = n[index]
    a = np.maximum(gaps[rows, index], 0.0) * own / np.maximum(own - 1, 1)
    gaps[rows, index] = np.inf
    b = np.maximum(gaps.min(axis=1), 0.0)
    top = np.maximum(a, b)
    return float(np.where((own > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1.0), 0.0).sum())


def blocks(sums: dict[int, np.ndarray]):
    """A batch (model, part, cells) for each key: the bytes of some rows of its matrix at a time, in order."""
    for key, rows in sums.items():
        per = max(1, BLOCK_CELLS // rows.shape[1])
        cells = [rows[low : low + per].tobytes() for low in range(0, len(rows), per)]
        yield block_batch([(key, part, c) for part, c in enumerate(cells)])


def block_batch(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)], names=["model", "part", "cells"])


def block_values(batch: pa.RecordBatch):
    """(model, part, numbers) of each row."""
    for model, part, cells in zip(*(batch.column(c).to_pylist() for c in ("model", "part", "cells"))):
        yield model, part, np.frombuffer(cells)


def add_blocks(batches):
    """One row for each model and part, with the sums of the numbers."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for model, part, values in block_values(batch):
            if (model, part) in total:
                total[model, part] += values
            else:
                total[model, part] = values.copy()
    yield block_batch([(*place, values.tobytes()) for place, values in total.items()])
