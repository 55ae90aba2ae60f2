"""Array kernels of boosted trees: histograms, regularised splits, leaf-wise
growth, prediction and exact path-dependent attribution.

Plain numpy over one block of rows or one set of histograms; which rows meet
where is Spark's business (:mod:`attrition.plans.boosting`). Gradients are
whole numbers (multiples of 2^-20), so histogram sums are exact: the same trees
come out however rows are partitioned and in whichever order parts are added.
"""

from __future__ import annotations

import heapq
import io
from dataclasses import dataclass
from functools import cache

import numpy as np

#: One unit of a gradient or Hessian.
UNIT = 2.0 ** -20
#: Smallest gain that counts as one.
LEAST_GAIN = 1e-6
_ROWS = 16_384  # rows whose bins are counted at a time
_COUNTED, _STEPPED = 65_536, 32_768  # rows of packed columns that are counted or moved at a time


@dataclass(frozen=True)
class BoostSpec:
    """Second-order boosting with a logistic loss."""

    rounds: int = 300
    step: float = 0.05
    max_depth: int = 7
    max_leaves: int | None = None   # best-first growth up to so many leaves
    l1: float = 0.0
    l2: float = 1.0
    min_gain: float = 0.0
    min_child_weight: float = 1.0
    min_rows: int = 1
    subsample: float = 0.8          # rows per tree
    colsample: float = 0.8          # columns per tree
    pos_weight: float | None = 1.0  # None: both classes weigh alike
    from_prior: bool = False        # start at the weighted log-odds instead of 0
    seed: int = 42


@dataclass(frozen=True)
class Layout:
    """Bins of all features on one axis."""

    starts: tuple[int, ...]  # first bin of each feature, then the total
    cuts: tuple[float, ...]  # upper edge of each bin; the last bin of a feature has none (inf)

    @classmethod
    def of(cls, edges: list[list[float]]) -> "Layout":
        starts, cuts = [0], []
        for e in edges:
            cuts += [*e, float("inf")]
            starts.append(len(cuts))
        return cls(tuple(starts), tuple(cuts))

    @property
    def width(self) -> int:
        return self.starts[-1]

    @property
    def n_features(self) -> int:
        return len(self.starts) - 1

    def feature_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_features), np.diff(self.starts))

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Global bin of each value; NaN falls into the last bin of its feature."""
        out = np.empty(x.shape, np.int32)
        for f in range(self.n_features):
            a, b = self.starts[f], self.starts[f + 1] - 1
            out[:, f] = a + np.searchsorted(self.cuts[a:b], x[:, f], side="left")
        return out


def uniform(keys: np.ndarray, *salt: int) -> np.ndarray:
    """Reproducible uniforms in [0, 1) of 64-bit keys."""
    z = keys.astype(np.uint64)
    with np.errstate(over="ignore"):
        for s in salt:
            z = (z + np.uint64((s * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2 ** 64))
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(float) * 2.0 ** -53


def drawn_columns(spec: BoostSpec, tree: int, n_features: int) -> np.ndarray:
    """The columns that a tree may split on: the share of smallest draws, one at least."""
    take = max(1, int(round(spec.colsample * n_features)))
    u = uniform(np.arange(n_features), spec.seed, tree, 1)
    out = np.zeros(n_features, bool)
    out[np.argsort(u, kind="stable")[:take]] = True
    return out


def gradients(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint(weight * (p - y) / UNIT), np.rint(weight * p * (1 - p) / UNIT)


def histograms(code: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, n_slots: int,
               width: int, layout: Layout | None = None) -> np.ndarray:
    """Sums of gradients, Hessians and rows per (slot, bin); rows with slot -1 are left out.

    With the ``layout``, features of two bins (most are indicators) are summed as
    a matrix product per slot. All sums are whole numbers below 2^53, so both ways agree."""
    out = np.zeros((3, n_slots * width), np.int64)
    live = np.flatnonzero(slot >= 0)
    n_bins = np.diff(layout.starts) if layout else np.full(code.shape[1], 3)
    many, few = np.flatnonzero(n_bins > 2), np.flatnonzero(n_bins <= 2)
    for s in range(0, len(live) if len(many) else 0, _ROWS):
        rows = live[s:s + _ROWS]
        at = (slot[rows, None] * width + (code[rows[:, None], many] if len(few) else code[rows])).ravel()
        n = len(many)
        out[0] += np.bincount(at, np.repeat(g[rows], n), n_slots * width).astype(np.int64)
        out[1] += np.bincount(at, np.repeat(h[rows], n), n_slots * width).astype(np.int64)
        out[2] += np.bincount(at, minlength=n_slots * width)
    out = out.reshape(3, n_slots, width)
    if len(few) and len(live):
        starts = np.array(layout.starts[:-1], code.dtype)
        first, two = starts[few], n_bins[few] == 2
        rows = live[np.argsort(slot[live], kind="stable")]
        for s in range(0, len(rows), 4 * _ROWS):
            part = rows[s:s + 4 * _ROWS]
            upper = (np.take(code, part, axis=0) > starts).astype(float)
            sums = np.vstack([g[part], h[part], np.ones(len(part))])
            own = slot[part]
            cuts = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True])
            for a, b in zip(cuts[:-1], cuts[1:]):
                high = np.rint(sums[:, a:b] @ upper[a:b])[:, few].astype(np.int64)
                all_ = sums[:, a:b].sum(axis=1).astype(np.int64)
                out[:, own[a], first] += all_[:, None] - high
                out[:, own[a], first[two] + 1] += high[:, two]
    return out


def local_codes(code: np.ndarray, layout: Layout) -> np.ndarray:
    """Bins counted from each feature's first one."""
    out = code - np.array(layout.starts[:-1], code.dtype)
    return out.astype(np.uint8 if max(np.diff(layout.starts), default=0) <= 256 else np.uint16)


class PackedCode:
    """Binned values by column; features of few bins share a byte, for counting.

    For many histograms of the same rows: :meth:`histograms` gives what :func:`histograms`
    gives, from a few columns instead of one per feature, and :meth:`step` moves rows as
    :func:`stepped` does. Features of two bins (most are indicators) go eight to a byte, others as
    long as the product of their bins stays below 256; a sum over a byte's values gives each
    feature's bins."""

    def __init__(self, code: np.ndarray, layout: Layout):
        self._of(np.ascontiguousarray(local_codes(code, layout).T), layout)

    @classmethod
    def of_columns(cls, local: np.ndarray, layout: Layout) -> "PackedCode":
        """From local codes, features x rows."""
        out = cls.__new__(cls)
        out._of(local, layout)
        return out

    def _of(self, local: np.ndarray, layout: Layout) -> None:
        self.layout, self.local, self.n = layout, local, local.shape[1]
        n_bins = np.diff(layout.starts)
        groups: list[list[int]] = []
        for f in sorted(np.flatnonzero(n_bins > 2), key=lambda f: (-n_bins[f], f)):  # widest first, each where it fits
            into = next((k for k in groups if np.prod(n_bins[k]) * n_bins[f] < 256), None)
            if into is None:
                groups.append(into := [])
            into.append(int(f))
        two = np.flatnonzero(n_bins == 2).tolist()
        self.columns = [self._joint(k, n_bins) for k in groups]
        self.bytes = [self._joint(two[s:s + 8], n_bins) for s in range(0, len(two), 8)]
        self.one = np.array(layout.starts[:-1])[n_bins == 1]

    def _joint(self, features: list[int], n_bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The features' bins (on the common axis), the byte of all, and which of its values are in which bin."""
        byte, size = self.local[features[0]], int(n_bins[features[0]])
        for f in features[1:]:
            byte = byte + self.local[f] * byte.dtype.type(size)
            size *= int(n_bins[f])
        value, bins, inside = np.arange(size), [], []
        for f in features:
            bins.append(self.layout.starts[f] + np.arange(n_bins[f]))
            inside.append(value[:, None] % n_bins[f] == np.arange(n_bins[f]))
            value = value // n_bins[f]
        return np.concatenate(bins), byte, np.hstack(inside).astype(float)

    def step(self, at: np.ndarray, bins: np.ndarray, left: np.ndarray) -> None:
        """Moves the rows' nodes on by one level of splits, in place."""
        split, feature = bins >= 0, self.layout.feature_of()[np.maximum(bins, 0)]
        first = np.where(split, feature, 0) * self.n
        cut = np.where(split, bins - np.array(self.layout.starts)[feature], np.iinfo(self.local.dtype).max) \
            .astype(self.local.dtype)
        to, flat = np.where(split, left, np.arange(len(bins))), self.local.reshape(-1)
        for s in range(0, self.n, _STEPPED):
            own = at[s:s + _STEPPED]
            place = first.take(own)
            place += np.arange(s, s + len(own))
            right = flat.take(place) > cut.take(own)
            np.add(to.take(own), right, out=own)

    def histograms(self, slot: np.ndarray, g: np.ndarray, h: np.ndarray, n_slots: int) -> np.ndarray:
        live = np.flatnonzero(slot >= 0)
        return self.sums(live, slot[live], g, h, n_slots)

    def sums(self, live: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, n_slots: int) -> np.ndarray:
        """Histograms of the rows ``live``, which lie in the slots ``slot``.

        A row and its Hessian are one number, the row above the bits that a chunk's Hessians need, so that
        two sums give three. Where the weights leave no room for this, rows are counted by themselves."""
        layout = self.layout
        out = np.zeros((3, n_slots, layout.width), np.int64)
        groups = self.columns + self.bytes
        most, rows = float(h[live].max(initial=0)), _COUNTED
        while rows > 1024 and _bits(rows * most) + _bits(rows) > 53:
            rows //= 2
        unit = 2.0 ** _bits(rows * most) if _bits(rows * most) + _bits(rows) <= 53 else 0.0
        stride = max((len(inside) for _, _, inside in groups), default=1)
        total = [np.zeros((3, n_slots * stride)) for _ in groups]
        alone = np.zeros((3, n_slots))
        for s in range(0, len(live), rows):
            part, own = live[s:s + rows], slot[s:s + rows]
            gp, hp = g.take(part), h.take(part)
            counted = hp + unit if unit else None

            def added(into, place):
                n = into.shape[1]
                into[0] += np.bincount(place, gp, n)
                if counted is None:
                    into[1] += np.bincount(place, hp, n)
                    into[2] += np.bincount(place, minlength=n)
                    return
                both = np.bincount(place, counted, n)
                count = np.floor(both / unit)
                into[2] += count
                count *= unit
                both -= count
                into[1] += both

            first = own * stride
            for into, (_, byte, _) in zip(total, groups):
                added(into, first + byte.take(part))
            if len(self.one):
                added(alone, own)
        for into, (bins, _, inside) in zip(total, groups):
            sums = into.reshape(3, n_slots, stride)[:, :, :len(inside)] @ inside
            out[:, :, bins] = np.rint(sums).astype(np.int64)
        if len(self.one):
            out[:, :, self.one] = alone[:, :, None].astype(np.int64)
        return out


def _bits(x: float) -> int:
    """Bits of whole numbers up to x."""
    return int(np.floor(np.log2(x))) + 1 if x >= 1 else 0


def siblings(parents: np.ndarray, small: np.ndarray, pairs: list[tuple[int, bool]]) -> np.ndarray:
    """Histograms of both children of each pair (parent's position, whether the
    counted child is the left one): the other is the parent minus the counted."""
    where = [p for p, _ in pairs]
    left = np.array([x for _, x in pairs], bool)[None, :, None]
    other = parents[:, where] - small
    out = np.empty((3, 2 * len(pairs), small.shape[2]), np.int64)
    out[:, 0::2] = np.where(left, small, other)
    out[:, 1::2] = np.where(left, other, small)
    return out


def objective(g, h, l1: float, l2: float):
    """Twice the loss a leaf saves: soft(g)^2 / (h + l2)."""
    t = np.maximum(np.abs(g) - l1, 0.0)
    d = h + l2
    return np.divide(t * t, d, out=np.zeros(np.broadcast(t, d).shape), where=d > 0)


def best_splits(hist: np.ndarray, layout: Layout, features: range, spec: BoostSpec,
                allowed: np.ndarray) -> np.ndarray:
    """Per node a row (gain, bin, left sums of 3, all sums of 3) of its best split
    over ``features`` (hist covers their bins only); the first of equal gains."""
    first, last = layout.starts[features.start], layout.starts[features.stop]
    feature = layout.feature_of()[first:last]
    begin = np.array(layout.starts)[feature] - first
    sums = np.concatenate([np.zeros((*hist.shape[:2], 1), np.int64), np.cumsum(hist, axis=2)], axis=2)
    all_ = sums[:, :, layout.starts[features.start + 1] - first]
    left = sums[:, :, 1:] - sums[:, :, begin]
    right = all_[:, :, None] - left
    g, h = left[0] * UNIT, left[1] * UNIT
    rg, rh = right[0] * UNIT, right[1] * UNIT
    gain = objective(g, h, spec.l1, spec.l2) + objective(rg, rh, spec.l1, spec.l2) \
        - objective(all_[0] * UNIT, all_[1] * UNIT, spec.l1, spec.l2)[:, None]
    fits = (h >= spec.min_child_weight) & (rh >= spec.min_child_weight) & (left[2] >= spec.min_rows) \
        & (right[2] >= spec.min_rows) & (left[2] > 0) & (right[2] > 0) & allowed[feature]
    gain = np.where(fits, gain, -np.inf)
    at = gain.argmax(axis=1)
    i = np.arange(len(at))
    return np.column_stack([gain[i, at], at + first, left[:, i, at].T, all_.T]).astype(float)


def merged_splits(parts: list[np.ndarray]) -> np.ndarray:
    """The best of each node's splits over parts that are in feature order."""
    out = parts[0].copy()
    for p in parts[1:]:
        better = p[:, 0] > out[:, 0]
        out[better] = p[better]
    return out


class Grower:
    """One tree: which nodes to count next, and which splits stay.

    Levels are counted together, yet growth is best-first: a split waits in a
    queue by gain, and only the first ``max_leaves - 1`` splits stay. A node that
    doesn't come up among them with the gains known so far never will, since
    deeper nodes only compete, so it isn't opened at all.
    """

    def __init__(self, spec: BoostSpec):
        self.spec = spec
        self.bin, self.left, self.depth, self.gain = [-1], [-1], [0], [-np.inf]
        self.sums: list[tuple[float, float, float]] = [(0.0, 0.0, 0.0)]
        self.found: list[np.ndarray | None] = [None]
        self.level, self.counted, self.pairs = [0], [0], None

    def chosen(self) -> list[int]:
        """Nodes whose split is taken, in the order of the queue."""
        most = self.spec.max_leaves - 1 if self.spec.max_leaves else len(self.bin)
        queue = [(-self.gain[0], 0)]
        out = []
        while queue and len(out) < most:
            gain, node = heapq.heappop(queue)
            if -gain <= max(self.spec.min_gain, LEAST_GAIN):
                break
            out.append(node)
            if self.left[node] >= 0:
                for child in (self.left[node], self.left[node] + 1):
                    heapq.heappush(queue, (-self.gain[child], child))
        return out

    def take(self, splits: np.ndarray) -> None:
        """Best splits of the counted level, in its order; opens the next level."""
        for node, s in zip(self.level, splits):
            if node == 0:
                self.sums[0] = tuple(s[5:8])
            if self.depth[node] < self.spec.max_depth:
                self.gain[node], self.found[node] = s[0], s
        stays = set(self.chosen())
        self.counted, self.pairs, nxt = [], [], []
        for i, node in enumerate(self.level):
            if node not in stays:
                continue
            s = self.found[node]
            self.bin[node], self.left[node] = int(s[1]), len(self.bin)
            left = tuple(s[2:5])
            right = tuple(a - b for a, b in zip(self.sums[node], left))
            for sums in (left, right):
                self.bin.append(-1)
                self.left.append(-1)
                self.depth.append(self.depth[node] + 1)
                self.gain.append(-np.inf)
                self.sums.append(sums)
                self.found.append(None)
            if self.depth[node] + 1 < self.spec.max_depth:
                small_left = left[2] <= right[2]
                self.pairs.append((i, small_left))
                self.counted.append(self.left[node] + (0 if small_left else 1))
                nxt += [self.left[node], self.left[node] + 1]
        self.level = nxt

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.bin, np.int32), np.array(self.left, np.int32)

    def slots(self) -> np.ndarray:
        out = np.full(len(self.bin), -1, np.int64)
        out[self.counted] = np.arange(len(self.counted))
        return out

    def _placed(self, keep: set[int]) -> tuple[dict[int, int], list[int]]:
        """Place of each node that stays in the finished tree, and these nodes in its order."""
        at, order = {0: 0}, [0]
        for node in order:
            if node in keep:
                for child in (self.left[node], self.left[node] + 1):
                    at[child] = len(order)
                    order.append(child)
        return at, order

    def places(self) -> np.ndarray:
        """Node of the finished tree per grown node; one below a split that lost its place
        belongs to the leaf there."""
        at, _ = self._placed(set(self.chosen()))
        out = np.zeros(len(self.bin), np.int64)
        for node in range(len(out)):  # parents come before their children
            out[node] = at.get(node, out[node])
            if self.left[node] >= 0:
                out[self.left[node]:self.left[node] + 2] = out[node]
        return out

    def finished(self) -> dict[str, np.ndarray]:
        """Node arrays of the tree; splits that lost their place become leaves."""
        keep = set(self.chosen())
        at, order = self._placed(keep)
        g, h = (np.array([self.sums[n][i] for n in order]) * UNIT for i in (0, 1))
        soft = np.sign(g) * np.maximum(np.abs(g) - self.spec.l1, 0.0)
        weight = np.divide(-soft, h + self.spec.l2, out=np.zeros(len(g)), where=h + self.spec.l2 > 0)
        return {"bin": np.array([self.bin[n] if n in keep else -1 for n in order], np.int32),
                "left": np.array([at[self.left[n]] if n in keep else -1 for n in order], np.int32),
                "value": weight * self.spec.step,
                "cover": np.array([self.sums[n][2] for n in order]),
                "gain": np.array([self.gain[n] if n in keep else 0.0 for n in order])}


def walk(code: np.ndarray, bins: np.ndarray, left: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """The node that each row of binned values ends in."""
    node = np.zeros(len(code), np.int64)
    live = np.arange(len(code))
    while True:
        live = live[bins[node[live]] >= 0]
        if not len(live):
            return node
        b = bins[node[live]]
        node[live] = left[node[live]] + (code[live, feature[b]] > b)


def stepped(code: np.ndarray, node: np.ndarray, bins: np.ndarray, left: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """The nodes of the rows after one more level of splits."""
    node = node.copy()
    b = bins[node]
    live = np.flatnonzero(b >= 0)
    b = b[live]
    at = feature[b]
    at += live * code.shape[1]
    node[live] = left[node[live]] + (code.reshape(-1)[at] > b)
    return node


class TreeEnsemble:
    """A fitted model: trees as flat node arrays over thresholds, a start margin."""

    def __init__(self, feature, threshold, left, value, cover, gain, roots, start, n_features):
        self.feature, self.threshold, self.left = feature, threshold, left
        self.value, self.cover, self.gain = value, cover, gain
        self.roots, self.start, self.n_features = roots, float(start), int(n_features)

    @classmethod
    def of(cls, trees: list[dict[str, np.ndarray]], layout: Layout, start: float) -> "TreeEnsemble":
        feature_of, cuts = layout.feature_of(), np.array(layout.cuts)
        roots = np.concatenate([[0], np.cumsum([len(t["bin"]) for t in trees])]).astype(np.int64)

        def joined(name, kind):
            return np.concatenate([t[name] for t in trees]).astype(kind) if trees else np.zeros(0, kind)

        bins = joined("bin", np.int64)
        split = bins >= 0
        shift = np.repeat(roots[:-1], np.diff(roots))
        return cls(np.where(split, feature_of[np.maximum(bins, 0)], -1).astype(np.int32),
                   np.where(split, cuts[np.maximum(bins, 0)], np.nan),
                   np.where(split, joined("left", np.int64) + shift, -1), joined("value", float),
                   joined("cover", float), joined("gain", float), roots, start, layout.n_features)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for root in self.roots[:-1]:
            node = np.full(len(x), root)
            live = np.arange(len(x))
            while True:
                live = live[self.feature[node[live]] >= 0]
                if not len(live):
                    break
                at = node[live]
                node[live] = self.left[at] + ~(x[live, self.feature[at]] <= self.threshold[at])
            out += self.value[node]
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margins(x)))

    def importances(self) -> np.ndarray:
        """Share of the total gain per feature."""
        split = self.feature >= 0
        total = np.bincount(self.feature[split], self.gain[split], self.n_features)
        return total / total.sum() if total.sum() > 0 else total

    def paths(self):
        """Per leaf: value, and (feature, low, high, share of the cover) with the
        splits on one feature joined into one interval (low, high]."""
        for root in self.roots[:-1]:
            stack = [(int(root), {})]
            while stack:
                node, path = stack.pop()
                f = int(self.feature[node])
                if f < 0:
                    yield self.value[node], path
                    continue
                low, high, share, nan = path.get(f, (-np.inf, np.inf, 1.0, True))
                t, left = self.threshold[node], int(self.left[node])
                for child, part in ((left, (low, min(high, t), False)), (left + 1, (max(low, t), high, nan))):
                    ratio = self.cover[child] / self.cover[node]
                    stack.append((child, {**path, f: (part[0], part[1], share * ratio, part[2])}))

    def expected(self) -> float:
        """Mean margin over the training rows that the covers stand for."""
        return self.start + sum(v * np.prod([s for _, _, s, _ in path.values()]) for v, path in self.paths())

    def attributions(self, x: np.ndarray) -> np.ndarray:
        """Exact path-dependent Shapley values of the margin, rows x features.

        For one leaf the game is a product over its features, each factor 1 or 0
        (the row is inside the interval or not) if the feature is known, else the
        cover share. The Shapley weights k! (d-k-1)! / d! are the integrals of
        t^k (1-t)^(d-1-k), so the sum over all subsets is one integral over t of
        a polynomial of degree d - 1, which Gauss-Legendre nodes give exactly. A leaf's
        values depend on nothing but the d factors, so with more than 2^d rows they are
        found once per pattern of factors and looked up by row.
        """
        n = len(x)
        out = np.zeros((self.n_features, n))
        inside: dict[tuple, np.ndarray] = {}
        for value, path in self.paths():
            d = len(path)
            if not d or value == 0.0:
                continue
            features, known = list(path), []
            for f in features:
                low, high, _, nan = path[f]
                key = (f, low, high, nan)
                if key not in inside:
                    if len(inside) >= 4096:
                        inside.clear()
                    v = x[:, f]
                    inside[key] = np.where(np.isnan(v), nan, (v > low) & (v <= high))
                known.append(inside[key])
            shares = np.array([share for _, _, share, _ in path.values()])
            if n <= 1 << d:
                out[features] += _leaf_values(np.array(known, float), shares, value)
                continue
            at = np.zeros(n, np.intp)  # which of the 2^d patterns a row has
            for j, k in enumerate(known):
                at += k.astype(np.intp) << j
            for f, of_pattern in zip(features, _leaf_values(_patterns(d), shares, value)):
                out[f] += of_pattern[at]
        return out.T

    def to_bytes(self) -> bytes:
        buf = io.BytesIO()
        np.savez_compressed(buf, feature=self.feature, threshold=self.threshold, left=self.left, value=self.value,
                            cover=self.cover, gain=self.gain, roots=self.roots,
                            start=self.start, n_features=self.n_features)
        return buf.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> "TreeEnsemble":
        with np.load(io.BytesIO(data), allow_pickle=False) as z:
            return cls(**{k: z[k] for k in z.files})


def _leaf_values(ones: np.ndarray, shares: np.ndarray, value: float) -> np.ndarray:
    """Shapley values of one leaf's game, features x columns of ``ones``."""
    nodes, weights = _legendre((len(ones) + 1) // 2)
    factor = shares[:, None, None] * (1 - nodes)[None, :, None] + ones[:, None, :] * nodes[None, :, None]
    whole = factor.prod(axis=0)  # shares and nodes lie inside (0, 1), so no factor is 0
    inner = (weights[None, :, None] * (whole[None] / factor)).sum(axis=1)
    return value * (ones - shares[:, None]) * inner


@cache
def _patterns(d: int) -> np.ndarray:
    """All 0-1 columns of length d, the first feature in the lowest bit."""
    return (np.arange(1 << d)[None, :] >> np.arange(d)[:, None] & 1).astype(float)


@cache
def _legendre(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and weights on [0, 1], exact for polynomials up to degree 2n - 1."""
    x, w = np.polynomial.legendre.leggauss(max(n, 1))
    return (x + 1) / 2, w / 2
