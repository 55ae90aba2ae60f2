"""Array kernels of random forests: Poisson draws, per-node feature draws,
histograms of the drawn features, Gini splits, and growth of a (sub)tree.

Plain numpy over the rows of one (sub)tree; which rows meet where is Spark's
business (:mod:`attrition.plans.forests`). Nodes have heap numbers (root 1,
children 2h and 2h + 1), and all draws are hashes of (row, tree) or (tree, node,
feature). Histograms hold counts of drawn rows per class, which are whole numbers, and
classes have one weight each, so the same trees come out however rows are
partitioned and wherever a tree is cut into parts.
"""

from __future__ import annotations

import io
from dataclasses import dataclass
from math import ceil, exp, factorial, sqrt

import numpy as np

from .trees import Layout, local_codes, uniform

_ROWS = 65_536  # rows whose bins are counted at a time
_NODES = 4_096  # nodes whose histograms are held at a time
_NEAR = 32  # open nodes at which a tree's rows are put side by side
_CELLS = 131_072  # values of rows in the order of their nodes that are counted at a time
#: Chances of a Poisson(1) draw, cumulated.
_POISSON = np.cumsum([exp(-1.0) / factorial(k) for k in range(16)])


@dataclass(frozen=True)
class ForestSpec:
    """Gini trees on Poisson draws of the rows, with a feature draw per node."""

    trees: int = 300
    max_depth: int = 15
    min_rows: int = 5       # drawn rows in a child, at least
    features: str = "sqrt"  # drawn per node: sqrt, log2, onethird, all, or a share
    seed: int = 42

    def drawn(self, n_features: int) -> int:
        many = {"sqrt": sqrt(n_features), "log2": np.log2(max(n_features, 2)), "onethird": n_features / 3,
                "all": n_features, "auto": sqrt(n_features)}
        take = many[self.features] if self.features in many else float(self.features) * n_features
        return min(n_features, max(1, ceil(take)))


def row_draws(rid: np.ndarray, spec: ForestSpec, tree: int) -> np.ndarray:
    """How often a tree draws each row."""
    return np.searchsorted(_POISSON, uniform(rid, spec.seed, tree, 3), side="right")


def feature_draws(heap: np.ndarray, spec: ForestSpec, tree: int, n_features: int) -> np.ndarray:
    """Nodes x drawn features, ascending."""
    keys = heap.astype(np.uint64)[:, None] * np.uint64(n_features) + np.arange(n_features, dtype=np.uint64)
    u = uniform(keys, spec.seed, tree, 4)
    take = spec.drawn(n_features)
    return np.sort(np.argsort(u, axis=1, kind="stable")[:, :take], axis=1)


def counts(code: np.ndarray, y: np.ndarray, times: np.ndarray, slot: np.ndarray, feats: np.ndarray,
           widths: np.ndarray) -> np.ndarray:
    """Drawn rows per (bin of a node's drawn feature, class), nodes and features in turn."""
    w = widths[feats]
    ends = np.cumsum(w.ravel())
    off = (ends - w.ravel()).reshape(w.shape)
    total = np.zeros(2 * int(ends[-1] if len(ends) else 0))
    for s in range(0, len(slot), _ROWS):
        own = slot[s:s + _ROWS]
        at = off[own] + np.take_along_axis(code[s:s + _ROWS], feats[own], axis=1)
        at = 2 * at + y[s:s + _ROWS, None]
        total += np.bincount(at.ravel(), np.repeat(times[s:s + _ROWS], at.shape[1]), len(total))
    return total.reshape(-1, 2)


def best_splits(hist: np.ndarray, feats: np.ndarray, layout: Layout, weight: np.ndarray, min_rows: int):
    """Per node (gain, bin, drawn rows of class 0 and 1 on the left and in all); the first of equal gains,
    and gain 0 without a split. The gain is the weighted fall of the Gini impurity."""
    widths = np.diff(layout.starts)
    w = widths[feats]
    flat = w.ravel()
    begin = np.cumsum(flat) - flat
    sums = np.cumsum(hist, axis=0)
    before = np.where(begin[:, None] > 0, sums[begin - 1], 0.0)
    left = sums - np.repeat(before, flat, axis=0)
    span = w.sum(axis=1)
    first = np.cumsum(span) - span
    whole = left[first + w[:, 0] - 1]
    right = np.repeat(whole, span, axis=0) - left
    gain = np.repeat(_impurity(whole, weight), span) - _impurity(left, weight) - _impurity(right, weight)
    least = max(min_rows, 1)
    fits = (left.sum(axis=1) >= least) & (right.sum(axis=1) >= least)
    gain = np.where(fits, gain, 0.0)
    top = np.maximum.reduceat(gain, first)
    hits = np.flatnonzero(gain == np.repeat(top, span))
    at = hits[np.searchsorted(hits, first)]
    segment = np.searchsorted(begin, at, side="right") - 1
    bins = np.array(layout.starts)[feats.ravel()[segment]] + at - begin[segment]
    real = top > 1e-9 * (whole * weight).sum(axis=1)
    return np.where(real, top, 0.0), np.where(real, bins, -1), left[at], whole


def _impurity(n: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weight of the rows times their Gini impurity."""
    a, b = n[:, 0] * weight[0], n[:, 1] * weight[1]
    return 2.0 * np.divide(a * b, a + b, out=np.zeros(len(a)), where=a + b > 0)


def may_split(heap: np.ndarray, n: np.ndarray, spec: ForestSpec) -> np.ndarray:
    """Whether nodes are above the last level, of both classes and large enough."""
    deep = np.floor(np.log2(np.maximum(heap, 1))).astype(int) >= spec.max_depth
    return ~deep & (n > 0).all(axis=1) & (n.sum(axis=1) >= 2 * max(spec.min_rows, 1))


def share(n: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted share of class 1."""
    w = n * weight
    return np.divide(w[:, 1], w.sum(axis=1), out=np.full(len(w), 0.5), where=w.sum(axis=1) > 0)


def importance(bins: np.ndarray, gain: np.ndarray, layout: Layout) -> np.ndarray:
    split = bins >= 0
    return np.bincount(layout.feature_of()[bins[split]], gain[split], layout.n_features)


def pruned(part: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The nodes (by heap number) without sibling leaves of the same class, which become
    their parent, from the lowest level up."""
    heap, bins, value, gain = (part[k].copy() for k in ("heap", "bin", "value", "gain"))
    kept, upper = np.ones(len(heap), bool), value > 0.5
    level = np.floor(np.log2(heap)).astype(int)
    for d in range(level.max(initial=0), -1, -1):
        split = np.flatnonzero((level == d) & (bins >= 0))
        left = np.searchsorted(heap, 2 * heap[split])
        same = (bins[left] < 0) & (bins[left + 1] < 0) & (upper[left] == upper[left + 1])
        bins[split[same]], gain[split[same]] = -1, 0.0
        kept[left[same]] = kept[left[same] + 1] = False
    return {"heap": heap[kept], "bin": bins[kept], "value": value[kept], "gain": gain[kept]}


def classed(code: np.ndarray, y: np.ndarray, layout: Layout) -> np.ndarray:
    """Twice the local code plus the class: what a row counts as, feature by feature."""
    bins = max(np.diff(layout.starts), default=0)
    kind = np.uint8 if bins <= 128 else np.uint16 if bins <= 1 << 15 else np.uint32
    out = code.astype(kind)
    out *= kind(2)
    out += y.astype(kind)[:, None]
    return out


def _counted(flat: np.ndarray, place: np.ndarray, times: np.ndarray, sizes: np.ndarray, feats: np.ndarray,
             widths: np.ndarray) -> np.ndarray:
    """What :func:`counts` gives for rows in the order of their nodes (``sizes`` rows each); a row is its
    place in ``flat``, the rows' classed codes."""
    w = widths[feats]
    ends = np.cumsum(w.ravel())
    off = (2 * (ends - w.ravel())).reshape(w.shape)
    total = np.zeros(2 * int(ends[-1]))
    after, many = np.cumsum(sizes), feats.shape[1]
    step = max(1024, _CELLS // many)
    for s in range(0, len(place), step):
        e = min(s + step, len(place))
        i, j = np.searchsorted(after, [s, e - 1], side="right")
        own = np.minimum(after[i:j + 1], e) - np.maximum(after[i:j + 1] - sizes[i:j + 1], s)
        at = np.repeat(feats[i:j + 1], own, axis=0)
        at += place[s:e, None]
        value = flat.take(at)
        first, last = off[i, 0], 2 * ends[(j + 1) * many - 1]
        at = np.repeat(off[i:j + 1] - first, own, axis=0)
        at += value
        total[first:last] += np.bincount(at.ravel(), np.repeat(times[s:e], many), last - first)
    return total.reshape(-1, 2)


def grow(code: np.ndarray, y: np.ndarray, times: np.ndarray, root: int, tree: int, spec: ForestSpec,
         layout: Layout, weight: np.ndarray) -> dict[str, np.ndarray]:
    """The subtree at heap number ``root`` over the rows that reach it (local codes, class,
    draws): its nodes' heap numbers ascending, bins (-1: leaf), values and gains, pruned."""
    return grow_rows(classed(code, y, layout), np.arange(len(y)), times, root, tree, spec, layout, weight)


def grow_rows(both: np.ndarray, rows: np.ndarray, times: np.ndarray, root: int, tree: int, spec: ForestSpec,
              layout: Layout, weight: np.ndarray) -> dict[str, np.ndarray]:
    """:func:`grow` over the ``rows`` of classed codes, drawn ``times``. Only their places are kept in the
    order of the nodes; the codes stay where they are, and rows leave with their leaf."""
    widths, starts, feature_of = np.diff(layout.starts), np.array(layout.starts), layout.feature_of()
    flat, place, times = both.reshape(-1), rows.astype(np.intp) * both.shape[1], times.astype(float)
    heap = np.array([root], np.int64)
    n = np.bincount(flat.take(place) & 1, times, 2)[None]
    opened = np.flatnonzero(may_split(heap, n, spec))
    sizes = np.full(len(opened), len(place))
    nodes: list[tuple] = []
    near = False
    while True:
        bins, gain, left = np.full(len(heap), -1, np.int64), np.zeros(len(heap)), np.zeros((len(heap), 2))
        ends = np.cumsum(sizes)
        for s in range(0, len(opened), _NODES):
            part, own = opened[s:s + _NODES], sizes[s:s + _NODES]
            a, b = ends[s] - own[0], ends[s + len(own) - 1]
            feats = feature_draws(heap[part], spec, tree, layout.n_features)
            hist = _counted(flat, place[a:b], times[a:b], own, feats, widths)
            gain[part], bins[part], left[part], _ = best_splits(hist, feats, layout, weight, spec.min_rows)
        nodes.append((heap, bins, share(n, weight), gain))
        split = np.flatnonzero(bins >= 0)
        if not len(split):
            break
        heap, n, left = np.column_stack([2 * heap[split], 2 * heap[split] + 1]).ravel(), n[split], left[split]
        n = np.stack([left, n - left], axis=1).reshape(-1, 2)
        b = bins[opened]
        first = np.full(len(bins), -2, np.int64)  # the left child of each split node
        first[split] = 2 * np.arange(len(split))
        f = np.where(b >= 0, feature_of[b], 0)
        right = flat.take(place + np.repeat(f, sizes)) > np.repeat(2 * (b - starts[f]) + 1, sizes)
        child = np.repeat(first[opened], sizes) + right
        opened = np.flatnonzero(may_split(heap, n, spec))
        slot = np.full(len(heap) + 2, -1, np.int64)  # the last two for rows whose node stays a leaf
        slot[opened] = np.arange(len(opened))
        slot = slot.take(child, mode="wrap")
        live = np.flatnonzero(slot >= 0)
        slot = slot[live]
        order = live[np.argsort(slot.astype(np.uint16) if len(opened) < 1 << 16 else slot, kind="stable")]
        place, times, sizes = place[order], times[order], np.bincount(slot, minlength=len(opened))
        if not near and len(opened) >= _NEAR:  # from here on a node's rows lie side by side
            near, many = True, both.shape[1]
            flat, place = both[place // many].reshape(-1), np.arange(len(place)) * many
    heap, bins, value, gain = (np.concatenate(c) for c in zip(*nodes))
    return pruned({"heap": heap.astype(np.int32), "bin": bins.astype(np.int32), "value": value, "gain": gain})


def packed(part: dict[str, np.ndarray]) -> bytes:
    buf = io.BytesIO()
    np.savez_compressed(buf, **part)
    return buf.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data), allow_pickle=False) as z:
        return {k: z[k] for k in z.files}


def joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """One pruned tree of its parts, by heap number: every level in order, children side by side."""
    whole = {k: np.concatenate([p[k] for p in parts]) for k in ("heap", "bin", "value", "gain")}
    order = np.argsort(whole["heap"], kind="stable")
    return pruned({k: c[order] for k, c in whole.items()})


def routed(code: np.ndarray, heap: np.ndarray, bins: np.ndarray, layout: Layout) -> np.ndarray:
    """Heap number of the node that each row (local codes) reaches in a tree given by its
    split nodes; other nodes end the way."""
    starts, feature_of = np.array(layout.starts), layout.feature_of()
    at = np.ones(len(code), np.int64)
    live = np.arange(len(code)) if len(heap) else np.zeros(0, np.int64)
    while len(live):
        k = np.minimum(np.searchsorted(heap, at[live]), len(heap) - 1)
        inner = heap[k] == at[live]
        live, k = live[inner], k[inner]
        f = feature_of[bins[k]]
        at[live] = 2 * at[live] + (code[live, f] > bins[k] - starts[f])
    return at


class Forest:
    """A fitted forest: trees one after another, each level by level, over binned values.

    The left child of a tree's i-th split node (from 0) is its node 2i + 1, so a node is a bin
    and a value."""

    def __init__(self, bin, value, roots, importance, starts, cuts):
        self.bin, self.value, self.roots, self.importance = bin, value, roots, importance
        self.layout = Layout(tuple(int(s) for s in starts), tuple(float(c) for c in cuts))
        split = bin >= 0
        before = np.cumsum(split) - split
        of_tree = np.repeat(np.arange(len(roots) - 1), np.diff(roots))
        self.left = (roots[:-1][of_tree] + 2 * (before - before[roots[:-1]][of_tree]) + 1).astype(np.int32) \
            if len(bin) else np.zeros(0, np.int32)

    @classmethod
    def of(cls, trees: list[dict[str, np.ndarray]], layout: Layout) -> "Forest":
        roots = np.concatenate([[0], np.cumsum([len(t["bin"]) for t in trees])]).astype(np.int64)

        def column(name, kind):
            return np.concatenate([t[name] for t in trees]).astype(kind) if trees else np.zeros(0, kind)

        gains = [importance(t["bin"], t["gain"], layout) for t in trees]
        shares = [g / g.sum() for g in gains if g.sum() > 0]
        return cls(column("bin", np.int32), column("value", float), roots,
                   np.sum(shares, axis=0) if shares else np.zeros(layout.n_features), layout.starts, layout.cuts)

    @property
    def getNumTrees(self) -> int:  # as MLlib's forest calls it
        return len(self.roots) - 1

    def of_codes(self, code: np.ndarray) -> np.ndarray:
        """Mean share of class 1 over the trees, of rows of local codes."""
        starts, feature_of = np.array(self.layout.starts), self.layout.feature_of()
        out = np.zeros(len(code))
        for root in self.roots[:-1]:
            node, live = np.full(len(code), root), np.arange(len(code))
            while True:
                b = self.bin[node[live]]
                live, b = live[b >= 0], b[b >= 0]
                if not len(live):
                    break
                f = feature_of[b]
                node[live] = self.left[node[live]] + (code[live, f] > b - starts[f])
            out += self.value[node]
        return out / max(self.getNumTrees, 1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self.of_codes(local_codes(self.layout.binned(x), self.layout))

    def importances(self) -> np.ndarray:
        """Mean over the trees of each feature's share of the tree's gain."""
        total = self.importance.sum()
        return self.importance / total if total > 0 else self.importance

    def to_bytes(self) -> bytes:
        return packed({"bin": self.bin, "value": self.value, "roots": self.roots, "importance": self.importance,
                       "starts": np.array(self.layout.starts), "cuts": np.array(self.layout.cuts)})

    @classmethod
    def from_bytes(cls, data: bytes) -> "Forest":
        return cls(**unpacked(data))
