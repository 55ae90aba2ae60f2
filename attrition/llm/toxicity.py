"""Toxicity by a subsequence-string-kernel support vector machine.

Kernel. Two strings are compared by the subsequences of three characters they
share, over a folded alphabet with marks at both ends of a token. A subsequence counts
``DECAY`` to the number of characters it skips, so gaps and inserted characters only
lower it; its characters stand at most ``SPAN`` places apart. The kernel is
normalised: K(w, w) = 1 whatever the length. Tokens are cut at white space and
stripped of outer punctuation; a run of three or more single characters is read as one
token, too. A token of over ``WINDOW`` characters is read in overlapping windows,
each a string of its own, in training as in scoring.

Training. Of the labelled documents at most ``max_toxic`` and ``max_clean`` are
taken, the first by a hash, so that what is fitted on is bounded. They are cut into
sentences that carry the document's label. Landmark strings give a Nyström map;
a squared-hinge machine is fitted on it, first on all strings, then in rounds of
multiple instance learning: of a toxic document only the worst sentence's worst string
counts, of a clean one that of the document and of each of its sentences.
Counting, mapping, choosing witnesses and every Newton step (sums of a Hessian of
(landmarks + 1)^2 numbers per task) are Spark jobs; the driver holds landmarks
and those sums. Because the kernel is an inner product of subsequence weights, the
machine folds into one table of 64^3 weights, whatever the number of landmarks.

Scoring. A document's score is a logistic function of its worst string over the
whole text; tokens are scored once and remembered. Null, empty and blank texts
score as a text without tokens. Labels, language, source and id are no input.
Repeated rows get equal scores; unlabelled data or labels of one class give a
constant score of the class share (0 without labels). Input columns named like
an output column are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm import common

DECAY = 0.5
SPAN = 7  # places between a subsequence's first and last character
WINDOW, STEP = 20, 10  # characters of a token read at once
AT_ONCE = 128  # texts that a task holds tokens of while it scores
REMEMBERED = 100_000  # tokens whose values a task keeps
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|\n+")
_INNER = re.compile(r"[^\w]+")
_OUTER = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])) + "¿¡«»„“”‘’…–—"
_SINGLES = re.compile(r"(?<!\S)(?:\w[^\w\s]*\s){2,}\w(?!\w)")

_FOLD = np.zeros(0x110000, np.uint8)
_FOLD[:] = 3 + np.arange(0x110000) % 29 + 32  # others share the upper half
for _i, _c in enumerate("abcdefghijklmnopqrstuvwxyz"):
    _FOLD[ord(_c)] = 3 + _i
_FOLD[:32] = 2


def tokens(text: str) -> set[str]:
    """Distinct tokens; those with inner punctuation also without it."""
    low = text.lower()
    out = {w.strip(_OUTER) for w in set(low.split())}
    out |= {_INNER.sub("", w) for w in out if not w.isalnum()}
    for m in _SINGLES.finditer(low):
        out.add(_INNER.sub("", m[0]))
    out.discard("")
    return out


def windows(word: str) -> list[str]:
    """The strings that a token is read as; marks stand at the token's ends only."""
    if len(word) <= WINDOW:
        return [f"\x01{word}\x02"]
    return [f"\x01{word[:WINDOW]}", *(word[i:i + WINDOW] for i in range(STEP, len(word) - STEP, STEP)),
            f"{word[-WINDOW:]}\x02"]


def sentences(text: str) -> list[list[str]]:
    """Distinct strings of each sentence; runs of single characters, which sentence
    ends may cut, make one more."""
    bags = [tokens(s) for s in _SENTENCE.split(text)]
    whole = {_INNER.sub("", m[0]) for m in _SINGLES.finditer(text.lower())}
    return [sorted({p for w in bag for p in windows(w)}) for bag in [*bags, whole] if bag]


_TRIPLES: dict[int, tuple] = {}


def _triples(n: int):
    """Index triples i < j < k of a string of n characters and their weights."""
    if n not in _TRIPLES:
        i, j, k = (a.ravel() for a in np.meshgrid(*[np.arange(n)] * 3, indexing="ij"))
        ok = (i < j) & (j < k) & (k - i <= SPAN)
        _TRIPLES[n] = i[ok], j[ok], k[ok], DECAY ** (k[ok] - i[ok] - 2.0)
    return _TRIPLES[n]


def _subsequences(strings: list[str], size: int = 1024):
    """Per block of strings of one length: (positions, ids of all triples, weights, norms).

    A subsequence may occur several times in a string; its weights add up before
    the norm is taken."""
    by_length: dict[int, list[int]] = {}
    for r, p in enumerate(strings):
        by_length.setdefault(len(p), []).append(r)
    for n, rows in by_length.items():
        i, j, k, w = _triples(n)
        if not len(w):
            continue
        for s in range(0, len(rows), size):
            at = rows[s:s + size]
            chars = np.array([strings[r] for r in at]).view(np.uint32).reshape(len(at), n)
            c = _FOLD[chars].astype(np.int32)
            c[chars == 1], c[chars == 2] = 0, 1
            ids = c[:, i] << 12 | c[:, j] << 6 | c[:, k]
            order = np.argsort(ids, axis=1)
            ranked = np.take_along_axis(ids, order, axis=1)
            new = np.ones(ids.shape, bool)
            new[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
            start = np.flatnonzero(new)
            sums = np.add.reduceat(w[order].ravel(), start)
            norms = np.sqrt(np.bincount(start // len(w), sums * sums, len(at)))
            yield np.array(at), ids, w, norms


def kernel(strings: list[str], landmarks: list[str]) -> np.ndarray:
    """K of all strings with all landmarks."""
    lr, li, lw = features(landmarks)
    used, at = np.unique(li, return_inverse=True)
    table = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    np.add.at(table, (at, lr), lw)
    column = np.full(1 << 18, len(used), np.int32)
    column[used] = np.arange(len(used))
    out = np.zeros((len(strings), len(landmarks)), np.float32)
    for rows, ids, w, norms in _subsequences(strings, 32):
        c = column[ids]
        r, t = np.nonzero(c < len(used))
        if len(r):
            first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
            got = np.add.reduceat(table[c[r, t]] * w[t].astype(np.float32)[:, None], first, axis=0)
            out[rows[r[first]]] = got / norms[r[first], None]
    return out


def features(strings: list[str]):
    """(row, subsequence id, weight) arrays of the strings' normalised features."""
    parts = [(np.repeat(rows, len(w)), ids.ravel(), (w[None] / norms[:, None]).ravel())
             for rows, ids, w, norms in _subsequences(strings)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(p) for p in zip(*parts))


@dataclass
class Model:
    """Weights of folded subsequences; score = 1 / (1 + exp(-(slope * worst + offset)))."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def of_strings(self, strings: list[str]) -> np.ndarray:
        """Decision value of each string."""
        out = np.full(len(strings), self.bias, np.float32)
        for rows, ids, w, norms in _subsequences(strings):
            out[rows] = (self.weights[ids] @ w.astype(np.float32)) / norms + self.bias
        return out

    def of_words(self, words: list[str]) -> np.ndarray:
        """Decision value of each token: its highest string's."""
        parts = [windows(w) for w in words]
        sizes = np.array([len(p) for p in parts])
        v = self.of_strings([x for p in parts for x in p])
        return np.maximum.reduceat(v, np.cumsum(sizes) - sizes) if len(v) else v

    def score(self, worst):
        z = np.clip(self.slope * np.asarray(worst, float) + self.offset, -30, 30)
        return 1.0 / (1.0 + np.exp(-z))


def _platt(v, y):
    """Slope and offset of a logistic function of v, with smoothed targets and both classes weighing alike."""
    pos, neg = y.sum(), (~y).sum()
    t = np.where(y, (pos + 1) / (pos + 2), 1 / (neg + 2))
    w = np.where(y, 0.5 / pos, 0.5 / neg)
    mean, std = v.mean(), v.std() + 1e-9
    x = np.stack([(v - mean) / std, np.ones(len(v))], 1)
    b = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.eye(2) * 1e-6
        step = np.linalg.solve(h, x.T @ (w * (p - t)))
        b -= np.clip(step, -2, 2)
    return float(b[0] / std), float(b[1] - b[0] * mean / std)


def _cut(batches):
    for b in batches:
        rows = [(d, y, x) for d, y, t in zip(b["doc"].to_pylist(), b["label"].to_pylist(), b["text"].to_pylist())
                for x in sentences(t)]
        for s in range(0, len(rows), 20_000):
            d, y, x = zip(*rows[s:s + 20_000])
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(y, pa.int32()),
                                              pa.array(x, pa.list_(pa.string()))], ["doc", "label", "strings"])


def _mapped(batches, landmarks, root):
    """The Nyström coordinates of the strings, next to their weights."""
    for b in batches:
        words = b["string"].to_pylist()
        for s in range(0, len(words), 4096):
            z = kernel(words[s:s + 4096], landmarks) @ root
            part = b.slice(s, 4096)
            yield pa.RecordBatch.from_arrays([part["pos"], part["neg"], pa.array([r.tobytes() for r in z], pa.binary())],
                                             ["pos", "neg", "z"])


def _newton(batches, b, pos, neg):
    """Hessian and gradient sums of the squared hinge over one task's strings."""
    d = len(b)
    h, g = np.zeros((d, d)), np.zeros(d)
    for batch in batches:
        for s in range(0, batch.num_rows, 4096):
            part = batch.slice(s, 4096)
            z = np.stack([np.frombuffer(v, np.float32) for v in part["z"].to_pylist()])
            x = np.hstack([z, np.ones((len(z), 1))]).astype(np.float64)
            v = x @ b
            for y, name, scale in ((1.0, "pos", pos), (-1.0, "neg", neg)):
                w = part[name].to_numpy(zero_copy_only=False) * scale
                act = (w > 0) & (y * v < 1)
                xa = x[act]
                h += (xa * w[act, None]).T @ xa
                g += xa.T @ (w[act] * y)
    yield pa.RecordBatch.from_arrays([pa.array([h.tobytes()]), pa.array([g.tobytes()])], ["h", "g"])


def _squared_hinge(tables, d: int, penalty: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Weights and bias (last) by Newton steps, one job each. ``tables``: (mapped
    strings, factor of their positive weights, of their negative weights)."""
    b = np.zeros(d)
    ridge = np.diag(np.r_[np.full(d - 1, penalty), 1e-8])
    for _ in range(steps):
        parts = None
        for table, pos, neg in tables:
            one = table.mapInArrow(partial(_newton, b=b, pos=pos, neg=neg), "h binary, g binary")
            parts = one if parts is None else parts.union(one)
        h, g = ridge.copy(), np.zeros(d)
        for r in parts.collect():  # a row per task
            h += np.frombuffer(r["h"]).reshape(d, d)
            g += np.frombuffer(r["g"])
        new = np.linalg.solve(h, g)
        done = np.abs(new - b).max() < 1e-5
        b = new
        if done:
            break
    return b


def _worst(batches, model):
    """The worst string of each sentence and its value."""
    for b in batches:
        sizes = np.diff(b["strings"].offsets.to_numpy())
        strings = b["strings"].flatten().to_pylist()
        v = model.of_strings(strings)
        start = np.cumsum(sizes) - sizes
        top = np.maximum.reduceat(v, start)
        at = [int(s + np.argmax(v[s:s + n])) for s, n in zip(start, sizes)]
        yield pa.RecordBatch.from_arrays(
            [b["doc"], b["label"], pa.array(top.astype(np.float64)), pa.array([strings[i] for i in at])],
            ["doc", "label", "value", "string"])


def _model(b: np.ndarray, landmarks: list[str], root: np.ndarray, slope: float = 1.0, offset: float = 0.0) -> Model:
    lr, li, lw = features(landmarks)
    weights = np.zeros(1 << 18)
    np.add.at(weights, li, lw * (root @ b[:-1])[lr])
    return Model(weights.astype(np.float32), float(b[-1]), slope, offset)


def fit(rows: DataFrame, n_landmarks: int = 192, rounds: int = 3, parts: int = 8) -> Model:
    """A model from labelled documents (doc, label, text), a bounded number of them."""
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = n.get(1, 0), n.get(0, 0)
    if not n_pos or not n_neg:
        share = n_pos / (n_pos + n_neg) if n_pos + n_neg else 0.0
        return Model(np.zeros(1 << 18, np.float32), 0.0, 0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    told = common.stored(rows.mapInArrow(_cut, "doc long, label int, strings array<string>").repartition(parts),
                         "toxicity-sentences")
    odds = F.log((F.col("n1") + 0.1) / (n_pos + 0.2)) - F.log((F.col("n0") + 0.1) / (n_neg + 0.2))
    vocabulary = common.stored(
        told.select("doc", "label", F.explode("strings").alias("string")).distinct().groupBy("string")
        .agg(F.sum("label").alias("n1"), F.sum(1 - F.col("label")).alias("n0"))
        .select("string", "n1", "n0", odds.alias("odds")).repartition(parts), "toxicity-strings")
    # landmarks: strings most telling of toxic rows, and the most frequent of clean ones
    picked = [r["string"] for by in ((F.col("odds") * F.sqrt("n1")).desc(), F.col("n0").desc())
              for r in vocabulary.orderBy(by, "string").limit(n_landmarks // 2).collect()]
    landmarks = list(dict.fromkeys(picked))
    val, vec = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    ok = val > 1e-6 * val.max()
    root = vec[:, ok] / np.sqrt(val[ok])
    to_map = partial(_mapped, landmarks=landmarks, root=root.astype(np.float32))
    shape = "pos double, neg double, z binary"
    mapped = common.stored(vocabulary.select(
        "string", (F.col("n1") * F.greatest("odds", F.lit(0.0))).alias("pos"), F.col("n0").cast("double").alias("neg"))
        .mapInArrow(to_map, shape), "toxicity-mapped")
    sums = mapped.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).first()
    seen_pos, seen_neg = sums["pos"] or 0.0, sums["neg"] or 0.0
    d = root.shape[1] + 1
    if not seen_pos or not seen_neg:
        return Model(np.zeros(1 << 18, np.float32), 0.0, 0.0, float(np.log(n_pos / n_neg)))
    # round 0: every string has its document's label; then witnesses only
    b = _squared_hinge([(mapped, 1 / seen_pos, 1 / seen_neg)], d)
    kept = [told, vocabulary, mapped]
    for _ in range(rounds):
        worst = common.stored(told.mapInArrow(partial(_worst, model=_model(b, landmarks, root)),
                                              "doc long, label int, value double, string string"), "toxicity-worst")
        kept.append(worst)
        docs = worst.groupBy("doc", "label").agg(F.max(F.struct("value", "string")).alias("top"),
                                                 F.count("*").alias("n"))
        each = worst.filter("label = 0").join(docs.filter("label = 0").select("doc", "n"), "doc") \
            .select("string", F.lit(0.0).alias("pos"), (0.25 / n_neg / F.col("n")).alias("neg"))
        tops = docs.select("top.string", F.when(F.col("label") == 1, 1.0 / n_pos).otherwise(0.0).alias("pos"),
                           F.when(F.col("label") == 0, 0.25 / n_neg).otherwise(0.0).alias("neg"))
        witnesses = common.stored(
            tops.unionByName(each).groupBy("string").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
            .repartition(parts).mapInArrow(to_map, shape), "toxicity-witnesses")
        kept.append(witnesses)
        b = _squared_hinge([(mapped, 0.0, 2 / 3 / seen_neg), (witnesses, 1.0, 2 / 3)], d)
    model = _model(b, landmarks, root)
    tops = told.mapInArrow(partial(_worst, model=model), "doc long, label int, value double, string string") \
        .groupBy("doc", "label").agg(F.max("value").alias("v")).collect()  # a number per sampled document
    low = float(model.bias)
    values = [max(r["v"], low) for r in tops]
    labels = [r["label"] == 1 for r in tops]
    missing = n_pos + n_neg - len(tops)  # texts without tokens
    if missing:
        y = n_pos - sum(labels)
        values += [low] * missing
        labels += [True] * y + [False] * (missing - y)
    model.slope, model.offset = _platt(np.array(values), np.array(labels))
    for table in kept:
        common.forget(table)
    return model


def sampled_labels(labels: DataFrame, label: Column, id_col: str, max_toxic: int,
                   max_clean: int) -> DataFrame:
    """(id, label) of at most so many rows of each label, the first by a hash of
    the id. An id with several labels has the highest."""
    rows = labels.groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.max(label).cast("int").alias("label"))
    parts = [rows.filter(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(most)
             for y, most in ((1, max_toxic), (0, max_clean))]
    return parts[0].union(parts[1])


def train(df: DataFrame, labels: DataFrame, label: Column, id_col: str = "doc_id", text_col: str = "text",
          max_toxic: int = 1500, max_clean: int = 2000) -> Model:
    """Fit on the whole texts of ``df``'s rows that ``labels`` (by id; 0 or 1) covers."""
    common.python_ready(df)
    sample = F.broadcast(sampled_labels(labels, label, id_col, max_toxic, max_clean))  # bounded above

    rows = (df.select(F.col(f"`{id_col}`").alias("id"), common.text_of(f"`{text_col}`").alias("text"))
            .join(sample, "id").select(F.xxhash64("id", "text").alias("doc"), "label", "text")
            .dropDuplicates(["doc"]))
    rows = common.stored(rows, "toxicity-rows")
    model = fit(rows)
    common.forget(rows)
    return model


def worst_values(texts: pa.Array, model: Model) -> np.ndarray:
    """The decision value of each text's worst string. Only ``AT_ONCE`` texts and their
    tokens are Python's at once; up to ``REMEMBERED`` tokens' values are kept."""
    low, seen, out = model.bias, {}, np.full(len(texts), model.bias)
    for s in range(0, len(texts), AT_ONCE):
        sets = [tokens(t) for t in texts.slice(s, AT_ONCE).to_pylist()]
        new = [w for w in set().union(*sets) if w not in seen]
        if new:
            seen.update(zip(new, model.of_words(new).tolist(), strict=True))
        worst = [max(map(seen.__getitem__, t), default=low) for t in sets]
        out[s:s + AT_ONCE] = np.maximum(worst, low)
        if len(seen) > REMEMBERED:
            seen.clear()
    return out


def score_documents(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with score (0 to 1) and predicted (1 if the score is at least 0.5)."""
    common.python_ready(df)
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        m = sent.value
        return pa.array(m.score(worst_values(texts, m)), pa.float64())

    out = common.with_replaced(df, {"score": score(common.text_of(f"`{text_col}`"))})
    return common.with_replaced(out, {"predicted": (F.col("score") >= 0.5).cast("int")})


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train_on_labels(docs: DataFrame, labels: DataFrame, **bounds) -> Model:
    """Fit on the documents that ``labels.toxic`` covers, without the held-out ones."""
    return train(docs, labels.filter(~held_out()), F.col("toxic"), **bounds)
