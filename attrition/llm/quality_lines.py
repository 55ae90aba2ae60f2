"""Quality rules with a linear-chain conditional random field over lines.

The lines of a text that hold a word form a chain; each is content or
boilerplate. A line's features are small integers (word count, shares of
symbols, capitals, digits, repeated words, ...), the field adds a weight per
(feature, value), one for the first label and four for neighbouring labels. Viterbi
decoding marks the lines; a document is kept if at least half of its words
stand in content lines and the base rules don't fail it.

Training: no line is labelled, so lines take the label of their document
(``labels.quality``), and several documents are chained into one sequence, so
that both labels and both changes occur. At most ``max_rows`` rows of each
label are used (the first by a hash of id and text). Each step of the quasi-Newton
search is one Spark job that sums likelihood and gradient by
forward-backward; the driver holds the weights and nothing of the corpus.

Defined cases: a null text is empty; a text without words has no line and fails
the base rules; equal lines and repeated rows are judged alike; without labelled
rows of both labels every line is content and the base rules decide alone;
tied paths mark content; an empty table gives no row. A text is handled whole;
texts are taken in blocks of about a million characters, a longer one alone.
Input columns named like results are replaced.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm import common

WORD = re.compile("[^\x20\x09-\x0d]+")
SYMBOLS, ENDS, LINKS = "#*$%&|<>", ".!?:;\"'»”…", "/@{}=_\\"
#: Base rules: fewest words, words of a repeated window, and its most share (percent).
LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30
#: Characters of texts that are handled together.
BLOCK = 1_000_000

#: Upper edges of each feature's values; the last value has none. Fixed values of this model.
EDGES = {
    "words": [1, 3, 7, 15, 40], "symbols": [0, .01, .03, .1], "capitals": [0, .1, .3, .7],
    "shouts": [0, .1, .5], "digits": [0, .05, .3], "links": [0, .02], "mean_word": [3, 4.5, 6, 8, 12],
    "repeated": [0, .3, .7], "echoes": [0, .1, .4], "unended": [0], "again": [0], "place": [0, 1, 2], "bias": [],
}
SIZES = [len(v) + 1 for v in EDGES.values()]
STARTS = np.concatenate([[0], np.cumsum(SIZES)[:-1]])
N_VALUES = int(sum(SIZES))
#: Weights: one per feature value (boilerplate against content), one for a first label, four for neighbours.
N_WEIGHTS = N_VALUES + 1 + 4

SPACE_, UPPER_, ALPHA_, DIGIT_, SYMBOL_, SHOUT_, LINK_, END_ = (1 << i for i in range(8))


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Classes of the code points up to U+FFFF as bits; those above count as U+FFFF, which has none."""
    out = np.zeros(1 << 16, np.uint8)
    for i in range(0xFFFF):
        c = chr(i)
        out[i] = UPPER_ * c.isupper() | ALPHA_ * c.isalpha() | DIGIT_ * c.isdigit()
    for chars, bit in ((common.SPACE, SPACE_), (SYMBOLS, SYMBOL_), ("!?", SHOUT_), (LINKS, LINK_), (ENDS, END_)):
        for c in chars:
            out[ord(c)] |= bit
    return out


def numbered(keys) -> np.ndarray:
    seen = defaultdict(count().__next__)
    return np.fromiter(map(seen.__getitem__, keys), np.int64)


def repeated_words(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Marks the words in windows of WINDOW words that occur twice or more in their text."""
    n = len(words) - WINDOW + 1
    covered = np.zeros(len(words), bool)
    if n < 2:
        return covered
    key, span = words, 1
    while span < WINDOW:  # numbers of runs of 1, 2, 4, 8 words
        _, key = np.unique(key[:-span] * (len(words) + 1) + key[span:], return_inverse=True)
        span *= 2
    inside = np.flatnonzero(text[:n] == text[WINDOW - 1:])
    _, back, times = np.unique(key[inside] * (int(text[-1]) + 1) + text[inside], return_inverse=True,
                               return_counts=True)
    first = inside[times[back] > 1]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


class Block:
    """Base statistics per text, and words and features of the lines that hold a word."""

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = classes()[np.minimum(points, 0xFFFF)]
        breaks = np.flatnonzero(points == 10)
        begin, end = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(points)]])
        n_lines = np.array([t.count("\n") + 1 for t in texts])
        text = np.repeat(np.arange(len(texts)), n_lines)  # of each line

        def per_line(mask):
            c = np.concatenate([[0], np.cumsum(mask)])
            return c[end] - c[begin]

        solid = kind & SPACE_ == 0
        starts = solid.copy()
        starts[1:] &= ~solid[:-1]
        n_words, n_solid = per_line(starts), per_line(solid)
        symbols = per_line(kind & SYMBOL_ != 0)
        has = n_words > 0

        words = numbered(WORD.findall(joined))
        line_of_word = np.repeat(np.arange(len(begin)), n_words)
        repeated = repeated_words(words, text[line_of_word])
        n_repeated = np.bincount(line_of_word[repeated], minlength=len(begin))

        echo = np.flatnonzero((words[1:] == words[:-1]) & (line_of_word[1:] == line_of_word[:-1])) + 1
        n_echoes = np.bincount(line_of_word[echo], minlength=len(begin))

        key = numbered(joined.split("\n")) * len(texts) + text
        _, first = np.unique(key, return_index=True)
        again = has.copy()
        again[first] = False

        def per_text(v):
            return np.bincount(text, weights=v, minlength=len(texts)).astype(np.int64)

        self.base = {"n_words": per_text(n_words), "word_chars": per_text(n_solid), "n_symbols": per_text(symbols),
                     "n_dup_lines": per_text(again), "n_repeat_words": per_text(n_repeated)}

        last = np.maximum.accumulate(np.where(solid, np.arange(len(points)), -1))[np.maximum(end - 1, 0)] \
            if len(points) else np.zeros(len(end), int)
        keep = np.flatnonzero(has)
        chars, m = n_solid[keep], n_words[keep]
        line = text[keep]
        is_first = np.concatenate([[True], line[1:] != line[:-1]]) if len(keep) else np.zeros(0, bool)
        is_last = np.concatenate([line[1:] != line[:-1], [True]]) if len(keep) else np.zeros(0, bool)
        letters = np.maximum(per_line(kind & ALPHA_ != 0)[keep], 1)
        raw = {
            "words": m, "symbols": symbols[keep] / np.maximum(chars, 1),
            "capitals": per_line(kind & UPPER_ != 0)[keep] / letters,
            "shouts": per_line(kind & SHOUT_ != 0)[keep] / np.maximum(m, 1),
            "digits": per_line(kind & DIGIT_ != 0)[keep] / np.maximum(chars, 1),
            "links": per_line(kind & LINK_ != 0)[keep] / np.maximum(chars, 1),
            "mean_word": chars / np.maximum(m, 1), "repeated": n_repeated[keep] / np.maximum(m, 1),
            "echoes": n_echoes[keep] / np.maximum(m, 1),
            "unended": kind[last[keep]] & END_ == 0, "again": again[keep],
            "place": is_first + 2 * is_last, "bias": np.zeros(len(keep)),
        }
        self.features = np.stack([np.digitize(v, EDGES[k], right=True) for k, v in raw.items()], 1).astype(np.uint8)
        self.line_words = m
        self.n_chain = np.bincount(line, minlength=len(texts)).astype(np.int64)  # lines with a word, per text


def blocks(texts: list[str]) -> Iterator[tuple[int, Block]]:
    """(first position, block) over the texts, about BLOCK characters each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK:
            yield start, Block(texts[start:i])
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, Block(texts[start:])


def padded(lengths: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Chains side by side, the longest first: (time x chain values, order, chains alive at each time)."""
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    longest = int(lengths[order[0]]) if len(order) else 0
    out = np.zeros((longest, len(order)))
    offset = np.concatenate([[0], np.cumsum(lengths)])
    for j, i in enumerate(order):
        out[:lengths[i], j] = values[offset[i]:offset[i + 1]]
    alive = np.searchsorted(-lengths[order], -np.arange(longest), side="left").tolist()
    return out, order, alive


def emissions(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return weights[STARTS + features].sum(axis=1)


def viterbi(lengths: np.ndarray, score: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The best labels (True: boilerplate) of each chain, chains one after the other."""
    s, order, alive = padded(lengths, score)
    first, turn = weights[N_VALUES], weights[N_VALUES + 1:].reshape(2, 2)
    labels = np.zeros(s.shape, bool)
    came = np.zeros((2, *s.shape), bool)
    best = np.zeros((2, s.shape[1]))
    for t, n in enumerate(alive):
        if t == 0:
            best[1] = first + s[0]
            continue
        step = best[:, None, :n] + turn[:, :, None]  # from, to, chain
        came[:, t, :n] = step[1] > step[0]
        best[:, :n] = step.max(axis=0)
        best[1, :n] += s[t, :n]
    at = best[1] > best[0]
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        labels[t, :n] = at[:n]
        if t:
            at[:n] = np.where(at[:n], came[1, t, :n], came[0, t, :n])
    out = np.zeros(len(score), bool)
    offset = np.concatenate([[0], np.cumsum(lengths)])
    for j, i in enumerate(order):
        out[offset[i]:offset[i + 1]] = labels[:lengths[i], j]
    return out


def likelihood(lengths, features, labels, weights) -> tuple[float, np.ndarray]:
    """Negative log-likelihood of the labels and its gradient, by forward-backward."""
    s, order, alive = padded(lengths, emissions(features, weights))
    y, _, _ = padded(lengths, labels)
    first, turn = weights[N_VALUES], weights[N_VALUES + 1:].reshape(2, 2)
    steps, n_chains = s.shape
    front, back = np.zeros((steps, 2, n_chains)), np.zeros((steps, 2, n_chains))
    for t, n in enumerate(alive):
        if t == 0:
            front[0, 1] = first + s[0]
            continue
        front[t, :, :n] = np.logaddexp.reduce(front[t - 1, :, None, :n] + turn[:, :, None], axis=0)
        front[t, 1, :n] += s[t, :n]
    for t in range(steps - 2, -1, -1):
        n = alive[t + 1]
        ahead = back[t + 1, :, :n].copy()
        ahead[1] += s[t + 1, :n]
        back[t, :, :n] = np.logaddexp.reduce(turn[:, :, None] + ahead[None], axis=1)
    total = np.logaddexp(front[0, 0] + back[0, 0], front[0, 1] + back[0, 1])
    grad = np.zeros(N_WEIGHTS)
    yi = y.astype(int)
    loss = total.sum() - (yi[0] * first).sum() - (s * y).sum()
    p1 = np.exp(front[:, 1] + back[:, 1] - total)
    grad[N_VALUES] = (p1[0] - y[0]).sum()
    pairs = np.zeros((2, 2))
    for t in range(1, steps):
        n = alive[t]
        ahead = back[t, :, :n].copy()
        ahead[1] += s[t, :n]
        joint = np.exp(front[t - 1, :, None, :n] + turn[:, :, None] + ahead[None] - total[:n])
        pairs += joint.sum(axis=2)
        np.subtract.at(pairs, (yi[t - 1, :n], yi[t, :n]), 1)
        loss -= turn[yi[t - 1, :n], yi[t, :n]].sum()
    grad[N_VALUES + 1:] = pairs.ravel()
    offset = np.concatenate([[0], np.cumsum(lengths)])
    gap = np.zeros(len(features))
    for j, i in enumerate(order):
        gap[offset[i]:offset[i + 1]] = p1[:lengths[i], j]
    gap -= labels
    for g in range(features.shape[1]):
        grad[STARTS[g]:STARTS[g] + SIZES[g]] += np.bincount(features[:, g], weights=gap, minlength=SIZES[g])
    return float(loss), grad


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        made = []
        for _, block in blocks([t or "" for t in b["text"].to_pylist()]):
            cut = np.cumsum(block.n_chain)[:-1]
            made += [f.tobytes() for f in np.split(block.features, cut)]
        yield pa.RecordBatch.from_arrays([b["chain"], b["k1"], b["k2"], b["label"], pa.array(made, pa.binary())],
                                         ["chain", "k1", "k2", "label", "lines"])


def training_chains(docs: DataFrame, labels: DataFrame, max_rows: int, per_chain: int) -> DataFrame:
    """Rows (label, lines) chained: docs array<struct<k1, k2, label, lines>>."""
    label = labels.groupBy("doc_id").agg((1 - F.min("quality")).cast("int").alias("label")).filter("label in (0, 1)")
    text = common.text_of()
    k1, k2 = common.row_key(F.col("doc_id"), text)
    keyed = docs.select("doc_id", text.alias("text"), k1.alias("k1"), k2.alias("k2"))
    known = keyed.select("doc_id", "k1", "k2").join(label, "doc_id").select("k1", "k2", "label").distinct()
    sample = functools.reduce(DataFrame.union, [  # at most 2 * max_rows keys
        known.filter(F.col("label") == y).orderBy("k1", "k2").limit(max_rows) for y in (0, 1)])
    rows = keyed.join(F.broadcast(sample), ["k1", "k2"]).dropDuplicates(["k1", "k2"]) \
        .select(F.pmod("k2", F.lit(max(1, 2 * max_rows // per_chain))).alias("chain"), "k1", "k2", "label", "text")
    return rows.mapInArrow(_featured, "chain long, k1 long, k2 long, label int, lines binary") \
        .groupBy("chain").agg(F.sort_array(F.collect_list(F.struct("k1", "k2", "label", "lines"))).alias("docs"))


def _gradient(batches, weights):
    total, grad, lines = 0.0, np.zeros(N_WEIGHTS), 0
    for b in batches:
        lengths, features, labels = [], [], []
        for chain in b["docs"].to_pylist():
            own = [np.frombuffer(d["lines"], np.uint8).reshape(-1, len(SIZES)) for d in chain]
            lengths.append(sum(map(len, own)))
            features += own
            labels += [np.full(len(f), float(d["label"])) for f, d in zip(own, chain)]
        lengths = np.array(lengths)
        if lengths.sum():
            loss, g = likelihood(lengths, np.concatenate(features), np.concatenate(labels), weights)
            total, grad, lines = total + loss, grad + g, lines + int(lengths.sum())
    yield pa.RecordBatch.from_pylist([{"loss": total, "lines": lines, "grad": grad.tolist()}])


def minimised(objective, start: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton search with step halving."""
    x = start
    f, g = objective(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, parts = g.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (s @ y)
            q -= a * y
            parts.append(a)
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(pairs, reversed(parts)):
            q += s * (a - (y @ q) / (s @ y))
        step = 1.0 if pairs else 1.0 / max(1e-12, np.abs(g).sum())
        slope = g @ q
        for _ in range(20):
            f2, g2 = objective(x - step * q)
            if f2 <= f - 1e-4 * step * slope:
                break
            step /= 2
        else:
            return x
        s, y = -step * q, g2 - g
        if s @ y > 1e-12:
            pairs = [*pairs[1 - memory:], (s, y)]
        done = f - f2 < 1e-6 * max(1.0, abs(f))
        x, f, g = x - step * q, f2, g2
        if done:
            break
    return x


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 1000, per_chain: int = 4, rounds: int = 40,
          ridge: float = 1e-4) -> np.ndarray:
    """Weights fitted on the rows that ``labels.quality`` covers (0: boilerplate, 1: content)."""
    common.python_ready(docs)
    chains = common.stored(training_chains(docs, labels, max_rows, per_chain).repartition(8), "quality-chains")
    seen = {r["label"] for r in chains.select(F.explode("docs.label").alias("label")).distinct().collect()}
    if len(seen) < 2:
        return np.zeros(N_WEIGHTS)

    def objective(weights):
        parts = chains.mapInArrow(partial(_gradient, weights=weights), "loss double, lines long, grad array<double>") \
            .collect()  # a row per task
        lines = max(1, sum(r["lines"] for r in parts))
        loss = sum(r["loss"] for r in parts) / lines + ridge / 2 * (weights @ weights)
        return loss, np.sum([r["grad"] for r in parts], axis=0) / lines + ridge * weights

    return minimised(objective, np.zeros(N_WEIGHTS), rounds)


VERDICT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "n_lines long, n_content_lines long, content_share double")


def judged(texts: list[str], weights: np.ndarray) -> pd.DataFrame:
    """Base statistics and the share of words in content lines, per text."""
    parts = []
    for _, block in blocks(texts):
        bad = viterbi(block.n_chain, emissions(block.features, weights), weights) if len(block.features) else \
            np.zeros(0, bool)
        text = np.repeat(np.arange(len(block.n_chain)), block.n_chain)
        n = len(block.n_chain)
        good = np.bincount(text, weights=block.line_words * ~bad, minlength=n)
        parts.append(pd.DataFrame({
            **block.base, "n_lines": block.n_chain,
            "n_content_lines": np.bincount(text, weights=~bad, minlength=n).astype(np.int64),
            "content_share": good / np.maximum(block.base["n_words"], 1)}))
    return pd.concat(parts, ignore_index=True)


def judge(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with the base statistics, base_failed, content_share and kept."""
    common.python_ready(docs)

    @F.pandas_udf(VERDICT)
    def verdict(texts: pd.Series) -> pd.DataFrame:
        return judged(texts.tolist(), weights) if len(texts) else pd.DataFrame(
            {c.split()[0]: [] for c in VERDICT.split(", ")})

    names = [c.split()[0] for c in VERDICT.split(", ")]
    out = common.with_replaced(docs, {"__verdict": verdict(common.text_of(f"`{text_col}`"))})
    out = common.with_replaced(out, {n: F.col(f"__verdict.{n}") for n in names}, drop=("__verdict",))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    out = common.with_replaced(out, {"base_failed": failed})
    return common.with_replaced(out, {"kept": ~F.col("base_failed") & (F.col("content_share") >= 0.5)})
