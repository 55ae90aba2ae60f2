"""Token counts by byte-pair merging with a heap and a linked list.

Each pre-token starts as its byte symbols (the last one marked as word end).
The adjacent pair of lowest rank, leftmost on ties, is popped and merged until
none is left; the count is symbols minus merges, and no identifiers are made.

Null text counts as empty (0 bytes, 0 tokens); whole texts are counted. A
special string inside a text counts as one token. Repeated rows each get their
count; an empty table gives an empty result. Input columns named like an
output column are replaced.
"""

from __future__ import annotations

import functools
import heapq
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm import common
from attrition.llm.words import byte_chars, is_special, pretokens

#: Pre-tokens a worker remembers; beyond it the memory starts afresh.
CACHE_WORDS = 400_000


class MergeCounter:
    """Counts the tokens of pre-tokens, remembering those already merged."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        chars = byte_chars()
        self.first = [vocab[chars[b]] for b in range(256)]
        self.last = [vocab[chars[b] + self.suffix] for b in range(256)]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a] << 32 | vocab[b]] = rank << 32 | vocab[a + b]
        self.seen: dict[str, int] = {}

    def merged(self, word: str) -> int:
        """Number of symbols left of one pre-token."""
        raw = word.encode("utf-8")
        n = len(raw)
        sym = [self.first[b] for b in raw]
        sym[-1] = self.last[raw[-1]]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges, heap = self.merges, []
        for i in range(n - 1):
            m = merges.get(sym[i] << 32 | sym[i + 1])
            if m is not None:
                heap.append((m, i, sym[i], sym[i + 1]))
        heapq.heapify(heap)
        left = n
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j = after[i]
            # a stale entry: one of its symbols has been merged meanwhile
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            new = m & 0xFFFFFFFF
            sym[i], sym[j] = new, -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                m = merges.get(new << 32 | sym[k])
                if m is not None:
                    heapq.heappush(heap, (m, i, new, sym[k]))
            h = before[i]
            if h >= 0:
                m = merges.get(sym[h] << 32 | new)
                if m is not None:
                    heapq.heappush(heap, (m, h, sym[h], new))
        return left

    def count(self, text: str) -> int:
        words = pretokens(text, self.path)
        seen = self.seen
        try:
            return sum(map(seen.__getitem__, words))
        except KeyError:
            pass
        for w in set(words):
            if w not in seen:
                seen[w] = 1 if is_special(w, self.path) else self.merged(w)
        total = sum(map(seen.__getitem__, words))
        if len(seen) > CACHE_WORDS:
            seen.clear()
        return total


@functools.lru_cache(maxsize=1)
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def count_tokens(df: DataFrame, vocabulary: str, text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """``df`` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit)."""
    common.python_ready(df)

    @F.pandas_udf("long")
    def n_tokens(texts):
        c = counter(vocabulary)
        return texts.map(c.count)

    text = common.text_of(f"`{text_col}`")
    out = common.with_replaced(df, {
        "n_bytes": F.octet_length(text).cast("long"), "n_tokens": n_tokens(text)})
    return common.with_replaced(out, {"over_limit": F.col("n_tokens") > limit})
