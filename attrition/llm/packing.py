"""Packing token streams into sequences by order-preserving dynamic programming.

Documents are ordered by id and cut into ranges. Within a range the tokens form
one stream, and window cuts are chosen at document ends (free), sentence ends
(a small penalty) or, in stretches without either, at forced points (a larger
penalty). A window costs its padding to the full length, none if its length is
a power of two, plus a fixed cost a window. With f(j) the least cost up to cut
j, the padded transition is min over the last ``size`` tokens of f(i) + i, kept
in a monotone queue; the unpadded lengths add one transition each. The stream
is solved in blocks, and the last window of a block opens the next one, so that
memory is bounded by a block and the longest text.

Null or empty text is its end token alone. Ties in id are ordered by text;
repeated rows are packed once each. An empty table gives no pieces. Columns
other than id and text are not used, so clashing names do no harm.
"""

from __future__ import annotations

import functools
import zlib
from codecs import charmap_decode
from collections import deque
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm import common
from attrition.llm.words import byte_chars, is_special, pretokens, tokenizer

SENTENCE_END = frozenset(".!?…。！？")

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class _Codes(dict):
    """Numbers words as they come; new ones are queued for encoding."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        k = self[word] = len(self)
        return k


class WordIds:
    """Library ids of pre-tokens, kept in flat arrays so that a text's ids are
    gathered without a Python loop over its tokens."""

    KEEP = 700_000

    def __init__(self, path: str):
        self.path, self.tok = path, tokenizer(path)
        chars = byte_chars()
        self.table = "".join(chars[b] for b in range(256))
        self.merge = self.tok.model.tokenize
        self._reset()

    def _reset(self):
        import numpy as np

        self.code, self.flat = _Codes(), np.zeros(1 << 16, np.uint32)
        self.length, self.at = np.zeros(1 << 15, np.int32), np.zeros(1 << 15, np.int64)
        self.ends, self.used = np.zeros(1 << 15, bool), 1
        self.code[None], self.length[0] = 0, 1  # a document's end, one id

    def _add(self):
        """Merge the new pre-tokens; the library's steps before the merges are done already."""
        import numpy as np

        words, self.code.new = self.code.new, []
        made, merge, table = [], self.merge, self.table
        for w in words:
            if w.isalnum() and w.isascii():
                made.append([t.id for t in merge(w)])
            elif is_special(w, self.path):
                made.append(self.tok.encode(w, add_special_tokens=False).ids)
            else:
                made.append([t.id for t in merge(charmap_decode(w.encode("utf-8", "surrogatepass"), "strict", table)[0])])
        k, sizes = len(self.code) - len(words), np.array([len(i) for i in made], np.int64)
        used = self.used + int(sizes.sum())
        while len(self.code) > len(self.length):
            self.length, self.at, self.ends = (
                np.concatenate([a, np.zeros_like(a)]) for a in (self.length, self.at, self.ends))
        while used > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        here = slice(k, len(self.code))
        self.flat[self.used:used] = list(chain.from_iterable(made))
        self.length[here], self.at[here] = sizes, self.used + np.cumsum(sizes) - sizes
        self.ends[here] = [w[-1] in SENTENCE_END and not is_special(w, self.path) for w in words]
        self.used = used

    def encode_all(self, texts: list[str], end_id: int) -> list[tuple]:
        """Per text: the ids (uint32) with the end id, and the positions after sentence ends."""
        import numpy as np

        if len(self.code) > self.KEEP:
            self._reset()
        words = [pretokens(t, self.path) for t in texts]
        for w in words:
            w.append(None)
        last = np.cumsum([len(w) for w in words]) - 1  # each text's end among all pre-tokens
        codes = np.fromiter(map(self.code.__getitem__, chain.from_iterable(words)), np.int64, int(last[-1]) + 1)
        if self.code.new:
            self._add()
        n = self.length[codes]
        upto = np.cumsum(n, dtype=np.int64)
        ids = self.flat[np.repeat(self.at[codes] - (upto - n), n) + np.arange(int(upto[-1]))]
        ids[upto[last] - 1] = end_id
        ends = upto[self.ends[codes]]
        stop = upto[last]
        start = np.concatenate([[0], stop[:-1]])
        cut = np.searchsorted(ends, stop, side="right")
        return [(ids[a:b], ends[i:j] - a) for a, b, i, j in zip(
            start.tolist(), stop.tolist(), [0, *cut[:-1].tolist()], cut.tolist(), strict=True)]

    def encode(self, text: str, end_id: int):
        return self.encode_all([text], end_id)[0]


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """The worker's encoder: what one task has merged the next needn't."""
    return WordIds(path)


def cut_points(n: int, doc_ends, sentence_ends, size: int, sentence_cost: float,
               forced_cost: float):
    """Candidate cuts of a stream of ``n`` tokens (0 and n included) and their
    penalties; stretches longer than an eighth of ``size`` get forced points."""
    import numpy as np

    kind = np.zeros(n + 1, np.int8)
    kind[sentence_ends] = 2
    kind[doc_ends] = 1
    kind[[0, n]] = 1
    at = np.flatnonzero(kind)
    gaps = np.flatnonzero(np.diff(at) > size // 8)
    for g in gaps:
        kind[at[g] + 64:at[g + 1]:64] = 3
    at = np.flatnonzero(kind)
    return at, np.array([0.0, 0.0, sentence_cost, forced_cost])[kind[at]]


def best_cuts(at, penalty, size: int, window_cost: float) -> list[int]:
    """Indices into ``at`` of the chosen cuts, from the first to the last."""
    import numpy as np

    m = len(at)
    lengths = [1 << k for k in range(size.bit_length()) if 1 << k <= size]
    index = np.full(int(at[-1]) + 1, -1, np.int64)
    index[at] = np.arange(m)
    exact: dict[int, list[int]] = {}
    for length in lengths:
        src = at - length
        ok = np.flatnonzero((src >= 0) & (index[np.maximum(src, 0)] >= 0))
        for j, i in zip(ok.tolist(), index[src[ok]].tolist(), strict=True):
            exact.setdefault(j, []).append(i)
    pos, pen = at.tolist(), penalty.tolist()
    cost, back = [0.0] * m, [0] * m
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])  # f(i) + i rising, with i rising
    for j in range(1, m):
        p = pos[j]
        while pos[queue[0][1]] < p - size:
            queue.popleft()
        least, i = queue[0]
        best = least + size - p
        for k in exact.get(j, ()):
            if cost[k] <= best:
                best, i = cost[k], k
        cost[j], back[j] = best + window_cost + pen[j], i
        v = cost[j] + p
        while queue and queue[-1][0] >= v:
            queue.pop()
        queue.append((v, j))
    cuts, j = [], m - 1
    while j:
        cuts.append(j)
        j = back[j]
    return [0, *cuts[::-1]]


class Packer:
    """Packs one ordered stream of (id, ids, sentence ends) into piece rows."""

    def __init__(self, size: int, block: int, costs: tuple[float, float, float], first: int,
                 with_ids: bool):
        self.size, self.block, self.costs, self.with_ids = size, block, costs, with_ids
        self.sequence, self.docs, self.held = first, [], 0

    def add(self, doc_id, ids, ends):
        # (id, all tokens, tokens before, ids, sentence ends)
        self.docs.append((doc_id, len(ids), 0, ids, ends))
        self.held += len(ids)
        if self.held >= self.block:
            yield from self.flush(False)

    def flush(self, final: bool):
        import numpy as np

        if not self.docs:
            return
        sizes = np.array([len(d[3]) for d in self.docs])
        doc_end = np.cumsum(sizes)
        ends = np.concatenate([d[4] + e - s for d, e, s in
                               zip(self.docs, doc_end, sizes, strict=True)]).astype(np.int64)
        sentence, forced, window = self.costs
        at, pen = cut_points(int(doc_end[-1]), doc_end, ends, self.size, sentence, forced)
        cuts = at[best_cuts(at, pen, self.size, window)]
        if not final and len(cuts) > 2:
            cuts = cuts[:-1]
        k = 0
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            offset = 0
            while a < b:
                while doc_end[k] <= a:
                    k += 1
                doc_id, total, before, ids, _ = self.docs[k]
                s = a - int(doc_end[k] - sizes[k])
                piece = ids[s:min(len(ids), s + b - a)]
                row = (doc_id, before + s, len(piece), zlib.crc32(piece.astype("<u4").tobytes()),
                       total, self.sequence, offset)
                yield (*row, piece.astype("int64")) if self.with_ids else row
                offset += len(piece)
                a += len(piece)
            self.sequence += 1
        done, left = int(cuts[-1]), []
        for d, e, n in zip(self.docs, doc_end, sizes, strict=True):
            if e > done:
                s = max(0, done - int(e - n))
                left.append((d[0], d[1], d[2] + s, d[3][s:], d[4][d[4] > s] - s))
        self.docs, self.held = left, int(doc_end[-1]) - done


def _parts(batch, most: int = 1 << 19):
    """Slices of a batch of about ``most`` bytes of text; a longer text is one of its own."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def pack(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
         size: int = 2048, end_id: int = 1, sentence_cost: float = 2.0, forced_cost: float = 8.0,
         window_cost: float = 64.0, block: int = 1 << 18, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and the piece's ``ids`` if asked for."""
    common.python_ready(df)
    costs = (sentence_cost, forced_cost, window_cost)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = word_ids(vocabulary)
        packer = Packer(size, block, costs, TaskContext.get().partitionId() << 40, with_ids)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        names += ["ids"] * with_ids

        def as_batch(rows):
            cols = [pa.array(c, pa.list_(pa.int64()) if n == "ids" else pa.int64())
                    for n, c in zip(names, zip(*rows, strict=True), strict=True)]
            return pa.RecordBatch.from_arrays(cols, names)

        rows = []
        for batch in batches:
            for part in _parts(batch):
                texts = part.column(1).to_pylist()
                for doc_id, made in zip(part.column(0).to_pylist(), encoder.encode_all(texts, end_id), strict=True):
                    rows += packer.add(doc_id, *made)
                    if len(rows) >= 4096:
                        yield as_batch(rows)
                        rows = []
        rows += packer.flush(True)
        if rows:
            yield as_batch(rows)

    # The input position spreads equal rows over several ranges.
    ordered = (df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         common.text_of(f"`{text_col}`").alias("text"))
               .withColumns({"h": F.xxhash64("text"), "at": F.monotonically_increasing_id()})
               .repartitionByRange("doc_id", "h", "at")
               .sortWithinPartitions("doc_id", "h", "at").select("doc_id", "text"))
    return ordered.mapInArrow(run, SCHEMA + (", ids array<long>" if with_ids else ""))
