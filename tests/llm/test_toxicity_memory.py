"""What a scoring or mapping task of the toxicity classifier holds at once."""

import tracemalloc

import numpy as np
import pyarrow as pa

from attrition.llm import toxicity


def peak(f):
    tracemalloc.start()
    try:
        out = f()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_kernel_of_long_strings_is_made_in_small_blocks():
    r = np.random.default_rng(1)
    strings = ["".join(map(chr, r.integers(97, 123, 22))) for _ in range(256)]
    toxicity._triples(22)
    k, most = peak(lambda: toxicity.kernel(strings, strings[:192]))
    assert np.allclose(np.diag(k[:192]), 1, atol=1e-4)
    assert most < 60e6


def test_scoring_a_batch_holds_few_tokens_at_once():
    r = np.random.default_rng(2)
    weights = r.normal(size=1 << 18).astype(np.float32)
    model = toxicity.Model(weights, -50.0, 1.0, 0.0)
    texts = [" ".join(f"w{k}x{j}" for j in range(20)) for k in range(1500)] + ["", "w3x4"]
    got, most = peak(lambda: toxicity.worst_values(pa.array(texts), model))
    want = [max(model.of_words([w for w in t.split()]), default=-50.0) for t in texts[-40:]]
    assert np.allclose(got[-40:], want, atol=1e-3)
    assert len(toxicity.worst_values(pa.array([], pa.string()), model)) == 0
