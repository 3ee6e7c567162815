"""The fit of the field holds numbers, not all tokens as strings."""

import tracemalloc

import numpy as np
import pandas as pd

from stayledger.llm import toxicity


def test_the_fit_takes_few_bytes_a_token():
    rng = np.random.default_rng(2)
    words = np.array([f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)])
    texts = [" ".join(rng.choice(words, 1500)) + "." for _ in range(400)]
    rows = pd.DataFrame({"text": texts, "label": [int(i % 2 == 0) for i in range(400)]})
    rows.loc[rows["label"] == 1, "text"] += " vile vile."
    count = sum(len(toxicity.tokens(t)) for t in rows["text"])
    tracemalloc.start()
    try:
        field = toxicity.fit_field(rows, epochs=1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert field.weights[toxicity.slot("w", "vile")] > 0
    assert peak < 80 * count
