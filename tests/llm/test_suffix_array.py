import random

import numpy as np
import pytest
from entityloom.llm.suffix_array import Segments, kasai, larsson_sadakane


def brute(segments):
    """Suffixes with end marks that sort below all bytes, by place."""
    text, at = [], 0
    for k, s in enumerate(segments):
        text += [*((0, c + 1) for c in s), (-1, k)]
    text = [(1, c) if x == 0 else (0, c) for x, c in text]
    order = sorted(range(len(text)), key=lambda i: text[i:])
    lcp = [0]
    for a, b in zip(order, order[1:], strict=False):
        n = 0
        while a + n < len(text) and b + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        lcp.append(n)
    return order, lcp


@pytest.mark.parametrize("seed", range(12))
def test_equal_to_sorted_suffixes(seed):
    rng = random.Random(seed)
    letters = [b"ab", b"a", b"abcdefgh", b"\x00\x01", bytes(range(256))][seed % 5]
    segments = [bytes(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 9, 40, 90]))) for _ in range(12)]
    segments += [segments[3] * 2, segments[4] + b"a", segments[4]]
    s = Segments(segments)
    order = larsson_sadakane(s)
    want, lcp = brute(segments)
    assert order.tolist() == want
    assert kasai(s, order).tolist() == lcp


def test_no_segments():
    s = Segments([b""])
    assert larsson_sadakane(s).tolist() == [0] and kasai(s, np.array([0])).tolist() == [0]
