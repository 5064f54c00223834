"""Maximal scoring segments: brute force on short input, linear time on long input."""

import random
import time

import pytest

from concord.llm.toxicity import segments


def brute(scores, drift, length):
    """The definition: take the best interval (shortest, then first), then the same to its left and right."""
    values = [-drift] * length
    for place, score in scores:
        values[place] = score

    def best(lo, hi):
        found = None
        for a in range(lo, hi):
            total = 0.0
            for b in range(a, hi):
                total += values[b]
                if total > 1e-9 and (found is None or total > found[0] + 1e-9 or abs(total - found[0]) <= 1e-9 and b - a < found[2] - found[1]):
                    found = (total, a, b)
        if found is None:
            return []
        total, a, b = found
        return best(lo, a) + [(a, b, total)] + best(b + 1, hi)

    return best(0, length)


def test_segments_are_those_of_the_definition():
    draw = random.Random(4)
    for _ in range(400):
        length = draw.randint(1, 30)
        places = sorted(draw.sample(range(length), draw.randint(0, length)))
        scores = [(p, draw.choice([0.3, 0.7, 1.1, 1.9]) + draw.random() / 100) for p in places]
        got = segments(scores, 0.25)
        want = brute(scores, 0.25, length)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


@pytest.mark.parametrize("step", [2, 6, 50])
def test_a_million_hits_take_seconds(step):
    start = time.time()
    found = segments([(step * i, 0.9) for i in range(1_000_000)])
    assert time.time() - start < 20 and (len(found) == 1) == (step == 2)
