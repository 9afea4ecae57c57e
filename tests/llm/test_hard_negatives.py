import math
import random

import numpy as np
import pytest
from conftest import rows

from pactloom.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, bound int"


def brute(data):
    taken = {}
    for i, e, label, *_ in data:
        if i is None or e is None or label is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        row = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in e])
        taken[i] = min(taken.get(i, row), row)
    out = []
    for a, (label, v) in taken.items():
        if a % 100:
            continue
        score = {i: sum(x * y for x, y in zip(v, w, strict=False)) for i, (_, w) in taken.items()}
        order = sorted((i for i in taken if i != a), key=lambda i: (-score[i], i))
        for p in [i for i in order if taken[i][0] == label][:5]:
            fits = [i for i in order if taken[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out += [(a, p, r + 1, n, score[p], score[n]) for r, n in enumerate(fits[:10])]
    return sorted(out, key=repr)


def mined(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return rows(hard_negatives.mine(hard_negatives.clean_rows(df), "pmod(vec_id, 100) = 0"))


def around(draw, centre, spread):
    return [float(c + draw.gauss(0, spread)) for c in centre]


@pytest.mark.parametrize("spread", [0.02, 0.3])
def test_negatives_against_brute_force(spark, monkeypatch, spread):
    # Pieces of 8 rows, blocks of 4 anchors, rounds of 16 rows and more: narrow clusters end early, wide ones don't.
    monkeypatch.setattr(hard_negatives, "PIECE_BYTES", 8 * 4 * 6)
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 4 * 4 * 6)
    monkeypatch.setattr(hard_negatives, "FIRST_ROWS", 16)
    draw = random.Random(4)
    middles = [[draw.gauss(0, 0.5) for _ in range(6)] for _ in range(4)]
    data = [(i * 10, around(draw, middles[draw.randint(0, 3)], spread), draw.randint(0, 3), None, None) for i in range(150)]
    data += [(3 + 10 * i, data[5][1], 2, None, None) for i in range(40)]  # one vector many times: ties
    got = mined(spark, data)
    assert got == brute(data) and len(got) > 50


def test_negatives_of_odd_rows(spark):
    data = [(100, [1.0, 0.5], 1, "x", 1), (101, [1.0, 0.5], 1, None, None), (101, [1.0, 0.5], 1, None, None), (102, None, 1, None, None)]
    data += [(103, [1.0, None], 2, None, None), (104, [float("nan"), 1.0], 2, None, None), (105, [float("inf"), 1.0], 2, None, None), (106, [], 2, None, None)]
    data += [(108, [0.5], 3, None, None), (109, [0.4, 0.5], None, None, None), (None, [0.4, 0.5], 2, None, None), (110, [0.4, 0.4], 4, None, None)]
    data += [(200, [0.0, 0.0], 5, None, None), (201, [0.3, 0.1], 5, None, None), (300, [-1.0, -1.0], 1, None, None), (107, [0.2, 0.2], 0, None, None)]
    got = mined(spark, data)
    assert got == brute(data) and {r[0] for r in got} == {100, 200}
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1, None, None)]) == []
    with pytest.raises(OverflowError):
        mined(spark, [(100, [3e10], 1, None, None), (101, [1.0], 1, None, None)])


def test_scores_beyond_doubles_are_exact():
    a = np.array([[2**30 + 1, 2**30 - 1, 3]])
    assert hard_negatives.inner(a, a)[0, 0] == (2**30 + 1) ** 2 + (2**30 - 1) ** 2 + 9
