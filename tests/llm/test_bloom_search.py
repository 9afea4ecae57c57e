import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pactloom.llm import bloom_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return Counter(TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")))


def brute(docs, items, top=50):
    counted = [(i, terms(t)) for i, t in docs]
    held = [c for _, c in counted if c]
    n, length = len(held), sum(c.total() for c in held)
    df = Counter(t for c in held for t in c)
    out = []
    for item_id, text in sorted(set(items), key=repr):
        found = []
        for doc_id, c in counted:
            if not c:
                continue
            m = 50 + (50 * c.total() * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms(text) if c[t])
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:top])]
    return sorted(out, key=repr)


def searched(spark, docs, items, **options):
    d = spark.createDataFrame([(*x, "k", 1) for x in docs], "doc_id long, text string, key string, item_id int")
    i = spark.createDataFrame([(*x, 0) for x in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in bloom_search.search(d, i, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(3)
    words = [f"w{int(draw.paretovariate(0.7))}" for _ in range(20_000)]
    docs = [(i, " ".join(draw.choices(words, k=draw.choice([1, 3, 30, 200, 2000])))) for i in range(150)]
    docs += [(1000 + i, docs[7][1]) for i in range(80)]  # a group of copies: ties
    items = [(i, " ".join(draw.choices(words, k=draw.randint(1, 30)))) for i in range(20)]
    return docs, items


@pytest.mark.parametrize(("items", "bits", "broadcast"), [(5_000, 1 << 21, 1 << 25), (7, 1 << 21, 0), (5_000, 128, 0)])
def test_ranks_against_brute_force(spark, monkeypatch, corpus, items, bits, broadcast):
    """In one round and in several; also where signatures are so short that they exclude next to nothing."""
    monkeypatch.setattr(bloom_search, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(bloom_search, "ROUND_ITEMS", items)
    monkeypatch.setattr(bloom_search, "MOST_BITS", bits)
    docs, asked = corpus
    assert searched(spark, docs, asked) == brute(docs, asked)


def test_ranks_of_odd_rows(spark):
    long = " ".join(f"T{i % 5000} again" for i in range(60_000))
    docs = [(1, "Alpha beta ÄÖ"), (1, "Alpha beta ÄÖ"), (2, None), (3, ""), (4, "... !!"), (5, long), (None, "beta beta"), (None, "beta gamma"), (6, "äö ALPHA")]
    items = [(1, "alpha BETA"), (1, "alpha BETA"), (2, None), (3, "?"), (4, "nowhere"), (None, "beta"), (5, "ÄÖ äö"), (6, "again t17"), (7, "gamma"), (7, "alpha")]
    assert searched(spark, docs, items) == brute(docs, items)
    assert searched(spark, docs, items, top_k=1) == brute(docs, items, 1)
    assert searched(spark, [], items) == [] and searched(spark, docs, []) == []


def test_bounds_hold_and_exclude(corpus):
    docs, items = corpus
    counted = [terms(t) for _, t in docs]
    n, length = len(docs), sum(c.total() for c in counted)
    df = Counter(t for c in counted for t in c)
    known = [t.encode() for t in df]
    hashes = np.array([bloom_search.xxhash.xxh64_intdigest(t) for t in known], np.uint64)
    begins, term, weight = [0], [], []
    for _, text in items:
        for t in terms(text):
            if t in df:
                term.append(known.index(t.encode()))
                weight.append(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))))
        begins.append(len(term))
    questions = bloom_search.Questions(known, hashes, np.array(begins), np.array(term), np.array(weight), n, length)

    class Held:
        value = np.packbits(np.zeros(1 << bloom_search.FILTER_BITS, bool)).tobytes()

    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs]), pa.array([t for _, t in docs])], ["key", "text"])
    text_of = dict(docs)
    seen = tight = 0
    for made in bloom_search._sign(Held)(iter([batch])):
        blocks = made.filter(pa.array([b is not None for b in made.column("bits").to_pylist()]))
        for keys, size, top, bits in bloom_search._blocks(iter([blocks])):
            bound = questions.bounds(bits, size, top)
            for j, key in enumerate(keys):
                c = Counter({t.encode(): k for t, k in terms(text_of[int(key)]).items()})
                m = int(questions.longness([c.total()])[0])
                exact = [questions.score(i, c, m) for i in range(len(items))]
                assert all(b >= x for b, x in zip(bound[:, j], exact, strict=True))
                seen += len(items)
                tight += sum(b <= 1.3 * x for b, x in zip(bound[:, j], exact, strict=True))
    assert seen == len(docs) * len(items) and tight > 0.8 * seen
