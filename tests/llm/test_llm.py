import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import rows
from parity_check import _bag, connect

from pactloom.llm import (
    common,
    decontamination,
    host_reputation,
    language,
    minhash,
    mixing,
    notices,
    queries,
    site_lines,
    suffix_array,
    suffixes,
    warc,
    winnowing,
)

SF_DIR = "/root/testdata/sf0.001"
PROSE = "the quick brown fox jumps over a lazy dog while seven wizards quietly mix several jugs of excellent liquor in town"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bands string, tid string, host string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, an empty and a very long text, repeated rows, columns with clashing names."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    texts = [(1, PROSE), (1, PROSE), (2, None), (3, ""), (4, "%%% ***"), (5, long), (6, PROSE + " tonight"), (None, PROSE), (7, "one two")]
    data = [(i, t, "en", None if i == 2 else "s", None, None, "x", None) for i, t in texts]
    return spark.createDataFrame([*data, (8, PROSE, None, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_agrees_with_sql(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    cursor = connect(SF_DIR).execute(queries.SQL[name])
    assert _bag(df.columns, df.collect()) == _bag([d[0] for d in cursor.description], cursor.fetchall())


def test_suffix_array_and_prefixes():
    for seed in range(150):
        draw = random.Random(seed)
        k = draw.choice([1, 2, 3, 5])
        texts = [[draw.randint(1, k) for _ in range(draw.randint(1, 14))] for _ in range(draw.randint(1, 6))]
        texts += [list(texts[0])] * draw.randint(0, 2)
        t = np.array([x for s in texts for x in [*s, 0]], np.int16)
        key = [(0, i) if c == 0 else (1, int(c)) for i, c in enumerate(t)]
        want = sorted(range(len(t)), key=lambda i: key[i:])
        got = suffix_array.suffix_array(t)
        assert list(got) == want
        before, common = suffix_array.permuted_common_prefixes(t, got)
        for j, i in zip(want, want[1:], strict=False):
            n = 0
            while t[i + n] == t[j + n] != 0:
                n += 1
            assert (before[i], common[i]) == (j, n)


def common_from_scratch(t, order):
    """Suffixes of a text with one separator at its end, and what neighbours in their order share, by slices."""
    raw = bytes(int(x) for x in t)
    want = sorted(range(len(raw)), key=lambda i: raw[i:])
    assert list(order) == want
    _, common = suffix_array.permuted_common_prefixes(t, order)
    for j, i in zip(want, want[1:], strict=False):
        n = int(common[i])
        assert raw[i : i + n] == raw[j : j + n]
        assert raw[i + n] != raw[j + n] or raw[i + n] == 0


@pytest.mark.parametrize("period", range(1, 10))
def test_suffix_array_of_periodic_texts(period):
    draw = random.Random(period)
    for size in (1, 2, 3, 5, 8, 13, 60, 61, 250, 2000):
        for k in (2, 3, 9):
            unit = [draw.randint(1, k) for _ in range(period)]
            t = np.array([*(unit[i % period] for i in range(size)), 0], np.int16)
            common_from_scratch(t, suffix_array.suffix_array(t))
            mixed = np.array([*t[:-1], *(draw.randint(1, k) for _ in range(size % 50)), *t[:-1], 0], np.int16)
            common_from_scratch(mixed, suffix_array.suffix_array(mixed))
    for seed in range(20):
        # Names repeat over several rounds of the recursion.
        pieces = [[random.Random(seed).randint(1, 2) for _ in range(5)], [1, 2] * period, [2, 1, 1] * period]
        t = np.array([x for _ in range(40) for x in pieces[draw.randint(0, 2)]] + [0], np.int16)
        common_from_scratch(t, suffix_array.suffix_array(t))


def brute_spans(texts, width):
    counts = Counter(t[j : j + width] for t in texts for j in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for j in range(len(t) - width + 1):
            if counts[t[j : j + width]] > 1:
                gone[j : j + width] = b"\1" * width
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group", [4096, 3])
def test_repeated_strings_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(suffixes, "GROUP", group)
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 300)  # texts are taken in blocks
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 8)))
    base = [" ".join(word() for _ in range(draw.randint(1, 200))) for _ in range(30)]
    common = " ".join(word() for _ in range(12))[:55]
    texts = base + [b[20:160] + word() + b[150:] for b in base[:10]] + base[:3] + ["ab" * 200, "x" * 130, ""]
    texts += [word() + " " + common + " " + word() for _ in range(25)] + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffixes.duplicate_spans(df, width=40).orderBy("doc_id").collect()
    want = brute_spans([(t or "").encode() for t in texts], 40)
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got] == want


def test_rows_of_a_hot_gram_are_given_once():
    # (gram, context, tid, at): one gram with repeated, unique and copied rows, between two others.
    rows = [(1, 5, 1, 1), (2, 0, 1, 2), (2, 0, 4, 7), (2, 3, 1, 9), (2, 4, 2, 9), (2, 4, 2, 9), (2, 4, 3, 9), (2, 4, 5, 9), (2, 6, 7, 1), (2, 8, 7, 3), (3, 1, 1, 1), (3, 1, 2, 1)]
    names = ["gram", "context", "tid", "at"]

    def given(piece_rows, batch_rows):
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[i : i + batch_rows]]) for i in range(0, len(rows), batch_rows)]
        return [tuple(r.values()) for b in suffixes._sort_out(piece_rows)(iter(batches)) for r in b.to_pylist()]

    whole = given(100, 100)
    assert len(set(whole)) == len(whole) == 11
    for piece_rows in range(1, 8):
        for batch_rows in range(1, 6):
            assert given(piece_rows, batch_rows) == whole


def test_strings_beside_a_hot_passage_stay(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE_ROWS", 40, raising=False)
    monkeypatch.setattr(suffixes, "GROUP", 3)
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcde") for _ in range(draw.randint(3, 8)))
    common = " ".join(word() for _ in range(30))[:60]
    texts = [" ".join(word() for _ in range(12)) + common + " ".join(word() for _ in range(12)) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = suffixes.duplicate_spans(df, width=40).orderBy("doc_id").collect()
    want = brute_spans([t.encode() for t in texts], 40)
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got] == want


def test_repeated_strings_of_odd_rows(odd, none):
    data = sorted(odd.select("doc_id", "text").collect(), key=lambda r: (str(r[0]), str(r[1])))
    want = brute_spans([(r[1] or "").encode() for r in data], 200)
    got = suffixes.duplicate_spans(odd).collect()
    assert sorted((str(r[0]), *r[1:5]) for r in got) == sorted((str(r[0]), *w) for r, w in zip(data, want, strict=True))
    assert suffixes.duplicate_spans(none).count() == 0


def test_periodic_texts_lose_what_repeats(spark):
    texts = ["ab" * 300, "-" * 500, ("- " * 40 + "\n") * 20, "abc" * 70 + "x" + "abc" * 70, "|---|" * 90, "q" * 199]
    texts += [f"table {i} " + "|---" * 80 + f" end {i}" for i in range(8)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffixes.duplicate_spans(df).orderBy("doc_id").collect()
    assert [tuple(r)[1:5] for r in got] == brute_spans([t.encode() for t in texts], 200)


def brute_classes(pairs, words=5, least=0.8):
    sets = {}
    for i, t in pairs:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        sets[i] = Counter(tuple(w[j : j + words]) for j in range(max(1, len(w) - words + 1))) if w else Counter()
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and (sets[a] & sets[b]).total() >= least * (sets[a] | sets[b]).total():
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {i: top(i) for i in sets}


def test_near_copies_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_copies(docs).collect()}
    assert got == brute_classes([(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("share", [4096, 3])
def test_pairs_far_apart_in_a_bucket(spark, monkeypatch, share, weighted):
    monkeypatch.setattr(minhash, "SHARE_ROWS", share)
    draw = random.Random(9)
    base = [f"w{draw.randrange(10**6)}" for _ in range(120)] + ["again", "and"] * 20
    texts = []
    for _ in range(60):
        words = list(base)
        for _ in range(draw.randint(0, 6)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(4)}"
        texts.append(" ".join(words[: draw.randint(120, len(words))]))
    # One bucket of all texts in three classes, and one of three documents (all near).
    members = [(i, [7 if i < 57 else 8], i % 3) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df = spark.createDataFrame(members, "doc_id long, bands array<long>, root long")
    found = {(r["a"], r["b"]) for r in minhash.far_pairs(df, docs, weighted=weighted).collect()}
    counts = []
    for t in texts:
        w = t.split()
        c = Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        counts.append(c if weighted else Counter(set(c)))
    wanted = {
        (i, j)
        for i in range(57)
        for j in range(i + 1, 57)
        if i % 3 != j % 3 and (counts[i] & counts[j]).total() >= 0.8 * (counts[i] | counts[j]).total()
    }
    assert wanted and wanted <= found
    assert all(i < j < 57 and i % 3 != j % 3 for i, j in found)
    assert len(found) < 57 * 38 / 2


def test_links_far_apart_in_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "NEIGHBOURS", 1)
    draw = random.Random(5)
    base = [f"w{draw.randrange(10**6)}" for _ in range(400)]
    docs = []
    for i in range(120):
        words = list(base)
        for _ in range(draw.choice([2, 9, 12, 16])):
            words[draw.randrange(400)] = f"x{draw.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    got = minhash.near_copies(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == brute_classes(docs)


def test_darts_estimate_weighted_similarity():
    draw = np.random.default_rng(1)
    elements = draw.integers(0, 2**63, 300).astype(np.uint64)
    x, y = draw.uniform(0.1, 6, 300), draw.uniform(0.1, 6, 300)
    y[:200] = x[:200]
    signed = minhash.dart_signatures(np.tile(elements, 2), np.concatenate([x, y]), np.repeat([0, 1], 300), 2, k=4096)
    assert (signed[0] == signed[1]).mean() == pytest.approx(np.minimum(x, y).sum() / np.maximum(x, y).sum(), abs=0.03)


def test_near_copies_of_odd_rows(odd, none):
    got = sorted(minhash.near_copies(odd).select("doc_id", "class_id").collect(), key=repr)
    assert {r["class_id"] for r in got if r["doc_id"] in (1, 8, None)} == {1}
    assert {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] in (2, 3, 4, 7)} == {2: 2, 3: 3, 4: 4, 7: 7}
    assert minhash.near_copies(none).count() == 0
    kept = minhash.keep_one(odd)
    assert sorted(kept.select("doc_id", "text").collect(), key=repr) == sorted(
        {(r[0], r[1]) for r in odd.select("doc_id", "text").collect() if r[0] not in (6, 8)}, key=repr
    )
    assert kept.columns == odd.columns and sorted(r[0] or 0 for r in kept.select("doc_id").collect()).count(1) == 1


def test_one_row_of_a_repeated_id_stays(spark):
    other = " ".join(f"v{i}" for i in range(40))
    third = " ".join(f"u{i}" for i in range(40))
    rows_ = [(1, PROSE, "a"), (2, PROSE + " x", "b"), (5, other, "c"), (5, PROSE, "d"), (5, other, "c"), (7, third, "e"), (7, third + " x", "e"), (7, other, "f")]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, _id string")
    kept = minhash.keep_one(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 5, 7]
    by = {r["doc_id"]: r for r in kept}
    # The copy of document 1 and that of document 5 under other ids go; of two near texts of one id one stays.
    assert by[1]["text"] == PROSE and by[5]["text"] == other and by[7]["text"] in (third, third + " x")


def test_filters_of_keys(spark):
    rows_ = spark.range(20_000).selectExpr("id AS key", "id % 7 AS _mask")
    keys = rows_.where("key % 10 = 0").select("key")
    inside, outside = common.listed(rows_, keys, "key"), common.unlisted(rows_, keys, "key")
    assert inside.columns == rows_.columns and inside.where("key % 10 = 0").count() == 2000 and inside.count() < 4000
    assert inside.count() + outside.count() == 20_000 and outside.where("key % 10 = 0").count() == 0
    assert common.listed(rows_, keys.limit(0), "key").count() == 0 and common.unlisted(rows_, keys.limit(0), "key").count() == 20_000


def test_tables_written_on_the_way_are_removed(spark, tmp_path):
    made = []

    @common.tidy
    def step(df):
        made.append(common.stored(df, "between"))
        return made[0].selectExpr("id + 1 AS id")

    out = step(spark.range(5))
    assert rows(out) == [(1,), (2,), (3,), (4,), (5,)]
    with pytest.raises(Exception, match="(?i)not.exist|not found"):
        made[0].count()


def winnow(text):
    words = re.findall(r"[^\W_]{1,16}", text.lower())
    prime, base = winnowing.PRIME, winnowing.BASE
    h = [xxhash.xxh64_intdigest(w, 42) for w in words]
    h = [(x - 2**64 if x >= 2**63 else x) % prime for x in h]
    grams = []
    for i in range(len(h) - 4):
        value = 0
        for x in h[i : i + 5]:
            value = (value * base + x) % prime
        grams.append(value)
    if 0 < len(h) < 5:
        x = xxhash.xxh64_intdigest(" ".join(words), 42)
        grams = [(x - 2**64 if x >= 2**63 else x) % prime]
    windows = [range(i, i + 8) for i in range(len(grams) - 7)] or ([range(len(grams))] if grams else [])
    chosen = dict.fromkeys(min(w, key=lambda i: (grams[i], -i)) for w in windows)
    return " ".join(f"{grams[i]:x}:{i}" for i in chosen), {grams[i] for i in chosen}


def test_fingerprints_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sparse = docs.withColumn("doc_id", docs.doc_id * 1000)  # several groups of numbers, with gaps
    got = {r["doc_id"]: r for r in winnowing.fingerprints(sparse).collect()}
    texts = {r["doc_id"]: r["text"] for r in sparse.collect()}
    ids = sorted(texts)
    for i, following in zip(ids, [*ids[1:], ids[0]], strict=True):
        text = texts[i]
        edited = text[: len(text) - len(text) // 4] + texts[following][: len(text) // 4]
        (print_, own), (edited_print, other), (_, after) = winnow(text), winnow(edited), winnow(texts[following])
        r = got[i]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (print_, edited_print)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(len(own & other) / len(own | other))
        assert r["near_next"] == pytest.approx(len(own & after) / len(own | after))


def test_fingerprints_of_odd_rows(odd, none):
    got = winnowing.fingerprints(odd).collect()
    assert len(got) == odd.count() and len({r["fingerprint"] for r in got if r["n_chars"] == len(PROSE)}) == 1
    assert winnowing.fingerprints(none).count() == 0


@pytest.mark.parametrize("ids", [[-(2**63), -1, 0, 5, 2**63 - 1], [-(2**63), -3000, None, 2**62], [None], [-5, 1], [2**63 - 1, 2**63 - 2]])
def test_next_documents_of_any_ids(spark, ids):
    texts = {i: f"{PROSE[n:]} number {n}" for n, i in enumerate(ids)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    order = sorted(ids, key=lambda i: -1 if i is None else i)
    got = {r["doc_id"]: r for r in winnowing.fingerprints(df).collect()}
    for i, following in zip(order, [*order[1:], order[0]], strict=True):
        edited = texts[i][: len(texts[i]) - len(texts[i]) // 4] + texts[following][: len(texts[i]) // 4]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_urls(spark):
    urls = [(1, "http://A.Example.org/es/x?q#f"), (2, None), (3, "nothing"), (4, "x://h"), (5, "ftp://a.com/fr/"), (6, "http://b.com?/de/")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = rows(host_reputation.judge_urls(pages, labels).select("page_id", "host", "path", "rule", "verdict"))
    assert got == [
        (1, "a.example.org", "/es/x", "example.org/es/", "block"),
        (2, "", "", None, "allow"),
        (3, "", "", None, "allow"),
        (4, "h", "", None, "allow"),
        (5, "a.com", "/fr/", "com/fr/", "allow"),
        (6, "b.com", "", None, "allow"),
    ]


def test_bad_hosts_are_blocked(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 2 else 'good'}.net/") for i in range(200)], "page_id long, url string")
    labels = pages.selectExpr("page_id AS doc_id", "1 AS quality", "CAST(page_id % 2 AS INT) AS toxic")
    got = host_reputation.judge_urls(pages, labels).select("host", "verdict").distinct()
    assert rows(got) == [("bad.net", "block"), ("good.net", "allow")]


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = language.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count()


def test_language_of_odd_rows(odd, none):
    got = {(r["doc_id"], r["lang_pred"]) for r in language.identify(odd).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (1, "en"), (None, "en")} <= got
    assert language.identify(none).count() == 0 and language.drop_rejected(none).count() == 0
    assert language.drop_rejected(odd).columns == odd.columns


def test_rows_are_dropped_by_all_rows(spark):
    """A language whose rows op5 holds out, and one whose rows have no doc_id, are learned as well."""
    ids = [r[0] for r in spark.range(400).where(language.is_held_out("id")).collect()]
    others = sorted({*range(400)} - {*ids})
    docs = [(i, "en", f"{PROSE} number {i}") for i in others]
    docs += [(i, "ru", f"и это обычный текст о погоде и о доме номер {i}") for i in ids[:40]]
    docs += [(None, "el", f"και αυτό είναι ένα απλό κείμενο για τον καιρό {i}") for i in range(40)]
    docs += [(ids[40], None, "漢字仮名交文章"), (others[0], None, "12 34")]
    kept = language.drop_rejected(spark.createDataFrame(docs, "doc_id long, lang string, text string"))
    assert rows(kept) == sorted(docs[:-2], key=repr)


def test_kneser_ney_sums_to_one():
    draw = np.random.default_rng(3)
    codes = draw.integers(97, 101, 4000).astype(np.uint64)
    grams = (codes[:-3] << np.uint64(48)) | (codes[1:-2] << np.uint64(32)) | (codes[2:-1] << np.uint64(16)) | codes[3:]
    model = language.KneserNey(*np.unique(grams, return_counts=True))
    context = grams[0] & ~np.uint64(0xFFFF)
    every = context | np.arange(4096, dtype=np.uint64)
    assert model.probability(4, every).sum() == pytest.approx(1, abs=0.01)


def test_models_hold_every_gram(spark, monkeypatch):
    monkeypatch.setattr(language, "SHARD_ROWS", 30_000)
    draw = random.Random(2)
    sign = lambda: chr(0x4E00 + int(draw.paretovariate(0.3)) % 8000)
    texts = [(lang, "".join(sign() for _ in range(500))) for lang in ("aa", "bb") for _ in range(80)]
    docs = [(i, lang, text) for i, (lang, text) in enumerate(texts)]
    model = language.train(spark.createDataFrame(docs, "doc_id long, lang string, text string"))
    assert model.languages == ["aa", "bb"] and len(model.grams[4].names) > 1
    counted = {}
    for lang in model.languages:
        counted[lang] = np.unique(language.symbols([t for x, t in texts if x == lang])[0], return_counts=True)
    unknown = language.symbols(["".join(sign() for _ in range(2000)) + " other letters"])[0]
    grams = np.concatenate([*(g for g, _ in counted.values()), unknown])
    got = model.log_probabilities(grams)
    for i, lang in enumerate(model.languages):
        want = language.KneserNey(*counted[lang]).probability(4, grams)
        assert got[:, i] == pytest.approx(np.log(want), abs=1e-4)


def test_language_bounds_are_of_all_rows(spark):
    draw = random.Random(5)
    word = lambda signs: "".join(draw.choice(signs) for _ in range(draw.randint(2, 6)))
    texts = [("aa" if i % 2 else "bb", " ".join(word("abcdef" if i % 2 else "defghi") for _ in range(draw.randint(1, 12)))) for i in range(9000)]
    texts += [("zz", "xyz zyx xxy"), ("zz", "zzy xyx"), ("zz", "yyx zxz xyz yzy"), ("zz", "12 34"), ("yy", "qqq"), ("ww", "5")]
    docs = [(i, lang, text) for i, (lang, text) in enumerate(texts)]
    model = language.train(spark.createDataFrame(docs, "doc_id long, lang string, text string").repartition(8))
    assert model.languages == ["aa", "bb", "yy", "zz"]
    entropy, n, _ = model.entropies([t for _, t in texts])
    truth = np.array([model.languages.index(x) if x != "ww" else -1 for x, _ in texts])
    used = (truth >= 0) & (n > 0)
    loss = model.losses(entropy[used], n[used], truth[used]).mean(axis=0)
    assert model.temperature == language.TEMPERATURES[int(loss.argmin())]
    for i, lang in enumerate(model.languages):
        own, size = entropy[used & (truth == i), i], n[used & (truth == i)]
        mean = np.average(own, weights=size)
        spread = (own - mean) ** 2 * size
        want = (mean, np.average((own - mean) ** 2, weights=size), np.sort(spread)[(len(own) - 1) // 2] / 0.455)
        assert model.bounds[i] == pytest.approx(want if lang != "yy" else (np.log(language.ALPHABET), 0, 0), abs=1e-6)


def test_reparameterised_questions(spark):
    question = "a train leaves the station near Paris with 12 passengers and each of the 12 passengers pays 7 dollars to Anna before lunch today"
    benchmark = spark.createDataFrame([(1, question), (2, question), (3, None), (4, "too short")], "item_id long, text string")
    changed = question.replace("12", "30").replace("7", "9").replace("Anna", "Maria")
    docs = [
        (1, "so " + question + " ok"),
        (2, "well then " + changed),
        (3, changed.replace("30", "31", 1)),
        (4, PROSE),
        (5, None),
        (None, question),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["item_id"] for r in decontamination.contaminated(df, benchmark).collect()}
    assert got == {1: 1, 2: 1, None: 1}
    assert rows(decontamination.drop_contaminated(df, benchmark).select("doc_id")) == [(3,), (4,), (5,)]
    assert decontamination.contaminated(df, benchmark.where("false")).count() == 0


def test_verbatim_passages_with_one_slot_altered(spark):
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(50)]
    fill = lambda numbers: " ".join(numbers.get(i, w) for i, w in enumerate(words))
    often = dict.fromkeys(range(4, 50, 8), "5")
    benchmark = spark.createDataFrame([(1, fill({3: "5", 30: "5"})), (2, fill(often))], "item_id long, text string")
    altered = fill({3: "5", 30: "7"})
    docs = [(1, altered), (2, "well " + altered + " so"), (3, fill({i: str(i) for i in often})), (4, PROSE)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["item_id"], r["n_windows"]) for r in decontamination.contaminated(df, benchmark).collect()}
    assert {i: got[i] for i in (1, 2)} == {1: (1, 35), 2: (1, 35)}
    # Numbers that contradict the item's in each window are no passage of it.
    assert set(got) == {1, 2}


def test_short_items(spark):
    benchmark = spark.createDataFrame([(1, "Who wrote the first long novel?"), (2, "Name it."), (3, "...")], "item_id long, text string")
    docs = [
        (1, "Q: who wrote the first long novel A: nobody"), (2, "who wrote the first novel"), (3, "name it"), (4, "please name it now"),
        (5, "Who wrote the first long novel?"), (6, "..."), (None, "name  IT!"), (None, "who wrote"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = [(r["doc_id"], r["item_id"]) for r in decontamination.judged(df, benchmark).collect()]
    assert sorted(got, key=repr) == sorted([(1, 1), (2, None), (3, 2), (4, None), (5, 1), (6, None), (None, 2), (None, None)], key=repr)


def brute_passages(texts, items, words=8, in_a_row=6, share=0.5, plain=5):
    """For texts of lower-case words and numbers: which item's passage each one holds, by comparing all windows."""
    token = lambda t: re.findall(r"\d+|[^\W\d_]+", t or "")
    mask = lambda w: ["#" if x.isdecimal() else x for x in w]
    out = []
    for t in texts:
        doc, best = token(t), None
        for i, item in items:
            own = token(item)
            total = len(own) - words + 1
            shifts = {}
            for a in range(len(doc) - words + 1):
                for b in range(total):
                    x, y = doc[a : a + words], own[b : b + words]
                    literal = x == y
                    slots = sum(v.isdecimal() for v in y)
                    if literal or (mask(x) == mask(y) and slots and words - slots >= plain):
                        shifts.setdefault(a - b, []).append((b, literal, [(v, u) for u, v in zip(x, y, strict=True) if v.isdecimal()]))
            for hits in shifts.values():
                pairs = {p for _, literal, ps in hits if any(not k[1] for k in hits) for p in ps if not literal or True}
                templated = {p for b, literal, ps in hits for p in ps if ps and (not literal or words - len(ps) >= plain)}
                del pairs
                one = len({p[0] for p in templated}) == len(templated) == len({p[1] for p in templated})
                n = len(hits) if one else sum(literal for _, literal, _ in hits)
                if n >= min(in_a_row, max(1, -(-total // 2))):
                    best = max(best or (0, 0, 0), (n, n / total, -i))
        out.append(None if best is None else (-best[2], best[0]))
    return out


def test_passages_against_brute_force(spark):
    draw = random.Random(12)
    word = lambda: draw.choice(["a", "bo", "cat", "dune", "elm", "fig", "go", "hat", "ink", "jam", "key", "low", "moss", "nut"])
    items = [(i, " ".join(str(draw.randint(1, 9)) if draw.random() < 0.2 else word() for _ in range(draw.randint(9, 25)))) for i in range(12)]
    texts = []
    for _ in range(120):
        own = draw.choice(items)[1].split()
        a = draw.randint(0, max(0, len(own) - 9))
        part = own[a : a + draw.randint(8, 25)]
        if draw.random() < 0.5:
            new = {str(i): str(draw.randint(1, 9)) for i in range(1, 10)}
            part = [new.get(x, x) for x in part]
        if draw.random() < 0.3:
            part[draw.randrange(len(part))] = word()
        texts.append(" ".join([word() for _ in range(draw.randint(0, 9))] + part + [word() for _ in range(draw.randint(0, 9))]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["item_id"], r["n_windows"]) if r["contaminated"] else None for r in decontamination.judged(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute_passages(texts, items)
    assert [got[i] for i in range(len(texts))] == want and 20 < sum(w is not None for w in want) < 118


def test_decontamination_of_odd_rows(spark, odd, none):
    benchmark = spark.createDataFrame([(1, PROSE, 0), (1, PROSE, 1), (None, PROSE, 2), (2, None, 3), (3, "", 4)], "item_id long, text string, id int")
    got = decontamination.judged(odd, benchmark).collect()
    assert len(got) == odd.count()
    assert sorted((str(r["doc_id"]) for r in got if r["contaminated"])) == ["1", "1", "6", "8", "None"]
    kept = decontamination.drop_contaminated(odd, benchmark)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 5, 7]
    assert decontamination.judged(none, benchmark).count() == 0 and decontamination.drop_contaminated(none, benchmark).count() == 0
    assert decontamination.judged(odd, benchmark.limit(0)).where("contaminated").count() == 0


def test_notices(spark):
    texts = [
        "All Rights Reserved. all rights reserved, CC-BY cc by",
        "licenced under teh Apache License 2.0",
        "permission is hereby granted, free of charge to any persons",
        None,
        "",
        "cc by cc by",
        "éall rights reserved",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in notices.scan_notices(df).collect()}
    assert (got[0]["n_words"], got[0]["n_base"], got[0]["first_word"], got[0]["last_word"]) == (10, 4, 0, 8)
    assert [got[i]["labels"] for i in range(7)] == ["cc-by,reserved", "apache", "mit", "", "", "cc-by", "reserved"]
    assert [got[i]["base_labels"] for i in range(7)] == ["cc-by,reserved", "", "", "", "", "cc-by", ""]
    assert got[1]["score"] < 1 and got[1]["spans"] == "apache:0-4" and got[5]["n_base"] == 2


def test_archives_of_odd_rows(spark):
    long = "x" * 3_000_000
    pages = [(1, "http://a\r\nb", long), (2, None, long), (3, "u", None), (None, "u", long), (4, "u", "é" * 499), (5, "u", "é" * 499)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    folder = warc.shared_folder(spark, "warc-test")
    read = warc.read_archives(warc.write_archives(df, folder), folder, texts=True).collect()
    kinds = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in read}
    assert kinds[1] == ("revisit", 2, 3_000_000) and kinds[2] == ("response", None, 3_000_000)
    assert kinds[3] == ("response", None, 0) and kinds[4] == ("response", None, 998)
    assert {r["html"] for r in read if r["page_id"] in (2, 5)} == {long, "é" * 499}
    assert warc.write_archives(df.where("false"), folder).count() == 0


def test_site_lines_of_odd_rows(spark, odd, none):
    data = [(i, f"Menu\nown {i}\n\nMenu", "h") for i in range(20)] + [(30, "Menu\nrest", None), (31, None, "h")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in site_lines.drop_boilerplate(df).collect()}
    assert got[3] == "own 3\n" and got[30] == "Menu\nrest" and got[31] is None
    assert site_lines.drop_boilerplate(odd).count() == odd.count() and site_lines.drop_boilerplate(none).count() == 0


def test_lines_at_the_ratio_and_copies_of_a_page(spark):
    # On 5 of 50 pages: exactly the ratio; on 6: above it. A third of all rows are copies of one page.
    data = [(i, f"own {i}" + "\nfive" * (i < 5) + "\nsix" * (i < 6), "h", 1, 2) for i in range(49)]
    data += [(100 + i, "whole page\nwith two lines\n" + "x" * 30_000, "h", 1, 2) for i in range(25)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, _host int, _lines int")
    got = {r["doc_id"]: r["text"] for r in site_lines.drop_boilerplate(df).collect()}
    assert got[0] == "own 0\nfive" and got[5] == "own 5"
    assert {got[100 + i] for i in range(25)} == {data[-1][1]}
    assert site_lines.drop_boilerplate(df).columns == df.columns


def test_rates_meet_the_targets(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    mixed = mixing.mixture(docs, labels).toPandas()
    weight = mixed.n_tokens * mixed.rate
    p = np.stack(mixed.p)
    shares = (p * weight.to_numpy()[:, None]).sum(0) / mixed.n_tokens.sum()
    assert shares == pytest.approx([mixing.TARGETS[d] for d in mixing.DOMAINS], abs=1e-3)
    assert (mixed.rate >= 0).all()


def solved(p, n, targets, ridge=mixing.RIDGE):
    """The same least squares by plain projected gradient over cells, until nothing moves."""
    total = n.sum()
    weight = np.linalg.inv((p * n[:, None]).T @ p / total + 1e-6 * np.eye(p.shape[1]))
    rate = np.ones(len(n))
    for _ in range(200_000):
        gap = (p * (n * rate)[:, None]).sum(0) / total - targets
        new = np.maximum(0, rate - (p @ (weight @ gap) + ridge * (rate - 1)) / (1 + ridge))
        if np.abs(new - rate).max() < 1e-10:
            break
        rate = new
    return (p * (n * rate)[:, None]).sum(0) / total


@pytest.mark.parametrize("targets", [[0.9, 0.08, 0.02], [0.2, 0.3, 0.5]])
def test_rates_against_a_small_solver(spark, monkeypatch, targets):
    monkeypatch.setattr(mixing, "WRITE_EVERY", 7)
    draw = np.random.default_rng(2)
    p = draw.dirichlet([0.4, 0.3, 0.2], 60).round(3)
    p[:, 0] = 1 - p[:, 1] - p[:, 2]
    n = draw.integers(1, 500, 60)
    df = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)], "n_tokens long, p array<double>")
    rates, reached = mixing.fit_rates(df.coalesce(1), dict(zip(mixing.DOMAINS, targets, strict=True)))
    got = {tuple(r["p"]): r["rate"] for r in rates.collect()}
    own = np.array([got[tuple(x)] for x in p.tolist()])
    assert (own >= 0).all() and reached == pytest.approx((p * (n * own)[:, None]).sum(0) / n.sum())
    assert reached == pytest.approx(solved(p, n, np.array(targets)), abs=1e-3)


def test_targets_out_of_reach_are_reported(spark):
    df = spark.createDataFrame([(10, [1.0, 0.0, 0.0]), (5, [0.5, 0.5, 0.0])], "n_tokens long, p array<double>").coalesce(1)
    with pytest.warns(UserWarning, match="reached"):
        mixing.fit_rates(df, {"clean": 0.5, "low": 0.1, "toxic": 0.4})


def test_words_are_counted_exactly(spark):
    texts = [(d, " ".join(f"w{i}x{d if i % 50 == 0 else 0}" for i in range(j, j + 300))) for d in (0, 1) for j in range(0, 3000, 100)]
    df = spark.createDataFrame(texts, "domain int, text string")
    got = {}
    for r in df.mapInArrow(mixing._count, "domain int, word long, n long").collect():
        got[r["domain"], r["word"]] = got.get((r["domain"], r["word"]), 0) + r["n"]
    assert Counter(got.values()) == Counter(Counter((d, w) for d, t in texts for w in set(t.split())).values())


def test_mixing_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (9, None, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    assert mixing.mixture(odd, labels).count() == odd.count()
    assert mixing.mixture(odd, labels.where("false")).count() == odd.count()
    assert mixing.mixture(none, labels).count() == 0
    # Rows of one id, and rows without one, are judged by their own texts.
    texts = [(1, "good words here"), (1, "bad words there"), (None, "good words here"), (None, "bad words there")] + [(i, t) for i in range(2, 40) for t in [("good" if i % 2 else "bad") + f" words {i}"]]
    docs = spark.createDataFrame([(*t, 7.0, 3) for t in texts], "doc_id long, text string, mix_rate double, p int")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(2, 40)], "doc_id long, quality int, toxic int")
    rates = {(r["text"], r["rate"]) for r in mixing.mixture(docs, labels, {"clean": 1.0, "low": 0.0}).join(docs.select("doc_id", "text"), "doc_id").where("doc_id > 1").collect()}
    kept = mixing.apply_mixture(docs, labels, {"clean": 1.0, "low": 0.0})
    assert kept.columns == ["doc_id", "text", "p", "mix_rate", "mix_copies"]
    assert {r["text"] for r in kept.collect() if r["doc_id"] in (1, None)} == {"good words here"} and len(rates) == 38
    assert mixing.apply_mixture(kept, labels).columns == kept.columns


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    after, seen = docs, []
    for _, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, after, SF_DIR), "stage")
        seen.append((after.columns, after.count()))
    assert all(c == docs.columns for c, _ in seen[:-1]) and seen[-1][0][: len(docs.columns)] == docs.columns
    lined = {r["doc_id"]: r["text"] for r in site_lines.drop_boilerplate(docs).collect()}
    classes = brute_classes(lined.items())
    assert seen[2][1] == len(set(classes.values()))
    assert rows(corpus_pipeline.run(spark, SF_DIR)) == rows(after)
