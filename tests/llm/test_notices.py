import random
import re

from conftest import rows

from pactloom.llm import host_reputation, notices, warc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def fewest_edits(notice, line):
    """The fewest edits between the notice and any piece of the line, by the table of edit distances."""
    above = [0] * (len(line) + 1)
    for i, a in enumerate(notice):
        row = [i + 1]
        for j, b in enumerate(line):
            row.append(min(above[j] + (a != b), above[j + 1] + 1, row[j] + 1))
        above = row
    return min(above)


def brute(text):
    w = words(text)
    line = (" " + " ".join(w) + " ").encode() if w else b" "
    base = [(i, label) for phrase, label in notices.PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    near = {label for n, label in notices.NOTICES.items() if fewest_edits(n.encode(), line) <= len(n) // notices.CHARACTERS_PER_EDIT}
    labels = {x[1] for x in base}
    firsts = [x[0] for x in base]
    return (len(w), len(base), min(firsts, default=None), max(firsts, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | near)))


def damaged(draw, text, edits):
    for _ in range(edits):
        at = draw.randrange(len(text))
        kind = draw.randrange(3)
        text = text[:at] + draw.choice("abcxyz é") * (kind < 2) + text[at + (kind > 0) :]
    return text


def test_notices_against_edit_distances(spark):
    draw = random.Random(6)
    filler = ["license", "the", "public", "all", "rights", "by", "cc", "général", "gnu", "of", "Ω", "x1"]
    texts = []
    for _ in range(70):
        parts = [" ".join(draw.choices(filler, k=draw.randint(0, 6)))]
        notice = draw.choice([*notices.NOTICES, *notices.PHRASES])
        parts.append(damaged(draw, notice, draw.choice([0, 1, 2, len(notice) // 10, len(notice) // 10 + 1, len(notice) // 8])))
        parts.append(draw.choice(["", "-", "\n"]).join(draw.choices(filler, k=draw.randint(0, 6))))
        texts.append(draw.choice([" ", ", ", ""]).join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in notices.scan_notices(df).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        want = brute(text)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) == want, text
        assert (r["score"] > 0) == (r["labels"] != "") and (r["score"] == 1 or not r["base_labels"])
    assert len({brute(t)[5] for t in texts}) > 5


def test_notices_of_odd_rows(spark):
    long = "public license " * 40_000 + "all rights reserved"
    data = [(1, long, "a", 1), (2, None, "b", 2), (3, "", None, None), (4, "cc by", "c", 3), (4, "cc by", "c", 3), (None, "CC BY", None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, labels string, score int")
    got = notices.scan_notices(df).select("doc_id", "n_words", "n_base", "base_labels").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, 80_003, 1, "reserved"), (2, 0, 0, ""), (3, 0, 0, ""), (4, 2, 1, "cc-by"), (4, 2, 1, "cc-by"), (None, 2, 1, "cc-by")], key=repr)
    assert notices.scan_notices(df.limit(0)).count() == 0


def test_urls_of_odd_rows(spark):
    data = [(1, "http://a.org/" + "x" * 100_000, "h", "p"), (1, "http://a.org/", "h", "p"), (None, "http://a.org/", None, None), (2, None, None, None), (3, "", None, None)]
    pages = spark.createDataFrame(data, "page_id long, url string, host string, verdict string")
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = host_reputation.judge_urls(pages, labels)
    assert sorted((str(r["page_id"]), r["host"], len(r["path"])) for r in got.collect()) == [("1", "a.org", 1), ("1", "a.org", 100_001), ("2", "", 0), ("3", "", 0), ("None", "a.org", 1)]
    assert host_reputation.judge_urls(pages.limit(0), labels).count() == 0


def test_pages_without_an_id_revisit(spark, tmp_path):
    big = "x" * 2000
    data = [(1, "u", big, "a", 5), (2, "u", big, "b", 6), (None, None, big, None, None), (None, "u", "y" * 3000, None, None), (3, "u", "small", None, None)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, digest string, size int")
    manifest = warc.write_archives(pages, str(tmp_path / "archives"))
    got = warc.read_archives(manifest, str(tmp_path / "archives")).select("page_id", "payload_bytes", "record_type", "refers_to")
    assert rows(got) == sorted([(1, 2000, "revisit", 2), (2, 2000, "response", None), (3, 5, "response", None), (None, 2000, "revisit", 2), (None, 3000, "response", None)], key=repr)
