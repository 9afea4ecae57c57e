"""License scans: exact seeds find where a short notice may stand, bounded-error matching verifies it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from pactloom.llm.common import prepare, table

# Phrases of the contract and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices that the method looks for with errors, and the labels that it adds.
NOTICES = {
    "licensed under the apache license": "apache",
    "permission is hereby granted free of charge to any person": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "creative commons attribution": "cc-by",
    "dedicated to the public domain": "public-domain",
    "permission to use copy modify and distribute this software": "isc",
    "all rights reserved": "reserved",
}
#: An edit (letter changed, added or left out) is allowed for every so many characters of a notice.
CHARACTERS_PER_EDIT = 10

_SPACES = bytes(b if b >= 0x80 or chr(b).isdigit() or "a" <= chr(b) <= "z" else 32 for b in range(256))


@dataclass(frozen=True)
class Notice:
    text: bytes
    label: str
    edits: int
    seeds: tuple[tuple[int, bytes], ...]
    pattern: object


@cache
def compiled(notices: tuple[tuple[str, str], ...], per_edit: int) -> tuple[Notice, ...]:
    """With ``k`` edits allowed, one of ``k + 1`` pieces stands unchanged wherever the notice does."""
    out = []
    for text, label in notices:
        raw = text.encode()
        k = len(raw) // per_edit
        cuts = [len(raw) * i // (k + 1) for i in range(k + 2)]
        seeds = tuple((a, raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False))
        pattern = regex.compile(b"(?e)(?:" + regex.escape(raw) + b"){e<=%d}" % k)
        out.append(Notice(raw, label, k, seeds, pattern))
    return tuple(out)


def words_of(text: str | None) -> bytes:
    """The words of the contract, a space before and after each."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().translate(_SPACES).split()
    return b" " + b" ".join(words) + b" " if words else b" "


def exact_places(line: bytes) -> list[tuple[int, str]]:
    """Where the contract's phrases stand, as (word, label); places may overlap."""
    found = []
    for phrase, label in PHRASES.items():
        needle = b" " + phrase.encode() + b" "
        at, word, counted = line.find(needle), 0, 0
        while at >= 0:
            word += line.count(b" ", counted, at)
            counted = at
            found.append((word, label))
            at = line.find(needle, at + 1)
    return found


def fuzzy_spans(line: bytes, notices: tuple[Notice, ...]) -> list[tuple[int, int, str, float]]:
    """Matches within the allowed edits: first and last byte in ``line``, label, 1 - edits / length."""
    found = []
    for n in notices:
        places = set()
        for offset, seed in n.seeds:
            at = line.find(seed)
            while at >= 0:
                places.add(max(0, at - offset - n.edits))
                at = line.find(seed, at + 1)
        windows: list[list[int]] = []
        for begin in sorted(places):
            end = begin + len(n.text) + 3 * n.edits
            if windows and begin <= windows[-1][1]:
                windows[-1][1] = end
            else:
                windows.append([begin, end])
        for begin, end in windows:
            for m in n.pattern.finditer(line, begin, min(end, len(line))):
                found.append((m.start(), m.end(), n.label, 1 - sum(m.fuzzy_counts) / len(n.text)))
    return found


def _scan(notices: tuple[tuple[str, str], ...], per_edit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = compiled(notices, per_edit)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                line = words_of(text)
                base, fuzzy = exact_places(line), fuzzy_spans(line, wanted)
                firsts, labels = [w for w, _ in base], {x for _, x in base}
                spans = []
                for a, b, label, _ in sorted(fuzzy):
                    # Words that the bytes of the match touch; a match may begin or end at a space.
                    first = line.count(b" ", 0, a + (line[a : a + 1] == b" ")) - 1
                    last = line.count(b" ", 0, b - (line[b - 1 : b] == b" ")) - 1
                    spans.append(f"{label}:{max(0, first)}-{max(0, last)}")
                rows.append(
                    (
                        line.count(b" ") - 1,
                        len(base),
                        min(firsts, default=None),
                        max(firsts, default=None),
                        ",".join(sorted(labels)),
                        ",".join(sorted(labels | {x[2] for x in fuzzy})),
                        max([x[3] for x in fuzzy] + [1.0] * bool(base), default=0.0),
                        ",".join(spans),
                    )
                )
            columns = zip(*rows, strict=True) if rows else [[]] * 8
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], NAMES)

    return run


FOUND = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans string"
)
NAMES = [x.split()[0] for x in FOUND.split(", ")]


def scan_notices(docs: DataFrame, notices: dict[str, str] | None = None, per_edit: int = CHARACTERS_PER_EDIT) -> DataFrame:
    """Per document the places of the fixed phrases, and the labels and word spans of notices found with errors.

    Words are runs of ASCII letters (A-Z lower-cased), digits and other characters beyond ASCII. ``score`` is the
    best match's 1 - edits / length, 1 for a fixed phrase, 0 for none. Null and empty texts have no words and no
    labels; repeated rows are scanned each; an empty table gives an empty result; other columns are not read.
    """
    prepare(docs.sparkSession)
    wanted = tuple((NOTICES if notices is None else notices).items())
    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text")
    return rows.mapInArrow(_scan(wanted, per_edit), FOUND)


def op8_short_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_notices(table(spark, sf_dir, "documents"))
