"""Mixing to target weights: soft domain membership of each document, and rates that make the domains' tokens match."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.llm.common import GOLDEN, free_prefix, listed, mix, prepare, stored, table, text_chunks, tidy, word_characters

DOMAINS = ("clean", "low", "toxic")
#: Wanted share of each domain in the tokens that come out; as many tokens come out as go in.
TARGETS = {"clean": 0.9, "low": 0.08, "toxic": 0.02}
#: Words that the classifier may use, for each domain: those whose share there differs most, in standard errors.
WORDS_PER_DOMAIN = 300
#: Counts of words that a task holds before it passes them on.
HELD_WORDS = 200_000
#: Distinct labelled texts that its weights are fitted on, about; counts that choose the words come from all.
SAMPLE_ROWS = 6000
PENALTY = 1e-3
#: Weight of staying near rate 1 against matching the targets.
RIDGE = 1e-4
#: The descent ends when all shares are so near their targets, or move less than that in a round.
NEAR, STILL = 1e-4, 1e-6
#: Rounds after which the rates so far are written down, and after which the descent ends with a warning in any case.
WRITE_EVERY, MOST_ROUNDS = 20, 300
#: Posteriors are rounded to this many steps; documents with equal ones get equal rates.
STEPS = 1000


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words that occur in each text (64 bits, number of the text), and the words of each text.

    Words are runs of letters or digits in lower case, and runs of other signs; the latter aren't counted.
    """
    low = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(t) + 1 for t in low), np.int64, len(low))
    begins = np.cumsum(sizes) - sizes
    kind = np.where(word_characters()[points], 1, np.where((points <= 32) | (points == 0xA0), 0, 2))
    first = kind > 0
    first[1:] &= kind[1:] != kind[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    at = np.flatnonzero(kind > 0)
    offset = at - starts[np.cumsum(first)[at] - 1]
    powers = np.full(int(offset.max()) + 1, 0x100000001B3, np.uint64)
    powers[0] = 1
    values = mix(points[at].astype(np.uint64) + GOLDEN) * np.cumprod(powers)[offset]
    hashes = mix(np.add.reduceat(values, np.searchsorted(at, starts)))
    owner = np.searchsorted(begins, starts, "right") - 1
    n_words = np.bincount(owner[kind[starts] == 1], minlength=len(texts))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))
    return hashes[new], owner[new], n_words


def _summed(domain: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((word, domain))
    domain, word = domain[order], word[order]
    first = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (domain[1:] != domain[:-1])))
    return domain[first], word[first], np.add.reduceat(n[order], first)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each domain a word occurs, summed as far as a task holds."""
    none = np.empty(0, np.int64)
    held = (none, none.astype(np.uint64), none)

    def given():
        return pa.RecordBatch.from_arrays([pa.array(held[0].astype(np.int32)), pa.array(held[1].view(np.int64)), pa.array(held[2])], ["domain", "word", "n"])

    for batch in batches:
        for at, end in text_chunks(batch.column("text")):
            part = batch.slice(at, end - at)
            domain = part.column("domain").to_numpy().astype(np.int64)
            word, owner, _ = presence([t or "" for t in part.column("text").to_pylist()])
            if len(word):
                held = _summed(*(np.concatenate(x) for x in zip(held, (domain[owner], word, np.ones(len(word), np.int64)), strict=True)))
            if len(held[0]) > HELD_WORDS:
                yield given()
                held = (none, none.astype(np.uint64), none)
    yield given()


def telling_words(counts: DataFrame, docs: list[int], per_domain: int = WORDS_PER_DOMAIN) -> np.ndarray:
    """Words whose share of documents differs most between a domain and the others, from ``counts (domain, word, n)``.

    ``docs`` has the number of documents of each domain. Only the chosen words come to the driver, as hashes.
    """
    n_of = [F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("n"))), F.lit(0)).alias(f"n{d}") for d in range(len(docs))]
    total = sum((F.col(f"n{d}") for d in range(1, len(docs))), F.col("n0"))
    words = stored(counts.groupBy("word").agg(*n_of).where(total > 1), "word-counts")
    every, chosen = sum(docs), set()
    for d, inside in enumerate(docs):
        outside = every - inside
        if inside and outside:
            mean = (total + 0.5) / F.lit(every + 1.0)
            gap = F.abs(F.col(f"n{d}") / F.lit(inside) - (total - F.col(f"n{d}")) / F.lit(outside))
            z = gap / F.sqrt(F.abs(mean * (1 - mean)) * F.lit(1 / inside + 1 / outside))
            chosen |= {r[0] for r in words.orderBy(z.desc(), "word").select("word").limit(per_domain).collect()}
    return np.sort(np.array(sorted(chosen), np.int64).view(np.uint64))


@dataclass
class Classifier:
    """Multinomial logistic regression on the presence of telling words; without examples all domains are alike."""

    words: np.ndarray
    weights: np.ndarray  # a row per domain; the last column is the constant

    def features(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        word, owner, n_words = presence(texts)
        out = np.zeros((len(texts), len(self.words) + 1), np.float32)
        out[:, -1] = 1
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
            known = self.words[at] == word
            out[owner[known], at[known]] = 1
        return out, n_words

    def fit(self, features: np.ndarray, domain: np.ndarray, rounds: int = 400) -> None:
        """Accelerated gradient descent on the penalised likelihood."""
        n, k = len(features), self.weights.shape[0]
        if not n:
            return
        truth = np.eye(k, dtype=np.float32)[domain]
        # Half the largest eigenvalue of the second moments bounds the curvature; a few power steps find it.
        v = np.ones(features.shape[1], np.float32)
        for _ in range(20):
            v = features.T @ (features @ v)
            v /= np.linalg.norm(v)
        step = np.float32(1) / np.float32(0.5 * np.linalg.norm(features @ v) ** 2 / n + PENALTY)
        w = ahead = self.weights.astype(np.float32)
        for t in range(rounds):
            gradient = (_softmax(features @ ahead.T) - truth).T @ features / n
            gradient[:, :-1] += np.float32(PENALTY) * ahead[:, :-1]
            new = ahead - step * gradient
            ahead = new + np.float32(t / (t + 3)) * (new - w)
            w = new
        absent = truth.sum(0) == 0
        w[absent, :-1], w[absent, -1] = 0, -700
        self.weights = w

    def posteriors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row of probabilities per text, and its words."""
        features, n_words = self.features(texts)
        return _softmax(features @ self.weights.T), n_words


def _softmax(x: np.ndarray) -> np.ndarray:
    p = np.exp(x - x.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def labelled_domain() -> Column:
    """The domain of a labelled document, from its ``quality`` and ``toxic``; null where neither is given."""
    return F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.coalesce("quality", "toxic").isNotNull(), 0)


def _features(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end in text_chunks(batch.column("text")):
                part = batch.slice(at, end - at)
                features, _ = model.value.features([t or "" for t in part.column("text").to_pylist()])
                packed = [np.packbits(f[:-1] > 0).tobytes() for f in features]
                yield pa.RecordBatch.from_arrays([part.column("domain"), pa.array(packed, pa.binary())], ["domain", "features"])

    return run


@tidy
def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``domain, text`` of the labelled documents."""
    named = labels.select("doc_id", labelled_domain().cast("int").alias("domain")).where("domain IS NOT NULL")
    # The same plan at every size: what has no label stays behind before the shuffle, and no side is broadcast whole.
    texts = listed(docs.select("doc_id", "text"), named, "doc_id")
    return texts.join(named.hint("merge"), "doc_id").select("domain", "text")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, words_per_domain: int = WORDS_PER_DOMAIN) -> Classifier:
    """Chooses words by counts over all labelled documents, and fits weights on a sample of their distinct texts.

    Words are counted exactly, by 64-bit hashes, in tasks and summed; the chosen ones reach the driver, and of the sample
    (about ``sample_rows`` texts) one row of bits for each distinct set of words.
    """
    prepare(docs.sparkSession)
    rows = _labelled(docs, labels)
    counts = rows.mapInArrow(_count, "domain int, word long, n long")
    sizes = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    words = telling_words(counts, [sizes.get(d, 0) for d in range(len(DOMAINS))], words_per_domain)
    model = Classifier(words, np.zeros((len(DOMAINS), len(words) + 1)))
    step = max(1, sum(sizes.values()) // sample_rows)
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(step)) == 0)
    held = docs.sparkSession.sparkContext.broadcast(model)
    sample = sample.mapInArrow(_features(held), "domain int, features binary").distinct().toPandas()
    features = np.ones((len(sample), len(words) + 1), np.float32)
    for i, packed in enumerate(sample["features"]):
        features[i, :-1] = np.unpackbits(np.frombuffer(packed, np.uint8))[: len(words)]
    model.fit(features, sample["domain"].to_numpy(np.int64))
    return model


def _score(model, steps: int, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end in text_chunks(batch.column(text)):
                part = batch.slice(at, end - at)
                p, n = model.value.posteriors([t or "" for t in part.column(text).to_pylist()])
                p = np.round(p * steps) / steps
                more = [pa.array(n, pa.int64()), pa.array(list(p), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, "n_tokens", "p"])

    return run


def memberships(docs: DataFrame, model: Classifier, steps: int = STEPS, prefix: str = "") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``p``, the words and domain posteriors of each row; ``prefix`` stands before both.

    The results travel with their row, so rows need no id.
    """
    prepare(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.withColumn("text", F.col("text").cast("string")).toDF(*names)
    fields = ", ".join([*(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, rows.schema.fields, strict=True)), "n_tokens long", "p array<double>"])
    scored = rows.mapInArrow(_score(held, steps, names[docs.columns.index("text")]), fields)
    return scored.toDF(*docs.columns, f"{prefix}n_tokens", f"{prefix}p")


def _moved(rounds: list[list[float]], step: float) -> Column:
    """``rate, ahead`` of a document with posteriors ``p`` after the rounds whose residuals and momentum are given.

    Accelerated projected gradient: each round moves from a point ahead of the rate down the gradient there, which for
    one document is its posteriors times the (weighted) residuals, and cuts at zero.
    """
    start = F.struct(F.col("rate").alias("rate"), F.col("ahead").alias("ahead"))
    if not rounds:
        return start

    def move(x, e):
        slope = sum((F.element_at("p", i + 1) * e[i] for i in range(1, len(DOMAINS))), F.element_at("p", 1) * e[0])
        new = F.greatest(F.lit(0.0), x["ahead"] - F.lit(step) * (slope + F.lit(RIDGE) * (x["ahead"] - 1)))
        return F.struct(new.alias("rate"), (new + e[len(DOMAINS)] * (new - x["rate"])).alias("ahead"))

    return F.aggregate(F.array(*(F.array(*map(F.lit, e)) for e in rounds)), start, move)


def fit_rates(members: DataFrame, targets: dict[str, float] | None = None, rounds: int = MOST_ROUNDS) -> tuple[DataFrame, list[float]]:
    """``p, rate`` for each of the (rounded) posteriors of ``members (n_tokens, p)``, and the shares these rates lead to.

    Least squares over the differences of expected and wanted shares, weighted by the inverse of the domains' second
    moments (so the descent needs few rounds however rare a domain is), documents weighted by their tokens, plus a
    small weight on the distance from rate 1. A document's gradient needs the residuals alone, so documents are first
    summed by their posteriors and a round is one aggregation over that table, which for three domains has 501501 rows
    at most, however many documents there are; residuals, a number per domain and round, are all that the driver keeps.

    Rounds end when the targets are met, when the shares move no more, or after ``rounds`` of them; where the targets
    aren't met by then, as when no rates can, a warning says which shares are reached.
    """
    targets = TARGETS if targets is None else targets
    wanted = [targets.get(d, 0.0) for d in DOMAINS]
    cells = members.groupBy("p").agg(F.sum("n_tokens").alias("n")).withColumns({"rate": F.lit(1.0), "ahead": F.lit(1.0)})
    cells = stored(cells, "cells")
    total = cells.agg(F.sum("n").alias("n")).first()["n"] or 0
    if not total:
        return cells.select("p", "rate"), [0.0] * len(DOMAINS)
    n = len(DOMAINS)
    p = [F.element_at("p", i + 1) for i in range(n)]
    moments = cells.agg(*(F.sum(F.col("n") * p[i] * p[j]) / F.lit(float(total)) for i in range(n) for j in range(n))).first()
    weight = np.linalg.inv(np.array(moments, float).reshape(n, n) + 1e-6 * np.eye(n))
    step = 1 / (1 + RIDGE)

    def shares(rated: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        sums = [F.sum(F.col("n") * q * F.col(c)) / F.lit(float(total)) for c in ("rate", "ahead") for q in p]
        found = np.array(rated.agg(*(s.alias(f"s{i}") for i, s in enumerate(sums))).first(), float)
        return found[:n], found[n:]

    def after(rounds: list[list[float]]) -> DataFrame:
        return cells.withColumn("x", _moved(rounds, step)).select("p", "n", "x.rate", "x.ahead")

    recent: list[list[float]] = []
    momentum = 0
    reached, ahead = shares(cells)
    for _ in range(rounds):
        if np.abs(reached - wanted).max() <= NEAR:
            break
        recent.append([*(weight @ (ahead - wanted)).tolist(), momentum / (momentum + 3)])
        moved = after(recent)
        if len(recent) == WRITE_EVERY:
            cells = moved = stored(moved, "cells")
            recent = []
        before, (reached, ahead) = reached, shares(moved)
        gaps = [float((x - wanted) @ weight @ (x - wanted)) for x in (before, reached)]
        # Momentum that carries past the goal is dropped.
        momentum = momentum + 1 if gaps[1] <= gaps[0] else 0
        if momentum and np.abs(reached - before).max() <= STILL:
            break
    if np.abs(reached - wanted).max() > 10 * NEAR:
        met = dict(zip(DOMAINS, reached.round(4).tolist(), strict=True))
        warnings.warn(f"the rates of these documents don't meet the targets {targets}; reached {met}", stacklevel=2)
    return stored(after(recent).select("p", "rate"), "rates"), reached.tolist()


def _rated(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None, prefix: str, **options) -> DataFrame:
    """``docs`` with tokens, posteriors, rate and copies of each row, under names with ``prefix``."""
    n, p, rate = (f"{prefix}{c}" for c in ("n_tokens", "p", "rate"))
    members = stored(memberships(docs, train(docs, labels, **options), prefix=prefix), "members")
    rates, _ = fit_rates(members.where(F.col(n) > 0).select(F.col(n).alias("n_tokens"), F.col(p).alias("p")), targets)
    # A row for each rounded posterior, 501501 at most.
    rated = members.join(F.broadcast(rates.select(F.col("p").alias(p), F.col("rate").alias(rate))), p, "left")
    rated = rated.withColumn(rate, F.coalesce(F.col(rate), F.lit(1.0)))
    part = F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("long"), F.lit("mix")), 11) / F.lit(2.0**53)
    copies = F.floor(rate) + (part < F.col(rate) - F.floor(rate)).cast("long")
    own = (F.col(f"`{c}`") for c in docs.columns)
    return rated.select(*own, n, p, rate, copies.cast("long").alias(f"{prefix}copies"))


@tidy
def mixture(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, **options) -> DataFrame:
    """``doc_id, n_tokens, p, rate, copies`` for each row of ``docs``; ``options`` are those of ``train``.

    A classifier learned from the labelled rows gives each document its domain posteriors; rates make the expected
    tokens of each domain match ``targets`` (shares of all tokens). ``copies`` is the rate rounded up or down by a hash
    of the doc_id, so that its mean is the rate.

    Null and empty texts have no tokens, the prior's posteriors, and the rate of documents like that, else 1; they
    don't count in the fit. Without labels all domains are equally likely. A doc_id that is labelled twice counts twice
    in the training. Each row is judged by its own text, so repeated ids and rows without one are no special case.
    Empty tables give an empty result; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _rated(rows, labels, targets, "", **options).drop("text")


@tidy
def apply_mixture(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, **options) -> DataFrame:
    """``docs`` with ``mix_rate`` and ``mix_copies``, which replace columns so named; documents with no copy are gone."""
    own = [c for c in docs.columns if c not in ("mix_rate", "mix_copies")]
    prefix = free_prefix(docs)
    rated = _rated(docs.select(*(F.col(f"`{c}`") for c in own)), labels, targets, prefix, **options)
    rate, copies = F.col(f"{prefix}rate").alias("mix_rate"), F.col(f"{prefix}copies").alias("mix_copies")
    return rated.where(F.col(f"{prefix}copies") > 0).select(*(F.col(f"`{c}`") for c in own), rate, copies)


def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    posteriors = [F.element_at("p", i + 1).alias(f"p_{d}") for i, d in enumerate(DOMAINS)]
    return mixed.select("doc_id", "n_tokens", *posteriors, "rate", "copies")
