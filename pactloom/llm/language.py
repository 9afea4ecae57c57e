"""Language ID by interpolated Kneser-Ney character models, one per language, in files of sorted hash arrays."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactloom.llm.common import code_points, letters, mix, prepare, shared_folder, stored, table, text_chunks
from pactloom.llm.warc import open_folder

ORDER = 4
#: Grams of one file of the model. Scoring tasks map files into memory, so their number bounds nothing.
SHARD_ROWS = 1 << 20
#: Temperatures that are tried.
TEMPERATURES = tuple(2.0**i for i in range(11))
#: Spreads of cross-entropies are counted in steps of one part in so many, to find their medians.
STEPS = 1e9
#: A text is rejected whose cross-entropy is so many standard deviations above its language's mean, and also this
#: share of the mean: texts of mixed languages or with codes among the words stay, what is no language goes.
REJECT_AT = 8.0
REJECT_SHARE = 1.0
UNDETERMINED = "und"
#: Symbols that a model may meet; what it never saw shares the discounted mass evenly.
ALPHABET = 4096.0


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The 4-grams of each text, packed 16 bits a symbol, the number of their text, and the letters of each text.

    Symbols are lower-case letters; what stands between letters is one space, and a text begins with three.
    """
    points, begins = code_points(["\n" * (ORDER - 1) + t for t in texts])
    is_letter = letters()[points]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    for j in range(ORDER - 1):
        keep[begins + j] = True
    keep[np.append(begins[1:], len(points) + 1)[:-1] - 1] = False  # the line break that joins two texts
    owner = np.zeros(len(points), np.int64)
    owner[begins[1:]] = 1
    owner = np.cumsum(owner)
    n_letters = np.bincount(owner[is_letter], minlength=len(texts))
    at = np.flatnonzero(keep)
    codes = np.where(is_letter[at], (points[at] ^ (points[at] >> 16)) & 0xFFFF, 32).astype(np.uint64)
    owner = owner[at]
    total = max(0, len(codes) - ORDER + 1)
    packed = np.zeros(total, np.uint64)
    for j in range(ORDER):
        packed = (packed << np.uint64(16)) | codes[j : j + total]
    whole = owner[:total] == owner[ORDER - 1 :] if total else np.empty(0, bool)
    return packed[whole], owner[:total][whole], n_letters


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, end in text_chunks(batch.column("text")):
            part = batch.slice(at, end - at)
            langs = np.array(part.column("lang").to_pylist(), object)
            packed, owner, _ = symbols([t or "" for t in part.column("text").to_pylist()])
            for lang in sorted(set(langs)):
                grams, n = np.unique(packed[(langs == lang)[owner]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"],
                )


def gram_counts(rows: DataFrame) -> DataFrame:
    """``lang, gram, n``: how often each 4-gram stands in all of ``rows (lang, text)``."""
    counts = rows.mapInArrow(_count, "lang string, gram long, n long")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in the sorted ``keys``, -1 for those that aren't there."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


@lru_cache(maxsize=4096)
def _mapped(folder: str, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and values of a file of the model, mapped into memory: pages come and go as they are looked at."""
    system, root = open_folder(folder)
    arrays = []
    for part in ("hashes", "values"):
        path = f"{root}/{name}-{part}.npy"
        if isinstance(system, fs.LocalFileSystem):
            arrays.append(np.asarray(np.load(path, mmap_mode="r")))
            continue
        handle, copy = tempfile.mkstemp(suffix=".npy")
        os.close(handle)
        fs.copy_files(path, copy, source_filesystem=system, destination_filesystem=fs.LocalFileSystem())
        arrays.append(np.asarray(np.load(copy, mmap_mode="r")))
        os.unlink(copy)  # the mapping holds it
    return arrays[0], arrays[1]


@dataclass
class Table:
    """Hashes of grams, sorted, and a row of values (one column a language) for each, in files by ranges of hashes.

    The files are in a folder that all executors share; this object holds their names and first hashes only.
    """

    folder: str
    names: list[str]
    starts: np.ndarray
    width: int

    @classmethod
    def of(cls, rows: DataFrame, name: str, width: int) -> Table:
        """``rows (key, p)`` as files; ``key`` sorts as the hash does."""
        folder = shared_folder(rows.sparkSession, name)
        open_folder(folder)[0].create_dir(open_folder(folder)[1], recursive=True)
        shards = max(1, -(-rows.count() // SHARD_ROWS))
        dealt = rows.select("key", "p").repartitionByRange(shards, "key").sortWithinPartitions("key")
        made = dealt.mapInArrow(_files(folder, width), "start long, name string").toPandas().sort_values("start")
        return cls(folder, list(made["name"]), _unsigned(made["start"].to_numpy(np.int64)), width)

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of each gram, and whether it is there."""
        values, there = np.zeros((len(grams), self.width), np.float32), np.zeros(len(grams), bool)
        wanted = mix(grams)
        order = np.argsort(wanted)
        wanted = wanted[order]
        cuts = np.append(np.searchsorted(wanted, self.starts), len(wanted))
        for name, a, b in zip(self.names, cuts[:-1], cuts[1:], strict=True):
            if a < b:
                hashes, rows = _mapped(self.folder, name)
                at = np.minimum(np.searchsorted(hashes, wanted[a:b]), len(hashes) - 1)
                hit = np.flatnonzero(hashes[at] == wanted[a:b])
                values[order[a:b][hit]] = rows[at[hit]]
                there[order[a:b][hit]] = True
        return values, there


_TOP = np.uint64(1 << 63)


def _signed(hashes: np.ndarray) -> np.ndarray:
    """Numbers that sort in Spark as the hashes do."""
    return (hashes ^ _TOP).view(np.int64)


def _unsigned(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.uint64) ^ _TOP


def _files(folder: str, width: int):
    """Each task writes its range of ``key, p`` under a name of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = [], []
        for batch in batches:
            keys.append(batch.column("key").to_numpy())
            values.append(batch.column("p").flatten().to_numpy().astype(np.float32))
        keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
        if len(keys):
            name = uuid.uuid4().hex
            system, root = open_folder(folder)
            for part, array in (("hashes", _unsigned(keys)), ("values", np.concatenate(values).reshape(-1, width))):
                with system.open_output_stream(f"{root}/{name}-{part}.npy") as out:
                    np.save(out, array)
            yield pa.RecordBatch.from_arrays([pa.array(keys[:1]), pa.array([name])], ["start", "name"])

    return run


def _dense(column: pa.Array, width: int) -> list[np.ndarray]:
    """Lists of structs whose first field is a language's number, as one array (a column a language) per other field."""
    row = np.repeat(np.arange(len(column)), pc.list_value_length(column).to_numpy(zero_copy_only=False))
    language, *fields = (x.to_numpy() for x in column.flatten().flatten())
    out = []
    for x in fields:
        out.append(np.zeros((len(column), width)))
        out[-1][row, language] = x
    return out


def _lists(p: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1], p.ravel())


def _backoffs(discounts: np.ndarray, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per context and language the count of all its grams, and what it leaves to the lower order."""
    total, kinds = _dense(column, len(discounts))
    total = np.maximum(total, 1)
    return total, np.where(kinds > 0, discounts * kinds / total, 1.0)


def _contexts(discounts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _signed(mix(batch.column("context").to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(keys), _lists(np.log(_backoffs(discounts, batch.column("all"))[1]))], ["key", "p"])

    return run


def _probabilities(discounts: np.ndarray):
    """Of each gram its probability in every language, from its counts, its context's and the lower order."""
    width = len(discounts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, backoff = _backoffs(discounts, batch.column("all"))
            counts = _dense(batch.column("own"), width)[0]
            lower = batch.column("lower").flatten().to_numpy().reshape(-1, width)
            p = np.maximum(counts - discounts, 0) / total + backoff * lower
            yield pa.RecordBatch.from_arrays([batch.column("gram"), _lists(p)], ["gram", "p"])

    return run


def _logs(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column("p").flatten().to_numpy().reshape(-1, width)
            keys = _signed(mix(batch.column("gram").to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(keys), _lists(np.log(p))], ["key", "p"])

    return run


class KneserNey:
    """Probabilities of one language: discounted counts at the top, numbers of distinct predecessors below.

    This is the plain form of the model, in memory; ``Model.of`` computes the same in Spark.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.levels = {}
        order = np.argsort(grams)
        grams, counts = grams[order], counts[order].astype(float)
        for n in range(ORDER, 0, -1):
            one, two = (counts == 1).sum(), (counts == 2).sum()
            discount = one / (one + 2 * two) if one and two else 0.75
            context, first = np.unique(grams >> np.uint64(16), return_index=True)
            total = np.add.reduceat(counts, first)
            kinds = np.diff(np.append(first, len(grams)))
            place = np.repeat(np.arange(len(context)), kinds)
            own = np.maximum(counts - discount, 0) / total[place]
            self.levels[n] = (grams, own, context, discount * kinds / total)
            if n > 1:
                grams, counts = np.unique(grams & np.uint64((1 << 16 * (n - 1)) - 1), return_counts=True)
                counts = counts.astype(float)

    def backoff(self, n: int, context: np.ndarray) -> np.ndarray:
        """What a context leaves to the lower order; all of it where the context is unknown."""
        at = _find(self.levels[n][2], context)
        return np.where(at < 0, 1.0, self.levels[n][3][at])

    def probability(self, n: int, grams: np.ndarray) -> np.ndarray:
        if n == 0:
            return np.full(len(grams), 1 / ALPHABET)
        at = _find(self.levels[n][0], grams)
        own = np.where(at < 0, 0.0, self.levels[n][1][at])
        lower = self.probability(n - 1, grams & np.uint64((1 << 16 * (n - 1)) - 1))
        return own + self.backoff(n, grams >> np.uint64(16)) * lower


@dataclass
class Model:
    """Per order one table of log probabilities of the grams any language has, and one of the contexts' remainders."""

    languages: list[str]
    grams: dict[int, Table]
    contexts: dict[int, Table]
    temperature: float = 1.0
    bounds: np.ndarray | None = None

    @classmethod
    def of(cls, counts: DataFrame) -> Model | None:
        """From ``counts (lang, gram, n)``, an order after the other, all in Spark; None where there are none.

        Only languages, their discounts and the names of files come to the driver.
        """
        counts = stored(counts, "grams")
        languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
        if not languages:
            return None
        width = len(languages)
        number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("long") - 1
        levels = {ORDER: counts.select(number.alias("language"), "gram", "n")}
        below = lambda n: F.col("gram").bitwiseAND(F.lit((1 << 16 * (n - 1)) - 1))
        for n in range(ORDER, 1, -1):
            fewer = levels[n].groupBy("language", below(n).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
            levels[n - 1] = stored(fewer, f"grams-{n - 1}")
        grams, contexts, lower = {}, {}, None
        for n in range(1, ORDER + 1):
            discounts = np.full(width, 0.75)
            once = levels[n].groupBy("language").agg(F.count_if(F.col("n") == 1).alias("one"), F.count_if(F.col("n") == 2).alias("two"))
            for r in once.collect():
                if r["one"] and r["two"]:
                    discounts[r["language"]] = r["one"] / (r["one"] + 2 * r["two"])
            context = F.shiftrightunsigned("gram", 16).alias("context")
            around = levels[n].groupBy("language", context).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
            around = around.groupBy("context").agg(F.collect_list(F.struct("language", "total", "kinds")).alias("all"))
            around = stored(around, "contexts")
            own = levels[n].groupBy("gram").agg(F.collect_list(F.struct("language", "n")).alias("own"))
            own = own.select("gram", "own", context, below(n).alias("low"))
            if n == 1:
                # All symbols have the one empty context, and there are 2^16 of them at most.
                own = own.join(F.broadcast(around), "context").withColumn("lower", F.array_repeat(F.lit(1 / ALPHABET), width))
            else:
                own = own.join(around, "context").join(lower, "low")
            rows = own.select("gram", "own", "all", "lower").mapInArrow(_probabilities(discounts), "gram long, p array<double>")
            rows = stored(rows, "probabilities")
            lower = rows.select(F.col("gram").alias("low"), F.col("p").alias("lower"))
            grams[n] = Table.of(rows.mapInArrow(_logs(width), "key long, p array<double>"), "model-grams", width)
            contexts[n] = Table.of(around.mapInArrow(_contexts(discounts), "key long, p array<double>"), "model-contexts", width)
        return cls(languages, grams, contexts)

    def log_probabilities(self, grams: np.ndarray, n: int = ORDER) -> np.ndarray:
        """A row per gram, a column per language."""
        if n == 0:
            return np.full((len(grams), len(self.languages)), -np.log(ALPHABET), np.float32)
        grams, places = np.unique(grams, return_inverse=True)
        out, there = self.grams[n].find(grams)
        missed = np.flatnonzero(~there)
        if len(missed):
            rest = grams[missed]
            lower = self.log_probabilities(rest & np.uint64((1 << 16 * (n - 1)) - 1), n - 1)
            out[missed] = lower + self.contexts[n].find(rest >> np.uint64(16))[0]
        return out[places]

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy a symbol of each text under each language, its symbols, and its letters."""
        packed, owner, n_letters = symbols(texts)
        n = np.bincount(owner, minlength=len(texts))
        sums = np.zeros((len(texts), len(self.languages)))
        if len(packed):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sums[owner[first]] = np.add.reduceat(self.log_probabilities(packed), first, axis=0, dtype=np.float64)
        return -sums / np.maximum(n, 1)[:, None], n, n_letters

    def confidence(self, entropy: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Probability of each language, from the whole text's likelihood at the fitted temperature."""
        z = -(entropy - entropy.min(axis=1, keepdims=True)) * np.maximum(n, 1)[:, None] / self.temperature
        p = np.exp(np.maximum(z, -700))
        return p / p.sum(axis=1, keepdims=True)

    def losses(self, entropy: np.ndarray, n: np.ndarray, truth: np.ndarray) -> np.ndarray:
        """What each text's own language costs at each of the temperatures."""
        plain = replace(self, temperature=1.0)
        costs = []
        for plain.temperature in TEMPERATURES:
            p = plain.confidence(entropy, n)[np.arange(len(truth)), truth]
            costs.append(-np.log(np.maximum(p, 1e-12)))
        return np.stack(costs, axis=1)

    def calibrate(self, scored: DataFrame) -> None:
        """Temperature by the likelihood of all rows' languages; mean and spread of each language's cross-entropy.

        ``scored (language, n, own, losses)`` is the whole training table. Sums are of decimals, so their order is free.
        """
        total = scored.agg(*[F.sum(F.col("losses")[i].cast("decimal(18,9)")) for i in range(len(TEMPERATURES))]).first()
        self.temperature = TEMPERATURES[int(np.argmin([float(x or 0) for x in total]))]
        width = len(self.languages)
        weight = F.sum("n").alias("size")
        own = F.sum((F.col("own") * F.col("n")).cast("decimal(38,6)")).alias("total")
        mean, known = np.zeros(width), []
        for r in scored.groupBy("language").agg(F.count(F.lit(1)).alias("rows"), weight, own).collect():
            if r["rows"] > 1:
                known.append(r["language"])
                mean[r["language"]] = float(r["total"]) / r["size"]
        self.bounds = np.tile([np.log(ALPHABET), 0.0, 0.0], (width, 1))
        means = F.array(*[F.lit(float(m)) for m in mean])
        spread = F.pow(F.col("own") - means[F.col("language")], F.lit(2.0)) * F.col("n")
        rows = scored.where(F.col("language").isin(known)).select("language", "n", spread.alias("spread"))
        middle = medians(rows.select("language", (F.col("spread") * STEPS).cast("long").alias("value")), width)
        for r in rows.groupBy("language").agg(weight, F.sum(F.col("spread").cast("decimal(38,12)")).alias("total")).collect():
            # Spread of long texts, and what a text's few symbols add to it.
            i = r["language"]
            self.bounds[i] = (mean[i], float(r["total"]) / r["size"], middle[i] / STEPS / 0.455)

    def rejects(self, entropy: np.ndarray, n: np.ndarray, best: np.ndarray) -> np.ndarray:
        mean, between, within = self.bounds[best].T
        margin = np.maximum(REJECT_AT * np.sqrt(between + within / np.maximum(n, 1)), REJECT_SHARE * mean)
        return entropy[np.arange(len(best)), best] > mean + margin


def medians(rows: DataFrame, width: int) -> dict[int, int]:
    """The median (of two, the lower) of ``value``, whole numbers from 0, of each ``language`` below ``width``.

    Exact: the values are counted in 256 ranges, then those of the range that holds the middle in finer ones, and so on.
    """
    within, rank = [0] * width, [-1] * width
    for r in rows.groupBy("language").agg(F.count(F.lit(1)).alias("n")).collect():
        rank[r["language"]] = (r["n"] - 1) // 2
    of_language = lambda values: F.array(*[F.lit(v).cast("long") for v in values])[F.col("language")]
    for shift in range(56, -1, -8):
        inside = rows.where(F.shiftright("value", min(shift + 8, 63)) == of_language(within))
        counts = inside.groupBy("language", F.shiftright("value", shift).alias("range")).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("language").orderBy("range"))
        placed = counts.withColumns({"before": upto - F.col("n"), "rank": of_language(rank)})
        for r in placed.where("before <= rank AND rank < before + n").collect():
            within[r["language"]] = r["range"]
            rank[r["language"]] -= r["before"]
    return {i: within[i] for i in range(width) if rank[i] >= 0}


SCORED = "language int, n long, own double, losses array<float>"


def _score(model):
    """Rows of a learned language with symbols, with their cross-entropy under it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        place = {x: i for i, x in enumerate(m.languages)}
        for batch in batches:
            for at, end in text_chunks(batch.column("text")):
                part = batch.slice(at, end - at)
                entropy, n, _ = m.entropies(part.column("text").to_pylist())
                truth = np.array([place.get(x, -1) for x in part.column("lang").to_pylist()], np.int32)
                kept = np.flatnonzero((truth >= 0) & (n > 0))
                entropy, n, truth = entropy[kept], n[kept], truth[kept]
                losses = pa.array(list(m.losses(entropy, n, truth).astype(np.float32)), pa.list_(pa.float32()))
                own = entropy[np.arange(len(truth)), truth]
                yield pa.RecordBatch.from_arrays([pa.array(truth), pa.array(n), pa.array(own), losses], ["language", "n", "own", "losses"])

    return run


def train(rows: DataFrame) -> Model | None:
    """A model from all of ``rows (doc_id, lang, text)`` that have a language and a text; None where there are none.

    Counts, temperature and bounds are of all these rows, none are left out.
    """
    prepare(rows.sparkSession)
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    model = Model.of(gram_counts(rows))
    if model is None:
        return None
    model.calibrate(stored(rows.mapInArrow(_score(rows.sparkSession.sparkContext.broadcast(model)), SCORED), "scored"))
    return model


PREDICTED = "doc_id long, lang_pred string, score double, entropy double, rejected boolean"


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        names = np.array(m.languages, object)
        for batch in batches:
            for at, end in text_chunks(batch.column("text")):
                part = batch.slice(at, end - at)
                entropy, n, n_letters = m.entropies([t or "" for t in part.column("text").to_pylist()])
                best = entropy.argmin(axis=1)
                lettered = n_letters > 0
                score = np.where(lettered, m.confidence(entropy, n).max(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.where(lettered, names[best], UNDETERMINED), pa.string()),
                        pa.array(score),
                        pa.array(entropy[np.arange(len(best)), best]),
                        pa.array(~lettered | m.rejects(entropy, n, best)),
                    ],
                    [x.split()[0] for x in PREDICTED.split(", ")],
                )

    return run


def is_held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score, entropy, rejected`` of every row; only the text is looked at.

    The language is that of the lowest cross-entropy a symbol. Null texts and texts without a letter are ``und``, with
    score 0, and rejected; so is everything without a model. Other texts always get a learned language; ``rejected``
    marks those whose cross-entropy is out of the range that the language's own texts of that length have.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        nothing = [F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("entropy"), F.lit(True).alias("rejected")]
        return rows.select("doc_id", *nothing)
    return rows.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model)), PREDICTED)


def identify(docs: DataFrame) -> DataFrame:
    """Learns from the rows of ``docs`` that aren't held out and predicts all; adds ``held_out`` to ``predict``.

    A row is held out when crc32 of its doc_id as text leaves 2 by 4. Rows without a doc_id are predicted only, and
    not held out. Repeated rows are learned from and predicted each. An empty table gives an empty result.
    """
    model = train(docs.where(~is_held_out() & F.col("doc_id").isNotNull()))
    return predict(docs, model).select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score", "entropy", "rejected")


def drop_rejected(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that language ID rejects; columns as they were.

    Nothing is held out: all rows with a language and a text are learned from, those without a doc_id too.
    """
    prepare(docs.sparkSession)
    model = train(docs)
    if model is None:
        return docs.limit(0)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end in text_chunks(batch.column("text")):
                part = batch.slice(at, end - at)
                entropy, n, n_letters = held.value.entropies([t or "" for t in part.column("text").to_pylist()])
                fine = (n_letters > 0) & ~held.value.rejects(entropy, n, entropy.argmin(axis=1))
                yield part.filter(pa.array(fine))

    return docs.mapInArrow(run, docs.schema)


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
