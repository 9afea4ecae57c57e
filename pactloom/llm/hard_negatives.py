"""Hard negatives from lists that clusters of anchors share: sorted once by an angular bound, walked until certified.

No vector of a cluster is farther than an angle b from the cluster's centre, so a row at angle t from the centre has an
inner product with any of them of at most its length times theirs times cos(t - b). Rows sorted by that bound (without
the anchor's own length) are the cluster's list. An anchor walks it from the front and may stop where the bound says
that nothing further on can still be among its first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pactloom.llm.common import prepare, stored, table, tidy

#: Clusters of anchors. A list holds every row, so their number is how often the rows are kept.
LISTS = 4
#: Anchors that the centres are fitted on, at most.
SAMPLE_ROWS = 4096
#: Bytes of vectors in one piece of a list, and in one block of anchors: what a task holds at once.
PIECE_BYTES = 1 << 17
BLOCK_BYTES = 1 << 16
#: Steps in which bounds are counted; a round walks whole steps.
STEPS = 512
#: Rows of each list that the first round walks; every further round walks twice as many.
FIRST_ROWS = 4096
#: Pieces of a list that meet the same block of anchors in one task.
PIECES = 16
POSITIVES = 5
NEGATIVES = 10
#: The share of the positive's score, in hundredths, that a negative must reach and may not exceed.
LOW, HIGH = 30, 90

LEAST = np.iinfo(np.int64).min


def _units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.sqrt((vectors**2).sum(axis=1))
    return np.divide(vectors, lengths[:, None], out=np.zeros_like(vectors), where=lengths[:, None] > 0), lengths


def centres(vectors: np.ndarray, n: int, rounds: int = 12) -> np.ndarray:
    """Unit centres of ``n`` clusters by direction (k-means on the sphere), the first ones far from each other."""
    units, _ = _units(vectors)
    if not len(units):
        return np.zeros((1, vectors.shape[1]))
    chosen = [units[0]]
    while len(chosen) < min(n, len(units)):
        chosen.append(units[np.argmin(np.max(units @ np.array(chosen).T, axis=1))])
    found = np.array(chosen)
    for _ in range(rounds):
        nearest = np.argmax(units @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, units)
        means, lengths = _units(sums)
        found = np.where(lengths[:, None] > 0, means, found)
    return found


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows; through doubles where these can hold them."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2**63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    raise OverflowError("a score may need more than 64 bits")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of integers as rows of ``dim`` columns; what a shorter one lacks is 0."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _assign(model, dim: int):
    """Each anchor's cluster and the cosine of its angle with the centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, lengths = _units(_matrix(batch.column("v"), dim).astype(float))
            cosines = units @ model.value.T
            nearest = np.argmax(cosines, axis=1)
            more = [pa.array(nearest.astype(np.int32)), pa.array(cosines[np.arange(len(batch)), nearest]), pa.array(lengths)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "cluster", "cosine", "length"])

    return run


def _bounds(model, widths: np.ndarray, dim: int):
    """Each row once for every list, with its bound there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, lengths = _units(_matrix(batch.column("v"), dim).astype(float))
            angles = np.arccos(np.clip(units @ model.value.T, -1, 1))
            bounds = lengths[:, None] * np.cos(np.maximum(0.0, angles - widths))
            # Angles are good to some 1e-8 where they are small; the bound must not fall short.
            bounds += lengths[:, None] * 1e-6
            for c in range(len(widths)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(batch), c, np.int32)), pa.array(bounds[:, c]), *batch.columns], ["cluster", "bound", *batch.schema.names])

    return run


PIECE = "cluster int, high double, piece long, n int, ids binary, labels binary, vectors binary"


def _packed(dim: int):
    """Rows sorted by (cluster, bound from high to low) as pieces; ``high`` is the piece's largest bound."""
    size = max(1, PIECE_BYTES // (4 * max(1, dim)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def given(rows: int) -> pa.RecordBatch:
            cluster, bound, ids, labels, vectors = (np.concatenate(x)[:rows] for x in zip(*held, strict=True))
            order = np.argsort(ids)  # columns by id, so that equal scores come in that order
            rest = [tuple(x[rows:] for x in map(np.concatenate, zip(*held, strict=True)))]
            held[:] = rest if len(rest[0][0]) else []
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "cluster": int(cluster[0]), "high": float(bound.max()), "piece": int(ids[order[0]]), "n": rows, "ids": ids[order].tobytes(),
                        "labels": labels[order].tobytes(), "vectors": vectors[order].astype(np.int32).tobytes(),
                    }
                ],
                pa.schema([("cluster", pa.int32()), ("high", pa.float64()), ("piece", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())]),
            )

        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in ("cluster", "bound", "vec_id", "label")]
            rows.append(_matrix(batch.column("v"), dim))
            cuts = np.flatnonzero(np.diff(rows[0])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(rows[0])], strict=True):
                if a == b:
                    continue
                if held and held[0][0][0] != rows[0][a]:
                    while held:
                        yield given(min(size, sum(len(x[0]) for x in held)))
                held.append(tuple(x[a:b] for x in rows))
                while sum(len(x[0]) for x in held) >= size:
                    yield given(size)
        while held:
            yield given(min(size, sum(len(x[0]) for x in held)))

    return run


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    starts = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))[: len(order)]
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[place < k]


FOUND = "anchor_id long, target int, other_id long, score long"


def _walk(dim: int, k: int, same: bool):
    """Pieces against blocks of anchors: per anchor and target the first ``k`` rows of what this task sees.

    A target is a window of scores (``low`` to ``high``, in hundredths); an anchor without targets has one without
    ends. What can't be among the first any more, by what was found before or by the task so far, is not kept.
    """
    schema = pa.schema([("anchor_id", pa.int64()), ("target", pa.int32()), ("other_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}

        def given():
            for anchors, targets, group, score, ids in known.values():
                a, t = np.divmod(group, targets)
                yield pa.RecordBatch.from_arrays([pa.array(anchors[a]), pa.array(t.astype(np.int32)), pa.array(ids), pa.array(score)], schema=schema)
            known.clear()

        for batch in batches:
            for row in range(len(batch)):
                ids, labels = (np.frombuffer(batch.column(c)[row].as_buffer(), np.int64) for c in ("ids", "labels"))
                vectors = np.frombuffer(batch.column("vectors")[row].as_buffer(), np.int32).reshape(len(ids), dim)
                high = batch.column("high")[row].as_py()
                block = batch.column("anchors")[row].values
                name = (batch.column("cluster")[row].as_py(), batch.column("block")[row].as_py())
                anchors, own, length = (block.field(c).to_numpy() for c in ("anchor_id", "label", "length"))
                mine = _matrix(block.field("v"), dim)
                n = len(anchors)
                low, most, least = (_targets(block.field(c)) for c in ("low", "high", "least"))
                targets = low.shape[1]
                if name not in known:
                    if len(known) >= 64:
                        yield from given()
                    none = np.empty(0, np.int64)
                    known[name] = (anchors, targets, none, none, none)
                _, _, group, score, had = known[name]
                # The k-th best so far, of this task or of earlier rounds, is what a row must reach.
                full = np.bincount(group, minlength=n * targets) >= k
                bar = np.full(n * targets, LEAST)
                if len(group):
                    worst = np.full(n * targets, np.iinfo(np.int64).max)
                    np.minimum.at(worst, group, score)
                    bar = np.where(full, worst, LEAST)
                bar = np.maximum(bar.reshape(n, targets), least)
                reach = high * length[:, None]
                wanted = (reach >= bar) & (100 * reach >= low)
                rows = np.flatnonzero(wanted.any(axis=1))
                if not len(rows):
                    continue
                scores = inner(mine[rows], vectors)
                fits = (labels == own[rows][:, None]) == same
                fits &= ids != anchors[rows][:, None]
                parts = [(group, score, had)]
                for t in range(targets):
                    ok = fits & (scores >= bar[rows, t][:, None])
                    if not same:
                        ok &= (100 * scores >= low[rows, t][:, None]) & (100 * scores <= most[rows, t][:, None])
                    a, c = np.nonzero(ok)
                    parts.append((rows[a] * targets + t, scores[a, c], ids[c]))
                group, score, had = (np.concatenate(x) for x in zip(*parts, strict=True))
                best = _first(group, score, had, k)
                known[name] = (anchors, targets, group[best], score[best], had[best])
        yield from given()

    return run


def _targets(column: pa.Array) -> np.ndarray:
    """A list of equal length for each anchor of the block as a matrix."""
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1)


def _first_in_lists(pieces: DataFrame, steps: dict[int, list[tuple[float, int]]], anchors: DataFrame, dim: int, k: int, same: bool) -> DataFrame:
    """Walks the lists for ``anchors (anchor_id, label, v, cluster, length, low, high)``, all until certified.

    A round takes the next bounds of each list, joins its pieces with the blocks of its cluster's open anchors, and
    closes the anchors for which no later bound can matter. Rounds double, so there are few.
    """
    spark = anchors.sparkSession
    targets = F.size("low")
    opened = anchors.withColumn("least", F.array_repeat(F.lit(int(LEAST)).cast("long"), targets))
    opened = stored(opened, "open-anchors")
    block_rows = max(1, BLOCK_BYTES // (4 * max(1, dim)))
    found, wanted = None, FIRST_ROWS
    upper = {c: float("inf") for c in steps}
    while True:
        lower = {}
        for c, counted in steps.items():
            left, lower[c] = wanted, float("-inf")
            for low, n in counted:
                if low < upper[c]:
                    left -= n
                    if left <= 0 and low > counted[-1][0]:
                        lower[c] = low
                        break
        here = F.lit(False)
        for c in steps:
            here |= (F.col("cluster") == c) & (F.col("high") < upper[c]) & (F.col("high") >= lower[c])
        part = pieces.where(here)
        sizes = {r["cluster"]: r["n"] for r in opened.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not sizes:
            break
        n_blocks = F.lit(1)
        for c, n in sizes.items():
            n_blocks = F.when(F.col("cluster") == c, -(-n // block_rows)).otherwise(n_blocks)
        blocks = opened.withColumn("block", F.pmod(F.xxhash64("anchor_id"), n_blocks).cast("int"))
        blocks = blocks.groupBy("cluster", "block").agg(F.sort_array(F.collect_list(F.struct("anchor_id", "label", "v", "length", "low", "high", "least"))).alias("anchors"))
        slots = max(1, -(-part.count() // (PIECES * len(steps))))
        dealt = part.withColumn("slot", F.pmod(F.xxhash64("piece", "high"), F.lit(slots)).cast("int"))
        blocks = blocks.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
        met = dealt.hint("merge").join(blocks, ["cluster", "slot"])
        met = met.select("cluster", "block", "high", "ids", "labels", "vectors", "anchors")
        new = met.mapInArrow(_walk(dim, k, same), FOUND)
        new = new if found is None else new.unionByName(found)
        order = Window.partitionBy("anchor_id", "target").orderBy(F.desc("score"), "other_id")
        found = stored(new.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place"), "found")
        if all(x == float("-inf") for x in lower.values()):
            break
        upper = lower
        bar = found.groupBy("anchor_id", "target").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s"))
        bar = bar.where(F.col("n") >= k).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("target", "s"))).alias("reached"))
        least = F.transform(F.sequence(F.lit(0), targets - 1), lambda t: F.coalesce(F.col("reached")[t.cast("int")], F.lit(int(LEAST)).cast("long")))
        rest = F.lit(0.0)
        for c, x in upper.items():
            rest = F.when(F.col("cluster") == c, F.lit(x)).otherwise(rest)
        reach = rest * F.col("length")
        still = F.exists(F.arrays_zip("low", "least"), lambda t: (reach >= t["least"]) & (100 * reach >= t["low"]))
        opened = opened.drop("least").join(bar, "anchor_id", "left").withColumn("least", least).drop("reached").where(still)
        opened = stored(opened, "open-anchors")
        wanted *= 2
    return spark.createDataFrame([], FOUND) if found is None else found


def clean_rows(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, v``: rows that take part, components as integers, one row for each vec_id."""
    x = F.col("embedding").cast("array<double>")
    fine = ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    relabelled = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(fine)
    whole = F.transform("embedding", lambda e: F.floor(e * 256).cast("long"))
    return rows.select("vec_id", relabelled.alias("label"), whole.alias("v")).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")


@tidy
def mine(rows: DataFrame, is_anchor: str, lists: int = LISTS, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``rows (vec_id, label, v)``.

    ``is_anchor`` is a condition on ``vec_id``. An anchor's positives are the first others of its label by inner
    product, its negatives for each of them the first rows of other labels with ``LOW`` to ``HIGH`` hundredths of the
    positive's score; smaller ids go first among equal scores.

    Centres are fitted on ``SAMPLE_ROWS`` anchors at most, chosen by a hash; all anchors and all rows are used. Every
    row is on every list; lists are cut into pieces of bounded size, anchors into blocks, and both meet in tasks.

    A shorter vector counts as filled up with zeros; an empty one has the score 0 with all. An anchor without another
    row of its label, or a positive without negatives in its window, has no rows. Components beyond 2^31 or scores
    beyond 64 bits raise an error. An empty table, or one without anchors, gives an empty result.
    """
    spark = rows.sparkSession
    prepare(spark)
    rows = stored(rows, "rows")
    facts = rows.agg(F.max(F.size("v")).alias("dim"), F.max(F.expr("array_max(transform(v, x -> abs(x)))")).alias("most")).first()
    dim = facts["dim"] or 0
    if (facts["most"] or 0) >= 2**31:
        raise OverflowError("a component is beyond 2^31 / 256")
    chosen = rows.where(is_anchor)
    sample = chosen.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("v").toPandas()["v"]
    points = np.zeros((len(sample), dim))
    for i, v in enumerate(sample):
        points[i, : len(v)] = v
    model = spark.sparkContext.broadcast(centres(points, lists))
    names = "vec_id long, label long, v array<long>"
    assigned = stored(chosen.mapInArrow(_assign(model, dim), names + ", cluster int, cosine double, length double"), "anchors")
    widest = {r["cluster"]: r["c"] for r in assigned.groupBy("cluster").agg(F.min("cosine").alias("c")).collect()}
    if not widest:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    widths = np.array([np.arccos(np.clip(widest.get(c, 1.0), -1, 1)) + 1e-7 for c in range(len(model.value))])
    entries = rows.mapInArrow(_bounds(model, widths, dim), "cluster int, bound double, " + names)
    entries = entries.where(F.col("cluster").isin(list(widest)))
    order = ["cluster", F.desc("bound"), "vec_id"]
    dealt = entries.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = stored(dealt.mapInArrow(_packed(dim), PIECE), "lists")
    # How many rows have which bound, in so many steps for each list.
    ends = {r["cluster"]: (r["lo"], r["hi"]) for r in pieces.groupBy("cluster").agg(F.min("high").alias("lo"), F.max("high").alias("hi")).collect()}
    steps: dict[int, list[tuple[float, int]]] = {}
    for c, (lo, hi) in ends.items():
        width = max(hi - lo, 1e-9) / STEPS
        counted = pieces.where(F.col("cluster") == c).groupBy(F.floor((F.col("high") - lo) / width).alias("s")).agg(F.sum("n").alias("n"), F.min("high").alias("low"))
        steps[c] = [(r["low"], r["n"]) for r in counted.orderBy(F.desc("s")).collect()]

    anchors = assigned.select(F.col("vec_id").alias("anchor_id"), "label", "v", "cluster", "length")
    one = F.array(F.lit(float("-inf")))
    first = _first_in_lists(pieces, steps, anchors.withColumn("low", one).withColumn("high", one), dim, positives, True)
    windows = first.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("other_id").alias("p")))).alias("ps"))
    # As many targets for each anchor; one without a positive is a window that nothing fits.
    at = lambda f, none: F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.when(i < F.size("ps"), f(F.get("ps", i))).otherwise(F.lit(none)))
    aimed = anchors.join(windows, "anchor_id")
    aimed = aimed.withColumn("low", at(lambda x: (-x["s"] * LOW).cast("double"), float("inf"))).withColumn("high", at(lambda x: (-x["s"] * HIGH).cast("double"), float("-inf")))
    aimed = stored(aimed, "targets")
    last = _first_in_lists(pieces, steps, aimed.drop("ps"), dim, negatives, False)
    pairs = aimed.select("anchor_id", F.posexplode("ps").alias("target", "x")).select("anchor_id", "target", F.col("x.p").alias("positive_id"), (-F.col("x.s")).alias("positive_score"))
    rank = F.row_number().over(Window.partitionBy("anchor_id", "target").orderBy(F.desc("score"), "other_id"))
    ranked = last.withColumn("rank", rank).join(pairs, ["anchor_id", "target"])
    model.destroy()
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_maximus_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(clean_rows(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")), "pmod(vec_id, 100) = 0")


OP12_SQL = f"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
             CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}),
n AS (SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INT) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
       AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""
