"""Document fingerprints by winnowing: rolling k-gram hashes, the smallest of each window, the rightmost of equals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pactloom.llm.common import stored, table

#: Words of a gram, and grams of a window (a power of two): 12 words in common always share a fingerprint.
GRAM = 5
WINDOW = 8
#: A word is a run of letters or digits; a longer run is cut, so that texts without spaces have words as well.
WORD = r"[\p{L}\p{N}]{1,16}"
PRIME = 2147483647
BASE = 1000003
SHIFT = 4294967296
#: Documents of one group when the next document is looked up: 2^11 numbers in a row.
GROUP_BITS = 11


def _pairs(column: str, step: int, combine) -> Column:
    """``combine(x[i], x[i + step])`` for all i where both exist."""
    n = F.greatest(F.size(column) - step, F.lit(0))
    return F.zip_with(F.slice(column, F.lit(1), n), F.slice(column, F.lit(step + 1), n), combine)


def _join(step: int):
    factor = pow(BASE, step, PRIME)
    return lambda x, y: (x * F.lit(factor) + y) % F.lit(PRIME)


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``: the selected grams as ``hash * 2^32 + (2^32 - 1 - position)``, in order of position.

    The polynomial hash of ``GRAM`` words is built from those of 2 and 4 words, each a pass over the array; the
    minimum of a window likewise. The position in the low bits makes the rightmost of equal hashes the smallest.
    A text of fewer words than a gram has one gram, a text of fewer grams than a window one window.
    """
    w, h, a, b, g, p, m = (f"_{name}_{x}" for x in "whabgpm")
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    df = df.withColumn(w, words)
    df = df.withColumn(h, F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(PRIME))))
    df = df.withColumn(a, _pairs(h, 1, _join(1)))
    df = df.withColumn(b, _pairs(a, 2, _join(2)))
    n = F.greatest(F.size(h) - (GRAM - 1), F.lit(0))
    grams = F.zip_with(F.slice(b, F.lit(1), n), F.slice(h, F.lit(GRAM), n), _join(1))
    short = F.array(F.pmod(F.xxhash64(F.array_join(w, " ")), F.lit(PRIME)))
    df = df.withColumn(g, F.when(F.size(h) >= GRAM, grams).when(F.size(h) > 0, short).otherwise(grams))
    df = df.withColumn(p, F.transform(g, lambda x, i: x * F.lit(SHIFT) + (F.lit(SHIFT - 1) - i)))
    least, step = p, 1
    while step < WINDOW:
        df = df.withColumn(f"{m}{step}", _pairs(least, step, lambda x, y: F.least(x, y)))
        least, step = f"{m}{step}", 2 * step
    whole = F.when(F.size(p) > 0, F.array(F.array_min(p))).otherwise(F.col(p))
    df = df.withColumn(name, F.when(F.size(p) >= WINDOW, F.array_distinct(least)).otherwise(whole))
    return df.drop(*(c for c in df.columns if c.startswith(f"_{name}_")))


def printed(fingerprint: str) -> Column:
    """``hash:position`` of each selected gram, hash in hex, with spaces between."""
    one = lambda x: F.concat(F.lower(F.hex(F.shiftright(x, 32))), F.lit(":"), (F.lit(SHIFT - 1) - x % F.lit(SHIFT)).cast("string"))
    return F.array_join(F.transform(fingerprint, one), " ")


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of the hashes of two fingerprints; 1 where both are empty."""
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / every)


def successors(ids: DataFrame) -> DataFrame:
    """``(id, next)`` for distinct ids: the next larger one, after the last the first.

    Groups of 2^11 numbers in a row find it among themselves; the first of the next group that has any comes from
    the same question about the groups' numbers, so no task sees more than one group.
    """
    ends = ids.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    if ends["lo"] is None:
        return ids.select("id", F.col("id").alias("next"))
    # Numbered from the smallest group's, so that numbers shrink to 0 from level to level, those of negative ids too.
    group = F.shiftright("id", GROUP_BITS) - F.lit(ends["lo"] >> GROUP_BITS)
    if ends["lo"] >> GROUP_BITS == ends["hi"] >> GROUP_BITS:
        lead = F.lead("id").over(Window.partitionBy(group).orderBy("id"))
        return ids.select("id", F.coalesce(lead, F.lit(ends["lo"])).alias("next"))
    firsts = ids.groupBy(group.alias("g")).agg(F.min("id").alias("first"))
    after = successors(firsts.select(F.col("g").alias("id"))).select(F.col("id").alias("g"), F.col("next").alias("ng"))
    after = after.join(firsts.select(F.col("g").alias("ng"), "first"), "ng").select("g", "first")
    lead = F.lead("id").over(Window.partitionBy("g").orderBy("id"))
    return ids.withColumn("g", group).withColumn("lead", lead).join(after, "g").select("id", F.coalesce("lead", "first").alias("next"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how like they are to it and to the next document.

    The edited text has its last quarter (code points, rounded down) replaced by the first as many of the next
    document's. The next document is that with the next larger doc_id, after the last the first; rows with equal
    doc_ids follow each other in the order of their texts, and a row without one counts as -1. Null texts are empty; a text
    without a letter or digit has an empty fingerprint. An empty table gives an empty result; other columns are not
    read.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), key.alias("k"))
    own = own.withColumn("g", F.shiftright("k", GROUP_BITS)).withColumn("guest", F.lit(False))
    # The first document of the next group visits, to be the next of the group's last.
    firsts = own.groupBy("g").agg(F.min("k").alias("k"))
    after = successors(firsts.select(F.col("g").alias("id")))
    # Written down, so that its size is known and a small one is broadcast instead of shuffling the texts to it.
    visits = stored(after.join(firsts.select(F.col("g").alias("next"), "k"), "next").select("k", F.col("id").alias("g")), "visits")
    guests = own.drop("g", "guest").join(visits, "k").groupBy("k", "g").agg(F.min("text").alias("text"))
    guests = guests.withColumns({"doc_id": F.lit(None).cast("long"), "guest": F.lit(True)})
    order = ["g", "guest", "k", "text"]
    rows = own.unionByName(guests).repartition("g").sortWithinPartitions(*order)
    rows = with_fingerprint(rows, "text", "fp")
    following = Window.partitionBy("g").orderBy(*order[1:])
    rows = rows.withColumn("next_text", F.lead("text").over(following)).withColumn("next_fp", F.lead("fp").over(following))
    rows = rows.where(~F.col("guest")).withColumn("n_chars", F.length("text").cast("long"))
    taken = F.floor(F.col("n_chars") / 4).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - taken)
    rows = rows.withColumn("edited", F.concat(kept, F.substring(F.col("next_text"), F.lit(1), taken)))
    rows = with_fingerprint(rows.drop("next_text"), "edited", "efp")
    hashes = {c: F.array_distinct(F.transform(c, lambda x: F.shiftright(x, 32))) for c in ("fp", "efp", "next_fp")}
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256)).withColumn("fingerprint", printed("fp"))
    rows = rows.withColumn("edited_fingerprint", printed("efp")).withColumns(hashes)
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fp", "efp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"),
    )


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
