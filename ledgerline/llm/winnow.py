"""Document fingerprints by winnowing.

The tokens of a text are its words between white space, longer ones cut
every ``PIECE`` characters. Every ``GRAM`` tokens in a row have a hash; of
each ``WINDOW`` neighbouring grams the one with the least hash is kept, the
rightmost of equal ones, with its place. Two texts that share GRAM + WINDOW
- 1 tokens in a row share a kept gram. Hash and place are packed into one
long (hash above, reversed place below), so that a plain minimum also
settles ties; the minimum of a window is built by doubling (2, 4, 8 grams).

Only DataFrame functions are used. The arrays of a text are some 40 times
its size, one text at a time; what is kept is a small share of it.

A text of fewer tokens than a gram is one gram; of fewer grams than a
window, one window. Null, empty or blank text has no gram: its fingerprint
is empty, its likeness 1 to another empty one, else 0. Extra columns are
kept by ``fingerprint`` and ignored by ``compare_edits``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE, GRAM, WINDOW = 8, 3, 8
#: Fine ranges of ids that neighbours are found in, at most (COARSE x FINE).
COARSE, FINE = 64, 64
_LAST = (1 << 31) - 1


def _once(value: Column, work) -> Column:
    """``work`` on a value that is computed once."""
    return F.transform(F.array(value), work)[0]


def marks(text: Column) -> Column:
    """Kept grams in the order of their windows: hash * 2^32 + 2^31 - 1 - place."""
    token = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"\S{{1,{PIECE}}}"), F.lit(0)),
                        lambda t: F.xxhash64(t))
    kept = _once(token, lambda p: F.when(F.size(p) > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(p) - GRAM, F.lit(0))),
        lambda i: F.shiftleft(F.xxhash64(*[F.get(p, i + k) for k in range(GRAM)]), 32).bitwiseOR(
            (F.lit(_LAST) - i).cast("long")))).otherwise(F.array().cast("array<bigint>")))
    width = 1
    while width < WINDOW:
        kept = _once(kept, lambda p: F.transform(p, lambda x, i: F.least(x, F.get(p, i + F.lit(width)))))
        width *= 2
    return F.array_distinct(_once(kept, lambda p: F.slice(p, F.lit(1), F.greatest(F.size(p) - (WINDOW - 1), F.lit(1)))))


def hashes(kept: Column) -> Column:
    return F.array_distinct(F.transform(kept, lambda x: F.shiftright(x, 32).cast("int")))


def written(kept: Column) -> Column:
    """hash@place of each kept gram (places in tokens, from 0)."""
    return F.array_join(F.transform(kept, lambda x: F.concat(
        F.lower(F.hex(F.shiftrightunsigned(x, 32))), F.lit("@"),
        (F.lit(_LAST) - x.bitwiseAND(F.lit(_LAST).cast("long"))).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared among all distinct hashes of two fingerprints."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with its fingerprint as text."""
    return docs.withColumn(out, written(marks(F.col(text))))


def with_next(docs: DataFrame, work) -> DataFrame:
    """``docs(doc_id, text)`` after ``work`` with next_text and next_kept of
    the following row in descending doc_id (null last, equal ids in the
    order of a hash of their text; after the last comes the first).

    Ids are cut into ranges of about as many rows each; a range's largest
    id is also sent to the range above it, whose smallest id it follows, and
    the largest of all to the lowest range. So texts cross one shuffle and
    no range needs another."""
    spark = docs.sparkSession
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    want = min(COARSE * FINE, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = docs.agg(F.percentile_approx(key, [i / want for i in range(1, want)] or [0.5], 20 * want)).first()[0] or []
    cuts = sorted(set(cuts))
    step = max(1, -(-len(cuts) // COARSE))
    array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs]) if xs else F.array().cast("array<bigint>")
    below = lambda xs: F.size(F.filter(xs, lambda x: x < key))
    head = below(array(cuts[::step]))
    fine = F.slice(array(cuts), F.greatest(head - 1, F.lit(0)) * step + 1, F.lit(step))
    docs = docs.withColumn("at", F.greatest(head - 1, F.lit(0)) * step + below(fine))
    tops = sorted((r.at, r.top) for r in docs.groupBy("at").agg(F.max(key).alias("top")).collect())  # one a range
    to = [(at, top, tops[(i + 1) % len(tops)][0]) for i, (at, top) in enumerate(tops)]
    also = F.broadcast(spark.createDataFrame(to, "at int, top long, above int"))
    dealt = docs.join(also, "at").withColumn("to", F.explode(
        F.when(key == F.col("top"), F.array(F.struct(F.col("at").alias("at"), F.lit(0).alias("ghost")),
                                            F.struct(F.col("above").alias("at"), F.lit(1).alias("ghost"))))
        .otherwise(F.array(F.struct(F.col("at").alias("at"), F.lit(0).alias("ghost")))))) \
        .select("doc_id", "text", F.col("to.at").alias("at"), F.col("to.ghost").alias("ghost"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = work(dealt.repartition(parts, "at"))
    order = Window.partitionBy("at").orderBy("ghost", F.coalesce("doc_id", F.lit(-(1 << 63))).desc(), F.xxhash64("text"))
    return ranged.withColumn("next_text", F.lead("text").over(order)) \
        .withColumn("next_kept", F.lead("kept").over(order)).where("ghost = 0").drop("at", "ghost")


def compare_edits(docs: DataFrame) -> DataFrame:
    """Each text beside its edited text, whose last half is taken from the
    next document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(rows, lambda d: d.withColumn("kept", marks(F.col("text"))))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("edited_kept", marks(F.col("edited"))) \
        .withColumn("own", hashes(F.col("kept")))
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("kept")).alias("fingerprint"), written(F.col("edited_kept")).alias("edited_fingerprint"),
        likeness(F.col("own"), hashes(F.col("edited_kept"))).alias("near_edited"),
        likeness(F.col("own"), hashes(F.col("next_kept"))).alias("near_next"))
