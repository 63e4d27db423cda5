"""Document fingerprints by winnowing, with DataFrame functions alone.

The words of a text, lower-cased, give overlapping grams of `k` words, each with a
rolling hash built from its words' hashes. Of every window of `w` grams the smallest
hash is chosen, the rightmost among equals, and its place among the grams is kept.
Two texts that share w + k - 1 words in a row therefore share a chosen gram.

Hash and place share one long, the place complemented, so that the smallest long is
the rightmost smallest hash; window minima come from log2(w) passes over an array.

Defined cases: a null text counts as empty and has an empty fingerprint. A text of
fewer than k words has one gram, one of fewer than w grams one window. Two empty
fingerprints are alike (1), an empty one and another are not (0). An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import text_of

PLACE_BITS = 30
PLACES = (1 << PLACE_BITS) - 1
HASHES = (1 << (63 - PLACE_BITS)) - 1


def with_marks(df: DataFrame, text_col: str, out: str, k: int = 3, w: int = 4) -> DataFrame:
    """Adds `out`: the chosen (hash, place) pairs of a text, packed in longs, in the order of their windows."""
    step = f"_{out}"
    df = df.withColumn(step, F.array_remove(F.split(F.lower(text_col), r"\s+"), ""))
    df = df.withColumn(f"{step}_words", F.transform(step, lambda word: F.xxhash64(word))).drop(step)
    df = df.withColumn(step, F.col(f"{step}_words"))
    for i in range(1, k):
        df = df.withColumn(step, F.expr(f"zip_with({step}, {_from(step + '_words', i)}, (x, y) -> xxhash64(x, y))"))
    # Grams that begin too near the end to be whole are cut off.
    df = df.withColumn(step, F.expr(f"slice({step}, 1, least(size({step}), greatest(size({step}) - {k - 1}, 1)))"))
    packed = f"shiftleft(x & {HASHES}L, {PLACE_BITS}) | ({PLACES}L - i)"
    df = df.withColumn(step, F.expr(f"transform({step}, (x, i) -> {packed})")).drop(f"{step}_words")
    reach = 1
    while reach < w:
        hop = min(reach, w - reach)
        df = df.withColumn(step, F.expr(f"zip_with({step}, {_from(step, hop)}, (x, y) -> least(x, y))"))
        reach += hop
    df = df.withColumn(step, F.expr(f"slice({step}, 1, least(size({step}), greatest(size({step}) - {w - 1}, 1)))"))
    return df.withColumn(out, F.array_distinct(step)).drop(step)


def _from(array: str, start: int) -> str:
    return f"slice({array}, {start + 1}, greatest(size({array}) - {start}, 0))"


def written(marks: str | Column) -> Column:
    """Chosen grams as text: hash in hexadecimal and place, space-separated."""
    entry = lambda m: F.concat_ws(":", F.hex(F.shiftright(m, PLACE_BITS)), (F.lit(PLACES) - m.bitwiseAND(F.lit(PLACES))).cast("string"))
    return F.array_join(F.transform(marks, entry), " ")


def hashes(marks: str) -> Column:
    return F.array_distinct(F.transform(marks, lambda m: F.shiftright(m, PLACE_BITS)))


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two arrays of distinct hashes."""
    shared = F.size(F.array_intersect(a, b))
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 1.0).otherwise(shared / (both - shared))


def with_next(docs: DataFrame, per_partition: int = 4) -> DataFrame:
    """(id, text, next_text): every document with the following one by ascending id, the first after the last.

    Ids are cut into buckets of equal width, a few for each shuffle partition, and
    neighbours are found within buckets. The last row of a bucket gets the first row
    of the next bucket that has rows through a join with one row a bucket.
    Equal ids follow each other by a hash of their text; null ids come first.
    """
    spark = docs.sparkSession
    lo, hi = docs.agg(F.min("id"), F.max("id")).first()
    buckets = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = ((hi or 0) - (lo or 0)) // buckets + 1
    bucket = F.coalesce(F.floor((F.col("id") - F.lit(lo or 0)) / F.lit(width)), F.lit(-1))
    dealt = docs.withColumn("bucket", bucket).repartition(F.col("bucket"))
    order = Window.partitionBy("bucket").orderBy("id", F.xxhash64("text"))
    inner = dealt.withColumn("next_text", F.lead("text").over(order)).filter("next_text is not null")
    last = dealt.withColumn("_after", F.lead(F.lit(1)).over(order)).filter("_after is null").drop("_after")
    first = dealt.withColumn("_n", F.row_number().over(order)).filter("_n = 1").select("bucket", F.col("text").alias("next_text"))
    # At most `buckets` rows and one for null ids, whatever the table holds.
    by_bucket = Window.orderBy("bucket")
    whole = by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follower = F.coalesce(F.lead("bucket").over(by_bucket), F.first("bucket").over(whole))
    hops = last.select("bucket").withColumn("follower", follower)
    outer = last.join(hops, "bucket").join(first.withColumnRenamed("bucket", "follower"), "follower")
    columns = ["id", "text", "next_text"]
    return inner.select(columns).unionByName(outer.select(columns))


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, w: int = 4) -> DataFrame:
    """Fingerprint every text and its edited form, and hold it against that and against the next document.

    The edited text has its last half replaced by as much of the next document's beginning.
    Ids are integers.
    """
    rows = with_next(docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")))
    half = F.expr("int(n_chars div 2)")
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.withColumn("edited", F.concat(F.left("text", F.expr("int(n_chars - n_chars div 2)")), F.left("next_text", half)))
    for text, out in (("text", "own"), ("edited", "changed"), ("next_text", "following")):
        rows = with_marks(rows, text, out, k, w)
    rows = rows.withColumns({f"{c}_set": hashes(c) for c in ("own", "changed", "following")})
    return rows.select(
        F.col("id").alias(id_col),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        written("own").alias("fingerprint"),
        written("changed").alias("edited_fingerprint"),
        likeness("own_set", "changed_set").alias("near_edited"),
        likeness("own_set", "following_set").alias("near_next"),
    )
