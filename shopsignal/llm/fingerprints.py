"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A text's sketch is the ``k`` smallest distinct hashes of its five-word
shingles (A-Z lower-cased; fewer words: the whole sequence is one shingle).
Sketches of parts merge into the sketch of the whole, and two sketches
estimate resemblance, containment and the number of distinct shingles.  A
sketch with fewer than ``k`` hashes holds every shingle, so its figures are
exact.  Built-in expressions only.

Defined cases: a null or empty text, or one without words, has the empty
sketch; two empty sketches are alike (1.0), an empty and another are not
(0.0).  Equal texts have equal sketches.  Columns other than doc_id and text
are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, order_buckets, split_words, text_or_empty, window_hashes

K = 128
SHINGLE = 5
HASH_BITS = 32
NO_HASHES = "array<bigint>"


def shingle_hashes(df: DataFrame, text: str, out: str, width: int = SHINGLE) -> DataFrame:
    """``df`` plus ``out``: the hashes (0 to 2**32 - 1, as long) of the text's shingles, repeats included."""
    words, hashes = f"__{out}_words", f"__{out}_hashes"
    df = df.withColumn(words, split_words(ascii_lower(F.col(text))))
    df = df.withColumn(hashes, F.transform(F.col(words), lambda w: F.xxhash64(w)))
    whole = F.when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array().cast(NO_HASHES))
    shingles = F.when(F.size(words) < width, whole).otherwise(window_hashes(F.col(hashes), width))
    return df.withColumn(out, F.transform(shingles, lambda h: h.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))).drop(words, hashes)


def bottom_k(hashes: Column, k: int = K) -> Column:
    """The sketch of an array of shingle hashes: its ``k`` smallest distinct values, ascending."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the shingles of both parts (a shingle that spans the cut belongs to neither)."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated shared part of all distinct shingles (0 to 1)."""
    both = merge(a, b, k)
    shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles (exact below ``k``)."""
    kth = (F.element_at(a, k) + 1) / F.lit(float(1 << HASH_BITS))
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / kth)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated part of a's distinct shingles that b also has (0 to 1; an empty a is contained)."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def render(a: Column) -> Column:
    """The sketch as text: eight hex digits a hash, ascending."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")), "")


def fingerprint(df: DataFrame, text: str, out: str, k: int = K) -> DataFrame:
    return shingle_hashes(df, text, f"__{out}_sh").withColumn(out, bottom_k(F.col(f"__{out}_sh"), k)).drop(f"__{out}_sh")


# ---------------------------------------------------------------- the next document
def with_next_text(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, next_text, <order columns>)``: each text beside the next in ascending doc_id order.

    Order: doc_id (nulls last), then text; after the last row comes the first.
    The rows are cut into contiguous buckets, one shuffle brings each bucket
    together, and every bucket also gets a copy of the first row of the one
    that follows, so no global sort and no single-task window over the rows are needed.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", text_or_empty(F.col("text")).alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = order_buckets(docs, 3 * n)  # several buckets a task even out
    # Of each bucket the first row's key: at most a few rows per cut point.
    firsts = docs.groupBy("r", "sub").agg(F.min(F.struct("doc_id", "text_hash")).alias("f"))
    order = Window.orderBy("r", "sub")
    overall = Window.orderBy("r", "sub").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = firsts.select(
        "r", "sub", F.coalesce(F.lead("f").over(order), F.first("f").over(overall)).alias("f")
    )
    # Rows with equal (doc_id, hash) have equal texts; one of them stands for the bucket's successor.
    keys = firsts.select(F.col("f.doc_id").alias("fd"), F.col("f.text_hash").alias("fh")).distinct()
    texts = (
        docs.join(F.broadcast(keys),
                  F.col("doc_id").eqNullSafe(F.col("fd")) & (F.col("text_hash") == F.col("fh")))
        .groupBy("fd", "fh").agg(F.min("text").alias("text"))
    )
    guards = follows.join(
        texts, F.col("f.doc_id").eqNullSafe(F.col("fd")) & (F.col("f.text_hash") == F.col("fh"))
    ).select(F.lit(None).cast("bigint").alias("doc_id"), "text", "fh", "r", "sub", F.lit(1).alias("guard"))
    rows = docs.withColumn("guard", F.lit(0)).unionByName(guards.withColumnRenamed("fh", "text_hash"))
    in_bucket = Window.partitionBy("r", "sub").orderBy("guard", "doc_id", "text_hash")
    return rows.withColumn("next_text", F.lead("text").over(in_bucket))


def edited_text(text: Column, next_text: Column, n_chars: Column) -> Column:
    """The last floor(n/2) code points replaced by the first as many (or all) of the next text."""
    half = F.floor(n_chars / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n_chars - half).cast("int")), F.substring(next_text, F.lit(1), half))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = fingerprint(with_next_text(docs), "text", "sketch")
    in_bucket = Window.partitionBy("r", "sub").orderBy("guard", "doc_id", "text_hash")
    rows = rows.withColumn("next_sketch", F.lead("sketch").over(in_bucket)).filter("guard = 0")
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.withColumn("edited", edited_text(F.col("text"), F.col("next_text"), F.col("n_chars")))
    rows = rows.select("doc_id", "n_chars", "edited", "sketch", "next_sketch")
    rows = fingerprint(rows, "edited", "edited_sketch")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        render(F.col("sketch")).alias("fingerprint"), render(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_shingles(F.col("sketch")).alias("distinct_shingles"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_in_text"),
    )
