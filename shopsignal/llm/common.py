"""Column builders and small helpers the training-data operators share."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# The white space that separates words everywhere here: space and \x09-\x0D.
WHITE_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """``documents`` of a data folder, pruned to ``columns``."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def split_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a non-null text, in order (none: an empty array)."""
    trimmed = F.btrim(text, F.lit(WHITE_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \t-\r]+"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def window_hashes(hashes: Column, width: int) -> Column:
    """64-bit hashes of every ``width`` consecutive elements of an array of element hashes (fewer: empty)."""
    return F.when(
        F.size(hashes) >= width,
        F.transform(
            F.slice(hashes, F.lit(1), F.size(hashes) - (width - 1)),
            lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, width)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32(doc_id as text) mod ``modulus`` is ``remainder``; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == remainder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back.

    Later steps read the files, so an executor lost afterwards costs a re-read
    and never a recomputation, and values drawn while writing (row ids) stay.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def identified(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` as rows of files, which have a place that every read of them gives again (written first if they are none)."""
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
        return docs
    except AnalysisException:
        return written(docs, name)


def order_buckets(docs: DataFrame, n: int, key: str = "doc_id", tie: str = "text_hash") -> DataFrame:
    """``docs`` with columns ``(r, sub)`` that cut its ascending order (``key`` nulls last, ``tie``) into contiguous buckets.

    ``key`` and ``tie`` are long columns.  ``n`` cut points of the key come
    from one aggregate of that column, so about ``n`` buckets hold near equal
    rows.  Rows equal to a cut point have a bucket of their own, cut again by
    the top bits of ``tie`` (six, and more for many cut points), so a key that
    many rows share (or a null one) spreads too.  Where rows equal in key *and*
    tie are more than a bucket's share (at most ``n`` such pairs), those are
    dealt over as many buckets by their place in the files; the order among
    them is that of the buckets.  Only a key with more rows than that makes
    the search for such pairs read the table again.
    """
    accuracy, bits = max(10_000, 10 * n), max(6, n.bit_length() - 2)
    cuts = docs.agg(F.percentile_approx(key, [(i + 1) / (n + 1) for i in range(n)], accuracy).alias("c")).first()["c"]
    cuts = sorted(set(cuts or []))
    k, t = F.col(key), F.col(tie)
    if cuts:
        # How many cut points lie below the key, by binary search.
        points = F.lit(cuts).cast("array<bigint>")
        halves = F.lit([1 << i for i in reversed(range(len(cuts).bit_length()))]).cast("array<int>")
        below = F.aggregate(halves, F.lit(0), lambda n, half: n + F.when(F.get(points, n + half - 1) < k, half).otherwise(0))
        r = F.when(k.isNull(), 2 * len(cuts) + 1).otherwise(2 * below + F.when(k.isin(cuts), 1).otherwise(0))
    else:
        r = F.when(k.isNull(), 1).otherwise(0)
    r = r.cast("int")
    # Shifted, the signed hash keeps its order.
    top_bits = lambda h: F.shiftright(h, 64 - bits) + (1 << (bits - 1))
    sub = F.when(r % 2 == 1, top_bits(t)).otherwise(0)
    if hot := _hot_pairs(docs.select(r.alias("r"), t.alias("t")), n):
        docs = identified(docs, "order_rows")
        place = docs.metadataColumn("_metadata")
        ties = F.coalesce(*[F.when(r == i, F.lit(sorted(h)).cast("array<bigint>")) for i, h in hot.items()],
                          F.array().cast("array<bigint>"))
        # Twice the pairs before this row's, and one for a row of such a pair: ascending as the tie is.
        level = F.aggregate(ties, F.lit(0), lambda n, h: n + F.when(h < t, 2).when(h == t, 1).otherwise(0)).cast("long")
        dealt = top_bits(F.xxhash64(place["file_path"], place["row_index"]))
        sub = F.shiftleft(level, bits) + F.when(level % 2 == 1, dealt).otherwise(sub)
    return docs.withColumns({"r": r, "sub": sub.cast("long")})


def _hot_pairs(docs: DataFrame, n: int) -> dict[int, list[int]]:
    """``{r: ties}`` of the pairs ``(r, t)``, r odd (one key), that more than an ``n``-th of all rows share."""
    rows = {x["r"]: x["count"] for x in docs.groupBy("r").count().collect()}  # at most two a cut point
    share = sum(rows.values()) / n
    heavy = [r for r, count in rows.items() if r % 2 == 1 and count > share]
    found: dict[int, list[int]] = {}
    if heavy:
        pairs = docs.filter(F.col("r").isin(heavy)).groupBy("r", "t").count().filter(F.col("count") > share)
        for x in pairs.collect():  # fewer than n
            found.setdefault(x["r"], []).append(x["t"])
    return found


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python of the tasks, once per application.

    A driver that found the package in its working folder or on a path of its
    own may have executors that do not; the sources go to the shared folder
    and from there to every executor (``addPyFile``).
    """
    sc = spark.sparkContext
    root = Path(__file__).parents[1]
    if sc.applicationId in _SHIPPED or not root.is_dir():
        return
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent).as_posix())
    path = scratch_path(spark, f"{root.name}.zip")
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(held.getvalue()))
    finally:
        out.close()
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
