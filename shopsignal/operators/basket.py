"""

``frequency(a, b)`` = number of baskets (sessions) that contain both items,
over purchases only, for every unordered pair with ``item_1 < item_2``.

A basket of n items yields n(n-1)/2 pairs, so the output of one basket grows
quadratically while its input does not: a basket that looks harmless to
AQE's byte-based skew detection can still emit billions of pairs in one task.
The plan bounds the pair work of every task, is fully lazy, and has one shape
at every size:

1. One partially aggregated row count per basket gives the largest basket's
   rows, an upper bound of its distinct items.  The plan reads that one number
   as a scalar subquery and sends the rows down one of two ways; the other
   way gets no rows, and AQE drops its joins.
2. No basket beyond ``block_size`` rows (the usual case): each basket's set of
   items is built partially in every map task, so repeats are never shuffled,
   and merged behind one shuffle on the basket.
3. Otherwise repeats are removed first, with a shuffle on (basket, item).
   Baskets with more than ``block_size`` distinct items, counted exactly, are
   cut into blocks by item hash, any other basket is one block, and a shuffle
   on (basket, block) gathers each block's items.
4. A block's items are one sorted array, and its pairs come straight from it:
   every item with those after it, so exactly n(n-1)/2 candidates are made.  Two blocks of a big basket
   meet by an equi-join on (basket, later block) and pair each item of one with
   each of the other.
5. ``groupBy(item_1, item_2).count()`` with map-side partial aggregation.

No rows are dropped or capped.  ``min_support`` above 1 first drops items that
too few baskets hold, which no frequent pair can contain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import KEY_BUCKETS, key_bucket
from ..schemas import PURCHASE

DEFAULT_BLOCK_SIZE = 1024


def purchase_items(clean: DataFrame, basket: str = "session_id", item: str = "product_id") -> DataFrame:
    """(basket, item) of purchase events."""
    return clean.filter(F.col("event_type") == PURCHASE).select(basket, item)


def _known(items: DataFrame, basket: str, item: str) -> DataFrame:
    """Rows with a basket and an item; the others take no part."""
    return items.select(basket, item).where(F.col(basket).isNotNull() & F.col(item).isNotNull())


def session_items(items: DataFrame, basket: str = "session_id", item: str = "product_id") -> DataFrame:
    """A6 / U2 as rows: the distinct ``(basket, item)``, at any basket size."""
    return _known(items, basket, item).distinct()


def session_baskets(items: DataFrame, basket: str = "session_id", item: str = "product_id") -> DataFrame:
    """The item set of every basket as one sorted array, ``(basket, items)``.

    Built on two levels: a shuffle on (basket, item) removes repeats, so the
    rows of a hot basket are spread over all tasks, and the task that
    gathers a basket receives each of its distinct items once.  One row a basket, whatever
    its size; jobs that do not need the arrays use ``session_items``.
    """
    distinct = session_items(items, basket, item)
    sets = distinct.groupBy(basket).agg(F.collect_list(item).alias("items"))
    return sets.select(basket, F.sort_array("items").alias("items"))


# One statement is analysed once, where a chain of DataFrame calls is analysed at every call.  Grouping the sizes by a
# bucket of the basket too gives the join its own shuffle (plans.joins.key_bucket); the repartition deals a big basket
# to many tasks even after that join on the basket.
_BASKET_PAIRS = """
with largest as (
  select coalesce(max(n), 0) as n from (select count(1) as n from {known} group by basket)),
sets as (
  select basket, sort_array(collect_set(item)) as items
  from {known} where (select n from largest) <= {block_size} group by basket),
distinct_rows as (
  select distinct basket, item from {known} where (select n from largest) > {block_size}),
sizes as (
  select basket, count(1) as n from distinct_rows group by basket, pmod(xxhash64(basket), {buckets})),
big as (
  select basket, cast(ceil(n / {block_size}) as int) as n_blocks from sizes where n > {block_size}),
tagged as (
  select r.basket, item, coalesce(n_blocks, 1) as n_blocks,
         cast(pmod(xxhash64(item), coalesce(n_blocks, 1)) as int) as block
  from distinct_rows r left join big on r.basket = big.basket),
blocks as (
  select basket, n_blocks, block, sort_array(collect_list(item)) as items
  from (select /*+ repartition(basket, block) */ * from tagged) group by basket, n_blocks, block),
within as (
  select basket, item_1, explode(slice(items, place + 2, size(items))) as item_2
  from (select basket, items, posexplode(items) as (place, item_1)
        from (select basket, items from sets union all select basket, items from blocks))),
earlier as (
  select basket, items as low, explode(sequence(block + 1, n_blocks - 1)) as block from blocks where block < n_blocks - 1),
across as (
  select basket, a, explode(high) as z
  from (select e.basket, b.items as high, explode(low) as a from earlier e join blocks b on e.basket = b.basket and e.block = b.block))
select basket, item_1, item_2 from within
union all select basket, least(a, z), greatest(a, z) from across
"""


def basket_pairs(items: DataFrame, basket: str = "session_id", item: str = "product_id",
                 block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """Every unordered pair of distinct items per basket, ``(basket, item_1, item_2)``.

    Rows with a null basket or item take no part.
    """
    known = _known(items, basket, item).select(F.col(basket).alias("basket"), F.col(item).alias("item"))
    pairs = items.sparkSession.sql(_BASKET_PAIRS, known=known, buckets=KEY_BUCKETS, block_size=block_size)
    return pairs.withColumnRenamed("basket", basket)


def _frequent(items: DataFrame, basket: str, item: str, min_support: int) -> DataFrame:
    """Rows of items that at least ``min_support`` baskets hold."""
    support = session_items(items, basket, item).groupBy(item, key_bucket(item)).agg(F.count(F.lit(1)).alias("_n"))
    return items.join(support.filter(F.col("_n") >= min_support).select(item), item, "left_semi")


def pair_frequencies(items: DataFrame, basket: str = "session_id", item: str = "product_id", min_support: int = 1,
                     block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``(item_1, item_2, frequency)`` over all pairs, no order."""
    if min_support > 1:
        items = _frequent(items, basket, item, min_support)
    pairs = basket_pairs(items, basket, item, block_size)
    freq = pairs.groupBy("item_1", "item_2").agg(F.count(F.lit(1)).alias("frequency"))
    return freq.filter(F.col("frequency") >= min_support) if min_support > 1 else freq


def market_basket_pairs(clean: DataFrame, min_support: int = 1, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """Pair frequencies of products bought in the same session."""
    return pair_frequencies(purchase_items(clean), min_support=min_support, block_size=block_size)


def top_pairs(pairs: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent pairs, ties by item names (plans as TakeOrderedAndProject)."""
    return pairs.orderBy(F.col("frequency").desc(), "item_1", "item_2").limit(n)
