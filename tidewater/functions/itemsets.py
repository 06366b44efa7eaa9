"""The most frequent triples of items over all baskets, exactly, by support-bounded candidates.

Expanding the triples of every basket is cubic in its size.  A triple is in no more baskets than its
rarest pair, and a pair in no more than its rarer item, so for a support s only items, then pairs, then
triples of s baskets and more need to be looked at.  The support starts at the third most frequent item
(no triple can have more) and goes down by steps until k triples reach it; rare items, the bulk, are
met only if frequent ones do not suffice.

* If all triples are few, at most LINEAR for each row, they are formed and counted in one pass.
* Pairs of a basket are formed in the row that holds its items or, if it has more than BLOCK, in cells
  of at most BLOCK x BLOCK items, so a basket of any size is spread over many tasks.
* A triple (a, b, c) of a basket is formed only from its pairs (a, b), (a, c) and (b, c) that all reach
  the support.
* If fewer than k triples are in two baskets, the rest of the answer are triples of one basket.  Those
  are the smallest by item; a basket's smallest triples lie among its smallest items, so each basket
  brings a bounded number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.common import top_k
from tidewater.functions.joins import join_by_share
from tidewater.sources.results import scratch

#: Items of a basket that are paired in one cell, and the factor by which the support goes down.
BLOCK, STEP = 256, 4
#: Triples for each row up to which all of them are formed.
LINEAR = 8


def _in_rows(rows: DataFrame) -> DataFrame:
    """(basket, items, a, rest): each item of a basket with the larger ones.  For baskets of bounded size."""
    held = rows.groupBy("basket").agg(F.sort_array(F.collect_list("item")).alias("items"))
    each = held.select("basket", "items", F.posexplode("items").alias("i", "a"))
    return each.select("basket", "a", F.expr("slice(items, i + 2, size(items))").alias("rest"))


def basket_pairs(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(basket, a, b) with a < b for all pairs of items of a basket; ``rows`` has (basket, item), distinct."""
    sizes = rows.groupBy("basket").agg(F.count(F.lit(1)).alias("size"))
    if sizes.filter(F.col("size") > block).isEmpty():
        return _in_rows(rows).select("basket", "a", F.explode("rest").alias("b"))
    sizes = scratch(sizes, "itemset-sizes")
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("item"), blocks).cast("int")
    sized = join_by_share(rows, sizes, ["basket"], "size").withColumn("own", own)
    small = _in_rows(sized.filter(F.col("size") <= block).select("basket", "item")).select("basket", "a", F.explode("rest").alias("b"))
    cells = sized.filter(F.col("size") > block).select("basket", "item", "own", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    left = cells.filter(F.col("own") == lo).select("basket", lo.alias("lo"), hi.alias("hi"), F.col("item").alias("x"))
    right = cells.filter(F.col("own") == hi).select("basket", lo.alias("lo"), hi.alias("hi"), F.col("item").alias("y"))
    met = left.join(right, ["basket", "lo", "hi"]).filter((F.col("lo") < F.col("hi")) | (F.col("x") < F.col("y")))
    return small.unionByName(met.select("basket", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))


def all_triples(rows: DataFrame) -> DataFrame:
    """(a, b, c, n) for every triple a < b < c; ``rows`` has (basket, item), distinct."""
    two = _in_rows(rows).select("rest", "a", F.posexplode("rest").alias("i", "b"))
    three = two.select("a", "b", F.explode(F.expr("slice(rest, i + 2, size(rest))")).alias("c"))
    return three.groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n"))


def frequent_triples(rows: DataFrame, support: int, block: int = BLOCK) -> DataFrame:
    """(a, b, c, n) for the triples a < b < c that at least ``support`` baskets hold."""
    items = rows.groupBy("item").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= support)
    kept = scratch(join_by_share(rows, scratch(items, "itemset-items"), ["item"], "n").select("basket", "item"), "itemset-rows")
    pairs = basket_pairs(kept, block)
    often = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= support)
    edges = scratch(join_by_share(pairs, scratch(often, "itemset-pairs"), ["a", "b"], "n").select("basket", "a", "b"), "itemset-edges")
    wings = edges.join(edges.withColumnRenamed("b", "c"), ["basket", "a"]).filter(F.col("b") < F.col("c"))
    closed = wings.join(edges.select("basket", F.col("a").alias("b"), F.col("b").alias("c")), ["basket", "b", "c"])
    return closed.groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= support)


def smallest_triples(rows: DataFrame, k: int) -> DataFrame:
    """(a, b, c): a superset of the k smallest triples, by item, that any basket holds.

    A basket's k smallest triples are formed of its k + 2 smallest items; the filter on the rank trims
    baskets to those before they are shuffled.
    """
    place = F.row_number().over(Window.partitionBy("basket").orderBy("item"))
    few = rows.withColumn("place", place).filter(F.col("place") <= k + 2).groupBy("basket").agg(F.sort_array(F.collect_list("item")).alias("items"))
    two = few.filter(F.size("items") >= 3).select("items", F.posexplode("items").alias("i", "a"))
    two = two.select("items", "a", F.explode(F.slice("items", F.col("i") + 2, F.lit(k + 2))).alias("b"))
    three = two.select("a", "b", F.explode(F.filter("items", lambda x: x > F.col("b"))).alias("c"))
    return top_k(three.distinct(), k, [F.asc("a"), F.asc("b"), F.asc("c")])


def top_triples(baskets: DataFrame, basket: str, item: str, k: int = 1, block: int = BLOCK, step: int = STEP,
                linear: int = LINEAR) -> DataFrame:
    """(a, b, c, n): the k triples of items a < b < c that most baskets hold, ties to the smaller items.

    A basket counts once whatever it repeats; NULL items and baskets are left out.  Fewer rows come
    back if there are fewer triples.
    """
    rows = baskets.select(F.col(basket).alias("basket"), F.col(item).alias("item")).filter("basket is not null and item is not null").distinct()
    rows = scratch(rows, "itemset-baskets")
    best = [F.desc("n"), F.asc("a"), F.asc("b"), F.asc("c")]
    size = F.col("size").cast("decimal(38,0)")
    held = rows.groupBy("basket").agg(F.count(F.lit(1)).alias("size")).agg(
        F.sum("size").alias("rows"), F.max("size").alias("most"), F.sum(size * (size - 1) * (size - 2) / 6).alias("triples")).first()
    if held["rows"] is None or (held["most"] <= block and held["triples"] <= linear * held["rows"]):
        return top_k(all_triples(rows), k, best)
    most = rows.groupBy("item").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(3).collect()
    support = max(2, most[2].n if len(most) == 3 else 2)
    while True:
        found = scratch(top_k(frequent_triples(rows, support, block), k, best), "itemset-triples")
        have = found.count()  # k at most
        if have == k or support == 2:
            break
        support = max(2, support // step)
    if have < k:
        known = found.select("a", "b", "c")
        single = smallest_triples(rows, k + have).join(F.broadcast(known), ["a", "b", "c"], "left_anti")
        single = top_k(single.withColumn("n", F.lit(1).cast("bigint")), k - have, best)
        found = found.unionByName(single)
    return top_k(found, k, best)
