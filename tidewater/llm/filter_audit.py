"""Interaction audit of document filters by exact constrained least squares (operator 11).

Filters applied one after the other hide each other: what a filter removes depends on the filters
in front.  Every answer follows from one small table, the documents removed by each coalition
(subset) of filters:

1. every document gets the bit mask of the filters it fails; masks are counted per part, labels
   apart, so the corpus becomes at most 2**m cells a part and label;
2. the cells give v(S), the documents that a coalition S removes, for all 2**m coalitions;
3. a step of an order removes v(before and filter) - v(before): differences of coalitions;
4. the Shapley values minimise the sum of k(S) * (v(S) - sum of the values in S)^2 with the Shapley
   kernel k, under the constraint that they add up to v(all).  The normal equations of this
   constrained least-squares problem are solved in rational numbers, so the values are exact.

The duplicate filter needs no meeting of equal texts: the first of every text is found by an
aggregate with partial aggregation, and rows ask for it by their own id and digest.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, pick, written

#: The classes of characters of the filters.
SPACES, SYMBOLS, CAPITALS = r"[\x20\x09-\x0D]+", r"[#$%&*|]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def few_words(text: Column) -> Column:
    return F.size(_words(text)) < 50


def repetitive(text: Column) -> Column:
    return F.size(F.array_distinct(_words(text))) * 100 < F.size(_words(text)) * 65


def shouting(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, CAPITALS, ""))) * 100 > F.length(text) * 5


def symbols(text: Column) -> Column:
    return text.rlike(SYMBOLS)


#: Letter and failure condition of the filters that look at one text, and the letter of the
#: filter that fails texts identical to an earlier document's.
FILTERS: dict[str, Callable[[Column], Column]] = {"A": few_words, "B": repetitive, "C": shouting, "D": symbols}
DUPLICATE = "E"


# --- exact constrained least squares ---------------------------------------------------------------

def solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """The solutions of a regular system for several right-hand sides (columns), by elimination."""
    n = len(matrix)
    rows = [list(a) + list(b) for a, b in zip(matrix, right)]
    for i in range(n):
        pivot = next(r for r in range(i, n) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [r[n:] for r in rows]


def kernel(m: int, size: int) -> Fraction:
    """The Shapley kernel's weight of a coalition of ``size`` of ``m``, neither empty nor full."""
    return Fraction(m - 1, comb(m, size) * size * (m - size))


def shapley_operator(m: int) -> list[list[Fraction]]:
    """A row for each filter, giving its Shapley value as a combination of v(1) .. v(2**m - 1).

    The normal equations with the efficiency constraint are solved for every unit vector of removals,
    so that a part costs one exact product.
    """
    inner = range(1, (1 << m) - 1)
    weight = {s: kernel(m, s.bit_count()) for s in inner}
    normal = [[sum((weight[s] for s in inner if s >> i & 1 and s >> j & 1), Fraction()) for j in range(m)] + [Fraction(1)]
              for i in range(m)]
    normal.append([Fraction(1)] * m + [Fraction(0)])  # the values add up to v(all)
    right = [[weight[s] if s in weight and s >> i & 1 else Fraction() for s in range(1, 1 << m)] for i in range(m)]
    right.append([Fraction(int(s == (1 << m) - 1)) for s in range(1, 1 << m)])
    return solve(normal, right)[:m]


# --- the audit -------------------------------------------------------------------------------------

def failure_cells(docs: DataFrame, labels: DataFrame, filters: dict[str, Callable[[Column], Column]], id_col: str, text_col: str,
                  part_col: str) -> DataFrame:
    """(part, mask, n, good, toxic): how many documents of a part fail exactly the filters of a mask,
    and how many of those are labelled good or toxic."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    mask = sum((F.when(fails(text), 1 << i).otherwise(0) for i, fails in enumerate(filters.values())), F.lit(0))
    rows = pick(docs, id_col, text_col, part_col).select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), mask.alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = written(rows, "audit-rows")
    named = rows.filter("id is not null")
    firsts = named.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    said = (pick(labels, id_col, "quality", "toxic").filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
            .agg(F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
                 F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic")))
    late = F.when(F.col("first"), 0).otherwise(1 << len(filters))
    known = (named.join(firsts, ["id", "digest"], "left").join(said, "id", "left")
             .select("part", (F.col("mask") + late).alias("mask"), "good", "toxic"))
    # rows without an id have no place among copies and no label
    unnamed = rows.filter("id is null").select("part", "mask", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic"))
    return known.unionByName(unnamed).groupBy("part", "mask").agg(
        F.count("*").alias("n"), *(F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("good", "toxic")))


def coalition_removals(cells: DataFrame, m: int) -> DataFrame:
    """A row per part: ``total`` documents, and for n, good and toxic the removals of all 2**m coalitions."""
    def removed(c: str) -> Column:
        return F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(c)).otherwise(0)) for s in range(1 << m)]).alias(c)
    return cells.groupBy("part").agg(F.sum("n").alias("total"), removed("n"), removed("good"), removed("toxic"))


def filter_audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Callable[[Column], Column]] = FILTERS,
                 duplicate: str = DUPLICATE, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """A row per value of ``part_col`` (null: empty string), order of the filters and step, with the
    documents ``kept`` after the step, ``removed`` by it, ``redundant`` (failing its filter, removed
    earlier), ``unique_fails`` (failing its filter only), ``good_lost`` and ``toxic_lost`` (removed here
    with that label) and ``shapley`` (its filter's removals summed over all orders).

    A null text is empty: it has no words, and equals other empty texts.  A row without an id is no
    copy, makes no other row a copy and has no label; rows that repeat an id are copies of smaller ids
    only, and each counts; a document is good or toxic if any of its labels says so.  An empty table
    gives an empty result; other columns are ignored.
    """
    letters = [*filters, duplicate]
    m = len(letters)
    table = coalition_removals(failure_cells(docs, labels, filters, id_col, text_col, part_col), m)

    def audit(batches):
        values = shapley_operator(m)
        orders = [(order, sum(1 << letters.index(x) for x in order[:k]), k) for order in permutations(letters) for k in range(m)]
        every = (1 << m) - 1
        for batch in batches:
            for row in batch.to_pylist():
                n, good, toxic, total = row["n"], row["good"], row["toxic"], row["total"]
                share = [sum(x * v for x, v in zip(line, n[1:])) * factorial(m) for line in values]
                out = []
                for order, before, k in orders:
                    f = letters.index(order[k])
                    after = before | 1 << f
                    removed = n[after] - n[before]
                    out.append((row["part"], "".join(order), k + 1, total - n[after], removed, n[1 << f] - removed,
                                n[every] - n[every ^ 1 << f], good[after] - good[before], toxic[after] - toxic[before], int(share[f])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7])], names=NAMES)

    return map_batches(table, audit, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in NAMES[3:]))


NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
