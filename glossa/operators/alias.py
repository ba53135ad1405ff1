"""Alias tables: a draw from a weighted list of any length reads one row.

A list of n entries becomes n slots of equal size.  A slot holds one entry up to ``cut`` and another, ``alt``, from there on.  A uniform number names the slot
and the place in it.  Entries lighter than a slot keep theirs and let a heavier one fill the rest.  Usually that is a loop over two stacks; here it is read off running sums: put
what the light ones lack and what the heavy ones have too much side by side, in order, on two rulers of equal length.  A light entry is filled by the heavy one that
its piece of the first ruler starts in.  A heavy entry whose piece ends inside a light one's has been overdrawn by what that one reaches over, and the next heavy entry fills that.
Weights are whole numbers, so the sums are exact and every entry gets its share to the last unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.operators.lookup import with_key

#: Units that a list's weights are rounded to, each entry keeping one at least; lists of up to 2**26 entries stay in 63 bits.
UNITS = 1 << 36


def alias_table(entries: DataFrame, by: list[str], item: str, weight: str) -> DataFrame:
    """``by, slot, item, alt, cut, units, n`` for the weighted ``item`` lists of ``entries``, one list per ``by``; slots go by ``item``, which is unique in a list.

    A list is sorted within one task (spilling if it must); its length is bounded by the vocabulary.
    """
    # The hash goes first: lists of arrays or strings are sorted by a number.
    of = Window.partitionBy("_key", *by)
    w = with_key(entries, by).select("_key", *by, F.col(item).alias("_item"), F.greatest(F.lit(1), F.floor(F.col(weight) / F.sum(weight).over(of) * F.lit(float(UNITS)))).cast("bigint").alias("_w"))
    upto = of.orderBy("_item").rowsBetween(Window.unboundedPreceding, 0)
    w = w.select("*", (F.count(F.lit(1)).over(upto) - 1).alias("slot"), F.count(F.lit(1)).over(of).alias("n"), F.sum("_w").over(of).alias("units"))
    over = F.col("_w") * F.col("n") - F.col("units")
    w = w.withColumn("_over", over)
    w = w.withColumn("_lack", F.sum(F.greatest(-F.col("_over"), F.lit(0))).over(upto)).withColumn("_much", F.sum(F.greatest(F.col("_over"), F.lit(0))).over(upto))
    mark = lambda kind, at: F.struct(F.lit(kind).alias("kind"), at.cast("bigint").alias("at"))
    marks = (F.when(F.col("_over") < 0, F.array(mark(0, F.col("_lack") + F.col("_over")), mark(1, F.col("_lack"))))
             .when(F.col("_over") > 0, F.array(mark(2, F.col("_much")))).otherwise(F.array(mark(3, F.lit(-1)))))
    # From the far end: the last heavy mark seen is the first one that ends behind, the last light end seen is the first at or behind.
    seen = of.orderBy(F.desc("_m.at"), "_m.kind").rowsBetween(Window.unboundedPreceding, -1)
    m = w.withColumn("_m", F.explode(marks))
    m = m.withColumn("_heavy", F.last(F.when(F.col("_m.kind") == 2, F.col("_item")), True).over(seen))
    m = m.withColumn("_end", F.last(F.when(F.col("_m.kind") == 1, F.col("_m.at")), True).over(seen)).where("_m.kind != 1")
    cut = (F.when(F.col("_m.kind") == 0, F.col("_w") * F.col("n"))
           .when(F.col("_m.kind") == 2, F.col("units") - (F.col("_end") - F.col("_m.at"))).otherwise(F.col("units")))
    alt = F.when(F.col("_m.kind") == 3, F.col("_item")).otherwise(F.coalesce("_heavy", "_item"))
    return m.select(*by, "slot", F.col("_item").alias(item), alt.alias("alt"), cut.alias("cut"), "units", "n")


def slot_of(u: Column, n: Column) -> Column:
    """The slot that a uniform number in [0, 1) falls in."""
    return F.least(F.floor(u * n), n - 1)


def drawn(u: Column, item: str = "token") -> Column:
    """The entry that ``u`` draws from its slot's row."""
    return F.when((u * F.col("n") - F.col("slot")) * F.col("units") < F.col("cut"), F.col(item)).otherwise(F.col("alt"))
