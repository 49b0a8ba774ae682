"""Running values along an ordered key, without putting a key into one task.

A plain window over (topic, partition) sends a hot topic-partition to a single
task.  Here the order column is cut into blocks of ``2**BLOCK_BITS`` positions.
Positions are unique per key, so a block has a bounded number of rows whatever
the skew.  Windows run inside blocks; what crosses a block border is carried by
a table with one row per block.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicflow.records import quote

BLOCK_BITS = 20
BLOCK = "__block"


def block_of(order: str, bits: int) -> Column:
    return F.shiftright(F.col(quote(order)).cast("bigint"), bits)


def with_block(df: DataFrame, order: str, bits: int = BLOCK_BITS) -> DataFrame:
    """Add the block column; one that is there stays, and with it its shuffle."""
    return df if BLOCK in df.columns else df.withColumn(BLOCK, block_of(order, bits))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    previous: Mapping[str, str] | None = None,
    totals: Mapping[str, str] | None = None,
    maxima: Mapping[str, str] | None = None,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add running values per key along the unique, non-negative column ``order``.

    ``previous``: {new: column} value in the row before, null in the first row.
    ``totals``: {new: column} sum up to and including the row.
    ``maxima``: {new: column} maximum over the rows before, null in the first row.

    Keys must not be null.  If ``df`` comes ``with_block`` the result does too,
    and calls in a row share one shuffle.
    """
    previous, totals, maxima = dict(previous or {}), dict(totals or {}), dict(maxima or {})
    by = [quote(k) for k in keys]
    order_col = F.col(quote(order))
    source = with_block(df, order, block_bits)

    here = Window.partitionBy(*by, BLOCK).orderBy(order_col)
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    local = {"__first": F.row_number().over(here) == 1} if previous else {}
    local |= {f"__p_{n}": F.lag(quote(c)).over(here) for n, c in previous.items()}
    local |= {f"__t_{n}": F.sum(quote(c)).over(upto) for n, c in totals.items()}
    local |= {f"__m_{n}": F.max(quote(c)).over(before) for n, c in maxima.items()}

    # one row per block, combined on the map side
    blocks = source.groupBy(*by, BLOCK).agg(
        *[F.sum(quote(c)).alias(f"__s_{n}") for n, c in totals.items()],
        *[F.max(quote(c)).alias(f"__x_{n}") for n, c in maxima.items()],
        *[F.max_by(quote(c), order_col).alias(f"__l_{n}") for n, c in previous.items()],
    )
    along = Window.partitionBy(*by).orderBy(BLOCK)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select(
        *by,
        BLOCK,
        *[F.sum(f"__s_{n}").over(earlier).alias(f"__ct_{n}") for n in totals],
        *[F.max(f"__x_{n}").over(earlier).alias(f"__cm_{n}") for n in maxima],
        *[F.lag(f"__l_{n}").over(along).alias(f"__cp_{n}") for n in previous],
    )

    joined = source.withColumns(local).join(carry, [*keys, BLOCK], "left")
    out = [F.col(quote(c)) for c in df.columns]
    for name in previous:
        c = F.when(F.col("__first"), F.col(f"__cp_{name}")).otherwise(F.col(f"__p_{name}"))
        out.append(c.alias(name))
    for name in totals:
        c = F.col(f"__t_{name}") + F.coalesce(F.col(f"__ct_{name}"), F.lit(0))
        out.append(c.alias(name))
    for name in maxima:
        out.append(F.greatest(f"__m_{name}", f"__cm_{name}").alias(name))
    return joined.select(*out)


def running_flags(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    watched: Sequence[str],
    flag: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
    name: str,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add ``name``: the number of rows up to and including this one that ``flag`` marks.

    ``flag(now, before)`` compares a row's ``watched`` columns with those of the row before it
    in its key; null counts as no mark, as does a key's first row.  One pass does both: blocks
    count by themselves, but for their first rows, which are compared by one row per block.
    """
    by = [quote(k) for k in keys]
    source = with_block(df, order, block_bits)
    here = Window.partitionBy(*by, BLOCK).orderBy(quote(order))
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def marked(now: Callable[[str], Column], before: Callable[[str], Column]) -> Column:
        return F.coalesce(flag(now, before), F.lit(False)).cast("bigint")

    own = marked(lambda c: F.col(quote(c)), lambda c: F.lag(quote(c)).over(here))
    own = F.when(F.row_number().over(here) == 1, 0).otherwise(own)
    rows = source.withColumn("__flag", own).withColumn("__count", F.sum("__flag").over(upto))
    ends = F.struct(*[F.col(quote(c)) for c in watched])
    blocks = rows.groupBy(*by, BLOCK).agg(
        F.max("__count").alias("__inside"),
        F.min_by(ends, quote(order)).alias("__head"),
        F.max_by(ends, quote(order)).alias("__tail"),
    )
    along = Window.partitionBy(*by).orderBy(BLOCK)
    blocks = blocks.withColumn("__last", F.lag("__tail").over(along))
    blocks = blocks.withColumn("__mark", marked(lambda c: F.col("__head")[c], lambda c: F.col("__last")[c]))
    earlier = F.sum(F.col("__inside") + F.col("__mark")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    carry = blocks.select(*by, BLOCK, (F.coalesce(earlier, F.lit(0)) + F.col("__mark")).alias("__carry"))
    joined = rows.join(carry, [*keys, BLOCK], "left")
    return joined.select(*[F.col(quote(c)) for c in df.columns], (F.col("__count") + F.col("__carry")).alias(name))


def fill_from_marks(
    df: DataFrame,
    marks: DataFrame,
    keys: Sequence[str],
    order: str,
    names: Sequence[str],
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Give every row the values of the last mark at or before it.

    ``marks`` holds (keys, order, names) and has a mark at the first row of
    every block, so the fill never looks beyond its block.
    """
    rank = "__rank"
    rows = df.select("*", *[F.lit(None).cast(marks.schema[n].dataType).alias(n) for n in names])
    rows = rows.withColumn(rank, F.lit(1))
    given = {*keys, order, *names}
    filler = marks.select(
        *[
            F.col(quote(f.name)).cast(f.dataType).alias(f.name)
            if f.name in given
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in rows.schema
            if f.name != rank
        ],
        F.lit(0).alias(rank),
    )
    both = rows.unionAll(filler).withColumn(BLOCK, block_of(order, block_bits))
    w = (
        Window.partitionBy(*[quote(k) for k in keys], BLOCK)
        .orderBy(quote(order), rank)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = both.withColumns({n: F.last(quote(n), ignorenulls=True).over(w) for n in names})
    return filled.filter(F.col(rank) == 1).drop(rank, BLOCK)
