"""Running folds over ordered rows of any number, without a task that takes a document whole.

Rows lie in blocks, a whole number that rises with the order. A block is folded to one state (a sum,
a maximum, the last value), the states are folded in order, and each block's rows take up what the
blocks before them left. Rows are shuffled by (key, block) and hold a window of a block; of a key only
its states meet, one for each BLOCK rows. So a key with a third of all rows has as many tasks as it has
blocks. What comes before a scan is planned twice, for states and rows: cut a long chain of scans between.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Places of the order that are a block.
BLOCK = 1 << 14

_SEEN = Window.unboundedPreceding


@dataclass
class Fold:
    """A running fold of value: kind is sum, max or last (the last value that is not null).

    back runs from the end, so that last is the next value; own is False where a row's own value is
    left out. Nulls are left out of all; a fold of no value is null.
    """

    kind: str
    value: Column
    back: bool = False
    own: bool = True

    def over(self, value: str, by: list[str], order: list[str], own: bool) -> Column:
        """The fold up to a row; one from the end goes through the rows in reverse, as a frame without an end is computed anew for each row."""
        w = Window.partitionBy(*by).orderBy(*(F.desc(c) if self.back else F.asc(c) for c in order)).rowsBetween(_SEEN, 0 if own else -1)
        return {"sum": F.sum, "max": F.max, "last": lambda x: F.last(x, True)}[self.kind](value).over(w)

    def state(self, value: str, order: Column) -> Column:
        """The fold of all rows of a group."""
        if self.kind == "last":
            return (F.min_by if self.back else F.max_by)(F.col(value), F.when(F.col(value).isNotNull(), order))
        return {"sum": F.sum, "max": F.max}[self.kind](value)

    def joined(self, earlier: Column, later: Column) -> Column:
        """The fold of two stretches; null is that of none."""
        if self.kind == "sum":
            return F.coalesce(earlier + later, earlier, later)
        return F.greatest(earlier, later) if self.kind == "max" else F.coalesce(later, earlier)


def places(order: str, size: int | str = BLOCK) -> Column | str:
    """Blocks of an order of whole numbers; the name of a column that holds blocks stands for itself."""
    return size if isinstance(size, str) else F.floor(F.col(order) / size).cast("bigint")


def scan(df: DataFrame, by: str, order: list[str], block: Column | str, deal: bool = False, **folds: Fold) -> DataFrame:
    """df with a column for each fold, over the rows of by in order.

    block must rise with the order. The column of a name stays in the rows; with deal they are shuffled by
    (by, block) once, however small the states, and a later scan by the same column shuffles none of them. Sums
    of floating numbers are added up by blocks. Rows with a null key are folded by block alone; columns starting
    with _ are the scan's own.
    """
    b = block if isinstance(block, str) else "_b"
    own = (df if isinstance(block, str) else df.withColumn(b, block)).withColumns({f"_v_{n}": f.value for n, f in folds.items()})
    at = F.struct(*order) if len(order) > 1 else F.col(order[0])
    states = own.where(F.col(by).isNotNull()).groupBy(by, b).agg(*(f.state(f"_v_{n}", at).alias(f"_v_{n}") for n, f in folds.items()))
    left = states.select(by, b, *(f.over(f"_v_{n}", [by], [b], False).alias(f"_c_{n}") for n, f in folds.items()))
    local = (own.repartition(by, b) if deal else own).withColumns({n: f.over(f"_v_{n}", [by, b], order, f.own) for n, f in folds.items()})
    out = local.join(left, [by, b], "left").withColumns({n: f.joined(F.col(f"_c_{n}"), F.col(n)) for n, f in folds.items()})
    return out.select(*df.columns, *folds)


def ahead(df: DataFrame, by: str, order: list[str], block: Column, reach: int, size: int = BLOCK) -> DataFrame:
    """df in blocks (_blk) of size consecutive rows, each with the reach rows after it as well, which have _home false; _at numbers the rows.

    A window by (by, _blk) in order of _at then sees reach rows after each row of its own block.
    """
    out = scan(df, by, order, block, _at=Fold("sum", F.lit(1).cast("bigint"), own=False)).withColumn("_at", F.coalesce("_at", F.lit(0).cast("bigint")))
    own = places("_at", size)
    first = F.greatest(F.lit(0).cast("bigint"), F.floor((F.col("_at") - reach) / size))
    return out.withColumn("_blk", F.explode(F.sequence(first, own))).withColumn("_home", F.col("_blk") == own)
