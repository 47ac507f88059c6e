"""A stated query set against all rows, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def counts_by_cell(rows: DataFrame) -> dict[int, int]:
    """Rows by ``cell``; callers keep the number of cells bounded."""
    return {r.cell: r["count"] for r in rows.groupBy("cell").count().collect()}


def _blocks(cell: Column, counts: Mapping[int, int], size: int) -> Column:
    """Number of blocks of ``size`` rows that a cell is cut into."""
    many = {c: -(-n // size) for c, n in counts.items() if n > size}
    if not many:
        return F.lit(1)
    pairs = F.create_map(*[F.lit(x) for item in sorted(many.items()) for x in item])
    return F.coalesce(F.element_at(pairs, cell), F.lit(1))


def search_blocks(
    base: DataFrame, queries: DataFrame, search: Callable, schema: str, base_rows: int = 8192, query_rows: int = 2048
) -> DataFrame:
    """Apply ``search(queries, base)`` (Arrow tables) to all pairs of blocks of equal ``cell``.

    Both sides need the integer columns cell and place; a place spreads the rows of a
    cell evenly.  A large cell is cut into several blocks on either side, so a group
    holds at most about ``base_rows`` and ``query_rows`` rows however full the cell is.
    """
    n_base, n_query = counts_by_cell(base), counts_by_cell(queries)
    cell = F.col("cell")
    of_base, of_query = _blocks(cell, n_base, base_rows), _blocks(cell, n_query, query_rows)
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = queries.withColumn("query_block", F.pmod("place", of_query)).withColumn("base_block", every(of_base))
    right = base.withColumn("base_block", F.pmod("place", of_base)).withColumn("query_block", every(of_query))
    keys = ["cell", "base_block", "query_block"]
    # both sides deal their rows by these keys, and equal numbers of different types go to different tasks
    left, right = (side.withColumns({key: F.col(key).cast("int") for key in keys}) for side in (left, right))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)


def smallest_ids(rows: DataFrame, group: str, id_column: str, n: int) -> DataFrame:
    """(group, ids): the ``n`` smallest distinct ids of each group, ascending.

    Spark limits every group before the shuffle, so a group of any size sends ``n`` rows a task.
    """
    first = Window.partitionBy(group).orderBy(id_column)
    few = rows.select(group, id_column).withColumn("_rank", F.dense_rank().over(first)).where(F.col("_rank") <= n)
    return few.groupBy(group).agg(F.sort_array(F.collect_set(id_column)).alias("ids"))
