"""Mixing sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import keep, prefix_sums, table

WORDS = r"[^\x20\x09-\x0D]+"
SEED = "mix"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def default_quality(text: str = "text", size: str = "size") -> Column:
    """1 for texts whose words have 3 to 10 characters on average, else 1/4."""
    mean = F.length(F.col(text)) / F.nullif(F.col(size), F.lit(0))
    return F.when(mean.between(3.0, 10.0), 1.0).otherwise(0.25)


def uniform(doc_id: str = "doc_id", seed: str = SEED) -> Column:
    """A number in (0, 1) that depends on the id and the seed only, so that reruns agree."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long") + 0.5) / F.lit(2.0**52)


def cyclic_weights(sources: DataFrame, weights: Sequence[float] = (3, 1, 2)) -> DataFrame:
    """``sources`` with ``weight``: the given weights in turn, by code point order, null last."""
    ranked = prefix_sums(
        sources.withColumn("_one", F.lit(1)), [], [F.col("source").asc_nulls_last()], "_one"
    ).drop("_one")
    turn = (F.col("before") % len(weights)).cast("int") + 1
    return ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn)).drop("before")


def fill_level(sources: DataFrame, budget: float, cap: float) -> float | None:
    """The level L with sum(min(cap * source_size, L * weight)) = budget; ``None``: all are capped.

    Every round hands the excess of the capped sources to the others.  A round is one
    aggregation of the per-source table; the level only rises, so the rounds end.
    """
    level, seen = 0.0, None
    top = cap * F.col("source_size")
    while True:
        capped = top <= F.lit(level) * F.col("weight")
        row = sources.agg(
            F.sum(F.when(capped, top).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if not row.free:
            return None
        if (row.fixed, row.free) == seen:
            return level
        seen = (row.fixed, row.free)
        level = (budget - row.fixed) / row.free


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    quality: Column | None = None,
    seed: str = SEED,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Copies of each document that a mix of its source to a target takes.

    ``docs`` needs doc_id, text and source; its columns (or those named in ``carry``)
    come back in the struct ``doc``, beside size (words), source_size, target (words of its source in the mix)
    and copies.  Efraimidis-Spirakis: each document draws the key -ln(u) / quality and
    is taken in key order.  A source first gives ``floor(target / source_size)`` whole
    epochs; the rest of its target is filled by the documents of smallest key, the last
    one by whether the total comes nearer to the target with it.

    * A null text has size 0; a null source is a source of its own, last in order.
    * Equal keys (repeated ids) are ordered by the row's place, so each row counts once.
    * A document is taken at most ``ceil(cap)`` times.  No rows give no rows.

    The keys of a source are range-partitioned: no task holds a whole source.  Only the
    partition that holds a source's boundary is summed row by row; all other rows just
    compare their key with it.
    """
    sized = docs.select(F.struct(*(carry or docs.columns)).alias("doc"), "doc_id", "text", "source", word_count().alias("size"))
    weight = default_quality() if quality is None else quality
    drawn = sized.withColumn("key", -F.log(uniform(seed=seed)) / weight)
    rows = keep(
        drawn.select("doc", "source", "size", "key").withColumn("row_id", F.monotonically_increasing_id()), "mix-rows"
    )
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = keep(cyclic_weights(sources, weights), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = fill_level(sources, share * total, cap)
    top = cap * F.col("source_size")
    target = top if level is None else F.least(top, F.lit(level) * F.col("weight"))
    sources = sources.withColumn("target", target).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1)
    )
    sources = sources.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    bounds = keep(boundaries(rows.select("source", "size", "key", "row_id"), sources), "mix-bounds")
    # a row per source: Spark broadcasts it where small; where not, skewed sources are split
    joined = rows.alias("r").join(bounds.alias("b"), F.col("r.source").eqNullSafe(F.col("b.source")))
    place = F.struct(F.col("r.key").alias("key"), F.col("r.row_id").alias("row_id"))
    extra = F.coalesce(place <= F.col("b.last_in"), place < F.col("b.first_out"), F.lit(False))
    return joined.select(
        "r.doc",
        "r.size",
        "b.source_size",
        "b.target",
        (F.col("b.epochs") + extra.cast("long")).cast("long").alias("copies"),
    )


def boundaries(keys: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with the last key taken (``last_in``) or, if it lies in front, ``first_out``."""
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("row_id")]
    placed = keep(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-keys")
    chain = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy("source", "part").agg(F.sum("size").alias("sum"))
    blocks = blocks.withColumn("before", F.coalesce(F.sum("sum").over(chain), F.lit(0)))
    hit = (
        sources.alias("s")
        .where("rest > 0")
        .join(blocks.alias("k"), F.col("s.source").eqNullSafe(F.col("k.source")))
        .where("k.before < s.rest AND s.rest <= k.before + k.sum")
        .select("s.source", "s.rest", "k.part", "k.before")
    )
    within = Window.partitionBy("source").orderBy("key", "row_id").rowsBetween(Window.unboundedPreceding, 0)
    edge = (
        placed.alias("p")
        .join(hit.alias("h"), F.col("p.source").eqNullSafe(F.col("h.source")) & (F.col("p.part") == F.col("h.part")))
        .select("p.source", "p.key", "p.row_id", "p.size", "h.rest", "h.before")
        .withColumn("middle", F.col("before") + F.sum("size").over(within) - F.col("size") / 2)
    )
    place = F.struct("key", "row_id")
    ends = edge.groupBy("source").agg(
        F.max(F.when(F.col("middle") < F.col("rest"), place)).alias("last_in"), F.min(place).alias("first_out")
    )
    return (
        sources.alias("s")
        .join(ends.alias("e"), F.col("s.source").eqNullSafe(F.col("e.source")), "left")
        .select("s.source", "s.source_size", "s.target", "s.epochs", "e.last_in", "e.first_out")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix itself: every document as often as it is taken, columns unchanged."""
    taken = mix(docs, **options).where("copies > 0")
    again = taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    return again.select("doc.*")


def op1_mix_sources(spark, sf_dir):
    """All documents mixed with the weights 3, 1, 2 to 150 % of their words."""
    taken = mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return taken.select(
        "doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
    -ln(u) / CASE WHEN length(text) / nullif(size, 0) BETWEEN 3 AND 10 THEN 1.0 ELSE 0.25 END::DOUBLE AS key FROM docs),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::DOUBLE AS weight
  FROM keyed GROUP BY source),
budget AS (SELECT 1.5::DOUBLE * sum(source_size) AS words FROM sources),
filled AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS full_at,
    coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0) AS capped, sum(weight) OVER rest AS free
  FROM sources WINDOW
    before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    rest AS (ORDER BY 2.0::DOUBLE * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (SELECT arg_min((words - capped) / free, full_at) FILTER (WHERE full_at > (words - capped) / free) AS water FROM filled, budget),
targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, water * weight) AS target,
    CASE WHEN source_size > 0 THEN floor(least(2.0::DOUBLE * source_size, water * weight) / source_size) ELSE 1 END AS epochs
  FROM sources, level),
summed AS (
  SELECT doc_id, size, source_size, target, epochs,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id) - size / 2.0::DOUBLE AS middle
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN middle < target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""
