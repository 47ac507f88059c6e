"""Retention by stream-name pattern, lifecycle phase and expiry."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PipelineConfig, RetentionRule
from ..session import scratch_path

CELLS = 1 << 18  # of each of two rows of counts
SLOTS = 1 << 13  # for the wanted keys of like count
KEY_NAMES = 200_000  # a key of more names is split
SLICE_NAMES, SLICES = 1_000_000, 8  # more names than these are matched in turns, up to so many


def glob_to_regex(pattern: str) -> str:
    return "^" + ".*".join(re.escape(part) for part in pattern.split("*")) + "$"


def _matches(stream: Column, pattern: str) -> Column:
    # LIKE with only % compiles to prefix, suffix and contains tests
    escaped = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return stream.like(escaped.replace("*", "%"))


def rule_column(
    stream: Column, cfg: PipelineConfig = PipelineConfig(), what: str = "policy"
) -> Column:
    """``policy`` (or another field) of the best matching rule, as a plain expression.

    The rules are configuration of fixed size, so no join is needed per row.
    """
    result = None
    for rule in sorted(cfg.retention_rules, key=lambda r: (r.priority, r.policy), reverse=True):
        hit = F.lit(False)
        for pattern in rule.patterns:
            hit = hit | _matches(stream, pattern)
        value = F.lit(getattr(rule, what))
        result = F.when(hit, value) if result is None else result.when(hit, value)
    return F.lit(None) if result is None else result


def rules_table(spark, rules: tuple[RetentionRule, ...]) -> DataFrame:
    rows = [
        (glob, glob_to_regex(glob), r.priority, r.policy, r.warm_days, r.delete_days)
        for r in rules
        for glob in r.patterns
    ]
    return spark.createDataFrame(
        rows,
        "pattern string, regex string, priority int, policy string, warm_days int, delete_days int",
    )


_EDGE = "\u0001"  # stands before and behind a whole name
_WHOLE = f"concat('{_EDGE}', data_stream, '{_EDGE}')"


def _keys(text: str) -> str:
    """Everything that a name must hold to contain ``text``: words between separators, three signs in a row, nothing."""
    words = f"transform(regexp_extract_all({text}, '(?<=[^0-9A-Za-z])[0-9A-Za-z]+(?=[^0-9A-Za-z])', 0), w -> concat('w', w))"
    signs = f"if(char_length({text}) < 3, array(), transform(sequence(1, greatest(char_length({text}) - 2, 1)), i -> concat('s', substring({text}, i, 3))))"
    return f"array_distinct(concat(array('', concat('n', {text})), {words}, {signs}))"


def _every(text: str = "pattern") -> str:
    """All keys that every name must have that a pattern matches."""
    pieces = f"split(concat('{_EDGE}', {text}, '{_EDGE}'), '\\\\*')"
    # a piece asks for itself only where it is the whole pattern
    kept = f"if(size({pieces}) = 1, k, filter(k, x -> NOT startswith(x, 'n')))"
    return f"array_distinct(flatten(transform(transform({pieces}, p -> {_keys('p')}), k -> {kept})))"


def _kept(df: DataFrame, path: str) -> DataFrame:
    """Writes ``df`` once; the shuffles it took are deleted."""
    spark, setting = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        df.write.mode("append").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(setting, before) if before else spark.conf.unset(setting)
    return spark.read.schema(df.schema).parquet(path)


def _listed(df: DataFrame, keys: str) -> DataFrame:
    """``df`` with the array of its keys and that of their hashes as last columns."""
    return df.select("*", F.expr(keys).alias("keys")).select("*", F.expr("transform(keys, k -> xxhash64(k))").alias("hashes"))


def _rows(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, first value of each list, lengths) of lists that are neither null nor empty."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes, sizes


def _cells(hashes: np.ndarray) -> np.ndarray:
    """A key's cell in each row of the counts."""
    return np.stack([hashes & (CELLS - 1), ((hashes >> 32) & (CELLS - 1)) + CELLS])


def _slots(counts: np.ndarray, hashes: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """A key's place among the wanted keys: keys of like count share a part of the table, whole names have their own."""
    kind = np.where(whole, 0, np.frexp(counts.astype(np.float64))[1])
    return kind.astype(np.int64) * SLOTS + ((hashes >> 16) & (SLOTS - 1))


def key_counts(names: DataFrame) -> np.ndarray:
    """How many names hold a key, at least for rare ones: a table of fixed size, never too low.

    Keys are counted in a cell of each of two rows; the smaller cell bounds the count of a key from above.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * CELLS, np.int64)
        for batch in batches:
            counts += np.bincount(_cells(_rows(batch.column(0))[0]).ravel(), minlength=2 * CELLS)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["cell", "n"])

    keys = f"filter({_keys(_WHOLE)}, k -> NOT startswith(k, 'n'))"
    listed = _listed(names.where("data_stream IS NOT NULL"), keys).select("hashes")
    summed = listed.mapInArrow(tasks, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    summed = _kept(summed, scratch_path(names.sparkSession, "key-counts")).toArrow()
    counts = np.zeros(2 * CELLS, np.int64)
    counts[summed["cell"].to_numpy()] = summed["n"].to_numpy()
    return counts


def with_rarest_key(rules: DataFrame, counts: np.ndarray) -> DataFrame:
    """Adds (key, n): of the keys of a pattern the one that fewest names have by the counts; no rule that no name can fit."""
    added = T.StructType([*rules.schema.fields, T.StructField("key", T.StringType()), T.StructField("n", T.LongType())])
    titles = added.names

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            *columns, keys, lists = batch.columns
            hashes, first, sizes = _rows(lists)
            n = counts[_cells(hashes)].min(axis=0)
            low = np.minimum.reduceat(n, first)
            found = np.flatnonzero(n == np.repeat(low, sizes))
            key = keys.flatten().take(pa.array(found[np.searchsorted(found, first)]))
            yield pa.RecordBatch.from_arrays([*columns, key, pa.array(low)], titles).filter(pa.array(low > 0))

    listed = _listed(rules.where("pattern IS NOT NULL"), f"filter({_every()}, k -> NOT startswith(k, 'n'))")
    # a whole name is one name at most, and is not counted
    whole = F.expr("instr(pattern, '*') = 0")
    name = F.concat(F.lit(f"n{_EDGE}"), "pattern", F.lit(_EDGE))
    return listed.mapInArrow(tasks, added).withColumns({"key": F.when(whole, name).otherwise(F.col("key")), "n": F.when(whole, F.lit(1)).otherwise(F.col("n")).cast("bigint")})


def wanted_slots(chosen: DataFrame) -> np.ndarray:
    """Which keys any pattern has chosen, as a table of fixed size that may hold others too, mostly rare ones."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(64 * SLOTS, bool)
        for batch in batches:
            h, n, whole = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            wanted[_slots(n, h, whole)] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(wanted))], ["slot"])

    keys = chosen.select(F.xxhash64("key").alias("h"), "n", F.startswith("key", F.lit("n")).alias("whole"))
    slots = _kept(keys.mapInArrow(tasks, "slot bigint").distinct(), scratch_path(chosen.sparkSession, "wanted")).toArrow()
    wanted = np.zeros(64 * SLOTS, bool)
    wanted[slots["slot"].to_numpy()] = True
    return wanted


def _numbered(key: str, part: str) -> Column:
    return F.expr(f"if({part} = 0, {key}, concat({key}, '{_EDGE}', {part}))")


def name_keys(names: DataFrame) -> DataFrame:
    """(data_stream, key): what the literal text of a matching pattern can ask for."""
    return names.select("data_stream", F.explode(F.expr(_keys(_WHOLE))).alias("key"))


def wanted_keys(names: DataFrame, counts: np.ndarray, wanted: np.ndarray) -> DataFrame:
    """(data_stream, key) of the keys that patterns may have chosen; a common key has parts, of which a name is in one."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            name, keys, lists = batch.columns
            hashes, first, sizes = _rows(lists)
            row = np.repeat(np.arange(len(name)), sizes)
            whole = np.zeros(len(hashes), bool)
            whole[first + 1] = True  # the second key of a name
            n = counts[_cells(hashes)].min(axis=0)
            hit = np.flatnonzero(wanted[_slots(n, hashes, whole)])
            part = hashes[first + 1][row[hit]] % np.where(whole, 1, 1 + n // KEY_NAMES)[hit]
            yield pa.RecordBatch.from_arrays([name.take(pa.array(row[hit])), keys.flatten().take(pa.array(hit)), pa.array(part)], ["data_stream", "key", "part"])

    listed = _listed(names.where("data_stream IS NOT NULL"), _keys(_WHOLE))
    rows = listed.mapInArrow(tasks, "data_stream string, key string, part bigint")
    return rows.select("data_stream", _numbered("key", "part").alias("key"))


def all_parts(chosen: DataFrame) -> DataFrame:
    """Rules whose key is common once for each part of it."""
    rows = chosen.withColumn("part", F.explode(F.expr(f"sequence(0, n div {KEY_NAMES})")))
    return rows.withColumn("key", _numbered("key", "part")).drop("part", "n")


def rarest_keys(names: DataFrame, rules: DataFrame) -> DataFrame:
    """(pattern, key, n): of the keys of a pattern the one that fewest names have; none that no name has."""
    return with_rarest_key(rules.select("pattern").distinct(), key_counts(names)).select("pattern", "key", "n")


def best_rules(names: DataFrame, chosen: DataFrame, counts: np.ndarray, wanted: np.ndarray) -> DataFrame:
    """(data_stream, best) of names that a rule with its rarest key (key, n, regex, best) matches."""
    return (
        wanted_keys(names, counts, wanted)
        # both grow with the tables, and Spark takes them for as small as what they come from: no broadcast
        .join(all_parts(chosen).hint("merge"), "key")
        .where(F.expr("data_stream RLIKE regex"))
        .groupBy("data_stream")
        .agg(F.max("best").alias("best"))
    )


def match_rules(streams: DataFrame, rules: DataFrame) -> DataFrame:
    """Best rule per stream name from a table of rules, however many there are.

    A name matches a pattern only if it holds all literal text of it.  Of that text the
    pattern is joined by what fewest names hold: a word between separators, three signs
    in a row, or the whole name; the pairs found are tested in full.  How many names hold
    a text, and which texts patterns have chosen, are tables of fixed size: names are
    shuffled only under texts that may have been chosen, patterns only under the one they
    chose.  A pattern for which even that is common does match many names; such a key is
    split, and the best rule of a name is found before the shuffle.  Many names are matched
    in turns, and the shuffles of a turn are deleted when it ends.  Nothing is broadcast, so
    the driver holds neither names nor patterns.  Of rules of equal priority the last
    policy name wins, as in :func:`rule_column`.
    """
    spark = streams.sparkSession
    # neighbours that are alike take less room, here and in the shuffles
    names = _kept(streams.select("data_stream").distinct().sortWithinPartitions("data_stream"), scratch_path(spark, "names"))
    counts = key_counts(names)
    best = F.struct("priority", "policy", "warm_days", "delete_days").alias("best")
    chosen = _kept(with_rarest_key(rules, counts).select("key", "n", "regex", best), scratch_path(spark, "patterns"))
    wanted = wanted_slots(chosen)
    turns = max(1, min(SLICES, -(-names.count() // SLICE_NAMES)))
    if turns == 1:
        found = best_rules(names, chosen, counts, wanted)
    else:
        path = scratch_path(spark, "best-rules")
        for turn in range(turns):
            # another hash than that of the parts and of the shuffles
            some = names.where(f"pmod(xxhash64('turn', data_stream), {turns}) = {turn}")
            found = _kept(best_rules(some, chosen, counts, wanted), path)
    return found.select("data_stream", "best.*")


def lifecycle_phase(age_days: Column, warm_days: Column, delete_days: Column) -> Column:
    return (
        F.when(age_days >= delete_days, F.lit("delete"))
        .when(age_days >= warm_days, F.lit("warm"))
        .otherwise(F.lit("hot"))
    )


def partition_lifecycle(
    partitions: DataFrame, as_of: str, cfg: PipelineConfig = PipelineConfig()
) -> DataFrame:
    """Phase of each ``(data_stream, dt)`` partition on day ``as_of``."""
    stream = F.col("data_stream")
    return (
        partitions.select("data_stream", "dt")
        .distinct()
        .withColumns(
            {
                "policy": rule_column(stream, cfg),
                "warm_days": rule_column(stream, cfg, "warm_days"),
                "delete_days": rule_column(stream, cfg, "delete_days"),
                "age_days": F.datediff(F.lit(as_of).cast("date"), F.col("dt")),
            }
        )
        .withColumn(
            "phase", lifecycle_phase(F.col("age_days"), F.col("warm_days"), F.col("delete_days"))
        )
    )


def rollover_bucket(
    event_time: Column, stream: Column, cfg: PipelineConfig = PipelineConfig()
) -> Column:
    """Start of the partition a row belongs to: a day, or half a day for short-lived streams."""
    hours = F.coalesce(rule_column(stream, cfg, "rollover_hours"), F.lit(24))
    seconds = hours.cast("bigint") * 3600
    epoch = F.unix_seconds(event_time)
    return F.timestamp_seconds(epoch - F.pmod(epoch, seconds))
