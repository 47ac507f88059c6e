"""Suppression of repeated documents.

``positions`` places every row in the anchored window of its fingerprint: per
fingerprint, in arrival order, a window opens at a row and lasts until a row at
least one window width later.  Each window depends on the one before, yet a
fingerprint may hold a third of all rows, so no task may need a whole fingerprint:

1. rows are range-partitioned and sorted by (fingerprint, arrival); a frequent
   fingerprint simply spans many partitions;
2. a partition filled by one fingerprint is summarised as a function from the
   incoming window to the outgoing one (``exits``), which does not need its
   predecessors;
3. these small summaries are chained per fingerprint, giving each partition the
   window it starts with;
4. a final pass folds all partitions in parallel.

Only (row, fingerprint, times, position) travel through these steps; documents
are joined back by row id after the suppressed rows are gone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.anchored import exits, fold
from ..functions.text import iso_instant
from ..session import checkpointed, staged

_ALWAYS, _NEVER = -(2**62), 2**62
AGGREGATE_MESSAGE = "Aggregated duplicate log events"


def arrival_order() -> list[Column]:
    """Total order in which rows count as having arrived."""
    return [
        F.col("arrived_at"),
        F.col("source.topic"),
        F.col("source.partition"),
        F.col("source.offset"),
        F.col("event_time"),
    ]


def emission(ordinal: Column, cfg: PipelineConfig = PipelineConfig()) -> Column:
    """``raw`` up to the threshold, then every threshold-th row ``aggregate``."""
    limit = cfg.merge_threshold
    return (
        F.when(ordinal.isNull() | (ordinal <= limit), F.lit("raw"))
        .when(ordinal % limit == 0, F.lit("aggregate"))
        .otherwise(F.lit("suppressed"))
    )


def _group_numbers(hashes) -> np.ndarray:
    if len(hashes) < 2:
        return np.zeros(len(hashes), np.int64)
    changed = pc.not_equal(hashes[1:], hashes[:-1]).to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.cumsum(changed))).astype(np.int64)


def _column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def _ints(batch, name) -> np.ndarray:
    return _column(batch, name).to_numpy(zero_copy_only=False).astype(np.int64)


def _folder(width):
    """Place the rows of sorted partitions, starting from the carried-in window."""

    def run(batches):
        last_hash, carry = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            hashes = _column(batch, "hash")
            if last_hash is None:
                start = _column(batch, "carry_start")[0].as_py()
                carry = None if start is None else (start, _column(batch, "carry_n")[0].as_py())
            elif hashes[0] != last_hash:
                carry = None
            starts, ordinals = fold(_group_numbers(hashes), _ints(batch, "us"), width, carry, _ints(batch, "more"))
            last_hash, carry = hashes[-1], (int(starts[-1]), int(ordinals[-1]))
            yield pa.RecordBatch.from_arrays(
                [_column(batch, "row_id"), hashes, pa.array(starts), pa.array(ordinals)],
                ["row_id", "hash", "window_us", "ordinal"],
            )

    return run


def _summariser(width):
    """Summarise what each partition hands over to the next one."""

    def run(batches):
        pid = heir = last_hash = latest = carry = None
        total, seen = 0, _ALWAYS
        times, places = [], []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            us, hashes = _ints(batch, "us"), _column(batch, "hash")
            if pid is None:
                pid, heir = (_column(batch, c)[0].as_py() for c in ("pid", "heir"))
                latest = _column(batch, "latest")[0].as_py()
            if latest is None:
                # the last fingerprint begins in this partition: its exit is known
                if last_hash is not None and hashes[0] != last_hash:
                    carry = None
                starts, ordinals = fold(_group_numbers(hashes), us, width, carry, _ints(batch, "more"))
                carry = (int(starts[-1]), int(ordinals[-1]))
            else:
                top = np.maximum.accumulate(us // 1000)
                higher = np.concatenate(([top[0] > seen], top[1:] > np.maximum(top[:-1], seen)))
                at = np.flatnonzero(higher)
                times.append(us[at])
                places.append(at + total)
                seen = max(seen, int(top[-1]))
            total += batch.num_rows
            last_hash = hashes[-1]
        if pid is None:
            return
        if latest is None:
            rows = ([_ALWAYS], [carry[0]], [carry[1]])
        else:
            entry, start, n = exits(
                np.concatenate(times), np.concatenate(places), total, width, latest
            )
            rows = (np.append(entry, _NEVER), np.append(start, 0), np.append(n, total))
        size = len(rows[0])
        for lo in range(0, size, 8192):
            part = [pa.array(np.asarray(r[lo : lo + 8192], np.int64)) for r in rows]
            many = len(part[0])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([last_hash.as_py()] * many, pa.binary()),
                    pa.array([pid] * many, pa.int32()),
                    pa.array([heir] * many, pa.int32()),
                    *part,
                ],
                ["hash", "pid", "heir", "entry", "exit_start", "exit_n"],
            )

    return run


def _chainer(width):
    """Follow each fingerprint through its partitions, in order."""

    def run(batches):
        current = state = None  # state: window reached after the previous partition
        done = False
        for batch in batches:
            out = {"pid": [], "carry_start": [], "carry_n": []}
            hashes = _column(batch, "hash").to_pylist()
            pids, heirs = _ints(batch, "pid"), _ints(batch, "heir")
            entry, start, n = (_ints(batch, c) for c in ("entry", "exit_start", "exit_n"))
            bounds = np.flatnonzero(np.diff(pids, prepend=-1)) if len(pids) else []
            for lo, hi in zip(bounds, [*bounds[1:], len(pids)]):
                here = (hashes[lo], int(pids[lo]))
                if here != current:
                    if current is None or here[0] != current[0]:
                        state = None
                    current, done = here, False
                if done:
                    continue
                due = _ALWAYS if state is None else state[0] // 1000 + width
                at = lo + int(np.searchsorted(entry[lo:hi], due, "left"))
                if at == hi:
                    continue
                done = True
                if entry[at] == _NEVER:
                    state = (state[0], state[1] + int(n[at]))
                else:
                    state = (int(start[at]), int(n[at]))
                # the window reached is what the next partition starts with
                out["pid"].append(int(heirs[lo]))
                out["carry_start"].append(state[0])
                out["carry_n"].append(state[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["pid"], pa.int32()),
                    pa.array(out["carry_start"], pa.int64()),
                    pa.array(out["carry_n"], pa.int64()),
                ],
                ["pid", "carry_start", "carry_n"],
            )

    return run


def folded(documents: DataFrame, cfg: PipelineConfig = PipelineConfig(), opened: DataFrame | None = None) -> DataFrame:
    """``(row_id, hash, window_us, ordinal)`` for every row that has a fingerprint.

    ``documents`` must have a stable ``row_id`` (see :func:`logmill.session.staged`).
    ``opened`` has the windows that are open before these rows: hash (binary), window_us,
    ordinal.  Each comes back as a row without ``row_id``, in front of its fingerprint:
    a row at the beginning of the window that stands for all the window holds.
    """
    width = cfg.merge_window_millis
    order = [c.alias(f"o{i}") for i, c in enumerate(arrival_order())]
    narrow = documents.where(F.col("event.hash").isNotNull()).select(
        "row_id",
        F.unhex("event.hash").alias("hash"),
        F.unix_micros("event_time").alias("us"),
        F.lit(0).cast("bigint").alias("more"),
        *order,
    )
    if opened is not None:
        first = opened.select("hash", F.col("window_us").alias("us"), (F.col("ordinal") - 1).alias("more"))
        narrow = narrow.unionByName(first, allowMissingColumns=True)
    keys = ["hash", *[f"o{i}" for i in range(len(order))], "row_id"]
    ranged = (
        narrow.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("row_id", "hash", "us", "more", F.spark_partition_id().alias("pid"))
    )
    rows = checkpointed(ranged)

    # one row per partition: which fingerprints it begins and ends with
    edges = rows.groupBy("pid").agg(
        F.min("hash").alias("first"), F.max(F.struct("hash", F.floor(F.col("us") / 1000).alias("ms"))).alias("last")
    )
    ordered = Window.orderBy("pid")
    same_chain = Window.partitionBy("last.hash").orderBy("pid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    linked = (
        edges.withColumn("before", F.lag("last.hash").over(ordered))
        .withColumn("after", F.lead("first").over(ordered))
        .withColumn("heir", F.lead("pid").over(ordered))
        .withColumn("prior", F.max("last.ms").over(same_chain))
    )
    whole = (F.col("first") == F.col("last.hash")) & (F.col("before") == F.col("first"))
    handing_over = linked.where(F.col("after") == F.col("last.hash")).select(
        "pid", "heir", F.when(whole, F.col("prior")).alias("latest")
    )
    # broadcasts hold one row per shuffle partition, whatever the data size
    summaries = (
        rows.join(F.broadcast(handing_over), "pid")
        .select("pid", "heir", "latest", "hash", "us", "more")
        .mapInArrow(
            _summariser(width),
            "hash binary, pid int, heir int, entry bigint, exit_start bigint, exit_n bigint",
        )
    )
    carried = (
        summaries.repartition("hash")
        .sortWithinPartitions("hash", "pid", "entry")
        .mapInArrow(_chainer(width), "pid int, carry_start bigint, carry_n bigint")
    )
    return (
        rows.join(F.broadcast(carried), "pid", "left")
        .select("row_id", "hash", "us", "more", "carry_start", "carry_n")
        .mapInArrow(_folder(width), "row_id bigint, hash binary, window_us bigint, ordinal bigint")
    )


def positions(documents: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """``(row_id, window_start, ordinal)`` for every row that has a fingerprint."""
    return folded(documents, cfg).select("row_id", F.timestamp_micros("window_us").alias("window_start"), "ordinal")


def last_of_windows(found: DataFrame) -> DataFrame:
    """``(hash, window_us, ordinal, row_id)`` of the last row of each window: its ordinal is the true count.

    An aggregation that combines before its shuffle, so a busy window is as cheap as others.
    """
    last = F.max(F.struct("ordinal", "row_id")).alias("last")
    return found.groupBy("hash", "window_us").agg(last).select("hash", "window_us", "last.*")


def has_window() -> Column:
    return F.col("failure").isNull() & F.col("event.hash").isNotNull()


def emitted(found: DataFrame, cfg: PipelineConfig, keep_suppressed: bool = False) -> DataFrame:
    """``(row_id, window_start, ordinal, action)`` of the rows to write, from :func:`folded` rows.

    ``merge_flush='threshold'``: raw rows up to the threshold, then a summary at every
    multiple of it.  ``'final'``: raw rows up to the threshold and, for windows that hold
    more, one summary at their last row, with the true count.
    """
    rows = found.where("row_id IS NOT NULL")
    limit = cfg.merge_threshold
    if cfg.merge_flush == "final":
        rows = checkpointed(rows)
        last = last_of_windows(rows).where(F.col("ordinal") > limit)
        first = rows.where(F.col("ordinal") <= limit).withColumn("action", F.lit("raw"))
        told = first.unionByName(last.withColumn("action", F.lit("aggregate")))
        if keep_suppressed:
            rest = rows.where(F.col("ordinal") > limit).join(last.select("row_id"), "row_id", "left_anti")
            told = told.unionByName(rest.withColumn("action", F.lit("suppressed")))
    else:
        told = rows.withColumn("action", emission(F.col("ordinal"), cfg))
        if not keep_suppressed:
            told = told.where(F.col("action") != "suppressed")
    return told.select("row_id", F.timestamp_micros("window_us").alias("window_start"), "ordinal", "action")


def with_positions(documents: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Documents with ``window_start``, ``ordinal`` and ``action``, suppressed rows included."""
    return _placed(documents, cfg, keep_suppressed=True)


def _placed(documents: DataFrame, cfg: PipelineConfig, keep_suppressed: bool) -> DataFrame:
    if not cfg.merge_enabled:
        return unplaced(documents)
    if "row_id" not in documents.columns:
        documents = staged(documents, "documents")
    understood = has_window()
    found = emitted(folded(documents.where(understood), cfg), cfg, keep_suppressed)
    placed = documents.where(understood).join(found, "row_id").drop("row_id")
    return placed.unionByName(unplaced(documents.where(~understood).drop("row_id")))


def unplaced(documents: DataFrame) -> DataFrame:
    """Documents outside any window: they are written as they are."""
    nothing = {"window_start": F.lit(None).cast("timestamp"), "ordinal": F.lit(None).cast("bigint")}
    return documents.withColumns({**nothing, "action": F.lit("raw")})


def aggregate_rows(documents: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Turn rows whose ``action`` is ``aggregate`` into window summaries.

    With ``merge_flush='final'`` they keep the stack trace of their last row.
    """
    is_aggregate = F.col("action") == "aggregate"
    attributes = F.create_map(
        F.lit("merge.window_start"),
        iso_instant(F.col("window_start")),
        F.lit("merge.window_end"),
        iso_instant(F.col("event_time")),
        F.lit("merge.occurrence_count"),
        F.col("ordinal").cast("string"),
        F.lit("merge.sample_message"),
        F.col("message"),
    )
    if cfg.merge_flush == "final":
        trace = F.create_map(F.lit("merge.sample_stack_trace"), F.col("error.stack_trace"))
        attributes = F.when(F.col("error.stack_trace").isNotNull(), F.map_concat(attributes, trace)).otherwise(attributes)
    event = (
        F.col("event")
        .withField("kind", F.lit("metric"))
        .withField("category", F.array(F.lit("application")))
        .withField("type", F.array(F.lit("aggregation")))
    )
    ingest = (
        F.col("ingest")
        .withField("truncated", F.lit(False))
        .withField("original_length", F.lit(None).cast("int"))
        .withField("message_preview", F.lit(None).cast("string"))
        .withField("message_hash", F.lit(None).cast("string"))
        .withField("policy", F.lit("merge-window"))
        .withField("raw_payload", F.lit(None).cast("string"))
    )
    doc_id = F.concat_ws(
        "-", F.lit("aggregate"), F.col("event.hash"), F.unix_millis("window_start").cast("string")
    )
    changed = {
        "id": doc_id,
        "message": F.lit(AGGREGATE_MESSAGE),
        "attributes": attributes,
        "event": event,
        "ingest": ingest,
    }
    return documents.withColumns(
        {name: F.when(is_aggregate, new).otherwise(F.col(name)) for name, new in changed.items()}
    )


def merge_anchored(documents: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Documents to write: raw rows and window summaries, suppressed rows left out."""
    kept = aggregate_rows(_placed(documents, cfg, keep_suppressed=False), cfg)
    return kept.drop("window_start", "ordinal")


def merge_tumbling(documents: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """True counts per fingerprint and fixed window, with first and last sample.

    A plain aggregation: partial results are combined map-side, so a frequent
    fingerprint costs no more than a rare one.  On a stream set a watermark first.
    """
    width = f"{cfg.merge_window_millis} milliseconds"
    order = F.struct(*arrival_order())
    return (
        documents.where(F.col("event.hash").isNotNull())
        .groupBy(F.col("event.hash").alias("hash"), F.window("event_time", width).alias("window"))
        .agg(
            F.count("*").alias("occurrence_count"),
            F.min("event_time").alias("first_seen"),
            F.max("event_time").alias("last_seen"),
            F.min_by("message", order).alias("first_message"),
            F.max_by("message", order).alias("last_message"),
        )
        .select(
            "hash",
            F.col("window.start").alias("window_start"),
            "occurrence_count",
            "first_seen",
            "last_seen",
            "first_message",
            "last_message",
        )
    )


def tumbling_parts(documents: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Counts of some rows that :func:`sum_parts` adds to those of other rows."""
    width = f"{cfg.merge_window_millis} milliseconds"
    sample = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(arrival_order())], F.col("message").alias("message"))
    return (
        documents.where(F.col("event.hash").isNotNull())
        .groupBy(F.col("event.hash").alias("hash"), F.window("event_time", width)["start"].alias("window_start"))
        .agg(
            F.count("*").alias("occurrence_count"),
            F.min("event_time").alias("first_seen"),
            F.max("event_time").alias("last_seen"),
            F.min(sample).alias("first"),
            F.max(sample).alias("last"),
        )
    )


def sum_parts(parts: DataFrame) -> DataFrame:
    """The result of :func:`merge_tumbling` from the parts of all rows."""
    summed = parts.groupBy("hash", "window_start").agg(
        F.sum("occurrence_count").alias("occurrence_count"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    return summed.select(
        "hash",
        "window_start",
        "occurrence_count",
        "first_seen",
        "last_seen",
        F.col("first.message").alias("first_message"),
        F.col("last.message").alias("last_message"),
    )
