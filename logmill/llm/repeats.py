"""Passages that repeat across documents, by sparse suffix arrays."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, keep, one_text_per_id, table, text_slices
from .hashing import Words, gram_hashes, minimisers, window_hashes

MIN_WORDS, PREFIX_WORDS = 50, 16
_WORD = re.compile(r"[^\x00-\x20]+")
_LAST = 2**63 - 1  # stands for a null id, which is ordered last


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


def sparse_suffixes(docs: DataFrame, min_words: int, prefix: int) -> DataFrame:
    """(head, doc): the suffixes kept, by the hash of their first ``prefix`` words.

    Kept are the suffixes that begin at a minimiser: of every window of ``min_words``
    words the place whose ``prefix`` words have the least hash.  Equal windows keep
    equal places, so a passage of ``min_words`` words has a kept suffix wherever it stands.
    """

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, ["text"], 1 << 20):
                words = Words(part.column("text"))
                grams = gram_hashes(words.hashes, prefix)
                chosen, _ = minimisers(grams, words.room(), prefix, min_words)
                docs_ = part.column("doc").to_numpy()[words.owners()[chosen]]
                yield pa.record_batch([_long(grams[chosen]), _long(docs_)], names=["head", "doc"])

    return bounded_batches(docs).select("text", "doc").mapInArrow(select, "head bigint, doc bigint")


def shared_heads(suffixes: DataFrame) -> DataFrame:
    """The suffixes whose neighbour in sorted order begins alike and stands in another document.

    Sorted by (head, doc) over range partitions, so a head that very many documents
    share spans many tasks.  The first and the last head of a partition may go on in the
    next one: their suffixes pass too, to be refuted or confirmed by the extension.
    """
    ordered = suffixes.repartitionByRange("head", "doc").sortWithinPartitions("head", "doc")

    return ordered.mapInArrow(_compare_neighbours, "head bigint, doc bigint")


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # a batch is held back until the next shows how its last head goes on
    head, doc, first, passed = None, None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        h, d = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        head, doc = (h, d) if head is None else (np.concatenate([head, h]), np.concatenate([doc, d]))
        first = head[0] if first is None else first
        whole = int(np.searchsorted(head, head[-1], side="left"))
        # a head that fills whole batches is passed on piece by piece: it is shared or an edge
        if whole == 0 and len(head) > 1 << 18:
            pass_on, whole, passed = np.ones(len(head) - 1, dtype=bool), len(head) - 1, head[-1]
        else:
            pass_on = _differ(head[:whole], doc[:whole]) | (head[:whole] == first)
            if passed is not None:
                # the rest of a head whose beginning was passed on
                pass_on |= head[:whole] == passed
        yield pa.record_batch([_long(head[:whole][pass_on]), _long(doc[:whole][pass_on])], names=["head", "doc"])
        head, doc = head[whole:], doc[whole:]
    if head is not None:
        yield pa.record_batch([_long(head), _long(doc)], names=["head", "doc"])


def _differ(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Per row of a sorted run whether its key stands in more than one document."""
    if not len(key):
        return np.zeros(0, dtype=bool)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    ends = np.concatenate([starts[1:], [len(key)]])
    return np.repeat(doc[starts] != doc[ends - 1], ends - starts)


def extended(docs: DataFrame, shared: DataFrame, min_words: int, prefix: int) -> DataFrame:
    """(passage, doc, start): every window of ``min_words`` words around a shared suffix.

    A match of ``min_words`` words that holds the suffix reaches some words to its left
    and the others to its right.  Each division of the two is one window; the windows
    whose minimiser the suffix is are all that need looking at.
    """
    heads = shared.groupBy("doc").agg(F.collect_set("head").alias("heads"))
    joined = docs.select("text", "doc").join(heads.hint("merge"), "doc").select("text", "doc", "heads")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, ["text"], 1 << 20):
                words = Words(part.column("text"))
                _, least = minimisers(gram_hashes(words.hashes, prefix), words.room(), prefix, min_words)
                lists = part.column("heads")
                values = lists.flatten().to_numpy().view(np.uint64)
                taken = np.zeros(len(least), dtype=bool)
                at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                for i in range(part.num_rows):
                    a, b = words.first[i], words.first[i + 1]
                    taken[a:b] = np.isin(least[a:b], values[at[i] : at[i + 1]])
                taken &= least > 0
                owner = words.owners()[taken]
                passage = window_hashes(words.hashes, min_words, seed=1)[taken]
                start = (np.flatnonzero(taken) - words.first[owner]).astype(np.int32)
                yield pa.record_batch(
                    [_long(passage), _long(part.column("doc").to_numpy()[owner]), pa.array(start)], names=["passage", "doc", "start"]
                )

    return joined.mapInArrow(extend, "passage bigint, doc bigint, start int")


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, prefix: int = PREFIX_WORDS) -> DataFrame:
    """Per document with repeats: doc_id, spans and cuts.

    A word is a run of characters above the space.  ``spans`` are the maximal runs of
    words covered by passages of ``min_words`` words that some other document holds too
    (start, end, first_doc: the smallest id that holds a part of it).  ``cuts`` are the
    runs covered by passages that a document of smaller id holds: without them, every
    passage is left in one document.

    * Null and short texts have no passages; a null id is ordered last.
    * Rows of equal id and text are one document.  Of several texts of an id only one
      takes part (see :func:`one_text_per_id`); repeats within a document don't count.
    * Passages are compared by 64-bit hashes.  No rows give no rows.

    Shuffled are the kept suffixes (some 7 % of the words), once the texts, and the
    windows around shared suffixes.  A passage in very many documents is summed up before
    the shuffle; its windows, some 20 bytes each, meet the sum in one task.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc")
    texts = one_text_per_id(docs.select("doc_id", "text").where("text IS NOT NULL")).select(doc, "text")
    suffixes = keep(sparse_suffixes(texts, min_words, prefix), "suffixes")
    shared = keep(shared_heads(suffixes), "shared-suffixes")
    windows = keep(extended(texts, shared, min_words, prefix), "windows")
    firsts = windows.groupBy("passage").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
    firsts = firsts.where("first_doc <> last_doc").select("passage", "first_doc")
    hits = windows.join(firsts, "passage").select("doc", "start", "first_doc")
    found = hits.groupBy("doc").agg(F.collect_list(F.struct("start", "first_doc")).alias("hits"))
    span = "array<struct<start:int,end:int,first_doc:bigint>>"

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            hits_ = batch.column("hits")
            start = pa.compute.struct_field(hits_.flatten(), "start").to_numpy()
            first = pa.compute.struct_field(hits_.flatten(), "first_doc").to_numpy()
            ends = np.cumsum(hits_.value_lengths().to_numpy())
            rows = []
            for doc, a, b in zip(batch.column("doc").to_pylist(), np.concatenate([[0], ends[:-1]]), ends):
                earlier = first[a:b] < doc
                rows.append((_runs(start[a:b], first[a:b], min_words), _runs(start[a:b][earlier], first[a:b][earlier], min_words)))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("first_doc", pa.int64())]))
            yield pa.record_batch([batch.column("doc"), pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], kind)], names=["doc", "spans", "cuts"])

    merged = found.mapInArrow(merge, f"doc bigint, spans {span}, cuts {span}")
    return merged.select(F.nullif("doc", F.lit(_LAST)).alias("doc_id"), "spans", "cuts")


def _runs(start: np.ndarray, first: np.ndarray, width: int) -> list[dict]:
    """Windows united to runs that overlap or touch."""
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, first = start[order], first[order]
    cut = np.flatnonzero(np.concatenate([[True], start[1:] > start[:-1] + width]))
    last = np.concatenate([cut[1:], [len(start)]]) - 1
    least = np.minimum.reduceat(first, cut)
    return [{"start": int(a), "end": int(b) + width, "first_doc": int(f)} for a, b, f in zip(start[cut], start[last], least)]


def _without(text: str, cuts) -> str:
    """``text`` without the word runs of ``cuts`` and the white space behind them."""
    words = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for cut in cuts:
        out.append(text[at : words[cut["start"]][0]])
        at = words[cut["end"]][0] if cut["end"] < len(words) else len(text)
    return "".join(out) + text[at:]


def cut_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with every repeated passage left in the document of smallest id only.

    Columns stay as they are; n_chars, where there is one, follows the text.  Rows of
    which nothing is left go; rows that lose nothing stay as they were.
    """

    @F.pandas_udf("string")
    def remaining(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        return pd.Series([None if c is None else _without(t, c) for t, c in zip(texts, cuts)], dtype=object)

    cuts = repeated_spans(docs, min_words).where(F.size("cuts") > 0)
    h = F.xxhash64("text")
    # the text that took part, where an id has several
    cuts = keep(cuts.select("doc_id", "cuts"), "cuts")
    cut_ids = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id"))
    chosen = keep(
        one_text_per_id(docs.select("doc_id", "text").where("text IS NOT NULL")).select("doc_id", h.alias("h")).alias("d")
        .join(cuts.alias("c"), cut_ids).select("d.doc_id", "d.h", "c.cuts").dropDuplicates(["doc_id", "h"]),
        "cuts-by-text",
    )
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", h.alias("h")).alias("d")
    on = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.h") == F.col("c.h"))
    joined = rows.join(chosen.alias("c").hint("merge"), on, "left").select("d.doc", "c.cuts")
    # only texts that lose something go to Python
    lost = F.col("cuts").isNotNull()
    # evaluated once: a filter on it, pushed below, would take a second Python worker beside each task
    once = remaining.asNondeterministic()
    left = joined.withColumn("left", once(F.when(lost, F.col("doc.text")), F.col("cuts")))
    left = left.where(~lost | (F.trim("left") != ""))
    changed = {"text": F.col("left"), "n_chars": F.length("left")}
    return left.select(
        *[
            (F.when(lost, changed[c].cast(docs.schema[c].dataType)).otherwise(F.col(f"doc.`{c}`")) if c in changed else F.col(f"doc.`{c}`")).alias(c)
            for c in docs.columns
        ]
    )


def op2_repeated_passages(spark, sf_dir):
    """One row per passage of 50 words or more that another document holds too."""
    rows = repeated_spans(table(spark, sf_dir, "documents")).select("doc_id", "cuts", F.explode("spans").alias("s"))
    within = F.filter("cuts", lambda c: (c["start"] < F.col("s.end")) & (c["end"] > F.col("s.start")))
    removed = F.aggregate(
        within,
        F.lit(0),
        lambda n, c: n + F.least(c["end"], F.col("s.end")) - F.greatest(c["start"], F.col("s.start")),
    )
    return rows.select(
        "doc_id", F.col("s.start").alias("start_word"), F.col("s.end").alias("end_word"),
        F.col("s.first_doc").alias("first_doc_id"), removed.alias("removed_words"),
    )


OP2_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[\x00-\x20]+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL),
windows AS (
  SELECT doc_id, start, md5(array_to_string(w[start + 1:start + 50], ' ')) AS passage
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS start FROM words WHERE len(w) >= 50)),
firsts AS (SELECT passage, min(doc_id) AS first_doc FROM windows GROUP BY passage HAVING min(doc_id) <> max(doc_id)),
hits AS (SELECT doc_id, start, first_doc FROM windows JOIN firsts USING (passage)),
marked AS (
  SELECT *, CASE WHEN start <= lag(start) OVER (PARTITION BY doc_id ORDER BY start) + 50 THEN 0 ELSE 1 END AS opens FROM hits),
runs AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY start) AS run FROM marked),
spans AS (
  SELECT doc_id, run, min(start)::INT AS start_word, (max(start) + 50)::INT AS end_word, min(first_doc) AS first_doc_id FROM runs GROUP BY ALL),
gone AS (
  SELECT doc_id, run, count(DISTINCT word) AS n
  FROM (SELECT doc_id, run, unnest(range(start, start + 50)) AS word FROM runs WHERE first_doc < doc_id) GROUP BY ALL)
SELECT doc_id, start_word, end_word, first_doc_id, coalesce(n, 0)::INT AS removed_words
FROM spans LEFT JOIN gone USING (doc_id, run)
"""
