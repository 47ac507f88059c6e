"""Near copies by Order MinHash, verified by banded alignment."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, discard, keep, one_text_per_id, packed, table, text_slices
from .components import components
from .hashing import Words, gram_hashes, mix64

SHINGLE, SIMILARITY = 3, 0.8
SKETCHES, PER_SKETCH = 48, 2
# texts of at most so many words: shingle, sketches, shingles per sketch
SHORT = ((16, 2, 24, 1), (60, 2, 40, 2))
PAIR_GROUP = 256
# documents of a block; bins that words are counted in, and those of a first, coarse look
BLOCK, BINS, COARSE = 256, 4096, 128
COLUMNS = 1024
# every so manieth sketch is looked at first
FIRST_SKETCHES = 6
# further hubs are drawn, for at most so many turns, while this share of their pairs is linked and
# more pairs than this are left; the classes are the same whenever the turns end, since all pairs
# left are tested
LINKED = 0.1
TURNS, PAIRS, PAIRS_A_ROW = 8, 100_000, 2
_LAST = 2**63 - 1  # stands for a null id, which is ordered last
_SEEDS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = 32
# after so many edits along the diagonals, or one per so many pairs of words, an alignment is done over by
# the bits of columns; those of longer texts would take much memory
FEW_EDITS, CELLS, COLUMN = 8, 400_000, 8192


def order_minhash(grams: np.ndarray, sketches: int, size: int) -> np.ndarray:
    """One key per sketch: the ``size`` least occurrence-labelled k-mers, in text order.

    A k-mer that stands n times counts as n elements, so the sketch sees multiplicity;
    the order of the chosen ones makes it sensitive to edits that move text.
    """
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(grams)), 0))
    label = np.empty(len(grams), dtype=np.uint64)
    label[order] = (np.arange(len(grams)) - begin).astype(np.uint64)
    elements = mix64(grams + label * np.uint64(0xD1B54A32D192ED03))
    keys = np.empty(sketches, dtype=np.uint64)
    size = min(size, len(grams))
    for low in range(0, sketches, max(1, (1 << 20) // len(grams))):
        seeds = _SEEDS[low : min(sketches, low + max(1, (1 << 20) // len(grams)))]
        values = mix64(elements[None, :] ^ seeds[:, None])
        least = np.sort(np.argpartition(values, size - 1, axis=1)[:, :size], axis=1)
        key = np.zeros(len(seeds), dtype=np.uint64)
        for i in range(size):
            key = mix64(key * np.uint64(31) + grams[least[:, i]])
        keys[low : low + len(seeds)] = key
    return keys


def within(a: list[int], b: list[int], allowed: int) -> bool:
    """Whether ``allowed`` edits turn the words ``a`` into ``b``: Myers' bit vectors.

    Bit i of ``up`` and ``down`` tells whether the column of a word of ``b`` rises or falls
    at word i of ``a``; a Python integer holds a whole column.
    """
    at: dict[int, int] = {}
    for i, word in enumerate(a):
        at[word] = at.get(word, 0) | (1 << i)
    every, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, edits, left = every, 0, len(a), len(b)
    for word in b:
        same = at.get(word, 0)
        # all steps are between 0 and 1 word by word, so bits beyond the column are cut off
        vertical = same | down
        across = (((same & up) + up) ^ up) | same
        rise, fall = down | (every & ~(across | up)), up & across
        left -= 1
        if rise & last:
            edits += 1
        elif fall & last:
            edits -= 1
        # each word that is left saves one edit at most
        if edits - left > allowed:
            return False
        rise = rise << 1 | 1
        up, down = ((fall << 1) | ~(vertical | rise)) & every, rise & vertical & every
    return edits <= allowed


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether 1 - edits / longer length reaches ``threshold``; words are the letters.

    An alignment with at most e edits stays within e of the main diagonal.  For each
    number of edits the furthest place on every diagonal of that band is kept, until one
    reaches the end or the edits allowed are used up; :func:`within` decides on pairs of
    more than FEW_EDITS.
    """
    longer = max(len(a), len(b))
    allowed = int((1 - threshold) * longer + 1e-9)
    if abs(len(a) - len(b)) > allowed:
        return False
    if len(a) == len(b) and int((a != b).sum()) <= allowed:
        return True
    short = min(len(a), len(b))
    apart = np.flatnonzero(a[:short] != b[:short])
    head = int(apart[0]) if len(apart) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    if short:
        apart = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
        tail = int(apart[0]) if len(apart) else short
        a, b = a[: len(a) - tail], b[: len(b) - tail]
    n, m = len(a), len(b)
    if not n or not m:
        return max(n, m) <= allowed
    # every word of the longer text without a partner costs an edit
    values, place, counts = np.unique(a, return_index=True, return_counts=True)
    others, other_place, other_counts = np.unique(b, return_index=True, return_counts=True)
    at = np.searchsorted(values, others)
    hit = at < len(values)
    hit[hit] = values[at[hit]] == others[hit]
    shared = int(np.minimum(counts[at[hit]], other_counts[hit]).sum())
    if max(n, m) - shared > allowed:
        return False
    # words that stand once on either side, in one order: aligning them is an upper bound
    single = (counts[at[hit]] == 1) & (other_counts[hit] == 1)
    x, y = place[at[hit]][single], other_place[hit][single]
    order = np.argsort(x)
    x, y = x[order], y[order]
    if len(y):
        chain = (y == np.maximum.accumulate(y)) & (y == np.minimum.accumulate(y[::-1])[::-1])
        x, y = np.concatenate([[-1], x[chain], [n]]), np.concatenate([[-1], y[chain], [m]])
        if int(np.maximum(np.diff(x), np.diff(y)).sum()) - len(x) + 1 <= allowed:
            return True
    left = np.concatenate([a, np.zeros(_STEP, dtype=a.dtype)])
    right = np.concatenate([b, np.ones(_STEP, dtype=b.dtype)])
    blocks_a = np.lib.stride_tricks.sliding_window_view(left, _STEP)
    blocks_b = np.lib.stride_tricks.sliding_window_view(right, _STEP)

    def slide(i: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Furthest place of equal words along the diagonals."""
        i = i.copy()
        live = np.flatnonzero((i < n) & (i + diagonal < m) & (i >= 0) & (i + diagonal >= 0))
        while len(live):
            x, y = i[live], i[live] + diagonal[live]
            differ = blocks_a[x] != blocks_b[y]
            run = np.where(differ.any(axis=1), differ.argmax(axis=1), _STEP)
            run = np.minimum(run, np.minimum(n - x, m - y))
            i[live] = x + run
            live = live[(run == _STEP) & (i[live] < n) & (i[live] + diagonal[live] < m)]
        return i

    goal = m - n
    far = slide(np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))
    low = 0
    if goal == 0 and far[0] >= n:
        return True
    never = np.int64(-(1 << 40))
    few = max(FEW_EDITS, n * m // CELLS) if n <= COLUMN else allowed
    for edits in range(1, allowed + 1):
        if edits > few:
            return within(a.tolist(), b.tolist(), allowed)
        wide = np.concatenate([[never, never], far, [never, never]])
        # diagonals low - 1 .. high + 1: insertion, substitution, deletion
        best = np.maximum(np.maximum(wide[:-2], wide[1:-1] + 1), wide[2:] + 1)
        low -= 1
        diagonal = np.arange(low, low + len(best))
        best = np.minimum(best, np.minimum(n, m - diagonal))
        # a place from which the goal needs more edits than are left is not followed
        usable = (best >= 0) & (best + diagonal >= 0) & (np.abs(goal - diagonal) <= allowed - edits)
        best = np.where(usable, best, never)
        far = slide(best, diagonal)
        at = goal - low
        if 0 <= at < len(far) and far[at] >= n:
            return True
        keep_ = np.flatnonzero(far >= 0)
        if not len(keep_):
            return False
        low, far = int(diagonal[keep_[0]]), far[keep_[0] : keep_[-1] + 1]
    return False


def text_keys(words: np.ndarray, first: np.ndarray, shingle: int, sketches: int, size: int, threshold: float) -> list[np.ndarray]:
    """The sketch keys of texts: words first[i]:first[i + 1] belong to text i.

    Short texts have few shingles and an edit spoils more of them, so they have sketches of
    their own.  A text so near to a limit of SHORT that a similar one may be beyond it has
    the sketches of both sides: two texts of ``threshold`` always have a kind in common.
    """
    out: list[list[np.ndarray]] = [[] for _ in range(len(first) - 1)]
    lengths, least = np.diff(first), 1
    for kind, (most, k, n, per) in enumerate((*SHORT, (np.inf, shingle, sketches, size))):
        grams = gram_hashes(words, k)
        salt = mix64(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(kind << 32))
        for i in np.flatnonzero((lengths >= least) & (lengths <= most)):
            a, b = int(first[i]), int(first[i + 1])
            own = grams[a : b - k + 1] if b - a >= k else gram_hashes(words[a:b], b - a)[:1]
            out[i].append(mix64(order_minhash(own, n, per) ^ salt))
        if most < np.inf:
            least = math.ceil(threshold * (most + 1) - 1e-9)
    return [np.concatenate(keys) if keys else np.empty(0, dtype=np.uint64) for keys in out]


def sketched(texts: DataFrame, shingle: int, sketches: int, size: int, threshold: float = SIMILARITY) -> DataFrame:
    """(doc, keys): the sketch keys of every text with a word; texts below a shingle are one."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, ["text"], 1 << 20):
                words = Words(part.column("text"), lower=True)
                keys = text_keys(words.hashes, words.first, shingle, sketches, size, threshold)
                rows = [i for i, own in enumerate(keys) if len(own)]
                if rows:
                    lists = pa.array([keys[i].view(np.int64) for i in rows], pa.list_(pa.int64()))
                    yield pa.record_batch([part.column("doc").take(pa.array(rows)), lists], names=["doc", "keys"])

    return bounded_batches(texts).select("text", "doc").mapInArrow(sketch, "doc bigint, keys array<bigint>")


def shared_buckets(entries: DataFrame) -> DataFrame:
    """(bucket, doc, weight, root): the entries (bucket, doc, root) of buckets with several roots.

    Near copies share most of their sketches, so many buckets hold the same documents as
    others: of those with equal sets one is enough.  Sets are compared by their size and
    128 bits of a sum that does not depend on the order.  ``weight`` is the number of
    entries in all buckets of the document: what most copies come from shares its buckets
    with more of them than they share with each other.

    The joins are planned as a shuffle at every size: the right sides grow with the rows, and
    a small input tells what a large one will move.
    """
    several = entries.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    # a table of its own: Spark splits a skewed join only where no aggregation shares its stage
    several = keep(several.select("bucket"), "several-roots")
    shared = keep(entries.join(several.hint("merge"), "bucket"), "shared-buckets")
    small = packed(shared)
    marks = [F.bit_xor(F.xxhash64("doc", F.lit(seed))).alias(f"s{seed}") for seed in (1, 2)]
    sets = shared.groupBy("bucket").agg(F.count("*").alias("n"), *marks)
    sets = keep(small(sets.groupBy("n", "s1", "s2").agg(F.min("bucket").alias("bucket")).select("bucket", "n")), "bucket-sets")
    discard(several)
    entries = keep(small(shared.join(sets.hint("merge"), "bucket")), "different-buckets")
    discard(shared, sets)
    weights = keep(small(entries.groupBy("doc").agg(F.sum("n").alias("weight"))), "weights")
    weighed = keep(small(entries.select("bucket", "doc", "root").join(weights.hint("merge"), "doc")), "weighed-buckets")
    discard(entries, weights)
    return weighed


def star_hubs(entries: DataFrame, turn: int) -> DataFrame:
    """(bucket, hub, hub_root): one document of every bucket.

    It is the document of most weight, in later turns one drawn anew by hash.  As many
    pairs as members: a bucket of any size is summed up before the shuffle.
    """
    draw = F.col("weight") if turn == 0 else F.xxhash64("doc", F.lit(turn))
    hubs = entries.groupBy("bucket").agg(F.max(F.struct(draw.alias("draw"), (-F.col("doc")).alias("minus"), "root")).alias("top"))
    hubs = hubs.select("bucket", (-F.col("top.minus")).alias("hub"), F.col("top.root").alias("hub_root"))
    return keep(packed(entries)(hubs), "hubs")


def with_roots(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """``entries`` with the ``root`` of their documents, of buckets that hold several roots."""
    of = roots.select(F.col("node").alias("doc"), "root")
    small = packed(entries)
    entries = entries.drop("root").join(of, "doc", "left").withColumn("root", F.coalesce("root", "doc"))
    rooted = keep(small(entries), "rooted")
    by_root = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    by_root = keep(small(by_root.select("bucket")), "open-buckets")
    left = keep(small(rooted.join(by_root, "bucket")), "open-entries")
    discard(rooted, by_root)
    return left


def untested(entries: DataFrame) -> int:
    """Pairs of different roots in the buckets."""
    by_root = entries.groupBy("bucket", "root").count()
    by_bucket = by_root.groupBy().agg(F.sum(F.col("count") * F.col("count")).alias("same"))
    sizes = entries.groupBy("bucket").count().groupBy().agg(F.sum(F.col("count") * F.col("count")).alias("all"))
    row = sizes.crossJoin(by_bucket).first()
    return ((row["all"] or 0) - (row["same"] or 0)) // 2


def word_bins(words: DataFrame) -> DataFrame:
    """(doc, size, bins): the word hashes of documents modulo BINS, two bytes each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = [(np.frombuffer(w, dtype=np.uint64) % np.uint64(BINS)).astype("<u2").tobytes() for w in batch.column("words").to_pylist()]
            yield pa.record_batch([batch.column("doc"), batch.column("size"), pa.array(bins, pa.binary())], names=["doc", "size", "bins"])

    return bounded_batches(words.select("doc", "size", "words")).mapInArrow(cut, "doc bigint, size bigint, bins binary")


def share_one(lists: list[list[int]]) -> np.ndarray:
    """Which two of the lists have a value in common."""
    out = np.zeros((len(lists), len(lists)), dtype=bool)
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    values, column, counts = np.unique(np.array([v for x in lists for v in x], dtype=np.int64), return_inverse=True, return_counts=True)
    # numbered without those of a single list
    number = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[column] if len(values) else column
    for low in range(0, int(number.max(initial=-1)) + 1, COLUMNS):
        part = (number >= low) & (number < low + COLUMNS)
        held = np.zeros((len(lists), COLUMNS), dtype=np.float32)
        held[row[part], number[part] - low] = 1
        out |= held @ held.T > 0
    return out


def edits_needed(more: np.ndarray) -> np.ndarray:
    """Least edits between texts whose counts of words differ by the rows of ``more``.

    An edit changes one word on either side.
    """
    return np.maximum(np.maximum(more, 0).sum(axis=1), np.maximum(-more, 0).sum(axis=1))


def block_pairs(entries: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    """(doc, hub): all pairs of a bucket in different components that may be similar.

    A bucket is cut into blocks of about BLOCK documents and each pair of blocks is a
    group of its own, so no task holds a bucket.  Of the buckets that hold both documents
    of a pair, only the first looks at it.  A pair is left out only if its lengths or the
    counts of its words show that it needs more edits than allowed: texts with a long
    passage in common share nearly all buckets, and most of them are no copies.
    """
    sizes = entries.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sizes = keep(packed(entries)(sizes), "blocks")
    # as many buckets a document as it has sketches
    held = entries.groupBy("doc").agg(F.collect_set("bucket").alias("buckets"))
    placed = entries.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    placed = placed.join(word_bins(words).join(held, "doc"), "doc")
    placed = placed.withColumn("earlier", F.filter("buckets", lambda b: b < F.col("bucket")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    held_by = ["own", "doc", "root", "size", "bins", "earlier"]
    spread = placed.select("bucket", *held_by, other)
    spread = spread.select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), *held_by)
    schema = pa.schema([("doc", pa.int64()), ("hub", pa.int64())])

    def pairs(group: pa.Table) -> pa.Table:
        own, doc, root, size = (group[c].to_numpy() for c in ("own", "doc", "root", "size"))
        met = share_one(group["earlier"].to_pylist())
        bins = np.empty((group.num_rows, BINS), dtype=np.uint8)
        coarse = np.empty((group.num_rows, COARSE), dtype=np.int16)
        for k, row in enumerate(group["bins"]):
            bins[k] = np.minimum(np.bincount(np.frombuffer(row.as_py(), dtype="<u2"), minlength=BINS), 255)
            coarse[k] = bins[k].reshape(-1, COARSE).sum(axis=0)
        low, high = group["low"][0].as_py(), group["high"][0].as_py()
        found = [np.empty((0, 2), dtype=np.int64)]
        for i in np.flatnonzero(own == low):
            # within one block each pair once, between two blocks every pair
            js = np.flatnonzero((own == high) & (root != root[i]) & ((doc > doc[i]) | (low != high)) & ~met[i])
            longer = np.maximum(size[js], size[i])
            allowed = ((1 - threshold) * longer + 1e-9).astype(np.int64)
            for may in (
                lambda js: np.abs(size[js] - size[i]),
                lambda js: edits_needed(coarse[js] - coarse[i]),
                lambda js: edits_needed(bins[js] - bins[i].astype(np.int16)),
            ):
                near = may(js) <= allowed
                js, allowed = js[near], allowed[near]
            found.append(np.stack([np.maximum(doc[js], doc[i]), np.minimum(doc[js], doc[i])], axis=1))
        both = np.concatenate(found)
        return pa.Table.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], schema=schema)

    return spread.groupBy("bucket", "low", "high").applyInArrow(pairs, "doc bigint, hub bigint")


def words_of(texts: DataFrame, entries: DataFrame) -> DataFrame:
    """(doc, words, size): the word hashes of the documents of ``entries``."""
    involved = entries.select("doc").distinct()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, ["text"], 1 << 20):
                w = Words(part.column("text"), lower=True)
                lists = [w.hashes[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
                columns = [pa.array([h.tobytes() for h in lists], pa.binary()), pa.array([len(h) for h in lists], pa.int64())]
                yield pa.record_batch([part.column("doc"), *columns], names=["doc", "words", "size"])

    # as many documents as there are near copies: planned as a shuffle at every size
    needed = texts.join(involved.hint("merge"), "doc").select("text", "doc")
    return keep(needed.mapInArrow(words, "doc bigint, words binary, size bigint"), "words")


def verified(pairs: DataFrame, words: DataFrame, threshold: float) -> tuple[int, DataFrame]:
    """How many different (doc, hub) ``pairs`` there are, and those whose texts align.

    The words of a hub meet the words of its documents in groups of about PAIR_GROUP
    documents, so a hub of very many documents spans many groups.
    """
    pairs = keep(pairs.select("doc", "hub").distinct(), "pairs")
    words = words.select("doc", "words")
    small = packed(pairs)
    # a table of its own, so that Spark splits the join at a hub of very many documents
    sizes = keep(small(pairs.groupBy("hub").agg(F.ceil(F.count("*") / PAIR_GROUP).alias("groups"))), "hub-sizes")
    placed = keep(small(pairs.join(sizes, "hub").withColumn("part", F.pmod(F.xxhash64("doc"), F.col("groups")))), "placed-pairs")
    members = placed.join(words, "doc").select("hub", "part", "doc", "words")
    hubs = placed.select("hub", "part").distinct().join(words.withColumnRenamed("doc", "hub"), "hub").select("hub", "part", "words")
    members, hubs = members.toDF("hub", "part", "doc", "words"), hubs.toDF("hub", "part", "words")
    schema = pa.schema([("doc", pa.int64()), ("hub", pa.int64())])

    def align(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        hub = np.frombuffer(right["words"][0].as_py(), dtype=np.uint64)
        good = [similar(np.frombuffer(w.as_py(), dtype=np.uint64), hub, threshold) for w in left["words"]]
        left = left.filter(pa.array(good, pa.bool_()))
        return pa.Table.from_arrays([left["doc"], left["hub"]], schema=schema)

    aligned = members.groupBy("hub", "part").cogroup(hubs.groupBy("hub", "part")).applyInArrow(align, "doc bigint, hub bigint")
    links = keep(aligned, "links")
    tested = pairs.count()
    discard(pairs, sizes, placed)
    return tested, links


def classes(
    docs: DataFrame, shingle: int = SHINGLE, threshold: float = SIMILARITY, sketches: int = SKETCHES, per_sketch: int = PER_SKETCH
) -> DataFrame:
    """(doc_id, class_id, class_size) for every row: near copies share a class.

    Two texts are linked if their edit similarity over words (A-Z in lower case) is
    ``threshold`` or more; a class is a connected component, its id the smallest doc_id,
    its size the number of its rows.

    Texts of equal bytes are one text.  Texts that share a sketch meet in a bucket, and
    each is aligned with the bucket's hub, the document that shares most: first in the
    buckets of some sketches, then in those of all sketches that still hold several
    components.  While that links many, further hubs are drawn; then all pairs of a
    bucket that are still in different components are tested.  So every two similar texts
    that share a sketch are in one class.  Near copies cost pairs that grow with the
    rows; the last step grows with the square of a bucket only as far as its documents
    are not copies of each other, and counts of words rule out most of those.

    * Null and empty texts: empty texts are copies of each other, null texts too.
    * Rows of equal id and text are one document.  Of several texts of an id, and of
      rows without id, one takes part; the others are classes of their own (class_id is
      their doc_id) and keep it.
    * Texts shorter than a shingle are one shingle.  No rows give no rows.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    digest = F.coalesce(F.md5("text"), F.lit(""))
    rows = docs.select(doc.alias("doc"), digest.alias("digest"), F.xxhash64("text").alias("h"))
    rows = keep(rows, "digests")
    low = rows.groupBy("doc").agg(F.min("h").alias("h"))
    part = rows.join(low, ["doc", "h"])
    firsts = part.groupBy("digest").agg(F.min("doc").alias("first"))
    members = keep(part.select("doc", "digest").distinct().join(firsts, "digest").select("doc", "first"), "members")
    # the copies that need no sketch: few beside the rows, or else a plain join
    texts = one_text_per_id(docs.select("doc_id", "text").where("text IS NOT NULL")).select(doc.alias("doc"), "text")
    sketch = sketched(texts, shingle, sketches, per_sketch, threshold).dropDuplicates(["doc"])
    sketch = keep(sketch.join(members.where("doc = first").select("doc"), "doc"), "sketches")
    enough = max(PAIRS_A_ROW * rows.count(), PAIRS)
    links = None
    # first some of the sketches link most copies; then all of them, in buckets of several components
    for part_of in (FIRST_SKETCHES, 1):
        keys = F.filter("keys", lambda key, i: i % part_of == 0)
        if links is None:
            entries = sketch.select("doc", F.col("doc").alias("root"), F.explode(keys).alias("bucket"))
        else:
            found = roots.select(F.col("node").alias("doc"), "root")
            entries = sketch.join(found, "doc", "left").select("doc", F.coalesce("root", "doc").alias("root"), F.explode(keys).alias("bucket"))
        open_ = shared_buckets(entries)
        words = words_of(texts, open_)
        left = untested(open_)
        for turn in range(TURNS if left else 0):
            # the hub meets all others of its bucket, so it leaves it
            hubs = star_hubs(open_, turn)
            others = keep(packed(open_)(open_.join(hubs, "bucket").where("doc <> hub")), "stars")
            discard(open_, hubs)
            tested, more = verified(others.where("root <> hub_root"), words, threshold)
            links = more if links is None else links.unionByName(more)
            open_ = others.drop("hub", "hub_root")
            open_.kept_at = others.kept_at
            if part_of > 1 or more.count() < LINKED * tested:
                # hubs bring few links more: what is left are hardly copies
                break
            roots = components(links.select(F.col("doc").alias("a"), F.col("hub").alias("b")))
            open_ = with_roots(open_, roots)
            discard(others)
            left = untested(open_)
            if left <= enough:
                break
        if links is None:
            links = sketch.select("doc", F.col("doc").alias("hub")).limit(0)
        if part_of > 1:
            roots = components(links.select(F.col("doc").alias("a"), F.col("hub").alias("b")))
            discard(open_, words)
    if left:
        # all that is left, whatever its number
        _, last = verified(block_pairs(open_, words, threshold), words, threshold)
        links = links.unionByName(last)
    roots = components(links.select(F.col("doc").alias("a"), F.col("hub").alias("b")))
    texts_of = members.join(roots.select(F.col("node").alias("first"), "root"), "first", "left")
    of_doc = texts_of.select("doc", F.coalesce("root", "first").alias("class"))
    found = keep(part.join(of_doc, "doc").select("doc", "class"), "classes")
    sizes = keep(found.groupBy("class").agg(F.count("*").alias("class_size")), "class-sizes")
    sized = found.join(sizes, "class").select(F.nullif("doc", F.lit(_LAST)).alias("doc_id"), F.nullif("class", F.lit(_LAST)).alias("class_id"), "class_size")
    others = rows.alias("r").join(low.alias("l"), (F.col("r.doc") == F.col("l.doc")) & (F.col("r.h") != F.col("l.h")))
    others = others.select(F.nullif("r.doc", F.lit(_LAST)).alias("doc_id"), F.nullif("r.doc", F.lit(_LAST)).alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return sized.unionByName(others)


def without_near_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of every class: the one of smallest doc_id, columns unchanged.

    Rows without id and further texts of an id have no class and stay.
    """
    found = classes(docs, **options)
    gone = keep(found.where("class_id <> doc_id").select("doc_id").distinct(), "copies")
    # rows that stand several times: few, so only they are shuffled
    again = docs.groupBy("doc_id", F.xxhash64("text").alias("h")).count().where("count > 1 AND doc_id IS NOT NULL")
    again = keep(again.select("doc_id", "h"), "repeated-rows")
    same = (F.col("d.doc_id") == F.col("a.doc_id")) & (F.xxhash64("d.text") == F.col("a.h"))
    once = docs.alias("d").join(again.alias("a"), same, "left_semi").dropDuplicates(["doc_id", "text"])
    single = docs.alias("d").join(again.alias("a"), same, "left_anti")
    return single.join(gone.hint("merge"), "doc_id", "left_anti").unionByName(once.join(gone, "doc_id", "left_anti"))


def op8_near_copies(spark, sf_dir):
    return classes(table(spark, sf_dir, "documents"))
