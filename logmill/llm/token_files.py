"""Token-id files: zstandard frames per document under one shared dictionary.

A file set is a folder of two Parquet tables, so that it lives wherever Spark's tables
do: ``dictionary`` (dict_hash, dictionary) and ``shards``, ascending by doc_id.  A
shard row holds up to some thousand documents: their ids, the frames one after another,
and per document the offset of its frame and its number of tokens.  One document is
read by its shard row, a slice and one decompression.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path
from .common import bounded_batches, keep, table, text_slices, worker_state

END_ID = 0
# bounds of the sample that the dictionary is trained on
TRAIN_DOCUMENTS, TRAIN_IDS, DICTIONARY_BYTES = 1000, 1000, 64 << 10
CACHED_WORDS, CACHED_PIECES = 500_000, 400_000
SHARD_BYTES, SHARD_DOCUMENTS = 1 << 20, 4096

SHARD = pa.schema(
    [
        ("dict_hash", pa.string()),
        ("doc_ids", pa.list_(pa.int64())),
        ("text_hashes", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("frames", pa.binary()),
        ("n_shard_tokens", pa.int64()),
    ]
)
SHARD_SQL = (
    "dict_hash string, doc_ids array<bigint>, text_hashes array<bigint>, n_tokens array<bigint>, "
    "offsets array<bigint>, frames binary, n_shard_tokens bigint"
)


# The split pattern of the vocabulary, for the letters, digits and spaces
# below U+0250, whose classes no longer change between Unicode versions
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
# white space other than the space
_WHITES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_UNSETTLED = re.compile(r"[^\x00-\u024f]")


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones themselves."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


_BYTE_LETTERS = _byte_letters()


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def splits_words(tokenizer) -> bool:
    """Whether ``tokenizer`` is a plain byte-level BPE that takes texts as they are.

    That is: no normaliser, the byte-level splitting without a space put first, no cut of
    long texts, and a BPE without drop-out or marks at word ends, whose pieces depend on
    nothing but their letters.
    """
    held = json.loads(tokenizer.to_str())
    split, model = held.get("pre_tokenizer") or {}, held["model"]
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    marks = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "fuse_unk")
    whole = not held.get("normalizer") and not held.get("truncation") and not held.get("padding")
    return bool(plain and whole and model.get("type") == "BPE" and not any(model.get(m) for m in marks))


class _Words(dict):
    """Ids by word, found when a word is first asked for; the words not asked for lately are forgotten."""

    def __init__(self, find: Callable[[str], bytes]):
        self.find, self.older = find, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.pop(word, None) or self.find(word)
        if len(self) >= CACHED_WORDS // 2:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    A byte-level BPE never merges across the space before a word, so a text without
    runs of white space is encoded word by word, each distinct word once, by the BPE
    model alone.  Other texts, and those with special tokens, go to the tokenizer whole, as
    do all texts if the tokenizer isn't of that kind (see :func:`splits_words`).
    """

    def __init__(self, path: str, word_wise: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.word_wise = word_wise and splits_words(self.tokenizer)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = _Words(self._word)
        self.pieces: dict[str, bytes] = {}
        self.letters = dict(enumerate(_BYTE_LETTERS))

    def _word(self, word: str) -> bytes:
        """Ids of a word with the space before it; its letters, signs and line ends are pieces of their own."""
        plain = word.isascii()
        if plain and word.isalpha():
            return self._model_ids(_BYTE_LETTERS[32] + word)
        spaced = " " + word
        if not plain and _UNSETTLED.search(word):
            return self._ids([spaced])[0]
        return b"".join([self._piece(p) for p in _PIECES.findall(spaced)])

    def _piece(self, piece: str) -> bytes:
        if piece[0] == " " and piece.isascii() and piece[1:].isalpha():
            return self.words[piece[1:]]
        if piece not in self.pieces:
            if len(self.pieces) >= CACHED_PIECES:
                self.pieces.clear()
            self.pieces[piece] = self._model_ids(piece.encode().decode("latin-1").translate(self.letters))
        return self.pieces[piece]

    def _model_ids(self, letters: str) -> bytes:
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _ids(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in encoded]

    def _splits(self, text: str) -> bool:
        # a space next to other white space belongs to a run
        if "  " in text or any(w in text and (" " + w in text or w + " " in text) for w in _WHITES):
            return False
        return not any(s in text for s in self.specials)

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        split, whole = {}, []
        for i, text in enumerate(texts):
            if text and self.word_wise and self._splits(text):
                split[i] = text.split(" ")
            else:
                whole.append(i)
        for i, ids in zip(whole, self._ids([texts[i] for i in whole])):
            out[i] = ids
        for (i, parts), first in zip(split.items(), self._ids([p[0] for p in split.values()])):
            out[i] = first + b"".join(map(self.words.__getitem__, parts[1:]))
        return out


def encoder(path: str) -> Encoder:
    held = worker_state("token_encoders")
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def train_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """A zstandard dictionary from the first ids of a bounded sample of documents.

    The sample is about TRAIN_DOCUMENTS rows chosen by a hash, TRAIN_IDS ids each: some
    4 MB come to the driver.  Too little text for training gives an empty dictionary.
    """
    # a prefix is enough to train on; every text is written whole
    share = TRAIN_DOCUMENTS / max(TRAIN_DOCUMENTS, docs.count())
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    picked = docs.where(F.col("text").isNotNull() & (place < share)).select(F.substring("text", 1, 8 * TRAIN_IDS).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids in encoder(tokenizer).encode(batch.column(0).to_pylist()):
                yield pa.record_batch([pa.array([ids[: 4 * TRAIN_IDS]], pa.binary())], names=["ids"])

    samples = sorted(bytes(r.ids) for r in picked.mapInArrow(encode, "ids binary").collect() if r.ids)
    try:
        size = min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 8))
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=held)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every whole text, append ``end_id`` and write the ids in ascending doc_id order.

    A null text is empty; null ids come first; rows of equal id are ordered by their
    text's hash.  Texts are range-partitioned by id and encoded partition by partition;
    a task holds one shard of about SHARD_BYTES at a time.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "dict_hash string, dictionary binary").coalesce(1).write.parquet(
        f"{path}/dictionary"
    )
    end = np.array([end_id], dtype="<u4").tobytes()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = _compressor(dictionary)
        rows: list[tuple] = []
        size = 0

        def shard() -> pa.RecordBatch:
            ids, hashes, counts, frames = zip(*rows)
            lengths = np.fromiter(map(len, frames), dtype=np.int64)
            values = [digest, list(ids), list(hashes), list(counts), (np.cumsum(lengths) - lengths).tolist(), b"".join(frames), sum(counts)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, SHARD)], schema=SHARD)

        for batch in batches:
            for part in text_slices(batch, ["text"]):
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, h, ids in zip(part.column("doc_id").to_pylist(), part.column("h").to_pylist(), encoder(tokenizer).encode(texts)):
                    ids += end
                    frame = pack.compress(ids)
                    rows.append((doc_id, h, len(ids) // 4, frame))
                    size += len(frame)
                    if size >= SHARD_BYTES or len(rows) >= SHARD_DOCUMENTS:
                        yield shard()
                        rows, size = [], 0
        if rows:
            yield shard()

    ordered = bounded_batches(docs).select("text", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"))
    ordered = ordered.repartitionByRange(F.col("doc_id"), F.col("h")).sortWithinPartitions("doc_id", "h")
    written = ordered.mapInArrow(shards, SHARD_SQL)
    # the place of a shard: its partition, then its order in there
    written.select("*", F.monotonically_increasing_id().alias("shard_id")).write.parquet(f"{path}/shards")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a file set: doc_id, start (ids of all documents before it), n_tokens, ids (bytes)."""
    return _read(spark, path, digest_only=False)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_token_files`, with the crc32 of the ids in their place."""
    return _read(spark, path, digest_only=True)


def _read(spark: SparkSession, path: str, digest_only: bool) -> DataFrame:
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)
    expected = hashlib.sha256(dictionary).hexdigest()
    shards = spark.read.parquet(f"{path}/shards")
    # shard ids count up within partitions: chain the partitions, then the shards in each
    part = F.shiftright("shard_id", 33)
    sums = shards.select("shard_id", part.alias("part"), "n_shard_tokens")
    totals = sums.groupBy("part").agg(F.sum("n_shard_tokens").alias("n"))
    chain = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("n").over(chain), F.lit(0)).alias("before"))
    inner = Window.partitionBy("part").orderBy("shard_id").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("inner", F.coalesce(F.sum("n_shard_tokens").over(inner), F.lit(0))).join(totals, "part")
    starts = keep(starts.select("shard_id", (F.col("before") + F.col("inner")).alias("shard_start")), "shard-starts")
    value_type = pa.int64() if digest_only else pa.binary()
    schema = pa.schema([("doc_id", pa.int64()), ("shard_id", pa.int64()), ("within", pa.int64()), ("n_tokens", pa.int64()), ("value", value_type)])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        unpack = zstandard.ZstdDecompressor(dict_data=held)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pydict()
                if row["dict_hash"][0] != expected:
                    raise ValueError("the frames were written with another dictionary")
                frames, offsets, counts = row["frames"][0], row["offsets"][0], row["n_tokens"][0]
                values = []
                for a, b in zip(offsets, [*offsets[1:], len(frames)]):
                    ids = unpack.decompress(frames[a:b])
                    values.append(zlib.crc32(ids) if digest_only else ids)
                counts = np.asarray(counts, dtype=np.int64)
                columns = [row["doc_ids"][0], [row["shard_id"][0]] * len(values), np.cumsum(counts) - counts, counts, values]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema)

    kind = "bigint" if digest_only else "binary"
    rows = shards.select("dict_hash", "doc_ids", "n_tokens", "offsets", "frames", "shard_id").mapInArrow(
        documents, f"doc_id bigint, shard_id bigint, within bigint, n_tokens bigint, value {kind}"
    )
    joined = rows.join(starts, "shard_id")
    return joined.select(
        "doc_id", (F.col("shard_start") + F.col("within")).alias("start"), "n_tokens",
        F.col("value").alias("ids_crc32" if digest_only else "ids"),
    )


def op5_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-ids")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"))
    return read_digests(spark, path)
