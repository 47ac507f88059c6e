"""Exact top-k search of binary codes by incremental multi-index hashing."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .blocks import search_blocks, smallest_ids
from .common import keep, table

_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def sign_code(vector: str = "embedding") -> Column:
    """The sign bits of a vector (1: above zero), first component first, zero-filled to whole bytes."""
    bits = F.array_join(F.transform(vector, lambda x: F.when(x > 0, "1").otherwise("0")), "")
    n_bytes = F.ceil(F.size(vector) / 8).cast("int")
    bits = F.rpad(bits, n_bytes * 8, "0")
    octets = F.transform(F.sequence(F.lit(0), n_bytes - 1), lambda i: F.lpad(F.conv(F.substring(bits, i * 8 + 1, F.lit(8)), 2, 16), 2, "0"))
    return F.when(F.size(vector) > 0, F.unhex(F.array_join(octets, "")))


class MultiIndex:
    """Codes of equal length, indexed by each of their segments.

    A code within distance ``s * (r + 1) - 1`` of a query differs in at most ``r`` bits in
    one of the ``s`` segments.  So the search radius of the segments grows from 0 until
    the k-th verified distance is within what has been covered.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        bits = np.unpackbits(codes, axis=1)
        n, width = bits.shape
        wanted = max(4, min(16, round(math.log2(max(n, 2)))))
        self.segments = max(1, round(width / wanted))
        self.cuts = np.array_split(np.arange(width), self.segments)
        self.tables = []
        for cut in self.cuts:
            values = self._values(bits[:, cut])
            order = np.argsort(values, kind="stable")
            self.tables.append((values[order], order))

    @staticmethod
    def _values(bits: np.ndarray) -> np.ndarray:
        return bits.astype(np.int64) @ (1 << np.arange(bits.shape[1], dtype=np.int64))

    @staticmethod
    def masks(width: int, radius: int) -> np.ndarray:
        return np.array([sum(1 << b for b in c) for c in itertools.combinations(range(width), radius)], dtype=np.int64)

    def search(self, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query all codes up to its k-th distance: (positions, distances)."""
        n = len(self.codes)
        k = min(k, n)
        bits = np.unpackbits(queries, axis=1)
        found = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)) for _ in queries]
        active = np.arange(len(queries))
        radius = 0
        while len(active):
            probes = sum(math.comb(len(cut), radius) for cut in self.cuts)
            if probes >= n:
                # more values to try than codes: look at all of them
                for i in active:
                    found[i] = (np.arange(n), _ONES[self.codes ^ queries[i]].sum(axis=1, dtype=np.int64))
                break
            pairs = []
            for cut, (values, order) in zip(self.cuts, self.tables):
                if radius > len(cut):
                    continue
                wanted = self._values(bits[np.ix_(active, cut)])[:, None] ^ self.masks(len(cut), radius)[None, :]
                low = np.searchsorted(values, wanted.ravel(), "left")
                many = np.searchsorted(values, wanted.ravel(), "right") - low
                total = int(many.sum())
                if total:
                    at = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(total)
                    owner = np.repeat(np.repeat(active, wanted.shape[1]), many)
                    pairs.append(owner * n + order[at])
            if pairs:
                pairs = np.unique(np.concatenate(pairs))
                owner, code = pairs // n, pairs % n
                apart = _ONES[self.codes[code] ^ queries[owner]].sum(axis=1, dtype=np.int64)
                starts = np.searchsorted(owner, active, "left")
                ends = np.searchsorted(owner, active, "right")
                for i, a, b in zip(active, starts, ends):
                    if b > a:
                        codes, first = np.unique(np.concatenate([found[i][0], code[a:b]]), return_index=True)
                        found[i] = (codes, np.concatenate([found[i][1], apart[a:b]])[first])
            covered = self.segments * (radius + 1) - 1
            open_ = [i for i in active if len(found[i][1]) < k or np.partition(found[i][1], k - 1)[k - 1] > covered]
            active = np.array(open_, dtype=np.int64)
            radius += 1
        return found


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks().to_pylist()
    return np.frombuffer(b"".join(values), dtype=np.uint8).reshape(len(values), -1)


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, distance): the ``k`` rows of smallest Hamming distance, exactly.

    Both sides have vec_id and code (binary).  Null ids or codes take no part, nor do
    empty codes; a query meets only codes of its own length.  A row of the query's id is
    no answer to it; ties go to the smaller id; repeated rows count once.  Equal codes
    are one candidate with its ``k + 1`` smallest ids.

    Codes are spread over blocks of bounded size, each with its own index; every query
    visits every block and brings back at most ``k + 1`` codes from each.
    """
    real = F.col("vec_id").isNotNull() & (F.octet_length("code") > 0)
    base = keep(smallest_ids(codes.where(real), "code", "vec_id", k + 1), "codes")
    asked = queries.where(real).select("vec_id", "code").distinct()
    # the cell is the length; codes of other lengths are not compared
    base = base.withColumn("cell", F.octet_length("code")).withColumn("place", F.xxhash64("code"))
    asked = asked.withColumn("cell", F.octet_length("code")).withColumn("place", F.xxhash64("vec_id"))
    schema = pa.schema([("query_id", pa.int64()), ("distance", pa.int32()), ("ids", pa.list_(pa.int64()))])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids = right["ids"].combine_chunks()
        first = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
        index = MultiIndex(_bytes(right["code"]))
        rows, apart, codes_ = [], [], []
        for i, (at, distance) in enumerate(index.search(_bytes(left["code"]), k + 1)):
            best = np.lexsort((first[at], distance))[: k + 1]
            rows.append(np.full(len(best), i))
            apart.append(distance[best])
            codes_.append(at[best])
        return pa.Table.from_arrays(
            [
                left["vec_id"].combine_chunks().take(pa.array(np.concatenate(rows))),
                pa.array(np.concatenate(apart).astype(np.int32)),
                ids.take(pa.array(np.concatenate(codes_))),
            ],
            schema=schema,
        )

    found = search_blocks(base, asked, search, "query_id bigint, distance int, ids array<bigint>", base_rows=1 << 16)
    rows = found.select("query_id", "distance", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    rows = rows.groupBy("query_id", "vec_id").agg(F.min("distance").alias("distance"))
    best = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "distance")


def op6_hamming_top_k(spark, sf_dir):
    """The 10 nearest sign codes of every embedding whose vec_id is divisible by 20."""
    codes = table(spark, sf_dir, "embeddings").select("vec_id", sign_code().alias("code"))
    return top_k(codes, codes.where("vec_id % 20 = 0"))


OP6_SQL = """
WITH c AS (
  SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '')::BIT AS code
  FROM embeddings WHERE len(embedding) > 0),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id, bit_count(xor(q.code, c.code))::INT AS distance
  FROM c q JOIN c ON q.vec_id <> c.vec_id AND q.vec_id % 20 = 0)
SELECT query_id, rank::INT AS rank, vec_id, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d) WHERE rank <= 10
"""
