"""Benchmark decontamination: Wu-Manber search for word windows of benchmark items.

Symbols are words, not characters: text and items are lower-cased (A-Z) and cut into words of
[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]. A pattern is a window of ``width`` consecutive words of an item, or the
whole item where it has fewer. For all patterns of one length, a shift table over blocks of two words
says how far the search may skip; where it says 0, the bucket of the block's hash lists the patterns that end
so, and a comparison of the words themselves confirms them. The tables hold at most ``most`` patterns;
a larger benchmark is searched block by block, every block against all texts, and a row's hits are put together.

Defined cases: null and empty texts have no words, no hits and no items; null and empty items have no
patterns; an item with a null id hits words but isn't counted as an item; rows with equal ids are judged
each on its own; other columns of either table are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scan import ALNUM, Words, mix, slices, words
from .shared import bounded_batches, column, keep, table, tidy

WIDTH = 8
MOST_PATTERNS = 200_000
CELLS = 1 << 20


def patterns_of(text: str | None, width: int) -> list[tuple[bytes, ...]]:
    w = words(pa.array([text or ""], pa.large_string()), ALNUM, lower=True, hashed=False)
    own = [w.word(i) for i in range(len(w.start))]
    return [tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1))] if own else []


class WuManber:
    """Patterns of one length m in words."""

    def __init__(self, m: int, patterns: dict[tuple[bytes, ...], set]):
        self.m, self.block = m, min(2, m)
        self.shift = np.full(CELLS, m - self.block + 1, np.uint8 if m < 250 else np.int64)
        self.bucket: dict[int, list[tuple[tuple[bytes, ...], set]]] = {}
        names = list(patterns)
        hashes = hash_words([w for p in names for w in p]).reshape(len(names), m)
        for j in range(m - self.block + 1):
            cell = self.cells(hashes[:, j], hashes[:, j + self.block - 1])
            np.minimum.at(self.shift, cell, self.shift.dtype.type(m - self.block - j))
        for name, cell in zip(names, self.cells(hashes[:, m - self.block], hashes[:, m - 1]).tolist()):
            self.bucket.setdefault(cell, []).append((name, patterns[name]))

    def cells(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The table cell of each block of words (a, b); for blocks of one word, a is b."""
        return (mix(a * np.uint64(3) + b) >> np.uint64(44)).astype(np.int64)

    def find(self, w: Words, doc: np.ndarray) -> Iterator[tuple[int, set]]:
        """(first word, items) of every occurrence."""
        m, n = self.m, len(w.hash)
        if n < m:
            return
        jump = np.zeros(n, self.shift.dtype)
        jump[m - 1 :] = self.shift[self.cells(w.hash[m - self.block : n - self.block + 1], w.hash[m - 1 :])]
        skip, at = jump.tobytes() if jump.dtype == np.uint8 else jump.tolist(), m - 1
        while at < n:
            if step := skip[at]:
                at += step
                continue
            first = at - m + 1
            if doc[first] == doc[at]:
                cell = int(self.cells(w.hash[at - self.block + 1 : at - self.block + 2], w.hash[at : at + 1])[0])
                if cell in self.bucket:
                    own = tuple(w.word(i) for i in range(first, at + 1))
                    for name, items in self.bucket[cell]:
                        if name == own:
                            yield first, items
            at += 1


def hash_words(names: list[bytes]) -> np.ndarray:
    """Hashes as the scan gives them."""
    data = b" ".join(names)
    w = words(pa.array([data.decode()], pa.large_string()))
    return w.hash


class Searcher:
    def __init__(self, patterns: dict[tuple[bytes, ...], set]):
        by: dict[int, dict] = {}
        for name, items in patterns.items():
            by.setdefault(len(name), {})[name] = items
        self.tables = [WuManber(m, x) for m, x in sorted(by.items())]

    def search(self, texts: pa.Array) -> tuple[Words, np.ndarray, list[set]]:
        """The words, how many occurrences cover each, and each text's items."""
        w = words(texts, ALNUM, lower=True)
        doc, edges, items = w.doc, np.zeros(len(w.hash) + 1, np.int64), [set() for _ in range(len(texts))]
        for t in self.tables:
            for first, found in t.find(w, doc):
                edges[first] += 1
                edges[first + t.m] -= 1
                items[doc[first]] |= found
        return w, np.cumsum(edges[:-1]), items


def pattern_blocks(benchmark: DataFrame, width: int, most: int) -> Iterator[dict[tuple[bytes, ...], set]]:
    """The patterns and their items, at most ``most`` at a time; items come to the driver one by one, and a long one may go on in the next block."""
    block: dict[tuple[bytes, ...], set] = {}
    for row in benchmark.select("item_id", "text").toLocalIterator():
        for name in patterns_of(row.text, width):
            if len(block) >= most and name not in block:
                yield block
                block = {}
            block.setdefault(name, set())
            if row.item_id is not None:
                block[name].add(str(row.item_id))
    yield block


FOUND = "n_words long, hits binary, items array<string>"


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, most: int = MOST_PATTERNS, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """carried (a struct of the columns ``carry``), n_words, hits (bit k of the bytes, high bit first: word k is hit), items (sorted), n_hit."""
    spark = docs.sparkSession
    bounded_batches(spark)
    own = docs.select(F.struct(*(column(c) for c in carry)).alias("carried"), F.col("text").alias("_text"))
    blocks = pattern_blocks(benchmark, width, most)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        found = own.mapInArrow(tidy(_search(spark.sparkContext.broadcast(block), "carried")), _with(FOUND, own, "carried"))
        return found.withColumn("n_hit", _ones(F.col("hits")))
    # Every block's hits go by a row's number, so that texts are written once, whatever the number of blocks.
    own = keep(own.withColumn("row", F.monotonically_increasing_id()), "decontaminate")
    texts, parts = own.select("row", "_text"), []
    while block is not None:
        hits = texts.mapInArrow(tidy(_search(spark.sparkContext.broadcast(block), "row")), _with(FOUND, texts, "row"))
        parts.append(keep(hits.where("length(hits) > 0") if parts else hits, "decontaminate-hits"))
        block, following = following, next(blocks, None)
    both = functools.reduce(DataFrame.unionAll, parts).groupBy("row").agg(F.max("n_words").alias("n_words"), F.collect_list("hits").alias("parts"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    found = own.drop("_text").join(both, "row").drop("row").mapInArrow(_either, _with(FOUND, own, "carried"))
    return found.withColumn("n_hit", _ones(F.col("hits")))


def _with(ddl: str, df: DataFrame, name: str) -> T.StructType:
    return T.StructType([df.schema[name], *T._parse_datatype_string(ddl).fields])


def _either(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits that any of a row's parts has."""
    for batch in batches:
        hits = []
        for parts in batch.column("parts").to_pylist():
            bits = [np.frombuffer(x, np.uint8) for x in parts if x]
            hits.append(np.bitwise_or.reduce(bits).tobytes() if bits else b"")
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("carried", "n_words")), pa.array(hits, pa.binary()), batch.column("items")], ["carried", "n_words", "hits", "items"])


def _ones(hits):
    """Set bits of a binary column."""
    digits = F.hex(hits)
    bits = F.lit(0)
    for digit in "123456789ABCDEF":
        bits = bits + (F.length(digits) - F.length(F.replace(digits, F.lit(digit)))) * bin(int(digit, 16)).count("1")
    return bits.cast("long")


def _search(shared, name: str):
    """Column ``name`` and what of the patterns ``shared`` is in the texts."""
    made: list[Searcher] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(Searcher(shared.value))
        for batch in batches:
            for first, texts in slices(batch.column("_text")):
                w, cover, items = made[0].search(texts)
                hits = []
                for d in range(len(texts)):
                    own = cover[w.ptr[d] : w.ptr[d + 1]] > 0
                    hits.append(np.packbits(own).tobytes() if own.any() else b"")
                yield pa.RecordBatch.from_arrays([batch.column(name).slice(first, len(texts)), pa.array(np.diff(w.ptr), pa.int64()), pa.array(hits, pa.binary()), pa.array([sorted(x) for x in items], pa.list_(pa.string()))], [name, "n_words", "hits", "items"])

    return run


def contaminated(found: DataFrame, least_items: int = 2) -> DataFrame:
    return found.withColumn("contaminated", F.size("items") >= least_items)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search ``documents`` for windows of ``benchmark``: see the module."""
    found = contaminated(decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select("carried.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")
