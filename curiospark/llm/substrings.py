"""Substring dedup by relative Lempel-Ziv parsing.

Every text is reference for the later ones. The reference is cut into blocks by content: a window of ``WINDOW`` words
belongs to the block of its anchor, the least hash among the runs of ``ANCHOR`` words in it, so that equal windows meet in
one block wherever they stand, and neighbouring windows mostly stay together. A block's index lists its windows by
content and, within equal ones, by place. Texts are factored greedily against it: from a word on, the factor is the longest
run of windows that also starts earlier in the block, found by making the runs that still have an earlier copy longer, a
window at a time, in all texts at once. At a factor's end, parsing goes on with the window over its boundary, which
starts another factor if it is in the index, too; so nothing is missed that continues in another source. As every
factor is at least a window long, each is a duplicate span. What a text's spans cover is removed.

A slice of texts is factored against itself first. What recurs in it is settled there, and only the first window of
each content is dealt to the blocks; where very many slices meet in one block, ``FAN`` of them are factored at a time,
in levels. So a passage that a third of all texts share puts at most ``FAN`` slices' windows into one task.

Earlier means a smaller doc_id, or the same and an earlier word. Windows and spans are dealt in packed form, and a row
holds only what is in it, whatever the number of blocks; texts are shuffled once, to meet their spans. A block holds 16
MB of text, whatever the input's size. Windows are told apart by hashes of 64 bits and 32 further bits of their anchors'.

Defined cases: null and empty texts have no words; null ids count as the largest; rows with equal ids are one document:
equal windows at the same place in them aren't repeats of each other; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .packed import binary, in_order, repeated, unpack
from .scan import NOT_SPACE, Words, mix, ngrams, slices, words
from .shared import bounded_batches, column, give_back, spread_over, table, text_bytes, tidy

WINDOW, ANCHOR = 20, 8
SLICE = 1 << 22
PLACE_BITS = 26
FAN = 4096
#: What is dealt to blocks: a run of windows under one anchor (null: 1 for a null id), and its windows' hashes apart.
RUN = np.dtype([("id", "<i8"), ("tell", "<u4"), ("anchor", "<u4"), ("place", "<u4"), ("size", "u1"), ("null", "u1")])
#: What is dealt to texts: ``windows`` consecutive windows of the text that also start at source_start of the source.
SPAN = np.dtype([("id", "<i8"), ("source", "<i8"), ("tell", "<u4"), ("start", "<u4"), ("windows", "<u4"), ("source_start", "<u4"), ("null", "u1"), ("source_null", "u1")])
DEALT = "bucket int, slice long, runs binary, windows binary"


def anchors(w: Words, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, text, hash, anchor's place) of every window."""
    h = ngrams(w.hash, window)
    doc = w.doc
    g = ngrams(w.hash, anchor)
    if not len(h):
        empty = np.empty(0, np.int64)
        return empty, empty, h, empty
    places = np.arange(len(g), dtype=np.uint64) & np.uint64((1 << PLACE_BITS) - 1)
    least = (g >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | places
    count, width = window - anchor + 1, 1
    while width * 2 <= count:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    rest = count - width
    if rest:
        least = np.minimum(least[: len(least) - rest], least[rest:])
    start = np.flatnonzero(doc[: len(h)] == doc[window - 1 :])
    # The place modulo 2**PLACE_BITS is that of a word at most a window after the start.
    step = (least[start].astype(np.int64) - start) & ((1 << PLACE_BITS) - 1)
    return start, doc[start], h[start], start + step


def factor(key: np.ndarray, run: np.ndarray, rank: np.ndarray, part: slice | np.ndarray = slice(None)) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The greedy parse of windows against themselves: where factors start, their windows, their sources, and each window's longest factor.

    ``key`` names a window's content; windows i and i + 1 are neighbours where ``run`` is equal; ``rank`` is the place in the
    order of texts and words, equal for windows at one place of one document.
    """
    n = len(key)
    length, source = np.zeros(n, np.int64), np.zeros(n, np.int64)
    follows = np.append(run[1:] == run[:-1], False) if n else np.empty(0, bool)
    order = np.argsort(key, kind="stable")
    at = order[repeated(key[order])]  # the index; a window that occurs once is in no factor
    name, step = key[at], 0
    while len(at):
        order = np.lexsort((rank[at], name))
        at, name = at[order], name[order]
        begin = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
        size = np.diff(np.append(begin, len(at)))
        first = np.repeat(at[begin], size)
        later = rank[at] > rank[first]
        step += 1
        length[at[later]], source[at[later]] = step, first[later]
        # Only what still has an earlier copy can grow by the next window.
        on = np.flatnonzero(np.repeat(np.logical_or.reduceat(later, begin), size) & follows[at + step - 1])
        at, name = at[on], mix(name[on] * np.uint64(0x9E3779B97F4A7C15) + key[at[on] + step])
    here, starts = np.flatnonzero(~np.append(False, follows[:-1])) if n else np.empty(0, np.int64), []
    while len(here):
        starts.append(here[length[here] > 0])
        after = here + np.maximum(length[here], 1)
        here = after[(after < n) & (run[np.minimum(after, n - 1)] == run[here])]
    begin = np.sort(np.concatenate(starts)) if starts else np.empty(0, np.int64)
    return begin, length[begin], source[begin], length


def spans_of(begin: np.ndarray, size: np.ndarray, source: np.ndarray, run: np.ndarray, place: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """SPAN records of factors; ``runs`` are RUN records and ``place`` is a window's first word."""
    out = np.zeros(len(begin), SPAN)
    own, other = runs[run[begin]], runs[run[source]]
    out["id"], out["null"], out["tell"], out["start"], out["windows"] = own["id"], own["null"], own["tell"], place[begin], size
    out["source"], out["source_null"], out["source_start"] = other["id"], other["null"], place[source]
    if not len(out):
        return out
    # Factors that go on in the same source over the end of a run are one.
    on = np.zeros(len(out), bool)
    end = out["start"][:-1] + out["windows"][:-1]
    on[1:] = (out["start"][1:] == end) & (out["source_start"][1:] == out["source_start"][:-1] + out["windows"][:-1])
    for c in ("id", "tell", "null", "source", "source_null"):
        on[1:] &= out[c][1:] == out[c][:-1]
    first = np.flatnonzero(~on)
    total = np.add.reduceat(out["windows"], first)
    out = out[first]
    out["windows"] = total
    return out


def target(ids: np.ndarray, tells: np.ndarray, targets: int) -> np.ndarray:
    """Where a text meets its spans; ``targets`` is prime, so that ids at regular steps spread. As ``_target`` has it."""
    return (ids ^ tells.astype(np.int64)) % targets


def grouped(label: np.ndarray, records: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The labels, and the records of each, packed."""
    order = np.argsort(label, kind="stable")
    label = label[order]
    cut = np.append(np.flatnonzero(np.diff(label, prepend=label[:1] - 1)), len(label)) if len(label) else np.zeros(1, np.int64)
    return label[cut[:-1]], binary(records[order], cut)


def order_of(runs: np.ndarray) -> np.ndarray:
    """Each run's document, numbered in order."""
    order = np.lexsort((runs["id"], runs["null"]))
    sorted_runs = runs[order]
    new = np.zeros(len(runs), np.int64)
    new[1:] = (sorted_runs["id"][1:] != sorted_runs["id"][:-1]) | (sorted_runs["null"][1:] != sorted_runs["null"][:-1])
    out = np.empty(len(runs), np.int64)
    out[order] = np.cumsum(new)
    return out


def settle(runs: np.ndarray, key: np.ndarray, targets: int, buckets: int | None, number: int) -> Iterator[pa.RecordBatch]:
    """Factors runs against each other. Yields rows of DEALT: spans under -1 - target and, if ``buckets`` is given, what is left to the blocks."""
    size = runs["size"].astype(np.int64)
    run = np.repeat(np.arange(len(runs)), size)
    inside = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
    place = runs["place"][run].astype(np.int64) + inside
    name = mix(key ^ (runs["anchor"][run].astype(np.uint64) << np.uint64(32)))
    begin, n, source, length = factor(name, run, (order_of(runs)[run] << 32) | place)
    spans = spans_of(begin, n, source, run, place, runs)
    label, packed = grouped(target(spans["id"], spans["tell"], targets), spans)
    if len(label):
        yield rows_of(-1 - label, number, packed, None)
    if buckets is None:
        return
    left = np.flatnonzero(length == 0)
    if not len(left):
        return
    run, place, key = run[left], place[left], key[left]
    new = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (place[1:] != place[:-1] + 1)))
    out = runs[run[new]]
    out["place"], out["size"] = place[new], np.diff(np.append(new, len(run)))
    bucket = (mix(out["anchor"].astype(np.uint64)) >> np.uint64(20)).astype(np.int64) % buckets
    order = in_order(bucket, buckets)
    bucket, out = bucket[order], out[order]
    size = out["size"].astype(np.int64)
    ends = np.cumsum(size)
    key = key[np.repeat(new[order] - (ends - size), size) + np.arange(len(key))]
    cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    yield rows_of(bucket[cut[:-1]], number, binary(out, cut), binary(key, np.concatenate(([0], ends))[cut]))


def rows_of(bucket: np.ndarray, number: int, runs: pa.Array, windows: pa.Array | None) -> pa.RecordBatch:
    n = len(bucket)
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(np.full(n, number), pa.int64()), runs, windows if windows is not None else pa.nulls(n, pa.binary())], ["bucket", "slice", "runs", "windows"])


def deal(ids: np.ndarray, null: np.ndarray, tells: np.ndarray, texts: pa.Array, buckets: int, targets: int, number: int = 0) -> Iterator[pa.RecordBatch]:
    """A slice's spans within itself, by target, and its other windows, by block."""
    w = words(texts, NOT_SPACE)
    start, doc, h, place = anchors(w)
    # Of rows that repeat an id and a text, one is enough.
    own = np.zeros(len(ids), bool)
    own[np.unique(np.rec.fromarrays([ids, null, tells]), return_index=True)[1]] = True
    here = own[doc]
    start, doc, h, place = start[here], doc[here], h[here], place[here]
    if not len(start):
        return
    new = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
    runs = np.zeros(len(new), RUN)
    text = doc[new]
    runs["id"], runs["null"], runs["tell"] = ids[text], null[text], tells[text]
    runs["anchor"] = (ngrams(w.hash, ANCHOR)[place[new]] >> np.uint64(32)).astype(np.uint32)
    runs["place"], runs["size"] = start[new] - w.ptr[text], np.diff(np.append(new, len(start)))
    yield from settle(runs, h, targets, buckets, number)


def meet(targets: int, buckets: int | None):
    """Factors a block's runs against its index; spans that are settled pass."""

    def run(group: pa.Table) -> pa.Table:
        bucket, number = group["bucket"][0].as_py(), group["slice"][0].as_py()
        if bucket < 0:
            return group
        give_back()
        found = list(settle(unpack(group["runs"], RUN), unpack(group["windows"], "<u8"), targets, buckets, number))
        return pa.Table.from_batches(found, group.schema) if found else group.slice(0, 0)

    return run


def blocks_for(size: int) -> int:
    """A block for 16 MB of text."""
    return max(64, size >> 24)


def targets_for(size: int) -> int:
    """As many, but a prime."""
    n = blocks_for(size) | 1
    while any(n % k == 0 for k in range(3, int(n**0.5) + 1, 2)):
        n += 2
    return n


def _target(targets: int):
    return F.pmod(F.coalesce("doc_id", F.lit(0)).bitwiseXOR(F.col("tell")), F.lit(targets)).cast("int")


def spans(rows: DataFrame, size: int, fan: int = FAN, slice_bytes: int = SLICE) -> DataFrame:
    """t, spans: packed SPAN records of the texts of target t. ``rows`` has doc_id, tell and text; ``size`` is the texts' bytes."""
    buckets, targets = blocks_for(size), targets_for(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, tells = batch.column("doc_id"), batch.column("tell")
            null = np.asarray(ids.is_null()).astype(np.uint8)
            ids, tells = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), tells.to_numpy(zero_copy_only=False).astype(np.uint32)
            for first, texts in slices(batch.column("text"), slice_bytes):
                part = slice(first, first + len(texts))
                yield from deal(ids[part], null[part], tells[part], texts, buckets, targets, (task << 24) + k)
                k += 1

    dealt = rows.select("doc_id", "tell", "text").mapInArrow(tidy(run), DEALT)
    shares = max(size // slice_bytes, rows.rdd.getNumPartitions()) // fan + 1
    while shares > 1:
        share = F.when(F.col("bucket") < 0, 0).otherwise(F.pmod(F.xxhash64("slice"), F.lit(shares))).alias("share")
        dealt = spread_over(dealt, size, "bucket", share).groupBy("bucket", share).applyInArrow(meet(targets, buckets), DEALT)
        shares = 1 if shares <= fan else shares // fan + 1
    met = spread_over(dealt, size, "bucket").groupBy("bucket").applyInArrow(meet(targets, None), DEALT)
    return met.select((-1 - F.col("bucket")).alias("t"), F.col("runs").alias("spans"))


FACTORS = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("source", pa.int64()), ("source_start", pa.int32())]))


def dedup_substrings(docs: DataFrame, carry: tuple[str, ...] = (), fan: int = FAN, slice_bytes: int = SLICE) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by a space), factors and, if any, the columns ``carry`` as a struct ``carried``."""
    bounded_batches(docs.sparkSession)
    size = text_bytes(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    carried = [F.struct(*(column(c) for c in carry)).alias("carried")] if carry else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)).alias("tell"), *carried)
    texts = rows.select(_target(targets_for(size)).alias("t"), F.lit(1).alias("kind"), *rows.columns, F.lit(None).cast("binary").alias("spans"))
    both = texts.unionByName(spans(rows, size, fan, slice_bytes).withColumn("kind", F.lit(0)), allowMissingColumns=True)
    names = ["doc_id", "n_words", "n_removed", "kept", "factors", *["carried"] * bool(carry)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, index = None, [], None
        for batch in batches:
            ts, kinds = (batch.column(k).to_numpy() for k in ("t", "kind"))
            cuts = np.flatnonzero(np.append(True, (np.diff(ts) != 0) | (np.diff(kinds) != 0)))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ts)]):
                if ts[a] != here:
                    here, held, index = ts[a], [], None
                part = batch.slice(a, b - a)
                if not kinds[a]:
                    held.append(unpack(pa.chunked_array([part.column("spans")]), SPAN))
                    continue
                if index is None:
                    index = Spans(np.concatenate(held) if held else np.empty(0, SPAN))
                for first, own in slices(part.column("text"), slice_bytes):
                    yield remove(index, part.slice(first, len(own)), own, names)

    result = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    result.add("factors", T._parse_datatype_string("array<struct<start:int,words:int,source:long,source_start:int>>"))
    if carry:
        result.add("carried", rows.schema["carried"].dataType)
    return spread_over(both, size, "t").sortWithinPartitions("t", "kind").mapInArrow(tidy(run), result)


class Spans:
    """Spans by text, in order of their starts, each one once."""

    def __init__(self, found: np.ndarray):
        order = np.lexsort((found["source_start"], found["windows"], found["start"], found["tell"], found["id"], found["null"]))
        found = found[order]
        new = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.empty(0, np.int64)
        self.found = found = found[new]
        other = np.zeros(len(found), bool)
        for c in ("id", "tell", "null"):
            other[1:] |= found[c][1:] != found[c][:-1]
        other[:1] = True
        first = np.flatnonzero(other)
        names = zip(*(found[c][first].tolist() for c in ("null", "id", "tell")))
        self.at = dict(zip(names, zip(first.tolist(), [*first[1:].tolist(), len(found)])))

    def of(self, null: list[bool], ids: list[int], tells: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The spans of some texts, end to end, and each one's text."""
        bounds = [self.at.get(x, (0, 0)) for x in zip(map(int, null), ids, tells)]
        a, b = np.array(bounds, np.int64).reshape(-1, 2).T
        size = b - a
        text = np.repeat(np.arange(len(size)), size)
        return self.found[np.repeat(a - (np.cumsum(size) - size), size) + np.arange(len(text))], text


def remove(index: Spans, batch: pa.RecordBatch, texts: pa.Array, names: list[str]) -> pa.RecordBatch:
    ids = batch.column("doc_id")
    found, text = index.of(ids.is_null().to_pylist(), ids.fill_null(0).to_pylist(), batch.column("tell").to_pylist())
    w = words(texts, NOT_SPACE, hashed=False)
    start, size = found["start"].astype(np.int64), found["windows"].astype(np.int64)
    edges = np.zeros(len(w.start) + 1, np.int64)
    np.add.at(edges, w.ptr[text] + start, 1)
    np.subtract.at(edges, w.ptr[text] + start + size + WINDOW - 1, 1)
    kept = np.cumsum(edges[:-1]) == 0
    n_words = np.diff(w.ptr)
    n_kept = np.diff(np.concatenate(([0], np.cumsum(kept)))[w.ptr])
    # Factors that go on in the same source are one.
    on = np.zeros(len(found), bool)
    if len(found):
        on[1:] = (text[1:] == text[:-1]) & (start[1:] == start[:-1] + size[:-1]) & (found["source"][1:] == found["source"][:-1]) & (found["source_null"][1:] == found["source_null"][:-1]) & (found["source_start"][1:] == found["source_start"][:-1] + found["windows"][:-1])
    first = np.flatnonzero(~on)
    total = (np.add.reduceat(size, first) if len(first) else size) + WINDOW - 1
    found, text = found[first], text[first]
    source = pa.array(found["source"], mask=found["source_null"].astype(bool))
    struct = pa.StructArray.from_arrays([pa.array(found["start"].astype(np.int32)), pa.array(total.astype(np.int32)), source, pa.array(found["source_start"].astype(np.int32))], ["start", "words", "source", "source_start"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32()), struct).cast(FACTORS)
    arrays = [ids, pa.array(n_words), pa.array(n_words - n_kept), joined(w, kept, n_kept), lists]
    return pa.RecordBatch.from_arrays([*arrays, *(batch.column(c) for c in names[5:])], names)


def joined(w: Words, kept: np.ndarray, n_kept: np.ndarray) -> pa.Array:
    """Each text's kept words with one space between them."""
    start, size = w.start[kept], (w.end - w.start)[kept]
    ends = np.cumsum(size + 1)
    at = np.repeat(start - (ends - size - 1), size + 1) + np.arange(int(ends[-1]) if len(ends) else 0)
    data = w.data[np.minimum(at, len(w.data) - 1)] if len(at) else np.empty(0, np.uint8)
    if len(at):
        data[ends - 1] = 0x20
    bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(n_kept)))]
    whole = data.tobytes()
    return pa.array([whole[a : b - 1].decode() if b > a else "" for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.string())


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove repeated runs of 20 words and more from ``documents``: see the module."""
    found = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
