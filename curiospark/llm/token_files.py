"""Token ids in binary files: length-delimited records with masked checksums, and an offset index.

A data file is a run of frames: length (u64), masked checksum of the length (u32), payload, masked
checksum of the payload (u32), all little-endian. A payload is a flag byte (1: the id is null), the
document id (i64), then the ids, two bytes each where the vocabulary fits, else four (the manifest
says which). The index file of a data file holds each frame's offset (u64), so that a reader can seek
to any frame, in any order. Checksums are CRC-32, rotated right by 15 bits and offset by a constant,
as is common for framed records. Files are in ascending order of document ids, as are their records.

Defined cases: null and empty texts have only the end id; null document ids come first and read back
as null; repeated ids keep all their rows, next to each other; an empty table gives an empty one.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import create, fresh_folder, random_access, task_file
from .letters import WHITE
from .scan import SPACE, raw, slices, word_hashes
from .shared import bounded_batches, keep, table
from .warc import spread

END_ID = 2
HELD, TOGETHER, SLICE = 2_000_000, 256, 1 << 22
#: Last bytes of the white space beyond ASCII in UTF-8, of which letters.WHITE has the code points.
WIDE_WHITE = np.array([int.from_bytes(chr(c).encode(), "big") for c in range(0x80, 0x3001) if re.fullmatch(f"[{WHITE}]", chr(c))], np.int64)
LATIN_BYTE, SIGN = np.zeros(256, bool), np.zeros(256, bool)
LATIN_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
SIGN[[c for c in range(0x21, 0x7F) if not LATIN_BYTE[c] and c != 0x27]] = True


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=2)
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind: str):
        self.room, self.size = np.empty(1 << 16, kind), 0

    def add(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.room):
            self.room = np.concatenate((self.room[: self.size], np.empty(max(need, 2 * self.size) - self.size, self.room.dtype)))
        self.room[self.size : need] = values
        self.size = need


def stretches(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[k], begin[k] + 1, ..., size[k] of them, for every k."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def cut_parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end of every part, whether a text must not be cut).

    A part is white space and the word after it, but for one ASCII sign at the word's end after a Latin letter or digit, which is a part of its
    own: no pre-token of a byte-level tokenizer reaches over such a part's ends. Only ASCII white space is told by its
    bytes; a text where other white space stands before it isn't cut, as the two would be one pre-token.
    """
    n = len(data)
    space, edge = SPACE[data], np.zeros(n + 1, bool)
    edge[offsets] = True
    mark = edge.copy()
    mark[1:n] |= ~space[:-1] & space[1:]
    end = np.flatnonzero(mark[1:]) + 1
    last, before = data[end - 1], data[np.maximum(end - 2, 0)]
    wide = np.flatnonzero(last >= 0x80)
    three = data[np.maximum(end[wide] - 3, 0)].astype(np.int64) << 16 | before[wide].astype(np.int64) << 8 | last[wide]
    white = np.isin(three, WIDE_WHITE) | np.isin(three & 0xFFFF, WIDE_WHITE)
    whole = np.zeros(len(offsets) - 1, bool)
    whole[np.searchsorted(offsets, end[wide[white]] - 1, "right") - 1] = True
    latin = LATIN_BYTE[before] | ((before >= 0x80) & (before != 0x97) & (before != 0xB7) & (data[np.maximum(end - 3, 0)] == 0xC3))
    mark[end[SIGN[last] & latin & ~edge[end - 1]] - 1] = True
    end = np.flatnonzero(mark[1:]) + 1
    return np.concatenate(([0], end[:-1])) if len(end) else end, end, whole


class Encoder:
    """Byte-level encoding by the tokenizers library, of every distinct part once: parts recur far more than texts.

    Parts are known by 64-bit hashes and their bytes: a part that has the hash of a known one is compared with it, but for
    those of equal hash and length within one slice of texts, which count as equal.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = [x.content for x in added.values()]
        apart = [(k, x.content) for k, x in added.items() if not (x.lstrip or x.rstrip or x.single_word)]
        self.apart = apart[0] if apart else None
        self.wide = self.tokenizer.get_vocab_size(True) > 1 << 16
        self.forget()

    def forget(self) -> None:
        self.keys, self.place = np.empty(0, np.uint64), np.empty(0, np.int64)  # sorted hashes, and where a part's entry is
        self.flat, self.begin, self.sizes = Grown("<u4"), Grown("<i8"), Grown("<i8")
        self.bytes, self.bytes_begin, self.bytes_size = Grown("u1"), Grown("<i8"), Grown("<i8")

    def ids_of(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts that stand end to end in ``data``, and how many each has; an added token between them keeps them apart in one text."""
        if self.apart and len(size) > 1:
            number, name = self.apart
            mark = np.frombuffer(name.encode(), np.uint8)
            wide = size + len(mark)
            room = np.empty(int(wide.sum()), np.uint8)
            begin = np.cumsum(wide) - wide
            room[stretches(begin, size)] = data
            room[stretches(begin + size, np.full(len(size), len(mark)))] = np.tile(mark, len(size))
            whole, cuts = room.tobytes(), [*begin[::TOGETHER].tolist(), len(room)]
            got = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast([whole[a:b].decode() for a, b in zip(cuts, cuts[1:])], add_special_tokens=False)]
            ids = np.concatenate(got)
            ends = np.flatnonzero(ids == number)
            if len(ends) == len(size) and all(len(x) and x[-1] == number for x in got):
                return ids[ids != number], np.diff(ends, prepend=-1) - 1
        ends = np.cumsum(size)
        got = [e.ids for e in self.tokenizer.encode_batch_fast([data[a:b].tobytes().decode() for a, b in zip(ends - size, ends)], add_special_tokens=False)]
        return np.array([x for ids in got for x in ids], np.uint32), np.array([len(ids) for ids in got], np.int64)

    def learn(self, data: np.ndarray, size: np.ndarray) -> None:
        """Entries of parts that stand end to end in ``data``, after the entries that there are."""
        if not len(size):
            return
        ids, counts = self.ids_of(data, size)
        for where, begin, held, values, n in ((self.flat, self.begin, self.sizes, ids, counts), (self.bytes, self.bytes_begin, self.bytes_size, data, size)):
            begin.add(where.size + np.cumsum(n) - n)
            held.add(n)
            where.add(values)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (large strings without nulls), end to end, and where each one's begin (one more than there are texts)."""
        if len(self.keys) > HELD:
            self.forget()
        data, offsets = raw(texts)
        start, end, whole = cut_parts(data, offsets)
        together = data.tobytes()
        for name in self.added:
            at = together.find(name.encode())
            while at >= 0:
                whole[np.searchsorted(offsets, at, "right") - 1] = True
                at = together.find(name.encode(), at + 1)
        if whole.any():
            own = ~whole[np.searchsorted(offsets, end - 1, "right") - 1]
            start, end = start[own], end[own]
        entry = self.entries(data, start, end)
        if whole.any():
            # A text that isn't cut is one part, in its place; it isn't remembered.
            texts_whole = np.flatnonzero(whole)
            kept, first = [x.size for x in self.grown()], self.begin.size
            n = np.diff(offsets)[texts_whole]
            for own in np.split(np.arange(len(n)), len(n)):  # each by itself, as it may hold added tokens
                self.learn(data[stretches(offsets[texts_whole[own]], n[own])], n[own])
            at = np.searchsorted(start, offsets[texts_whole])
            start, end = np.insert(start, at, offsets[texts_whole]), np.insert(end, at, offsets[texts_whole + 1])
            entry = np.insert(entry, at, first + np.arange(len(texts_whole)))
        size = self.sizes.room[entry]
        ids = self.flat.room[stretches(self.begin.room[entry], size)]
        if whole.any():
            for x, before in zip(self.grown(), kept):
                x.size = before
        return ids, np.concatenate(([0], np.cumsum(size)))[np.searchsorted(end, offsets, "right")]

    def grown(self) -> tuple[Grown, ...]:
        return self.flat, self.begin, self.sizes, self.bytes, self.bytes_begin, self.bytes_size

    def entries(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Each part's entry; new parts get one."""
        size = end - start
        h, first, back = np.unique(word_hashes(data, start, end) ^ (size.astype(np.uint64) << np.uint64(40)), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, h)
        known = np.zeros(len(h), bool)
        known[at < len(self.keys)] = self.keys[at[at < len(self.keys)]] == h[at < len(self.keys)]
        entry = np.full(len(h), -1, np.int64)
        entry[known] = self.place[at[known]]
        own = np.flatnonzero(known)
        if len(own):
            same = self.bytes_size.room[entry[own]] == size[first[own]]
            own_same = own[same]
            n = size[first[own_same]]
            equal = self.bytes.room[stretches(self.bytes_begin.room[entry[own_same]], n)] == data[stretches(start[first[own_same]], n)]
            same[same] = np.logical_and.reduceat(equal, np.cumsum(n) - n) if len(n) else True
            entry[own[~same]] = -1
        new = np.flatnonzero(entry < 0)
        entry[new] = self.begin.size + np.arange(len(new))
        n = size[first[new]]
        self.learn(data[stretches(start[first[new]], n)], n)
        free = new[~known[new]]
        self.keys, self.place = np.insert(self.keys, at[free], h[free]), np.insert(self.place, at[free], entry[free])
        return entry[back]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(data: bytes, at: int) -> tuple[bytes, int]:
    """The payload of the frame at ``at`` and where the next begins; ValueError where a checksum fails."""
    size = data[at : at + 8]
    n = int.from_bytes(size, "little")
    payload = data[at + 12 : at + 12 + n]
    if len(size) < 8 or masked(size) != int.from_bytes(data[at + 8 : at + 12], "little") or len(payload) < n or masked(payload) != int.from_bytes(data[at + 12 + n : at + 16 + n], "little"):
        raise ValueError(f"a damaged frame at {at}")
    return payload, at + 16 + n


MANIFEST = "part long, path string, records long, tokens long, width int"


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files in ascending order of doc_id; returns their manifest with starts.

    Range partitioning shuffles the texts once, before they are encoded; the ids are never shuffled.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = fresh_folder(spark, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, path, out, at, tokens, offsets = encoder(tokenizer), task_file(folder, ".tok"), None, 0, 0, []
        kind = "<u4" if own.wide or end_id > 0xFFFF else "<u2"
        for batch in batches:
            ids = batch.column("doc_id")
            for first, texts in slices(batch.column("text"), SLICE):
                flat, bounds = own.encode(texts)
                flat, end = flat.astype(kind), np.array([end_id], kind).tobytes()
                for k, doc_id in enumerate(ids.slice(first, len(texts)).to_pylist()):
                    out = out or create(path)
                    framed = frame(struct.pack("<bq", doc_id is None, doc_id or 0) + flat[bounds[k] : bounds[k + 1]].tobytes() + end)
                    out.write(framed)
                    offsets.append(at)
                    at += len(framed)
                    tokens += int(bounds[k + 1] - bounds[k]) + 1
        if out:
            out.close()
            with create(f"{path}.idx") as index:
                index.write(np.array([*offsets, at], "<u8").tobytes())
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int64()), "path": [path], "records": pa.array([len(offsets)], pa.int64()), "tokens": pa.array([tokens], pa.int64()), "width": pa.array([int(kind[2])], pa.int32())})

    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    manifest = keep(ordered.mapInArrow(write, MANIFEST), "token-manifest")
    # One row per file of many megabytes: the driver adds up their token counts.
    rows, start = [], 0
    for row in manifest.orderBy("part").toLocalIterator():
        rows.append((*row, start))
        start += row.tokens
    return spark.createDataFrame(rows, T.StructType([*manifest.schema.fields, T.StructField("start", T.LongType())]))


def read_token_files(manifest: DataFrame, ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, ids of every record, by the offset indexes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, width, start in zip(*(batch.column(k).to_pylist() for k in ("path", "width", "start"))):
                with random_access(f"{path}.idx") as index:
                    offsets = np.frombuffer(index.read(), "<u8").astype(np.int64)
                with random_access(path) as data:
                    at = 0
                    while at < len(offsets) - 1:
                        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (1 << 22), "right")) - 1)
                        data.seek(int(offsets[at]))
                        block, rows = data.read(int(offsets[upto] - offsets[at])), []
                        for offset in offsets[at:upto] - offsets[at]:
                            payload, _ = unframe(block, int(offset))
                            null, doc_id = struct.unpack_from("<bq", payload)
                            own = np.frombuffer(payload, f"<u{width}", offset=9).astype("<u4")
                            rows.append((None if null else doc_id, start, len(own), zlib.crc32(own.tobytes()), own))
                            start += len(own)
                        columns = list(zip(*rows))
                        arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + ([pa.array(columns[4], pa.list_(pa.int64()))] if ids else [])
                        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * ids])
                        at = upto

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids
    return manifest.select("path", "width", "start").repartition(spread(manifest.sparkSession)).mapInArrow(read, schema)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode ``documents`` into token files, read them back: see the module."""
    manifest = write_token_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return read_token_files(manifest, ids=False)
