"""N-gram Jaccard join by PartEnum signatures, and the groups that its links form.

A text's set holds its distinct shingles of five words. Two different sets link when their Jaccard similarity is
at least ``percent`` / 100. Sizes are cut into bands; a pair belongs to the band of its smaller set, and there its
symmetric difference has at most k members. The shingles' domain is partitioned into n1 groups of n2 parts such that
in some group at most k2 parts differ; so the two sets agree in one of the enumerated subsets of n2 - k2 parts and
share that subset's signature, and mostly many: a set that shares fewer signatures than any partner would share with it
is out. A set gives signatures to its own band and to those of its possible smaller partners.

Signatures of nothing would be shared by sets that have nothing in common. There are more parts than needed
(``SPARE``), so that a set leaves its empty subsets out if a pair that agrees in k fewer parts must still agree in
one that isn't empty; a set with too many empty ones gives the signatures of another partition besides, as both sets of
a pair that has nothing better then do.

Steps. Texts with equal sets are one class, by a 64-bit fingerprint of the set. (1) The signatures are dealt to
buckets in packed form, a slice's row for a bucket naming only the classes in it; of classes that share one, each is paired with the smallest. (2) Texts of the paired classes are
compared in full: first each class with the partner that it shares most signatures with, then the pairs between
different components. (3) Where classes that share a signature are still in different components, all pairs across these
components are compared, the hopeless ones being told by parities of their shingles, and the closest first. So no link between different
components is missed, and the work inside a component, of any size, is linear.

Defined cases: null and empty texts, and texts without words, have an empty set and are linked with nothing; a text of
fewer than five words has its whole word sequence as one shingle; rows with equal ids are one document, which links by any of
its texts, and each keeps its row; a null id is in no group (component_id null); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .packed import binary, in_order, lengths, repeated, unpack
from .scan import NOT_SPACE, Words, mix, ngrams, slices, words
from .shared import bounded_batches, give_back, keep, release, spread_over, table, text_bytes, tidy

SHINGLE, PERCENT, SPARE, LEVELS = 5, 80, 1.15, 4
WIDER = 1.25
SLICE = 1 << 22
SPLIT, HOT = 512, 10_000


def tell() -> Column:
    """What tells rows of one id apart by their texts."""
    return F.xxhash64("text").alias("tell")


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted."""
    w: Words = words(texts, NOT_SPACE, lower=True)
    g = ngrams(w.hash, n)
    out = []
    for a, b in zip(w.ptr[:-1].tolist(), w.ptr[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(g[a : b - n + 1]))
        else:
            out.append(mix(ngrams(w.hash[a:b], b - a) ^ np.uint64(b - a)) if b > a else np.empty(0, np.uint64))
    return out


def fingerprint(s: np.ndarray) -> int:
    """Of a set; equal for equal sets."""
    total = np.array([mix(s ^ np.uint64(0xA5A5)).sum(dtype=np.uint64) ^ np.uint64(len(s))])
    return int(mix(total).view(np.int64)[0])


class Bands:
    """Bounds of the size bands, and each one's k, parts and way to enumerate."""

    def __init__(self, percent: int = PERCENT, most: int = 1 << 40):
        self.percent, self.low, self.k, self.parts = percent, [], [], []
        size = 1
        while size < most:
            nxt = max(size + 1, int(size * WIDER))
            small = nxt - 1
            k = (small + small * 100 // percent) * (100 - percent) // (100 + percent)
            self.low.append(size)
            self.k.append(k)
            self.parts.append({0: 0, 1: 3, 2: 4}.get(k, 2 * -(-int((k + 1) * SPARE + 1) // 2)))
            size = nxt
        self.low, self.k, self.parts = (np.array(x, np.int64) for x in (self.low, self.k, self.parts))

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, "right") - 1


BANDS = Bands()
SUBSETS = {3: list(combinations(range(3), 2)), 4: list(combinations(range(4), 2))}


def signatures(sets: list[np.ndarray], bands: Bands = BANDS, needed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of the set) of all sets; sets must be sorted.

    ``needed``, if given, takes the least number of signatures that each set shares with any set similar to it.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    own = bands.of(np.maximum(sizes, 1))
    least = bands.of(np.maximum(-(-sizes * bands.percent // 100), 1))
    for step in range(int((own - least).max(initial=0)) + 1):
        tag = own - step
        todo = np.flatnonzero((sizes > 0) & (tag >= least) & (bands.k[np.maximum(tag, 0)] > 0))
        for level in range(LEVELS):
            if not len(todo):
                break
            todo = _level([sets[i] for i in todo], todo, tag[todo], level, bands, out, needed if not level else None)
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate([s for s, _ in out]), np.concatenate([i for _, i in out])


def _level(sets: list[np.ndarray], index: np.ndarray, tag: np.ndarray, level: int, bands: Bands, out: list, needed: np.ndarray | None) -> np.ndarray:
    """One partition's signatures; returns the sets that need another partition's, too."""
    if level:
        sets = [np.sort(mix(s ^ np.uint64(0x51ED * level))) for s in sets]
    sizes = np.array([len(s) for s in sets])
    ptr = np.concatenate(([0], np.cumsum(sizes)))
    flat, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    parts, k = bands.parts[tag], bands.k[tag]
    # Parts are ranges of the hashes, so each is a run of the sorted set.
    part = ((flat >> np.uint64(32)) * parts[doc].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero((np.diff(part, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
    sums = np.add.reduceat(mix(flat + np.uint64(level + 1)), first)
    part, doc = part[first], doc[first]
    last = level == LEVELS - 1
    salt = mix((tag * 16 + level).astype(np.uint64))
    small = k <= 2
    big = ~small[doc]
    out.append((mix(sums[big] ^ mix(salt[doc[big]] + part[big].astype(np.uint64))), index[doc[big]]))
    filled = np.bincount(doc, minlength=len(sets))
    more = ~small & (parts - filled >= parts - k)
    if needed is not None:
        # The partner in this band that may differ most; all parts but k and the empty ones then agree.
        other = np.where(bands.of(sizes) == tag, sizes * 100 // bands.percent, bands.low[tag + 1] - 1)
        sure = parts - (sizes + other) * (100 - bands.percent) // (100 + bands.percent) - (parts - filled)
        np.minimum.at(needed, index, np.where(small | more, 1, np.maximum(sure, 1)))
    if last and more.any():  # nothing better is left than signatures of empty parts
        for d in np.flatnonzero(more):
            gone = np.setdiff1d(np.arange(parts[d]), part[doc == d]).astype(np.uint64)
            out.append((mix(mix(salt[d] + gone)), np.full(len(gone), index[d])))
    for n, subsets in SUBSETS.items():
        chosen = np.flatnonzero(small & (parts == n))
        if not len(chosen):
            continue
        place = np.full(len(sets), -1)
        place[chosen] = np.arange(len(chosen))
        here = np.flatnonzero(place[doc] >= 0)
        dense = np.zeros((len(chosen), n), np.uint64)
        dense[place[doc[here]], part[here]] = sums[here]
        for k_subset, subset in enumerate(subsets):
            values = salt[chosen] + np.uint64(1000 + k_subset)
            for p in subset:
                values = mix(values ^ dense[:, p])
            empty = (dense[:, list(subset)] == 0).all(axis=1)
            more[chosen[empty]] = True
            ok = np.ones(len(chosen), bool) if last else ~empty
            out.append((values[ok], index[chosen[ok]]))
    return index[more]


#: What is dealt to buckets: 40 bits of a signature (the bucket has more) and the place of its class among the row's; the row's classes.
ENTRY = np.dtype([("sig", "<u4"), ("top", "u1"), ("at", "<u2"), ("at_top", "u1")])
CLASS = np.dtype([("name", "<i8"), ("needed", "<u4")])


def deal(texts: pa.Array, buckets: int) -> pa.RecordBatch | None:
    """The slice's signatures by bucket: entries and the classes that they name, no others."""
    classes: dict[int, np.ndarray] = {}
    for s in shingle_sets(texts):
        if len(s):
            classes.setdefault(fingerprint(s), s)
    if not classes:
        return None
    names = np.fromiter(classes, np.int64, len(classes))
    needed = np.full(len(classes), 1 << 30)
    sig, at = signatures(list(classes.values()), needed=needed)
    bucket = ((sig >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    order = in_order(at, len(classes))
    order = order[in_order(bucket[order], buckets)]
    bucket, sig, at = bucket[order], sig[order], at[order]
    cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    new = np.append(True, (bucket[1:] != bucket[:-1]) | (at[1:] != at[:-1]))[: len(at)]
    held = np.cumsum(new)
    cut_classes = np.concatenate(([0], held))[cut]
    own = np.zeros(int(new.sum()), CLASS)
    own["name"], own["needed"] = names[at[new]], needed[at[new]]
    place = held - 1 - np.repeat(cut_classes[:-1], np.diff(cut))
    entries = np.zeros(len(sig), ENTRY)
    entries["sig"], entries["top"] = sig.astype(np.uint32), (sig >> np.uint64(32)).astype(np.uint8)
    entries["at"], entries["at_top"] = place & 0xFFFF, place >> 16
    return pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]], pa.int32()), binary(entries, cut), binary(own, cut_classes)], ["bucket", "entries", "classes"])


def _members(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, class, what the class needs), sorted and distinct, of the signatures that more than one class has."""
    entries, own = unpack(group["entries"], ENTRY), unpack(group["classes"], CLASS)
    sig = entries["sig"].astype(np.uint64) | (entries["top"].astype(np.uint64) << np.uint64(32))
    at = entries["at"].astype(np.int64) | (entries["at_top"].astype(np.int64) << 16)
    sizes = lengths(group["classes"], CLASS.itemsize)
    at += np.repeat(np.cumsum(sizes) - sizes, lengths(group["entries"], ENTRY.itemsize))
    names, needed = own["name"], own["needed"]
    order = np.argsort(sig, kind="stable")
    sig, at = sig[order], at[order]
    keep_shared = repeated(sig)
    sig, at = sig[keep_shared], at[keep_shared]
    order = np.lexsort((names[at], sig))
    sig, at = sig[order], at[order]
    node = names[at]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node, at = sig[new], node[new], at[new]
    keep_shared = repeated(sig)
    return sig[keep_shared], node[keep_shared], needed[at[keep_shared]]


def _stars(group: pa.Table) -> pa.Table:
    """Each class b with the smallest class a that shares a signature, how many such signatures, and what b needs; a itself, too."""
    give_back()
    sig, node, needed = _members(group)
    first = np.searchsorted(sig, sig)
    order = np.lexsort((node, node[first]))
    a, b, needed = node[first][order], node[order], needed[order]
    new = np.flatnonzero((np.diff(a, prepend=0) != 0) | (np.diff(b, prepend=0) != 0) | (np.arange(len(a)) == 0))
    n = np.diff(np.append(new, len(a)))
    return pa.table({"a": pa.array(a[new], pa.int64()), "b": pa.array(b[new], pa.int64()), "n": pa.array(n, pa.int64()), "needed": pa.array(needed[new].astype(np.int64), pa.int64())})


def buckets_for(size: int) -> int:
    """A bucket for 16 MB of text: a task then holds about as much of signatures."""
    return max(64, size >> 24)


def dealt(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch.column("text"), SLICE):
                if (found := deal(texts, buckets)) is not None:
                    yield found

    return docs.select("text").mapInArrow(tidy(run), "bucket int, entries binary, classes binary")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, tell (a hash that tells texts of one id apart), n_shingles, class (null without shingles) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column("text"), SLICE):
                sets = shingle_sets(texts)
                names = pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, len(texts)) for c in ("doc_id", "tell")), pa.array([len(s) for s in sets], pa.int64()), names], ["doc_id", "tell", "n_shingles", "class"])

    return docs.select("doc_id", tell(), "text").mapInArrow(tidy(run), f"doc_id {kind}, tell long, n_shingles long, class long")


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """The exact test of two sorted sets."""
    if min(len(a), len(b)) * 100 < max(len(a), len(b)) * percent:
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of the class pairs a, b those that link. ``texts`` has class and text.

    The text of a, and those of its partners, meet in one task; where there are more than SPLIT partners, in several,
    each with the text of a. A task holds one set of a at a time.
    """
    wide = pairs.groupBy("a").agg(F.count("*").alias("n")).select("a", F.ceil(F.col("n") / SPLIT).cast("int").alias("tasks"))
    hubs = wide.join(texts.select(F.col("class").alias("a"), "text"), "a").select("a", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), F.lit(None).cast("long").alias("b"), "text")
    spokes = pairs.join(wide, "a").join(texts.select(F.col("class").alias("b"), "text"), "b").select("a", F.pmod(F.xxhash64("b"), F.col("tasks")).cast("int").alias("task"), "b", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, None
        for batch in batches:
            for first, part in slices(batch.column("text"), SLICE):
                a, b = (batch.column(k).slice(first, len(part)).to_pylist() for k in ("a", "b"))
                found = []
                for x, y, s in zip(a, b, shingle_sets(part)):
                    if y is None:
                        hub, own = x, s
                    elif x == hub and similar(own, s, percent):
                        found.append((x, y))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return hubs.unionByName(spokes).repartition("a", "task").sortWithinPartitions("a", "task", F.col("b").asc_nulls_first()).drop("task").mapInArrow(tidy(run), "a long, b long")


def with_components(frame: DataFrame, comp: DataFrame, *columns: str) -> DataFrame:
    """Adds comp_<column>, a class's component: itself where it has no link."""
    for c in columns:
        frame = frame.join(comp.select(F.col("node").alias(c), F.col("comp").alias(f"comp_{c}")), c, "left").withColumn(f"comp_{c}", F.coalesce(f"comp_{c}", c))
    return frame


BLOCK, ALL, ROWS = 4096, 1 << 30, 50_000


def parities(s: np.ndarray) -> bytes:
    """Bits, a power of two and at least twice as many as members: bit i is the parity of how many members fall to i."""
    n = max(512, 1 << (2 * len(s) - 1).bit_length())
    return np.packbits((np.bincount((mix(s) & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1).astype(np.uint8)).tobytes()


def folded(rows: list[bytes]) -> np.ndarray:
    """Parities as a matrix, all folded to the shortest: two sets differ in at least as many members as their rows in bits."""
    least = min(map(len, rows))
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(r, np.uint64).reshape(-1, least // 8), axis=0) for r in rows])


def _across(width: int, percent: int = PERCENT):
    """Pairs of classes of different components that aren't hopeless, by signature and block pair: each class with its ``width`` closest.

    Every such pair has a member outside the largest component there, so only those members look for partners.
    """

    def run(group: pa.Table) -> pa.Table:
        sig, x, y, node, comp, size, block = (group[k].to_numpy() for k in ("sig", "x", "y", "node", "comp", "size", "block"))
        order = np.lexsort((node, comp, y, x, sig))
        sig, x, y, node, comp, size, block = (v[order] for v in (sig, x, y, node, comp, size, block))
        bits = group["parity"].combine_chunks()
        first = np.flatnonzero((np.diff(sig, prepend=sig[0] - 1) != 0) | (np.diff(x, prepend=-1) != 0) | (np.diff(y, prepend=-1) != 0))
        pairs = [np.empty((2, 0), np.int64)]
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(sig)]):
            own, n, where = comp[a:b], size[a:b], node[a:b]
            names, counts = np.unique(own, return_counts=True)
            if len(names) < 2:
                continue
            rows = folded([bits[int(k)].as_py() for k in order[a:b]])
            for i in np.flatnonzero(own != names[counts.argmax()]).tolist():
                ok = (own != own[i]) & (100 * np.minimum(n[i], n) >= percent * np.maximum(n[i], n))
                if x[a] != y[a]:
                    ok &= block[a:b] != block[a + i]
                j = np.flatnonzero(ok)
                spare = (n[i] + n[j]) * (100 - percent) - np.bitwise_count(rows[i] ^ rows[j]).sum(axis=1).astype(np.int64) * (100 + percent)
                j, spare = j[spare >= 0], spare[spare >= 0]
                j = j[np.lexsort((where[j], -spare))[:width]]
                pairs.append(np.stack([np.full(len(j), where[i]), where[j]]))
            if len(pairs) > 4096:
                pairs = [np.unique(np.sort(np.concatenate(pairs, axis=1), axis=0), axis=1)]
        found = np.unique(np.sort(np.concatenate(pairs, axis=1), axis=0), axis=1)
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    return run


def shared_signatures(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sig, node of the signatures that several classes have; node, size, needed, parity). ``texts`` has class and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column("text")):
                sig, at = signatures(shingle_sets(part))
                node = np.array(batch.column("class").slice(first, len(part)).to_pylist(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(node[at])], ["sig", "node"])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column("text")):
                sets = shingle_sets(part)
                needed = np.full(len(sets), 1 << 30)
                signatures(sets, needed=needed)
                yield pa.RecordBatch.from_arrays([batch.column("class").slice(first, len(part)), pa.array([len(s) for s in sets], pa.int64()), pa.array(needed, pa.int64()), pa.array([parities(s) for s in sets], pa.binary())], ["node", "size", "needed", "parity"])

    texts = texts.select("class", "text")
    rows = keep(texts.mapInArrow(tidy(run), "sig long, node long"), "signatures")
    several = rows.groupBy("sig").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("sig")
    return keep(rows.join(several, "sig").distinct(), "shared-signatures"), keep(texts.mapInArrow(tidy(sketch), "node long, size long, needed long, parity binary"), "sketches")


def unresolved(rows: DataFrame, sketches: DataFrame, comp: DataFrame, width: int) -> DataFrame:
    """Candidate pairs a, b across components, of classes that share a signature."""
    rows = keep(with_components(rows, comp, "node").withColumnRenamed("comp_node", "comp"), "placed")
    # A class that shares too few signatures with classes of other components links with none of them.
    mixed = rows.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("sig")
    rows = rows.join(mixed, "sig")
    enough = rows.groupBy("node").agg(F.count("*").alias("n")).join(sketches.select("node", "needed"), "node").where("n >= needed").select("node")
    rows = keep(rows.join(enough, "node"), "mixed")
    sums = rows.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("m"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("who")).where("low <> high")
    # Signatures of the same members ask the same: one of them is enough. Many members meet in pairs of blocks.
    once = sums.groupBy("m", "who").agg(F.min("sig").alias("sig")).select("sig", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    met = rows.join(once, "sig").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = keep(met.select("sig", "node", "comp", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")), "met")
    groups = max(1, met.count() // ROWS)
    met = met.join(sketches.drop("needed"), "node").withColumn("deal", F.pmod(F.xxhash64("sig", "x", "y"), F.lit(groups)))
    return met.groupBy("deal").applyInArrow(_across(width), "a long, b long").distinct()


def class_links(docs: DataFrame, carriers: DataFrame) -> DataFrame:
    """Links a, b between classes that connect all that is connected. ``carriers`` has class, doc_id and tell of a text of each class."""
    size = text_bytes(docs)
    stars = spread_over(dealt(docs, buckets_for(size)), size, "bucket").groupBy("bucket").applyInArrow(_stars, "a long, b long, n long, needed long")
    found = keep(stars.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("needed").alias("needed")), "star-pairs")
    # A class that shares fewer signatures with all others together than with one similar class links with none.
    enough = keep(found.groupBy(F.col("b").alias("node")).agg(F.sum("n").alias("n"), F.max("needed").alias("needed")).where("n >= needed").select("node"), "enough")
    stars = found.where("a <> b").select("a", "b", "n").join(enough.select(F.col("node").alias("b")), "b", "left_semi")
    stars = stars.join(enough.select(F.col("node").alias("a"), F.lit(True).alias("open")), "a", "left")
    stars = keep(stars.select("a", "b", "n", F.coalesce("open", F.lit(False)).alias("open")), "pairs")
    release(found, enough)
    nodes = stars.where("open").select(F.col("a").alias("class")).union(stars.select("b")).distinct()
    one = carriers.join(nodes, "class").select("class", "doc_id", "tell")
    texts = keep(docs.select("doc_id", tell(), "text").join(one, ["doc_id", "tell"]).select("class", "text"), "candidate-texts")
    best = stars.where("open").groupBy("b").agg(F.max_by("a", F.struct("n", -F.col("a"))).alias("a")).select("a", "b")
    links = keep(verified(best, texts), "links")
    comp = components(links)
    rest = keep(with_components(stars.where("open").join(best, ["a", "b"], "left_anti"), comp, "a", "b").where("comp_a <> comp_b").select("a", "b"), "rest-pairs")
    if rest.limit(1).count():
        links = keep(links.union(verified(rest, texts)), "links")
        release(comp)
        comp = components(links)
    # Where all that shares a signature with some class is connected, no link can be missing.
    placed = with_components(stars, comp, "a", "b")
    around = placed.select("a", "comp_b").union(placed.where("open").select("a", "comp_a")).groupBy("a").agg(F.min("comp_b").alias("low"), F.max("comp_b").alias("high")).where("low <> high").select("a")
    around = stars.join(around, "a", "left_semi")
    around = keep(around.where("open").select(F.col("a").alias("class")).union(around.select("b")).distinct(), "around")
    if around.limit(1).count():
        rows, sketches = shared_signatures(texts.join(around, "class", "left_semi"))
        tested = keep(best.union(rest), "tested")
        # Few partners of each class at first, as one link joins whole components; then, all that are left.
        for width in (2, ALL):
            more = keep(unresolved(rows, sketches, comp, width).join(tested, ["a", "b"], "left_anti"), "across-pairs")
            if more.limit(1).count():
                links = keep(links.union(verified(more, texts)), "links")
                release(comp)
                comp, tested = components(links), keep(tested.union(more), "tested")
        release(rows, sketches)
    release(comp, stars, around, texts, rest)
    return links


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class, component_id of every row."""
    bounded_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    members = keep(classes(docs), "classes")
    known = members.where("doc_id is not null and class is not null")
    carriers = keep(known.groupBy("class").agg(F.min(F.struct("doc_id", "tell")).alias("least"), F.count("*").alias("n")).select("class", "least.*", "n"), "carriers")
    links = class_links(docs.where("doc_id is not null"), carriers)
    # A document whose rows differ has several classes: documents then connect classes, too.
    several = known.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("high")).where("a <> high")
    extra = several.select("doc_id", "a").join(known.select("doc_id", "class").distinct(), "doc_id").where("class <> a").select("a", F.col("class").alias("b"))
    # Each class goes by its smallest document, so that a component's smallest node is its smallest document.
    first = carriers.select("class", F.col("doc_id").alias("first"))
    edges = links.union(extra).join(first.select(F.col("class").alias("a"), F.col("first").alias("x")), "a").join(first.select(F.col("class").alias("b"), F.col("first").alias("y")), "b").where("x <> y")
    comp = components(edges.select(F.col("x").alias("a"), F.col("y").alias("b")))
    least = keep(carriers.join(comp.select(F.col("node").alias("doc_id"), "comp"), "doc_id", "left").select("class", F.coalesce("comp", "doc_id").alias("component_id"), "n"), "class-components")
    release(carriers, links, comp)
    # A class with more than a HOT-th of all rows: there are fewer than HOT of them, so they are broadcast; no other class is large.
    most = least.agg(F.sum("n")).head()[0] or 0
    hot = least.where(F.col("n") * HOT > most).select("class", F.col("component_id").alias("hot_id"))
    split = members.drop("tell").join(F.broadcast(hot), "class", "left")
    cold = split.where("hot_id is null").join(least.where(F.col("n") * HOT <= most).select("class", "component_id"), "class", "left")
    own = lambda found: F.when(F.col("class").isNull() | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col(found)).alias("component_id")
    out = ["doc_id", "n_shingles", "class"]
    return cold.select(*out, own("component_id")).union(split.where("hot_id is not null").select(*out, own("hot_id")))


def op4_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of ``documents``: see the module."""
    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")

