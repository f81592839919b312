"""Language-model scoring: a log-bilinear model learned by noise-contrastive estimation.

Symbols: the end, the ``FREQUENT`` most frequent words, and ``RARE`` classes that the other words fall into by
their last letters and punctuation. The neural part gives the distribution of the next symbol after two symbols: a
prediction, the sum of the two context vectors, is multiplied with every symbol's vector and biased; as there are
only SYMBOLS squared contexts, batched matrix products normalise all of them beforehand, and a token costs one
dot product. Within a rare class, a word's share is (c + 1) / (N + V + 1) of the class's own counts, one place being
that of all unknown words. A second log-bilinear model, learned by the same estimation, tells the words of a class
apart in context: every word that occurs ``MEMBER_LEAST`` times in training has a vector, its share is multiplied
by the exponential of that vector's product with one of the symbol before it, and matrix products over each class
normalise the shares for every such symbol. So the probabilities of the known words and one unknown word per class
sum to one, and the words with vectors of their own grow in number with the corpus, up to ``HEAD``.

Corpus counts come from all training texts, and so does the neural part: texts are dealt to ``ROUNDS`` parts by a
hash, and each part to shards; in each round every shard learns from its texts in the order of their hashes, starting from the last round's
average, and the vectors are averaged by the tokens that they saw. So scores don't depend on how rows lie in files. Counts of the words above a threshold that keeps them within
``HEAD`` are broadcast, with the vectors; the other words' counts are joined, so that what is broadcast is bounded by ``HEAD`` words.

Defined cases: null and empty texts consist of the end alone; null ids count as held out; rows with equal ids are
scored each on its own; without any training text every token is unknown; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .packed import in_order, pack, schema, unpack
from .scan import NOT_SPACE, Words, mix, slices, words
from .shared import bounded_batches, keep, release, spread_over, table, text_bytes, tidy

FREQUENT, RARE, SIZE, NOISE, BATCH, ROUNDS = 895, 128, 24, 32, 4096, 2
SYMBOLS = 1 + FREQUENT + RARE
HEAD = 1 << 20
LEARN = 0.15
#: Of the words within a class: occurrences that give a word a vector, the vectors' length, noise words and tokens of a step, step width.
MEMBER_LEAST, MEMBER_SIZE, MEMBER_NOISE, MEMBER_BATCH, MEMBER_LEARN = 8, 8, 2, 1 << 15, 0.3
END = np.uint64(0x5D1F0A2C3B4E6978)
BIG_SLICE = 1 << 22


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(True))


def rare_class(w: Words) -> np.ndarray:
    """Of each word: by its last two letters, before a sign at its end, and that sign."""
    last = w.data[w.end - 1]
    sign = (last < 0x30) | ((last > 0x39) & (last < 0x61)) | ((last > 0x7A) & (last < 0x80))
    kind = np.where(sign, np.where(last == 0x2E, 1, np.where(last == 0x2C, 2, 3)), 0)
    end = np.maximum(w.end - sign, w.start + 1)
    a, b = w.data[end - 1].astype(np.uint64), w.data[np.maximum(end - 2, w.start)].astype(np.uint64)
    return (kind * (RARE // 4) + (mix(a * np.uint64(257) + b) % np.uint64(RARE // 4)).astype(np.int64)).astype(np.uint8)


def buckets_for(size: int) -> int:
    """A bucket for 16 MB of text, whatever the input's size."""
    return max(256, size >> 24)


def word_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """hash, cls, n of every word and the end in the texts that aren't held out."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch.column("text"), BIG_SLICE):
                w = words(texts, NOT_SPACE, lower=True)
                h, first, n = np.unique(w.hash, return_index=True, return_counts=True)
                cls = rare_class(w)[first]
                yield pack(np.append(h, END), buckets, [np.append(h, END), np.append(cls, np.uint8(0)), np.append(n, len(texts)).astype(np.uint32)])

    def add(group: pa.Table) -> pa.Table:
        h, cls, n = unpack(group["c0"], "<u8"), unpack(group["c1"], "<u1"), unpack(group["c2"], "<u4")
        h, first, back = np.unique(h, return_index=True, return_inverse=True)
        total = np.bincount(back, n, len(h)).astype(np.int64)
        return pa.table({"hash": h.view(np.int64), "cls": cls[first].astype(np.int32), "n": total})

    train = docs.where(~held_out(F.col("doc_id"))).select("text")
    return spread_over(train.mapInArrow(spread, schema(3)), buckets << 24, "bucket").groupBy("bucket").applyInArrow(add, "hash long, cls int, n long")


class Vocabulary:
    """The head of the counts, by hash, and what of it are symbols or have vectors within a class; totals of the rare classes."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, classes: np.ndarray, total: int, types: int, by_class: np.ndarray):
        order = np.lexsort((hashes, -counts))
        order = order[hashes[order] != END]
        symbol = np.full(len(hashes), -1, np.int16)
        symbol[order[:FREQUENT]] = 1 + np.arange(min(FREQUENT, len(order)))
        symbol[hashes == END] = 0
        own = order[FREQUENT:]
        own = own[counts[own] >= MEMBER_LEAST]
        member = np.full(len(hashes), -1, np.int32)
        member[own] = np.arange(len(own))
        #: Classes and counts of the words with vectors, from the most frequent on.
        self.member_class, self.member_counts = classes[own].astype(np.uint8), counts[own]
        by_hash = np.argsort(hashes)
        self.hashes, self.counts, self.symbol, self.member = hashes[by_hash], counts[by_hash], symbol[by_hash], member[by_hash]
        self.total, self.types = total, types
        #: Tokens and types of each rare class, without the frequent words.
        self.by_class = by_class
        self.end_count = int(counts[hashes == END].sum())
        self.unigram = np.zeros(SYMBOLS)
        frequent = self.symbol >= 0
        self.unigram[self.symbol[frequent]] = self.counts[frequent]
        self.unigram[1 + FREQUENT :] = by_class[0]
        self.unigram = (self.unigram + 1) / (self.unigram.sum() + SYMBOLS)

    def look_up(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """By word: its symbol, its count, whether the head knows it, and its vector within its class (-1: none)."""
        cls = 1 + FREQUENT + rare_class(w).astype(np.int64)
        if not len(self.hashes):
            return cls, np.zeros(len(cls), np.int64), np.zeros(len(cls), bool), np.full(len(cls), -1, np.int32)
        at = np.minimum(np.searchsorted(self.hashes, w.hash), len(self.hashes) - 1)
        known = self.hashes[at] == w.hash
        symbol = np.where(known, self.symbol[at], -1).astype(np.int64)
        return np.where(symbol >= 0, symbol, cls), np.where(known, self.counts[at], 0), known, np.where(known, self.member[at], -1)


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, int]:
    """Broadcastable part of the counts, and the count from which on words are in it."""
    whole = counts.agg(F.sum("n"), F.count("*")).head()
    # Words by count: at most HEAD + 1 of these rows come to the driver, as each stands for a word or more.
    sizes = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n"))
    least, held = 1, 0
    for row in sizes.toLocalIterator():
        held += row.words
        if held > HEAD:
            least = row.n + 1
            break
    head = counts.where((F.col("n") >= least) | (F.col("hash") == int(END.astype(np.int64)))).select("hash", "cls", "n").toArrow()
    hashes, cls, n = head["hash"].to_numpy().view(np.uint64), head["cls"].to_numpy(), head["n"].to_numpy()
    order = np.lexsort((hashes, -n))
    frequent = order[hashes[order] != END][:FREQUENT]
    classes = counts.where(F.col("hash") != int(END.astype(np.int64))).groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    by_class = np.zeros((2, RARE), np.int64)
    for row in classes:
        by_class[:, row.cls] = row.n, row.v
    np.subtract.at(by_class, (0, cls[frequent]), n[frequent])
    np.subtract.at(by_class, (1, cls[frequent]), 1)
    return Vocabulary(hashes, n, cls, whole[0] or 0, whole[1], by_class), least


def sequences(w: Words, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols with each text's end, the two symbols before each, and where the texts begin."""
    n = len(w.ptr) - 1
    begin = w.ptr + np.arange(n + 1)
    out = np.zeros(len(symbol) + n, np.int64)
    out[np.arange(len(symbol)) + w.doc] = symbol
    before = np.concatenate(([0], out[:-1]))
    before2 = np.concatenate(([0, 0], out[:-2]))[: len(out)]
    before[begin[:-1]] = 0
    before2[begin[:-1]] = 0
    second = begin[:-1][np.diff(begin) > 1] + 1
    before2[second] = 0
    return out, before, before2, begin


class LogBilinear:
    """score(w | a, b) = (near[a] + far[b]) . target[w] + bias[w]."""

    def __init__(self, unigram: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.parts = {k: (rng.standard_normal((SYMBOLS, SIZE)) * 0.1).astype(np.float32) for k in ("near", "far", "target")}
        self.parts["bias"] = np.log(unigram).astype(np.float32)
        self.noise = unigram

    def learn(self, symbols: np.ndarray, near: np.ndarray, far: np.ndarray, state: dict[str, np.ndarray], rng: np.random.Generator) -> None:
        """Noise-contrastive steps over shuffled tokens; NOISE symbols are shared by a step's tokens."""
        p, log_noise = self.parts, np.log(NOISE * self.noise).astype(np.float32)
        order = rng.permutation(len(symbols))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            w, a, b = symbols[own], near[own], far[own]
            drawn = rng.choice(SYMBOLS, NOISE, p=self.noise)
            q = p["near"][a] + p["far"][b]
            target, other = p["target"][w], p["target"][drawn]
            real = 1 / (1 + np.exp(log_noise[w] - p["bias"][w] - np.einsum("ij,ij->i", q, target)))
            fake = 1 / (1 + np.exp(log_noise[drawn] - p["bias"][drawn] - q @ other.T))
            up = (1 - real)[:, None]
            step_q = up * target - fake @ other
            grads = {k: np.zeros_like(v) for k, v in p.items()}
            gather(grads["near"], a, step_q)
            gather(grads["far"], b, step_q)
            gather(grads["target"], w, up * q)
            np.subtract.at(grads["target"], drawn, fake.T @ q)
            grads["bias"] += np.bincount(w, up[:, 0], SYMBOLS).astype(np.float32)
            np.subtract.at(grads["bias"], drawn, fake.sum(axis=0))
            for k, g in grads.items():
                g /= len(own)
                state[k] += g * g
                p[k] += LEARN * g / np.sqrt(state[k] + 1e-10)

    def normaliser(self) -> np.ndarray:
        """Natural log of the normaliser of every context (near, far), by one matrix product for each near symbol."""
        out = np.empty((SYMBOLS, SYMBOLS), np.float32)
        for a in range(SYMBOLS):
            s = (self.parts["near"][a] + self.parts["far"]) @ self.parts["target"].T + self.parts["bias"]
            top = s.max(axis=1, keepdims=True)
            out[a] = top[:, 0] + np.log(np.exp(s - top).sum(axis=1))
        return out

    def log10(self, symbols: np.ndarray, near: np.ndarray, far: np.ndarray, normal: np.ndarray) -> np.ndarray:
        p = self.parts
        s = np.einsum("ij,ij->i", p["near"][near] + p["far"][far], p["target"][symbols]) + p["bias"][symbols]
        return (s - normal[near, far]).astype(np.float64) / np.log(10)


class Members:
    """Words within a class: a word's share by counts times exp(near[symbol before] . own[word]), normalised over the class."""

    def __init__(self, words: int, seed: int = 11):
        self.near = np.random.default_rng(seed).standard_normal((SYMBOLS, MEMBER_SIZE)).astype(np.float32) * 0.5
        self.own = np.zeros((words, MEMBER_SIZE), np.float32)

    def learn(self, word: np.ndarray, near: np.ndarray, cls: np.ndarray, state: dict[str, np.ndarray], rng: np.random.Generator) -> None:
        """Noise-contrastive steps: a token's noise are the words of other tokens of its class, which are spread as the class's counts."""
        order = rng.permutation(len(word))
        for at in range(0, len(order), MEMBER_BATCH):
            some = order[at : at + MEMBER_BATCH]
            some = some[np.argsort(cls[some], kind="stable")]
            w, a, c = word[some], near[some], cls[some]
            # A class's first tokens lack others before them and wait for another step.
            full = np.flatnonzero(c[MEMBER_NOISE:] == c[:-MEMBER_NOISE]) + MEMBER_NOISE
            if not len(full):
                continue
            q, rows, weights, step = self.near[a[full]], [], [], 0
            for k in range(MEMBER_NOISE + 1):
                other = w[full - k]
                chance = 1 / (1 + np.exp(np.log(MEMBER_NOISE) - np.einsum("ij,ij->i", q, self.own[other])))
                up = ((k == 0) - chance).astype(np.float32)[:, None]
                step = step + up * self.own[other]
                rows.append(other)
                weights.append(up * q)
            at_words, g = summed(np.concatenate(rows), np.concatenate(weights))
            state["own"][at_words] += (g * g).mean(axis=1)
            self.own[at_words] += MEMBER_LEARN * g / np.sqrt(state["own"][at_words])[:, None]
            state["seen"] += np.bincount(w[full], minlength=len(self.own))
            at_near, g = summed(a[full], step)
            state["near"][at_near] += (g * g).mean(axis=1)
            self.near[at_near] += MEMBER_LEARN * g / np.sqrt(state["near"][at_near])[:, None]

    def start(self) -> dict[str, np.ndarray]:
        return {"own": np.ones(len(self.own), np.float32), "near": np.ones(SYMBOLS, np.float32), "seen": np.zeros(len(self.own), np.int64)}

    def normaliser(self, vocab: Vocabulary) -> np.ndarray:
        """log10 of the sum of a class's shares after each symbol: words without a vector, the unknown one among them, keep theirs."""
        out = np.empty((SYMBOLS, RARE))
        order = np.argsort(vocab.member_class, kind="stable")
        cut = np.searchsorted(vocab.member_class[order], np.arange(RARE + 1))
        for c in range(RARE):
            rows = order[cut[c] : cut[c + 1]]
            share = (vocab.member_counts[rows] + 1) / (vocab.by_class[:, c].sum() + 1)
            total = np.full(SYMBOLS, 1 - share.sum())
            for at in range(0, len(rows), BATCH):
                total += np.exp(self.near @ self.own[rows[at : at + BATCH]].T) @ share[at : at + BATCH]
            out[:, c] = np.log10(total)
        return out

    def log10(self, word: np.ndarray, near: np.ndarray, cls: np.ndarray, normal: np.ndarray) -> np.ndarray:
        """What the context adds to the logarithm of a word's share; ``word`` is -1 where it has no vector."""
        product = np.zeros(len(word))
        has = np.flatnonzero(word >= 0)
        product[has] = np.einsum("ij,ij->i", self.near[near[has]], self.own[word[has]])
        return product / np.log(10) - normal[near, cls]


def summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in order, and the sums of their values."""
    order = in_order(rows, int(rows.max(initial=0)))
    sorted_rows = rows[order]
    first = np.flatnonzero(np.diff(sorted_rows, prepend=-1))
    return sorted_rows[first], np.add.reduceat(values[order], first, axis=0)


def gather(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """into[rows] += values, equal rows added up first."""
    at, sums = summed(rows, values)
    into[at] += sums


def shards_for(size: int) -> int:
    """A shard for 16 MB of text."""
    return max(16, size >> 24)


def train(docs: DataFrame, vocab: Vocabulary, shards: int, rounds: int = ROUNDS) -> tuple[LogBilinear, Members]:
    """One pass over every training text, in ``rounds`` rounds of parallel learning and averaging.

    A shard learns from the texts that a hash deals to it, in the order of another, so that nothing depends on how rows lie in files.
    """
    spark = docs.sparkSession
    model, members = LogBilinear(vocab.unigram), Members(len(vocab.member_counts))
    keys = ("near", "far", "target", "bias")
    shared_vocab = spark.sparkContext.broadcast(vocab)
    place = F.xxhash64("text", F.col("doc_id").cast("string"))
    for k in range(rounds):
        part = docs.where(~held_out(F.col("doc_id"))).select(F.pmod(place, F.lit(rounds * shards)).cast("int").alias("shard"), place.alias("place"), "text")
        part = spread_over(part.where(F.pmod("shard", F.lit(rounds)) == k), shards << 24, "shard").sortWithinPartitions("shard", "place", "text")
        shared = spark.sparkContext.broadcast((model, members))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocab, (model, members) = shared_vocab.value, shared.value
            # The task's sum of words' vectors, each times the tokens that a shard saw.
            total, weight = np.zeros(members.own.shape), np.zeros(len(members.own), np.int64)
            for shard, texts in by_shard(batches):
                own, inner, rng, seen = LogBilinear(model.noise), Members(0), np.random.default_rng(shard), 0
                own.parts = {x: v.copy() for x, v in model.parts.items()}
                inner.near, inner.own = members.near.copy(), members.own.copy()
                state = {x: np.full_like(v, 1e-4 if x != "bias" else 1e-2) for x, v in own.parts.items()}
                inner_state = inner.start()
                for some in texts:
                    w = words(some, NOT_SPACE, lower=True)
                    symbol, _, _, member = vocab.look_up(w)
                    s, a, b, _ = sequences(w, symbol)
                    own.learn(s, a, b, state, rng)
                    seen += len(s)
                    rare = np.flatnonzero(member >= 0)
                    inner.learn(member[rare], a[rare + w.doc[rare]], symbol[rare] - 1 - FREQUENT, inner_state, rng)
                flat = np.concatenate([*(own.parts[x].ravel() for x in keys), inner.near.ravel()]).reshape(-1, 64)
                yield vectors(np.arange(len(flat)), np.full(len(flat), seen), flat)
                total += inner.own * inner_state["seen"][:, None]
                weight += inner_state["seen"]
            touched = np.flatnonzero(weight)
            for at in range(0, len(touched), 1 << 16):
                some = touched[at : at + (1 << 16)]
                yield vectors(-1 - some, weight[some], total[some] / weight[some][:, None])

        def average(values):
            # Rounded, as sums of doubles depend on their order in the last digits.
            return [F.round(F.sum(F.col("v")[i] * F.col("seen")) / F.sum("seen"), 6).alias(f"v{i}") for i in values]

        learned = keep(part.mapInArrow(tidy(run), "at int, seen long, v array<float>"), "lm-learned")

        def averaged(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
            got = rows.groupBy("at").agg(*average(range(width))).toArrow().sort_by("at")
            return got["at"].to_numpy(), np.stack([got[f"v{i}"].to_numpy() for i in range(width)], axis=1).astype(np.float32)

        _, flat = averaged(learned.where("at >= 0"), 64)
        if len(flat):
            flat, at = flat.ravel(), 0
            for x in keys:
                v = model.parts[x]
                model.parts[x] = flat[at : at + v.size].reshape(v.shape)
                at += v.size
            members.near = flat[at:].reshape(members.near.shape)
            at_words, own = averaged(learned.where("at < 0"), MEMBER_SIZE)
            members.own[-1 - at_words] = own
        release(learned)
    return model, members


def vectors(at: np.ndarray, seen: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * v.shape[1], pa.int32()), pa.array(v.ravel().astype(np.float32)))
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen, pa.int64()), lists], ["at", "seen", "v"])


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.Array]]]:
    """(shard, its texts, about BIG_SLICE at a time, cut alike however the batches fall); rows come in the order of shards."""
    rows = ((int(batch.column("shard")[a].as_py()), batch.column("text").slice(a, b - a)) for batch in batches for a, b in _stretches(batch.column("shard").to_numpy()))
    held: list = [next(rows, None)]

    def texts(shard: int) -> Iterator[pa.Array]:
        rest = None
        while held[0] is not None and held[0][0] == shard:
            new = held[0][1].cast(pa.large_string()).fill_null("")
            rest = pa.concat_arrays([rest, new]) if rest is not None else new
            held[0] = next(rows, None)
            *whole, (_, rest) = slices(rest, BIG_SLICE)
            yield from (x for _, x in whole)
        yield rest

    while held[0] is not None:
        yield held[0][0], texts(held[0][0])


def _stretches(v: np.ndarray) -> list[tuple[int, int]]:
    cut = np.flatnonzero(np.append(True, v[1:] != v[:-1]))[: len(v)].tolist()
    return list(zip(cut, [*cut[1:], len(v)]))


LOCAL = "doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_part double, score_part double, tail array<struct<hash:long,cls:int,n:int>>"


def score(docs: DataFrame, vocab: Vocabulary, model: LogBilinear, members: Members, counts: DataFrame, least: int) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast((vocab, model, model.normaliser(), members, members.normaliser(vocab)))
    tail_type = pa.list_(pa.struct([("hash", pa.int64()), ("cls", pa.int32()), ("n", pa.int32())]))
    places = (vocab.by_class.sum(axis=0) + 1).astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, model, normal, members, member_normal = shared.value
        for batch in batches:
            for first, texts in slices(batch.column("text"), BIG_SLICE):
                w = words(texts, NOT_SPACE, lower=True)
                symbol, count, known, member = vocab.look_up(w)
                s, a, b, begin = sequences(w, symbol)
                neural = np.add.reduceat(model.log10(s, a, b, normal), begin[:-1])
                logs = np.where(known, np.log10(count + 1.0), 0.0)
                rare = symbol > FREQUENT
                cls = np.where(rare, symbol - 1 - FREQUENT, 0)
                context = members.log10(member, a[np.arange(len(symbol)) + w.doc], cls, member_normal)
                within = np.where(rare, logs - np.log10(places[cls]) + context, 0.0)
                by_text = lambda v: np.diff(np.concatenate(([0.0], np.cumsum(v)))[w.ptr])
                tail = np.flatnonzero(~known)
                order = tail[np.lexsort((w.hash[tail], w.doc[tail]))]
                doc = w.doc[order]
                new = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(w.hash[order].view(np.int64), prepend=0) != 0)) if len(order) else order
                tf = np.diff(np.append(new, len(order)))
                bounds = np.searchsorted(doc[new], np.arange(len(texts) + 1))
                struct = pa.StructArray.from_arrays([pa.array(w.hash[order[new]].view(np.int64)), pa.array(symbol[order[new]] - 1 - FREQUENT, pa.int32()), pa.array(tf, pa.int32())], ["hash", "cls", "n"])
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), struct)
                rows = batch.slice(first, len(texts))
                end = np.log10(vocab.end_count + 1.0)
                arrays = [rows.column("doc_id"), rows.column("held_out"), np.diff(begin), by_text(known).astype(np.int64) + (vocab.end_count > 0), by_text(logs) + end, by_text(within) + neural, lists.cast(tail_type)]
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in arrays], ["doc_id", "held_out", "n_tokens", "n_known", "base_part", "score_part", "tail"])

    local = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, LOCAL.format(kind=kind))
    local = keep(local.withColumn("row", F.monotonically_increasing_id()), "lm-local")
    missing = local.select("row", F.inline("tail"))
    found = missing.join(counts.where(F.col("n") < least).select("hash", F.col("n").alias("c")), "hash", "left")
    more = found.groupBy("row").agg(F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("more_known"), F.sum(F.col("n") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + 1.0)).alias("more"))
    joined = local.drop("tail").join(more, "row", "left")
    extra = F.coalesce(F.col("more"), F.lit(0.0))
    floor = float(np.log10(vocab.total + vocab.types + 1))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce(F.col("more_known"), F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"), (F.col("base_part") + extra - F.col("n_tokens") * floor).alias("base_score"), (F.col("score_part") + extra).alias("score"),
    )


def score_corpus(docs: DataFrame) -> DataFrame:
    """Count, learn and score."""
    bounded_batches(docs.sparkSession)
    size = text_bytes(docs)
    counts = keep(word_counts(docs, buckets_for(size)), "lm-counts")
    vocab, least = vocabulary(counts)
    model, members = train(docs, vocab, shards_for(size))
    return score(docs, vocab, model, members, counts, least)


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every text of ``documents``: see the module."""
    return score_corpus(table(spark, sf_dir, "documents").select("doc_id", "text"))


