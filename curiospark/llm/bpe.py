"""Exact byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word, the encoding's last token is unique: it is the one token t that ends there
such that the last token of the prefix before t and t are *compatible*, which means that merging the two
tokens' symbols from scratch gives back just those two. So one pass finds, at each end position, the
tokens that are suffixes of the prefix (an automaton over the vocabulary whose failure links run through
all suffixes), tests the pairs, stores the last token, and back-pointers give the ids. Time is linear in a
word's length, so that a run of letters of any length costs no more a letter than a short word.

Texts are prepared as the tokenizer file asks: added tokens are cut out of the raw text, the rest is
composed (NFC) and lower-cased letter by letter (by the library where a text has other than Latin letters), and split into contractions, runs of letters, single
digits and runs of other signs; each word's last symbol carries the word end.

Defined cases: null and empty texts have no tokens; rows with equal ids are encoded each on its own; other
columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .letters import LATIN, WHITE, byte_letters, class_of
from .scan import slices
from .shared import bounded_batches, table
from .token_files import load, tokenizer_path

END = "</w>"
HELD_WORDS, HELD_PAIRS = 400_000, 1_000_000


@functools.lru_cache(maxsize=1)
def word_pattern() -> re.Pattern:
    letters, numbers = class_of("L"), class_of("N")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{WHITE}{letters}{numbers}]+")


ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")


class PrefixBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.end = spec["model"]["end_of_word_suffix"] or ""
        self.names = {i: t for t, i in vocab.items()}
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.letters = byte_letters()
        self.byte = {x: b for b, x in self.letters.items()}
        self.library = load(path)
        self.map = str.maketrans({chr(b): x for b, x in self.letters.items()})
        merges = [x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"]]
        #: Rank and result of each mergeable pair of ids.
        self.merge = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        last = {x: chr(0xE000 + ord(x)) for x in self.letters.values()}
        self.last = last
        self.symbol: dict[str, int] = {}
        for x in self.letters.values():
            self.symbol[x] = vocab[x]
            if self.end:
                self.symbol[last[x]] = vocab[x + self.end]
        #: Every token as a string of symbols: base tokens first, then what each merge gives.
        self.text = {i: s for s, i in self.symbol.items()}
        for (a, b), (_, c) in self.merge.items():
            self.text[c] = self.text[a] + self.text[b]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_STRING)
        for i, s in self.text.items():
            if self.apart(s) == [i]:  # a token that merging never reaches is never a last token
                self.automaton.add_word(s, (len(s), i))
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.forget()

    def apart(self, symbols: str) -> list[int]:
        """Merge by rank, leftmost first: the definition, for the few symbols of two tokens."""
        ids = [self.symbol[s] for s in symbols]
        while len(ids) > 1:
            found = min(((self.merge[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.merge), default=None)
            if not found:
                break
            k = found[1]
            ids[k : k + 2] = [self.merge[ids[k], ids[k + 1]][1]]
        return ids

    def fit(self, a: int, b: int) -> bool:
        key = a << 32 | b
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= HELD_PAIRS:
                self.fits.clear()
            found = self.fits[key] = self.apart(self.text[a] + self.text[b]) == [a, b]
        return found

    def word(self, symbols: str) -> list[int]:
        """The ids of a word, given as symbols."""
        n = len(symbols)
        last, size = [0] * (n + 1), [0] * (n + 1)
        known, at, done = self.fits.get, -1, True
        for end, (length, token) in self.automaton.iter(symbols):
            if end == at and done:
                continue
            at = end
            begin = end + 1 - length
            if begin == 0:
                done = True
            elif size[begin]:
                before = last[begin]
                done = known(before << 32 | token)
                if done is None:
                    done = self.fit(before, token)
            else:
                done = False
            if done:
                last[end + 1], size[end + 1] = token, length
        ids = []
        while n:
            ids.append(last[n])
            n -= size[n]
        return ids[::-1]

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids: list[list[int]] = []
        self.shown: list[str] = []

    def words(self, text: str) -> list[str]:
        """Prepared words; an added token stands for itself."""
        pieces = self.cut.split(text) if self.cut and "<|" in text else [text]
        out: list[str] = []
        for piece in pieces:
            if piece in self.added:
                out.append(piece)
            elif piece.isascii():
                out += ASCII_WORD.findall(piece.lower())
            elif LATIN.fullmatch(lower := unicodedata.normalize("NFC", piece).lower()):
                out += word_pattern().findall(lower)
            else:  # letters and cases that depend on the edition of Unicode: prepared by the library itself
                prepared = self.library.normalizer.normalize_str(piece)
                shown = self.library.pre_tokenizer.pre_tokenize_str(prepared)
                out += [bytes(map(self.byte.__getitem__, x)).decode() for x, _ in shown]
        return out

    def learn(self, new: list[str]) -> None:
        for word in new:
            if word in self.added:
                ids = [self.added[word]]
            else:
                symbols = word.encode().decode("latin-1").translate(self.map)
                ids = self.word(symbols[:-1] + self.last[symbols[-1]] if self.end else symbols)
            self.place[word] = len(self.ids)
            self.ids.append(ids)
            self.shown.append(self.decode(ids))

    def decode(self, ids: list[int]) -> str:
        """As the tokenizer file has no decoder: the tokens' names, joined by one space."""
        return " ".join(map(self.names.__getitem__, ids))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """All ids end to end, where each text's begin (one more than texts), and the decoded texts."""
        own = [self.words(t) for t in texts]
        if len(self.place) > HELD_WORDS:
            self.forget()
        self.learn([w for w in dict.fromkeys(itertools.chain.from_iterable(own)) if w not in self.place])
        places = [list(map(self.place.__getitem__, x)) for x in own]
        shown = [" ".join(map(self.shown.__getitem__, x)) for x in places]
        listed = [list(itertools.chain.from_iterable(map(self.ids.__getitem__, x))) for x in places]
        bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, listed), np.int64, len(listed)))))
        return np.fromiter(itertools.chain.from_iterable(listed), np.int32, int(bounds[-1])), bounds, shown


@functools.lru_cache(maxsize=2)
def prefix_bpe(path: str) -> PrefixBpe:
    return PrefixBpe(path)


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids array<int>, decoded string (the text that decoding those ids gives)."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = prefix_bpe(tokenizer)
        for batch in batches:
            for first, texts in slices(batch.column("text")):
                ids, bounds, shown = own.encode(texts.to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(texts)), lists, pa.array(shown, pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text of ``documents``: see the module."""
    return digests(encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the decimal ids, joined by spaces, and of the decoded text."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
