"""Encoding of a corpus with a byte-level BPE vocabulary.

Method: corpus-level merge replay. The texts are cut into words by the tokenizer's own pattern, and
merges never cross a word, so the distinct words of the corpus carry all the work. Over them lies an
inverted index from token pair to the word positions where the pair stands; the merges are
replayed in rank order, each applied to all of its positions at once, and only the neighbours of a
merged pair are touched and indexed anew. A word a million documents share is merged once.

A task replays the corpus part that it reads: blocks of documents stream through it, each block's
words that the task hasn't met are indexed and replayed together, and the documents are put together
from their words. So no token is ever shuffled. Merges of one word depend on nothing outside it, so the
ids are those that one replay over the whole corpus would give. The vocabulary (fixed size, read
once on the driver) is broadcast.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

# Fixed value: the word pattern of the public byte-level BPE vocabularies.
WORD = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

BLOCK_CHARS = 4_000_000
MEMO_WORDS = 200_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in such a vocabulary: itself if printable, else the next from U+0100 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Byte ids and merges of a vocabulary file (``tokenizers`` JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids = model["vocab"]
        self.byte_ids = [ids[c] for c in byte_letters()]
        #: (left id, right id) as one number -> (rank, id of the merged token)
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merges.setdefault(ids[a] << 32 | ids[b], (rank, ids[a + b]))


class Replay:
    """Merge replay over many words at once.

    All words lie one after another in flat arrays: ``token`` and the positions of the neighbours,
    -1 at the ends of a word. ``where`` is the inverted index, from pair to positions of its left half;
    a heap holds the ranks of the pairs that occur. Taking ranks in rising order is enough: a merge can
    only bring forth pairs of its own new token, whose ranks come later.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.byte_ids = vocabulary.byte_ids
        self.merges = vocabulary.merges

    def __call__(self, words: list[str]) -> list[list[int]]:
        byte_ids, merges = self.byte_ids, self.merges
        token: list[int] = []
        starts: list[int] = []
        for w in words:
            starts.append(len(token))
            token.extend([byte_ids[b] for b in w.encode("utf-8", "surrogatepass")])
        starts.append(len(token))
        n = len(token)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        for s in starts:
            if s < n:
                before[s] = -1
            if s:
                after[s - 1] = -1
        where: dict[int, list[int]] = {}
        for i in range(n - 1):
            if after[i] != -1:
                pair = token[i] << 32 | token[i + 1]
                if pair in where:
                    where[pair].append(i)
                elif pair in merges:
                    where[pair] = [i]
        heap = [(merges[p][0], p) for p in where]
        heapq.heapify(heap)
        while heap:
            _, pair = heapq.heappop(heap)
            places = where.pop(pair, None)
            if places is None:
                continue
            left, right = pair >> 32, pair & 0xFFFFFFFF
            merged = merges[pair][1]
            if left == right:
                places.sort()  # in a run of equal tokens the leftmost pair is merged first
            for i in places:
                if token[i] != left:
                    continue  # merged away
                j = after[i]
                if j == -1 or token[j] != right:
                    continue
                k = after[j]
                token[i], token[j] = merged, -1
                after[i] = k
                h = before[i]
                if k != -1:
                    before[k] = i
                    p = merged << 32 | token[k]
                    if p in where:
                        where[p].append(i)
                    elif p in merges:
                        where[p] = [i]
                        heapq.heappush(heap, (merges[p][0], p))
                if h != -1:
                    p = token[h] << 32 | merged
                    if p in where:
                        where[p].append(h)
                    elif p in merges:
                        where[p] = [h]
                        heapq.heappush(heap, (merges[p][0], p))
        return [[t for t in token[a:b] if t != -1] for a, b in zip(starts, starts[1:])]


class Encoder:
    """Encodes blocks of texts; keeps the ids of words that it has met, up to ``memo_words`` of them."""

    def __init__(self, vocabulary: Vocabulary, memo_words: int = MEMO_WORDS):
        self.replay = Replay(vocabulary)
        self.memo: dict[str, list[int]] = {}
        self.memo_words = memo_words
        self.find = regex.compile(WORD).findall

    def __call__(self, texts: list[str | None]) -> list[list[str]]:
        """The words of each text, all of them in the memo; a null text has none."""
        words = [self.find(t) if t else [] for t in texts]
        if len(self.memo) > self.memo_words:
            self.memo.clear()  # only speed depends on it
        new = {*chain.from_iterable(words)}.difference(self.memo)
        if new:
            fresh = [*new]
            self.memo.update(zip(fresh, self.replay(fresh)))
        return words


def _blocks(batches: Iterator[pa.RecordBatch], text_col: str, chars: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of at most about ``chars`` characters, at least one row each."""
    for b in batches:
        column = b.column(b.schema.names.index(text_col))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        begin = total = 0
        for i, s in enumerate(sizes):
            if i > begin and total + s > chars:
                yield b.slice(begin, i - begin)
                begin, total = i, 0
            total += s
        if begin < len(sizes):
            yield b.slice(begin)


def _mapped(df: DataFrame, id_cols: list[str], text_col: str, vocabulary_path: str, out: str, kind: str, column: Callable[[Encoder, list], pa.Array], block_chars: int) -> DataFrame:
    spark = df.sparkSession
    ship(spark)
    vocabulary = spark.sparkContext.broadcast(Vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for b in _blocks(batches, "__text", block_chars):
            at = b.schema.names.index("__text")
            ids = column(encoder, encoder(b.column(at).to_pylist()))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns) if i != at), ids], names=[*(n for n in b.schema.names if n != "__text"), out])

    rows = df.select(*[F.col(c) for c in id_cols], F.col(text_col).cast("string").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    return rows.mapInArrow(run, f"{fields}, `{out}` {kind}")


def _ids(encoder: Encoder, words: list[list[str]]) -> pa.Array:
    memo = encoder.memo
    flat = [[*chain.from_iterable([memo[w] for w in ws])] for ws in words]
    offsets = np.zeros(len(flat) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in flat], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, np.fromiter(chain.from_iterable(flat), dtype=np.int32, count=int(offsets[-1])))


def _counts(encoder: Encoder, words: list[list[str]]) -> pa.Array:
    memo = encoder.memo
    return pa.array([sum([len(memo[w]) for w in ws]) for ws in words], pa.int64())


def encode(df: DataFrame, id_cols: list[str], text_col: str, vocabulary_path: str, out: str = "ids", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``id_cols`` and the token ids of each text, one row per row of ``df``.

    No special token is added, and a text that looks like one is encoded as any other; white space is
    kept. An empty text and a null text have the empty list, never null. Texts are encoded whole,
    whatever their length; equal rows give equal rows. Other columns of ``df`` are ignored.
    """
    return _mapped(df, id_cols, text_col, vocabulary_path, out, "array<int>", _ids, block_chars)


def count_tokens(df: DataFrame, id_cols: list[str], text_col: str, vocabulary_path: str, out: str = "n_tokens", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Like ``encode``, with only the number of tokens; 0 for empty and null texts."""
    return _mapped(df, id_cols, text_col, vocabulary_path, out, "bigint", _counts, block_chars)


def default_vocabulary(spark: SparkSession, name: str = "byte_bpe_50k.json") -> str:
    """Path of a vocabulary: under ``spark.tallyloom.tokenizers`` if the session sets it, else the installed files."""
    folder = spark.conf.get("spark.tallyloom.tokenizers", "/opt/tokenizers")
    return f"{folder}/{name}"
