"""Lexical retrieval packing of documents into fixed windows.

Documents are tokenised and sorted by a sketch (the minimum of their hashed
token trigrams), so that similar ones are neighbours. Runs of that order,
bounded in tokens and documents, are the shards. Each shard has a BM25
inverted index over token ids: a seed document opens a window, the index
returns the unused documents by their score over all its terms, and these fill
the window greedily, those that fit first; when no scored one is left, the next
document in order is the seed. What room is left takes the beginning of
the best one that does not fit, and its rest opens the next window. So only
the last window of a shard has padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.llm.common import staged
from pluvio.llm.tokens import default_paths, encoder

WINDOW = 1024
END = 0  # the id after each document
SHARD_TOKENS, SHARD_DOCS = 1 << 20, 2048
K1, B = 1.2, 0.75
#: A term is common if more than one document in so many has it.
COMMON = 4
#: Documents that a query returns: as many as a shard has.
NEIGHBOURS = SHARD_DOCS


class Bm25:
    """An inverted index over the token ids of one shard's documents."""

    def __init__(self, docs: list[np.ndarray]) -> None:
        self.n = len(docs)
        lengths = np.array([len(d) for d in docs])
        ids = np.concatenate(docs).astype(np.int64)
        size = int(ids.max(initial=0)) + 1
        key, tf = np.unique(np.repeat(np.arange(self.n), lengths) * size + ids, return_counts=True)
        self._doc, self._term = np.divmod(key, size)
        df = np.bincount(self._term, minlength=size)
        idf = np.log1p((self.n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths / max(lengths.mean(), 1))
        weight = (idf[self._term] * tf * (K1 + 1) / (tf + norm[self._doc])).astype(np.float32).astype(float)
        self._first = np.searchsorted(self._doc, np.arange(self.n + 1))
        common = df * COMMON > self.n
        shared = (df[self._term] > 1) & ~common[self._term]  # the others are in no other document
        by_term = np.argsort(self._term[shared], kind="stable")
        self._size, self._left = size, self.n
        self._index(*(x[shared][by_term] for x in (self._term, self._doc, weight)))
        # terms of many documents have a row of weights, which is added up without a posting list
        self._row = np.where(common & (df > 1), np.cumsum(common & (df > 1)) - 1, -1)
        self._rows = np.zeros((int(self._row.max(initial=-1)) + 1, self.n))
        dense = self._row[self._term] >= 0
        self._rows[self._row[self._term[dense]], self._doc[dense]] = weight[dense]

    def _index(self, term: np.ndarray, doc: np.ndarray, weight: np.ndarray) -> None:
        """Postings of the terms, in order of term and document."""
        self._posting_term, self._posting_doc, self._posting_weight = term, doc, weight
        self._posting = np.r_[0, np.cumsum(np.bincount(term, minlength=self._size))]

    def _forget(self, used: np.ndarray) -> None:
        """Without the postings of used documents, whenever half of those that had some are used."""
        left = self.n - int(used.sum())
        if 2 * left < self._left:
            self._left = left
            keep = ~used[self._posting_doc]
            self._index(self._posting_term[keep], self._posting_doc[keep], self._posting_weight[keep])

    def nearest(self, seed: int, used: np.ndarray) -> np.ndarray:
        """Unused documents by score over all terms of the seed, ties by place."""
        self._forget(used)
        terms = self._term[self._first[seed]:self._first[seed + 1]]
        start, size = self._posting[terms], self._posting[terms + 1] - self._posting[terms]
        at = np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)
        rows = self._row[terms]
        score = self._rows[rows[rows >= 0]].sum(axis=0)
        score += np.bincount(self._posting_doc[at], self._posting_weight[at], self.n)
        score[used] = 0
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")][:NEIGHBOURS]


def pack_shard(docs: list[np.ndarray], window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece; documents
    end with the end id. Every id lies in exactly one piece."""
    index = Bm25([d[:-1] for d in docs])
    lengths = np.array([len(d) for d in docs])
    used, fresh = np.zeros(len(docs), bool), 0
    sequence, room, seed, opened = 0, window, None, None  # opened: a document with a rest to place

    while True:
        if opened is None:
            best = None
            if seed is not None and room < window:
                chosen = index.nearest(seed, used)
                size, at = lengths[chosen], 0
                while room and at < len(chosen):
                    fits = size[at:] <= room
                    step = int(fits.argmax())
                    if best is None and (step or not fits[0]):
                        best = int(chosen[at])  # the first that does not fit
                    if not fits[step]:
                        break
                    n, length, at = int(chosen[at + step]), int(size[at + step]), at + step + 1
                    yield n, 0, length, sequence, window - room
                    used[n], room = True, room - length
                near = len(chosen) > 0
            else:
                near = False
            if room and (best is not None or not near):
                if best is None:  # nothing is near: go on with the next document in order
                    while fresh < len(docs) and used[fresh]:
                        fresh += 1
                    if fresh == len(docs):
                        return
                    best = seed = fresh
                opened = (best, 0)
                used[best] = True
        if opened is not None:
            n, start = opened
            length = min(room, int(lengths[n]) - start)
            yield n, start, length, sequence, window - room
            if room == window:  # a window keeps the seed that opens it
                seed = n
            room -= length
            opened = (n, start + length) if start + length < lengths[n] else None
        if not room:
            sequence, room = sequence + 1, window


def _sketch(ids: np.ndarray) -> int:
    """The least hash of the token trigrams (of the whole, if shorter)."""
    x = ids.astype(np.uint64)
    hashed = np.zeros(max(1, len(x) - 2), np.uint64)
    for i in range(min(3, len(x))):
        hashed = (hashed ^ x[i:i + len(hashed)]) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
    return int((hashed * np.uint64(0xBF58476D1CE4E5B9)).min().astype(np.uint64).view(np.int64))


def tokenised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              paths: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, sketch, tie, tokens): little-endian ids of the whole text and
    the end id, two bytes each where the vocabulary allows; null is empty."""
    paths = paths or default_paths()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(*paths)
        end = np.array([END], own.dtype).tobytes()
        for b in batches:
            made = [own.encode(t.as_py()) + end for t in b["text"]]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array([_sketch(np.frombuffer(m, own.dtype)) for m in made], pa.int64()),
                 pa.array([xxhash.xxh64_intdigest(m) - (1 << 63) for m in made], pa.int64()),
                 pa.array(made, pa.binary())], ["doc_id", "sketch", "tie", "tokens"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, sketch long, tie long, tokens binary")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         paths: tuple[str, str] | None = None) -> DataFrame:
    """One row per piece: doc_id, start (ids of the document before it),
    length, ids (little-endian 32-bit), doc_tokens (the end id included),
    sequence_id, offset (in the sequence, gapless from 0).

    Every row of ``docs`` is a document of its own, also one that repeats an
    id or a text, or has no id. Null and empty texts are the end id alone.
    An empty table gives no pieces; columns beside the two are not read.
    """
    paths = paths or default_paths()
    # written first: the range shuffle reads its input twice, once for a sample
    rows = staged(tokenised(docs, id_col, text_col, paths), "tokens")
    fields = [rows.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in ("start", "length")),
              T.StructField("ids", T.BinaryType()),
              *(T.StructField(n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset"))]
    names = [f.name for f in fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(*paths).dtype
        sequences = TaskContext.get().partitionId() << 33

        def packed(keys: list, docs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            nonlocal sequences
            pieces = list(pack_shard(docs, window))
            for at in range(0, len(pieces), 1000):
                n, start, length, sequence, offset = map(np.array, zip(*pieces[at:at + 1000]))
                ids = [docs[i][s:s + c].astype("<u4").tobytes() for i, s, c in zip(n, start, length)]
                columns = [pa.array([keys[i].as_py() for i in n], kind), start, length, pa.array(ids, pa.binary()),
                           np.array([len(docs[i]) for i in n]), sequences + sequence, offset]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names)
            sequences += pieces[-1][3] + 1

        keys, held, size, kind = [], [], 0, None
        for b in batches:
            kind = b["doc_id"].type
            for key, tokens in zip(b["doc_id"], b["tokens"]):
                keys.append(key)
                held.append(np.frombuffer(tokens.as_py(), dtype))
                size += len(held[-1])
                if size >= SHARD_TOKENS or len(held) >= SHARD_DOCS:
                    yield from packed(keys, held)
                    keys, held, size = [], [], 0
        if held:
            yield from packed(keys, held)

    # the row's number parts equal rows, which may be most of the table
    rows, order = rows.withColumn("row", F.monotonically_increasing_id()), ["sketch", "tie", "doc_id", "row"]
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "tokens")
            .mapInArrow(work, T.StructType(fields)))
