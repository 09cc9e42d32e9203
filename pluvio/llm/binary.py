"""Token-ID output: best-fit-decreasing packing into binary id matrices.

Documents are tokenised, an end id after each, and split losslessly into
pieces of at most one window. Pieces are dealt to shards by a hash. Each
shard places its pieces, longest first, into the open sequence with the
least room that still holds them; a segment tree over the capacities finds
it. A shard is written as one set of files:

* ``.ids.bin``: the id matrix, sequences x window, little-endian, two bytes
  an id where the vocabulary allows, padded with the pad id;
* ``.cu.bin``: cumulative segment lengths over the flattened matrix, 64-bit,
  from 0, padding counted as a segment of its own at the end of a sequence;
* ``.pos.bin.zst``: the position of each id in its segment (a matrix like
  the ids, so it resets to 0 with each segment), zstandard-compressed;
* ``.segments.parquet``: which piece of which document each segment is.

One row per set of files comes back to Spark; sets that a failed or repeated
task left behind are in no row and are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.llm.common import staged
from pluvio.llm.tokens import default_paths, encoder
from pluvio.llm.warc import open_store
from pluvio.session import work_path

WINDOW = 1024
END = PAD = 0
#: Tokens of a shard, about (a piece more at most), and so of a file.
SHARD_TOKENS = 1 << 22
#: Pieces of a shard at most, however short they are.
SHARD_PIECES = 1 << 16


class CapacityTree:
    """Open sequences by the room left in them; finds the least room of at
    least a given size in logarithmic time."""

    def __init__(self, window: int) -> None:
        self._leaves = 1 << window.bit_length()
        self._open = [0] * (2 * self._leaves)  # open sequences below each node
        self._at: list[list[int]] = [[] for _ in range(window + 1)]

    def _count(self, room: int, by: int) -> None:
        node = room + self._leaves
        while node:
            self._open[node] += by
            node >>= 1

    def add(self, room: int, sequence: int) -> None:
        self._at[room].append(sequence)
        self._count(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, sequence) of the tightest fit, removed; None if nothing fits."""
        node, open_ = size + self._leaves, self._open
        while not open_[node]:
            while node & 1:  # a right child: the next larger rooms lie further up
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self._leaves:
            node *= 2
            if not open_[node]:
                node += 1
        room = node - self._leaves
        self._count(room, -1)
        return room, self._at[room].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of each piece and the number of sequences."""
    tree, sequences = CapacityTree(window), 0
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        found = tree.take(size) if size < window else None
        if found is None:
            found, sequences = (window, sequences), sequences + 1
        room, sequence[i] = found
        offset[i] = window - room
        if room > size:
            tree.add(room - size, int(sequence[i]))
    return sequence, offset, sequences


def shard_arrays(pieces: list[np.ndarray], window: int) -> tuple[np.ndarray, ...]:
    """Order, sequence and offset of the pieces; the id matrix, the
    cumulative segment lengths and the position matrix."""
    lengths = np.array([len(p) for p in pieces])
    sequence, offset, n = best_fit_decreasing(lengths, window)
    order = np.lexsort((offset, sequence))
    ids = np.full(n * window, PAD, pieces[0].dtype)
    positions = np.zeros(n * window, np.uint16 if window <= 1 << 16 else np.uint32)
    ramp = np.arange(window, dtype=positions.dtype)
    starts = sequence * window + offset
    for i in order.tolist():
        at, size = int(starts[i]), int(lengths[i])
        ids[at:at + size] = pieces[i]
        positions[at:at + size] = ramp[:size]
    ends = (starts + lengths)[order]
    filled = np.bincount(sequence, weights=lengths, minlength=n).astype(np.int64)
    short = np.flatnonzero(filled < window)
    for s in short.tolist():  # padding counts its own positions
        at = s * window + int(filled[s])
        positions[at:(s + 1) * window] = ramp[:window - int(filled[s])]
    cumulative = np.sort(np.concatenate([[0], ends, (short + 1) * window]))
    return order, sequence, offset, ids, cumulative, positions


def _pieces(docs: DataFrame, id_col: str, text_col: str, window: int, paths: tuple[str, str]) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(*paths)
        end = np.array([END], own.dtype).tobytes()
        width = own.dtype.itemsize
        for b in batches:
            ids, starts, totals, parts = [], [], [], []
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"]):
                made = own.encode(text.as_py()) + end
                for at in range(0, len(made), window * width):
                    ids.append(doc_id)
                    starts.append(at // width)
                    totals.append(len(made) // width)
                    parts.append(made[at:at + window * width])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(totals, pa.int64()),
                 pa.array(parts, pa.binary())], ["doc_id", "start", "doc_tokens", "tokens"])

    return rows.mapInArrow(work, "doc_id long, start long, doc_tokens long, tokens binary")


INDEX = T.StructType([T.StructField("path", T.StringType()), *(T.StructField(n, T.LongType()) for n in (
    "first_sequence", "sequences", "window", "id_bytes", "segments", "tokens"))])


def write(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
          window: int = WINDOW, paths: tuple[str, str] | None = None) -> DataFrame:
    """Write the packed matrices; returns one row per set of files: path
    (without endings), first_sequence, sequences, window, id_bytes, segments,
    tokens.

    Every row of ``docs`` is a document of its own, also one that repeats an
    id or a text, or has no id. Null and empty texts are the end id alone.
    Columns beside the two are not read; an empty table writes nothing.
    """
    paths = paths or default_paths()
    folder = folder or work_path(docs.sparkSession, "llm", "packed", unique=True)
    pieces = _pieces(docs, id_col, text_col, window, paths)
    # the row's number parts equal rows, which may be most of the table
    deal = [F.xxhash64("doc_id", "start", "tokens", F.monotonically_increasing_id()).alias("deal"), "doc_id", "start",
            "doc_tokens", "tokens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        task, dtype = TaskContext.get(), encoder(*paths).dtype
        first, files = task.partitionId() << 33, 0

        def written(rows: list[tuple], tokens: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal first, files
            order, sequence, offset, ids, cumulative, positions = shard_arrays(tokens, window)
            name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{files:05d}"
            store.create_dir(base, recursive=True)
            for ending, content in ((".ids.bin", ids.astype(ids.dtype.newbyteorder("<")).tobytes()),
                                    (".cu.bin", cumulative.astype("<i8").tobytes()),
                                    (".pos.bin.zst", zstandard.compress(positions.astype(
                                        positions.dtype.newbyteorder("<")).tobytes(), 1))):
                with store.open_output_stream(f"{base}/{name}{ending}", compression=None) as out:
                    out.write(content)
            doc_id, start, total = ([rows[i][c] for i in order] for c in range(3))
            pq.write_table(pa.table({
                "doc_id": pa.array(doc_id, pa.int64()), "start": pa.array(start, pa.int64()),
                "length": pa.array([len(tokens[i]) for i in order], pa.int64()),
                "doc_tokens": pa.array(total, pa.int64()), "sequence": pa.array(sequence[order]),
                "offset": pa.array(offset[order])}), f"{base}/{name}.segments.parquet", filesystem=store)
            n = len(ids) // window
            row = {"path": f"{folder}/{name}", "first_sequence": first, "sequences": n, "window": window,
                   "id_bytes": dtype.itemsize, "segments": len(rows), "tokens": sum(map(len, tokens))}
            first, files = first + n, files + 1
            return pa.RecordBatch.from_pylist([row], schema)

        rows, tokens, size = [], [], 0
        for b in batches:
            for *row, content in zip(*(b[c].to_pylist() for c in ("doc_id", "start", "doc_tokens", "tokens"))):
                rows.append(tuple(row))
                tokens.append(np.frombuffer(content, dtype))
                size += len(tokens[-1])
                if size >= SHARD_TOKENS or len(rows) >= SHARD_PIECES:
                    yield written(rows, tokens)
                    rows, tokens, size = [], [], 0
        if rows:
            yield written(rows, tokens)

    schema = pa.schema([("path", pa.string()), *((f.name, pa.int64()) for f in INDEX.fields[1:])])
    # in the order of the hash: a shard is a random mix of lengths, the same in every attempt
    order = ["deal", "doc_id", "start", "tokens"]
    dealt = pieces.select(*deal).repartition("deal").sortWithinPartitions(*order)
    return staged(dealt.mapInArrow(work, INDEX), "packed-index")


def read(index: DataFrame) -> DataFrame:
    """The pieces, read back from the files of ``index``: doc_id, start,
    length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    Ids are cut out of the matrix by the cumulative segment lengths; a file
    whose positions do not reset with its segments is an error.
    """
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = {"ids": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.int64())) for n in names])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            store, base = open_store(row["path"])

            def content(ending: str) -> bytes:
                with store.open_input_file(base + ending) as file:
                    return file.read()

            window = row["window"]
            ids = np.frombuffer(content(".ids.bin"), f"<u{row['id_bytes']}")
            cumulative = np.frombuffer(content(".cu.bin"), "<i8")
            positions = np.frombuffer(zstandard.decompress(content(".pos.bin.zst")),
                                      "<u2" if window <= 1 << 16 else "<u4")
            segments = pq.read_table(base + ".segments.parquet", filesystem=store).to_pydict()
            starts = cumulative[:-1]
            reset = np.arange(len(ids)) - np.repeat(starts, np.diff(cumulative))
            if cumulative[-1] != len(ids) or len(ids) != row["sequences"] * window or (positions != reset).any():
                raise ValueError(f"damaged files at {row['path']}")
            at = np.array(segments["sequence"]) * window + np.array(segments["offset"])
            end = cumulative[np.searchsorted(cumulative, at, side="right")]
            if not np.isin(at, starts).all() or (end - at != segments["length"]).any():
                raise ValueError(f"segments at {row['path']} are not those of the matrix")
            for part in range(0, len(at), 1000):
                own = slice(part, part + 1000)
                yield pa.RecordBatch.from_arrays([
                    pa.array(segments["doc_id"][own], pa.int64()), pa.array(segments["start"][own], pa.int64()),
                    pa.array(segments["length"][own], pa.int64()),
                    pa.array([ids[a:e].astype("<u4").tobytes() for a, e in zip(at[own], end[own])], pa.binary()),
                    pa.array(segments["doc_tokens"][own], pa.int64()),
                    pa.array(row["first_sequence"] + np.array(segments["sequence"][own])),
                    pa.array(segments["offset"][own], pa.int64())], schema=schema)

    files = index.count()  # a row per set of files of about SHARD_TOKENS tokens
    return index.repartition(max(1, files), "path").mapInArrow(
        work, ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names))
