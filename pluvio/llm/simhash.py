"""SimHash near-duplicates by anchor-point covering.

A covering code is a set of anchors such that every fingerprint lies within
the covering radius R of one of them, its home. If two fingerprints differ
in at most t bits, the second lies within R + t of the home of the first.
So each fingerprint is copied to every anchor within R + t, and only
fingerprints at the same anchor are compared, one of them being at home.

The code is linear, the direct sum of the Golay code [23, 12] (perfect,
radius 3), the Hamming code [7, 4] (perfect, radius 1) and two free bits:
2^18 anchors for 32 bits, radius 4. It is applied to each half of a
fingerprint. Of two fingerprints that differ in at most k bits, one half
differs in at most k // 2, so t is k // 2 there: with k = 3, about 15
anchors for each half. The other half only counts in the comparison, which
is always over all 64 bits.

Only distinct fingerprints are compared, so a group of equal ones, however
large, is one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import free_prefix, others, staged
from pluvio.llm.graph import components

#: Groups up to this size at an anchor are compared side by side, larger ones by search.
SMALL_GROUP = 64
#: Rows of an anchor from which on they are divided by the bytes of the other half.
DIVIDED_GROUP = 1024
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 16


# --- fingerprints ---------------------------------------------------------

def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The fingerprint of a whole text given as UTF-8, as an unsigned number."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    width = min(shingle, len(words))
    joined = map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in joined), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(len(part), 64)
        # bytes are added eight at a time, in runs too short to overflow one
        runs = np.add.reduceat(bits.view(np.uint64), np.arange(0, len(part), 255), axis=0)
        ones += runs.view(np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long, text_hash long) for every row; null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("content"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = np.array([fingerprint(x.as_buffer().to_pybytes(), shingle) for x in b["content"]], np.uint64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(made.view(np.int64)), b["text_hash"]],
                                             ["doc_id", "fp", "text_hash"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {kind}, fp long, text_hash long")


# --- the covering code ----------------------------------------------------

def _parity_columns() -> list[int]:
    """For each of 32 bits, the 14-bit syndrome of an error there."""
    golay, x = [], 1
    for _ in range(23):  # powers of x modulo the generator polynomial of the code
        golay.append(x)
        x <<= 1
        if x >> 11:
            x ^= 0b110001110101
    return golay + [h << 11 for h in range(1, 8)] + [0, 0]


@lru_cache(maxsize=4)
def anchor_offsets(threshold: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(offsets, starts, radius): a half with syndrome s has its anchors
    within radius + threshold at ``half ^ offsets[starts[s]:starts[s + 1]]``,
    its home first."""
    columns = _parity_columns()
    size = 1 << 14
    covered, masks, syndromes, weights, radius = np.zeros(size, bool), [], [], [], None
    for weight in range(len(columns) + 1):
        if radius is not None and weight > radius + threshold:
            break
        for bits in combinations(range(32), weight):
            mask = syndrome = 0
            for i in bits:
                mask |= 1 << i
                syndrome ^= columns[i]
            masks.append(mask)
            syndromes.append(syndrome)
            weights.append(weight)
            covered[syndrome] = True
        if radius is None and covered.all():
            radius = weight
    masks, syndromes = np.array(masks, np.uint64), np.array(syndromes)
    order = np.lexsort((masks, np.array(weights), syndromes))
    starts = np.searchsorted(syndromes[order], np.arange(size + 1))
    return masks[order], starts, radius


@lru_cache(maxsize=1)
def _syndrome_tables() -> np.ndarray:
    columns = _parity_columns()
    tables = np.zeros((4, 256), np.int64)
    for byte in range(4):
        for value in range(256):
            for i in range(8):
                if value >> i & 1:
                    tables[byte, value] ^= columns[8 * byte + i]
    return tables


def anchors(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into fps, anchor key, home): all copies of the fingerprints."""
    offsets, starts, _ = anchor_offsets(max_bits // 2)
    tables, found = _syndrome_tables(), []
    for half in (0, 1):
        part = (fps >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        syndrome = np.zeros(len(fps), np.int64)
        for byte in range(4):
            syndrome ^= tables[byte, ((part >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)]
        count = starts[syndrome + 1] - starts[syndrome]
        index = np.repeat(np.arange(len(fps)), count)
        nth = np.arange(len(index)) - np.repeat(np.cumsum(count) - count, count)
        key = part[index] ^ offsets[starts[syndrome][index] + nth]
        found.append((index, key.astype(np.int64) | (half << 32), nth == 0))
    return tuple(map(np.concatenate, zip(*found)))


# --- comparison per anchor ------------------------------------------------

def _small(key, fp, home, max_bits) -> list[np.ndarray]:
    """Links inside runs of equal keys, every row against the k-th after it."""
    links = []
    for k in range(1, SMALL_GROUP):
        at = np.flatnonzero(key[k:] == key[:-k])
        if not len(at):
            break
        a, b = fp[at], fp[at + k]
        near = (np.bitwise_count(a ^ b) <= max_bits) & (home[at] | home[at + k])
        links.append(np.stack([a[near], b[near]], axis=1))
    return links


def _forest(fp: np.ndarray, max_bits: int) -> list[np.ndarray]:
    """A spanning forest of the links inside one group: fewer links than rows."""
    links, rest, queue = [], fp, []
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= max_bits
            if near.any():
                found = rest[near]
                links.append(np.stack([np.full(len(found), x), found], axis=1))
                queue.extend(found)
                rest = rest[~near]
        queue = queue if len(rest) else []
    return links


def _large(fp: np.ndarray, half: int, max_bits: int) -> list[np.ndarray]:
    """Links that connect what is near in a large group of one anchor.

    The half that the anchor does not cover differs in at most ``max_bits``
    bits, so with fewer bits than bytes at least one of its bytes is equal: the
    group is divided by each byte in turn, and rows are compared inside these parts."""
    if max_bits >= 4 or len(fp) <= DIVIDED_GROUP:
        return _forest(fp, max_bits)
    other, links = fp >> np.uint64(32 * (1 - half)), []
    for byte in range(4):
        value = (other >> np.uint64(8 * byte)) & np.uint64(255)
        order = np.argsort(value, kind="stable")
        for part in np.split(fp[order], np.flatnonzero(np.diff(value[order])) + 1):
            links += _forest(part, max_bits)
    return links


def _links(key, fp, home, max_bits) -> list[np.ndarray]:
    edges = np.flatnonzero(np.diff(key)) + 1
    starts, ends = np.r_[0, edges], np.r_[edges, len(key)]
    large = ends - starts > SMALL_GROUP
    links = []
    for s, e in zip(starts[large], ends[large]):
        links += _large(fp[s:e], int(key[s]) >> 32, max_bits)
    small = np.repeat(~large, ends - starts)
    return links + _small(key[small], fp[small], home[small], max_bits)


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b): links between the distinct fingerprints of ``fps`` (fp), enough
    to connect all that differ in at most ``max_bits`` bits."""

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b["fp"].to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 4096):
                part = fp[at:at + 4096]
                index, key, home = anchors(part.view(np.uint64), max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[index]), pa.array(home)],
                                                 ["anchor", "fp", "home"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(key, fp, home) -> Iterator[pa.RecordBatch]:
            for x in _links(key, fp.view(np.uint64), home, max_bits) if len(key) else []:
                if len(x):
                    a, b = x.view(np.int64).T
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        held: list[tuple] = []  # rows of a group that may go on in the next batch
        for b in batches:
            rows = [b[c].to_numpy(zero_copy_only=False) for c in ("anchor", "fp", "home")]
            if not len(rows[0]):
                continue
            if held and held[-1][0][-1] == rows[0][0] == rows[0][-1]:
                held.append(rows)
                continue
            rows = [np.concatenate(x) for x in zip(*held, rows)]
            cut = np.searchsorted(rows[0], rows[0][-1])
            yield from made(*(x[:cut] for x in rows))
            held = [[x[cut:] for x in rows]]
        if held:
            yield from made(*map(np.concatenate, zip(*held)))

    copies = fps.mapInArrow(copy, "anchor long, fp long, home boolean")
    return (copies.repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(compare, "a long, b long"))


# --- groups ---------------------------------------------------------------

def _grouped(docs: DataFrame, max_bits: int, shingle: int, id_col: str, text_col: str):
    """(rows with fingerprints, fp -> best row of its component)."""
    rows = staged(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "text_hash")).alias("best")
    fps = staged(rows.groupBy("fp").agg(best), "distinct")
    roots = components(links(fps.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = rooted.groupBy("root").agg(F.min("best").alias("best"))
    return rows, rooted.select("fp", "root").join(first, "root").select("fp", "best")


def near_duplicates(docs: DataFrame, max_bits: int = 3, shingle: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, fingerprint, component_id).

    ``component_id`` is the smallest id that can be reached over links of at
    most ``max_bits`` bits, null only if all ids there are null. Texts
    without words (null, empty, white space) have fingerprint zero. Equal
    rows get equal results; an empty table gives an empty result.
    """
    rows, groups = _grouped(docs, max_bits, shingle, id_col, text_col)
    return rows.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.doc_id").alias("component_id"))


def deduplicate(docs: DataFrame, max_bits: int = 3, shingle: int = 3,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that with the smallest
    id (ids that are not null first). Rows equal in id and text are the same
    document: they stay or go together. Texts without words (null, empty, white
    space) are alike and one of them stays. An empty table stays empty, and
    columns keep their names, whatever they are."""
    rows, groups = _grouped(docs, max_bits, shingle, id_col, text_col)
    goes = rows.join(groups, "fp").where(
        "not (doc_id <=> best.doc_id and fp = best.fp and text_hash = best.text_hash)")
    goes = staged(goes.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).distinct(), "goes")
    hashed = free_prefix(docs, "_simhash_text_hash_")
    marked = docs.withColumn(hashed, F.xxhash64(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    left = marked.join(goes, marked[id_col].eqNullSafe(goes["d"]) & (marked[hashed] == goes["h"]), "left_anti")
    return left.select(*others(left, [hashed]))
