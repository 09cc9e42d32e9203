"""Phrases whose words stand together more often than apart, by prefix-free parsing.

Texts are cut into pieces at punctuation, and pieces into words. Wherever the
hash of a few consecutive words hits a residue, a chunk ends and the next
begins; neighbours overlap by these trigger words. So equal passages give
equal chunks, wherever they stand, and the corpus becomes a dictionary of
distinct chunks with their frequencies. An n-gram lies whole in the chunk
that owns its first word: each chunk owns its words up to the next trigger,
so every occurrence is counted once, inside distinct chunks, weighted.

N-grams are counted level by level over the dictionary. A phrase can be
frequent only if its two parts without the last and without the first word
are, so each level counts only those whose parts are marked in a bitmap of
the level before. Bitmaps have a fixed size and are addressed by hash: a
false mark costs a row in a shuffle, never a wrong count, as phrases are
counted by their text. Bigrams are first counted by 64-bit hash, so that the
many rare ones never travel as text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.common import staged

MAX_WORDS, MIN_COUNT, TOP, ABSORB_PERCENT, UNITS = 4, 30, 2000, 80, 2_000_000
#: One trigger in so many places on average; bytes of text parsed at once.
TRIGGER, BLOCK = 16, 1 << 20
#: Size of a level's bitmap as a power of two: 2^26 bits are 8 MB.
BITS, BITMAP = 26, 1 << 15
#: A task hands on its counts when it holds so many.
HELD = 1 << 18

_LETTERS = bytes(range(65, 91))
_BREAKS, _LINE = b".,;:!?\n\x0b\x0c\r", 10
_PLAIN = bytes.maketrans(_LETTERS + b"\t" + _BREAKS, _LETTERS.lower() + b" " + b"\n" * len(_BREAKS))
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """The powers of an odd base modulo 2^64, and their inverses."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK)
        for at, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[at] = np.cumprod(table, dtype=np.uint64)
    return _powers


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a block of normal text: start, end, line and hash of each."""

    def __init__(self, block: bytes) -> None:
        self.block = block
        a = np.frombuffer(block, np.uint8)
        line_end = a == _LINE
        change = np.diff(np.r_[True, line_end | (a == 32), True].view(np.int8))
        self.start, self.end = np.flatnonzero(change == -1), np.flatnonzero(change == 1)
        self.line = np.cumsum(line_end, dtype=np.int32)[self.start] if len(a) else np.zeros(0, np.int32)
        power, inverse = _power_tables(len(a) + 1)
        sums = np.zeros(len(a) + 1, np.uint64)
        np.cumsum((a.astype(np.uint64) + np.uint64(1)) * power[:len(a)], out=sums[1:])
        self.hash = _mix((sums[self.end] - sums[self.start]) * inverse[self.start])

    def whole(self, size: int) -> np.ndarray:
        """Whether the run of ``size`` words from each word on lies in one line."""
        n = len(self.line)
        inside = np.zeros(n, bool)
        if n >= size:
            inside[:n - size + 1] = self.line[:n - size + 1] == self.line[size - 1:]
        return inside

    def runs(self, size: int, seed: np.ndarray | int = 0) -> list[np.ndarray]:
        """Hashes of the runs of 1 to ``size`` words from each word on; the
        last ones of a block, which are not whole, are without meaning."""
        with np.errstate(over="ignore"):
            ones = _mix(self.hash + np.asarray(seed, np.uint64))
            found = [ones]
            for k in range(1, size):
                further = np.r_[ones[k:], np.zeros(min(k, len(ones)), np.uint64)][:len(ones)]
                found.append(_mix(found[-1] * np.uint64(_BASE) + further))
        return found


def normal(text: bytes) -> bytes:
    """A-Z in lower case, one space between words, a line feed for each break."""
    text = text.translate(_PLAIN)
    return re.sub(rb"  +", b" ", text) if b"  " in text else text


def _blocks(text: bytes, overlap: int, block: int) -> Iterator[tuple[bytes, int]]:
    """Parts of a normal text, and how many bytes of each are its own. They
    end at a line's end, or else between words; then the next ``overlap`` words follow."""
    further = re.compile(rb"(?: [^ \n]+){0,%d}" % overlap)
    at = 0
    while at < len(text):
        cut = len(text) if at + block >= len(text) else text.rfind(b"\n", at, at + block) + 1
        if cut > at:
            yield text[at:cut], cut - at
        else:
            cut = text.rfind(b" ", at + 1, at + block)
            if cut < 0:  # one very long word
                ends = [p for p in (text.find(b" ", at + block), text.find(b"\n", at + block)) if p >= 0]
                cut = min(ends, default=len(text))
            yield text[at:further.match(text, cut).end()], cut - at
        at = cut


def chunks(text: bytes, overlap: int = MAX_WORDS - 1, trigger: int = TRIGGER,
           block: int = BLOCK) -> Iterator[tuple[list[bytes], list[tuple[bytes, int]]]]:
    """The parse of a normal text, by block: chunks that own all their words, and (chunk, words owned) of the others."""
    for part, own in _blocks(text, overlap, block):
        words = Words(part)
        mine = int(np.searchsorted(words.start, own))
        if not mine:
            continue
        hit = words.whole(overlap) & (words.runs(overlap)[-1] % np.uint64(trigger) == 0)
        hit[0] = True
        hit[1:] |= words.line[1:] != words.line[:-1]
        first = np.flatnonzero(hit[:mine])
        following = np.r_[first[1:], mine]
        line_last = np.searchsorted(words.line, words.line[first], "right") - 1
        goes_on = following <= line_last
        last = np.where(goes_on, np.minimum(following + overlap - 1, line_last), line_last)
        cuts = list(zip(words.start[first].tolist(), words.end[last].tolist()))
        full, partly = [], []
        for (s, e), more, n in zip(cuts, goes_on.tolist(), (following - first).tolist()):
            if more:
                partly.append((part[s:e], n))
            else:
                full.append(part[s:e])
        yield full, partly


def _table(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names)


def dictionary(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", overlap: int = MAX_WORDS - 1,
               trigger: int = TRIGGER, block: int = BLOCK) -> DataFrame:
    """(lang, owned, chunk, n): the distinct chunks, each with a line feed behind
    it, and how often each is parsed; ``owned`` is -1 for all of a chunk's
    words. Null languages are ``und``, null texts empty."""
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Counter, Counter]] = {}

        def given() -> Iterator[pa.RecordBatch]:
            for lang, (full, partly) in held.items():
                n = len(full) + len(partly)
                yield _table([pa.array([lang] * n, pa.string()),
                              pa.array([-1] * len(full) + [k[1] for k in partly], pa.int32()),
                              pa.array([c + b"\n" for c in (*full, *(k[0] for k in partly))], pa.binary()),
                              pa.array([*full.values(), *partly.values()], pa.int64())],
                             ["lang", "owned", "chunk", "n"])
            held.clear()

        for b in batches:
            of_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(b["lang"].to_pylist(), b["text"]):
                of_lang.setdefault(lang, []).append(normal(text.as_py()))
            for lang, texts in of_lang.items():
                for full, partly in chunks(b"\n".join(texts), overlap, trigger, block):
                    counts = held.setdefault(lang, (Counter(), Counter()))
                    counts[0].update(full)
                    counts[1].update(partly)
                    if sum(len(c) for pair in held.values() for c in pair) > HELD:
                        yield from given()
        yield from given()

    parsed = rows.mapInArrow(work, "lang string, owned int, chunk binary, n long")
    return staged(parsed.groupBy("lang", "owned", "chunk").agg(F.sum("n").alias("n")), "chunks")


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


class Batch:
    """A batch of the dictionary: its words, and of each word the code and the seed of its
    language, whether its chunk owns it, and its chunk's frequency."""

    def __init__(self, b: pa.RecordBatch) -> None:
        chunk, lang = b["chunk"], b["lang"].dictionary_encode()
        ends = np.frombuffer(chunk.buffers()[1], np.int64 if pa.types.is_large_binary(chunk.type) else np.int32)
        ends = ends[chunk.offset:chunk.offset + len(chunk) + 1]
        self.words = words = Words(chunk.buffers()[2][int(ends[0]):int(ends[-1])].to_pybytes())
        self.langs = lang.dictionary.to_pylist()
        self.lang = lang.indices.to_numpy(zero_copy_only=False)[words.line]
        self.seed = np.array([_seed(x) for x in self.langs], np.uint64)[self.lang]
        self.n = b["n"].to_numpy(zero_copy_only=False)[words.line]
        limit = b["owned"].to_numpy(zero_copy_only=False)[words.line]
        place = np.arange(len(words.line)) - np.searchsorted(words.line, words.line)
        self.mine = (limit < 0) | (place < limit)

    def summed(self, at: np.ndarray, k: int, key: np.ndarray) -> Iterator[tuple[int, bytes, int]]:
        """(language, phrase, frequency) of the runs of ``k`` words that begin at
        ``at``, those with the same ``key`` and the same bytes as one."""
        at = at[np.argsort(key[at], kind="stable")]
        start, end, lang = self.words.start[at], self.words.end[at + k - 1], self.lang[at]
        again = np.r_[False, key[at[1:]] == key[at[:-1]]][:len(at)]
        if not self._alike(np.flatnonzero(again), start, end, lang):
            again[:] = False
        first = np.flatnonzero(~again)
        total = np.add.reduceat(self.n[at], first) if len(first) else first
        block = self.words.block
        for x, s, e, n in zip(lang[first].tolist(), start[first].tolist(), end[first].tolist(), total.tolist()):
            yield x, block[s:e], n

    def _alike(self, again: np.ndarray, start: np.ndarray, end: np.ndarray, lang: np.ndarray) -> bool:
        """Whether all runs of ``again`` are, byte by byte, like the ones before them."""
        size = end[again] - start[again]
        if (size != end[again - 1] - start[again - 1]).any() or (lang[again] != lang[again - 1]).any():
            return False
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        data = np.frombuffer(self.words.block, np.uint8)
        return bool((data[np.repeat(start[again], size) + step] == data[np.repeat(start[again - 1], size) + step]).all())


def _marked(bits: np.ndarray, hashes: np.ndarray, power: int) -> np.ndarray:
    at = (hashes >> np.uint64(64 - power)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _ahead(flags: np.ndarray) -> np.ndarray:
    """The flag of the next word at each word."""
    return np.r_[flags[1:], np.zeros(min(1, len(flags)), bool)]


def _counted(parsed: DataFrame, sizes: tuple[int, ...], known: int, bits, power: int) -> DataFrame:
    """(lang, phrase, k, h, n) of the runs of each of ``sizes`` words whose
    runs of ``known`` words are all marked (0: of all runs), with counts by task."""
    shared = parsed.sparkSession.sparkContext.broadcast(bits) if known else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], dict[bytes, int]] = {}

        def given() -> Iterator[pa.RecordBatch]:
            for (lang, k), counts in held.items():
                if not counts:
                    continue
                words = Words(b"\n".join(counts))
                h = words.runs(k, _seed(lang))[-1][::k]  # every phrase has k words
                n = len(counts)
                yield _table([pa.array([lang] * n, pa.string()), pa.array(list(counts), pa.binary()),
                              pa.array([k] * n, pa.int32()), pa.array(h.view(np.int64)),
                              pa.array(list(counts.values()), pa.int64())], ["lang", "phrase", "k", "h", "n"])
            held.clear()

        for b in (Batch(b) for b in batches if b.num_rows):
            hashes = b.words.runs(max(known, *sizes), b.seed)
            for k in sizes:
                take = b.mine & b.words.whole(k)
                if known:
                    sound = _marked(shared.value, hashes[known - 1], power)
                    for _ in range(k - known + 1):
                        take &= sound
                        sound = _ahead(sound)
                mine = [held.setdefault((lang, k), {}) for lang in b.langs]
                for lang, phrase, n in b.summed(np.flatnonzero(take), k, hashes[k - 1]):
                    counts = mine[lang]
                    counts[phrase] = counts.get(phrase, 0) + n
                if sum(map(len, held.values())) > HELD:
                    yield from given()
        yield from given()

    made = (parsed.select("lang", "owned", "chunk", "n")
            .mapInArrow(work, "lang string, phrase binary, k int, h long, n long"))
    return made.groupBy("lang", "phrase", "k", "h").agg(F.sum("n").alias("n"))


def _bigram_hashes(parsed: DataFrame, bits, power: int) -> DataFrame:
    """(h, n): bigrams of marked words, counted by hash."""
    shared = parsed.sparkSession.sparkContext.broadcast(bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, weights, size = [], [], 0

        def given() -> Iterator[pa.RecordBatch]:
            nonlocal size
            if size:
                order = np.argsort(h := np.concatenate(keys), kind="stable")
                h, n = h[order], np.concatenate(weights)[order]
                first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
                yield _table([pa.array(h[first].view(np.int64)), pa.array(np.add.reduceat(n, first))], ["h", "n"])
            keys.clear(), weights.clear()
            size = 0

        for b in (Batch(b) for b in batches if b.num_rows):
            ones, twos = b.words.runs(2, b.seed)
            sound = _marked(shared.value, ones, power)
            take = b.mine & b.words.whole(2) & sound & _ahead(sound)
            keys.append(twos[take])
            weights.append(b.n[take])
            size += len(keys[-1])
            if size > 8 * HELD:
                yield from given()
        yield from given()

    made = parsed.select("lang", "owned", "chunk", "n").mapInArrow(work, "h long, n long")
    return made.groupBy("h").agg(F.sum("n").alias("n"))


def _bitmap(hashed: DataFrame, power: int) -> np.ndarray:
    """The places of the column ``h``, as bits: 2^power of them, whatever the number of rows."""
    place = F.shiftrightunsigned("h", 64 - power)
    parts = (hashed.select(F.shiftright(place, 15).alias("part"), place.bitwiseAND(F.lit(BITMAP - 1)).alias("at"))
             .groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits")).collect())
    bits = np.zeros(max(1 << power, BITMAP) >> 3, np.uint8)
    for part, found in parts:
        bits[part * (BITMAP >> 3):][:len(found)] = np.frombuffer(found, np.uint8)
    return bits


def frequent(parsed: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
             power: int = BITS) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, k, n) of all phrases of 1 to ``max_words`` words that
    occur ``min_count`` times, (lang, n): all words)."""
    often = F.col("n") >= min_count
    words = staged(_counted(parsed, (1,), 0, None, power), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    levels = [words.where(often)]
    if max_words > 1:
        pairs = _bigram_hashes(parsed, _bitmap(levels[0], power), power)
        bits, known = _bitmap(pairs.where(often), power), 2
        for k in range(min(3, max_words), max_words + 1):
            # bigrams are counted by text together with the trigrams, by the same marks
            sizes = tuple(sorted({2, k})) if k <= 3 else (k,)
            levels.append(staged(_counted(parsed, sizes, known, bits, power).where(often), "phrases"))
            if k < max_words:
                bits, known = _bitmap(levels[-1].where(F.col("k") == k), power), k
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found.select("lang", F.col("phrase").cast("string").alias("phrase"), "k", "n"), totals


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT, top: int = TOP, absorb_percent: int = ABSORB_PERCENT,
                 trigger: int = TRIGGER, block: int = BLOCK, power: int = BITS) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates are phrases of 2 to ``max_words`` words that occur ``a >=
    min_count`` times. Their score is the least over all cuts of
    floor(2000000 a / (l + r)), where the parts occur l and r times; ties go to
    the shortest first part. A candidate is dropped if a longer one that
    contains it occurs at least ``absorb_percent`` % as often. Order: score,
    a, phrase in byte order. ``n`` counts the language's words.

    Null languages count as ``und``, null and empty texts have no words;
    repeated rows count as often as they stand there. An empty table gives
    no rows, and other columns are not read.
    """
    parsed = dictionary(docs, lang_col, text_col, max_words - 1, trigger, block)
    found, totals = frequent(parsed, max_words, min_count, power)
    found = staged(found, "frequent")
    words = F.split("phrase", " ")
    part = lambda start, size: F.array_join(F.slice(words, start, size), " ")
    candidates = found.where("k > 1").withColumnRenamed("n", "a")
    cuts = (candidates.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
            .select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("first"),
                    part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest")))
    left = found.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = found.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    units = F.expr(f"{UNITS}BD * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct(units.alias("score"), "cut", "l", "r")).alias("least")))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: part(i, m))))
    longer = (candidates.where("k > 2").select("lang", F.explode(inner).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * _exact("longer") < absorb_percent * _exact("a")))
    order = Window.partitionBy("lang").orderBy(F.col("least.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "least.l", "least.r", "n", "least.score")
