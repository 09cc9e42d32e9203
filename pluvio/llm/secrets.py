"""Secret scan: patterns, and zstandard novelty primed with a dictionary.

Pattern findings are reported as they match. Beyond them, every string of
letters and digits close to a sensitive word, on either side, is a candidate, and so
are runs on the lines directly after one. Its novelty is the marginal
compressed size, in bytes a character, that it adds to the code around it, with a compressor primed with the
identifiers that most distinct texts of the corpus use: names and words are
cheap there, a random string costs most of its length. Other occurrences of a
candidate in the code around it do not count as known. Candidates above
``NOVELTY``, or what their own alphabet allows, are reported.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.llm.common import free_prefix, others, staged

#: Pattern kinds in the order in which findings at one place are listed.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: What a candidate may be: a run of these, with letters and digits in it.
LEAST_RUN = 12
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
VALUE = re.compile(r"[A-Za-z0-9+/_-]{12,}")
SENSITIVE = re.compile(r"(?ai:pass(?:word|wd|phrase|code)|pwd|secret|token|(?:api|access|private|signing)[_ -]?key"
                       r"|credential|authorization|bearer|signature|session[_ -]?id)")
SENSITIVE_WORDS = ("pass", "pwd", "secret", "token", "key", "credential", "authorization", "bearer",
                   "signature", "session")
#: Characters between a sensitive word and a candidate on either side of it, at most.
NEAR = 64
#: Between a candidate and one on the next line.
NEXT_LINE = re.compile(r"""[\x20\t"'+,\\\r]{0,8}\n[\x20\t"'#*>]*""")
#: Characters of code around a candidate that it is measured against, each side.
AROUND = 256
#: Least marginal bytes a character that make a candidate novel.
NOVELTY = 0.6
#: Alphabets of random strings and their sizes; the share of a character's entropy that is asked for.
ALPHABETS = ((re.compile("[0-9A-F]+|[0-9a-f]+"), 16), (re.compile("[0-9A-Z]+|[0-9a-z]+"), 36))
OF_ALPHABET, SIGNS = 0.9, re.compile("[+/_=-]")
#: Runs that name something: a date or time, or words and numbers in a row, so many characters each on average.
TIMESTAMP = re.compile(r"\d{4}[-_/]?\d\d[-_/]?\d\d(?:[Tt_-]?\d\d[-_]?\d\d(?:[-_]?\d\d)?\d*)?[Zz]?")
PARTS, PART_LENGTH = re.compile("[A-Z]?[a-z]+|[A-Z]+|[0-9]+"), 3
#: Identifiers in the dictionary.
DICTIONARY_WORDS = 4096
IDENTIFIER = re.compile(r"[A-Za-z_]{4,24}")


def base_findings(text: str, lowered: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches of a text."""
    found = []
    if any(w in lowered for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[2])))


def candidates(text: str, lowered: str, base: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs that no pattern has found, near a sensitive
    word on either side, or on the line directly after such a run."""
    if not any(w in lowered for w in SENSITIVE_WORDS):
        return
    words = [m.span() for m in SENSITIVE.finditer(text)]
    starts, ends = [s for s, _ in words], [e for _, e in words]
    last = None  # end of the last run in sensitive context
    for m in CANDIDATE.finditer(text):
        for start, end in _beside_word(*m.span(), words, ends):
            run = text[start:end]
            if not (any(map(str.isdigit, run)) and any(map(str.isalpha, run))) or is_name(run):
                continue
            before, after = bisect_right(ends, start) - 1, bisect_left(starts, end)
            near = (before >= 0 and start - ends[before] <= NEAR) or (after < len(words) and starts[after] - end <= NEAR)
            if not near and (last is None or not NEXT_LINE.fullmatch(text, last, start)):
                continue
            last = end
            if not any(s < end and start < e for s, e, _ in base):
                yield start, end


def _beside_word(start: int, end: int, words: list[tuple[int, int]], ends: list[int]) -> list[tuple[int, int]]:
    """A run, or what lies before and after the first sensitive word in it."""
    first = bisect_right(ends, start)
    if first == len(words) or words[first][0] >= end:
        return [(start, end)]
    s, e = words[first]
    return [(x, y) for x, y in ((start, s), (e, end)) if y - x >= LEAST_RUN]


def is_name(run: str) -> bool:
    """Whether a run is a timestamp, or signs or capitals divide it into words
    and numbers; random strings fall into much shorter parts."""
    if TIMESTAMP.fullmatch(run):
        return True
    parts = PARTS.findall(run)
    divided = SIGNS.search(run) or not (run.islower() or run.isupper())
    return bool(divided) and sum(map(len, parts)) >= PART_LENGTH * len(parts)


def least_novelty(run: str) -> float:
    """``NOVELTY``, or less where the alphabet of the run allows less."""
    letters = SIGNS.sub("", run)
    size = next((n for alphabet, n in ALPHABETS if alphabet.fullmatch(letters)), 64)
    return min(NOVELTY, OF_ALPHABET * math.log2(size) / 8)


def _blanked(text: str, runs: set[str]) -> str:
    """``text`` with those of its runs that are among ``runs`` blanked."""
    return VALUE.sub(lambda m: " " * len(m[0]) if m[0] in runs else m[0], text)


def _without_candidates(text: str) -> str:
    """A text with its findings and candidates blanked, where they stand and
    wherever their values stand as runs of their own."""
    lowered = text.lower()
    base = base_findings(text, lowered)
    blank = sorted([(s, e) for s, e, _ in base] + list(candidates(text, lowered, base)))
    if not blank:
        return text
    runs = {v for s, e in blank for v in VALUE.findall(text, s, e)}
    parts, at = [], 0
    for s, e in blank:
        parts.append(text[at:max(at, s)])
        at = max(at, e)
    return _blanked(" ".join([*parts, text[at:]]), runs)


def identifier_dictionary(docs: DataFrame, text_col: str = "text", words: int = DICTIONARY_WORDS) -> bytes:
    """The identifiers that occur in most distinct texts of the whole table,
    findings and candidates left out, the commonest last, where a compressor
    reaches them at least cost.

    Null texts count as empty, and a text that is repeated once; ties go to the
    smaller word. Words of one text alone are left out, so a small or empty
    table may give an empty dictionary. Other columns are not read.
    """

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, made = [], []
            for t in b["text"]:
                text = t.as_py()
                hashes.append(hashlib.sha256(text.encode()).digest())
                made.append(" ".join(sorted(set(IDENTIFIER.findall(_without_candidates(text))))))
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.binary()), pa.array(made, pa.string())],
                                             ["text_hash", "words"])

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    once = (texts.mapInArrow(distinct_words, "text_hash binary, words string")
            .groupBy("text_hash").agg(F.first("words").alias("words")))
    counts = staged(once.select(F.explode(F.split("words", " ")).alias("word")).where("word <> ''")
                    .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "words")
    order = [F.desc("n"), F.asc("word")]
    # sorted by range, the first rows are in the first parts: no task sends its own best to the driver
    top = counts.repartitionByRange(*order).sortWithinPartitions(*order).limit(words).collect()
    return " ".join(r["word"] for r in reversed(top)).encode()


class Scanner:
    """Scans texts with a compressor primed by the dictionary and the code around a span."""

    def __init__(self, dictionary: bytes) -> None:
        self._dictionary = dictionary

    def _size(self, primer: bytes, content: bytes) -> int:
        primed = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=3, dict_data=primed, write_checksum=False,
                                            write_content_size=False, write_dict_id=False).compress(content))

    def novelty(self, text: str, start: int, end: int, alone: bool = False) -> float:
        """Marginal compressed bytes a character of a span, its surroundings
        known; with ``alone``, other occurrences of its runs are blanked there."""
        before, after = text[max(0, start - AROUND - (end - start)):start], text[end:end + AROUND + (end - start)]
        if alone:  # the value of "key=value" may stand elsewhere without its key
            run, runs = text[start:end], set(VALUE.findall(text, start, end))
            before, after = (_blanked(side.replace(run, " " * len(run)), runs) for side in (before, after))
        around = before[-AROUND:] + " " + after[:AROUND]
        primer = self._dictionary + b" " + around.encode() + b" " * 8
        return (self._size(primer, text[start:end].encode()) - self._size(primer, b"")) / (end - start)

    def scan(self, text: str) -> list[dict]:
        lowered = text.lower()
        base = base_findings(text, lowered)
        found: list[tuple[int, int, str, float | None]] = [(s, e, kind, None) for s, e, kind in base]
        for start, end in candidates(text, lowered, base):
            if (novelty := self.novelty(text, start, end, alone=True)) >= least_novelty(text[start:end]):
                found.append((start, end, "novel", novelty))
        found.sort(key=lambda f: (f[0], KINDS.index(f[2])))
        return [{"kind": k, "start": s, "end": e, "novelty": n} for s, e, k, n in found]


FINDINGS = "array<struct<kind:string,start:long,end:long,novelty:double>>"


def scan(docs: DataFrame, dictionary: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with ``findings``: (kind, start, end, novelty) by place in the
    whole text, in code points, the end exclusive; novelty only of ``novel`` ones.

    Null and empty texts have no findings (an empty list). Pattern kinds may
    overlap each other; a ``novel`` finding overlaps none of them. An input
    column named ``findings`` is replaced.
    """
    kept = others(docs, ["findings"])
    rows = docs.select(*kept, F.coalesce(F.col(text_col), F.lit("")).alias(free_prefix(docs, "_scanned_text")))
    fields = [f for f in rows.schema.fields[:-1]]
    made = T.StructType([*fields, T.StructField("findings", T._parse_datatype_string(FINDINGS))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("novelty", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(dictionary)
        for b in batches:
            found = pa.array([scanner.scan(t.as_py()) for t in b.column(b.num_columns - 1)], kind)
            columns = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, found], [*b.schema.names[:-1], "findings"])

    return rows.mapInArrow(work, made)


def spans(findings: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the findings of these kinds, comma-joined, in order."""
    own = F.filter(findings, lambda f: f["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
