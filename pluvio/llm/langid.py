"""Language identification: averaged hashed subword embeddings.

A text is the bag of its lower-cased character 1- to 4-grams inside words,
the word's edges included, each hashed to a bucket. The mean of the
buckets' embeddings goes through a linear softmax. Both layers are trained
together by stochastic gradient descent in numpy, on a bounded sample of
labelled texts that is balanced over the languages. A part of the sample
calibrates: a temperature makes the probabilities honest, and the rejection
threshold is the score that all but ``REJECT`` of the correct predictions
reach.

For prediction the two layers fold into one table of bucket scores, so a
text costs one gather and one mean, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import free_prefix, others

BUCKETS = 1 << 14
DIMENSIONS = 16
ORDERS = (1, 2, 3, 4)
#: Rows of the training sample over all languages (a bound, not a size).
TRAIN_ROWS = 2400
EPOCHS, RATE = 6, 0.5
#: Share of the sample that calibrates, and of correct predictions that may be rejected.
CALIBRATION, REJECT = 0.25, 0.01
#: A wrong prediction kept counts as much as so many right ones rejected.
COST = 5
UNKNOWN = "und"
PIECE = 1 << 18


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _grams(text: str) -> np.ndarray:
    """Buckets of the subwords of a piece of text, with repeats."""
    points = np.frombuffer((" " + text + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    table = _letters()
    letter = table[np.minimum(points, len(table) - 1)]
    points = np.where(letter, points, 32).astype(np.uint64)
    found = []
    for n in ORDERS:
        size = len(points) - n + 1
        if size < 1:
            break
        value = np.full(size, n, np.uint64)
        for i in range(n):
            value = value * np.uint64(0x9E3779B97F4A7C15) + points[i:i + size]
        whole = letter[:size].copy() if n < 3 else np.ones(size, bool)
        for i in range(1, n - 1):  # no edge inside a subword
            whole &= letter[i:i + size]
        if n == 2:
            whole |= letter[1:1 + size]
        value = value[whole]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        found.append((value >> np.uint64(40)).astype(np.int64) % BUCKETS)
    return np.concatenate(found)


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter; the last entry stands for all beyond."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(i).isalpha() for i in range(0x3000)] + [True]))
    return _LETTERS[0]


def _pieces(text: str) -> Iterator[np.ndarray]:
    """Subwords of a whole text, in pieces of bounded size cut at white space if there is any."""
    text, at = text.lower(), 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            end = max(text.rfind(" ", at + 1, end), text.rfind("\n", at + 1, end)) + 1 or end
        yield _grams(text[at:end])
        at = end


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, share of the subwords in each)."""
    counts = np.zeros(BUCKETS)
    for grams in _pieces(text):
        counts += np.bincount(grams, minlength=BUCKETS)
    where = np.flatnonzero(counts)
    return where, counts[where] / max(counts.sum(), 1)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray  # buckets x languages: embedding times output layer
    bias: np.ndarray
    temperature: float
    threshold: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, probability, rejected); ``und`` without letters or languages."""
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        total, n = np.zeros(len(self.languages)), 0
        for grams in _pieces(text):
            total += np.bincount(grams, minlength=BUCKETS).astype(np.float64) @ self.table if len(
                grams) > BUCKETS else self.table[grams].sum(axis=0)
            n += len(grams)
        p = _softmax((total / max(n, 1) + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(bags: list[tuple[np.ndarray, np.ndarray]], langs: list[str], seed: int = 7) -> LanguageModel:
    """Fit both layers, then the temperature and the rejection threshold."""
    languages = tuple(sorted(set(langs)))
    if not languages:
        return LanguageModel((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    truth = np.searchsorted(languages, langs)
    order = rng.permutation(len(bags))
    apart = int(len(bags) * CALIBRATION)
    calibrate, learn = order[:apart], order[apart:]
    embed = rng.normal(0, 1, (BUCKETS, DIMENSIONS))
    out, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    steps, done = EPOCHS * len(learn), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(learn):
            rate = RATE * (1 - done / steps)
            done += 1
            where, share = bags[i]
            mean = share @ embed[where]
            off = _softmax(mean @ out + bias)
            off[truth[i]] -= 1
            back = out @ off
            out -= rate * np.outer(mean, off)
            bias -= rate * 0.1 * off
            embed[where] -= rate * np.outer(share, back)
    table = embed @ out
    if not len(calibrate):
        return LanguageModel(languages, table, bias, 1.0, 0.0)
    logits = np.array([share @ table[where] + bias for where, share in (bags[i] for i in calibrate)])
    known = truth[calibrate]
    rows = np.arange(len(known))

    def loss(t: float) -> float:
        return float(-np.log(np.maximum(_softmax(logits / t)[rows, known], 1e-12)).mean())

    temperature = min(np.geomspace(0.5, 20, 121), key=loss)
    p = _softmax(logits / temperature)
    threshold = rejection_threshold(p.max(axis=1), p.argmax(axis=1) == known)
    return LanguageModel(languages, table, bias, float(temperature), threshold)


def rejection_threshold(sure: np.ndarray, right: np.ndarray) -> float:
    """The probability under which a prediction is rejected: where wrong ones
    kept, each as bad as ``COST`` right ones rejected, and right ones rejected
    are fewest, but at least the share ``REJECT`` of the right ones."""
    if not right.any():
        return 0.0
    least = np.sort(sure[right])[int(right.sum() * REJECT)]
    order = np.argsort(sure, kind="stable")
    rejected = np.r_[0, np.cumsum(right[order])]  # right ones among the i least sure
    kept = (~right).sum() - np.r_[0, np.cumsum(~right[order])]
    best = int(np.argmin(COST * kept + rejected))
    cut = sure[order[best]] if best < len(sure) else np.inf
    return float(max(least, cut if best else 0.0))


def held_out(doc_id: Column) -> Column:
    """Rows that no language is learned from; a row without id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        train_rows: int = TRAIN_ROWS) -> LanguageModel:
    """Learn from a sample of at most ``train_rows`` rows that have a
    language and are not held out, as many of each language as there are, up
    to an equal share. The sample is seeded by the id."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).alias("text")).where(~held_out(F.col("id"))).where(
        "lang is not null and text rlike '\\\\p{L}'")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return train([], [])
    quota = train_rows * 0.9 / len(counts)
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, quota / n))])
    draw = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1_000_003)) / 1_000_003

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            made = [bag(t) for t in part["text"]]
            yield pd.DataFrame({"id": part["id"].astype("string"), "lang": part["lang"],
                                "buckets": [w.astype(np.int32) for w, _ in made],
                                "shares": [s.astype(np.float32) for _, s in made]})

    sample = (rows.where(draw < share[F.col("lang")]).limit(train_rows)
              .mapInPandas(bags, "id string, lang string, buckets array<int>, shares array<float>")
              .toPandas().sort_values(["id", "lang"]))
    return train(list(zip(sample["buckets"], sample["shares"].map(lambda s: np.asarray(s, np.float64)))),
                 list(sample["lang"]))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and rejected.

    Only the whole text is read. A text that is null or has no letter is
    ``und`` with score 0, rejected. ``rejected`` marks predictions under the
    calibrated threshold; their language is still given. Input columns of
    these names are replaced.
    """

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predicted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            yield pd.DataFrame([model.predict(t) for t in part], columns=["lang_pred", "score", "rejected"])

    found = free_prefix(docs, "_langid_")
    made = docs.withColumn(found, predicted(F.coalesce(F.col(text_col), F.lit(""))))
    return made.select(*others(made, ["lang_pred", "score", "rejected", found]), f"{found}.*")
