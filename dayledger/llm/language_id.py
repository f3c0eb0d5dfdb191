"""Language identification by words first, then ever shorter character n-grams.

A model holds, per language, the negative logarithm of the relative frequency of its most
frequent words and of the n-grams of 1 to 5 letters in its words. A word that the model
knows, of any language, is scored by its frequencies. An unseen word is scored by the mean
of its known 5-grams; if it has none, by its 4-grams, and so on. A text belongs to the
language in which its words score best on average.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from dayledger.llm.shared import ship, stored

#: Most words, and most n-grams of each length, that the model keeps for a language. All
#: that are as frequent as the first one beyond go, too.
WORDS, GRAMS = 30_000, 10_000
#: Most scores in the table of one kind of feature; with more than 16 languages, fewer
#: features of each are kept.
CELLS = 1 << 23
LONGEST_GRAM = 5
#: A longer word is never a feature itself; it is scored by its n-grams.
LONGEST_WORD = 64
#: A feature a language lacks scores as if it were so much rarer than the rarest that is kept.
PENALTY = 1.0
UNKNOWN = "und"
#: Counts that a task holds before it passes them on, and unseen words a worker remembers.
HELD, REMEMBERED = 500_000, 100_000
#: Texts whose unseen words are scored together.
TOGETHER = 64

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Up to U+024F there are no marks, and these are all the letters.
_LATIN_WORD, _BEYOND_LATIN = re.compile("[A-Za-zªµºÀ-ÖØ-öø-ɏ]+"), re.compile("[^\x00-\u024f]")
COUNTS = "lang string, size int, feature string, n long"


def words_in(text: str | None) -> list[str]:
    """Runs of letters, with their marks, in lower case."""
    lowered = (text or "").lower()
    return (_WORD if _BEYOND_LATIN.search(lowered) else _LATIN_WORD).findall(lowered)


def grams_in(word: str, size: int) -> list[str]:
    """The n-grams of a word that starts and ends in a space; single letters without these."""
    padded = word if size == 1 else f" {word} "
    return [padded[k : k + size] for k in range(len(padded) - size + 1)]


class _Counts:
    """Counts by language, passed on as rows whenever there are many."""

    def __init__(self, whole: bool):
        self.whole, self.of = whole, defaultdict(Counter)

    def full(self) -> bool:
        return sum(map(len, self.of.values())) >= HELD

    def rows(self) -> pa.RecordBatch:
        langs = [lang for lang, own in self.of.items() for _ in own]
        features = [feature for own in self.of.values() for feature in own]
        n = [n for own in self.of.values() for n in own.values()]
        sizes = [0] * len(features) if self.whole else list(map(len, features))
        self.of.clear()
        columns = zip((langs, sizes, features, n), (pa.string(), pa.int32(), pa.string(), pa.int64()), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["lang", "size", "feature", "n"])


def _words_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _Counts(whole=True)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts.of[lang].update(words_in(text.as_py()))
            if counts.full():
                yield counts.rows()
    yield counts.rows()


def _grams_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _Counts(whole=False)
    for batch in batches:
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "feature", "n")), strict=True):
            own = counts.of[lang]
            for size in range(1, LONGEST_GRAM + 1):
                for gram in grams_in(word, size):
                    own[gram] += n
        if counts.full():
            yield counts.rows()
    yield counts.rows()


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("lang", "size", "feature").agg(F.sum("n").alias("n"))


def feature_counts(texts: DataFrame) -> DataFrame:
    """How often each language has each word (size 0) and n-gram (its size), over all rows.

    texts: lang and text. Tasks count before anything is shuffled, and n-grams are counted
    in distinct words, so neither a language with most of the rows nor a frequent word
    makes a large group.
    """
    ship(texts.sparkSession)
    words = stored(_summed(texts.select("lang", "text").mapInArrow(_words_of_texts, COUNTS)), "language-words")
    # A short table would be read by few tasks; each of its rows makes some forty n-grams.
    spread = words.repartition(4 * texts.sparkSession.sparkContext.defaultParallelism)
    grams = _summed(spread.mapInArrow(_grams_of_words, COUNTS))
    return stored(words.unionByName(grams), "language-features")


def _kept(counts: DataFrame, languages: int) -> DataFrame:
    """The most frequent features of each language and size, with the sum over all of them.

    The least count that stays is read from a histogram of the counts, so nothing is ranked
    in one place but the different counts of a language.
    """
    fits = CELLS // languages**2
    most = F.when(F.col("size") == 0, min(WORDS, fits)).otherwise(min(GRAMS, fits))
    fitting = F.length("feature") <= LONGEST_WORD
    histogram = counts.groupBy("lang", "size", "n").agg(F.count_if(fitting).alias("features"), F.count("*").alias("rows"))
    down = W.partitionBy("lang", "size").orderBy(F.desc("n"))
    bounds = (
        histogram.withColumn("up_to", F.sum("features").over(down))
        .groupBy("lang", "size")
        .agg(
            F.min(F.when(F.col("up_to") <= most, F.col("n"))).alias("least"),
            F.sum(F.col("n") * F.col("rows")).alias("total"),
        )
    )
    # Six rows for each language, all of whose names the model brings to the driver anyway.
    return counts.where(fitting).join(F.broadcast(bounds), ["lang", "size"]).where("n >= least")


@dataclass(frozen=True)
class Model:
    """Languages in code-point order, and per size of feature a row of scores for each feature."""

    languages: list[str]
    usual: int
    usual_share: float
    rows: list[dict[str, int]]
    scores: list[np.ndarray]


class Judge:
    """A model in use. Unseen words keep what their n-grams gave them, while there is room."""

    def __init__(self, model: Model):
        self.model = model
        self._forget(REMEMBERED)

    def _forget(self, room: int) -> None:
        known = self.model.scores[0]
        self.scores = np.concatenate([known, np.zeros((room, known.shape[1]), np.float32)])
        self.rows, self.used = dict(self.model.rows[0]), len(known)

    def _learn(self, words: list[str]) -> None:
        """Score words that the model does not have by the mean over their longest known n-grams."""
        left = words
        for size in range(LONGEST_GRAM, 0, -1):
            get = self.model.rows[size].get
            found = [[row for gram in grams_in(word, size) if (row := get(gram)) is not None] for word in left]
            judged = [word for word, rows in zip(left, found, strict=True) if rows]
            left = [word for word, rows in zip(left, found, strict=True) if not rows]
            if judged:
                lengths = np.array([len(rows) for rows in found if rows])
                flat = np.fromiter(chain.from_iterable(found), np.int64, lengths.sum())
                sums = np.add.reduceat(self.model.scores[size][flat], np.cumsum(lengths) - lengths, dtype=np.float64)
                last = self.used + len(judged)
                self.scores[self.used : last] = sums / lengths[:, None]
                self.rows.update(zip(judged, range(self.used, last), strict=True))
                self.used = last
        self.rows.update(dict.fromkeys(left, -1))  # no letter of theirs is known

    def identify(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The best language of each text and its share of the likelihood of an average word."""
        counted = [Counter(words_in(text)) for text in texts]
        every = set().union(*counted)
        unseen = [word for word in every if word not in self.rows]
        if self.used + len(unseen) > len(self.scores):
            self._forget(max(REMEMBERED, len(every)))
            unseen = [word for word in every if word not in self.rows]
        if unseen:
            self._learn(unseen)
        return [self._best(words) for words in counted]

    def _best(self, words: Counter) -> tuple[str, float]:
        if not words:
            return UNKNOWN, 0.0
        rows = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        times = np.fromiter(words.values(), np.float64, len(words))
        if rows.min() < 0:
            rows, times = rows[rows >= 0], times[rows >= 0]
            if not len(rows):
                return self.model.languages[self.model.usual], self.model.usual_share
        mean = (times @ self.scores[rows]) / times.sum()
        best = int(np.argmin(mean))
        return self.model.languages[best], float(1.0 / np.sum(10.0 ** (mean[best] - mean)))


def learned(texts: DataFrame) -> Model:
    """The model of the rows of texts (lang, text) whose lang is not null.

    Counts cover all of them. What comes to the driver is the model, whose size has a
    bound: for n languages at most n * (WORDS + 5 * GRAMS) features and CELLS scores of
    each size. Rows without text or letters teach nothing; without any words there are no
    languages.
    """
    counts = feature_counts(texts.where("lang IS NOT NULL"))
    sums = counts.where("size = 0").groupBy("lang").agg(F.sum("n").alias("n")).collect()
    sizes = sorted((r.lang, r.n) for r in sums)
    languages = [lang for lang, _ in sizes]
    if not languages:
        return Model([], 0, 0.0, [], [])
    place = {lang: k for k, lang in enumerate(languages)}
    usual = max(range(len(sizes)), key=lambda k: (sizes[k][1], -k))
    kept = _kept(counts, len(languages)).select("lang", "size", "feature", "n", "total").toArrow()
    rows: list[dict[str, int]] = []
    scores = []
    size_of = kept["size"].to_numpy()
    for size in range(LONGEST_GRAM + 1):
        part = kept.filter(pa.array(size_of == size))
        features = part["feature"].to_pylist()
        # Rows in the order of the features, so that sums are the same in every run.
        row = {feature: k for k, feature in enumerate(sorted(set(features)))}
        own = -np.log10(part["n"].to_numpy() / part["total"].to_numpy())
        table = np.full((len(row), len(languages)), own.max(initial=0.0) + PENALTY, np.float32)
        table[[row[f] for f in features], [place[lang] for lang in part["lang"].to_pylist()]] = own
        rows.append(row)
        scores.append(table)
    share = sizes[usual][1] / sum(n for _, n in sizes)
    return Model(languages, usual, share, rows, scores)


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of docs but text, then lang_pred and score (0 to 1), from text alone.

    `und` and 0 for a text that is null or has no letter, and where nothing was learned. A
    text whose letters the model has never met gets the language with most words, and its
    share of them. Of equal languages the first in code-point order is taken. Rows are
    answered one by one, repeated or not, and an empty table gives an empty result. Columns
    of docs that are called lang_pred or score give way to the new ones.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    other = [c for c in docs.columns if c not in ("text", "lang_pred", "score")]
    source = docs.select(*(F.col(f"`{c}`") for c in other), "text")
    schema = source.drop("text").schema.add("lang_pred", "string").add("score", "double")

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value) if shared.value.languages else None
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            answers: list[tuple[str, float]] = []
            for first in range(0, len(texts), TOGETHER):
                part = texts[first : first + TOGETHER]
                answers += judge.identify(part) if judge else [(UNKNOWN, 0.0)] * len(part)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array([lang for lang, _ in answers], pa.string()),
                    pa.array([score for _, score in answers], pa.float64()),
                ],
                [*other, "lang_pred", "score"],
            )

    return source.mapInArrow(identify, schema)
