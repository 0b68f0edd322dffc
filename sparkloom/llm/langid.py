"""Language ID by word-first backoff to character n-grams."""

import array
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, give_back, hash_bound, mark, materialise, small_batches

#: Labelled documents of each language that a model is fitted on (documented bound of the sample).
SAMPLE = 8000
#: Languages that a model has at most.
LANGUAGES = 1000
#: Characters of the longest n-gram.
LONGEST = 4
WORD = re.compile(r"[^\W\d_]+")


class Counts:
    """Keys with their counts by language; keys of the same kind with the same counts share a row."""

    def __init__(self, rows: Iterable[tuple[str, int, str]] = (), langs: int = 0) -> None:
        """Rows of a key, its kind, and its counts as text: place of the language, `:` and count, with `,` between."""
        self.keys: list[str] = []
        own, times = array.array("i"), array.array("q")
        at: dict[tuple[int, str], int] = {}
        for key, kind, counts in rows:
            row = at.setdefault((kind, counts), len(at))
            self.keys.append(key)
            own.append(row)
            if row == len(times):
                times.append(0)
            times[row] += 1
        self.own, self.times, self.kinds = np.array(own, np.int32), np.array(times, np.float64), np.array([k for k, _ in at], np.int64)
        self.rows = np.zeros((len(at), langs))
        for (_, counts), row in at.items():
            for place, n in (x.split(":") for x in counts.split(",")):
                self.rows[row, int(place)] = int(n)


class Model:
    """Log frequencies by language of words, and of n-grams for words that are not known."""

    def __init__(self, langs: list[str], documents: list[int], words: "Counts", grams: "Counts", cache: int = 50_000) -> None:
        self.langs = langs
        #: Words that are looked up at once, and unknown ones that are remembered at most.
        self.cache = max(1, min(cache, 2_000_000 // max(1, len(langs))))
        self.prior = int(np.argmax(documents)) if langs else 0
        self.words, self.scores = dict(zip(words.keys, words.own.tolist(), strict=True)), self._log(words.rows, words.times)
        self.grams = np.array(grams.keys, f"<U{LONGEST}")  # sorted, 16 bytes each
        order = np.argsort(self.grams)
        self.grams, self.gram_rows = self.grams[order], grams.own[order]
        self.gram_scores = np.zeros_like(grams.rows)
        for n in range(1, LONGEST + 1):  # frequencies among n-grams of the same length
            at = grams.kinds == n
            self.gram_scores[at] = self._log(grams.rows[at], grams.times[at])
        self.added: list[str] = []
        self.table: np.ndarray | None = None

    @staticmethod
    def _log(counts: np.ndarray, times: np.ndarray) -> np.ndarray:
        if not counts.size:
            return counts
        logs = np.log((counts + 0.5) / ((counts * times[:, None]).sum(axis=0) + 0.5 * times.sum()))
        return logs - logs.max(axis=1, keepdims=True)

    def unknown(self, words: list[str]) -> np.ndarray:
        """Scores of unseen words: of each, the mean over its known n-grams of the longest length that has any."""
        out, left = np.zeros((len(words), len(self.langs))), np.arange(len(words))
        for n in range(LONGEST, 0, -1):
            if not len(left) or not len(self.grams):
                break
            texts = [f" {words[i]} " if n > 1 else words[i] for i in left.tolist()]
            of = np.repeat(np.arange(len(texts)), [max(0, len(t) - n + 1) for t in texts])
            asked = np.array([t[i : i + n] for t in texts for i in range(len(t) - n + 1)], self.grams.dtype)
            at = np.minimum(np.searchsorted(self.grams, asked), len(self.grams) - 1)
            known = self.grams[at] == asked
            of, rows = of[known], self.gram_rows[at[known]]
            times = np.bincount(of, minlength=len(texts))
            for k in range(len(self.langs)):
                out[left, k] += np.bincount(of, weights=self.gram_scores[rows, k], minlength=len(texts)) / np.maximum(times, 1)
            left = left[times == 0]
        return out

    def totals(self, texts: list[list[str]]) -> np.ndarray:
        """The sum of the scores of each text's words; every text has some."""
        total, at = np.zeros((len(texts), len(self.langs))), 0
        while at < len(texts):
            to, n = at + 1, len(texts[at])
            while to < len(texts) and n + len(texts[to]) <= self.cache:
                n += len(texts[to])
                to += 1
            if to == at + 1:  # perhaps a very long text, in pieces
                for low in range(0, n, self.cache):
                    total[at] += self._looked_up(texts[at][low : low + self.cache]).sum(axis=0)
            else:
                starts = np.cumsum([0, *map(len, texts[at : to - 1])])
                total[at:to] = np.add.reduceat(self._looked_up(list(chain.from_iterable(texts[at:to]))), starts)
            at = to
        return total

    def _looked_up(self, words: list[str]) -> np.ndarray:
        """Scores of at most `cache` words. Unknown words get rows behind the known ones' until their room is full."""
        if self.table is None:
            self.table = np.concatenate([self.scores, np.zeros((self.cache, len(self.langs)))])
        new = sorted(set(words).difference(self.words))
        if len(self.added) + len(new) > self.cache:
            for word in self.added:
                del self.words[word]
            self.added.clear()
            new = sorted(set(words).difference(self.words))
        if new:
            first = len(self.scores) + len(self.added)
            self.table[first : first + len(new)] = self.unknown(new)
            self.words.update(zip(new, range(first, first + len(new)), strict=True))
            self.added += new
        return self.table[np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text."""
        found = [WORD.findall(t.lower()) if t and self.langs else [] for t in texts]
        some = [i for i, w in enumerate(found) if w]
        total = self.totals([found[i] for i in some])
        best = total.argmax(axis=1) if len(some) else np.zeros(0, np.int64)
        odds = np.exp(total - total.max(axis=1, keepdims=True, initial=-np.inf))
        share = 1.0 / odds.sum(axis=1)
        out = [("und", 0.0)] * len(texts)
        for i, k, x, level in zip(some, best.tolist(), share.tolist(), (total == total[:, :1]).all(axis=1).tolist(), strict=True):
            if any(map(str.isalpha, texts[i])):
                out[i] = (self.langs[self.prior], 1.0 / len(self.langs)) if level else (self.langs[k], x)
        return out


def _grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams by language over distinct words with their counts."""
    total: dict[tuple[str, str], int] = {}
    names = ["lang", "gram", "n"]

    def out() -> pa.RecordBatch:
        rows = list(total.items())
        total.clear()
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], names=names)

    for batch in batches:
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            padded = f" {word} "
            for size in range(1, LONGEST + 1):
                text = padded if size > 1 else word
                for at in range(0, len(text) - size + 1, 50_000):
                    for i in range(at, min(at + 50_000, len(text) - size + 1)):
                        key = (lang, text[i : i + size])
                        total[key] = total.get(key, 0) + n
                    if len(total) > 300_000:  # also within a long word
                        yield out()
    if total:
        yield out()


def _gathered(counts: DataFrame, key: str, kind: Column, langs: list[str]) -> Counts:
    """All keys with their counts by language."""
    place = F.element_at(F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)]), F.col("lang"))
    text = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", place, F.col("n")))), ",")
    return Counts(((r[0], r[1], r[2]) for r in counts.groupBy(key).agg(kind, text).toLocalIterator()), len(langs))


def fit(spark: SparkSession, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE, most_langs: int = LANGUAGES) -> Model:
    """Fits on about so many labelled documents of each language, chosen by a hash of the id.

    Rows without text or language are left out. Words and n-grams are counted by Spark; all of the sample's come to
    the driver: the sample alone bounds the model. A column with more than most_langs languages is no column of
    languages and raises ValueError.
    """
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.lit("langid"), F.col(id_col)).bitwiseAND((1 << 63) - 1).alias("_u"))
    sizes = dict(sorted((r[0], r[1]) for r in labelled.groupBy("lang").count().limit(most_langs + 1).collect()))
    langs = list(sizes)
    small_batches(spark)
    if len(langs) > most_langs:
        raise ValueError(f"more than {most_langs} languages")
    if not langs:
        return Model([], [], Counts(), Counts())
    share = F.element_at(F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(hash_bound(sample, n)))]), F.col("lang"))
    chosen = labelled.filter(F.col("_u") <= share)
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)[^\W\d_]+"), F.lit(0))).alias("word")
    counts = chosen.select("lang", word).groupBy("lang", "word").agg(F.count("*").alias("n"))
    begun = mark()
    counts = materialise(spark, counts, "words")
    words = _gathered(counts, "word", F.lit(0), langs)
    grams = counts.select("lang", "word", "n").mapInArrow(_grams, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    model = Model(langs, list(sizes.values()), words, _gathered(grams, "gram", F.length("gram"), langs))
    discard(spark, begun, begun + 1)
    return model


def detector(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """The model as a function of a text column: struct(lang_pred, score). Other columns of a row stay in the JVM."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def detect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            got = [x for at in range(0, len(texts), 1000) for x in shared.value.predict(texts.slice(at, 1000).to_pylist())]
            yield pa.StructArray.from_arrays([pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())], names=["lang_pred", "score"])
        give_back()

    # Not to be computed again for each use of the result.
    return F.arrow_udf(detect, "lang_pred string, score double").asNondeterministic()


def identify(spark: SparkSession, docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Columns keep, lang_pred and score of each row of docs; only the text decides.

    A document's score of a language is the sum over its words of the word's log frequency, or, for a word that
    is not known, the mean log frequency of its longest known n-grams; score is the share of the best language
    among all. Texts that are null or have no letter are `und` with score 0. A text in which nothing is known gets
    the language with most documents. Equal scores go to the first language by code point. Repeated rows keep a
    row each; empty tables give empty ones; columns that are not named are not read, and the text may also be kept.
    """
    rows = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], detector(spark, model)(F.col(text_col).cast("string")).alias("_found"))
    return rows.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "_found.lang_pred", "_found.score")
