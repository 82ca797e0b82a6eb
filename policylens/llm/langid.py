"""Language ID by word-first backoff.

Words that a language uses often enough are scored by their log frequency in
each language.  A word that no language knows is scored by its character
n-grams: at every place by the longest one known, falling back from four
characters to one.  Word counts cover all training texts; the model keeps the
words that make up at least ``MIN_SHARE`` of a language's words, so at most
``1 / MIN_SHARE`` per language whatever the corpus, and that is what may be
sent to every task.  The n-grams are fitted on at most ``FIT_WORDS`` distinct
words per language, chosen by hash; they stand for words not seen before, so
each counts once.

Defined results: ``und`` with score 0 for a null text, a text without letters,
or when there was nothing to learn from.  Rows whose training language is null
teach nothing.  Equal texts, repeated rows too, get equal results; on ties the
first language in code-point order wins.  Very long texts and words are read
whole, in parts.  An empty table gives no rows.  An extra column named as an
output is replaced by it; all others are carried as they are.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from policylens.llm.common import stage, with_results
from policylens.llm.tokens import is_latin

UNKNOWN = "und"
MIN_SHARE = 1e-5
FIT_WORDS = 20_000
LONGEST = 4
# Distinct words a task counts before it hands its counts on.
FLUSH = 300_000
REMEMBERED = 400_000
# N-grams that are added up at once.
PLACES = 1 << 17

_latin_words = re.compile("[a-zªµºß-öø-ÿ]+").findall
_any_words = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall


def letters_words(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    if not text:
        return []
    text = text.lower()
    return _latin_words(text) if is_latin(text) else _any_words(text)


def grams(word: str, size: int) -> list[str]:
    padded = f"<{word}>"
    return [padded[i:i + size] for i in range(len(padded) - size + 1)]


@dataclass
class LanguageModel:
    """Log frequencies: ``words`` and ``pieces`` map to rows with a column per language."""

    languages: list[str]
    words: dict[str, np.ndarray]
    pieces: dict[str, np.ndarray]
    unseen: np.ndarray
    rows: dict[str, int] = field(default_factory=dict)
    table: np.ndarray | None = None
    known_pieces: dict[str, int] = field(default_factory=dict)
    spelling: np.ndarray | None = None

    def _places(self, word: str) -> list[int]:
        """Rows of ``spelling``: at each place the longest n-gram known, ``unseen`` (the last row) if none is."""
        padded, find, none = f"<{word}>", self.known_pieces.get, len(self.known_pieces)
        out = []
        for i in range(len(padded) - 1):
            for end in range(i + LONGEST, i, -1):
                at = find(padded[i:end])
                if at is not None:
                    break
            out.append(none if at is None else at)
        return out

    def _remember(self, new: list[str]) -> None:
        """Give each word of ``new`` its row: its own frequencies, or what its pieces add up to."""
        if self.spelling is None:
            self.known_pieces = {piece: at for at, piece in enumerate(self.pieces)}
            self.spelling = np.array([*(found / len(piece) for piece, found in self.pieces.items()), self.unseen])
        have = len(self.rows)
        if self.table is None or have + len(new) > len(self.table):
            grown = np.empty((2 * have + len(new) + 1024, len(self.languages)))
            grown[:have] = self.table[:have] if self.table is not None else 0
            self.table = grown
        rows, at, starts = [], [], []

        def add_up() -> None:
            if rows:
                np.add.at(self.table, rows, np.add.reduceat(self.spelling[at], starts, axis=0))
                for part in (rows, at, starts):
                    part.clear()

        for row, word in enumerate(new, have):
            self.rows[word] = row
            known = self.words.get(word)
            self.table[row] = 0.0 if known is None else known
            if known is not None:
                continue
            places = self._places(word)
            for start in range(0, len(places), PLACES):     # a very long word in parts
                rows.append(row)
                starts.append(len(at))
                at += places[start:start + PLACES]
                if len(at) >= PLACES:
                    add_up()
        add_up()

    def predict(self, text: str | None) -> tuple[str, float]:
        found = letters_words(text)
        if not found or not self.languages:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.languages))
        for start in range(0, len(found), REMEMBERED // 4):
            part = found[start:start + REMEMBERED // 4]
            try:
                at = list(map(self.rows.__getitem__, part))
            except KeyError:
                if len(self.rows) + len(set(part)) > REMEMBERED:
                    self.rows.clear()
                self._remember([word for word in set(part) if word not in self.rows])
                at = list(map(self.rows.__getitem__, part))
            total += self.table[at].sum(axis=0)
        best = int(total.argmax())
        return self.languages[best], float(1.0 / np.exp(total - total[best]).sum())


def word_counts(training: DataFrame) -> DataFrame:
    """(lang, word, n) over all of ``training`` (text, lang); each task counts before the shuffle."""
    schema = StructType([StructField("lang", StringType()), StructField("word", StringType()),
                         StructField("n", LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counter in seen.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counter), pa.string()), pa.array(list(counter), pa.string()),
                     pa.array(list(counter.values()), pa.int64())], names=schema.names)
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seen[lang].update(letters_words(text))
            if sum(map(len, seen.values())) > FLUSH:
                yield from flush()
        yield from flush()

    rows = training.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    return rows.mapInArrow(run, schema).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(training: DataFrame, min_share: float = MIN_SHARE, fit_words: int = FIT_WORDS) -> LanguageModel:
    """Learn from ``training`` (text, lang)."""
    counts = stage(word_counts(training), "word-counts")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return LanguageModel([], {}, {}, np.zeros(0))
    size = np.array([totals[x] for x in languages], float)
    column = {x: i for i, x in enumerate(languages)}
    of_lang = counts.join(F.broadcast(counts.sparkSession.createDataFrame(
        [(x, float(n)) for x, n in totals.items()], "lang string, total double")), "lang")
    often = of_lang.where(F.col("n") >= F.greatest(F.lit(2.0), F.col("total") * min_share)).select("word").distinct()
    kept: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(languages)))
    for word, lang, n in zip(*counts.join(often, "word").select("word", "lang", "n").toArrow().to_pydict().values(),
                             strict=True):
        kept[word][column[lang]] = n
    # smoothed by half an occurrence each
    words = {w: np.log((c + 0.5) / (size + 0.5 * len(kept))) for w, c in kept.items()}

    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("word"), "word"))
    # a threshold on the hash thins each language to about twice the bound before the exact cut
    distinct = counts.groupBy("lang").agg(F.count(F.lit(1)).alias("distinct"))
    thinned = counts.join(F.broadcast(distinct), "lang").where(
        F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < F.lit(2.0 * fit_words * (1 << 30)) / F.col("distinct"))
    fit = thinned.withColumn("_place", place).where(F.col("_place") <= fit_words).select("lang", "word").collect()
    tallies: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(languages)))
    sums = np.zeros((LONGEST + 1, len(languages)))
    for r in fit:
        for n in range(1, LONGEST + 1):
            for g in grams(r["word"], n):
                tallies[g][column[r["lang"]]] += 1
            sums[n, column[r["lang"]]] += max(0, len(r["word"]) + 3 - n)
    sorts = Counter(map(len, tallies))
    pieces = {g: np.log((c + 0.5) / (sums[len(g)] + 0.5 * sorts[len(g)] + 1)) for g, c in tallies.items()}
    return LanguageModel(languages, words, pieces, np.log(0.5 / (sums[1] + 0.5 * sorts[1] + 1)))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` without ``text``, with ``lang_pred`` and ``score`` for it, which replace columns of these names."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)           # bounded: see the module's text
    schema = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = shared.value.predict
        for batch in batches:
            found = [predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("carried"), pa.array([x for x, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())], names=["carried", *schema.names])

    return with_results(docs, run, schema)


def in_a_language(docs: DataFrame, model: LanguageModel, at_least: float = 0.5) -> DataFrame:
    """``docs`` that are in one of the model's languages: not ``und``, and no
    more doubtful than ``at_least``.  With nothing learned, all stay."""
    if not model.languages:
        return docs
    columns = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col("text"))
    kept = identify(packed, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= at_least))
    return kept.select(*[F.col(f"doc.`{c}`").alias(c) for c in columns])
