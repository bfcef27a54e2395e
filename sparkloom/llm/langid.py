"""Language identification: script ranges, learned per-word scores, and Viterbi over the words of a text.

A word's score for a language is its naive Bayes log-likelihood from character n-grams; languages that don't use the
word's script are no candidates for it. Viterbi with a penalty for each switch then labels every word, so that a text
of several languages falls into spans. A text's language is the one with the most labelled words.

Defined results: a null text, or one without a letter, is ``und`` with score 0; with nothing to learn from, so is every
text; ties go to the language first in code point order; repeated rows and any length are treated alike; an empty table
gives no rows. Extra columns are ignored, and ``lang`` is read of training rows only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sparkloom.llm.common import give_back, hold, slices, spread

#: Documented bound of the fitted sample: rows a language.
SAMPLE_A_LANGUAGE = 1500
#: Letter pairs and triples are counted in so many buckets; a model takes this many floats a language.
BUCKETS = 1 << 17
SWITCH_PENALTY = 6.0
SCRIPT_SHARE = 0.01
NO_SCRIPT_SCORE = -30.0
#: Words (and their characters) whose scores are kept a worker, words labelled at once, and numbers of a padded
#: block: memory bounds without effect on results.
MAX_WORDS = 200_000
MAX_CHARS = 1 << 23
WORDS_AT_ONCE = 1 << 18
CELLS = 1 << 22
LONG_TEXT = 1 << 22
WORD = re.compile(r"\S+")
#: A part of the hashes that holds more samples than this is counted by finer parts.
MANY_SAMPLES = 8

#: First code point of a range and the script from there on.
SCRIPT_RANGES = [
    (0x0, "Latin"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"), (0x590, "Hebrew"), (0x600, "Arabic"), (0x780, "Other"),
    (0x900, "Devanagari"), (0x980, "Bengali"), (0xA00, "Other"), (0xB80, "Tamil"), (0xC00, "Other"), (0xE00, "Thai"), (0xE80, "Other"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1380, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"),
    (0x2C60, "Latin"), (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Other"), (0x3400, "Han"), (0xA000, "Other"), (0xA720, "Latin"),
    (0xA800, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Other"), (0x20000, "Han"), (0x323B0, "Other"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})
_STARTS = np.array([start for start, _ in SCRIPT_RANGES])
_NUMBERS = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES])
BREAK = 10  # between words; no word holds it


def scripts_of(points: np.ndarray) -> np.ndarray:
    """Number in SCRIPTS of each code point's script."""
    return _NUMBERS[np.searchsorted(_STARTS, points, side="right") - 1]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Spelled(NamedTuple):
    """Words as letters: for each letter its word, script and the buckets of the pair and triple that it ends and centres."""

    word: np.ndarray
    script: np.ndarray
    pair: np.ndarray
    triple: np.ndarray


def spell(words: list[str]) -> Spelled:
    """Lower-case letters of the words; other characters don't count, a word's edges do."""
    joined = ("\n" + "\n".join(words) + "\n").lower().encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(joined, "<u4")
    ends = points == BREAK
    keep = _letters()[points] | ends
    word = (np.cumsum(ends) - 1)[keep]
    c = points[keep]
    at = np.flatnonzero(c != BREAK)
    a, b, d = (x.astype(np.uint64) for x in (c[at - 1], c[at], c[at + 1]))
    pair = (a * np.uint64(0x9E3779B1) + b * np.uint64(0x85EBCA77)) & np.uint64(0xFFFFFFFF)
    triple = (pair * np.uint64(0xC2B2AE3D) + d * np.uint64(0x27D4EB2F) + np.uint64(1)) & np.uint64(0xFFFFFFFF)
    shift = np.uint64(32 - BUCKETS.bit_length() + 1)
    return Spelled(word[at], scripts_of(c[at]), (pair >> shift).astype(np.int64), (triple >> shift).astype(np.int64))


def held_out(row_id: Column) -> Column:
    """True for the documents that must not be learned from."""
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class LanguageModel:
    languages: list[str]
    #: (BUCKETS, languages) log-likelihoods.
    logs: np.ndarray
    #: (scripts, languages): who uses what.
    uses: np.ndarray
    words: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    filled: int = 0
    chars: int = 0

    def __getstate__(self) -> dict:
        return self.__dict__ | {"words": {}, "scores": np.zeros((0, 0), np.float32), "filled": 0, "chars": 0}

    def _score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(words, languages) scores relative to each word's best, and whether the word has a letter."""
        spelled = spell(words)
        lengths = np.bincount(spelled.word, minlength=len(words))
        has = lengths > 0
        scores = np.zeros((len(words), len(self.languages)), np.float32)
        if has.any():
            starts = (np.cumsum(lengths) - lengths)[has]
            scores[has] = np.add.reduceat(self.logs[spelled.pair] + self.logs[spelled.triple], starts, axis=0)
        kinds = np.bincount(spelled.word * len(SCRIPTS) + spelled.script, minlength=len(words) * len(SCRIPTS)).reshape(len(words), -1)
        allowed = self.uses[kinds.argmax(axis=1)]
        scores[~allowed & allowed.any(axis=1, keepdims=True) & has[:, None]] = -np.inf
        scores -= scores.max(axis=1, keepdims=True)
        return np.maximum(scores, np.float32(NO_SCRIPT_SCORE)), has

    def _learn(self, words: set[str]) -> None:
        missing = list(words.difference(self.words))
        if not missing:
            return
        scores, has = self._score(missing)
        base, self.filled = self.filled, self.filled + int(has.sum())
        while self.filled > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        self.scores[base : self.filled] = scores[has]
        rows = np.where(has, base + np.cumsum(has) - 1, 0)  # row 0 is for words without a letter
        self.words.update(zip(missing, rows.tolist()))
        self.chars += sum(map(len, missing))

    def forget(self) -> None:
        """Give up the words' scores."""
        self.words, self.scores, self.filled, self.chars = {}, np.zeros((0, 0), np.float32), 0, 0

    def _room(self) -> None:
        if not self.filled or len(self.words) > MAX_WORDS or self.chars > MAX_CHARS:
            self.words, self.scores, self.filled, self.chars = {}, np.zeros((4096, len(self.languages)), np.float32), 1, 0

    def label(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text, the language number of every word, -1 where a word has no letter."""
        if not self.languages:
            return [np.full(len((t or "").split()), -1, np.int32) for t in texts]
        found: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        waiting: list[tuple[int, list[str]]] = []
        n = 0
        for i, text in enumerate(texts):
            if text and len(text) > LONG_TEXT:
                self._label_long(i, text, found)
                continue
            words = (text or "").split()
            if waiting and n + len(words) > WORDS_AT_ONCE:
                self._label(waiting, found)
                waiting, n = [], 0
            if words:
                waiting.append((i, words))
                n += len(words)
        self._label(waiting, found)
        return found

    def _rows(self, words: list[str]) -> np.ndarray:
        """Rows of ``scores`` for words that have been learned."""
        return np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))

    def rows_of(self, words: list[str]) -> np.ndarray:
        """Rows of ``scores`` for the words."""
        self._room()
        self._learn(set(words))
        return self._rows(words)

    def _label(self, texts: list[tuple[int, list[str]]], found: list[np.ndarray]) -> None:
        self._room()
        self._learn(set().union(*(words for _, words in texts)))
        self._paths([(i, self._rows(words)) for i, words in texts], found)

    def _label_long(self, i: int, text: str, found: list[np.ndarray]) -> None:
        """A text whose words are too many to hold as strings: as rows of scores they take four bytes each."""
        self._room()
        rows: list[np.ndarray] = []
        matches = WORD.finditer(text)
        while words := [m[0] for m in islice(matches, WORDS_AT_ONCE)]:
            self._learn(set(words))
            rows.append(self._rows(words))
        if rows:
            self._paths([(i, np.concatenate(rows))], found)

    def _paths(self, texts: list[tuple[int, np.ndarray]], found: list[np.ndarray]) -> None:
        """Texts for which one language throughout is best are done at once: any switch costs more than its loss."""
        hard = []
        for i, r in texts:
            loss = sum((self.scores[r[at : at + WORDS_AT_ONCE]].sum(axis=0) for at in range(0, len(r), WORDS_AT_ONCE)), np.zeros(len(self.languages), np.float32))
            top = int(loss.argmax())
            if loss[top] >= -SWITCH_PENALTY:
                found[i] = np.where(r == 0, -1, top).astype(np.int32)
            else:
                hard.append((i, r))
        hard.sort(key=lambda x: len(x[1]))
        block: list[tuple[int, np.ndarray]] = []
        for item in hard:
            if block and (len(block) + 1) * len(item[1]) * len(self.languages) > CELLS:
                self._viterbi(block, found)
                block = []
            block.append(item)
        if block:
            self._viterbi(block, found)

    def _forward(self, rows: np.ndarray, scores: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each step, which states may be stayed in and the best one before it; and the scores after the last."""
        langs, docs = best.shape
        stays = np.empty((len(rows), langs, docs), bool)
        tops = np.empty((len(rows), docs), np.int32)
        best = best.copy()
        low = np.float32(-SWITCH_PENALTY)
        for t in range(len(rows)):
            np.greater_equal(best, low, out=stays[t])
            tops[t] = best.argmax(axis=0)
            np.maximum(best, low, out=best)
            best += scores.take(rows[t], axis=1)
            best -= best.max(axis=0)
        return stays, tops, best

    def _viterbi(self, block: list[tuple[int, np.ndarray]], found: list[np.ndarray]) -> None:
        """Best paths of a block of texts, all of them a word further at each step.

        A text of more steps than CELLS allows goes forward once for the scores at every so many steps, and backward
        over these stretches, each computed again: the same paths, in bounded memory.
        """
        lengths = np.array([len(r) for _, r in block])
        steps, docs, langs = int(lengths.max()), len(block), len(self.languages)
        rows = np.zeros((steps, docs), np.int32)
        for k, (_, r) in enumerate(block):
            rows[: len(r), k] = r
        scores = np.ascontiguousarray(self.scores[: self.filled].T)
        stretch = max(1, min(steps, CELLS // (langs * docs)))
        starts = range(0, steps, stretch)
        best = np.zeros((langs, docs), np.float32)  # relative to the best: a switch starts from -penalty
        bests = []
        for at in starts:
            bests.append(best)
            stays, tops, best = self._forward(rows[at : at + stretch], scores, best)
        labels = np.empty((steps, docs), np.int32)
        state = best.argmax(axis=0).astype(np.int32)
        # beyond a text's end the words score nothing and the best state stays, so walking back through them keeps it
        each = np.arange(docs)
        for at, before in zip(reversed(starts), reversed(bests)):
            if at != starts[-1]:
                stays, tops, _ = self._forward(rows[at : at + stretch], scores, before)
            for t in range(len(stays) - 1, -1, -1):
                labels[at + t] = state
                state = np.where(stays[t][state, each], state, tops[t])
        labels[rows == 0] = -1
        for k, (i, r) in enumerate(block):
            found[i] = labels[: len(r), k].copy()

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """(first word, word after the last, language) of each stretch of one language; letterless words join the stretch before."""
        out: list[tuple[int, int, str]] = []
        for i, code in enumerate(self.label([text])[0]):
            name = self.languages[code] if code >= 0 else (out[-1][2] if out else "und")
            if out and out[-1][2] == name:
                out[-1] = (out[-1][0], i + 1, name)
            else:
                out.append((i, i + 1, name))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[int]]:
        """Language, share of the lettered words that carry it, and number of spans."""
        names, scores, spans = [], [], []
        for codes in self.label(texts):
            codes = codes[codes >= 0]
            if not len(codes):
                names.append("und"), scores.append(0.0), spans.append(0)
                continue
            counts = np.bincount(codes, minlength=len(self.languages))
            top = int(counts.argmax())
            names.append(self.languages[top]), scores.append(float(counts[top] / len(codes))), spans.append(int((codes[1:] != codes[:-1]).sum()) + 1)
        return names, scores, spans


def _sample_limits(known: DataFrame, sample: int) -> dict[str, int]:
    """For each language the hash up to which its ``sample`` smallest lie. known: lang, h.

    Rows are counted by leading bits of the hash, finer where a part holds many, so that only counts are shuffled and
    a language with most of all rows is no task of its own; the last few thousand hashes are ranked exactly.
    """
    ahead = F.sum("n").over(Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shift, parts, before = 48, known.select("lang", "h"), {}
    while True:
        counts = parts.groupBy("lang", F.shiftright("h", shift).alias("part")).agg(F.count(F.lit(1)).alias("n"))
        crossing = counts.withColumn("ahead", F.coalesce(ahead, F.lit(0)) + _by_language(before, 0)).where(F.col("ahead") < sample)
        last = crossing.groupBy("lang").agg(F.max_by(F.struct("part", "n", "ahead"), "part").alias("last")).select("lang", "last.*").collect()
        ends = {r["lang"]: r["part"] for r in last}
        if shift == 0:
            return ends
        many = [r for r in last if r["n"] > MANY_SAMPLES * sample]
        if not many:
            bound = known.select("lang", "h").where(F.shiftright("h", shift) <= _by_language(ends, None))
            hashes = bound.groupBy("lang", F.col("h").alias("part")).agg(F.count(F.lit(1)).alias("n")).withColumn("ahead", F.coalesce(ahead, F.lit(0)))
            return {r["lang"]: r["h"] for r in hashes.where(F.col("ahead") < sample).groupBy("lang").agg(F.max("part").alias("h")).collect()}
        # only the part in which the sample ends is looked at more closely
        before = {r["lang"]: r["ahead"] for r in last}
        parts = parts.where(F.shiftright("h", shift) == _by_language(ends, None))
        shift = max(0, shift - 16)


def _by_language(values: dict, default: int | None) -> Column:
    if not values:
        return F.lit(default)
    found = F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("lang"))
    return found if default is None else F.coalesce(found, F.lit(default))


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_A_LANGUAGE) -> LanguageModel:
    """Fit on a documented sample: the ``sample`` labelled rows of each language with the smallest id hash.

    Scans of ids and labels find the hash below which a language's sample lies; one of the sampled texts follows,
    which leave their tasks as bucket counts. The driver gets one row a language, then BUCKETS counts for each at most.
    Rows of equal ids are in or out together.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where(~held_out(F.col("id")) & F.col("lang").isNotNull())
    known = known.withColumn("h", F.xxhash64(F.col("id").cast("string"), F.lit("sample")))
    limits = _sample_limits(known, sample)
    if not limits:
        return fit([], [], [], [])
    chosen = known.where(F.col("h") <= _by_language(limits, None)).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("langid")
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = seen.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                words = (text or "").split()
                for at in range(0, len(words), WORDS_AT_ONCE):
                    spelled = spell(words[at : at + WORDS_AT_ONCE])
                    for slots in (spelled.pair, spelled.triple, BUCKETS + spelled.script):
                        own += np.bincount(slots, minlength=len(own))
        for lang, own in seen.items():
            slots = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slots), pa.string()), pa.array(slots, pa.int32()), pa.array(own[slots], pa.int64())], ["lang", "slot", "n"])

    counts = chosen.mapInArrow(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    return fit(counts["lang"], counts["slot"], counts["n"], sorted(limits))


def fit(langs: list[str], slots: list[int], counts: list[int], languages: list[str]) -> LanguageModel:
    """Smoothed log-likelihoods from (language, slot, count) rows; slots from BUCKETS on are scripts."""
    number = {name: i for i, name in enumerate(languages)}
    table = np.zeros((BUCKETS + len(SCRIPTS), len(languages)))
    table[np.array(slots, np.int64), np.array([number[x] for x in langs], np.int64)] = counts
    grams, letters = table[:BUCKETS] + 0.5, table[BUCKETS:]
    # buckets overlap in what they say: halve it, so that the penalty is weighed against about one vote a letter
    logs = (np.log(grams / grams.sum(axis=0)) / 2).astype(np.float32)
    return LanguageModel(languages, logs, letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=0), 1))


def identify_languages(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_spans. A map over the scan; the model, bounded by its parameters, goes with the task."""
    source = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        hold("langid", m.forget)
        for batch in slices(batches):
            names, scores, spans = m.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, pa.int32())],
                ["doc_id", "held_out", "lang_pred", "score", "n_spans"],
            )

    return spread(source).mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double, n_spans int")


def known_language(docs: DataFrame, model: LanguageModel, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose text has a language; ``und`` rows go. One pass, no join.

    All columns stay as they are, but that a null in ``lang_col``, where there is such a column of strings, becomes the
    language found: what is stated is never overruled.
    """
    at = docs.columns.index(text_col)
    filled = docs.columns.index(lang_col) if lang_col in docs.columns and docs.schema[lang_col].dataType == StringType() else -1
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        hold("langid", m.forget)
        for batch in slices(batches):
            names, _, _ = m.predict(batch.column(at).to_pylist())
            if filled >= 0:
                column = batch.column(filled)
                columns = [*batch.columns[:filled], pc.coalesce(column, pa.array(names, column.type)), *batch.columns[filled + 1 :]]
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch.filter(pa.array([n != "und" for n in names], pa.bool_()))
        give_back()

    return docs.mapInArrow(run, docs.schema)
