"""Language of text spans: scripts narrow the candidates, Viterbi over words picks the path."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartpost.llm.tables import session

# Three neighbouring letters (a blank beyond the word) share this many counters.
COUNTERS = 1 << 16
# Nats that a change of language costs, and the share of a language's letters that
# a script must hold for its words to be candidates for the language.
SWITCH, SCRIPT_SHARE = 10.0, 0.01
# Score of a language for a word in a script that it does not use.
NOT_IN_SCRIPT = -30.0
SLICE_CHARS = 1 << 20
UNKNOWN = "und"

# First code points of Unicode's blocks of scripts; 0 stands for all others.
SCRIPTS = (
    (0x0000, 1), (0x0250, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0),
    (0x0900, 7), (0x0980, 8), (0x0A00, 0), (0x0B80, 9), (0x0C00, 0), (0x0E00, 10), (0x0E80, 0), (0x10A0, 11),
    (0x1100, 12), (0x1200, 13), (0x1380, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x2C60, 1), (0x2C80, 0),
    (0x3040, 14), (0x3100, 0), (0x3130, 12), (0x3190, 0), (0x3400, 15), (0x4DC0, 0), (0x4E00, 15), (0xA000, 0),
    (0xAC00, 12), (0xD7B0, 0), (0xF900, 15), (0xFB00, 1), (0xFB13, 0), (0x20000, 15), (0x30000, 0),
)
N_SCRIPTS = 16


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Script of each code point that is a letter or mark; 255 for all others."""
    table = np.full(0x110000, 255, np.uint8)
    for (first, script), (after, _) in zip(SCRIPTS, [*SCRIPTS[1:], (0x110000, 0)]):
        table[first:after] = script
    for code in range(0x110000):
        if unicodedata.category(chr(code))[0] not in "LM":
            table[code] = 255
    return table


@lru_cache(maxsize=1)
def small_letters() -> np.ndarray:
    """Lower case of each code point, itself where that is not one code point."""
    table = np.arange(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        low = chr(code).lower()
        if len(low) == 1:
            table[code] = ord(low)
    return table


@dataclass
class Words:
    """Words of one text: letters' counters, where words begin, their scripts and sizes."""

    counters: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    scripts: np.ndarray
    first: np.ndarray


def words_of(text: str) -> Words | None:
    """Runs of letters of the text, in lower case; None without any."""
    codes = small_letters()[np.frombuffer(text.encode("utf-32-le"), "<u4")]
    script = letters()[codes]
    inside = script != 255
    if not inside.any():
        return None
    padded = np.zeros(len(codes) + 2, np.uint64)
    padded[1:-1] = np.where(inside, codes, 0)
    mixed = padded[:-2] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= padded[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= padded[2:] * np.uint64(0x165667B19E3779F9)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    counters = (mixed[inside] >> np.uint64(48)).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(ends - begins)[:-1]])
    return Words(counters, begins, ends, script[begins].astype(np.int64), first)


def parts(text: str) -> Iterator[tuple[int, str]]:
    """The text in pieces of bounded size, cut after a character that is no letter."""
    at, table = 0, letters()
    while at < len(text):
        until = min(len(text), at + SLICE_CHARS)
        while until < len(text) and table[ord(text[until - 1])] != 255:
            until += 1
        yield at, text[at:until]
        at = until


@dataclass
class Model:
    """Log-probability of each counter, and allowed scripts, by language."""

    languages: list[str]
    logs: np.ndarray
    scripts: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        """Words x languages: mean-free log-likelihoods; scripts rule candidates out."""
        sums = np.add.reduceat(self.logs[words.counters], words.first, axis=0, dtype=np.float64)
        allowed = self.scripts[words.scripts]
        none = ~allowed.any(axis=1)
        return np.where(allowed | none[:, None], sums, sums.min(axis=1, keepdims=True) + NOT_IN_SCRIPT)


def forward(scores: np.ndarray, value: list[float] | None, switch: float) -> tuple[list[float], np.ndarray]:
    """Best sums that end in each language after these words, and where each word's came from.

    ``value`` holds the sums after the words before; None at the beginning of a text.
    """
    back = np.zeros(scores.shape, np.int32)
    rows = scores.tolist()
    at = 0
    if value is None:
        value, at = rows[0], 1
    for at, row in enumerate(rows[at:], at):
        top = max(value)
        lead = value.index(top)
        jump = top - switch
        for k, have in enumerate(value):
            if have >= jump:
                back[at, k] = k
                value[k] = have + row[k]
            else:
                back[at, k] = lead
                value[k] = jump + row[k]
    return value, back


def traced(value: list[float], backs: list[np.ndarray]) -> list[np.ndarray]:
    """The path behind the best of the last sums, for each part of the words."""
    now, paths = value.index(max(value)), []
    for back in reversed(backs):
        path = np.empty(len(back), np.int64)
        for at in range(len(back) - 1, -1, -1):
            path[at] = now
            now = back[at, now]
        paths.append(path)
    return paths[::-1]


def best_path(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Language of each word: greatest sum of scores less ``switch`` per change.

    Ties stay with the language of the next word, then go to the first language.  Where
    every stretch of words gains less than half a switch over the best single language, that
    language is the whole path: a path of k languages without it has k - 1 changes, and
    one with it has a change for each stretch that leaves it.
    """
    totals = scores.sum(axis=0)
    best = int(np.argmax(totals))
    gain = np.cumsum(scores - scores[:, best : best + 1], axis=0)
    low = np.minimum.accumulate(np.vstack([np.zeros((1, scores.shape[1])), gain[:-1]]), axis=0)
    if ((gain - low) < switch / 2).all():
        return np.full(len(scores), best, np.int64)
    value, back = forward(scores, None, switch)
    return traced(value, [back])[0]


def spans_of(text: str, model: Model, switch: float = SWITCH) -> list[tuple[int, int, int, int]]:
    """(start, end, language index, letters) of runs of words in one language, in order.

    The sums of a long text are carried from part to part, so where it is cut changes nothing.
    """
    found = [(at, words) for at, words in ((at, words_of(part)) for at, part in parts(text)) if words is not None]
    if len(found) == 1:
        paths = [best_path(model.scores(found[0][1]), switch)]
    else:
        value, backs = None, []
        for _, words in found:
            value, back = forward(model.scores(words), value, switch)
            backs.append(back)
        paths = traced(value, backs) if found else []
    out: list[tuple[int, int, int, int]] = []
    for (at, words), path in zip(found, paths):
        change = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1])
        last = np.concatenate([change[1:], [len(path)]]) - 1
        size = np.add.reduceat(words.ends - words.begins, change)
        for a, b, language, n in zip(words.begins[change], words.ends[last], path[change], size):
            if out and out[-1][2] == language:
                out[-1] = (out[-1][0], int(at + b), int(language), out[-1][3] + int(n))
            else:
                out.append((int(at + a), int(at + b), int(language), int(n)))
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by (language, counter), then by (language, -1 - script), of all texts of a task."""
    found: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts = found.setdefault(lang, np.zeros(COUNTERS + N_SCRIPTS, np.int64))
            for _, part in parts(text.as_py()):
                words = words_of(part)
                if words is not None:
                    np.add.at(counts, words.counters, 1)
                    counts[COUNTERS:] += np.bincount(words.scripts, words.ends - words.begins, N_SCRIPTS).astype(np.int64)
    for lang, counts in found.items():
        keys = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys)), pa.array(keys), pa.array(counts[keys])], ["lang", "key", "n"]
        )


def learn(examples: DataFrame) -> Model:
    """Fit on all rows of ``examples`` (lang, text) without nulls.

    What reaches the driver are sums: at most COUNTERS + N_SCRIPTS per language, whatever
    the number of rows.
    """
    summed = (
        examples.where("lang is not null and text is not null")
        .select("lang", "text")
        .mapInArrow(_count, "lang string, key long, n long")
        .groupBy("lang", "key")
        .agg(F.sum("n").alias("n"))
    )
    table = summed.toPandas()
    languages = sorted(table["lang"].unique().tolist())
    counts = np.zeros((COUNTERS + N_SCRIPTS, len(languages)))
    counts[table["key"].to_numpy(np.int64), table["lang"].map(languages.index).to_numpy(np.int64)] = table["n"]
    grams, scripts = counts[:COUNTERS], counts[COUNTERS:]
    smooth = 0.5
    logs = np.log((grams + smooth) / (grams.sum(axis=0) + smooth * COUNTERS))
    shares = scripts / np.maximum(1, scripts.sum(axis=0))
    return Model(languages, logs.astype(np.float32), shares >= SCRIPT_SHARE)


def verdict(text: str | None, model: Model) -> tuple[str, float, str]:
    """Language of most letters, its share of letters, and the spans as lang:start:end."""
    spans = spans_of(text, model) if text and model.languages else []
    if not spans:
        return UNKNOWN, 0.0, ""
    size = np.bincount([s[2] for s in spans], [s[3] for s in spans], len(model.languages))
    best = int(np.argmax(size))
    told = ",".join(f"{model.languages[language]}:{start}:{end}" for start, end, language, _ in spans)
    return model.languages[best], float(size[best] / size.sum()), told


def _predict(model: Model) -> Callable:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [verdict(text.as_py(), model) for text in batch.column(1)]
            lang, score, spans = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, pa.string())],
                ["doc_id", "lang_pred", "score", "lang_spans"],
            )

    return predict


def label_languages(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, lang_spans) per row of ``documents`` (doc_id, text).

    Spans are in code points, end exclusive.  A text that is null, empty or without a
    letter, and any text when no language was learned, is ``und`` with score 0 and no
    spans; ties go to the first language by name.  Very long texts are read in pieces of
    SLICE_CHARS cut between words and labelled as one.  Repeated rows are labelled each.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_predict(model), "doc_id long, lang_pred string, score double, lang_spans string")


def fold(folds: int = 5) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def held_out_labels(documents: DataFrame) -> DataFrame:
    """Learn from the documents (doc_id, text, lang) of folds 1 to 4 and label all of them.

    held_out is true for fold 0; a null doc_id is in no fold: not learned from, held_out
    false.  The order of rows and other columns play no part.
    """
    session(documents.sparkSession)
    model = learn(documents.where(fold() != 0).select(F.col("lang").cast("string"), F.col("text").cast("string")))
    labelled = label_languages(documents, model)
    return labelled.select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "lang_spans"
    )
