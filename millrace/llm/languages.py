"""Language spans: script ranges narrow the candidates, Viterbi with a switching penalty labels the words.

Learned from labelled texts: for every language, the counts of short byte runs of its words (hashed
into a table of bounded size) and the scripts it is written in. The score of a word for a language
is the sum of the log shares of its byte runs, compared with the best language. A language whose
learning texts hold next to no words of the word's script is no candidate, unless none is.

Viterbi picks for every text the labelling of its words with the best total of word scores, less a
penalty for each change of language. All texts of a slice advance together, word by word. The
prediction is the language with most letters, ties going to the first in alphabetical order; the
score is its share of the letters.

Nulls, empty texts and texts without a letter are ``und`` with score 0. Without any learning text,
every text is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import append, column, summed
from millrace.llm.words import LETTERS, Texts, mixed, slices, words

RUN_SIZES = (3, 4)
TABLE_BYTES = 64 << 20
SLICE = 4 << 20
UNDETERMINED = "und"

# First and last code point of script ranges. Everything else counts as Latin.
SCRIPTS = {
    "latin": (),
    "greek": ((0x0370, 0x03FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x0400, 0x052F),),
    "armenian": ((0x0530, 0x058F),),
    "hebrew": ((0x0590, 0x05FF),),
    "arabic": ((0x0600, 0x06FF), (0x0750, 0x077F)),
    "devanagari": ((0x0900, 0x097F),),
    "bengali": ((0x0980, 0x09FF),),
    "tamil": ((0x0B80, 0x0BFF),),
    "telugu": ((0x0C00, 0x0C7F),),
    "thai": ((0x0E00, 0x0E7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7A3)),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF)),
}


def _script_table() -> np.ndarray:
    """Script number by the code point divided by 16, for the basic plane; every range ends at such a step."""
    table = np.zeros(0x10000 >> 4, np.int64)
    for number, ranges in enumerate(SCRIPTS.values()):
        for first, last in ranges:
            table[first >> 4:(last >> 4) + 1] = number
    return table


SCRIPT_OF = _script_table()


def _scripts(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Script of the first character of each word."""
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
    a, b, c = padded[start], padded[start + 1] & 0x3F, padded[start + 2] & 0x3F
    point = np.where(a < 0x80, a, np.where(a < 0xE0, (a & 0x1F) << 6 | b, (a & 0x0F) << 12 | b << 6 | c))
    return np.where(a < 0xF0, SCRIPT_OF[point >> 4], 0)


@cache
def _is_letter() -> np.ndarray:
    """Whether each code point is a letter, up to the last one that is."""
    flags = np.array([chr(c).isalpha() for c in range(0x110000)])
    return flags[:np.flatnonzero(flags)[-1] + 2]


def _letters(data: np.ndarray) -> np.ndarray:
    """Running count of letters: ``out[b] - out[a]`` is the number of those that begin in bytes a to b."""
    flags = np.zeros(len(data) + 1, np.int64)
    flags[1:] = (data | 0x20) - ord("a") < 26
    wide = np.flatnonzero(data >= 0xC0)
    if len(wide):
        padded = np.append(data, np.zeros(3, np.uint8)).astype(np.int64)
        a, b, c, d = (padded[wide + k] & 0x3F for k in range(4))
        lead = padded[wide]
        point = np.where(lead < 0xE0, (a & 0x1F) << 6 | b, np.where(lead < 0xF0, (a & 0x0F) << 12 | b << 6 | c,
                                                                      (a & 0x07) << 18 | b << 12 | c << 6 | d))
        table = _is_letter()
        flags[wide + 1] = table[np.minimum(point, len(table) - 1)]
    return np.cumsum(flags)


class WordRuns:
    """Words of a slice and the table places of their byte runs, a boundary on either side included."""

    def __init__(self, texts: Texts, buckets: int):
        self.found = found = words(texts, LETTERS)
        self.scripts = _scripts(texts.data, found.start)
        # A zero byte before every text keeps the runs of neighbours apart.
        rows = np.repeat(np.arange(len(texts)), np.diff(texts.bounds))
        norm = np.zeros(len(texts.data) + len(texts) + 4, np.uint32)
        norm[np.arange(len(texts.data)) + rows + 1] = LETTERS[texts.data]
        # Capitals of the Latin supplement follow a byte C3 and stand 32 below their small letters.
        capital = np.flatnonzero((norm[1:] >= 0x80) & (norm[1:] <= 0x9E) & (norm[1:] != 0x97) & (norm[:-1] == 0xC3)) + 1
        norm[capital] += 32
        start, size = found.start + found.row + 1, found.end - found.start
        self.places, self.word = [], []
        for order, length in enumerate(RUN_SIZES):
            counts = np.maximum(size + 3 - length, 1)  # the word and two boundaries; a shorter word is one run
            word = np.repeat(np.arange(len(start)), counts)
            first = np.repeat(start - 1 - (np.cumsum(counts) - counts), counts) + np.arange(len(word))
            value = norm[first]
            inside = np.repeat(start + size + 1, counts)
            for j in range(1, length):
                value = value << np.uint32(8) | np.where(first + j < inside, norm[first + j], 0)
            self.places.append((mixed(value.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64) + order * buckets)
            self.word.append(np.cumsum(counts) - counts)

    def scores(self, table: np.ndarray) -> np.ndarray:
        total = np.zeros((len(self.found.row), table.shape[1]), np.float32)
        if len(total):
            for places, begins in zip(self.places, self.word, strict=True):
                total += np.add.reduceat(table[places], begins, axis=0)
        return total


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # log shares, one row per run size and bucket, one column per language
    scripts: np.ndarray  # whether a language (column) is written in a script (row)

    @property
    def buckets(self) -> int:
        return len(self.table) // len(RUN_SIZES)


def rows_each(counts: list[int], rows: int) -> int:
    """Rows that each language may give: with what small ones leave over, all give ``rows`` together, or all they have."""
    left = rows
    for place, count in enumerate(sorted(counts)):
        each = max(1, left // (len(counts) - place))
        if count > each:
            return each
        left -= count
    return max(counts, default=0)


def learn(df: DataFrame, id_column: str, text: str, language: str, sample_rows: int = 40_000,
          min_script_share: float = 0.01) -> LanguageModel:
    """Model of all values of ``language``, learned from about ``sample_rows`` of the rows.

    The languages and their counts come from all rows. Each has an equal part in the sample, and what
    small ones leave over goes to the others: a language teaches with all its rows up to that part,
    above it with about that many, chosen by a hash of the id. The sample bounds the cost of learning; the table of byte
    runs is at most 64 MB whatever the number of languages. Rows with a null text or language teach nothing.
    """
    labelled = df.where(column(df, language).isNotNull() & column(df, text).isNotNull()).select(
        column(df, id_column).alias("id"), column(df, text).alias("text"), column(df, language).cast("string").alias("language"))
    known = {r.language: r.n for r in labelled.groupBy("language").agg(F.count("*").alias("n")).collect()}
    names = sorted(known)
    each = rows_each(list(known.values()), sample_rows)
    hot = [F.lit(v) for name in names if known[name] > each for v in (name, int(each / known[name] * (1 << 30)))]
    sample = labelled
    if hot:
        share = F.coalesce(F.try_element_at(F.create_map(*hot), F.col("language")), F.lit(1 << 30))
        sample = labelled.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share)
    sample = sample.select("text", "language")
    count = max(1, len(names))
    buckets = 1 << min(16, (TABLE_BYTES // (4 * len(RUN_SIZES) * count)).bit_length() - 1)
    rows, kinds = buckets * len(RUN_SIZES), len(SCRIPTS)

    def accumulate(batches) -> np.ndarray:
        total = np.zeros((rows + kinds) * count)
        for batch in batches:
            of = pc.index_in(batch.column("language"), pa.array(names, batch.column("language").type)).to_numpy(zero_copy_only=False)
            for part in slices(batch.column("text"), SLICE):
                runs = WordRuns(part, buckets)
                spoken = of[part.first:part.first + len(part)].astype(np.int64)[runs.found.row]
                for places, begins in zip(runs.places, runs.word, strict=True):
                    per_run = np.repeat(spoken, np.diff(np.append(begins, len(places))))
                    total += np.bincount(places * count + per_run, minlength=len(total))
                total += np.bincount((rows + runs.scripts) * count + spoken, minlength=len(total))
        return total

    counts = summed(sample, accumulate, (rows + kinds) * count).reshape(rows + kinds, count)
    runs = counts[:rows].reshape(len(RUN_SIZES), buckets, count) + 0.5
    table = np.log(runs / runs.sum(axis=1, keepdims=True)).reshape(rows, count).astype(np.float32)
    script_counts = counts[rows:]
    scripts = script_counts > min_script_share * np.maximum(1, script_counts.sum(axis=0))
    return LanguageModel(names, table, scripts)


def word_scores(runs: WordRuns, model: LanguageModel, floor: float) -> np.ndarray:
    """Scores against the best language, 0 at most; ``floor`` bounds what a single word can say."""
    scores = runs.scores(model.table)
    allowed = model.scripts[runs.scripts]
    allowed |= ~allowed.any(axis=1, keepdims=True)
    scores[~allowed] = -np.inf
    scores -= scores.max(axis=1, keepdims=True)
    return np.maximum(scores, np.where(allowed, -floor, -2 * floor), dtype=np.float32)


def viterbi(scores: np.ndarray, begins: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word; the words of text i are ``begins[i]`` to ``begins[i + 1]``."""
    sizes = np.diff(begins)
    order = np.argsort(-sizes, kind="stable")
    lengths, starts = sizes[order], begins[:-1][order]
    labels = scores.shape[1]
    stays = np.ones(scores.shape, bool)
    source = np.zeros(len(scores), np.int16)
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), "left")  # texts with more than t words
    best = np.zeros((len(lengths), labels), np.float32)
    for t in range(steps):
        m = active[t]
        at = starts[:m] + t
        if t:
            now = best[:m]
            top = now.argmax(axis=1)
            change = now[np.arange(m), top] - penalty
            stay = now >= change[:, None]
            stays[at], source[at] = stay, top
            best[:m] = np.where(stay, now, change[:, None]) + scores[at]
        else:
            best[:m] = scores[at]
    out = np.zeros(len(scores), np.int16)
    label = best.argmax(axis=1) if labels else np.zeros(len(lengths), np.int64)
    for t in range(steps - 1, -1, -1):
        m = active[t]
        at = starts[:m] + t
        out[at] = label[:m]
        if t:
            label[:m] = np.where(stays[at, label[:m]], label[:m], source[at])
    return out


RESULT_FIELDS = "lang_pred string, score double"
SPAN_FIELDS = ", lang_spans array<struct<start: int, stop: int, lang: string>>"


def identify(df: DataFrame, text: str, model: LanguageModel, penalty: float = 12.0, floor: float = 8.0,
             spans: bool = True, drop: tuple[str, ...] = ()) -> DataFrame:
    """The frame with ``lang_pred``, ``score`` and, if wanted, ``lang_spans``.

    A span runs from the first to behind the last word of a stretch of one language, in characters.
    Columns of the same names are replaced.
    """
    sent = df.sparkSession.sparkContext.broadcast((model.languages, model.table, model.scripts))

    def make():
        own = LanguageModel(*sent.value)
        limit = max(1 << 16, SLICE * 4 // max(4, len(own.languages)))

        def judged(part: Texts) -> tuple[list, list, list]:
            rows, labels = len(part), max(1, len(own.languages))
            runs = WordRuns(part, own.buckets or 1)
            found = runs.found
            begins = np.searchsorted(found.row, np.arange(rows + 1))
            running = _letters(part.data)
            letters = running[found.end] - running[found.start]
            lettered = (np.diff(running[part.bounds]) > 0) & bool(own.languages)
            label = viterbi(word_scores(runs, own, floor), begins, penalty) if own.languages else np.zeros(len(letters), np.int16)
            total = np.bincount(found.row * labels + label, letters, rows * labels).reshape(rows, labels)
            winner = total.argmax(axis=1)
            share = total.max(axis=1) / np.maximum(1, total.sum(axis=1))
            names = [own.languages[w] if ok else UNDETERMINED for w, ok in zip(winner, lettered, strict=True)]
            shares = np.where(lettered, share, 0.0).tolist()
            if not spans:
                return names, shares, []
            points = np.zeros(len(part.data) + 1, np.int64)
            np.cumsum((part.data & 0xC0) != 0x80, out=points[1:])
            change = np.flatnonzero(np.append(True, (label[1:] != label[:-1]) | (found.row[1:] != found.row[:-1])))[:len(label) or 0]
            stop = np.append(change[1:], len(label))
            out: list[list[dict]] = [[] for _ in range(rows)]
            for a, b in zip(change.tolist(), stop.tolist(), strict=False):
                row = int(found.row[a])
                if lettered[row]:
                    base = points[part.bounds[row]]
                    out[row].append({"start": int(points[found.start[a]] - base), "stop": int(points[found.end[b - 1]] - base),
                                     "lang": own.languages[label[a]]})
            return names, shares, out

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            names, shares, found = [], [], []
            for part in slices(batch.column(text), limit):
                for all_, new in zip((names, shares, found), judged(part), strict=True):
                    all_ += new
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())]))
            return [pa.array(names, pa.string()), pa.array(shares, pa.float64()), *([pa.array(found, kind)] if spans else [])]

        return work

    return append(df, RESULT_FIELDS + (SPAN_FIELDS if spans else ""), make, drop)
