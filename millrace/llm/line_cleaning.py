"""Line-first cleaning: every line is judged on its own, failures go, then documents that lost too much.

A line (what stands between line feeds) with at least one word fails

* the punctuation rule, if marks and symbols are too large a share of its characters, or if it is
  longer than a title, has no sentence end behind its last word and too few of them inside;
* the navigation rule, if too many of its words are separators between links;
* the boilerplate rule, if it holds a known phrase, equals an earlier line of its text, or mostly
  repeats the word before.

Lines without a word never fail. A document is rejected if the characters of the words it lost
exceed ``max_lost`` of all; before that, ``base_failed`` rejects texts that are too short or repeat
themselves. Null is an empty text: no words, so base_failed. All counts cover the whole text.
Columns of the frame that have the names of results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from millrace.llm.frames import append
from millrace.llm.words import SPACED, Texts, Words, mixed, occurrence, slices, words

# The characters counted as symbols, and phrases of page furniture.
SYMBOLS = b"#*$%&|<>"
PHRASES = ("all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
           "use of cookies", "uses cookies", "enable javascript", "click here", "sign up for", "subscribe to",
           "skip to content", "back to top", "lorem ipsum")


@dataclass(frozen=True)
class Rules:
    max_mark_share: float = 0.1
    words_per_sentence_end: int = 40
    title_words: int = 6
    min_separators: int = 3
    max_separator_share: float = 0.15
    max_echo_share: float = 0.3
    max_lost: float = 0.4
    min_words: int = 10
    repeat_window: int = 5
    max_repeat_percent: int = 20


def _marked(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(characters, np.uint8)] = True
    return table


LINE = np.arange(256, dtype=np.uint8)
LINE[0], LINE[ord("\n")] = 0xFF, 0
SYMBOL, MARK = _marked(SYMBOLS), _marked(SYMBOLS + b"!=~^_{}[]\\")
SENTENCE_END, CLOSING = _marked(b".!?:;"), _marked(b"\"')]*_")
WIDE_ENDS = ("…", "。", "！", "？", "।", "۔", "؟", "»", "”")
SEPARATORS = _marked(b"|>")
PHRASE_PATTERN = "(?i)" + "|".join(PHRASES)


def _counted(flags: np.ndarray) -> np.ndarray:
    """Running count: ``out[b] - out[a]`` is the number of true flags in [a, b)."""
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def repeated_words(found: Words, size: int) -> np.ndarray:
    """Which words stand in a run of ``size`` words that occurs twice or more in their text."""
    n = len(found)
    covered = np.zeros(n, bool)
    if n < size:
        return covered
    total = np.zeros(n - size + 1, np.uint64)
    for j in range(size):
        total += mixed(mixed(found.index[j:n - size + 1 + j].astype(np.uint64)) + np.uint64(j + 1))
    starts = np.flatnonzero(found.row[size - 1:] == found.row[:n - size + 1])
    if not len(starts):
        return covered
    key = mixed(mixed(total[starts]) + found.row[starts].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    head = np.append(True, key[order][1:] != key[order][:-1])
    group = np.cumsum(head) - 1
    lead = starts[order[head]][group]
    if any((found.index[starts[order] + j] != found.index[lead + j]).any() for j in range(size)):  # different words, one key
        exact = np.stack([found.row[starts[order]], *(found.index[starts[order] + j] for j in range(size))], axis=1)
        group = np.unique(exact, axis=0, return_inverse=True)[1].reshape(-1)
    twice = np.bincount(group)[group] > 1
    steps = np.zeros(n + 1, np.int64)
    hit = starts[order[twice]]
    np.add.at(steps, hit, 1)
    np.add.at(steps, hit + size, -1)
    return np.cumsum(steps[:-1]) > 0


def _wide_end(data: bytes) -> bool:
    return data.decode("utf-8", "ignore").rstrip().endswith(WIDE_ENDS)


class Judged:
    """Counts and verdicts for one slice of texts."""

    def __init__(self, texts: Texts, phrases: np.ndarray, rules: Rules):
        self.rows = rows = len(texts)
        data = texts.data
        found, lines = words(texts, SPACED), words(texts, LINE)
        self.lines = lines
        characters = _counted((data & 0xC0) != 0x80)
        word_size = characters[found.end] - characters[found.start]
        line_of = np.searchsorted(lines.start, found.start, "right") - 1
        n_lines = len(lines.start)
        line_words = np.bincount(line_of, minlength=n_lines)
        line_size = np.bincount(line_of, word_size, n_lines).astype(np.int64)
        self.n_words = found.per_row(rows)
        self.word_chars = np.bincount(found.row, word_size, rows).astype(np.int64)
        self.n_symbols = np.diff(_counted(SYMBOL[data])[texts.bounds])
        filled = np.flatnonzero(line_words)
        again = occurrence(lines.row[filled], lines.index[filled]) > 0
        self.n_dup_lines = np.bincount(lines.row[filled[again]], minlength=rows)
        self.n_repeat_words = np.bincount(found.row[repeated_words(found, rules.repeat_window)], minlength=rows)
        self.base_failed = (self.n_words < rules.min_words) | (
            100 * self.n_repeat_words > rules.max_repeat_percent * self.n_words)

        marks = _counted(MARK[data])
        many_marks = marks[lines.end] - marks[lines.start] > rules.max_mark_share * line_size
        ends = _counted(SENTENCE_END[data])
        few_ends = (ends[lines.end] - ends[lines.start]) * rules.words_per_sentence_end < line_words
        separator = (found.end - found.start == 1) & SEPARATORS[data[found.start]]
        separators = np.bincount(line_of[separator], minlength=n_lines)
        navigation = (separators >= rules.min_separators) & (separators > rules.max_separator_share * line_words)
        echo = np.zeros(len(found), bool)
        echo[1:] = (found.index[1:] == found.index[:-1]) & (line_of[1:] == line_of[:-1])
        echoes = np.bincount(line_of[echo], minlength=n_lines) > rules.max_echo_share * line_words
        repeated = np.zeros(n_lines, bool)
        repeated[filled[again]] = True
        phrase = np.zeros(n_lines, bool)
        for line in np.flatnonzero(phrases[lines.row] & (line_words > 0)):
            text = data[lines.start[line]:lines.end[line]].tobytes().decode()
            phrase[line] = any(p in text.lower() for p in PHRASES)
        open_end = few_ends & (line_words > rules.title_words) & ~self._closed(data, found, line_of, n_lines)
        self.failed = (line_words > 0) & (many_marks | open_end | navigation | echoes | repeated | phrase)
        self.lost = np.bincount(lines.row, line_size * self.failed, rows).astype(np.int64)
        self.kept = ~self.base_failed & (self.lost <= rules.max_lost * self.word_chars)

    @staticmethod
    def _closed(data: np.ndarray, found: Words, line_of: np.ndarray, n_lines: int) -> np.ndarray:
        """Lines whose last word ends a sentence, closing quotes and brackets aside."""
        closed = np.zeros(n_lines, bool)
        last = np.flatnonzero(np.append(line_of[1:] != line_of[:-1], True)) if len(line_of) else np.empty(0, np.int64)
        at, start = found.end[last] - 1, found.start[last]
        for _ in range(3):
            back = CLOSING[data[at]] & (at > start)
            at = np.where(back, at - 1, at)
        closed[line_of[last]] = SENTENCE_END[data[at]]
        for k in last[data[found.end[last] - 1] >= 0x80]:
            closed[line_of[k]] |= _wide_end(data[found.start[k]:found.end[k]].tobytes())
        return closed

    def cleaned(self, texts: Texts) -> list[str]:
        """Each text without its failed lines and the line feeds that ended them."""
        out = [""] * self.rows
        failed = np.flatnonzero(self.failed)
        edges = np.searchsorted(self.lines.row[failed], np.arange(self.rows + 1))
        for row in range(self.rows):
            a, b = int(texts.bounds[row]), int(texts.bounds[row + 1])
            keep, at = [], a
            for line in failed[edges[row]:edges[row + 1]]:
                keep.append(texts.data[at:self.lines.start[line]].tobytes())
                at = min(b, int(self.lines.end[line]) + 1)
            out[row] = b"".join([*keep, texts.data[at:b].tobytes()]).decode()
        return out


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNT_FIELDS = ", ".join(f"{c} long" for c in COUNTS) + ", lost_chars long, base_failed boolean, kept boolean"


def judge_lines(df: DataFrame, text: str, rules: Rules = Rules(), with_text: bool = True) -> DataFrame:
    """The frame with the counts of each text, ``base_failed``, ``kept`` and, if wanted, ``clean_text``.

    ``clean_text`` is the text without its failed lines, for kept and rejected documents alike.
    """
    fields = COUNT_FIELDS + (", clean_text string" if with_text else "")

    def make():
        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            values = batch.column(text)
            phrases = pc.match_substring_regex(values, PHRASE_PATTERN).fill_null(False).to_numpy(zero_copy_only=False)
            made: dict[str, list] = {name: [] for name in (*COUNTS, "lost", "base_failed", "kept")}
            cleaned: list[str] = []
            for part in slices(values):
                judged = Judged(part, phrases[part.first:part.first + len(part)], rules)
                for name, out in made.items():
                    out.append(getattr(judged, name))
                if with_text:
                    cleaned += judged.cleaned(part)
            arrays = [pa.array(np.concatenate(out) if out else []).cast(pa.int64()) for out in list(made.values())[:-2]]
            arrays += [pa.array(np.concatenate(made[n]) if made[n] else [], pa.bool_()) for n in ("base_failed", "kept")]
            return arrays + ([pa.array(cleaned, pa.string())] if with_text else [])

        return work

    return append(df, fields, make, drop=() if with_text else (text,))


def clean(df: DataFrame, text: str, rules: Rules = Rules()) -> DataFrame:
    """Kept documents with their failed lines removed; all other columns stay as they are."""
    judged = judge_lines(df, text, rules).where("kept")
    columns = [judged["clean_text"].alias(c) if c == text else judged[f"`{c}`"] for c in df.columns if c in judged.columns]
    return judged.select(*columns)
