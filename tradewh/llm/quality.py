"""Quality rules: line-first cleaning.

Every line of a text is judged on its own by the rules of ``LINE_RULES`` (each
a named predicate over the line's counts); failing lines are removed, and a
document goes when the removal costs it more than ``max_lost`` of its words.
Two document-level rules stand beside it: too few words, and too many words in
repeated eight-word windows.

The work is per row, so the plan is one scan and one Arrow pass: no shuffle.

Defined results: a null text counts as a text without words (rejected: too
short); blank lines are neither judged nor removed; a repeated row is judged
like any other; texts of any length are judged whole; an empty table gives no
rows; other columns of the table are ignored or passed through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradewh.llm.common import pick

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
MAX_LOST = 0.5

SYMBOLS = "#*$%&|<>"
NOT_SYMBOL = re.compile(f"[^{re.escape(SYMBOLS)}]+")
#: The white space that separates words.
_BLANKS = (" ", "\t", "\n", "\v", "\f", "\r")
NAV_MARKS = frozenset("| > < » « › ‹ • · / > ::".split())
END_MARKS = frozenset(".!?…:;\"'”’»)]}。！？")
BOILERPLATE = re.compile(
    r"cookie|javascript|lorem ipsum|terms of (?:use|service)|privacy policy|sign (?:in|up)|log ?in|click here"
    r"|read more|subscribe|newsletter|share this|skip to (?:main )?content|back to top|all rights reserved", re.I)
SHOUT = re.compile(r"!!")


def _navigation(line: str, words: list[str]) -> bool:
    """Menus and table rows: at least three separators, a quarter of the words."""
    marks = sum(w in NAV_MARKS for w in words)
    return marks >= 3 and 4 * marks >= len(words)


def _symbols(line: str, words: list[str]) -> bool:
    """More than three symbols per ten words (and more than two at all)."""
    n = len(NOT_SYMBOL.sub("", line))
    return n > 2 and 10 * n > 3 * len(words)


def _shouting(line: str, words: list[str]) -> bool:
    """Doubled exclamation marks at a fifth of the words, or five words and more in capitals."""
    if "!!" in line and 5 * len(SHOUT.findall(line)) >= len(words):
        return True
    return len(words) >= 5 and line.isupper()


def _boilerplate(line: str, words: list[str]) -> bool:
    """A short line with a page-furniture phrase."""
    return len(words) <= 12 and BOILERPLATE.search(line) is not None


def _stutter(line: str, words: list[str]) -> bool:
    """Six words or more of which a third repeat the word before them."""
    return len(words) >= 6 and 3 * sum(map(eq, words, words[1:])) >= len(words)


def _punctuation(line: str, words: list[str]) -> bool:
    """Eight words or more of which none ends with a closing mark."""
    return len(words) >= 8 and words[-1][-1] not in END_MARKS and not any(w[-1] in END_MARKS for w in words)


LINE_RULES = {
    "navigation": _navigation,
    "symbols": _symbols,
    "shouting": _shouting,
    "boilerplate": _boilerplate,
    "stutter": _stutter,
    "punctuation": _punctuation,
}


def line_failure(line: str) -> str | None:
    """The first rule the line fails, or None; blank lines pass."""
    words = line.split()
    if not words:
        return None
    for name, rule in LINE_RULES.items():
        if rule(line, words):
            return name
    return None


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a ``window``-word window found twice or more in the text.

    Windows are found by a wrapping 64-bit sum of word hashes; only windows
    whose sums collide are then compared word by word, so the count is exact.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    sums = np.zeros(n, np.uint64)
    for k in range(window):
        sums += h[k:k + n] * np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64 | 1)
    order = np.sort(sums)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    seen: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(np.isin(sums, twice)).tolist():
        seen.setdefault(tuple(words[i:i + window]), []).append(i)
    marks = np.zeros(len(words) + 1, np.int64)
    for at in seen.values():
        if len(at) > 1:
            np.add.at(marks, at, 1)
            np.add.at(marks, np.asarray(at) + window, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def judge(text: str | None, max_lost: float = MAX_LOST) -> dict:
    """Counts, the cleaned text and the verdict for one text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n_words = len(words)
    n_repeat = repeated_words(words)
    seen: set[str] = set()
    kept_lines, n_dup, lost, failed = [], 0, 0, {}
    for line in text.split("\n"):
        bare = len(line.encode("utf-8", "surrogatepass").split())
        if bare:
            n_dup += line in seen
            seen.add(line)
            if rule := line_failure(line):
                failed[rule] = failed.get(rule, 0) + 1
                lost += bare
                continue
        kept_lines.append(line)
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    return {
        "n_words": n_words,
        "word_chars": len(text) - sum(map(text.count, _BLANKS)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat,
        "lost_words": lost,
        "base_failed": base_failed,
        "kept": not base_failed and lost <= max_lost * n_words,
        "clean_text": "\n".join(kept_lines),
        "failed_rules": ",".join(sorted(failed)),
    }


_FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
           ("n_repeat_words", pa.int64()), ("lost_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
           ("failed_rules", pa.string()), ("clean_text", pa.string())]
_SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lost_words long, "
           "base_failed boolean, kept boolean, failed_rules string")


def quality_report(docs: DataFrame, max_lost: float = MAX_LOST, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts and the verdict, and with
    ``with_text`` the text without its failing lines."""
    fields = _FIELDS if with_text else _FIELDS[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(t, max_lost) for t in batch.column("text").to_pylist()]
            cols = [batch.column("doc_id")] + [pa.array([r[f] for r in rows], t) for f, t in fields]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id"] + [f for f, _ in fields])

    schema = f"doc_id long, {_SCHEMA}" + (", clean_text string" if with_text else "")
    return pick(docs, doc_id="long", text="string").mapInArrow(run, schema)


def keep_good(docs: DataFrame, max_lost: float = MAX_LOST) -> DataFrame:
    """The rows of ``docs`` whose text passes, with all their columns as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [judge(t, max_lost)["kept"] for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    at = docs.columns.index("text")
    return docs.mapInArrow(run, docs.schema)
