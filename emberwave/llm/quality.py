"""Quality rules with suffix-array repetition.

The words of a text are the symbols of a suffix array. Neighbouring suffixes share a longest common
prefix (LCP); the LCP intervals are the maximal repeated substrings. A word position p is the start of
a repeat as long as the larger LCP beside its suffix, and the union of those spans over all p is the
union of the spans of all maximal repeats. A text fails when repeats of ``min_repeat`` words or more
cover too large a share of it, or when its longest repeat is too long.

Unbroken runs of RUN_REPEAT characters or more (one word each) have a second array over their characters.
Its repeats of RUN_REPEAT characters or more fail a text by the same share, of all its characters, or by a length
of as many characters as the longest repeat may have words, six to a word.

Many texts share one array: equal words of different texts get different symbols, so no repeat reaches
over a text's end. The array is built by prefix doubling, which re-sorts only the suffixes that are
still tied; the ranks of each round give the LCPs by binary descent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from emberwave.llm.common import encoded, slices, word_ids

SYMBOLS = "#*$%&|<>"
#: Characters that a repeat inside unbroken runs has at least, about as many as eight words have.
RUN_REPEAT = 48
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_words long, longest_repeat long"
)


@dataclass(frozen=True)
class Rules:
    """``min_words`` and ``max_repeat_percent`` are the base; the other three are the suffix array's.

    A share of 0.12 in repeats of eight words is what published filters for training text allow, and repeats
    of fifty words are what published exact deduplication of substrings takes out.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    min_repeat: int = 8
    max_covered: float = 0.12
    max_longest: int = 50


def suffix_ranks(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array and the ranks after each doubling: level k ranks by the first 2**k symbols.

    ``ends[i]`` is where the text of position i ends; symbols of different texts differ.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    heads = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = heads
    levels = [rank.astype(np.int32)]
    tied = ~first | ~np.r_[first[1:], True]
    active, width = order[tied], 1
    while active.size:
        follow = active + width
        second = np.where(follow < ends[active], rank[np.minimum(follow, n - 1)] + 1, 0)
        key = rank[active] * (n + 2) + second
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        old = rank[active]
        at = np.arange(active.size)
        new_group = np.r_[True, key[1:] != key[:-1]]
        old_group = np.r_[True, old[1:] != old[:-1]]
        rank[active] = old + np.maximum.accumulate(np.where(new_group, at, 0)) - np.maximum.accumulate(np.where(old_group, at, 0))
        levels.append(rank.astype(np.int32))
        active = active[~new_group | ~np.r_[new_group[1:], True]]
        width *= 2
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    return array, levels


def repeat_lengths(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position the length of the longest repeat that starts there."""
    n = len(symbols)
    if n < 2:
        return np.zeros(n, np.int64)
    array, levels = suffix_ranks(symbols, ends)
    left, right = array[:-1], array[1:]
    common = np.zeros(n - 1, np.int64)
    pairs = np.flatnonzero(levels[0][left] == levels[0][right])
    a, b, got = left[pairs], right[pairs], np.zeros(pairs.size, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + got, b + got
        inside = (i < ends[a]) & (j < ends[b])
        i, j = np.minimum(i, n - 1), np.minimum(j, n - 1)
        got += np.where(inside & (levels[k][i] == levels[k][j]), 1 << k, 0)
    common[pairs] = got
    longest = np.zeros(n, np.int64)
    longest[left] = common
    longest[right] = np.maximum(longest[right], common)
    return longest


def covered(lengths: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in a repeat of ``least`` symbols or more."""
    begins = np.flatnonzero(lengths >= least)
    change = np.zeros(len(lengths) + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, begins + lengths[begins], -1)
    return np.cumsum(change[:-1]) > 0


def _run_repeats(texts: int, ids: np.ndarray, owner: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the characters that lie in repeats inside long runs, and the longest such repeat."""
    inside, longest = np.zeros(texts, np.int64), np.zeros(texts, np.int64)
    long = {k: x for k, x in enumerate(words) if len(x) >= RUN_REPEAT}
    runs = {k: x for k, w in long.items() if len(x := np.frombuffer(w.decode("utf-8", "replace").encode("utf-32-le"), "<u4")) >= RUN_REPEAT}
    places = np.flatnonzero(np.isin(ids, list(runs))) if runs else []
    if not len(places):
        return inside, longest
    # A symbol of its own ends each run, so that no repeat reaches over it.
    sizes = np.array([len(runs[k]) + 1 for k in ids[places].tolist()])
    text = np.repeat(owner[places], sizes)
    symbols = text * 0x110000 + np.concatenate([np.r_[runs[k], 0] for k in ids[places].tolist()])
    symbols[np.cumsum(sizes) - 1] = -1 - np.arange(len(sizes))
    lengths = repeat_lengths(symbols, np.searchsorted(text, text, "right"))
    np.add.at(inside, text[covered(lengths, RUN_REPEAT)], 1)
    np.maximum.at(longest, text, np.where(lengths >= RUN_REPEAT, lengths, 0))
    return inside, longest


def _dup_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    return len(lines) - len(set(lines))


def measured(column: pa.Array, rules: Rules) -> dict[str, np.ndarray]:
    """The counts and verdicts of a slice of texts, an array each."""
    texts = column.fill_null("").to_pylist()
    ids, starts, words = word_ids(encoded(column))
    n_words = np.diff(starts)
    owner = np.repeat(np.arange(len(texts)), n_words)
    lengths = repeat_lengths(owner * max(len(words), 1) + ids, starts[1:][owner])
    total = lambda flags: np.diff(np.r_[0, np.cumsum(flags)][starts])
    repeat_words = total(covered(lengths, 3))
    covered_words = total(covered(lengths, rules.min_repeat))
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, owner, lengths)
    failed = (n_words < rules.min_words) | (100 * repeat_words > rules.max_repeat_percent * n_words)
    repetitive = (covered_words > rules.max_covered * n_words) | (longest >= rules.max_longest)
    word_chars = np.array([len(x) - sum(map(x.count, _SPACE)) for x in texts], np.int64)
    run_covered, run_longest = _run_repeats(len(texts), ids, owner, words)
    repetitive |= (run_covered > rules.max_covered * word_chars) | (run_longest >= 6 * rules.max_longest)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": np.array([sum(map(x.count, SYMBOLS)) for x in texts], np.int64),
        "n_dup_lines": np.array([_dup_lines(x) for x in texts], np.int64),
        "n_repeat_words": repeat_words,
        "base_failed": failed,
        "kept": ~failed & ~repetitive,
        "covered_words": covered_words,
        "longest_repeat": longest,
    }


def assess(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row of counts and a verdict per row of ``documents`` (doc_id, text).

    A null text has no words and fails the base, as an empty one does; a null doc_id is passed on.
    Repeated rows give repeated results, an empty table none. Other columns are not read, whatever
    their names. A text of any length is judged whole, in memory proportional to it, times the binary logarithm of
    its longest repeat: a level of ranks for each doubling.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), **measured(part.column("text"), rules)})

    return documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].cast("string").alias("text")).mapInArrow(run, SCHEMA)


def keep_good(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``documents`` that the rules keep, with all their columns as they are, whatever their names.

    A null or empty text has no words and goes. Equal texts stay or go together; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield part.filter(pa.array(measured(part.column("text"), rules)["kept"]))

    return documents.mapInArrow(run, documents.schema)
