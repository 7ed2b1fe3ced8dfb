"""Language identification by cross-parsing entropy.

A bounded sample of labelled text makes one suffix automaton per language. A text is parsed into phrases
against each: from where the last phrase ended, the longest string that occurs in the language's sample
is the next one. The fewer phrases a text needs, the closer it is to the sample. What held-back text of
the language itself and of the others needs against that same sample tells how much a phrase more or less
says: a short sample says little, whatever its language, and takes nothing from the others. The language
with the most evidence wins.

Automata are hash tables of (state, letter), read over many chunks of text in step and composed by a prefix
scan (``lanes``), so a text of any length is parsed as one and counts the same however it is cut. Models above
MODEL_BYTES are used in blocks of languages, one broadcast after another.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberwave.llm import lanes
from emberwave.llm.common import few, saved, slices

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
#: The training sample: so many labelled rows of each language at most, taken whole, in an order by hash, as
#: long as they come to so many characters (one row at least), and so many characters beyond for the rates.
SAMPLE_ROWS, LANGUAGE_CHARS, REST_CHARS = 64, 50_000, 10_000
#: Distinct labels; more of them are no languages, and nothing is learned from them but an error.
MOST_LANGUAGES = 1_000
#: What a language of average entropy needs counts as so many characters of each language's own held-back text.
PRIOR_CHARS = 1_000
#: Bytes of automata in one broadcast, and of one up to which it is a plain array of states by letters: with a
#: large alphabet, nearly all of that would be empty, and a hash table holds it in less.
MODEL_BYTES, DENSE_BYTES = 200_000_000, 24_000_000
UNKNOWN = "und"

_OTHER = regex.compile(r"[^\p{L}\p{M}]+")


def folded(text: str) -> str:
    """Lower case; each run of anything but letters and marks becomes one space."""
    return _OTHER.sub(" ", text.lower())


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class Automaton:
    """The suffix automaton of a text: every path from state 0 spells a substring."""

    def __init__(self, text: str) -> None:
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for char in text:
            state = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and char not in self.next[p]:
                self.next[p][char] = state
                p = link[p]
            if p >= 0:
                q = self.next[p][char]
                if length[p] + 1 == length[q]:
                    link[state] = q
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(char) == q:
                        self.next[p][char] = copy
                        p = link[p]
                    link[q] = link[state] = copy
            last = state

    def tabled(self, name: str, number: dict[str, int], own: float, foreign: float, size: int) -> Language:
        """The automaton in arrays, by the numbers of letters."""
        width = len(number) + 1
        edges = [(state * width + number[c], target) for state, follow in enumerate(self.next) for c, target in follow.items()]
        keys, targets = np.array(edges, np.int64).reshape(-1, 2).T
        table: lanes.Table | lanes.Dense
        if 4 * len(self.next) * width <= DENSE_BYTES:
            table = lanes.Dense(len(self.next) * width, keys, targets)
        else:
            table = lanes.Table(2 * len(edges))
            table.put(keys, targets)
        root = np.full(width, -1, np.int64)
        for c, target in self.next[0].items():
            root[number[c]] = target
        return Language(name, table, width, root, own, foreign, size)

    def phrases(self, text: str) -> int:
        """Longest matches that spell the text; a character that never occurs is a phrase of its own."""
        count = state = 0
        for char in text:
            follow = self.next[state].get(char, -1)
            if follow < 0:
                if state:
                    count += 1
                follow = self.next[0].get(char, -1)
                if follow < 0:
                    count, follow = count + 1, 0
            state = follow
        return count + (state > 0)


@dataclass(frozen=True)
class Language:
    """An automaton as a table from state * width + letter to the next state, its rates and its size."""

    name: str
    table: lanes.Table | lanes.Dense
    width: int
    #: Next states of state 0, -1 for letters that do not occur.
    root: np.ndarray
    #: Phrases a character that text of the language, and that of others, needs; characters of the sample.
    own: float
    foreign: float
    size: int

    def step(self, states: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Goes on with the phrase, or begins a new one and emits the old; a letter without any is a phrase."""
        follow = self.table.get(states.astype(np.int64) * self.width + letters)
        missed = np.flatnonzero(follow < 0)
        emitted = np.zeros(len(states), np.int16)
        if missed.size:
            again = self.root[letters[missed]]
            emitted[missed] = (states[missed] != 0).astype(np.int16) + (again < 0)
            follow[missed] = np.maximum(again, 0)
        return follow, emitted

    @property
    def nbytes(self) -> int:
        return self.table.nbytes + self.root.nbytes


@dataclass(frozen=True)
class Model:
    languages: list[Language]
    #: The letters of all samples in order; a letter's number is its place, all others share the last one.
    letters: str

    def parse(self, texts: list[str]) -> np.ndarray:
        """(texts, languages) phrases."""
        sizes = np.array([len(x) for x in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        known = np.array([ord(x) for x in self.letters], np.uint32)
        at = np.searchsorted(known, points)
        letters = np.where((at < len(known)) & (known[np.minimum(at, len(known) - 1)] == points), at, len(known)).astype(np.int32)
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        for k, language in enumerate(self.languages):
            emitted, state = lanes.run(language.step, letters, sizes)
            out[:, k] = emitted + (state != 0)
        return out

    def evidence(self, texts: list[str]) -> np.ndarray:
        """(texts, languages): the log-likelihood ratio of the phrases (Poisson) between a language's own text
        and others', and the log of its sample's size, which decides where a text says nothing."""
        own, foreign, sizes = (np.array([getattr(x, n) for x in self.languages], float) for n in ("own", "foreign", "size"))
        length = np.array([len(x) for x in texts])[:, None]
        return length * (foreign - own) - self.parse(texts) * np.log(foreign / own) + np.log(sizes)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """A learned language for each text that has a letter, and 1 less the odds of the second best."""
        best = Best.none(len(texts)).with_model(self, texts)
        return best.said(texts)

    def blocks(self) -> list[Model]:
        """The model in parts of some MODEL_BYTES, one language at least in each."""
        parts: list[list[Language]] = [[]]
        for language in self.languages:
            if parts[-1] and sum(x.nbytes for x in parts[-1]) + language.nbytes > MODEL_BYTES:
                parts.append([])
            parts[-1].append(language)
        return [replace(self, languages=x) for x in parts]


@dataclass(frozen=True)
class Best:
    """Of each text the language of the most evidence so far, that evidence and the second most."""

    names: list[str | None]
    first: np.ndarray
    second: np.ndarray

    @classmethod
    def none(cls, n: int) -> Best:
        return cls([None] * n, np.full(n, -np.inf), np.full(n, -np.inf))

    def with_model(self, model: Model, texts: list[str | None]) -> Best:
        """Languages come in the order of their names, so a tie stays with the first."""
        if not model.languages:
            return self
        found = model.evidence([folded(x) if has_letter(x) else "" for x in texts])
        at = found.argmax(axis=1)
        ordered = np.sort(found, axis=1)
        top, next_ = ordered[:, -1], ordered[:, -2] if found.shape[1] > 1 else np.full(len(texts), -np.inf)
        wins = top > self.first
        names = [model.languages[k].name if w else old for k, w, old in zip(at.tolist(), wins.tolist(), self.names, strict=True)]
        return Best(names, np.maximum(top, self.first), np.where(wins, np.maximum(next_, self.first), np.maximum(top, self.second)))

    def said(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        clear = [n is not None and has_letter(x) for n, x in zip(self.names, texts, strict=True)]
        gap = np.where(np.isinf(self.second), np.inf, self.first - np.where(np.isinf(self.second), 0, self.second))
        score = np.where(clear, 1 - np.exp(-np.maximum(gap, 0)), 0.0)
        return [n if c else UNKNOWN for n, c in zip(self.names, clear, strict=True)], score.tolist()


def fit(samples: dict[str, list[str]]) -> Model:
    """An automaton of four fifths of each language's sample, and the phrases a character of the rests needs.

    Each is as long as its own language's sample lets it be; no language's sample changes another's automaton.
    """
    texts = {k: folded(" ".join(v)) for k, v in sorted(samples.items())}
    texts = {k: v for k, v in texts.items() if v.strip()}
    sizes = {k: max(1, len(v) * 4 // 5) for k, v in texts.items()}
    letters = "".join(sorted({c for k, v in texts.items() for c in v[: sizes[k]]}))
    number = {c: k for k, c in enumerate(letters)}
    # A language of many words needs more phrases for its own text; rest text of each sample tells.
    rests = {k: v[sizes[k] : sizes[k] + REST_CHARS] for k, v in texts.items()}
    largest = sorted(rests, key=lambda k: (-len(rests[k]), k))[:3]
    # Others' rests are taken in turn up to REST_CHARS in all, and of each no more than its share.
    share = max(100, REST_CHARS // max(1, len(texts) - 1))
    languages = []
    for name, text in texts.items():
        rest, size = rests[name], sizes[name]
        machine = Automaton(text[:size])
        phrases, chars = machine.phrases(rest), len(rest)
        if chars < REST_CHARS:
            # A short rest says little: so long a sample of another language's and its rest fill up.
            other = [(Automaton(texts[k][:size]).phrases(rests[k][:PRIOR_CHARS]), len(rests[k][:PRIOR_CHARS])) for k in largest if k != name and sizes[k] >= size and rests[k]]
            if other:
                phrases += PRIOR_CHARS * sum(p for p, _ in other) / sum(n for _, n in other)
                chars += PRIOR_CHARS
        rate = phrases / chars if phrases else 1.0
        others = [v[:share] for k, v in rests.items() if k != name and v]
        others = others[: max(1, REST_CHARS // share)]
        chars = sum(map(len, others))
        # Where nothing tells them apart, others' text needs as many phrases, and the sample says nothing.
        foreign = max(rate, sum(map(machine.phrases, others)) / chars) if chars else rate
        languages.append(machine.tabled(name, number, rate, foreign, size))
    return Model(languages, letters)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 on division by 4; false for null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(documents: DataFrame) -> dict[str, list[str]]:
    """By language some whole texts of labelled rows, the same on every run.

    Rows are dealt by a hash of doc_id into SAMPLE_ROWS bins a language, and one row is drawn of each bin:
    the smallest hash, of rows that do not fill LANGUAGE_CHARS alone before those that do. These minima are
    aggregated before any shuffle, whatever share a language has. Rows are then taken in the order of their hashes
    as long as they fit into LANGUAGE_CHARS together; where none does, the shortest one is taken alone.
    """
    able = documents.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").where(~held_out())
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    hashed = able.select("lang", F.xxhash64(F.lit(5), doc_id).alias("h"), doc_id.alias("doc_id"), text.alias("text"), F.length(text).alias("chars"))
    drawn = F.min(F.struct((F.col("chars") > LANGUAGE_CHARS).alias("over"), "h", "chars")).alias("r")
    bins = saved(hashed.groupBy("lang", F.pmod("h", F.lit(SAMPLE_ROWS)).alias("bin")).agg(drawn).select("lang", "r.h", "r.chars"), "bins")
    names = bins.select("lang").distinct().limit(MOST_LANGUAGES + 1).count()
    if names > MOST_LANGUAGES:
        raise ValueError(f"lang holds more than {MOST_LANGUAGES} different labels")
    chosen: list[tuple[str, int]] = []
    by_name: dict[str, list[tuple[int, int]]] = {}
    for row in bins.collect():
        by_name.setdefault(row.lang, []).append((row.h, row.chars))
    for name, found in by_name.items():
        left, own = LANGUAGE_CHARS, []
        for h, chars in sorted(found):
            if chars <= left:
                own.append((name, h))
                left -= chars
        chosen += own or [(name, min(found, key=lambda x: (x[1], x[0]))[0])]
    if not chosen:
        return {}
    wanted = F.broadcast(documents.sparkSession.createDataFrame(chosen, "lang string, h long"))
    texts: dict[str, list[tuple[int, int, str]]] = {}
    # Rows that repeat a doc_id have one hash; the text that is least stands for them.
    for row in hashed.join(wanted, ["lang", "h"]).groupBy("lang", "h", "doc_id").agg(F.min("text").alias("text")).collect():
        texts.setdefault(row.lang, []).append((row.h, row.doc_id, row.text))
    return {k: [x[2] for x in sorted(v)] for k, v in texts.items()}


def identify(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score, a row per row of ``documents`` (doc_id, text, lang).

    Without ``model``, one is fitted to rows with doc_id, text and lang that are not held out. A text
    that is null or has no letter gives ``und`` and 0, and so does every text if nothing could be
    learned. A tie goes to the language first by code point. The prediction sees the text alone, whole;
    other columns are not read, whatever their names. A null doc_id is not held out and not learned from.
    Repeated rows give repeated results, an empty table none. More than MOST_LANGUAGES labels are an error.
    """
    model = model or fit(training_sample(documents.select("doc_id", "text", "lang")))
    state = documents.select(documents["doc_id"].cast("long").alias("doc_id"), held_out().alias("held_out"), documents["text"].cast("string").alias("text"))
    blocks = model.blocks()
    for number, block in enumerate(blocks):
        last = number == len(blocks) - 1
        shared = documents.sparkSession.sparkContext.broadcast(pickle.dumps(block, protocol=5))
        columns = SCHEMA if last else "doc_id long, held_out boolean, text string, name string, first double, second double"
        state = state.mapInArrow(_judged(shared, last), columns)
        if not last:
            # Beyond one broadcast, the best so far goes on with its text in a written table.
            state = saved(state, "languages")
            shared.destroy()
    return state


def _judged(shared, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(shared.value)
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            best = Best.none(len(texts))
            if "name" in part.schema.names:
                best = Best(part.column("name").to_pylist(), *(part.column(x).to_numpy(zero_copy_only=False) for x in ("first", "second")))
            best = best.with_model(model, texts)
            out = {"doc_id": part.column("doc_id"), "held_out": part.column("held_out")}
            if last:
                said, score = best.said(texts)
                out |= {"lang_pred": pa.array(said, pa.string()), "score": pa.array(score, pa.float64())}
            else:
                out |= {"text": part.column("text"), "name": pa.array(best.names, pa.string()), "first": pa.array(best.first), "second": pa.array(best.second)}
            yield pa.RecordBatch.from_pydict(out)

    return run
