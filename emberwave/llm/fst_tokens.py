"""Token counts by a compiled finite-state tokenizer.

A byte-pair vocabulary has a deterministic left-to-right form. The coding of every prefix of a text ends in
one certain token: among the tokens that end there, the one that may stand after the last token of what
comes before it, where two tokens may stand side by side if coding their joined text gives just these two.
A state therefore holds, for the last places that a token could still begin at, the characters read since,
the last token there and the number of tokens so far relative to the newest place. A transition on a
character leads to a state and is annotated with the tokens it emits (the change of the count, which is
negative when tokens join). Transitions are compiled when first met and kept in a table that arrays of
states and characters are looked up in.

Texts are read in chunks, all in step. A chunk's map takes the state before it to the state behind it and
the tokens emitted between; maps compose by a prefix scan (``lanes``). Nothing in it depends on spaces: a text
without any is cut and composed like another.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from emberwave.llm import lanes
from emberwave.llm.common import mixed, slices
from emberwave.llm.tokenfile import tokenizer_file

SPACE = "▁"
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
#: States and pairs of tokens that a worker keeps before it starts again between slices, some 250 and 24 bytes each.
KEPT_STATES, KEPT_PAIRS = 800_000, 2_000_000
#: Characters without a piece, by the bytes of their UTF-8 form, come first among the letters.
_UNKNOWN = 5
#: A place of a state in one number: the prefix read since, the last token there (0 is none), and how many
#: tokens more there are now, which joining tokens can make fewer.
_PREFIX, _TOKEN, _MORE = 32, 12, 0x800


class Transducer:
    """Counts tokens; ``scores`` gives each piece's merge priority, higher first."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores
        chars = sorted(x for x in scores if len(x) == 1)
        self.letter_of = np.full(0x110000, 4, np.int32)
        self.letter_of[:0x10000], self.letter_of[:0x800], self.letter_of[:0x80] = 3, 2, 1
        self.letter_of[[ord(x) for x in chars]] = _UNKNOWN + np.arange(len(chars))
        self.letter_of[ord(" ")] = self.letter_of[ord(SPACE)]
        self.width = _UNKNOWN + len(chars)
        # The prefixes of all pieces as a tree, with the token that each one is, if merging leaves it whole.
        prefixes = {"": 0}
        for piece in scores:
            for k in range(1, len(piece) + 1):
                prefixes.setdefault(piece[:k], len(prefixes))
        letter = {x: _UNKNOWN + k for k, x in enumerate(chars)}
        self.tree = lanes.Table(4 * len(prefixes))
        inner = [(prefixes[x[:-1]], letter[x[-1]], n) for x, n in prefixes.items() if x and x[-1] in letter]
        parent, by, child = (np.array(x, np.int64) for x in zip(*inner, strict=True))
        self.tree.put(parent * self.width + by, child)
        self.goes_on = np.zeros(len(prefixes), bool)
        self.goes_on[parent] = True
        self.pieces = list(scores)
        self.token_of = np.full(len(prefixes), -1, np.int64)
        for k, piece in enumerate(self.pieces):
            if self.merged(piece) == [piece]:
                self.token_of[prefixes[piece]] = k
        self.most = max(map(len, self.pieces)) + 1
        self.pairs = lanes.Table()
        self.forget()

    def forget(self) -> None:
        self.rows = np.full((1 << 12, self.most), -1, np.int64)
        self.rows[0, 0] = _MORE
        self.n_states = 1
        self.by_hash = lanes.Table(1 << 12)
        self.same_hash: dict[bytes, int] = {}
        self.table = lanes.Table(1 << 14)

    def merged(self, text: str) -> list[str]:
        """The pieces that merging by priority leaves, leftmost first among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _may_follow(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether token stands as it is behind before - 1; behind nothing (0) each one does."""
        keys = before * len(self.pieces) + token
        found = np.where(before == 0, 1, self.pairs.get(keys))
        if (found < 0).any():
            new = np.unique(keys[found < 0])
            said = []
            for a, b in (divmod(k, len(self.pieces)) for k in new.tolist()):
                pair = [self.pieces[a - 1], self.pieces[b]]
                said.append(self.merged("".join(pair)) == pair)
            self.pairs.put(new, np.array(said, np.int64))
            found = np.where(before == 0, 1, self.pairs.get(keys))
        return found == 1

    def _compiled(self, states: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and emitted tokens of transitions that are not in the table."""
        rows = self.rows[states]
        held = rows >= 0
        child = np.full(rows.shape, -1, np.int64)
        child[held] = self.tree.get((rows[held] >> _PREFIX) * self.width + np.broadcast_to(letters[:, None], rows.shape)[held])
        token = np.where(child >= 0, self.token_of[child], -1)
        before, more = rows >> _TOKEN & 0xFFFFF, (rows & 0xFFF) - _MORE
        # The oldest place from which a token ends here that may stand behind the last one there.
        chosen = np.full(len(rows), -1)
        for k in range(self.most):
            open_ = np.flatnonzero((chosen < 0) & (token[:, k] >= 0))
            chosen[open_[self._may_follow(before[open_, k], token[open_, k])]] = k
        if (chosen < 0).any():
            raise ValueError("a piece has no left-to-right form in this vocabulary")
        at = np.arange(len(rows))
        emitted = 1 - more[at, chosen]
        stays = (child >= 0) & self.goes_on[child]
        next_rows = np.where(stays, child << _PREFIX | before << _TOKEN | more + emitted[:, None] + _MORE, -1)
        next_rows = np.take_along_axis(next_rows, np.argsort(~stays, axis=1, kind="stable"), axis=1)
        next_rows[at, stays.sum(axis=1)] = token[at, chosen] + 1 << _TOKEN | _MORE
        return self._numbered(next_rows), emitted

    def _numbered(self, rows: np.ndarray) -> np.ndarray:
        """The numbers of states, new ones where they are not known."""
        hashed = np.zeros(len(rows), np.uint64)
        for k in range(self.most):
            hashed = mixed(hashed + rows[:, k].astype(np.uint64))
        keys = (hashed >> np.uint64(1)).astype(np.int64)
        new, first = np.unique(keys, return_index=True)
        absent = self.by_hash.get(new) < 0
        new, first = new[absent], first[absent]
        while self.n_states + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.full_like(self.rows, -1)])
        numbers = self.n_states + np.arange(len(new))
        self.rows[numbers] = rows[first]
        self.n_states += len(new)
        self.by_hash.put(new, numbers)
        out = self.by_hash.get(keys)
        for k in np.flatnonzero((self.rows[out] != rows).any(axis=1)).tolist():
            # Two states of one hash: the later one is known by its content.
            out[k] = self.same_hash.setdefault(rows[k].tobytes(), self.n_states)
            if out[k] == self.n_states:
                self.rows = np.concatenate([self.rows[: self.n_states], rows[k : k + 1], np.full_like(self.rows, -1)])
                self.n_states += 1
        return out

    def step(self, states: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and emitted tokens; transitions not met before are compiled."""
        keys = states.astype(np.int64) * self.width + letters
        found = self.table.get(keys)
        if (found < 0).any():
            new = np.unique(keys[found < 0])
            state, letter = new // self.width, new % self.width
            # No piece holds an unknown letter: its bytes are tokens, and nothing joins over it.
            follow, emitted = np.zeros(len(new), np.int64), letter.copy()
            piece = letter >= _UNKNOWN
            if piece.any():
                follow[piece], emitted[piece] = self._compiled(state[piece], letter[piece])
            self.table.put(new, (follow << 16) + emitted + 0x8000)
            found = self.table.get(keys)
        return found >> 16, (found & 0xFFFF) - 0x8000

    def tokens(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each whole text."""
        if self.n_states > KEPT_STATES or self.table.size > 2 * KEPT_STATES:
            self.forget()
        if self.pairs.size > KEPT_PAIRS:
            self.pairs = lanes.Table()
        # Every text but an empty one begins with a mark.
        marked = [SPACE + x if x else "" for x in texts]
        sizes = np.array([len(x) for x in marked], np.int64)
        letters = self.letter_of[np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4")]
        return lanes.run(self.step, letters, sizes)[0]


@lru_cache(maxsize=2)
def compiled(model: str) -> Transducer:
    """The transducer of a sentencepiece byte-pair model with byte fallback; kept for a worker's later tasks."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(model))
    usual = (i for i in range(library.get_piece_size()) if not (library.is_control(i) or library.is_byte(i) or library.is_unknown(i) or library.is_unused(i)))
    return Transducer({library.id_to_piece(i): library.get_score(i) for i in usual})


def count_tokens(documents: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit, a row per row of ``documents`` (doc_id, text).

    A null or empty text has 0 bytes and 0 tokens. Repeated rows give repeated results, an empty table
    none; a null doc_id is passed on; other columns are not read, whatever their names. Texts are counted
    whole; a text beyond ``lanes.BLOCK`` characters is read in parts, each from the state the last one left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(model)
        for part in slices(batches):
            texts = part.column("text").fill_null("")
            counts = machine.tokens(texts.to_pylist())
            yield pa.RecordBatch.from_pydict(
                {"doc_id": part.column("doc_id"), "n_bytes": pc.binary_length(texts).cast(pa.int64()), "n_tokens": pa.array(counts), "over_limit": pa.array(counts > limit)}
            )

    return documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].cast("string").alias("text")).mapInArrow(run, SCHEMA)
