"""Secret scans with a token-efficiency test.

Three patterns find assignments, access keys and long hexadecimal runs. Apart from them, every run of key
characters, dots between them included, is coded with a public byte-pair vocabulary: prose and names take
several characters a token, random strings fewer than two. Where a run as a whole does not tell, each of its parts
between separators is judged alone, so a key is found in a path or behind words too. Runs that are a known digest or identifier are
excluded first; a run with the form of a name is one only if the words it is made of take several characters
a token as well, and a digest by its length is none where an assignment's name says that it is a secret.
The two findings are told side by side: a key that a pattern finds and whose token ratio is low has both spans.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from emberwave.llm.common import slices
from emberwave.llm.tokenfile import tokenizer_file

KINDS = ("assign", "access", "hex", "random")
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"

_ASSIGN = re.compile("(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]+")
_RUN = re.compile("[A-Za-z0-9+/_=-]+(?:\\.[A-Za-z0-9+/_=-]+)*")
#: What stands between separators in a run, where there are any.
_PART = re.compile("[A-Za-z0-9+]+")
_LONG = {"access": re.compile("AKIA[A-Z0-9]{16}"), "hex": re.compile("[0-9a-f]{24}"), "random": re.compile("[A-Za-z0-9+/_=.-]{20}")}

#: Hexadecimal digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_DIGITS = (32, 40, 56, 64, 96, 128)
_UUID = re.compile("[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_DIGEST = re.compile("[0-9a-f]+|[0-9A-F]+")
_INSIDE = re.compile(
    f"(?<![A-Za-z0-9])(?:{_UUID.pattern}|" + "|".join(f"[0-9a-f]{{{n}}}|[0-9A-F]{{{n}}}" for n in DIGEST_DIGITS) + ")(?![A-Za-z0-9])"
)
_NUMBER = re.compile("[0-9+/_=.-]+")
#: Names: parts of letters in one case or capitalised, or of a few digits, joined by separators or case.
_NAME = re.compile(
    "(?:[/_+=.-]*+(?>[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[A-Za-z](?![A-Za-z0-9])|(?<![A-Za-z0-9])[0-9]{1,8}+(?![A-Za-z0-9])|(?<=[a-z]{3})[0-9]{1,4}+(?![a-z0-9])))++[/_+=.-]*+"
)
_WORD = re.compile("[A-Z]?[a-z]+|[A-Z]+")


@dataclass(frozen=True)
class Test:
    """A run of ``least`` characters or more is random below ``ratio`` characters a token."""

    vocabulary: str = "byte_bpe_50k.tiktoken"
    least: int = 20
    ratio: float = 2.0


@lru_cache(maxsize=2)
def vocabulary(name: str):
    import public_tokenizers
    import tiktoken

    with open(tokenizer_file(name), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the patterns' matches, leftmost and without overlap in each kind."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if _LONG["access"].search(text):
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if _LONG["hex"].search(text):
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(found)


def _tokens(text: str, test: Test) -> int:
    return len(vocabulary(test.vocabulary).encode_ordinary(text))


def known(run: str, test: Test = Test(), named: bool = False) -> bool:
    """Whether a run is a digest, a UUID, a number, or a name made of words that are not random themselves.

    ``named`` says that it stands in an assignment to a secret; digits alone that look like a digest are then none.
    """
    if _UUID.fullmatch(run) or _NUMBER.fullmatch(run):
        return True
    if not named and len(run) in DIGEST_DIGITS and _DIGEST.fullmatch(run):
        return True
    if not _NAME.fullmatch(run):
        return False
    # Single letters between separators, as in a list of initials, say nothing.
    words = [x for x in _WORD.findall(run) if len(x) > 1]
    return sum(map(len, words)) >= test.ratio * sum(_tokens(x, test) for x in words)


def _is_random(run: str, test: Test, named: bool) -> bool:
    return len(run) >= test.least and len(run) < test.ratio * _tokens(run, test) and not known(run, test, named)


def _unknown(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """What is left of a run between the digests and UUIDs that are parts of it."""
    for m in _INSIDE.finditer(text, start, end):
        yield start, m.start()
        start = m.end()
    yield start, end


def random_spans(text: str, base: list[tuple[int, int, int]], test: Test) -> list[tuple[int, int, int]]:
    """Spans of random runs, or else of the random parts of a run; ``base`` has the patterns' spans, of which assignments tell what is named a secret."""
    if not _LONG["random"].search(text):
        return []
    found = []
    named = [(s, e) for s, kind, e in base if kind == 0]
    at = 0
    for m in _RUN.finditer(text):
        start, end = m.span()
        while at < len(named) and named[at][1] <= start:
            at += 1
        inside = at < len(named) and named[at][0] < end
        if end - start < test.least:
            continue
        for low, high in [(start, end)] if inside else _unknown(text, start, end):
            if _is_random(text[low:high], test, inside):
                found.append((low, 3, high))
            else:
                found += [(p.start(), 3, p.end()) for p in _PART.finditer(text, low, high) if p.end() - p.start() >= test.least and _is_random(p.group(), test, inside)]
    return found


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(documents: DataFrame, test: Test = Test()) -> DataFrame:
    """Counts and spans of secrets, a row per row of ``documents`` (doc_id, text).

    ``spans`` lists kind:start:end by start, then kind, in code points with the end exclusive; of an
    assignment it covers the whole match. ``base_sha256`` digests the patterns' spans alone, written
    likewise. A null text is an empty one: counts 0, no spans. Repeated rows give repeated results, an
    empty table none; a null doc_id is passed on; other columns are not read. Texts are scanned whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").fill_null("").to_pylist(), strict=True):
                base = base_spans(text)
                added = random_spans(text, base, test)
                n = [sum(kind == k for _, kind, _ in base) for k in range(3)]
                rows.append((doc_id, *n, len(added), hashlib.sha256(written(base).encode()).hexdigest(), written(sorted(base + added))))
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].cast("string").alias("text")).mapInArrow(run, SCHEMA)
