"""Secrets by pattern, and by how little a primed compressor can make of them."""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartpost.llm.tables import session

# The patterns of the base kinds.
ASSIGN = re.compile(
    r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ACCESS_CHARS, HEX_CHARS, VALUE_CHARS = 20, 24, 6
# A run of this many hex digits is where a HEX match can be long enough.
HEX_RUN = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")

# Novelty: words that make the block of text they stand in sensitive.
SENSITIVE = re.compile(
    r"(?ai:passw|passphrase|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|credential|bearer|authorization)"
)
HINTS = ("passw", "passp", "pwd", "secret", "token", "key", "credential", "bearer", "authoriz")
BLOCK_END = re.compile(r"\n[^\S\n]*\n")
# Beyond its block a context goes on over any text this short, and until prose resumes: words in a row.
REACH = 64
PROSE = re.compile(r"(?<![^\W\d_])(?:[^\W\d_]++[.,;:!?\"')]*+\s++){7}[^\W\d_]")
LEAST_CHARS = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
# A wrapped string goes on as a whole line; its last line may be short, but is not a word.
NEXT_LINE = re.compile(r"\\?[\"',]?[^\S\n]*\n[^\S\n]*[\"'>#*]?[^\S\n]*([A-Za-z0-9+/_=-]+)(?=\\?[\"',;]*[^\S\n]*(?:\n|\Z))")
NO_WORD = re.compile(r"[0-9+/=]|[a-z][A-Z]")
AROUND = 256
# Marginal compressed bytes per character from which a string is novel, unless its alphabet has fewer bits.
NOVEL = 0.75
ALPHABETS = [
    (re.compile(letters), math.log2(size) / 8)
    for letters, size in (
        ("[0-9a-f_=-]+", 16),
        ("[0-9A-F_=-]+", 16),
        ("[0-9a-z_=-]+", 36),
        ("[0-9A-Z_=-]+", 36),
        ("[0-9A-Za-z_=-]+", 62),
    )
]
# Without digits, or without letters, a string is held against the letters that words are made of.
NOVEL_DIGITS, NOVEL_LETTERS, NOVEL_BOTH_CASES = 0.6, 0.65, 0.72
# Identifiers that code is full of; the compressor knows them before it starts.
IDENTIFIERS = (
    "access_key access_token api_key authorization bearer begin certificate client_id client_secret config "
    "connection_string const credentials database default end environment export false function getenv header "
    "host import instance key localhost main name null object password path port private_key public_key request "
    "response return secret_access_key self server session settings static string timeout token true url user "
    "username value version 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ example.com http:// "
    "https:// application/json Content-Type Accept-Encoding SELECT FROM WHERE INSERT UPDATE"
)

Span = tuple[int, int, int]


class Novelty:
    """Marginal cost of a string for a compressor primed with identifiers and its context."""

    def __init__(self, identifiers: str = IDENTIFIERS):
        primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.press = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_dict_id=False)
        self.identifiers, self.bare = identifiers, zstandard.ZstdCompressor(level=19, write_content_size=False)
        self.last = ("", 0)

    def size(self, text: str) -> int:
        return len(self.press.compress(text.encode()))

    def share(self, before: str, string: str, after: str) -> float:
        context = before + after
        if context != self.last[0]:
            self.last = (context, self.size(context))
        return (self.size(context + string) - self.last[1]) / len(string)

    def letter_share(self, before: str, string: str, after: str) -> float:
        """Share beside the identifiers as text, whose letters tell common from rare ones.

        Further copies of the string would tell of it and are left out.
        """
        context = f"{self.identifiers} {(before + after).replace(string, '')} ".encode()
        grown = len(self.bare.compress(context + string.encode()))
        return (grown - len(self.bare.compress(context))) / len(string)


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the base kinds, leftmost and non-overlapping within each."""
    low = text.lower()
    found = []
    if any(word in low for word in ("passw", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= VALUE_CHARS]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    # A match is a whole run, so runs that are long enough are the matches that stay.
    found += [(m.start(), 2, m.end()) for m in HEX_RUN.finditer(text)]
    return sorted(found)


def novel_spans(text: str, novelty: Novelty, base: list[Span]) -> list[Span]:
    """Strings in a sensitive context that do not compress.

    Strings inside a base span are known already.  A run of candidate characters is
    measured whole, then from its first sensitive word on, then between its sensitive
    words: each character a few times, however many words there are.
    """
    low = text.lower()
    if not base and not any(hint in low for hint in HINTS):
        return []
    runs = [m.span() for m in CANDIDATE.finditer(text)]
    if not runs:
        return []
    words = [m.span() for m in SENSITIVE.finditer(text)]
    known, context = _Known(base), _Context(text, runs, base)
    found = {}
    strings = set()
    for start, end in _in_context(text, runs, words, base):
        if known.meets(start, end):
            continue
        plain = set()
        for at, to in _stretches(start, end, words):
            string = text[at:to]
            if string in plain:
                continue
            if string in strings or context.is_novel(novelty, at, to):
                strings.add(string)
                found[at] = to
                if to == end:
                    break
            else:
                plain.add(string)
    found = _continued(text, novelty, context, found, known)
    found |= _copies(text, _free(runs, found, known), strings)
    return sorted((start, 3, end) for start, end in found.items())


class _Known:
    """Spans, to be asked for an overlap."""

    def __init__(self, base: list[Span]):
        base = sorted(base)
        self.starts, self.ends = [a for a, _, _ in base], []
        for _, _, b in base:
            self.ends.append(max(b, self.ends[-1]) if self.ends else b)

    def meets(self, start: int, end: int) -> bool:
        before = bisect(self.starts, end - 1)
        return before > 0 and self.ends[before - 1] > start


def _mixed(string: str) -> bool:
    return any(c.isdigit() for c in string) and any(c.isalpha() for c in string)


def least_share(string: str) -> float:
    """Share from which a string is novel: that of random strings in its alphabet, NOVEL at most."""
    if not any(map(str.isalpha, string)):
        return NOVEL_DIGITS
    if not any(map(str.isdigit, string)):
        return NOVEL_LETTERS if string.islower() or string.isupper() else NOVEL_BOTH_CASES
    return min([NOVEL, *(bits for letters, bits in ALPHABETS if letters.fullmatch(string))])


class _Context:
    """The text without base spans and candidates, which would tell of each other."""

    def __init__(self, text: str, runs: list[tuple[int, int]], base: list[Span]):
        self.text, pieces, at, size = text, [], 0, 0
        self.ends, self.offsets = [], []
        for start, end in sorted([*runs, *((start, end) for start, _, end in base)]):
            if start > at:
                pieces.append(text[at:start])
                size += start - at
            at = max(at, end)
            self.ends.append(at)
            self.offsets.append(size)
        self.rest = "".join([*pieces, text[at:]])

    def is_novel(self, novelty: Novelty, start: int, end: int) -> bool:
        """Whether the string there is, beside the AROUND characters left before and after its run."""
        at = self.offsets[bisect(self.ends, start)]
        string = self.text[start:end]
        share = novelty.share if _mixed(string) else novelty.letter_share
        return share(self.rest[max(0, at - AROUND) : at], string, self.rest[at : at + AROUND]) >= least_share(string)


def _stretches(start: int, end: int, words: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Where a string may be in a run: all of it, all after its first sensitive word, between its words."""
    yield start, end
    i = bisect(words, (start, start))
    # A word may begin before the run and end in it.
    i -= i > 0 and words[i - 1][1] > start
    at, is_first = start, True
    while i < len(words) and words[i][0] < end:
        a, b = words[i]
        if a - at >= LEAST_CHARS:
            yield at, a
        at = b
        if is_first and end - at >= LEAST_CHARS:
            yield at, end
        i, is_first = i + 1, False
    if not is_first and end - at >= LEAST_CHARS:
        yield at, end


def _in_context(text: str, runs: list[tuple[int, int]], words: list[tuple[int, int]], base: list[Span]) -> list[tuple[int, int]]:
    """Runs in a sensitive context.

    That is a block, up to an empty line, with a sensitive word before or after the run;
    and from there, or from a base span, from run to run until prose resumes.
    """
    ends = [m.start() for m in BLOCK_END.finditer(text)]
    sensitive = {bisect(ends, start) for start, _ in words}
    inside = {run for run in runs if bisect(ends, run[0]) in sensitive}

    def carried(gap: str) -> bool:
        return len(gap) <= REACH or not PROSE.search(gap)

    marks = [(start, end, False) for start, end in words] + [(start, end, False) for start, _, end in base]
    at = None
    for start, end, is_run in sorted([*marks, *((*run, True) for run in runs)]):
        if not is_run:
            at = max(at or 0, end)
        elif (start, end) in inside or (at is not None and carried(text[at:start])):
            inside.add((start, end))
            at = max(at or 0, end)
        else:
            at = None
    at = None
    for start, end, is_run in sorted([*((*word, False) for word in words), *((*run, True) for run in runs)], reverse=True):
        if not is_run or (start, end) in inside or (at is not None and carried(text[end:at])):
            if is_run:
                inside.add((start, end))
            at = start
        else:
            at = None
    return sorted(inside)


def _continued(text: str, novelty: Novelty, context: _Context, found: dict[int, int], known: _Known) -> dict[int, int]:
    """``found`` with the lines that go on a wrapped string: equally long ones, and a shorter last one."""
    out = dict(found)
    for start, end in sorted(found.items()):
        while line := NEXT_LINE.match(text, end):
            a, b = line.span(1)
            if a in out or b - a > end - start or known.meets(a, b):
                break
            if b - a >= 16 and not (b - a == end - start and context.is_novel(novelty, a, b)):
                break
            if b - a < 16 and not NO_WORD.search(line[1]):
                break
            out[a] = b
            if b - a < end - start:
                break
            start, end = a, b
    return out


def _free(runs: list[tuple[int, int]], found: dict[int, int], known: _Known) -> Iterator[tuple[int, int]]:
    """Parts of runs outside base spans' runs and found strings."""
    starts = sorted(found)
    for start, end in runs:
        if known.meets(start, end):
            continue
        at = start
        for a in starts[bisect(starts, start - 1) : bisect(starts, end - 1)]:
            if a > at:
                yield at, a
            at = found[a]
        if at < end:
            yield at, end


def _copies(text: str, parts: Iterator[tuple[int, int]], strings: set[str]) -> dict[int, int]:
    """Further places of ``strings`` in ``parts``, alone or within longer ones."""
    found, sizes = {}, {}
    for head, size in sorted({(string[:LEAST_CHARS], len(string)) for string in strings}, reverse=True):
        sizes.setdefault(head, []).append(size)
    for at, end in parts if sizes else ():
        while at <= end - LEAST_CHARS:
            lengths = sizes.get(text[at : at + LEAST_CHARS], ())
            size = next((n for n in lengths if at + n <= end and text[at : at + n] in strings), 0)
            if size:
                found[at] = at + size
            at += size or 1
    return found


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan(text: str | None, novelty: Novelty) -> tuple[list[Span], list[Span]]:
    """Base spans, and those of the method."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, novel_spans(text, novelty, base)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    novelty = Novelty()
    for batch in batches:
        rows = [scan(text.as_py(), novelty) for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *[pa.array([sum(k == kind for _, k, _ in base) for base, _ in rows], pa.int64()) for kind in range(3)],
                pa.array([sha256(spans_text(base).encode()).hexdigest() for base, _ in rows]),
                pa.array([spans_text(base + novel) for base, novel in rows]),
            ],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def find_secrets(documents: DataFrame) -> DataFrame:
    """Secrets of each row of ``documents`` (doc_id, text; others ignored).

    Counts of the base kinds, the hash of their spans, and all spans as
    kind:start:end in code points, end exclusive.  A null or empty text has none;
    repeated rows are scanned each; an empty table gives no rows.
    """
    session(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        _find, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redacted(text: str | None, novelty: Novelty, mark: str) -> str | None:
    """``text`` with each run of overlapping spans replaced by ``mark``."""
    base, novel = scan(text, novelty)
    out, at = [], 0
    for start, _, end in sorted(base + novel):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def redact_secrets(documents: DataFrame, mark: str = "[secret]") -> DataFrame:
    """All documents and columns, secrets in text replaced by ``mark`` and n_chars renewed.

    Null and empty texts stay as they are (a null text keeps its n_chars), repeated rows
    are cleaned each, texts of any length are scanned whole, further columns pass through;
    an empty table gives no rows.
    """
    session(documents.sparkSession)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        novelty = Novelty()
        return pd.Series([redacted(text, novelty, mark) for text in texts], dtype=object)

    out = documents.withColumn("text", clean("text"))
    if "n_chars" in documents.columns:
        renewed = F.coalesce(F.char_length("text").cast("long"), F.col("n_chars").cast("long"))
        out = out.withColumn("n_chars", renewed)
    return out.select(*documents.columns)
