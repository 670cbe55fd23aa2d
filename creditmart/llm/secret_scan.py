"""Secrets in texts: fixed patterns, and strings that a vocabulary finds hard to spell.

A vocabulary learned from ordinary text covers ordinary strings with few tokens. A run
of letters and digits that needs many tokens for its length is random, and random runs
are keys. Runs that are known to be random for other reasons (digests of the usual
lengths, UUIDs, numbers) are excluded first; words, names of files and links have ratios
above the limits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import texts
from creditmart.llm.tokenizing import encoder

#: Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "random")
#: A run is random if its characters per token are below this.
MAX_CHARS_PER_TOKEN = 2.0
#: Characters of the shortest run that is looked at.
MIN_RUN = 16
MASK = "[SECRET]"

# letters of the keywords in either case, and no other letters that fold to them
_KEYWORDS = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "api_?key")
)
_ASSIGN = re.compile(rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_HINT = re.compile(r"pass|secret|token|api", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{MIN_RUN},}}={{0,2}}(?![A-Za-z0-9+/_-])")
_DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})", re.IGNORECASE)
_HEX_DIGITS = re.compile(r"[0-9A-Fa-f]+")
_UUID = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", re.IGNORECASE)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns' matches that are long enough."""
    found = []
    if _ASSIGN_HINT.search(text):
        found += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # a maximal run that is long enough is the same as a match of 24 or more
    found += [(m.start(), "hex", m.end()) for m in _LONG_HEX.finditer(text)]
    return found


def limit(run: str, max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> float:
    """Characters per token below which a run is random, by its length and its kinds of characters.

    Short runs vary more, so they have to be a little denser. Sixteen letters as in ``0-9A-F``
    find longer tokens by chance. Small letters alone are often compounds of syllables that
    the vocabulary lacks; they count from 32 letters on, or where hardly two share a token.
    """
    letters = run.rstrip("=")
    digits = any(c.isdigit() for c in letters)
    small = any(c.islower() for c in letters)
    # the first letter of a word may be a capital
    capital = any(c.isupper() for c in letters[1:]) or (not small and letters[:1].isupper())
    if digits + small + capital >= 2:
        if _HEX_DIGITS.fullmatch(letters):
            return 1.15 * max_chars_per_token
        return max_chars_per_token if len(letters) >= 20 else 0.95 * max_chars_per_token
    if capital or (small and len(letters) >= 32):
        return 0.95 * max_chars_per_token
    return 0.75 * max_chars_per_token if small else 0.0  # a number


def is_random(run: str, coder, max_chars_per_token: float) -> bool:
    """Whether a run of letters and digits is no known identifier and spelled with many tokens."""
    if _DIGEST.fullmatch(run) or _UUID.fullmatch(run):
        return False
    return len(run) < limit(run, max_chars_per_token) * len(coder.encode_ordinary(run))


def spans(text: str, coder, max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> list[tuple[int, str, int]]:
    """All spans: the patterns' ones, and random runs that touch none of them."""
    base = base_spans(text)
    more = []
    for match in _RUN.finditer(text):
        start, end = match.span()
        if any(s < end and start < e for s, _, e in base):
            continue
        if is_random(match.group(), coder, max_chars_per_token):
            more.append((start, "random", end))
    order = {kind: number for number, kind in enumerate(KINDS)}
    return sorted(base + more, key=lambda span: (span[0], order[span[1]]))


def _listed(found: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in found)


def scanned(docs: DataFrame, max_chars_per_token: float = MAX_CHARS_PER_TOKEN, ranks_path: str | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of ``docs``.

    ``spans`` lists kind:start:end in code points, end exclusive. Null and empty texts
    have none. Rows that repeat are scanned alike; other columns are left out; an empty
    table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(ranks_path)
        for batch in batches:
            rows = []
            for text in texts(batch.column(1)):
                found = spans(text, coder, max_chars_per_token)
                base = [span for span in found if span[1] != "random"]
                n = [sum(kind == k for _, k, _ in base) for kind in KINDS[:3]]
                rows.append((*n, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(found)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            )

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def masked(text: str, found: list[tuple[int, str, int]], mask: str = MASK) -> str:
    """The text with every span, or run of spans that overlap, replaced by ``mask``."""
    parts, at = [], 0
    for start, _, end in found:
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redacted(docs: DataFrame, max_chars_per_token: float = MAX_CHARS_PER_TOKEN, ranks_path: str | None = None) -> DataFrame:
    """``docs`` with secrets masked in ``text``; null texts stay null, other columns as they are.

    ``n_chars``, where there is one, is counted anew for texts that change.
    """
    schema = docs.schema
    names = schema.fieldNames()
    position = names.index("text")
    counted = names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(ranks_path)
        for batch in batches:
            before = batch.column(position)
            after = [
                value if value is None else masked(value, spans(value, coder, max_chars_per_token))
                for value in (item.as_py() for item in before)
            ]
            columns = list(batch.columns)
            columns[position] = pa.array(after, before.type)
            if counted is not None:
                known = zip(batch.column(counted).to_pylist(), before, after, strict=True)
                anew = [n if n is None or old.as_py() == new else type(n)(len(new)) for n, old, new in known]
                columns[counted] = pa.array(anew, batch.column(counted).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, schema)
