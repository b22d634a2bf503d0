"""Secret scan: pattern rules plus a token-efficiency test for random strings.

A run of token characters that a public byte-pair vocabulary can only spell with very few characters per token is
a random string: words, names and paths are in the vocabulary, key material is not. Every run is measured whole and, if
it passes, by its parts between separators, so that words around a key do not hide it; next to a span of the pattern
rules, what lies outside that span is measured. Known digests (hex of a digest's length), UUIDs and numbers are left out
of that test; the pattern rules still report them.

Defined cases: a null or empty text has no spans; a null id, repeated rows and extra columns pass through as they
are; offsets are code points with the end exclusive; a text of any length is scanned whole.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

# The rules of the scan.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})", re.I)
UUID = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", re.I)
#: Separators by which a run is parted, one after the other, and the length from which a part is measured.
SEPARATORS, LEAST_PART = (re.compile(r"[^/]+"), re.compile(r"[^+/_-]+")), 16
#: The longest piece given to the tokenizer at once; a longer run is measured piece by piece.
PIECE = 512

SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long, "
          "random_ratio double")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the three pattern rules, each leftmost and non-overlapping."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if ("=" in text or ":" in text) else []
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def known(run: str) -> bool:
    """Digests, UUIDs, and numbers or rules without a letter."""
    core = run.rstrip("=")
    return bool(DIGEST.fullmatch(core) or UUID.fullmatch(core)) or not any(c.isalpha() for c in core)


class TokenRatio:
    """Characters per token of a string under a ranks file of a public tokenizer."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._enc = tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, run: str) -> float:
        tokens = sum(len(self._enc.encode_ordinary(run[i:i + PIECE])) for i in range(0, len(run), PIECE))
        return len(run) / max(1, tokens)


def outside(start: int, end: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of what the spans of ``base`` (sorted) leave of a run."""
    left = []
    for s, _, e in base:
        if s < end and start < e:
            left.append((start, s))
            start = e
    return [(s, e) for s, e in [*left, (start, end)] if e - s >= LEAST_PART]


def random_spans(text: str, ratio, max_ratio: float, base: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int]], float]:
    """Spans of random runs, or random parts of runs, outside the pattern spans, and the lowest ratio seen (0 if no run was measured)."""
    found, lowest = [], 0.0

    def measure(start: int, end: int, level: int) -> None:
        nonlocal lowest
        run = text[start:end]
        if known(run):
            return
        r = ratio(run)
        lowest = r if not lowest else min(lowest, r)
        if r <= max_ratio:
            found.append((start, 3, end))
            return
        for level in range(level, len(SEPARATORS)):
            parts = [(start + m.start(), start + m.end()) for m in SEPARATORS[level].finditer(run)]
            if parts != [(start, end)]:
                for s, e in parts:
                    if e - s >= LEAST_PART:
                        measure(s, e, level + 1)
                return

    for m in RUN.finditer(text):
        for s, e in outside(m.start(), m.end(), base):
            measure(s, e, 0)
    return found, lowest


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan_text(text: str | None, ratio, max_ratio: float) -> tuple:
    text = text or ""
    base = base_spans(text)
    extra, lowest = random_spans(text, ratio, max_ratio, base)
    n = [sum(k == i for _, k, _ in base) for i in range(3)]
    return *n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + extra), len(extra), lowest


def scan_secrets(docs: DataFrame, ranks: str = "byte_bpe_50k.tiktoken", max_ratio: float = 2.0) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts by rule, digest of the rule spans, all spans.

    ``ranks`` names a file of the public tokenizers' folder, found on each executor. A pure map: no shuffle.
    """

    def run(batches):
        import public_tokenizers as tokenizers

        ratio = TokenRatio(tokenizers.path(ranks), tokenizers.PATTERN)
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        for batch in batches:
            rows = [scan_text(t.as_py(), ratio, max_ratio) for t in batch.column(1)]
            cols = list(zip(*rows)) if rows else [[] for _ in names[1:]]
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(cols, types))], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
