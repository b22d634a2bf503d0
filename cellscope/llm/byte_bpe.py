r"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary's byte strings resolves pre-tokens that are whole entries. The hash
has levels; a key that is alone in its slot of a level rests there, the others go down to the next level, and a key's
number is the count of taken slots before its own. A number is compared with the entry that owns it, so foreign
strings never pass. Tier two: every other pre-token is merged on its own, with a heap of adjacent pairs over a linked
list of its bytes, the least rank first and the leftmost of equal ones.

A text is cut into pre-tokens by the public pattern; a text of any length is cut whole, in portions that end where a
token must end (a letter before a space and a letter). Each portion's distinct pre-tokens are resolved once. A portion
without characters above U+FFFF is cut by the standard library's engine, which is given the classes' characters one by one.

Defined cases: null and empty texts have no ids; null ids and repeated rows are rows like others; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from cellscope.llm.common import mix64

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Characters cut into pre-tokens at a time, and merged pre-tokens a worker remembers (a memory, not a bound on work).
CHARS, REMEMBERED = 1 << 20, 400_000
#: Slots of a level for each key that has none yet.
ROOM = 1.6

#: Letters and numbers that came to Unicode after version 16, which the tokenizer's tables do not know.
YOUNG_LETTERS = r"""
\u0558 \u058b-\u058c \u088f \u0c5c \u0cdc \u208f \u209d-\u209f \ua7ce-\ua7cf \ua7d2 \ua7d4 \ua7dd \ua7e2 \ua7f1 \uab6c-\uab6d
\U000107bb-\U000107bf \U00010940-\U00010959 \U00010ec5-\U00010ec7 \U00010ed9-\U00010eee \U00011b0a \U00011db0-\U00011ddb
\U00011df1 \U00016ea0-\U00016eb8 \U00016ebb-\U00016ed3 \U00016ff2-\U00016ff3 \U000187f8-\U000187ff \U00018cd6-\U00018cda
\U00018d09-\U00018d20 \U00018d80-\U00018df2 \U00018e00-\U00019191 \U000191a0-\U000191d2 \U0001b123-\U0001b128 \U0001b168
\U0001d6a6 \U0001df1f-\U0001df24 \U0001df2b-\U0001df81 \U0001df90-\U0001df96 \U0001dfcd-\U0001dfff \U0001e6c0-\U0001e6de
\U0001e6e0-\U0001e6e2 \U0001e6e4-\U0001e6e5 \U0001e6e7-\U0001e6ed \U0001e6f0-\U0001e6f4 \U0001e6fe-\U0001e6ff
\U0002b73a-\U0002b73f \U0002b81e \U0002cea2-\U0002cead \U000323b0-\U00033479 \U0003d000-\U0003fc3f
"""
YOUNG_NUMBERS = r"\U00011de0-\U00011de9 \U0001246f \U00012475-\U0001247f \U00012550-\U00012686 \U00016ff4-\U00016ff6"


def splitter(pattern: str) -> regex.Pattern:
    """The public pattern with the tokenizer's notion of letters and numbers."""
    for kind, young in (("L", YOUNG_LETTERS), ("N", YOUNG_NUMBERS)):
        pattern = pattern.replace(rf"\p{{{kind}}}", rf"[\p{{{kind}}}--[{''.join(young.split())}]]")
    return regex.compile(f"(?V1){pattern}")


def plane_splitter(pattern: str) -> re.Pattern:
    """``splitter`` for texts without characters above U+FFFF: its classes' characters are listed, as ranges."""
    plane = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x10000))))
    listed = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        ranges = itertools.groupby(enumerate(splitter(name).findall(plane)), lambda at: ord(at[1]) - at[0])
        ends = [(found[0][1], found[-1][1]) for found in (list(group) for _, group in ranges)]
        listed[name] = "".join(f"{re.escape(first)}-{re.escape(last)}" for first, last in ends)

    def spelled(found: re.Match) -> str:
        inner = re.sub(r"\\p\{[LN]\}|\\s", lambda name: listed[name[0]], found[0])
        return inner if found[0][0] == "[" else f"[{inner}]"

    return re.compile(re.sub(r"\[[^\]]*\]|\\p\{[LN]\}|\\s", spelled, pattern.replace(r"\S", r"[^\s]")))


class PerfectHash:
    """Minimal perfect hash over distinct byte strings: each key's own number below their count, found in arrays."""

    def __init__(self, keys: list[bytes]):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, base = self._digest(keys), 0
        if len(np.unique(left)) < len(left):
            raise ValueError("keys must be distinct")
        while len(left):
            slots = self._slots(left, len(self.levels), int(ROOM * len(left)) + 1)
            alone = np.bincount(slots, minlength=int(ROOM * len(left)) + 1) == 1
            self.levels.append((alone, base + np.cumsum(alone) - 1))
            base += int(alone.sum())
            left = left[~alone[slots]]

    @staticmethod
    def _digest(keys: Iterable[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)

    @staticmethod
    def _slots(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(digests + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(size)).astype(np.int64)

    def __call__(self, keys: list[bytes]) -> np.ndarray:
        """A number for each key; -1 for some strings that are no keys, any number for the others."""
        found, left, at = np.full(len(keys), -1, np.int64), self._digest(keys), np.arange(len(keys))
        for level, (alone, number) in enumerate(self.levels):
            slots = self._slots(left, level, len(alone))
            here = alone[slots]
            found[at[here]] = number[slots[here]]
            left, at = left[~here], at[~here]
        return found


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of least rank, leftmost first, becomes one part until no pair has a rank."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins here; 0 when a part was swallowed
    before = list(range(-1, n))  # beginning of the part to the left
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of the two has changed since
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if i and (r := ranks.get(piece[before[i]:stop])) is not None:
            heapq.heappush(heap, (r, before[i], stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


class Codec:
    """Encodes texts to ids and decodes ids to bytes."""

    CUT = regex.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split, self.split_plane = ranks, splitter(pattern), plane_splitter(pattern)
        self.perfect = PerfectHash(list(ranks))
        numbers = self.perfect(list(ranks))
        self.owner, self.id_of = [b""] * len(ranks), np.zeros(len(ranks), "<u4")
        for number, (key, rank) in zip(numbers.tolist(), ranks.items()):
            self.owner[number], self.id_of[number] = key, rank
        self.bytes_of = dict(zip(ranks.values(), ranks))
        self.merged: dict[bytes, bytes] = {}

    def resolve(self, tokens: list[str]) -> dict[str, bytes]:
        """The ids of distinct pre-tokens, as little-endian unsigned 32-bit numbers."""
        keys = [t.encode("utf-8", "replace") for t in tokens]
        if len(self.merged) > REMEMBERED:
            self.merged.clear()
        found = {}
        for token, key, number in zip(tokens, keys, self.perfect(keys).tolist()):
            if number >= 0 and self.owner[number] == key:
                found[token] = self.id_of[number].tobytes()
                continue
            ids = self.merged.get(key)
            if ids is None:
                ids = self.merged[key] = np.array(merge(key, self.ranks), "<u4").tobytes()
            found[token] = ids
        return found

    def portions(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > CHARS:
            cut = self.CUT.search(text, start + CHARS)
            if not cut:
                break
            yield text[start:cut.start()]
            start = cut.start()
        yield text[start:]

    def pre_tokens(self, portion: str) -> list[str]:
        plane = portion.isascii() or len(portion.encode("utf-16-le", "replace")) == 2 * len(portion)
        return (self.split_plane if plane else self.split).findall(portion)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Each text's ids."""
        cut, distinct = [], set()
        for text in texts:
            found = [self.pre_tokens(p) for p in self.portions(text)] if text else []
            distinct.update(*found)
            cut.append(found)
        ids = self.resolve(list(distinct)).__getitem__
        return [np.frombuffer(b"".join(map(ids, itertools.chain.from_iterable(found))), "<u4") for found in cut]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@functools.cache
def codec(vocabulary: str) -> Codec:
    """One per Python worker, which serves several tasks; ``vocabulary`` names a file of the public tokenizers' folder."""
    import public_tokenizers

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(key): int(rank) for key, rank in map(bytes.split, lines)}
    return Codec(ranks, public_tokenizers.PATTERN)


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """Rows of (other columns, text) in groups of about CHARS characters."""
    others, texts, n = [], [], 0
    for other, text in zip(zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns - 1))), batch.column(batch.num_columns - 1)):
        text = text.as_py()
        others.append(other)
        texts.append(text)
        n += len(text or "")
        if n >= CHARS:
            yield others, texts
            others, texts, n = [], [], 0
    if others:
        yield others, texts


def _digests(vocabulary: str):
    def run(batches):
        coder = codec(vocabulary)
        decimal = {i: str(i) for i in coder.bytes_of}.__getitem__
        names, kinds = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], [pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            rows = []
            for others, texts in _batches(batch):
                for (doc_id,), ids in zip(others, coder.encode(texts)):
                    listed = ",".join(map(decimal, ids.tolist()))
                    rows.append((doc_id, len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)], names=names)

    return run


def _ids(vocabulary: str):
    def run(batches):
        coder = codec(vocabulary)
        for batch in batches:
            rows = [(doc_id, ids.astype(np.int32)) for others, texts in _batches(batch) for (doc_id,), ids in zip(others, coder.encode(texts))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def _texts(vocabulary: str):
    def run(batches):
        coder = codec(vocabulary)
        for batch in batches:
            data = [coder.decode(ids.values.to_numpy()) if ids.is_valid else b"" for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "bytes"])

    return run


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids): the ids of each whole text."""
    return docs.select("doc_id", "text").mapInArrow(_ids(vocabulary), "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, bytes): the bytes that each row's ids stand for; null ids give none."""
    return encoded.select("doc_id", "ids").mapInArrow(_texts(vocabulary), "doc_id long, bytes binary")


def digest_documents(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 (decimal ids, comma-joined), decoded_sha256 (their bytes)."""
    return docs.select("doc_id", "text").mapInArrow(_digests(vocabulary), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
