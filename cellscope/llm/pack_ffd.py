"""Packing tokenized documents into sequences: first-fit decreasing with a tournament tree of bin capacities.

Documents are cut into full sequences of LENGTH ids and one shorter piece. Full pieces are sequences of their own; the
shorter ones are dealt at random into groups of about GROUP pieces, and each group is packed on its own: pieces by
decreasing length, each into the first sequence with room, which the tree finds in logarithmic steps (a node holds
the greatest room below it). Groups are bounded at any input size, and a document that is repeated many times spreads
over all groups, since a piece's group comes from its place in the stored piece table.

Texts are tokenized part by part: the tokenizer's normalizer and word splitting never look across ASCII white space
and encode the parts of a word on their own, so the ids of parts are kept and reused (up to PARTS parts a worker).

Defined cases: null and empty texts are documents of just the end id; null ids and repeated rows are documents like
others; a text of any length is tokenized whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import parts_for, stored

LENGTH, END = 2048, 1
GROUP = 4096
#: Word parts a worker remembers, and characters of text tokenized at a time.
PARTS, CHARS = 500_000, 1 << 20


class WordIds:
    """Token ids of texts, with the ids of word parts kept and reused.

    Text of ASCII and Latin-1 letters, digits and punctuation is split into the parts that the tokenizer encodes one
    by one; a word with other characters is one part. New letter runs are encoded many at a time: the last id of a
    run is one that ends a word.
    """

    SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zßà-öø-ÿ]+|[0-9]|[^\sa-z0-9ßà-öø-ÿ]+")
    SIMPLE = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
    WORD = re.compile(r"[^\t-\r ]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocab = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocab.values()) + 1, bool)
        self._ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self._ids: dict[str, bytes] = {}

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _split(self, text: str) -> list[str]:
        if self.SIMPLE.fullmatch(text):
            return self.SPLIT.findall(text.lower())
        return [p for w in self.WORD.findall(text) for p in (self.SPLIT.findall(w.lower()) if self.SIMPLE.fullmatch(w) else [w])]

    def _learn(self, new: set[str]) -> None:
        ids_of = self._ids
        runs = [p for p in new if p.isalpha()]
        for p in new.difference(runs):
            ids_of[p] = self._encode(p).tobytes()
        portions = [runs[begin:begin + 2048] for begin in range(0, len(runs), 2048)]
        for some, found in zip(portions, self._tokenizer.encode_batch_fast([" ".join(p) for p in portions], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            cut = np.flatnonzero(self._ends[ids]) + 1
            if len(cut) != len(some):  # a run that the tokenizer cuts further: one at a time
                ids_of.update((p, self._encode(p).tobytes()) for p in some)
                continue
            data, at = ids.tobytes(), 0
            for p, end in zip(some, (4 * cut).tolist()):
                ids_of[p] = data[at:end]
                at = end

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers, without an end id."""
        parts = [self._split(t.encode("utf-8", "replace").decode() if t else "") for t in texts]
        if len(self._ids) > PARTS:
            self._ids.clear()
        self._learn(set().union(*parts).difference(self._ids))
        get = self._ids.__getitem__
        return [b"".join(map(get, p)) for p in parts]


@functools.cache
def word_ids(path: str) -> WordIds:
    """One per Python worker, which serves several tasks."""
    return WordIds(path)


class Rooms:
    """Tournament tree over bins; a node holds the greatest room of the bins below it."""

    def __init__(self, bins: int, capacity: int):
        self.size = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.size)

    def first(self, need: int) -> int:
        """The first bin with at least ``need`` room takes it; its number is returned."""
        room, node = self.room, 1
        while node < self.size:
            node *= 2
            if room[node] < need:
                node += 1
        room[node] -= need
        found = node - self.size
        node //= 2
        while node:
            room[node] = max(room[2 * node], room[2 * node + 1])
            node //= 2
        return found


def first_fit_decreasing(lengths: np.ndarray, capacity: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; longer pieces first, equal ones in the given order."""
    order = np.argsort(-lengths, kind="stable")
    rooms, where, offset, used = Rooms(len(lengths), capacity), np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), {}
    for i in order.tolist():
        b = rooms.first(int(lengths[i]))
        where[i], offset[i] = b, used.get(b, 0)
        used[b] = int(offset[i] + lengths[i])
    return where, offset


def _portions(ids: list, texts):
    """Rows in portions of about CHARS characters."""
    some, n = [], 0
    for i, t in zip(ids, texts):
        t = t.as_py()
        some.append((i, t))
        n += len(t or "")
        if n >= CHARS:
            yield some
            some, n = [], 0
    if some:
        yield some


def _pieces(vocabulary: str, length: int):
    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        import public_tokenizers

        tokenize = word_ids(public_tokenizers.path(vocabulary))
        end = np.array([END], "<u4").tobytes()
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        for batch in batches:
            rows = []
            for some in _portions(batch.column(0).to_pylist(), batch.column(1)):
                for (i, _), data in zip(some, tokenize([t for _, t in some])):
                    data += end
                    n = len(data) // 4
                    rows += [(i, s, min(length, n - s), zlib.crc32(data[4 * s:4 * (s + length)]), n) for s in range(0, n, length)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)], names=names)

    return run


def _pack(length: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("piece", kind="stable").reset_index(drop=True)
        where, offset = first_fit_decreasing(frame["length"].to_numpy(), length)
        first = np.full(where.max() + 1, -1, np.int64)
        np.maximum.at(first, where, frame["piece"].to_numpy())
        return frame.assign(sequence_id=first[where], offset=offset).drop(columns=["piece", "group"])

    return run


def pack_documents(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", length: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A sequence is named by one of its pieces, so names are unique over all groups and full pieces. ``vocabulary``
    names a file of the public tokenizers' folder, found on each executor.
    """
    cut = docs.select("doc_id", "text").mapInArrow(_pieces(vocabulary, length), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    cut = stored(cut.withColumn("piece", F.monotonically_increasing_id()), "pack-pieces")
    whole = cut.where(F.col("length") == length).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("piece").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = cut.where(F.col("length") < length)
    groups = parts_for(short.count(), GROUP)
    short = short.withColumn("group", F.pmod(F.xxhash64(F.lit(23), "piece"), F.lit(groups)))
    packed = short.groupBy("group").applyInPandas(_pack(length), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return whole.union(packed.select(*whole.columns))
