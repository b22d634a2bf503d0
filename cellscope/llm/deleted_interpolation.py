"""Language-model scores by deleted interpolation.

A bigram, a unigram and a uniform estimate are mixed with weights that depend on how often the context was seen
(buckets of its count, powers of two). The weights are learned by expectation-maximisation on held-out counts: a
tenth of the training documents is deleted from the counts and scored with the rest. Final counts use all training
documents.

How it runs: documents become blocks of token numbers with the block's own vocabulary, written once. A block sends
the counts of its distinct words and bigrams, keyed by 64-bit hashes and packed by key range, to the shuffle; each
range sums its keys over all blocks and answers every block with the totals of its keys. A frequent word is one entry
in each block's message, so no key is hot, and the number of ranges grows with the corpus, so a range stays bounded.

Words are runs of characters other than ASCII white space with A-Z lower-cased; every text ends with one end token.
The base score is the unigram model with 0.1 added to every count. Words and bigrams are told apart by 64-bit hashes
(bigrams within their range by 48 bits).

Defined cases: a null or empty text has just the end token; a null doc_id counts as training and is scored; repeated
rows count as often as they stand; without any training token scores are 0 known, and the mixture falls back to the
uniform part; texts of any length are scored whole.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import lower_bytes, mix64, parts_for, pieces, stored

#: One document in HOLD is held out from training, and one in HOLD more (of the training part) from the EM counts.
HOLD, HELD_OUT, EM_PART = 10, 0, 1
#: Tokens in a block, and keys in a range.
BLOCK_TOKENS, RANGE_KEYS = 2_000_000, 1_000_000
BUCKETS = 24
#: EM runs on counts of (bucket, bigram part, unigram part) with both parts in steps of 2^(1/STEPS) above uniform.
STEPS, EM_ROUNDS = 8, 60
END = b"\n"  # no word holds white space


def _hash(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _bigram(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mix64(mix64(before) * np.uint64(3) + after)


class _Builder:
    """Gathers documents of one kind into a block."""

    def __init__(self, kind: int):
        self.kind = kind
        self.clear()

    def clear(self):
        self.vocab: dict[bytes, int] = {END: 0}
        self.ids, self.docs, self.sizes, self.tokens = [], [], [], 0

    def add(self, doc_id, text):
        vocab, found = self.vocab, []
        for part in pieces(lower_bytes(text)):
            words = part.split()
            for w in words:
                if w not in vocab:
                    vocab[w] = len(vocab)
            found.append(np.fromiter(map(vocab.__getitem__, words), np.int32, len(words)))
        found.append(np.zeros(1, np.int32))
        self.ids += found
        self.docs.append(doc_id)
        self.sizes.append(sum(map(len, found)))
        self.tokens += self.sizes[-1]

    def rows(self):
        if not self.docs:
            return []
        ids = np.concatenate(self.ids)
        row = (self.kind, self.tokens, len(self.vocab), _hash(list(self.vocab)).tobytes(), _short(ids), list(self.docs), list(self.sizes))
        self.clear()
        return [row]


_BLOCK = "kind int, tokens long, words long, vocab binary, ids binary, docs array<long>, sizes array<long>"
_BLOCK_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def _blocks(batches):
    """Documents to blocks; kind 0 is held out, 1 trains and serves the EM, 2 trains."""
    kinds = [_Builder(k) for k in range(3)]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _BLOCK_TYPES)], names=[f.split()[0] for f in _BLOCK.split(", ")])

    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1)):
            fold = zlib.crc32(str(i).encode()) % HOLD if i is not None else 2
            builder = kinds[0 if fold == HELD_OUT else 1 if fold == EM_PART else 2]
            builder.add(i, t.as_py())
            if builder.tokens >= BLOCK_TOKENS:
                yield batch(builder.rows())
    for builder in kinds:
        if rows := builder.rows():
            yield batch(rows)


def _bigrams(vocab: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of a block the vocabulary place of its context (the end token before a text) and its bigram key."""
    context = np.empty_like(ids)
    context[1:] = ids[:-1]
    context[np.cumsum(sizes) - sizes] = 0  # each text's first token follows an end
    return context, _bigram(vocab[context], vocab[ids])


def _ranges(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _split(keys: np.ndarray, counts: np.ndarray, n: int):
    """Sorted keys with counts, cut by range; only ranges that have keys."""
    part, first = np.unique(_ranges(keys, n), return_index=True)
    for r, begin, end in zip(part.tolist(), first, np.append(first[1:], len(keys))):
        yield r, keys[begin:end], counts[begin:end]


def _pack(keys: np.ndarray) -> bytes:
    """Low 48 bits of the keys; the range and these tell keys apart."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    raw = np.zeros((len(data) // 6, 8), np.uint8)
    raw[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return raw.view("<u8").ravel().astype(np.uint64)


def _short(counts: np.ndarray) -> bytes:
    """Counts in the shortest unsigned integers that hold them all, after one byte with their width."""
    top = int(counts.max()) if len(counts) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _long(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[list]:
    return [batch.column(n).to_pylist() for n in names]


def _read(kind, vocab, ids, sizes):
    return np.frombuffer(vocab, np.uint64), _long(ids).astype(np.int64), np.array(sizes, np.int64)


def _ask(n_words: int, n_bigrams: int):
    """Map from a block to its messages: what (0 words, 1 bigrams), range, keys and the block's own counts."""

    def run(batches):
        for batch in batches:
            for block, kind, vocab, ids, sizes in zip(*_columns(batch, ["block", "kind", "vocab", "ids", "sizes"])):
                vocab, ids, sizes = _read(kind, vocab, ids, sizes)
                own = np.bincount(ids, minlength=len(vocab))
                order = np.argsort(vocab, kind="stable")
                messages = [(0, vocab[order], own[order], n_words)]
                keys, count = np.unique(_bigrams(vocab, ids, sizes)[1], return_counts=True)
                messages.append((1, keys, count, n_bigrams))
                rows = [(what, r, block, kind, _pack(k), _short(c)) for what, keys, counts, n in messages for r, k, c in _split(keys, counts, n)]
                for begin in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[begin:begin + 64]), [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()])],
                                                     names=["what", "part", "block", "kind", "keys", "counts"])

    return run


_ASKED = "what int, part int, block long, kind int, keys binary, counts binary"
_ANSWER = "block long, what int, part int, train binary, em binary, distinct long"


def _answer(frame: pd.DataFrame) -> pd.DataFrame:
    """Sum a range's keys over all blocks; give each block the training and EM counts of its keys."""
    keys = [_unpack(k) for k in frame["keys"]]
    counts = [_long(c) for c in frame["counts"]]
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    size = np.array([len(k) for k in keys])
    kind = np.repeat(frame["kind"].to_numpy(), size)
    count = np.concatenate(counts).astype(np.float64)
    train = np.bincount(place, np.where(kind > 0, count, 0), len(every)).astype(np.uint64)
    em = np.bincount(place, np.where(kind == 1, count, 0), len(every)).astype(np.uint64)
    ends = np.cumsum(size)
    mine = [place[e - s:e] for s, e in zip(size, ends)]
    distinct = np.zeros(len(frame), np.int64)
    distinct[0] = int((train > 0).sum())
    return pd.DataFrame({"block": frame["block"], "what": frame["what"], "part": frame["part"], "train": [_short(train[m]) for m in mine],
                         "em": [_short(em[m]) if k == 1 else b"" for m, k in zip(mine, frame["kind"])], "distinct": distinct})


def _totals(answers: pd.DataFrame, what: int, column: str) -> np.ndarray:
    mine = answers[answers["what"] == what].sort_values("part")
    return np.concatenate([_long(x).astype(np.float64) for x in mine[column]]) if len(mine) else np.empty(0)


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(BUCKETS - 1, np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0)).astype(np.int64)


def _parts(pair: np.ndarray, context: np.ndarray, word: np.ndarray, tokens: float) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood bigram and unigram estimates; a context never seen leaves the bigram estimate at 0."""
    return np.where(context > 0, pair / np.maximum(context, 1), 0.0), word / max(tokens, 1.0)


def _gather(block: pd.DataFrame, answers: pd.DataFrame, column: str):
    row = block.iloc[0]
    vocab, ids, sizes = _read(row["kind"], row["vocab"], row["ids"], row["sizes"])
    order = np.argsort(vocab, kind="stable")
    word = np.empty(len(vocab))
    word[order] = _totals(answers, 0, column)
    context, key = _bigrams(vocab, ids, sizes)
    pair = _totals(answers, 1, column)[np.unique(key, return_inverse=True)[1]]
    return row, ids, sizes, context, word, pair


def _em_events(tokens: float):
    """Held-out events of an EM block, counted by (bucket, bigram step, unigram step) with the EM part deleted from the counts."""

    def run(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(answers):
            return pd.DataFrame({"bucket": [], "two": [], "one": [], "n": []}, dtype="int64")
        _, ids, _, context, word, pair = _gather(block, answers, "train")
        _, _, _, _, word_em, pair_em = _gather(block, answers, "em")
        word, pair = word - word_em, pair - pair_em
        p2, p1 = _parts(pair, word[context], word[ids], tokens)
        cells = np.stack([_bucket(word[context]), _step(p2), _step(p1)], 1)
        cell, n = np.unique(cells, axis=0, return_counts=True)
        return pd.DataFrame({"bucket": cell[:, 0], "two": cell[:, 1], "one": cell[:, 2], "n": n})

    return run


def _step(p: np.ndarray) -> np.ndarray:
    """A probability's place on a grid of STEPS to a factor of two; -1 for 0."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.round(-np.log2(np.where(p > 0, p, 1)) * STEPS), -1).astype(np.int64)


def fit_weights(cells: np.ndarray, uniform: float) -> np.ndarray:
    """EM over the grid: weights (bigram, unigram, uniform) for each bucket; a bucket without events takes the pooled ones."""
    def p(step):
        return np.where(step >= 0, np.exp2(-step / STEPS), 0.0)

    def fit(rows):
        w = np.full(3, 1 / 3)
        if not len(rows):
            return None
        parts = np.stack([p(rows[:, 1]), p(rows[:, 2]), np.full(len(rows), uniform)], 1)
        for _ in range(EM_ROUNDS):
            mass = parts * w
            mass /= np.maximum(mass.sum(1, keepdims=True), 1e-300)
            w = (mass * rows[:, 3:4]).sum(0) / rows[:, 3].sum()
        w = np.maximum(w, [0, 1e-6, 1e-6])
        return w / w.sum()

    pooled = fit(cells)
    if pooled is None:
        pooled = np.array([0.4, 0.4, 0.2])
    weights = []
    for b in range(BUCKETS):
        own = fit(cells[cells[:, 0] == b]) if len(cells) else None
        weights.append(pooled if own is None else own)
    if not (cells[:, 0] == 0).any() if len(cells) else True:
        w = np.array([0.0, pooled[1], pooled[2]])
        weights[0] = w / w.sum()
    return np.array(weights)


def _score(weights: np.ndarray, tokens: int, distinct: int):
    def run(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(block):
            return pd.DataFrame({"doc_id": [], "held_out": [], "n_tokens": [], "n_known": [], "base_score": [], "score": []})
        row, ids, sizes, context, word, pair = _gather(block, answers, "train")
        w = weights[_bucket(word[context])]
        p2, p1 = _parts(pair, word[context], word[ids], tokens)
        score = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (distinct + 1))
        base = np.log10((word + 0.1) / (tokens + 0.1 * (distinct + 1)))[ids]
        begin = np.cumsum(sizes) - sizes
        doc = pd.array([None if d is None or d != d else int(d) for d in row["docs"]], dtype="Int64")
        return pd.DataFrame({"doc_id": doc, "held_out": row["kind"] == 0, "n_tokens": sizes, "n_known": np.add.reduceat((word[ids] > 0).astype(np.int64), begin),
                             "base_score": np.add.reduceat(base, begin), "score": np.add.reduceat(score, begin)})

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    blocks = docs.select("doc_id", "text").mapInArrow(_blocks, _BLOCK).withColumn("block", F.monotonically_increasing_id())
    blocks = stored(blocks, "lm-blocks")
    size = {r["kind"]: r for r in blocks.groupBy("kind").agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).collect()}
    every = sum(r["tokens"] for r in size.values())
    train = sum(r["tokens"] for k, r in size.items() if k > 0)
    em = size[1]["tokens"] if 1 in size else 0
    words = sum(r["words"] for r in size.values())
    n_words, n_bigrams = parts_for(words, RANGE_KEYS), parts_for(every, RANGE_KEYS)
    asked = blocks.select("block", "kind", "vocab", "ids", "sizes").mapInArrow(_ask(n_words, n_bigrams), _ASKED)
    answers = stored(asked.groupBy("what", "part").applyInPandas(_answer, _ANSWER), "lm-answers")
    distinct = answers.where("what = 0").agg(F.sum("distinct")).first()[0] or 0

    held = blocks.where("kind = 1").select("block")
    events = blocks.where("kind = 1").groupBy("block").cogroup(answers.join(held, "block", "left_semi").groupBy("block")).applyInPandas(_em_events(train - em), "bucket long, two long, one long, n long")
    cells = np.array([list(r) for r in events.groupBy("bucket", "two", "one").agg(F.sum("n").alias("n")).collect()], np.float64).reshape(-1, 4)
    weights = fit_weights(cells, 1 / (distinct + 1))

    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        _score(weights, train, distinct), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train).cast("long").alias("train_tokens"), "base_score", "score")
