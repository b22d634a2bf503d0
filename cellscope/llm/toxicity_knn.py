"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, distance-weighted votes.

Terms are words and word beginnings of 4 to 6 bytes (so that inflected forms meet), told apart by 64-bit hashes. The
labelled examples are a bounded sample, EXAMPLES of each label picked by a hash of the id; every term of theirs is in the
vector space, and document frequencies for the weights are counted over all documents. A term's weight grows with its
evidence on the labels (G2 statistic over the examples), so that words of the topic do not outweigh those that tell the
labels apart; no term's weight is zero. The index is arrays only, bounded by the sample, and goes to the workers as one broadcast
variable; neither terms nor vectors become Python objects on the driver.

Examples stand in blocks, ordered by label and heaviest term. Terms that few examples hold are added up from their posting
lists; for the others a block holds each term's greatest weight, which bounds the cosine of every example in the block. A query
takes its most promising blocks first, and afterwards only blocks whose bound reaches its least neighbour so far, so the neighbours
are exact. Votes are weighted by similarity and by how many labelled rows an example stands for; isotonic regression on
leave-one-out votes, which are cast in tasks over the examples, turns them into probabilities.

Defined cases: null and empty texts, and texts without any term, get the rate of the label among examples without
terms; a null label teaches nothing; a document labelled more than once counts as toxic if one label says so; rows
with a null id are scored and never teach; repeated rows are scored alike; without labels, or with one label only,
every score is that label's rate (0 without labels); ties in similarity go to the example that is earlier in the index.
"""

from __future__ import annotations

import ctypes
import glob
import hashlib
import itertools
import math
import os
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import fold, mix64, pieces, stored

#: Labels are learned from rows whose fold is not HELD_OUT.
FOLDS, HELD_OUT = 5, 0
#: Labelled examples of each label, neighbours, queries scored at once.
EXAMPLES, NEIGHBOURS, QUERIES = 4096, 15, 256
#: A term held by this share of the examples or more has block maxima in place of a posting list.
COMMON_SHARE = 1 / 32
#: Examples of a block, and numbers of blocks after which a query raises its least neighbour.
BLOCK, FIRST_BLOCKS = 64, (2, 8)
#: Neighbours far away say little: votes are added to this many votes of the overall rate.
PRIOR_VOTES = 2.0
STEMS = (4, 5, 6)
#: Bytes of text that are cut into words at once, and bytes beyond which a word is hashed by itself.
TEXT_BLOCK, LONG_WORD = 1 << 20, 64
#: Masks for the first 0 to 8 bytes of a number.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

_WORDS = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def _words(data: bytes, cuts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, digest, held) of each word and its beginnings in translated text, whose parts end at ``cuts``.

    A word of up to eight bytes is its bytes in one number, spread like a hash; the eights of a longer one are mixed into it.
    A word's beginning is its first bytes in one number, with their count in the last byte, which no word of that length has.
    """
    padded = np.frombuffer(data + b" " * 9, np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], padded == 32])))
    starts, length = edges[::2], edges[1::2] - edges[::2]
    eights = np.lib.stride_tricks.as_strided(padded, (len(padded) - 7, 8), (1, 1))

    def eight(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(eights[at]).view("<u8").ravel() & _MASKS[np.minimum(left, 8)]

    head = eight(starts, length)
    digest = np.empty((len(starts), 1 + len(STEMS)), np.uint64)
    held = np.ones(digest.shape, bool)
    digest[:, 0] = mix64(head)
    for at in range(8, LONG_WORD, 8):
        more = np.flatnonzero((length > at) & (length <= LONG_WORD))
        if not len(more):
            break
        digest[more, 0] = mix64(digest[more, 0] * np.uint64(0x9E3779B97F4A7C15 + 2 * at) + eight(starts[more] + at, length[more] - at))
    for k in np.flatnonzero(length > LONG_WORD).tolist():
        digest[k, 0] = xxhash.xxh3_64_intdigest(data[starts[k]:starts[k] + length[k]])
    for column, n in enumerate(STEMS, 1):
        digest[:, column] = mix64(head & _MASKS[n] | np.uint64(n << 56))
        held[:, column] = length > n
    return np.searchsorted(cuts, starts, side="right"), digest, held


class Terms:
    """Hashed term counts of texts, over a sorted array of term hashes (all terms when there is none)."""

    def __init__(self, hashes: np.ndarray | None = None):
        self.hashes = hashes
        if hashes is not None:  # the hashes that share their first bits are next to each other
            bits = max(1, len(hashes).bit_length() + 1)
            self.shift = np.uint64(64 - bits)
            self.first = np.concatenate([[0], np.cumsum(np.bincount((hashes >> self.shift).astype(np.int64), minlength=1 << bits))]).astype(np.int32)

    def _places(self, digest: np.ndarray) -> np.ndarray:
        """The place of each digest in the hashes, -1 where it is none of them."""
        bucket = (digest >> self.shift).astype(np.int64)
        at, end = self.first[bucket], self.first[bucket + 1]
        place = np.full(len(digest), -1, np.int32)
        todo = np.flatnonzero(at < end)
        while len(todo):
            now = at[todo]
            hit = self.hashes[now] == digest[todo]
            place[todo[hit]] = now[hit]
            at[todo] = now + 1
            todo = todo[~hit & (now + 1 < end[todo])]
        return place

    def _counted(self, block: list[tuple[int, bytes]], texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, term, count) of a few (text number, translated text); a text that is cut is counted part by part."""
        part, digest, held = _words(b" ".join(d for _, d in block), np.cumsum([len(d) + 1 for _, d in block]).tolist())
        owner = np.fromiter((k for k, _ in block), np.int64, len(block))[part]
        owner, digest = np.repeat(owner, held.sum(1)), digest[held]
        if self.hashes is None:
            return _summed(owner, digest.view(np.int64))
        place = self._places(digest)
        known = place >= 0
        owner, place = owner[known], place[known]
        bits = len(self.hashes).bit_length()
        key = owner << bits | place
        key = key.astype(np.uint32) if texts << bits < 1 << 32 else key
        key.sort()
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        n = np.diff(np.append(first, len(key)))
        key = key[first].astype(np.int64)
        return key >> bits, key & ((1 << bits) - 1), n

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, term, count), by text and term; terms are places in the hashes, or the hashes as signed numbers."""
        found, block, size = [], [], 0
        for k, text in enumerate(texts):
            for part in pieces(text.encode("utf-8", "surrogatepass").translate(_WORDS)) if text else ():
                if size + len(part) > TEXT_BLOCK and block:
                    found.append(self._counted(block, len(texts)))
                    block, size = [], 0
                block.append((k, part))
                size += len(part)
        if block or not found:
            found.append(self._counted(block, len(texts)))
        return found[0] if len(found) == 1 else _summed(*(np.concatenate(a) for a in zip(*found)))


def _summed(text: np.ndarray, term: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The counts of equal (text, term) added up, by text and term."""
    order = np.lexsort((term, text))
    text, term = text[order], term[order]
    n = np.ones(len(order), np.int64) if n is None else n[order]
    first = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (text[1:] != text[:-1]))) if len(term) else np.empty(0, np.int64)
    return text[first], term[first], np.add.reduceat(n, first) if len(first) else n


def _split(text: np.ndarray, texts: int, *arrays: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """The parts of ``arrays`` that belong to each text."""
    ends = np.searchsorted(text, np.arange(1, texts))
    return list(zip(*(np.split(a, ends) for a in arrays))) if texts else []


class Index:
    """Inverted index over unit vectors of the examples that have terms, with maxima for blocks of examples."""

    def __init__(self, rows: list[tuple], idf: np.ndarray, weight: dict[int, float], ids: list):
        """``rows``: (counts, label) for each of ``ids``, the counts as a dict or as arrays (terms, counts)."""
        rows = [(*_arrays(c), y, i) for (c, y), i in zip(rows, ids)]
        empty = Counter(y for t, _, y, _ in rows if not len(t))
        self.base = _rate(empty, weight, Counter(r[2] for r in rows))
        self.idf = idf
        rows = [(t, n, y, i, int(t[int(np.argmax(self.unit(t, n)))])) for t, n, y, i in rows if len(t)]
        rows.sort(key=lambda r: (r[2], r[4]))
        self.labels = np.array([r[2] for r in rows], np.int64)
        self.ids = [r[3] for r in rows]
        self.weights = np.array([weight[y] for y in self.labels.tolist()]) if rows else np.empty(0)
        held = np.zeros(len(idf), np.int64)
        for t, *_ in rows:
            held[t] += 1
        self.starts = np.concatenate([[0], np.cumsum(held)])
        self.place, self.unit_weights = np.empty(self.starts[-1], np.int32), np.empty(self.starts[-1], np.float32)
        free = self.starts[:-1].copy()
        for k, (t, n, *_) in enumerate(rows):  # row by row into place: sorting all postings takes several times their memory
            at = free[t]
            self.place[at], self.unit_weights[at] = k, self.unit(t, n)
            free[t] = at + 1
        self.common = np.flatnonzero(held >= max(2, COMMON_SHARE * len(self.ids)))
        self._dense = None
        self.points: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_dense": None, "_most": None, "_column": None}

    @property
    def rows(self) -> list[tuple[dict[int, float], int, object]]:
        """(vector, label, id) of the examples."""
        vectors: list[dict[int, float]] = [{} for _ in self.ids]
        for t in range(len(self.idf)):
            for k in range(self.starts[t], self.starts[t + 1]):
                vectors[self.place[k]][t] = float(self.unit_weights[k])
        return list(zip(vectors, self.labels.tolist(), self.ids))

    def unit(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.idf[terms]
        return (w / (math.sqrt(float(w @ w)) or 1.0)).astype(np.float32)

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        terms, n = _arrays(counts)
        return dict(zip(terms.tolist(), self.unit(terms, n).tolist()))

    def _open(self) -> None:
        """The common terms' weights by example (whole blocks), and the greatest of each block."""
        blocks = -(-len(self.ids) // BLOCK)
        self._column = np.full(len(self.idf), -1, np.int32)
        self._column[self.common] = np.arange(len(self.common))
        self._dense = np.zeros((blocks, len(self.common), BLOCK), np.float32)
        for c, t in enumerate(self.common.tolist()):
            at = slice(self.starts[t], self.starts[t + 1])
            self._dense[self.place[at] // BLOCK, c, self.place[at] % BLOCK] = self.unit_weights[at]
        self._most = np.ascontiguousarray(self._dense.max(2).T)

    def best(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS, without: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """The k most similar examples of each query (terms, unit weights), exactly: (similarity, place), most similar first."""
        if not self.ids:
            return [[] for _ in queries]
        if self._dense is None:
            self._open()
        blocks, width = len(self._dense), len(self._dense) * BLOCK
        q = np.zeros((len(queries), len(self.common)), np.float32)
        partial = np.zeros((len(queries), width), np.float32)
        for row, sums, (terms, w) in zip(q, partial, queries):
            c = self._column[terms]
            rare = c < 0
            row[c[~rare]] = w[~rare]
            first = self.starts[terms[rare]]
            n = self.starts[terms[rare] + 1] - first
            at = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
            sums += np.bincount(self.place[at], self.unit_weights[at] * np.repeat(w[rare], n), minlength=width).astype(np.float32)
        bound = (q @ self._most + partial.reshape(len(queries), blocks, BLOCK).max(2)) * np.float32(1 + 1e-5) + np.float32(1e-6)
        found = np.zeros((len(queries), blocks, BLOCK), np.float32)
        order, least = np.argsort(-bound, axis=1, kind="stable"), np.zeros(len(queries), np.float32)
        for at, end in itertools.pairwise([0, *(n for n in FIRST_BLOCKS if n < blocks), blocks]):
            todo = np.zeros((len(queries), blocks), bool)
            np.put_along_axis(todo, order[:, at:end], True, axis=1)
            self._take(todo & (bound >= least[:, None]), q, partial, found, without)
            if end < blocks and end * BLOCK > k:
                taken = np.take_along_axis(found, order[:, :end, None], axis=1).reshape(len(queries), end * BLOCK)
                least = np.partition(taken, end * BLOCK - k, axis=1)[:, end * BLOCK - k]
        return [self._ordered(row, k, low) for row, low in zip(found.reshape(len(queries), width), least.tolist())]

    def _take(self, todo: np.ndarray, q: np.ndarray, partial: np.ndarray, found: np.ndarray, without: list[int] | None) -> None:
        """Whole cosines of the (query, block) pairs in ``todo``."""
        for b in np.flatnonzero(todo.any(0)).tolist():
            rows = np.flatnonzero(todo[:, b])
            found[rows, b] = q[rows] @ self._dense[b] + partial[rows, b * BLOCK:(b + 1) * BLOCK]
        for row, place in enumerate(without or []):
            found[row, place // BLOCK, place % BLOCK] = 0

    @staticmethod
    def _ordered(similarity: np.ndarray, k: int, least: float) -> list[tuple[float, int]]:
        """The k greatest positive similarities; at least k are not below ``least`` unless it is 0."""
        places = np.flatnonzero(similarity >= least if least > 0 else similarity > 0)
        if len(places) > k:
            best = similarity[places]
            places = places[best >= np.partition(best, len(best) - k)[-k]]
        return sorted(((float(similarity[p]), p) for p in places.tolist()), key=lambda x: (-x[0], x[1]))[:k]

    def nearest(self, v: dict[int, float], k: int = NEIGHBOURS) -> list[tuple[float, int]]:
        if not v:
            return []
        return self.best([(np.fromiter(v, np.int64, len(v)), np.fromiter(v.values(), np.float32, len(v)))], k)[0]

    def vote(self, found: list[tuple[float, int]]) -> float:
        """Share of the votes for toxic; a vote counts its similarity over its distance and the rows it stands for."""
        place = [p for _, p in found]
        sim = np.array([s for s, _ in found])
        mass = self.weights[place] * sim / (1.05 - np.minimum(sim, 1.0))
        prior = PRIOR_VOTES * float(self.weights.mean())
        return float(((mass * self.labels[place]).sum() + prior * self.base) / (mass.sum() + prior))

    def calibrate(self, votes: np.ndarray) -> None:
        """Isotonic fit of label on the leave-one-out votes (pool adjacent violators), lightly smoothed towards the rate."""
        if not len(self.labels):
            return
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []
        for x, y, w in zip(votes[order], self.labels[order], self.weights[order]):
            if pools and pools[-1][0] == x:
                pools[-1][1] += w * y
                pools[-1][2] += w
            else:
                pools.append([x, w * y, w, x])
        merged: list[list[float]] = []
        for p in pools:
            merged.append(list(p))
            while len(merged) > 1 and merged[-2][1] * merged[-1][2] >= merged[-1][1] * merged[-2][2]:
                last = merged.pop()
                merged[-1] = [merged[-1][0], merged[-1][1] + last[1], merged[-1][2] + last[2], last[3]]
        total = self.weights.sum()
        rate = float((self.weights * self.labels).sum() / total)
        prior = float(self.weights.mean())
        xs, ys = [], []
        for lo, y, w, hi in merged:
            p = (y + prior * rate) / (w + prior)
            xs += [lo, hi]
            ys += [p, p]
        self.points = np.array(xs), np.array(ys)

    def scores(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, list[tuple[float, int]]]]:
        """(probability, neighbours) for the term counts (terms, counts) of some texts."""
        return [self._probability(found) for found in self.best([(t, self.unit(t, n)) for t, n in vectors])]

    def _probability(self, found: list[tuple[float, int]]) -> tuple[float, list[tuple[float, int]]]:
        if not found:
            return self.base, []
        raw = self.vote(found)
        p = float(np.interp(raw, *self.points)) if self.points is not None else raw
        return min(1.0, max(0.0, 0.99 * p + 0.01 * raw)), found


def _arrays(counts) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(counts, dict):
        return np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), np.float64, len(counts))
    return counts


def _rate(count: Counter, weight: dict[int, float], every: Counter) -> float:
    """Weighted share of label 1 among the examples in ``count``; of all examples when there are none."""
    count = count if sum(count.values()) else every
    total = sum(n * weight[y] for y, n in count.items())
    return count[1] * weight.get(1, 0.0) / total if total else 0.0


def sample_labels(labels: DataFrame) -> tuple[DataFrame, dict[int, float]]:
    """Bounded examples (doc_id, toxic) of the training folds, and how many labelled rows an example of a label stands for."""
    taught = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    taught = taught.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = {r["toxic"]: r["count"] for r in taught.groupBy("toxic").count().collect()}
    picked = [taught.where(F.col("toxic") == y).orderBy(F.xxhash64(F.lit(17), F.col("doc_id")), "doc_id").limit(EXAMPLES) for y in (0, 1)]
    return stored(picked[0].union(picked[1]), "tox-sample"), {y: n / min(n, EXAMPLES) for y, n in total.items()}


def evidence(terms: list[np.ndarray], labels: list[int], size: int) -> np.ndarray:
    """G2 statistic of each of ``size`` terms on the labels of the examples."""
    a, b = held = np.zeros((2, size))
    for t, y in zip(terms, labels):
        held[1 - y, t] += 1
    n1, n0 = float(sum(labels)), float(len(labels) - sum(labels))
    every, df = n1 + n0, a + b

    def part(observed, expected):
        return np.where(observed > 0, observed * np.log(np.maximum(observed, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    g2 = 2 * (part(a, df * n1 / every) + part(b, df * n0 / every) + part(n1 - a, (every - df) * n1 / every) + part(n0 - b, (every - df) * n0 / every))
    return np.maximum(g2, 0.0)


def _example_vectors(batches):
    terms = Terms()
    for batch in batches:
        for at in range(0, batch.num_rows, QUERIES):
            part = batch.slice(at, QUERIES)
            text, term, n = terms([t.as_py() for t in part.column(2)])
            found = _split(text, part.num_rows, term, n)
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), part.column(1).cast(pa.int32()), pa.array([t for t, _ in found], pa.list_(pa.int64())), pa.array([n.astype(np.int32) for _, n in found], pa.list_(pa.int32()))],
                                             names=["doc_id", "toxic", "terms", "counts"])


def _frequencies(hashes: Broadcast):
    def run(batches):
        terms, df, n = Terms(hashes.value), np.zeros(len(hashes.value), np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES):
                part = batch.column(0).slice(at, QUERIES)
                df += np.bincount(terms([t.as_py() for t in part])[1], minlength=len(df))
                n += len(part)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1), pa.int32()), pa.array(np.append(df[held], n), pa.int64())], names=["term", "n"])

    return run


def _left_out(index: Broadcast):
    """(place, vote) of each example by the others."""
    def run(batches):
        _one_thread()
        found = index.value
        terms = np.repeat(np.arange(len(found.idf)), np.diff(found.starts))
        order = np.argsort(found.place, kind="stable")
        terms, weights, ends = terms[order], found.unit_weights[order], np.concatenate([[0], np.cumsum(np.bincount(found.place, minlength=len(found.ids)))])
        for batch in batches:
            places, votes = batch.column(0).to_pylist(), []
            for at in range(0, len(places), QUERIES):
                some = places[at:at + QUERIES]
                votes += [found.vote(x) for x in found.best([(terms[ends[p]:ends[p + 1]], weights[ends[p]:ends[p + 1]]) for p in some], without=some)]
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(votes, pa.float64())], names=["place", "vote"])

    return run


def _distinct(parts) -> np.ndarray:
    """Sorted distinct hashes of some arrays of signed numbers, a million at a time."""
    found, waiting = np.empty(0, np.uint64), []
    for part in itertools.chain(parts, [None]):
        waiting += [part.view(np.uint64)] if part is not None else []
        if part is None or sum(map(len, waiting)) > 1 << 20:
            found = np.concatenate([found, *waiting])
            found.sort()
            found, waiting = found[np.append(True, found[1:] != found[:-1])] if len(found) else found, []
    return found


def _all_terms(batches):
    yield pa.RecordBatch.from_arrays([pa.array(_distinct(b.column(0).flatten().to_numpy() for b in batches).view(np.int64))], names=["term"])


def _numbered(hashes: Broadcast):
    """Terms as their places in the sorted hashes, which hold all of them."""
    def run(batches):
        for batch in batches:
            terms = batch.column("terms")
            place = np.searchsorted(hashes.value, terms.flatten().to_numpy().view(np.uint64)).astype(np.int32)
            ends = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy())]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.ListArray.from_arrays(ends, pa.array(place)), batch.column("counts")],
                                             names=["doc_id", "toxic", "terms", "counts"])

    return run


def _read_examples(examples: DataFrame) -> tuple[list, list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels, sorted term hashes, and each example's terms and counts end to end, with the number of terms of each.

    Terms are numbered in tasks: the driver gets the distinct hashes and small numbers, never all hashes of all examples.
    """
    rest = "counts array<int>"
    vectors = stored(examples.select("doc_id", "toxic", "text").mapInArrow(_example_vectors, f"doc_id long, toxic int, terms array<long>, {rest}"), "tox-vectors")
    hashes = _distinct(c.to_numpy() for c in vectors.select("terms").mapInArrow(_all_terms, "term long").toArrow().column("term").chunks)
    sent = examples.sparkSession.sparkContext.broadcast(hashes)
    rows = vectors.mapInArrow(_numbered(sent), f"doc_id long, toxic int, terms array<int>, {rest}").toArrow()
    sent.unpersist()
    ids, labels = (rows.column(c).to_numpy() for c in ("doc_id", "toxic"))
    order = np.argsort(ids, kind="stable")
    sizes = np.concatenate([np.empty(0, np.int64), *(c.value_lengths().to_numpy() for c in rows.column("terms").chunks)]).astype(np.int64)
    lengths = sizes[order]
    starts = np.empty(len(order), np.int64)
    starts[order] = np.cumsum(lengths) - lengths
    term, count = (np.empty(lengths.sum(), np.int32) for _ in range(2))
    at = 0
    for batch in rows.to_batches():
        ends = np.cumsum(sizes[at:at + batch.num_rows])[:-1]
        for name, whole in (("terms", term), ("counts", count)):
            for start, part in zip(starts[at:at + batch.num_rows].tolist(), np.split(batch.column(name).flatten().to_numpy(), ends)):
                whole[start:start + len(part)] = part
        at += batch.num_rows
    return ids[order].tolist(), labels[order].tolist(), hashes, term, count, lengths


def train(docs: DataFrame, labels: DataFrame) -> tuple[Broadcast, Broadcast, tuple | None]:
    """Term hashes and index, from the bounded examples and the frequencies over all of ``docs``, broadcast once each, and the
    points of the calibration."""
    context = docs.sparkSession.sparkContext
    sample, weight = sample_labels(labels)
    examples = stored(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "tox-examples")
    ids, labelled, hashes, term, counts, lengths = _read_examples(examples)
    if len(set(labelled)) < 2:
        hashes, term, counts, lengths = hashes[:0], term[:0], counts[:0], np.zeros_like(lengths)
    pa.default_memory_pool().release_unused()
    hashed = context.broadcast(hashes)
    idf = np.zeros(len(hashes))
    vectors = _split(np.repeat(np.arange(len(ids)), lengths), len(ids), term, counts)
    if len(hashes):
        counted = docs.select("text").mapInArrow(_frequencies(hashed), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
        held, df = (counted.column(c).to_numpy() for c in ("term", "n"))
        idf[held[held >= 0]] = df[held >= 0]
        idf = np.log((df[held < 0][0] + 1) / (idf + 1)) + 1
        idf = idf * np.sqrt(1 + evidence([t for t, _ in vectors], labelled, len(idf)))
        del counted, held, df
    index = Index(list(zip(vectors, labelled)), idf, {y: weight.get(y, 1.0) for y in (0, 1)}, ids)
    del vectors, term, counts  # the vectors are in the index
    sent = context.broadcast(index)
    if index.ids:
        asked = docs.sparkSession.range(0, len(index.ids), 1, -(-len(index.ids) // (4 * QUERIES)))
        cast = asked.mapInArrow(_left_out(sent), "place long, vote double").toArrow()
        votes = np.empty(len(index.ids))
        votes[cast.column("place").to_numpy()] = cast.column("vote").to_numpy()
        index.calibrate(votes)
    return hashed, sent, index.points


def _scores(terms: Terms, index: Index, texts: pa.Array, known: dict):
    """(probability, evidence) of each text; a text that was scored before is not scored again."""
    for at in range(0, len(texts), QUERIES):
        part = [t.as_py() for t in texts.slice(at, QUERIES)]
        keys = [hashlib.blake2b((t or "").encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in part]
        new = {k: t for k, t in zip(keys, part) if k not in known}
        text, term, n = terms(list(new.values()))
        fresh = {}
        for k, (p, found) in zip(new, index.scores(_split(text, len(new), term, n))):
            fresh[k] = p, ",".join(f"{index.ids[r]}:{s:.4f}:{index.labels[r]}" for s, r in found[:5])
        for k in keys:
            yield fresh[k] if k in fresh else known[k]
        if len(known) < 20_000:
            known.update(fresh)


def _one_thread() -> None:
    """One thread for numpy's matrix products in this worker: Spark runs tasks side by side, and threads that wait for
    the next small product only burn CPU. Another build of numpy keeps its own setting."""
    for lib in glob.glob(os.path.join(os.path.dirname(np.__file__), "..", "numpy.libs", "*openblas*")):
        limit = getattr(ctypes.CDLL(lib), "scipy_openblas_set_num_threads64_", None)
        if limit is not None:
            limit(1)


def _opened(hashes: Broadcast, index: Broadcast, points: tuple | None) -> tuple[Terms, Index]:
    _one_thread()
    index.value.points = points
    return Terms(hashes.value), index.value


def _score(*trained):
    def run(batches):
        (terms, index), known = _opened(*trained), {}
        for batch in batches:
            scored = list(_scores(terms, index, batch.column(1), known))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([p for p, _ in scored], pa.float64()), pa.array([e for _, e in scored], pa.string())], names=["doc_id", "score", "evidence"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, evidence (nearest examples id:similarity:label)."""
    scored = docs.select("doc_id", "text").mapInArrow(_score(*train(docs, labels)), "doc_id long, score double, evidence string")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def _accept(at: int, *trained):
    def run(batches):
        (terms, index), known = _opened(*trained), {}
        for batch in batches:
            keep = [p < 0.5 for p, _ in _scores(terms, index, batch.column(at), known)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def remove_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` scored below one half, all columns kept."""
    return docs.mapInArrow(_accept(docs.columns.index("text"), *train(docs, labels)), docs.schema)
