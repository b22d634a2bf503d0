r"""Resampling documents towards a target distribution: hashed n-gram importance weights, perturbed, exact top share drawn.

Features are runs of 1 to 2 consecutive words, repeats counted, dealt to BUCKETS buckets by crc32. A bucket's gain is the
scaled log ratio of its smoothed shares in target and source; a document's weight is the floored mean gain of its
features; a Gumbel perturbation from the id's hash turns the highest scores into a sample without replacement.

Weights are scored in arrays: a word's crc32 is taken once for each distinct word of a portion, and a pair's crc32 comes
from its words' by the linearity of the code (appending n bytes is a linear map on the register, tabulated for each n).
Bucket counts leave each task as one partial sum for each bucket, so the driver receives at most BUCKETS numbers.

The draw is a distributed quickselect on the composite key (score downwards, doc_id upwards, stored row number):
each round takes random pivot keys from the rows still in question, counts the rows above and at each pivot exactly, and
keeps the rows between the two pivots around the wanted rank. Only winners are sorted, by range, and ranked by the counts of
the partitions before their own.

Defined cases: null and empty texts have no words, no features and weight 0; a null id is hashed as empty text and comes
after all other ids in a tie; repeated rows are documents of their own (rows of one score and id are ranked in stored order);
with no documents nothing is returned, with no target rows every gain comes from the smoothing; extra columns are
ignored; a text of any length is read whole.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import lower_bytes, parts_for, pieces, stored

BUCKETS, SCALE, SEED = 10_000, 1000, 7
#: Drawn percent of the documents with at least LEAST_WORDS words.
PERCENT, LEAST_WORDS = 25, 20
#: Pivot keys of a round, bytes of text read at a time, winners sorted in a task.
PIVOTS, CHUNK, PER_TASK = 64, 1 << 20, 250_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Words of more bytes are rare; their pairs are hashed one by one.
_LONGEST = 64


@functools.cache
def _appending() -> np.ndarray:
    """[n, k, b]: what byte k of a crc32 register, worth b, becomes when n bytes follow."""
    byte = np.arange(256, dtype=np.uint32)
    step = byte.copy()
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    tables = [np.stack([byte << np.uint32(8 * k) for k in range(4)])]
    for _ in range(_LONGEST + 1):
        last = tables[-1]
        tables.append((last >> np.uint32(8)) ^ step[last & np.uint32(255)])
    return np.stack(tables)


def pair_crcs(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of joined byte strings from the crc32 of both and the length of the second (at most _LONGEST + 1)."""
    table, crc = _appending(), second.copy()
    for k in range(4):
        crc ^= table[length, k, (first >> np.uint32(8 * k)) & np.uint32(255)]
    return crc


def _bucketed(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, bucket, is a word) of all features; each array holds a portion of the texts of about CHUNK bytes."""
    some, owner, size, carry = [], [], 0, {}
    for k, text in enumerate(texts):
        for piece in pieces(text, CHUNK):
            some.append(_WORD.findall(piece))
            owner.append(k)
            size += len(piece)
            if size >= CHUNK:
                yield _features(some, owner, carry)
                some, owner, size = [], [], 0
    if some:
        yield _features(some, owner, carry)


def _features(words: list[list[bytes]], owner: list[int], carry: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of consecutive word lists; ``carry`` holds the last word of a text that goes on in the next portion."""
    if not any(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    again = int(owner[0] in carry)
    if again:  # the pair over the cut
        words[0] = [carry[owner[0]], *words[0]]
    carry.clear()
    flat = [w for some in words for w in some]
    text = np.repeat(np.array(owner, np.int64), [len(some) for some in words])
    carry[int(text[-1])] = flat[-1]
    number = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    place = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    crc = np.fromiter(map(zlib.crc32, number), np.uint32, len(number))
    spaced = np.fromiter((zlib.crc32(b" " + w) for w in number), np.uint32, len(number))
    length = np.fromiter(map(len, number), np.int64, len(number))
    left, right = place[:-1], place[1:]
    inside = text[:-1] == text[1:]
    left, right, at = left[inside], right[inside], text[1:][inside]
    short = length[right] <= _LONGEST
    pairs = np.empty(len(left), np.uint32)
    pairs[short] = pair_crcs(crc[left[short]], spaced[right[short]], length[right[short]] + 1)
    if not short.all():
        names = list(number)
        pairs[~short] = [zlib.crc32(names[a] + b" " + names[b]) for a, b in zip(left[~short].tolist(), right[~short].tolist())]
    single = crc[place[again:]]
    kinds = np.zeros(len(single) + len(pairs), bool)
    kinds[:len(single)] = True
    return np.concatenate([text[again:], at]), np.concatenate([single, pairs]).astype(np.int64), kinds


def _count(buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, crc, _ in _bucketed([lower_bytes(t.as_py()) for t in batch.column(0)]):
                total += np.bincount(crc % buckets, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows' column ``text``."""
    partial = texts.select("text").mapInArrow(_count(buckets), "bucket int, n long")
    found = np.zeros(buckets, np.int64)
    for bucket, n in partial.groupBy("bucket").agg(F.sum("n")).collect():  # at most ``buckets`` rows
        found[bucket] = n
    return found


def bucket_gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * ln of the smoothed share in target over that in source), as whole numbers."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), float(len(source))
    return np.array([math.floor(scale * math.log(((t + 1.0) * (s_all + n)) / ((s + 1.0) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weigh(gains: np.ndarray):
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            features, words, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for at, crc, single in _bucketed([lower_bytes(t.as_py()) for t in batch.column(1)]):
                features += np.bincount(at, minlength=n)
                words += np.bincount(at[single], minlength=n)
                np.add.at(total, at, gains[crc % len(gains)])
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(features), pa.array(words), pa.array(weight)], names=["doc_id", "n_features", "n_words", "weight"])

    return run


def gumbel(doc_id: Column, seed: int = SEED, scale: int = SCALE) -> Column:
    """Scaled Gumbel noise from the first 32 bits of sha256 of ``seed:doc_id``."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    h = F.conv(head, 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0)))


#: The order of the draw: columns that ascend.
ORDER = ("down", "absent", "id", "row")


def _not_after(pivot, strictly: bool) -> Column:
    """Whether a row's key comes before ``pivot``, or at it unless ``strictly``."""
    found = F.lit(not strictly)
    for name in reversed(ORDER):
        found = F.when(F.col(name) == pivot[name], found).otherwise(F.col(name) < pivot[name])
    return found


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS):
    """The key (a row of columns ORDER) of rank ``k``, 1 for the first, by rounds of random pivots and exact counts.

    ``keys`` should be stored: each round reads the whole table once, whatever its size, and brings back ``pivots``
    counts. Keys are distinct, so each round ends at the wanted key or leaves fewer rows.
    """
    low = high = None  # the wanted key is after low and before high
    turn = 0
    while True:
        open_rows = keys
        if low is not None:
            open_rows = open_rows.where(~_not_after(low, False))
        if high is not None:
            open_rows = open_rows.where(_not_after(high, True))
        turn += 1
        chosen = open_rows.orderBy(F.xxhash64(F.lit(turn), "row"), "row").limit(pivots).select(*ORDER).collect()
        chosen.sort(key=tuple)
        # three parts for each pivot: before, at, after; keys are distinct, so one row is at the pivot
        counts = keys.agg(*[F.count_if(_not_after(p, True)).alias(f"c{i}") for i, p in enumerate(chosen)]).first()
        for pivot, before in zip(chosen, counts):
            if before == k - 1:
                return pivot
            if before < k - 1:
                low = pivot
            else:
                high = pivot
                break


def ranked(rows: DataFrame, order: tuple[str, ...], n: int, name: str, per_task: int = PER_TASK) -> DataFrame:
    """``rows`` with a gapless ``rank`` by ``order``: range-sorted parts, and the counts of the parts before each."""
    parts = rows.repartitionByRange(parts_for(n, per_task), *order).sortWithinPartitions(*order)
    parts = stored(parts.withColumn("part", F.spark_partition_id()).withColumn("rank", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), name)
    before, starts = 0, []
    for part, size in sorted(map(tuple, parts.groupBy("part").count().collect())):  # one row for each part
        starts.append((part, before))
        before += size
    starts = rows.sparkSession.createDataFrame(starts or [(0, 0)], "part int, start long")
    return parts.join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + F.col("rank") + 1).drop("part", "start")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
             seed: int = SEED, scale: int = SCALE) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): doc_id, n_features, weight, score, rank (null when not drawn)."""
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets), scale)
    weighed = docs.select("doc_id", "text").mapInArrow(_weigh(gains), "doc_id long, n_features long, n_words long, weight long")
    weighed = weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed, scale)).withColumn("row", F.monotonically_increasing_id())
    weighed = stored(weighed, "resample-weights")
    keys = weighed.where(F.col("n_words") >= least_words).select(
        (-F.col("score")).alias("down"), F.col("doc_id").isNull().cast("int").alias("absent"), F.coalesce("doc_id", F.lit(0)).alias("id"), "row")
    k = keys.count() * percent // 100
    if k == 0:
        return weighed.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    winners = ranked(keys.where(_not_after(kth_key(keys, k), False)), ORDER, k, "resample-winners").select("row", "rank")
    return weighed.join(winners, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
