"""Benchmark decontamination with word-level suffix arrays.

Each task turns its documents into shards. A shard's suffix array holds the document suffixes that can match at all
(those with enough benchmark words in a row); every suffix of every benchmark item is binary-searched in it, which
gives all documents and places where at least a whole window occurs, and the longest verbatim match from there.
Documents are only mapped, never shuffled. The benchmark is cut into blocks of a stated size; each block is read to
the driver, sent to the tasks and searched in turn, so any benchmark size works; only matches of several blocks meet.

Words are runs of characters that are neither ASCII punctuation, space nor control, with A-Z lower-cased. A window is
``window`` consecutive words of an item; an item with fewer words is one window. A document word inside any
occurrence of a window is hit.

Defined cases: null or empty texts have no words and are not contaminated; an item without words never matches;
items are named by item_id, and rows that share one count as one item; a null item_id matches like any other but is
left out of the item list; repeated document rows each give a row; very long texts are read in pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import pieces, stored

WINDOW = 10
#: Bytes of benchmark text in a block (one block at a time is held by the driver and each task).
BLOCK_BYTES = 16 << 20
#: Words of an item kept in one piece; longer items are cut with an overlap of a window less one.
PIECE_WORDS = 4096
#: Words gathered in a shard.
SHARD_WORDS = 400_000

#: ASCII other than letters and digits separates words; A-Z become a-z; bytes of other characters stay.
_WORDS = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))

SPAN_TYPE = "array<struct<item_id:string,doc_start:long,item_start:long,length:long>>"
SCHEMA = f"doc_id long, n_words long, hit_starts array<long>, hit_ends array<long>, items array<string>, matches {SPAN_TYPE}"


def words_of(text: str | None) -> list[bytes]:
    return b"" if text is None else text.encode("utf-8", "surrogatepass").translate(_WORDS).split()


class Block:
    """Benchmark pieces with word numbers, and the distinct windows they contain."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.names: list[str | None] = []
        ids, starts, owner, offset = [], [], [], []
        at = 0
        for name, text in items:
            words = words_of(text)
            step = PIECE_WORDS - window + 1
            for cut in range(0, max(1, len(words) - window + 1), step) if words else ():
                part = words[cut:cut + PIECE_WORDS]
                nums = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in part]
                ids += [*nums, 0]
                starts.append((at, len(nums)))
                owner.append(len(self.names))
                offset.append(cut)
                self.names.append(name)
                at += len(nums) + 1
        self.ids = np.array(ids, np.int32)
        # one query suffix for each window: where it starts, how many words it needs, whose it is
        q_at, q_len, q_owner, q_item_at = [], [], [], []
        for (s, n), o, cut in zip(starts, owner, offset):
            for i in range(max(1, n - window + 1)):
                q_at.append(s + i)
                q_len.append(min(window, n))
                q_owner.append(o)
                q_item_at.append(cut + i)
        self.q_at = np.array(q_at, np.int64)
        self.q_len = np.array(q_len, np.int64)
        self.q_owner = np.array(q_owner, np.int64)
        self.q_item_at = np.array(q_item_at, np.int64)
        self.shortest = int(self.q_len.min()) if q_at else window


def suffix_array(ids: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Order the suffixes at ``starts`` by their first ``depth`` words or more (prefix doubling; 0 ends a suffix)."""
    n = len(ids)
    rank = np.append(ids.astype(np.int64), 0)
    width = 1
    while width < depth:
        ahead = np.zeros(n + 1, np.int64)
        ahead[:max(0, n - width)] = rank[width:n] if width < n else 0
        ahead[rank == 0] = 0
        _, inv = np.unique(rank * (int(rank.max()) + 2) + ahead, return_inverse=True)
        rank = np.where(rank == 0, 0, inv + 1)
        width *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


def _compare(ids: np.ndarray, at: np.ndarray, block: Block, q: np.ndarray) -> np.ndarray:
    """Sign of (document suffix at ``at``) against (query suffix ``q``) over the query's words."""
    out = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    for k in range(int(block.q_len.max())):
        live = live[block.q_len[q[live]] > k]
        if not len(live):
            break
        d = ids[at[live] + k].astype(np.int64) - block.ids[block.q_at[q[live]] + k]
        out[live[d != 0]] = np.sign(d[d != 0])
        live = live[d == 0]
    return out


def _bound(ids: np.ndarray, sa: np.ndarray, block: Block, q: np.ndarray, upper: bool) -> np.ndarray:
    """Binary search of every query suffix in the suffix array, all at once."""
    lo, hi = np.zeros(len(q), np.int64), np.full(len(q), len(sa), np.int64)
    while True:
        live = np.flatnonzero(lo < hi)
        if not len(live):
            return lo
        mid = (lo[live] + hi[live]) // 2
        sign = _compare(ids, sa[mid], block, q[live])
        right = sign <= 0 if upper else sign < 0
        lo[live[right]] = mid[right] + 1
        hi[live[~right]] = mid[~right]


def search(ids: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """All (document position, query) pairs where the query's whole window occurs in ``ids``.

    ``ids`` holds numbers of benchmark words; 0 stands for any other word and between documents, and ends it.
    """
    none = np.empty(0, np.int64)
    if not len(block.q_at) or not len(ids):
        return none, none
    window = int(block.q_len.max())
    padded = np.append(ids, np.zeros(window + 1, ids.dtype))
    stop = np.flatnonzero(ids == 0)
    run = np.append(stop, len(ids))[np.searchsorted(stop, np.arange(len(ids)))] - np.arange(len(ids))
    starts = np.flatnonzero(run >= block.shortest)
    if not len(starts):
        return none, none
    sa = suffix_array(ids, starts, window)
    q = np.arange(len(block.q_at))
    lo = _bound(padded, sa, block, q, False)
    size = _bound(padded, sa, block, q, True) - lo
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return sa[np.repeat(lo, size) + inside], np.repeat(q, size)


def match_shard(doc_words: list[np.ndarray], block: Block) -> list[tuple]:
    """For each document of a shard: hit spans (starts, ends), names of items, longest matches."""
    sizes = np.array([len(w) for w in doc_words], np.int64)
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    ids = np.zeros(int((sizes + 1).sum()), np.int32)
    for b, w in zip(begin, doc_words):
        ids[b:b + len(w)] = w
    out: list[tuple] = [([], [], [], [])] * len(doc_words)
    at, q = search(ids, block)
    if not len(at):
        return out
    # matches on one diagonal of a document and an item piece that follow each other are one longer match
    doc = np.searchsorted(begin, at, "right") - 1
    owner, diagonal = block.q_owner[q], at - block.q_at[q]
    order = np.lexsort((at, diagonal, owner, doc))
    at, q, doc, owner, diagonal = at[order], q[order], doc[order], owner[order], diagonal[order]
    new = np.append(True, (np.diff(at) != 1) | (np.diff(diagonal) != 0) | (np.diff(owner) != 0) | (np.diff(doc) != 0))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    doc, owner, item_at, start = doc[first], owner[first], block.q_item_at[q[first]], at[first]
    end = at[last] + block.q_len[q[last]]
    cuts = np.flatnonzero(np.append(True, np.diff(doc) > 0))
    for c, e in zip(cuts, np.append(cuts[1:], len(doc))):
        d = doc[c]
        s, t = start[c:e] - begin[d], end[c:e] - begin[d]
        longest: dict[str | None, tuple[int, int, int]] = {}
        for o, i, x, y in zip(owner[c:e].tolist(), item_at[c:e].tolist(), s.tolist(), t.tolist()):
            name = block.names[o]
            if y - x > longest.get(name, (0,))[0]:
                longest[name] = (y - x, x, i)
        by_start = np.argsort(s, kind="stable")
        s, t = s[by_start], np.maximum.accumulate(t[by_start])
        head = np.flatnonzero(np.append(True, s[1:] > t[:-1]))
        tail = np.append(head[1:], len(s)) - 1
        named = sorted(x for x in longest if x is not None)
        out[d] = (s[head].tolist(), t[tail].tolist(), named,
                  [{"item_id": x, "doc_start": longest[x][1], "item_start": longest[x][2], "length": longest[x][0]} for x in named])
    return out


def _numbers(text: str | None, vocab: dict[bytes, int]) -> np.ndarray:
    if not text:
        return np.empty(0, np.int32)
    data = text.encode("utf-8", "surrogatepass").translate(_WORDS)
    get = vocab.get
    found = [np.array([get(w, 0) for w in part.split()], np.int32) for part in pieces(data)]
    return np.concatenate(found) if len(found) != 1 else found[0]


def _scan(docs: DataFrame, items: list[tuple], window: int) -> DataFrame:
    """Match every document against one block of items; a map over the documents."""

    def run(batches):
        block = Block(items, window)
        out_schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("hit_starts", pa.list_(pa.int64())), ("hit_ends", pa.list_(pa.int64())),
                                ("items", pa.list_(pa.string())), ("matches", pa.list_(pa.struct([("item_id", pa.string()), ("doc_start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())])))])

        def flush(ids, words):
            found = match_shard(words, block)
            cols = [ids, [len(w) for w in words], *zip(*found)]
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, out_schema)], schema=out_schema)

        for batch in batches:
            ids, words, n = [], [], 0
            for i, t in zip(batch.column(0), batch.column(1)):
                ids.append(i.as_py())
                words.append(_numbers(t.as_py(), block.vocab))
                n += len(words[-1])
                if n >= SHARD_WORDS:
                    yield flush(ids, words)
                    ids, words, n = [], [], 0
            if ids:
                yield flush(ids, words)

    return docs.mapInArrow(run, SCHEMA)


def _blocks(benchmark: DataFrame):
    """Number of blocks, and the blocks one after the other as lists of (item_id as text, text).

    Only sizes are summed first; a block holds whole items, about BLOCK_BYTES of text.
    """
    b = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").distinct()
    n = max(1, -(-(b.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return n, ([(r[0], r[1]) for r in b.where(part == k).collect()] for k in range(n))


def match_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, hit spans, matching items, longest matches.

    Columns: doc_id, n_words, n_hit, items (sorted), matches (item, first place of its longest match, length).
    """
    docs = docs.select("doc_id", "text")
    n, blocks = _blocks(benchmark)
    if n == 1:
        found = _scan(docs, next(blocks), window)
    else:  # several blocks: name rows, since ids may repeat, search block after block, and bring their spans together
        named = stored(docs.withColumn("row", F.monotonically_increasing_id()), "docs")
        scans = [stored(_scan(named.select(F.col("row").alias("doc_id"), "text"), items, window), "matches") for items in blocks]
        every = scans[0]
        for s in scans[1:]:
            every = every.unionByName(s)
        found = every.groupBy(F.col("doc_id").alias("row")).agg(
            F.first("n_words").alias("n_words"), F.flatten(F.collect_list("hit_starts")).alias("hit_starts"), F.flatten(F.collect_list("hit_ends")).alias("hit_ends"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("matches")).alias("matches"))
        found = named.select("row", "doc_id").join(found, "row").drop("row")
    spans = F.array_sort(F.arrays_zip("hit_starts", "hit_ends"))
    # words covered by the union of the spans: walk them in order with the end reached so far
    walk = F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end")), lambda a, s: F.struct(
        (a["hit"] + F.greatest(F.lit(0).cast("long"), s["hit_ends"] - F.greatest(a["end"], s["hit_starts"]))).alias("hit"),
        F.greatest(a["end"], s["hit_ends"]).alias("end")), lambda a: a["hit"])
    return found.select("doc_id", "n_words", walk.alias("n_hit"), "items", "matches")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Contract rows: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, matches."""
    m = match_benchmark(docs, benchmark, window)
    return m.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"), "matches")


def _clean(items: list[tuple], window: int, columns: list[str]):
    """Map that drops the rows in which a window of the block occurs."""
    at = columns.index("text")

    def run(batches):
        block = Block(items, window)
        for batch in batches:
            words, keep, n = [], [], 0
            for t in batch.column(at):
                words.append(_numbers(t.as_py(), block.vocab))
                n += len(words[-1])
                if n >= SHARD_WORDS:
                    keep += [not m[0] for m in match_shard(words, block)]
                    words, n = [], 0
            keep += [not m[0] for m in match_shard(words, block)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any benchmark window in them, all columns kept."""
    n, blocks = _blocks(benchmark)
    for _ in range(n):
        docs = docs.mapInArrow(_clean(next(blocks), window, docs.columns), docs.schema)
        docs = stored(docs, "clean") if n > 1 else docs
    return docs


