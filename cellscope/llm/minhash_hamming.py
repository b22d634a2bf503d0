"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

A document's signature is VALUES minima of hashed word shingles, kept to 16 bits each. Two signatures are near when
at most MAX_DIFFERENT of the values differ. The signature is split into CHUNKS chunks; by the pigeonhole principle
near signatures have a chunk with at most floor(MAX_DIFFERENT / CHUNKS) = 1 differing value, so each chunk is indexed
once for each of its values left out: every pair under the signature threshold shares a key. At a similarity of 0.75
the number of differing values is binomial (64, 0.25), which passes 31 about once in 10^5; higher similarity, rarer.
All links are confirmed on the full shingle sets (held as 64-bit hashes of the shingles).

Equal sets are one class from the start, so copies never make pairs. In a key's bucket every class is first compared
with the bucket's smallest class; only classes that are still in different components after that are compared with
each other, so a large group of near copies costs about as many pairs as it has members and no link is lost.

Words are runs of characters other than ASCII white space, with A-Z lower-cased; a text with fewer words than a
shingle has one shingle, the whole sequence.

Defined cases: null texts and texts without words have an empty set and link with nothing (their component is their
own id); a null id has a null component unless its class or links hold an id, and is kept when it has none; rows that
share a doc_id are judged by their own texts; extra columns are ignored; texts of any length are read in pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellscope.llm.common import lower_bytes, mix64, pieces, small, stored
from cellscope.llm.components import connected_components
from cellscope.llm.linking import contract, merged

SHINGLE = 5
VALUES, CHUNKS, MAX_DIFFERENT = 64, 16, 31
WIDTH = VALUES // CHUNKS
#: Cells of a sketch, and classes of a bucket that are compared in one task with as many others.
SKETCH, BLOCK = 1024, 2048
#: Link when 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75

_rng = np.random.default_rng(20)
_MULTIPLY = _rng.integers(1, 2**63, VALUES, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, VALUES, np.uint64)


class WordHashes:
    """64-bit hashes of words, remembered up to a stated number of words."""

    LIMIT = 300_000

    def __init__(self):
        self._known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        import xxhash

        digest, known, found = xxhash.xxh3_64_intdigest, self._known, []
        for part in pieces(lower_bytes(text)):
            words = part.split()
            if len(known) > self.LIMIT:
                known.clear()
            for w in set(words).difference(known):
                known[w] = digest(w)
            found.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the shingles of a word-hash sequence, sorted; empty for no words."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = mix64(h) + words[k:k + n]
    return np.unique(mix64(h))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The low 16 bits of each hash function's minimum over the set."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for cut in range(0, len(shingles), 4096):
        part = shingles[cut:cut + 4096]
        np.minimum(least, (part[None, :] * _MULTIPLY[:, None] + _ADD[:, None]).min(1), out=least)
    return (mix64(least) & np.uint64(0xFFFF)).astype(np.uint16)


def index_keys(sigs: np.ndarray) -> np.ndarray:
    """For each signature its VALUES keys: chunk, value left out, the other three values (exact, not hashed)."""
    chunks = sigs.reshape(len(sigs), CHUNKS, WIDTH).astype(np.uint64)
    keys = np.empty((len(sigs), CHUNKS, WIDTH), np.uint64)
    for out in range(WIDTH):
        rest = [v for v in range(WIDTH) if v != out]
        key = np.uint64(out) + np.arange(CHUNKS, dtype=np.uint64)[None, :] * np.uint64(WIDTH)
        for v in rest:
            key = (key << np.uint64(16)) | chunks[:, :, v]
        keys[:, :, out] = key
    return keys.reshape(len(sigs), VALUES).astype(np.int64)


def _digest(shingles: np.ndarray) -> int:
    return int(mix64(shingles).sum(dtype=np.uint64).astype(np.int64))


def _sign(batches):
    words = WordHashes()
    for batch in batches:
        sizes, d1, sigs = [], [], []
        for t in batch.column(1):
            s = shingle_hashes(words(t.as_py()))
            sizes.append(len(s))
            d1.append(_digest(s) if len(s) else None)
            sigs.append(signature(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(d1, pa.int64()), pa.array(sigs, pa.binary()), batch.column(2)],
                                         names=["doc_id", "n_shingles", "d1", "sig", "mark"])


def _keys(batches):
    for batch in batches:
        if batch.num_rows:
            sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(batch.num_rows, VALUES)
            keys = index_keys(sigs)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), VALUES))], names=["key", "id"])


def _near(batches):
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(batch.num_rows, VALUES) for k in (2, 3))
            keep = (a != b).sum(1) <= MAX_DIFFERENT
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))


def _shingle_sets(batches):
    words = WordHashes()
    for batch in batches:
        d1, sets = [], []
        for t in batch.column(0):
            s = shingle_hashes(words(t.as_py()))
            d1.append(_digest(s) if len(s) else None)
            sets.append(s.astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(d1, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])


def _texts(docs: DataFrame, signed: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts of documents that hold the classes named in the stored table ``ids`` (among them a few that do not)."""
    where = stored(signed.select("doc_id", F.col("d1").alias("id")).join(small(ids), "id", "left_semi").groupBy("id").agg(F.min("doc_id").alias("doc_id")), "mh-where")
    texts = docs.join(small(where.select("doc_id").distinct()), "doc_id", "left_semi").select("text")
    if where.where("doc_id is null").limit(1).count():
        texts = texts.union(docs.where("doc_id is null").select("text"))
    return texts


def _sets(docs: DataFrame, signed: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, set) of the classes named in the stored table ``ids``, from their whole texts."""
    return _texts(docs, signed, ids).mapInArrow(_shingle_sets, "id long, set array<long>").join(small(ids), "id", "left_semi").dropDuplicates(["id"])


def _confirm(docs: DataFrame, signed: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose full shingle sets are similar enough."""
    sets = _sets(docs, signed, stored(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "mh-ids"))
    left, right = sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), sets.select(F.col("id").alias("a"), F.col("set").alias("sa"))
    both = pairs.join(left, "b").join(right, "a").select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("n"))
    return both.where(100 * F.col("n") >= SIMILARITY * (F.col("na") + F.col("nb") - F.col("n"))).select("a", "b")


def _sketches(batches):
    """Sizes and sketches of the texts' sets: how many shingles fall into each of SKETCH cells."""
    words = WordHashes()
    for batch in batches:
        rows = []
        for t in batch.column(0):
            s = shingle_hashes(words(t.as_py()))
            cells = np.bincount((s % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
            rows.append((_digest(s) if len(s) else None, len(s), np.minimum(cells, 255).astype(np.uint8).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.int64(), pa.int64(), pa.binary()))], names=["id", "n", "sketch"])


def _groups(batches, keys: int):
    """Row groups with equal first ``keys`` columns, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)], 1)
        cuts = np.flatnonzero((cols[1:] != cols[:-1]).any(1)) + 1
        for begin, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            if held and tuple(cols[begin]) != last:
                yield pa.Table.from_batches(held)
                held = []
            last = tuple(cols[begin])
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


def _open_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a bucket's classes (or of two blocks of it) from different components that may be linked.

    A pair counts in the first key it shares only. The sketches bound the intersection from above, so no link is lost.
    """
    key, x, y = (table.column(k)[0].as_py() for k in range(3))
    side, ids, comp, n = (table.column(k).to_numpy() for k in ("side", "id", "comp", "n"))
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(len(ids), VALUES)
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(ids), SKETCH)
    full = (sketch == 255).any(1)
    left = np.flatnonzero(side == 0)
    right = left if x == y else np.flatnonzero(side == 1)
    chunk, out = key >> 50, (key >> 48) & 3
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for begin in range(0, len(left), 64):
        rows = left[begin:begin + 64]
        differ = comp[rows][:, None] != comp[right][None, :]
        if x == y:
            differ &= rows[:, None] < right[None, :]
        i, j = np.nonzero(differ)
        for cut in range(0, len(i), 16384):
            p, q = rows[i[cut:cut + 16384]], right[j[cut:cut + 16384]]
            same = sig[p] == sig[q]
            near = same.sum(1) >= VALUES - MAX_DIFFERENT
            p, q, same = p[near], q[near], same[near].reshape(-1, CHUNKS, WIDTH).sum(2)
            first = (same >= WIDTH - 1).argmax(1)
            own = (first == chunk) & ((same[np.arange(len(p)), first] < WIDTH) | (out == 0))
            p, q = p[own], q[own]
            most = np.minimum(sketch[p], sketch[q]).sum(1, dtype=np.int64)
            may = (100 * most >= SIMILARITY * (n[p] + n[q] - most)) | full[p] | full[q]
            a.append(np.minimum(ids[p[may]], ids[q[may]]))
            b.append(np.maximum(ids[p[may]], ids[q[may]]))
    return np.concatenate(a), np.concatenate(b)


def _across(batches):
    for group in _groups(batches, 3):
        a, b = _open_pairs(group)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _with_signatures(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    sig = classes.select("id", "sig")
    return (pairs.join(sig.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a").join(sig.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")
            .select("a", "b", "sa", "sb").mapInArrow(_near, "a long, b long"))


def _placed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, mark, c) of every row: a 64-bit hash of its text, and its component's least set (null without words)."""
    docs = docs.select("doc_id", "text")
    signed = stored(docs.withColumn("mark", F.xxhash64("text")).mapInArrow(_sign, "doc_id long, n_shingles long, d1 long, sig binary, mark long"), "mh-signed")
    # a class is a set; a 64-bit digest of the set names it
    classes = stored(signed.where("n_shingles > 0").groupBy(F.col("d1").alias("id")).agg(F.min("sig").alias("sig")), "mh-classes")
    keyed = classes.select("id", "sig").mapInArrow(_keys, "key long, id long")
    in_key = Window.partitionBy("key")
    shared = keyed.withColumn("center", F.min("id").over(in_key)).withColumn("far", F.max("id").over(in_key)).where("center <> far")
    shared = stored(shared, "mh-shared")

    stars = shared.where("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).union(
        shared.where("id <> center and id <> far").select(F.col("id").alias("a"), F.col("far").alias("b"))).distinct()
    tested = stored(_with_signatures(stars, classes), "mh-tested")
    links = stored(_confirm(docs, signed, tested), "mh-links")
    found = stored(connected_components(links, "a", "b", "mh-cc"), "mh-components")

    # buckets whose classes are not all in one component yet: compare across components, large buckets by blocks
    placed = shared.select("key", "id").join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("comp"))
    open_keys = placed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("k")).where("x <> y and k > 3").select("key", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks"))
    rest = stored(placed.join(open_keys, "key"), "mh-rest")
    about = _texts(docs, signed, stored(rest.select("id").distinct(), "mh-rest-ids")).mapInArrow(_sketches, "id long, n long, sketch binary").join(rest.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"])
    about = stored(about.join(classes, "id"), "mh-about")
    mine = F.pmod(F.xxhash64(F.lit(5), "id"), "blocks").cast("int")
    rest = rest.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.select("key", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), (F.col("mine") > F.col("other")).cast("int").alias("side"), "id", "comp")
    rest = rest.join(about, "id").select("key", "x", "y", "side", "id", "comp", "n", "sig", "sketch").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    across = rest.mapInArrow(_across, "a long, b long").join(tested, ["a", "b"], "left_anti")
    more = _confirm(docs, signed, stored(across, "mh-across"))
    over = connected_components(stored(contract(found, more), "mh-more"), "a", "b", "mh-cc")
    found = merged(found, over)

    rows = signed.select("doc_id", "n_shingles", "d1", "mark").join(stored(found, "mh-components"), F.col("d1") == F.col("id"), "left")
    return rows.select("doc_id", "n_shingles", "mark", F.coalesce("component", "d1").alias("c"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    rows = _placed(docs).drop("mark")
    first = rows.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("least"))
    rows = rows.join(first, "c", "left")
    own = F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return rows.select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull() & F.col("component_id").isNull()))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept: one row of each group of near copies, all columns kept.

    A row is told by its id and its text's hash, so rows that share an id go or stay by their own texts. A group's row is the one
    of the least id (a null id only where there is no other), ties by hash; of rows equal in id and text one stays. Rows without
    words stay, all of them.
    """
    placed = stored(_placed(docs).where("c is not null"), "mh-rows")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark"))
    first = placed.groupBy("c").agg(least.alias("first"), F.count("*").alias("n")).where("n > 1").select("c", "first.doc_id", "first.mark")
    first = stored(first, "mh-first")
    known = ["doc_id", "mark"]
    mine = placed.groupBy("c", *known).agg(F.count("*").alias("n")).alias("m").join(first.alias("f"), F.col("m.c") == F.col("f.c"))
    wins = F.col("m.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("m.mark") == F.col("f.mark"))
    # what goes, and what stays once; rows alone in their group are in neither
    marked = stored(mine.where(~wins | (F.col("n") > 1)).select(F.col("m.doc_id").alias("of"), F.col("m.mark").alias("mark"), wins.alias("once")), "mh-marked")

    def among(rows: DataFrame, some: DataFrame, how: str) -> DataFrame:
        some = small(some)
        return rows.join(some, F.col("doc.doc_id").eqNullSafe(some["of"]) & (F.xxhash64("doc.text") == some["mark"]), how)

    rows = docs.select(F.struct("*").alias("doc"))
    alone = among(rows, marked, "left_anti").select("doc")
    once = among(rows, marked.where("once"), "left_semi").select("doc", F.col("doc.doc_id").alias("of"), F.xxhash64("doc.text").alias("mark"))
    once = once.groupBy("of", "mark").agg(F.first("doc").alias("doc")).select("doc")
    return alone.union(once).select("doc.*")
