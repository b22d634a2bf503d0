"""Fuzzy line dedup: character-shingle MinHash, banding, exact check, union-find.

A line's shingles are its SHINGLE-character windows at every position; a line's signature is the least of its
shingle hashes under HASHES masks. Windows are hashed in numpy, many lines at once (by doubling: two characters, four,
eight, sixteen), in Arrow batches; DataFrame functions took three to four times the allowed CPU for it (README). Bands, buckets,
links and components are DataFrame operations. Each band joins ROWS of
the minima (a minimum serves in two bands); lines with a similarity of 0.75 meet in some band with a probability of
0.9975 to 0.9998, by length. In a band's bucket every line is
first compared with the bucket's smallest and largest; what is outside the bucket's most frequent component afterwards is
compared with the bucket's lines of other components, by marks of the minima and an upper bound from bitmaps. What passes
is confirmed on the whole shingle sets, as is every link: about as many pairs as a large group has lines, and those near the
threshold. Of each component (equal lines included) one line stays, the first by doc_id and line number;
the other occurrences are taken out of their documents.

Lines shorter than MIN_CHARS characters are not shingled: exact copies of those with SHORT_WORDS words or more take
part, the others stay as they are (headings and fragments repeat by chance). Equal lines are recognised by a 64-bit hash of the line; lines are what stands between line feeds.

Defined cases: null texts stay null with no lines; an empty text is one empty line; a document whose lines all go
keeps its row with an empty text; rows that share a doc_id share their lines' fate, line number by line number; lines
of rows with a null id stay and do not make others go; very long lines are shingled whole; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope.llm.common import mix64, small, stored
from cellscope.llm.components import connected_components
from cellscope.llm.linking import contract, merged

SHINGLE, MIN_CHARS, SHORT_WORDS = 16, 40, 3
BANDS, ROWS, HASHES = 16, 3, 24
#: The minima of each band: every minimum in two bands, no two minima together twice.
BAND_OF = [tuple((3 * b + r) % HASHES if b < BANDS // 2 else (b + 8 * r) % HASHES for r in range(ROWS)) for b in range(BANDS)]
#: Link when 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75
#: Equal minima (of HASHES) below which lines that no bucket centre has brought together are not checked further.
LEAST_EQUAL = 10
#: 64-bit words of a line's bitmap of shingle hashes, and of its marks (one of 16 bits for each minimum). With more words the join
#: that compares them becomes a method of over 8,000 bytes, which the JVM does not compile.
MAP_WORDS, MARK_WORDS = 24, HASHES // 4
LEVELS = 2
CELLS = 64 * MAP_WORDS // LEVELS
#: Masks evenly spread over 32 bits: a minimum under a mask is the hash nearest to it.
MASKS = [((k * (1 << 32) // HASHES + 0x2545F491 * (k + 1)) % (1 << 32)) - (1 << 31) for k in range(HASHES)]
#: Characters that are hashed at once in a task; longer lines are cut, with windows across the cuts kept.
BLOCK = 1 << 17
#: Bits of a shingle's hash when sets are compared; the rest of a word names the line.
SET_BITS = 44
_SHORT = rf"(?:[^ \t\x0B\f\r]++[ \t\x0B\f\r]++){{{SHORT_WORDS - 1}}}[^ \t\x0B\f\r]"


def _lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """(doc_id, line_no, line) of the lines that are shingled; with ``short`` also of those that take part as exact copies."""
    every = docs.where("doc_id is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    long = F.length("line") >= MIN_CHARS
    return every.where(long | F.col("line").rlike(_SHORT) if short else long)


def _blocks(lines: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first line, line after the last, hashes, starts, ends) of runs of lines with about BLOCK characters.

    ``hashes`` holds one 64-bit hash for each place; those of line i's windows are hashes[starts[i]:ends[i]]. A line of more than
    BLOCK characters comes alone, in several blocks that share SHINGLE - 1 characters.
    """
    at = 0
    while at < len(lines):
        end, n = at, 0
        while end < len(lines) and (end == at or n + len(lines[end]) <= BLOCK):
            n += len(lines[end])
            end += 1
        if n <= BLOCK:
            yield at, end, *_hashed(lines[at:end])
        else:
            for cut in range(0, n - SHINGLE + 1, BLOCK):
                yield at, end, *_hashed([lines[at][cut:cut + BLOCK + SHINGLE - 1]])
        at = end


def _hashed(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lines], dtype=np.int64)
    ends = np.cumsum(sizes)
    h = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    h = mix64(h + np.uint64(0x632BE59BD9B4E019))
    width = 1
    while width < SHINGLE:
        h = h[:-width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + h[width:]
        width *= 2
    return mix64(h), ends - sizes, ends - (SHINGLE - 1)


def _minima(lines: list[str]) -> np.ndarray:
    """The HASHES minima of every line, one row each."""
    least = np.full((len(lines), HASHES), np.iinfo(np.int32).max, dtype=np.int32)
    for at, end, hashes, starts, ends in _blocks(lines):
        h = np.append((hashes >> np.uint64(32)).astype(np.uint32).view(np.int32), np.int32(0))
        cuts = np.column_stack([starts, ends]).ravel()  # every second run lies between two lines
        for k, mask in enumerate(MASKS):
            least[at:end, k] = np.minimum(least[at:end, k], np.minimum.reduceat(h ^ np.int32(mask), cuts)[::2])
    return least


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, first = np.unique(batch.column("id").to_numpy(), return_index=True)
        some = batch.take(pa.array(first))  # one of the equal lines of a batch
        if some.num_rows:
            minima = _minima(some.column("line").to_pylist())
            yield pa.RecordBatch.from_arrays([some.column("id"), some.column("doc_id"), *[pa.array(minima[:, k]) for k in range(HASHES)]],
                                             names=["id", "doc_id", *[f"m{k}" for k in range(HASHES)]])


def _signatures(lines: DataFrame) -> DataFrame:
    """(id, m0 .. m23, first_doc) of every distinct line that is shingled; first_doc is a document that holds it."""
    minima = [T.StructField(f"m{k}", T.IntegerType()) for k in range(HASHES)]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("doc_id", lines.schema["doc_id"].dataType), *minima])
    each = lines.select(F.xxhash64("line").alias("id"), "doc_id", "line").mapInArrow(_sign, schema)
    return each.groupBy("id").agg(F.min("doc_id").alias("first_doc"), *[F.min(f"m{k}").alias(f"m{k}") for k in range(HASHES)])


def _distinct(lines: list[str]) -> np.ndarray:
    """Sorted distinct words: the line's number above, the hash of one of its shingles below."""
    found = []
    for at, end, hashes, starts, ends in _blocks(lines):
        n = ends - starts
        place = np.arange(n.sum()) + np.repeat(starts - (np.cumsum(n) - n), n)
        owner = np.repeat(np.arange(at, end, dtype=np.uint64), n)
        found.append((owner << np.uint64(SET_BITS)) | (hashes[place] >> np.uint64(64 - SET_BITS)))
    words = np.concatenate(found)
    words.sort()
    return words[np.append(True, words[1:] != words[:-1])]


def _pieces(batch: pa.RecordBatch, *texts: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about BLOCK characters in the named columns, at least a row each."""
    sizes = sum(pc.utf8_length(batch.column(t)).to_numpy(zero_copy_only=False).astype(np.int64) for t in texts)
    at, total = 0, np.cumsum(sizes)
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the pairs (a, b, la, lb) those (a, b) whose shingle sets are similar enough."""
    for batch in batches:
        for part in _pieces(batch, "la", "lb"):
            x, y = (_distinct(part.column(c).to_pylist()) for c in ("la", "lb"))
            both = np.concatenate([x, y])
            both.sort()
            common = both[1:][both[1:] == both[:-1]]
            sizes, n = (np.bincount((w >> np.uint64(SET_BITS)).astype(np.int64), minlength=part.num_rows) for w in (both, common))
            yield part.select(["a", "b"]).filter(pa.array(100 * n >= SIMILARITY * (sizes - n)))


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n, spare, w0 .. w23) for lines (id, line): the shingle set's size, what it has more than bits in its bitmap, and that bitmap.

    The bitmap has LEVELS bits for each of CELLS cells of hashes: whether the set has a shingle there, and a second one.
    """
    for batch in batches:
        for part in _pieces(batch, "line"):
            words = _distinct(part.column("line").to_pylist())
            owner = (words >> np.uint64(SET_BITS)).astype(np.int64)
            cell = ((words & np.uint64((1 << SET_BITS) - 1)) % np.uint64(CELLS)).astype(np.int64)
            held = np.bincount(owner * CELLS + cell, minlength=part.num_rows * CELLS).reshape(-1, CELLS)
            bits = np.concatenate([held > k for k in range(LEVELS)], axis=1)
            maps = np.packbits(bits, axis=1).view(np.int64)
            n = np.bincount(owner, minlength=part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n), pa.array(n - bits.sum(axis=1, dtype=np.int64)), *[pa.array(maps[:, k].copy()) for k in range(MAP_WORDS)]],
                                             names=["id", "n", "spare", *[f"w{k}" for k in range(MAP_WORDS)]])


def _sets(docs: DataFrame, signed: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, line) of the lines named in the stored table ``ids``, read again from one document each.

    The text stands for its shingle set, which is many times as long.
    """
    ids = small(ids)
    holders = small(stored(signed.join(ids, "id", "left_semi").select(F.col("first_doc").alias("doc_id")).distinct(), "line-holders"))
    held = _lines(docs.join(holders, "doc_id", "left_semi")).withColumn("id", F.xxhash64("line")).join(ids, "id", "left_semi")
    return stored(held.groupBy("id").agg(F.min("line").alias("line")), "line-sets")


def _confirm(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of lines whose whole shingle sets are similar enough."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("line").alias("la")), "a").join(sets.select(F.col("id").alias("b"), F.col("line").alias("lb")), "b")
    return both.select("a", "b", "la", "lb").mapInArrow(_similar, "a long, b long")


def _about(signed: DataFrame, sets: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, n, spare, w0 .., e0 ..) of the lines in the stored table ``ids``: bitmaps of their shingles and marks of their minima."""
    ids = small(ids)
    schema = "id long, n long, spare long, " + ", ".join(f"w{k} long" for k in range(MAP_WORDS))
    maps = sets.join(ids, "id", "left_semi").select("id", "line").mapInArrow(_maps, schema)
    marks = [F.expr(" | ".join(f"shiftleft(1L, (m{4 * k + i} & 15) + {16 * i})" for i in range(4))).alias(f"e{k}") for k in range(MARK_WORDS)]
    return stored(maps.join(signed.join(ids, "id", "left_semi").select("id", *marks), "id"), "line-about")


def _near(left: DataFrame, right: DataFrame, about: DataFrame) -> DataFrame:
    """Pairs (a, b) of lines of a band, (band, id, comp, most) on both sides, that are in different components and may be linked.

    Equal minima have equal marks, so at least LEAST_EQUAL common marks are asked for. In a cell two sets share at most the
    smaller of their numbers of shingles: the bits that both bitmaps have, and no more than the ``spare`` ones of either. This
    bounds the intersection from above. Of two lines outside the most frequent component only one order is taken.
    """
    cols = [c for c in about.columns if c != "id"]
    a, b = (side.join(about, "id").select(*[F.col(c).alias(i + c) for c in ("band", "id", "comp", "most", *cols)]) for i, side in (("a", left), ("b", right)))
    both = lambda c, n: sum(F.bit_count(F.col(f"a{c}{k}").bitwiseAND(F.col(f"b{c}{k}"))) for k in range(n))
    common = F.least("aspare", "bspare") + both("w", MAP_WORDS)
    apart = (F.col("acomp") < F.col("bcomp")) | F.col("bmost") & (F.col("acomp") != F.col("bcomp"))
    alike = (both("e", MARK_WORDS) >= LEAST_EQUAL) & ((100 + SIMILARITY) * common >= SIMILARITY * (F.col("an") + F.col("bn")))
    met = a.join(b, (F.col("aband") == F.col("bband")) & apart & alike)
    return met.select(F.least("aid", "bid").alias("a"), F.greatest("aid", "bid").alias("b")).distinct()


def _apart(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(band, id, comp, most) of the lines of buckets that are not all in one component; ``most`` marks the bucket's most frequent one."""
    placed = shared.join(found, "id", "left").select("band", "id", F.coalesce("component", "id").alias("comp"))
    held = placed.groupBy("band", "comp").agg(F.count("*").alias("n"))
    mains = held.groupBy("band").agg(F.sum("n").alias("k"), F.count("*").alias("comps"), F.max(F.struct("n", "comp"))["comp"].alias("main")).where("comps > 1 and k > 3")
    return placed.join(mains, "band").select("band", "id", "comp", (F.col("comp") == F.col("main")).alias("most"))


def line_components(docs: DataFrame) -> DataFrame:
    """(id, component) of the distinct lines that are linked with another distinct line."""
    signed = stored(_signatures(_lines(docs)), "line-signatures")
    band = [F.xxhash64(F.lit(b), *[f"m{k}" for k in BAND_OF[b]]) for b in range(BANDS)]
    keyed = signed.select("id", F.explode(F.array(*band)).alias("band"))
    ends = keyed.groupBy("band").agg(F.min("id").alias("center"), F.max("id").alias("far")).where("center <> far")
    # a band's row is hashed and its lines stream past: they are not sorted
    shared = stored(keyed.join(stored(ends, "line-band-ends").hint("shuffle_hash"), "band"), "line-buckets")
    sets = _sets(docs, signed, stored(shared.select("id").distinct(), "line-ids"))
    stars = shared.where("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).union(
        shared.where("id <> center and id <> far").select(F.col("id").alias("a"), F.col("far").alias("b"))).distinct()
    tested = stored(stars, "line-tested")
    links = stored(_confirm(sets, tested), "line-links")
    found = stored(connected_components(links, "a", "b", "line-cc"), "line-components")

    # buckets whose lines are not all in one component yet: what is outside the most frequent one is compared across components
    rest = stored(_apart(shared, found), "line-rest")
    about = _about(signed, sets, stored(rest.select("id").distinct(), "line-rest-ids"))
    across = _near(rest.where("not most"), rest, about).join(tested, ["a", "b"], "left_anti")
    more = _confirm(sets, stored(across, "line-across"))
    over = connected_components(stored(contract(found, more), "line-more"), "a", "b", "line-cc")
    return stored(merged(found, over), "line-components")


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, gone): numbers of the lines of a document that repeat an earlier line of the corpus."""
    found = line_components(docs)
    placed = _lines(docs, short=True).select("doc_id", "line_no", F.xxhash64("line").alias("id"))
    placed = placed.join(found, "id", "left").select("doc_id", "line_no", F.coalesce("component", "id").alias("component"))
    placed = stored(placed, "line-places")
    first = placed.groupBy("component").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("n")).where("n > 1").select("component", "first")
    gone = placed.join(first, "component").where(F.struct("doc_id", "line_no") != F.col("first"))
    return gone.groupBy("doc_id").agg(F.collect_list("line_no").alias("gone"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with repeated lines taken out of ``text``; adds n_lines and n_kept (columns so called are replaced)."""
    gone = stored(dropped_lines(docs.select("doc_id", "text")).withColumnRenamed("doc_id", "gone_id"), "line-gone")
    rows = docs.select(F.struct("*").alias("doc")).join(gone, F.col("doc.doc_id") == F.col("gone_id"), "left")
    given = F.col("doc.text")
    lines = F.split(given, "\n", -1)
    kept = F.filter(lines, lambda line, i: ~F.array_contains(F.col("gone"), i))
    text = F.when(F.col("gone").isNull(), given).otherwise(F.array_join(kept, "\n"))
    n = F.when(given.isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    columns = [text.alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c not in ("n_lines", "n_kept")]
    return rows.select(*columns, n.alias("n_lines"), (n - F.coalesce(F.size(F.col("gone")), F.lit(0))).cast("long").alias("n_kept"))
