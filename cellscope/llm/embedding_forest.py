"""Embedding near-duplicates with a forest of random-projection trees.

A tree splits the unit vectors again and again by a random direction of its own for each level, at a threshold near
the middle of the node; vectors close to a threshold spill over to both sides. Thresholds are fitted on a bounded
sample (SAMPLE vectors); every vector is routed through every tree. Vectors are compared inside the leaves only,
by cosine in double precision, so every reported link is exact; links may be missed only if a pair shares no leaf.
The depth follows the number of vectors, so a leaf holds about LEAF vectors at any size.

A leaf that is larger than a block (near copies that no split can part) is cut into blocks, and pairs of blocks go to
different tasks. Tasks return per vector the number of links and a spanning forest of the links, never the pairs; a
pair that shares several leaves is counted in the first of them. Equal vectors with equal labels are one class.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do
rows with a null label (their component is their own vec_id); vectors of different length never link; rows with a
null vec_id take part, count as links and have a null component unless a linked row has an id; repeated rows are
copies and link with each other; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import stored
from cellscope.llm.components import connected_components

TREES, LEAF, BLOCK = 12, 1024, 1024
SAMPLE = 20_000
#: Half width of the spill band, in units of a projection's spread over the sample.
SPILL = 0.1
#: A vector goes to at most this many leaves of a tree (its nearest thresholds spill first).
MAX_LEAVES = 4
COSINE = 0.98
#: Nodes with fewer sample vectors take their direction's middle as threshold.
FEW = 64


class Tree:
    """Routing of one tree: directions by level, thresholds by node."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int):
        rng = np.random.default_rng(seed)
        self.dim, self.depth, self.seed = sample.shape[1], depth, seed
        self.middle = sample.mean(0) if len(sample) else np.zeros(self.dim)
        self.directions = rng.standard_normal((depth, self.dim))
        self.directions /= np.linalg.norm(self.directions, axis=1, keepdims=True)
        self.bands = [SPILL * float((sample @ d).std()) if len(sample) else 0.0 for d in self.directions]
        self.thresholds: list[dict[int, float]] = []
        node = np.zeros(len(sample), np.int64)
        for d in self.directions:
            proj, cut = sample @ d, {}
            order = np.argsort(node, kind="stable")
            ends = np.flatnonzero(np.append(np.diff(node[order]) != 0, True)) + 1 if len(node) else []
            begin = 0
            for end in ends:
                rows = order[begin:end]
                begin = end
                if len(rows) >= FEW:
                    cut[int(node[rows[0]])] = float(np.quantile(proj[rows], rng.uniform(0.35, 0.65)))
            self.thresholds.append(cut)
            default = float(self.middle @ d)
            limit = np.array([cut.get(int(x), default) for x in node])
            node = node * 2 + (proj > limit if len(node) else 0)

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs: one leaf for each row, more where it lies in spill bands."""
        row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        for d, cut, band in zip(self.directions, self.thresholds, self.bands):
            proj = (x @ d)[row]
            default = float(self.middle @ d)
            values, inverse = np.unique(node, return_inverse=True)
            limit = np.array([cut.get(int(v), default) for v in values])[inverse] if len(values) else np.empty(0)
            right = proj > limit
            room = np.bincount(row, minlength=len(x))[row] < MAX_LEAVES
            spill = (np.abs(proj - limit) <= band) & room
            # of several spills of one row only as many as there is room for
            seen = np.flatnonzero(spill)
            _, first = np.unique(row[seen], return_index=True)
            both = seen[first]
            node, row = np.append(node * 2 + right, node[both] * 2 + ~right[both]), np.append(row, row[both])
        order = np.lexsort((node, row))
        return row[order], node[order]


def unit(vectors) -> tuple[np.ndarray, np.ndarray]:
    """Rows as double-precision unit vectors, and which rows are usable (one common length within the batch)."""
    n = len(vectors)
    dim = max((len(v) for v in vectors if v is not None), default=0)
    out, good = np.zeros((n, dim)), np.zeros(n, bool)
    for i, v in enumerate(vectors):
        if v is None or len(v) != dim or not dim:
            continue
        a = np.array([np.nan if c is None else c for c in v], np.float64) if isinstance(v, list) else np.asarray(v, np.float64)
        top = np.abs(a).max()
        if np.isfinite(top) and np.isfinite(a).all() and top > 0:
            a = a / top
            out[i], good[i] = a / np.linalg.norm(a), True
    return out, good


def _usable(embedding: str = "embedding"):
    e = F.col(embedding)
    bad = F.exists(e, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return F.coalesce(e.isNotNull() & (F.size(e) > 0) & ~bad & F.exists(e, lambda c: c != 0), F.lit(False))


def _route(trees: list[Tree]):
    """Map that gives every class the blocks it belongs to, with all its leaves to tell first meetings."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, _ = unit(batch.column("embedding").to_pylist())
            found = [t.leaves(x) for t in trees]
            member = [[set() for _ in trees] for _ in range(len(x))]
            for t, (rows, leaves) in enumerate(found):
                for r, leaf in zip(rows.tolist(), leaves.tolist()):
                    member[r][t].add(leaf)
            packed = [[",".join(map(str, sorted(s))) for s in m] for m in member]
            tree = np.concatenate([np.full(len(r), t) for t, (r, _) in enumerate(found)])
            row, leaf = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(take), batch.column("label").take(take), pa.array(tree, pa.int32()), pa.array(leaf, pa.int64()),
                 batch.column("copies").take(take), batch.column("embedding").take(take), pa.array([packed[r] for r in row.tolist()], pa.list_(pa.string()))],
                names=["id", "label", "tree", "leaf", "copies", "embedding", "member"])

    return run


def _links(frame: pd.DataFrame) -> pd.DataFrame:
    """Links between the rows of side 0 and side 1 of a block pair (or within one block): counts and a spanning forest."""
    frame = frame.sort_values("id", kind="stable").reset_index(drop=True)
    tree = int(frame["tree"].iloc[0])
    same = bool((frame["x"] == frame["y"]).all())
    left = frame.index[frame["side"] == 0].to_numpy()
    right = left if same else frame.index[frame["side"] == 1].to_numpy()
    x, _ = unit([np.asarray(v) for v in frame["embedding"]])
    ids, copies, member = frame["id"].to_numpy(), frame["copies"].to_numpy(), frame["member"].tolist()
    # leaf sets as rows of numbers: a pair counts in the first tree where it meets, and there in its lowest common leaf
    earlier = [_leaf_sets([m[t] for m in member]) for t in range(tree)]
    lower = _leaf_sets([m[tree] for m in member], int(frame["leaf"].iloc[0]))
    count, parent = np.zeros(len(ids), np.int64), list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for begin in range(0, len(left), 256):
        rows = left[begin:begin + 256]
        near = x[rows] @ x[right].T >= COSINE
        i, j = np.nonzero(near)
        i, j = rows[i], right[j]
        if same:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        met = np.zeros(len(i), bool)
        for sets in [*earlier, lower]:
            met |= (sets[i][:, :, None] == sets[j][:, None, :]).any((1, 2))
        i, j = i[~met], j[~met]
        np.add.at(count, i, copies[j])
        np.add.at(count, j, copies[i])
        for a, b in zip(i.tolist(), j.tolist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    up = np.array([root(i) for i in range(len(ids))])
    keep = (count > 0)
    return pd.DataFrame({"id": ids[keep], "links": count[keep], "up": ids[up][keep]})


def _leaf_sets(packed: list[str], below: int | None = None) -> np.ndarray:
    """Leaf sets of one tree (only leaves under ``below``) as rows of numbers; unused places never equal another row's."""
    out = np.repeat(-1 - np.arange(len(packed))[:, None], MAX_LEAVES, axis=1)
    for r, leaves in enumerate(packed):
        mine = [x for x in map(int, leaves.split(",")) if below is None or x < below]
        out[r, :len(mine)] = mine
    return out


def embedding_duplicates(vectors: DataFrame) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    v = vectors.select("vec_id", "embedding", "label").withColumn("ok", _usable() & F.col("label").isNotNull())
    # the class of a row: equal label and equal components; -0.0 and 0.0 are one number
    canon = F.transform("embedding", lambda c: F.when(c == 0, F.lit(0.0)).otherwise(c.cast("double")))
    v = v.withColumn("id", F.when(F.col("ok"), F.xxhash64(F.lit(3), F.col("label"), canon)))
    classes = v.where("ok").groupBy("id", "label").agg(F.count("*").alias("copies"), F.min("embedding").alias("embedding"))
    classes = stored(classes.withColumn("dim", F.size("embedding")), "emb-classes")
    parts = []
    for dim, n in sorted((r["dim"], r["count"]) for r in classes.groupBy("dim").count().collect()):
        parts.append(_forest(classes.where(F.col("dim") == dim), n))
    if parts:
        found = parts[0]
        for p in parts[1:]:
            found = found.union(p)
        found = stored(found, "emb-links")
    else:
        found = vectors.sparkSession.createDataFrame([], "id long, links long, up long")
    comps = connected_components(found.select("id", "up"), "id", "up", "emb-cc")
    comps = stored(comps, "emb-components").withColumnRenamed("component", "comp")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    info = classes.select("id", "copies").join(links, "id", "left").join(comps, "id", "left")
    rows = v.select("vec_id", "id").join(info, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    least = rows.where("comp is not null").groupBy("comp").agg(F.min("vec_id").alias("least"))
    rows = rows.join(least, "comp", "left")
    rows = rows.select("vec_id", F.coalesce(F.col("links") + F.col("copies") - 1, F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
                       F.when(F.col("comp").isNull(), F.col("vec_id")).otherwise(F.col("least")).alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("vec_id").isNull() & F.col("component_id").isNull()))


def _forest(classes: DataFrame, n: int) -> DataFrame:
    """Link counts and spanning links (id, links, up) of classes whose vectors have one length."""
    share = min(1.0, SAMPLE / max(1, n))
    picked = classes if share == 1.0 else classes.where(F.pmod(F.xxhash64(F.lit(11), F.col("id")), F.lit(1 << 20)) < int(share * (1 << 20)))
    sample, _ = unit([r[0] for r in picked.orderBy("id").select("embedding").limit(SAMPLE).collect()])
    depth = max(0, int(np.ceil(np.log2(max(1, n) / LEAF))))
    trees = [Tree(sample, depth, 100 + t) for t in range(TREES if depth else 1)]
    routed = classes.select("id", "label", "copies", "embedding").mapInArrow(
        _route(trees), f"id long, label {dict(classes.dtypes)['label']}, tree int, leaf long, copies long, embedding {dict(classes.dtypes)['embedding']}, member array<string>")
    key = ["tree", "label", "leaf"]
    sizes = routed.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("blocks > 1")
    sizes = stored(sizes, "emb-leaves")
    blocked = routed.join(sizes, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    blocked = blocked.withColumn("mine", F.pmod(F.xxhash64(F.lit(5), F.col("id")), F.col("blocks")).cast("int"))
    # a row of block b takes part in (b, c) for every c >= b and in (c, b) for every c < b
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    blocked = blocked.withColumn("other", other)
    blocked = blocked.select("id", *key, "copies", "embedding", "member", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"),
                             (F.col("mine") > F.col("other")).cast("int").alias("side"))
    return blocked.groupBy(*key, "x", "y").applyInPandas(_links, "id long, links long, up long")
