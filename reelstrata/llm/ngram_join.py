"""N-gram Jaccard join: which documents share most of their word shingles (of 4 words and 85%, unless given).

Shingles are hashed to 64 bits; texts with equal sets form a class, and one point per class goes on. Two sets with the
wanted similarity share one of the least hashes of each (as many as a set may lack, and one more), so points meet under
those. Where points meet, a count-vector R-tree finds the pairs that may be similar: shingles are hashed into groups, the
counts of a set in the groups are its point, points are packed by size into leaves with bounding boxes, and the sum
over groups of the smaller coordinate (of the boxes, then of the points) bounds the overlap. Surviving pairs
form candidate clusters. Those are first narrowed by the prefixes, which hold every value up to their last, so that
a value one of them lacks is missing from its set; inside what is left, overlaps are counted exactly. Links within a cluster are followed breadth first,
so that a group of n copies needs about n comparisons and yields fewer than n links, and no pair is lost that
would join two components.

Meeting places of more than LEAF points and clusters of more than SHINGLES shingles are cut by size into leaves and
become one task for each pair of leaves whose sizes allow a link; no group is gathered whole.

Defined results: NULL, empty and blank texts have no shingles, are linked with nothing and are their own component;
fewer words than a shingle has are one; a NULL doc_id takes the least id of its component, NULL if there is none;
repeated rows are in one class; the component id is the least doc_id that links lead to.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelstrata.llm.common import fresh, stored
from reelstrata.llm.graph import components

SHINGLE, PERCENT = 4, 85
GROUPS = 64
#: A count that a point's 16 bits cannot hold stands for any larger one.
MOST = (1 << 16) - 1
#: Points of a meeting place that one task takes from each of at most two leaves.
LEAF = 8_192
#: Shingles of a cluster that one task takes from each of at most two leaves; any set counts as SMALLEST at least.
SHINGLES, SMALLEST = 1 << 21, 256
#: Shingles that are compared with a set in one pass.
PASS = 1 << 18
#: Points of a leaf of the tree inside a task.
PAGE = 32
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    s = h[: len(h) - width + 1].copy()
    for k in range(1, width):
        s = s * MIX[0] + h[k : len(h) - width + 1 + k]
        s ^= s >> np.uint64(29)
    s *= MIX[1]
    s ^= s >> np.uint64(32)
    return np.unique(s)


def counts(found: np.ndarray) -> np.ndarray:
    """The point of a set: its shingles in each group, taken from bits that do not decide the prefix."""
    return np.bincount((found & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS).astype(np.int32)


def packed(found: np.ndarray) -> bytes:
    return np.minimum(counts(found), MOST).astype(np.uint16).tobytes()


def unpacked(points) -> np.ndarray:
    """The points, with counts that are no less than those of the sets."""
    out = np.frombuffer(b"".join(points), np.uint16).reshape(-1, GROUPS).astype(np.int32)
    out[out == MOST] = 1 << 24
    return out


def prefix(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1


def linked(overlap, n, m, percent: int = PERCENT):
    return overlap * (100 + percent) >= percent * (n + m)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def node_of(found: np.ndarray) -> int:
    """The 64-bit name of a set: equal sets, equal names."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes(), seed=85)).view(np.int64))


def signatures(text: Column, width: int, percent: int) -> Column:
    """n, node, the prefix and the point of every text's set."""

    @F.arrow_udf("n long, node long, prefix array<long>, point binary")
    def run(texts: pa.Array) -> pa.Array:
        sizes, nodes, parts, points = [], [], [], []
        for text in texts.to_pylist():
            found = shingles(text, width)
            sizes.append(len(found))
            nodes.append(node_of(found))
            parts.append(signed(found[: prefix(len(found), percent)] if len(found) else found))
            points.append(packed(found))
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32))
        values = pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
        columns = [
            pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
            pa.ListArray.from_arrays(offsets, values), pa.array(points, pa.binary()),
        ]
        return pa.StructArray.from_arrays(columns, ["n", "node", "prefix", "point"])

    return run(text)


class Union:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


class Tree:
    """Leaves of points packed by size, each with the box of its points: largest counts and smallest size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, rows: np.ndarray):
        order = rows[np.argsort(sizes[rows], kind="stable")]
        self.pages = [order[i : i + PAGE] for i in range(0, len(order), PAGE)]
        self.top = np.stack([points[page].max(0) for page in self.pages])
        self.low = np.array([sizes[page].min() for page in self.pages])
        self.high = np.array([sizes[page].max() for page in self.pages])


def survivors(points: np.ndarray, sizes: np.ndarray, left: Tree, right: Tree, same: bool, percent: int = PERCENT):
    """Pairs of pages whose boxes, and then the pairs of rows whose points, allow a link."""
    for i, page in enumerate(left.pages):
        start = i if same else 0
        bound = np.minimum(left.top[i], right.top[start:]).sum(1)
        near = (right.low[start:] * percent <= left.high[i] * 100) & (left.low[i] * percent <= right.high[start:] * 100)
        for j in np.flatnonzero(linked(bound, left.low[i], right.low[start:], percent) & near) + start:
            other = right.pages[j]
            yield page, other, lambda a=page, b=other: linked(
                np.minimum(points[a][:, None], points[b][None]).sum(2), sizes[a][:, None], sizes[b][None], percent
            )


def trees(points: np.ndarray, sizes: np.ndarray, side: np.ndarray) -> tuple[Tree, Tree, bool]:
    """The tree of each side; one tree for both if all rows are on one side."""
    if (side == side[0]).all():
        tree = Tree(points, sizes, np.arange(len(sizes)))
        return tree, tree, True
    return Tree(points, sizes, np.flatnonzero(side == 0)), Tree(points, sizes, np.flatnonzero(side == 1)), False


def candidates(nodes: np.ndarray, sizes: np.ndarray, points: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Fewer pairs than rows that connect whatever the bounds leave connected."""
    union, out = Union(len(nodes)), []
    left, right, same = trees(points, sizes, side)
    for page, other, test in survivors(points, sizes, left, right, same, percent):
        roots = [union.root(i) for i in (*page, *other)]
        if len(set(roots)) == 1:
            continue
        for a, b in zip(*np.nonzero(test())):
            if union.join(int(page[a]), int(other[b])):
                out.append((int(nodes[page[a]]), int(nodes[other[b]])))
    return out


def meet(batches, percent: int):
    """Candidate pairs of rows sorted by meeting place; only whole places are worked on."""
    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        place = np.flatnonzero((rows[["token", "leaf_a", "leaf_b"]].diff().fillna(1) != 0).any(axis=1).to_numpy())
        if len(place):
            held = rows.iloc[place[-1] :]
            yield settle(rows.iloc[: place[-1]], place, percent)
    if held is not None and len(held):
        yield settle(held.reset_index(drop=True), np.array([0, len(held)]), percent)


def settle(rows: pd.DataFrame, place: np.ndarray, percent: int) -> pd.DataFrame:
    """Places of up to PAGE rows all at once, pairs at equal distances; larger ones with a tree each."""
    out_u, out_v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(rows):
        nodes, sizes, side = (rows[c].to_numpy() for c in ("node", "n", "side"))
        points = unpacked(rows["point"])
        starts = place[place < len(rows)]
        lengths = np.diff(np.append(starts, len(rows)))
        group = np.repeat(np.arange(len(starts)), lengths)
        small = (lengths <= PAGE)[group]
        for shift in range(1, min(PAGE, len(rows))):
            i = np.flatnonzero((group[:-shift] == group[shift:]) & small[shift:])
            for at in range(0, len(i), 4096):
                a = i[at : at + 4096]
                b = a + shift
                good = linked(np.minimum(points[a], points[b]).sum(1), sizes[a], sizes[b], percent)
                out_u.append(nodes[a[good]])
                out_v.append(nodes[b[good]])
        for k in np.flatnonzero(lengths > PAGE):
            span = slice(starts[k], starts[k] + lengths[k])
            found = candidates(nodes[span], sizes[span], points[span], side[span], percent)
            found = np.array(found, np.int64).reshape(-1, 2)
            out_u.append(found[:, 0])
            out_v.append(found[:, 1])
    return pd.DataFrame({"u": np.concatenate(out_u), "v": np.concatenate(out_v)}).drop_duplicates()


def walk(rows: pd.DataFrame, points: np.ndarray, sets: list[np.ndarray], most, percent: int) -> pd.DataFrame:
    """Pairs that connect what `most` leaves connected among the sets of a cluster or of two of its leaves.

    From each set reached, all sets not yet reached whose point allows it are compared, PASS values at once.
    `most` bounds the overlap of a set and others, which it gets one after another with the places they begin at."""
    sizes, nodes, side = rows["n"].to_numpy(), rows["node"].to_numpy(), rows["side"].to_numpy()
    lengths = np.array([len(s) for s in sets])
    open_ = np.ones(len(sets), bool)
    out = []
    one_side = (side == side[0]).all()
    for first in range(len(sets)):
        if not open_[first]:
            continue
        open_[first] = False
        queue = [first]
        while queue:
            i = queue.pop()
            near = open_ if one_side else open_ & (side != side[i])
            rest = np.flatnonzero(near & (sizes * percent <= sizes[i] * 100) & (sizes[i] * percent <= sizes * 100))
            rest = rest[linked(np.minimum(points[rest], points[i]).sum(1), sizes[rest], sizes[i], percent)]
            if not len(rest):
                continue
            for some in np.split(rest, np.flatnonzero(np.diff(np.cumsum(lengths[rest]) // PASS)) + 1):
                every = np.concatenate([sets[j] for j in some])
                begins = np.concatenate([[0], np.cumsum(lengths[some])[:-1]])
                bound = most(sets[i], sizes[i], every, begins, lengths[some], sizes[some])
                for j in some[linked(bound, sizes[some], sizes[i], percent)]:
                    open_[j] = False
                    queue.append(int(j))
                    out.append((int(nodes[i]), int(nodes[j])))
    return pd.DataFrame(out, columns=["u", "v"], dtype="int64")


def shared(found: np.ndarray, every: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """How many values of a set are in each of the others."""
    at = np.minimum(np.searchsorted(found, every), len(found) - 1)
    return np.add.reduceat((found[at] == every).astype(np.int64), begins)


def overlap(found, n, every, begins, lengths, sizes) -> np.ndarray:
    """The overlap of whole sets."""
    return shared(found, every, begins)


def prefix_bound(found, n, every, begins, lengths, sizes) -> np.ndarray:
    """What prefixes leave of the overlap: up to the end of the shorter one, a value of one set that the other
    lacks is lost."""
    ends = every[begins + lengths - 1]
    both = shared(found, every, begins)
    mine = np.searchsorted(found, ends, "right")
    theirs = np.add.reduceat((every <= found[-1]).astype(np.int64), begins)
    return np.minimum(n - (mine - both), sizes - (theirs - both))


def narrow(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Candidate pairs that the prefixes of the sets leave."""
    prefixes = [np.asarray(p).view(np.uint64) for p in rows["prefix"]]
    return walk(rows, unpacked(rows["point"]), prefixes, prefix_bound, percent)


def follow(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links, by exact overlap."""
    sets = [np.frombuffer(s, np.uint64) for s in rows["found"]]
    return walk(rows, np.stack([counts(s) for s in sets]), sets, overlap, percent)


def leaves(rows: DataFrame, key: str, weight: Column, limit: int, percent: int) -> DataFrame:
    """Rows of key, node and n with the tasks they take part in: leaf_a, leaf_b and the side they are on.

    Keys are weighed by counts that combine on the map side; rows alone under their key go, and the join back may be split
    where a key is hot. Keys of up to the limit of weight are one task. Others are cut by size into leaves of about that
    weight, from the weight of each size, with the rows of one size dealt by their hash, so no key is ever
    sorted or numbered as a whole. A leaf meets itself and the later leaves whose smallest set may still be similar to its largest."""
    of = rows.groupBy(F.col(key).alias("of_key")).agg(F.count(F.lit(1)).alias("of"), F.sum(weight).alias("load"))
    loads = stored(of.where("of > 1").drop("of"), "loads")
    shared_rows = stored(rows.join(loads, F.col(key) == F.col("of_key")).drop("of_key"), "shared")
    small = shared_rows.where(F.col("load") <= limit).select(
        *rows.columns, F.lit(0).alias("leaf_a"), F.lit(0).alias("leaf_b"), F.lit(0).alias("side")
    )
    large = shared_rows.where(F.col("load") > limit)
    sizes = large.groupBy(F.col(key).alias("size_key"), F.col("n").alias("size_n")).agg(F.sum(weight).alias("span"))
    upto = Window.partitionBy("size_key").orderBy("size_n").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored(sizes.withColumn("start", F.coalesce(F.sum("span").over(upto), F.lit(0))), "sizes")
    dealt = F.pmod(F.xxhash64("node", F.lit("leaf")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    leaf = F.floor((F.col("start") + F.floor(dealt * F.col("span"))) / limit).cast("int")
    large = large.join(sizes, (F.col(key) == F.col("size_key")) & (F.col("n") == F.col("size_n")))
    large = large.select(*rows.columns, leaf.alias("leaf"))
    boxes = large.groupBy(key, "leaf").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    a = boxes.select(F.col(key).alias("k"), F.col("leaf").alias("leaf_a"), F.col("high").alias("a_high"))
    b = boxes.select(F.col(key).alias("kb"), F.col("leaf").alias("leaf_b"), F.col("low").alias("b_low"))
    fits = (F.col("k") == F.col("kb")) & (F.col("leaf_a") <= F.col("leaf_b")) & (F.col("b_low") * percent <= F.col("a_high") * 100)
    pairs = a.join(b, fits).select("k", "leaf_a", "leaf_b")
    ends = F.when(F.col("leaf_a") == F.col("leaf_b"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    tasks = pairs.withColumn("side", F.explode(ends)).withColumn("l", F.when(F.col("side") == 0, F.col("leaf_a")).otherwise(F.col("leaf_b")))
    split = large.join(tasks, (F.col(key) == F.col("k")) & (F.col("leaf") == F.col("l")))
    return small.unionByName(split.select(*rows.columns, "leaf_a", "leaf_b", "side"))


def classes(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, h (the hash of the text), n and node of every row; and node, best and component of every class with shingles.

    The best row of a class is that of the least id (NULL is the greatest), then of the least text hash."""
    signed_docs = docs.select("doc_id", F.xxhash64("text").alias("h"), signatures(F.col("text"), width, percent).alias("s"))
    signed_docs = stored(signed_docs.select("doc_id", "h", "s.*"), "signatures")
    some = signed_docs.where("n > 0")
    points = stored(some.select("node", "n", "prefix", "point").dropDuplicates(["node"]), "points")
    tokens = points.select(F.explode("prefix").alias("token"), "node", "n")
    met = leaves(tokens, "token", F.lit(1), LEAF, percent).join(points.select("node", "point"), "node")
    places = met.repartition("token", "leaf_a", "leaf_b").sortWithinPartitions("token", "leaf_a", "leaf_b")
    places = places.select("token", "leaf_a", "leaf_b", "side", "node", "n", "point")
    pairs = places.mapInPandas(lambda batches: meet(batches, percent), "u long, v long").distinct()
    rough = components(pairs, "candidates").join(points.select("node", "n"), "node")
    rough = rough.select(F.col("component").alias("cluster"), "node", "n")
    load = F.greatest(F.floor(F.col("n") * (100 - percent) / 100) + 1, F.lit(SMALLEST))
    tiles = leaves(rough, "cluster", load, SHINGLES, percent).join(points.select("node", "prefix", "point"), "node")
    pairs = tiles.groupBy("cluster", "leaf_a", "leaf_b").applyInPandas(lambda rows: narrow(rows, percent), "u long, v long")
    clusters = components(pairs, "narrowed")
    # the sets of the candidates, from one document of each class
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("best")
    source = some.groupBy("node", "n").agg(best)
    wanted = clusters.join(source, "node").select("best.doc_id", "best.h", "node", "n", F.col("component").alias("cluster"))

    @F.arrow_udf("binary")
    def sets(texts: pa.Array) -> pa.Array:
        return pa.array([shingles(t, width).tobytes() for t in texts.to_pylist()], pa.binary())

    @F.arrow_udf("long")
    def names(found: pa.Array) -> pa.Array:
        return pa.array([node_of(np.frombuffer(f, np.uint64)) for f in found.to_pylist()], pa.int64())

    texts = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("t"), "text")
    texts = texts.join(wanted, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("h")))
    found = texts.select("node", "n", "cluster", sets("text").alias("found"))
    found = found.where(names("found") == F.col("node")).dropDuplicates(["node"])
    found = stored(found, "sets")
    load = F.greatest(F.col("n"), F.lit(SMALLEST))
    tiles = leaves(found.select("cluster", "node", "n"), "cluster", load, SHINGLES, percent).join(found.select("node", "found"), "node")
    links = tiles.groupBy("cluster", "leaf_a", "leaf_b").applyInPandas(lambda rows: follow(rows, percent), "u long, v long")
    labels = components(links, "links")
    least = some.groupBy("node").agg(best).join(labels, "node", "left")
    return signed_docs, stored(least.select("node", "best", F.coalesce("component", "node").alias("component")), "classes")


def join(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row, for shingles of so many words and so much likeness."""
    signed_docs, least = classes(docs, width, percent)
    ids = least.groupBy("component").agg(F.min("best.doc_id").alias("component_id"))
    named = least.join(ids, "component").select(F.col("node").alias("m"), "component_id")
    alone = signed_docs.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return (
        signed_docs.where("n > 0").join(named, F.col("node") == F.col("m"))
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        .unionByName(alone)
    )


def keep_one(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that of the least id and then of the least text hash, columns as they were.

    Components are those of the sets, whatever the ids: documents without an id, or with an id that other texts have
    too, stay or go by their own text. Blank texts stay. Of rows that repeat id and text one stays."""
    signed_docs, least = classes(docs, width, percent)
    ids, texts = fresh(docs, "join_id"), fresh(docs, "join_text")
    kept = least.groupBy("component").agg(F.min("best").alias("best")).select("best.doc_id", "best.h")
    kept = kept.unionByName(signed_docs.where("n = 0").select("doc_id", "h").distinct())
    kept = kept.select(F.col("doc_id").alias(ids), F.col("h").alias(texts))
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(F.col(ids)) & (F.xxhash64(docs["text"]) == F.col(texts)))
    return rows.dropDuplicates([ids, texts]).select(*docs.columns)
