"""Near-duplicate documents: a chosen-path set similarity join on word shingles.

Documents with equal sets count once. Each tree deals the sets out by one minwise token; a node that is still too large
is dealt out again by the tokens that its path chooses, once and now and then twice, so that a pair at the threshold
keeps about one common node per level while less similar sets part. Small nodes are compared exhaustively: sketches
leave out pairs that are far from the threshold, whatever is left is compared on its full sets. Independent trees are
repeated to the wanted recall; a pair at similarity s misses all of t trees of one level with (1 - s) ** t.

What paths hardly part (large groups that are all alike) is first drawn together: every member is compared with a few
members that look most like the whole group. From then on a node only needs the pairs of members outside its largest
component with all others; it is done when there are none or few of them, and is dealt out further until then. Nodes
left at the last level are compared in full, in blocks of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gridtide.llm import chunks as C, words as W
from gridtide.llm.graph import components
from gridtide.session import stored

SHINGLE, PERCENT = 5, 85
TREES, PATH, SKETCH = 8, 32, 128
NODE_LIMIT, LEVELS, MORE_LEVELS = 256, 2, 3
# Where members are compared with pivots or with other components only: rows of a block, as a multiple of the limit,
# and the pairs that a node may still have to be compared, as a multiple of the limit's square.
WIDE, FEW = 4, 64
PIVOTS, VOTES = 4, 16
# Shingles that a comparison sorts at a time, and that one task holds: sets that are longer together are compared a range of hashes at a time, each in a task of its own.
SLICE, BLOCK_SHINGLES = 1 << 19, 1 << 22
# Sketches of 128 values are off by 0.03 at the threshold, as a standard deviation; pairs within 0.14 are compared in full.
SLACK = 0.14


class Sets:
    """The distinct shingles of every row of one block, row by row."""

    def __init__(self, words: W.Words, hasher: W.Hasher, k: int):
        hashes, counts = hasher(words.data, words.starts, words.ends), np.diff(words.bounds)
        runs, whole = W.runs(hashes, words.bounds, k, 11)
        row, value = [words.row[: len(runs)][whole]], [runs[whole]]
        for n in range(1, k):  # texts with fewer than k words: the whole sequence
            short = np.flatnonzero(counts == n)
            total = np.zeros(len(short), np.uint64)
            for j, c in enumerate(W.constants(n, 100 + n)):
                total += hashes[words.bounds[short] + j] * c
            row.append(short)
            value.append(W.mix(total))
        row, value = np.concatenate(row), np.concatenate(value)
        order = np.lexsort((value, row))
        row, value = row[order], value[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        self.row, self.value = row[new], value[new]
        self.bounds = np.searchsorted(self.row, np.arange(words.rows + 1))

    def sketches(self, n: int) -> np.ndarray:
        """The least value of each of n hash functions, for the rows that have shingles."""
        at = self.bounds[:-1][np.diff(self.bounds) > 0]
        out = np.empty((len(at), n), np.uint64)
        for i, (c, r) in enumerate(zip(W.constants(n, 21), W.constants(n, 22))):
            out[:, i] = np.minimum.reduceat((self.value ^ r) * c, at)
        return out

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit sums over each set, for the rows that have shingles."""
        at = self.bounds[:-1][np.diff(self.bounds) > 0]
        return tuple(np.add.reduceat(W.mix(self.value * c), at).view(np.int64) for c in W.constants(2, 23))


def _sketch(docs: DataFrame, id: str, text: str, k: int) -> DataFrame:
    def run(batches):
        hasher = W.Hasher()
        for batch in batches:
            for words in W.blocks(batch.column(1), lower=True):
                ids = batch.column(0).slice(words.first, words.rows)
                sets = Sets(words, hasher, k)
                sizes = np.diff(sets.bounds)
                has = sizes > 0
                if not has.any():
                    yield pa.RecordBatch.from_pydict({"doc": ids, "size": pa.array(sizes), "d1": pa.nulls(len(ids), pa.int64()), "d2": pa.nulls(len(ids), pa.int64()), "path": pa.nulls(len(ids), pa.list_(pa.int64())), "sketch": pa.nulls(len(ids), pa.binary())})
                    continue
                values, (d1, d2) = sets.sketches(SKETCH), sets.digests()
                spread = np.full(len(has), -1)
                spread[has] = np.arange(has.sum())
                take = pa.array(spread, pa.int64(), mask=~has)
                low = (values & np.uint64(0xFFFF)).astype(np.uint16)
                yield pa.RecordBatch.from_pydict({
                    "doc": ids, "size": pa.array(sizes), "d1": pa.array(d1).take(take), "d2": pa.array(d2).take(take),
                    "path": pa.array(list(values[:, :PATH].view(np.int64)), pa.list_(pa.int64())).take(take), "sketch": pa.array([x.tobytes() for x in low], pa.binary()).take(take),
                })

    return docs.select(F.col(id).cast("long"), text).mapInArrow(run, "doc long, size long, d1 long, d2 long, path array<long>, sketch binary")


def _branch(rows: DataFrame, reps: DataFrame, trees: int, level: int) -> DataFrame:
    """Deal `node, doc` out by one path function for each node, and a second one for the share the threshold asks for.

    The last few path values come along as `votes`.
    """
    at = lambda salt: F.lit(trees + 1) + F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(PATH - trees)).cast("int")
    twice = F.pmod(F.xxhash64("node", F.lit(level + 500)), F.lit(PERCENT)) < 100 - PERCENT
    picks = F.when(twice, F.array(at(level), at(level + 100))).otherwise(F.array(at(level)))
    rows = rows.withColumn("pick", F.explode(F.array_distinct(picks))).join(reps.select("doc", "path"), "doc")
    return rows.select(F.xxhash64("node", "pick", F.element_at("path", F.col("pick"))).alias("node"), "doc", F.slice("path", PATH - VOTES + 1, VOTES).alias("votes"))


def _nodes(reps: DataFrame, trees: int, limit: int, levels: int) -> tuple[DataFrame, DataFrame | None]:
    """`node, doc` of all nodes with 2 to `limit` members, and `node, doc, votes` of those still larger at the last level."""
    rows = reps.select("doc", F.posexplode(F.slice("path", 1, trees)).alias("tree", "value")).select(F.xxhash64("tree", "value").alias("node"), "doc")
    if levels == 1:
        rows = rows.join(reps.select("doc", F.slice("path", PATH - VOTES + 1, VOTES).alias("votes")), "doc")
    done = []
    for level in range(1, levels + 1):
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        rows = stored(rows.join(sizes, "node"), "nodes")
        done.append(rows.filter(F.col("n") <= limit).select("node", "doc"))
        rows = rows.filter(F.col("n") > limit).drop("n")
        if rows.isEmpty():
            return _union(done), None
        if level < levels:
            rows = _branch(rows, reps, trees, level)
    return _union(done), rows


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _members(rows: DataFrame) -> DataFrame:
    """`node, doc` with one node for each distinct set of members."""
    sets = rows.groupBy("node").agg(F.sort_array(F.collect_set("doc")).alias("members")).filter("size(members) > 1")
    sets = sets.dropDuplicates(["members"])
    return sets.select("node", F.explode("members").alias("doc"))


def _groups(linked: np.ndarray) -> np.ndarray:
    """The first member of each member's component, given the matrix of links."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label[None, :], len(label)).min(axis=1)
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _common(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The members of a block in order, the sizes of their sets, and how much every two have in common."""
    docs = table["doc"].to_numpy()
    place = np.argsort(np.argsort(docs, kind="stable"), kind="stable")
    sizes, parts, lo = np.zeros(len(docs), np.int64), [], 0
    for part in table["shingles"].chunks:
        n = pa.compute.list_value_length(part).to_numpy().astype(np.int64)
        sizes[place[lo : lo + len(n)]] = n
        parts.append((part.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.repeat(place[lo : lo + len(n)].astype(np.int32), n)))
        lo += len(n)
    common = np.zeros((len(docs), len(docs)), np.float32)
    width = max(1, (4 << 20) // (4 * len(docs)))
    # A range of hashes at a time, so that long texts cost no more memory than their sets.
    slices = int(sizes.sum()) // SLICE + 1
    for k in range(slices):
        value, row = (np.concatenate(x) for x in zip(*[(v[i], r[i]) for v, r in parts for i in [np.flatnonzero(C.range_of(v, slices) == k)]]))
        by = np.argsort(value)
        value, row = value[by], row[by]
        column = np.cumsum(np.r_[False, value[1:] != value[:-1]]) if len(value) else value.astype(np.int64)
        for left in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [left, left + width])
            present = np.zeros((len(docs), width), np.float32)
            present[row[a:b], column[a:b] - left] = 1
            common += present @ present.T
    return np.sort(docs), sizes, common


def _exact(blocks: DataFrame, sets: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Links `a, b` of each block's members, compared on full sets.

    A block whose sets are no longer together than a task may hold gives each member with the smallest it is connected to. Longer ones are
    compared a range of hashes at a time, every range a group of its own; what pairs have in common is added up, and all linked pairs are given.
    """

    def run(key, table):
        docs, sizes, common = _common(table)
        if key[2].as_py() > 1:
            i, j = np.nonzero(np.triu(common, 1))
            n = common[i, j].astype(np.int64)
        else:
            label = _groups(100 * common >= percent * (sizes[:, None] + sizes[None, :] - common))
            i = np.flatnonzero(label != np.arange(len(docs)))
            j, n = label[i], None
        return pa.table({"block": pa.array([key[0].as_py()] * len(i), pa.int64()), "a": pa.array(docs[i], pa.int64()), "b": pa.array(docs[j], pa.int64()), "common": pa.nulls(len(i), pa.int64()) if n is None else pa.array(n)})

    total = F.sum(F.size("shingles")).over(Window.partitionBy("block"))
    members = blocks.join(sets, "doc").select("block", "doc", "shingles", F.ceil(total / BLOCK_SHINGLES).cast("long").alias("slices"))
    at = lambda v: F.shiftright(F.shiftrightunsigned(v, 32) * F.col("slices"), 32)
    part = lambda k: F.struct(k.alias("slice"), F.filter("shingles", lambda v: at(v) == k).alias("shingles"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("slice"), F.col("shingles")))
    parts = F.when(F.col("slices") > 1, F.transform(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1), part)).otherwise(whole)
    found = stored(members.select("block", "doc", "slices", F.inline(parts)).groupBy("block", "slice", "slices").applyInArrow(run, "block long, a long, b long, common long"), "compared")
    links = found.filter("common IS NULL").select("a", "b")
    pairs = found.filter("common IS NOT NULL").groupBy("block", "a", "b").agg(F.sum("common").alias("common"))
    size = lambda c, n: reps.select(F.col("doc").alias(c), F.col("size").alias(n))
    pairs = pairs.join(size("a", "m"), "a").join(size("b", "n"), "b")
    return links.unionByName(pairs.filter(100 * F.col("common") >= percent * (F.col("m") + F.col("n") - F.col("common"))).select(F.col("b").alias("a"), F.col("a").alias("b")))


def _shingles(docs: DataFrame, wanted: DataFrame, id: str, text: str, k: int) -> DataFrame:
    """`doc, shingles` of the wanted documents."""

    def run(batches):
        hasher = W.Hasher()
        for batch in batches:
            for words in W.blocks(batch.column(1), lower=True):
                sets = Sets(words, hasher, k)
                ids = batch.column(0).slice(words.first, words.rows)
                lists = pa.ListArray.from_arrays(pa.array(sets.bounds.astype(np.int32)), pa.array(sets.value.view(np.int64)))
                yield pa.RecordBatch.from_pydict({"doc": ids, "shingles": lists})

    # Sort-merge at every size, so that what is shuffled follows the input.
    texts = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).alias("__text")).join(wanted.select("doc").hint("merge"), "doc", "left_semi")
    return texts.select("doc", "__text").mapInArrow(run, "doc long, shingles array<long>")


def _stars(big: DataFrame, limit: int) -> DataFrame:
    """`block, doc`: the members of each node in parts, each part with the node's pivots.

    The pivots are those whose sketch has the most values that are the commonest of the node at their place.
    """
    votes = big.select("node", F.posexplode("votes").alias("place", "value")).groupBy("node", "place", "value").agg(F.count(F.lit(1)).alias("n"))
    common = votes.groupBy("node", "place").agg(F.max(F.struct("n", "value")).alias("top"), F.sum("n").alias("size"))
    common = common.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("place", "top.value"))).alias("common"), F.ceil(F.max("size") / F.lit(limit * WIDE // 2)).cast("long").alias("parts"))
    same = F.filter(F.zip_with("votes", F.transform("common", lambda x: x["value"]), lambda x, y: x == y), lambda x: x)
    scored = big.join(common, "node").select("node", "doc", "parts", F.size(same).alias("alike"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("alike"), "doc"))).filter(F.col("rank") <= PIVOTS)
    own = scored.select(F.xxhash64("node", F.pmod(F.xxhash64("doc"), F.col("parts"))).alias("block"), "doc")
    pivots = ranked.select("node", "doc", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    return own.unionByName(pivots.select(F.xxhash64("node", "part").alias("block"), "doc")).distinct()


def _mixed(rows: DataFrame, label: DataFrame) -> DataFrame:
    """`node, doc, component, n, out, top`: rows of the nodes that have `out` > 0 members outside their largest component `top`."""
    known = rows.join(label.withColumnRenamed("node", "doc"), "doc", "left").select("node", "doc", F.coalesce("component", "doc").alias("component"))
    counts = known.groupBy("node", "component").agg(F.count(F.lit(1)).alias("n"))
    nodes = counts.groupBy("node").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("largest"))
    nodes = nodes.select("node", "n", (F.col("n") - F.col("largest.n")).alias("out"), F.col("largest.component").alias("top")).filter("out > 0")
    return known.join(nodes, "node")


def _crossed(mixed: DataFrame, limit: int) -> DataFrame:
    """`block, doc, component, sketch`: members outside a node's largest component with all its members, part by part."""
    parts = lambda c: F.ceil(F.col(c) / F.lit(limit * WIDE // 2)).cast("long")
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    mixed = mixed.withColumn("all_parts", parts("n")).withColumn("out_parts", parts("out"))
    every = mixed.select("node", "doc", "component", "sketch", F.pmod(F.xxhash64("doc"), F.col("all_parts")).alias("i"), upto("out_parts").alias("j"))
    outer = mixed.filter("component != top").select("node", "doc", "component", "sketch", F.pmod(F.xxhash64("doc", F.lit(1)), F.col("out_parts")).alias("j"), upto("all_parts").alias("i"))
    return every.unionByName(outer).select(F.xxhash64("node", "i", "j").alias("block"), "doc", "component", "sketch").distinct()


def _close(parts: DataFrame, least: float) -> DataFrame:
    """`block, doc`: what is left of each block once members go that look like nothing in another component.

    `parts` has `block, doc, sketch`, and `component` where some links are known already.
    """
    known = "component" in parts.columns

    def run(table: pa.Table) -> pa.Table:
        docs = table["doc"].to_numpy()
        values = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint16).reshape(len(docs), SKETCH)
        alike = np.stack([(values == v).sum(axis=1) for v in values]) >= least * SKETCH
        if known:
            component = table["component"].to_numpy()
            near = (alike & (component[:, None] != component[None, :])).any(axis=1)
        else:
            near = alike.sum(axis=1) > 1
        return pa.table({"block": table["block"].filter(pa.array(near)), "doc": pa.array(docs[near])})

    left = parts.groupBy("block").applyInArrow(run, "block long, doc long")
    sets = left.groupBy("block").agg(F.sort_array(F.collect_list("doc")).alias("members")).dropDuplicates(["members"])
    return sets.select("block", F.explode("members").alias("doc"))


def _alike(big: DataFrame, reps: DataFrame, sets: DataFrame, links: DataFrame, percent: int, trees: int, limit: int, levels: int, more: int, least: float) -> DataFrame:
    """The links that the nodes still too large after `levels` levels hold."""
    links = links.unionByName(stored(_exact(_stars(big, limit), sets, reps, percent), "links"))
    label = components(links)
    done, rows = [], big.select("node", "doc")
    for level in range(levels, levels + more + 1):
        mixed = stored(_mixed(rows, label), "mixed")
        few = F.col("out") * F.col("n") <= FEW * limit * limit
        done.append(mixed.filter(few) if level < levels + more else mixed)
        rows = mixed.filter(~few).select("node", "doc")
        if level == levels + more or rows.isEmpty():
            break
        rows = _branch(rows, reps, trees, level).drop("votes")
    sketched = _union(done).join(reps.select("doc", "sketch"), "doc")
    blocks = stored(_close(_crossed(sketched, limit), least), "blocks")
    return links.unionByName(stored(_exact(blocks, sets, reps, percent), "links"))


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, trees: int = TREES, limit: int = NODE_LIMIT, levels: int = LEVELS,
    more_levels: int = MORE_LEVELS,
) -> DataFrame:
    """All columns of `docs`, then `n_shingles`, `component_id` and `kept`; columns of those names are replaced.

    Sets of `shingle`-word runs (A-Z lower-cased; a shorter text is one run), linked where 100 times the intersection is
    at least `percent` times the union. Ids are whole numbers. `component_id` is the smallest id reachable, `kept` says that it is the row's own.
    Texts without words (also null) have empty sets and link with nothing. Rows with equal ids get one
    verdict, that of the smallest component of any of them. A null id links with nothing: its component is null and the row is kept. Empty tables give none.
    """
    docs = docs.drop("n_shingles", "component_id", "kept")
    every = stored(_sketch(docs, id, text, shingle), "sketches")
    keys = ["d1", "d2", "size"]
    classes = every.filter("d1 IS NOT NULL AND doc IS NOT NULL").groupBy(*keys).agg(F.min(F.struct("doc", "path", "sketch")).alias("r"))
    reps = stored(classes.select("r.doc", "r.path", "r.sketch", *keys), "sets")
    nodes, big = _nodes(reps, trees, limit, levels)
    least = percent / 100 - SLACK
    sketched = _members(nodes).withColumnRenamed("node", "block").join(reps.select("doc", "sketch"), "doc")
    blocks = stored(_close(sketched, least), "blocks")
    if big is not None:
        big = stored(big, "nodes")
    wanted = blocks.select("doc") if big is None else blocks.select("doc").unionAll(big.select("doc"))
    sets = stored(_shingles(docs, wanted, id, text, shingle), "shingles")
    links = stored(_exact(blocks, sets, reps, percent), "links")
    if big is not None:
        links = _alike(big, reps, sets, links, percent, trees, limit, levels, more_levels, least)
    label = components(links).withColumnRenamed("node", "rep")
    of_class = reps.select(*keys, F.col("doc").alias("rep")).join(label, "rep", "left").select(*keys, F.coalesce("component", "rep").alias("component"))
    found = every.select("doc", *keys).join(of_class, keys, "left").filter("doc IS NOT NULL")
    found = found.groupBy("doc").agg(F.max("size").alias("n_shingles"), F.min("component").alias("component_id"))
    own = F.col(id).cast("long")
    out = docs.join(found.withColumnRenamed("doc", "__doc"), own == F.col("__doc"), "left").drop("__doc")
    out = out.withColumns({"n_shingles": F.coalesce("n_shingles", F.lit(0).cast("long")), "component_id": F.coalesce("component_id", own)})
    return out.withColumn("kept", F.coalesce(F.col("component_id") == own, F.lit(True)))
