"""Near-duplicate texts by a chosen-path set similarity join.

A document is the set of its word shingles. Each of several trees branches on minwise tokens: a node picks one or two of
the 128 minwise hashes by its own seed, 1 / threshold on average, and a document goes to one child for each pick, named by
the token that is its minimum there. So pairs below the threshold get fewer with depth, while those above don't. Small
nodes are compared exhaustively, large ones branch on for as long as they are large.

The longer a path, the more trees a pair needs: trees are first planned for few levels, and documents that were in deeper
nodes get as many further trees as the level they were at asks for, one level after the other.

What keeps the work in proportion to the table:

* Documents with equal sets are one class, whose smallest id takes part.
* A large root node is also compared in blocks that share its smallest id. That joins groups of near copies of any size,
  and a node whose documents are all of one known component has nothing left to find and ends.
* A node ends once all but its largest known component are at most a block, or up to four if the component is larger than
  they are: these are compared with each other and with that component's blocks, so every document of the node is compared
  with four blocks at most.
* Blocks are compared by minwise agreement first, with a margin of 4.5 standard deviations, and only documents that
  have a possible partner there are compared on their full sets. A block returns a spanning forest of its links.

The minima come from one permutation: a set's sorted hashes fall into 128 ranges, and the smallest of each is its minimum;
an empty range takes that of another one, the first that isn't empty in an order of its own.

Defined results. A null or blank text has no shingles and is linked with nothing, nor is a row without id: it has a null
component and is kept. Rows that share an id are one document; each row finds its exact copies, and the greatest text
stands for the id in comparisons. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import batch_settings, components, lean, partitions, place_of, settings
from matchloom.storage import materialize

Batches = Iterator[pa.RecordBatch]
COORDINATES = 128
# Levels a round of the recursion goes down before nodes are measured again.
STEPS = 3
# Blocks of documents outside a node's largest known component that are compared with it at once, if it is larger than they are.
WIDE = 4
# Trees whose large root nodes are compared before any component is known.
JOINING = 2
# Tries of an empty range to find one that isn't.
TRIES = 1024
# Joins of texts with the few ids that are needed get a Bloom filter of bounded size before the shuffle.
EARLY_FILTER = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "100m",
}


def recall_at(trees: int, similarity: float, depth: int) -> float:
    """Probability that a pair of this similarity is found ``depth`` levels down in one of the trees.

    All trees draw from the same minima, so the chances are summed over the number of minima in which the pair agrees;
    given those, trees are independent. The root has one pick, a coordinate of its own for each tree. A node below has
    1 / similarity of them on average: one, and with probability ``more`` a second. With fewer a pair at the threshold would
    be lost with depth, with more those below it would multiply. Pairs beneath the minwise margin count as lost.
    """
    total, more = 0.0, 1 / similarity - 1
    for agree in range(least_agreement(similarity), COORDINATES + 1):
        found = 1.0
        for _ in range(depth - 1):
            hit = agree / COORDINATES * found
            found = 1 - (1 - more) * (1 - hit) - more * (1 - hit) ** 2
        roots = range(max(0, trees - (COORDINATES - agree)), min(agree, trees) + 1)
        missed = sum(math.comb(trees, k) * math.comb(COORDINATES - trees, agree - k) * (1 - found) ** k for k in roots) / math.comb(COORDINATES, agree)
        total += math.comb(COORDINATES, agree) * similarity**agree * (1 - similarity) ** (COORDINATES - agree) * (1 - missed)
    return total


def least_agreement(similarity: float) -> int:
    """Minima in which a pair at the threshold agrees at least, with a margin of 4.5 standard deviations."""
    return max(1, math.floor(COORDINATES * (similarity - 4.5 * math.sqrt(similarity * (1 - similarity) / COORDINATES))))


def trees_for(recall: float, similarity: float, depth: int = 3) -> int:
    """Trees until a pair at the threshold is found ``depth`` levels down with probability ``recall``; the most if none are enough."""
    return next((n for n in range(1, COORDINATES) if recall_at(n, similarity, depth) >= recall), COORDINATES)


def deepest(recall: float, similarity: float, depth: int) -> int:
    """The deepest level up to ``depth`` at which trees can reach ``recall``, which falls with the level."""
    level = 1
    while level < depth and recall_at(COORDINATES, similarity, level + 1) >= recall:
        level += 1
    return level


def next_level(level: int) -> int:
    """The first level below this one at which nodes are measured."""
    return 1 + STEPS * ((level - 1) // STEPS + 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    import xxhash

    spaced = pc.replace_substring_regex(pc.fill_null(texts, ""), r"[\t-\r]", " ")
    split = pc.split_pattern(pc.ascii_lower(spaced), " ")
    flat = pc.dictionary_encode(split.flatten())
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in flat.dictionary.to_pylist()] or [0], np.uint64)
    codes = flat.indices.to_numpy(zero_copy_only=False)
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    real = np.array([w != "" for w in flat.dictionary.to_pylist()] or [False])[codes] if len(codes) else np.zeros(0, bool)
    text_of = np.repeat(np.arange(len(counts)), counts)[real]
    values = hashes[codes[real]] if len(codes) else np.zeros(0, np.uint64)
    counts = np.bincount(text_of, minlength=len(counts))
    ends = np.cumsum(counts)
    # Unrelated odd weights: sums with related ones would be equal for some orders of the same words.
    weights = _mix(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    rolled = np.zeros(max(0, len(values) - words + 1), np.uint64)
    for k, weight in enumerate(weights):
        rolled += values[k : k + len(rolled)] * weight
    rolled = _mix(rolled)
    out = []
    for end, count in zip(ends.tolist(), counts.tolist()):
        if count >= words:
            out.append(np.unique(rolled[end - count : end - words + 1]))
        elif count:
            short = sum((int(v) * int(w) for v, w in zip(values[end - count : end], weights)), count)
            out.append(_mix(np.array([short & 0xFFFFFFFFFFFFFFFF], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _donors() -> np.ndarray:
    """For each range the ranges it tries when it is empty."""
    return (_mix(np.arange(COORDINATES * TRIES, dtype=np.uint64) + np.uint64(1)) & np.uint64(COORDINATES - 1)).astype(np.int64).reshape(COORDINATES, TRIES)


def minima(sets: list[np.ndarray], donors: np.ndarray) -> np.ndarray:
    """A row of minwise tokens for each sorted set; zeros for an empty one."""
    counts = np.array([len(s) for s in sets], np.int64)
    low, filled = np.zeros((len(sets), COORDINATES), np.uint32), np.zeros((len(sets), COORDINATES), bool)
    if not counts.sum():
        return low
    flat = np.concatenate(sets)
    place = np.repeat(np.arange(len(sets)) * COORDINATES, counts) + (flat >> np.uint64(64 - COORDINATES.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))  # sets are sorted, so the first of a range is its minimum
    low.flat[place[first]] = (flat[first] >> np.uint64(16)).astype(np.uint32)
    filled.flat[place[first]] = True
    row, at = np.nonzero(~filled & (counts > 0)[:, None])
    for attempt in range(TRIES):
        if not len(row):
            break
        donor = donors[at, attempt]
        found = filled[row, donor]
        low[row[found], at[found]] = low[row[found], donor[found]]
        row, at = row[~found], at[~found]
    low[row, at] = low[row, filled[row].argmax(axis=1)]
    return low


def _sign(words: int, also: list[str]) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        donors = _donors()
        for batch in batches:
            sets = shingle_sets(batch.column("text"), words)
            low = minima(sets, donors)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            checks = [c.tobytes() for c in low.astype(np.uint8)]
            offsets = np.arange(len(sets) + 1, dtype=np.int32) * COORDINATES
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(low.view(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), lists, pa.array(checks, pa.binary()), *(batch.column(c) for c in also)],
                ["doc_id", "n_shingles", "set_key", "low", "check", *also],
            )

    return run


def _groups(batches: Batches, value: Callable[[pa.RecordBatch], list]) -> Iterator[tuple[int, list[int], list]]:
    """(group, ids, values) of rows that come sorted by group."""
    here, ids, held = None, [], []
    for batch in batches:
        values = value(batch)
        for group, id_, one in zip(batch.column("g").to_pylist(), batch.column("id").to_pylist(), values):
            if group != here:
                if ids:
                    yield here, ids, held
                here, ids, held = group, [], []
            ids.append(id_)
            held.append(one)
    if ids:
        yield here, ids, held


def _parts(linked: np.ndarray) -> np.ndarray:
    """The smallest row each row of a symmetric matrix is connected with."""
    part = np.arange(len(linked))
    while True:
        lower = np.minimum(part, np.where(linked, part[None, :], len(part)).min(axis=1))
        lower = lower[lower]
        if (lower == part).all():
            return part
        part = lower


def _possible(least: int) -> Callable[[Batches], Batches]:
    """Of each group the documents whose minima agree in at least ``least`` places with those of one of another label.

    Documents that are connected that way are a group of their own, named by its members. The last byte of each minimum
    is enough: different ones agree in one of 256.
    """

    def run(batches: Batches) -> Batches:
        out: list[tuple[int, int]] = []
        value = lambda batch: list(zip(batch.column("check").to_pylist(), batch.column("label").to_pylist()))
        for _, ids, held in _groups(batches, value):
            order = np.argsort(ids, kind="stable")
            sorted_ids, label = np.array(ids)[order], np.array([h[1] for h in held])[order]
            check = np.frombuffer(b"".join(h[0] for h in held), np.uint8).reshape(-1, COORDINATES)[order]
            agree = np.zeros((len(check), len(check)), np.uint8)
            for c in check.T:
                agree += c[:, None] == c[None]
            part = _parts((agree >= least) & (label[:, None] != label[None]))
            for first in np.flatnonzero(np.bincount(part, minlength=len(part)) > 1):
                members = sorted_ids[part == first]
                name = int.from_bytes(hashlib.blake2b(members.astype("<i8").tobytes(), digest_size=8).digest(), "little", signed=True)
                out += [(name, int(i)) for i in members]
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], ["g", "id"])
                out = []
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], ["g", "id"])

    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs, from the incidence of the shingles that more than one set has."""
    values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    keep = counts[place] > 1
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[keep]
    column = shared[place[keep]]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for at in range(0, int(shared[-1]) + 1 if len(values) else 0, 20_000):
        mine = (column >= at) & (column < at + 20_000)
        block = np.zeros((len(sets), min(20_000, int(shared[-1]) + 1 - at)), np.float32)
        block[owner[mine], column[mine] - at] = 1
        out += (block @ block.T).astype(np.int64)
    out[np.arange(len(sets)), np.arange(len(sets))] = [len(s) for s in sets]
    return out


def _compare(words: int, percent: int) -> Callable[[Batches], Batches]:
    """(u, v) that join what each group's full sets link."""

    def run(batches: Batches) -> Batches:
        out: list[tuple[int, int]] = []

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], ["u", "v"])

        for _, ids, sets in _groups(batches, lambda batch: shingle_sets(batch.column("text"), words)):
            order = np.argsort(ids, kind="stable")
            sets = [sets[i] for i in order]
            sizes = np.array([len(s) for s in sets])
            both = intersections(sets)
            linked = (100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)) & (both > 0)
            part = _parts(linked)
            out += [(int(ids[order[i]]), int(ids[order[p]])) for i, p in enumerate(part) if ids[order[i]] != ids[order[p]]]
            if len(out) >= 10_000:
                yield batch_of()
                out = []
        yield batch_of()

    return run


def _blocks(rows: DataFrame, node: list[str], size: Column, most: int) -> DataFrame:
    """``rows`` with the block of about ``most`` rows of its node that each is in."""
    count = F.ceil(size / F.lit(most)).cast("long")
    return rows.withColumn("block", F.pmod(F.xxhash64("id", *node), count))


def near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 5, percent: int = 75, recall: float = 0.9999, small: int = 300, depth: int = 3) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; and __at, its place, if ``docs`` came from ``located``.

    ``small``: documents of a node that is compared exhaustively. ``depth``: levels the first trees are planned for. Nodes
    branch on below it while they are large; what is left at a level at which no number of trees could reach ``recall`` is
    compared block by block, so that none is given up.
    """
    spark = docs.sparkSession
    batch_settings(spark)
    place = place_of(docs)
    also = ["__at"] * bool(place)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), *[F.col(place).alias(c) for c in also])
    source = rows.drop(*also)
    schema = "doc_id long, n_shingles long, set_key binary, low array<int>, check binary" + ", __at struct<file: string, row: long>" * len(also)
    signed = materialize(rows.mapInArrow(lean(_sign(words, also)), schema), "signed")
    classes = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("id"), F.any_value(F.struct("low", "check")).alias("s"))
    classes = materialize(classes.select("set_key", "id", "s.low", "s.check"), "classes")
    # Ids of several texts are few; they are found in narrow rows, so that signatures aren't shuffled again.
    shared = materialize(classes.groupBy("id").agg(F.min("set_key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("id").alias("shared"), "first"), "shared")
    lows = classes.join(shared, F.col("id") == F.col("shared"), "left").where("shared IS NULL OR set_key = first").select("id", "low", "check")

    join = _Join(source, lows, words, percent, small)
    last = deepest(recall, percent / 100, 1000)
    ids, start, plan = lows.select("id", "low"), 0, min(depth, last)
    trees, most = trees_for(recall, percent / 100, plan), 1
    links, deep, known = [], [], None
    while True:
        roots = [F.xxhash64(F.lit(t), F.col("low")[t]) for t in range(start, trees)]
        frontier = ids.select("id", F.posexplode(F.array(*roots)).alias("tree", "node"))
        if known is None:
            links.append(join.roots(frontier, F.col("tree") < JOINING))
            known, frontier = components(links[0]), join.large
        found, reached, below = join.grow(frontier.select("node", "id"), known, plan, last)
        links.append(found)
        deep.append(below)
        # One level more at a time: a document needs the trees for the level it was at, not for the deepest of all.
        start, most, above = trees, max(most, reached), plan
        while trees <= start and plan < most:
            above, plan = plan, min(next_level(plan), last)
            trees = trees_for(recall, percent / 100, plan)
        if trees <= start:
            break
        known = components(reduce(DataFrame.union, links))
        ids = join.only(reduce(DataFrame.union, deep).where(F.col("level") > above), "low")
    found = components(reduce(DataFrame.union, links))

    named = classes.select("set_key", "id").join(found, "id", "left").select("set_key", F.coalesce("component_id", "id").alias("component_id"))
    empty = signed.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), *also)
    rows = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").join(named, "set_key").select("doc_id", "n_shingles", "component_id", *also)
    return rows.union(empty).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


class _Join:
    """The steps of the tree; groups are rows (g, id) of documents to compare with each other."""

    def __init__(self, source: DataFrame, lows: DataFrame, words: int, percent: int, small: int) -> None:
        self.source, self.lows, self.words, self.percent, self.small = source, lows, words, percent, small
        self.least = least_agreement(percent / 100)
        self.parts = partitions(source.sparkSession)

    def roots(self, frontier: DataFrame, joining: Column | None = None) -> DataFrame:
        """Links found in the root nodes; ``large`` keeps the rows of those to branch on.

        Of the large ones only the rows for which ``joining`` holds are compared here: the others find most of their links known
        from these, and all of them branch on.
        """
        nodes = frontier.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("n > 1")
        nodes = materialize(nodes, "nodes")
        rows = _blocks(frontier.join(nodes, "node").where((F.col("n") <= self.small) | (F.lit(True) if joining is None else joining)), ["node"], F.col("n"), self.small)
        self.large = frontier.join(nodes.where(F.col("n") > self.small).select("node"), "node").select("node", "id")
        members = rows.groupBy("node", "block").agg(F.collect_set("id").alias("ids"), F.min("first").alias("first"))
        return self.links(self._distinct(members.select(F.array_union("ids", F.array("first")).alias("ids"))))

    def _distinct(self, members: DataFrame) -> DataFrame:
        """Each set of members once."""
        groups = members.where("size(ids) > 1").select(F.sort_array("ids").alias("ids"))
        groups = groups.select(F.xxhash64("ids").alias("g"), "ids").groupBy("g", "ids").agg(F.lit(1).alias("one"))
        return groups.select("g", F.explode("ids").alias("id"))

    def only(self, ids: DataFrame, column: str) -> DataFrame:
        """id and that part of the signature of some documents; Spark filters the others out before a shuffle."""
        wanted = ids.where(F.col("id").between(-(1 << 63), (1 << 63) - 1)).select("id").distinct()
        with settings(self.source.sparkSession, EARLY_FILTER):
            return materialize(self.lows.select("id", column).join(wanted, "id", "left_semi"), "signatures")

    def grow(self, frontier: DataFrame, known: DataFrame, depth: int, last: int) -> tuple[DataFrame, int, DataFrame]:
        """Trees from their large nodes down: the links found, the level reached, and (id, level) of what was below ``depth``."""
        level, groups, deep, low = 1, [], [], None
        while True:
            frontier, ready, more = self.branch(frontier, known, level, last, low)
            groups.append(ready)
            if not more:
                break
            low = self.only(frontier, "low") if low is None else low
            level = min(level + STEPS, last)
            if level > depth:
                deep.append(frontier.select("id", F.lit(level).alias("level")))
        links = self.links(reduce(DataFrame.union, groups), known)
        return links, level, reduce(DataFrame.union, deep or [frontier.select("id", F.lit(level).alias("level"))]).distinct()

    def children(self, frontier: DataFrame, levels: range) -> DataFrame:
        """Rows of ``frontier`` in the nodes that many levels below its ``node``, or all its ``nodes``; those in between don't become rows."""
        low = F.col("low")

        def picked(node: Column, level: int) -> Column:
            first, second, chance = (F.pmod(F.xxhash64(node, F.lit(level), F.lit(i)), F.lit(n)).cast("int") for i, n in enumerate((COORDINATES, COORDINATES, 1000)))
            below = [F.xxhash64(node, pick, low[pick]) for pick in (first, second)]
            return F.when(chance < 1000 * (100 / self.percent - 1), F.array_distinct(F.array(*below))).otherwise(F.array(below[0]))

        down = lambda nodes, level: F.flatten(F.transform(nodes, lambda node: picked(node, level)))
        nodes = reduce(down, levels, F.col("nodes") if "nodes" in frontier.columns else F.array("node"))
        return frontier.select(*[c for c in frontier.columns if c not in ("low", "node", "nodes")], F.explode(nodes).alias("node"))

    def branch(self, frontier: DataFrame, known: DataFrame, level: int, last: int, low: DataFrame | None = None) -> tuple[DataFrame, DataFrame, bool]:
        """Of nodes that have more to find: those to branch on, groups of those to compare, and if any branch on.

        Below the roots rows first go down to this level. At the last one all are compared: every pair but those inside
        the largest component known.
        """
        # A document meets its label and its signature once, with all its nodes.
        rows = frontier.groupBy("id").agg(F.collect_list("node").alias("nodes")).join(known, "id", "left")
        rows = rows.select("id", "nodes", F.coalesce("component_id", "id").alias("label"))
        labelled = self.children(rows.join(low, "id") if level > 1 else rows, range(max(2, level - STEPS + 1), level + 1))
        labelled = materialize(labelled.select("node", "id", "label"), "children")
        sizes = labelled.groupBy("node", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("node")
        sizes = sizes.agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("label", "n").alias("main"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
        others = F.col("n") - F.col("most")
        few = others <= F.greatest(F.lit(self.small), F.least(F.lit(WIDE * self.small), F.col("most")))
        sizes = materialize(sizes.withColumn("ready", F.lit(True) if level >= last else few), "sizes")
        # Each row meets its node's size once: what branches on and what is compared are parts of the same written table.
        rows = materialize(labelled.join(sizes.drop("labels"), "node"), "measured")
        deeper, more = rows.where("NOT ready").select("node", "id"), not sizes.where("NOT ready").isEmpty()
        # A node of one block is one group; else the others, block by block, against the largest component's blocks and each other.
        whole = F.col("n") <= self.small
        stray = ~whole & (F.col("label") != F.col("main"))
        size = F.when(stray, others).when(whole, 1).otherwise(F.col("most"))
        blocks = _blocks(rows.where("ready").withColumn("stray", stray), ["node"], size, self.small).groupBy("node", "stray", "block")
        blocks = materialize(blocks.agg(F.collect_set("id").alias("ids"), F.first(whole).alias("whole")), "blocks")
        strays = blocks.where("stray").select("node", F.col("block").alias("other"), F.col("ids").alias("others"))
        # Blocks of strays also meet those with higher numbers.
        pairs = blocks.where("NOT whole").join(strays, "node").where("NOT stray OR block < other")
        members = blocks.where("whole").select("ids").union(pairs.select(F.array_union("ids", "others").alias("ids")))
        return deeper, self._distinct(members), more

    def links(self, groups: DataFrame, known: DataFrame | None = None) -> DataFrame:
        """Links inside groups between documents that aren't of one known component, confirmed on full sets."""
        groups = materialize(groups, "groups")
        # A document meets its signature and its label once, with all its groups.
        rows = groups.where(F.col("id").between(-(1 << 63), (1 << 63) - 1)).groupBy("id").agg(F.collect_list("g").alias("gs")).join(self.lows.select("id", "check"), "id")
        label = F.col("id") if known is None else F.coalesce("component_id", "id")
        rows = (rows if known is None else rows.join(known, "id", "left")).select("id", "check", label.alias("label"), F.explode("gs").alias("g"))
        rows = rows.repartition(self.parts, "g").sortWithinPartitions("g", "id")
        # Few documents have a possible partner: Spark filters the others out before a shuffle.
        with settings(self.source.sparkSession, EARLY_FILTER):
            possible = materialize(rows.mapInArrow(lean(_possible(self.least)), "g long, id long").distinct(), "possible")
            wanted = possible.where(F.col("id").between(-(1 << 63), (1 << 63) - 1)).select("id")
            texts = self.source.join(wanted, self.source["doc_id"] == wanted["id"], "left_semi").groupBy(F.col("doc_id").alias("id")).agg(F.max("text").alias("text"))
            full = possible.join(texts, "id").select("g", "id", "text").repartition(self.parts, "g").sortWithinPartitions("g", "id")
            return materialize(full.mapInArrow(lean(_compare(self.words, self.percent)), "u long, v long"), "links")
