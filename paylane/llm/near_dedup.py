"""Near-duplicate documents by a chosen-path set similarity join over MinHash tokens.

A document's tokens are its COORDINATES minwise values, (coordinate, value). In a tree, a node's documents branch: a hash of
(node, token) chooses each token with probability 1 / (threshold * COORDINATES), and a document goes to the child of
each chosen token it has. Two documents of similarity s share s / threshold children of a shared node on average, so pairs
above the threshold keep meeting while others part. Small nodes are compared exhaustively, larger ones branch again. One tree
finds a pair with some probability; as many independent trees are grown as the target recall needs.

A node passes on a spanning forest of its likely pairs, never the pairs themselves; documents connected through such forests
are a family, and every likely pair lies within one. Links are then found on the full sets, family by family: within blocks of
a bounded number of members, each with a few hubs of the family, and then, where a family of several blocks is not one
component yet, between its blocks. Again only spanning forests of the links go on, so output grows with members.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylane.llm.common import split_words, tidy
from paylane.llm.components import components
from paylane.session import broadcast_if_small, staged

COORDINATES, SMALL, BASE, EXTRA_LEVELS, TIGHT, HUBS, BLOCK, COLUMNS = 128, 128, 4, 2, 0.9, 24, 512, 4096
LAST = (1 << 63) - 1
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# ---------------------------------------------------------------- sets and signatures


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``width``-word shingles; fewer words are one shingle, no word an empty set."""
    flat, counts = split_words(texts)
    seen = pc.ascii_lower(flat).dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, seen.dictionary.to_numpy(zero_copy_only=False)), np.uint64, len(seen.dictionary))
    words = hashes[seen.indices.to_numpy()]
    ends = np.cumsum(counts)
    sets, start = [], 0
    for end in ends.tolist():
        own = words[start:end]
        w = min(width, len(own))
        if w:
            value = np.full(len(own) - w + 1, w, np.uint64)
            for k in range(w):
                value = mixed(value * ODD + own[k : len(own) - w + 1 + k])
            own = np.unique(value)
        sets.append(own)
        start = end
    return sets


def minwise(sets: list[np.ndarray], seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
    out = np.full((len(sets), COORDINATES), 0xFFFFFFFF, np.uint32)
    for row, own in zip(out, sets):
        for at in range(0, len(own), 4096):
            values = ((own[at : at + 4096, None] * a + b) >> np.uint64(32)).astype(np.uint32)
            np.minimum(row, values.min(axis=0), out=row)
    return out


def sketches(minima: np.ndarray) -> np.ndarray:
    """One bit of each minwise value: two words of 64 bits per document."""
    bits = np.packbits((mixed(minima.astype(np.uint64)) & np.uint64(1)).astype(np.uint8), axis=1)
    return bits.view(np.int64)


def signature_rows(width: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                sets = shingle_sets(batch.column("text"), width)
                minima = minwise(sets, seed)
                keys = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets]
                one, two = np.array(keys, np.int64).reshape(-1, 2).T
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ord"), batch.column("dk"), pa.array([len(s) for s in sets], pa.int64()), pa.array(one), pa.array(two),
                     pa.array([m.tobytes() for m in minima], pa.binary())],
                    ["ord", "dk", "n_shingles", "c1", "c2", "minima"],
                )

    return work


# ---------------------------------------------------------------- trees


def survival(depth: int) -> float:
    """Chance that a pair at the threshold still shares a node after ``depth`` levels of one tree."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    return p


def children(nodes: np.ndarray, rows: np.ndarray, tokens: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Child nodes of (node, row of tokens), with the rows they come from."""
    out_nodes, out_rows = [], []
    limit = np.uint64(int(rate * 2**64))
    for at in range(0, len(nodes), 4096):
        drawn = mixed(nodes[at : at + 4096, None] ^ tokens[rows[at : at + 4096]])
        i, j = np.nonzero(drawn < limit)
        out_nodes.append(mixed(drawn[i, j] + ODD))
        out_rows.append(rows[at : at + 4096][i])
    return (np.concatenate(out_nodes), np.concatenate(out_rows)) if out_nodes else (nodes, rows)


def branched(depth: int, trees: int, threshold: float, root: str | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (node, id, s1, s2) after ``depth`` levels: below the roots of all trees, or below the nodes in column ``root``."""
    rate = 1 / (threshold * COORDINATES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                n = batch.num_rows
                minima = np.frombuffer(b"".join(batch.column("minima").to_pylist()), np.uint32).reshape(n, COORDINATES)
                tokens = mixed(minima.astype(np.uint64) * ODD + np.arange(COORDINATES, dtype=np.uint64))
                if root is None:
                    nodes, rows = np.repeat(mixed(np.arange(1, trees + 1, dtype=np.uint64)), n), np.tile(np.arange(n), trees)
                else:
                    nodes, rows = batch.column(root).to_numpy().view(np.uint64), np.arange(n)
                for _ in range(depth):
                    nodes, rows = children(nodes, rows, tokens, rate)
                s = sketches(minima)[rows] if len(rows) else np.zeros((0, 2), np.int64)
                ids = batch.column("id").to_numpy()[rows]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (nodes.view(np.int64), ids, s[:, 0].copy(), s[:, 1].copy())], ["node", "id", "s1", "s2"])

    return work


NODE_ROWS = "node long, id long, s1 long, s2 long"


def agreement(threshold: float) -> int:
    """Least number of equal sketch bits that goes on to confirmation: five standard deviations below the expected number."""
    p = (1 + threshold) / 2
    return int(COORDINATES * p - 5 * math.sqrt(COORDINATES * p * (1 - p)))


def equal_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal bits of all sketches in ``a`` with all in ``b``; unsigned, as counts of negative numbers mean something else."""
    a, b = np.ascontiguousarray(a).view(np.uint64), np.ascontiguousarray(b).view(np.uint64)
    return COORDINATES - np.bitwise_count(a[:, None, :] ^ b[None, :, :]).sum(axis=2, dtype=np.int32)


def roots_of(linked: np.ndarray) -> np.ndarray:
    """Least index connected to each row of a symmetric matrix of links."""
    n = len(linked)
    linked = linked | np.eye(n, dtype=bool)
    label = np.arange(n)
    while True:
        new = np.where(linked, label[None, :], n).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of equal keys, one run after another, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(max(0, batch.num_rows - 1), bool)
        for v in values:
            changed |= v[1:] != v[:-1]
        cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for x, y in zip(cuts[:-1], cuts[1:]):
            if y == x:
                continue
            own = tuple(v[x] for v in values)
            if own != key and held:
                yield pa.concat_batches(held)
                held = []
            key = own
            held.append(batch.slice(x, y - x))
    if held:
        yield pa.concat_batches(held)


def gathered(pieces: Iterator[tuple[np.ndarray, np.ndarray]], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Batches (a, b) of many small arrays of edges."""
    a, b, n = [], [], 0
    for one, other in pieces:
        if len(one):
            a.append(one)
            b.append(other)
            n += len(one)
        if n >= rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
            a, b, n = [], [], 0
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


EDGES = "a long, b long"


def forests(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spanning forests of the likely pairs of small nodes, from rows sorted by node."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces():
            for table in runs(batches, ["node"]):
                if table.num_rows > 1:
                    ids = table.column("id").to_numpy()
                    s = np.stack([table.column("s1").to_numpy(), table.column("s2").to_numpy()], axis=1)
                    root = roots_of(equal_bits(s, s) >= least)
                    on = root != np.arange(len(root))
                    yield ids[on], ids[root[on]]

        yield from gathered(pieces())

    return work


# ---------------------------------------------------------------- links on full sets


def linked_sets(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of sets reach the threshold, as a symmetric matrix: exact intersections by products of 0/1 columns."""
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    if n == 2:
        both = np.zeros((2, 2), np.int64)
        both[0, 1] = both[1, 0] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
    else:
        owner = np.repeat(np.arange(n), sizes)
        _, column, counts = np.unique(np.concatenate(sets) if n else np.zeros(0), return_inverse=True, return_counts=True)
        number = np.cumsum(counts > 1) - 1  # shingles of one member meet nothing
        on = counts[column] > 1
        owner, column = owner[on], number[column[on]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        both = np.zeros((n, n), np.float32)
        for at in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
            x, y = np.searchsorted(column, [at, at + COLUMNS])
            part = np.zeros((n, COLUMNS), np.float32)
            part[owner[x:y], column[x:y] - at] = 1
            both += part @ part.T
        both = both.astype(np.int64)
    return (both > 0) & (100 * both >= percent * (sizes[:, None] + sizes[None, :] - both))


def linked(width: int, percent: int, keys: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spanning forests of the links in each group of rows (..., id, text), from rows sorted by the group's keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces():
            for table in runs(batches, keys):
                ids = table.column("id").to_numpy()
                root = roots_of(linked_sets(shingle_sets(table.column("text"), width), percent))
                on = root != np.arange(len(root))
                yield ids[on], ids[root[on]]

        yield from gathered(pieces())

    return work


def within_blocks(members: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Stored forests of the links within blocks. ``members``: (family, size, id), stored; families have two members at least."""
    many = F.ceil(F.col("size") / BLOCK)
    placed = members.withColumn("block", F.pmod(F.xxhash64("id"), many))
    # Hubs are members by a second hash; those of a family of several blocks are in each of them.
    hub = (many > 1) & (F.pmod(F.xxhash64("id", F.lit(1)), F.col("size")) < HUBS)
    blocks = F.when(hub, F.sequence(F.lit(0).cast("long"), many - 1)).otherwise(F.array("block"))
    placed = placed.select("family", "id", F.explode(blocks).alias("block"))
    return group_links(placed, ["family", "block"], texts, width, percent)


def group_links(placed: DataFrame, keys: list[str], texts: DataFrame, width: int, percent: int) -> DataFrame:
    rows = placed.join(texts, "id").repartition(*keys).sortWithinPartitions(*keys, "id")
    return staged(rows.mapInArrow(tidy(linked(width, percent, keys)), EDGES), "near-links")


def between_blocks(members: DataFrame, texts: DataFrame, links: DataFrame, width: int, percent: int) -> DataFrame | None:
    """Stored forests of the links between members of different blocks, for families that are not one component yet.

    Members outside a family's largest component meet all others, in pairs of blocks; None if there is nothing to do.
    """
    wide = members.where(F.col("size") > BLOCK)
    if not wide.limit(1).count():
        return None
    labels = components(links).select(F.col("node").alias("id"), F.col("label").alias("comp"))
    wide = staged(wide.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id")), "near-wide")
    sizes = wide.groupBy("family", "comp").agg(F.count("*").alias("n"))
    mixed_families = sizes.groupBy("family").agg(F.sum("n").alias("all"), F.max(F.struct("n", "comp")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    half = BLOCK // 2
    mixed_families = mixed_families.select("family", F.col("main.comp").alias("main"), F.ceil(F.col("all") / half).alias("across"),
                                           F.ceil((F.col("all") - F.col("main.n")) / half).alias("down"))
    rows = wide.join(broadcast_if_small(staged(mixed_families, "near-mixed")), "family")
    own = lambda many: F.pmod(F.xxhash64("id"), F.col(many))
    others = rows.withColumn("x", own("across")).withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("down") - 1)))
    rest = rows.where("comp <> main").withColumn("y", own("down")).withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)))
    placed = rest.unionByName(others).select("family", "x", "y", "id").distinct()
    return group_links(placed, ["family", "x", "y"], texts, width, percent)


# ---------------------------------------------------------------- the join


def likely_edges(reps: DataFrame, threshold: float, recall: float) -> DataFrame:
    """Stored edges (a, b) whose components are the families.

    Trees start at BASE levels and go deeper only below large nodes, down to where unrelated documents, which part about
    eightfold a level, would leave small ones. A large node most of whose members are near its least one is a family as it
    stands and branches no more; nor does what is left large at the end.
    """
    total = reps.count()
    deepest = max(BASE, math.ceil(math.log(max(total, 1) / SMALL, 8)) if total > SMALL else 0) + EXTRA_LEVELS
    trees = math.ceil(math.log(1 - recall) / math.log(1 - survival(deepest)))
    least = agreement(threshold)
    rows = reps.select("id", "minima").mapInArrow(tidy(branched(BASE, trees, threshold)), NODE_ROWS)
    edges = None
    for level in range(BASE, deepest + 1):
        hub = F.min(F.struct("id", "s1", "s2")).alias("hub")
        large = staged(rows.groupBy("node").agg(F.count("*").alias("n"), hub).where(F.col("n") > SMALL), "near-large")
        any_large = large.count() > 0
        large = broadcast_if_small(large)
        small = rows.join(large.select("node"), "node", "left_anti") if any_large else rows
        done = staged(small.repartition("node").sortWithinPartitions("node", "id").mapInArrow(tidy(forests(least)), EDGES), "near-forests")
        edges = done if edges is None else edges.unionByName(done)
        if not any_large:
            break
        differ = F.bit_count(F.col("s1").bitwiseXOR(F.col("hub.s1"))) + F.bit_count(F.col("s2").bitwiseXOR(F.col("hub.s2")))
        stay = rows.join(large, "node").select("node", "id", F.col("hub.id").alias("hub"), (differ <= COORDINATES - least).alias("near"))
        stay = staged(stay, "near-branching")
        loose = stay.groupBy("node").agg(F.avg(F.col("near").cast("int")).alias("share")).where(F.col("share") < TIGHT).select("node")
        loose = broadcast_if_small(staged(loose, "near-loose"))
        tight = stay if level == deepest else stay.join(loose, "node", "left_anti")
        edges = edges.unionByName(tight.select(F.col("id").alias("a"), F.col("hub").alias("b")))
        if level < deepest:
            again = stay.join(loose, "node", "left_semi").select(F.col("node").alias("root"), "id").join(reps.select("id", "minima"), "id")
            rows = again.mapInArrow(tidy(branched(1, 1, threshold, "root")), NODE_ROWS)
    return staged(edges.where("a <> b").distinct(), "near-likely")


def links_of(reps: DataFrame, docs: DataFrame, width: int, percent: int, recall: float) -> DataFrame:
    """Edges (a, b) whose components are the groups of near duplicates among ``reps`` (id, minima); ``docs``: (dk, text)."""
    families = components(likely_edges(reps, percent / 100, recall))
    families = staged(families.select(F.col("label").alias("family"), F.col("node").alias("id")), "near-families")
    sizes = families.groupBy("family").agg(F.count("*").alias("size"))
    members = staged(families.join(sizes, "family"), "near-members")
    texts = docs.select(F.col("dk").alias("id"), "text").join(broadcast_if_small(members.select("id")), "id", "left_semi")
    texts = staged(texts.dropDuplicates(["id"]), "near-texts")
    links = within_blocks(members, texts, width, percent)
    more = between_blocks(members, texts, links, width, percent)
    return links if more is None else links.unionByName(more)


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80, recall: float = 0.999, seed: int = 13) -> DataFrame:
    """(ord, dk, n_shingles, component_id, head): the group of each row of ``docs``; one (doc_id, text) of each group is its head.

    Texts are linked if their sets of ``width``-word shingles (A-Z lower-cased, words between ASCII white space) have
    100 * intersection >= percent * union; a group is everything linked through others, its id the least doc_id in it (null
    ids last). Texts of equal sets are linked without search. Texts without words are linked with nothing.
    ``ord`` is the doc_id (null as the largest long) and ``dk`` a hash of id and text.
    """
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"), F.xxhash64("doc_id", "text").alias("dk"), "text")
    schema = "ord long, dk long, n_shingles long, c1 long, c2 long, minima binary"
    own = staged(keyed.mapInArrow(tidy(signature_rows(width, seed)), schema), "near-signatures")
    filled = own.where("n_shingles > 0")
    classes = filled.groupBy("c1", "c2").agg(F.min(F.struct("ord", "dk", "minima")).alias("r"))
    classes = staged(classes.select("c1", "c2", F.col("r.ord").alias("least"), F.col("r.dk").alias("id"), F.col("r.minima").alias("minima")), "near-classes")

    labels = components(links_of(classes, keyed, width, percent, recall))
    ids = classes.select("id", "least", "c1", "c2").join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    ids = staged(ids, "near-labels")
    heads = ids.groupBy("label").agg(F.min(F.struct("least", "id")).alias("head"))
    named = ids.join(heads, "label").select("c1", "c2", "head")
    out = own.select("ord", "dk", "n_shingles", "c1", "c2").join(named, ["c1", "c2"], "left")
    alone = F.struct(F.col("ord").alias("least"), F.col("dk").alias("id"))
    out = out.withColumn("head", F.when(F.col("n_shingles") > 0, F.col("head")).otherwise(alone))
    component = F.when(F.col("head.least") != LAST, F.col("head.least"))
    is_head = (F.col("ord") == F.col("head.least")) & (F.col("dk") == F.col("head.id"))
    return out.select("ord", "dk", "n_shingles", component.alias("component_id"), is_head.alias("head"))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` but for all of each group save one: that of the least doc_id (of equal ids, the least hash).

    Of rows repeated with id and text one stays.
    """
    groups = staged(near_groups(docs, **how), "near-groups")
    names = docs.columns
    rows = docs.select(F.struct("*").alias("row"))
    key = [F.coalesce(F.col("row.doc_id").cast("long"), F.lit(LAST)).alias("ord"), F.xxhash64("row.doc_id", "row.text").alias("dk")]
    rows = rows.select("row", *key)
    gone = staged(groups.where("not head").select("ord", "dk").distinct(), "near-gone")
    kept = rows.join(broadcast_if_small(gone), ["ord", "dk"], "left_anti")
    repeated = staged(groups.where("head").groupBy("ord", "dk").count().where("count > 1").select("ord", "dk"), "near-repeated")
    if repeated.limit(1).count():
        small = broadcast_if_small(repeated)
        once = kept.join(small, ["ord", "dk"], "left_semi").dropDuplicates(["ord", "dk"])
        kept = kept.join(small, ["ord", "dk"], "left_anti").unionByName(once)
    return kept.select(*(F.col(f"row.`{c}`").alias(c) for c in names))
