"""N-gram Jaccard self-join by a MinHash LSH forest.

Texts are sets of word shingles; equal sets are one node from the start. A node's
MinHash signature is cut into trees: in each tree nodes are ordered by their values,
which makes a prefix trie. Matched prefixes are shortened level by level, from the
full depth to the depth at which a pair at the threshold is found with the target
recall, and only as long as a trie node holds members that are not joined yet. The
signatures of members are compared there with a wide margin, which yields candidate
groups. Within a candidate group all pairs are verified on the exact sets.

Groups of any size are cut into blocks; every pair of blocks meets in one task,
which returns a count per node and a spanning set of links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriframe.llm.common import col, importable, slices
from veriframe.llm.components import components
from veriframe.llm.shingles import WORDS, set_id, shingle_sets
from veriframe.session import durable

THRESHOLD = 0.8
TREES, DEPTH = 16, 8
RECALL = 0.9995
MARGIN = 0.25  # a candidate's estimate may lie so far below the threshold (7 standard errors)
SLICE = 1 << 20  # bytes of text hashed at once; a worker needs some fifty times that
BLOCK = 512  # nodes of a block
MAP_BITS = 1 << 27  # of the bitmap that picks texts: 16 MiB
BLOCK_SHINGLES = 1 << 20  # and shingles of a block, on average

_SEEDS = np.random.default_rng(20240229).integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def stop_depth(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold shares one in some tree with the target recall."""
    for d in range(depth, 0, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    raise ValueError(f"{trees} trees cannot reach a recall of {recall} at {threshold}")


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of TREES * DEPTH MinHash values for each non-empty set."""
    sizes = np.array([len(s) for s in sets])
    out = np.empty((len(sets), len(_SEEDS)), np.uint32)
    if len(sets):
        shingles, starts = np.concatenate(sets), np.concatenate(([0], np.cumsum(sizes)[:-1]))
        for k, seed in enumerate(_SEEDS):
            out[:, k] = np.minimum.reduceat(shingles * seed, starts) >> np.uint64(32)
    return out


def prefix_keys(signature: np.ndarray, depth: int) -> np.ndarray:
    """Per row and tree the hash of the first ``depth`` values."""
    cut = signature.reshape(len(signature), TREES, DEPTH)[:, :, :depth].astype(np.uint64)
    h = np.zeros(cut.shape[:2], np.uint64)
    for d in range(depth):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, d]
    return (h * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def _prepared(df: DataFrame, id_col: str, text_col: str, words: int, depth: int) -> DataFrame:
    """Per row its id, a hash of the text, and set id, size, signature and prefix keys of its set."""
    text = col(text_col).cast("string")
    rows = df.select(col(id_col).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    names = ["_id", "_hash", "set_id", "n", "signature", "prefixes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                sets = shingle_sets(part.column("_text").to_pylist(), words)
                full = [i for i, s in enumerate(sets) if len(s)]
                signature = signatures([sets[i] for i in full])
                keys = prefix_keys(signature, depth)
                row = dict(zip(full, range(len(full))))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id"), part.column("_hash"),
                        pa.array([set_id(s) for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([signature[row[i]].tobytes() if i in row else None for i in range(len(sets))], pa.binary()),
                        pa.array([keys[row[i]] if i in row else None for i in range(len(sets))], pa.list_(pa.int64())),
                    ],
                    names=names,
                )

    return rows.mapInArrow(
        run, f"_id {kind}, _hash bigint, set_id binary, n bigint, signature binary, prefixes array<bigint>"
    )


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first ``keys`` columns; the rows must come sorted by them."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = list(zip(*(batch.column(k).to_pylist() for k in range(keys))))
        start = 0
        for i, v in enumerate(values):
            if v != current:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, current = [], i, v
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


class Roots:
    """Union-find over 0..n-1; the smallest member is the root."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def all(self) -> np.ndarray:
        p = self.parent
        while True:
            q = p[p]
            if (q == p).all():
                self.parent = p
                return p
            p = q

    def join(self, members: np.ndarray) -> None:
        roots = np.unique(self.all()[members])
        self.parent[roots] = roots[0]


def trie_links(signature: np.ndarray, tree: int, stop: int, least: float) -> np.ndarray:
    """Per row of a trie node the first row it is joined to, over estimates of at least ``least``.

    Rows that share a longer prefix are compared first; the prefix is shortened, down to
    ``stop``, while the rows below it are not all joined.
    """
    n = len(signature)
    roots = Roots(n)
    own = signature[:, tree * DEPTH : (tree + 1) * DEPTH]
    order = np.lexsort(own.T[::-1])
    for depth in range(DEPTH, stop - 1, -1):
        head = own[order, :depth]
        border = np.flatnonzero(np.concatenate(([True], (head[1:] != head[:-1]).any(axis=1), [True])))
        for a, b in zip(border[:-1], border[1:]):
            run = order[a:b]
            for p in run[: -1 if b - a > 1 else 0]:
                label = roots.all()
                others = run[label[run] != label[p]]
                if not len(others):
                    if len(np.unique(label[run])) == 1:
                        break
                    continue
                alike = others[(signature[others] == signature[p]).mean(axis=1) >= least]
                if len(alike):
                    roots.join(np.append(alike, p))
    return roots.all()


def exact_links(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: Fraction) -> np.ndarray:
    """Matrix of the pairs whose Jaccard similarity reaches ``threshold``; ``right`` None: left with itself."""
    own = right is None
    right = left if own else right
    sizes_l, sizes_r = (np.array([len(s) for s in x]) for x in (left, right))
    all_l = np.concatenate(left)
    all_r = all_l if own else np.concatenate(right)
    # Only shingles that two sets share can count.
    values, counts = np.unique(all_l if own else np.concatenate((all_l, all_r)), return_counts=True)
    values = values[counts > 1]
    common = np.zeros((len(left), len(right)), np.int64)
    row_l, row_r = np.repeat(np.arange(len(left)), sizes_l), np.repeat(np.arange(len(right)), sizes_r)

    def placed(shingles: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(values, shingles)
        at[at == len(values)] = 0
        known = values[at] == shingles if len(values) else np.zeros(len(shingles), bool)
        order = np.argsort(at[known], kind="stable")
        return at[known][order], row[known][order]

    (at_l, row_l), (at_r, row_r) = placed(all_l, row_l), placed(all_r, row_r)
    step = 2_048
    for first in range(0, len(values), step):
        dense = []
        for at, row, n in ((at_l, row_l, len(left)), (at_r, row_r, len(right))):
            a, b = np.searchsorted(at, (first, first + step))
            m = np.zeros((n, step), np.float32)
            m[row[a:b], at[a:b] - first] = 1
            dense.append(m)
        common += (dense[0] @ dense[1].T).astype(np.int64)
    union = sizes_l[:, None] + sizes_r[None, :] - common
    linked = common * threshold.denominator >= union * threshold.numerator
    if own:
        np.fill_diagonal(linked, False)
    return linked


def _tiled(members: DataFrame, group: list[str], blocks: str, payload: list[str]) -> DataFrame:
    """Rows dealt to the tiles of their group, sorted by tile; ``blocks`` is the group's number of blocks."""
    own = F.pmod(F.xxhash64("set_id"), F.col(blocks)).cast("int")
    spread = members.withColumn("_block", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1))
    )
    tile = [*group, "_first", "_second"]
    dealt = spread.withColumns({"_first": F.least("_block", "_other"), "_second": F.greatest("_block", "_other")})
    return dealt.select(*tile, "_block", *payload).repartition(*tile).sortWithinPartitions(*tile, "set_id")


def _candidate_edges(nodes: DataFrame, stop: int, least: float) -> DataFrame:
    """Spanning links (a, b) among nodes that share a trie node and have similar signatures."""
    keyed = nodes.select("set_id", F.posexplode("prefixes").alias("tree", "prefix"))
    shared = (
        keyed.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        .withColumn("_blocks", F.ceil(F.col("_n") / BLOCK)).drop("_n").hint("rebalance")
    )
    members = keyed.join(shared, ["tree", "prefix"]).join(nodes.select("set_id", "signature"), "set_id")
    tiles = _tiled(members, ["tree", "prefix"], "_blocks", ["set_id", "signature"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, 4):
            if group.num_rows < 2:
                continue
            ids = group.column("set_id").to_pylist()
            signature = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32).reshape(len(ids), -1)
            root = trie_links(signature, group.column("tree")[0].as_py(), stop, least)
            pairs = [(ids[r], ids[i]) for i, r in enumerate(root) if r != i]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*pairs)], names=["a", "b"])

    return tiles.mapInArrow(run, "a binary, b binary")


def _marked(chosen: DataFrame) -> np.ndarray:
    """Bitmap over the hashes of the chosen rows: sixteen bits a row, MAP_BITS at most.

    Spark builds it in pieces of 4 KiB, so at most MAP_BITS / 8 bytes reach the driver.
    """
    wanted = max(chosen.count(), 1) * 16
    bits = min(MAP_BITS, max(1 << 15, 1 << (wanted - 1).bit_length()))
    at = F.pmod(F.xxhash64("_pick_id", "_pick_hash"), F.lit(bits))
    pieces = chosen.select(at.alias("at")).groupBy(F.expr("cast(at div 32768 as int)").alias("piece")).agg(
        F.bitmap_construct_agg(F.col("at") % 32_768).alias("map")
    )
    out = np.zeros((bits >> 15, 4_096), np.uint8)
    for r in pieces.collect():
        out[r["piece"]] = np.frombuffer(r["map"], np.uint8)
    return out.ravel()


def _is_marked(df: DataFrame, id_col: str, text_col: str, marks: np.ndarray) -> Column:
    """Whether a row's id and text may be among those of the bitmap; only the row's slot goes to Python."""
    shared = df.sparkSession.sparkContext.broadcast(marks)

    @F.pandas_udf("boolean")
    def look(at: pd.Series) -> pd.Series:
        slots = at.to_numpy()
        return pd.Series((shared.value[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1)

    return look(F.pmod(F.xxhash64(col(id_col), F.xxhash64(col(text_col).cast("string"))), F.lit(len(marks) * 8)))


def _with_shingles(df: DataFrame, chosen: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(group, set_id, n, shingles) of the chosen nodes, from the one text picked for each.

    Texts are not shuffled: a bitmap of bounded size tells the tasks which rows may be picked,
    and only their shingles meet the chosen nodes. When it is full it lets more rows through,
    which the join by set removes.
    """
    text = col(text_col).cast("string")
    rows = df.select(col(id_col).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))
    marks = _marked(chosen)
    shared = df.sparkSession.sparkContext.broadcast(marks)
    slot = F.pmod(F.xxhash64("_id", "_hash"), F.lit(len(marks) * 8))
    rows = rows.select(slot.alias("_slot"), "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            at = batch.column("_slot").to_numpy()
            marked = batch.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            for part in slices(marked, "_text", SLICE):
                sets = [s for s in shingle_sets(part.column("_text").to_pylist(), words) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([set_id(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["set_id", "n", "shingles"],
                )

    made = rows.mapInArrow(run, "set_id binary, n bigint, shingles binary")
    joined = made.join(chosen.select("set_id", "group"), "set_id")
    return durable(joined.dropDuplicates(["set_id"]), "shingles")  # repeated rows give a node twice


def _verified(nodes: DataFrame, threshold: Fraction) -> DataFrame:
    """(a, b, links): links of a node counted in a tile (b null), and spanning links (links null)."""
    sizes = (
        nodes.groupBy("group").agg(F.count(F.lit(1)).alias("_n"), F.sum("n").alias("_s")).filter("_n > 1")
        .select("group", F.ceil(F.greatest(F.col("_n") / BLOCK, F.col("_s") / BLOCK_SHINGLES)).alias("_blocks"))
        .hint("rebalance")
    )
    tiles = _tiled(nodes.join(sizes, "group"), ["group"], "_blocks", ["set_id", "shingles"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, 3):
            ids = group.column("set_id").to_pylist()
            sets = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
            block = np.array(group.column("_block").to_pylist())
            if group.column("_first")[0].as_py() == group.column("_second")[0].as_py():
                at_l = at_r = np.arange(len(ids))
                linked = exact_links(sets, None, threshold)
            else:
                at_l, at_r = (np.flatnonzero(block == b) for b in (block.min(), block.max()))
                if block.min() == block.max():
                    continue
                linked = exact_links([sets[i] for i in at_l], [sets[i] for i in at_r], threshold)
            counts = np.zeros(len(ids), np.int64)
            counts[at_l] += linked.sum(axis=1)
            if at_r is not at_l:
                counts[at_r] += linked.sum(axis=0)
            if not counts.any():
                continue
            roots = Roots(len(ids))
            for i in np.flatnonzero(linked.any(axis=1)):
                roots.join(np.append(at_r[linked[i]], at_l[i]))
            root = roots.all()
            a = [ids[i] for i in np.flatnonzero(counts)]
            links = [int(c) for c in counts if c]
            b: list = [None] * len(a)
            for i, r in enumerate(root):
                if i != r:
                    a.append(ids[r])
                    b.append(ids[i])
                    links.append(None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(links, pa.int64())], names=["a", "b", "links"]
            )

    return tiles.mapInArrow(run, "a binary, b binary, links bigint")


def _resolved(
    df: DataFrame, id_col: str, text_col: str, threshold: float, words: int, recall: float
) -> tuple[DataFrame, DataFrame]:
    """(rows with id, text hash and set id; one row per set with its class and counts).

    Per set: ``_set``, ``_class`` (smallest id of the class), ``_winner`` (id and text hash of
    the class's first row), ``n_links`` and ``n_copies``.
    """
    importable(df.sparkSession)
    stop, exact = stop_depth(threshold, recall), Fraction(threshold).limit_denominator(1_000)
    rows = durable(_prepared(df, id_col, text_col, words, stop), "signatures")
    first = F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_hash")
    nodes = (
        rows.filter(F.col("set_id").isNotNull())
        .groupBy("set_id")
        .agg(
            F.first("signature").alias("signature"), F.first("prefixes").alias("prefixes"),
            F.min(first).alias("_first"), F.count(F.lit(1)).alias("n_copies"),
        )
    )
    nodes = durable(nodes, "nodes")
    groups = components(_candidate_edges(nodes, stop, threshold - MARGIN))
    chosen = groups.select(F.col("node").alias("set_id"), F.col("root").alias("group")).join(
        nodes.select("set_id", F.col("_first._id").alias("_pick_id"), F.col("_first._hash").alias("_pick_hash")), "set_id"
    )
    verified = durable(_verified(_with_shingles(df, durable(chosen, "chosen"), id_col, text_col, words), exact), "links")
    links = verified.filter(F.col("b").isNull()).groupBy(F.col("a").alias("set_id")).agg(F.sum("links").alias("n_links"))
    root = components(verified.filter(F.col("b").isNotNull()))
    # Only linked nodes need their class looked up; every other node is a class of its own.
    linked = root.select(F.col("node").alias("set_id"), "root").join(links, "set_id").join(
        nodes.select("set_id", "_first"), "set_id"
    )
    linked = durable(linked, "linked")
    of_class = linked.groupBy("root").agg(F.min("_first").alias("_won")).hint("rebalance")
    resolved = linked.join(of_class, "root").select("set_id", "n_links", "_won")
    per_set = nodes.select("set_id", "_first", "n_copies").join(resolved, "set_id", "left")
    won = F.coalesce("_won", "_first")
    return rows.select("_id", "_hash", "set_id"), per_set.select(
        F.col("set_id").alias("_set"), won["_id"].alias("_class"),
        F.struct(won["_id"].alias("_id"), won["_hash"].alias("_hash")).alias("_winner"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), "n_copies",
    )


def classes(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    words: int = WORDS,
    recall: float = RECALL,
) -> DataFrame:
    """Per row: the id, ``class_id``, ``n_links`` and ``n_copies``.

    ``class_id`` is the smallest id of the class, the texts joined by chains of pairs whose sets
    of ``words``-word shingles have a Jaccard similarity of at least ``threshold``. ``n_links``
    counts the different sets a text is linked to, ``n_copies`` the rows that share its own.
    Words are runs of ASCII letters and digits, A-Z lower-cased, and of characters beyond ASCII.

    Texts of fewer words are a single shingle. Null texts and those without words are linked to
    nothing, not even each other: their class is their own id. Repeated rows share class and
    counts. Null ids are passed over for ``class_id`` unless a class has no other. Empty tables
    are fine, other columns are not read.

    ``recall`` bounds the chance that a pair at the threshold meets in no tree; pairs of a group
    joined by other links are verified in any case.
    """
    rows, per_set = _resolved(df, id_col, text_col, threshold, words, recall)
    return rows.join(per_set.hint("rebalance"), F.col("set_id") == F.col("_set"), "left").select(
        F.col("_id").alias(id_col),
        F.when(F.col("set_id").isNull(), F.col("_id")).otherwise(F.col("_class")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.coalesce("n_copies", F.lit(1).cast("bigint")).alias("n_copies"),
    )


def one_of_each(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    words: int = WORDS,
    recall: float = RECALL,
) -> DataFrame:
    """The rows of ``df`` that stay when one of each class of :func:`classes` does, all columns kept.

    The row with the smallest id stays, a null one only if there is no other; among equal ids
    the smallest hash of the text decides. Rows without words all stay. Rows that repeat both id
    and text stay once.
    """
    rows, per_set = _resolved(df, id_col, text_col, threshold, words, recall)
    several = per_set.filter((F.col("n_copies") > 1) | (F.col("n_links") > 0)).select("_set", "_winner")
    lost = (
        rows.join(several.hint("rebalance"), F.col("set_id") == F.col("_set"))
        .select("_id", "_hash", "_winner").filter(F.struct("_id", "_hash") != F.col("_winner"))
        .select("_id", "_hash", F.lit(True).alias("_lost"))
    )
    again = rows.groupBy("_id", "_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    both = lost.unionByName(again.select("_id", "_hash", F.lit(False).alias("_lost")))
    # Keys of which rows go, or all rows but one; found among ids and hashes, and few beside all rows.
    touched = durable(both.groupBy(F.col("_id").alias("_pick_id"), F.col("_hash").alias("_pick_hash")).agg(F.max("_lost").alias("_lost")), "touched")
    marked = _is_marked(df, id_col, text_col, _marked(touched))
    # Whole rows are shuffled only if they may be touched; the others pass where they are.
    keyed = df.filter(marked).select(
        F.struct(*[col(c) for c in df.columns]).alias("_row"),
        F.struct(col(id_col).alias("_id"), F.xxhash64(col(text_col).cast("string")).alias("_hash")).alias("_key"),
    )
    gone = touched.filter("_lost").select(F.struct(F.col("_pick_id").alias("_id"), F.col("_pick_hash").alias("_hash")).alias("_key"))
    kept = keyed.join(gone, "_key", "left_anti").dropDuplicates(["_key"]).select("_row.*")
    return df.filter(~marked).unionByName(kept)
