"""Documents whose sets of word shingles have a Jaccard similarity of at least a threshold: a size-aware join.

Equal sets are one class and go through the join once. Small classes (below a boundary that costs choose) are joined
by enumerating subsets: two sets of sizes n and m are similar exactly if they share a subset of c(n, m) shingles, so
each set lists its subsets of that size. Large classes are joined by inverted lists: under one order of all shingles,
similar sets share one of their first n - ceil(t * n) + 1 shingles. Shingles in more than ``hot`` of the classes' first
regions come last in that order, so that common lines and passages make no long lists.

No list is ever turned into all its pairs. First every member is compared with one centre of its list, and the links
found make components. Then only members outside a list's largest component are compared with members of other
components, after exact bounds on size and on the parity bitmaps of the sets. What is left is verified on whole sets,
so a pair is linked if and only if it is similar; links inside a component that add nothing are not looked for.

Shingles are told apart by 64-bit hashes, sets by 64-bit signatures.

Defined cases: null texts, empty texts and texts without a word have no shingles and are linked with nothing; with
fewer words than ``words`` the whole sequence is the one shingle. Repeated rows are copies of each other. A null
doc_id is kept and never is a component's id unless all its rows have none. Empty tables give no rows. Other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_signals.llm.components import components
from review_signals.llm.shared import bounded, staged
from review_signals.llm.text_arrays import Texts, chunks, mix, roll, tidy

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BITMAP_LONGS = 8
_BITMAP_BITS = 64 * _BITMAP_LONGS


@dataclass(frozen=True)
class Join:
    """``percent`` of similarity on shingles of ``words`` words. A bounded list of hot shingles and of ids may be
    broadcast; more hot shingles than ``max_hot`` raise ``hot``, more ids than ``max_ids`` are shuffled."""

    percent: int = 85
    words: int = 4
    hot: int = 100
    max_hot: int = 2_000_000
    max_ids: int = 1_000_000
    largest_small: int = 24
    list_cost: int = 6

    def overlap(self, n: int, m: int) -> int:
        """Shared shingles that sets of n and m need: 100 * o >= percent * (n + m - o)."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1

    def region(self, n: int) -> int:
        """Shingles in which hot ones are counted: the prefix and half as many more."""
        return min(n, self.prefix(n) + max(8, self.prefix(n) // 2))

    def partners(self, n: int) -> range:
        """Sizes m >= n of sets that can be similar to a set of n."""
        return range(n, 100 * n // self.percent + 1)


def shingle_sets(texts: Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after the other, and where each text's begin and end."""
    lowered = Texts(_LOWER[texts.data], texts.offsets)
    starts, ends = lowered.words
    owner = lowered.owner(starts)
    hashes = lowered.hashes(starts, ends)
    count = np.bincount(owner, minlength=len(texts))
    whole = np.flatnonzero(owner[: max(0, len(owner) - words + 1)] == owner[words - 1:])
    values, holders = [roll(hashes, words)[whole]], [owner[whole]]
    first = np.cumsum(count) - count
    for length in range(1, words):
        short = np.flatnonzero(count == length)
        joined = np.zeros(len(short), np.uint64)
        with np.errstate(over="ignore"):
            for step in range(length):
                joined = mix(joined * np.uint64(31) + hashes[first[short] + step])
        values.append(joined)
        holders.append(short)
    value, holder = np.concatenate(values), np.concatenate(holders)
    order = np.lexsort((value, holder))
    value, holder = value[order], holder[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (holder[1:] != holder[:-1])
    value, holder = value[new], holder[new]
    return value, np.searchsorted(holder, np.arange(len(texts) + 1))


def _signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    with np.errstate(over="ignore"):
        return mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).astype(np.int64)


def _bitmaps(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per set, the parity of its shingles in each of 512 cells: two bitmaps differ in at most |A - B| + |B - A| cells."""
    holder = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    cells = np.bincount(holder * _BITMAP_BITS + (mix(values) % np.uint64(_BITMAP_BITS)).astype(np.int64),
                        minlength=(len(bounds) - 1) * _BITMAP_BITS) & 1
    return np.packbits(cells.astype(np.uint8).reshape(len(bounds) - 1, _BITMAP_BITS), axis=1).reshape(-1, 64)


def _fixed(rows: np.ndarray) -> pa.Array:
    """Equally long byte rows as an Arrow column."""
    flat = np.ascontiguousarray(rows)
    return pa.array([row.tobytes() for row in flat], pa.binary())


def _pieces(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Slices of 64-bit values as an Arrow binary column."""
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * 8).astype(np.int64).tobytes()), pa.py_buffer(values.astype("<u8").tobytes())]).cast(pa.binary())


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def measure(docs: DataFrame, join: Join) -> DataFrame:
    """Per row the size and signature of its set (``node``), the set's first region by hash and its bitmap."""
    sizes = np.array([join.region(n) for n in range(4096)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "text"):
            values, bounds = shingle_sets(texts, join.words)
            count = np.diff(bounds)
            keep = sizes[np.minimum(count, 4095)]
            large = np.flatnonzero(count > 4095)
            keep[large] = [join.region(int(n)) for n in count[large]]
            after = np.cumsum(keep)
            picked = values[np.repeat(bounds[:-1] - after + keep, keep) + np.arange(after[-1] if len(after) else 0)]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("text_key"), pa.array(count.astype(np.int64)),
                pa.array(_signatures(values, bounds)), _pieces(picked, np.concatenate([[0], after])), _fixed(_bitmaps(values, bounds)),
            ], names=["doc_id", "text_key", "n", "node", "region", "bitmap"])

    return _keyed(docs).mapInArrow(task, "doc_id long, text_key long, n long, node long, region binary, bitmap binary")


def whole_sets(docs: DataFrame, nodes: DataFrame, join: Join, column: str = "shingles") -> DataFrame:
    """The whole sets of some classes, from the text of one document of each (``nodes``: node, doc_id, text_key), or only
    their ``cells``.

    Rows that repeat an id and its text give one row."""
    wanted = bounded(nodes.select("node", F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key")), join.max_ids)
    rows = _keyed(docs)
    rows = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_key") == F.col("__key")))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "text"):
            values, bounds = shingle_sets(texts, join.words)
            if column == "cells":
                held = pa.array([_cells(values[low:high]) for low, high in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
            else:
                held = _pieces(values, bounds)
            sizes = pa.array(np.diff(bounds).astype(np.int64))
            yield pa.RecordBatch.from_arrays([part.column("node"), sizes, held], names=["node", "size", column])

    return rows.select("node", "text").mapInArrow(task, f"node long, size long, {column} binary").dropDuplicates(["node"])


def _cells(values: np.ndarray) -> bytes:
    """The set's parity bitmap with at least a cell per shingle."""
    count = max(512, 1 << max(0, len(values) - 1).bit_length())
    odd = np.bincount((mix(values) & np.uint64(count - 1)).astype(np.int64), minlength=count) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _cells_differ(first: bytes, second: bytes) -> int:
    """Cells in which two bitmaps differ: at most |A - B| + |B - A|. The longer one is folded to the other's length,
    as cells of a shorter bitmap are those of a longer one modulo its length."""
    a, b = np.frombuffer(first, np.uint8), np.frombuffer(second, np.uint8)
    size = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(x.reshape(-1, size), axis=0) for x in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def _u64(held: bytes) -> np.ndarray:
    return np.frombuffer(held, "<u8")


def cost_boundary(sizes: dict[int, int], join: Join) -> int:
    """Sets below the boundary list subsets, others go to inverted lists: the boundary with the least rows to handle."""
    def subsets(n: int) -> int:
        return sum(math.comb(n, join.overlap(n, m)) for m in join.partners(n)) + sum(
            math.comb(n, join.overlap(m, n)) for m in range(1, n) if n in join.partners(m))

    def cost(bound: int) -> int:
        return sum(count * (subsets(n) if n < bound else 0) for n, count in sizes.items()) + sum(
            count * join.prefix(n) * join.list_cost for n, count in sizes.items() if 100 * n >= join.percent * bound)

    return min(range(1, join.largest_small + 2), key=lambda bound: (cost(bound), bound))


def subset_links(small: DataFrame, boundary: int, join: Join) -> DataFrame:
    """Links among small classes. A subset is listed per pair of sizes; each of its sets is linked with the smallest
    set of the lower size, which is similar to all of them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, key, low, size = [], [], [], []
            for own, held in zip(batch.column("node").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
                values = _u64(held)
                n = len(values)
                pairs = [(n, m) for m in join.partners(n)] + [(m, n) for m in range(1, n) if n in join.partners(m)]
                for a, b in pairs:
                    if b >= boundary:
                        continue
                    picks = np.array(list(combinations(range(n), join.overlap(a, b))), np.int64)
                    code = np.full(len(picks), np.uint64(a * 64 + b))
                    with np.errstate(over="ignore"):
                        for column in range(picks.shape[1] if len(picks) else 0):
                            code = mix(code * np.uint64(31) + values[picks[:, column]])
                    key.append(code.astype(np.int64))
                    node.append(np.full(len(code), own))
                    low.append(np.full(len(code), a))
                    size.append(np.full(len(code), n))
            joined = [np.concatenate(part) if part else np.zeros(0, np.int64) for part in (node, key, low, size)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)) for part in joined], names=["node", "subset", "low", "n"])

    listed = small.select("node", "shingles").mapInArrow(task, "node long, subset long, low long, n long")
    place = F.when(F.col("n") == F.col("low"), F.col("node"))
    centres = listed.groupBy("subset", "low").agg(F.min(place).alias("centre"), F.count(F.lit(1)).alias("sets"))
    centres = staged(centres.filter("centre is not null and sets > 1"), "subset-centres")
    return listed.join(centres, ["subset", "low"]).filter("node <> centre").select(
        F.col("centre").alias("a"), F.col("node").alias("b")).distinct()


def _region_rows(classes: DataFrame) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                held = b"".join(batch.column("region").slice(low, 2000).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(held, "<i8"))], names=["shingle"])

    return classes.select("region").mapInArrow(tidy(task), "shingle long")


def hot_shingles(shared: DataFrame, join: Join) -> np.ndarray:
    """Shingles in the regions of over ``hot`` classes, sorted: at most ``max_hot``, or the bound rises."""
    counted = shared.filter(F.col("count") > join.hot)
    total = counted.agg(F.count(F.lit(1)), F.sum("count")).first()
    if total[0] > join.max_hot:  # no more than max_hot shingles can be in over total / max_hot classes each
        counted = counted.filter(F.col("count") > total[1] / join.max_hot)
    return np.sort(np.array([row[0] for row in counted.select("shingle").toLocalIterator()], np.int64).view(np.uint64))


def _is_hot(values: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(values), bool)
    place = np.minimum(np.searchsorted(hot, values), len(hot) - 1)
    return hot[place] == values


_LISTED = "shingle long, node long, rank long"


def list_rows(regions: DataFrame, classes: DataFrame, docs: DataFrame, hot: np.ndarray, join: Join) -> tuple[DataFrame, DataFrame]:
    """Per class a row for each shingle of its prefix: of classes whose region suffices, and of those that are mostly hot.
    ``rank`` orders classes: those of the most common content first."""
    shared = classes.sparkSession.sparkContext.broadcast(hot)

    def emit(parts: list[tuple]) -> pa.RecordBatch:
        lengths = [len(part[0]) for part in parts]
        shingles = np.concatenate([part[0] for part in parts]) if parts else np.zeros(0, np.uint64)
        columns = [np.repeat(np.array([part[i] for part in parts], np.int64), lengths) for i in (1, 2)]
        return pa.RecordBatch.from_arrays(
            [pa.array(column.astype(np.int64)) for column in (shingles, *columns)], names=["shingle", "node", "rank"])

    def prefixes(column: str, whole: bool):  # noqa: ANN202 - a task function
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts = []
                for node, n, held in zip(*(batch.column(c).to_pylist() for c in ("node", "n", column)), strict=True):
                    values, prefix = _u64(held), join.prefix(n)
                    is_hot = _is_hot(values, shared.value)
                    rank = 1000 - 1000 * int(is_hot[: join.region(n)].sum()) // join.region(n)
                    first = np.concatenate([values[~is_hot], values[is_hot]])[:prefix]
                    if whole or len(values) == n or len(values) - is_hot.sum() >= prefix:
                        parts.append((first, node, rank))
                    else:  # too few other than hot ones in the region: the mark that the whole set is needed
                        parts.append((np.zeros(1, np.uint64), node, -1))
                    if len(parts) >= 1000:
                        yield emit(parts)
                        parts = []
                yield emit(parts)

        return task

    rows = staged(regions.select("node", "n", "region").mapInArrow(tidy(prefixes("region", whole=False)), _LISTED), "prefixes")
    marked = bounded(staged(rows.filter("rank < 0").select("node"), "mostly-hot"), join.max_ids)
    marked = staged(classes.select("node", "n", "doc_id", "text_key").join(marked, "node"), "mostly-hot-places")
    # written first: two Python steps in one stage would double the Python workers of an executor
    sets = staged(whole_sets(docs, marked, join), "mostly-hot-sets").withColumnRenamed("size", "n")
    more = staged(sets.select("node", "n", "shingles").mapInArrow(tidy(prefixes("shingles", whole=True)), _LISTED), "mostly-hot-prefixes")
    return rows.filter("rank >= 0"), more


def _can_link(a: str, b: str, join: Join) -> Column:
    """Exact bounds: sizes, and cells in which the bitmaps differ."""
    sizes = 100 * F.least(f"{a}.n", f"{b}.n") >= join.percent * F.greatest(f"{a}.n", f"{b}.n")
    room = (100 - join.percent) * (F.col(f"{a}.n") + F.col(f"{b}.n")) / (100 + join.percent)
    differ = sum(
        (F.bit_count(F.col(f"{a}.b{i}").bitwiseXOR(F.col(f"{b}.b{i}"))) for i in range(_BITMAP_LONGS)), F.lit(0))
    return sizes & (differ <= room)


def _longs(bitmap: str) -> list[Column]:
    """The bitmap as longs, which Spark can compare bit by bit."""
    return [F.conv(F.hex(F.substring(bitmap, 8 * i + 1, 8)), 16, -10).cast("long").alias(f"b{i}") for i in range(_BITMAP_LONGS)]


def near_pairs(pairs: DataFrame, cells: DataFrame, join: Join) -> DataFrame:
    """The pairs whose bitmaps do not differ too much: few but similar ones."""
    compact = pairs.join(cells.select(F.col("node").alias("a"), F.col("size").alias("n"), F.col("cells").alias("x")), "a").join(
        cells.select(F.col("node").alias("b"), F.col("size").alias("m"), F.col("cells").alias("y")), "b")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c) for c in ("n", "m", "x", "y"))
            kept = [
                (100 + join.percent) * _cells_differ(x.as_buffer(), y.as_buffer()) <= (100 - join.percent) * (n.as_py() + m.as_py())
                for n, m, x, y in zip(*columns, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return compact.select("a", "b", "n", "m", "x", "y").mapInArrow(tidy(near), "a long, b long").distinct()


def verify(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) that are similar, by their whole sets."""
    rows = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                first, second = _u64(x.as_buffer()), _u64(y.as_buffer())
                place = np.minimum(np.searchsorted(second, first), max(0, len(second) - 1))
                shared = int((second[place] == first).sum()) if len(second) else 0
                kept.append(100 * shared >= join.percent * (len(first) + len(second) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return rows.select("a", "b", "x", "y").mapInArrow(tidy(task), "a long, b long")


def link_classes(docs: DataFrame, classes: DataFrame, regions: DataFrame, join: Join) -> DataFrame:
    """Components over classes: ``node`` and ``root`` of each class that has a link. ``regions`` has node, n and region."""
    sizes = classes.filter(F.col("n") <= 2 * join.largest_small).groupBy("n").count().collect()  # a row per small size
    boundary = cost_boundary({row["n"]: row["count"] for row in sizes}, join)
    small = classes.filter(F.col("n") < boundary)
    small_sets = staged(whole_sets(docs, staged(small.select("node", "doc_id", "text_key"), "small"), join), "small-sets")
    links = subset_links(small_sets, boundary, join)

    listed = regions.filter(100 * F.col("n") >= join.percent * boundary)
    shared = staged(_region_rows(listed).groupBy("shingle").count().filter("count > 1"), "shared-shingles")
    rows, more = list_rows(listed, classes, docs, hot_shingles(shared, join), join)
    # a list of two has a shingle that is in two regions, or one of a mostly hot class
    several = staged(shared.select("shingle").union(more.select("shingle")).distinct(), "list-shingles")
    members = staged(rows.unionByName(more).join(several, "shingle"), "list-members")
    order = F.shiftleft("rank", 52) + F.col("node").bitwiseAND(F.lit((1 << 52) - 1))
    centres = staged(members.groupBy("shingle").agg(F.min_by("node", order).alias("centre"), F.min("rank").alias("rank")), "list-centres")
    nodes = bounded(staged(members.select("node").distinct(), "list-nodes"), join.max_ids)
    facts = staged(classes.select("node", "n", *_longs("bitmap")).join(nodes, "node"), "list-facts")

    # each class tries the first centre of its lists; what that misses is left to the lists' other components below
    first_of = F.shiftleft("rank", 52) + F.col("centre").bitwiseAND(F.lit((1 << 52) - 1))
    tied = members.select("shingle", "node").join(centres, "shingle").groupBy("node").agg(
        F.min_by("centre", first_of).alias("centre")).filter("centre <> node")
    pairs = tied.join(facts.alias("x"), F.col("centre") == F.col("x.node")).join(facts.alias("y"), tied["node"] == F.col("y.node"))
    pairs = staged(pairs.filter(_can_link("x", "y", join)).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")), "star-pairs")
    links = staged(links.unionByName(_verified(docs, classes, pairs, join)), "star-links")
    first = staged(components(links), "star-components")

    # members outside the largest component of their list, against members of all other components
    placed = members.select("shingle", "node").join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = staged(placed, "placed")
    sizes = placed.groupBy("shingle", "root").count()
    largest = sizes.groupBy("shingle").agg(F.max_by("root", "count").alias("main"), F.count(F.lit(1)).alias("roots"))
    largest = staged(largest.filter("roots > 1").select("shingle", "main"), "largest-components")
    mixed = staged(placed.join(largest, "shingle").join(facts, "node"), "mixed-lists")
    outside = mixed.filter("root <> main").alias("x")
    across = outside.join(mixed.alias("y"), (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.root") != F.col("y.root"))
                          & ((F.col("y.root") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))) & _can_link("x", "y", join))
    pairs = staged(across.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "cross-pairs")
    return components(links.unionByName(_verified(docs, classes, pairs, join)))


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, join: Join) -> DataFrame:
    def sets_of(pairs: DataFrame, column: str) -> DataFrame:
        nodes = staged(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "pair-nodes")
        places = staged(classes.select("node", "doc_id", "text_key").join(bounded(nodes, join.max_ids), "node"), "pair-places")
        return staged(whole_sets(docs, places, join, column), f"pair-{column}")

    near = staged(near_pairs(pairs, sets_of(pairs, "cells"), join), "near-pairs")
    return verify(near, sets_of(near, "shingles"), join)


def rooted_rows(docs: DataFrame, join: Join = Join()) -> DataFrame:  # noqa: B008 - frozen
    """Per row its doc_id, ``text_key``, shingles ``n`` and ``root``, which is the same for rows that links reach and does
    not depend on ids; without shingles (``n`` 0) it means nothing."""
    measured = staged(measure(docs, join), "shingle-measures")
    # one row per class: a document that stands for it
    chosen = staged(measured.filter("n > 0").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")), "classes")
    chosen = chosen.select(F.col("node").alias("__node"), F.col("first.doc_id").alias("__doc"), F.col("first.text_key").alias("__key"))
    mine = (F.col("node") == F.col("__node")) & F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_key") == F.col("__key"))
    representatives = measured.join(bounded(chosen, join.max_ids), mine, "left_semi")
    classes = staged(representatives.dropDuplicates(["node"]), "class-measures")
    roots = staged(link_classes(docs, classes.drop("region"), classes.select("node", "n", "region"), join), "components")

    rows = measured.select("doc_id", "text_key", "n", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return staged(rows.select("doc_id", "text_key", "n", "root"), "rooted")


def similar_components(docs: DataFrame, join: Join = Join()) -> DataFrame:  # noqa: B008 - frozen
    """Per row its doc_id, ``n_shingles`` and ``component_id``, the smallest doc_id that links reach; ``text_key`` tells
    rows of one doc_id apart."""
    rows = rooted_rows(docs, join)
    least = staged(rows.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("least")), "component-ids")
    joined = rows.join(least, "root", "left")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "text_key")
