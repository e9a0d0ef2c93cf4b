"""Near duplicates by a chosen-path similarity join over word shingles.

Texts with one set of shingles are a class, and classes are compared once. Every
class walks down random trees: each node chooses one or two of its minwise
tokens, and the class goes to the child of each token's value. Two classes of
similarity s go the same way with chance s a step. The classes of a small node
are compared exhaustively by sketches, and pairs that may be alike are confirmed
on full sets.

That is done twice. The first time a node gives only the pairs that connect what
is alike in it, so a group of n near copies costs about n pairs and not n * n;
large nodes give pairs with a few leaders. The second time every pair between
classes not yet connected is taken, and large nodes walk on until they are small
or all of one component. No link between components is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alambique.llm import shingles as sh
from alambique.llm.batches import batches_of, trimmed
from alambique.llm.components import components
from alambique.llm.text import WORD, whole
from alambique.operators.joins import lookup_join, skew_join
from alambique.storage import Measured, materialize, materialize_measured


@dataclass(frozen=True)
class Settings:
    """``words`` a shingle, links from ``percent`` similarity on. ``trees``,
    ``maybe`` and ``likely`` are set so that a link at the limit is missed with a
    chance of ``miss``, over all that a sketch of ``coords`` may happen to be and
    with the steps of large nodes. Each tree has coordinates of its own for its
    first steps and OWN_STEPS more, and takes any after these; pairs in a node are
    compared by the first ``compared``, and those left by all coordinates."""

    words: int = 2
    percent: int = 80
    miss: float = 1e-5
    coords: int = 192
    compared: int = 64
    node_rows: int = 2048
    leaders: int = 8
    seed: int = 1

    @property
    def limit(self) -> float:
        return self.percent / 100

    def depth(self, classes: int) -> int:
        """Steps before nodes are compared: one more for thirty times the rows,
        as classes that are not alike share a token in thirty at most."""
        return 3 + max(0, math.ceil(math.log(max(classes, 1) / 1e6, 30)))

    @property
    def twice(self) -> tuple[int, int]:
        """One node in so many has two children: in the first steps, and in the
        steps of large nodes, where links have to survive any number of them."""
        return (4, 2) if self.percent >= 80 else (2, 1)

    def _met(self, share: np.ndarray, twice: int, steps: int, met: np.ndarray) -> np.ndarray:
        """Chance to meet after these steps and others that have the chance ``met``."""
        for _ in range(steps):
            one = share * met
            met = (1 - 1 / twice) * one + (1 - (1 - one) ** 2) / twice  # see _choose
        return met

    def missed(self, depth: int, trees: int) -> float:
        """Chance that two classes at the limit meet in no tree, with STEPS steps
        of large nodes, over all shares of equal coordinates of the sketch and of
        each tree."""
        part, (first, later) = self.coords // trees, self.twice
        share = np.arange(self.coords + 1) / self.coords
        own = np.arange(part + 1)[None, :] / part
        met = self._met(share, later, STEPS, np.ones(len(share)))[:, None]
        met = self._met(own, first, depth, self._met(own, later, OWN_STEPS, met))
        alike = np.array([_binomial(part, x) for x in share])
        missed = (1 - (alike * met).sum(axis=1)).clip(0) ** trees
        return float(np.dot(_binomial(self.coords, self.limit), missed))

    def trees(self, depth: int) -> int:
        """Trees that miss a link at the limit in three fifths of ``miss``."""
        low, high = 0, self.coords // 6
        if self.missed(depth, high) > 0.6 * self.miss:
            raise ValueError(f"{self.coords} coordinates are too few for {self.percent} percent")
        while high - low > 1:
            middle = (low + high) // 2
            if self.missed(depth, middle) <= 0.6 * self.miss:
                high = middle
            else:
                low = middle
        return high

    def fitted(self, depth: int) -> Settings:
        """These settings, with as many coordinates as the limit takes."""
        coords = self.coords
        while replace(self, coords=coords).missed(depth, coords // 6) > 0.6 * self.miss:
            coords *= 2
            if coords > MOST_COORDS:
                raise ValueError(f"no sketch of {MOST_COORDS} finds links of {self.percent} percent")
        return replace(self, coords=coords)

    def _least_equal(self, coords: int) -> int:
        """Equal coordinates that a link at the limit falls below in a fifth of
        ``miss``."""
        chances = np.cumsum(_binomial(coords, self.limit))
        return int(np.searchsorted(chances, 0.2 * self.miss, "right"))

    @property
    def maybe(self) -> int:
        return self._least_equal(self.compared)

    @property
    def likely(self) -> int:
        return self._least_equal(self.coords)

    @property
    def clear(self) -> int:
        """Equal coordinates that few pairs below the limit reach."""
        return math.ceil(self.compared * (1 + self.limit) / 2)


#: Steps of large nodes on coordinates of the tree, and further steps that the
#: number of trees allows for.
OWN_STEPS, STEPS = 8, 88

#: Longest sketch that limits far below 80 percent may take.
MOST_COORDS = 1 << 13


def _binomial(n: int, share: float) -> np.ndarray:
    """Chances of 0 to n hits; in logarithms, as the numbers of choices are large."""
    if share in (0, 1):
        return (np.arange(n + 1) == n * share).astype(float)
    log = np.append(0, np.cumsum(np.log(np.arange(1, n + 1))))
    x = np.arange(n + 1)
    return np.exp(log[n] - log - log[::-1] + x * math.log(share) + (n - x) * math.log(1 - share))


def described(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, size ``n``, signature ``sig`` and sketch ``coords`` of each
    row's set, NULL for an empty set, and ``text_hash``."""
    words, seed, coords = settings.words, settings.seed, settings.coords

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        hasher, factors = sh.WordHasher(), sh.factors(coords, seed)
        for batch in batches:
            sizes, sigs, sketches = [], [], []
            for text in batch.column(1):
                own = sh.shingle_set(hasher(text.as_py() or ""), words)
                sizes.append(len(own))
                sigs.append(sh.signature(own) if len(own) else None)
                sketch = sh.sketch(own, factors).astype(np.uint16)
                sketches.append(sketch.tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sigs, pa.int64()),
                 pa.array(sketches, pa.binary()), batch.column(2)],
                ["doc_id", "n", "sig", "coords", "text_hash"],
            )

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), text, F.xxhash64(text))
    return rows.mapInArrow(
        trimmed(run), "doc_id long, n long, sig long, coords binary, text_hash long"
    )


def _choose(
    node: np.ndarray, owner: np.ndarray, coords: np.ndarray, twice: int
) -> tuple:
    """Children of nodes: one chosen coordinate each, a second at one in ``twice``."""
    width = np.uint64(coords.shape[1])
    first = sh.mix(node ^ np.uint64(0x51ED270B)) % width
    step = sh.mix(node ^ np.uint64(0x2545F491)) % (width - np.uint64(1)) + np.uint64(1)
    more = sh.mix(node ^ np.uint64(0x632BE59B)) % np.uint64(twice) == 0
    nodes = np.concatenate([node, node[more]])
    owners = np.concatenate([owner, owner[more]])
    chosen = np.concatenate([first, ((first + step) % width)[more]])
    value = coords[owners, chosen.astype(np.int64)].astype(np.uint64)
    return sh.mix(sh.mix(nodes + chosen) + value), owners


def _walk(
    node: np.ndarray, owner: np.ndarray, coords: np.ndarray, depth: int, twice: int
) -> tuple:
    for _ in range(depth):
        node, owner = _choose(node, owner, coords, twice)
    return node, owner


def _matrix(column: pa.Array, dtype: type = np.uint8) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype).reshape(len(column), -1)


def _binary(rows: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(rows)
    return pa.array([r.tobytes() for r in flat], pa.binary())


def _paths(
    classes: DataFrame, depth: int, trees: int, payload: str, settings: Settings
) -> DataFrame:
    """``node``, ``cls`` and ``label`` of each class at the end of its paths.

    ``payload`` is nothing, the low bytes of the coordinates compared (``sketch``)
    or the coordinates of the node's tree and all coordinates (``walk``).
    """
    compared, twice = settings.compared, settings.twice[0]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        roots = sh.mix(np.arange(1, trees + 1, dtype=np.uint64))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                coords, n = _matrix(part.column(2), np.uint16), part.num_rows
                width = coords.shape[1] // trees
                own = coords[:, : width * trees].reshape(n, trees, width)
                own = own.transpose(1, 0, 2).reshape(n * trees, width)  # a row a tree and class
                node, row = _walk(np.repeat(roots, n), np.arange(n * trees), own, depth, twice)
                taken = pa.array(row % n)
                columns = [pa.array(node.view(np.int64))]
                columns += [part.column(0).take(taken), part.column(1).take(taken)]
                if payload:
                    if payload == "walk":
                        held = _binary(np.hstack([own[row], coords[row % n]]))
                    else:
                        held = _binary(coords[:, :compared].astype(np.uint8)).take(taken)
                    columns.append(held)
                names = ["node", "cls", "label", "payload"]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    extra = ", payload binary" if payload else ""
    rows = classes.select("sig", "label", "coords")
    return rows.mapInArrow(trimmed(run), "node long, cls long, label long" + extra)


def _compare_nodes(
    rows: DataFrame, settings: Settings, grouped: bool, width: int = 1
) -> DataFrame:
    """Classes of different labels that may be alike in one node.

    All classes of a node are compared, at each distance in turn, by the ``width``
    bytes that ``payload`` has of each coordinate. The result has the pairs that
    connect what is alike in a node, or, ``grouped``, the classes by what is so
    connected: ``node`` is then a hash of the group's classes, so that a group
    found in several nodes comes as equal rows.
    """
    kind = np.dtype(f"u{width}")
    maybe = settings.maybe if width == 1 else settings.likely
    clear = settings.clear

    def pairs(node, cls, label, held) -> pa.RecordBatch:
        left, right, score = [], [], []
        root = np.arange(len(node), dtype=np.int32)
        for apart in range(1, len(node)):
            same = node[:-apart] == node[apart:]
            if not same.any():
                break
            open_ = same & (label[:-apart] != label[apart:])
            if grouped:
                # What is connected already needs no further pair.
                open_ &= root[:-apart] != root[apart:]
            other = np.flatnonzero(open_).astype(np.int32)
            for at in range(0, len(other), CHUNK):
                i = other[at : at + CHUNK]
                equal = (held[i] == held[i + apart]).sum(axis=1, dtype=np.int16)
                found = i[equal >= maybe]
                if grouped:
                    root = _joined(root, found, found + apart)
                    continue
                left.append(found)
                right.append(found + apart)
                score.append(equal[equal >= maybe])
        if grouped:
            at, group = _named(root, cls)
            columns = [pa.array(x) for x in (group, cls[at], label[at])]
            return pa.RecordBatch.from_arrays(columns, ["node", "cls", "label"])
        if not left:
            return _pairs([], [])
        a, b, equal = map(np.concatenate, (left, right, score))
        del left, right, score
        keep = _connecting(node, a, b, equal, clear)
        return _pairs(cls[a[keep]], cls[b[keep]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            now = [batch.column(i).to_numpy() for i in range(3)]
            now.append(_matrix(batch.column(3), kind))
            if rest is not None and len(rest[0]):
                now = [np.concatenate(x) for x in zip(rest, now)] if len(now[0]) else rest
            if not len(now[0]):
                continue
            # The last node may go on in the next batch.
            end = int(np.searchsorted(now[0], now[0][-1]))
            for start, stop in _stretches(now[0][:end]):
                yield pairs(*(x[start:stop] for x in now))
            rest = [x[end:].copy() for x in now]
        if rest is not None:
            yield pairs(*rest)

    dealt = rows.repartition("node").sortWithinPartitions("node", "cls")
    result = "node long, cls long, label long" if grouped else "a long, b long"
    return dealt.mapInArrow(trimmed(run), result)


#: Pairs that are compared at once, and that the nodes looked at together may have
#: beyond those of one node.
CHUNK, TOGETHER = 1 << 14, 1 << 18


def _stretches(node: np.ndarray) -> Iterator[tuple[int, int]]:
    """Beginnings and ends of stretches of whole nodes with few pairs."""
    edges = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else []
    start, held = 0, 0
    for at, end in zip(edges, [*edges[1:], len(node)]):
        held += int(end - at) ** 2 // 2
        if held > TOGETHER:
            yield start, int(end)
            start, held = int(end), 0
    if start < len(node):
        yield start, len(node)


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each row's group, once ``a`` and ``b`` are connected."""
    while len(a):
        low = np.minimum(root[a], root[b])
        for ends in (a, b):
            np.minimum.at(root, root[ends], low)
        while not (root == root[root]).all():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _named(root: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows in groups of several, and a hash of each one's group."""
    sizes = np.bincount(root, minlength=len(root))
    at = np.flatnonzero(sizes[root] > 1)
    named = np.zeros(len(root), np.uint64)
    np.add.at(named, root[at], sh.mix(cls[at].view(np.uint64)))
    return at, sh.mix(named)[root[at]].view(np.int64)


def _cut(rows: DataFrame, size: Column, most: int) -> DataFrame:
    """Rows with ``side`` and a ``node`` of their own for each two parts of nodes
    whose ``size`` adds up to more than ``most``; other nodes have one part, of side
    0. Classes of two parts meet in the node of these, on different sides."""
    sizes = rows.groupBy("node").agg(F.sum(size).alias("size")).filter(F.col("size") > most)
    parts = sizes.select("node", F.ceil(F.col("size") / most).cast("int").alias("parts"))
    parts = materialize_measured(parts, "cut-nodes")
    if not parts.rows:
        return rows.withColumn("side", F.lit(0))
    joined = lookup_join(rows, parts, "node", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("__other")
    spread = joined.withColumn("__own", own).select("*", other)
    low, high = F.least("__own", "__other"), F.greatest("__own", "__other")
    return spread.withColumns(
        {
            "node": F.when(F.col("parts") > 1, F.xxhash64("node", low, high)).otherwise(F.col("node")),
            # The node of one part with itself has all its rows on side 0.
            "side": (F.col("__own") > F.col("__other")).cast("int"),
            "both": F.col("__own") != F.col("__other"),
        }
    ).drop("parts", "__own", "__other", "both")


def _confirm_nodes(rows: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links between different labels within each node, by full sets (``sig``, ``n``,
    ``coords`` and ``shingles``).

    A node's classes are compared until their labels are connected: what is left
    out would connect nothing. Nodes of more than SETS sets, or SET_BYTES, are cut, so
    a task holds two parts at most.
    """
    likely, percent = settings.likely, settings.percent

    def links(label, cls, side, held, own) -> list[tuple[int, int]]:
        sizes = np.array([len(x) for x in own])
        starts = np.cumsum(sizes) - sizes
        # Shingles as small numbers, so that a set is held against all others at once.
        _, every = np.unique(np.concatenate(own), return_inverse=True)
        every = every.astype(np.int32)
        mine = np.zeros(int(every.max()) + 1, bool)
        two = len(np.unique(side)) > 1
        _, group, counts = np.unique(label, return_inverse=True, return_counts=True)
        found = []
        done = np.zeros(len(cls), bool)
        # Labels with few classes first: each is held against all the others.
        for i in np.lexsort((cls, counts[group])).tolist():
            done[i] = True
            open_ = ~done & (group != group[i])
            if two:
                open_ &= side != side[i]
            other = np.flatnonzero(open_)
            other = other[(held[other] == held[i]).sum(axis=1) >= likely]
            if not len(other):
                continue
            shingles = every[starts[i] : starts[i] + sizes[i]]
            mine[shingles] = True
            shared = np.add.reduceat(mine[every], starts, dtype=np.int32)[other]
            mine[shingles] = False
            linked = 100 * shared >= percent * (sizes[i] + sizes[other] - shared)
            for j in other[linked].tolist():
                if group[i] != group[j]:
                    group[group == group[j]] = group[i]
                    found.append((int(cls[i]), int(cls[j])))
        return found

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if rest is None else pa.concat_tables([rest, now])
            if not now.num_rows:
                continue
            node = now.column("node").to_numpy()
            end = int(np.searchsorted(node, node[-1]))
            yield from nodes(now.slice(0, end))
            rest = now.slice(end)
        if rest is not None:
            yield from nodes(rest)

    def nodes(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        node = table.column("node").to_numpy()
        edges = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        pairs = []
        for start, end in zip(edges, [*edges[1:], len(node)]):
            part = table.slice(start, end - start)
            # The sets are read where Arrow holds them.
            own = [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column("shingles")]
            names = [part.column(c).to_numpy() for c in ("label", "cls", "side")]
            pairs += links(*names, _matrix(part.column("coords"), np.uint16), own)
        yield _pairs([a for a, _ in pairs], [b for _, b in pairs])

    sized = lookup_join(rows, sets.select(F.col("sig").alias("cls"), "n"), "cls", "inner")
    size = F.greatest(F.col("n") * 8, F.lit(SET_BYTES // SETS))
    parts = _cut(sized, size, SET_BYTES).select("node", "cls", "label", "side")
    full = sets.select(F.col("sig").alias("cls"), "coords", "shingles")
    joined = skew_join(materialize(parts, "cut-rows"), full, ["cls"], "inner")
    dealt = joined.select("node", "cls", "label", "side", "coords", "shingles").repartition("node")
    return dealt.sortWithinPartitions("node", "cls").mapInArrow(trimmed(run), "a long, b long")


#: Bytes and number of the full sets of a node's part, and rows and bytes that a task
#: is handed at once.
SET_BYTES, SETS, BATCH, HANDED = 12 << 20, 1024, 2000, 2 << 20


def _pairs(a: Iterable[int], b: Iterable[int]) -> pa.RecordBatch:
    low, high = np.minimum(a, b), np.maximum(a, b)
    columns = [pa.array(np.asarray(x, np.int64)) for x in (low, high)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


#: Pairs of a row that a node gives in the first pass, besides those that connect it.
NEAREST = 12


def _connecting(
    node: np.ndarray, a: np.ndarray, b: np.ndarray, equal: np.ndarray, clear: int
) -> np.ndarray:
    """Pairs that connect what is alike in each node.

    They are a spanning forest of the most alike, all pairs of the row that is
    most alike to the others, and the NEAREST pairs of each row that is not
    clearly alike to that one.
    """
    order = np.lexsort((b, a, -equal, node[a])).astype(np.int32)
    of = node[a[order]]
    edges = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    kept = []
    for start, end in zip(edges, [*edges[1:], len(of)]):
        own = order[start:end]
        if len(own) < 3:
            kept.append(own)
            continue
        least = a[own].min()
        left, right, rows = a[own] - least, b[own] - least, b[own].max() - least + 1
        mass = np.bincount(left, equal[own], rows) + np.bincount(right, equal[own], rows)
        center = mass.argmax()
        star = (left == center) | (right == center)
        kept.append(own[star])
        near = np.zeros(rows, np.int64)
        near[left[star]] = near[right[star]] = equal[own[star]]
        weak = near < clear
        weak[center] = False
        kept.append(own[_nearest(left, right, weak)])
        kept.append(own[_forest(left.tolist(), right.tolist(), rows)])
    return np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.int64)


def _nearest(left: np.ndarray, right: np.ndarray, weak: np.ndarray) -> np.ndarray:
    """Places of the first NEAREST edges, in their order, of each weak row."""
    row = np.concatenate([left, right])
    edge = np.tile(np.arange(len(left)), 2)
    order = np.lexsort((edge, row))
    row, edge = row[order], edge[order]
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    place = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
    return np.unique(edge[(place < NEAREST) & weak[row]])


def _forest(left: list[int], right: list[int], rows: int) -> list[int]:
    """Places of the edges, in their order, that join two trees."""
    root, kept = list(range(rows)), []
    for i, (x, y) in enumerate(zip(left, right)):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append(i)
            if len(kept) == rows - 1:
                break
    return kept


def _leader_pairs(rows: DataFrame, settings: Settings) -> DataFrame:
    """Pairs of the classes of large nodes with their most alike leader.

    Leaders are drawn by a hash of the class alone, so that one group has much
    the same leaders in all its nodes.
    """
    n, maybe = settings.leaders, settings.maybe
    drawn = [
        F.min(F.struct(F.xxhash64("cls", F.lit(r)).alias("o"), "cls", "payload")).alias(f"l{r}")
        for r in range(n)
    ]
    leaders = rows.groupBy("node").agg(*drawn)
    listed = leaders.select(
        "node",
        *[F.col(f"l{r}.cls").alias(f"c{r}") for r in range(n)],
        *[F.col(f"l{r}.payload").alias(f"p{r}") for r in range(n)],
    )
    joined = lookup_join(rows.select("node", "cls", "payload"), listed, "node", "inner")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = batch.schema.get_field_index
            if not batch.num_rows:
                continue
            cls, own = batch.column(get("cls")).to_numpy(), _matrix(batch.column(get("payload")))
            names = np.stack([batch.column(get(f"c{r}")).to_numpy() for r in range(n)])
            equal = np.stack(
                [
                    (own == _matrix(batch.column(get(f"p{r}")))).sum(axis=1)
                    for r in range(n)
                ]
            )
            equal[names == cls] = -1
            best, at = equal.argmax(axis=0), np.arange(len(cls))
            alike = equal[best, at] >= maybe
            yield _pairs(cls[alike], names[best, at][alike])

    return joined.mapInArrow(trimmed(run), "a long, b long")


def _one_step(rows: DataFrame, steps: int, settings: Settings, own: bool) -> DataFrame:
    """Rows that take more steps down their trees, see ``Settings.twice``, on
    coordinates of the tree or on any; ``low`` is what they are compared by."""
    whole, twice, compared = settings.coords, settings.twice[1], settings.compared

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for batch in batches:
            if not batch.num_rows:
                continue
            held = _matrix(batch.column(3), np.uint16)
            coords = held[:, :-whole] if own else held[:, -whole:]
            low = _binary(held[:, -whole:][:, :compared].astype(np.uint8))
            node = batch.column(0).to_numpy().view(np.uint64)
            child, owner = _walk(node, np.arange(len(node)), coords, steps, twice)
            taken = pa.array(owner)
            columns = [x.take(taken) for x in (*(batch.column(i) for i in (1, 2, 3)), low)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(child.view(np.int64)), *columns],
                ["node", "cls", "label", "payload", "low"],
            )

    return rows.select("node", "cls", "label", "payload").mapInArrow(
        trimmed(run), "node long, cls long, label long, payload binary, low binary"
    )


def _compared(rows: DataFrame) -> DataFrame:
    """Rows of ``walk`` as rows of ``sketch``."""
    return rows.select("node", "cls", "label", F.col("low").alias("payload"))


def _heavy(rows: DataFrame, settings: Settings) -> Measured:
    """Nodes with more rows than may be compared at once, and not of one label."""
    sizes = rows.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    large = sizes.filter((F.col("n") > settings.node_rows) & (F.col("low") < F.col("high")))
    return materialize_measured(large.select("node"), "heavy-nodes")


#: Rounds of two steps, after which large nodes are compared two parts at a time, and
#: rows of a part of other large nodes and groups.
ROUNDS, DENSE_ROWS = 48, 1 << 15


def first_pairs(classes: DataFrame, settings: Settings) -> DataFrame:
    """Pairs ``a < b`` of classes (``sig``, ``label``, ``coords``) that connect
    what may be alike in each node; with leaders in large nodes. Half the trees are
    enough here: ``open_rows`` finds in all of them what is not connected yet."""
    depth, trees, heavy = _shape(classes, settings, 2)
    light = lookup_join(_paths(classes, depth, trees, "sketch", settings), heavy, "node", "left_anti")
    found = _compare_nodes(light, settings, grouped=False)
    if heavy.rows:
        paths = _paths(classes, depth, trees, "sketch", settings)
        rows = lookup_join(paths, heavy, "node", "left_semi")
        found = found.union(_leader_pairs(materialize(rows, "heavy-rows"), settings))
    return materialize(found.distinct(), "first-pairs")


def open_rows(classes: DataFrame, settings: Settings) -> DataFrame:
    """``node``, ``cls`` and ``label`` of classes that may be linked though their
    labels differ; a node is a group of such classes.

    Large nodes walk on until they are small; those of one label are done. Groups
    found in several trees are one, see ``_merged``. They are compared again by all
    coordinates.
    """
    depth, trees, heavy = _shape(classes, settings)
    light = lookup_join(_paths(classes, depth, trees, "sketch", settings), heavy, "node", "left_anti")
    found = _compare_nodes(light, settings, grouped=True)
    if heavy.rows:
        paths = _paths(classes, depth, trees, "walk", settings)
        rows = lookup_join(paths, heavy, "node", "left_semi")
        found = reduce(DataFrame.union, _walk_on(rows, settings), found)
    found = _merged(materialize(found.distinct(), "open-groups"))
    found = _cut(found, F.lit(1), DENSE_ROWS).select("node", "cls", "label")
    named = materialize_measured(found.select(F.col("cls").alias("sig")).distinct(), "open-classes")
    coords = lookup_join(classes.select("sig", "coords"), named, "sig", "left_semi")
    coords = coords.select(F.col("sig").alias("cls"), F.col("coords").alias("payload"))
    whole_ = lookup_join(found, coords, "cls", "inner").select("node", "cls", "label", "payload")
    return materialize(
        _compare_nodes(whole_, settings, grouped=True, width=2).distinct(), "open-rows"
    )


def _merged(groups: DataFrame) -> DataFrame:
    """Groups that share classes as one, where this has no more pairs than they have.

    Classes that are much alike meet in most trees, with others each time; merged, a
    class of theirs is in one group and a pair is compared once.
    """
    links = groups.select(F.col("node").alias("a"), F.col("cls").alias("b"))
    wholes = components(links).select("node", F.col("label").alias("whole"))
    named = lookup_join(groups, wholes, "node", "left").withColumn("whole", F.coalesce("whole", "node"))
    named = materialize(named, "whole-groups")
    pairs = F.col("n").cast("double") * F.col("n")
    apart = named.groupBy("whole", "node").agg(F.count(F.lit(1)).alias("n"))
    apart = apart.groupBy("whole").agg(F.sum(pairs).alias("apart"))
    distinct = named.select(F.col("whole").alias("node"), "cls", "label").distinct()
    sizes = distinct.groupBy(F.col("node").alias("whole")).agg(F.count(F.lit(1)).alias("n"))
    large = sizes.join(apart, "whole").filter(pairs > F.col("apart")).select("whole")
    large = materialize_measured(large, "large-wholes")
    kept = lookup_join(named, large, "whole", "left_semi").select("node", "cls", "label")
    large = Measured(large.df.withColumnRenamed("whole", "node"), large.rows, large.size)
    merged = lookup_join(distinct, large, "node", "left_anti")
    return materialize(merged.union(kept), "merged-groups")


def _shape(
    classes: DataFrame, settings: Settings, one_in: int = 1
) -> tuple[int, int, Measured]:
    """Depth and number of the trees, or of one in so many, and their large nodes."""
    depth = settings.depth(classes.count())
    trees = -(-settings.trees(depth) // one_in)
    return depth, trees, _heavy(_paths(classes, depth, trees, "", settings), settings)


def _walk_on(rows: DataFrame, settings: Settings) -> list[DataFrame]:
    found = []
    rows = materialize(_one_step(rows, 0, settings, False), "heavy-steps")
    for n in range(ROUNDS):
        mixed = _mixed(rows, settings)
        dense = _cut(_compared(lookup_join(rows, mixed, "node", "left_anti")), F.lit(1), DENSE_ROWS)
        dense = dense.select("node", "cls", "label", "payload")
        found.append(_compare_nodes(dense, settings, grouped=True))
        if not mixed.rows:
            return found
        rows = lookup_join(rows, mixed, "node", "left_semi")
        rows = materialize(_one_step(rows, 2, settings, 2 * n < OWN_STEPS), "heavy-steps")
        heavy = _heavy(rows, settings)
        light = lookup_join(rows, heavy, "node", "left_anti")
        found.append(_compare_nodes(_compared(light), settings, grouped=True))
        if not heavy.rows:
            return found
        rows = lookup_join(rows, heavy, "node", "left_semi")
    parts = _cut(_compared(rows), F.lit(1), settings.node_rows // 2)
    parts = parts.select("node", "cls", "label", "payload")
    return [*found, _compare_nodes(parts, settings, grouped=True)]


def _mixed(rows: DataFrame, settings: Settings) -> Measured:
    """Nodes in which a row may differ in label from more rows than may be compared.

    Other large nodes have one label, but for a few rows. Their classes are much alike
    and would stay together for many steps, in ever more nodes.
    """
    labels = rows.groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = labels.groupBy("node").agg((F.sum("n") - F.max("n")).alias("others"))
    return materialize_measured(
        sizes.filter(F.col("others") >= settings.node_rows).select("node"), "mixed-nodes"
    )


def confirmed(pairs: DataFrame, sets: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The pairs that are linked by their full sets (``sig``, ``shingles``)."""
    percent = settings.percent
    one = sets.select(F.col("sig").alias("a"), F.col("shingles").alias("of_a"))
    other = sets.select(F.col("sig").alias("b"), F.col("shingles").alias("of_b"))
    both = skew_join(skew_join(pairs, one, ["a"], "inner"), other, ["b"], "inner")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                one, other = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(one, other, assume_unique=True))
                linked.append(100 * common >= percent * (len(one) + len(other) - common))
            mask = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"]
            )

    return both.select("a", "b", "of_a", "of_b").mapInArrow(trimmed(run), "a long, b long")


def _full_sets(
    docs: DataFrame, named: DataFrame, ends: DataFrame, settings: Settings
) -> DataFrame:
    """``sig`` and ``shingles`` of the classes in ``ends``, from one text of each,
    with ``n`` and ``coords``.

    ``named`` has the ``first`` document of each class, and those two.
    """
    words = settings.words
    sigs = materialize_measured(ends.distinct(), "ends")
    ids = lookup_join(named, sigs, "sig", "left_semi").filter(F.col("first").isNotNull())
    ids = ids.select(F.col("first").alias("doc_id")).distinct()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        hasher = sh.WordHasher()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                sets = [
                    sh.shingle_set(hasher(t.as_py() or ""), words)
                    for t in batch.column(0).slice(at, 64)
                ]
                sets = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([sh.signature(s) for s in sets], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["sig", "shingles"],
                )

    texts = lookup_join(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        ids,
        "doc_id",
        "left_semi",
    ).select("text")
    read = texts.mapInArrow(trimmed(run), "sig long, shingles binary")
    # Rows that share an id may have other texts, or the same one again.
    own = lookup_join(read, sigs, "sig", "left_semi").dropDuplicates(["sig"])
    described_ = lookup_join(named.select("sig", "n", "coords"), sigs, "sig", "left_semi")
    return materialize(lookup_join(own, described_, "sig", "inner"), "full-sets")


def _labels(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("node").alias("sig"), "label")


def _placed(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id, n, sig, text_hash`` of each row, and ``label`` and
    ``component_id`` of its component."""
    settings = settings.fitted(settings.depth(docs.count()))
    # All Python runs in jobs within: what is left is a join of stored tables.
    with batches_of(docs.sparkSession, BATCH, HANDED):
        rows, classes, labels = _found(docs, settings)
    label = F.coalesce("label", "sig")
    named = classes.select("sig", "first")
    grouped = lookup_join(named, labels, "sig", "left").withColumn("label", label)
    least = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    placed = lookup_join(grouped, least, "label", "inner").select("sig", "label", "component_id")
    return lookup_join(rows.select("doc_id", "n", "sig", "text_hash"), placed, "sig", "left")


def _found(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored rows and classes, and the labels of the classes that are linked."""
    rows = materialize(described(docs, settings), "shingle-sets")
    classes = materialize(
        rows.filter(F.col("sig").isNotNull())
        .groupBy("sig")
        .agg(F.min("doc_id").alias("first"), F.max("n").alias("n"), F.max("coords").alias("coords")),
        "shingle-classes",
    )
    named = classes.select("sig", "first", "n", "coords")
    alone = classes.withColumn("label", F.col("sig"))
    pairs = first_pairs(alone, settings)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("sig"))
    sets = _full_sets(docs, named, ends, settings)
    links = materialize(confirmed(pairs, sets, settings), "links")
    labels = _labels(links)
    known = lookup_join(classes, labels, "sig", "left").withColumn(
        "label", F.coalesce("label", "sig")
    )
    known = materialize(known, "labelled-classes")
    rest = open_rows(known, settings)
    sets = _full_sets(docs, named, rest.select(F.col("cls").alias("sig")), settings)
    more = materialize(_confirm_nodes(rest, sets, settings), "more-links")
    return rows, classes, _labels(links.union(more))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Component of each document: ``doc_id, n_shingles, component_id, kept``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A row for
    each row. The component's id is the smallest id of its documents, and the
    document with that id is kept. NULL and empty texts, and those without a
    word, have no shingles and are linked with nothing. Rows that repeat are
    linked by their texts like any other. A row with a NULL id belongs to the
    component of its text but never stands for it. An empty table gives no rows.
    """
    return _placed(docs, settings).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias(
            "component_id"
        ),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def deduplicated(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One document of each component, with the columns of ``docs``.

    It is the one with the smallest id, of those with one id the one whose text has
    the smallest hash, of equal ones any. Only what is linked goes: texts that share
    an id, have none, or have no word stay unless they are linked with another. An
    empty table gives no rows; other columns stay as they are, whatever their names.
    """
    found = _placed(docs.select("doc_id", "text"), settings).filter(F.col("sig").isNotNull())
    keys = ["__near_id", "__near_hash"]
    id_ = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias(keys[0])
    counts = found.groupBy("label", "doc_id", F.col("text_hash").alias(keys[1])).agg(
        F.count(F.lit(1)).alias("n")
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", keys[1])
    best = counts.groupBy("label").agg(F.min_by(F.struct("doc_id", keys[1], "n"), order).alias("best"))
    kept = materialize(best.select("best.*").select(id_, keys[1], "n"), "kept-documents")
    text = F.col("text").cast("string")
    hashed = docs.select("*", id_, F.xxhash64(text).alias(keys[1]))
    worded = hashed.filter(whole(text).rlike(WORD))
    one = lookup_join(worded, kept.filter("n = 1").select(*keys), keys, "left_semi")
    several = materialize_measured(kept.filter("n > 1").select(*keys), "repeated-documents")
    # Rows that repeat are combined where they are read, however many there are.
    repeated = lookup_join(worded, several, keys, "left_semi").groupBy(*keys).agg(
        F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row")
    )
    blank = hashed.filter(~whole(text).rlike(WORD))
    parts = [x.select(*[F.col(f"`{c}`") for c in docs.columns]) for x in (one, repeated.select("row.*"), blank)]
    return reduce(DataFrame.union, parts)
