"""Near-duplicate documents by chosen-path similarity join over minwise tokens.

A document is the set of its word shingles. ``COORDINATES`` minwise hashes stand
for the set: two sets agree in a coordinate with the probability of their
Jaccard similarity. Documents with the same set are one class, and one text of each
class enters the join; ids play no part in it.

A tree splits the documents by the value of a coordinate that the node chooses;
independent trees start from different coordinates. Members that are already
linked need no comparison with each other: a node whose members share one
component is finished, and a node is small if at most ``SMALL`` members are
outside its largest component. Small nodes are compared exhaustively, the
members outside with all members. A larger node compares its members with its
smallest, and then branches ``BRANCHES`` times, each time by ``TAKEN`` further
coordinates it chooses. A large group of copies thus ends after a star of
comparisons and some for each stranger in its node, instead of all pairs. After
``DEPTH`` levels the nodes that are left are compared exhaustively. Trees are
independent, and there are as many as the target recall asks (``trees_for``).

Nodes are compared inside tasks, blocks of members against blocks, on set sizes
and 2-bit sketches that similar sets have (a pair at the threshold fails the
sketch with a probability of about 1e-7). What leaves a task is linear in its
members: the candidate pairs, if they are no more than the members, or else the
members that have a candidate. Every link is confirmed on the full shingle sets.
Pairs are confirmed once, whatever number of nodes they meet in; members of a
dense block meet again in one task with their texts, which gives one link for each
two components that it connects. Each level ends with one merge of the components.

Defined cases: null or wordless texts have an empty set and are linked with
nothing; shorter texts than a shingle are one shingle, the whole sequence;
null keys take no part in linking (component null, kept); rows that repeat a key
are documents of their own, linked by their texts alone; an empty table gives
an empty result; texts of any length count whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.llm.batches import list_array, ragged, released, slices, texts
from paysignal.llm.components import components
from paysignal.llm.scratch import Scratch
from paysignal.llm.words import hash_words, mix64

COORDINATES = 64
#: Of the pairs at the threshold, the share that some tree shall bring together in a node that is compared exhaustively.
RECALL = 0.9995
SMALL = 256
DEPTH = 3
#: A branch takes so many further coordinates at once, and a node so many branches: about (1 / 0.8) ** 3, so that a level makes no more members than the one above.
TAKEN, BRANCHES = 3, 2
#: Members of a block on either side, and shingles that a block with texts holds at most.
ONES, ALLS, SHINGLES = 512, 2048, 4_000_000
#: Coordinates (of 64) in which the 2-bit sketches of a candidate pair may differ.
MOST_APART = 26
#: Candidate keys up to this number (8 bytes each) are broadcast to pick their texts; more are joined by shuffle.
BROADCAST_KEYS = 400_000
#: Pairs that are confirmed together, on average.
GROUP = 1000
#: Pairs of a group that are looked at together; more would only take memory.
AT_ONCE = 1 << 17
#: From so many pairs of two blocks on, intersections come from a product of matrices of so many columns.
MATRIX, COLUMNS = 64, 8192
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TIMES = mix64(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_PLUS = mix64(np.arange(1001, COORDINATES + 1001, dtype=np.uint64))


def trees_for(recall: float, similarity: float, depth: int = DEPTH) -> int:
    """How many trees bring a pair of ``similarity`` together with a probability of ``recall``, if all nodes above the last level are large."""
    meets = 1.0
    for _ in range(depth - 1):
        meets = 1 - (1 - similarity**TAKEN * meets) ** BRANCHES
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity * meets)))


def shingles(raws: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every shingle, shingles per text), repeats included."""
    h, counts, _ = hash_words(raws)
    first = np.cumsum(counts) - counts
    rolled = h[: max(0, len(h) - words + 1)].copy()
    for j in range(1, words):
        rolled = rolled * _ODD + h[j : j + len(rolled)]
    lengths = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    out = np.empty(int(lengths.sum()), dtype=np.uint64)
    at = np.cumsum(lengths) - lengths
    full = counts >= words
    out[ragged(at[full], lengths[full])] = rolled[ragged(first[full], lengths[full])]
    for i in np.flatnonzero((counts > 0) & ~full):
        acc = np.uint64(counts[i])
        with np.errstate(over="ignore"):
            for x in h[first[i] : first[i] + counts[i]]:
                acc = acc * _ODD + x
        out[at[i]] = acc
    return mix64(out), lengths


def sets(raws: list[bytes], words: int) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted."""
    flat, lengths = shingles(raws, words)
    return [np.unique(x) for x in np.split(flat, np.cumsum(lengths)[:-1])] if raws else []


def signatures(df: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``key, tid`` (of the text), ``n, digest`` (of the set), ``sig`` (minwise values) and the sketch planes ``s0, s1``; null beside n = 0."""
    schema = T.StructType(
        [
            T.StructField("key", df.schema[key].dataType),
            T.StructField("tid", T.BinaryType()),
            T.StructField("n", T.LongType(), False),
            T.StructField("digest", T.BinaryType()),
            T.StructField("sig", T.ArrayType(T.IntegerType(), False)),
            T.StructField("s0", T.LongType()),
            T.StructField("s1", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.uint64(1) << np.arange(COORDINATES, dtype=np.uint64)
        for batch in batches:
            for part in slices(batch, limit=1 << 20):
                flat, lengths = shingles(texts(part), words)
                some = np.flatnonzero(lengths)
                starts = (np.cumsum(lengths) - lengths)[some]
                sig = np.zeros((len(some), COORDINATES), dtype=np.uint32)
                if len(some):
                    for i in range(COORDINATES):
                        hashed = ((flat * _TIMES[i] + _PLUS[i]) >> np.uint64(32)).astype(np.uint32)
                        sig[:, i] = np.minimum.reduceat(hashed, starts)
                bits = mix64(sig.astype(np.uint64) + _PLUS)
                planes = [((bits >> np.uint64(p)) & np.uint64(1)) @ weights for p in (0, 1)]
                n = np.zeros(len(lengths), dtype=np.int64)
                digest: list[bytes | None] = [None] * len(lengths)
                for i, at in zip(some, starts, strict=True):
                    own = np.unique(flat[at : at + lengths[i]])
                    n[i] = len(own)
                    digest[i] = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                place = np.full(len(lengths), len(some))
                place[some] = np.arange(len(some))
                take = pa.array(place, mask=place == len(some))
                values = list_array(sig.view(np.int32).ravel(), np.full(len(some), COORDINATES), pa.int32())
                columns = [part.column(0), part.column(1), pa.array(n), pa.array(digest, type=pa.binary()), values.take(take)]
                columns += [pa.array(p.astype(np.uint64).view(np.int64)).take(take) for p in planes]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(F.col(key).alias("key"), text_id(text).alias("tid"), F.col(text).alias("text")).mapInArrow(released(run), schema)


def text_id(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def intersections(left: list[np.ndarray], right: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of ``left[x]`` and ``right[y]`` (distinct, sorted values)."""
    if len(x) < MATRIX:
        return np.array([len(np.intersect1d(left[i], right[j], assume_unique=True)) for i, j in zip(x, y, strict=True)], dtype=np.int64)
    # Many pairs of few sets: incidence matrices over the values that both sides hold.
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, len(both), COLUMNS):
        part = both[at : at + COLUMNS]
        sides = []
        for side in (left, right):
            m = np.zeros((len(side), len(part)), dtype=np.float32)
            for i, own in enumerate(side):
                m[i, np.searchsorted(part, own[np.isin(own, part, assume_unique=True)])] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out[x, y].astype(np.int64)


def confirmed(pairs: pa.Table, docs: pa.Table, words: int, least: tuple[int, int]) -> pa.Table:
    """The labels of the pairs whose sets are similar: least[0] * union <= least[1] * intersection."""
    keys = docs["key"].to_pylist()
    place = {k: i for i, k in enumerate(keys)}
    own: list[np.ndarray] = []
    for batch in docs.to_batches():
        for part in slices(batch):
            own.extend(sets(texts(part), words))
    a, b = (np.array([place[k] for k in pairs[c].to_pylist()], dtype=np.int64) for c in ("a", "b"))
    block = pairs["blocks"].to_numpy()
    size = np.array([len(s) for s in own])
    keep = np.zeros(len(a), dtype=bool)
    order = np.argsort(block, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(block[order])) + 1) if len(order) else []:
        (left, x), (right, y) = np.unique(a[rows], return_inverse=True), np.unique(b[rows], return_inverse=True)
        inter = intersections([own[i] for i in left], [own[i] for i in right], x, y)
        keep[rows] = least[1] * inter >= least[0] * (size[a[rows]] + size[b[rows]] - inter)
    return pairs.select(["la", "lb"]).rename_columns(["a", "b"]).filter(pa.array(keep))


class _Groups:
    """Rows sorted by ``grp, side`` (0: one, 1: all), as columns of whole groups."""

    def __init__(self, table: pa.Table, least: tuple[int, int]):
        number = lambda name: table[name].to_numpy()
        self.table, self.grp, self.side, self.n = table, number("grp"), number("side"), number("n")
        self.s0, self.s1, self.least = number("s0").view(np.uint64), number("s1").view(np.uint64), least
        self.label = np.frombuffer(b"".join(x[:8] for x in table["label"].to_pylist()), dtype="<u8")
        self.start = np.flatnonzero(np.concatenate(([True], self.grp[1:] != self.grp[:-1])))
        self.ones = np.add.reduceat((self.side == 0).astype(np.int64), self.start)
        self.size = np.diff(np.append(self.start, len(self.grp)))

    def candidates(self, most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place among the groups, one, all): the pairs that may be similar, of some whole groups at a time."""
        cost = np.cumsum(self.ones * (self.size - self.ones))
        at = 0
        while at < len(cost):
            to = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + most, side="right")))
            of = np.repeat(np.arange(at, to), self.ones[at:to])
            one = ragged(self.start[at:to], self.ones[at:to])
            lot = np.cumsum((self.size - self.ones)[of]) // AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(lot)) + 1).tolist(), len(of)]
            found = [self._fit(of[i:j], one[i:j]) for i, j in zip(cuts, cuts[1:])]
            yield tuple(np.concatenate(x) for x in zip(*found))
            at = to

    def _fit(self, of: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs of ``one`` (in the groups ``of``) that may be similar."""
        alls = (self.size - self.ones)[of]
        other = ragged((self.start + self.ones)[of], alls)
        one, of = np.repeat(one, alls), np.repeat(of, alls)
        low, high = np.minimum(self.n[one], self.n[other]), np.maximum(self.n[one], self.n[other])
        fit = (self.label[one] != self.label[other]) & (low * self.least[1] >= high * self.least[0])
        of, one, other = of[fit], one[fit], other[fit]
        fit = self.apart(one, other) <= MOST_APART
        return of[fit], one[fit], other[fit]

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.bitwise_count((self.s0[x] ^ self.s0[y]) | (self.s1[x] ^ self.s1[y])).astype(np.int64)


def _whole_groups(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.Table]:
    """Sorted rows as tables that end where a group ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(x.num_rows for x in held) < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        grp = table["grp"].to_numpy()
        cut = int(np.searchsorted(grp, grp[-1], side="left"))
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


_SCREENED = pa.schema(
    [("a", pa.binary()), ("b", pa.binary()), ("la", pa.binary()), ("lb", pa.binary()), ("grp", pa.int64()), ("side", pa.int32()), ("rep", pa.binary()),
     ("label", pa.binary()), ("n", pa.int64()), ("s0", pa.int64()), ("s1", pa.int64())]
)


def _padded(arrays: list, at: int, rows: int) -> pa.RecordBatch:
    """``arrays`` from column ``at`` on, nulls in the others."""
    held = dict(zip(_SCREENED.names[at:], arrays))
    return pa.RecordBatch.from_arrays([held.get(f.name, pa.nulls(rows, f.type)) for f in _SCREENED], schema=_SCREENED)


def screened(least: tuple[int, int]):
    """Groups of members to candidate pairs ``a, b`` with their labels ``la, lb`` or, where these are more than the members, to the members that have one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            groups = _Groups(table, least)
            reps, labels = table["rep"].to_pylist(), table["label"].to_pylist()
            for of, one, other in groups.candidates():
                if not len(of):
                    continue
                hits = np.bincount(of, minlength=len(groups.size))
                dense = (hits > groups.size)[of]
                x, y = one[~dense], other[~dense]
                pairs = [min((reps[i], reps[j], labels[i], labels[j]), (reps[j], reps[i], labels[j], labels[i])) for i, j in zip(x.tolist(), y.tolist())]
                yield _padded([pa.array([p[k] for p in pairs], type=pa.binary()) for k in range(4)], 0, len(pairs))
                kept = np.unique(np.concatenate((one[dense], other[dense])))
                some = table.take(pa.array(kept)).select(_SCREENED.names[4:]).combine_chunks()
                yield _padded([some[c].combine_chunks() for c in some.column_names], 4, len(kept))

    return work


def linked(words: int, least: tuple[int, int]):
    """Groups of members with their texts to ``a, b``: labels that a similar pair connects, one link for each two components."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, 1):
            groups = _Groups(table, least)
            own: list[np.ndarray] = []
            for batch in table.to_batches():
                for part in slices(batch):
                    own.extend(sets(texts(part), words))
            size = np.array([len(x) for x in own])
            labels, out, parent = table["label"].to_pylist(), [], {}

            def root(x: bytes) -> bytes:
                while parent.get(x, x) != x:
                    parent[x] = parent.get(parent[x], parent[x])
                    x = parent[x]
                return x

            for of, one, other in groups.candidates():
                for rows in np.split(np.arange(len(of)), np.flatnonzero(np.diff(of)) + 1) if len(of) else []:
                    (left, x), (right, y) = np.unique(one[rows], return_inverse=True), np.unique(other[rows], return_inverse=True)
                    inter = intersections([own[i] for i in left], [own[i] for i in right], x, y)
                    found = least[1] * inter >= least[0] * (size[one[rows]] + size[other[rows]] - inter)
                    for i, j in zip(one[rows][found].tolist(), other[rows][found].tolist()):
                        a, b = root(labels[i]), root(labels[j])
                        if a != b:
                            parent[max(a, b)] = min(a, b)
                            out.append((labels[i], labels[j]))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], type=pa.binary()) for k in (0, 1)], schema=schema)

    return work


class _Join:
    def __init__(self, df: DataFrame, key: str, text: str, words: int, least: tuple[int, int], trees: int, small: int):
        # a text by its MD5 and one document that holds it
        self.docs = df.select(F.col(key).alias("own"), text_id(text).alias("key"), F.col(text).alias("text"))
        self.words, self.least, self.trees, self.small = words, least, trees, small
        self.scratch = Scratch(df.sparkSession, "minhash")
        self.signed = self.scratch.table(signatures(df, key, text, words), "signatures")
        self.reps = self.scratch.table(
            self.signed.filter("n > 0 AND key IS NOT NULL")
            .groupBy("digest")
            .agg(
                F.min(F.struct("tid", "key")).alias("of"),
                F.min("key").alias("least"),
                *[F.first(c).alias(c) for c in ("n", "sig", "s0", "s1")],
            )
            .select("digest", F.col("of.tid").alias("rep"), F.col("of.key").alias("own"), "least", "n", "sig", "s0", "s1"),
            "classes",
        )
        self.labels = self._none("rep", "label")
        self.tested: DataFrame | None = None

    def _none(self, *names: str) -> DataFrame:
        return self.reps.limit(0).select(*[F.col("rep").alias(n) for n in names])

    def _labelled(self, df: DataFrame, by: str = "rep", name: str = "label") -> DataFrame:
        to = self.labels.select(F.col("rep").alias(by), F.col("label").alias("_to"))
        return df.join(to, by, "left").withColumn(name, F.coalesce("_to", by)).drop("_to")

    @staticmethod
    def _nodes(front: DataFrame) -> DataFrame:
        """Of the nodes whose members (node, rep, label) are not all linked: ``size``,
        the component with most members (``major``), how many are of others
        (``rest``), and the smallest member (``pivot``)."""
        each = front.groupBy("node", "label").agg(F.count("*").alias("c"), F.min("rep").alias("least"))
        return (
            each.groupBy("node")
            .agg(F.sum("c").alias("size"), F.max(F.struct("c", "label")).alias("most"), F.min("least").alias("pivot"))
            .filter("size > most.c")
            .select("node", "size", (F.col("size") - F.col("most.c")).alias("rest"), F.col("most.label").alias("major"), "pivot")
        )

    @staticmethod
    def _chosen(i: int) -> Column:
        """The i-th coordinate that a node chooses."""
        return F.pmod(F.xxhash64("node", F.lit(i)), F.lit(COORDINATES)).cast("int")

    def _members(self, front: DataFrame, nodes: DataFrame) -> DataFrame:
        """Members of ``nodes`` with what a comparison needs. (Joined the same way at every size.)"""
        rows = front.join(nodes.hint("merge"), "node")
        return self.scratch.table(rows.select("node", "rep", "label", "n", "s0", "s1", "size", "rest", "major", "pivot"), "members")

    def _screened(self, members: DataFrame, last: bool) -> DataFrame:
        """Candidates of all nodes. A small node compares the members outside its major
        component with all members, a larger one its pivot; ``ONES`` of the former and
        ``ALLS`` of the latter are a group, whatever the size of the node."""
        every = F.lit(True) if last else F.col("rest") <= self.small
        one = F.when(every, F.col("label") != F.col("major")).otherwise(F.col("rep") == F.col("pivot"))
        blocks = F.ceil(F.col("size") / ALLS).cast("int")
        others = F.ceil(F.when(every, F.col("rest")).otherwise(F.lit(1)) / ONES).cast("int")
        lot = lambda seed, of: F.pmod(F.xxhash64("rep", F.lit(seed)), of).cast("int")
        as_all = F.transform(F.sequence(F.lit(0), others - 1), lambda i: F.struct(F.lit(1).alias("side"), i.alias("i"), lot(1, blocks).alias("j")))
        as_one = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.struct(F.lit(0).alias("side"), lot(2, others).alias("i"), j.alias("j")))
        dealt = members.withColumn("_at", F.explode(F.concat(as_all, F.when(one, as_one).otherwise(F.array()))))
        rows = dealt.select(
            F.xxhash64("node", "_at.i", "_at.j").alias("grp"), F.col("_at.side").alias("side"), "rep", "label", "n", "s0", "s1"
        )
        sorted_ = rows.repartition("grp").sortWithinPartitions("grp", "side")
        return sorted_.mapInArrow(
            released(screened(self.least)),
            "a binary, b binary, la binary, lb binary, grp long, side int, rep binary, label binary, n long, s0 long, s1 long",
        )

    def _texts(self, reps: DataFrame) -> DataFrame | None:
        """``key`` (rep), ``text`` of distinct ``rep``, if there are any."""
        wanted = reps.join(self.reps.select("rep", "own"), "rep").select(F.col("rep").alias("key"), "own")
        wanted = self.scratch.table(wanted, "wanted")
        n = wanted.count()
        if not n:
            return None
        met = self.docs.join(F.broadcast(wanted) if n <= BROADCAST_KEYS else wanted, ["key", "own"], "left_semi")
        docs = self.scratch.table(met.select("key", "text"), "texts")
        # some rows repeat id and text
        return docs if docs.count() == n else self.scratch.table(docs.dropDuplicates(["key"]), "texts")

    def _dense(self, members: DataFrame, docs: DataFrame) -> DataFrame:
        """Links ``a, b`` of labels from groups with many candidates. Groups of more shingles than a task should hold are cut into a grid."""
        parts = members.groupBy("grp").agg(F.ceil(F.sum("n") / SHINGLES).cast("int").alias("k"))
        lot, all_ = F.pmod(F.xxhash64("rep", F.lit(3)), F.col("k")).cast("int"), F.sequence(F.lit(0), F.col("k") - 1)
        cells = F.transform(all_, lambda i: F.when(F.col("side") == 0, F.struct(lot.alias("i"), i.alias("j"))).otherwise(F.struct(i.alias("i"), lot.alias("j"))))
        dealt = members.join(parts, "grp").withColumn("_at", F.explode(cells))
        rows = dealt.select(F.xxhash64("grp", "_at.i", "_at.j").alias("grp"), "side", "rep", "label", "n", "s0", "s1")
        held = rows.join(docs.withColumnRenamed("key", "rep"), "rep")
        met = held.repartition("grp").sortWithinPartitions("grp", "side")
        return met.mapInArrow(released(linked(self.words, self.least)), "a binary, b binary")

    def _confirm(self, pairs: DataFrame, docs: DataFrame) -> DataFrame:
        """The labels ``a, b`` of pairs confirmed on the texts. Pairs of one class meet in one group, which gets each of its texts once."""
        groups = max(1, pairs.count() // GROUP)
        dealt = pairs.withColumn("blocks", F.xxhash64("b")).withColumn("group", F.pmod("blocks", F.lit(groups)))
        wanted = dealt.select("group", F.explode(F.array("a", "b")).alias("key")).distinct()
        held = wanted.join(docs, "key").select(F.col("group").alias("of"), "key", "text")
        words, least = self.words, self.least

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            return confirmed(left, right, words, least)

        return dealt.groupBy("group").cogroup(held.groupBy("of")).applyInArrow(meet, "a binary, b binary")

    def _merge(self, links: DataFrame) -> None:
        """Merge the components whose labels are linked."""
        found = self.scratch.table(components(links, self.scratch), "found")
        root = found.select(F.col("node").alias("label"), "root")
        moved = self.labels.join(root, "label", "left").select("rep", F.coalesce("root", "label").alias("label"))
        new = found.join(self.labels.select(F.col("rep").alias("node")), "node", "left_anti")
        self.labels = self.scratch.table(
            moved.unionByName(new.select(F.col("node").alias("rep"), F.col("root").alias("label"))), "labels"
        )

    def _test(self, members: DataFrame, last: bool) -> None:
        found = self.scratch.table(self._screened(members, last), "candidates")
        pairs = found.filter("a IS NOT NULL").groupBy("a", "b").agg(F.first("la").alias("la"), F.first("lb").alias("lb"))
        pairs = self.scratch.table(pairs.join(self.tested, ["a", "b"], "left_anti") if self.tested is not None else pairs, "pairs")
        dense = found.filter("rep IS NOT NULL")
        reps = dense.select("rep").unionByName(pairs.select(F.explode(F.array("a", "b")).alias("rep"))).distinct()
        docs = self._texts(reps)
        if docs is None:
            return
        self._merge(self._confirm(pairs, docs).unionByName(self._dense(dense, docs)))
        own = pairs.select("a", "b")
        self.tested = self.tested.unionByName(own) if self.tested is not None else own

    def run(self) -> DataFrame:
        # Trees at their roots: one coordinate each, every fourth tree a second.
        roots = [(t, t) for t in range(self.trees)] + [(t, (self.trees + t // 4) % COORDINATES) for t in range(0, self.trees, 4)]
        values = F.array(*[F.xxhash64(F.lit(t), F.lit(c), F.col("sig")[c]) for t, c in roots])
        front = self.reps.select(F.explode(values).alias("node"), "rep", "n", "s0", "s1").withColumn("label", F.col("rep"))
        # Nothing is linked yet, so every member is a component of its own.
        nodes = (
            front.groupBy("node")
            .agg(F.count("*").alias("size"), F.min("rep").alias("pivot"))
            .filter("size > 1")
            .select("node", "size", (F.col("size") - 1).alias("rest"), F.col("pivot").alias("major"), "pivot")
        )
        for level in range(DEPTH):
            members = self._members(front, nodes)
            last = level == DEPTH - 1
            self._test(members, last)
            if last:
                break
            # The larger nodes, with what has been linked meanwhile: some are small now, the others branch.
            held = ("n", "s0", "s1")
            large = self._labelled(members.filter(F.col("rest") > self.small).select("node", "rep", *held))
            large = self.scratch.table(large.join(self._nodes(large).select("node", "rest"), "node"), "large")
            if large.isEmpty():
                break
            branches = [[self._chosen(b * TAKEN + i) for i in range(TAKEN)] for b in range(BRANCHES)]
            below = F.array(*[F.xxhash64("node", F.lit(b), *[F.col("sig")[c] for c in cs]) for b, cs in enumerate(branches)])
            children = (
                large.filter(F.col("rest") > self.small)
                .join(self.reps.select("rep", "sig"), "rep")
                .select(F.explode(below).alias("node"), "rep", "label", *held)
            )
            front = self.scratch.table(
                large.filter(F.col("rest") <= self.small).select("node", "rep", "label", *held).unionByName(children), "front"
            )
            nodes = self._nodes(front)
        # a component goes by the smallest key of its classes
        classes = self._labelled(self.reps.select("digest", "rep", "least"))
        smallest = classes.groupBy("label").agg(F.min("least").alias("_least"))
        classes = self.scratch.table(classes.join(smallest, "label").select("digest", "_least"), "components")
        own = F.when(F.col("key").isNotNull(), F.coalesce("_least", "key"))
        return (
            self.signed.select("key", "tid", "n", F.when(F.col("key").isNotNull(), F.col("digest")).alias("digest"))
            .join(classes, "digest", "left")
            .select("key", F.col("n").alias("n_shingles"), own.alias("component_id"), "tid")
            .withColumn("kept", F.col("key").eqNullSafe(F.col("component_id")))
        )


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    least: tuple[int, int] = (80, 100),
    recall: float = RECALL,
    small: int = SMALL,
) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` (the smallest key reachable by
    links of similarity >= least[0] / least[1]), ``kept`` (key = component_id) and
    ``tid`` (the MD5 of the text, which tells rows of one key apart)."""
    trees = min(COORDINATES, trees_for(recall, least[0] / least[1]))
    return _Join(df, key, text, words, least, trees, small).run().withColumnRenamed("key", key)
