"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

A token's probability is P(class | context) * P(token | class).

Classes: the end of a text, the ``TOP`` most frequent words (a class each) and
``TAILS`` classes of all other words, by a hash of their last two bytes.
P(class | context) is a softmax over hashed features of the context: the word
before, the two before together, and two skip features (the second and the
third word before alone). P(token | class) is the maximum-entropy solution of
features on the word alone, its relative frequency in the class, with an
absolute discount whose mass goes to the class's one unknown token, so that the
probabilities of all known words and the unknown tokens sum to one.

Counting covers every training text. Training is one pass over all of them in
``ROUNDS`` rounds, each on the texts that a hash assigns to it: every task
takes the shared weights, makes sparse AdaGrad steps in numpy batches, and gives
back its changes; the changes of a feature are averaged over the tasks that saw
it. The weights have a fixed size (``ROWS`` x classes). Scoring looks the counts
of the ``COMMON`` most frequent words up in a broadcast table of that bound; the
others are joined with the full counts.

Defined cases: null text is empty and scores its end alone; a null key is the
empty text for the split into training and held-out texts; repeated rows are
texts of their own and score alike; texts of any length are learned from and
scored whole; with nothing to learn from every class is equally likely; an
empty table gives an empty result. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.llm.batches import list_array, ragged, slices, texts
from paysignal.llm.scratch import Scratch
from paysignal.llm.words import hash_words, mix64

TOP, TAILS = 63, 32
CLASSES = 1 + TOP + TAILS
ROWS = 1 << 14
COMMON = 1 << 18
ROUNDS = 2
RATE = 0.25
#: Tokens of a training step or a scoring batch, and occurrences in it up to which a row's values are added one by one.
STEP, FEW = 4096, 4
#: Rows of weights that travel together, and tasks whose changes are added at once.
BAND, FAN = 64, 64
#: Distinct words that a counting task holds before it passes them on.
HELD = 1 << 20
END = np.uint64(0x5BD1E9955BD1E995)
_BEFORE = np.uint64(0x1B873593CC9E2D51)
_SALT = mix64(np.arange(1, 5, dtype=np.uint64))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ONES = np.ones(max(STEP, CLASSES), dtype=np.float32)


class Tokens(NamedTuple):
    word: np.ndarray  # 64-bit hash; each text's last is END
    tail: np.ndarray  # last two bytes
    first: np.ndarray  # first token of each text
    size: np.ndarray  # tokens per text


def tokens(raws: list[bytes]) -> Tokens:
    word, counts, tail = hash_words(raws)
    size = counts + 1
    first = np.cumsum(size) - size
    at = ragged(first, counts)
    words, tails = np.full(int(size.sum()), END), np.zeros(int(size.sum()), dtype=np.uint16)
    words[at], tails[at] = word, tail
    return Tokens(words, tails, first, size)


def tail_class(tail: np.ndarray) -> np.ndarray:
    return (mix64(tail.astype(np.uint64)) % np.uint64(TAILS)).astype(np.int64) + 1 + TOP


def classes(t: Tokens, top: np.ndarray) -> np.ndarray:
    """``top``: hashes of the most frequent words, ascending; the i-th is class 1 + i."""
    found = tail_class(t.tail)
    if len(top):
        at = np.minimum(np.searchsorted(top, t.word), len(top) - 1)
        found = np.where(top[at] == t.word, 1 + at, found)
    return np.where(t.word == END, 0, found)


def features(t: Tokens) -> np.ndarray:
    """Rows of the weights, four for each token."""
    place = np.arange(len(t.word)) - np.repeat(t.first, t.size)

    def before(k: int) -> np.ndarray:
        out = np.full(len(t.word), _BEFORE)
        out[k:] = np.where(place[k:] >= k, t.word[: len(t.word) - k], _BEFORE)
        return out

    one, two, three = before(1), before(2), before(3)
    keys = (one ^ _SALT[0], two ^ _SALT[1], (one * _ODD + two) ^ _SALT[2], three ^ _SALT[3])
    return np.stack([((mix64(k) >> np.uint64(40)) % np.uint64(ROWS)).astype(np.int16) for k in keys])


class Buffers:
    """Matrices of a step, used again and again: fresh ones cost about as much as the sums in them."""

    def __init__(self):
        self.logit, self.part, self.exp = (np.empty((STEP, CLASSES), dtype=np.float32) for _ in range(3))

    def rows_of(self, matrix: np.ndarray, rows: np.ndarray, out: np.ndarray) -> np.ndarray:
        """``matrix[rows]`` in ``out``; rows are in range (``mode`` spares numpy a copy)."""
        return np.take(matrix, rows, axis=0, out=out[: len(rows)], mode="clip")


def exponentials(weights: np.ndarray, rows: np.ndarray, held: Buffers) -> tuple[np.ndarray, np.ndarray]:
    """(logit, its exponential) of every token and class, in ``held``; weights are kept far below overflow."""
    out = held.rows_of(weights, rows[0], held.logit)
    for own in rows[1:]:
        out += held.rows_of(weights, own, held.part)
    out += weights[ROWS]
    np.clip(out, -80, 80, out=out)
    return out, np.exp(out, out=held.exp[: len(out)])


def sums_of(rows: np.ndarray, values: np.ndarray, held: Buffers) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, the sum of the values of each, in ``held``). Most rows occur a
    few times: their values are added place by place; the others' in one product."""
    order = np.argsort(rows, kind="stable")
    own = rows[order]
    begins = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    counts = np.diff(np.append(begins, len(own)))
    out = held.rows_of(values, order[begins], held.logit)
    for j in range(1, FEW):
        more = np.flatnonzero((counts > j) & (counts <= FEW))
        sums = held.rows_of(out, more, held.part)
        sums += np.take(values, order[begins[more] + j], axis=0)
        out[more] = sums
    many = np.flatnonzero(counts > FEW)
    block = held.rows_of(values, order[np.repeat(counts > FEW, counts)], held.part)
    to = 0
    for i, n in zip(many.tolist(), counts[many].tolist(), strict=True):
        np.matmul(_ONES[:n], block[to : (to := to + n)], out=out[i])
    return own[begins], out


def log_class(weights: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Natural log of P(class | context) of each token."""
    out, rows, held = np.empty(len(wanted)), rows.astype(np.intp), Buffers()
    for at in range(0, len(wanted), STEP):
        s, e = exponentials(weights, rows[:, at : at + STEP], held)
        out[at : at + STEP] = s[np.arange(len(s)), wanted[at : at + STEP]] - np.log(e @ _ONES[:CLASSES])
    return out


class Learner:
    """Sparse AdaGrad steps on a copy of the weights."""

    def __init__(self, weights: np.ndarray):
        self.start = weights
        self.weights = weights.copy()
        self.squares = np.full(len(weights), 1e-6, dtype=np.float32)
        self.touched = np.zeros(len(weights), dtype=bool)
        self.held = Buffers()

    def learn(self, rows: np.ndarray, wanted: np.ndarray) -> None:
        wide = rows.astype(np.intp)
        for at in range(0, len(wanted), STEP):
            own = rows[:, at : at + STEP]
            _, p = exponentials(self.weights, wide[:, at : at + STEP], self.held)
            p *= (1 / (p @ _ONES[:CLASSES]))[:, None]
            p[np.arange(len(p)), wanted[at : at + STEP]] -= 1
            for feature in own:
                self._step(*sums_of(feature, p, self.held))
            self._step(np.array([ROWS]), (_ONES[: len(p)] @ p)[None, :])

    def _step(self, changed: np.ndarray, gradient: np.ndarray) -> None:
        self.squares[changed] += np.einsum("ij,ij->i", gradient, gradient)
        gradient *= (RATE / np.sqrt(self.squares[changed]))[:, None]
        new = self.held.rows_of(self.weights, changed, self.held.part)
        new -= gradient
        self.weights[changed] = new
        self.touched[changed] = True

    def bands(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(band, its changes, which of its rows were touched)."""
        change = self.weights - self.start
        for at in range(0, len(change), BAND):
            if self.touched[at : at + BAND].any():
                yield at // BAND, change[at : at + BAND].tobytes(), self.touched[at : at + BAND].astype(np.float32).tobytes()


def _counts(df: DataFrame) -> DataFrame:
    """``word, tail, c`` of all tokens of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            word, tail, c = (np.concatenate(x) for x in zip(*held, strict=True))
            unique, first, at = np.unique(word, return_index=True, return_inverse=True)
            return unique, tail[first], np.bincount(at, weights=c).astype(np.int64)

        def out() -> pa.RecordBatch:
            word, tail, c = merged()
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(word.view(np.int64)), pa.array(tail.astype(np.int32)), pa.array(c)], names=["word", "tail", "c"]
            )

        for batch in batches:
            for part in slices(batch):
                t = tokens(texts(part))
                unique, first, c = np.unique(t.word, return_index=True, return_counts=True)
                held.append((unique, t.tail[first], c))
                if sum(len(x[0]) for x in held) > 2 * HELD:
                    held[:] = [merged()]
                    if len(held[0][0]) > HELD:
                        yield out()
        if held:
            yield out()

    found = df.mapInArrow(run, "word long, tail int, c long")
    return found.groupBy("word").agg(F.first("tail").alias("tail"), F.sum("c").alias("c"))


class Model(NamedTuple):
    weights: np.ndarray
    top: np.ndarray
    common: np.ndarray  # hashes of the most frequent words, ascending
    common_c: np.ndarray
    total: int
    distinct: int
    inside: np.ndarray  # per class: training tokens
    discount: np.ndarray
    unknown: np.ndarray  # per class: log10 of the unknown token's probability

    def log_inside(self, cls: np.ndarray, c: np.ndarray) -> np.ndarray:
        """log10 P(token | class) of tokens with training counts ``c``."""
        known = np.log10(np.maximum(c - self.discount[cls], 1e-300) / np.maximum(self.inside[cls], 1))
        return np.where(cls <= TOP, 0.0, np.where(c > 0, known, self.unknown[cls]))

    def log_base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.total + self.distinct + 1))


def _class_sums(counts: DataFrame, top: np.ndarray) -> np.ndarray:
    """Per class: tokens, words, words seen once, words seen twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((CLASSES, 4), dtype=np.int64)
        for batch in batches:
            word = batch.column(0).to_numpy().view(np.uint64)
            t = Tokens(word, batch.column(1).to_numpy().astype(np.uint16), np.zeros(0, int), np.zeros(0, int))
            cls, c = classes(t, top), batch.column(2).to_numpy()
            for i, x in enumerate((c, np.ones_like(c), c == 1, c == 2)):
                sums[:, i] += np.bincount(cls, weights=x, minlength=CLASSES).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(CLASSES)), *(pa.array(sums[:, i]) for i in range(4))], names=["cls", "n", "v", "n1", "n2"]
        )

    found = counts.mapInArrow(run, "cls long, n long, v long, n1 long, n2 long").groupBy("cls").agg(*[F.sum(x) for x in ("n", "v", "n1", "n2")])
    out = np.zeros((CLASSES, 4))
    for r in found.collect():
        out[r[0]] = r[1:]
    return out


def _train_round(df: DataFrame, weights: np.ndarray, top: np.ndarray) -> np.ndarray:
    shared = df.sparkSession.sparkContext.broadcast((weights, top))  # ROWS x CLASSES numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, top_ = shared.value
        learner = Learner(start)
        for batch in batches:
            for part in slices(batch):
                t = tokens(texts(part))
                learner.learn(features(t), classes(t, top_))
        found = list(learner.bands())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([TaskContext.get().partitionId()] * len(found), type=pa.int64()),
                pa.array([b for b, _, _ in found], type=pa.int32()),
                pa.array([x for _, x, _ in found], type=pa.binary()),
                pa.array([x for _, _, x in found], type=pa.binary()),
            ],
            names=["part", "band", "change", "seen"],
        )

    def add(group: pa.Table) -> pa.Table:
        def total(name: str) -> bytes:
            return np.sum([np.frombuffer(x, dtype=np.float32) for x in group[name].to_pylist()], axis=0, dtype=np.float32).tobytes()

        return pa.table(
            {
                "part": group["part"][:1],
                "band": group["band"][:1],
                "change": pa.array([total("change")], type=pa.binary()),
                "seen": pa.array([total("seen")], type=pa.binary()),
            }
        )

    schema = "part long, band int, change binary, seen binary"
    found, parts = df.mapInArrow(run, schema), df.rdd.getNumPartitions()
    while True:  # sums of FAN tasks at a time, so no group grows with the input
        found = found.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("band", "part").applyInArrow(add, schema)
        parts = -(-parts // FAN)
        if parts <= 1:
            break
    out = weights.copy()
    for r in found.collect():
        rows = slice(r["band"] * BAND, min(len(out), (r["band"] + 1) * BAND))
        seen = np.frombuffer(r["seen"], dtype=np.float32)
        out[rows] += np.frombuffer(r["change"], dtype=np.float32).reshape(len(seen), -1) / np.maximum(seen, 1)[:, None]
    return out


def _most_frequent(counts: DataFrame) -> list:
    """The words from some count on, ``COMMON`` at most. A histogram of counts
    by powers of 2^(1/16) (some hundred rows) finds the count, so that no task
    ranks words."""
    level = F.floor(F.log2("c") * 16).cast("int")
    held, least = 0, None
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        held += r["count"]
        if held > COMMON:
            break
        least = r["level"]
    return [] if least is None else counts.filter(level >= least).select("word", "c").collect()


def fit(df: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> Model:
    """``df`` has the training texts in ``text``; ``counts`` is the written table of their tokens."""
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    often = sorted(_most_frequent(counts.filter(F.col("word") != F.lit(int(END.view(np.int64))))), key=lambda r: (-r["c"], r["word"]))
    hashes = np.array([r["word"] for r in often], dtype=np.int64).view(np.uint64)
    c = np.array([r["c"] for r in often], dtype=np.int64)
    top = np.sort(hashes[:TOP])
    sums = _class_sums(counts, top)
    n, v, n1, n2 = sums.T
    discount = np.clip(n1 / np.maximum(n1 + 2 * n2, 1), 0.1, 0.95)
    unknown = np.log10(np.where(n > 0, np.maximum(discount * v, 1e-300) / np.maximum(n, 1), 1.0))
    weights = np.zeros((ROWS + 1, CLASSES), dtype=np.float32)
    weights[ROWS] = np.log((n + 1) / (n.sum() + CLASSES))
    for r in range(rounds):
        own = F.pmod(F.xxhash64(F.lit(31), "text"), F.lit(rounds)) == r
        weights = _train_round(df.filter(own).select("text"), weights, top)
    order = np.argsort(hashes)
    return Model(weights, top, hashes[order], c[order], int(size["n"]), int(size["v"]), n, discount, unknown)


def score(df: DataFrame, key: str = "doc_id", text: str = "text", held_out: Column | None = None) -> DataFrame:
    """Learns from the rows that are not ``held_out`` and scores all rows: ``key``,
    ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score`` (log10 of the text's probability)."""
    scratch = Scratch(df.sparkSession, "lm")
    held = F.lit(False) if held_out is None else held_out
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), held.alias("held_out"))
    train = rows.filter(~F.col("held_out")).select("text")
    counts = scratch.table(_counts(train), "counts")
    model = fit(train, counts)
    shared = df.sparkSession.sparkContext.broadcast(model)  # COMMON counts and ROWS x CLASSES weights

    schema = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField("key", rows.schema["key"].dataType), T.StructField("held_out", T.BooleanType())]
        + [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")]
        + [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]
        + [T.StructField("words", T.ArrayType(T.LongType())), T.StructField("cls", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.IntegerType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        row = TaskContext.get().partitionId() << 40
        end_c = m.inside[0]
        for batch in batches:
            for part in slices(batch):
                t = tokens(texts(part))
                cls = classes(t, m.top)
                logp = log_class(m.weights, features(t), cls) / np.log(10)
                unique, back = np.unique(t.word, return_inverse=True)
                at = np.minimum(np.searchsorted(m.common, unique), max(0, len(m.common) - 1))
                hit = m.common[at] == unique if len(m.common) else np.zeros(len(unique), dtype=bool)
                c = np.where(hit, m.common_c[at] if len(m.common) else 0, 0)
                ended = unique == END
                c, hit = np.where(ended, end_c, c)[back], (hit | ended)[back]
                base = np.where(hit, m.log_base(c), 0.0)
                inside = np.where(hit, m.log_inside(cls, c), 0.0)

                doc = np.repeat(np.arange(len(t.size)), t.size)
                sums = [np.bincount(doc, weights=x, minlength=len(t.size)) for x in (hit & (c > 0), base, logp + inside)]
                rest = np.flatnonzero(~hit)
                # One entry per text and word that is not among the common ones.
                order = rest[np.lexsort((t.word[rest], doc[rest]))]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (np.diff(doc[order]) != 0) | (t.word[order[1:]] != t.word[order[:-1]])
                begins = np.flatnonzero(new)
                tf = np.diff(np.append(begins, len(order)))
                first = order[begins]
                per = np.bincount(doc[first], minlength=len(t.size))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(len(t.size))),
                        part.column(0),
                        part.column(2),
                        pa.array(t.size),
                        pa.array(sums[0].astype(np.int64)),
                        pa.array(sums[1]),
                        pa.array(sums[2]),
                        list_array(t.word[first].view(np.int64), per, pa.int64()),
                        list_array(cls[first].astype(np.int32), per, pa.int32()),
                        list_array(tf.astype(np.int32), per, pa.int32()),
                    ],
                    names=schema.names,
                )
                row += len(t.size)

    part = scratch.table(rows.mapInArrow(run, schema), "parts")

    # The remaining words: counts by join, then both scores from (class, count) in the same formulas.
    rest = part.select("row", F.explode(F.arrays_zip("words", "cls", "tf")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.cls").alias("cls"), F.col("w.tf").alias("tf")
    )
    inside = F.array(*[F.lit(float(max(x, 1))) for x in model.inside])[F.col("cls")]
    discount = F.array(*[F.lit(float(x)) for x in model.discount])[F.col("cls")]
    unknown = F.array(*[F.lit(float(x)) for x in model.unknown])[F.col("cls")]
    count = F.coalesce("c", F.lit(0))
    base = F.log10((count + 1) / F.lit(float(model.total + model.distinct + 1)))
    own = F.when(F.col("cls") <= TOP, 0.0).when(count > 0, F.log10((count - discount) / inside)).otherwise(unknown)
    more = (
        rest.join(counts.select("word", "c"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(count > 0, F.col("tf")).otherwise(0)).alias("known"),
            F.sum(F.col("tf") * base).alias("base"),
            F.sum(F.col("tf") * own).alias("own"),
        )
    )
    return part.drop("words", "cls", "tf").join(more, "row", "left").select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("own", F.lit(0.0))).alias("score"),
    )
