"""Spelling variants: words one edit apart, found over a reduced alphabet.

Every letter is hashed to one of a few symbols, so that a word has a reduced word.
Two words one edit apart have reduced words that are equal or one edit apart. So
each word's full one-edit neighbourhood over the few symbols (its reduced word,
every deletion, replacement and insertion) is joined with the reduced vocabulary,
and pairs that meet are verified on the original strings, inside the join: only
true pairs become rows, and a word has at most its length times the alphabet of
them, however many words share a reduced word.

Neighbourhoods are 64-bit polynomial hashes, made from prefix and suffix hashes
in numpy, never as strings; hash collisions only add pairs to verify.

Handling: null texts have no words; a null id counts as empty text in the deletion
rule; repeated rows count again; texts and words of any length are whole; an empty
table has no word; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysignal.llm.scratch import Scratch
from paysignal.llm.words import mix64

#: Symbols of the reduced alphabet.
SYMBOLS = 8
#: A vocabulary is broadcast up to so many words and bytes of them; beyond, the join is a shuffle.
BROADCAST_WORDS = 3_000_000
BROADCAST_BYTES = 96 << 20
#: Keys of one batch of neighbourhoods, and of one row.
BATCH_KEYS = 1 << 20
ROW_KEYS = 1 << 16

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BASE = np.uint64(0x9E3779B97F4A7C15)


def vocabulary(docs: DataFrame, least_length: int = 7, least_count: int = 2, every: int = 31) -> DataFrame:
    """(word, n): runs of letters, lower-cased A-Z, of at least ``least_length`` code points and ``least_count`` occurrences.

    Where ``every`` divides the crc32 h of ``<doc_id>:<run>``, the run first loses its code point h modulo its length.
    """
    runs = docs.select(F.col("doc_id").alias("id"), F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= least_length).withColumn("run", F.translate("run", UPPER, LOWER))
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary"))
    at = "cast(h % length(run) AS int)"
    cut = F.concat(F.expr(f"substring(run, 1, {at})"), F.expr(f"substring(run, {at} + 2)"))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= least_count)


def _symbols(points: np.ndarray, symbols: int) -> np.ndarray:
    return (mix64(points.astype(np.uint64) + _BASE) >> np.uint64(33)) % np.uint64(symbols)


def neighbourhoods(symbols: int = SYMBOLS):
    """``word, n`` to ``word, n, own, keys``: the key of the reduced word, and those of its
    neighbourhood (itself included), each once; long lists go on in further rows with null ``own``."""
    values = mix64(np.arange(1, symbols + 1, dtype=np.uint64) * _BASE) | np.uint64(1)

    def keys_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """codes: words of one length as rows. Hash: sum of value(symbol i) * base^(length - 1 - i)."""
        rows, size = codes.shape
        power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size + 1, _BASE))), dtype=np.uint64)
        v = values[codes]
        zero = np.zeros((rows, 1), np.uint64)
        suffix = np.concatenate((np.cumsum((v * power[size - 1 :: -1])[:, ::-1], axis=1)[:, ::-1], zero), axis=1)
        whole = suffix[:, :1]
        head = whole - suffix  # of the first i symbols, at their powers in the word
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        gone = head[:, :-1] * inverse + suffix[:, 1:]
        other = (whole - v * power[size - 1 :: -1])[:, :, None] + (values[None, :] * power[size - 1 :: -1][:, None])[None]
        grown = (head * _BASE + suffix)[:, :, None] + (values[None, :] * power[size::-1][:, None])[None]
        return whole[:, 0], np.concatenate((gone, other.reshape(rows, -1), grown.reshape(rows, -1)), axis=1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(batch.schema.get_field_index("word"))
            counts = batch.column(batch.schema.get_field_index("n"))
            texts = words.to_pylist()
            lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
            for size in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == size)
                step = max(1, BATCH_KEYS // (2 * (size + 1) * symbols))
                for at in range(0, len(rows), step):
                    some = rows[at : at + step]
                    points = np.frombuffer("".join(texts[i] for i in some).encode("utf-32-le"), dtype="<u4")
                    own, keys = keys_of(_symbols(points, symbols).reshape(len(some), size).astype(np.int64))
                    keys.sort(axis=1)
                    once = np.concatenate((np.ones((len(some), 1), bool), keys[:, 1:] != keys[:, :-1]), axis=1)
                    yield from _packed(words, counts, some, own, keys, once)

    return work


def _packed(words, counts, some, own, keys, once) -> Iterator[pa.RecordBatch]:
    flat, sizes = keys[once].view(np.int64), once.sum(axis=1)
    names = ["word", "n", "own", "keys"]
    if sizes.max() <= ROW_KEYS:
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
        at = pa.array(some)
        yield pa.RecordBatch.from_arrays([words.take(at), counts.take(at), pa.array(own.view(np.int64)), lists], names=names)
        return
    starts = np.cumsum(sizes) - sizes
    for i, row in enumerate(some):
        mine = flat[starts[i] : starts[i] + sizes[i]]
        for at in range(0, len(mine), ROW_KEYS):
            part = mine[at : at + ROW_KEYS]
            key = pa.array([None if at else int(own[i : i + 1].view(np.int64)[0])], type=pa.int64())
            lists = pa.ListArray.from_arrays(pa.array([0, len(part)], type=pa.int32()), pa.array(part))
            yield pa.RecordBatch.from_arrays([words.slice(row, 1), counts.slice(row, 1), key, lists], names=names)


def _fits(vocab: DataFrame) -> bool:
    rows, size = vocab.agg(F.count("*"), F.sum(F.octet_length("word"))).first()
    return rows <= BROADCAST_WORDS and (size or 0) <= BROADCAST_BYTES


def near_words(vocab: DataFrame, symbols: int = SYMBOLS, small: bool | None = None) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words one edit apart. ``vocab``: distinct ``word, n``."""
    small = _fits(vocab) if small is None else small
    around = vocab.mapInArrow(neighbourhoods(symbols), "word string, n long, own long, keys array<long>")
    reduced = vocab.mapInArrow(_reduced(symbols), "near string, near_n long, key long")
    asked = around.select("word", "n", F.explode("keys").alias("key"))
    found = asked.join(
        F.broadcast(reduced) if small else reduced,
        (asked["key"] == reduced["key"]) & (F.levenshtein("word", "near", 1) == 1),
    )
    return found.select("word", "n", "near", "near_n")


def _reduced(symbols: int):
    """``word, n`` to ``near, near_n, key`` by the key of the reduced word."""
    work = neighbourhoods(symbols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in work(batches):
            own = batch.column(2)
            kept = batch.filter(own.is_valid()) if own.null_count else batch
            if kept.num_rows:
                yield pa.RecordBatch.from_arrays(kept.columns[:3], names=["near", "near_n", "key"])

    return run


def roots(forms: DataFrame, most: int, ratio: int, scratch: Scratch) -> DataFrame:
    """(word, root) of ``word, form``: the last of the forms from each word that has one.

    A form's count is at least ``ratio`` times its word's, and none is above ``most``,
    which bounds the steps; pointers double with each round.
    """
    steps = max(1, math.ceil(math.log(max(2, most), ratio)))
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        now = scratch.table(now, "roots")
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return now


def variants(vocab: DataFrame, scratch: Scratch, ratio: int = 10, symbols: int = SYMBOLS, small: bool | None = None) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of a vocabulary ``word, n`` of distinct words.

    ``form``: of the words one edit apart the most frequent (ties: the smallest), if it is
    at least ``ratio`` times as frequent; ``root``: the last of the forms, or the word itself.
    """
    vocab = scratch.table(vocab.select("word", "n"), "vocabulary")
    near = near_words(vocab, symbols, small).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top")
    )
    takes = -F.col("top.less") >= ratio * F.col("n")
    known = vocab.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("top.near")).alias("form"),
        F.when(takes, -F.col("top.less")).alias("form_n"),
    )
    known = scratch.table(known, "forms")
    most = known.agg(F.max("form_n")).first()[0] or 0
    last = roots(known.filter("form IS NOT NULL"), most, ratio, scratch)
    return known.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
