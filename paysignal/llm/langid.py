"""Language identification by compression.

For each language a raw-content zstandard dictionary is filled with text of
that language. A document's letters are compressed with every dictionary, in
segments of ``SEGMENT`` bytes that each start from the dictionary afresh; the
language of the smallest sum of outputs wins. So all of a text counts, and its
margin does not fall with its length. Nothing but the text enters a prediction.

Fitting reads all labelled rows once for sizes, then takes a bounded sample of
them: ``DICT_BYTES`` per language, from documents chosen by a hash, at most
``PER_DOCUMENT`` characters of each, and a row that is repeated once. Sizes that lie closer than ``MARGIN`` are
rejected; the prediction is still given, ties going to the language with more
labelled text.

Defined cases: a null text or one without letters is ``und``, score 0, and
rejected; labelled rows with a null language are not learned from; with no
labelled rows every document is ``und``; with one language its score is 1;
repeated rows are predicted alike; the whole text is compressed at any length.
The number of languages is taken to be a label set (at most some hundreds).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex as re
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.llm.batches import released, slices, strings

DICT_BYTES = 128 << 10
PER_DOCUMENT = 2000
LEVEL = 6
SEGMENT = 8 << 10
MARGIN = 0.005
UNKNOWN = "und"
_OTHER = re.compile(r"[^\p{L}\p{M}]+")
_LETTER = re.compile(r"\p{L}")


def letters(text: str) -> bytes:
    """Lower-cased letters with their marks; every run of anything else is one space. Marks without any letter are nothing."""
    found = _OTHER.sub(" ", text.lower()).strip()
    return found.encode() if _LETTER.search(found) else b""


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", dict_bytes: int = DICT_BYTES) -> list[tuple[str, bytes]]:
    """(language, dictionary), the language with most labelled text first."""
    rows = labelled.filter(F.col(lang).isNotNull() & (F.length(text) > 0)).select(
        F.col(lang).alias("lang"),
        F.substring(text, 1, PER_DOCUMENT).alias("text"),
        F.xxhash64(F.lit(91), key, text).alias("h"),
    )
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    if not sizes:
        return []
    # Twice the wanted bytes on average, in the order of the hash; copies count once.
    share = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, 2.0 * dict_bytes / r["n"])))])
    draw = F.pmod(F.col("h"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.filter(draw < share[F.col("lang")]).distinct().collect()
    chosen: dict[str, dict[str, None]] = {}
    for r in sorted(sample, key=lambda r: (r["h"], r["text"])):
        chosen.setdefault(r["lang"], {}).setdefault(r["text"])
    order = sorted(chosen, key=lambda k: (-next(r["n"] for r in sizes if r["lang"] == k), k))
    made = [(k, b"\n".join(filter(None, map(letters, chosen[k])))[:dict_bytes]) for k in order]
    return [(k, d) for k, d in made if len(d) >= 8]  # zstandard takes no shorter dictionary


class Classifier:
    def __init__(self, dictionaries: list[tuple[str, bytes]], level: int = LEVEL):
        self.names = [k for k, _ in dictionaries]
        self.compressors = []
        for _, content in dictionaries:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.compressors.append(
                zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
            )

    def predict(self, text: str) -> tuple[str, float]:
        """(language, margin): how much smaller than the second the smallest sum of outputs is."""
        found = letters(text)
        if not found or not self.names:
            return UNKNOWN, 0.0
        parts = [found[at : at + SEGMENT] for at in range(0, len(found), SEGMENT)]
        sizes = [sum(len(c.compress(part)) for part in parts) for c in self.compressors]
        best = min(sizes)
        at = sizes.index(best)
        others = sizes[:at] + sizes[at + 1 :]
        return self.names[at], (1.0 - best / min(others) if others else 1.0)


def predict(
    df: DataFrame,
    dictionaries: list[tuple[str, bytes]],
    text: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    margin: float = MARGIN,
) -> DataFrame:
    """``carry`` columns, ``lang_pred``, ``score`` (0 to 1) and ``rejected``."""
    schema = T.StructType(
        [df.schema[c] for c in carry]
        + [
            T.StructField("lang_pred", T.StringType(), False),
            T.StructField("score", T.DoubleType(), False),
            T.StructField("rejected", T.BooleanType(), False),
        ]
    )
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)  # DICT_BYTES per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for batch in batches:
            for part in slices(batch, "_text"):
                found = [classifier.predict(t) for t in strings(part, "_text")]
                made = [
                    pa.array([k for k, _ in found], type=pa.string()),
                    pa.array([s for _, s in found], type=pa.float64()),
                    pa.array([k == UNKNOWN or s <= margin for k, s in found], type=pa.bool_()),
                ]
                kept = [part.column(i) for i in range(len(carry))]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)

    rows = df.select(*[df[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(carry)], df[f"`{text}`"].alias("_text"))
    return rows.mapInArrow(released(run), schema)


def remainder(key: Column, of: int) -> Column:
    """crc32 of the key as text, modulo ``of``; a null key is the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % of
