import hashlib

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from test_llm_pairs_vectors import brute_components

import corpus_pipeline as cp
from paysignal.llm import bpe, langid, mixing

SMALL = "/root/testdata/sf0.001"


def stages(spark, docs, base):
    out = [docs]
    for name, stage in cp.STAGES:
        stage(spark, out[-1], SMALL).write.parquet(f"{base}/{name}")
        out.append(spark.read.parquet(f"{base}/{name}"))
    return out


def test_stages_against_brute_force(spark, tmp_dir):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    raw, known, kept, mixed, encoded = stages(spark, docs, tmp_dir)
    assert [tuple(x.columns) for x in (known, kept, mixed)] == [cp.COLUMNS] * 3

    classifier = langid.Classifier(langid.fit(raw.filter(langid.remainder(F.col("doc_id"), 4) != 2)))
    want = {}
    for r in raw.collect():
        lang, margin = classifier.predict(r.text)
        if lang != langid.UNKNOWN and margin > langid.MARGIN:
            want[r.doc_id] = (r.text, lang)
    assert {r.doc_id: (r.text, r.lang) for r in known.collect()} == want

    rows = known.collect()
    component = brute_components([r.doc_id for r in rows], [r.text for r in rows], 5)
    left = {r.doc_id: r.text for r in kept.collect()}
    assert left == {r.doc_id: r.text for r in rows if component[r.doc_id, r.text][1] == r.doc_id}

    copies = {r.rec.doc_id: r.copies for r in mixing.mix(kept).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == copies

    vocab = bpe.vocabulary(public_tokenizers.path(cp.VOCABULARY))
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})
    got = encoded.collect()
    assert len(got) == sum(copies.values())
    assert all(r.ids == reference.encode_ordinary(left[r.doc_id]) and r.n_tokens == len(r.ids) for r in got)


def test_odd_rows_pass_all_stages(spark, tmp_dir, odd_docs, no_docs):
    _, known, kept, mixed, encoded = stages(spark, odd_docs, f"{tmp_dir}/odd")
    assert known.filter("text IS NULL OR text = ''").isEmpty() and known.filter("doc_id IS NULL").count() == 2
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(None) == 2
    assert mixed.count() == encoded.count() > 0
    assert stages(spark, no_docs, f"{tmp_dir}/none")[-1].count() == 0


def test_rows_that_repeat_an_id_stay_once(spark, tmp_dir):
    rows = [(5, "one two three four five six seven", "en", "a", 1)] * 3 + [(6, "eight nine ten eleven twelve thirteen", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in cp.near_duplicates(spark, docs, SMALL).collect()) == [5, 6]


def test_another_text_of_an_id_that_goes_stays(spark, tmp_dir):
    t, u = (" ".join(f"{x}{i}" for i in range(30)) for x in "tu")
    rows = [(3, t, "en", "a", 1), (5, u, "en", "a", 1), (5, t, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id, r.text) for r in cp.near_duplicates(spark, docs, SMALL).collect()) == [(3, t), (5, u)]


def test_tokens_decode_to_the_text(spark, odd_docs):
    docs = odd_docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").dropDuplicates(["doc_id"])
    want = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in docs.collect()}
    assert {r.doc_id: r.decoded_sha256 for r in cp.tokens(spark, docs, SMALL).collect()} == want


def test_run_is_registered(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is cp.run and "pipeline" not in entry.oracle_sql()
    assert cp.run(spark, SMALL).count() > 0
