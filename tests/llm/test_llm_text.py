import hashlib
import random
import time
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paysignal.llm import bpe, html, langid, tokencount
from paysignal.llm.words import hash_words

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ALPHABET = ["a", "b", "the", "Ing", " ", "  ", "\n", "\t", "é", "你", "1", "'s", "!!", "\x1c", "\x85", "\xa0", "\U0001f600", "x" * 40]


@pytest.fixture(scope="module")
def reference():
    vocab = bpe.vocabulary(PATH)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=30).map("".join), max_size=6), st.lists(st.text(max_size=60), max_size=4))
def test_bpe_equals_the_library(made, free):
    vocab = bpe.vocabulary(PATH)
    reference = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})
    texts = made + free
    ids, counts = bpe.Encoder(vocab, PATTERN).encode(texts)
    at = 0
    for text, n in zip(texts, counts, strict=True):
        own = ids[at : at + n]
        assert own.tolist() == reference.encode_ordinary(text)
        assert vocab.decode(own) == text.encode()
        at += n


def test_bpe_memory_is_bounded_over_many_distinct_words(reference):
    encoder = bpe.Encoder(bpe.vocabulary(PATH), PATTERN)
    part = lambda k: " ".join(f"w{k}x{i}" for i in range(20_000))
    tracemalloc.start()
    try:
        for k in range(22):
            encoder.encode([part(k)])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert encoder.encode([part(0)])[0].tolist() == reference.encode_ordinary(part(0))
    assert peak < 60 << 20, peak


def test_bpe_long_matches(reference):
    rnd = random.Random(3)
    texts = ["a" * 20_000, "ab" * 3_000, "".join(rnd.choice("abcdefgh") for _ in range(9_000)), " " * 700, "0" * 129]
    ids, counts = bpe.Encoder(bpe.vocabulary(PATH), PATTERN).encode(texts)
    assert ids.tolist() == [i for t in texts for i in reference.encode_ordinary(t)]
    assert counts.sum() == len(ids)


def test_bpe_of_odd_rows(odd_docs, no_docs, reference):
    outputs = ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")
    out = bpe.encode(odd_docs, PATH, PATTERN, carry=("doc_id", "text", "ids"), outputs=outputs[:1] + outputs[2:]).collect()
    assert len(out) == odd_docs.count()
    for r in out:
        text = r.text or ""
        want = np.array(reference.encode_ordinary(text), dtype="<u4")
        assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(want.tobytes()).hexdigest()
        assert bytes(r.decoded) == text.encode() and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    ids = bpe.encode(odd_docs, PATH, PATTERN, carry=("text",)).collect()
    assert all(r.ids == reference.encode_ordinary(r.text or "") for r in ids)
    assert bpe.encode(no_docs, PATH, PATTERN, outputs=outputs).collect() == []


def test_words_are_split_as_bytes():
    texts = [b"", b" A  b\x0bC\n", "É \xa0x\x85y".encode(), b"averyveryverylongword-of-many-bytes averyveryverylongword-of-many-bytez"]
    word, counts, _ = hash_words(texts)
    want = [w for t in texts for w in t.lower().split()]
    assert counts.tolist() == [len(t.lower().split()) for t in texts]
    assert len(dict(zip(want, word.tolist(), strict=True))) == len(set(word.tolist())) == len(set(want))


def brute_sections(text, ids, sizes, rule):
    """Tokens per line, token by token."""
    raw = text.encode()
    line = np.concatenate(([0], np.cumsum(np.frombuffer(raw, dtype=np.uint8) == 10)))[: len(raw)]
    counts, at = [0] * (text.count("\n") + 1), 0
    for i in ids:
        own = line[at : at + sizes[i]].tolist()
        counts[own[0] if rule == "first" else max(sorted(set(own)), key=own.count)] += 1
        at += sizes[i]
    return counts


@pytest.mark.parametrize("rule", tokencount.RULES)
def test_tokens_of_lines(spark, odd_docs, reference, rule):
    _, sizes = tokencount.tokenizer(PATH, PATTERN)
    docs = odd_docs.select("text").dropDuplicates().union(
        spark.createDataFrame([("\n\n\n\nx\n\n",), ("a\n\n\nb",), ("ends\n",)], "text string")
    )
    got = {}
    for r in tokencount.token_counts(docs, PATH, PATTERN, carry=("text",), rule=rule).collect():
        got.setdefault(r.text, {})[r.section] = r.n_tokens
    for (text,) in docs.collect():
        want = brute_sections(text or "", reference.encode_ordinary(text or ""), sizes, rule)
        assert [got[text][i] for i in range(len(got[text]))] == want


def test_tokens_of_given_spans(spark, no_docs, reference):
    text = "Été title\nbody of it"
    df = spark.createDataFrame([(1, text, [(0, 9), (10, 14)])], "doc_id long, text string, f array<struct<start:int,end:int>>")
    out = {r.section: r for r in tokencount.token_counts(df, PATH, PATTERN, spans="f").collect()}
    assert sum(r.n_tokens for r in out.values()) == len(reference.encode_ordinary(text))
    assert set(out) == {0, 1, None} and sum(r.n_bytes for r in out.values()) == len(text.encode())
    assert tokencount.token_counts(no_docs, PATH, PATTERN).collect() == []
    with pytest.raises(ValueError):
        tokencount.token_counts(df, PATH, PATTERN, rule="last")


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site name</h1></header><div id="menu"><a href=x>one</a> <a>two</a></div>
<div id="content"><h2>Title &amp; more</h2><div class="text"><p>First  paragraph, long enough to be the <b>content</b> of this page.<br>Really.
<p>Short&nbsp;one.</div><div class="text"><p>Second section has also quite some text to count as content.</p></div></div>
<div class="comments"><p>I think this is all wrong, a long reader comment that should not be shown here.</p></div>
<aside>Side text that is long enough, too, but aside.</aside><form>Sign up<input></form>
<div class="cookie-notice">We use cookies to make this page better for you and for others.</div><script>var t="</p>";</script></body></html>"""


def test_html_without_article_element():
    assert html.extract(PAGE) == (
        "Title & more\nFirst paragraph, long enough to be the content of this page. Really.\nShort one.\n"
        "Second section has also quite some text to count as content."
    )


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("<!-- never closed <p>x", ""),
        ("plain & simple &lt;text&gt; &bogus; &amp", "plain & simple <text> &bogus; &"),
        ("<ul><li>one<li>two</ul>", "one\ntwo"),
        ('<p title="unclosed>text</p><p>next</p>', "text\nnext"),
        ("a < b and c > d", "a < b and c > d"),
        ("<nav><a>x</a></nav><article><h1>Hi</h1><p>There.</article><footer>A long line of a footer here, longer than all.</footer>", "Hi\nThere."),
        ("<script>only code</script>", ""),
        ("<article><div class=comments><p>No no no.</div><p>Yes</article>", "Yes"),
        ("<body><p hidden>secret<p>seen", "seen"),
    ],
)
def test_html_cases(page, text):
    assert html.extract(page) == text


@pytest.mark.parametrize("wrapper", ["div class='page has-sidebar'", "div class='with-menu'", "form id='aspnetForm'"])
def test_html_wrapper_with_most_of_the_text_stays(wrapper):
    page = f"<body><{wrapper}><h2>Title</h2><p>The text of this page, all of it.</p><div class=comments><p>No.</p></div></{wrapper.split()[0]}></body>"
    assert html.extract(page) == "Title\nThe text of this page, all of it."


def test_html_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", PAGE), (3, "u", PAGE), (4, "u", "<p>" + "word " * 50_000 + "</p>"), (5, "u", "<div>" * 3000 + "deep")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    out = html.main_text(df).collect()
    assert len(out) == 6 and all(r.n_chars == len(r.text) for r in out)
    by = {r.page_id: r.text for r in out}
    assert by[1] == by[2] == "" and by[4] == " ".join(["word"] * 50_000) and by[5] == "deep"
    assert html.main_text(df.limit(0)).collect() == []


def test_language_is_learned_and_held_out(spark):
    from paysignal.llm.queries import op10_langid

    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = [r for r in op10_langid(spark, sf).collect() if r.held_out]
    assert all(0 <= r.score <= 1 for r in out)
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.98 * len(out)
    assert sum(r.rejected for r in out) <= 0.02 * len(out)


def test_language_of_odd_rows(odd_docs, no_docs):
    model = langid.fit(odd_docs)
    assert {k for k, _ in model} == {"en", "de", "fr"}
    out = langid.predict(odd_docs, model, carry=("text", "kept")).collect()
    assert len(out) == odd_docs.count()
    for r in out:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert r.rejected or r.lang_pred != "und"
    assert langid.fit(no_docs) == [] and langid.predict(no_docs, []).collect() == []
    assert {r.lang_pred for r in langid.predict(odd_docs, []).collect()} == {"und"}
    alone = langid.predict(odd_docs.filter("doc_id = 1"), model[:1]).first()
    assert alone.score == 1.0 and not alone.rejected


def test_language_margin_does_not_fall_with_length(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held_out = langid.remainder(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.filter(~held_out))
    found = docs.filter("lang = 'en' AND length(text) > 0").orderBy(~held_out, "doc_id").select("text").collect()
    clean = " ".join(r.text for r in found)
    rows = [(n, clean[:n]) for n in (200_000, 1_000_000, 5_000_000)]
    out = sorted(langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect())
    assert [len(t) for _, t in rows] == [200_000, 1_000_000, 5_000_000] and [r.lang_pred for r in out] == ["en"] * 3
    assert not any(r.rejected for r in out) and all(r.score > 0.8 * out[0].score for r in out), out


def test_letters_are_letters_and_their_marks():
    assert langid.letters("²½① Ⅷ ३") == b""
    assert langid.letters("हिन्दी में, É!") == "हिन्दी में é".encode()
    assert langid.letters("\u0301\u0302") == b""
    assert langid.Classifier([("hi", "हिन्दी में लिखा".encode())]).predict("²½①") == (langid.UNKNOWN, 0.0)


def test_a_repeated_row_is_drawn_once(spark):
    rows = [(1, "the same words again and again", "en")] * 500 + [(2, "andere Worte in einer Sprache", "de")]
    found = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [k for k, _ in found] == ["en", "de"] and found[0][1] == b"the same words again and again"


def test_deep_and_long_pages():
    """Linear in the depth, and no recursion."""
    for n in (3_000, 100_000):
        for tag in ("<div>", "<head>", "<thead>", "<p>a", "<table><tr>", "<li>", "</div>", "<span class=ad>"):
            began = time.perf_counter()
            html.extract(tag * n + "some text")
            assert time.perf_counter() - began < 20
    deep = "<div>" * 5_000 + "<p>words of the article</p><p>and some more</p>" + "</div>" * 5_000
    assert html.extract(f"<body>{deep}</body>") == "words of the article\nand some more"


def test_only_whole_marks_cut():
    body = (
        "<h1>Title</h1><p>A first paragraph of the article with quite a few words in it.</p>"
        "<div class='share-price'><p>The share price rose by ten percent.</p></div><p class='ad-hoc'>An ad-hoc meeting.</p>"
        "<section id='replies-explained'><p>How replies work.</p></section>"
    )
    page = f"<body><nav>Home</nav><article>{body}<div class='share-buttons'>Tweet</div></article><div class='site-footer'>Foot</div></body>"
    want = (
        "Title\nA first paragraph of the article with quite a few words in it.\nThe share price rose by ten percent.\n"
        "An ad-hoc meeting.\nHow replies work."
    )
    assert html.extract(page) == want


def test_densities_decide():
    """Without any telling tag or class, and against one: the dense part is the article."""
    dense = "".join(f"<p>{' '.join(f'word{i}{j}' for j in range(60))}</p>" for i in range(6))
    thin = "".join(f"<p><a href=x>link {i}</a></p>" for i in range(40))
    for frame in ("<div>{}</div><div>{}</div>", "<article>{}</article><section>{}</section>"):
        found = html.extract("<body>" + frame.format(thin, dense) + "</body>")
        assert "word00" in found and "word559" in found and "link" not in found
