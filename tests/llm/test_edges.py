"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib

import pytest

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tripspark.llm import (chat_format, decontaminate, exact_dedup, hpy_lm, html_extract,
                           jaccard_join, licenses, mixing, token_files, toxicity)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LONG = "the quick brown fox jumps over it. " * 40_000
ROWS = [
    (1, "released under the MIT License", "en", "a", 30), (2, None, None, None, None),
    (3, "", "en", "a", 0), (None, "a text without an id", "en", "b", 20),
    (4, "one two", "de", "b", 7), (4, "one two", "de", "b", 7), (5, LONG, "en", "b", len(LONG)),
    (6, LONG + "x", "en", "b", len(LONG) + 1), (7, " \t\n\x0b ", "en", "c", 5),
    (None, None, None, None, None), (8, "one  two", "de", None, 8), (9, "é\u0000x 𝄞 ﬀ", "fr", "c", 7),
]
KIND = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; the input's columns of these names must not disturb them.
CLASH = ("row norm cut large nth run_id run_size words lowered places label block token size at "
         "need both pivot head rep n buckets key score predicted component node a b u v "
         "mix_source mix_block mix_slot part seq start ids host path chunk data held_out").split()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, KIND)


@pytest.fixture(scope="module")
def clashing(docs):
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 1), (4, 1, 0), (4, 0, 1), (5, 1, 0), (None, 1, 1),
                                  (9, None, None), (99, 0, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "quick brown fox jumps over it the quick"), (2, None),
                                  (None, "one two three four five six"), (3, "")],
                                 "item_id long, text string")


def table(df):
    return sorted(map(repr, df.collect()))


def operators(bench, labels):
    return {
        "op1": licenses.license_scan,
        "op2": lambda d: toxicity.held_out_scores(d, labels),
        "op4": lambda d: token_files.token_digests(d, TOKENIZER),
        "op5": exact_dedup.exact_duplicates,
        "op6": mixing.mixture,
        "op7": hpy_lm.held_out_scores,
        "op9": lambda d: decontaminate.contamination(d, bench),
        "op10": jaccard_join.jaccard_components,
    }


@pytest.mark.parametrize("name", ["op1", "op2", "op4", "op5", "op6", "op7", "op9", "op10"])
def test_empty_tables_and_clashing_columns(name, docs, clashing, empty, bench, labels):
    run = operators(bench, labels)[name]
    none = run(empty)
    assert none.count() == 0
    plain = run(docs)
    assert none.columns == plain.columns
    rows = table(plain)
    assert rows == table(run(clashing))
    assert len(rows) >= len(ROWS)  # every row has a result; mixing may read some twice


def test_license_scan(docs):
    found = {(r["doc_id"], r["n_words"]): r for r in licenses.license_scan(docs).collect()}
    mit = found[1, 5]
    assert (mit["n_base"], mit["first_word"], mit["last_word"], mit["base_labels"], mit["labels"],
            mit["score"]) == (1, 3, 3, "mit", "mit", 1.0)
    for key in ((2, 0), (3, 0), (7, 0)):
        own = found[key]
        assert (own["n_base"], own["first_word"], own["labels"], own["score"]) == (0, None, "", 0.0)


def test_license_scan_by_template(spark):
    texts = ["x\nLicensed under CC BY-NC 4.0.\ny", "MIT license mit LICENSE", "license mit",
             "This work is licensed under the GNU General Public License, version 3.",
             "work licensed under the gnu general public license version", "gnu\ngeneral license"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r["doc_id"]: (r["n_base"], r["first_word"], r["last_word"], r["labels"], r["score"])
             for r in licenses.license_scan(docs).collect()}
    assert found[0] == (1, 3, 3, "cc-by,cc-by-nc", 1.0)
    assert found[1][:3] == (2, 0, 2) and found[2] == (0, None, None, "", 0.0)
    assert found[3] == (1, 6, 6, "gpl", 1.0) and found[4][3] == "gpl" and found[5][3] == ""


def test_exact_duplicates(spark, docs):
    found = exact_dedup.exact_duplicates(docs).collect()
    groups = {(r["doc_id"], r["text_sha256"]): r for r in found}
    one = hashlib.sha256(b"one two").hexdigest()
    assert (groups[8, one]["keep_id"], groups[8, one]["group_size"]) == (4, 3)
    assert sum(r["kept"] for r in found if r["text_sha256"] == one) == 1
    nothing = hashlib.sha256(b"").hexdigest()
    assert groups[None, nothing]["keep_id"] == 2 and groups[3, nothing]["group_size"] == 3
    space = hashlib.sha256(b" ").hexdigest()
    assert groups[7, space]["group_size"] == 1


def test_exact_duplicates_of_one_text_in_many_rows(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(
            F.concat(F.lit("own "), (F.col("id") % 1500).cast("string"))).alias("text"))
    found = exact_dedup.exact_duplicates(docs)
    by = {r["keep_id"]: (r["n"], r["k"], r["s"]) for r in found.groupBy("keep_id").agg(
        F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("k"),
        F.max("group_size").alias("s")).collect()}
    assert by.pop(0) == (1000, 1, 1000)
    assert set(by.values()) == {(2, 1, 2)} and len(by) == 1000


def test_token_files_in_order(docs):
    found = token_files.token_digests(docs, TOKENIZER).collect()
    found.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [None, None, 1, 2, 3, 4, 4, 5, 6, 7, 8, 9]
    before = 0
    for r in found:
        assert r["start"] == before
        before += r["n_tokens"]


def test_token_file_blocks_decode_alone_and_detect_damage():
    import numpy as np
    ids = np.random.default_rng(1).zipf(1.3, 20_000) % 500
    data = token_files.Table(token_files.frequencies(np.bincount(ids, minlength=600)))
    body = token_files.encode_file(ids, [5, None], [15_000, 5_000], data)
    docs, lengths, n, index, stream = token_files.read_index(body, data)
    assert (docs, list(lengths), n) == ([5, None], [15_000, 5_000], 20_000)
    assert len(body) < 2 * len(ids)
    assert (token_files.decode_blocks(index, stream, n, data) == ids).all()
    third = token_files.decode_blocks(index, stream, n, data, 2, 3)
    assert (third == ids[2 * token_files.BLOCK:3 * token_files.BLOCK]).all()
    last = token_files.decode_blocks(index, stream, n, data, 4)
    assert (last == ids[4 * token_files.BLOCK:]).all()
    broken = bytearray(body)
    broken[-7] ^= 1
    with pytest.raises(ValueError):
        token_files.decode_blocks(*[token_files.read_index(bytes(broken), data)[k]
                                    for k in (3, 4)], n, data)
    other = token_files.Table(token_files.frequencies(np.ones(600, np.int64)))
    with pytest.raises(ValueError):
        token_files.read_index(body, other)
    with pytest.raises(ValueError):
        token_files.encode_file(np.array([599]), [1], [1], data)


def test_frequencies_keep_rare_ids():
    import numpy as np
    counts = np.ones(50_000, np.int64)
    counts[7] = 10**12
    freq = token_files.frequencies(counts)
    assert freq.sum() == 1 << token_files.SCALE and freq.min() == 1
    assert token_files.frequencies(np.zeros(10, np.int64)).sum() == 1 << token_files.SCALE


def test_components_and_short_texts(docs):
    found = jaccard_join.jaccard_components(docs).collect()
    ids = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found]
    assert ids.count((4, 1, 4)) == 2 and (8, 1, 4) in ids
    assert (6, 8, 5) in ids and (2, 0, 2) in ids and (7, 0, 7) in ids
    assert (None, 2, None) in ids and (None, 0, None) in ids


def test_mixing_keeps_every_row(docs):
    found = mixing.mix(docs)
    assert found.columns[:5] == docs.columns
    once = found.where("mix_epoch = 0").select(docs.columns)
    assert table(once) == table(docs)


PAGES = [
    (1, "http://A.example/x", "<html><body><nav>menu</nav><article><h1>Title &amp; more</h1>"
        "<p>First  text,\n with <b>bold</b>.<br>Line<p>Second &lt;p&gt; text.</article>"
        "<div class='comments'>no</div><footer>foot</footer>"),
    (2, "http://a.example/y", "<body><div id=side class='sidebar-1'>links</div><article>Only"
        " words.<script>var t='</p>';</script><ul><li>one<li>two</ul></article><aside>x</aside>"),
    (3, None, None), (4, "", ""), (None, "http://a.example:80/z", "no markup, only text"),
    (5, "http://b.example/", "<div class=ad>buy</div><!-- <p>gone</p> --><p>Broken <i>tags here"),
    (6, "http://b.example/", "<p>"), (1, "http://A.example/x", "<article>again</article>"),
]


def test_html_extraction(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    found = sorted(html_extract.extract_pages(pages).collect(), key=lambda r: (r[0] or 0, r[3]))
    texts = [(r["page_id"], r["text"]) for r in found]
    assert texts == [
        (None, "no markup, only text"), (1, "again"),
        (1, "Title & more\nFirst text, with bold. Line\nSecond <p> text."),
        (2, "Only words.\none\ntwo"), (3, ""), (4, ""), (5, "Broken tags here"), (6, "")]
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert html_extract.extract_pages(pages.limit(0)).count() == 0
    clash = pages.select("*", F.lit(1).alias("host"), F.lit(2).alias("path"), F.lit(3).alias("text"))
    assert table(html_extract.extract_pages(clash)) == table(html_extract.extract_pages(pages))


def test_pages_of_a_host_agree_on_containers(spark):
    """One page's longest container is a teaser box; the host's other pages outvote it."""
    def page(main, box):
        return (f"<body><div class='content c12'><p>{main}</p></div>"
                f"<div class='box'><p>{box}</p></div></body>")
    rows = [(i, f"http://h.example/{i}", page("Main text, long. " * 20, "teaser")) for i in range(5)]
    rows.append((9, "http://h.example/9", page("Short one.", "A long teaser, indeed. " * 9)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_extract.extract_pages(pages).collect()}
    assert found[9] == "Short one." and found[0] == ("Main text, long. " * 20).strip()


TURNS = [
    (1, 0, "user", "a\\b </s> \\</s> [INST]"), (1, 1, "assistant", "[/INST]\\"),
    (1, 2, None, None), (2, 5, "assistant", ""), (2, None, "assistant", "first"),
    (None, 1, "user", "x"), (3, 1, "user", "b"), (3, 1, "user", "a"), (3, 1, "user", "a"),
]


def test_chat_format(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    written = {r["conv_id"]: r for r in chat_format.format_conversations(turns).collect()}
    said, loss = chat_format.read_back(written[1]["formatted"], written[1]["spans"])
    assert said == [("user", "a\\b </s> \\</s> [INST]"), ("assistant", "[/INST]\\"), ("", "")]
    assert loss == "[/INST]\\"
    assert chat_format.read_back(written[2]["formatted"], written[2]["spans"]) == (
        [("assistant", "first"), ("assistant", "")], "first")
    assert [t for _, t in chat_format.read_back(written[3]["formatted"], [])[0]] == ["a", "a", "b"]
    assert written[1]["formatted"].count("</s>") == 3
    digests = {r["conv_id"]: r for r in chat_format.format_digests(turns).collect()}
    assert digests[1]["turns_sha256"] == hashlib.sha256(
        "".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
    assert set(digests) == {None, 1, 2, 3} and digests[None]["n_turns"] == 1
    assert chat_format.format_digests(turns.limit(0)).count() == 0
    clash = turns.select("*", F.lit(1).alias("spans"), F.lit(2).alias("formatted"))
    assert table(chat_format.format_digests(clash)) == table(chat_format.format_digests(turns))


@pytest.mark.parametrize("text", ["", "\\", "\\\\", "<s", "</s></s>", "<\\s>", "[INST][/INST]<s>",
                                  "\\\\</s>", "</\\s>", "[/INST"])
def test_escapes_are_reversible(text):
    escaped = chat_format.escape(text)
    assert chat_format.unescape(escaped) == text
    assert not any(mark in escaped for mark in chat_format.CONTROL)


def test_template_language():
    def show(source, **names):
        return chat_format.compile_template(source)(**names)[0]
    assert show("{{ 1 + 2 * 3 }} {{ 'a' ~ 1 }}{# no #}{{ none }}") == "7 a1"
    assert show("{% for x in xs %}{{ loop.index }}{{ x }}{% if not loop.last %},{% endif %}"
                "{% endfor %}", xs=["a", "b"]) == "1a,2b"
    assert show("{% if a == 1 %}x{% elif a in [2, 3] and b %}y{% else %}z{% endif %}",
                a=3, b=True) == "y"
    assert show("  {%- set t = x.k | upper | trim -%}  {{ t if t else 'none' }}",
                x={"k": " q "}) == "Q"
    text, spans = chat_format.compile_template(
        "a{% generation %}é{{ x['y'] }}{% endgeneration %}b")(x={"y": "𝄞"})
    assert (text, spans) == ("aé𝄞b", [(1, 3)])
    folded = chat_format.fold_body(chat_format.parse(
        "a{% if 1 == 1 %}b{{ 'c' | upper }}{% else %}{{ x }}{% endif %}d"))
    assert folded == [("text", "abCd")]
    for bad in ("{{ x.__class__ }}", "{{ x | nothing }}", "{% for x %}{% endfor %}", "{{ f(1) }}",
                "{% if x %}", "{{ 'a }}", "{{ x", "{% import os %}", "{{ _x }}"):
        with pytest.raises(chat_format.TemplateError):
            chat_format.compile_template(bad)
    with pytest.raises(chat_format.TemplateError):
        show("{{ x['a'] }}", x=3)


def test_pipeline_stages(spark, sf, docs, clashing, tmp_path):
    """Every stage on odd rows and on an empty table; what it keeps has the columns of documents."""
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for table_ in (clashing, docs.limit(0)):
            found = stage(spark, table_, str(tmp_path))
            assert found.count() >= (0 if table_ is not clashing else 1)
            if name != "token_files":
                assert found.columns == table_.columns
