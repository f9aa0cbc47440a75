"""What the second review found missing, against brute force where that is possible."""

import re
import time
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tripspark.llm import chat_format, decontaminate, html_extract, licenses, toxicity

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ascii_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_Z))


def licenses_of(text):
    """(labels by template, best share) over all windows."""
    own, found, best = ascii_words(text), set(), 0.0
    for label, notice in licenses.TEMPLATES:
        tokens, span = set(notice.split()), -(-len(notice.split()) * 5 // 4)
        lacking = max(len(tokens) >= 8, len(tokens) * 5 // 100)
        for i in range(len(own)):
            left = tokens - set(own[i:i + span])
            if len(left) <= lacking and not left & licenses.NAMES:
                found.add(label)
                best = max(best, 1 - len(left) / len(tokens))
    return found, best


def test_wrapped_notices(spark):
    texts, expected = [], []
    for label, notice in licenses.TEMPLATES:
        own = notice.split()
        for width in (1, 3, 5):  # words a line, as comments
            lines = [" ".join(own[i:i + width]) for i in range(0, len(own), width)]
            texts.append("first line\n# " + "\n# ".join(lines) + ".\nlast line")
            expected.append(label)
    for at in (200, 250, 256, 300):  # across the borders of pieces
        texts.append("word\n" * at + licenses.TEMPLATES[9][1].replace(" ", "\n") + "\nend" * 300)
        expected.append("bsd")
    # The words of a notice, but far apart.
    texts.append(("\n" + "filler " * 30 + "\n").join(licenses.TEMPLATES[12][1].split()))
    expected.append(None)
    texts.append(" ".join("filler " * 30 + w for w in licenses.TEMPLATES[12][1].split()))
    expected.append(None)  # the same on one line
    texts.append("word " * 700 + licenses.TEMPLATES[9][1] + " end" * 300)
    expected.append("bsd")
    # One word changed, which is no name; and one that is.
    texts.append(licenses.TEMPLATES[9][1].replace("without modification", "without changes"))
    expected.append("bsd")
    texts.append("This Source Code Form is subject to the terms of the Mozilla Public Licence, v. 2.0.")
    expected.append("mpl")
    texts.append(licenses.TEMPLATES[12][1].replace("eclipse", "other"))
    expected.append(None)
    texts.append("under the terms of the GNU general public license")
    expected.append(None)  # neither lgpl nor agpl
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = {r["doc_id"]: r for r in licenses.license_scan(docs).collect()}
    documents = docs.toPandas()  # the SQL says the same of them
    with duckdb.connect() as db:
        db.register("documents", documents)
        said = db.execute(licenses.SQL).fetch_df().set_index("doc_id")
    for i, row in rows.items():
        assert (said.labels[i], said.n_base[i]) == (row["labels"], row["n_base"])
        assert said.score[i] == pytest.approx(row["score"])
    for i, text in enumerate(texts):
        found, best = licenses_of(text)
        base = set(filter(None, rows[i]["base_labels"].split(",")))
        assert set(filter(None, rows[i]["labels"].split(","))) == found | base
        assert expected[i] is None and not found or expected[i] in found
        assert rows[i]["score"] == pytest.approx(1.0 if base else best)


ARTICLE = "<article><h1>Title</h1><p>The text of it, long enough. And more.</p></article>"
STORY = "Title\nThe text of it, long enough. And more."


@pytest.mark.parametrize("page,text", [
    (f"<body><div class='layout has-sidebar'>{ARTICLE}</div></body>", STORY),
    (f"<body><div class='post comments-open'>{ARTICLE}</div></body>", STORY),
    (f"<body><div class='no-comments'>{ARTICLE}</div></body>", STORY),
    (f"<body><div class='share-price'>{ARTICLE}</div></body>", STORY),
    (f"<body><div class='layout sidebar'>{ARTICLE}</div></body>", STORY),
    (f"<body><form id=aspnet><div class=ad>Buy</div>{ARTICLE}</form></body>", STORY),
    (f"<body><form><div class=related><article>Card.</article></div>{ARTICLE}</form></body>", STORY),
    ("<body><form><fieldset><h1>Title</h1><p>The text of it, long enough. And more.</p>"
     "</fieldset></form></body>", STORY),
    ("<body><div class='cookie'>Yes</div><div class='widget'><div><p>Only text. Of the page."
     "</p></div></div></body>", "Only text. Of the page."),
    (f"<body>{ARTICLE}<div class='comments'>{'A long comment, indeed. ' * 50}</div></body>", STORY),
    (f"<body>{ARTICLE}<div class='comment-list'>No.</div><p class='site-footer'>No.</p>"
     "<form>Name <p>No.</p></form><div id=sidebar-1>No.</div></body>", STORY),
    ("<article><p>Before <span class=ad>buy</span> after.</p></article>", "Before after."),
])
def test_marks_on_wrappers_and_forms(page, text):
    assert html_extract.extract(page, None) == text


LEAD, LONG = "A lead of some words.", "The body of the text, which is long. " * 20
LAYOUTS = [
    "<body><article><h1>T{i}</h1><p>{lead}</p><div class='body'>{long}</div></article>{rest}</body>",
    "<body><main><h1>T{i}</h1><article><p>{lead}</p><div class='body'>{long}</div></article></main>"
    "{rest}</body>",
    "<body><article><h1>T{i}</h1><section class='intro'><p>{lead}</p></section>"
    "<section class='details'>{long}</section></article>{rest}</body>",
    "<body><div class='post'><h1>T{i}</h1><div class='intro'>{lead}</div><div class='in'>"
    "<div class='body'>{long}</div></div></div>{rest}</body>",
    "<body><h1>T{i}</h1><p>{lead}</p><div class='body'>{long}</div>{rest}</body>",
]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_articles_in_nested_containers(spark, layout):
    rest = "<div class='more'><a href=x>Another page</a> <a href=y>And another</a></div>"
    rows = [(i, "http://h.example/", layout.format(i=i, lead=LEAD, long=LONG, rest=rest))
            for i in range(4)]
    rows.append((9, "http://h.example/", layout.format(i=9, lead=LEAD * 99, long="Short.", rest=rest)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_extract.extract_pages(pages).collect()}
    assert found == {i: f"T{i}\n{LEAD}\n{LONG.strip()}" for i in range(4)} | {
        9: f"T9\n{LEAD * 99}\nShort."}


def test_sibling_sections_of_a_body():
    page = (f"<body><section class='a'>{LONG}</section><section class='b'>{LONG}</section>"
            "<div class='x'><a href=x>Link</a></div></body>")
    assert html_extract.extract(page, None) == f"{LONG.strip()}\n{LONG.strip()}"


def test_changed_copies_of_short_items(spark):
    """Items of 1 to 14 words, each with up to three words changed, against every alignment."""
    rng = np.random.default_rng(5)
    items = [(n, " ".join(f"w{n}x{i}" for i in range(n))) for n in range(1, 15)]
    items += [(None, "no id one"), (None, "no id two of seven words here"), (20, ""), (21, None)]
    docs = []
    for _, text in items[:-2]:
        own = text.split()
        for changes in range(4):
            for _ in range(3):
                new = list(own)
                for at in rng.choice(len(own), min(changes, len(own)), replace=False):
                    new[at] = "changed"
                docs.append(" ".join(["before", *new, "after"]))
    docs.append("no id one then no id two of seven words here, and w1x0")
    expected = {}
    for i, doc in enumerate(docs):
        doc, hits = ascii_words(doc), []
        for number, text in items:
            own = ascii_words(text)
            best = 0
            for start in range(len(doc) - len(own) + 1 if own else 0):
                same = [a == b for a, b in zip(own, doc[start:])]
                width = min(decontaminate.WINDOW, len(own))
                need = decontaminate.SHARE if len(own) >= decontaminate.MIN_WORDS else 1
                if max(sum(same[j:j + width]) for j in range(len(own) - width + 1)) / width >= need:
                    best = max(best, sum(same))
            if best:
                hits.append((best, number))
        most = max((b for b, _ in hits), default=0)
        ids = [n for b, n in hits if b == most and n is not None]
        expected[i] = (bool(hits), len(hits), min(ids, default=None), most)
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r["doc_id"]: (r["contaminated"], r["n_items"], r["item_id"], r["equal_words"])
             for r in decontaminate.contamination(frame, bench).collect()}
    assert found == expected


def test_pipeline_decides_by_row(spark, sf, tmp_path):
    """Rows that share a doc_id or have none go only if they themselves are copies or leaks."""
    item = " ".join(f"q{i}" for i in range(20))
    one, two, three = (" ".join(f"{c}{i}" for i in range(30)) for c in "xyz")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    rows = [(1, one), (1, two), (2, one), (None, three), (None, three), (3, item), (3, "clean text"),
            (None, "before " + item), (4, ""), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.one_of_each_group(spark, docs, str(tmp_path)).collect()
    assert Counter(map(tuple, kept)) == Counter(
        [(1, one), (1, two), (None, three), (3, item), (3, "clean text"), (4, ""), (4, None)])
    kept = corpus_pipeline.drop_benchmark(spark, docs, str(tmp_path)).collect()
    assert Counter(map(tuple, kept)) == Counter(r for r in rows if item not in (r[1] or ""))


def test_toxicity_of_the_pipeline_is_by_row(spark, sf):
    sf = sf.replace("0.001", "0.01")
    whole = spark.read.parquet(f"{sf}/documents.parquet")
    scores = toxicity.toxicity_scores(whole, whole, spark.read.parquet(f"{sf}/labels.parquet"))
    bad = scores.where("predicted = 1").join(whole.select("doc_id", "text"), "doc_id").first()
    clean = whole.join(scores.where("predicted = 0"), "doc_id").select(whole.columns).first()
    extra = spark.createDataFrame(
        [{**clean.asDict(), "doc_id": bad["doc_id"]}, {**clean.asDict(), "doc_id": None,
                                                       "text": bad["text"]}], whole.schema)
    docs = whole.unionByName(extra)
    again = toxicity.toxicity_scores(docs, docs, spark.read.parquet(f"{sf}/labels.parquet"))
    expected = again.where("predicted = 0").count()
    kept = corpus_pipeline.drop_toxic(spark, docs, sf)
    assert kept.count() == expected
    assert kept.where(f"doc_id = {bad['doc_id']}").count() == again.where(
        f"predicted = 0 and doc_id = {bad['doc_id']}").count() > 0


def deep(parts):
    return "".join(parts * 20_000)


@pytest.mark.parametrize("page,words", [
    (deep(["<div>word "]), 20_000),
    (deep(["<div class=a>word </b><p>more "]), 40_000),
    (deep(["<span>"]) + deep(["<div>word</div>"]), 20_000),
    (deep(["<div>"]) + deep(["<li>word"]), 20_000),
    (deep(["<form>"]) + "<article>word</article>" + deep([" more</form>"]), 20_001),
])
def test_deep_nesting_takes_time_in_proportion(page, words):
    started = time.monotonic()
    own, _ = html_extract.page_votes(page)
    assert len(html_extract.extract(page, None).split()) == words
    assert time.monotonic() - started < 30  # work in the square of the depth takes minutes
    assert sum(map(len, own)) < 400 * words


def test_deep_paths_keep_their_names():
    inside = "<main><p>The text of it, long enough. And more.</p></main><p>Other.</p>"
    pages = [f"{'<div class=x>' * n}{inside}" for n in (10, 100, 100, 101)]
    votes = [html_extract.page_votes(page)[0] for page in pages]
    best = [max(own, key=lambda p: own[p][0]) for own in votes]
    assert best[1] == best[2] and len(set(best)) == 3
    assert best[0].count("/") == 11 and best[1].rpartition("/")[2].startswith("main.~")
    for page, path in zip(pages, best):
        assert html_extract.extract(page, path) == "The text of it, long enough. And more."


@pytest.mark.parametrize("template", [
    "{{ 'a' * 1000000000000 }}", "{{ '%999999999d' % 1 }}", "{{ [1] * 99999999999 }}",
    "{{ 2 * " + "9" * 40 + " }}"])
def test_templates_make_no_large_values(template):
    with pytest.raises(chat_format.TemplateError):
        chat_format.compile_template(template)()
