"""One query per operator over its whole table, and the SQL of those that SQL can state."""

import public_tokenizers

from . import (chat_format, decontaminate, exact_dedup, hpy_lm, html_extract, jaccard_join,
               licenses, mixing, prefix_trie, spelling, token_files, toxicity, vector_search)
from .common import read_table

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return register


@query(licenses.SQL)
def op1_license_scan(spark, sf):
    return licenses.license_scan(read_table(spark, sf, "documents"))


@query()
def op2_toxicity(spark, sf):
    return toxicity.held_out_scores(read_table(spark, sf, "documents"),
                                    read_table(spark, sf, "labels"))


@query()
def op3_html_extraction(spark, sf):
    return html_extract.extract_pages(read_table(spark, sf, "pages")).drop("path")


@query()
def op4_token_files(spark, sf):
    return token_files.token_digests(read_table(spark, sf, "documents"),
                                     public_tokenizers.path("word_bpe_49k.json"))


@query(exact_dedup.SQL)
def op5_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(read_table(spark, sf, "documents"))


@query()
def op6_mixing(spark, sf):
    return mixing.mixture(read_table(spark, sf, "documents"))


@query()
def op7_language_model(spark, sf):
    return hpy_lm.held_out_scores(read_table(spark, sf, "documents"))


@query(chat_format.SQL)
def op8_chat_format(spark, sf):
    return chat_format.format_digests(
        chat_format.with_hostile(read_table(spark, sf, "conversations")))


@query()
def op9_decontamination(spark, sf):
    return decontaminate.contamination(read_table(spark, sf, "documents"),
                                       read_table(spark, sf, "benchmark"))


@query(jaccard_join.SQL)
def op10_jaccard_join(spark, sf):
    return jaccard_join.jaccard_components(read_table(spark, sf, "documents"))


@query(spelling.SQL)
def op11_spelling_variants(spark, sf):
    return spelling.spelling_variants(read_table(spark, sf, "documents"), noise=31)


@query()
def op12_nearest_neighbours(spark, sf):
    return vector_search.nearest(read_table(spark, sf, "embeddings"))


@query(prefix_trie.SQL)
def op13_prefix_trie(spark, sf):
    return prefix_trie.rebuilt_trie(read_table(spark, sf, "conversations"))
