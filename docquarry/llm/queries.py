"""The operators and the pipeline as registered queries."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import corpus_pipeline
from docquarry.catalog.registry import Catalog, Tables
from docquarry.llm import (balltree, bpe, lines, merkle, minhash, mixing, prefixes, revisits, substring,
                           suffixes, tokencounts, toxicity, winnowing)

QUERIES = Catalog()
query = QUERIES.query


@query()
def op7_bpe_chunk_reuse(t: Tables) -> DataFrame:
    return bpe.encode_documents(t.documents, public_tokenizers.path("word_bpe_49k.json"))


@query(substring.WINDOW_SQL)
def op3_substring_count_min(t: Tables) -> DataFrame:
    return substring.remove_repeats(t.documents)


@query(minhash.NEAR_SQL)
def op8_minhash_fast_sketch(t: Tables) -> DataFrame:
    return minhash.near_duplicates(t.documents, words=4)


@query()
def op6_toxicity_string_kernel(t: Tables) -> DataFrame:
    return toxicity.toxicity(t.documents, t.labels)


@query(mixing.MIX_SQL)
def op4_mixing_pareto(t: Tables) -> DataFrame:
    return mixing.mix(t.documents)


@query(balltree.TOP_SQL)
def op10_top_k_ball_tree(t: Tables) -> DataFrame:
    return balltree.top_k(t.embeddings)


@query()
def op9_fingerprints_winnowing(t: Tables) -> DataFrame:
    return winnowing.edited(t.documents)


@query()
def op5_line_chunks(t: Tables) -> DataFrame:
    return lines.remove_repeats(t.documents, whole=True)


@query(revisits.REVISIT_SQL)
def op1_warc_revisits(t: Tables) -> DataFrame:
    found = revisits.resolve(revisits.captures(t.pages))
    return found.select("record_id", "canonical_url", "refers_to", "verdict",
                        *[F.col("headers")[name].alias(name.replace("-", "_"))
                          for name in ("date", "cache-control", "content-type", "server")])


def pipeline(spark, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES.runs["pipeline"] = pipeline
if corpus_pipeline.ORACLE_SQL:
    QUERIES.sql["pipeline"] = corpus_pipeline.ORACLE_SQL


@query(suffixes.STRING_SQL)
def op2_suffix_difference_cover(t: Tables) -> DataFrame:
    return suffixes.remove_repeats(t.documents)


@query(prefixes.TRIE_SQL)
def op11_prefix_trie_peeling(t: Tables) -> DataFrame:
    return prefixes.conversation_trie(t.conversations)


@query()
def op12_token_counts_lookup(t: Tables) -> DataFrame:
    return tokencounts.count_tokens(t.documents, public_tokenizers.path("word_bpe_49k.json"))


@query(merkle.MERKLE_SQL)
def op13_merkle_manifest(t: Tables) -> DataFrame:
    return merkle.verified_manifest(t.documents)
