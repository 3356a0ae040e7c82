"""The queries ``opN_<name>``: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabtext.llm import decontam, gatedlm, html, langid, lexical, mixing, packing, pii, prefixtrie, simhash, suffix, tokencount, topk
from tabtext.llm import sql as S
from tabtext.llm.registry import query, table


@query("op1_pii", S.PII)
def op1_pii(spark, sf_dir):
    """Base spans and disclosing terms of every document."""
    return pii.detect(table(spark, sf_dir, "documents"))


@query("op2_language_id")
def op2_language_id(spark, sf_dir):
    """Predicted language of every document, trained on rows whose id hash is not held out."""
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op3_token_counts")
def op3_token_counts(spark, sf_dir):
    """Tokens of every document, counted by a separator scan over flat token files written from them."""
    return tokencount.document_tokens(table(spark, sf_dir, "documents"))


@query("op4_simhash_near_dedup")
def op4_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_benchmark_decontamination", S.DECONTAMINATION)
def op5_benchmark_decontamination(spark, sf_dir):
    """Words of every document that lie in benchmark windows."""
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_mixing", S.MIXING)
def op6_mixing(spark, sf_dir):
    """Slot and position of every document in the mix of sources."""
    return mixing.schedule(table(spark, sf_dir, "documents"))


@query("op7_exact_topk", S.TOPK)
def op7_exact_topk(spark, sf_dir):
    """The 20 best inner products of each query vector against all rows."""
    return topk.search(table(spark, sf_dir, "embeddings"))


@query("op8_suffix_dedup", S.REPEATS)
def op8_suffix_dedup(spark, sf_dir):
    """Bytes of every document covered by a 200-byte string that starts elsewhere too."""
    return suffix.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op9_html_extraction")
def op9_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return html.extract_pages(table(spark, sf_dir, "pages"))


@query("op10_token_output")
def op10_token_output(spark, sf_dir):
    """Packed token rows of every document: ids, cumulative segment lengths, restarting positions."""
    return packing.pack(table(spark, sf_dir, "documents")) \
        .withColumn("n_segments", F.size("doc_ids"))


@query("op11_prefix_trie", S.PREFIX_TRIE)
def op11_prefix_trie(spark, sf_dir):
    """Every node of the trie of the rebuilt conversations."""
    return prefixtrie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op12_lm_score")
def op12_lm_score(spark, sf_dir):
    """Log-likelihood of every document, by counts and by the recurrent model."""
    return gatedlm.score_documents(table(spark, sf_dir, "documents"))


@query("op13_ranked_search", S.RANKED_SEARCH)
def op13_ranked_search(spark, sf_dir):
    """The 10 best-scoring documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
