"""Queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import alignment, bpe, crf, lm, nndescent, packing, prefix_trie, rank_queue, rules, secrets, simhash, toxicity, warc

QUERIES = {
    build.__name__: build
    for build in (
        toxicity.op1_toxicity_grammar,
        bpe.op2_word_table_bpe,
        packing.op3_best_fit_packing,
        crf.op4_quality_crf,
        warc.op5_warc,
        simhash.op6_simhash,
        secrets.op7_secret_scan,
        nndescent.op8_nn_descent,
        lm.op9_log_bilinear,
        rules.op10_quality_rules,
        prefix_trie.op11_prefix_trie,
        rank_queue.op12_rank_queue_bpe,
        alignment.op13_token_alignment,
    )
}
SQL = {"op5_warc": warc.SQL, "op10_quality_rules": rules.SQL, "op11_prefix_trie": prefix_trie.SQL}
