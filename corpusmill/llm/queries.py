"""The queries of this subpackage and, where SQL can express them, their SQL."""

from corpusmill.llm import counting, divergence, language, lattice, minhash, mixing, periods, pieces, quality, recurrent, sharding, toxicity, warc

QUERIES = {
    "op1_lattice_hashing": lattice.op1_lattice_hashing,
    "op2_recurrent_lm": recurrent.op2_recurrent_lm,
    "op3_minhash_bayes": minhash.op3_minhash_bayes,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_shard_documents": sharding.op6_shard_documents,
    "op7_sentencepiece": pieces.op7_sentencepiece,
    "op8_language_id": language.op8_language_id,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_warc_round_trip": warc.op10_warc_round_trip,
    "op11_token_counts": counting.op11_token_counts,
    "op12_periodic_runs": periods.op12_periodic_runs,
    "op13_source_divergence": divergence.op13_source_divergence,
}

ORACLE_SQL = {
    "op1_lattice_hashing": lattice.OP1_SQL,
    "op3_minhash_bayes": minhash.OP3_SQL,
    "op5_mix_sources": mixing.OP5_SQL,
    "op10_warc_round_trip": warc.OP10_SQL,
    "op13_source_divergence": divergence.OP13_SQL,
}
