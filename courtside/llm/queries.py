"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from courtside.llm import (bpe, decontaminate, exact_dedup, kneser_ney, licences, repair, setsketch,
                           sharding, token_counts, toxicity, unigram, warc, whitening)

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_sentencepiece": unigram.op2_sentencepiece,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_warc": warc.op6_warc,
    "op7_licence_scan": licences.op7_licence_scan,
    "op8_kneser_ney": kneser_ney.op8_kneser_ney,
    "op9_minhash_neardup": setsketch.op9_minhash_neardup,
    "op10_sharding": sharding.op10_sharding,
    "op11_conversation_repair": repair.op11_conversation_repair,
    "op12_whitening": whitening.op12_whitening,
    "op13_byte_bpe": bpe.op13_byte_bpe,
}

SQL = {
    "op1_decontaminate": decontaminate.SQL,
    "op3_exact_dedup": exact_dedup.SQL,
    "op6_warc": warc.SQL,
    "op9_minhash_neardup": setsketch.SQL,
    "op11_conversation_repair": repair.SQL,
}
