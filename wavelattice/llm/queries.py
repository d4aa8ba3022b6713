"""Registered queries of the training-data operators."""

from wavelattice.llm import chat, decontam, filter_audit, html_text, infill, langid, mixing, ngram_join, secrets, suffixes, topk, toxicity, warc

QUERIES = {"op1_decontaminate": decontam.query,
           "op2_warc_zip": warc.query, "op3_secrets": secrets.query, "op4_toxicity": toxicity.query,
           "op5_language": langid.query, "op6_chat_format": chat.query, "op7_ngram_jaccard": ngram_join.query, "op8_top_k": topk.query,
           "op9_mix_sources": mixing.query, "op10_suffix_dedup": suffixes.query, "op11_html_text": html_text.query, "op12_filter_audit": filter_audit.query,
           "op13_fill_in_middle": infill.query}
ORACLES = {"op2_warc_zip": warc.SQL, "op3_secrets": secrets.SQL, "op6_chat_format": chat.SQL, "op7_ngram_jaccard": ngram_join.SQL,
           "op8_top_k": topk.SQL, "op9_mix_sources": mixing.SQL, "op10_suffix_dedup": suffixes.SQL, "op11_html_text": html_text.SQL, "op12_filter_audit": filter_audit.SQL, "op13_fill_in_middle": infill.SQL}
