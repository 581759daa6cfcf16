"""The queries of this package and the SQL that some of them can be held against."""

from clickrate.llm import chat, decontam, langid, lexical, licences, minhash, packing, quality, repetition, secrets, token_counts, urls, whitening

_ALL = (licences.op1_license_scans, secrets.op2_secret_scans, minhash.op3_minhash_near_dedup, token_counts.op4_token_counts, repetition.op5_suffix_array_repetition,
        urls.op6_url_filters, langid.op7_language_id, decontam.op8_benchmark_decontamination, packing.op9_best_fit_packing, quality.op10_quality_classifier,
        chat.op11_chat_formatting, whitening.op12_embedding_whitening, lexical.op13_ranked_lexical_search)
QUERIES = {f.__name__: f for f in _ALL}
ORACLE_SQL = {"op3_minhash_near_dedup": minhash.OP3_SQL, "op5_suffix_array_repetition": repetition.OP5_SQL,
              "op6_url_filters": urls.OP6_SQL, "op8_benchmark_decontamination": decontam.OP8_SQL,
              "op11_chat_formatting": chat.OP11_SQL, "op13_ranked_lexical_search": lexical.OP13_SQL}
