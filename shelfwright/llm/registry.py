"""The queries of this subpackage and the SQL of those that SQL can express."""

from shelfwright.llm import alignment, digests, lang_id, mixing, near_dups, piece_bpe, quality_ranker, quality_rules, revisits, secret_scan, sharding, vector_codes, vector_tiles

QUERIES = {
    "op1_secret_scan": secret_scan.query,
    "op3_quality_rules": quality_rules.query,
    "op2_quality_ranker": quality_ranker.query,
    "op10_sharding": sharding.query,
    "op4_mixing": mixing.query,
    "op7_revisits": revisits.query,
    "op5_digests": digests.query,
    "op6_near_duplicates": near_dups.query,
    "op8_piece_encoding": piece_bpe.query,
    "op9_language_id": lang_id.query,
    "op11_exact_top_k": vector_tiles.query,
    "op12_vector_codes": vector_codes.query,
    "op13_alignment": alignment.query,
}
ORACLE_SQL: dict[str, str] = {
    "op1_secret_scan": secret_scan.ORACLE_SQL,
    "op6_near_duplicates": near_dups.ORACLE_SQL,
    "op7_revisits": revisits.ORACLE_SQL,
    "op11_exact_top_k": vector_tiles.ORACLE_SQL,
    "op12_vector_codes": vector_codes.ORACLE_SQL,
}
