"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from firmloom.llm import sql
from firmloom.llm.bottom_k import op11_bottom_k
from firmloom.llm.bpe import op10_bpe
from firmloom.llm.byte_cnn import op8_quality
from firmloom.llm.collocations import op13_collocations
from firmloom.llm.decontaminate import op5_decontamination
from firmloom.llm.hard_negatives import op12_hard_negatives
from firmloom.llm.html_text import op9_html_text
from firmloom.llm.jaccard import op7_jaccard
from firmloom.llm.pseudonyms import op4_pseudonyms
from firmloom.llm.quality import op2_quality
from firmloom.llm.secret_scan import op3_secrets
from firmloom.llm.url_filter import op1_url_filter
from firmloom.llm.warc import op6_warc

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_quality": op2_quality,
    "op3_secrets": op3_secrets,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_decontamination": op5_decontamination,
    "op6_warc": lambda spark, sf_dir: op6_warc(spark, sf_dir).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"),
    "op7_jaccard": op7_jaccard,
    "op8_quality": op8_quality,
    "op9_html_text": op9_html_text,
    "op10_bpe": op10_bpe,
    "op11_bottom_k": op11_bottom_k,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_collocations": op13_collocations,
}
SQL = {
    "op2_quality": sql.quality_sql(),
    "op5_decontamination": sql.decontamination_sql(),
    "op6_warc": sql.warc_sql(),
    "op7_jaccard": sql.jaccard_sql(),
    "op11_bottom_k": sql.bottom_k_sql(),
    "op12_hard_negatives": sql.hard_negatives_sql(),
    "op13_collocations": sql.collocations_sql(),
}
