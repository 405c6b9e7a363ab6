"""Queries of this folder and the SQL for those that SQL can express."""

from __future__ import annotations

from provlake.llm.op1_licenses import op1_licenses
from provlake.llm.op2_bpe import op2_bpe
from provlake.llm.op3_substring import op3_substring
from provlake.llm.op4_simhash import op4_simhash
from provlake.llm.op5_ann import op5_ann
from provlake.llm.op6_token_files import op6_token_files
from provlake.llm.op7_html import op7_html
from provlake.llm.op8_url_filter import ORACLE as OP8
from provlake.llm.op8_url_filter import op8_url_filter
from provlake.llm.op9_decontaminate import op9_decontaminate
from provlake.llm.op10_toxicity import op10_toxicity

QUERIES = {f.__name__: f for f in (op1_licenses, op2_bpe, op3_substring, op4_simhash, op5_ann, op6_token_files, op7_html, op8_url_filter, op9_decontaminate, op10_toxicity)}
ORACLES = {"op8_url_filter": OP8}
