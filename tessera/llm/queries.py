"""The queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from .decontaminate import op7_decontaminate
from .fingerprints import op6_fingerprints
from .html_text import op8_page_text
from .near_dedup import op2_near_dedup
from .oracles import LEAKS, NEAR, SUBSTRINGS, WARC
from .pieces import op10_pieces
from .quality import op4_quality
from .substring_dedup import op1_substring_dedup
from .token_counts import op9_token_counts
from .token_store import op3_token_store
from .warc import op5_warc

QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_near_dedup, op3_token_store, op4_quality, op5_warc, op6_fingerprints, op7_decontaminate, op8_page_text, op9_token_counts, op10_pieces)}
#: The others have no SQL form: tokenizers, a trained classifier, ICU's normalisation, tree matching.
ORACLE_SQL: dict[str, str] = {"op1_substring_dedup": SUBSTRINGS, "op2_near_dedup": NEAR, "op5_warc": WARC, "op7_decontaminate": LEAKS}
