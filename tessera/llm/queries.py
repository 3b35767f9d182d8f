"""The queries of this subpackage and, where SQL can express them, their SQL."""

from .decontam import OP7_SQL, op7_benchmark_decontamination
from .langid import op3_language_id
from .linededup import OP6_SQL, op6_line_dedup
from .media import op1_media_columns
from .mixing import op9_source_mixing
from .neardup import OP2_SQL, op2_minhash_near_dedup
from .pii import op5_pii
from .suffixdedup import op4_suffix_dedup
from .tokencount import op10_token_counts
from .urlfilter import op8_url_filters

QUERIES = {
    "op1_media_columns": op1_media_columns,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_language_id": op3_language_id,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_pii": op5_pii,
    "op6_line_dedup": op6_line_dedup,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_url_filters": op8_url_filters,
    "op9_source_mixing": op9_source_mixing,
    "op10_token_counts": op10_token_counts,
}
ORACLE_SQL = {"op2_minhash_near_dedup": OP2_SQL, "op6_line_dedup": OP6_SQL, "op7_benchmark_decontamination": OP7_SQL}
