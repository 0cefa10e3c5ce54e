"""The registered queries of this subpackage, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from .attention_lm import op13_attention_scores
from .bpe import op10_bpe_round_trip
from .huffman_tokens import op3_huffman_tokens
from .jaccard_join import ORACLE as OP7_SQL, op7_tile_jaccard
from .langid import op4_output_code_language
from .lexical_search import ORACLE as OP11_SQL, op11_bucket_search
from .line_templates import op8_line_templates
from .media import op9_tiff_media
from .mixing import ORACLE as OP1_SQL, op1_source_mix
from .prefix_trie import ORACLE as OP12_SQL, op12_conversation_trie
from .repetition import ORACLE as OP5_SQL, op5_suffix_repetition
from .secret_scan import op6_secret_scan
from .warc import ORACLE as OP2_SQL, op2_warc_shards


def queries() -> dict:
    return {
        "op1_source_mix": op1_source_mix,
        "op2_warc_shards": op2_warc_shards,
        "op3_huffman_tokens": op3_huffman_tokens,
        "op4_output_code_language": op4_output_code_language,
        "op5_suffix_repetition": op5_suffix_repetition,
        "op6_secret_scan": op6_secret_scan,
        "op7_tile_jaccard": op7_tile_jaccard,
        "op8_line_templates": op8_line_templates,
        "op9_tiff_media": op9_tiff_media,
        "op10_bpe_round_trip": op10_bpe_round_trip,
        "op11_bucket_search": op11_bucket_search,
        "op12_conversation_trie": op12_conversation_trie,
        "op13_attention_scores": op13_attention_scores,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_source_mix": OP1_SQL, "op2_warc_shards": OP2_SQL, "op5_suffix_repetition": OP5_SQL, "op7_tile_jaccard": OP7_SQL, "op11_bucket_search": OP11_SQL, "op12_conversation_trie": OP12_SQL}
