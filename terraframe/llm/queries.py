"""Queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from .ball_tree import OP1_SQL, op1_ball_tree
from .hnsw import OP9_SQL, op9_hnsw
from .html_text import op2_html_text
from .huffman import op3_huffman_ids
from .mixing import op8_mixing
from .piece_scan import op4_piece_scan
from .ppm import op10_language_id
from .simhash import op5_simhash
from .token_counts import op7_token_counts
from .warc import OP6_SQL, op6_warc

QUERIES = {
    "op1_ball_tree": op1_ball_tree,
    "op2_html_text": op2_html_text,
    "op3_huffman_ids": op3_huffman_ids,
    "op4_piece_scan": op4_piece_scan,
    "op5_simhash": op5_simhash,
    "op6_warc": op6_warc,
    "op7_token_counts": op7_token_counts,
    "op8_mixing": op8_mixing,
    "op9_hnsw": op9_hnsw,
    "op10_language_id": op10_language_id,
}

ORACLE_SQL = {"op1_ball_tree": OP1_SQL, "op6_warc": OP6_SQL, "op9_hnsw": OP9_SQL}
