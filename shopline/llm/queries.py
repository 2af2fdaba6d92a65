"""Registered queries of this package and their DuckDB oracles.

A query without an oracle can't be said in SQL; ``tests/llm`` holds it against
a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopline.llm import op4_warc as warc
from shopline.llm import op5_maxscore as maxscore
from shopline.llm import op11_variants as variants
from shopline.llm import op13_merkle as merkle
from shopline.llm.op1_mcd import op1_mcd
from shopline.llm.op2_langid import op2_langid
from shopline.llm.op3_lattice import op3_lattice
from shopline.llm.op6_lines import op6_lines
from shopline.llm.op7_trees import op7_trees
from shopline.llm.op8_pii import op8_pii
from shopline.llm.op9_bpe import op9_bpe
from shopline.llm.op10_mixing import op10_mixing
from shopline.llm.op12_paths import op12_paths

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mcd": op1_mcd,
    "op2_langid": op2_langid,
    "op3_lattice": op3_lattice,
    "op4_warc": warc.op4_warc,
    "op5_maxscore": maxscore.op5_maxscore,
    "op6_lines": op6_lines,
    "op7_trees": op7_trees,
    "op8_pii": op8_pii,
    "op9_bpe": op9_bpe,
    "op10_mixing": op10_mixing,
    "op11_variants": variants.op11_variants,
    "op12_paths": op12_paths,
    "op13_merkle": merkle.op13_merkle,
}

ORACLES: dict[str, str] = {
    "op4_warc": warc.ORACLE,
    "op5_maxscore": maxscore.ORACLE,
    "op11_variants": variants.ORACLE,
    "op13_merkle": merkle.ORACLE,
}
