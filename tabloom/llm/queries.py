"""The queries of this subpackage, as the driver runs them, and their SQL."""

from __future__ import annotations

from .chat import op8_chat
from .chunkbpe import op13_bpe
from .codes import op11_codes, op11_sql
from .decontaminate import op5_decontamination
from .langid import op4_langid
from .licenses import op9_licenses
from .packing import op10_packing
from .quality import op3_quality, op3_sql
from .sharding import op1_sharding
from .simhash import op6_simhash
from .toxicity import op2_toxicity
from .trie import op12_trie
from .warc import op7_warc


def queries() -> dict:
    return {
        "op1_sharding": op1_sharding,
        "op2_toxicity": op2_toxicity,
        "op3_quality": op3_quality,
        "op4_langid": op4_langid,
        "op5_decontamination": op5_decontamination,
        "op6_simhash": op6_simhash,
        "op7_warc": op7_warc,
        "op8_chat": op8_chat,
        "op9_licenses": op9_licenses,
        "op10_packing": op10_packing,
        "op11_codes": op11_codes,
        "op12_trie": op12_trie,
        "op13_bpe": op13_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_quality": op3_sql(), "op11_codes": op11_sql()}
