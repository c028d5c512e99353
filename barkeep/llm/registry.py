"""Queries of this package and their DuckDB SQL, keyed by name."""

from __future__ import annotations

from barkeep.llm.ann import op6_ann
from barkeep.llm.bpe import op7_bpe
from barkeep.llm.chat import OP3_SQL, op3_chat
from barkeep.llm.codes import OP11_SQL, op11_codes
from barkeep.llm.fingerprint import op8_fingerprint
from barkeep.llm.langid import op4_langid
from barkeep.llm.lines import OP13_SQL, op13_lines
from barkeep.llm.lm import OP1_SQL, op1_lm
from barkeep.llm.mixing import op5_mixing
from barkeep.llm.neardup import OP10_SQL, op10_neardup
from barkeep.llm.secrets import op9_secrets
from barkeep.llm.toxicity import op2_toxicity
from barkeep.llm.whitening import op12_whitening

QUERIES = {f.__name__: f for f in (op1_lm, op2_toxicity, op3_chat, op4_langid, op5_mixing, op6_ann,
                                    op7_bpe, op8_fingerprint, op9_secrets, op10_neardup, op11_codes, op12_whitening, op13_lines)}

#: DuckDB SQL for the queries it can express.
ORACLES: dict[str, str] = {"op1_lm": OP1_SQL, "op3_chat": OP3_SQL, "op10_neardup": OP10_SQL,
                            "op11_codes": OP11_SQL, "op13_lines": OP13_SQL}
