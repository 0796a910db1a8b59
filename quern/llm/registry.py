"""The queries of the training-data operators."""

from __future__ import annotations

from quern.llm import oracles
from quern.llm.chat import op5_chat
from quern.llm.decontaminate import op6_decontaminate
from quern.llm.html import op2_html
from quern.llm.minhash import op1_minhash
from quern.llm.mixing import op4_mixing
from quern.llm.pii import op8_pii
from quern.llm.quality import op7_quality
from quern.llm.secrets import op3_secrets
from quern.llm.sharding import op10_sharding
from quern.llm.tokens import op9_tokens

QUERIES = {f.__name__: f for f in (op1_minhash, op2_html, op3_secrets, op4_mixing, op5_chat, op6_decontaminate, op7_quality, op8_pii, op9_tokens, op10_sharding)}

#: DuckDB SQL, where it can express a query's whole result; tests hold the others against brute force.
ORACLES: dict[str, str] = {"op1_minhash": oracles.MINHASH, "op5_chat": oracles.CHAT, "op6_decontaminate": oracles.DECONTAMINATE}
