"""The registered query of each operator, and its SQL where SQL can say it."""

from __future__ import annotations

from .bpe import op3_bpe
from .fingerprints import op4_fingerprints
from .langid import op9_langid
from .merkle import OP13_SQL, op13_merkle
from .mixing import op10_mixing
from .near_dup import OP1_SQL, op1_near_dup
from .neighbours import op2_neighbours
from .packing import op11_packing
from .secrets import op8_secrets
from .spelling import OP12_SQL, op12_spelling
from .token_counts import op6_token_counts
from .url_filter import op7_url_filter
from .warc import OP5_SQL, op5_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_near_dup, op2_neighbours, op3_bpe, op4_fingerprints, op5_warc, op6_token_counts, op7_url_filter, op8_secrets,
        op9_langid, op10_mixing, op11_packing, op12_spelling, op13_merkle,
    )
}
ORACLES: dict[str, str] = {"op1_near_dup": OP1_SQL, "op5_warc": OP5_SQL, "op12_spelling": OP12_SQL, "op13_merkle": OP13_SQL}
