"""Column expressions used across the package."""

from vigil.functions.labels import (  # noqa: F401
    ATTACK_TAXONOMY, NORMAL, ATTACK, UNKNOWN, argmax, binary_label, decode, hit, indicator,
    taxonomy_frame, taxonomy_join, taxonomy_label, threshold,
)
from vigil.functions.scalar import (  # noqa: F401
    complement, fixed4, index_of, keyed_u32, keyed_uniform, safe_div, sign01, stamp,
)
