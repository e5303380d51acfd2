"""Column-expression builders (JVM-side, whole-stage-codegen friendly)."""

from tessera.functions.hashing import hash_hex, hash_u, hash_bucket  # noqa: F401
from tessera.functions.encode import (  # noqa: F401
    flag, any_flag, member_flag, threshold_flag, map_default, map_nullable,
)
from tessera.functions.numeric import (  # noqa: F401
    bin_right_closed, safe_ratio, row_sum, abs_deviation, outside_range, lenient_double,
    square, product,
)
from tessera.functions.kolmogorov import ks_pvalue  # noqa: F401
