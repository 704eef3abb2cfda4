from uptake.functions.arith import (  # noqa: F401
    finite_or_null,
    ln_inf,
    nan_to_null,
    round_half_even,
    row_sum,
    safe_ratio,
    share_true,
    to_number,
)
from uptake.functions.names import (  # noqa: F401
    normalise_drop_header,
    normalise_indicator_header,
    rename_columns,
)
