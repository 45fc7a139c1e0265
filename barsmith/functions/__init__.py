"""Column-expression helpers: pure ``Column -> Column`` builders, no plans."""

from barsmith.functions.columns import (  # noqa: F401
    EPS,
    SQRT_252,
    col_or_lit,
    macd_cross_label,
    momentum_label,
    rel_change,
    rsi_label,
    safe_ratio,
    vol_regime_label,
)
