from tessera.functions.columns import (  # noqa: F401
    MONEY,
    SILVER_MONEY,
    UNFULFILLED_STATUSES,
    any_null,
    date_key,
    enum,
    is_fulfilled,
    pct,
    ratio,
    surrogate_key,
    text,
)
