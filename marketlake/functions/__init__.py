from marketlake.functions.scalar import (  # noqa: F401
    blank_to_null,
    cut,
    is_blank,
    quarter_of,
    relative_change,
    safe_date,
    safe_divide,
    to_bigint,
    to_double,
    up_flag,
    year_of,
)
