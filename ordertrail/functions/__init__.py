from .exprs import (  # noqa: F401
    date_parts,
    days_before,
    first_nonnull,
    half_even,
    half_up,
    ident,
    mode_or,
    moment,
    most_frequent,
    parse_ts,
    percent,
    ratio,
    sum_or_zero,
    text_literal,
    whole_days,
    year_month,
)
