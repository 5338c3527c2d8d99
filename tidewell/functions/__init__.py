"""Column expressions; none of them runs Python in the executors."""

from .amounts import (  # noqa: F401
    MONEY,
    adjusted_premium,
    ape,
    argmax_name,
    band,
    mean_of,
    owner_relation,
    payments_per_year,
    ratio,
    signed,
    value_map,
    vip_tier,
)
from .conditions import any_not_null, flag, is_or_null, null_when, yn  # noqa: F401
from .dates import (  # noqa: F401
    col,
    day,
    day_shift,
    first_day_from_yyyymm,
    month_end,
    month_end_of,
    month_index,
    month_number,
    month_shift,
    months_apart,
    parse_mixed_ts,
    quarter_label,
    same_month,
    same_quarter,
    same_year,
    since,
    tenure_text,
    week_number,
    whole_months,
    whole_years,
    year_month,
)
from .text import (  # noqa: F401
    contains,
    cut_percent,
    drop_first,
    drop_last,
    fold,
    keep_alnum,
    last_chars,
    like_any,
    normalize_phone,
    sha256_text,
)
