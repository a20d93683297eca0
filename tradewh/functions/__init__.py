"""Column -> Column functions (no Python UDFs; everything stays in codegen)."""

from tradewh.functions.text import (  # noqa: F401
    norm_text, unicode_trim, repair_enye, normalize_country, decode_canal, left,
)
from tradewh.functions.numeric import (  # noqa: F401
    parse_decimal, parse_double, parse_int, parse_money, parse_money_strict, to_money, round_half_away,
    to_double, pct_change, abs_change, to_millions, safe_div, subitem_value,
)
from tradewh.functions.dates import (  # noqa: F401
    parse_date, date_key, month_name_es, quarter_of, semester,
)
