from vellum.functions.exprs import (  # noqa: F401
    MONEY, MONEY_TOTAL, RATE, RECON_TOTAL, avg2, avg_money, days_between, display_time,
    money, money_text, money_total, norm_lower, norm_upper, ratio_pct, sum2, title_label,
)
