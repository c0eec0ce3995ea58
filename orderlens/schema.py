"""Column names of the order table and the fixed value lists the cleaning
step needs.  Values in the FIXED VALUES block must equal the ones the
original order-outcome project uses, so they are stated verbatim."""

from __future__ import annotations

TARGET = "buyout_flag"
DATE_COL = "sale_date"
CONTACT_COL = "contact_id"
DEAL_COUNT_COL = "contact_Число сделок"
ROW_ID = "row_id"
MANAGER_COL = "lead_responsible_user_id"
UNKNOWN_OUTCOME_COL = "outcome_unknown"

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original project exactly)
# ---------------------------------------------------------------------------

# Columns filled in only after the order outcome is known, or constant ones.
LEAKAGE_COLUMNS: tuple[str, ...] = (
    "current_status_id",
    "lead_status_id",
    "lead_closed_at",
    "closed_ts",
    "received_ts",
    "rejected_ts",
    "returned_ts",
    "handed_to_delivery_ts",
    "issued_or_pvz_ts",
    "days_to_outcome",
    "days_handed_to_issued_pvz",
    "days_sale_to_handed",
    "lead_Условный отказ",
    "lead_Дата получения денег на Р/С",
    "lead_Дата возврата посылки на склад",
    "lead_Дата перехода Передан в доставку",
    "lead_Дата перехода в Сборку",
    "lead_Ответственный за доставку",
    "lead_LEADQUALIFYCATION",
    "lead_Вес (грамм)*",
    "lead_Длина",
    "lead_Ширина",
    "lead_Высота",
    "lifecycle_incomplete",
    "lead_is_deleted",
    "lead_account_id",
)

# Cities appended to the city dictionary by hand: (name, region).
EXTRA_CITIES: tuple[tuple[str, str], ...] = (
    ("Ялта", "Республика Крым"),
    ("Симферополь", "Республика Крым"),
    ("Севастополь", "Город федерального значения Севастополь"),
)

# Target text forms accepted by the loader.
TRUE_TEXT = ("True", "true")
FALSE_TEXT = ("False", "false")

# Manager tier cut points on the new-client buyout rate.
MGR_HIGH_RATE = 0.4
MGR_MID_RATE = 0.2
MGR_TIERS = ("mgr_high", "mgr_mid", "mgr_low")

# City population threshold for the big-city flag.
BIG_CITY_POPULATION = 500_000

# Category placeholder written for missing values.
NAN_TOKEN = "__NaN__"

# Default display orders of binned features (profiles order by these first).
DEFAULT_CATEGORY_ORDERS: dict[str, list[str]] = {
    "price_bin": ["0-5k", "5-8k", "8-15k", "15k+", "unknown"],
    "cart_bin": ["1-8", "9-12", "13+"],
    "manager_bin": ["0-800", "800-1.8k", "1.8-3k", "3k+"],
    "delta_bin": ["<30мин", "30-60мин", "1-2ч", ">2ч"],
    "order_text_bin": ["empty", "1-50", "51-100", "101-200", "201-500", "500+"],
    "sale_weekday": ["0", "1", "2", "3", "4", "5", "6"],
    "lead_Квалификация лида": [
        "А - лид", "В - лид", "С - лид", "D/Неквал лид", "D - лид", "Е - лид", "Неквал лид",
    ],
}
