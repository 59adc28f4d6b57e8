"""Business literals of the POS jobs, gathered in one frozen object.

Every operator takes a ``Rules``; nothing below is hidden in operator code.
Labels are English stand-ins for the source system's own words.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal


@dataclass(frozen=True)
class Rules:
    # --- fixed values: catalogue exclusion (P2) ---
    general_department: str = "General"       # department name that is not real stock
    general_name_token: str = "General"       # items whose name contains it are skipped
    barcode_deny: tuple[str, ...] = ("180", "240")

    # --- fixed values: status and type codes (P1, P3) ---
    excluded_entry_types: tuple[int, ...] = (4, 10, 12, 16)
    excluded_transaction_types: tuple[int, ...] = (14, 21)
    gift_card_entry_type: int = 18
    excluded_doc_types: tuple[int, ...] = (5, 6)
    doc_states: tuple[int, ...] = (7, 8, 9, 10)

    # --- fixed values: tax and labels ---
    vat: Decimal = Decimal("1.18")
    no_department: str = "No department"
    no_group: str = "No group"
    unknown_seller: str = "Unknown"
    no_supplier: str = "No supplier"
    gift_card: str = "Gift card"
    promotion_prefix: str = "Promotion "       # key of a promotion without a name
    doc_type_labels: tuple[tuple[int, str], ...] = (
        (1, "Invoice"), (2, "Return"), (3, "Debit"), (4, "Credit"))
    # store code -> label in the user directory (D9c); unknown codes give ''
    user_store_labels: tuple[tuple[int, str], ...] = (
        (1, "Main store"), (2, "Second store"), (3, "Third store"))
    role_admin: str = "mgmt"
    role_employee: str = "emp"

    # --- fixed values: lookback windows ---
    sales_months: int = 13
    supplier_monthly_years: int = 3
    supplier_docs_months: int = 14
    hours_days: int = 90
    attendance_days: int = 400
    promotion_months: int = 25

    # --- fixed values: result sizes ---
    low_stock_limit: int = 300

    # salt of the pseudonymous user key (D9c); set per deployment
    user_key_salt: str = field(default="possum", repr=False)


# Parameters of the driver fixtures (FIXTURES.md section 3).
TEST_RULES = Rules(general_department="PROMO", general_name_token="cold")
