"""Parameters of the driver fixtures (FIXTURES.md section 3)."""

from datetime import datetime

from possum.rules import TEST_RULES

AS_OF = datetime(2001, 8, 1, 12, 0, 0)          # sales, stock, suppliers, promotions
AS_OF_PEOPLE = datetime(2024, 1, 30, 12, 0, 0)  # attendance, net feed
RULES = TEST_RULES
# fixed values: the manual price list of the fixtures (position order)
PRICE_LIST = [("small widget", "11.50"), ("widget", "12.25")]
LABEL_B = "Branch B"
