"""Projection of the driver tables onto canonical POS views.

The same SQL text feeds the Spark adapters and the DuckDB oracles: only the
inputs are shared, operator logic is written twice. Views are listed in
creation order; later views read earlier ones.
"""

from __future__ import annotations

import re

# fixed values: view definitions over the driver tables
VIEWS: dict[str, str] = {}

VIEWS["store"] = """
SELECT n_nationkey AS StoreID, n_name AS StoreName, CAST(n_nationkey AS STRING) AS Code,
       n_regionkey * 100 + n_nationkey AS Sort, CASE WHEN n_nationkey % 12 = 11 THEN 0 ELSE 1 END AS Status
FROM nation
"""

VIEWS["department"] = """
SELECT CAST(MIN(p_partkey) AS INT) AS DepartmentID, p_type AS Name FROM part GROUP BY p_type
"""

VIEWS["item_main"] = """
SELECT p.p_partkey AS ItemID, p.p_name AS Name, p.p_brand AS ModelNumber,
       CASE WHEN p.p_partkey % 20 = 0 THEN CAST(p.p_partkey AS STRING)
            ELSE concat(CAST(20 + p.p_partkey % 6 AS STRING), CASE WHEN p.p_partkey % 4 < 2 THEN 'W' ELSE 'S' END,
                        lpad(CAST(p.p_partkey % 40 AS STRING), 2, '0'), lpad(CAST(p.p_size % 10 AS STRING), 2, '0'),
                        'M', CAST(p.p_size AS STRING)) END AS BarcodeNumber,
       CASE WHEN p.p_partkey % 17 = 0 THEN NULL ELSE d.DepartmentID END AS DepartmentID1,
       CASE WHEN p.p_partkey % 23 = 0 THEN 0 ELSE 1 END AS Status
FROM part p JOIN department d ON d.Name = p.p_type
"""

VIEWS["item_group"] = """
SELECT CAST(2 * MIN(p_partkey) AS INT) AS ItemGroupID, p_brand AS ItemGroupName,
       CASE WHEN p_brand = 'Brand#7' THEN 0 ELSE 1 END AS Status
FROM part GROUP BY p_brand
UNION ALL
SELECT CAST(2 * MIN(p_partkey) + 1 AS INT), p_type, 1 FROM part GROUP BY p_type
"""

VIEWS["item_to_group"] = """
SELECT p.p_partkey AS ItemID, g.ItemGroupID, CASE WHEN g.ItemGroupName = p.p_brand AND p.p_partkey % 3 > 0 THEN 1 ELSE 0 END AS IsMainGroup,
       CASE WHEN p.p_partkey % 31 = 0 THEN 0 ELSE 1 END AS Status
FROM part p JOIN item_group g ON g.ItemGroupName = p.p_brand
UNION ALL
SELECT p.p_partkey, g.ItemGroupID, 0, CASE WHEN p.p_partkey % 31 = 0 THEN 0 ELSE 1 END
FROM part p JOIN item_group g ON g.ItemGroupName = p.p_type
"""

VIEWS["item_store"] = """
SELECT q.ItemID * 100 + q.StoreID AS ItemStoreID, q.ItemID, q.StoreID,
       CASE WHEN q.ItemID % 13 = 0 THEN NULL ELSE q.OnHand END AS OnHand,
       CASE WHEN (q.ItemID + q.StoreID) % 29 = 0 THEN -1 ELSE 1 END AS Status,
       CASE WHEN q.ItemID % 3 = 0 THEN NULL ELSE CAST(p.p_size AS DECIMAL(18,1)) END AS ReorderPoint,
       CASE WHEN q.ItemID % 2 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(p.p_retailprice AS DECIMAL(18,2)) END AS AVGCost,
       CASE WHEN q.ItemID % 5 = 0 THEN CAST(p.p_retailprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS AVCostWithoutTax,
       CASE WHEN q.ItemID % 7 = 0 THEN CAST(p.p_retailprice AS DECIMAL(18,2)) ELSE NULL END AS CostWithoutTax
FROM (SELECT l_partkey AS ItemID, s_nationkey AS StoreID,
             CAST(SUM(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS DECIMAL(18,1))
                           WHEN l_returnflag = 'R' THEN CAST(-l_quantity AS DECIMAL(18,1)) ELSE 0 END) AS DECIMAL(18,1)) AS OnHand
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_partkey, s_nationkey) q
JOIN part p ON p.p_partkey = q.ItemID
"""

VIEWS["pos_transaction"] = """
SELECT o_orderkey AS TransactionID, c_nationkey AS StoreID,
       o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24) + INTERVAL '1' MINUTE * (o_orderkey % 60) AS SaleTime,
       CAST(o_totalprice AS DECIMAL(18,2)) AS Total,
       CASE WHEN o_orderkey % 50 = 0 THEN 14 WHEN o_orderkey % 50 = 1 THEN 21 ELSE 1 END AS TransactionType,
       CASE WHEN o_custkey % 41 = 0 THEN NULL ELSE o_custkey END AS SellerID,
       CASE WHEN o_orderstatus = 'P' AND o_orderkey % 7 = 0 THEN -1 ELSE 1 END AS Status
FROM orders JOIN customer ON c_custkey = o_custkey
"""

VIEWS["transaction_entry"] = """
SELECT l_orderkey * 10000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         l_quantity, l_discount, l_returnflag, l_linestatus) AS TransactionEntryID,
       l_orderkey AS TransactionID, l_partkey * 100 + s_nationkey AS ItemStoreID, m.DepartmentID1 AS DepartmentID,
       CAST(l_quantity AS DECIMAL(18,1)) AS Qty,
       CAST(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,2)) AS Total,
       CAST(l_discount AS DECIMAL(18,2)) AS DiscountRate, l_partkey AS ItemID,
       CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 18 WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 4 ELSE 1 END AS TransactionEntryType,
       CASE WHEN l_partkey % 37 = 0 THEN -1 ELSE 1 END AS Status
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN item_main m ON m.ItemID = l_partkey
"""

VIEWS["tender"] = """
SELECT CAST(substr(o_orderpriority, 1, 1) AS INT) AS TenderID, substr(o_orderpriority, 3) AS TenderNameHe
FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority NOT LIKE '5%') x
"""

VIEWS["tender_entry"] = """
SELECT o_orderkey AS TransactionID, CAST(substr(o_orderpriority, 1, 1) AS INT) AS TenderID,
       CAST(o_totalprice AS DECIMAL(18,2)) AS Amount, CASE WHEN o_orderkey % 43 = 0 THEN -1 ELSE 1 END AS Status
FROM orders
"""

VIEWS["users"] = """
SELECT c_custkey AS UserId, CAST(c_custkey AS STRING) AS UserNo, c_name AS UserName,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE concat(c_mktsegment, '  ') END AS UserFName,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE substr(c_name, 10) END AS UserLName,
       CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS IsSuperAdmin, CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE 1 END AS IsUser,
       CASE WHEN c_custkey % 8 = 0 THEN 0 ELSE 1 END AS Status
FROM customer
"""

VIEWS["user_store"] = """
SELECT DISTINCT o_custkey AS UserID, c_nationkey AS StoreID FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_custkey % 5 > 0
"""

VIEWS["suppliers_docs"] = """
SELECT DocID AS ID, DateT, CAST(1 + DocID % 6 AS INT) AS Type, CAST(5 + DocID % 7 AS INT) AS DocStatus, CASE WHEN DocID % 19 = 0 THEN 0 ELSE 1 END AS Status,
       CASE WHEN SuppKey % 15 = 0 THEN NULL ELSE SuppKey END AS SupplierID, n AS StoreID,
       CASE WHEN DocID % 4 = 0 THEN NULL ELSE CAST(DocID AS STRING) END AS No, CAST(DocID % 2 AS INT) AS IsPaid,
       CASE WHEN DocID % 2 = 1 THEN Amt ELSE NULL END AS AmountPay
FROM (SELECT l_orderkey * 10000 + l_suppkey AS DocID, l_suppkey AS SuppKey, min(s_nationkey) AS n, min(l_shipdate) AS DateT,
             CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS Amt
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_orderkey, l_suppkey) x
"""

VIEWS["suppliers_docs_entry"] = """
SELECT l_orderkey * 10000 + l_suppkey AS ID, CASE WHEN l_linenumber = 7 THEN 0 ELSE 1 END AS Status,
       CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS ExtPrice,
       CAST(floor(l_extendedprice / l_quantity) AS DECIMAL(18,2)) AS Cost, CAST(l_quantity AS DECIMAL(18,1)) AS Qty
FROM lineitem
"""

VIEWS["supplier_dim"] = """
SELECT s_suppkey AS SupplierID, s_name AS Name FROM supplier
"""

VIEWS["promotion"] = """
SELECT ItemGroupID AS ID, CASE WHEN ItemGroupID % 8 = 0 THEN '' ELSE concat('Promo ', CAST(ItemGroupID % 12 AS STRING)) END AS Description FROM item_group
"""

VIEWS["transaction_discounts"] = """
SELECT DISTINCT m.ItemID AS TDiscountID, g.ItemGroupID AS PromotionID, CASE WHEN m.ItemID % 47 = 0 THEN -1 WHEN m.ItemID % 3 = 0 THEN NULL ELSE 1 END AS Status
FROM item_main m JOIN item_group g ON g.ItemGroupName = m.ModelNumber
"""

VIEWS["tentry_discount"] = """
SELECT ItemID AS TDiscountID, TransactionEntryID, Qty AS QtyInSale, CAST(abs(Total) * DiscountRate AS DECIMAL(18,2)) AS DiscAmount,
       CASE WHEN TransactionEntryID % 53 = 0 THEN -1 WHEN TransactionEntryID % 2 = 0 THEN NULL ELSE 1 END AS Status
FROM transaction_entry WHERE DiscountRate > 0
"""

VIEWS["punches"] = """
SELECT user_id AS UserID, CAST(ts AS DATE) AS PreDate, CAST(user_id % 25 AS INT) AS StoreID, rn,
       CASE WHEN event_type = 'signup' THEN NULL ELSE ts END AS Login,
       CASE WHEN event_type = 'error' THEN NULL ELSE ts + INTERVAL '1' MINUTE * CAST(floor(value) AS INT) END AS Logout
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn FROM events) x
"""

VIEWS["ledger_monthly"] = """
SELECT CAST(year(o_orderdate) AS INT) AS Year, CAST(month(o_orderdate) AS INT) AS Month,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS Total, COUNT(*) AS Cnt, MAX(o_orderdate) AS UpdatedAt
FROM orders GROUP BY 1, 2
"""

VIEWS["net_feed"] = """
SELECT concat(lpad(CAST(day(ts) AS STRING), 2, '0'), '/', lpad(CAST(month(ts) AS STRING), 2, '0'), '/', CAST(year(ts) AS STRING)) AS day_key,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS net
FROM events WHERE event_type = 'purchase' GROUP BY 1
"""

VIEWS["presence_view"] = """
SELECT UserID, concat('user ', CAST(UserID AS STRING), ' ') AS Name, CAST(UserID AS STRING) AS UserNo, StoreID, PreDate, part,
       MAX(CASE WHEN rn = 1 THEN Login END) AS Login1, MAX(CASE WHEN rn = 1 THEN Logout END) AS Logout1,
       MAX(CASE WHEN rn = 2 THEN Login END) AS Login2, MAX(CASE WHEN rn = 2 THEN Logout END) AS Logout2,
       MAX(CASE WHEN rn = 3 THEN Login END) AS Login3, MAX(CASE WHEN rn = 3 THEN Logout END) AS Logout3,
       MAX(CASE WHEN rn = 4 THEN Login END) AS Login4, MAX(CASE WHEN rn = 4 THEN Logout END) AS Logout4,
       MAX(CASE WHEN rn = 5 THEN Login END) AS Login5, MAX(CASE WHEN rn = 5 THEN Logout END) AS Logout5,
       MAX(CASE WHEN rn = 6 THEN Login END) AS Login6, MAX(CASE WHEN rn = 6 THEN Logout END) AS Logout6
FROM (SELECT UserID, StoreID, PreDate, Login, Logout, CAST((rn - 1) % 6 + 1 AS INT) AS rn, CAST(floor((rn - 1) / 6) AS INT) AS part FROM punches) y
GROUP BY UserID, StoreID, PreDate, part
"""

VIEWS["ledger_invoices"] = """
SELECT o_orderdate AS HenDate, CAST(1 + o_orderkey % 3 AS INT) AS HenType, o_orderstatus AS HenTypeName, o_orderkey AS HenNum, c_name AS CustName,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS TtlMam,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(1.18 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS TtlWith,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 2 AS INT) END AS Sgira, CAST(NULL AS DECIMAL(18,2)) AS SgiraSchum,
       CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority ELSE NULL END AS Commnts, o_orderdate AS UpdatedAt
FROM orders JOIN customer ON c_custkey = o_custkey
"""

VIEWS["price_list"] = """
SELECT * FROM (VALUES (1, 'small widget', CAST(11.50 AS DECIMAL(18,2))), (2, 'widget', CAST(12.25 AS DECIMAL(18,2)))) AS v(position, pl_name, pl_price)
"""


RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
              "lineitem", "events")


def dependencies(name: str) -> list[str]:
    """Views (in creation order) that ``name`` needs, itself included."""
    order = list(VIEWS)
    need: set[str] = set()

    def visit(v: str) -> None:
        if v in need:
            return
        need.add(v)
        body = VIEWS[v]
        for other in order:
            if other != v and re.search(rf"\b{other}\b", body):
                visit(other)

    visit(name)
    return [v for v in order if v in need]


def with_clause(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` holding the views the names need."""
    need: list[str] = []
    for n in names:
        for v in dependencies(n):
            if v not in need:
                need.append(v)
    order = [v for v in VIEWS if v in need]
    parts = [f"{v} AS ({VIEWS[v].strip()})" for v in order]
    return "WITH " + ",\n".join(parts) + "\n"
