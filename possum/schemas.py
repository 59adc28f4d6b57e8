"""Declared schemas of the canonical POS tables (without ``branch``)."""

from __future__ import annotations

from pyspark.sql.types import StructType

_PAIRS = ", ".join(f"Login{i} TIMESTAMP_NTZ, Logout{i} TIMESTAMP_NTZ" for i in range(1, 7))

# fixed values: column names and types of the canonical tables
DDL: dict[str, str] = {
    "store": "StoreID INT, StoreName STRING, Code STRING, Sort INT, Status INT",
    "department": "DepartmentID INT, Name STRING",
    "item_main": ("ItemID BIGINT, Name STRING, ModelNumber STRING, BarcodeNumber STRING, "
                  "DepartmentID1 INT, Status INT"),
    "item_group": "ItemGroupID INT, ItemGroupName STRING, Status INT",
    "item_to_group": "ItemID BIGINT, ItemGroupID INT, IsMainGroup INT, Status INT",
    "item_store": ("ItemStoreID BIGINT, ItemID BIGINT, StoreID INT, OnHand DECIMAL(18,1), Status INT, "
                   "ReorderPoint DECIMAL(18,1), AVGCost DECIMAL(18,2), AVCostWithoutTax DECIMAL(18,2), "
                   "CostWithoutTax DECIMAL(18,2)"),
    "pos_transaction": ("TransactionID BIGINT, StoreID INT, SaleTime TIMESTAMP_NTZ, Total DECIMAL(18,2), "
                        "TransactionType INT, SellerID BIGINT, Status INT"),
    "transaction_entry": ("TransactionEntryID BIGINT, TransactionID BIGINT, ItemStoreID BIGINT, "
                          "DepartmentID INT, Qty DECIMAL(18,1), Total DECIMAL(18,2), "
                          "TransactionEntryType INT, Status INT"),
    "tender": "TenderID INT, TenderNameHe STRING",
    "tender_entry": "TransactionID BIGINT, TenderID INT, Amount DECIMAL(18,2), Status INT",
    "users": ("UserId BIGINT, UserNo STRING, UserName STRING, UserFName STRING, UserLName STRING, "
              "IsSuperAdmin INT, IsUser INT, Status INT"),
    "user_store": "UserID BIGINT, StoreID INT",
    "suppliers_docs": ("ID BIGINT, DateT TIMESTAMP_NTZ, Type INT, DocStatus INT, Status INT, SupplierID BIGINT, "
                       "StoreID INT, No STRING, IsPaid INT, AmountPay DECIMAL(18,2)"),
    "suppliers_docs_entry": "ID BIGINT, Status INT, ExtPrice DECIMAL(18,2), Cost DECIMAL(18,2), Qty DECIMAL(18,1)",
    "supplier_dim": "SupplierID BIGINT, Name STRING",
    "promotion": "ID INT, Description STRING",
    "transaction_discounts": "TDiscountID BIGINT, PromotionID INT, Status INT",
    "tentry_discount": ("TDiscountID BIGINT, TransactionEntryID BIGINT, QtyInSale DECIMAL(18,1), "
                        "DiscAmount DECIMAL(18,2), Status INT"),
    "presence_view": f"UserID BIGINT, Name STRING, UserNo STRING, StoreID INT, PreDate DATE, {_PAIRS}",
    "ledger_monthly": "Year INT, Month INT, Total DECIMAL(18,2), Cnt BIGINT, UpdatedAt TIMESTAMP_NTZ",
    "ledger_invoices": ("HenDate TIMESTAMP_NTZ, HenType INT, HenTypeName STRING, HenNum BIGINT, CustName STRING, "
                        "TtlMam DECIMAL(18,2), TtlWith DECIMAL(18,2), Sgira INT, SgiraSchum DECIMAL(18,2), "
                        "Commnts STRING, UpdatedAt TIMESTAMP_NTZ"),
    "net_feed": "day_key STRING, net DECIMAL(18,2)",
}

# Tables a branch database may lack; the datasets built on them come out empty.
OPTIONAL = ("ledger_monthly", "ledger_invoices", "suppliers_docs", "suppliers_docs_entry", "supplier_dim",
            "presence_view", "promotion", "transaction_discounts", "tentry_discount", "net_feed")


def schema(table: str) -> StructType:
    return StructType.fromDDL(DDL[table])


def columns(table: str) -> list[str]:
    return [f.name for f in schema(table).fields]
