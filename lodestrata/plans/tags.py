"""Governance tags as data.  Fixed values."""

from __future__ import annotations

# Tag and its allowed values.
DEFINITIONS: dict[str, tuple[str, ...]] = {
    "PIPELINE_LAYER": ("BRONZE", "SILVER", "GOLD"),
    "DATA_CLASSIFICATION": ("PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED"),
    "PII": ("TRUE", "FALSE"),
    "DATA_DOMAIN": ("CUSTOMER", "ORDER", "PRODUCT", "PAYMENT", "SHIPMENT"),
    "QUALITY_TIER": ("RAW", "VALIDATED", "CERTIFIED"),
}

# Tag types every table carries, in report order.
TABLE_TAGS = ["PIPELINE_LAYER", "DATA_CLASSIFICATION", "DATA_DOMAIN", "QUALITY_TIER"]

QUALITY_BY_LAYER = {"BRONZE": "RAW", "SILVER": "VALIDATED", "GOLD": "CERTIFIED"}

# Layer, table, classification, domain.
TABLES: list[tuple[str, str, str, str]] = [
    ("BRONZE", "CUSTOMERS", "CONFIDENTIAL", "CUSTOMER"),
    ("BRONZE", "ORDERS", "INTERNAL", "ORDER"),
    ("BRONZE", "ORDER_ITEMS", "INTERNAL", "ORDER"),
    ("BRONZE", "PRODUCTS", "INTERNAL", "PRODUCT"),
    ("BRONZE", "PAYMENTS", "CONFIDENTIAL", "PAYMENT"),
    ("BRONZE", "SHIPMENTS", "INTERNAL", "SHIPMENT"),
    ("SILVER", "STG_CUSTOMERS", "CONFIDENTIAL", "CUSTOMER"),
    ("SILVER", "STG_ORDERS", "INTERNAL", "ORDER"),
    ("SILVER", "STG_ORDER_ITEMS", "INTERNAL", "ORDER"),
    ("SILVER", "STG_PRODUCTS", "INTERNAL", "PRODUCT"),
    ("SILVER", "STG_PAYMENTS", "CONFIDENTIAL", "PAYMENT"),
    ("SILVER", "STG_SHIPMENTS", "INTERNAL", "SHIPMENT"),
    ("GOLD", "DIM_CUSTOMERS", "CONFIDENTIAL", "CUSTOMER"),
    ("GOLD", "DIM_PRODUCTS", "INTERNAL", "PRODUCT"),
    ("GOLD", "FACT_SALES", "CONFIDENTIAL", "ORDER"),
    ("GOLD", "DIM_DATES", "PUBLIC", "ORDER"),
    ("GOLD", "FACT_SHIPMENT_PERFORMANCE", "INTERNAL", "SHIPMENT"),
    ("GOLD", "FACT_PAYMENT_SUMMARY", "CONFIDENTIAL", "PAYMENT"),
    ("GOLD", "FACT_DAILY_REVENUE", "INTERNAL", "ORDER"),
]

# Layer, table and its columns with personal data.
PERSONAL_COLUMNS: list[tuple[str, str, list[str]]] = [
    ("BRONZE", "CUSTOMERS", ["EMAIL", "PHONE", "FIRST_NAME", "LAST_NAME"]),
    ("SILVER", "STG_CUSTOMERS", ["EMAIL", "PHONE", "FIRST_NAME", "LAST_NAME"]),
    ("GOLD", "DIM_CUSTOMERS", ["EMAIL", "FIRST_NAME", "LAST_NAME"]),
]

# Tables that hold one entity in each layer.
ENTITIES: dict[str, dict[str, str]] = {
    "CUSTOMERS": {"BRONZE": "CUSTOMERS", "SILVER": "STG_CUSTOMERS", "GOLD": "DIM_CUSTOMERS"},
    "PRODUCTS": {"BRONZE": "PRODUCTS", "SILVER": "STG_PRODUCTS", "GOLD": "DIM_PRODUCTS"},
    "ORDERS": {"BRONZE": "ORDERS", "SILVER": "STG_ORDERS", "GOLD": "FACT_SALES"},
}
