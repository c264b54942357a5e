"""The canonical operations schema and the names that hang on it. All columns are optional on input."""

from __future__ import annotations

from pyspark.sql import types as T

_MONEY = T.DecimalType(18, 4)

#: Canonical column names and types.
OPERATIONS = {
    "Year": T.IntegerType(), "Month": T.IntegerType(), "Customer": T.StringType(), "HQ CTO Customer Name": T.StringType(),
    "CTO / RCU Customer Code": T.StringType(), "CTO Name And Code": T.StringType(), "JobfileNumber": T.StringType(),
    "Reporting Entity Label": T.StringType(), "Zone 3 Label": T.StringType(), "Market Segment Name": T.StringType(),
    "Product Name": T.StringType(), "Activity Name (EN)": T.StringType(), "Shipping Type Name": T.StringType(),
    "Turnover in EUR": _MONEY, "Direct GM in EUR": _MONEY, "Gross Billing Tax Excl. in EUR": _MONEY,
    "TEU": T.DoubleType(), "Freight Ton": T.DoubleType(),
}
#: Names of columns, and of what is read and written, in their order.
LINEAGE = "__source_file__"
HEADER_MARKERS = frozenset({"Year", "Customer", "JobfileNumber"})
HEADER_SCAN_ROWS = 15
DEDUP_KEY = "JobfileNumber"
#: Summed column to output column, in output order.
METRICS = {"Turnover in EUR": "CA_EUR", "Direct GM in EUR": "GM_EUR", "Gross Billing Tax Excl. in EUR": "Billing_HT_EUR", "TEU": "TEU", "Freight Ton": "Freight_Ton"}
KEYS = ("Customer", "HQ CTO Customer Name", "CTO / RCU Customer Code", "CTO Name And Code")
DIMENSIONS = ("Reporting Entity Label", "Zone 3 Label", "Market Segment Name", "Product Name", "Activity Name (EN)", "Shipping Type Name")
MODAL = ("HQ CTO Customer Name", "Market Segment Name", "Reporting Entity Label")
OPERATION_COUNT, FIRST, LAST, MONTHS = "Nb_operations", "Premiere_activite", "Derniere_activite", "Nb_mois_actifs"
SEGMENT, DEFAULT_SEGMENT = "segment", "Non classe"
