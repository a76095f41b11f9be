"""Column layouts of the monthly files and the shape each fact table has for queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Positional column names of the monthly files.
EU_COLUMNS = [
    "SMK-COMCODE", "SMK-RECORD-TYPE", "SMK-COD-SEQ", "SMK-COD-ALPHA", "SMK-TRADE-IND",
    "SMK-COO-SEQ", "SMK-COO-ALPHA", "SMK-NATURE-OF-TRANSACTION", "SMK-MODE-OF-TRANSPORT",
    "SMK-PERIOD-REFERENCE", "SMK-SUITE INDICATOR", "SMK-SITC", "SMK-IP-COMCODE",
    "SMK-NO-OF-CONSIGNMENTS", "SMK-STAT-VALUE", "SMK-NETT-MASS", "SMK-SUPP-UNIT",
]
EXPORT_COLUMNS = [
    "COMCODE", "SITC", "RECORD-TYPE", "COD-SEQUENCE", "COD-ALPHA", "ACCOUNT-DATE",
    "PORT-SEQUENCE", "PORT-ALPHA", "FLAG-SEQUENCE", "FLAG-ALPHA", "TRADE-INDICATOR",
    "CONTAINER", "MODE-OF-TRANSPORT", "INLAND-MOT", "GOLO-SEQUENCE", "GOLO-ALPHA",
    "SUITE-INDICATOR", "PROCEDURE-CODE", "VALUE", "QUANTITY-1", "QUANTITY-2",
    "INDUSTRIAL-PLANT-COMCODE",
]
IMPORT_COLUMNS = [
    "COMCODE", "SITC", "RECORD-TYPE", "COD-SEQUENCE", "COD-ALPHA", "COO-SEQUENCE",
    "COO-ALPHA", "ACCOUNT-DATE", "PORT-SEQUENCE", "PORT-ALPHA", "FLAG-SEQUENCE",
    "FLAG-ALPHA", "COUNTRY-SEQUENCE-COO-IMP", "COUNTRY-ALPHA-COO-IMP", "TRADE-INDICATOR",
    "CONTAINER", "MODE-OF-TRANSPORT", "INLAND-MOT", "GOLO-SEQUENCE", "GOLO-ALPHA",
    "SUITE-INDICATOR", "PROCEDURE-CODE", "CB-CODE", "VALUE", "QUANTITY-1", "QUANTITY-2",
]
CONTROL_COLUMNS = [
    "MK-COMCODE", "MK-INTRA-EXTRA-IND", "MK-INTRA-MMYY-ON", "MK-INTRA-MMYY-OFF",
    "MK-EXTRA-MMYY-ON", "MK-EXTRA-MMYY-OFF", "MK-NON-TRADE-ID", "MK-SITC-NO",
    "MK-SITC-IND", "MK-SITC-CONV-A", "MK-SITC-CONV-B", "MK-CN-Q2", "MK-SUPP-ARRIVALS",
    "MK-SUPP-DESPATCHES", "MK-SUPP-IMPORTS", "MK-SUPP-EXPORTS", "MK-SUB-GROUP-ARR",
    "MK-ITEM-ARR", "MK-SUB-GROUP-DESP", "MK-ITEM-DESP", "MK-SUB-GROUP-IMP", "MK-ITEM-IMP",
    "MK-SUB-GROUP-EXP", "MK-ITEM-EXP", "MK-QTY1-ALPHA", "MK-QTY2-ALPHA",
    "MK-COMMODITY-ALPHA-1",
]
# File family of each table.
FILE_FAMILIES = {
    "control": "SMKA12", "exports": "SMKE19", "imports": "SMKI19",
    "dispatches": "SMKX46", "arrivals": "SMKM46",
}


@dataclass(frozen=True)
class FactShape:
    """Which columns of a fact table hold the origin, item, gateway, period and measures."""

    name: str
    flow: str                      # "inbound" or "outbound"
    columns: tuple[str, ...]       # header names, in file order
    code: str
    country: str
    period: str
    style: str                     # spelling of the period, see functions.periods
    port: str | None               # None for the EU side
    measures: tuple[tuple[str, str], ...]   # (name in results, column)
    integers: tuple[str, ...]      # columns cast to bigint on load


_EU = dict(
    columns=tuple(EU_COLUMNS), code="smk_comcode", country="smk_cod_alpha",
    period="smk_period_reference", style="0YYYYMM", port=None,
    measures=(("consignments", "smk_no_of_consignments"), ("price", "smk_stat_value"),
              ("weight", "smk_nett_mass")),
    integers=("smk_no_of_consignments", "smk_stat_value", "smk_nett_mass", "smk_supp_unit"),
)
_NON_EU = dict(
    code="comcode", period="account_date", style="MM/YYYY", port="port_alpha",
    measures=(("price", "value"), ("weight", "quantity_1")),
    integers=("value", "quantity_1", "quantity_2"),
)

IMPORTS = FactShape("imports", "inbound", columns=tuple(IMPORT_COLUMNS), country="coo_alpha", **_NON_EU)
EXPORTS = FactShape("exports", "outbound", columns=tuple(EXPORT_COLUMNS), country="cod_alpha", **_NON_EU)
ARRIVALS = FactShape("arrivals", "inbound", **_EU)
DISPATCHES = FactShape("dispatches", "outbound", **_EU)
FACTS = {f.name: f for f in (IMPORTS, EXPORTS, ARRIVALS, DISPATCHES)}


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


COMCODE_SCHEMA = _strings("commoditycode", "parent", "description")
COUNTRY_SCHEMA = T.StructType(
    _strings("countryname", "countrycode").fields
    + [T.StructField("eu", T.BooleanType()), T.StructField("non_eu", T.BooleanType())])
PORT_SCHEMA = T.StructType(
    _strings("portname", "portcode", "type").fields
    + [T.StructField("lat", T.DoubleType()), T.StructField("long", T.DoubleType())])
MISSING_PORTS_SCHEMA = T.StructType(
    _strings("portname_x", "portcode", "type").fields
    + [T.StructField("lat", T.DoubleType()), T.StructField("long", T.DoubleType())])
# Location code lists are headerless; X2 country, X3 code, X5 name, X11 position.
LOCODE_SCHEMA = _strings(*[f"x{i}" for i in range(1, 13)])
