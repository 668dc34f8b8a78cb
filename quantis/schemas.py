"""Declared schemas of the domain tables (never inferred).

Money columns are ``decimal(18,4)``: totals are then exact and identical
whatever order the partial aggregates are combined in.  Reports convert to
double at the edge.
"""

from __future__ import annotations

from pyspark.sql.types import DecimalType, DoubleType, LongType, StringType, StructField, StructType

# Domain column names.
ITEM = "item_description_name_form_strength"
QTY = "quantity_required_for_period_specified_above"
VALUE = "value_of_quantities_required_for_12_months"
BUFFER = "value_of_quantities_required_including_buffer_kes"
PROCURE = "value_of_quantities_to_be_procured_kes"
NEW_PRICE = "new_price_kes"
PACK_X = "pack_size.x"
BUFFER_PACKS = "quantity_required_buffer_packs"
PROCURE_PACKS = "quantity_required_to_procure_packs"

S = StringType()
D = DoubleType()
M = DecimalType(18, 4)

FORECASTS = StructType(
    [
        StructField("county", S),
        StructField("sub_county", S),
        StructField("facility_type", S),
        StructField("facility_name", S),
        StructField("sub_category", S),
        StructField("keph_level", S),
        StructField("tab", S),
        StructField("ven", S),
        StructField("funding", S),
        StructField(ITEM, S),
        StructField("pack_size", S),
        StructField("price_kes", D),
        StructField(QTY, D),
        StructField(VALUE, M),
        StructField(BUFFER, M),
        StructField(PROCURE, M),
        StructField("contains_lab", S),
    ]
)

# The divergent-schema county: ``pack_size.x`` and ``new_price_kes``, two
# extra pack quantities, and an explicit row-order key (the source tables
# have an implicit row order that ``consecutive_id`` relies on).
FORECASTS_TN = StructType(
    [
        StructField("county", S),
        StructField("sub_county", S),
        StructField("facility_type", S),
        StructField("facility_name", S),
        StructField("sub_category", S),
        StructField("keph_level", S),
        StructField("tab", S),
        StructField("ven", S),
        StructField("funding", S),
        StructField(ITEM, S),
        StructField(PACK_X, S),
        StructField("price_kes", D),
        StructField(NEW_PRICE, D),
        StructField(QTY, D),
        StructField(BUFFER_PACKS, D),
        StructField(PROCURE_PACKS, D),
        StructField(VALUE, M),
        StructField(BUFFER, M),
        StructField(PROCURE, M),
        StructField("contains_lab", S),
        StructField("source_row", LongType()),
    ]
)

CLASSIFICATIONS = StructType(
    [
        StructField(ITEM, S),
        StructField("tab", S),
        StructField("product_or_equipment", S),
        StructField("product_classification", S),
        StructField("rmnch_product", S),
        StructField("moh_647_name", S),
    ]
)

NEW_CATEGORIZATION = StructType(
    [
        StructField("item_name", S),
        StructField("product_category", S),
        StructField("ven", S),
        StructField("product_or_equipment", S),
    ]
)

OLD_CATEGORIZATION = StructType(
    [StructField(ITEM, S), StructField("tab", S), StructField("product_or_equipment", S)]
)

RMNCH_PRODUCTS = StructType([StructField("product", S)])

ORG_UNITS = StructType([StructField("id", S), StructField("name", S), StructField("parent_id", S)])

WARD_OVERRIDES = StructType([StructField("facility_name", S), StructField("ward", S)])

ANALYTICS = StructType(
    [
        StructField("data", S),
        StructField("period", S),
        StructField("organisation_unit", S),
        StructField("facility_ownership", S),
        StructField("keph_level", S),
        StructField("value", D),
        StructField("numerator", D),
        StructField("denominator", D),
        StructField("factor", D),
        StructField("multiplier", D),
        StructField("divisor", D),
    ]
)

ORGANISATION_UNITS = StructType(
    [
        StructField("facility_id", S),
        StructField("facility_name", S),
        StructField("ward_name", S),
        StructField("sub_county_name", S),
        StructField("county_name", S),
        StructField("mfl_code", S),
    ]
)

KEPH_LEVELS = StructType([StructField("keph_level_id", S), StructField("keph_level_name", S)])

FACILITY_OWNERSHIPS = StructType(
    [
        StructField("facility_ownership_id", S),
        StructField("facility_ownership", S),
        StructField("facility_ownership_short", S),
    ]
)
