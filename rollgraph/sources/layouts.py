"""Record layouts of the registry bulk file and the property roll.

The names, widths, type codes and slices below are fixed values of the files.
"""

from __future__ import annotations

from typing import NamedTuple


class Field(NamedTuple):
    name: str
    start: int
    end: int
    kind: str


RECORD_LENGTH = 560

# Name, width and type code of each field, in the order of the record.
# N is a zero-filled number, C is text, D is a yyyyMMdd date.

DELETE_ALL_LOG = (
    ("layout_code", 2, "N"),
    ("filing_num", 10, "N"),
    ("value_DELETE", 6, "C"),
    ("filler", 542, "C"),
)

MASTER = (
    ("layout_code", 2, "N"),
    ("filing_num", 10, "N"),
    ("status_id", 2, "N"),
    ("corp_type_id", 2, "N"),
    ("name", 150, "C"),
    ("perpetual_flag", 2, "N"),
    ("creation_date", 8, "N"),
    ("expiration_date", 8, "D"),
    ("inactive_date", 8, "D"),
    ("formation_date", 8, "D"),
    ("report_due_date", 8, "D"),
    ("tax_id", 11, "N"),
    ("dba_name", 150, "C"),
    ("foreign_fein", 16, "C"),
    ("foreign_state", 4, "C"),
    ("foreign_country", 64, "C"),
    ("foreign_formation_date", 8, "D"),
    ("expiration_Type", 16, "C"),
    ("nonprofit_subtype_id", 3, "N"),
    ("boc_flag", 2, "N"),
    ("boc_date", 8, "C"),
    ("filler", 70, "C"),
)

ADDRESS = (
    ("layout_code", 2, "N"),
    ("filing_num", 10, "N"),
    ("address1", 50, "C"),
    ("address2", 50, "C"),
    ("city", 64, "C"),
    ("state", 4, "C"),
    ("zip_code", 9, "C"),
    ("zip_extension", 6, "C"),
    ("country", 64, "C"),
    ("filler", 301, "C"),
)

REGISTERED_AGENT_BUSINESS = (
    ("layout_code", 2, "N"),
    ("filing_num", 10, "N"),
    ("address1", 50, "C"),
    ("address2", 50, "C"),
    ("city", 64, "C"),
    ("state", 4, "C"),
    ("zip_code", 9, "C"),
    ("zip_extension", 6, "C"),
    ("country", 64, "C"),
    ("inactive_date", 8, "D"),
    ("business_name", 150, "C"),
    ("filler", 143, "C"),
)

REGISTERED_AGENT_PERSONAL = (
    ("layout_code", 2, "N"),
    ("filing_num", 10, "N"),
    ("address1", 50, "C"),
    ("address2", 50, "C"),
    ("city", 64, "C"),
    ("state", 4, "C"),
    ("zip_code", 9, "C"),
    ("zip_extension", 6, "C"),
    ("country", 64, "C"),
    ("inactive_date", 8, "D"),
    ("agent_last_name", 50, "C"),
    ("agent_first_name", 50, "C"),
    ("agent_middle_name", 50, "C"),
    ("agent_suffix", 6, "C"),
    ("filler", 137, "C"),
)

CHARTER_OFFICER_BUSINESS = (
    ("layout_code", 2, "N"),
    ("filing_num", 10, "N"),
    ("address1", 50, "C"),
    ("address2", 50, "C"),
    ("city", 64, "C"),
    ("state", 4, "C"),
    ("zip_code", 9, "C"),
    ("zip_extension", 6, "C"),
    ("country", 64, "C"),
    ("officer_id", 6, "N"),
    ("officer_title", 32, "C"),
    ("business_name", 150, "C"),
    ("filler", 113, "C"),
)

CHARTER_OFFICER_PERSONAL = (
    ("layout_code", 2, "N"),
    ("filing_num", 10, "N"),
    ("address1", 50, "C"),
    ("address2", 50, "C"),
    ("city", 64, "C"),
    ("state", 4, "C"),
    ("zip_code", 9, "C"),
    ("zip_extension", 6, "C"),
    ("country", 64, "C"),
    ("officer_id", 6, "N"),
    ("officer_title", 32, "C"),
    ("last_name", 50, "C"),
    ("first_name", 50, "C"),
    ("middle_name", 50, "C"),
    ("suffix", 6, "C"),
    ("filler", 107, "C"),
)

CHARTER_NAMES = (
    ("layout_code", 2, "N"),
    ("filing_num", 10, "N"),
    ("name_id", 6, "N"),
    ("name", 150, "C"),
    ("name_status_id", 3, "N"),
    ("name_type_id", 3, "N"),
    ("creation_date", 8, "D"),
    ("inactive_date", 8, "D"),
    ("expire_date", 8, "D"),
    ("county_type", 8, "C"),
    ("consent_filing_number", 11, "N"),
    ("selected_county_array", 254, "C"),
    ("reserved", 5, "C"),
    ("filler", 84, "C"),
)

ASSOCIATED_ENTITY = (
    ("layout_code", 2, "N"),
    ("filing_num", 10, "N"),
    ("associated_entity_id", 6, "N"),
    ("associated_entity_name", 150, "C"),
    ("entity_filing_number", 12, "N"),
    ("entity_filing_date", 8, "D"),
    ("jurisdiction_country", 64, "C"),
    ("jurisdiction_state", 4, "C"),
    ("inactive_date", 8, "D"),
    ("capacity_id", 4, "N"),
    ("filler", 292, "C"),
)

FILING_HIST = (
    ("layout_code", 2, "N"),
    ("filing_num", 10, "N"),
    ("document_number", 14, "N"),
    ("filing_type_id", 12, "N"),
    ("filing_type", 96, "C"),
    ("entry_date", 8, "D"),
    ("filing_date", 8, "D"),
    ("effective_date", 8, "D"),
    ("effective_cond_flag", 2, "N"),
    ("inactive_date", 8, "D"),
    ("filler", 392, "C"),
)

AUDIT_LOG = (
    ("layout_code", 2, "N"),
    ("filing_num", 10, "N"),
    ("audit_date", 8, "D"),
    ("table_id", 4, "N"),
    ("field_id", 4, "N"),
    ("action", 10, "C"),
    ("current_value", 300, "C"),
    ("audit_comment", 222, "C"),
)

# The trailer counts records per layout; the thirteenth count is its own.
TOTALS_LOG = (
    ("layout_code", 2, "N"),
    ("all_9s", 10, "N"),
    ("date_of_run", 8, "D"),
    ("count_01", 12, "N"),
    ("count_02", 12, "N"),
    ("count_03", 12, "N"),
    ("count_04", 12, "N"),
    ("count_05", 12, "N"),
    ("count_06", 12, "N"),
    ("count_07", 12, "N"),
    ("count_08", 12, "N"),
    ("count_09", 12, "N"),
    ("count_10", 12, "N"),
    ("count_11", 12, "N"),
    ("count_12", 12, "N"),
    ("count_13", 12, "N"),
    ("filler", 384, "C"),
)

# The layout code of each record type.  Code 04 is reserved and
# has no fields.
RECORD_TYPES = {
    "01": ("delete_all_log", DELETE_ALL_LOG),
    "02": ("master", MASTER),
    "03": ("address", ADDRESS),
    "04": ("reserved", ()),
    "05": ("registered_agent_business", REGISTERED_AGENT_BUSINESS),
    "06": ("registered_agent_personal", REGISTERED_AGENT_PERSONAL),
    "07": ("charter_officer_business", CHARTER_OFFICER_BUSINESS),
    "08": ("charter_officer_personal", CHARTER_OFFICER_PERSONAL),
    "09": ("charter_names", CHARTER_NAMES),
    "10": ("associated_entity", ASSOCIATED_ENTITY),
    "11": ("filing_hist", FILING_HIST),
    "12": ("audit_log", AUDIT_LOG),
    "99": ("totals_log", TOTALS_LOG),
}

TOTAL_CODES = tuple(int(code) for code in RECORD_TYPES)

# Name, start and end of each field of the property roll.
PROPERTY_ROLL = (
    Field("ptype", 12, 17, "C"),
    Field("hs", 2608, 2609, "C"),
    Field("deed", 2033, 2058, "C"),
    Field("code", 2731, 2741, "C"),
    Field("code2", 2741, 2751, "C"),
    Field("code3", 2751, 2761, "C"),
    Field("lot", 1745, 1795, "C"),
    Field("block", 1695, 1745, "C"),
    Field("sub_div", 1675, 1685, "C"),
    Field("acre", 1659, 1675, "C"),
    Field("description", 1149, 1404, "C"),
    Field("value", 1915, 1930, "C"),
    Field("hood", 1686, 1695, "C"),
    Field("geo_id", 546, 596, "C"),
    Field("prop_id", 0, 12, "C"),
    Field("py_owner_i", 596, 608, "C"),
    Field("prop_owner", 608, 678, "C"),
    Field("st_number", 4459, 4474, "C"),
    Field("prefix", 1039, 1049, "C"),
    Field("st_name", 1049, 1099, "C"),
    Field("suffix", 1099, 1109, "C"),
    Field("city", 1109, 1139, "C"),
    Field("zip", 1139, 1149, "C"),
    Field("unit_num", 4475, 4479, "C"),
    Field("mail_add_1", 693, 753, "C"),
    Field("mail_add_2", 753, 813, "C"),
    Field("mail_add_3", 813, 873, "C"),
    Field("mail_city", 873, 923, "C"),
    Field("mail_state", 923, 974, "C"),
    Field("mail_zip", 978, 983, "C"),
    Field("DBA", 4135, 4175, "C"),
)


def layout_fields(layout: tuple[tuple[str, int, str], ...]) -> list[Field]:
    """A record's fields with running offsets."""
    fields, at = [], 0
    for name, width, kind in layout:
        fields.append(Field(name, at, at + width, kind))
        at += width
    return fields
