"""Column functions: each takes columns and returns a column."""

from erpweave.functions.dates import days_between, month_of, month_start, sap_date, year_of
from erpweave.functions.flags import code_label, flag_to_bool, is_blank, not_flag
from erpweave.functions.keys import hierarchy_level, object_key, strip_leading_zeros
from erpweave.functions.numbers import guarded_ratio, money, quantity, rate, signed_amount
from erpweave.functions.privacy import mask_tax_id, register_mask_udf
from erpweave.functions.ranges import SelectOption, in_ranges

__all__ = [
    "SelectOption", "code_label", "days_between", "flag_to_bool", "guarded_ratio",
    "hierarchy_level", "in_ranges", "is_blank", "mask_tax_id", "money", "month_of",
    "month_start", "not_flag", "object_key", "quantity", "rate", "register_mask_udf",
    "sap_date", "signed_amount", "strip_leading_zeros", "year_of",
]
