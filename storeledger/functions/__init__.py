"""Column expressions; all built-in, no Python workers."""

from storeledger.functions.dates import iso_day, order_day, order_day_layout
from storeledger.functions.numbers import product_sum, python_round, to_number, with_products
from storeledger.functions.text import is_blank, na_to_null, python_list, python_repr

__all__ = [
    "is_blank",
    "iso_day",
    "na_to_null",
    "order_day",
    "order_day_layout",
    "product_sum",
    "python_list",
    "python_repr",
    "python_round",
    "to_number",
    "with_products",
]
