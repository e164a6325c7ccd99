"""Scalar rules as native Column expressions, with Python/pandas/SQL twins."""

from cartwheel.functions.email import domain_column, domain_function, domain_of, domain_udf, emails_in
from cartwheel.functions.rules import (
    discount_amount_column,
    discount_amount_function,
    discount_amount_pandas_udf,
    discount_amounts,
    rate_column,
    register_python_functions,
    register_sql_functions,
    tier_column,
    tier_function,
    tier_of,
    tier_udf,
)

__all__ = [
    "discount_amount_column", "discount_amount_function", "discount_amount_pandas_udf",
    "discount_amounts", "domain_column", "domain_function", "domain_of", "domain_udf", "emails_in",
    "rate_column", "register_python_functions", "register_sql_functions", "tier_column",
    "tier_function", "tier_of", "tier_udf",
]
