"""Table schemas and their enforcement.

All casts are ``try_cast``: dirty text becomes null and never fails a job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, DataType, DateType, DoubleType, FloatType, IntegerType, IntegralType, NumericType,
    StringType, StructField, StructType,
)

KEY = ["Customer_ID", "snapshot_date"]
CUSTOMER, SNAPSHOT = KEY

# Column names and types of the input tables and of the wide table.
LOAN_TYPES: dict[str, DataType] = {
    "loan_id": StringType(),
    "Customer_ID": StringType(),
    "loan_start_date": DateType(),
    "tenure": IntegerType(),
    "installment_num": IntegerType(),
    "loan_amt": FloatType(),
    "due_amt": FloatType(),
    "paid_amt": FloatType(),
    "overdue_amt": FloatType(),
    "balance": FloatType(),
    "snapshot_date": DateType(),
}
CLICK_COLUMNS = [f"fe_{i}" for i in range(1, 21)]
CLICK_TYPES: dict[str, DataType] = {
    "Customer_ID": StringType(), "snapshot_date": DateType(),
} | {c: IntegerType() for c in CLICK_COLUMNS}
WIDE_TYPES: dict[str, DataType] = {
    "Customer_ID": StringType(), "snapshot_date": DateType(),
} | {c: DoubleType() for c in CLICK_COLUMNS} | {
    "Age": IntegerType(),
    "SSN": StringType(),
    "Occupation": StringType(),
    "Annual_Income": DoubleType(),
    "Monthly_Inhand_Salary": DoubleType(),
    "Num_Bank_Accounts": IntegerType(),
    "Num_Credit_Card": IntegerType(),
    "Interest_Rate": IntegerType(),
    "Num_of_Loan": IntegerType(),
    "Type_of_Loan": StringType(),
    "Delay_from_due_date": IntegerType(),
    "Num_of_Delayed_Payment": IntegerType(),
    "Changed_Credit_Limit": DoubleType(),
    "Num_Credit_Inquiries": IntegerType(),
    "Credit_Mix": StringType(),
    "Outstanding_Debt": DoubleType(),
    "Credit_Utilization_Ratio": DoubleType(),
    "Credit_History_Age": DoubleType(),
    "Payment_of_Min_Amount": StringType(),
    "Total_EMI_per_month": DoubleType(),
    "Amount_invested_monthly": DoubleType(),
    "Payment_Behaviour": StringType(),
    "Monthly_Balance": DoubleType(),
    "Name": StringType(),
    "cleaned_loans": StringType(),
    "loan_array": ArrayType(StringType()),
}


def struct_of(types: dict[str, DataType]) -> StructType:
    """A read schema from a name-to-type map."""
    return StructType([StructField(n, t) for n, t in types.items()])


def to_type(c: Column, source: DataType, target: DataType) -> Column:
    """Cast that yields null where the value does not fit; text to a whole number goes through double."""
    if source == target:
        return c
    if isinstance(target, IntegralType) and isinstance(source, StringType):
        c = c.try_cast("double")
    return c.try_cast(target)


def enforce(df: DataFrame, types: dict[str, DataType], strict: bool = True) -> DataFrame:
    """Cast every listed column in one projection; other columns pass through.

    ``strict`` demands that all listed columns exist, otherwise absent ones are skipped.
    Names are matched without regard to case and take the spelling of ``types``.
    """
    wanted = {n.lower(): (n, t) for n, t in types.items()}
    missing = sorted(set(wanted) - {c.lower() for c in df.columns})
    if strict and missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    out = []
    for field in df.schema.fields:
        name, target = wanted.get(field.name.lower(), (field.name, field.dataType))
        out.append(to_type(F.col(f"`{field.name}`"), field.dataType, target).alias(name))
    return df.select(*out)


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the columns with a numeric type, in table order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Names of the columns that start with ``prefix``, in table order."""
    return [c for c in df.columns if c.startswith(prefix)]
