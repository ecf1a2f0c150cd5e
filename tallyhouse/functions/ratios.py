"""Derived risk features, as name-to-expression maps for one ``withColumns`` call.

Divisions are ``try_divide``: a zero denominator gives null.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

c = F.col
RECENT_DELAY_DAYS = 10
MULTI_BORROWER_PRODUCTS = 6


def wide_features() -> dict[str, Column]:
    """Features of the first feature store."""
    ratio = lambda top, bottom: F.round(F.try_divide(top, bottom), 2)
    products = c("Num_Bank_Accounts") + c("Num_Credit_Card")
    return {
        "Recent_Delays": F.when(c("Delay_from_due_date") > RECENT_DELAY_DAYS, 1).otherwise(0),
        "Income_to_Debt_Ratio": ratio(c("Annual_Income"), c("Outstanding_Debt")),
        "EMI_to_Income_Ratio": ratio(c("Total_EMI_per_month"), c("Annual_Income") / 12),
        "Monthly_Saving": F.round(
            c("Monthly_Inhand_Salary") - c("Total_EMI_per_month") - c("Amount_invested_monthly"), 2),
        "Is_Multi_Borrower": F.when(products > MULTI_BORROWER_PRODUCTS, 1).otherwise(0),
        "Int_across_loans": ratio(c("Interest_Rate"), c("Num_of_Loan")),
        "Delinquency_Score": ratio(c("Num_of_Delayed_Payment"), c("Num_Credit_Card") + c("Num_of_Loan")),
    }


def risk_features() -> dict[str, Column]:
    """Features of the second feature store."""
    salary = c("Monthly_Inhand_Salary")
    return {
        "Num_Fin_Pdts": c("Num_Bank_Accounts") + c("Num_Credit_Card") + c("Num_of_Loan"),
        "Loans_per_Credit_Item": F.try_divide(
            c("Num_of_Loan"), c("Num_Bank_Accounts") + c("Num_Credit_Card") + F.lit(1)),
        "Debt_to_Salary": F.try_divide(c("Outstanding_Debt"), salary + 1),
        "EMI_to_Salary": F.try_divide(c("Total_EMI_per_month"), salary + 1),
        "Repayment_Ability": salary - c("Total_EMI_per_month"),
        "Loan_Extent": c("Delay_from_due_date") * c("Num_of_Loan"),
    }
