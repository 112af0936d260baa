"""fact_cs_tickets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlake import schemas as S
from patronlake.functions.stamps import parse_stamp
from patronlake.functions.text import clean_email, text_or
from patronlake.functions.vocab import keep_if_in
from patronlake.operators.cleaning import CleanPlan, clean_rows


def category_of_rating(rating: Column) -> Column:
    """1, 2 → complaint; 3 → inquiry; 4, 5 → praise; anything else has none."""
    complaint, inquiry, praise = S.ISSUE_CATEGORIES
    return (
        F.when(rating.isin(1, 2), complaint).when(rating == 3, inquiry).when(rating.isin(4, 5), praise)
    )


def tickets_plan(raw: DataFrame) -> CleanPlan:
    # A workbook column with gaps is exported as 3.0, so read the number first and then the whole.
    rating = F.col("Customer_Rating").try_cast("double")
    category = category_of_rating(rating)
    if "Issue_Type" in raw.columns:
        category = F.coalesce(keep_if_in(F.col("Issue_Type"), S.ISSUE_CATEGORIES), category)
    reported = parse_stamp(F.col("Reported_Date"), raw.schema["Reported_Date"].dataType)
    return CleanPlan(
        S.FACT_CS_TICKETS.name,
        "Ticket_ID",
        {
            "ticket_id": F.col("Ticket_ID"),
            "order_id": F.col("Order_ID"),
            "customer_email": clean_email(F.col("Customer_Email")),
            "issue_category": category,
            "status": text_or(F.col("Status"), "Unknown"),
            "rating": rating.try_cast("int"),
            "reported_at": reported,
        },
        parsed={
            "customer_email": "Customer_Email",
            "rating": "Customer_Rating",
            "reported_at": "Reported_Date",
        },
    )


def clean_tickets(raw: DataFrame) -> DataFrame:
    return clean_rows(raw, tickets_plan(raw))
