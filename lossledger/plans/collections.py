"""Premium collected per instalment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.functions.rules import local_date, money, signed
from lossledger.plans.membership import Tables
from lossledger.plans.premium import installment_gross

# Transaction types that count as settled, those that pay money back, and the gateway's success code.
SETTLED_TYPES = ("DB", "RF", "FW", "PY", "PR")
REFUND_TYPES = ("PR", "RF", "FW")
GATEWAY_OK = "OK"
PREMIUM_MODEL = "healthplanamendment"


def settled_transactions(transactions: DataFrame, types: Sequence[str] = SETTLED_TYPES) -> DataFrame:
    return transactions.where(
        F.col("transaction_type").isin(*types)
        & (F.col("payment_gateway_result") == GATEWAY_OK)
        & F.col("deleted").isNull()
        & F.col("invoice_id").isNotNull()
    ).select(F.col("id").alias("transaction_id"), "invoice_id", "transaction_type", "confirmed_at")


def items_of_types(items: DataFrame, content_types: DataFrame) -> DataFrame:
    """Live invoice items whose content type is in the given list: a semi join, so nothing is widened."""
    wanted = content_types.select(F.col("id").alias("content_type_id")).distinct()
    return items.where(F.col("deleted").isNull()).join(wanted, "content_type_id", "left_semi")


def item_payments(items: DataFrame, links: DataFrame, settled: DataFrame, how: str = "left") -> DataFrame:
    """Invoice items beside the settled transactions of their invoice."""
    link = links.select(F.col("invoiceitem_id").alias("item_id"), "invoice_id")
    return items.withColumnRenamed("id", "item_id").join(link, "item_id", how).join(settled, "invoice_id", how)


def instalment_payments(t: Tables) -> DataFrame:
    """Each premium instalment (amendment_id, number, dates, amounts) beside its settled transactions, if any."""
    scope = items_of_types(t["invoice_item"], t["content_type"].where(F.col("model") == PREMIUM_MODEL))
    items = scope.select(
        "id",
        F.col("object_id").alias("amendment_id"),
        "installment_number",
        F.col("valid_since").alias("installment_valid_since"),
        F.col("valid_through").alias("installment_valid_through"),
        money(F.col("subtotal_cents")).alias("_sub"),
        money(F.col("net_premium_cents")).alias("_net"),
        money(F.col("total_cents")).alias("_tot"),
    )
    # Times become dates before the shuffles, which carry them twice.
    settled = settled_transactions(t["transaction"]).withColumn("_date", local_date(F.col("confirmed_at"))).drop("confirmed_at")
    return item_payments(items, t["invoice_item_invoice"], settled).drop("invoice_id", "item_id")


def signed_collections(premium: DataFrame, t: Tables, payments: DataFrame | None = None) -> DataFrame:
    """Premium rows beside each instalment and settled transaction, refunds negative. Uncollected rows stay, with
    NULL transaction columns. ``payments`` are the instalments' payments where they are written already, with all columns
    or without those (of subtotals, totals, transactions' ids) that nobody reads."""
    paid = instalment_payments(t) if payments is None else payments
    rows = premium.join(paid, "amendment_id", "left")
    code = F.col("transaction_type")
    gross = installment_gross(F.col("net_premium_before_discount"), F.col("_net"), F.col("net_premium"))
    amounts = {"installment_net_premium": "_net", "installment_subtotal": "_sub", "installment_total": "_tot"}
    return rows.withColumns(
        {
            "installment_net_premium_before_discount": signed(gross, code, REFUND_TYPES),
            **{out: signed(F.col(c), code, REFUND_TYPES) for out, c in amounts.items() if c in paid.columns},
            "transaction_date": F.col("_date"),
        }
    ).drop("_sub", "_net", "_tot", "_date")
