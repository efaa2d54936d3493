"""Checks base64 payloads that claim to be PDF documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the first bytes of a PDF document.
PDF_MAGIC = "255044462D"


def check_payloads(rows: DataFrame, column: str) -> DataFrame:
    """Adds `valid` and `reason` (NULL, 'not base64' or 'not a pdf'); the payload column is dropped."""
    encoded = F.col(column)
    solid = F.when(encoded.rlike("[ \t\r\n]"), F.translate(encoded, " \t\r\n", "")).otherwise(encoded)
    # The decoder checks the alphabet; missing padding it would accept.
    padded = F.length(solid) % 4 == 0
    content = F.when(padded, F.try_to_binary(encoded, F.lit("base64")))
    is_pdf = F.startswith(F.col("_content"), F.to_binary(F.lit(PDF_MAGIC), F.lit("hex")))
    reason = F.when(F.col("_content").isNull(), F.lit("not base64")).when(~is_pdf, F.lit("not a pdf"))
    decoded = rows.withColumn("_content", content).withColumn("reason", reason)
    return decoded.withColumn("valid", F.col("reason").isNull()).drop(column, "_content")
