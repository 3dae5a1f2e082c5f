"""File-to-file jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lagfield.operators.panel import pair_panel, zero_fill
from lagfield.sources.io import read_sell_in, write_csv, write_panel
from lagfield.session import stored

# fixed values: measures of the sell-in file and the column order of the panel file
SELL_IN_MEASURES = ("cust_request_qty", "request_tn", "tn")
PANEL_NAMES = {"plan_flag": "plan_precios_cuidados", "request_tn": "cust_request_tn"}


def zero_filled_file(spark: SparkSession, sell_in: str, out: str, as_csv: bool = False) -> None:
    """Sell-in file to the zero-filled panel.

    Parquet by month unless ``as_csv``, which gives gzip text sorted by customer,
    product and month with the columns of the original file.
    """
    facts = stored(read_sell_in(spark, sell_in), "sell-in")
    if not as_csv:
        write_panel(pair_panel(facts, SELL_IN_MEASURES), out)
        return
    filled = zero_fill(facts, SELL_IN_MEASURES).withColumnsRenamed(PANEL_NAMES)
    order = ["customer_id", "product_id", "periodo"]
    write_csv(filled.select(*order, "plan_precios_cuidados", "cust_request_qty", "cust_request_tn", "tn"), out, "gzip", order)


