"""Purchase-event analytics on PySpark: batch totals, live totals and the views between them."""
