from tallyline.plans.layers import run_batch_increment, run_batch_view, served_totals
from tallyline.plans.totals import items_sold, items_sold_live

__all__ = ["items_sold", "items_sold_live", "run_batch_increment", "run_batch_view", "served_totals"]
