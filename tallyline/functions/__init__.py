from tallyline.functions.decode import classify, decode, decode_rows, reject_reason, usable_item
from tallyline.functions.encode import encode, machine_name
from tallyline.functions.enrich import catalogue, enrich, health_label, price_of
from tallyline.functions.time import micros_of, parse_any_time, parse_time

__all__ = [
    "catalogue", "classify", "decode", "decode_rows", "encode", "enrich", "health_label", "machine_name",
    "micros_of", "parse_any_time", "parse_time", "price_of", "reject_reason", "usable_item",
]
