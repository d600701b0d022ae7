"""Small helpers of the tests."""

from __future__ import annotations

import json


def rows(df, *columns):
    """Rows as sorted tuples, nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r])


def payload(item, **more):
    return json.dumps({"item": item, **more})


def write_unit(topic, unit, lines, name="part-0.txt"):
    """Put one file of payload lines into a unit folder of a file topic."""
    place = topic / f"unit={unit}"
    place.mkdir(parents=True, exist_ok=True)
    (place / name).write_text("".join(line + "\n" for line in lines))
