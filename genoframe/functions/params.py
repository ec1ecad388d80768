"""Parameters of a run, and numbers as people read them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def changed(old: Column, new: Column) -> Column:
    """Map of the parameters that both JSON objects have with other values: name to (old, new)."""
    a, b = (F.from_json(c, "map<string,string>") for c in (old, new))
    names = F.array_intersect(F.map_keys(a), F.map_keys(b))
    pairs = F.transform(names, lambda k: F.struct(k.alias("k"), F.struct(F.element_at(a, k).alias("old"), F.element_at(b, k).alias("new")).alias("v")))
    return F.map_from_entries(F.filter(pairs, lambda x: ~x["v"]["old"].eqNullSafe(x["v"]["new"])))


def in_bases(n: Column) -> Column:
    """950 bp, 12.5 kb, 3.0 Mb, 1.10 Gb."""
    return F.when(n >= 1e9, F.format_string("%.2f Gb", n / 1e9)).when(n >= 1e6, F.format_string("%.1f Mb", n / 1e6)).when(n >= 1e3, F.format_string("%.1f kb", n / 1e3)).otherwise(F.format_string("%d bp", n.cast("long")))
