from starweave.functions.keys import digest_key, prefix_key, whole_key
from starweave.functions.numbers import trunc_int
from starweave.functions.times import date_parts, has_fraction, parse_timestamp

__all__ = [
    "date_parts",
    "digest_key",
    "has_fraction",
    "parse_timestamp",
    "prefix_key",
    "trunc_int",
    "whole_key",
]
