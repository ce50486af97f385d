"""Column-expression helpers (all JVM-side, codegen friendly)."""

from .hashing import rolling_hash, HASH_MULTIPLIER, BITMAP_BITS
from .times import seconds_of, interval, to_event_ts, utc_ntz
from .urls import is_static_resource, url_host
from .json import json_long

__all__ = ["rolling_hash", "HASH_MULTIPLIER", "BITMAP_BITS", "seconds_of", "interval",
           "to_event_ts", "utc_ntz", "is_static_resource",
           "url_host", "json_long"]
