"""Small plain statements of results, for comparing with Spark on fixtures."""

import hashlib
import math


def order_key(seed, *ids):
    return hashlib.md5(":".join((str(seed), *map(str, ids))).encode()).hexdigest()


def same(a, b):
    if a is None or b is None:
        return a is b
    if isinstance(a, float) or isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or math.isclose(a, b)
    return a == b
