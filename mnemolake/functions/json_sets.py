"""JSON containment: a document holds another if it has all its members, and in arrays an element for each of its elements."""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def _refuse(name: str):
    raise ValueError(f"{name} is no JSON")


def read_json(text: str | None):
    """A parsed document in a list of one, or None for what is no JSON or nests deeper than Python reads."""
    if text is None:
        return None
    try:
        return [json.loads(text, parse_float=Decimal, parse_int=Decimal, parse_constant=_refuse)]
    except (ValueError, ArithmeticError, RecursionError):
        return None


def _scalar(x) -> str:
    if isinstance(x, bool) or x is None:
        return json.dumps(x)
    return json.dumps(x) if isinstance(x, str) else format(x.normalize() + 0, "f") if abs(x.adjusted()) < 400 else str(x.normalize())


def path_values(x) -> set[str]:
    """Every container and scalar with the path to it. What holds another document has all its pairs; array elements
    share one path, so the reverse needs ``holds``."""
    out, todo = set(), [("$", x)]
    while todo:
        path, v = todo.pop()
        if isinstance(v, dict):
            out.add(path + "{")
            todo += [(f"{path}.{json.dumps(k)}", w) for k, w in v.items()]
        elif isinstance(v, list):
            out.add(path + "[")
            todo += [(path + "[]", w) for w in v]
        else:
            out.add(f"{path}={_scalar(v)}")
    return out


def _same(a, b) -> bool:
    return isinstance(a, bool) == isinstance(b, bool) and a == b


def holds(big, small) -> bool:
    """Whether ``big`` contains ``small``: objects by members, arrays by elements in any order, scalars by value."""
    if isinstance(small, dict):
        return isinstance(big, dict) and all(k in big and holds(big[k], v) for k, v in small.items())
    if isinstance(small, list):
        return isinstance(big, list) and all(any(holds(b, s) for b in big) for s in small)
    return not isinstance(big, (dict, list)) and _same(big, small)


def path_values_of(text: Column) -> Column:
    """The pairs of a JSON text; null where it is none."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            parsed = [read_json(t) for t in b.to_pylist()]
            yield pa.array([None if p is None else sorted(path_values(p[0])) for p in parsed], pa.list_(pa.string()))

    return F.arrow_udf(run, "array<string>")(text)


def json_holds(big: Column, small: Column) -> Column:
    """Containment of two JSON texts; null where either is none."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            wanted: dict[str, object] = {}
            out = []
            for x, y in zip(a.to_pylist(), b.to_pylist()):
                if y not in wanted:
                    wanted[y] = read_json(y)
                p, q = read_json(x), wanted[y]
                out.append(None if p is None or q is None else holds(p[0], q[0]))
            yield pa.array(out, pa.bool_())

    return F.arrow_udf(run, "boolean")(big, small)
