"""Run the checks with every size bound forced down, so that the beyond-bound paths give the results.

Nothing is broadcast by the operators, cells, blocks, groups and runs are tiny, and long transforms are
cut. The SQL stays the same.
"""

from __future__ import annotations

import dataclasses
import inspect
import sys

from checks import compare, queries
from gridtide.operators import (
    clean, decompose, describe, distribution, forecast, models, position, quantile, relate, sequence, sifting, skew, spectrum,
)

BOUNDS = {"cell_rows": 50, "block_rows": 256, "run_rows": 1, "group_points": 200}


def lower_bounds() -> None:
    for module in (clean, decompose, describe, distribution, forecast, models, position, quantile, relate, sequence, sifting, skew, spectrum):
        for function in vars(module).values():
            if not inspect.isfunction(function) or not function.__defaults__:
                continue
            names = list(inspect.signature(function).parameters)
            names = names[: function.__code__.co_argcount][-len(function.__defaults__):]
            function.__defaults__ = tuple(BOUNDS.get(n, d) for n, d in zip(names, function.__defaults__))
    queries.SHORT = dataclasses.replace(queries.SHORT, block_rows=BOUNDS["block_rows"])
    queries.DEFAULTS = dataclasses.replace(queries.DEFAULTS, block_rows=BOUNDS["block_rows"])
    queries.prepared.__defaults__ = (queries.SHORT,)


if __name__ == "__main__":
    lower_bounds()
    arguments = sys.argv[1:]
    where = arguments.pop(0) if arguments and "/" in arguments[0] else "/root/testdata/sf0.01"
    sys.exit(1 if compare.main(where, arguments) else 0)
