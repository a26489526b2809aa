"""Rules for column names, evaluated on the driver over ``df.columns``."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearwell.contracts import ContractError

# Every one of these characters becomes an underscore.
_SEPARATORS = " -."
_TO_UNDERSCORE = str.maketrans(dict.fromkeys(_SEPARATORS, "_"))


def tidy_name(name: str) -> str:
    return name.strip().lower().translate(_TO_UNDERSCORE)


def tidy_names(names: Sequence[str], on_collision: str = "raise") -> list[str]:
    """Tidy all names; two that become equal raise, or get ``_2``, ``_3`` …"""
    tidy = [tidy_name(name) for name in names]
    repeated = sorted(name for name, n in Counter(tidy).items() if n > 1)
    if not repeated:
        return tidy
    if on_collision == "raise":
        raise ContractError(f"columns fall together after tidying: {', '.join(repeated)}")
    if on_collision != "suffix":
        raise ValueError(f"on_collision must be 'raise' or 'suffix', not {on_collision!r}")
    taken, result = set(tidy), []
    used: set[str] = set()
    for name in tidy:
        chosen, n = name, 2
        while chosen in used or (chosen != name and chosen in taken):
            chosen, n = f"{name}_{n}", n + 1
        used.add(chosen)
        result.append(chosen)
    return result


def column(name: str) -> Column:
    """The column called exactly ``name``, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")
