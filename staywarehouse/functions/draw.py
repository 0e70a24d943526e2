"""Repeatable draws: integer arithmetic on an id, so any engine computes the same rows.

The functions return SQL text over column names, for ``selectExpr`` and ``expr``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

MODULUS = 2147483647


def draw(identity: str, salt: int, bound: int | str) -> str:
    """An integer in [0, bound), fixed by ``identity`` and ``salt``.

    A linear step, a square and a second linear step modulo a prime; every product stays
    below 2**63.
    """
    first = f"((cast({identity} as bigint) % {MODULUS} * 48271 + {salt * 69621}) % {MODULUS})"
    second = f"({first} * {first} % {MODULUS})"
    return f"(({second} * 16807 + {first} * 40692 + {salt}) % {MODULUS} % ({bound}))"


def between(identity: str, salt: int, low: int, high: int) -> str:
    """A whole number from ``low`` to ``high``, both included."""
    return f"({draw(identity, salt, high - low + 1)} + {low})"


def chance(identity: str, salt: int, percent: int) -> str:
    return f"({draw(identity, salt, 100)} < {percent})"


def pick(identity: str, salt: int, values: Sequence[str]) -> str:
    """One of ``values``, all equally likely."""
    options = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({options}), cast({draw(identity, salt, len(values))} + 1 as int))"


def weighted(identity: str, salt: int, weights: Mapping[object, int]) -> str:
    """One of the keys of ``weights``, which are percentages adding up to 100.

    The draw falls among the running totals of the weights; one plus the number of totals it
    has reached is the position of the choice.
    """
    if sum(weights.values()) != 100:
        raise ValueError("weights must add up to 100")
    ticket, reached, steps = draw(identity, salt, 100), 0, []
    for weight in list(weights.values())[:-1]:
        reached += weight
        steps.append(f"cast({ticket} >= {reached} as int)")
    options = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in weights)
    return f"element_at(array({options}), {' + '.join(['1', *steps])})"
