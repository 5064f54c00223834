"""Lightest derivations in a weighted hypergraph, by an agenda.

Items are derived by rules from one or two items. A rule's value never lies below the values it is
made of and grows with them (a superior function), so the least value on the agenda is final when
it is popped and no item is looked at twice.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from heapq import heappop, heappush

Item = Hashable
Value = tuple  # compared as it is: (cost, letters of the edits so far)
Rule = Callable[[Item, Value, dict[Item, Value]], Iterable[tuple[Item, Value]]]


def lightest(axioms: Iterable[tuple[Item, Value]], rule: Rule, goal: Item | None = None) -> dict[Item, Value]:
    """The final values of the items popped until ``goal`` is final (all items, without a goal).

    ``rule(item, value, final)`` gives what the new final item derives, alone or together with items
    in ``final``.
    """
    final: dict[Item, Value] = {}
    waiting: dict[Item, Value] = {}
    agenda: list[tuple[Value, int, Item]] = []
    pushed = 0

    def push(item: Item, value: Value) -> None:
        nonlocal pushed
        if item not in final and (item not in waiting or value < waiting[item]):
            waiting[item] = value
            heappush(agenda, (value, pushed, item))
            pushed += 1

    for item, value in axioms:
        push(item, value)
    while agenda:
        value, _, item = heappop(agenda)
        if item in final:
            continue
        final[item] = value
        if item == goal:
            break
        for derived in rule(item, value, final):
            push(*derived)
    return final
