"""Options of multiple-choice questions: wrong answers that could be right."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamstack.functions import constants as K
from loamstack.functions import draws
from loamstack.operators.taxonomy import CONFUSABLE, DEFECTS, OTHER, PART_DEFECTS

LETTERS, N_OPTIONS = "ABCDEF", 4


def named(type_: Column) -> Column:
    """The name (Chinese) of a type."""
    return K.look({d[0]: d[1] for d in DEFECTS}, type_)


def ranked(types: Column, role: Column, active: list[str], seed: int, id_: Column) -> Column:
    """Wrong types for a picture that shows ``types`` (the first is asked for), best first.

    Types in ``active`` that the picture does not show and that a part of this ``role`` can (any type, if the role is null or has no list):
    first those that look like the right one, then those of its group, then the rest, each drawn.
    """
    right = F.get(types, 0)
    # Levels depend on the right type and the role alone: one constant list for each pair of them.
    every = _listed_by(right, active, None)
    found = F.when(role.isNull(), every)
    for r, possible in PART_DEFECTS.items():
        found = found.when(role == r, _listed_by(right, active, possible))
    shown = F.filter(found.otherwise(every), lambda x: ~F.array_contains(types, x["t"]))
    return F.transform(F.sort_array(F.transform(shown, lambda x: F.struct(x["level"].alias("level"), draws.key(seed, id_, x["t"]).alias("h"), x["t"].alias("t")))), lambda x: x["t"])


def _listed_by(right: Column, active: list[str], possible: tuple | None) -> Column:
    """Types in ``active`` that are ``possible`` (None: all), each with its level beside the right one."""
    groups = {d[0]: d[2] for d in DEFECTS}
    usable = [t for t in active if t != OTHER and (possible is None or t in possible)]
    level = lambda right, t: 0 if any({right, t} == set(pair) for pair in CONFUSABLE) else 1 if right in groups and groups.get(t) == groups[right] else 2
    of = lambda right: f"cast(array({', '.join(f'struct({level(right, t)}, {K.literal(t)})' for t in usable)}) as array<struct<level:int,t:string>>)"
    return F.coalesce(F.try_element_at(K.table({r: of(r) for r in groups}), right), F.expr(of(None)))


def options(types: Column, role: Column, active: list[str], seed: int, id_: Column, n: int = N_OPTIONS) -> Column:
    """The names (Chinese) of the first type and of wrong ones, ``n`` in all or as many as there are, in drawn order."""
    every = F.concat(F.array(F.get(types, 0)), F.slice(ranked(types, role, active, seed, id_), 1, n - 1))
    mixed = F.sort_array(F.transform(every, lambda t: F.struct(draws.key(seed, id_, F.lit("o"), t).alias("h"), t.alias("t"))))
    return F.when(F.size(types) > 0, F.transform(mixed, lambda x: named(x["t"])))


def letter(options_: Column, name: Column) -> Column:
    """The letter under which ``name`` stands."""
    return F.get(K.array(LETTERS), (F.array_position(options_, name) - 1).cast("int"))


def listed(options_: Column) -> Column:
    """One line for each option."""
    return F.array_join(F.transform(options_, lambda o, i: F.concat(F.get(K.array(LETTERS), i), F.lit(". "), o)), "\n")
