"""The lexical control: flags from a harm lexicon, with the guard for neutral self-description."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T

LEXICAL_RATIONALE = "[lexical control] word match; not a model verdict."


@dataclass(frozen=True)
class Lexicon:
    """Heads with their terms. ``implied`` is the parent label that every other head raises."""

    heads: Mapping[str, Sequence[str]]
    whole_words: frozenset[str] = frozenset()
    implied: str | None = "toxic"
    self_markers: Sequence[str] = ()
    self_groups: Sequence[str] = ()
    guarded_by: Sequence[str] = field(default=())

    def settings(self) -> list:
        """All that decides a flag, in an order that doesn't vary."""
        return [sorted((k, list(v)) for k, v in self.heads.items()), sorted(self.whole_words), self.implied,
                list(self.self_markers), list(self.self_groups), list(self.guarded_by)]

    @property
    def labels(self) -> list[str]:
        heads = list(self.heads)
        return heads if self.implied is None or self.implied in heads else [self.implied, *heads]

    def flags(self, text: Column, guard: bool = False) -> dict[str, Column]:
        """Boolean column per label over one text column.

        With ``guard`` on, a text in which someone neutrally describes themselves is not given
        the parent label by its own terms; another head (or a ``guarded_by`` head) still is.
        """
        lowered = F.lower(T.or_empty(text))
        own = {h: T.contains_term(lowered, terms, h in self.whole_words) for h, terms in self.heads.items()}
        if self.implied is None:
            return own
        others = [c for h, c in own.items() if h != self.implied]
        raised = reduce(lambda a, b: a | b, others) if others else F.lit(False)
        parent = own.get(self.implied, F.lit(False))
        if guard:
            parent = parent & ~self.neutral(text)
        return {x: (parent | raised) if x == self.implied else own[x] for x in self.labels}

    def neutral(self, text: Column) -> Column:
        """A self-description with a group term near it and none of the guarding heads."""
        lowered = F.lower(T.or_empty(text))
        found = T.near_terms(lowered, self.self_markers, self.self_groups)
        for h in self.guarded_by:
            found = found & ~T.contains_term(lowered, self.heads[h], h in self.whole_words)
        return found


def clauses_of(flags: Mapping[str, Column], clauses: Mapping[str, str]) -> Column:
    """Sorted distinct clauses of the raised labels."""
    listed = F.array_compact(F.array(*[F.when(c, F.lit(clauses[x])) for x, c in flags.items()]))
    return F.array_sort(F.array_distinct(listed))
