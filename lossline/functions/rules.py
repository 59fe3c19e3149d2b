"""Data-quality rules as named predicates.

Semantics (as the reference applies them):
- drop rules: a row is kept only when every drop predicate is TRUE, so FALSE
  or NULL drops it (a SQL ``WHERE a AND b``);
- warn rules: counted over kept rows as ``NOT rule`` being TRUE, so a NULL
  input is not a violation.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DROP_RULE_DOMAINS, DROP_RULE_SQL, WARN_RULE_SQL


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str  # "drop" | "warn"
    sql: str  # a predicate, or a column whose values must be ``allowed``
    allowed: tuple[str, ...] = ()

    @property
    def predicate(self) -> Column:
        return F.col(self.sql).isin(*self.allowed) if self.allowed else F.expr(self.sql)

    def violated(self) -> Column:
        """TRUE where the row fails the rule under this rule's kind."""
        if self.kind == "drop":
            return ~F.coalesce(self.predicate, F.lit(False))
        return F.coalesce(~self.predicate, F.lit(False))


DROP_RULES = (*(Rule(name, "drop", sql) for name, sql in DROP_RULE_SQL),
              *(Rule(name, "drop", column, allowed) for name, column, allowed in DROP_RULE_DOMAINS))
WARN_RULES = tuple(Rule(name, "warn", sql) for name, sql in WARN_RULE_SQL)

RULES = DROP_RULES + WARN_RULES


def rule(name: str) -> Rule:
    for r in RULES:
        if r.name == name:
            return r
    raise KeyError(name)


def keep_predicate(rules=DROP_RULES) -> Column:
    """Conjunction of the drop rules (NULL counts as failing under WHERE)."""
    return reduce(lambda a, b: a & b, (r.predicate for r in rules))


def passes_all(rules=DROP_RULES) -> Column:
    """Null-safe boolean: TRUE only when every rule is TRUE."""
    return F.coalesce(keep_predicate(rules), F.lit(False))


def failed_rule_names(rules=DROP_RULES, sep: str = ",") -> Column:
    """Comma-joined names of the failed rules (NULL rule result fails)."""
    return F.concat_ws(sep, *[F.when(r.violated(), F.lit(r.name)) for r in rules])
