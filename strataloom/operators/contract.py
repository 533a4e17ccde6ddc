"""The column contract: what may be emitted, what must be, what nobody declared."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from strataloom.model import ASSAY_COLUMNS, DENIED, DENY_EXEMPT, EXTRA_DECLARED, FILE_COLUMNS, LINK_KEYS, LayerSpec


def normalized(name: str) -> str:
    return re.sub(r"[^a-z0-9]", "", name.lower())


_EXEMPT = frozenset(normalized(x) for x in DENY_EXEMPT)


class ScopeError(RuntimeError):
    """A column that must not be emitted."""


def denied(columns: list[str]) -> list[str]:
    """Columns whose normalized name contains a denied fragment and is not exempt as a whole."""
    return [c for c in columns if normalized(c) not in _EXEMPT and any(t in normalized(c) for t in DENIED)]


def scope_gate(columns: list[str], report_only: bool = False) -> list[str]:
    """Denied columns; raises on any, unless only a report is wanted."""
    found = denied(columns)
    if found and not report_only:
        raise ScopeError(f"columns outside of the permitted scope: {found}")
    return found


def gated(df: DataFrame) -> DataFrame:
    """The frame itself, after the gate: every sink calls this."""
    scope_gate(df.columns)
    return df


def read_columns(df: DataFrame) -> list[str]:
    """Columns that the plan of df takes from its sources, after pruning: those of the leaves of the
    physical plan and of its subqueries. Nothing runs."""
    found, todo = {}, [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            plan = plan.initialPlan()
        for part in (plan.collectLeaves(), plan.subqueriesAll()):
            for i in range(part.size()):
                node = part.apply(i)
                if node.getClass().getSimpleName() in ("AdaptiveSparkPlanExec", "SubqueryExec", "SubqueryBroadcastExec", "SubqueryAdaptiveBroadcastExec", "ReusedSubqueryExec"):
                    todo.append(node if node.children().isEmpty() else node.children().apply(0))
                else:
                    out = node.output()
                    found |= {out.apply(j).name(): None for j in range(out.size())}
    return list(found)


def guarded(df: DataFrame) -> DataFrame:
    """The frame itself, if its plan reads no denied column; raises before any file is opened. A
    column that pruning leaves out is not read, and does not count."""
    found = denied(read_columns(df))
    if found:
        raise ScopeError(f"the plan reads columns outside of the permitted scope: {found}")
    return df


def undeclared(columns: list[str], layers: list[LayerSpec]) -> list[str]:
    """Columns outside the declared surface of all layers; reported, never enforced."""
    declared = set(EXTRA_DECLARED).union(*[x.columns() for x in layers])
    return sorted(c for c in set(columns) if c not in declared)


def required_columns() -> list[str]:
    return list(dict.fromkeys((*LINK_KEYS, *ASSAY_COLUMNS, *FILE_COLUMNS)))
