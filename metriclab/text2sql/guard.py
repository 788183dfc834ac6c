"""Only reading plans over the given tables may run.

A statement is parsed, not searched for words: its plan must be made of reading nodes,
every relation must be a name on the list, so paths and table functions stay out, and
every function must be one of the engine's own that work on values.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import SparkSession

#: Words that the strict mode refuses anywhere.
FORBIDDEN = ("insert", "update", "delete", "drop", "alter", "create", "truncate", "attach", "detach", "pragma", "vacuum", "replace")
#: Logical nodes that only read.
READING = frozenset(
    "Project Filter Aggregate Sort Join Distinct GlobalLimit LocalLimit Limit Offset Union Intersect Except SubqueryAlias UnresolvedRelation UnresolvedWith CTERelationDef WithCTE UnresolvedSubqueryColumnAliases "
    "UnresolvedInlineTable OneRowRelation UnresolvedHaving Window WithWindowDefinition Pivot Unpivot Generate LateralJoin Expand Sample UnresolvedOrdinal UnresolvedHint UnresolvedPivot LocalRelation Values UnresolvedTableAlias".split()
)


#: Group of the engine's own functions that call Java methods or tell about files, users and the session.
CLOSED_GROUP = "misc_funcs"
#: Names that the engine reads as functions of the session where no column has them.
SESSION = frozenset(("current_user", "user", "session_user", "current_catalog", "current_database", "current_schema"))


class RefusedQuery(ValueError):
    """The statement isn't one that may run."""


def stripped(reply: str) -> str:
    """SQL of a model's reply: without fences, talk before a fence, or the last semicolon."""
    fenced = re.search(r"```(?:\w+)?\s*(.*?)```", reply, re.S)
    return (fenced[1] if fenced else reply).strip().rstrip(";").strip()


def _nodes(plan) -> Iterable:
    """A plan's nodes with those of its expressions' subqueries and its CTEs."""
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        yield node
        for i in range(node.children().length()):
            waiting.append(node.children().apply(i))
        inner = node.innerChildren()
        for i in range(inner.length()):
            child = inner.apply(i)
            if hasattr(child, "nodeName"):
                waiting.append(child)
        if node.nodeName() == "UnresolvedWith":
            relations = node.cteRelations()
            for i in range(relations.length()):
                waiting.append(relations.apply(i)._2())
        found = node.expressions()
        for i in range(found.length()):
            waiting += _subqueries(found.apply(i))


def _subqueries(expression) -> list:
    out, waiting = [], [expression]
    while waiting:
        e = waiting.pop()
        kind = e.getClass().getSimpleName()
        if kind in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"):
            out.append(e.plan())
        elif kind == "InSubquery":
            waiting.append(e.query())
        for i in range(e.children().length()):
            waiting.append(e.children().apply(i))
    return out


def _functions(node) -> Iterable[str]:
    """Names of the functions in a node's expressions, and of a generator beside a table."""
    waiting = [node.expressions().apply(i) for i in range(node.expressions().length())]
    if node.nodeName() == "Generate":
        waiting.append(node.generator())
    while waiting:
        e = waiting.pop()
        kind = e.getClass().getSimpleName()
        if kind == "UnresolvedFunction":
            parts = e.nameParts()
            yield ".".join(parts.apply(i) for i in range(parts.length()))
        elif kind == "UnresolvedGenerator":
            yield e.name().funcName()
        elif kind == "UnresolvedAttribute" and e.nameParts().length() == 1 and e.nameParts().apply(0).lower() in SESSION:
            yield e.nameParts().apply(0)
        waiting += [e.children().apply(i) for i in range(e.children().length())]


def _works_on_values(spark: SparkSession, name: str) -> bool:
    """Whether a function is built in and of no closed group; what is registered by a user is not."""
    jvm = spark.sparkContext._jvm
    try:
        info = spark._jsparkSession.sessionState().catalog().lookupFunctionInfo(jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(name))
    except Exception:  # no such function
        return False
    return name.lower() not in SESSION and info.getSource() == "built-in" and info.getGroup() not in ("", CLOSED_GROUP)


def checked(spark: SparkSession, sql: str, tables: Iterable[str], strict_keywords: bool = False) -> str:
    """The statement, if it only reads the given tables and its own CTEs."""
    if strict_keywords and (word := next((w for w in FORBIDDEN if re.search(rf"\b{w}\b", sql, re.I)), None)):
        raise RefusedQuery(f"the word {word} is not allowed")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as e:
        raise RefusedQuery(f"not a statement: {str(e).splitlines()[0]}") from e
    nodes = list(_nodes(plan))
    allowed = {t.lower() for t in tables}
    for node in nodes:
        if node.nodeName() == "UnresolvedWith":
            relations = node.cteRelations()
            allowed |= {relations.apply(i)._1().lower() for i in range(relations.length())}
    for node in nodes:
        name = node.nodeName()
        if name not in READING:
            raise RefusedQuery(f"{name} is not allowed")
        if name == "UnresolvedRelation":
            parts = node.multipartIdentifier()
            if parts.length() != 1 or parts.apply(0).lower() not in allowed:
                raise RefusedQuery(f"unknown table {node.tableName()}")
        if refused := next((f for f in _functions(node) if not _works_on_values(spark, f)), None):
            raise RefusedQuery(f"the function {refused} is not allowed")
    return sql
