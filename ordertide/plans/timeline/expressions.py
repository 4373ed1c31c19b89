"""Configuration expressions to Spark columns.

The configuration holds a handful of short texts such as
``max(ci_payment_date, add_days(sm_signoff_ts, 2))``. Each is translated once, on the driver,
into a Column; rows never see the text. Anything outside the small set below is rejected.

Missing values: arithmetic on a missing value is missing, ``max`` skips what is not a date,
``==`` with a missing side is False and ``!=`` is True. Ordering a missing value is an error of the row, and so is a text
that should be a date and is none: every term carries, beside its value, the text of the first error on the way to it.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...functions.dates import days_between, plus_days, plus_fractional_days

STAGE_NAME = re.compile(r"^stage_(.+)$")
_COMPARE = {
    ast.Lt: lambda a, b: a < b,
    ast.LtE: lambda a, b: a <= b,
    ast.Gt: lambda a, b: a > b,
    ast.GtE: lambda a, b: a >= b,
}


@dataclass(frozen=True)
class Term:
    """A typed column: kind is date, int, number, bool, text or null. ``error`` is NULL in rows without one."""

    column: Column
    kind: str
    error: Column | None = None

    @property
    def numeric(self) -> bool:
        return self.kind in ("int", "number")



def first_error(*errors: Column | None) -> Column | None:
    """The first error that a row has; None where no row can have one."""
    known = [error for error in errors if error is not None]
    return known[0] if len(known) == 1 else F.coalesce(*known) if known else None


def _chosen_error(test: Column, yes: Column | None, no: Column | None) -> Column | None:
    """The error of the branch that a row takes."""
    if yes is None and no is None:
        return None
    none = F.lit(None).cast("string")
    return F.when(test, none if yes is None else yes).otherwise(none if no is None else no)


def null_date() -> Column:
    return F.lit(None).cast("timestamp")


def parse(text: str | None) -> ast.expr | None:
    """The expression tree, or None for an empty text or the word None."""
    if text is None or not text.strip():
        return None
    body = ast.parse(text.strip(), mode="eval").body
    if isinstance(body, ast.Constant) and body.value is None:
        return None
    return body


def column_term(name: str, kind: T.DataType) -> Term:
    """A source column as a term; dates become timestamps."""
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return Term(column.cast("timestamp"), "date")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return Term(column, "int")
    if isinstance(kind, T.NumericType):
        return Term(column.cast("double"), "number")
    if isinstance(kind, T.BooleanType):
        return Term(column, "bool")
    return Term(column, "text")


class Scope:
    """What names mean: source columns first by schema, ``stage_N`` by computed stage.

    ``unreadable`` holds the error of source columns that were read from text.
    """

    def __init__(self, schema: T.StructType, stage_dates: dict[str, Column], unreadable: dict[str, Column] | None = None):
        self.kinds = {item.name: item.dataType for item in schema.fields}
        self.stage_dates = stage_dates
        self.unreadable = unreadable or {}

    def latest(self, stage_ids: Iterable[str]) -> Column:
        """The latest date among the listed stages."""
        return latest_of([self.stage_dates[stage_id] for stage_id in stage_ids])

    def name(self, name: str) -> Term:
        stage = STAGE_NAME.match(name)
        if stage and stage.group(1) in self.stage_dates:
            return Term(self.stage_dates[stage.group(1)], "date")
        if name in self.kinds:
            term = column_term(name, self.kinds[name])
            return Term(term.column, term.kind, self.unreadable.get(name))
        return Term(F.lit(None), "null")


def compile_term(node: ast.expr, scope: Scope) -> Term:
    if isinstance(node, ast.Name):
        return scope.name(node.id)
    if isinstance(node, ast.Constant):
        return _constant(node.value)
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
        inner = compile_term(node.operand, scope)
        return Term(-inner.column, inner.kind, inner.error) if inner.numeric else Term(F.lit(None), "null", inner.error)
    if isinstance(node, ast.BinOp):
        left, right = compile_term(node.left, scope), compile_term(node.right, scope)
        term = _arithmetic(node.op, left, right)
        return Term(term.column, term.kind, first_error(left.error, right.error))
    if isinstance(node, ast.Compare):
        return _comparison(node, scope)
    if isinstance(node, ast.Call) and isinstance(node.func, ast.Name):
        return _call(node, scope)
    raise ValueError(f"not allowed in a stage expression: {ast.unparse(node)}")


def _constant(value) -> Term:
    if value is None:
        return Term(F.lit(None), "null")
    if isinstance(value, bool):
        return Term(F.lit(value), "bool")
    if isinstance(value, int):
        return Term(F.lit(value), "int")
    if isinstance(value, float):
        return Term(F.lit(value), "number")
    return Term(F.lit(str(value)), "text")


def _shift(date: Term, days: Term, sign: int) -> Term:
    amount = days.column if sign > 0 else -days.column
    if days.kind == "int":
        return Term(plus_days(date.column, amount), "date")
    return Term(plus_fractional_days(date.column, amount), "date")


def _arithmetic(op: ast.operator, left: Term, right: Term) -> Term:
    if "null" in (left.kind, right.kind):
        return Term(F.lit(None), "null")
    if isinstance(op, ast.Add):
        if left.kind == "date" and right.numeric:
            return _shift(left, right, 1)
        if right.kind == "date" and left.numeric:
            return _shift(right, left, 1)
    if isinstance(op, ast.Sub) and left.kind == "date":
        if right.numeric:
            return _shift(left, right, -1)
        if right.kind == "date":
            return Term(days_between(left.column, right.column), "int")
    if not (left.numeric and right.numeric):
        raise ValueError(f"cannot combine {left.kind} and {right.kind}")
    if isinstance(op, ast.Div):
        return Term(F.try_divide(left.column.cast("double"), right.column.cast("double")), "number")
    kind = "int" if left.kind == right.kind == "int" else "number"
    if isinstance(op, ast.Add):
        return Term(left.column + right.column, kind)
    if isinstance(op, ast.Sub):
        return Term(left.column - right.column, kind)
    if isinstance(op, ast.Mult):
        return Term(left.column * right.column, kind)
    raise ValueError(f"operator {type(op).__name__} is not allowed in a stage expression")


def _comparison(node: ast.Compare, scope: Scope) -> Term:
    if len(node.ops) != 1:
        raise ValueError("only one comparison at a time is allowed")
    left = compile_term(node.left, scope)
    right = compile_term(node.comparators[0], scope)
    op = node.ops[0]
    if isinstance(op, (ast.Eq, ast.NotEq)):
        comparable = left.kind == right.kind or (left.numeric and right.numeric)
        equal = F.coalesce(left.column == right.column, F.lit(False)) if comparable else F.lit(False)
        return Term(equal if isinstance(op, ast.Eq) else ~equal, "bool", first_error(left.error, right.error))
    if type(op) not in _COMPARE:
        raise ValueError(f"comparison {type(op).__name__} is not allowed in a stage expression")
    missing = F.when(left.column.isNull() | right.column.isNull(), F.lit(f"{ast.unparse(node)}: a side is missing"))
    return Term(_COMPARE[type(op)](left.column, right.column), "bool", first_error(left.error, right.error, missing))


def _truth(term: Term) -> Column:
    if term.kind == "bool":
        return F.coalesce(term.column, F.lit(False))
    if term.numeric:
        return F.coalesce(term.column != 0, F.lit(False))
    return term.column.isNotNull()


def _call(node: ast.Call, scope: Scope) -> Term:
    name = node.func.id
    if name in ("cond", "iff"):
        if len(node.args) != 3:
            raise ValueError(f"{name} needs a condition and two values")
        asked = compile_term(node.args[0], scope)
        test = _truth(asked)
        yes, no = (compile_term(arg, scope) for arg in node.args[1:])
        error = first_error(asked.error, _chosen_error(test, yes.error, no.error))
        kinds = {yes.kind, no.kind} - {"null"}
        if kinds == {"int", "number"}:
            kinds = {"number"}
        if len(kinds) > 1:
            raise ValueError(f"{name} has values of different kinds: {sorted(kinds)}")
        return Term(F.when(test, yes.column).otherwise(no.column), kinds.pop() if kinds else "null", error)
    terms = [compile_term(arg, scope) for arg in node.args]
    error = first_error(*[term.error for term in terms])
    if name == "max":
        return Term(latest_of([term.column for term in terms if term.kind == "date"]), "date", error)
    if name == "add_days":
        if len(terms) < 2 or terms[0].kind != "date" or not terms[1].numeric:
            return Term(null_date(), "date", error)
        return Term(plus_days(terms[0].column, terms[1].column), "date", error)
    raise ValueError(f"unknown function {name} in a stage expression")


def latest_of(dates: list[Column]) -> Column:
    """The latest date present; NULL where none is."""
    if not dates:
        return null_date()
    return dates[0] if len(dates) == 1 else F.greatest(*dates)


def date_expression(text: str | None, scope: Scope) -> Column | None:
    """A date column for the text; None where the text can never give a date."""
    node = parse(text)
    if node is None:
        return None
    term = compile_term(node, scope)
    return term.column if term.kind == "date" else None


def expression_error(text: str | None, scope: Scope) -> Column | None:
    """The error that a row has in the text; None where no row can have one."""
    node = parse(text)
    return None if node is None else compile_term(node, scope).error


@dataclass(frozen=True)
class Edges:
    """Predecessors of a stage: a plain list, or two lists chosen per row. ``wrong`` is the error of the test."""

    ids: tuple[str, ...] = ()
    test: Column | None = None
    yes: Edges | None = None
    no: Edges | None = None
    wrong: Column | None = None

    @property
    def error(self) -> Column | None:
        """The error that a row has on the way to its list."""
        if self.test is None:
            return None
        return first_error(self.wrong, _chosen_error(self.test, self.yes.error, self.no.error))

    def choose(self, build):
        """Apply ``build`` (list of ids -> Column) under the per-row choice."""
        if self.test is None:
            return build(self.ids)
        return F.when(self.test, self.yes.choose(build)).otherwise(self.no.choose(build))


def compile_edges(preceding: str | Iterable[str] | None, scope: Scope, known: set[str]) -> Edges:
    """Predecessor lists as Edges; ids that name no stage are ignored."""
    if preceding is None:
        return Edges()
    if isinstance(preceding, str):
        node = parse(preceding)
        return Edges() if node is None else _edges(node, scope, known)
    items = list(preceding)
    if len(items) == 1 and re.match(r"\s*(iff|cond)\(", items[0]):
        return _edges(parse(items[0]), scope, known)
    return Edges(tuple(item for item in items if item in known))


def _edges(node: ast.expr, scope: Scope, known: set[str]) -> Edges:
    if isinstance(node, ast.List):
        ids = [str(item.value) for item in node.elts if isinstance(item, ast.Constant)]
        return Edges(tuple(item for item in ids if item in known))
    if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and node.func.id in ("cond", "iff"):
        if len(node.args) != 3:
            raise ValueError(f"{node.func.id} needs a condition and two lists")
        asked = compile_term(node.args[0], scope)
        return Edges((), _truth(asked), _edges(node.args[1], scope, known), _edges(node.args[2], scope, known), asked.error)
    return Edges()


def candidate_edges(preceding: str | Iterable[str] | None) -> set[str]:
    """Every stage id that some row may have as predecessor."""
    if preceding is None:
        return set()
    texts = [preceding] if isinstance(preceding, str) else list(preceding)
    found: set[str] = set()
    for text in texts:
        if not isinstance(preceding, str) and not re.match(r"\s*(iff|cond)\(", text):
            found.add(text)
            continue
        node = parse(text)
        for part in ast.walk(node) if node is not None else ():
            if isinstance(part, ast.List):
                found |= {str(item.value) for item in part.elts if isinstance(item, ast.Constant)}
    return found


def referenced_stages(preceding, *expressions: str | None) -> set[str]:
    """Stage ids read by the predecessor lists and by ``stage_N`` names."""
    found = candidate_edges(preceding)
    texts = [text for text in expressions if text]
    if isinstance(preceding, str):
        texts.append(preceding)
    for text in texts:
        node = parse(text)
        for part in ast.walk(node) if node is not None else ():
            if isinstance(part, ast.Name) and STAGE_NAME.match(part.id):
                found.add(STAGE_NAME.match(part.id).group(1))
    return found
