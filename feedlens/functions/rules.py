"""Validation rules as Column builders (Q1, Q2, Q9).

A rule binding names a column (possibly a dotted path into structs and
arrays), a registered validation and optional parameters. Each validation
turns a binding into ``(failed: Column, message: str)`` pairs; a NULL
``failed`` counts as passed.

Row validations look at several columns, named by the parameter ``columns`` (else the bound column alone):
a condition over them, their uniqueness in a batch, or their presence in another table. The last two need
other rows, so they read a mark that ``operators.row_rules.mark`` has put on each row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Error-message templates of the rules.
NULL_MESSAGE = "Column {column} is null"
NULL_ELEMENT_MESSAGE = "Column {column} has null elements"
TYPE_MESSAGE = "Column {column} is not {dtype}"
CONDITION_MESSAGE = "Row does not satisfy {condition}"
UNIQUE_MESSAGE = "Key {columns} is not unique"
REFERENCE_MESSAGE = "Key {columns} is not in {table}"


@dataclass(frozen=True)
class Rule:
    id: int                      # dataset_column_validation id (orders the messages)
    column: str                  # column name or dotted path
    validation: str              # registered validation name
    datatype: str | None = None  # declared column type (data-type rule)
    params: str | None = None    # JSON parameters as registered


def _through_array(path: str, schema: T.StructType) -> bool:
    """True when the dotted path crosses an array (field access maps over it)."""
    dtype: T.DataType = schema
    for part in path.split("."):
        if isinstance(dtype, T.ArrayType):
            return True
        if not isinstance(dtype, T.StructType) or part not in dtype.names:
            return False
        dtype = dtype[part].dataType
    return False


def null_failures(rule: Rule, schema: T.StructType) -> list[tuple[Column, str]]:
    """Column is NULL. For a path through an array the reference check fires
    only when the whole array is NULL; a NULL element is reported separately."""
    c = F.col(rule.column)
    out = [(c.isNull(), NULL_MESSAGE.format(column=rule.column))]
    if _through_array(rule.column, schema):
        out.append((F.exists(c, lambda x: x.isNull()),
                    NULL_ELEMENT_MESSAGE.format(column=rule.column)))
    return out


def param(rule: Rule, name: str):
    """A value from the rule's JSON parameters (None when absent or unparsable)."""
    import json
    try:
        params = json.loads(rule.params) if rule.params else {}
    except ValueError:
        return None
    return params.get(name) if isinstance(params, dict) else None


def type_failures(rule: Rule, schema: T.StructType) -> list[tuple[Column, str]]:
    """Value present but not castable to the expected type: the ``type``
    parameter when the binding has one, else the column's declared type."""
    dtype = str(param(rule, "type") or rule.datatype or "STRING").upper()
    c = F.col(rule.column)
    return [(c.isNotNull() & c.try_cast(dtype).isNull(), TYPE_MESSAGE.format(column=rule.column, dtype=dtype))]


def rule_columns(rule: Rule) -> list[str]:
    """The columns a rule reads: those of its ``columns`` parameter (row validations), else the bound one."""
    named = param(rule, "columns")
    if rule.validation in ROW_VALIDATIONS and isinstance(named, list) and named:
        return [str(c) for c in named]
    return [rule.column]


def condition_failures(rule: Rule, schema: T.StructType) -> list[tuple[Column, str]]:
    """The ``condition`` parameter, a SQL expression over the row, is false; NULL counts as passed."""
    condition = param(rule, "condition")
    if not condition:
        raise ValueError(f"rule {rule.id} has no condition")
    return [(~F.expr(str(condition)), CONDITION_MESSAGE.format(condition=condition))]


def mark_name(rule: Rule) -> str:
    """The column in which a row's mark for a rule over other rows stands."""
    return f"__row_rule_{rule.id}"


def unique_failures(rule: Rule, schema: T.StructType) -> list[tuple[Column, str]]:
    """Another row of the batch has the same key; keys with a NULL are not compared."""
    return [(F.col(mark_name(rule)), UNIQUE_MESSAGE.format(columns=", ".join(rule_columns(rule))))]


def reference_failures(rule: Rule, schema: T.StructType) -> list[tuple[Column, str]]:
    """The table named by the parameter ``table`` has no such key; keys with a NULL refer to nothing and pass."""
    return [(F.col(mark_name(rule)), REFERENCE_MESSAGE.format(columns=", ".join(rule_columns(rule)), table=param(rule, "table")))]


# Registered validation names.
VALIDATIONS: dict[str, Callable[[Rule, T.StructType], list[tuple[Column, str]]]] = {
    "column_null_validation": null_failures,
    "data_type_validation": type_failures,
    "row_condition_validation": condition_failures,
    "row_unique_validation": unique_failures,
    "row_reference_validation": reference_failures,
}
ROW_VALIDATIONS = ("row_condition_validation", "row_unique_validation", "row_reference_validation")
#: Row validations over other rows too.
MARKED_VALIDATIONS = ("row_unique_validation", "row_reference_validation")


def column_exists(path: str, schema: T.StructType) -> bool:
    """Whether a dotted path resolves in the schema (through structs and arrays)."""
    dtype: T.DataType = schema
    for part in path.split("."):
        while isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
        if not isinstance(dtype, T.StructType) or part not in dtype.names:
            return False
        dtype = dtype[part].dataType
    return True


def missing_rules(rules: list[Rule], schema: T.StructType) -> list[Rule]:
    """Rules whose column is not in the batch: they fail on their own."""
    return [r for r in sorted(rules, key=lambda r: r.id) if not runs_on(r, schema)]


def runs_on(rule: Rule, schema: T.StructType) -> bool:
    return all(column_exists(c, schema) for c in rule_columns(rule))


def checks(rules: list[Rule], schema: T.StructType) -> list[tuple[Rule, Column, str]]:
    """Failure conditions of the rules whose column exists (the others are
    reported by ``missing_rules``, so one bad binding does not stop the rest)."""
    out = []
    for r in sorted(rules, key=lambda r: r.id):
        if not runs_on(r, schema):
            continue
        try:
            build = VALIDATIONS[r.validation]
        except KeyError:
            raise ValueError(f"unknown validation {r.validation!r}") from None
        out += [(r, cond, msg) for cond, msg in build(r, schema)]
    return out
