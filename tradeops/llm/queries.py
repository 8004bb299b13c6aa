"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from . import op1, op2, op3, op4, op5, op6, op7, op8, op9, op9_runs, op10, op11, op12, op13

_OPS = (op1, op2, op3, op4, op5, op6, op7, op8, op9, op10, op11, op12, op13, op9_runs)

QUERIES = {op.NAME: op.run for op in _OPS}
ORACLE_SQL = {op.NAME: op.SQL for op in _OPS if op.SQL is not None}
