"""Column-level feature operators and the op registry."""

from orderlens.functions.ops import OPS, Val, register_op

__all__ = ["OPS", "Val", "register_op"]
