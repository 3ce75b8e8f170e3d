"""Incremental staging loads as Spark jobs: extract past a mark, merge, remember the mark."""

from tidemark.contract import AUDIT_COLUMNS, Column, Contract, is_audit

__all__ = ["AUDIT_COLUMNS", "Column", "Contract", "is_audit"]
