"""Operators for preparing text at scale; nothing else in the package imports this one."""
