"""Identifiers: the first 16 hexadecimal digits of a SHA-1 over the parts, joined without separator."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def short_hash(*parts: Column) -> Column:
    return F.substring(F.sha1(F.concat(*[p.cast("string") for p in parts]).cast("binary")), 1, 16)


def record_id(doc: Column, cls: Column, start: Column, end: Column, run: Column) -> Column:
    return short_hash(doc, cls, start, end, run)


def edge_id(citing: Column, cited: Column) -> Column:
    return short_hash(citing, cited)


def run_name(community: str, pass_name: str, day: str, number: int) -> str:
    return f"{community}_{pass_name}_{day}_{number:03d}"
