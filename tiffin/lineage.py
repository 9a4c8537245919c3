"""Which tables a frame reads, from its own analysed plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Folders written by this session's jobs, and the tables that they were made from: a copy does not
# hide where its rows come from.
_COPIES: dict[str, frozenset[str]] = {}


def _plain(path: str) -> str:
    scheme, _, rest = path.rpartition(":")
    return (rest if scheme in ("file", "") else path).rstrip("/").replace("//", "/")


def _leaves(plan):
    yield from _each(plan.collectLeaves())
    for inner in _each(plan.subqueriesAll()):
        yield from _leaves(inner)


def _each(seq):
    return [seq.apply(i) for i in range(seq.size())]


def sources(df: DataFrame) -> frozenset[str]:
    """Names of the tables below ``df``, those in subqueries and behind written copies included.

    Only the plan is looked at: no file is listed and nothing runs. Rows that the driver made are
    named ``local``.
    """
    found: set[str] = set()
    for leaf in _leaves(df._jdf.queryExecution().analyzed()):
        kind = leaf.getClass().getSimpleName()
        if kind == "LogicalRelation" and \
                leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            for root in _each(leaf.relation().location().rootPaths()):
                path = _plain(root.toString())
                found |= _COPIES.get(path) or {path.rsplit("/", 1)[-1].removesuffix(".parquet")}
        elif kind in ("LocalRelation", "LogicalRDD", "ExternalRDD"):
            found.add("local")
    return frozenset(found)


def copied(path: str, df: DataFrame) -> None:
    """Remember what a folder was written from."""
    _COPIES[_plain(path)] = sources(df)
