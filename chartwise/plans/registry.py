"""Concept registry and the ``build`` entry point.

Each concept is a plain DataFrame function whose parameters are named inputs
(base tables or other concepts).  ``@concept`` records the inputs; a
:class:`Context` resolves them lazily, so one concept's DataFrame is one
Catalyst plan over the base tables unless a node is materialised.

``build`` derives any subset in dependency order.  Nodes read by two or more
requested concepts are materialised once - written to the sink (and read back)
when one is given, otherwise checkpointed to ``spark.checkpoint.dir`` - so the
lineage is cut and a lost executor recomputes from the stored copy, not from
the raw event log.
"""

from __future__ import annotations

import inspect
import threading
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir
from ..sources import store


@dataclass(frozen=True)
class ConceptDef:
    name: str
    fn: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    group: str


REGISTRY: dict[str, ConceptDef] = {}


def concept(name: str | None = None, group: str = ""):
    """Register ``fn``; its parameter names are its inputs."""

    def deco(fn):
        n = name or fn.__name__
        params = tuple(p for p in inspect.signature(fn).parameters)
        REGISTRY[n] = ConceptDef(n, fn, params, group)
        return fn

    return deco


def _load_all() -> None:
    from .. import concepts  # noqa: F401  (populates REGISTRY)


class Context:
    """Resolves names to DataFrames: concepts first, then base tables."""

    def __init__(self, sources):
        _load_all()
        self.sources = sources
        self.spark = sources.spark
        self._memo: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._memo:
            if name in REGISTRY:
                d = REGISTRY[name]
                self._memo[name] = d.fn(*[self.table(i) for i in d.inputs])
            else:
                self._memo[name] = self.sources[name]
        return self._memo[name]

    def pin(self, name: str, df: DataFrame) -> None:
        self._memo[name] = df


def dependencies(targets: Iterable[str]) -> list[str]:
    """Concepts needed for ``targets`` in a valid topological order."""
    _load_all()
    order: list[str] = []
    state: dict[str, int] = {}

    def visit(n: str):
        if n not in REGISTRY:
            return
        s = state.get(n, 0)
        if s == 2:
            return
        if s == 1:
            raise ValueError(f"dependency cycle at {n}")
        state[n] = 1
        for i in REGISTRY[n].inputs:
            visit(i)
        state[n] = 2
        order.append(n)

    for t in targets:
        if t not in REGISTRY:
            raise KeyError(f"unknown concept {t!r}")
        visit(t)
    return order


def build(sources, targets: Iterable[str] | None = None, sink: str | None = None, materialize_shared: bool = True,
          workers: int = 4, resume: str | None = None) -> dict[str, DataFrame]:
    """Derive ``targets`` (default: all) and optionally write each to ``sink/<name>``; name -> DataFrame, read back if written.

    A node is derived as soon as its inputs are there, up to ``workers`` nodes at a time (their jobs share
    the cluster).  A written node lies under a hidden name until it is complete and is then renamed, so ``sink/<name>`` is
    never half a table.  ``resume`` names a run: nodes that a run of this name has completed are read, not derived
    again; without a name every node is derived.  When a node fails no further one is begun, those under way end, and the error is raised.
    """
    _load_all()
    targets = list(targets) if targets is not None else sorted(REGISTRY)
    order = dependencies(targets)
    # a node is worth materialising when it is read twice: by two consumers, or
    # returned to the caller and also consumed downstream
    consumers: dict[str, int] = {n: (1 if n in targets else 0) for n in order}
    for n in order:
        for i in REGISTRY[n].inputs:
            if i in consumers:
                consumers[i] += 1
    ctx = Context(sources)
    spark = sources.spark
    if materialize_shared and sink is None:
        ensure_checkpoint_dir(spark)
    for n in order:                 # base tables first: several nodes need each
        for i in REGISTRY[n].inputs:
            if i not in REGISTRY:
                ctx.table(i)
    planning = threading.Lock()

    def derive(n: str) -> DataFrame:
        path = sink and f"{sink.rstrip('/')}/{n}"
        if path and resume and store.exists(spark, store.mark(path, resume)):
            return spark.read.parquet(path)
        with planning:
            df = ctx.table(n)
        if path:
            store.replace(df, path, resume)
            return spark.read.parquet(path)
        return df.checkpoint(eager=True) if materialize_shared and consumers[n] >= 2 else df

    waiting = {n: {i for i in REGISTRY[n].inputs if i in REGISTRY} for n in order}
    out: dict[str, DataFrame] = {}
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        running: dict = {}
        while len(out) < len(order):
            for n in [n for n in order if n in waiting and waiting[n] <= out.keys()]:
                del waiting[n]
                running[pool.submit(inheritable_thread_target(spark)(derive), n)] = n
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for d in done:
                n = running.pop(d)
                out[n] = d.result()     # raises what the node raised
                with planning:
                    ctx.pin(n, out[n])
    return {n: out[n] for n in order if n in targets or sink is not None}
