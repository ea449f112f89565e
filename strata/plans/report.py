"""per-layer row counts gathered while the layer is written (no extra pass)."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class RunReport:
    """Collects one ``Observation`` per layer; ``counts()`` reads them after the writes.

    When Catalyst proves an input empty it removes the observed node and no
    metrics arrive; the layer is then counted from what was written (a
    ``fallback`` callable, typically a metadata-only count of the stored table).
    """

    def __init__(self):
        self._obs: dict[str, tuple[Observation, Callable[[], int] | None]] = {}

    def track(self, layer: str, df: DataFrame, fallback: Callable[[], int] | None = None,
              extra: dict[str, Column] | None = None) -> DataFrame:
        """Observe the row count (plus ``extra`` aggregate metrics) of ``df``."""
        obs = Observation(layer)
        self._obs[layer] = (obs, fallback)
        metrics = [F.count(F.lit(1)).alias("rows")]
        metrics += [expr.alias(name) for name, expr in (extra or {}).items()]
        return df.observe(obs, *metrics)

    def tap(self, layer: str, fallback: Callable[[], int] | None = None,
            extra: dict[str, Column] | None = None):
        """``track`` as a function of the frame, for sinks that apply it
        right before writing (after their own rebalance)."""
        return lambda df: self.track(layer, df, fallback, extra)

    def metric(self, layer: str, name: str):
        """An extra metric of a layer, or None when no metrics arrived."""
        return (self._metrics(layer) or {}).get(name)

    def _metrics(self, layer: str) -> dict | None:
        """The metrics of a layer, or None where the observed node was optimised away:
        the row that arrives then has no schema.  Any other error is raised."""
        try:
            return self._obs[layer][0].get
        except Py4JJavaError as e:
            if e.java_exception.getClass().getName() == "java.lang.AssertionError":
                return None
            raise

    def counts(self) -> dict[str, int]:
        """Rows per layer.  Only metrics that never arrived are replaced by a recount;
        an error while they are fetched is an error."""
        out = {}
        for layer, (_, fallback) in self._obs.items():
            rows = (self._metrics(layer) or {}).get("rows")
            if rows is None:
                if fallback is None:
                    raise RuntimeError(f"no metrics arrived for layer {layer}")
                rows = fallback()
            out[layer] = int(rows)
        return out
