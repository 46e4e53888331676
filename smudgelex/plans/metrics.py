"""Numbers that a job counts on its way, without a pass of their own."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from smudgelex.functions import tokens as t
from smudgelex.operators.tokenize import entity_treatment


def _entities(text: str, markup: str, treatment: str) -> Column:
    """How many entities of a text are treated so; most texts have none."""
    plain = F.col(text) if markup == "none" else t.without_tags(F.col(text), markup, " ")
    names = F.regexp_extract_all(plain, F.lit(t.ENTITY), F.lit(1))
    some = F.size(F.filter(names, lambda n: entity_treatment(n) == treatment))
    return F.sum(F.when(F.contains(text, F.lit("&")), some).otherwise(0))


def _total(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("bigint")


def observe_documents(
    documents: DataFrame, name: str | Observation, text: str = "text", markup: str = "trec"
) -> DataFrame:
    """The same rows; the job that reads them counts ``n_documents``, ``n_malformed``
    and entities that are ``n_kept``, ``n_dropped`` and ``n_unknown``.

    ``name`` is an ``Observation`` for a batch and a name for a stream.
    """
    malformed = F.lit(0).cast("bigint")
    if "malformed" in documents.columns:
        malformed = F.count("malformed")
    kinds = [_total(_entities(text, markup, k)).alias(f"n_{k}") for k in ("kept", "dropped", "unknown")]
    return documents.observe(name, F.count(F.lit(1)).alias("n_documents"), malformed.alias("n_malformed"), *kinds)


def observe_tokens(tokens: DataFrame, name: str | Observation) -> DataFrame:
    """The same rows; the job that reads them counts ``n_processed``, the tokens that are
    not empty, and ``n_symbols`` among them."""
    some = F.count(F.when(F.length("token") > 0, 1))
    symbols = F.count(F.when(F.col("type") == "SYMBOL", 1))
    return tokens.observe(name, some.alias("n_processed"), symbols.alias("n_symbols"))


class StreamMetrics(StreamingQueryListener):
    """Adds up what streams observe; a batch that is run again counts once.

    Register it with ``spark.streams.addListener``.
    """

    def __init__(self) -> None:
        self.batches: dict[tuple[str, str, int], dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            self.batches[name, str(progress.id), progress.batchId] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def totals(self, name: str) -> dict[str, int]:
        out: dict[str, int] = defaultdict(int)
        for (observed, _, _), row in self.batches.items():
            if observed == name:
                for key, value in row.items():
                    out[key] += value or 0
        return dict(out)
