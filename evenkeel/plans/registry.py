"""All registered queries, each over the whole of the tables it reads."""

from __future__ import annotations

from evenkeel.plans import clean_proxies, document_queries, finance_queries, handover_queries, planted
from evenkeel.plans.finance_queries import Query
from evenkeel.session import tune


def _tuned(query: Query) -> Query:
    def run(spark, sf_dir):
        return query(tune(spark), sf_dir)
    return run


def queries() -> dict[str, Query]:
    found = {**finance_queries.queries(), **document_queries.queries(),
             **handover_queries.queries(), **clean_proxies.queries(),
             **planted.queries()}
    return {name: _tuned(query) for name, query in found.items()}
