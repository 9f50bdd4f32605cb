"""All registered queries."""

from __future__ import annotations

from candlemill.registry.base import Query
from candlemill.registry.files import file_queries
from candlemill.registry.keyed import keyed_queries
from candlemill.registry.loads import load_queries
from candlemill.registry.operators import operator_queries
from candlemill.registry.programs import program_queries
from candlemill.registry.reports import report_queries
from candlemill.registry.scalars import scalar_queries


def all_queries() -> list[Query]:
    return [
        *report_queries(),
        *operator_queries(),
        *scalar_queries(),
        *file_queries(),
        *keyed_queries(),
        *load_queries(),
        *program_queries(),
    ]
