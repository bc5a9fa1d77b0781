"""Training-data operators: language ID, mixing, de-duplication, sharding, search, scoring, mining.

Thirteen operators that share nothing with the flow-analytics half of the library;
``queries()`` and ``oracle_sql()`` hand their registered queries to the entry
module.  Nothing outside this package imports it.
"""

from __future__ import annotations


def queries() -> dict:
    from flowlens.llm.catalogue import QUERIES
    return dict(QUERIES)


def oracle_sql() -> dict:
    from flowlens.llm.catalogue import ORACLES
    return dict(ORACLES)
