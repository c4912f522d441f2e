"""All queries of the core and their SQL."""

from humusgrid.plans import core_queries, domain, exports, extracts, links, relational, reports, statistics, texts, writes

FLAGSHIP = "canned_property_means"
_PARTS = (relational.R, domain.R, links.R, reports.R, extracts.R, writes.R, statistics.R, exports.R, texts.R)
QUERIES = {k: v for part in _PARTS for k, v in part.queries.items()} | core_queries.QUERIES
ORACLE = {k: v for part in _PARTS for k, v in part.oracle.items()} | core_queries.ORACLE
