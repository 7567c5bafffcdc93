"""Training-data operators: decontamination, near-dedup, search, token output,
scoring, mixing, language ID, WARC archives and sharding.

Nothing outside this subpackage imports it; the queries are registered through
``casekit.llm.queries``.
"""
