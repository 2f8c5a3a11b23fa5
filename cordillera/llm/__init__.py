"""Training-data operators: deduplication, scoring, tokenising, packing, archives.

Nothing outside this folder imports it; ``cordillera.llm.queries`` holds the
registered queries and their SQL.
"""
