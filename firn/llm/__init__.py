"""Training-data operators: extraction, decontamination, deduplication,
language id, scoring, URL rules, mixing, chat formatting and sharding.

``queries.load()`` returns the registered queries and their SQL; nothing
outside this package imports it.
"""
