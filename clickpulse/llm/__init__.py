"""Training-data operators on Spark: quality, de-duplication, language, scoring, tokens, packing, search, chat.

Nothing outside this package imports it; ``clickpulse.llm.registry`` holds its
registered queries and SQL.
"""
