"""Training-data operators: dedup, token counts, sharding, mixing, language id, top-k, chat, packing, toxicity.

Nothing else in the library imports this subpackage; its queries are in ``semjoin.llm.queries``.
"""
