"""All corpus queries: importing the operators registers them."""

from topiclake.llm import edit_counts, embedding_dedup, exact_dedup, html_text, language_id, lexical_search, mixing, packing, quality, simhash, spelling_variants, substring_dedup, toxicity  # noqa: F401
from topiclake.llm.registry import ORACLES, QUERIES  # noqa: F401
