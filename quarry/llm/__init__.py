"""Training-data operators: scoring, tokenising, de-duplication, extraction.

Nothing outside this folder imports it; ``queries.py`` registers its queries.
"""
