"""Training-data operators: quality, toxicity, licences, search, decontamination, PII,
token output, HTML extraction, source mixing and near-duplicate joins.

Nothing else in the library imports this subpackage; ``llm.queries`` holds its registered
queries and their SQL.
"""
