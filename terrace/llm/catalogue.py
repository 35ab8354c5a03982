"""All queries of the subpackage: importing the query modules registers them."""

from . import q_corpus, q_models, q_tables, q_text
from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "q_corpus", "q_models", "q_tables", "q_text"]
