"""Registered queries (Spark) and their SQL oracles (DuckDB)."""

from vigil.plans import queries as _q
from vigil.plans.oracle import ORACLES

MODEL_NAMES = ("tree_cascade", "weighted_logreg", "mlp_embeddings", "tree_grid_search", "forest_elimination",
               "mlp_search", "two_targets", "warm_start", "cascade_full", "tree_grid_pruned", "network_binary",
               "network_heads", "bandit_search", "tree_grid_scores", "network_binary_scores", "bandit_scores")
QUERIES = {name: getattr(_q, name) for name in ORACLES if name not in MODEL_NAMES}


def all_queries():
    """Every registered query: the relational ones and the model queries (Spark ML)."""
    from vigil.plans.learning import LEARNING_QUERIES
    from vigil.plans.models import MODEL_QUERIES
    return {**QUERIES, **MODEL_QUERIES, **LEARNING_QUERIES}
