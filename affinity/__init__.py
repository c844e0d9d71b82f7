"""Purchase-affinity analytics on Spark.

Sub-packages:

- ``sources``   readers, writers and schemas (transactions, dimensions, derived tables, model state)
- ``functions`` column expressions (dates, weights, hashing, scores, average precision)
- ``operators`` DataFrame -> DataFrame operators (ids, preparation, quantiles, sampling,
  latent factors, scoring, evaluation)
- ``plans``     end-to-end jobs (prepare, train, score) and plan/broadcast helpers
- ``streaming`` intentionally empty: every input of the workload is a batch file scan
"""

from affinity.session import checkpoint_dir, get_session

__all__ = ["checkpoint_dir", "get_session"]
