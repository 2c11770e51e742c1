"""daymatrix: daily feature counts and daily matrices on Spark.

Row-level visit and diagnosis tables become one long table of daily counts
(``day, domain, scope, group_value, variable, value, n``) at three geographic
scopes (CAT, RS, UP). Wide matrices, gap-free calendars, fills and the
demand/diagnosis join are renderings of that long table.

Subpackages:

* ``sources``   -- table readers, fixture views, staging/final stores
* ``functions`` -- Column-level cleaning, ICD-10 parsing, feature names
* ``operators`` -- aggregation, reshape, time series, dedup, joins, checks
* ``plans``     -- end-to-end jobs, incremental runs, the query registry
* ``streaming`` -- the Structured Streaming form of the daily count
"""

from daymatrix.session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
