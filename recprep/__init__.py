"""recprep: recommender-data preparation and evaluation as lazy Spark jobs.

Every operator is a function ``DataFrame -> DataFrame`` (or returns a Column)
built from Spark SQL / DataFrame primitives, so Catalyst plans it and it runs
unchanged from ``local[8]`` to a large cluster. Driver-side values are limited
to counts and other scalars.
"""

from recprep.session import get_session, materialize, staging_path

__all__ = ["get_session", "materialize", "staging_path"]
