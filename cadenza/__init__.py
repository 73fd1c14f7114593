"""cadenza: a Spark-native song recommender and genre classifier.

Everything is expressed as DataFrame / SQL / ``pyspark.ml`` plans that run
for all users at once.  Sub-packages:

* ``sources``   typed readers, reject tables, sinks, and the derived views
                over the driver tables (plays, songs, attributes, similar,
                genre).
* ``functions`` column-expression builders (ids, packed lists, features).
* ``operators`` relational operators: ids, ratings, sets, top-k, metrics,
                item similarity, ragged arrays, profiles.
* ``plans``     composite user-level plans: collaborative filter (ALS),
                content model, hybrid merge, genre classifiers.
* ``streaming`` Structured Streaming form of the triplet ingest.
"""

from cadenza.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
